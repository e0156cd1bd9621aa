"""Flat changes to nested commits and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.messages import is_weak_issue_summary

# How far a summary's source is trusted.
SOURCE_RANK = {"issue_title": 5, "pull_request_title": 4, "commit_subject": 3, "commit_body": 2, "existing_issue_summary": 1}
TEXTS = ["code_before", "code_after", "javadoc_before", "javadoc_after"]


def flatten(nested: DataFrame, key: str) -> DataFrame:
    """One row a change with ``change_index`` and the commit's columns; commits without changes give none."""
    keep = [c for c in nested.columns if c != "changes"]
    exploded = nested.select(*keep, F.posexplode("changes").alias("pos", "change"))
    texts = [F.col(f"change.{c}").alias(c) for c in ("change_index", "entity_type", *TEXTS)]
    return exploded.select(*keep, *texts, (F.col(key) * 100_000 + F.col("pos") + 1).alias("source_order"))


def group(changes: DataFrame) -> DataFrame:
    """(project_slug, commit_hash, repository_url, issue_summary, changes, first_order) of each commit.

    ``changes`` needs ``fp`` and a total ``source_order``. Equal contents of a commit stay once, first in
    order; ``change_index`` counts from 1. A commit's changes form one row by nature of the result; repeats
    are dropped by a combining aggregate before any list is built.
    """
    key = ["project_slug", "commit_hash"]
    rank = F.lit(0)
    for name, value in SOURCE_RANK.items():
        rank = F.when(F.col("issue_summary_source") == name, value).otherwise(rank)
    best = F.max(F.struct((~is_weak_issue_summary(F.col("issue_summary"))).alias("good"), rank.alias("rank"), (-F.col("source_order")).alias("o"), F.col("issue_summary").alias("s")))
    url = F.min(F.struct(F.col("source_order").alias("o"), F.col("repository_url").alias("u")))
    ranked = changes.withColumn("issue_summary_source", F.coalesce("issue_summary_source", F.lit("existing_issue_summary")))
    contents = ranked.groupBy(*key, "fp").agg(
        F.min(F.struct("source_order", "entity_type", *TEXTS)).alias("c"), best.alias("best"), url.alias("url")
    )
    commits = contents.groupBy(*key).agg(
        F.array_sort(F.collect_list("c")).alias("cs"), F.max("best").alias("best"), F.min("url").alias("url")
    )
    nested = F.transform(
        "cs", lambda c, i: F.struct((i + 1).alias("change_index"), c["entity_type"].alias("entity_type"), *[c[t].alias(t) for t in TEXTS])
    )
    return commits.select(
        *key, F.col("url.u").alias("repository_url"), F.col("best.s").alias("issue_summary"), nested.alias("changes"), F.col("url.o").alias("first_order")
    )


def conflicts(changes: DataFrame) -> DataFrame:
    """(project_slug, commit_hash, candidates): commits with two different summaries or more, and those in order."""
    seen = changes.select("project_slug", "commit_hash", "issue_summary").distinct()
    grouped = seen.groupBy("project_slug", "commit_hash").agg(F.sort_array(F.collect_list("issue_summary")).alias("candidates"))
    return grouped.where(F.size("candidates") > 1)
