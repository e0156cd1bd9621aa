"""Issue titles from a table fetched beforehand; the engine itself asks no network."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.messages import looks_like_issue_id
from ..functions.summaries import first_paragraph

# Where a title comes from, most trusted first.
SOURCES = ["github_issue", "jira_issue", "pull_request"]


def resolve(commits: DataFrame, titles: DataFrame) -> DataFrame:
    """(commit_seq, issue_id, issue_summary): of a commit's ids the title of the most trusted source.

    ``commits`` has ``issue_ids`` in order of sight, ``titles`` (project_slug, issue_id, title, source). Titles
    that are ids themselves are passed over; ties go to the earlier id. Without a title: the first id (or
    empty) and the message's first paragraph. Each id is looked up once a project.
    """
    rank = F.lit(len(SOURCES))
    for i, name in enumerate(SOURCES):
        rank = F.when(F.col("source") == name, i).otherwise(rank)
    known = titles.where(F.col("title").isNotNull() & ~looks_like_issue_id(F.trim("title"))).withColumn("rank", rank).where(F.col("rank") < len(SOURCES))
    known = known.groupBy("project_slug", "issue_id").agg(F.min(F.struct("rank", "title")).alias("t"))
    ids = commits.select("commit_seq", "project_slug", F.posexplode("issue_ids").alias("pos", "issue_id"))
    best = ids.join(known, ["project_slug", "issue_id"]).groupBy("commit_seq").agg(F.min(F.struct("t.rank", "pos", "issue_id", "t.title")).alias("b"))
    first = F.coalesce(F.get("issue_ids", F.lit(0)), F.lit(""))
    return commits.join(best, "commit_seq", "left").select(
        "commit_seq", F.coalesce("b.issue_id", first).alias("issue_id"), F.coalesce("b.title", first_paragraph(F.col("message"))).alias("issue_summary")
    )
