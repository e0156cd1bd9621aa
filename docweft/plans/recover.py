"""Targeted recovery: commits of a grouped dataset are read again under looser gates, and what is new is merged in."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sinks
from ..functions import paths
from ..functions.text import commit_hash, fingerprint, slug, text_or_empty
from ..operators import dedup, nest, summarize
from ..operators.running import numbered
from ..sources import git
from ..storage import exists, written
from . import jobs, mining

# Reasons that say nothing of a change's quality.
SILENT = ["code_not_changed", "identical_code", "identical_javadoc", "empty_javadoc"]
TEXTS = jobs.TEXTS


def targets(nested: DataFrame, least: int = 3) -> DataFrame:
    """(slug, h, current_change_count, issue_summary) of the commits with ``least`` changes or more, one row a commit."""
    keyed = nested.select(slug(F.col("project_slug")).alias("slug"), commit_hash(F.col("commit_hash")).alias("h"), F.size("changes").alias("n"), "issue_summary", "row_seq")
    grouped = keyed.where("slug is not null and h is not null").groupBy("slug", "h")
    return grouped.agg(F.sum("n").alias("current_change_count"), F.min_by("issue_summary", "row_seq").alias("issue_summary")).where(F.col("current_change_count") >= least)


def reprocess(table: DataFrame, file_changes: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Every aligned pair of the wanted commits with its reason; silent reasons are dropped. ``wanted`` (slug, h) prunes files by a semi join."""
    files = file_changes
    if wanted is not None:
        keyed = file_changes.withColumns({"slug": slug(F.col("project_slug")), "h": commit_hash(F.col("commit_hash"))})
        files = keyed.join(wanted.select("slug", "h"), ["slug", "h"], "left_semi").drop("slug", "h")
    kept = ["file_id", "new_id", "project_slug", "commit_hash", "new_entity_type", "reason", *TEXTS]
    return written(jobs.recovered_changes(table, files).where(~F.col("reason").isin(SILENT)).select(*kept), "reasons")


def flat_changes(nested: DataFrame) -> DataFrame:
    """The dataset's changes with fingerprints, numbered by commit and position."""
    flat = nest.flatten(nested, "row_seq")
    return flat.withColumn("fp", fingerprint(*[F.col(c) for c in TEXTS]))


def merge_recovered(current: DataFrame, recovered: DataFrame) -> dict[str, DataFrame]:
    """New changes joined to the current ones: audit of repeats, and the regrouped dataset.

    ``recovered`` are kept pairs of ``reprocess``. Of equal contents the first in file order stays, and none
    that the dataset holds already.
    """
    ready = recovered.where("reason = ''").select(
        "project_slug", "commit_hash", F.lit("").alias("repository_url"), F.lit("").alias("issue_summary"), F.lit("existing_issue_summary").alias("issue_summary_source"), F.col("new_entity_type").alias("entity_type"),
        *TEXTS, (F.lit(10**15) + F.col("new_id")).alias("source_order"), fingerprint(*[F.col(c) for c in TEXTS]).alias("fp"),
    )
    told = dedup.against_frozen(ready, current, ["fp"], "source_order")
    fresh = told.where("outcome = 'new'").drop("outcome")
    kept = current.select(*[c for c in fresh.columns if c in current.columns]).withColumn("issue_summary_source", F.lit("existing_issue_summary"))
    kept = kept.withColumns({c: text_or_empty(F.col(c)) for c in ("issue_summary", "repository_url", *TEXTS)})
    first = dedup.keep_first(kept.unionByName(fresh), ["fp"], ["source_order"], ["source_order"]).select("fp", "source_order")
    merged = kept.unionByName(fresh).join(first, ["fp", "source_order"], "left_semi")
    fresh = written(fresh, "fresh")
    # What was left out, row by row, with the first current change of the same content where there is one.
    held = current.groupBy("fp").agg(F.min("source_order").alias("kept_order"))
    left_out = told.where("outcome <> 'new'").join(held, "fp", "left").select("project_slug", "commit_hash", "entity_type", "outcome", "fp", "source_order", "kept_order")
    return {"fresh": fresh, "audit": told.groupBy("outcome").agg(F.count("*").alias("changes")), "duplicates": left_out, "nested": nest.group(merged)}


@dataclass
class RecoverOptions:
    cache_dir: str
    output_dir: str
    least: int = 3
    only: list[tuple[str, str]] = field(default_factory=list)  # (project, commit) to keep to; empty: all targets
    force_refresh: bool = False
    fetch_existing: bool = True
    git_timeout: float = 180


def recover_repositories(spark: SparkSession, nested: DataFrame, options: RecoverOptions) -> dict:
    """Reads the target commits of a grouped dataset (row_seq first) again from their repositories and merges in what is new.

    ``nested`` has project_slug, repository_url, commit_hash, issue_summary, changes and row_seq. Repositories are taken one
    by one; a run that starts again passes over what is done. Failures are kept with their reason and reported as unresolved.
    """
    wanted = targets(nested, options.least)
    if options.only:
        wanted = audited(wanted, options.only)
    urls = nested.select(slug(F.col("project_slug")).alias("slug"), "repository_url").where("repository_url <> ''").groupBy("slug").agg(F.min("repository_url").alias("url"))
    wanted = written(wanted.join(urls, "slug", "left").select(F.col("slug").alias("project_slug"), F.col("h").alias("commit_hash"), "url"), "targets")
    progress = sinks.Progress(spark, f"{options.output_dir}/progress")
    rest = written(progress.rest(wanted), "rest")
    for row in rest.select("project_slug", "url").distinct().collect():  # one row a repository
        mine = rest.where(F.col("project_slug") == row["project_slug"])
        failures = None
        try:
            if not row["url"]:
                raise git.GitError("no repository is known")
            clone = git.clone_or_update(row["url"], options.cache_dir, options.force_refresh, options.fetch_existing)
        except (git.GitError, OSError) as error:
            failures = mine.select("project_slug", "commit_hash", F.lit("missing_local_repo_cache").alias("reason"), F.lit(str(error)[:1000]).alias("detail"))
        else:
            named = written(git.named_changes(mine, clone, options.git_timeout), "named")
            failures = named.where("name_status is null").select(F.lit(row["project_slug"]).alias("project_slug"), "commit_hash", F.lit("git_extract_failed").alias("reason"), F.col("error").alias("detail"))
            places = numbered(named.where("name_status is not null"), [], ["commit_hash"], "scan_seq")
            paths_of = places.select("commit_hash", "scan_seq", F.posexplode(paths.changed_paths(F.col("name_status"))).alias("file_seq", "path"))
            reprocess(*mining.entities_of(paths_of, clone, row["project_slug"])).write.mode("append").parquet(f"{options.output_dir}/reasons")
        failures.write.mode("append").parquet(f"{options.output_dir}/failures")
        progress.add(mine)
    kept = "file_id bigint, new_id bigint, project_slug string, commit_hash string, new_entity_type string, reason string, " + ", ".join(f"{c} string" for c in TEXTS)
    read = lambda name, schema: spark.read.schema(schema).parquet(f"{options.output_dir}/{name}") if exists(spark, f"{options.output_dir}/{name}") else spark.createDataFrame([], schema)
    # A run that was stopped between writing a repository's reasons and noting it would write them twice.
    reasons = written(read("reasons", kept).dropDuplicates(), "reasons")
    failed = read("failures", "project_slug string, commit_hash string, reason string, detail string").dropDuplicates()
    parts = merge_recovered(flat_changes(nested), reasons)
    summary = report(reasons, parts)
    for name, table in {"nested": parts["nested"], "duplicates": parts["duplicates"], "unresolved": summarize.unresolved(failed), "summary": summary}.items():
        table.write.mode("overwrite").parquet(f"{options.output_dir}/{name}")
    sinks.write_summary(summary, options.output_dir)
    told = {"target_commits": wanted.count(), **summary.first().asDict()}
    sinks.write_text(f"{options.output_dir}/README.md", mining.render_readme("Recovery", told))
    return told


def audited(wanted: DataFrame, only: list[tuple[str, str]]) -> DataFrame:
    """The targets among the given (project, commit) pairs, by canonical slug and hash."""
    pairs = wanted.sparkSession.createDataFrame(only, "p string, c string")
    pairs = pairs.select(slug(F.col("p")).alias("slug"), commit_hash(F.col("c")).alias("h")).dropna().distinct()
    return wanted.join(pairs, ["slug", "h"], "left_semi")


def report(reasons: DataFrame, parts: dict[str, DataFrame]) -> DataFrame:
    """One row: how many pairs came out for each reason, how many were new, and the sizes of the new dataset."""
    told = reasons.agg(
        F.count_if(F.col("reason") == "").alias("raw_recovered"), F.count_if(F.col("reason") == "format_only_javadoc").alias("format_only"),
        F.count_if(F.col("reason") == "weak_inheritdoc_only").alias("weak_inheritdoc_only"), F.count_if(F.col("reason").startswith("invalid_code")).alias("invalid"),
    )
    new = parts["fresh"].agg(F.count("*").alias("new_changes"))
    return told.crossJoin(new).crossJoin(summarize.size_summary(parts["nested"].select(F.size("changes").alias("size"))))
