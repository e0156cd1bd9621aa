"""Datasets at rest: a folder a project with ``combined_samples.json`` (an array) and ``metadata.json``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.running import running_sum

SIX = ["commit_hash", "issue_summary", "code_before", "code_after", "javadoc_before", "javadoc_after"]
METADATA = "repository string, repository_url string, project_slug string, retained_samples bigint, total_commits_scanned bigint, complete_history boolean, stop_reason string"


def read_samples(spark: SparkSession, folder: str, dataset: str) -> DataFrame:
    """Flat changes with lineage: dataset, project_slug, source_sample_id, source_path, source_order.

    A project's samples are one ``combined_samples.json`` (an array, read whole, as positions cannot be told from lines)
    or the lines that ``sinks.write_samples`` writes to ``samples``, numbered by their ``sample_id``. A byte order mark
    is ignored; a file that is no array of objects gives no rows; missing fields are empty. ``source_order`` numbers
    rows by project, then position.
    """
    files = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "combined_samples.json").text(folder)
    named = files.select(F.col("_metadata.file_path").alias("source_path"), F.regexp_replace("value", "\\A\ufeff", "").alias("value"))
    fields = ", ".join(f"{c}: string" for c in SIX)
    parsed = named.select("source_path", F.from_json("value", f"array<struct<{fields}>>", {"mode": "PERMISSIVE"}).alias("rows"))
    rows = parsed.select("source_path", F.posexplode("rows").alias("pos", "r")).where("r is not null")
    arrays = rows.select("source_path", F.element_at(F.split("source_path", "/"), -2).alias("project_slug"), F.col("pos").cast("bigint"), *[F.col(f"r.{c}").alias(c) for c in SIX])
    schema = "sample_id string, " + ", ".join(f"{c} string" for c in SIX)
    parts = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "part-*.json").json(folder)
    lines = parts.select("*", F.col("_metadata.file_path").alias("source_path")).where("source_path rlike '/samples/[^/]+$' and sample_id is not null")
    number = F.regexp_extract("sample_id", r"(\d+)$", 1).cast("bigint") - 1
    written_lines = lines.select("source_path", F.element_at(F.split("source_path", "/"), -3).alias("project_slug"), number.alias("pos"), *SIX)
    flat = arrays.unionByName(written_lines).withColumns({"dataset": F.lit(dataset), **{c: F.coalesce(c, F.lit("")) for c in SIX}})
    sizes = flat.groupBy("project_slug").agg((F.max("pos") + 1).alias("n"))
    offsets = running_sum(sizes, [], ["project_slug"], F.col("n"), "upto").select("project_slug", (F.col("upto") - F.col("n")).alias("offset"))
    return flat.join(offsets, "project_slug").select(
        "dataset", "project_slug", F.format_string("sample_%04d", F.col("pos") + 1).alias("source_sample_id"), "source_path",
        (F.col("offset") + F.col("pos")).alias("source_order"), *SIX,
    )


def read_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """One row a project; a file that cannot be read gives its project with nulls."""
    files = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "metadata.json").text(folder)
    parsed = files.select(F.element_at(F.split("_metadata.file_path", "/"), -2).alias("folder_slug"), F.from_json(F.regexp_replace("value", "\\A\ufeff", ""), METADATA).alias("m"))
    return parsed.select("folder_slug", "m.*")


def read_nested(spark: SparkSession, path: str) -> DataFrame:
    """Grouped commits from JSON: an array in one file, or lines."""
    change = "struct<change_index: int, entity_type: string, code_before: string, code_after: string, javadoc_before: string, javadoc_after: string>"
    schema = f"project_slug string, repository_url string, commit_hash string, issue_summary string, changes array<{change}>"
    return spark.read.schema(schema).option("multiLine", True).json(path)
