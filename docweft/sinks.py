"""Where results go: samples with review and discard parts, summaries, metadata, resumable progress."""

from __future__ import annotations

import json
import os
from collections.abc import Iterable

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import running
from .storage import exists

SIX = ["commit_hash", "issue_summary", "code_before", "code_after", "javadoc_before", "javadoc_after"]
SUMMARY = ["sample_id", "repo", "commit_hash", "file_path", "entity_type", "entity_name", "entity_signature", "javadoc_change_type", "method_change_type", "issue_id", "issue_summary"]


def numbered(samples: DataFrame, order: list[str], most: int | None = None) -> DataFrame:
    """Retained samples with ``sample_id`` from ``sample_0001`` on, the first ``most`` in order."""
    kept = running.numbered(samples.where("disposition = 'retain'"), [], order, "_n")
    kept = kept if most is None else kept.where(F.col("_n") <= most)
    return kept.withColumn("sample_id", F.format_string("sample_%04d", "_n")).drop("_n")


def write_samples(samples: DataFrame, folder: str, order: list[str], most: int | None = None) -> DataFrame:
    """Writes samples, their summary and what needs review; gives the retained rows.

    Each part is written by Spark's commit protocol: readers see a whole folder or none.
    """
    kept = numbered(samples, order, most)
    present = [c for c in SUMMARY if c in kept.columns]
    kept.select("sample_id", *SIX).write.mode("overwrite").option("ignoreNullFields", False).json(f"{folder}/samples")
    kept.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in present]).write.mode("overwrite").option("header", True).csv(f"{folder}/summary")
    samples.where("disposition = 'review'").select(F.col("reason").alias("review_reason"), *SIX).write.mode("overwrite").json(f"{folder}/review")
    return kept


def write_by_project(samples: DataFrame, folder: str) -> None:
    """One partition a project; only the projects among ``samples`` are replaced."""
    samples.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("project_slug").json(folder)


def write_summary(summary: DataFrame, folder: str) -> None:
    """A one-row summary as JSON and as (metric, value) lines; nested values are JSON."""
    summary.write.mode("overwrite").json(f"{folder}/summary_json")
    cells = [F.struct(F.lit(c).alias("metric"), (F.to_json(c) if t.startswith(("array", "map", "struct")) else F.col(c).cast("string")).alias("value")) for c, t in summary.dtypes]
    summary.select(F.explode(F.array(*cells)).alias("x")).select("x.*").write.mode("overwrite").option("header", True).csv(f"{folder}/summary_csv")


def write_projects(spark: SparkSession, rows: Iterable[dict], columns: list[str], folder: str) -> None:
    """One line a project with the named columns as CSV; what a project lacks is empty. One row a source, from the driver."""
    cells = [tuple("" if r.get(c) is None else str(r[c]) for c in columns) for r in rows]
    table = spark.createDataFrame(cells, ", ".join(f"`{c}` string" for c in columns))
    table.coalesce(1).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(f"{folder}/project_summary")


def _at(path: str) -> tuple[fs.FileSystem, str]:
    """The file system a path names, and the path on it; without a scheme it is a local one."""
    return fs.FileSystem.from_uri(path if "://" in path else os.path.abspath(path))


def write_json(path: str, value: object) -> None:
    """A small JSON file of the driver, replaced at once."""
    write_text(path, json.dumps(value, ensure_ascii=False, indent=2))


def write_text(path: str, text: str) -> None:
    there, inside = _at(path)
    there.create_dir(inside.rpartition("/")[0], recursive=True)
    with there.open_output_stream(f"{inside}.tmp") as out:
        out.write(text.encode("utf-8"))
    there.move(f"{inside}.tmp", inside)


def read_json(path: str, default: object) -> object:
    there, inside = _at(path)
    try:
        with there.open_input_stream(inside, compression=None) as source:
            return json.loads(source.read().decode("utf-8-sig"))
    except (OSError, ValueError):
        return default


def _clear(there: fs.FileSystem, folder: str) -> None:
    if there.get_file_info(folder).type == fs.FileType.Directory:
        there.delete_dir(folder)


def promote(staged: str, final: str) -> None:
    """A staged folder takes the place of the final one, on the file system that both name."""
    there, source = _at(staged)
    target = _at(final)[1]
    _clear(there, target)
    there.create_dir(target.rpartition("/")[0], recursive=True)
    there.move(source, target)


def copy_dataset(source: str, target: str, without: Iterable[str] = ("review",)) -> None:
    """A copy of a dataset's folder that leaves some of its parts out, such as what waits for review."""
    there, begin = _at(source)
    other, end = _at(target)
    _clear(other, end)
    for info in there.get_file_info(fs.FileSelector(begin, recursive=True)):
        inside = info.path[len(begin) :].lstrip("/")
        if info.type == fs.FileType.File and inside.split("/")[0] not in without:
            other.create_dir(f"{end}/{inside}".rpartition("/")[0], recursive=True)
            fs.copy_files(info.path, f"{end}/{inside}", source_filesystem=there, destination_filesystem=other)


def backup(files: Iterable[str], folder: str) -> list[str]:
    """Copies of the named files in ``folder``; a copy that is there already stays. Gives what was copied."""
    done = []
    for path in files:
        there, source = _at(path)
        other, target = _at(f"{folder}/{path.rstrip('/').rpartition('/')[2]}")
        if there.get_file_info(source).type == fs.FileType.File and other.get_file_info(target).type == fs.FileType.NotFound:
            other.create_dir(target.rpartition("/")[0], recursive=True)
            fs.copy_files(source, target, source_filesystem=there, destination_filesystem=other)
            done.append(path)
    return done


def folders(folder: str) -> list[str]:
    """The folders in a folder, by name; none if it is not there."""
    there, inside = _at(folder)
    if there.get_file_info(inside).type != fs.FileType.Directory:
        return []
    scheme = folder.partition("://")[0] + "://" if "://" in folder else ""
    return sorted(scheme + f.path for f in there.get_file_info(fs.FileSelector(inside)) if f.type == fs.FileType.Directory)


def latest(folder: str, prefix: str) -> str | None:
    """The last folder, by name, that begins with ``prefix``; None if there is none."""
    return max((f for f in folders(folder) if f.rpartition("/")[2].startswith(prefix)), default=None)


def require_rows(rows: DataFrame, expected: int | None, name: str) -> int:
    """The number of rows; an error if there are none, or not as many as expected."""
    n = rows.count()
    if not n or expected is not None and n != expected:
        raise ValueError(f"{name}: {n} rows, expected {expected if expected is not None else 'some'}")
    return n


class Progress:
    """Targets done, as appended Parquet: a job that starts again skips them by an anti join."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def done(self) -> DataFrame:
        if not exists(self.spark, self.folder):
            return self.spark.createDataFrame([], "project_slug string, commit_hash string")
        return self.spark.read.schema("project_slug string, commit_hash string").parquet(self.folder)

    def rest(self, targets: DataFrame) -> DataFrame:
        return targets.join(self.done(), ["project_slug", "commit_hash"], "left_anti")

    def add(self, targets: DataFrame) -> None:
        targets.select("project_slug", "commit_hash").write.mode("append").parquet(self.folder)
