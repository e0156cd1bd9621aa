"""Orders, sequence numbers and limits over ordered sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..storage import written
from .running import numbered, running_sum


def sequence_ids(rows: DataFrame, source: str, order: str, prefix: str = "sample_") -> DataFrame:
    """Rows with ``seq_id``: prefix and a number of four digits or more, from 1 in each source."""
    return numbered(rows, [source], [order], "_n").withColumn("seq_id", F.format_string(prefix + "%04d", "_n")).drop("_n")


def limit_per_source(rows: DataFrame, source: str, order: str, most: int) -> DataFrame:
    """The first ``most`` rows of each source; the rank filter is pushed into the window, so few rows are shuffled."""
    number = F.row_number().over(Window.partitionBy(source).orderBy(order))
    return rows.withColumn("_n", number).where(F.col("_n") <= most).drop("_n")


def cumulative_target(counts: DataFrame, priority: str, count: str, target: int) -> DataFrame:
    """Sources in order of priority while the total so far is below ``target``, with what is taken of each.

    One row a source: the running sum is over that small table.
    """
    before = F.coalesce(F.sum(count).over(Window.orderBy(priority).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (
        counts.withColumn("before", before)
        .where(F.col("before") < target)
        .withColumn("taken", F.least(F.col(count), F.lit(target) - F.col("before")))
    )


def start_from(sources: DataFrame, name: str, most: int | None = None) -> DataFrame:
    """Sources from the named one on, in order of priority; an unknown name is an error, an empty one starts at the first."""
    if name:
        first = sources.where((F.col("name") == name) | (F.col("slug") == name)).agg(F.min("priority").alias("p")).first()["p"]
        if first is None:
            raise ValueError(f"unknown source: {name}")
        sources = sources.where(F.col("priority") >= first)
    return sources.orderBy("priority").limit(most) if most is not None else sources


def early_stop(flags: DataFrame, order: str, most: int, step: int = 10) -> DataFrame:
    """The commits read before scanning stops, with running numbers of unique and retained rows.

    ``flags`` has one row a commit: ``uniques`` new rows and ``retained`` of them that pass. Once the running
    unique number reaches a threshold (first ``most``), retained rows are counted; at ``most`` the scan stops,
    else the threshold becomes that number plus ``step``. The jumps are few, and each is an aggregate. ``order`` is total.
    """
    uniques = running_sum(flags, [], [order], F.col("uniques"), "unique_total")
    running = written(running_sum(uniques, [], [order], F.col("retained"), "retained_total"), "early_stop")
    threshold = most
    while True:
        stop = running.where(F.col("unique_total") >= threshold).agg(F.min(F.struct(order, "unique_total", "retained_total")).alias("s")).first()["s"]
        if stop is None:
            return running
        if stop["retained_total"] >= most:
            return running.where(F.col(order) <= stop[order])
        threshold = stop["unique_total"] + step


def interleaved(old: DataFrame, new: DataFrame, key: str, source_order: str) -> DataFrame:
    """The union of two datasets ordered by ``source_order``, ties by first appearance of the key: (rows, position).

    Both datasets number their rows from 0, so their rows interleave. ``position`` is that order as a number.
    """
    both = old.withColumn("dataset_rank", F.lit(0)).unionByName(new.withColumn("dataset_rank", F.lit(1)), allowMissingColumns=True)
    first = both.groupBy(key).agg(F.min(F.struct("dataset_rank", source_order)).alias("_seen"))
    joined = both.join(first, key)
    return joined.withColumn("position", F.struct(source_order, "_seen", "dataset_rank")).drop("_seen")
