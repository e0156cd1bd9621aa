"""Running sums and numbers over any order, without one task for a large group or for the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..storage import written


def running_sum(rows: DataFrame, by: Sequence[str], order: Sequence[str], value: Column, name: str) -> DataFrame:
    """``rows`` with ``name``: the sum of ``value`` over the rows of the same ``by`` up to this one in ``order``, which must be total.

    Rows are range-partitioned by (by, order), so a group that holds a third of all rows lies in many
    partitions. Each partition sums its own part of a group; what came before is one small row a partition
    and group.
    """
    sorted_rows = rows.withColumn("_v", value).repartitionByRange(*by, *order)
    placed = written(sorted_rows.withColumn("_part", F.spark_partition_id()), "running")
    sums = placed.groupBy(*by, "_part").agg(F.sum("_v").alias("_s"))
    before = F.sum("_s").over(Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sums.select(*[F.col(b).alias(f"_by{i}") for i, b in enumerate(by)], F.col("_part").alias("_p"), F.coalesce(before, F.lit(0)).alias("_before"))
    same = [F.col(b).eqNullSafe(F.col(f"_by{i}")) for i, b in enumerate(by)] + [F.col("_part") == F.col("_p")]
    here = Window.partitionBy("_part", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = placed.join(offsets, same).withColumn(name, F.col("_before") + F.sum("_v").over(here))
    return joined.drop("_v", "_part", "_p", "_before", *[f"_by{i}" for i in range(len(by))])


def numbered(rows: DataFrame, by: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``rows`` numbered from 1 within ``by`` (none: over the whole table) in ``order``."""
    return running_sum(rows, by, order, F.lit(1), name)
