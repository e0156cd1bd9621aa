"""Deduplication by key: first in order, by priority with an audit of what went, and against frozen sets.

The survivor is found by one aggregate with map-side combining (``min_by`` over a total order), never by
sorting a whole key group in one task; rows that follow join back by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.messages import is_weak_issue_summary
from .running import running_sum


def keep_first(rows: DataFrame, keys: Sequence[str], order: Sequence[str], kept: Sequence[str]) -> DataFrame:
    """(keys, kept, copies): of each key the ``kept`` columns of the row first in ``order``, which must be total. Null keys are equal."""
    first = F.min(F.struct(*order, *[c for c in kept if c not in order]))
    grouped = rows.groupBy(*keys).agg(first.alias("_first"), F.count("*").alias("copies"))
    return grouped.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in kept if c not in keys], "copies")


def priority_rank(summary: Column, is_old: Column, source_order: Column, row: Column) -> Column:
    """Least for the row to keep: a summary that says something, then the old dataset, then source order, then the row."""
    return F.struct(
        is_weak_issue_summary(summary).alias("weak"), (~is_old).alias("new"), source_order.alias("source_order"), row.alias("row")
    )


def priority_dedup(rows: DataFrame, key: str, rank: Column, row: str) -> DataFrame:
    """(key, row, survivor, copies, is_kept) of every row: the least ``rank`` of its key survives."""
    ranked = rows.select(key, row, rank.alias("_rank"))
    best = ranked.groupBy(key).agg(F.min_by(row, "_rank").alias("survivor"), F.count("*").alias("copies"))
    return ranked.join(best, key).select(key, row, "survivor", "copies", (F.col(row) == F.col("survivor")).alias("is_kept"))


def removed_groups(audit: DataFrame, key: str, row: str) -> DataFrame:
    """(key, survivor, removed) of the keys that lost rows; ``removed`` is the number of rows that went."""
    return audit.where("not is_kept").groupBy(key, "survivor").agg(F.count("*").alias("removed"))


def not_in(rows: DataFrame, frozen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key does not stand in ``frozen``; null parts of a key are equal."""
    known = frozen.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return rows.join(known, same, "left_anti")


def against_frozen(rows: DataFrame, frozen: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Every row with ``outcome``: in_frozen, repeated (a row before it has the key) or new."""
    known = frozen.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct().withColumn("_known", F.lit(True))
    first = rows.groupBy(*keys).agg(F.min(order).alias("_first"))
    joined = rows.join(known, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left").drop(*[f"_{k}" for k in keys])
    again = first.select(*[F.col(k).alias(f"_{k}") for k in keys], "_first")
    joined = joined.join(again, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left")
    outcome = F.when(F.col("_known"), "in_frozen").when(F.col(order) > F.col("_first"), "repeated").otherwise("new")
    return joined.withColumn("outcome", outcome).drop("_known", "_first", *[f"_{k}" for k in keys])


def filter_with_limit(outcomes: DataFrame, source: str, order: str, most: int) -> DataFrame:
    """Of each source: the first ``most`` new rows, and how many frozen and repeated rows came before the last of them.

    A source with fewer new rows is read to its end.
    """
    counted = running_sum(outcomes, [source], [order], F.when(F.col("outcome") == "new", 1).otherwise(0), "_n")
    read = counted.where((F.col("_n") < most) | ((F.col("_n") == most) & (F.col("outcome") == "new")))
    return read.groupBy(source).agg(
        F.count_if(F.col("outcome") == "new").alias("kept"),
        F.count_if(F.col("outcome") == "in_frozen").alias("duplicate_against_baseline"),
        F.count_if(F.col("outcome") == "repeated").alias("duplicate_inside"),
    )
