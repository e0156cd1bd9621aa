"""Counts, distributions and top lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bounds of the buckets and their names.
BUCKETS = [(1, 1, "1"), (2, 2, "2"), (3, 3, "3"), (4, 5, "4-5"), (6, 10, "6-10"), (11, 20, "11-20"), (21, 50, "21-50")]
LAST_BUCKET = ">50"


def group_sizes(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("size"))


def size_distribution(sizes: DataFrame) -> DataFrame:
    """(size, groups): how many groups have each size."""
    return sizes.groupBy("size").agg(F.count("*").alias("groups"))


def bucket(size: Column) -> Column:
    name = F.lit(LAST_BUCKET)
    for low, high, label in BUCKETS:
        name = F.when(size.between(low, high), label).otherwise(name)
    return name


def bucketed_distribution(sizes: DataFrame) -> DataFrame:
    """(bucket, bucket_order, groups) in the fixed order; empty buckets are left out."""
    order = F.lit(len(BUCKETS))
    for i, (low, high, _) in enumerate(BUCKETS):
        order = F.when(F.col("size").between(low, high), i).otherwise(order)
    return sizes.groupBy(bucket(F.col("size")).alias("bucket"), order.alias("bucket_order")).agg(F.count("*").alias("groups"))


def size_summary(sizes: DataFrame) -> DataFrame:
    """One row: groups, rows, average (4 digits), largest, and groups of more than one and more than three; zeros for nothing."""
    return sizes.agg(
        F.count("*").alias("commits"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("changes"),
        F.coalesce(F.round(F.avg("size"), 4), F.lit(0.0)).alias("average"),
        F.coalesce(F.max("size"), F.lit(0)).alias("largest"),
        F.count_if(F.col("size") > 1).alias("multi_change"),
        F.count_if(F.col("size") > 3).alias("more_than_three"),
    )


def top_groups(sizes: DataFrame, keys: list[str], most: int = 20) -> DataFrame:
    """The ``most`` largest groups, ties by key: kept by a bounded heap in each task, not by a sort."""
    return sizes.orderBy(F.desc("size"), *keys).limit(most)


def funnel(rows: DataFrame, flags: dict[str, Column], *by: str) -> DataFrame:
    """Counts of all rows and of each named condition."""
    return rows.groupBy(*by).agg(F.count("*").alias("scanned"), *[F.count_if(c).alias(n) for n, c in flags.items()])


def disposition_counts(rows: DataFrame, *by: str) -> DataFrame:
    """Retained, review and filtered rows; filtered is what is left of the candidates, never below zero."""
    retained, review = F.count_if(F.col("disposition") == "retain"), F.count_if(F.col("disposition") == "review")
    return rows.groupBy(*by).agg(
        F.count("*").alias("candidates"), retained.alias("retained"), review.alias("review"),
        F.greatest(F.lit(0), F.count("*") - retained - review).alias("filtered"),
        F.count_if(F.col("reason").startswith("truncated_code_context")).alias("truncated"),
        F.count_if(F.col("reason") == "weak_inheritdoc_only").alias("weak_inheritdoc"),
        F.count_if(F.col("fallback")).alias("fallbacks"),
    )


def unresolved(failures: DataFrame) -> DataFrame:
    """(project_slug, commit_hash, reasons): commits with a failure whose reason, before a colon, means unresolved."""
    # Fixed values.
    kinds = ["missing_local_repo_cache", "git_extract_failed"]
    left = failures.where(F.split("reason", ":")[0].isin(kinds)).select("project_slug", "commit_hash", "reason").distinct()
    return left.groupBy("project_slug", "commit_hash").agg(F.sort_array(F.collect_list("reason")).alias("reasons"))
