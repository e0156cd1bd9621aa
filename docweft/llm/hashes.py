"""Commit hashes that may be shortened: which spellings mean the same commit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHORTEST = 12  # digits that a shortened hash keeps


def _with_shorts(hashes: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Distinct (keys, h), and those of them that could be the beginning of another, under the same ``p12``."""
    spelled = hashes.select(*keys, "h").distinct().withColumn("p12", F.substring("h", 1, SHORTEST))
    longest = spelled.groupBy(*keys, "p12").agg(F.max(F.length("h")).alias("top"), F.count("*").alias("n"))
    # Only a bucket with two spellings or more can hold a shortened one; most buckets end here.
    mixed = longest.where("n > 1").drop("n")
    inside = spelled.join(mixed, [*keys, "p12"])
    shorts = inside.where((F.length("h") < F.col("top")) & (F.length("h") >= SHORTEST))
    return spelled, shorts.select(*keys, "p12", F.col("h").alias("s"))


def roots(hashes: DataFrame) -> DataFrame:
    """(h, root): ``root`` is the shortest spelling present that ``h`` begins with.

    Two hashes are linked by beginnings, at once or through a chain, exactly when their roots agree.
    Distinct spellings are compared only within one 12-digit beginning, so a hash that fills a third
    of all rows is one row here.
    """
    spelled, shorts = _with_shorts(hashes, [])
    found = (
        spelled.join(shorts, "p12")
        .where(F.col("h").startswith(F.col("s")))
        .groupBy("h")
        .agg(F.min("s").alias("root"))
    )
    return spelled.select("h").join(found, "h", "left").select("h", F.coalesce("root", "h").alias("root"))


def fulls(hashes: DataFrame, *keys: str) -> DataFrame:
    """(keys, h, full): the longest spelling that begins with ``h`` under the same keys.

    If two different long hashes begin with the same shortened one, the smaller is taken.
    """
    by = list(keys)
    spelled, shorts = _with_shorts(hashes, by)
    best = (
        shorts.join(spelled, [*by, "p12"])
        .where(F.col("h").startswith(F.col("s")))
        .groupBy(*by, "s")
        .agg(F.min(F.struct((-F.length("h")).alias("l"), "h")).alias("best"))
        .select(*by, F.col("s").alias("h"), F.col("best.h").alias("full"))
    )
    return spelled.select(*by, "h").join(best, [*by, "h"], "left").select(*by, "h", F.coalesce("full", "h").alias("full"))
