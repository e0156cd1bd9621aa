"""Streams of samples: the first of each content passes, the others are dropped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import fingerprint

TEXTS = ["code_before", "code_after", "javadoc_before", "javadoc_after"]


def first_contents(stream: DataFrame, time: str, late: str = "7 days") -> DataFrame:
    """The stream without contents seen within ``late``: state is one fingerprint a content and is given up after that.

    First means first processed; within a batch any of equal rows may pass, as their contents agree.
    """
    keyed = stream.withColumn("fp", fingerprint(*[F.col(c) for c in TEXTS]))
    return keyed.withWatermark(time, late).dropDuplicatesWithinWatermark(["fp"])


def counts_by_window(stream: DataFrame, time: str, key: str, width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """(window start, key, rows) of tumbling windows; rows later than ``late`` are dropped."""
    grouped = stream.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count("*").alias("rows"))
    return grouped.select(F.col("window.start").alias("window_start"), key, "rows")


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Processes what is there and stops; started again it goes on where it ended."""
    query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
