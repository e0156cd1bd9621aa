"""Nearest-URL page differencing: a page without the lines it shares with the page nearest to it.

A page is named by host and URL path. Pages of a host are put in order of their paths; the nearest page is that of the
two neighbours in this order with the longer common beginning of the path, which no other page of the host exceeds.
The lines of both are aligned by a longest common subsequence, and lines of the page that are in it are deleted.

The order is made by a range partitioning of the names alone; neighbours across partitions come from one small row a
partition, so a host may hold any share of all pages. Texts are joined by id, once as page and once as neighbour.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import written
from .markup import FIELDS, body


def common_lines(a: list[str], b: list[str]) -> list[int]:
    """The places in ``a`` of a longest common subsequence of lines that are not blank.

    Equal beginnings and ends are matched at once; between them matches are taken as an increasing sequence (the
    least last place in ``b`` for each length), so the work follows the number of equal pairs, not that of all pairs.
    """
    one, two = ([i for i, line in enumerate(x) if line.strip()] for x in (a, b))
    head = 0
    while head < min(len(one), len(two)) and a[one[head]] == b[two[head]]:
        head += 1
    tail = 0
    while tail < min(len(one), len(two)) - head and a[one[-1 - tail]] == b[two[-1 - tail]]:
        tail += 1
    places: dict[str, list[int]] = {}
    for j in range(len(two) - tail - 1, head - 1, -1):
        places.setdefault(b[two[j]], []).append(j)  # latest first, so that one line takes one place
    ends: list[int] = []
    chains: list[tuple[int, tuple | None]] = []
    for i in range(head, len(one) - tail):
        for j in places.get(a[one[i]], ()):
            k = bisect_left(ends, j)
            link = (i, chains[k - 1] if k else None)
            ends[k : k + 1], chains[k : k + 1] = [j], [link]
    middle = []
    chain = chains[-1] if chains else None
    while chain is not None:
        middle.append(chain[0])
        chain = chain[1]
    kept = [*range(head), *reversed(middle), *range(len(one) - tail, len(one))]
    return [one[i] for i in kept]


def _common_length(a: Column, b: Column) -> Column:
    """The number of segments that two paths begin with alike; -1 if one is null."""
    same = F.arrays_zip(F.split(a, "/").alias("x"), F.split(b, "/").alias("y"))
    first = F.array_position(F.transform(same, lambda z: F.coalesce(z["x"] == z["y"], F.lit(False))), False)
    return F.when(a.isNull() | b.isNull(), -1).otherwise(F.when(first == 0, F.size(same)).otherwise(first - 1))


def nearest_pages(pages: DataFrame) -> DataFrame:
    """(id, other) of (id, host, path): for each page the one nearest by path in its host, null if it is alone; ties to the earlier."""
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct("host", "path", "id")
    placed = pages.select("id", "host", "path").repartitionByRange(parts, "host", "path", "id").withColumn("pid", F.spark_partition_id())
    placed = written(placed, "pages")
    edges = placed.groupBy("pid").agg(F.min(key).alias("first"), F.max(key).alias("last"))
    # One row a partition: its neighbours' edges.
    order = Window.orderBy("pid")
    edges = F.broadcast(edges.select("pid", F.lag("last").over(order).alias("before"), F.lead("first").over(order).alias("after")))
    inside = Window.partitionBy("pid").orderBy("host", "path", "id")
    told = placed.join(edges, "pid").select("id", "host", "path", F.coalesce(F.lag(key).over(inside), "before").alias("p"), F.coalesce(F.lead(key).over(inside), "after").alias("q"))
    for side in "pq":
        told = told.withColumn(side, F.when(F.col(f"{side}.host").eqNullSafe(F.col("host")), F.col(side)))
    near = [F.when(F.col(s).isNull(), -1).otherwise(_common_length(F.coalesce("path", F.lit("")), F.coalesce(f"{s}.path", F.lit("")))) for s in "pq"]
    return told.select("id", F.when(near[0] >= near[1], F.col("p.id")).otherwise(F.col("q.id")).alias("other"))


def differenced(pages: DataFrame) -> DataFrame:
    """(id, other, lines, shared, text) of (id, host, path, text): each page without the lines it shares with the nearest.

    ``lines`` counts the lines that are not blank, ``shared`` those deleted. A page alone on its host keeps its text.
    Null texts count as empty; pages without host are one host; ``id`` must be unique.
    """
    near = nearest_pages(pages)
    texts = pages.select("id", F.coalesce("text", F.lit("")).alias("text"))
    both = texts.join(near, "id").join(texts.select(F.col("id").alias("other"), F.col("text").alias("beside")), "other", "left")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, str]] = []
            for text, beside in zip(batch.column("text").to_pylist(), batch.column("beside").to_pylist(), strict=True):
                lines = text.split("\n")
                gone = set(common_lines(lines, beside.split("\n"))) if beside else set()
                out.append((sum(bool(x.strip()) for x in lines), len(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone)))
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            values = [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.string()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("other"), *values], ["id", "other", "lines", "shared", "text"])

    return both.select("id", "other", "text", "beside").mapInArrow(kernel, "id bigint, other bigint, lines int, shared int, text string")


def comment_pages(samples: DataFrame) -> DataFrame:
    """(id, host, path, text, sample_id, field): each comment as the page of its file's URL; ``id`` is made from both."""
    url = F.coalesce("commit_url", F.lit(""))
    repository = F.regexp_replace(F.regexp_replace(url, r"\A[a-z]+://[^/]*", ""), r"/commit/.*\z", "")
    place = {"host": F.regexp_extract(url, r"\A[a-z]+://([^/]*)", 1), "path": F.concat_ws("/", repository, "file_path")}
    fields = F.array(*[F.struct(F.lit(i).alias("number"), F.lit(f).alias("field"), F.col(f).alias("doc")) for i, f in enumerate(FIELDS)])
    each = samples.where("sample_id is not null").select("sample_id", F.explode(fields).alias("x"), *[c.alias(n) for n, c in place.items()]).where("x.doc is not null")
    number = F.col("sample_id").cast("bigint") * len(FIELDS) + F.col("x.number")
    return each.select(number.alias("id"), "host", "path", body(F.col("x.doc")).alias("text"), "sample_id", "x.field").dropDuplicates(["id"])


def differenced_comments(samples: DataFrame) -> DataFrame:
    """(sample_id, field, lines, shared, text) of every comment that is not null, differenced with the nearest of its kind.

    A comment is compared with comments of the same field only. A repeated ``sample_id`` is one page.
    """
    pages = comment_pages(samples).withColumn("host", F.concat_ws(" ", "field", "host"))
    out = differenced(pages)
    return out.select(F.floor(F.col("id") / len(FIELDS)).alias("sample_id"), F.array(*[F.lit(f) for f in FIELDS])[F.pmod("id", F.lit(len(FIELDS))).cast("int")].alias("field"), "lines", "shared", "text")
