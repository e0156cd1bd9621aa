"""From files to documented entities, and from old entities to new ones."""

from __future__ import annotations

from collections.abc import Iterator
from typing import TYPE_CHECKING

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.java_entities import class_context_pair, parse_entities
from ..functions.javadoc import semantic_tokens
from ..functions.kernels import ratio, seq_ratio

if TYPE_CHECKING:
    import pandas as pd

ENTITY = (
    "entity_seq int, entity_type string, name string, signature string, javadoc string, start_line int, end_line int, "
    "return_type string, parameters array<string>, throws array<string>, code_start_line int, code_end_line int"
)
_FIELDS = [part.strip().split(" ")[0] for part in ENTITY.split(", ")]


def extract_entities(sources: DataFrame) -> DataFrame:
    """(file_id, side, entity columns) of ``sources`` (file_id, side, content); null contents have none."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("file_id", pa.int64()), ("side", pa.string())]
            + [(f, pa.list_(pa.string()) if f in ("parameters", "throws") else pa.int32() if f.endswith(("line", "seq")) else pa.string()) for f in _FIELDS]
        )
        for batch in batches:
            rows = []
            for file_id, side, content in zip(*(batch.column(c).to_pylist() for c in ("file_id", "side", "content")), strict=True):
                for n, e in enumerate(parse_entities(content), 1):
                    rows.append({"file_id": file_id, "side": side, "entity_seq": n, **vars(e)})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    ready = sources.where("content is not null").select(F.col("file_id").cast("bigint"), "side", "content")
    return ready.mapInArrow(kernel, f"file_id bigint, side string, {ENTITY}")


def both_sides(file_changes: DataFrame) -> DataFrame:
    """(file_id, side, content) of both versions of each file."""
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.col(f"{s}_content").alias("content")) for s in ("old", "new")])
    return file_changes.select("file_id", F.explode(sides).alias("s")).select("file_id", "s.side", "s.content")


def _greedy(group: pd.DataFrame) -> pd.DataFrame:
    """New entities in order take the most similar old one still free; ties by nearness, then by the later old."""
    import pandas as pd

    old = group[group.side == "old"].sort_values("entity_seq").to_dict("records")
    free = list(range(len(old)))
    out = []
    for new in group[group.side == "new"].sort_values("entity_seq").to_dict("records"):
        if not free:
            break
        best = max(free, key=lambda i: (ratio(list(old[i]["tokens"]), list(new["tokens"])), -abs(old[i]["line"] - new["line"]), i))
        free.remove(best)
        out.append((new["file_id"], old[best]["entity_id"], new["entity_id"]))
    return pd.DataFrame(out, columns=["file_id", "old_id", "new_id"])


def align(entities: DataFrame) -> DataFrame:
    """(file_id, old_id, new_id): each new entity with its old version of the same type, name and parameters.

    Conflicts can only arise inside a key of one file. Keys with one entity a side, nearly all, are matched
    by an aggregate; only the others go to the greedy kernel.
    """
    key = ["file_id", "entity_type", "name", "params"]
    params = F.when(F.col("entity_type") == "method", F.array_join(F.coalesce("parameters", F.array()), "\x1f")).otherwise("")
    keyed = entities.withColumns({"params": params, "name": F.coalesce("name", F.lit(""))})
    sizes = keyed.groupBy(*key).agg(
        F.count_if(F.col("side") == "old").alias("olds"), F.count_if(F.col("side") == "new").alias("news"),
        F.min(F.when(F.col("side") == "old", F.col("entity_id"))).alias("old_id"), F.min(F.when(F.col("side") == "new", F.col("entity_id"))).alias("new_id"),
    )
    simple = sizes.where("olds = 1 and news = 1").select("file_id", "old_id", "new_id")
    crowded = sizes.where("olds >= 1 and news >= 1 and olds + news > 2").select(*key)
    rest = keyed.join(crowded, key).select(
        *key, "side", "entity_id", "entity_seq", F.coalesce("code_start_line", F.lit(0)).alias("line"), semantic_tokens(F.col("javadoc")).alias("tokens")
    )
    residual = rest.groupBy(*key).applyInPandas(lambda pdf: _greedy(pdf), "file_id bigint, old_id bigint, new_id bigint")
    return simple.union(residual)


def doc_similarities(pairs: DataFrame) -> DataFrame:
    """``pairs`` (old_doc, new_doc, ...) with ``similarity``; equal word lists are 1.0 without a kernel's work."""
    tokens = pairs.withColumns({"_a": semantic_tokens(F.col("old_doc")), "_b": semantic_tokens(F.col("new_doc"))})
    same = F.col("_a") == F.col("_b")
    score = seq_ratio(F.when(~same, F.col("_a")), F.when(~same, F.col("_b")))
    return tokens.withColumn("similarity", F.when(same, F.lit(1.0)).otherwise(score)).drop("_a", "_b")


def bounded_class_contexts(pairs: DataFrame, whole: int = 300, most: int = 500) -> DataFrame:
    """``pairs`` (pair_id, entity_type, code_before, code_after) with classes of many lines reduced to what differs."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = [class_context_pair(a or "", b or "", whole, most) for a, b in zip(batch.column("code_before").to_pylist(), batch.column("code_after").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("pair_id"), batch.column("entity_type"), pa.array([a for a, _ in cut], pa.string()), pa.array([b for _, b in cut], pa.string())],
                names=["pair_id", "entity_type", "code_before", "code_after"],
            )

    columns = ["pair_id", "entity_type", "code_before", "code_after"]
    lines = F.greatest(F.size(F.split(F.coalesce("code_before", F.lit("")), "\n")), F.size(F.split(F.coalesce("code_after", F.lit("")), "\n")))
    large = (F.col("entity_type") == "class") & (lines > whole)
    rest = pairs.where(~F.coalesce(large, F.lit(False))).select(*columns)
    cut = pairs.where(large).select(*columns).mapInArrow(kernel, "pair_id bigint, entity_type string, code_before string, code_after string")
    return rest.union(cut)
