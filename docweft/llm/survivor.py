"""One surviving record of each group of duplicates, by skyline selection.

Records compete in three dimensions: completeness, recency and trust. A record is undominated if none
is at least as good in all three and better in one. Completeness and trust take few values, so each
group is first reduced, before any shuffle, to one cell a (completeness, trust) that keeps its latest
record, and for each field its latest record that has it: the skyline lies in an array whose length is
bounded by the number of cells, however many rows the group has.

A record's layer is the length of the longest chain of records that dominate it. Where the skyline does not
settle a field and several cells could, layers are found by a scan over the group's times, latest first. The
state of the scan is one number a cell and each step is linear in the (max, +) algebra, so pieces of a group in
different partitions are scanned on their own and joined by one small matrix a partition.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.messages import is_weak_issue_summary
from ..functions.text import commit_hash, slug, strip
from ..storage import written
from .hashes import fulls

_EPOCH = "-9223372036854775807"


def usable_summary(summary: Column) -> Column:
    """Not null, not weak, and not cut off (ending in dots)."""
    return summary.isNotNull() & ~is_weak_issue_summary(summary) & ~strip(F.coalesce(summary, F.lit(""))).rlike(r"(?:\.\.\.|…)\z")


def _step(state: np.ndarray, cells: list[int], above: np.ndarray) -> list[np.ndarray]:
    """The new values of ``cells``, which have a record at the next earlier time; ``above[k]`` marks the cells at least as good as k.

    ``state`` has a number a cell, or a row a cell if it is a matrix; cells come best first.
    """
    new: dict[int, np.ndarray] = {}
    for k in cells:
        best = state[above[k]].max(axis=0)
        for better, value in new.items():
            if above[k, better]:
                best = np.maximum(best, value)
        new[k] = best + 1
    for k, value in new.items():
        state[k] = value
    return [new[k] for k in cells]


def _above(complete: np.ndarray, trust: np.ndarray) -> np.ndarray:
    return (complete[None, :] >= complete[:, None]) & (trust[None, :] <= trust[:, None])


def _moments(older: np.ndarray, k: np.ndarray) -> Iterator[tuple[int, list[int]]]:
    cuts = [0, *(np.flatnonzero(np.diff(older)) + 1).tolist(), len(older)]
    for i, j in zip(cuts[:-1], cuts[1:], strict=True):
        yield int(older[i]), k[i:j].tolist()


def record_layers(records: DataFrame, groups: DataFrame) -> DataFrame:
    """(g, k, layer) of chosen records by dominance layer over all records of their groups.

    ``records`` has (g, k, older): a group, the number of a cell and a time, the latest smallest. ``groups`` has g,
    ``complete`` and ``trust`` of its cells, best first, and ``chosen``: for each cell the time whose layer is asked, or null.
    """
    parts = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = records.join(groups, "g").select("g", "older", "k", "complete", "trust", "chosen").distinct()
    ordered = steps.repartitionByRange(parts, "g", "older").sortWithinPartitions("g", "older", "k").withColumn("pid", F.spark_partition_id())

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row a group and partition: its steps, and for the partition's last group, which may go on, their matrix."""
        held: dict | None = None

        def closed(last: bool) -> pa.RecordBatch:
            older, k = (np.concatenate(held[c]) for c in ("older", "k"))
            matrix = b""
            if last:
                above = _above(np.array(held["complete"]), np.array(held["trust"]))
                state = np.where(np.eye(len(above), dtype=bool), 0.0, -np.inf)
                for _, cells in _moments(older, k):
                    _step(state, cells, above)
                matrix = state.tobytes()
            row = {c: [held[c]] for c in ("g", "complete", "trust", "chosen", "pid")}
            types = [pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.int32()]
            arrays = [pa.array(v, t) for v, t in zip(row.values(), types, strict=True)]
            return pa.RecordBatch.from_arrays([*arrays, *[pa.array([x], pa.binary()) for x in (older.tobytes(), k.astype(np.int32).tobytes(), matrix)]], [*row, "older", "k", "matrix"])

        for batch in batches:
            names = np.array(batch.column("g").to_pylist(), object)
            cuts = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)] if len(names) else []
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                if held is not None and held["g"] != names[i]:
                    yield closed(False)
                    held = None
                if held is None:
                    held = {c: batch.column(c)[i].as_py() for c in ("g", "complete", "trust", "chosen", "pid")} | {"older": [], "k": []}
                held["older"].append(batch.column("older").to_numpy()[i:j])
                held["k"].append(batch.column("k").to_numpy()[i:j])
        if held is not None:
            yield closed(True)

    schema = "g string, complete array<int>, trust array<int>, chosen array<bigint>, pid int, older binary, k binary, matrix binary"
    blocks = written(ordered.mapInArrow(pack, schema), "layer-blocks")
    # Only a partition's last group has a matrix: at most one small row a partition reaches the driver.
    tails = {(r["pid"], r["g"]): r["matrix"] for r in blocks.where("octet_length(matrix) > 0").select("pid", "g", "matrix").collect()}
    carried: dict[tuple[int, str], np.ndarray] = {}
    for pid, g in sorted(tails):
        matrix = np.frombuffer(tails[pid, g], np.float64)
        matrix = matrix.reshape(int(len(matrix) ** 0.5), -1)
        before = carried.get((pid, g), np.zeros(len(matrix)))
        after = (matrix + before[None, :]).max(axis=1)
        follows = pid + 1
        while follows < parts and not any(p == follows for p, _ in tails):  # partitions without rows
            follows += 1
        carried[follows, g] = np.maximum(after, before)
    shared = records.sparkSession.sparkContext.broadcast(carried)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str, int, int]] = []
            for r in batch.to_pylist():
                above = _above(np.array(r["complete"]), np.array(r["trust"]))
                state = shared.value.get((r["pid"], r["g"]), np.zeros(len(above))).copy()
                wanted: dict[int, set[int]] = {}
                for k, older in enumerate(r["chosen"]):
                    if older is not None:
                        wanted.setdefault(older, set()).add(k)
                for older, cells in _moments(np.frombuffer(r["older"], np.int64), np.frombuffer(r["k"], np.int32)):
                    told = _step(state, cells, above)
                    out += [(r["g"], k, int(v) - 1) for k, v in zip(cells, told, strict=True) if k in wanted.get(older, ())]
            if out:
                g, k, layer = zip(*out, strict=True)
                yield pa.record_batch({"g": pa.array(g, pa.string()), "k": pa.array(k, pa.int32()), "layer": pa.array(layer, pa.int32())})

    return blocks.mapInArrow(scan, "g string, k int, layer int")


def skyline_survivors(records: DataFrame, group: Sequence[str], row_id: str, fields: Sequence[str]) -> DataFrame:
    """One row a group: ``row_id`` of the survivor, the number of copies, and ``fields`` filled field by field.

    ``records`` has ``complete`` (INT, larger is better), ``trust`` (INT, smaller is better, null last)
    and ``recency`` (BIGINT, larger is better, null last) beside the named columns. The survivor is the
    undominated record first by (complete, trust, recency, row_id); a field it lacks is taken from the other
    undominated records in the same order, then from the records of the next dominance layer, and so on.
    ``undominated`` is the number of (complete, trust) with an undominated record. Ties go to the smaller
    ``row_id``. Null group keys are dropped; an empty table gives an empty result.
    """
    worst = 2_147_483_647
    keys = [f"_k{i}" for i in range(len(group))]
    ready = records.dropna(subset=list(group)).select(
        *[F.col(c).alias(k) for c, k in zip(group, keys, strict=True)],
        F.coalesce("complete", F.lit(0)).alias("complete"),
        F.coalesce("trust", F.lit(worst)).alias("trust"),
        (-F.coalesce("recency", F.lit(_EPOCH).cast("bigint"))).alias("older"),
        F.col(row_id).alias("_id"),
        *[F.col(f).alias(f"f_{i}") for i, f in enumerate(fields)],
    )
    rank = F.struct("older", F.col("_id").alias("id"))
    kept = [F.min(F.when(F.col(f"f_{i}").isNotNull(), F.struct(rank.alias("r"), F.col(f"f_{i}").alias("v")))).alias(f"b_{i}") for i in range(len(fields))]
    cells = ready.groupBy(*keys, "complete", "trust").agg(F.count("*").alias("n"), F.min(rank).alias("top"), *kept)
    cell = F.struct((-F.col("complete")).alias("less"), "trust", F.col("top.older").alias("older"), F.col("top.id").alias("id"), "complete", *[f"b_{i}" for i in range(len(fields))])
    grouped = cells.groupBy(*keys).agg(F.sum("n").alias("copies"), F.array_sort(F.collect_list(cell)).alias("cells"))
    # Cells are sorted best first. The record on top of a cell is undominated if no cell that is at least as good has one as late.
    top = F.transform(
        "cells",
        lambda c, i: ~F.exists(
            F.slice("cells", F.lit(1), i),
            lambda d: (d["complete"] >= c["complete"]) & (d["trust"] <= c["trust"]) & (d["older"] <= c["older"]),
        ),
    )
    named = grouped.withColumn("top", top)
    out = [*[F.col(k).alias(c) for c, k in zip(group, keys, strict=True)], F.col("cells")[0]["id"].alias(row_id), "copies", F.size(F.filter("top", lambda x: x)).alias("undominated"), F.col("cells")[0]["complete"].alias("complete")]
    if not fields:
        return named.select(*out)
    named = named.withColumn("g", F.md5(F.to_json(F.struct(*keys))))

    def undominated(i: int) -> Column:
        """For each cell, whether its record for the i-th field is undominated; null if no record has it."""
        return F.zip_with("cells", "top", lambda c, t: F.when(c[f"b_{i}"].isNotNull(), t & (c[f"b_{i}"]["r"]["older"] == c["older"])))

    def times(i: int) -> Column:
        return F.transform("cells", lambda c: c[f"b_{i}"]["r"]["older"])

    open_ = [F.size(F.filter(undominated(i), lambda x: x.isNotNull())) > 1 for i in range(len(fields))]
    open_ = [o & ~F.exists(undominated(i), lambda x: F.coalesce(x, F.lit(False))) for i, o in enumerate(open_)]
    named = written(named.withColumns({f"o_{i}": o for i, o in enumerate(open_)}), "skyline")
    layers = None
    for i in range(len(fields)):
        asked = named.where(F.col(f"o_{i}")).select("g", *keys, F.col("cells.complete").alias("c"), F.col("cells.trust").alias("t"), times(i).alias("chosen"))
        places = F.transform(F.arrays_zip("c", "t"), lambda z: F.struct(z["c"].alias("complete"), z["t"].alias("trust")))
        steps = ready.join(asked, keys).select("g", (F.array_position(places, F.struct("complete", "trust")) - 1).cast("int").alias("k"), "older")
        found_here = record_layers(steps, asked.select("g", F.col("c").alias("complete"), F.col("t").alias("trust"), "chosen"))
        found_here = found_here.groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct("k", "layer"))).alias(f"l_{i}"))
        layers = found_here if layers is None else layers.join(found_here, "g", "full")
    told = named.join(layers, "g", "left")

    def filled(i: int) -> Column:
        choices = F.transform(
            F.arrays_zip("cells", undominated(i).alias("u")),
            lambda z, k: F.when(
                z["u"].isNotNull(),
                F.struct(
                    F.coalesce(F.col(f"l_{i}")[k], F.when(z["u"], 0).otherwise(1)).alias("layer"), z["cells"]["less"].alias("less"), z["cells"]["trust"].alias("trust"),
                    z["cells"][f"b_{i}"]["r"].alias("r"), z["cells"][f"b_{i}"]["v"].alias("v"),
                ),
            ),
        )
        return F.array_min(F.array_compact(choices))["v"]

    return told.select(*out, *[filled(i).alias(f) for i, f in enumerate(fields)])


def commit_records(nested: DataFrame, trust: DataFrame) -> DataFrame:
    """Rows of ``nested`` with canonical slug, full hash and the three dimensions; rows without slug or hash are dropped."""
    ready = nested.select(
        slug(F.col("project_slug")).alias("slug"), commit_hash(F.col("commit_hash")).alias("h"), "dataset", "row_seq", "repository_url",
        "issue_summary", "mined_at",
    ).where("slug is not null and h is not null")
    full = fulls(ready, "slug")
    ranks = trust.groupBy("dataset").agg(F.min("trust_rank").alias("trust"))
    return (
        ready.join(full, ["slug", "h"])
        .join(ranks, "dataset", "left")
        .withColumns(
            {
                "complete": usable_summary(F.col("issue_summary")).cast("int"),
                "recency": F.unix_micros(F.col("mined_at").cast("timestamp")),
                "summary": F.when(usable_summary(F.col("issue_summary")), F.col("issue_summary")),
            }
        )
    )


def best_commits(nested: DataFrame, trust: DataFrame) -> DataFrame:
    """One record of each commit recorded twice or more: its row, number of copies, best summary, URL and time."""
    survivors = skyline_survivors(commit_records(nested, trust), ["slug", "full"], "row_seq", ["summary", "repository_url", "mined_at"])
    return survivors.where("copies >= 2").select(
        F.col("slug").alias("project_slug"), F.col("full").alias("commit_hash"), "row_seq", "copies", "undominated", "complete",
        F.col("summary").alias("issue_summary"), "repository_url", "mined_at",
    )


def found(nested: DataFrame, trust: DataFrame) -> DataFrame:
    """(project_slug, commit_hash, row_seq) of the commits with two or more records and a usable summary."""
    survivors = skyline_survivors(commit_records(nested, trust), ["slug", "full"], "row_seq", [])
    return survivors.where("copies >= 2 and complete = 1").select(F.col("slug").alias("project_slug"), F.col("full").alias("commit_hash"), "row_seq")
