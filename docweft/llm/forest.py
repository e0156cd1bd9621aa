"""A persisted forest of prefix trees over set signatures, looked up by range search.

The index lies in one shared folder. Each run holds two sorted tables: *labels* (the tree's number and
``DEPTH`` minimum hashes, or ``EXACT`` and a 128-bit key; with the id and size of the set) and *sets* (id
and shingles). Each table is cut by range into files of sorted rows, and the manifest names the least and
the greatest entry of every file. A look-up sends each label to the files whose range can hold its prefix,
opens only these, reads only the row groups whose statistics can hold it and finds the prefix by two binary
searches. Nothing of the history is shuffled, and files that no prefix falls into are not opened.

Runs of one tier are merged into one of the next when they are ``TIER`` many, so each row is rewritten
about log(runs) times. A manifest is written under a new number after the files it names are complete, and
the greatest number counts: a lost job leaves the index as it was, and ``Forest`` opens what is there.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import kernels as K

TREES = 32
DEPTH = 5
WIDTH = 1 + 4 * DEPTH  # bytes of a label
EXACT = 255  # in place of a tree's number: the label is a key and only equal keys meet
TIER = 4
LABELS_A_FILE, LABELS_A_GROUP = 1 << 20, 1 << 13
SETS_A_FILE, SETS_A_GROUP = 1 << 14, 1 << 7
CHUNK_BYTES = 32 << 20  # of labels looked up, or of shingles compared, in one file at a time
SCHEMAS = {
    "labels": pa.schema([("label", pa.binary(WIDTH)), ("id", pa.int64()), ("n", pa.int32())]),
    "sets": pa.schema([("id", pa.int64()), ("grams", pa.list_(pa.int64()))]),
}
LABELS, SETS = "label binary, id bigint, n int", "id bigint, grams array<bigint>"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file:///") else path)


def _label_values(column: pa.Array) -> np.ndarray:
    """Labels as fixed strings of bytes, which compare byte by byte."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.ascontiguousarray(K.byte_matrix(column, WIDTH)).reshape(-1).view(f"S{WIDTH}")


def asked_labels(batch: pa.RecordBatch, trees: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(labels, ids, sizes) of rows (sign, id, n): a signature gives one label for each of the first ``trees``, a key itself."""
    wide = pc.binary_length(batch.column("sign")).to_numpy() > WIDTH
    sets, keys = (batch.filter(pa.array(x)) for x in (wide, ~wide))
    signs = K.byte_matrix(sets.column("sign"), TREES * DEPTH * 4)
    labels = [K.tree_labels(signs, trees, DEPTH).reshape(-1).view(f"S{WIDTH}"), _label_values(keys.column("sign"))]
    ids = [np.repeat(sets.column("id").to_numpy(), trees), keys.column("id").to_numpy()]
    sizes = [np.repeat(sets.column("n").to_numpy(), trees), keys.column("n").to_numpy()]
    return np.concatenate(labels), np.concatenate(ids), np.concatenate(sizes)


def labels_of(signs: DataFrame, trees: int = TREES) -> DataFrame:
    """(label, id, n) of all labels of rows (sign, id, n)."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                labels, ids, sizes = asked_labels(batch, trees)
                yield pa.record_batch({"label": K.fixed_binary(labels.view(np.uint8).reshape(-1, WIDTH)), "id": ids, "n": sizes})

    return signs.select("sign", "id", "n").mapInArrow(kernel, LABELS)


def prefix_range(labels: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest label with the same first ``depth`` values; a key is its own range."""
    low = labels.copy().view(np.uint8).reshape(-1, WIDTH)
    high = low.copy()
    tree = low[:, 0] != EXACT
    low[tree, 1 + 4 * depth :] = 0
    high[tree, 1 + 4 * depth :] = 255
    return low.reshape(-1).view(f"S{WIDTH}"), high.reshape(-1).view(f"S{WIDTH}")


@dataclass
class Part:
    """One file: its range and size. Bounds of labels are written in hexadecimal digits."""

    path: str
    low: str
    high: str
    rows: int
    bytes: int


@dataclass
class Run:
    tier: int
    labels: list[Part] = field(default_factory=list)
    sets: list[Part] = field(default_factory=list)


def write_sorted(df: DataFrame, kind: str, folder: str, rows: int) -> list[Part]:
    """``df`` cut by range into files of sorted rows; ``rows`` is an upper bound of its number of rows.

    Every attempt of a task writes a file of its own name and only finished attempts are named in the result, so a
    task that is lost or run twice leaves nothing in the index.
    """
    column, most, group = ("label", LABELS_A_FILE, LABELS_A_GROUP) if kind == "labels" else ("id", SETS_A_FILE, SETS_A_GROUP)
    schema = SCHEMAS[kind]
    parts = max(1, -(-rows // most))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, writer, path, low, high, n = None, None, "", None, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                base, inside = _open(folder)
                base.create_dir(inside, recursive=True)
                path = f"{kind}-{uuid.uuid4().hex}.parquet"
                writer = pq.ParquetWriter(f"{inside}/{path}", schema, filesystem=base, compression="zstd", use_dictionary=False)
                low = batch.column(column)[0].as_py()
            high = batch.column(column)[batch.num_rows - 1].as_py()
            n += batch.num_rows
            writer.write_table(pa.table([batch.column(c).cast(schema.field(c).type) for c in schema.names], schema=schema), row_group_size=group)
        if writer is not None:
            writer.close()
            size = base.get_file_info(f"{_open(folder)[1]}/{path}").size
            text = [x.hex() if isinstance(x, bytes) else str(x) for x in (low, high)]
            yield pa.record_batch({"path": [f"{folder}/{path}"], "low": text[:1], "high": text[1:], "rows": [n], "bytes": [size]})

    cut = df.repartitionByRange(parts, column) if parts > 1 else df.coalesce(1)
    found = cut.sortWithinPartitions(column).mapInArrow(kernel, "path string, low string, high string, rows bigint, bytes bigint").collect()
    order = sorted((Part(**r.asDict()) for r in found), key=lambda p: p.low if kind == "labels" else int(p.low))
    return order


def _chunks(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """Rows sorted by ``column`` in tables that hold one of its values only, cut at ``CHUNK_BYTES``."""
    held: list[pa.RecordBatch] = []
    size = 0

    def flush() -> pa.Table:
        nonlocal held, size
        out, held, size = pa.Table.from_batches(held).combine_chunks(), [], 0
        return out

    for batch in batches:
        values = batch.column(column).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            if begin == end:
                continue
            piece = batch.slice(begin, end - begin)
            if held and held[0].column(column)[0].as_py() != int(values[begin]):
                yield flush()
            held.append(piece)
            size += piece.nbytes
            if size >= CHUNK_BYTES:
                yield flush()
    if held:
        yield flush()


def _groups(file: pq.ParquetFile, low: np.ndarray, high: np.ndarray, value) -> list[int]:  # noqa: ANN001
    """The row groups that can hold an entry of one of the sorted ranges."""
    out = []
    for g in range(file.num_row_groups):
        stats = file.metadata.row_group(g).column(0).statistics
        if stats is None or not stats.has_min_max:
            out.append(g)
            continue
        least, most = value(stats.min), value(stats.max)
        at = int(np.searchsorted(high, least, "left"))
        if at < len(high) and low[at] <= most:
            out.append(g)
    return out


def _read(file: pq.ParquetFile, groups: list[int]) -> tuple[pa.Table, int]:
    size = sum(file.metadata.row_group(g).column(c).total_compressed_size for g in groups for c in range(file.metadata.num_columns))
    return file.read_row_groups(groups).combine_chunks(), size


def _spread(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which range, position) of all positions of the ranges."""
    many = np.maximum(ends - starts, 0)
    which = np.repeat(np.arange(len(many)), many)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many) + starts[which]


class Forest:
    """The index in ``folder``, opened if it is there and begun if not."""

    def __init__(self, spark: SparkSession, folder: str, settings: dict | None = None) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self.settings = {"trees": TREES, "depth": DEPTH, **(settings or {})}
        self.number, self.runs, self.batches = 0, [], {}
        self.bytes_read = 0  # of index files by the look-ups of this object
        self._load()

    def _load(self) -> None:
        fs, inside = _open(self.folder)
        if fs.get_file_info(inside).type == pafs.FileType.NotFound:
            return
        names = sorted(f.base_name for f in fs.get_file_info(pafs.FileSelector(inside)) if f.base_name.startswith("manifest-"))
        if not names:
            return
        with fs.open_input_stream(f"{inside}/{names[-1]}") as f:
            held = json.loads(f.read())
        if held["settings"] != self.settings:
            raise ValueError(f"the index was built with {held['settings']}, not {self.settings}")
        self.number = held["number"]
        self.batches = held["batches"]
        self.runs = [Run(r["tier"], [Part(**p) for p in r["labels"]], [Part(**p) for p in r["sets"]]) for r in held["runs"]]

    def _save(self) -> None:
        self.number += 1
        fs, inside = _open(self.folder)
        fs.create_dir(inside, recursive=True)
        text = json.dumps({"settings": self.settings, "number": self.number, "batches": self.batches, "runs": [asdict(r) for r in self.runs]})
        with fs.open_output_stream(f"{inside}/.new-manifest") as f:
            f.write(text.encode())
        fs.move(f"{inside}/.new-manifest", f"{inside}/manifest-{self.number:08d}.json")

    def _delete(self, runs: list[Run]) -> None:
        for part in (p for r in runs for p in [*r.labels, *r.sets]):
            fs, inside = _open(part.path)
            fs.delete_file(inside)

    def append(self, labels: DataFrame, sets: DataFrame, rows: tuple[int, int], batch: str, decisions: str) -> None:
        """Adds one run (``rows``: upper bounds of labels and sets), notes the batch as done, and merges full tiers."""
        self.runs.append(Run(0, write_sorted(labels, "labels", self.folder, rows[0]), write_sorted(sets, "sets", self.folder, rows[1])))
        self.batches[batch] = decisions
        gone = []
        while len(full := [r for r in self.runs if r.tier == self.runs[-1].tier]) >= TIER:
            merged = Run(full[0].tier + 1)
            for kind, schema in (("labels", LABELS), ("sets", SETS)):
                parts = [p for r in full for p in getattr(r, kind)]
                if parts:
                    table = self.spark.read.schema(schema).parquet(*[p.path for p in parts])
                    setattr(merged, kind, write_sorted(table, kind, self.folder, sum(p.rows for p in parts)))
            gone += full
            self.runs = [r for r in self.runs if r not in full] + [merged]
        self._save()
        self._delete(gone)

    def size(self) -> int:
        return sum(p.bytes for r in self.runs for p in [*r.labels, *r.sets])

    def candidates(self, signs: DataFrame, trees: int, depth: int, near: int, far: int, threshold: float, seen: Observation) -> DataFrame:
        """(a, b, file) of rows (sign, id, n): entries of the first ``trees`` within ``near`` to ``far`` places of where a label would stand, under its prefix of ``depth`` values.

        A key that is held gives (id, null, null). ``seen`` counts the labels with more entries beyond ``far`` and the
        bytes read.
        """
        parts = [(i, p) for i, r in enumerate(self.runs) for p in r.labels]
        sets = [(i, p) for i, r in enumerate(self.runs) for p in r.sets]
        shared = self.spark.sparkContext.broadcast(
            {
                "paths": [p.path for _, p in parts],
                "runs": [
                    (
                        [k for k, (j, _) in enumerate(parts) if j == i],
                        np.array([bytes.fromhex(p.low) for p in r.labels], f"S{WIDTH}"),
                        np.array([bytes.fromhex(p.high) for p in r.labels], f"S{WIDTH}"),
                    )
                    for i, r in enumerate(self.runs)
                    if r.labels
                ],
                "run_of": [i for i, _ in parts],
                "sets": {i: (min((k for k, (j, _) in enumerate(sets) if j == i), default=0), np.array([int(p.low) for p in r.sets], np.int64)) for i, r in enumerate(self.runs)},
            }
        )

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                asked = asked_labels(batch, trees)
                low, high = prefix_range(asked[0], depth)
                for numbers, least, most in shared.value["runs"]:
                    row, at = _spread(np.searchsorted(most, low, "left"), np.searchsorted(least, high, "right"))
                    if not len(row):
                        continue
                    where = np.array(numbers, np.int64)[at] * 256 + asked[0][row].view(np.uint8)[::WIDTH]
                    order = np.argsort(where, kind="stable")
                    where, row = where[order], row[order]
                    cuts = np.flatnonzero(np.diff(where, prepend=-1))
                    blocks = list(zip(cuts, [*cuts[1:], len(where)], strict=True))
                    packed = {c: pa.array([x[row[i:j]].tobytes() for i, j in blocks], pa.binary()) for c, x in zip(("labels", "ids", "sizes"), asked, strict=True)}
                    yield pa.record_batch({"file": pa.array(where[cuts] // 256), "tree": pa.array((where[cuts] % 256).astype(np.int32)), **packed})

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table in _chunks(batches, "file"):
                number = table.column("file")[0].as_py()
                mine, ids, n = (np.frombuffer(b"".join(table.column(c).to_pylist()), t) for c, t in (("labels", f"S{WIDTH}"), ("ids", np.int64), ("sizes", np.int32)))
                order = np.argsort(mine, kind="stable")
                mine, ids, n = mine[order], ids[order], n[order]
                low, high = prefix_range(mine, depth)
                fs, inside = _open(shared.value["paths"][number])
                with fs.open_input_file(inside) as source:
                    file = pq.ParquetFile(source)
                    groups = _groups(file, low, high, lambda x: np.bytes_(x))
                    if not groups:
                        continue
                    held, size = _read(file, groups)
                theirs = _label_values(held.column("label"))
                lo, hi, at = np.searchsorted(theirs, low, "left"), np.searchsorted(theirs, high, "right"), np.searchsorted(theirs, mine, "left")
                tree = mine.view(np.uint8).reshape(-1, WIDTH)[:, 0] != EXACT
                left, right = np.maximum(lo, at - near), np.minimum(hi, at + near)
                which, place = (np.concatenate(x) for x in zip(_spread(np.maximum(lo, at - far), left), _spread(right, np.minimum(hi, at + far)), strict=True))
                other = held.column("n").to_numpy()[place]
                keep = tree[which] & (np.minimum(n[which], other) >= threshold * np.maximum(n[which], other))
                which, b = which[keep], held.column("id").to_numpy()[place[keep]]
                run = shared.value["run_of"][number]
                offset, lows = shared.value["sets"][run]
                key = np.flatnonzero(~tree & (hi > lo))
                more = int((tree & ((lo < at - far) | (hi > at + far))).sum())
                yield pa.record_batch(
                    {
                        "a": pa.array(np.concatenate([ids[which], ids[key], [-1]]).astype(np.int64)),
                        "b": pa.concat_arrays([pa.array(b), pa.nulls(len(key) + 1, pa.int64())]),
                        "file": pa.concat_arrays([pa.array((offset + np.searchsorted(lows, b, "right") - 1).astype(np.int64)), pa.nulls(len(key) + 1, pa.int64())]),
                        "more": pa.array(np.concatenate([np.zeros(len(which) + len(key)), [more]]).astype(np.int64)),
                        "read": pa.array(np.concatenate([np.full(len(which) + len(key), -1), [size]]).astype(np.int64)),
                    }
                )

        # Labels travel in blocks of one file and tree, so a row group is read by one task; a large part is split at run time.
        sent = signs.select("sign", "id", "n").mapInArrow(send, "file bigint, tree int, labels binary, ids binary, sizes binary")
        placed = sent.hint("rebalance", "file", "tree").sortWithinPartitions("file")
        met = placed.mapInArrow(search, "a bigint, b bigint, file bigint, more bigint, read bigint")
        met = met.observe(seen, F.sum("more").alias("more"), F.sum(F.when(F.col("read") >= 0, F.col("read"))).alias("read"))
        return met.where("read < 0").select("a", "b", "file").distinct()

    def verify(self, pairs: DataFrame, own: DataFrame, threshold: float, seen: Observation) -> DataFrame:
        """(a) of the (a, b, file) with an entry whose set is like enough; ``own`` has the (id, grams) of ``a``."""
        paths = self.spark.sparkContext.broadcast([p.path for r in self.runs for p in r.sets])

        def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table in _chunks(batches, "file"):
                b = table.column("b").to_numpy()
                fs, inside = _open(paths.value[table.column("file")[0].as_py()])
                with fs.open_input_file(inside) as source:
                    file = pq.ParquetFile(source)
                    held, size = _read(file, _groups(file, b, b, int))
                ids = held.column("id").to_numpy()
                at = np.searchsorted(ids, b)
                found = (at < len(ids)) & (ids[np.minimum(at, len(ids) - 1)] == b)
                rows = pa.array(np.flatnonzero(found))
                mine, theirs = pc.take(table.column("grams"), rows), pc.take(held.column("grams"), pa.array(at[found]))
                good = np.flatnonzero(found)[K.set_likeness(mine.combine_chunks(), theirs.combine_chunks()) >= threshold]
                a = np.unique(table.column("a").to_numpy()[good])
                yield pa.record_batch({"a": pa.array(np.append(a, -1)), "read": pa.array(np.append(np.full(len(a), -1), size).astype(np.int64))})

        sets = own.select(F.col("id").alias("a"), "grams")
        carried = pairs.where("b is not null").join(sets, "a").hint("rebalance", "file").sortWithinPartitions("file", "b")
        told = carried.mapInArrow(kernel, "a bigint, read bigint").observe(seen, F.sum(F.when(F.col("read") >= 0, F.col("read"))).alias("read"))
        return told.where("read < 0").select("a")
