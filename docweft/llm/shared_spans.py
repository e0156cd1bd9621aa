"""Long spans that stand, character by character, in more than one document.

A window is ``SPAN`` code points. Its anchor is the least hash among the runs of ``GRAM`` code points in it, so
equal windows have equal anchors, and a document has about one run of windows with one anchor (a *stretch*) a
hundred characters. First pass: each task counts the anchors of its documents in a count-min sketch of its own, the
sketches are merged block by block, and the merged sketch never counts too low. Second pass: only stretches whose
anchor is estimated to stand in two documents or more are kept and grouped exactly. Stretches that are equal as
a whole are settled by one combined count; only where one anchor has stretches of different texts are windows
compared, for one document of each such text. A window in two documents has an anchor in two documents, so none is
lost, and copies cost one row a stretch, not one a character.

The sketch grows with the measured number of anchors. While it is below ``SKETCH_BYTES`` it is broadcast and filters
in the scan; beyond that, stretches are written once by hash of their anchor, and each part is filtered by its own
piece of the sketch. Equality is that of two independent 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import Scratch
from . import kernels as K

SPAN = 300
GRAM = 100
DEPTH = 3
BLOCK_BITS = 16  # counters in one row of a block of the sketch; a block has DEPTH rows
LOAD = 4  # counters for each expected anchor in each row
SKETCH_BYTES = 64 << 20  # of packed sketch broadcast at once
PENDING = 1 << 21  # anchors a task counts before it passes its sketch on
_A, _B = 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7
_SALT = np.uint64(0x2545F4914F6CDD1D)
STRETCH = "doc_id bigint, anchor bigint, place bigint, m bigint, f1 bigint, f2 bigint"
TEXT_KEY = ["anchor", "f1", "f2", "m"]


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, values.dtype)
    pad = -len(values) % width
    blocks = np.concatenate([values, np.full(pad, np.iinfo(values.dtype).max, values.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def _sums(points: np.ndarray, base: int) -> np.ndarray:
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * K.powers(base, len(points))[: len(points)], out=sums[1:])
    return sums


def _hashes(sums: np.ndarray, base: int, begin: np.ndarray | slice, end: np.ndarray | slice, length: np.ndarray | int) -> np.ndarray:
    """The hash of each range of code points, wherever it stands; ranges are given by indexes or slices of the sums."""
    back = K.powers(K.inverse(base), len(sums))
    return K.mix((sums[end] - sums[begin]) * back[: len(sums)][begin] + np.asarray(length, np.uint64) * _SALT)


def _stretches(batch: pa.RecordBatch, span: int, gram: int, hashed: bool) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, place in the row, number of windows, anchor, two hashes) of all stretches, slice by slice; hashes if wanted."""
    column = batch.column("text")
    points = np.frombuffer("".join(column.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.concatenate(([0], np.cumsum(pc.utf8_length(column).to_numpy()))).astype(np.int64)
    for start in range(0, len(points) - span + 1, K.SLICE):
        piece = points[start : start + K.SLICE + span - 1]
        n = len(piece) - span + 1
        sums = _sums(piece, _A)
        anchors = _sliding_min(_hashes(sums, _A, slice(0, len(piece) - gram + 1), slice(gram, None), gram), span - gram + 1)
        rows = np.searchsorted(at, np.arange(start, start + n), "right") - 1
        whole = np.arange(start, start + n) + span <= at[rows + 1]
        where = np.flatnonzero(whole)
        if not len(where):
            continue
        new = np.ones(len(where), bool)
        new[1:] = (np.diff(where) > 1) | (np.diff(rows[where]) > 0) | (anchors[where[1:]] != anchors[where[:-1]])
        begin = where[new]
        m = np.diff(np.append(np.flatnonzero(new), len(where)))
        row = rows[begin]
        out = (row, begin + start - at[row], m, anchors[begin])
        if hashed:
            end = begin + m + span - 1
            out += (_hashes(sums, _A, begin, end, end - begin), _hashes(_sums(piece, _B), _B, begin, end, end - begin))
        yield out


def _slots(anchors: np.ndarray, blocks: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The block of each anchor and its counter in each row of the block."""
    h = K.mix(anchors + _SALT)
    mask = np.uint64((1 << BLOCK_BITS) - 1)
    return (K.mix(anchors ^ _SALT) % np.uint64(blocks)).astype(np.int64), [((h >> np.uint64(BLOCK_BITS * j)) & mask).astype(np.int64) for j in range(DEPTH)]


def _long_texts(documents: DataFrame, span: int) -> DataFrame:
    return documents.where(F.col("doc_id").isNotNull() & (F.length("text") >= span)).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")


def sketch_blocks(texts: DataFrame, span: int = SPAN, gram: int = GRAM) -> int:
    """How many blocks the sketch of these texts needs, by their measured length."""
    chars = texts.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    return max(1, -(-chars * 2 * LOAD // ((span - gram + 1) << BLOCK_BITS)))


def anchor_sketch(texts: DataFrame, blocks: int, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(block, flags): for each counter of the merged sketch, whether it counts two documents or more, as packed bits."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def passed_on() -> pa.RecordBatch:
            block, slots = _slots(np.concatenate(held), blocks)
            held.clear()
            each = np.concatenate([(block * DEPTH + j << BLOCK_BITS) + x for j, x in enumerate(slots)])
            slot, n = np.unique(each, return_counts=True)
            slot = np.concatenate([slot, slot[n > 1]])  # two are as good as many
            slot.sort()
            cuts = np.flatnonzero(np.diff(slot // (DEPTH << BLOCK_BITS), prepend=-1))
            inside = (slot % (DEPTH << BLOCK_BITS)).astype(np.int32)
            parts = [inside[i:j].tobytes() for i, j in zip(cuts, [*cuts[1:], len(slot)], strict=True)]
            return pa.record_batch({"block": pa.array(slot[cuts] // (DEPTH << BLOCK_BITS)), "slots": pa.array(parts, pa.binary())})

        size = 0
        for batch in batches:
            for part in K.small_batches(iter([batch]), "text"):
                for rows, _, _, anchors in _stretches(part, span, gram, False):
                    held.append(K.row_sets(anchors, rows)[0])
                    size += len(held[-1])
            if size >= PENDING:
                yield passed_on()
                size = 0
        if held:
            yield passed_on()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts = None, np.zeros(DEPTH << BLOCK_BITS, np.int64)

        def packed() -> pa.RecordBatch:
            return pa.record_batch({"block": pa.array([now]), "flags": pa.array([np.packbits(counts > 1).tobytes()], pa.binary())})

        for batch in batches:
            for block, slots in zip(batch.column("block").to_pylist(), batch.column("slots").to_pylist(), strict=True):
                if now is not None and block != now:
                    yield packed()
                    counts[:] = 0
                now = block
                counts += np.bincount(np.frombuffer(slots, np.int32), minlength=len(counts))
        if now is not None:
            yield packed()

    counted = texts.mapInArrow(count, "block bigint, slots binary")
    return counted.repartition("block").sortWithinPartitions("block").mapInArrow(merge, "block bigint, flags binary")


def _repeated(anchors: np.ndarray, blocks: int, first: int, flags: np.ndarray) -> np.ndarray:
    """Whether each anchor is estimated to stand in two documents; ``flags`` holds the blocks from ``first`` on."""
    block, slots = _slots(anchors, blocks)
    at = (block - first) * DEPTH << BLOCK_BITS
    keep = np.ones(len(anchors), bool)
    for j, slot in enumerate(slots):
        place = at + (j << BLOCK_BITS) + slot
        keep &= (flags[place >> 3] >> (7 - (place & 7)) & 1).astype(bool)
    return keep


def suspected(documents: DataFrame, scratch: Scratch, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(doc_id, anchor, place, m, f1, f2) of the stretches whose anchor is estimated to stand in two documents or more."""
    texts = _long_texts(documents, span)
    spark = documents.sparkSession
    blocks = sketch_blocks(texts, span, gram)
    sketch = scratch.written(anchor_sketch(texts, blocks, span, gram), "sketch")
    size = (DEPTH << BLOCK_BITS) // 8
    most = max(1, SKETCH_BYTES // size)

    def piece(first: int) -> object:
        flags = np.zeros(min(most, blocks - first) * size, np.uint8)
        for row in sketch.where(F.col("block").between(first, first + most - 1)).toLocalIterator():
            at = (row["block"] - first) * size
            flags[at : at + size] = np.frombuffer(row["flags"], np.uint8)
        return spark.sparkContext.broadcast(flags)

    whole = piece(0) if blocks <= most else None

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in K.small_batches(batches, "text", 1 << 20):
            ids = batch.column("doc_id").to_numpy()
            for rows, places, m, anchors, f1, f2 in _stretches(batch, span, gram, True):
                keep = np.ones(len(rows), bool) if whole is None else _repeated(anchors, blocks, 0, whole.value)
                if keep.any():
                    values = (ids[rows], anchors.view(np.int64), places, m, f1.view(np.int64), f2.view(np.int64))
                    yield pa.record_batch([pa.array(x[keep]) for x in values], names=["doc_id", *TEXT_KEY[:1], "place", "m", "f1", "f2"])

    found_here = texts.mapInArrow(emit, STRETCH)
    if whole is not None:
        return scratch.written(found_here, "stretches")

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = _slots(batch.column("anchor").to_numpy().view(np.uint64), blocks)[0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((block // most).astype(np.int32))], [*batch.schema.names, "part"])

    parted = scratch.written(found_here.mapInArrow(part, STRETCH + ", part int"), "parted", "part")
    kept = []
    for number in range(-(-blocks // most)):
        flags, first = piece(number * most), number * most

        def sift(batches: Iterator[pa.RecordBatch], flags=flags, first=first) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            for batch in batches:
                if batch.num_rows:
                    yield batch.filter(pa.array(_repeated(batch.column("anchor").to_numpy().view(np.uint64), blocks, first, flags.value)))

        mine = parted.where(F.col("part") == number).drop("part")
        kept.append(scratch.written(mine.mapInArrow(sift, STRETCH), "stretches"))
        flags.unpersist()
    out = kept[0]
    for more in kept[1:]:
        out = out.union(more)
    return out


def shared_texts(stretches: DataFrame, documents: DataFrame, scratch: Scratch, span: int = SPAN) -> tuple[DataFrame, DataFrame]:
    """Of all stretches' texts (anchor, f1, f2, m): those shared as a whole, and (with low, high) the shared parts of others.

    A text is shared as a whole if two documents have it. Other texts are compared by windows with the texts that have
    the same anchor; of each one document is read. ``low`` to ``high`` are places in the stretch, the latter outside it.
    """
    one = F.min(F.struct("doc_id", "place")).alias("one")
    texts = scratch.written(stretches.groupBy(*TEXT_KEY).agg(one, F.max("doc_id").alias("last")), "texts")
    whole = texts.where("one.doc_id < last").select(*TEXT_KEY)
    # Windows can be shared only where an anchor has several texts of more than one document, one of them not settled yet.
    open_ = (F.col("one.doc_id") == F.col("last")).cast("int")
    mixed = texts.groupBy("anchor").agg(F.count("*").alias("c"), F.max(open_).alias("o"), F.min("one.doc_id").alias("lo"), F.max("last").alias("hi"))
    wanted = texts.join(mixed.where("c > 1 and o = 1 and lo < hi").select("anchor"), "anchor", "left_semi")
    grouped = wanted.groupBy("one.doc_id").agg(F.collect_list(F.struct("one.place", "last", *TEXT_KEY)).alias("runs"))
    sources = _long_texts(documents, span).join(grouped, "doc_id")  # the list of a document is in proportion to its length

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in K.small_batches(batches, "text", 1 << 20):
            for doc, text, runs in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "runs")), strict=True):
                for run in runs:
                    points = np.frombuffer(text[run["place"] : run["place"] + run["m"] + span - 1].encode("utf-32-le", "surrogatepass"), np.uint32)
                    sums, ends = [(_sums(points, x), x) for x in (_A, _B)], (np.zeros(1, np.int64), np.full(1, len(points)))
                    if [int(_hashes(s, x, *ends, ends[1]).view(np.int64)[0]) for s, x in sums] != [run["f1"], run["f2"]]:
                        continue  # another row of the same id has this stretch
                    w = [pa.array(_hashes(s, x, slice(0, run["m"]), slice(span, None), span).view(np.int64)) for s, x in sums]
                    same = {c: pa.array(np.full(run["m"], v, np.int64)) for c, v in (("doc_id", doc), ("last", run["last"]), *((k, run[k]) for k in TEXT_KEY))}
                    yield pa.record_batch({"w1": w[0], "w2": w[1], "off": pa.array(np.arange(run["m"])), **same})

    schema = "w1 bigint, w2 bigint, off bigint, doc_id bigint, last bigint, anchor bigint, f1 bigint, f2 bigint, m bigint"
    windows = scratch.written(sources.mapInArrow(kernel, schema), "windows")
    repeated = windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("lo"), F.max("last").alias("hi")).where("lo < hi")
    hit = windows.where("doc_id = last").join(repeated, ["w1", "w2"], "left_semi").select(*TEXT_KEY, "off").distinct()
    island = hit.withColumn("g", F.col("off") - F.row_number().over(Window.partitionBy(*TEXT_KEY).orderBy("off")))
    parts = island.groupBy(*TEXT_KEY, "g").agg(F.min("off").alias("low"), (F.max("off") + span).alias("high")).drop("g")
    return whole, parts


def found(documents: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(doc_id) of the documents with a span of at least ``span`` code points that stands in another document.

    Null, empty and shorter texts are not among them. Repeated rows of one doc_id are one document.
    """
    scratch = Scratch(documents.sparkSession)
    stretches = suspected(documents, scratch, span, gram)
    whole, parts = shared_texts(stretches, documents, scratch, span)
    return stretches.join(whole.union(parts.select(*TEXT_KEY)).distinct(), TEXT_KEY, "left_semi").select("doc_id").distinct()


def shared_report(documents: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_chars, shared_chars, share) of every document: how many of its characters lie in shared spans.

    Null and empty texts have no characters and share 0.0. A row that repeats a doc_id is reported as often as it stands.
    """
    scratch = Scratch(documents.sparkSession)
    stretches = suspected(documents, scratch, span, gram)
    whole, parts = shared_texts(stretches, documents, scratch, span)
    every = whole.select(*TEXT_KEY, F.lit(0).cast("bigint").alias("low"), (F.col("m") + span - 1).alias("high")).union(parts)
    ranges = stretches.join(every, TEXT_KEY).select("doc_id", (F.col("place") + F.col("low")).alias("low"), (F.col("place") + F.col("high")).alias("high")).distinct()
    before = F.max("high").over(Window.partitionBy("doc_id").orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1))
    covered = ranges.select("doc_id", F.greatest(F.lit(0), F.col("high") - F.greatest("low", F.coalesce(before, F.lit(0)))).alias("c"))
    sums = covered.groupBy("doc_id").agg(F.sum("c").alias("shared_chars"))
    sized = documents.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("n_chars"))
    out = sized.join(sums, "doc_id", "left").withColumn("shared_chars", F.coalesce("shared_chars", F.lit(0)))
    return out.withColumn("share", F.when(F.col("n_chars") > 0, F.round(F.col("shared_chars") / F.col("n_chars"), 6)).otherwise(F.lit(0.0)))
