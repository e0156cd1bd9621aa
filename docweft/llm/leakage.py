"""Evaluation passages inside training texts, found by spaced-seed hashing.

A seed is a fixed mask over ``SPAN`` consecutive words; only the words at its ones are hashed, so words at
its zeros may differ. Items are hashed under every mask, texts are hashed under every mask as they are
scanned, and around each meeting the whole diagonal (text against item) is compared word by word: the
longest exact run, and the longest run with a few substitutions. A text that shares ``SPAN`` consecutive
words with an item meets it under every mask, so none is lost.

The items are broadcast whole while they are of at most ``MOST_WORDS`` words, and texts are not shuffled. Beyond that,
seeds are joined: the texts are scanned once, seeds that a broadcast bit table of fixed size rules out are dropped,
the others meet the items' seeds by a shuffle, and only texts with a meeting are fetched again, each with the
items it met, and compared in the same way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import Scratch
from . import kernels as K

# One mask a line, each beginning and ending with a one.
SPAN = 12
MASKS = (
    "111100001111",
    "110011110011",
    "101101101101",
)
SUBSTITUTIONS = 2
MOST_WORDS = 1_000_000
FILTER_BITS = 29  # of the table of seeds that items have: 64 MB; a fuller table lets more seeds through and loses none
DENSE = 2_000_000  # meetings of one text that are listed one by one
WORDS = r"[^\p{L}\p{N}]+"


def word_text(text: Column) -> Column:
    """The words (longest runs of letters and digits) in lower case, parted by one space. Null counts as empty."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), WORDS, " ")


def _seeds(tokens: np.ndarray) -> list[np.ndarray]:
    out = []
    n = len(tokens) - SPAN + 1
    for number, mask in enumerate(MASKS):
        h = np.full(max(n, 0), number + 1, np.uint64)
        for k, used in enumerate(mask):
            if used == "1" and n > 0:
                h = K.mix(h * np.uint64(3) + tokens[k : k + n])
        out.append(h)
    return out


def _index(items: pa.Table) -> dict:
    """Sorted seeds of a block of items, each with its item and place, and all the items' words."""
    offsets, raw = K.buffers(items.column("words"))
    tokens, rows = K.token_hashes(offsets, raw, K.NOT_BLANK)
    at = K.bounds(rows, len(items))
    seeds, owners, places = [], [], []
    whole = rows[: max(len(rows) - SPAN + 1, 0)] == rows[SPAN - 1 :]
    for h in _seeds(tokens):
        seeds.append(h[whole])
        owners.append(rows[: len(h)][whole])
        places.append(np.flatnonzero(whole))
    if not seeds[0].size:
        return {}
    all_seeds, owner, place = np.concatenate(seeds), np.concatenate(owners), np.concatenate(places)
    order = np.argsort(all_seeds, kind="stable")
    return {"seeds": all_seeds[order], "owner": owner[order], "place": place[order], "tokens": tokens, "at": at, "ids": items.column("item").to_numpy()}


def _longest(equal: np.ndarray, allowed: int) -> tuple[int, int]:
    """Length of the longest stretch with at most ``allowed`` unequal words inside, ends equal, and its unequal words."""
    wrong = np.flatnonzero(~equal)
    edges = np.concatenate(([-1], wrong, [len(equal)]))
    filled = np.diff(edges) > 1
    best, subs = 0, 0
    for miss in range(min(allowed, len(wrong)) + 1):
        # A stretch that begins or ends with an unequal word is, without it, one with fewer of them.
        spans = edges[miss + 1 :] - edges[: len(edges) - miss - 1] - 1
        spans = np.where(filled[: len(spans)] & filled[miss:], spans, 0)
        if int(spans.max()) > best:
            best, subs = int(spans.max()), miss
    return best, subs


def _diagonals(lo: np.ndarray, many: np.ndarray, hit: np.ndarray, rows: np.ndarray, at: np.ndarray, index: dict) -> list[np.ndarray]:
    """Arrays (row, item, shift) of the diagonals with a hit.

    A text that repeats itself meets an item that does so in a product of places. Where one text has more than
    ``DENSE`` meetings, all diagonals of that text and the items it meets are given instead: at most as many as
    both have words.
    """
    out = []
    for begin, end, dense in _runs(rows[hit], many):
        h, m, low = hit[begin:end], many[begin:end], lo[begin:end]
        if not dense:
            where = np.repeat(h, m)
            entry = np.repeat(low - np.concatenate(([0], np.cumsum(m)[:-1])), m) + np.arange(m.sum())
            out.append(np.unique(np.stack([rows[where], index["owner"][entry], where - index["place"][entry]]), axis=1))
            continue
        row = int(rows[h[0]])
        first = np.unique(low, return_index=True)[1]
        for item in np.unique(np.concatenate([index["owner"][low[k] : low[k] + m[k]] for k in first])):
            shifts = np.arange(int(at[row]) - int(index["at"][item + 1]) + SPAN, int(at[row + 1]) - int(index["at"][item]) - SPAN + 1)
            out.append(np.stack([np.full(len(shifts), row), np.full(len(shifts), item), shifts]))
    return out


def _runs(rows: np.ndarray, many: np.ndarray) -> Iterator[tuple[int, int, bool]]:
    """(begin, end, dense) of the hits, whole rows together up to ``DENSE`` meetings; a row with more is alone."""
    if not len(rows):
        return
    cuts = np.concatenate((np.flatnonzero(np.diff(rows)) + 1, [len(rows)]))
    sums = np.concatenate(([0], np.cumsum(many)))
    begin = last = 0
    for cut in cuts.tolist():
        if sums[cut] - sums[begin] > DENSE and last > begin:
            yield begin, last, False
            begin = last
        if sums[cut] - sums[begin] > DENSE:
            yield begin, cut, True
            begin = cut
        last = cut
    if begin < len(rows):
        yield begin, len(rows), False


def _best(shifts: np.ndarray, doc: np.ndarray, doc_at: int, item: np.ndarray, item_at: int) -> tuple[int, int, int]:
    """(longest exact run, longest run with substitutions, these) over diagonals, the longest overlap first."""
    begin, end = np.maximum(doc_at, item_at + shifts), np.minimum(doc_at + len(doc), item_at + len(item) + shifts)
    run = length = subs = 0
    for k in np.argsort(begin - end, kind="stable").tolist():
        a, b = int(begin[k]), int(end[k])
        if b - a <= run or b - a < SPAN:
            break
        equal = doc[a - doc_at : b - doc_at] == item[a - shifts[k] - item_at : b - shifts[k] - item_at]
        run = max(run, _longest(equal, 0)[0])
        found, cost = _longest(equal, SUBSTITUTIONS)
        if (found, -cost) > (length, -subs):
            length, subs = found, cost
    return run, length, subs


def _scan(batches: Iterator[pa.RecordBatch], index: dict) -> Iterator[pa.RecordBatch]:
    for batch in K.small_batches(batches, "words"):
        offsets, raw = K.buffers(batch.column("words"))
        tokens, rows = K.token_hashes(offsets, raw, K.NOT_BLANK)
        if len(tokens) < SPAN or not index:
            continue
        at = K.bounds(rows, batch.num_rows)
        whole = rows[: len(rows) - SPAN + 1] == rows[SPAN - 1 :]
        diagonals = []
        for h in _seeds(tokens):
            lo = np.searchsorted(index["seeds"], h, "left")
            hit = np.flatnonzero((lo < len(index["seeds"])) & whole)
            hit = hit[index["seeds"][lo[hit]] == h[hit]]
            if len(hit):
                many = np.searchsorted(index["seeds"], h[hit], "right") - lo[hit]
                diagonals += _diagonals(lo[hit], many, hit, rows, at, index)
        if not diagonals:
            continue
        row, item, shift = np.unique(np.concatenate(diagonals, axis=1), axis=1)
        cuts = np.flatnonzero(np.diff(row, prepend=-1) | np.diff(item, prepend=-1))
        values = []
        for a, b in zip(cuts, [*cuts[1:], len(row)], strict=True):
            r, i = int(row[a]), int(item[a])
            d0, i0 = int(at[r]), int(index["at"][i])
            values.append(_best(shift[a:b], tokens[d0 : at[r + 1]], d0, index["tokens"][i0 : index["at"][i + 1]], i0))
        found_here = np.array(values, np.int32)
        yield pa.record_batch(
            {
                "doc_id": pa.array(batch.column("doc_id").to_numpy()[row[cuts]]),
                "item_id": pa.array(index["ids"][item[cuts]]),
                "run": pa.array(found_here[:, 0]),
                "overlap": pa.array(found_here[:, 1]),
                "substitutions": pa.array(found_here[:, 2]),
            }
        )


RESULT = "doc_id bigint, item_id bigint, run int, overlap int, substitutions int"


def _row_seeds(batches: Iterator[pa.RecordBatch], key: str, flags: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """(seed, key): the distinct seeds of each row, with ``flags`` only those whose bit is set."""
    for batch in K.small_batches(batches, "words"):
        offsets, raw = K.buffers(batch.column("words"))
        tokens, rows = K.token_hashes(offsets, raw, K.NOT_BLANK)
        if len(tokens) < SPAN:
            continue
        whole = rows[: len(rows) - SPAN + 1] == rows[SPAN - 1 :]
        h = np.concatenate([x[whole] for x in _seeds(tokens)])
        r = np.tile(rows[: len(whole)][whole], len(MASKS))
        if flags is not None:
            bit = (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
            kept = (flags[bit >> 3] >> (bit & 7) & 1).astype(bool)
            h, r = h[kept], r[kept]
        h, r, _ = K.row_sets(h, r)
        yield pa.record_batch({"seed": h.view(np.int64), key: batch.column(key).to_numpy()[r]})


def _bits(seeds: DataFrame) -> np.ndarray:
    """The table of bits that the seeds' first bits name, merged block by block."""
    block = 16

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, np.zeros(1 << block, bool)
        for batch in batches:
            if not batch.num_rows:
                continue
            bit = (batch.column("seed").to_numpy().view(np.uint64) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(bit >> block, prepend=-1))
            for i, j in zip(cuts, [*cuts[1:], len(bit)], strict=True):
                if now is not None and now != bit[i] >> block:
                    yield pa.record_batch({"block": pa.array([now]), "bits": pa.array([np.packbits(held, bitorder="little").tobytes()], pa.binary())})
                    held[:] = False
                now = int(bit[i] >> block)
                held[bit[i:j] & ((1 << block) - 1)] = True
        if now is not None:
            yield pa.record_batch({"block": pa.array([now]), "bits": pa.array([np.packbits(held, bitorder="little").tobytes()], pa.binary())})

    flags = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    placed = seeds.select("seed").withColumn("block", F.shiftrightunsigned("seed", 64 - FILTER_BITS + block)).repartition("block").sortWithinPartitions("block")
    for row in placed.mapInArrow(merge, "block bigint, bits binary").toLocalIterator():
        flags[row["block"] << (block - 3) : (row["block"] + 1) << (block - 3)] |= np.frombuffer(row["bits"], np.uint8)
    return flags


def _broadcast(texts: DataFrame, words: DataFrame) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(_index(words.toArrow()))
    return texts.mapInArrow(lambda batches: _scan(batches, shared.value), RESULT)


def _joined(texts: DataFrame, words: DataFrame) -> DataFrame:
    scratch = Scratch(texts.sparkSession)
    seeds = scratch.written(words.mapInArrow(lambda batches: _row_seeds(batches, "item"), "seed bigint, item bigint"), "item-seeds")
    flags = texts.sparkSession.sparkContext.broadcast(_bits(seeds))
    mine = texts.mapInArrow(lambda batches: _row_seeds(batches, "doc_id", flags.value), "seed bigint, doc_id bigint")
    met = scratch.written(mine.join(seeds, "seed").select("doc_id", "item").distinct(), "met")
    beside = met.join(words, "item").groupBy("doc_id").agg(F.collect_list(F.struct("item", F.col("words").alias("text"))).alias("items"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                items = batch.column("items")[i].as_py()
                index = _index(pa.table({"item": pa.array([x["item"] for x in items], pa.int64()), "words": pa.array([x["text"] for x in items], pa.string())}))
                yield from _scan(iter([batch.select(["doc_id", "words"]).slice(i, 1)]), index)

    return texts.join(beside, "doc_id").select("doc_id", "words", "items").mapInArrow(compare, RESULT)


def overlaps(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, run, overlap, substitutions) of every text and item that meet under a seed.

    ``run`` is the longest exact run of words, ``overlap`` the longest with at most two words replaced.
    Null and empty texts and items shorter than a mask meet nothing; repeated rows of one document are
    reported once, ties by the longest run. Rows with a null id are dropped.
    """
    words = items.where("item_id is not null").select(F.col("item_id").cast("bigint").alias("item"), word_text(F.col("text")).alias("words"))
    total = words.agg(F.coalesce(F.sum(F.size(F.split("words", " "))), F.lit(0)).alias("n")).first()["n"]
    texts = documents.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), word_text(F.col("text")).alias("words"))
    out = _broadcast(texts, words) if total <= MOST_WORDS else _joined(texts, words)
    best = F.max(F.struct("overlap", (-F.col("substitutions")).alias("s")))
    grouped = out.groupBy("doc_id", "item_id").agg(F.max("run").alias("run"), best.alias("best"))
    return grouped.select("doc_id", "item_id", "run", F.col("best.overlap").alias("overlap"), (-F.col("best.s")).alias("substitutions"))


def found(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id) with at least 12 consecutive words in common."""
    return overlaps(documents, items).where(F.col("run") >= SPAN).select("doc_id", "item_id")
