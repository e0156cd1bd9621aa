"""Near-duplicate records: consistent weighted samples of TF-IDF shingles, banded, and an exact prefix join, then verified exactly.

Plan: (1) one pass turns texts into sets of shingle hashes, written once; (2) document frequencies of all shingles are
counted over all rows, and those above one go into a table of fixed size that never tells too few; (3) one
representative of each set of equal shingles is sampled and banded; (4) each also gives its rarest shingles, as
many as any pair at the threshold must share one of; (5) representatives that share a band or such a shingle, and
whose sizes allow it, are compared in full. Copies never meet.

Bands meet with a probability that follows the weighted likeness, which lies far below the threshold where what two
texts share is common and what they do not is rare. The prefixes do not depend on chance: by number of shingles they
lose no pair by set likeness, by weight none by weighted likeness. A band that more than ``CROWD`` representatives
share is linked as a star only, as prefixes bring the rest.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import Scratch, written
from . import kernels as K
from .splits import hash_to_min

WIDTH = 3
THRESHOLD = 0.6
BANDS = 40
ROWS = 3
SEED = 20_011
FREQUENCY_ROWS, FREQUENCY_BITS = 3, 22  # of the table of document frequencies: two bytes an entry, 24 MB at any number of rows
BLOCK_BITS = 16
SCALE = 1024  # entries hold the binary logarithm of a count in these parts
WEIGHT_SCALE = 1 << 20  # weights are added up in these parts, as whole numbers, so that sums are exact in any order
TOLERANCE = 2e-6  # a share of a weight, twice what rounding to such parts can change: no weight is below 0.99
CROWD = 64


def joined_text(fields: Sequence[str]) -> Column:
    """The fields joined by line ends, null as empty, in lower case."""
    return F.lower(F.concat_ws("\n", *[F.coalesce(F.col(f), F.lit("")) for f in fields]))


def shingle_table(rows: DataFrame, row_id: str, fields: Sequence[str], width: int = WIDTH, others: dict[str, Column] | None = None) -> DataFrame:
    """(id, fp, fp2, n, grams, tf, others) of each row; a text with fewer than ``width`` tokens has an empty set.

    Rows without an id are dropped, as nothing could name them.
    """
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return K.shingle_sets(batches, width)

    ready = rows.where(F.col(row_id).isNotNull()).select(F.col(row_id).cast("bigint").alias("id"), joined_text(fields).alias("text"), *[c.alias(n) for n, c in (others or {}).items()])
    kept = "".join(f", {n} {t}" for n, t in ready.dtypes[2:])
    return ready.mapInArrow(kernel, f"id bigint, fp bigint, fp2 bigint, n int, grams array<bigint>, tf array<int>{kept}")


def _entries(g: np.ndarray) -> list[np.ndarray]:
    """Where each shingle stands in each row of the table of frequencies."""
    h = K.mix(g.view(np.uint64))
    mask = np.uint64((1 << FREQUENCY_BITS) - 1)
    return [(((h >> np.uint64(21 * j)) & mask).astype(np.int64) + (j << FREQUENCY_BITS)) for j in range(FREQUENCY_ROWS)]


class Frequencies:
    """Document frequencies of all shingles in a table of fixed size: the least of the entries of a shingle.

    An entry holds the highest count of the shingles that fall on it, so a frequency is never told too low, and too high
    only where all entries of a shingle are shared with more frequent ones. A shingle of one row has the frequency 1.
    """

    def __init__(self, rows: int, table: np.ndarray) -> None:
        self.rows, self.table = rows, table

    def rank(self, g: np.ndarray) -> np.ndarray:
        """Logarithm of the frequency, in parts of ``SCALE``; 0 for a shingle that surely stands in one row only."""
        return np.minimum.reduce([self.table[e] for e in _entries(g)]).astype(np.float64)

    def weights(self, g: np.ndarray, tf: np.ndarray) -> np.ndarray:
        return (np.log((1 + self.rows) / (1 + np.exp2(self.rank(g) / SCALE))) + 1) * (1 + np.log(tf))


def frequencies(sets: DataFrame, counts: DataFrame) -> Frequencies:
    """The table of frequencies: merged block by block, so at most (table / block) rows reach the driver."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at = np.concatenate(_entries(batch.column("g").to_numpy()))
            q = np.tile(np.round(np.log2(batch.column("count").to_numpy()) * SCALE).astype(np.uint16), FREQUENCY_ROWS)
            order = np.argsort(at, kind="stable")
            at, q = at[order], q[order]
            cuts = np.flatnonzero(np.diff(at >> BLOCK_BITS, prepend=-1))
            ends = [*cuts[1:], len(at)]
            yield pa.record_batch(
                {
                    "block": pa.array(at[cuts] >> BLOCK_BITS),
                    "at": pa.array([(at[i:j] & ((1 << BLOCK_BITS) - 1)).astype(np.uint16).tobytes() for i, j in zip(cuts, ends, strict=True)], pa.binary()),
                    "q": pa.array([q[i:j].tobytes() for i, j in zip(cuts, ends, strict=True)], pa.binary()),
                }
            )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, np.zeros(1 << BLOCK_BITS, np.uint16)
        for batch in batches:
            for block, at, q in zip(*(batch.column(c).to_pylist() for c in ("block", "at", "q")), strict=True):
                if now is not None and now != block:
                    yield pa.record_batch({"block": pa.array([now]), "held": pa.array([held.tobytes()], pa.binary())})
                    held[:] = 0
                now = block
                np.maximum.at(held, np.frombuffer(at, np.uint16), np.frombuffer(q, np.uint16))
        if now is not None:
            yield pa.record_batch({"block": pa.array([now]), "held": pa.array([held.tobytes()], pa.binary())})

    table = np.zeros(FREQUENCY_ROWS << FREQUENCY_BITS, np.uint16)
    sent = counts.select("g", "count").mapInArrow(spread, "block bigint, at binary, q binary")
    for row in sent.repartition("block").sortWithinPartitions("block").mapInArrow(merge, "block bigint, held binary").toLocalIterator():
        table[row["block"] << BLOCK_BITS : (row["block"] + 1) << BLOCK_BITS] = np.frombuffer(row["held"], np.uint16)
    return Frequencies(sets.where("n > 0").count(), table)


def keyed(sets: DataFrame, known: Frequencies, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, weighted: bool = False) -> DataFrame:
    """(key, band, id, n, pos): the band keys of each row's weighted samples, with pos 0, and the shingles of its prefix.

    ``n`` is the size of the row's set and ``pos`` the shingle's place in it, the rarest first (``K.prefixes``); with
    ``weighted`` the weight of the set and of what stands before the shingle (``K.weighted_prefixes``). A shingle that no
    other row has is left out: nothing can meet it.
    """
    shared = sets.sparkSession.sparkContext.broadcast(known)
    kind = np.int64 if weighted else np.int32

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = K.ConsistentSampler(bands * rows, SEED)
        for batch in batches:
            if not batch.num_rows:
                continue
            grams, at = K.list_values(batch.column("grams"), np.int64)
            tf, _ = K.list_values(batch.column("tf"), np.float64)
            ids, weights = batch.column("id").to_numpy(), shared.value.weights(grams, tf)
            parts = np.round(weights * WEIGHT_SCALE).astype(np.int64) if weighted else np.empty(0, np.int64)
            sizes = K.segment_sum(parts.view(np.uint64), at).view(np.int64) if weighted else np.diff(at).astype(kind)
            keys = K.band_keys(sampler.sample(grams.view(np.uint64), weights, at), rows)
            same = {"band": np.ones(keys.size, bool), "id": np.repeat(ids, bands), "n": np.repeat(sizes, bands), "pos": np.zeros(keys.size, kind)}
            yield pa.record_batch({"key": keys.ravel().view(np.int64), **same})
            rank = shared.value.rank(grams)
            which, row, pos = K.weighted_prefixes(grams.view(np.uint64), rank, parts, at, threshold - TOLERANCE) if weighted else K.prefixes(grams.view(np.uint64), rank, at, threshold)
            met = rank[which] > 0
            which, row, pos = which[met], row[met], pos[met]
            yield pa.record_batch({"key": grams[which], "band": np.zeros(len(which), bool), "id": ids[row], "n": sizes[row], "pos": pos.astype(kind)})

    place = "bigint" if weighted else "int"
    return sets.where("n > 0").select("id", "grams", "tf").mapInArrow(kernel, f"key bigint, band boolean, id bigint, n {place}, pos {place}")


def reachable(threshold: float) -> Column:
    """Whether two sets whose first common shingle stands at these places can still reach the threshold; for bands, by size alone.

    Places and sizes are numbers of shingles, or both are weights.
    """
    both = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    return both * (1 + threshold) >= (F.col("na") + F.col("nb")) * (threshold - TOLERANCE)


def likeness(a: Column, b: Column) -> Column:
    """Size of the intersection over that of the union; 0 if either is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b, likeness) of the pairs at or above the threshold, compared over their whole sets."""
    left = sets.select(F.col("id").alias("a"), F.col("grams").alias("ga"))
    right = sets.select(F.col("id").alias("b"), F.col("grams").alias("gb"))
    scored = pairs.join(left, "a").join(right, "b").select("a", "b", likeness(F.col("ga"), F.col("gb")).alias("likeness"))
    return scored.where(F.col("likeness") >= threshold)


def representatives(sets: DataFrame) -> DataFrame:
    """(fp, fp2, rep, copies) of each distinct set that is not empty."""
    return sets.where("n > 0").groupBy("fp", "fp2").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))


def verified_weighted(pairs: DataFrame, sets: DataFrame, known: Frequencies, threshold: float) -> DataFrame:
    """(a, b, likeness) of the pairs at or above the threshold by weighted Jaccard of their TF-IDF weights."""
    shared = sets.sparkSession.sparkContext.broadcast(known)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sides = []
            for side in "ab":
                grams, at = K.list_values(batch.column(f"g{side}"), np.int64)
                sides.append((grams, shared.value.weights(grams, K.list_values(batch.column(f"t{side}"), np.float64)[0]), at))
            yield pa.record_batch({"a": batch.column("a"), "b": batch.column("b"), "likeness": K.weighted_likeness(*sides)})

    left, right = (sets.select(F.col("id").alias(s), F.col("grams").alias(f"g{s}"), F.col("tf").alias(f"t{s}")) for s in "ab")
    return pairs.join(left, "a").join(right, "b").mapInArrow(kernel, "a bigint, b bigint, likeness double").where(F.col("likeness") >= threshold)


def met_pairs(keys: DataFrame, threshold: float) -> DataFrame:
    """(a, b), a < b, of the rows that share a key and may reach the threshold."""
    # A key that only one row has is dropped by a combined count before anything is joined.
    busy = keys.groupBy("key", "band").agg(F.count("*").alias("c"), F.min("id").alias("low")).where("c > 1")
    left = keys.join(busy, ["key", "band"])
    crowded = F.col("band") & (F.col("c") > CROWD)
    star = left.where(crowded & (F.col("id") > F.col("low"))).select(F.col("low").alias("a"), F.col("id").alias("b"))
    open_ = left.where(~crowded).select("key", "band", "id", "n", "pos")
    pairs = open_.toDF("key", "band", "a", "na", "pa").join(open_.toDF("key", "band", "b", "nb", "pb"), ["key", "band"])
    return pairs.where((F.col("a") < F.col("b")) & reachable(threshold)).select("a", "b").union(star).distinct()


def near_duplicates(
    rows: DataFrame, row_id: str, fields: Sequence[str], threshold: float = THRESHOLD, width: int = WIDTH, bands: int = BANDS, band_rows: int = ROWS, weighted: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(links, members): links (a, b, likeness) between representatives, a < b, and members (id, rep).

    Likeness is that of the sets of shingles, or with ``weighted`` the weighted Jaccard of their TF-IDF weights; the prefixes
    are then measured by weight, so that they lose no pair by that likeness either. Null fields count as
    empty; rows with an empty set of shingles are linked to nothing and are no members. Repeated rows are members of one
    representative. ``row_id`` must be unique.
    """
    scratch = Scratch(rows.sparkSession)
    sets = scratch.written(shingle_table(rows, row_id, fields, width), "shingles")
    counts = scratch.written(sets.select(F.explode("grams").alias("g")).groupBy("g").count().where("count > 1"), "counts")
    known = frequencies(sets, counts)
    reps = representatives(sets)
    members = written(sets.where("n > 0").select("id", "fp", "fp2").join(reps, ["fp", "fp2"]).select("id", "rep"), "members")
    one = members.where("id = rep").select("id").distinct()
    kept = written(sets.join(one, "id", "left_semi").select("id", "n", "grams", "tf"), "sets")
    scratch.drop()
    keys = written(keyed(kept, known, threshold, bands, band_rows, weighted), "keys")
    pairs = met_pairs(keys, threshold)
    return (verified_weighted(pairs, kept, known, threshold) if weighted else verified(pairs, kept, threshold)), members


SAMPLE_FIELDS = ("code_before", "code_after", "javadoc_after")


def found(samples: DataFrame) -> DataFrame:
    """(sample_a, sample_b), a < b: all pairs of rows with likeness of at least 0.6, copies included."""
    links, members = near_duplicates(samples, "sample_id", SAMPLE_FIELDS)
    links = written(links, "links")
    one, two = members.toDF("x", "a"), members.toDF("y", "b")
    across = links.join(one, "a").join(two, "b").select("x", "y")
    copied = members.groupBy("rep").count().where("count > 1").select("rep")
    twice = members.join(copied, "rep", "left_semi")
    within = twice.toDF("rep", "x").join(twice.toDF("rep", "y"), "rep").where("x < y").select("x", "y")
    return across.union(within).select(F.least("x", "y").alias("sample_a"), F.greatest("x", "y").alias("sample_b")).where("sample_a < sample_b").distinct()


def classes(samples: DataFrame) -> DataFrame:
    """(sample_id, class_id, group_id, links): each row's class of equal sets, group of near-duplicates and number of links.

    A class is named by its smallest row, a group by the smallest class that its links reach, at once or through a chain;
    ``links`` counts the other classes near this one. No pairs of copies. Rows with an empty set of shingles are
    classes and groups of their own without links.
    """
    links, members = near_duplicates(samples, "sample_id", SAMPLE_FIELDS)
    links = written(links, "links")
    each = links.select(F.col("a").alias("rep")).union(links.select("b")).groupBy("rep").agg(F.count("*").alias("links"))
    groups = hash_to_min(links.select("a", "b")).select(F.col("node").alias("rep"), F.col("component").alias("grp"))
    known = members.distinct().join(each, "rep", "left").join(groups, "rep", "left").select("id", "rep", "grp", "links")
    rows = samples.select(F.col("sample_id").alias("id"))
    return rows.join(known, "id", "left").select(
        F.col("id").alias("sample_id"), F.coalesce("rep", "id").alias("class_id"), F.coalesce("grp", "rep", "id").alias("group_id"), F.coalesce("links", F.lit(0)).alias("links")
    )


def weighted_links(samples: DataFrame) -> DataFrame:
    """(sample_a, sample_b, likeness) between classes of equal sets, by weighted Jaccard of at least 0.6; see ``classes`` for membership."""
    links, _ = near_duplicates(samples, "sample_id", SAMPLE_FIELDS, weighted=True)
    return links.select(F.col("a").alias("sample_a"), F.col("b").alias("sample_b"), F.round("likeness", 6).alias("likeness"))
