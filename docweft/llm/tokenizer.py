"""Encoding and decoding with a public byte-level BPE vocabulary, inside the JVM.

Texts are cut into words by the vocabulary's pattern. A word that is itself a piece of the vocabulary has
its id in a literal table. All other words are made distinct over the whole corpus, turned into byte
arrays, and folded: each step takes the lowest-ranked pair of neighbours from a literal rank table and
merges it. Only the other words and the ids are shuffled, never the texts.

Literal tables are open-addressed arrays (two possible slots a key by 64-bit hash), so a look-up takes two
array reads at most; a map literal would be searched from its beginning for every pair.
"""

from __future__ import annotations

import base64
import heapq
import json
import struct
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..storage import written

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k"
# Fixed value: how this vocabulary cuts text into words, in Java's dialect.
PATTERN = r"(?U)'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ID_BITS = 20  # of an id in a packed merge: left, right and result fit a 64-bit number
MOST_IDS = 1 << ID_BITS
SEGMENT = 2048  # words of a text numbered together
LONG_WORD = 96  # bytes; longer words are merged by a heap in a Python worker, exactly alike
SEPARATOR = "\x01"
BROADCAST_BYTES = 64 << 20  # of words and ids; a larger dictionary is joined by a shuffle


class Vocabulary:
    """Pieces by id, merges (left id, right id) -> id, and the id of each byte."""

    def __init__(self, folder: str = TOKENIZERS, name: str = VOCABULARY) -> None:
        lines = Path(folder, f"{name}.tiktoken").read_bytes().splitlines()
        pairs = (line.split() for line in lines if line)
        self.pieces = {int(rank): base64.b64decode(piece) for piece, rank in pairs}
        ids = {piece: rank for rank, piece in self.pieces.items()}
        self.bytes = [ids[bytes([b])] for b in range(256)]
        if max(self.pieces) >= MOST_IDS:
            raise ValueError(f"ids of this vocabulary reach {max(self.pieces)}; {MOST_IDS - 1} is the most a packed merge holds")
        self.merges: dict[tuple[int, int], int] = {}
        model = Path(folder, f"{name}.json")
        if model.exists():
            told = json.loads(model.read_text(encoding="utf-8"))["model"]
            vocab = told["vocab"]
            for merge in told["merges"]:
                left, right = merge.split(" ") if isinstance(merge, str) else merge
                self.merges[vocab[left], vocab[right]] = vocab[left + right]
            # Later merges must have higher ids: the fold takes the least id as the lowest rank.
            values = list(self.merges.values())
            if values != sorted(values):
                raise ValueError("ids of this vocabulary do not follow its merges")
        else:  # ranks alone: a piece is the merge of the two pieces that all earlier merges leave of it
            for rank in sorted(self.pieces):
                if len(self.pieces[rank]) > 1:
                    parts = self.encode(self.pieces[rank])
                    if len(parts) != 2:
                        raise ValueError(f"piece {rank} is no merge of two earlier pieces")
                    self.merges[parts[0], parts[1]] = rank

    def encode(self, word: bytes) -> list[int]:
        """The ids of one word by a heap of pairs: n log n in its length."""
        ids = [self.bytes[b] for b in word]
        n = len(ids)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(m, i) for i in range(n - 1) if (m := self.merges.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            m, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else -1
            if j < 0 or self.merges.get((ids[i], ids[j])) != m:
                continue
            ids[i], ids[j] = m, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (new := self.merges.get((ids[a], ids[b]))) is not None:
                    heapq.heappush(heap, (new, a))
        return [x for x in ids if x >= 0]


def two_slots(keys: dict[bytes, int]) -> list[bytes | None]:
    """Each key at one of its two slots: the low and the middle bits of its hash; by moving others on.

    The table has a power of two of slots, more than twice as many as keys.
    """
    size = 1 << (2 * len(keys)).bit_length()

    def places(key: bytes) -> tuple[int, int]:
        h = xxhash.xxh64_intdigest(key, 42)
        return h & (size - 1), (h >> 32) & (size - 1)

    slots: list[bytes | None] = [None] * size
    for key in keys:
        at = places(key)[0]
        for _ in range(500):
            slots[at], key = key, slots[at]
            if key is None:
                break
            one, two = places(key)
            at = two if at == one else one
        else:
            raise ValueError("the table is too full")
    return slots


@lru_cache(maxsize=4)
def tables(folder: str, name: str) -> tuple[Vocabulary, str, str, str]:
    """The vocabulary and, as text for literals, its words, their ids and its packed merges."""
    vocabulary = Vocabulary(folder, name)
    words: dict[bytes, int] = {}
    for rank, piece in vocabulary.pieces.items():
        try:
            plain = piece.decode("utf-8")
        except UnicodeDecodeError:
            continue
        if SEPARATOR not in plain and vocabulary.encode(piece) == [rank]:
            words[piece] = rank
    slots = two_slots(words)
    word_text = SEPARATOR.join("" if w is None else w.decode("utf-8") for w in slots)
    id_text = ",".join("-1" if w is None else str(words[w]) for w in slots)
    packed = {struct.pack("<q", (left << ID_BITS) + right): (((left << ID_BITS) + right) << ID_BITS) + m for (left, right), m in vocabulary.merges.items()}
    merge_text = ",".join("-1" if k is None else str(packed[k]) for k in two_slots(packed))
    return vocabulary, word_text, id_text, merge_text


def _bound(value: Column, use) -> Column:  # noqa: ANN001
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def _slot_pair(key: Column, table: Column, read) -> Column:  # noqa: ANN001
    mask = (F.size(table) - 1).cast("bigint")
    one = F.xxhash64(key).bitwiseAND(mask).cast("int")
    two = F.shiftrightunsigned(F.xxhash64(key), 32).bitwiseAND(mask).cast("int")
    return F.coalesce(read(one), read(two))


def _word_tables(folder: str, name: str) -> Column:
    _, words, ids, _ = tables(folder, name)
    return F.struct(F.split(F.lit(words), SEPARATOR, -1).alias("words"), F.split(F.lit(ids), ",").cast("array<int>").alias("ids"))


def _known(word: Column, table: Column) -> Column:
    """The id of a word that is a piece by itself, else null."""
    return _slot_pair(word, table["words"], lambda at: F.when(F.get(table["words"], at) == word, F.get(table["ids"], at)))


def _merge_of(left: Column, right: Column, table: Column) -> Column:
    def read(key: Column, at: Column) -> Column:
        entry = F.get(table, at)
        return F.when(F.shiftright(entry, ID_BITS) == key, entry.bitwiseAND(F.lit(MOST_IDS - 1)).cast("int"))

    return _bound(left.cast("bigint") * MOST_IDS + right, lambda key: _slot_pair(key, table, lambda at: read(key, at)))


def _step(ids: Column, table: Column) -> Column:
    """One merge of the lowest rank, at all its places unless they could overlap; ``done`` if there is none."""
    n = F.size(ids) - 1
    ranks = F.zip_with(F.slice(ids, 1, n), F.slice(ids, 2, n), lambda a, b: _merge_of(a, b, table))

    def merge(ranks: Column, low: Column) -> Column:
        at = F.array_position(ranks, low).cast("int")
        first_only = F.concat(F.slice(ids, 1, at - 1), F.array(low), F.slice(ids, at + 2, F.greatest(n - at, F.lit(0))))
        everywhere = F.filter(
            F.transform(ids, lambda x, i: F.when(F.get(ranks, i) == low, low).when(F.get(ranks, i - 1) == low, F.lit(None).cast("int")).otherwise(x)),
            lambda x: x.isNotNull(),
        )
        return F.when(F.get(ids, at - 1) == F.get(ids, at), first_only).otherwise(everywhere)

    def settle(ranks: Column) -> Column:
        return _bound(
            F.array_min(ranks),
            lambda low: F.when(low.isNull(), F.struct(ids.alias("ids"), F.lit(True).alias("done"))).otherwise(
                F.struct(merge(ranks, low).alias("ids"), (n == 1).alias("done"))
            ),
        )

    return _bound(ranks, settle)


def fold_merges(word: Column, folder: str = TOKENIZERS, name: str = VOCABULARY) -> Column:
    """The ids of a word that is not empty, by a fold of ranked merges over its bytes."""
    vocabulary, _, _, merges = tables(folder, name)
    byte_ids = F.split(F.lit(",".join(map(str, vocabulary.bytes))), ",").cast("array<int>")
    raw = F.transform(F.regexp_extract_all(F.hex(F.encode(word, "UTF-8")), F.lit(".."), 0), lambda x: F.conv(x, 16, 10).cast("int"))
    start = F.transform(raw, lambda b: F.get(byte_ids, b))

    def fold(table: Column, ids: Column) -> Column:
        state = F.struct(ids.alias("ids"), (F.size(ids) < 2).alias("done"))
        return F.aggregate(
            F.sequence(F.lit(1), F.greatest(F.size(ids), F.lit(1))),
            state,
            lambda s, _: F.when(s["done"], s).otherwise(_step(s["ids"], table)),
            lambda s: s["ids"],
        )

    merge_table = F.split(F.lit(merges), ",").cast("array<bigint>")
    return _bound(merge_table, lambda table: _bound(start, lambda ids: fold(table, ids)))


def split_words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PATTERN), 0)


def _coded(documents: DataFrame, folder: str, name: str) -> DataFrame:
    """(doc_id, doc, th, codes, tails): ids of known words, and -1 - k for the k-th entry of ``tails``, the others.

    ``doc`` and ``th`` (the id without null, a hash of text and null id) name a row's contents for plain equi joins.
    """
    key = {"doc": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)), "th": F.xxhash64("text", F.col("doc_id").isNull())}
    rows = documents.select("doc_id", *[c.alias(n) for n, c in key.items()], split_words(F.col("text")).alias("words"))
    count = F.ceil(F.size("words") / SEGMENT).cast("int")
    starts = F.filter(F.sequence(F.lit(0), count), lambda i: i < count)
    parts = F.transform(starts, lambda i: F.slice(F.col("words"), i * SEGMENT + 1, SEGMENT))

    def part(table: Column, words: Column) -> Column:
        return _bound(
            F.transform(words, lambda w: _known(w, table)),
            lambda known: F.struct(
                words.alias("words"), known.alias("known"),
                F.array_distinct(F.filter(F.zip_with(words, known, lambda w, k: F.when(k.isNull(), w)), lambda w: w.isNotNull())).alias("tail"),
            ),
        )

    rows = rows.select("doc_id", "doc", "th", _bound(_word_tables(folder, name), lambda table: F.transform(parts, lambda words: part(table, words))).alias("parts"))

    def codes(done: Column, p: Column) -> Column:
        offset = F.size(done["tails"])
        new = F.zip_with(p["words"], p["known"], lambda w, k: F.coalesce(k, -offset - F.array_position(p["tail"], w).cast("int")))
        return F.struct(F.concat(done["codes"], new).alias("codes"), F.concat(done["tails"], p["tail"]).alias("tails"))

    none = F.struct(F.expr("cast(array() as array<int>)").alias("codes"), F.expr("cast(array() as array<string>)").alias("tails"))
    return rows.select("doc_id", "doc", "th", F.aggregate("parts", none, codes).alias("c")).select("doc_id", "doc", "th", "c.codes", "c.tails")


def encode_words(words: DataFrame, folder: str = TOKENIZERS, name: str = VOCABULARY) -> DataFrame:
    """(word, ids) of distinct, non-empty words."""
    spark = words.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    distinct = words.select("word").where("word <> ''").repartition(parts, "word").distinct()
    short = distinct.where(F.octet_length("word") <= LONG_WORD).select("word", fold_merges(F.col("word"), folder, name).alias("ids"))
    shared = spark.sparkContext.broadcast(tables(folder, name)[0])

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [shared.value.encode(w.encode("utf-8")) for w in batch.column("word").to_pylist()]
            yield pa.record_batch({"word": batch.column("word"), "ids": pa.array(ids, pa.list_(pa.int32()))})

    long = distinct.where(F.octet_length("word") > LONG_WORD).mapInArrow(kernel, "word string, ids array<int>")
    return short.union(long)


def encode(documents: DataFrame, folder: str = TOKENIZERS, name: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids) of every row, without special tokens; null and empty texts give an empty list.

    The texts of special tokens are ordinary text. Repeated rows are given as often as they stand.
    """
    coded = written(_coded(documents, folder, name), "coded")
    tails = coded.where(F.size("tails") > 0).select("doc", "th", F.posexplode("tails").alias("k", "word"))
    # The dictionary grows with the corpus's vocabulary: it is broadcast only while its measured size allows.
    size = Observation()
    weighed = encode_words(tails, folder, name).observe(size, F.sum(F.octet_length("word") + F.size("ids") * 4 + 64).alias("bytes"))
    dictionary = written(weighed, "dictionary")
    spelled = tails.join(F.broadcast(dictionary) if (size.get["bytes"] or 0) <= BROADCAST_BYTES else dictionary, "word")
    # A set, since a document that stands twice brings every entry twice.
    back = spelled.groupBy("doc", "th").agg(F.array_sort(F.collect_set(F.struct("k", "ids"))).alias("entries"))
    joined = coded.drop("tails").join(back, ["doc", "th"], "left")
    ids = F.flatten(F.transform("codes", lambda c: F.when(c >= 0, F.array(c)).otherwise(F.get(F.col("entries"), -1 - c)["ids"])))
    return joined.select("doc_id", ids.alias("ids"))


def decode(encoded: DataFrame, folder: str = TOKENIZERS, name: str = VOCABULARY) -> DataFrame:
    """(doc_id, text): the binary pieces of the ids, concatenated and read as UTF-8. An empty list gives an empty text; null gives null."""
    vocabulary = tables(folder, name)[0]
    hexed = F.split(F.lit(",".join(vocabulary.pieces[i].hex() for i in range(len(vocabulary.pieces)))), ",")
    text = _bound(hexed, lambda table: F.decode(F.unhex(F.array_join(F.transform("ids", lambda i: F.get(table, i)), "")), "UTF-8"))
    return encoded.select("doc_id", text.alias("text"))
