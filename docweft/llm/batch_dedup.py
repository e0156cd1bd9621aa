"""New batches against all that was accepted before.

Accepted sets lie in a persisted forest of prefix trees (``forest``). A batch looks its own labels up, deepest
prefix first and nearest neighbours first; sets for which no duplicate is verified look again under a shorter
prefix, until the prefix length at which the recall target is met and all entries under it are seen. Every
candidate is verified over whole sets. One row of each set and one of each key (commit and code) enters the
forest, so copies weigh nothing.

Within a batch the order decides: a row is turned away by an *accepted* earlier row only. Rows with equal
sets form a class; links lie between classes; decisions go in rounds over the smallest accepted and the
smallest open row of each class and key, so copies are never paired.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..storage import Scratch, collect_garbage, fresh_path, noted
from . import kernels as K
from .forest import DEPTH, EXACT, TREES, WIDTH, Forest, labels_of
from .near_dups import likeness, shingle_table

FIELDS = ("code_after", "javadoc_after")
THRESHOLD = 0.6
RECALL = 0.999
SEED = 31_013
NEAR = 64  # neighbours on either side that a look-up takes first; it goes on, eight times as far, while more are left
CROWD = 64  # open classes of one batch under one prefix, beyond which they are compared with its first one first
MAX_ROUNDS = 10_000


def least_depth(threshold: float = THRESHOLD, trees: int = TREES, recall: float = RECALL) -> int:
    """The longest prefix at which a pair at the threshold still meets in some tree with the wanted probability."""
    for depth in range(DEPTH, 0, -1):
        if 1 - (1 - threshold**depth) ** trees >= recall:
            return depth
    return 1


def exact_key() -> F.Column:
    """128 bits of the commit hash in lower case and the code without white space; null where either says nothing."""
    code = F.regexp_replace(F.coalesce("code_after", F.lit("")), r"(?U)\s+", "")
    usable = F.col("commit_hash").isNotNull() & (code != "")
    return F.when(usable, F.unhex(F.md5(F.concat_ws("\x01", F.lower("commit_hash"), code))))


def open_forest(samples: DataFrame, folder: str | None = None) -> Forest:
    """The index in ``folder``, which all executors must share; a new one where there is none."""
    return Forest(samples.sparkSession, folder or fresh_path(samples.sparkSession, "forest"), {"fields": list(FIELDS), "threshold": THRESHOLD, "seed": SEED})


def signed(samples: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows, classes of equal sets, and labels of these classes and of the keys; each written by batch.

    rows (id, fp, fp2, key, batch); classes (fp, fp2, cls, copies, n, grams, batch) with the smallest row of each set;
    signs (sign, id, n, batch) of the classes and of the keys. A null batch comes first, as if it were the oldest. Texts
    are read once.
    """
    others = {"key": exact_key(), "batch": F.coalesce(F.col("batch_id").cast("bigint"), F.lit(-1))}
    sets = scratch.written(shingle_table(samples, "sample_id", FIELDS, others=others).drop("tf"), "signed", "batch")
    grouped = sets.where("n > 0").groupBy("batch", "fp", "fp2").agg(F.min("id").alias("cls"), F.count("*").alias("copies"), F.min_by(F.struct("n", "grams"), "id").alias("s"))
    classes = scratch.written(grouped.select("fp", "fp2", "cls", "copies", "s.n", "s.grams", "batch"), "classes", "batch")
    keys = sets.where("key is not null").groupBy("batch", "key").agg(F.min("id").alias("id")).select(key_sign(), "id", F.lit(0).alias("n"), "batch")
    signs = scratch.written(set_signs(classes).unionByName(keys), "signs", "batch")
    return sets.select("id", "fp", "fp2", "n", "key", "batch"), classes, signs


def key_sign() -> F.Column:
    """A key as a label of the forest."""
    return F.concat(F.unhex(F.lit(f"{EXACT:02X}")), F.col("key"), F.unhex(F.lit("00" * (WIDTH - 17)))).alias("sign")


def of_sets(signs: DataFrame) -> DataFrame:
    """The rows of ``signs`` that are sets, not keys."""
    return signs.where(F.octet_length("sign") > WIDTH)


def set_signs(classes: DataFrame) -> DataFrame:
    """(sign, id, n, batch): the minimum hashes of each class."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                grams, at = K.list_values(batch.column("grams"), "int64")
                sign = K.signature_column(K.minhash(grams.view("uint64"), at, TREES * DEPTH, SEED))
                yield pa.record_batch({"sign": sign, "id": batch.column("cls"), "n": batch.column("n"), "batch": batch.column("batch")})

    return classes.select("cls", "n", "grams", "batch").mapInArrow(kernel, "sign binary, id bigint, n int, batch bigint")


def held_before(forest: Forest, classes: DataFrame, signs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(a) of the classes with a near duplicate in the forest, and (a) of the keys that stand there; both by their smallest row.

    Rounds: the nearest ``NEAR`` entries on each side under ever shorter prefixes, for the classes not settled so far. Deep
    prefixes are looked up in some of the trees, as what is nearly equal meets in most; the shortest in all of them. Then,
    while any open class has entries left under the shortest prefix, eight times as far each time.
    """
    own = classes.select(F.col("cls").alias("id"), "grams")
    hits = keys = classes.select(F.col("cls").alias("a")).limit(0)
    if not forest.runs:
        return hits, keys
    least = least_depth()
    rounds = [(depth, 0, NEAR) for depth in range(DEPTH, least - 1, -1)]
    asked = signs
    while rounds:
        depth, near, far = rounds.pop(0)
        looked, compared = Observation(), Observation()
        pairs = forest.candidates(asked, TREES >> (depth - least), depth, near, far, THRESHOLD, looked)
        if depth == DEPTH:
            pairs = scratch.written(pairs, "met")
            keys = pairs.where("b is null").select("a")
        hits = hits.union(scratch.written(forest.verify(pairs, own, THRESHOLD, compared).distinct(), "hits"))
        forest.bytes_read += noted(looked, "read") + noted(compared, "read")
        if not rounds and noted(looked, "more"):
            rounds.append((depth, far, far * 8))
        asked = of_sets(signs).join(hits, F.col("id") == F.col("a"), "left_anti")
    return hits, keys


def _pairs_verified(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The (a, b) of one batch whose sets are like enough; sizes are compared before any set is fetched."""
    sizes = classes.select("cls", "n")
    near = pairs.join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b")
    near = near.where(F.least("na", "nb") >= F.greatest("na", "nb") * THRESHOLD).select("a", "b")
    sets = classes.select("cls", "grams")
    return near.join(sets.toDF("a", "ga"), "a").join(sets.toDF("b", "gb"), "b").where(likeness(F.col("ga"), F.col("gb")) >= THRESHOLD).select("a", "b")


def links_inside(signs: DataFrame, hits: DataFrame, classes: DataFrame, firm: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(a, b) links between open classes of one batch, a > b, and (a) of classes that a surely accepted row turns away.

    Classes that share a prefix of the least depth are compared. Where more than ``CROWD`` do, they are first compared with
    the first of them only: if that one is ``firm`` (the first of its key, which is new) and the first under all its
    prefixes, it will be accepted, and whatever is near it goes at once. This repeats while it turns any away, so a batch
    in which a third of the rows are edits of one text is not paired with itself.
    """
    prefix = F.xxhash64(F.substring("label", 1, 1 + 4 * least_depth())).alias("p")
    sizes = Observation()
    open_ = labels_of(of_sets(signs).join(hits, F.col("id") == F.col("a"), "left_anti")).select(prefix, "id")
    shared = open_.groupBy("p").agg(F.count("*").alias("c"), F.min("id").alias("low")).where("c > 1")
    open_ = scratch.written(open_.join(shared, "p").observe(sizes, F.max("c").alias("most")), "open")
    turned = classes.select(F.col("cls").alias("a")).limit(0)
    for _ in range(MAX_ROUNDS):
        if noted(sizes, "most") <= CROWD:
            break
        first = open_.groupBy("id").agg(F.bool_and(F.col("low") == F.col("id")).alias("first")).where("first").join(firm, "id", "left_semi").select("id")
        crowded = open_.where(f"c > {CROWD}").join(first.select(F.col("id").alias("low")), "low", "left_semi")
        star = crowded.where("id > low").select(F.col("id").alias("a"), F.col("low").alias("b")).distinct()
        gone, number = scratch.counted(_pairs_verified(star, classes).select("a").distinct(), "gone")
        # A first one has now met all under its crowded prefixes: it leaves them, with those it turns away.
        settled = crowded.where("id = low").select("p", "id")
        left = open_.drop("c", "low").join(gone.select(F.col("a").alias("id")), "id", "left_anti").join(settled, ["p", "id"], "left_anti")
        shared = left.groupBy("p").agg(F.count("*").alias("c"), F.min("id").alias("low")).where("c > 1")
        sizes, before = Observation(), open_
        open_ = scratch.written(left.join(shared, "p").observe(sizes, F.max("c").alias("most")), "open")
        turned = turned.union(gone)
        if not number and before.count() == open_.count():
            break
    pairs = open_.select("p", F.col("id").alias("a")).join(open_.select("p", F.col("id").alias("b")), "p").where("a > b").select("a", "b").distinct()
    return scratch.written(_pairs_verified(pairs, classes), "links"), turned


def _decide(rows: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, cls, key, accepted) of open rows (id, cls, key) of one batch, in order of id, with links (c, d) between classes.

    A row belongs to its class and its key and watches these and the classes linked to its own. It is turned
    away when a watched group has an accepted row before it, waits while one has an open row before it, and is
    accepted otherwise. Groups are reduced to their smallest accepted and smallest open row before they are joined.
    """
    state = rows.withColumn("accepted", F.lit(None).cast("boolean"))
    low = [F.min(F.when(c, F.col("id"))).alias(n) for c, n in ((F.col("accepted"), "done"), (F.col("accepted").isNull(), "open"))]
    for _ in range(MAX_ROUNDS):
        own = state.where("cls is not null").groupBy("cls").agg(*low)
        near = links.join(own, F.col("d") == F.col("cls")).select(F.col("c").alias("cls"), "done", "open")
        seen = own.union(near).groupBy("cls").agg(F.min("done").alias("done"), F.min("open").alias("open"))
        keys = state.where("key is not null").groupBy("key").agg(*[c.alias(f"k_{n}") for c, n in zip(low, ("done", "open"), strict=True)])
        watched = state.join(seen, "cls", "left").join(keys, "key", "left")
        done, open_ = F.least("done", "k_done"), F.least("open", "k_open")
        verdict = F.when(done < F.col("id"), False).when(open_ < F.col("id"), None).otherwise(True)
        waiting = Observation()
        state = watched.select("id", "cls", "key", F.coalesce("accepted", verdict).alias("accepted"))
        state = scratch.written(state.observe(waiting, F.count_if(F.col("accepted").isNull()).alias("n")), "round")
        if not noted(waiting, "n"):
            return state
    raise RuntimeError("a batch did not settle")


def _enter(forest: Forest, number: int, result: DataFrame, classes: DataFrame, signs: DataFrame, rows: DataFrame, bound: tuple[int, int]) -> DataFrame:
    """Writes the batch's decisions (id, cls, accepted) and enters its first accepted row of each set and of each key."""
    path = f"{forest.folder}/decisions/{number}"
    result.select("id", "cls", "accepted").write.mode("overwrite").option("compression", "zstd").parquet(path)
    told = rows.sparkSession.read.schema("id bigint, cls bigint, accepted boolean").parquet(path)
    first = told.where("accepted and cls is not null").groupBy("cls").agg(F.min("id").alias("first"))
    named = of_sets(signs).join(first, F.col("id") == F.col("cls")).select("sign", F.col("first").alias("id"), "n")
    keyed = rows.where("key is not null").join(told.where("accepted"), "id", "left_semi").groupBy("key").agg(F.min("id").alias("id"))
    forest.append(
        labels_of(named.union(keyed.select(key_sign(), "id", F.lit(0)))), classes.join(first, "cls").select(F.col("first").alias("id"), "grams"), bound, str(number), path
    )
    return told


def check_batch(forest: Forest, number: int, size: int, rows: DataFrame, classes: DataFrame, signs: DataFrame, accept_all: bool = False) -> DataFrame:
    """(id, cls, accepted) of the rows of one signed batch, and their entry into the forest.

    The tables are the batch's parts of what ``signed`` gives, ``size`` the number of its rows. A batch that the index has already is not decided again:
    its decisions are read. Rows with an empty set can be turned away by their key only.
    """
    spark = rows.sparkSession
    if str(number) in forest.batches:
        return spark.read.schema("id bigint, cls bigint, accepted boolean").parquet(forest.batches[str(number)])
    scratch = Scratch(spark)
    bound = (size * (TREES + 1), size)
    classed = rows.join(classes.select("fp", "fp2", "cls", "copies"), ["fp", "fp2"], "left").select("id", "cls", "copies", "key")
    if accept_all:
        out = _enter(forest, number, classed.withColumn("accepted", F.lit(True)), classes, signs, rows, bound)
        scratch.drop()
        return out
    hits, held = held_before(forest, classes, signs, scratch)
    keys = rows.where("key is not null").groupBy("key").agg(F.count("*").alias("same"), F.min("id").alias("first"))
    keys = keys.join(held.withColumn("old", F.lit(True)), F.col("first") == F.col("a"), "left").select("key", "same", "first", "old")
    # A class whose first row is the first of its key, and that key new, or has no key, depends on its set alone.
    lead = rows.join(classes.select(F.col("cls").alias("id")), "id", "left_semi").select("id", "key").join(keys, "key", "left")
    firm = lead.where("key is null or (old is null and first = id)").select("id")
    links, turned = links_inside(signs, hits, classes, firm, scratch)
    yes, no = F.lit(True), F.lit(False)
    marks = hits.union(turned).select(F.col("a").alias("cls"), yes.alias("hit")).union(links.select("a", no)).union(links.select("b", no))
    marks = marks.groupBy("cls").agg(F.max("hit").alias("hit"))
    told = classed.join(marks, "cls", "left").join(keys, "key", "left")
    away = F.coalesce("hit", no) | F.coalesce("old", no)
    contested = (F.coalesce("copies", F.lit(1)) > 1) | (F.coalesce("same", F.lit(1)) > 1) | F.col("hit").isNotNull()
    disputes = Observation()
    told = told.select("id", "cls", "key", away.alias("away"), (~away & contested).alias("contested"))
    told = scratch.written(told.observe(disputes, F.count_if("contested").alias("n")), "told")
    result = told.where("not contested").select("id", "cls", (~F.col("away")).alias("accepted"))
    if noted(disputes, "n"):
        both = links.select(F.col("a").alias("c"), F.col("b").alias("d")).union(links.select("b", "a"))
        result = result.union(_decide(told.where("contested").select("id", "cls", "key"), both, scratch).select("id", "cls", "accepted"))
    out = _enter(forest, number, result, classes, signs, rows, bound)
    scratch.drop()
    return out


def decisions(samples: DataFrame, forest: Forest | None = None) -> DataFrame:
    """(id, accepted) of all rows of ``samples``, batch after batch; batch 0 and older are accepted whole.

    ``forest`` may hold the batches of earlier calls, which are not read again; it is opened from its folder by
    ``open_forest``. ``sample_id`` must be unique. Null texts count as empty; a null commit hash equals none. An
    empty table gives an empty result. What is in the index already keeps its decisions.
    """
    spark = samples.sparkSession
    forest = forest or open_forest(samples)
    scratch = Scratch(spark)
    tables = signed(samples, scratch)
    sizes = {r["batch"]: r["count"] for r in tables[0].groupBy("batch").count().collect()}
    for number, size in sorted(sizes.items()):
        check_batch(forest, number, size, *[t.where(F.col("batch") == number) for t in tables], accept_all=number <= 0)
        collect_garbage(spark)
    scratch.drop()
    paths = [forest.batches[str(n)] for n in sizes]
    schema = "id bigint, accepted boolean"
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def found(samples: DataFrame) -> DataFrame:
    """(sample_id) of the rows turned away."""
    return decisions(samples).where("not accepted").select(F.col("id").alias("sample_id")).distinct()
