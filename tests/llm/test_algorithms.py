"""Operators over keys, links and sets, against small brute-force versions."""

import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docweft.llm import batch_dedup, forest as forest_module, format_dups, hashes, kernels, near_dups, splits, survivor

COMMITS = "commit_seq long, project_slug string, commit_hash string"
SAMPLES = "sample_id long, batch_id int, commit_hash string, code_before string, code_after string, javadoc_before string, javadoc_after string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_roots_and_fulls(spark):
    full, other = "a" * 12 + "b" * 28, "a" * 12 + "c" * 28
    df = spark.createDataFrame([(full,), (other,), ("a" * 12 + "bb",), ("a" * 12,), ("d" * 40,), ("abc",)], "h string")
    got = dict(rows(hashes.roots(df)))
    assert got[full] == got[other] == got["a" * 12 + "bb"] == "a" * 12
    assert got["d" * 40] == "d" * 40 and got["abc"] == "abc"
    got = {h: f for _, h, f in rows(hashes.fulls(df.withColumn("k", F.lit(1)), "k"))}
    assert got["a" * 12 + "bb"] == full and got["a" * 12] == full and got[other] == other


def test_projects_linked_by_chains_share_a_split(spark):
    h = [c * 40 for c in "abcdef"]
    data = [
        (1, "One/Project", h[0]), (2, "one-project", h[1]), (3, "two", f" {h[0].upper()}\n"), (4, "two", h[2]), (5, "three", h[2][:12]),
        (6, "four", h[3]), (7, "five", h[4]), (8, None, h[0]), (9, "six", None), (10, "seven", "0" * 40), (11, "eight", "0" * 40), (12, "four", h[3]),
    ]
    commits = spark.createDataFrame(data, COMMITS)
    assert rows(splits.linked_projects(commits)) == [("one_project", "three"), ("one_project", "two"), ("three", "two")]
    got = {r["commit_seq"]: r["split"] for r in splits.assign_splits(commits, {"x": 1, "y": 1, "z": 1}).collect()}
    assert len(got) == 12 and len({got[i] for i in (1, 2, 3, 4, 5)}) == 1


def test_long_chain_settles(spark):
    edges = spark.createDataFrame([(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)] + [("z1", "z2")], "a string, b string")
    got = dict(rows(splits.hash_to_min(edges)))
    assert {got[f"n{i:03d}"] for i in range(61)} == {"n000"} and got["z2"] == "z1"


def test_rendezvous_keeps_proportions_and_moves_little(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("k"))
    shares = {"train": 0.8, "validation": 0.1, "test": 0.1}
    counts = {r["s"]: r["count"] for r in df.select(splits.rendezvous(F.col("k"), shares).alias("s")).groupBy("s").count().collect()}
    assert abs(counts["train"] / 20000 - 0.8) < 0.02 and abs(counts["test"] / 20000 - 0.1) < 0.01
    more = {"train": 0.8, "validation": 0.1, "test": 0.2}
    moved = df.where(splits.rendezvous(F.col("k"), shares) != splits.rendezvous(F.col("k"), more))
    assert moved.where(splits.rendezvous(F.col("k"), more) != "test").isEmpty()
    with pytest.raises(ValueError):
        splits.rendezvous(F.col("k"), {"a": 0})


def _texts(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"word{i}" for i in range(400)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(5, 60))] for _ in range(n // 3)]
    out = []
    for i in range(n):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 6])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        if rng.random() < 0.1:
            words = words[: len(words) // 2] + words
        out.append(" ".join(words) if i % 17 else None)
    return out


def _grams(*fields):
    t = re.findall("[a-z0-9_]+", "\n".join(f or "" for f in fields).lower())
    return {tuple(t[i : i + 3]) for i in range(len(t) - 2)}


def _like(a, b):
    return len(a & b) / len(a | b) if a and b else 0


def _samples(seed=1, n=150):
    code, doc = _texts(seed, n), _texts(seed + 1, n)
    return [(i, i % 4, f"{i % 40:040x}".upper() if i % 3 else f"{i % 40:040x}", None, code[i], None, doc[i] if i % 5 else "") for i in range(n)]


def test_near_duplicates_equal_brute_force(spark):
    data = _samples()
    df = spark.createDataFrame(data, SAMPLES)
    sets = {r[0]: _grams(r[3], r[4], r[6]) for r in data}
    expected = [(a, b) for a in sets for b in sets if a < b and _like(sets[a], sets[b]) >= 0.6]
    assert rows(near_dups.found(df)) == sorted(expected)
    classes = {r["sample_id"]: (r["class_id"], r["links"]) for r in near_dups.classes(df).collect()}
    assert len(classes) == len(data)
    assert all(sets[i] == sets[c] for i, (c, _) in classes.items())


def test_likeness_of_common_words_only(spark):
    same = "if x null throw new y for int i"
    df = spark.createDataFrame([(i, 0, None, same, f"a{i} b{i} c{i} d{i} e{i}" * 3, None, None) for i in range(30)], SAMPLES)
    sets = [_grams(same, f"a{i} b{i} c{i} d{i} e{i}" * 3) for i in range(30)]
    assert near_dups.found(df).count() == sum(_like(sets[a], sets[b]) >= 0.6 for a in range(30) for b in range(a + 1, 30))


def test_edits_of_a_template_that_fills_a_third_of_the_rows(spark):
    shared = " ".join(f"s{i}" for i in range(62))
    edits = {i: " ".join(f"r{i}x{k}" for k in range(20 - i % 2)) for i in range(40)}
    data = [(i, 0, None, shared, own, None, None) for i, own in edits.items()]
    data += [(i, 0, None, " ".join(f"o{i}x{k}" for k in range(80)), None, None, None) for i in range(40, 120)]
    sets = {r[0]: _grams(r[3], r[4]) for r in data}
    expected = [(a, b) for a in sets for b in sets if a < b and _like(sets[a], sets[b]) >= 0.6]
    assert len(expected) == 780 and rows(near_dups.found(spark.createDataFrame(data, SAMPLES))) == expected


def test_samples_agree_as_often_as_the_sets_are_alike():
    rng = np.random.default_rng(3)
    sampler = kernels.ConsistentSampler(600, 1)
    for n in (40, 3000):
        h = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        w = rng.uniform(1, 9, (2, n))
        w[0, : n // 4] = w[1, n // 4 : n // 2] = 0
        sides = [(h[w[k] > 0].view(np.int64), w[k][w[k] > 0], np.array([0, (w[k] > 0).sum()])) for k in (0, 1)]
        names = [sampler.sample(a[0].view(np.uint64), a[1], a[2])[0] for a in sides]
        true = np.minimum(*w).sum() / np.maximum(*w).sum()
        assert kernels.weighted_likeness(*sides)[0] == pytest.approx(true)
        assert abs((names[0] == names[1]).mean() - true) < 0.07


@pytest.mark.parametrize("n", [5000, 200_000])
def test_large_sets_without_a_common_member_share_no_sample(n):
    rng = np.random.default_rng(n)
    h = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
    names = kernels.ConsistentSampler(120, 1).sample(h, np.full(2 * n, 8.0), np.array([0, n, 2 * n]))
    keys = kernels.band_keys(names, 3)
    assert not (names[0] == names[1]).any() and not (keys[0] == keys[1]).any()


def test_weighted_links_equal_brute_force(spark):
    data = _samples(8)
    df = spark.createDataFrame(data, SAMPLES)
    tokens = {r[0]: re.findall("[a-z0-9_]+", "\n".join(x or "" for x in (r[3], r[4], r[6])).lower()) for r in data}
    counts = {i: Counter(tuple(t[k : k + 3]) for k in range(len(t) - 2)) for i, t in tokens.items()}
    counts = {i: c for i, c in counts.items() if c}
    df_of = Counter(g for c in counts.values() for g in c)
    n = len(counts)
    weigh = {i: {g: (np.log((1 + n) / (1 + df_of[g])) + 1) * (1 + np.log(k)) for g, k in c.items()} for i, c in counts.items()}
    reps = {min(j for j in counts if set(counts[j]) == set(counts[i])) for i in counts}
    expected = {}
    for a in reps:
        for b in reps:
            if a < b and set(weigh[a]) & set(weigh[b]):
                every = {g: (weigh[a].get(g, 0), weigh[b].get(g, 0)) for g in {*weigh[a], *weigh[b]}}
                like = sum(map(min, every.values())) / sum(map(max, every.values()))
                if like >= 0.6:
                    expected[a, b] = like
    got = {(r[0], r[1]): r[2] for r in near_dups.weighted_links(df).collect()}
    near = {k for k, v in expected.items() if v > 0.605}
    assert near <= set(got) and {k for k in got if got[k] > 0.605} <= set(expected) and near
    assert all(abs(got[k] - expected[k]) < 0.01 for k in near)


def test_groups_of_near_duplicates_follow_chains(spark):
    words = [f"w{i}" for i in range(30)]
    texts = [" ".join(words[i : i + 20]) for i in (0, 3, 6)] + ["a quite different text of its own", None]
    df = spark.createDataFrame([(i + 1, 0, None, t, None, None, None) for i, t in enumerate(texts)], SAMPLES)
    got = {r["sample_id"]: (r["class_id"], r["group_id"], r["links"]) for r in near_dups.classes(df).collect()}
    assert got == {1: (1, 1, 1), 2: (2, 1, 2), 3: (3, 1, 1), 4: (4, 4, 0), 5: (5, 5, 0)}


@pytest.mark.parametrize("crowd", [4])
def test_crowded_bands_lose_nothing(spark, monkeypatch, crowd):
    monkeypatch.setattr(near_dups, "CROWD", crowd)
    data = _samples(9)
    sets = {r[0]: _grams(r[3], r[4], r[6]) for r in data}
    expected = sorted((a, b) for a in sets for b in sets if a < b and _like(sets[a], sets[b]) >= 0.6)
    assert rows(near_dups.found(spark.createDataFrame(data, SAMPLES))) == expected


def test_prefixes_meet_at_the_threshold():
    rng = random.Random(5)
    for _ in range(300):
        both, one, two = (rng.sample(range(k, k + 90), rng.randint(1, 60)) for k in (0, 100, 200))
        sets = [np.array(sorted(both + own), np.uint64) for own in (one, two)]
        at = np.array([0, len(sets[0]), len(sets[0]) + len(sets[1])])
        h = np.concatenate(sets)
        which, row, _ = kernels.prefixes(h, np.where(h < 90, h % 7, 9.0), at, 0.6)
        if _like(set(sets[0].tolist()), set(sets[1].tolist())) >= 0.6:
            assert set(h[which[row == 0]].tolist()) & set(h[which[row == 1]].tolist())


def _turned_away(data):
    accepted, out = [], set()
    for r in sorted(data, key=lambda r: (r[1], r[0])):
        grams, code = _grams(r[4], r[6]), re.sub(r"\s+", "", r[4] or "")
        key = (r[2].lower(), code) if r[2] is not None and code else None
        if r[1] > 0 and any(_like(grams, g) >= 0.6 or key and key == k for g, k in accepted):
            out.add(r[0])
        else:
            accepted.append((grams, key))
    return out


@pytest.mark.parametrize("seed", [1, 7])
def test_batches_equal_brute_force(spark, seed):
    data = _samples(seed)
    got = {r[0] for r in batch_dedup.found(spark.createDataFrame(data, SAMPLES)).collect()}
    assert got == _turned_away(data) and got


def test_only_accepted_rows_turn_away(spark):
    words = [f"w{i}" for i in range(24)]
    a, b, c = " ".join(words[:20]), " ".join(words[3:22]), " ".join(words[6:24])
    data = [(1, 0, None, None, a, None, None), (2, 1, None, None, b, None, None), (3, 1, None, None, c, None, None), (4, 2, "AB", None, "x  y", None, "one two three four"), (5, 2, "ab", None, "x y", None, "five six seven eight")]
    assert _like(_grams(a), _grams(b)) >= 0.6 and _like(_grams(b), _grams(c)) >= 0.6 > _like(_grams(a), _grams(c))
    assert rows(batch_dedup.found(spark.createDataFrame(data, SAMPLES))) == [(2,), (5,)]


@pytest.mark.parametrize("near", [64, 1])
def test_forest_is_reopened_for_later_batches(spark, tmp_path, monkeypatch, near):
    monkeypatch.setattr(batch_dedup, "NEAR", near)
    data = _samples(3)
    df = spark.createDataFrame(data, SAMPLES)
    folder = f"file://{tmp_path}/forest"
    got = []
    for part in ("batch_id < 2", "batch_id = 2", "batch_id > 2"):
        forest = batch_dedup.open_forest(df, folder)  # each part by an object that knows the folder only
        got += batch_dedup.decisions(df.where(part), forest).where("not accepted").collect()
    assert {r[0] for r in got} == _turned_away(data)
    again = batch_dedup.open_forest(df, folder)
    number, runs = again.number, len(again.runs)
    assert {r[0] for r in batch_dedup.decisions(df, again).where("not accepted").collect()} == _turned_away(data)
    assert again.number == number and runs <= forest_module.TIER * 3
    with pytest.raises(ValueError):
        forest_module.Forest(spark, folder, {"seed": 1})


def test_runs_are_merged_and_only_some_files_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(forest_module, "LABELS_A_FILE", 256)
    monkeypatch.setattr(forest_module, "SETS_A_FILE", 16)
    text = lambda i: " ".join(f"t{i}w{k}" for k in range(20))
    data = [(b * 100 + i, b, None, None, text(b * 100 + i), None, None) for b in range(6) for i in range(40)] + [(900, 6, None, None, text(3) + " x", None, None)]
    df = spark.createDataFrame(data, SAMPLES)
    forest = batch_dedup.open_forest(df, f"file://{tmp_path}/forest")
    batch_dedup.decisions(df.where("batch_id < 6"), forest)
    assert [r.tier for r in forest.runs] == [1, 0, 0] and sum(p.rows for r in forest.runs for p in r.sets) == 240
    assert len(forest.runs[0].labels) > 8
    before = forest.bytes_read
    assert rows(batch_dedup.decisions(df.where("batch_id = 6"), forest)) == [(900, False)]
    assert 0 < forest.bytes_read - before


def test_a_batch_of_edits_of_one_text(spark, monkeypatch):
    monkeypatch.setattr(batch_dedup, "CROWD", 8)
    rng = random.Random(1)
    base = [f"w{i}" for i in range(40)]
    data = [(1, 0, None, None, "other words stand in here", None, None)]
    for i in range(2, 122):
        words = list(base) if i % 3 else [f"v{i}x{k}" for k in range(30)]
        words[rng.randrange(len(words))] = f"e{i}"
        data.append((i, 1, None if i % 5 else "aa", None, " ".join(words), None, None))
    got = {r[0] for r in batch_dedup.found(spark.createDataFrame(data, SAMPLES)).collect()}
    assert got == _turned_away(data) and len(got) > 70


def test_survivor_is_the_lexicographic_best_of_the_skyline(spark):
    rng = random.Random(5)
    data = [(rng.randint(1, 30), rng.randint(0, 1), rng.choice([1, 2, 3, None]), rng.choice([None, *range(5)]), i, rng.choice([None, f"v{i}"])) for i in range(400)]
    df = spark.createDataFrame(data, "g int, complete int, trust int, recency long, row long, v string")
    got = {r["g"]: r for r in survivor.skyline_survivors(df, ["g"], "row", ["v"]).collect()}
    for g, r in got.items():
        group = [x for x in data if x[0] == g]
        order = lambda x: (-x[1], x[2] if x[2] is not None else 9, -(x[3] if x[3] is not None else -1), x[4])
        assert r["row"] == min(group, key=order)[4] and r["copies"] == len(group)
        assert (r["v"] is None) == all(x[5] is None for x in group)


def _filled(group, fields):
    """By definition: skyline after skyline of a list of (complete, trust, recency, row, fields...)."""
    left, out = list(group), [None] * fields
    better = lambda a, b: a[0] >= b[0] and a[1] <= b[1] and a[2] >= b[2] and a[:3] != b[:3]
    while left:
        sky = [b for b in left if not any(better(a, b) for a in left)]
        for j in range(fields):
            have = [r for r in sky if r[4 + j] is not None]
            if out[j] is None and have:
                out[j] = min(have, key=lambda r: (-r[0], r[1], -r[2], r[3]))[4 + j]
        left = [r for r in left if r not in sky]
    return tuple(out)


def test_fields_are_filled_by_layers_of_records(spark):
    schema = "g int, complete int, trust int, recency long, row long, v string"
    df = spark.createDataFrame([(1, 1, 1, 10, 1, None), (1, 1, 1, 5, 2, None), (1, 1, 1, 1, 3, "old"), (1, 0, 1, 9, 4, "fresh")], schema)
    assert [tuple(r) for r in survivor.skyline_survivors(df, ["g"], "row", ["v"]).collect()] == [(1, 1, 4, 1, 1, "fresh")]


def test_layers_of_a_group_that_fills_many_partitions(spark):
    rng = random.Random(1)
    data = []
    for i in range(1200):
        v, w = (f"{c}{i}" if rng.random() < p else None for c, p in (("v", 0.02), ("w", 0.01)))
        data.append((1 if i < 500 else rng.randint(1, 8), rng.randint(0, 2), rng.choice([1, 2, 3, None]), rng.choice([None, *range(60)]), i, v, w))
    df = spark.createDataFrame(data, "older int, complete int, trust int, recency long, row long, v string, w string")
    got = {r["older"]: (r["v"], r["w"]) for r in survivor.skyline_survivors(df, ["older"], "row", ["v", "w"]).collect()}
    for g, filled in got.items():
        group = [(c, 99 if t is None else t, -1 if e is None else e, *rest) for k, c, t, e, *rest in data if k == g]
        assert filled == _filled(group, 2)
    assert len(got) == 8


def test_best_commit_records(spark):
    full, other = "ab" * 20, "cd" * 20
    schema = "row_seq long, dataset string, project_slug string, repository_url string, commit_hash string, issue_summary string, mined_at timestamp"
    from datetime import datetime as d

    data = [
        (1, "bulk", "P/x", None, full, "Fix", d(2030, 1, 1)), (2, "bulk", "p_x", "u", full[:12].upper(), "Handle null values here", d(2030, 1, 1)),
        (3, "final", "p-x", None, f" {full} ", "Handle nothing ...", d(2031, 1, 1)), (4, "final", "p_x", None, other, "Say something good", None),
        (5, "final", "p_x", None, other, "Say something better", None), (6, "final", "p_x", None, "ef" * 20, "Alone but usable", None), (7, "final", None, None, full, "No slug at all", None),
    ]
    trust = spark.createDataFrame([("final", 1), ("bulk", 4)], "dataset string, trust_rank int")
    nested = spark.createDataFrame(data, schema)
    assert rows(survivor.found(nested, trust)) == [("p_x", full, 2), ("p_x", other, 4)]
    best = {r["commit_hash"]: r for r in survivor.best_commits(nested, trust).collect()}
    assert best[full]["issue_summary"] == "Handle null values here" and best[full]["copies"] == 3 and best[full]["repository_url"] == "u"


def test_format_duplicates(spark):
    doc = "/**\n * Returns the Value.\n * @param a first\n * @return x\n */"
    flat = "/** returns the value!! @return X @param A, first */"
    data = [
        (1, 0, None, "int f()", None, doc, None), (5, 0, None, "INT   f ( )", None, flat, ""), (3, 0, None, "int f()", None, doc.replace("first", "second"), None),
        (4, 0, None, None, None, None, None), (2, 0, None, "", None, " ", "{}"), (9, 0, None, "int f()", None, "@param a first", None), (8, 0, None, "int f()", None, "param a first", None),
    ]
    df = spark.createDataFrame(data, SAMPLES)
    assert rows(format_dups.found(df)) == [(1, 5), (2, 4), (8, 9)]
    assert sorted(r["copies"] for r in format_dups.collapsed(df).collect()) == [1, 2, 2, 2]
    assert format_dups.collapsed(df).where("collided").isEmpty()


def test_crowded_bands_lose_no_weighted_link(spark):
    shared = " ".join(f"s{i}" for i in range(62))
    data = [(i, 0, None, shared, f"r{i}", None, None) for i in range(100)]
    data += [(i, 0, None, " ".join(f"o{i}x{k}" for k in range(80)), None, None, None) for i in range(100, 400)]
    expected = [(a, b) for a in range(100) for b in range(a + 1, 100)]
    got = rows(near_dups.weighted_links(spark.createDataFrame(data, SAMPLES)))
    common, own = 60 * (np.log(401 / 101) + 1), np.log(401 / 2) + 1
    assert [r[:2] for r in got] == expected and all(abs(r[2] - common / (common + 2 * own)) < 0.01 for r in got)


def test_weighted_prefixes_meet():
    rng = np.random.default_rng(11)
    member = rng.choice(1 << 40, 60, replace=False).astype(np.uint64)
    weight, rank = rng.integers(1, 40, 60), rng.integers(0, 4, 60).astype(float)
    sets = [np.sort(rng.permutation(60)[: rng.integers(1, 60)]) for _ in range(120)]
    at = np.cumsum([0, *map(len, sets)])
    every = np.concatenate(sets)
    which, row, before = kernels.weighted_prefixes(member[every], rank[every], weight[every], at, 0.5)
    first = [dict(zip(every[which[row == i]].tolist(), before[row == i].tolist(), strict=True)) for i in range(len(sets))]
    met = 0
    for i, a in enumerate(sets):
        for j in range(i):
            both = weight[np.intersect1d(a, sets[j])].sum()
            if 2 * both >= weight[np.union1d(a, sets[j])].sum():
                common = first[i].keys() & first[j].keys()
                assert any(weight[s].sum() - first[k][c] >= both for c in common for k, s in ((i, a), (j, sets[j])))
                met += 1
    assert met > 100


def test_batches_let_go_of_their_broadcasts(spark):
    held = spark.sparkContext._jsc.sc().env().memoryManager()
    before = held.storageMemoryUsed()
    batch_dedup.decisions(spark.createDataFrame(_samples(12), SAMPLES))
    ends = time.monotonic() + 20
    while held.storageMemoryUsed() > before + (20 << 20) and time.monotonic() < ends:
        time.sleep(0.2)
    assert held.storageMemoryUsed() <= before + (20 << 20)
