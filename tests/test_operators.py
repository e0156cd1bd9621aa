"""Operators over rows: deduplication, order, nesting, alignment, classification, quality, merge."""

import random

import pytest
from pyspark.sql import functions as F

from docweft.functions.java_entities import class_context_pair, parse_entities, split_class, without_comments
from docweft.functions.kernels import pairs_by_spelling, ratio
from docweft.functions.text import fingerprint
from docweft.operators import classify, dedup, entities, limits, nest, quality, summarize
from docweft.plans import jobs, mining
from docweft.streaming import dedup as streams

TEXTS = ["code_before", "code_after", "javadoc_before", "javadoc_after"]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_keep_first_and_priority(spark):
    df = spark.createDataFrame([("k", 3, "x"), ("k", 1, "y"), (None, 2, "z"), (None, 5, "w")], "k string, n long, v string")
    assert rows(dedup.keep_first(df, ["k"], ["n"], ["n", "v"]).fillna("-")) == [("-", 2, "z", 2), ("k", 1, "y", 2)]
    data = [(1, "a", "Fix", "old", 0), (2, "a", "Handle null values", "new", 0), (3, "b", "Handle more", "new", 0), (4, "b", "Handle most", "old", 5), (5, "c", "Say this", "old", 9), (6, "c", "Say that", "old", 4)]
    df = spark.createDataFrame(data, "row long, fp string, s string, d string, o long")
    audit = dedup.priority_dedup(df, "fp", dedup.priority_rank(F.col("s"), F.col("d") == "old", F.col("o"), F.col("row")), "row")
    assert rows(audit.where("is_kept").select("fp", "row")) == [("a", 2), ("b", 4), ("c", 6)]
    assert rows(dedup.removed_groups(audit, "fp", "row")) == [("a", 2, 1), ("b", 4, 1), ("c", 6, 1)]


def test_frozen_sets_and_limits(spark):
    new = spark.createDataFrame([("p", "a", 1), ("p", "b", 2), ("p", "b", 3), ("p", None, 4), ("p", "c", 5), ("p", "a", 6)], "p string, k string, n long")
    old = spark.createDataFrame([("a",), (None,), ("a",)], "k string")
    told = dedup.against_frozen(new, old, ["k"], "n")
    assert rows(told.select("n", "outcome")) == [(1, "in_frozen"), (2, "new"), (3, "repeated"), (4, "in_frozen"), (5, "new"), (6, "in_frozen")]
    assert rows(dedup.not_in(new, old, ["k"]).select("n")) == [(2,), (3,), (5,)]
    assert rows(dedup.filter_with_limit(told, "p", "n", 2)) == [("p", 2, 2, 1)]
    assert rows(dedup.filter_with_limit(told, "p", "n", 9)) == [("p", 2, 3, 1)]


def test_sources_in_order(spark):
    counts = spark.createDataFrame([(0, 30), (1, 50), (2, 40), (3, 10)], "priority int, n long")
    assert rows(limits.cumulative_target(counts, "priority", "n", 90).select("priority", "taken")) == [(0, 30), (1, 50), (2, 10)]
    named = spark.createDataFrame([(0, "a/x", "a_x"), (1, "b/x", "b_x"), (2, "c/x", "c_x")], "priority int, name string, slug string")
    assert rows(limits.start_from(named, "b_x", 1).select("slug")) == [("b_x",)]
    with pytest.raises(ValueError):
        limits.start_from(named, "zz")


def test_early_stop(spark):
    flags = [(i, 3, 1) for i in range(40)]
    read = limits.early_stop(spark.createDataFrame(flags, "seq long, uniques long, retained long"), "seq", 12)
    unique, retained, threshold, expected = 0, 0, 12, 0
    for i, u, r in flags:
        unique, retained, expected = unique + u, retained + r, i + 1
        if unique >= threshold:
            if retained >= 12:
                break
            threshold = unique + 10
    assert read.count() == expected


def test_early_stop_runs_over_commits(spark):
    from docweft import catalogue

    folder = "/root/testdata/sf0.001"
    samples = spark.read.parquet(f"{folder}/samples.parquet").select("sample_id", "project_slug", "commit_hash").collect()
    starts = {}
    for i, p, h in sorted(samples):
        starts.setdefault((p, h.lower() if h is not None else i), i)
    got = catalogue.queries()["early_stop_limit"](spark, folder).orderBy("scan_seq").collect()
    assert [r["scan_seq"] for r in got] == sorted(starts.values())[: len(got)] and len(got) > 10
    uniques = retained = 0
    for r in got:
        uniques, retained = uniques + r["uniques"], retained + r["retained"]
        assert (r["unique_total"], r["retained_total"]) == (uniques, retained)


def test_interleaved_order(spark):
    old = spark.createDataFrame([("a", 0), ("b", 1)], "fp string, o long")
    new = spark.createDataFrame([("c", 0), ("d", 1)], "fp string, o long")
    assert [r["fp"] for r in limits.interleaved(old, new, "fp", "o").orderBy("position").collect()] == ["a", "c", "b", "d"]


def _change(order, code, summary="Handle null values", commit="h1", source=None, kind="method"):
    return ("p", commit, "u", summary, source, kind, order, f"{code}0", f"{code}1", f"{code} doc", f"{code} doc new")


CHANGE = "project_slug string, commit_hash string, repository_url string, issue_summary string, issue_summary_source string, entity_type string, source_order long, code_before string, code_after string, javadoc_before string, javadoc_after string"


def test_nesting_and_back(spark):
    data = [_change(5, "x"), _change(2, "y", "Fix"), _change(3, "x "), _change(9, "z", "Other words here", source="issue_title"), _change(1, "w", commit="h2"), *[_change(20 + i, f"v{i}", commit="h3") for i in range(6)]]
    flat = spark.createDataFrame(data, CHANGE).withColumn("fp", fingerprint(*[F.col(c) for c in TEXTS]))
    grouped = {r["commit_hash"]: r for r in nest.group(flat).collect()}
    assert [(c["change_index"], c["code_before"]) for c in grouped["h1"]["changes"]] == [(1, "y0"), (2, "x 0"), (3, "x0"), (4, "z0")]
    assert grouped["h1"]["issue_summary"] == "Other words here" and [c["change_index"] for c in grouped["h3"]["changes"]] == [1, 2, 3, 4, 5, 6]
    assert rows(nest.conflicts(flat).select("commit_hash")) == [("h1",)]
    again = nest.flatten(nest.group(flat).withColumn("row_seq", F.lit(1)), "row_seq")
    assert again.count() == 11


def test_distributions(spark):
    sizes = spark.createDataFrame([(n,) for n in (1, 2, 3, 4, 5, 6, 10, 11, 20, 21, 50, 51)], "size long")
    got = [(r["bucket"], r["groups"]) for r in summarize.bucketed_distribution(sizes).orderBy("bucket_order").collect()]
    assert got == [("1", 1), ("2", 1), ("3", 1), ("4-5", 2), ("6-10", 2), ("11-20", 2), ("21-50", 2), (">50", 1)]
    assert tuple(summarize.size_summary(sizes.where("size < 0")).first()) == (0, 0, 0.0, 0, 0, 0)
    failures = spark.createDataFrame([("p", "h", "git_extract_failed:x"), ("p", "h", "git_extract_failed:x"), ("p", "g", "empty_code")], "project_slug string, commit_hash string, reason string")
    assert rows(summarize.unresolved(failures)) == [("p", "h", ["git_extract_failed:x"])]


SOURCE = """package x;
/** A class. */
@Deprecated
public class Foo {
    /** Runs it. */
    // note
    public List<String> run(int a,
        Map<K, V> m) throws A, B {
        if (a > 0) { return null; }
    }

    /** Makes one. */
    Foo() { }

    /** Held. */
    private static final Foo X = new Foo(1);

    /** Annotated with arguments. */
    @Test(timeout = 3)
    void lost() { }
}
"""


def test_entities_of_a_source():
    got = [(e.entity_type, e.name, e.return_type, e.parameters, e.throws, e.code_start_line, e.code_end_line) for e in parse_entities(SOURCE)]
    assert got[:4] == [
        ("class", "Foo", "", [], [], 3, 21), ("method", "run", "List<String>", ["int a", "Map<K", "V> m"], ["A", "B"], 7, 10), ("method", "Foo", "", [], [], 13, 13), ("field", "X", "Foo", [], [], 16, 16),
    ]
    assert [e.name for e in parse_entities(SOURCE)][4:] == []


def test_class_contexts():
    body = lambda n: "class A {\n" + "".join(f"    int f{i}() {{\n        return {i}; // c\n    }}\n" for i in range(120)) + f"    int g() {{\n        return {n};\n    }}\n}}"
    old, new = class_context_pair(body(1), body(2))
    assert old == "class A {\nint g() {\n        return 1;\n    }\n}" and "return 2" in new
    assert class_context_pair(body(1), body(1)) == ("", "") and class_context_pair("class A {", "class A { }") == ("class A {", "class A { }")
    assert split_class('class A { int a; String s = "}"; void f() { if (a) { } else { } } }') == ("class A {", ["int a;", 'String s = "}";', "void f() { if (a) { } else { } }"])
    assert without_comments('a // x\n"//" /* y\n */ b') == 'a\n"//"\n b'


ENTITY = "file_id long, side string, entity_id long, entity_seq int, entity_type string, name string, parameters array<string>, javadoc string, code_start_line int"


def test_alignment(spark):
    data = [
        (1, "old", 1, 1, "method", "f", ["int a"], "/** Sorts the list of items. */", 10), (1, "old", 2, 2, "method", "f", ["int a"], "/** Closes every open file. */", 20), (1, "new", 3, 1, "method", "f", ["int a"], "/** Closes every open file now. */", 10),
        (1, "new", 4, 2, "method", "f", ["int a"], "/** Sorts the list. */", 20), (1, "old", 5, 3, "method", "f", ["long a"], "x", 30), (1, "new", 6, 3, "method", "f", ["long a"], "y", 31), (1, "new", 7, 4, "method", "g", [], "created", 40),
        (2, "old", 8, 1, "class", "C", None, "same", 5), (2, "old", 9, 2, "class", "C", None, "same", 5), (2, "new", 10, 1, "class", "C", [], "same", 5),
    ]
    got = rows(entities.align(spark.createDataFrame(data, ENTITY)))
    assert got == [(1, 1, 4), (1, 2, 3), (1, 5, 6), (2, 9, 10)]


def test_sequence_kernels():
    assert ratio("a b c d".split(), "a b x d".split()) == 0.75
    long = [f"w{i % 3}" for i in range(240)]
    assert ratio(long, long[1:] + ["z"]) < 0.1
    assert pairs_by_spelling(["colour", "teh"], ["the", "color"]) is False
    assert pairs_by_spelling(["colour"], ["color"]) and not pairs_by_spelling([], []) and not pairs_by_spelling(["a"], ["b", "c"])


PAIR = "pair_id long, code_before string, code_after string, old_javadoc string, new_javadoc string, old_name string, new_name string, entity_type string, params array<string>"


def test_classification(spark):
    plain, contract = "/** Normalizes the value. */", "/** Normalizes the value. Returns empty when the value is null. */"
    data = [
        (1, "String f(String v) {\n return v.trim();\n}", "String f(String v) {\n if (v == null) { return EMPTY; }\n return v.trim();\n}", plain, contract, "f", "f", "method", ["String v"]),
        (2, "return value + 1;", "return renamed + 1;", plain, contract, "f", "f", "method", []),
        (3, "first(); second();", "second(); first();", plain, contract, "f", "f", "method", []),
        (4, "int a() { return 1; }", "int a() { if (x) { throw new Oops(); } return 1; }", "/** Draws a circle. */", "/** Paints blue squares on canvas. */", "a", "a", "method", []),
        (5, "String f(String v) {\n return v.trim();\n}", "String f(String v) {\n if (v == null) { return EMPTY; }\n return v.trim();\n}", plain, contract, "f", "g", "method", ["String v"]),
        (6, "int x = 1;", "int x = null;", plain, contract, "x", "x", "field", []),
        (7, "String f() { return a; }", "String f() { return a; }", plain, contract, "f", "f", "method", []),
    ]
    base = spark.createDataFrame(data, PAIR)
    sides = {f"{s}_{k}": v for s in ("old", "new") for k, v in {"entity_type": F.col("entity_type"), "parameters": F.col("params"), "throws": F.col("params"), "return_type": F.lit(""), "signature": F.lit("f()")}.items()}
    pairs = base.withColumns({**sides, "code_changed": F.col("code_before") != F.col("code_after")})
    assert rows(classify.with_gates(pairs).select("pair_id", "change_type")) == [(1, "code_and_javadoc_change"), (5, "method_rename")]


def test_quality_findings(spark):
    text = "int f() { return 1; }"
    data = [
        (1, "p", "h", "Handle it by", text, text, "/** a */", "/**  a */"), (2, "p", "h", "Handle it well", text, "int f() {", "/** a */", "/** b */"), (3, "p", "h", "Handle it well", text, "int f() {", "/** a */", "/** b */"), (4, "p", None, "Good words here", text, text + " ", "x", "y"),
    ]
    schema = "sample_id long, project_slug string, commit_hash string, issue_summary string, code_before string, code_after string, javadoc_before string, javadoc_after string"
    df = spark.createDataFrame(data, schema)
    got = rows(quality.flat_findings(df, df.where("sample_id = 2")))
    assert got == [
        ("dangling_issue_summary", "1"), ("duplicate_against_baseline", "2"), ("duplicate_against_baseline", "3"), ("duplicate_inside_new", "3"), ("empty_field", "4"), ("identical_code", "1"), ("identical_javadoc", "1"), ("invalid_code_after", "2"), ("invalid_code_after", "3"),
    ]
    assert not quality.passed(quality.flat_findings(df, df.limit(0))) and quality.passed(quality.flat_findings(df.limit(0), df))


def test_merge_job(spark):
    method = "int f() {\n    return %d;\n}"
    data = [
        (1, 0, "p", "h1", "Fix", method % 1, method % 2, "/** Gives one. */", "/** Gives two. */"), (2, 1, "p", "h1", "Handle all the values", method % 1 + "\n", method % 2, "/** Gives one. */", "/** Gives two. */"),
        (3, 1, "p", "h2", "Fix", method % 3, method % 4, "/** Three is it. */", "/** Four is it. */"), (4, 1, "p", "h3", "Fix", method % 5, method % 6, "/** Five. */", "/** Six. */"),
        (5, 1, "p", "h1", "Keep the words", method % 7, method % 7, "/** a */", "/** b */"), (6, 1, "p", "h1", "Keep the words", method % 7, method % 8, "/** a */", "/** <b>a</b>. */"), (7, 1, "p", None, "Keep", method % 7, method % 9, "/** a */", "/** c */"), (8, 1, "p", "h1", "Keep the words", "x", "y", "/** a */", "/** c */"),
    ]
    schema = "sample_id long, batch_id int, project_slug string, commit_hash string, issue_summary string, code_before string, code_after string, javadoc_before string, javadoc_after string"
    samples = spark.createDataFrame(data, schema).withColumn("repo", F.lit("u"))
    commits = spark.createDataFrame([(1, "P", "H2", "\nRepair the broken parser\n\nbody"), (2, "p", "h3", "Update")], "commit_seq long, project_slug string, commit_hash string, message string")
    parts = jobs.merge_and_clean(samples, commits)
    s = parts["summary"].first().asDict()
    assert (s["raw_changes"], s["duplicates_removed"], s["identical_code"], s["format_only"], s["invalid_schema_or_empty_field"], s["unknown_entity_type"]) == (8, 1, 1, 1, 1, 1)
    assert (s["repaired_from_subject"], s["weak_unresolved"], s["commits"], s["changes"]) == (1, 1, 2, 2)
    assert rows(parts["nested"].select("commit_hash", "issue_summary")) == [("h1", "Handle all the values"), ("h2", "Repair the broken parser")]
    assert rows(parts["unresolved"].select("sample_id")) == [(4,)] and parts["findings"].isEmpty()


def test_continuation(spark):
    row = lambda p, n, o: (p, *[f"{n}{i}" for i in range(6)], o)
    schema = "project_slug string, " + ", ".join(f"{c} string" for c in mining.SIX) + ", source_order long"
    new = spark.createDataFrame([row("p", "base1", 5), row("p", "new1", 6), row("p", "new1", 7), row("p", "got1", 8), row("p", "new2", 9)], schema)
    kept, counts = mining.continuation(new, new.where("source_order = 5"), new.where("source_order = 8"), 1)
    assert rows(kept.select("source_order")) == [(6,)] and tuple(counts.first()) == (1, 1)


def test_stream_keeps_first_contents(spark, tmp_path):
    schema = "t timestamp, " + ", ".join(f"{c} string" for c in TEXTS)
    from datetime import datetime

    rng = random.Random(1)
    data = [(datetime(2030, 1, 1, rng.randint(0, 5)), f"a{i % 7}", "b", "c", "d  \n") for i in range(40)]
    spark.createDataFrame(data, schema).repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    seen = []
    streams.run_available(streams.first_contents(stream, "t"), lambda df, _: seen.extend(df.select("code_before").collect()), str(tmp_path / "state"))
    assert sorted(r[0] for r in seen) == [f"a{i}" for i in range(7)]


def test_running_sums_over_many_partitions(spark):
    from docweft.operators import running

    rng = random.Random(8)
    data = [(rng.choice(["hot", "hot", "hot", "b", None]), i, rng.randint(0, 3)) for i in range(500)]
    df = spark.createDataFrame(data, "g string, i long, v long").repartition(5)
    got = {(r["g"], r["i"]): (r["s"], r["n"]) for r in running.numbered(running.running_sum(df, ["g"], ["i"], F.col("v"), "s"), [], ["i"], "n").collect()}
    sums = {}
    for n, (g, i, v) in enumerate(data, 1):
        sums[g] = sums.get(g, 0) + v
        assert got[g, i] == (sums[g], n)


def test_issue_titles(spark):
    from docweft.operators import issues

    commits = spark.createDataFrame([(1, "p", "Fix AB-1 and #2\n\nx", ["AB-1", "#2"]), (2, "p", "Repair it (AB-3)", ["AB-3"]), (3, "p", "Plain words", [])], "commit_seq long, project_slug string, message string, issue_ids array<string>")
    titles = spark.createDataFrame([("p", "AB-1", "Pull title", "pull_request"), ("p", "#2", "Issue title", "github_issue"), ("p", "AB-3", "AB-3", "jira_issue"), ("p", "AB-3", None, "jira_issue"), ("q", "AB-3", "Other", "jira_issue")], "project_slug string, issue_id string, title string, source string")
    assert rows(issues.resolve(commits, titles)) == [(1, "#2", "Issue title"), (2, "AB-3", "Repair it"), (3, "", "Plain words")]


def test_recovery(spark):
    from docweft.plans import recover

    nested = spark.createDataFrame([(1, "P/x", "u", "AB", "Say it well", [(1, "method", "a", "b", "c", "d"), (2, "method", "e", "f", "g", "h")])], "row_seq long, project_slug string, repository_url string, commit_hash string, issue_summary string, changes array<struct<change_index:int,entity_type:string,code_before:string,code_after:string,javadoc_before:string,javadoc_after:string>>")
    assert rows(recover.targets(nested, 2)) == [("p_x", "ab", 2, "Say it well")]
    data = [(1, 10, "p", "h", "method", "", "a", "b", "c", "d \n"), (1, 11, "p", "h", "method", "", "n", "m", "o", "p"), (1, 12, "p", "h", "method", "", "n ", "m", "o", "p"), (1, 13, "p", "h", "method", "format_only_javadoc", "x", "y", "z", "w")]
    reasons = spark.createDataFrame(data, "file_id long, new_id long, project_slug string, commit_hash string, new_entity_type string, reason string, code_before string, code_after string, javadoc_before string, javadoc_after string")
    parts = recover.merge_recovered(recover.flat_changes(nested), reasons)
    assert rows(parts["audit"]) == [("in_frozen", 1), ("new", 1), ("repeated", 1)]
    summary = recover.report(reasons, parts).first().asDict()
    assert (summary["raw_recovered"], summary["format_only"], summary["new_changes"], summary["commits"], summary["changes"]) == (3, 1, 1, 2, 3)
