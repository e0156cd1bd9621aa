"""Operators over texts: functions, markup, tokens, leaked passages, shared spans."""

import random
import re
import time

import numpy as np
import pytest

from docweft.llm import function_docs, leakage, markup, pages, shared_spans, tokenizer

SOURCE = '''package x;

public class Outer<T> {
    private Runnable r = () -> { helper("}"); };
    private int[] a = {1, 2};

    /**
     * Counts how many open items remain.
     */
    // a note
    @Timed(value = "a{", unit = X)
    public <K, V extends Comparable<K>> int count(Map<K, V> m, int[] b) throws E {
        /** Inside a body nothing counts at all here. */
        class Local { void hidden() { } }
        return '}' == '{' ? 1 : 2;
    }

    /** Not attached because of the block comment below it. */
    /* breaks */
    void loose() { }

    /** Builds one outer thing from its parts. */
    Outer(int x) { }

    /** No body is here for this function. */
    abstract void none();

    enum Kind {
        A, B;

        /** Tells whether this kind holds any water. */
        boolean wet()
        {
            return true;
        }
    }

    int value() default 3;

    /** Gives the cut off result to all callers. */
    int cut() {
        if (a) {
'''


def test_functions_of_a_source():
    got = {name: (SOURCE.count("\n", 0, at) + 1, doc) for name, at, doc in function_docs.functions(SOURCE)}
    assert set(got) == {"count", "loose", "Outer", "wet"}
    assert got["count"][0] == 12 and got["count"][1].startswith("/**\n     * Counts")
    assert got["loose"][1] is None and got["wet"][0] == 32


@pytest.mark.parametrize(
    ("doc", "name", "trivial"),
    [
        ("/** Returns the cached item quickly. */", "load", False),
        ("/** Load the order items. @param a not counted here at all */", "loadOrderItems", True),
        ("/** {@inheritDoc} */", "f", True),
        ("/** &nbsp; <p></p> */", "f", True),
        ("/** <b>One</b> {@code two} &lt;three {@link Four#five six} */", "f", False),
        ("/**\n * @return nothing counts after a tag\n */", "f", True),
        (None, "f", True),
    ],
)
def test_trivial_documentation(doc, name, trivial):
    assert function_docs.is_trivial(doc, name) == trivial


def test_function_pairs(spark):
    samples = spark.createDataFrame(
        [
            (1, "method", "run", "@A(x = 1)\nvoid run() { go(); }", "/** Starts all of the waiting engines. */"), (2, "method", "run", "void run() { go();", "/** Starts all of the waiting engines. */"),
            (3, "class", "Outer", SOURCE, None), (4, "method", "run", None, "/** Starts all of the waiting engines. */"), (5, None, "run", "void run() { }", "x"), (6, "method", "run", "void run() { }", ""),
        ],
        "sample_id long, entity_type string, entity_name string, code_after string, javadoc_after string",
    )
    text = "class A {\r\n  /** d */\r\n  @B\r\n  int get() {\r\n    return 1;\r\n  }\r\n}\r\n"
    files = spark.createDataFrame([(1, None, text)], "file_id long, old_content string, new_content string")
    doc = "/** Gives back what was stored before. */"
    entity = "entity_id long, file_id long, side string, entity_type string, name string, javadoc string, start_line int, end_line int, code_start_line int, code_end_line int"
    entities = spark.createDataFrame(
        [(10, 1, "new", "method", "get", doc, 2, 2, 3, 6), (11, 1, "old", "method", "get", doc, 2, 2, 3, 6), (12, 1, "new", "method", "get", None, 2, 2, 3, 6), (13, 1, "new", "class", "A", doc, 1, 7, 1, 7), (14, 1, "new", "method", "get", doc, 2, 2, 3, 99)],
        entity,
    )
    got = {(r[0], r[1], r[2], r[3]) for r in function_docs.found(samples, entities, files).collect()}
    assert got == {("samples", 1, "run", 2), ("samples", 3, "count", 12), ("samples", 3, "Outer", 23), ("samples", 3, "wet", 32), ("entities", 10, "get", 4)}


MARKED = [
    "a <b>bold</b> move", "<UL><LI>x</LI></UL>", "one<br/>two", "x &lt; y", "it &#8212; is", "{@code x}", "<!-- note -->", "**strong** word", "a `name` here", "see [it](docs/a.md)", "![a](b.png)",
    "end.\n * ## Heading", "Title\n * -----", "* | a | b |\n * | --- | --- |", "text.\n * - first", "A _very good_ one", "a __very good__ one", "~~gone~~ now", "an *idle* one", "h2. Title", "== Title ==",
    "'''bold''' x", "''slanted'' x", "[[Page|label]]", "{{monospace x}}", "{{{x(1)}}}", "{code}\nx\n{code}", "{color:red}x{color}", "a \\textbf{b}", "so \\[ x \\] y", "is $\\frac{a}{b}$ long", "$$ x^{2} $$", "as \\sum_{k=1}^{n} a", "{\\bf x}",
    "```java\nx\n```", "done.\n * > quoted text",
]
PLAIN = [
    "the range [0, n), so a < b holds", "Passes {name} placeholder, e.g. 'x' -> 9", "The a_b_ hook and the _x field, if x <= 2 & y >= 2.", "costs $20 per item, $44 each, or 5%", "In C# and R&D builds", "keys a.b[0] = 'c' or {0} win over #top",
    "The --a-b flag and max_b_size", "An int[][] of 4 * 5 * 6 cells; i <- j means i |= j.", "a * b + c, where a > 0 && b >= 4", "Writes to C:\\temp\\item\\new unless /var/a", "A Map<String, Long> or List<A> of flags", "Reads $HOME/a.cfg (see #5)",
    "where a\n * > 0 && b", "computes a\n * + b for each", "plain (words) and \"quotes\"", "@param x the value\n * @return y", "...", "Comparable<S>", "the <name> given", "i.e. 5 - 3\n * - 2 left",
]


def test_markup_is_told_from_what_looks_like_it(spark):
    docs = [(i, f"/**\n * {t}\n */", None) for i, t in enumerate(MARKED + PLAIN)]
    df = spark.createDataFrame([*docs, (900, None, ""), (901, "/** */", "/** x &amp; y */")], "sample_id long, javadoc_before string, javadoc_after string")
    got = {(r["sample_id"], r["field"]) for r in markup.found(df).collect()}
    missed = [t for i, t in enumerate(MARKED) if (i, "javadoc_before") not in got]
    wrong = [t for i, t in enumerate(PLAIN, len(MARKED)) if (i, "javadoc_before") in got]
    assert not missed and not wrong and (901, "javadoc_after") in got and (900, "javadoc_after") not in got


def test_markup_becomes_clean_text(spark):
    doc = "/**\n * <p>Use <code>a&lt;b</code> &amp; {@code List<X>}.</p>\n * <ol><li>one<li>two</ol>\n * <pre>\n *   x = 1;\n * </pre>\n * <h3>Head</h3>\n * See {@link Foo#bar(int) the label} or {@link #baz}; $\\frac{a}{b}$ and **bold**.\n */"
    df = spark.createDataFrame([(1, doc, "/**\n * Plain a < b.\n */")], "sample_id long, javadoc_before string, javadoc_after string")
    got = {r["field"]: r["clean_text"] for r in markup.cleaned(df).collect()}
    text = got["javadoc_before"]
    for piece in ("Use `a<b` & `List<X>`.", "1. one", "2. two", "```\nx = 1;\n```", "### Head", "See the label or baz; $\\frac{a}{b}$ and bold."):
        assert piece in text
    assert "<" not in re.sub("`[^`]*`", "", text) and got["javadoc_after"] == "Plain a < b."


LONG_SPANS = {
    "`" + "call(a, b) and " * 200 + "c`": "markdown_code", "**" + "bold " * 900 + "x**": "markdown_strong", "[x](" + "a/" * 900 + ")": "markdown_link", "\\[ " + "x + " * 900 + "y \\]": "latex_math",
    "$x_" + "1 + " * 900 + "2$": "latex_math", "$$" + "x^2 + " * 900 + "y$$": "latex_math", "an *" + "idle\n" * 900 + "one*": "markdown_emphasis", "{{" + "x " * 900 + "}}": "wiki_braces", "[[" + "Page " * 900 + "]]": "wiki_link",
    "'''" + "bold " * 900 + "x'''": "wiki_quotes", "~~" + "gone " * 900 + "x~~": "markdown_strike", "a _" + "very " * 900 + "good_ one": "markdown_emphasis",
}


@pytest.mark.parametrize("text", LONG_SPANS, ids=range(len(LONG_SPANS)))
def test_spans_of_any_length_are_told_and_converted(text):
    assert markup.kinds(text) == [LONG_SPANS[text]]
    kept = text[0] == "`" or text.startswith("$x")  # what is written in the notation of clean text already
    assert (markup.clean(text) == text) == kept


@pytest.mark.parametrize("mark", ["*", "_", "`", "$", "~~", "[", "{{", "{{{", "''", "\\[", "\\(", "**", "{code}"])
def test_marks_that_never_close_take_no_time(mark):
    began = time.time()
    markup.kinds((mark + "a b ") * 20_000)
    assert time.time() - began < 20


def test_common_lines_are_a_longest_common_subsequence():
    rng = random.Random(3)
    for _ in range(300):
        a, b = ([rng.choice(["x", "y", "z", "w", " ", ""]) for _ in range(rng.randint(0, 12))] for _ in range(2))
        got = pages.common_lines(a, b)
        one, two = ([x for x in t if x.strip()] for t in (a, b))
        best = [[0] * (len(two) + 1) for _ in range(len(one) + 1)]
        for i, x in enumerate(one):
            for j, y in enumerate(two):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert len(got) == best[-1][-1] and got == sorted(set(got))
        rest = iter(two)
        assert all(a[i] in rest for i in got)


def test_pages_lose_the_lines_of_their_nearest_neighbour(spark):
    schema = "id long, host string, path string, text string"
    data = [(1, "h", "/a/b/x", "menu\none\nfoot"), (2, "h", "/a/b/y", "menu\ntwo\nfoot"), (3, "h", "/c/z", "menu\nthree"), (4, "other", "/a/b/x", "menu\none\nfoot"), (5, "h", "/c", None)]
    got = {r["id"]: (r["other"], r["lines"], r["shared"], r["text"]) for r in pages.differenced(spark.createDataFrame(data, schema)).collect()}
    assert got == {1: (2, 3, 2, "one"), 2: (1, 3, 2, "two"), 3: (5, 2, 0, "menu\nthree"), 4: (None, 3, 0, "menu\none\nfoot"), 5: (3, 0, 0, "")}
    many = spark.range(2000).selectExpr("id", "'h' as host", "format_string('/d/%04d/%s', id div 2, if(id % 2 = 0, 'a', 'b')) as path", "'t' as text")
    assert all(r["other"] == r["id"] ^ 1 for r in pages.nearest_pages(many).collect())


tokenizers = pytest.importorskip("tokenizers")
TEXTS = [
    None, "", " ", "Hello, world! it's we'll I'VE", "a" * 300, " " * 200 + "x", "日本語のテキストと emoji 👩‍👩‍👧 naïve", "tab\tnew\r\n\r\nline  two   spaces ", "<|endoftext|> is text", "\x00\x01\x1c\x85\xa0 ctrl", "ab" * 400, "x1y2_z3.foo(bar[0]);//--==",
]


def test_encoding_equals_the_library_and_decodes(spark):
    library = tokenizers.Tokenizer.from_file(f"{tokenizer.TOKENIZERS}/{tokenizer.VOCABULARY}.json")
    library.encode_special_tokens = True
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choice("ab \n'st1é漢_.😀") for _ in range(rng.randint(1, 60))) for _ in range(60)]
    df = spark.createDataFrame([*enumerate(texts), (None, "no id"), (3, texts[3])], "doc_id long, text string")
    encoded = tokenizer.encode(df).cache()
    assert encoded.count() == len(texts) + 2 and encoded.where("doc_id = 3").count() == 2
    got = {r["doc_id"]: r["ids"] for r in encoded.collect()}
    for i, t in [*enumerate(texts), (None, "no id")]:
        assert got[i] == library.encode(t or "", add_special_tokens=False).ids, t
    back = {r["doc_id"]: r["text"] for r in tokenizer.decode(encoded).collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(texts))


def test_every_single_piece_encodes_to_itself():
    vocabulary, words, _, _ = tokenizer.tables(tokenizer.TOKENIZERS, tokenizer.VOCABULARY)
    assert len([w for w in words.split(tokenizer.SEPARATOR) if w]) > 49_000
    assert all(vocabulary.encode(piece) == [rank] for rank, piece in list(vocabulary.pieces.items())[::37])


def _words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def test_leaked_passages_equal_brute_force(spark):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(300)] + ["Ärger", "ÉTÉ", "naïve"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(5, 40)))) for i in range(30)]
    docs = []
    for i in range(120):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 80))]
        if i % 3 == 0:
            source = _words(items[i % 30][1])
            a = rng.randrange(len(source))
            words[rng.randint(0, len(words)) : 0] = [w.upper() for w in source[a : a + rng.randint(8, 16)]]
        docs.append((i, rng.choice([" ", "\n * ", ", "]).join(words)))
    docs += [(500, None), (501, ""), (502, "a " * 3000), (503, items[0][1] + " " + "z " * 20000 + items[1][1])]
    items += [(100, None), (101, "a " * 30), (102, "")]
    grams = {i: {tuple(_words(t)[k : k + 12]) for k in range(len(_words(t)) - 11)} for i, t in items}
    expected = {(d, i) for d, t in docs for w in [{tuple(_words(t)[k : k + 12]) for k in range(len(_words(t)) - 11)}] for i in grams if grams[i] & w}
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {tuple(r) for r in leakage.found(df, it).collect()} == expected and expected


def test_longest_stretch_is_not_hidden_by_a_wider_one_with_unequal_ends():
    def stretch(*runs):
        return np.concatenate([np.full(n, k % 2 == 0) for k, n in enumerate(runs)])

    assert leakage._longest(stretch(18, 3, 8, 1, 4, 1, 5), 2) == (19, 2)
    rng = np.random.default_rng(3)
    for _ in range(200):
        equal = rng.random(rng.integers(1, 25)) < 0.7
        n = len(equal)
        all_ = [(b - a + 1, -int((~equal[a : b + 1]).sum())) for a in range(n) for b in range(a, n) if equal[a] and equal[b]]
        length, cost = max([x for x in all_ if x[1] >= -2], default=(0, 0))
        assert leakage._longest(equal, 2) == (length, -cost)


def test_leakage_in_blocks_and_with_substitutions(spark, monkeypatch):
    item = " ".join(f"w{i}" for i in range(30))
    changed = item.replace("w7 ", "other ").replace("w20 ", "word ")
    df = spark.createDataFrame([(1, changed), (2, item)], "doc_id long, text string")
    it = spark.createDataFrame([(1, item), (2, item.upper()), (3, "short")], "item_id long, text string")
    monkeypatch.setattr(leakage, "MOST_WORDS", 20)
    got = {(r[0], r[1]): (r[2], r[3], r[4]) for r in leakage.overlaps(df, it).collect()}
    assert got == {(1, 1): (12, 30, 2), (1, 2): (12, 30, 2), (2, 1): (30, 30, 0), (2, 2): (30, 30, 0)}


def test_a_vocabulary_of_ranks_alone(spark):
    import base64
    from pathlib import Path

    import tiktoken

    name = "byte_bpe_multi_50k"
    lines = Path(tokenizer.TOKENIZERS, f"{name}.tiktoken").read_bytes().split(b"\n")
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x)}
    pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    texts = ["Hello, world! it's", "日本語 naive café", "x1y2_z3.foo(bar[0]);", "", None, "Привет мир"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["ids"] for r in tokenizer.encode(df, name=name).collect()}
    assert got == {i: library.encode_ordinary(t or "") for i, t in enumerate(texts)}


def test_ids_that_a_packed_merge_cannot_hold_are_refused(tmp_path):
    import base64

    rows = [base64.b64encode(bytes([b])) + b" %d" % b for b in range(256)] + [base64.b64encode(b"ab") + b" %d" % tokenizer.MOST_IDS]
    (tmp_path / "big.tiktoken").write_bytes(b"\n".join(rows))
    with pytest.raises(ValueError):
        tokenizer.Vocabulary(str(tmp_path), "big")


@pytest.mark.parametrize("in_parts", [False, True])
def test_shared_spans_equal_brute_force(spark, monkeypatch, in_parts):
    if in_parts:  # a sketch of many blocks, one of them broadcast at a time
        monkeypatch.setattr(shared_spans, "LOAD", 1 << 13)
        monkeypatch.setattr(shared_spans, "SKETCH_BYTES", 1)
    rng = random.Random(4)
    make = lambda n: "".join(rng.choice("abcdef é漢\n") for _ in range(n))
    docs = [(i, make(rng.randint(0, 120))) for i in range(40)]
    for i in range(0, 40, 4):
        piece = docs[i][1][10 : 10 + rng.randint(20, 50)]
        docs.append((100 + i, make(15) + piece + make(9)))
    docs.append((205, docs[8][1]))  # one id with two texts
    docs += [(200, docs[3][1]), (201, None), (202, ""), (203, "x" * 500), (204, "x" * 29), (205, "x" * 31)]
    span = 30
    seen = {}
    for d, t in docs:
        for k in range(len(t or "") - span + 1):
            seen.setdefault(t[k : k + span], set()).add(d)
    expected = {d for s in seen.values() if len(s) > 1 for d in s}
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r[0] for r in shared_spans.found(df, span, 10).collect()} == expected and expected
    report = {r["doc_id"]: r for r in shared_spans.shared_report(df, span, 10).collect()}
    for d, t in docs:
        covered = set()
        for k in range(len(t or "") - span + 1):
            if len(seen[t[k : k + span]]) > 1:
                covered.update(range(k, k + span))
        if d != 205:
            assert report[d]["shared_chars"] == len(covered) and report[d]["n_chars"] == len(t or "")


def test_spans_across_slices(spark, monkeypatch):
    from docweft.llm import kernels

    monkeypatch.setattr(kernels, "SLICE", 64)
    rng = random.Random(6)
    a = "".join(rng.choice("abcdefgh") for _ in range(400))
    df = spark.createDataFrame([(1, a), (2, "zz" + a[180:240]), (3, "other " * 20)], "doc_id long, text string")
    assert {r[0] for r in shared_spans.found(df, 40, 12).collect()} == {1, 2, 3} - {3}
