"""Column functions: quoted cases, and small plain models on random texts."""

import hashlib
import html
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docweft.functions import html_refs, java_scan, javadoc, messages, paths, summaries, text, tokens


def column(spark, values, f, schema="x string"):
    df = spark.createDataFrame([(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)], "i long, " + schema)
    names = df.columns[1:]
    return [r[1] for r in sorted(df.select("i", f(*[F.col(c) for c in names])).collect())]


PATHS = {
    "src/Kettle.java": True, "kitchen/src/brew/Kettle.java": True, "kitchen\\src\\Pot.java": True, "kitchen//src//brew/Latest.java": True, "kitchen/SRC/Pot.java": True,
    "kitchen/brew/Kettle.java": False, "src/brew/Kettle.kt": False, "kitchen/src/tests/Kettle.java": False, "kitchen-benchmark/src/Kettle.java": False, "android/src/Kettle.java": False, "kitchen/android/src/Kettle.java": True,
    "src/build/Kettle.java": False, "my_generated_code/src/Kettle.java": False, "src/KettleTest.java": False, "src/KettleTests.java": False, "src/TestKettle.java": False, "src/KettleTestCase.java": False, "src/Testing/Pot.java": True,
}


def test_paths(spark):
    assert column(spark, list(PATHS), paths.is_target_path) == list(PATHS.values())
    assert column(spark, ["M\tsrc/A.java\nR100\told.java\tsrc/B.java\nA\tpom.xml", None], paths.changed_paths) == [["src/A.java", "src/B.java"], []]


def test_low_signal_messages(spark):
    yes = ["docs", "DOC: say what a kettle is", "sorted  members of Pot", "Formatting of the pot", "typos, typos", "Boil: refactoring of the lid", "Renamed internal lid", "Remove whitespace here", "Drop the empty line", "imports only", "\n \t\ncleanup of Pot"]
    no = ["Boil twice when the lid is open", " ", None, "Undocumented lid\nformatting", "The doctor boils", "reform of the pot"]
    assert column(spark, yes + no, messages.is_low_signal_message) == [True] * len(yes) + [False] * len(no)


def test_weak_and_dangling_summaries(spark):
    weak = ["Revert", " cleanup ", "CLEAN \t UP", "- update -", "ok", "a b", "...", "", None, "Boil water for", "Pour from :", "or !", "-- into --"]
    sound = ["Boil the water", "Water is what tea is made of.", "from!", "Pour out of?", "The pot holds what it is filled with."]
    assert column(spark, weak + sound, messages.is_weak_issue_summary) == [True] * len(weak) + [False] * len(sound)
    line = ["what tea is made of.", "made with", "made with ?", "made", "WITH", None]
    assert column(spark, line, messages.is_dangling_summary) == [True, True, False, False, True, False]
    assert column(spark, line, messages.ends_with_dangling_word) == [False, True, True, False, True, False]


def test_issue_ids_and_summaries(spark):
    assert column(spark, ["TEA-7: pot (#9), TEA-7 and P2-10; tea-8 A-1", "", None], messages.issue_ids) == [["TEA-7", "#9", "P2-10"], [], []]
    cases = {
        "Boil the water when\nthe lid is shut\n\nas told.": ("Boil the water when the lid is shut", False),
        "The pot now keeps warm by (#12)\n\nDefault of all pots\n\ndefault.": ("The pot now keeps warm by default.", True),
        "TEA-31 pour out of #4": ("TEA-31 pour out of #4", True),
        "TEA-31 pour out of": ("pour out of issue TEA-31", True),
        "Say what each pot is made of.": ("Say what each pot is made of.", False),
        "pour into": ("pour into", True),
        "\n\n  [Pot] : warm - \n": ("Pot] : warm", False),
        "": ("", False),
    }
    got = [tuple(x) for x in column(spark, list(cases), summaries.with_fallback)]
    assert got == list(cases.values())


def test_patch_lines(spark):
    patch = "--- a/x\n+++ b/x\n+ /** doc\n- * more\n context * x\n+  int a;\n"
    assert column(spark, [patch, "+ * only", "+int a;", "+++ int", "", None], paths.has_doc_changes) == [True, True, False, False, False, False]
    assert column(spark, [patch, "+ * only", "+int a;", "+// x", "+   ", None], paths.has_code_changes) == [True, False, True, False, False, False]


def test_line_form_and_fingerprint_follow_a_plain_model(spark):
    rng = random.Random(1)
    alphabet = ["a", "b", " ", "\t", "\n", "\r", "\r\n", "\x0b", "\x0c", "\xa0", "\x85", " ", "​", "\x1c", "é"]
    cases = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) for _ in range(600)] + [None]

    def model(t):
        lines = (t or "").replace("\r\n", "\n").replace("\r", "\n").split("\n")
        return "\n".join(x.rstrip(text.WS_CHARS) for x in lines).strip("\n")

    assert column(spark, cases, text.line_form) == [model(c) for c in cases]
    expected = [hashlib.sha256("␞".join([model(c), model(None)]).encode()).hexdigest() for c in cases]
    assert column(spark, cases, lambda x: text.fingerprint(x, F.lit(None))) == expected


def test_unescape_is_the_standard_librarys(spark):
    rng = random.Random(2)
    parts = ["&", "amp", "lt", ";", "#", "x", "41", "8212", "128", "0", "x1F680", " ", "not", "notit", "NotEqualTilde;", "copy", "D800", "1114112", "99999999999", "\n", "&nbsp;", "&lt;", "&#x2014;"]
    cases = ["".join(rng.choices(parts, k=rng.randint(1, 8))) for _ in range(500)]
    assert column(spark, cases, html_refs.unescape) == [html.unescape(c) for c in cases]


DOCS = [
    ("/**\n * Boils the\n * water.\n */", "/** Boils the water. */", False),
    ("/** Needs pot 2.0.1 or later. */", "/** Needs pot 2.1.0 or later. */", False),
    ("/** Pours.\n * @author a\n * @version 3\n */", "/** Pours.\n * @see Pot\n */", False),
    ("/** Boils water. */", "/** Boils water and keeps it warm until somebody lifts the lid again. */", True),
    ("/** @return a cup */", "/** @return a cup or null */", True),
    ("/** Fills it.\n * @param cup what to fill\n */", "/** Fills it.\n * @param cup what to fill, up to the golden brim\n */", True),
    ("/** Tea &gt; water http://tea.example/x @param pot warm */", "/** pot @param water Tea www.tea.example warm */", False),
    ("/** Odour of the harbour. */", "/** Odor of the harbor. */", False),
]


def test_substantive_changes(spark):
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(DOCS)], "i long, a string, b string")
    told = javadoc.with_substantive(df.select("i", javadoc.semantic_tokens(F.col("a")).alias("a"), javadoc.semantic_tokens(F.col("b")).alias("b")), "a", "b")
    assert [r["substantive"] for r in told.orderBy("i").collect()] == [x for *_, x in DOCS]


def test_semantic_words(spark):
    doc = "/**\n * Fill {@link Pot the old pot} or {@linkplain Cup} with <i>tea</i> &lt; it's TEA-12 hot.\n * @author someone\n * not this\n * @param cups up to 12, 2031-05-06\n */"
    assert column(spark, [doc, None, ""], javadoc.semantic_tokens) == [["fill", "the", "old", "pot", "or", "cup", "with", "tea", "it's", "hot", "param", "cups", "up", "to"], [], []]


def test_format_only_reasons(spark):
    cases = [("/** Boils\n * water */", "/**\n * Boils water\n */"), ("/** Boils <em>hot</em> water; yes */", "/** Boils hot water, yes. */"), ("/** Boils water. */", "/** Boils hot water. */"), (None, "/** */")]
    got = column(spark, cases, javadoc.format_only_reason, "a string, b string")
    assert got == ["whitespace_or_line_wrapping_only", "punctuation_or_html_formatting_only", "", "whitespace_or_line_wrapping_only"]


def test_inheritdoc_and_format_review(spark):
    assert column(spark, ["/** {@INHERITDOC}\n * @version 2 */", "/** @inheritDoc and pours. */", "/** pours */", None], javadoc.is_weak_inheritdoc) == [True, False, False, False]
    assert column(spark, ["/** cup > pot", "tea", "tea \ufffd", None], javadoc.format_review) == [["unclosed_javadoc", "unbalanced_angle_brackets"], [], ["replacement_character"], []]


SNIPPETS = [
    ("Cup pour(Pot pot) {\n    return pot.out();\n}", "method", ""), ("Cup pour() { }\n/** more", "method", "unclosed_javadoc"), ("Cup pour() {\n    fill(a,", "method", "unfinished_ending"), ("int a =", "method", "unfinished_ending"),
    ("Cup pour() {\n" + java_scan.PLACEHOLDER + "\n}", "method", "placeholder_context"), ("Cup pour() {\n  while (hot) {\n  }", "method", "unbalanced_braces"), ("} {", "class", "unbalanced_braces"), ("char end() { return '}'; }", "method", ""),
    ("@Hot Cup pour() { }", "method", "missing_method_signature"), ("@Hot(\"a\")\nCup pour() { }", "method", ""), ("interface Pot { }", "class", ""), ("Cup cup;", "class", "missing_class_declaration"), ("Cup pour() { /* hot", "method", "unclosed_comment"),
    ("Cup pour() { say('x", "method", "unclosed_string"), (None, "method", "empty_code"), (" \n", "class", "empty_code"), ("Cup pour() { }", "field", "unsupported_entity_type"), ("abstract Cup pour();", "method", ""), ("Cup pour() { } Cup cup;", "method", "unfinished_method"), ("record Cup(int a) { } Pot pot;", "class", "unfinished_class"),
]


def test_snippets(spark):
    assert column(spark, [s[:2] for s in SNIPPETS], java_scan.snippet_problem, "a string, b string") == [s[2] for s in SNIPPETS]
    pairs = [("Cup pour() { }", "Cup pour() { fill(); }"), ("enum Tea { GREEN }", "enum Tea { GREEN, BLACK }"), ("tea + 1", "tea"), (None, None), ("class Pot { ", "class Pot { int a;")]
    assert column(spark, pairs, java_scan.infer_type, "a string, b string") == ["method", "class", None, None, "class"]


def _scan(code):
    state, depth, low, i = "", 0, 0, 0
    while i < len(code):
        two, c = code[i : i + 2], code[i]
        if state == "//":
            state = "" if c == "\n" else state
        elif state == "/*":
            if two == "*/":
                state, i = "", i + 1
        elif state:
            if c == "\\":
                i += 1
            elif c == state:
                state = ""
        elif two in ("//", "/*"):
            state, i = two, i + 1
        elif c in "\"'":
            state = c
        elif c in "{}":
            depth += 1 if c == "{" else -1
            low = min(low, depth)
        i += 1
    return depth, low, state == "/*", state in ('"', "'")


def test_brace_scan_follows_a_state_machine(spark):
    rng = random.Random(4)
    cases = ["".join(rng.choice(["{", "}", '"', "'", "\\", "/*", "*/", "//", "\n", "a", "/", "*"]) for _ in range(rng.randint(0, 16))) for _ in range(800)]
    assert [tuple(x) for x in column(spark, cases, java_scan.scan)] == [_scan(c) for c in cases]


def test_dispositions(spark):
    big = "class Pot {\n" + "Cup cup;\n" * 502 + "}"
    cases = [("class Pot { }", "class Pot { {", "class"), ("Cup pour() { }", "Cup pour() { if {", "method"), (big, big, "class"), ("Cup pour() { }", "Cup pour() { fill(); }", "method")]
    got = column(spark, cases, lambda a, b, t: java_scan.disposition(a, b, t, F.lit(False)), "a string, b string, t string")
    assert [tuple(x) for x in got] == [("review", "invalid_class_context:unbalanced_braces"), ("discard", "truncated_code_context:unbalanced_braces"), ("discard", "class_context_too_large"), ("retain", "")]


def test_multisets_and_shapes(spark):
    rng = random.Random(3)
    cases = [([rng.choice("abcd") for _ in range(rng.randint(0, 8))], [rng.choice("abcd") for _ in range(rng.randint(0, 8))]) for _ in range(200)]
    got = column(spark, cases, tokens.multiset_minus, "a array<string>, b array<string>")
    assert got == [sorted((Counter(a) - Counter(b)).elements()) for a, b in cases]
    both = column(spark, cases, tokens.multiset_changes, "a array<string>, b array<string>")
    assert [(x["removed"], x["added"]) for x in both] == [(sorted((Counter(a) - Counter(b)).elements()), sorted((Counter(b) - Counter(a)).elements())) for a, b in cases]
    shape = column(spark, ["pour(cup); cup = pot - 2; // tea"], lambda x: tokens.identifier_shape(tokens.java_tokens(x)))[0]
    assert shape == ["id0", "(", "id1", ")", ";", "id1", "=", "id2", "-", "2", ";"]
    names = [rng.choices(["cup", "pot", "tea", "if", "(", "1"], k=rng.randint(0, 12)) for _ in range(100)]
    order = [[x for x in dict.fromkeys(n) if x in ("cup", "pot", "tea")] for n in names]
    assert column(spark, [(n,) for n in names], tokens.identifier_shape, "x array<string>") == [[f"id{o.index(x)}" if x in o else x for x in n] for n, o in zip(names, order, strict=True)]
    assert column(spark, ["warmPotOf_tea"], tokens.split_identifier) == [["warm", "pot", "of", "tea"]]
    assert column(spark, [(["final Pot pot", "@Hot Cup[] cups", "tea"],)], tokens.parameter_types, "x array<string>") == [["Pot", "Cup[]", "tea"]]


def test_slugs_and_hashes(spark):
    assert column(spark, ["Tea.House/Green-Pot", "--", None, "a  b."], text.slug) == ["tea_house_green_pot", None, None, "a_b"]
    assert column(spark, [" ABC\n", "000", "", None], text.commit_hash) == ["abc", None, None, None]


@pytest.mark.parametrize("pattern", [javadoc.VERSION, javadoc.DATE, javadoc.NUMBER])
def test_patterns_compile_alike(pattern):
    re.compile(pattern.replace("(?iU)", "(?i)").replace("(?U)", ""))
