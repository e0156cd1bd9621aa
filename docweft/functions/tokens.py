"""Tokens of Java code and multisets of tokens, as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .expr import let
from .text import text_or_empty

# Fixed values.
KEYWORDS = (
    "abstract assert boolean break byte case catch char class continue default do double else enum extends false final "
    "finally float for if implements import instanceof int interface long native new null package private protected public "
    "record return short static strictfp super switch synchronized this throw throws transient true try void volatile while"
).split()
BEHAVIOUR = "break case catch continue default else false if new null return switch throw true try while".split()
LINK_STOP_WORDS = (
    "a an and arg argument class code data input method object output param parameter result return returns the this value "
    "values string char character sequence array type name"
).split()
CONTRACT_GROUPS = [
    ["null", "nullable", "nonnull", "requirenonnull"],
    ["throw", "throws", "exception", "exceptions", "fail", "fails", "failure"],
    ["timeout", "time", "duration", "instant", "epoch", "millisecond", "milliseconds", "second", "seconds"],
    ["empty", "blank"],
    ["valid", "invalid", "validate", "validation"],
    ["minimum", "maximum", "min", "max", "negative", "positive", "overflow"],
    ["deprecated", "deprecation", "obsolete"],
]
COMMENTS = r"(?s)/\*.*?\*/|//[^\n]*"
TOKEN = (
    r"(?U)\"(?:\\.|[^\"\\])*\"|'(?:\\.|[^'\\])*'|[A-Za-z_$][\w$]*|\d+(?:\.\d+)?|==|!=|<=|>=|&&|\|\||\+\+|--|->|"
    r"[{}()\[\];,.?:+\-*/%<>=!]"
)
IDENTIFIER = r"(?U)\A[a-z_$][\w$]*\z"


def words(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def java_tokens(code: Column) -> Column:
    """Tokens in lower case; comments are taken off first, inside literals too."""
    return F.transform(F.regexp_extract_all(F.regexp_replace(text_or_empty(code), COMMENTS, " "), F.lit(TOKEN), 0), F.lower)


def is_identifier(token: Column) -> Column:
    return token.rlike(IDENTIFIER) & ~token.isin(KEYWORDS)


def _begins(xs: Column, differ: Callable[[Column, Column], Column]) -> Column:
    """Where each run of like elements of a sorted array begins."""
    return F.filter(F.transform(xs, lambda x, i: F.when((i == 0) | differ(F.get(xs, i - 1), x), i)), lambda i: i.isNotNull())


def _ends(xs: Column, begins: Column) -> Column:
    return F.concat(F.slice(begins, 2, F.greatest(F.size(begins) - 1, F.lit(0))), F.array(F.size(xs)))


def identifier_shape(tokens: Column) -> Column:
    """Identifiers renamed by order of first sight (id0, id1, ...), all else kept.

    By sorting: equal tokens form runs with their places, runs of identifiers are numbered by their first place.
    """
    def runs(xs: Column) -> Column:
        def one(a: Column, b: Column) -> Column:
            return F.struct(F.get(xs, a)["i"].alias("first"), F.get(xs, a)["t"].alias("t"), F.transform(F.slice(xs, a + 1, b - a), lambda x: x["i"]).alias("places"))

        return let(_begins(xs, lambda p, x: p["t"] != x["t"]), lambda at: F.zip_with(at, _ends(xs, at), one))

    def renamed(rs: Column) -> Column:
        ids, others = F.array_sort(F.filter(rs, lambda r: is_identifier(r["t"]))), F.filter(rs, lambda r: ~is_identifier(r["t"]))
        named = F.flatten(F.transform(ids, lambda r, k: let(F.concat(F.lit("id"), k.cast("string")), lambda name: F.transform(r["places"], lambda i: F.struct(i.alias("i"), name.alias("t"))))))
        kept = F.flatten(F.transform(others, lambda r: F.transform(r["places"], lambda i: F.struct(i.alias("i"), r["t"].alias("t")))))
        return F.transform(F.array_sort(F.concat(named, kept)), lambda x: x["t"])

    return let(F.array_sort(F.transform(tokens, lambda t, i: F.struct(t.alias("t"), i.alias("i")))), lambda xs: let(runs(xs), renamed))


def multiset_changes(a: Column, b: Column) -> Column:
    """STRUCT(removed, added): ``a`` without as many of each element as ``b`` has, and the reverse; both sorted.

    Both sides are sorted together once, so the work is that of a sort. Elements must not be null.
    """
    def counted(xs: Column) -> Column:
        def one(i: Column, j: Column) -> Column:
            return F.struct(F.get(xs, i)["v"].alias("v"), F.get(xs, i)["s"].alias("s"), (j - i).alias("n"))

        return let(_begins(xs, lambda p, x: (p["v"] != x["v"]) | (p["s"] != x["s"])), lambda at: F.zip_with(at, _ends(xs, at), one))

    def left(rs: Column, side: int, step: int) -> Column:
        def more(r: Column, i: Column) -> Column:
            other = F.get(rs, i + step)
            there = F.when(other["v"] == r["v"], other["n"]).otherwise(0)
            return F.array_repeat(r["v"], F.when(r["s"] == side, F.greatest(r["n"] - there, F.lit(0))).otherwise(0))

        return F.flatten(F.transform(rs, more))

    return let(F.array_sort(F.concat(_sided(a, 0), _sided(b, 1))), lambda xs: let(counted(xs), lambda rs: F.struct(left(rs, 0, 1).alias("removed"), left(rs, 1, -1).alias("added"))))


def _sided(values: Column, side: int) -> Column:
    return F.transform(values, lambda v: F.struct(v.alias("v"), F.lit(side).alias("s")))


def multiset_minus(a: Column, b: Column) -> Column:
    """``a`` without as many of each element as ``b`` has; the rest sorted. Elements must not be null."""
    return multiset_changes(a, b)["removed"]


def split_identifier(name: Column) -> Column:
    """Parts of a name at underscores and inner capitals, in lower case, of two letters or more."""
    spaced = F.regexp_replace(F.replace(name, F.lit("_"), F.lit(" ")), "([a-z0-9])([A-Z])", "$1 $2")
    return F.transform(F.filter(F.split(spaced, r"(?U)\s+"), lambda x: F.length(x) > 1), F.lower)


def code_terms(tokens: Column) -> Column:
    """Words of code: keywords and numbers whole, identifiers in parts, the words inside literals."""
    def terms(t: Column) -> Column:
        none = F.expr("cast(array() as array<string>)")
        return (
            F.when(t.isin(KEYWORDS) | t.rlike(r"(?U)\A\d+(?:\.\d+)?\z"), F.array(t))
            .when(t.rlike(IDENTIFIER), split_identifier(t))
            .when(t.rlike(r"\A[\"']"), F.regexp_extract_all(t, F.lit("[a-z]+"), 0))
            .otherwise(none)
        )

    return F.flatten(F.transform(tokens, terms))


def changed_terms(old: Column, new: Column) -> Column:
    """The distinct words of which one side has more."""
    return let(multiset_changes(old, new), lambda c: F.array_distinct(F.concat(c["removed"], c["added"])))


def parameter_types(parameters: Column) -> Column:
    """Each parameter without ``final``, annotations and its name."""
    def bare(parameter: Column) -> Column:
        tokens = F.filter(F.split(parameter, r"(?U)\s+"), lambda t: (t != "") & (t != "final") & ~F.startswith(t, F.lit("@")))
        return F.array_join(F.when(F.size(tokens) > 1, F.slice(tokens, 1, F.size(tokens) - 1)).otherwise(tokens), " ")

    return F.transform(F.coalesce(parameters, F.expr("cast(array() as array<string>)")), bare)
