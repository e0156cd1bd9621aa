"""Normal forms of documentation comments, and whether a change of a comment says something new.

Lines end at a line feed only. Null counts as empty everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .expr import let
from .html_refs import unescape
from .kernels import seq_ratio, spelling_only
from .text import WS, line_form, strip, text_or_empty, unix_lines
from .tokens import multiset_changes

# Fixed values.
IGNORED_TAGS = ["@see", "@since", "@version", "@author"]
UNINFORMATIVE = ["a", "an", "and", "or", "the", "this", "that", "method", "class", "function"]
CONTRACT_TERMS = [
    "allow", "allowed", "blank", "default", "deprecated", "deprecation", "empty", "epoch", "exception", "fail", "fails",
    "invalid", "milliseconds", "nonnull", "null", "nullable", "overflow", "seconds", "throw", "throws", "timeout", "valid",
]
FORMAT_TAG = r"(?i)</?(?:p|br|b|i|em|strong|code|pre|ul|ol|li|blockquote|span)\b[^>]*>"
URL = r"(?iU)(?:https?://|www\.)\S+"
ISSUE = r"(?iU)(?:#|[A-Z][A-Z0-9]+-)\d+\b"
VERSION = r"(?iU)\bv?\d+(?:\.\d+){1,}(?:[-._][a-z0-9]+)?\b"
DATE = r"(?U)\b(?:\d{4}[-/]\d{1,2}[-/]\d{1,2}|\d{1,2}[-/]\d{1,2}[-/]\d{2,4}|(?:19|20)\d{2})\b"
NUMBER = r"(?U)\b\d+(?:[._-]\d+)*\b"


def content_lines(doc: Column) -> Column:
    """The comment's lines without frame, blank lines dropped, white space collapsed."""
    def bare(line: Column) -> Column:
        opened = strip(F.regexp_replace(strip(line), r"\A/\*\*", ""))
        closed = strip(F.regexp_replace(opened, r"\*/\z", ""))
        return strip(F.regexp_replace(strip(F.regexp_replace(closed, r"\A\*", "")), f"{WS}+", " "))

    return F.filter(F.transform(F.split(unix_lines(text_or_empty(doc)), "\n"), bare), lambda x: x != "")


def doc_text(doc: Column) -> Column:
    return F.array_join(content_lines(doc), "\n")


def layout_form(doc: Column) -> Column:
    """Equal for comments that differ in wrapping and white space only."""
    return F.array_join(content_lines(line_form(doc)), " ")


def format_form(doc: Column) -> Column:
    """Equal for comments that differ in punctuation and markup only."""
    return format_form_of(layout_form(doc))


def format_form_of(layout: Column) -> Column:
    plain = F.regexp_replace(layout, FORMAT_TAG, " ")
    plain = F.regexp_replace(plain, "<[^>]+>", " ")
    plain = F.regexp_replace(plain, rf"\{{@([a-zA-Z]+){WS}+([^}}]*)\}}", "$1 $2")
    return F.array_join(F.regexp_extract_all(F.lower(plain), F.lit("@?[A-Za-z0-9_$]+"), 0), " ")


def format_only_reason(old: Column, new: Column) -> Column:
    """Why a change of a comment is one of form only; empty if it is not."""
    def told(x: Column) -> Column:
        return (
            F.when(x["a"] == x["b"], "whitespace_or_line_wrapping_only")
            .when(format_form_of(x["a"]) == format_form_of(x["b"]), "punctuation_or_html_formatting_only")
            .otherwise("")
        )

    return let(F.struct(layout_form(old).alias("a"), layout_form(new).alias("b")), told)


def core_text(doc: Column) -> Column:
    """Content lines without the blocks of tags that only refer (see, since, version, author), joined by spaces."""
    start = F.struct(F.expr("cast(array() as array<string>)").alias("kept"), F.lit(False).alias("skip"))

    def fold(state: Column, line: Column) -> Column:
        tag = F.lower(F.regexp_extract(line, r"(?U)\A(@\w+)\b", 1))
        skip = F.when(tag != "", tag.isin(IGNORED_TAGS)).otherwise(state["skip"])
        return F.struct(F.when(skip, state["kept"]).otherwise(F.concat(state["kept"], F.array(line))).alias("kept"), skip.alias("skip"))

    return F.array_join(F.aggregate(content_lines(doc), start, fold, lambda s: s["kept"]), " ")


def semantic_tokens_of(core: Column) -> Column:
    """Lower-case words of unescaped core text; addresses, ids, versions, dates, tags and numbers are left out."""
    text = F.regexp_replace(core, r"(?U)\{@(?:link|linkplain)\s+([^}\s]+)\}", "$1")
    text = F.regexp_replace(text, r"(?U)\{@(?:link|linkplain)\s+(?:[^}\s]+)\s+([^}]+)\}", "$1")
    for pattern in (URL, ISSUE, VERSION, DATE, "<[^>]+>", NUMBER):
        text = F.regexp_replace(text, pattern, " ")
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z]+(?:'[a-z]+)?"), 0)


def semantic_tokens(doc: Column) -> Column:
    """The words by which two comments are compared."""
    return semantic_tokens_of(let(core_text(doc), unescape))


def doc_similarity(old: Column, new: Column) -> Column:
    """Sequence ratio of the semantic words, in a Python kernel."""
    return seq_ratio(semantic_tokens(old), semantic_tokens(new))


def _effective(tokens: Column) -> Column:
    return F.filter(tokens, lambda x: ~x.isin(UNINFORMATIVE))


def substantive_change(old: Column, new: Column) -> Column:
    """STRUCT(verdict, removed, added) of two token arrays.

    ``verdict`` is 'yes', 'no', 'spelling' (as many words went as came: yes unless by spelling alone) or
    'ratio' (one word: yes below a similarity of 0.9). The last two need a kernel, the first two do not.
    """
    def judge(x: Column) -> Column:
        a, b, removed, added = x["a"], x["b"], x["removed"], x["added"]
        changed = F.size(removed) + F.size(added)
        verdict = (
            F.when(F.sort_array(x["old"]) == F.sort_array(x["new"]), "no")
            .when((F.size(a) == 0) | (F.size(b) == 0), F.when(F.greatest(F.size(a), F.size(b)) >= 3, "yes").otherwise("no"))
            .when(changed == 0, "no")
            .when((changed == 1) & F.arrays_overlap(F.concat(removed, added), F.array(*map(F.lit, CONTRACT_TERMS))), "yes")
            .when(changed >= 2, F.when((F.size(removed) != F.size(added)) | (F.size(removed) == 0), "yes").otherwise("spelling"))
            .otherwise("ratio")
        )
        return F.struct(verdict.alias("verdict"), removed.alias("removed"), added.alias("added"))

    def differences(x: Column) -> Column:
        names = ("old", "new", "a", "b")
        return let(multiset_changes(x["a"], x["b"]), lambda c: let(F.struct(*[x[n].alias(n) for n in names], c["removed"].alias("removed"), c["added"].alias("added")), judge))

    # All that comes from outside enters in the outermost value: a kernel's result must not end up inside a lambda.
    outer = F.struct(old.alias("old"), new.alias("new"))
    return let(outer, lambda x: let(F.struct(x["old"].alias("old"), x["new"].alias("new"), _effective(x["old"]).alias("a"), _effective(x["new"]).alias("b")), differences))


def with_substantive(rows: DataFrame, old: str, new: str) -> DataFrame:
    """``rows`` with ``substantive``: whether the change between two token arrays is more than spelling, filler words or a touch."""
    told = rows.withColumn("_s", substantive_change(F.col(old), F.col(new)))
    spelling, close = F.col("_s.verdict") == "spelling", F.col("_s.verdict") == "ratio"
    minor = spelling_only(F.when(spelling, F.col("_s.removed")), F.when(spelling, F.col("_s.added")))
    score = seq_ratio(F.when(close, F.col(old)), F.when(close, F.col(new)))
    scored = told.withColumns({"_minor": minor, "_ratio": score})
    verdict = F.when(spelling, ~F.col("_minor")).when(close, F.col("_ratio") < 0.9).otherwise(F.col("_s.verdict") == "yes")
    return scored.withColumn("substantive", verdict).drop("_s", "_minor", "_ratio")


def is_weak_inheritdoc(new: Column) -> Column:
    """The new comment inherits and says nothing else."""
    doc = text_or_empty(new)
    mark = r"(?iU)\{@inheritDoc\}|@inheritDoc\b"
    return doc.rlike(mark) & (F.size(semantic_tokens(F.regexp_replace(doc, mark, " "))) == 0)


def format_review(doc: Column) -> Column:
    """Reasons to look at a comment again: replacement character, no end, unequal angle brackets."""
    text = text_or_empty(doc)
    bare = strip(text)
    count = lambda mark: F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))
    return F.array_compact(
        F.array(
            F.when(F.contains(text, F.lit("\ufffd")), "replacement_character"),
            F.when(F.startswith(bare, F.lit("/**")) & ~F.endswith(bare, F.lit("*/")), "unclosed_javadoc"),
            F.when(count("<") != count(">"), "unbalanced_angle_brackets"),
        )
    )
