"""Summaries of commit messages: the first paragraph, and what to do when it breaks off."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .messages import ISSUE_ID, ends_with_dangling_word
from .text import WS, strip, text_or_empty, unix_lines


def lines_of(message: Column) -> Column:
    return F.split(unix_lines(text_or_empty(message)), "\n")


def clean_line(line: Column) -> Column:
    """Without issue ids, alone or in parentheses, without marks at the ends, white space collapsed."""
    text = F.regexp_replace(strip(line), rf"\((?:{WS}*(?:{ISSUE_ID}){WS}*)+\)", "")
    text = F.regexp_replace(text, ISSUE_ID, "")
    edge = WS[:-1] + r":;,\-\[\]]"
    return F.regexp_replace(F.regexp_replace(text, rf"\A{edge}+|{edge}+\z", ""), f"{WS}+", " ")


def first_paragraph(message: Column) -> Column:
    """The cleaned lines up to the first blank line after content, joined by spaces."""
    start = F.struct(F.expr("cast(array() as array<string>)").alias("kept"), F.lit(False).alias("over"))

    def fold(state: Column, line: Column) -> Column:
        blank = strip(line) == ""
        text = clean_line(line)
        over = state["over"] | (blank & (F.size(state["kept"]) > 0))
        kept = F.when(over | blank | (text == ""), state["kept"]).otherwise(F.concat(state["kept"], F.array(text)))
        return F.struct(kept.alias("kept"), over.alias("over"))

    return F.array_join(F.aggregate(lines_of(message), start, fold, lambda s: s["kept"]), " ")


def with_fallback(message: Column) -> Column:
    """STRUCT(summary, fallback): the first paragraph, or if that dangles the best of what the message offers.

    In order: the subject completed by a later line in lower case, the raw subject, the paragraph with its
    last issue id, the subject.
    """
    def decide(p: Column) -> Column:
        lines = F.filter(lines_of(message), lambda x: strip(x) != "")
        raw = strip(F.coalesce(F.get(lines, F.lit(0)), F.lit("")))
        subject = F.when(F.size(lines) > 0, clean_line(raw)).otherwise(p)
        later = F.transform(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))), clean_line)
        joined = F.transform(F.filter(later, lambda x: x.rlike(r"\A\p{Ll}")), lambda x: F.trim(F.concat_ws(" ", subject, x)))
        completed = F.get(F.filter(joined, lambda x: ~ends_with_dangling_word(x)), F.lit(0))
        ids = F.regexp_extract_all(raw, F.lit(f"({ISSUE_ID})"), 1)

        def result(text: Column, fallback: bool) -> Column:
            return F.struct(text.alias("summary"), F.lit(fallback).alias("fallback"))

        return (
            F.when(~ends_with_dangling_word(p), result(p, False))
            .when(completed.isNotNull(), result(completed, True))
            .when((raw != "") & ~ends_with_dangling_word(raw), result(raw, True))
            .when((p != "") & (F.size(ids) > 0), result(F.concat(p, F.lit(" issue "), F.try_element_at(ids, F.lit(-1))), True))
            .otherwise(result(F.coalesce(F.nullif(subject, F.lit("")), p), True))
        )

    return F.transform(F.array(first_paragraph(message)), decide)[0]


def subject(message: Column) -> Column:
    """The first line that is not blank, stripped; empty if there is none."""
    return strip(F.coalesce(F.get(F.filter(lines_of(message), lambda x: strip(x) != ""), F.lit(0)), F.lit("")))
