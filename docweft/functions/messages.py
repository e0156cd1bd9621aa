"""Commit messages and issue summaries: ids, subjects, first paragraphs, and the weak and dangling tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WS, WS_CHARS

# Fixed values.
WEAK_SUMMARIES = ["pr", "fix", "fixed", "update", "changes", "cleanup", "clean up", "revert"]
DANGLING_WORDS = ["by", "to", "for", "with", "of", "in", "on", "and", "or", "from", "into"]
ISSUE_ID = r"#[0-9]+|[A-Z][A-Z0-9]+-[0-9]+"
LOW_SIGNAL_START = (
    r"(?iU)^(?:javadocs?|docs?|documentation|sort(?:ed|ing)?\s+members?|format(?:ting)?|reformat(?:ting)?|"
    r"cleanup|clean\s*up|typos?|fix\s+typos?)\b"
)
LOW_SIGNAL_ANYWHERE = (
    r"(?iU)\b(?:refactor(?:ing)?|rename(?:d|s|ing)?\s+internal|empty\s+lines?|whitespace|imports?\s+only|"
    r"code\s+duplication)\b"
)


def collapse(text: Column) -> Column:
    """White space runs become one space, ends are trimmed."""
    return F.trim(F.regexp_replace(text, f"{WS}+", " "))


def last_word(text: Column) -> Column:
    return F.element_at(F.split(text, " "), -1)


def is_weak_issue_summary(summary: Column) -> Column:
    """True for summaries that say nothing: fixed words, three letters or less, or a dangling last word."""
    flat = collapse(F.coalesce(summary, F.lit("")))
    bare = F.lower(F.trim(F.regexp_replace(flat, r"^[ .,:;!\-_]+|[ .,:;!\-_]+$", "")))
    words = F.regexp_replace(last_word(bare), r"^[.,;:!?]+|[.,;:!?]+$", "")
    return (
        F.when((bare == "") | bare.isin(WEAK_SUMMARIES) | (F.length(bare) <= 3), True)
        .when(flat.rlike(r"[.!?]\z"), False)
        .otherwise(words.isin(DANGLING_WORDS))
    )


def is_dangling_summary(summary: Column) -> Column:
    """The continuation's test: the last word, without punctuation, is a linking word."""
    flat = collapse(F.coalesce(summary, F.lit("")))
    word = F.regexp_replace(F.lower(last_word(flat)), r"^[.,;:!?]+|[.,;:!?]+$", "")
    return word.isin(DANGLING_WORDS)


def ends_with_dangling_word(text: Column) -> Column:
    """The subject's test: a linking word at the very end, or one parted by white space from a final mark."""
    flat = F.rtrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(WS_CHARS + "\n\r"))
    spaced = F.regexp_extract(flat, rf"([a-z]+){WS}+[.!?]\z", 1)
    word = F.when(spaced != "", spaced).otherwise(F.regexp_extract(flat, r"([a-z]+)\z", 1))
    return word.isin(DANGLING_WORDS)


def is_low_signal_message(message: Column) -> Column:
    """True where the first line that is not blank only tells of formatting, typos or documentation."""
    lines = F.filter(F.split(F.coalesce(message, F.lit("")), "\n"), lambda x: ~x.rlike(rf"\A{WS}*\z"))
    first = F.coalesce(F.try_element_at(lines, F.lit(1)), F.lit(""))
    first = F.regexp_replace(first, rf"\A{WS}+|{WS}+\z", "")
    return first.rlike(LOW_SIGNAL_START) | first.rlike(LOW_SIGNAL_ANYWHERE)


def issue_ids(text: Column) -> Column:
    """Distinct issue ids in order of first sight."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({ISSUE_ID})"), 1))


def looks_like_issue_id(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(rf"\A(?:{ISSUE_ID})\z")
