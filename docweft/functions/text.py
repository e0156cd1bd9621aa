"""Text normal forms and the content fingerprint, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as white space at a line's end, and separators.
WS_CHARS = (
    "\t\x0b\x0c\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WS = r"[\t\n\x0B\f\r\x1C-\x1F \x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
FIELD_SEPARATOR = "\u241e"


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def strip(text: Column) -> Column:
    """White space of any script cut off at both ends."""
    return F.regexp_replace(text, rf"\A{WS}+|{WS}+\z", "")


def py_lower_strip(text: Column) -> Column:
    return F.lower(strip(text))


def unix_lines(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def line_form(text: Column) -> Column:
    """Unix line ends, no white space at line ends, no empty lines at either end. Null counts as empty."""
    lines = F.split(unix_lines(text_or_empty(text)), "\n")
    trimmed = F.array_join(F.transform(lines, lambda x: F.rtrim(x, F.lit(WS_CHARS))), "\n")
    return F.trim(trimmed, F.lit("\n"))


def fingerprint(*texts: Column) -> Column:
    """SHA-256 of the line forms, joined by a separator; equal for texts that differ in layout at line ends only."""
    return F.sha2(F.concat_ws(FIELD_SEPARATOR, *[line_form(t) for t in texts]), 256)


def slug(name: Column) -> Column:
    """Lower case, every run of other characters than letters and digits one ``_``, none at the ends; empty is null."""
    plain = F.trim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "_"), F.lit("_"))
    return F.when(plain != "", plain)


def commit_hash(value: Column) -> Column:
    """Trimmed, in lower case; null where there is none (null, blank or all zeros)."""
    plain = py_lower_strip(value)
    return F.when((plain != "") & ~plain.rlike(r"\A0+\z"), plain)
