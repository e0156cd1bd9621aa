"""Paths of source files and lines of patches."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip, text_or_empty

# Fixed values.
OTHER_DIRECTORIES = ["test", "tests", "testdata", "generated", "target", "build"]
OTHER_PATTERN = r"(?:^|[-_])(?:test|tests|testlib|testdata|benchmark|benchmarks|generated)(?:[-_]|$)"
TEST_NAME = r"\A(?:Test.*|.*Tests?|.*TestCase)\.java\z"
DOC_TAGS = ["@param", "@return", "@throws", "@exception", "@see", "@since"]


def is_target_path(path: Column) -> Column:
    """Java sources under a ``src`` directory that are no tests, benchmarks or generated files."""
    plain = F.regexp_replace(F.replace(text_or_empty(path), F.lit("\\"), F.lit("/")), "/+", "/")
    parts = F.split(plain, "/")
    low = F.transform(parts, F.lower)
    directories = F.slice(low, 1, F.greatest(F.size(low) - 1, F.lit(0)))
    return (
        F.endswith(plain, F.lit(".java"))
        & F.array_contains(low, "src")
        & (F.get(low, F.lit(0)) != "android")
        & ~F.exists(directories, lambda d: d.isin(OTHER_DIRECTORIES) | d.rlike(OTHER_PATTERN))
        & ~F.element_at(parts, -1).rlike(TEST_NAME)
    )


def changed_paths(name_status: Column) -> Column:
    """The target paths of ``status<TAB>path`` lines, the last field of each."""
    lines = F.filter(F.split(text_or_empty(name_status), "\n"), lambda x: strip(x) != "")
    return F.filter(F.transform(lines, lambda x: F.element_at(F.split(x, "\t"), -1)), is_target_path)


def _is_change(line: Column) -> Column:
    return line.rlike(r"\A[+-]") & ~line.rlike(r"\A(?:\+\+\+|---)")


def _payload(line: Column) -> Column:
    return strip(F.when(_is_change(line), F.substr(line, F.lit(2))).otherwise(line))


def is_doc_line(line: Column) -> Column:
    text = _payload(line)
    found = text.rlike(r"\A(?:/\*\*|\*)")
    for tag in DOC_TAGS:
        found = found | F.contains(text, F.lit(tag))
    return found


def is_code_line(line: Column) -> Column:
    return _is_change(line) & (_payload(line) != "") & ~is_doc_line(line) & ~_payload(line).rlike(r"\A(?://|/\*|\*)")


def has_doc_changes(patch: Column) -> Column:
    """Some added or removed line belongs to documentation."""
    return F.exists(F.split(text_or_empty(patch), "\n"), lambda x: _is_change(x) & is_doc_line(x))


def has_code_changes(patch: Column) -> Column:
    return F.exists(F.split(text_or_empty(patch), "\n"), is_code_line)
