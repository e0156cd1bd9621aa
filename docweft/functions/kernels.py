"""The few procedures that Spark has no expression for, as Arrow batches in Python workers."""

from __future__ import annotations

import difflib
from collections import Counter
from functools import cache
from typing import TYPE_CHECKING

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

if TYPE_CHECKING:
    import pandas as pd


def ratio(a: list[str], b: list[str]) -> float:
    return difflib.SequenceMatcher(None, a, b).ratio()


def alike(a: str, b: str, least: float) -> bool:
    """Whether the ratio reaches ``least``; two upper bounds, by length and by letters, spare most of the work."""
    total = len(a) + len(b)
    if 2 * min(len(a), len(b)) < least * total:
        return False
    if 2 * sum((Counter(a) & Counter(b)).values()) < least * total:
        return False
    return difflib.SequenceMatcher(None, a, b).ratio() >= least


def pairs_by_spelling(removed: list[str], added: list[str], least: float = 0.8) -> bool:
    """Whether each removed word goes to another added word that is spelled alike; the first that fits is taken."""
    if not removed or len(removed) != len(added):
        return False
    free = list(added)
    for old in removed:
        at = next((i for i, new in enumerate(free) if alike(old, new, least)), -1)
        if at < 0:
            return False
        del free[at]
    return True


@cache
def _udfs() -> tuple:
    """Made on first use, as they load pandas.

    Declared non-deterministic so that the optimizer neither copies a call into several places nor moves it
    below a filter that was put there to keep rows from it; the results depend on the arguments alone.
    """
    import pandas as pd

    def ratios(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else ratio(list(x), list(y)) for x, y in zip(a, b, strict=True)], dtype="float64")

    def spellings(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else pairs_by_spelling(list(x), list(y)) for x, y in zip(a, b, strict=True)], dtype="boolean")

    for f in (ratios, spellings):
        f.__annotations__ = {"a": pd.Series, "b": pd.Series, "return": pd.Series}
    return F.pandas_udf(ratios, T.DoubleType()).asNondeterministic(), F.pandas_udf(spellings, T.BooleanType()).asNondeterministic()


def seq_ratio(a: Column, b: Column) -> Column:
    """Ratio of matching elements of two token arrays, popular elements left out from 200 on; null for null."""
    return _udfs()[0](a, b)


def spelling_only(removed: Column, added: Column) -> Column:
    """Whether two arrays of words differ by spelling alone; null for null."""
    return _udfs()[1](removed, added)
