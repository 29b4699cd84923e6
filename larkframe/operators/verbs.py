"""Column selection by name, type or statistic, and the conditional expressions of the table verbs."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def name_range(df: DataFrame, first: str, last: str) -> list[str]:
    cols = df.columns
    return cols[cols.index(first): cols.index(last) + 1]


def starts_with(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def ends_with(df: DataFrame, suffix: str) -> list[str]:
    return [c for c in df.columns if c.endswith(suffix)]


def contains(df: DataFrame, text: str) -> list[str]:
    return [c for c in df.columns if text in c]


def matches(df: DataFrame, pattern: str) -> list[str]:
    return [c for c in df.columns if re.search(pattern, c)]


def everything_after(df: DataFrame, first: list[str]) -> list[str]:
    return first + [c for c in df.columns if c not in first]


def where_type(df: DataFrame, *types) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]


def numeric(df: DataFrame) -> list[str]:
    return where_type(df, T.NumericType)


def all_of(df: DataFrame, names: list[str]) -> list[str]:
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise ValueError(f"columns not found: {absent}")
    return names


def any_of(df: DataFrame, names: list[str]) -> list[str]:
    return [n for n in names if n in df.columns]


def if_else(pred: Column, yes, no) -> Column:
    """A null predicate gives null, not the else value."""
    return F.when(pred, yes).when(~pred, no)


def cut(x: Column, breaks: list[float], labels: list[str], include_lowest: bool = False) -> Column:
    """Right-closed bins (a, b]; outside is null. Infinite ends are written as None."""
    out = None
    for i, label in enumerate(labels):
        lo, hi = breaks[i], breaks[i + 1]
        cond = F.lit(True)
        if lo is not None:
            cond = (x >= lo) if (include_lowest and i == 0) else (x > lo)
        if hi is not None:
            cond = cond & (x <= hi)
        out = F.when(cond & x.isNotNull(), label) if out is None else out.when(cond & x.isNotNull(), label)
    return out


def factor(x: Column, levels: list[str]) -> Column:
    """1-based level number; a value outside the levels is null."""
    out = None
    for i, level in enumerate(levels, 1):
        out = F.when(x == level, i) if out is None else out.when(x == level, i)
    return out
