"""Exact order statistics from a table of distinct values with counts.

``percentile`` keeps all values of a group in one buffer. Counting equal values first (map-side combine) and taking
running counts over range partitions gives the same type-7 result with no group held in one place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkframe.operators.grouping import group_join
from larkframe.operators.ordering import running


def value_table(
    df: DataFrame, by: list[str], value: Column | str, descending: bool = False, weight: Column | None = None, **sums: Column
) -> DataFrame:
    """Distinct non-null values per group: ``v``, count ``n``, inclusive running count ``cum``, order number ``dense``.

    ``weight`` counts a row that many times. Extra ``name=column`` arguments are summed per value, with running totals ``cum_name``.
    """
    v = F.col(value) if isinstance(value, str) else value
    d = df.withColumn("_v", v).where(F.col("_v").isNotNull())
    t = d.groupBy(*by, F.col("_v").alias("v")).agg(
        (F.count(F.lit(1)) if weight is None else F.sum(weight)).alias("n"), *[F.sum(c).alias(name) for name, c in sums.items()]
    )
    order = [F.col("v").desc()] if descending else ["v"]
    outs = {"cum": ("sum", "n"), "dense": ("count", "n")}
    outs.update({f"cum_{s}": ("sum", s) for s in sums})
    return running(t, by, order, **outs)


def long_form(df: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    """One row per value: group keys, ``measure``, ``value``."""
    return df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(by, cols, "measure", "value")


def quantiles(
    df: DataFrame, by: list[str], value: Column | str, probs: dict[str, float], weight: Column | None = None
) -> DataFrame:
    """Type-7 quantiles per group: one column per entry of ``probs``."""
    t = value_table(df, by, value, weight=weight)
    size = t.groupBy(*by).agg(F.sum("n").alias("_size"))
    if by:
        t = group_join(t, size, by)
    else:
        t = t.withColumn("_size", F.lit(size.first()["_size"]))

    def at(p: float, side) -> Column:
        place = side((F.col("_size") - 1) * F.lit(float(p)))
        return F.max(F.when((F.col("cum") - F.col("n") <= place) & (place < F.col("cum")), F.col("v")))

    out = []
    for name, p in probs.items():
        h = (F.col("_size") - 1) * F.lit(float(p))
        frac = F.max(h - F.floor(h))
        lo, hi = at(p, F.floor), at(p, F.ceil)
        out.append((lo + (hi - lo) * frac).alias(name))
    # only values at a wanted place survive to the last aggregation
    wanted = reduce(lambda a, b: a | b, [
        (F.col("cum") > s((F.col("_size") - 1) * F.lit(float(p)))) & (F.col("cum") - F.col("n") <= s((F.col("_size") - 1) * F.lit(float(p))))
        for p in probs.values() for s in (F.floor, F.ceil)
    ])
    return t.where(wanted).groupBy(*by).agg(*out)


def quantiles_of(df: DataFrame, cols: list[str], probs: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """Quantiles of several columns in one pass: rows (group, measure), one column per probability."""
    by = by or []
    return quantiles(long_form(df, by, cols), by + ["measure"], "value", probs)


def quantile_values(df: DataFrame, cols: list[str], probs: dict[str, float]) -> dict[str, dict[str, float]]:
    """The same as plain numbers per column: one row per named column reaches the driver."""
    return {r["measure"]: r.asDict() for r in quantiles_of(df, cols, probs).collect()}
