"""Group statistics attached to rows, and joins whose null keys match."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkframe.session import materialized

FEW = 10_000  # groups whose statistics go to every task


def match_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a null key matches a null key; key columns are kept once (from the left)."""
    if not on:
        raise ValueError("match_join needs at least one key")
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in on})
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in on])
    joined = left.join(renamed, cond, how)
    if how in ("left_semi", "left_anti"):
        return joined
    if how in ("right", "full"):
        keys = [F.coalesce(F.col(k), F.col(f"_r_{k}")).alias(k) for k in on]
        rest = [c for c in left.columns if c not in on] + [c for c in right.columns if c not in on]
        return joined.select(*keys, *rest)
    return joined.drop(*[f"_r_{k}" for k in on])


def group_join(left: DataFrame, groups: DataFrame, on: list[str], how: str = "inner", few: int = FEW) -> DataFrame:
    """match_join with one row per group. The groups are written and counted first: up to ``few`` go to every task, and left is not shuffled.

    So a hot key is no task of its own. More groups than that are joined by a shuffle.
    """
    groups = materialized(groups)
    return match_join(left, F.broadcast(groups) if groups.limit(few + 1).count() <= few else groups, on, how)


def one_row(df: DataFrame, **aggs: Column) -> dict:
    """Whole-table statistics as plain values: one aggregated row reaches the driver."""
    return df.agg(*[c.alias(n) for n, c in aggs.items()]).first().asDict()


def attach(df: DataFrame, by: list[str], **aggs: Column) -> DataFrame:
    """Group aggregates as columns on every row.

    Aggregating first combines map-side, and few groups are joined back without a shuffle; a window over the group would
    put a hot group into one task.
    """
    if not by:
        row = one_row(df, **aggs)
        return df.withColumns({n: F.lit(v) for n, v in row.items()})
    return group_join(df, df.groupBy(*by).agg(*[c.alias(n) for n, c in aggs.items()]), by)


def share_of(df: DataFrame, by: list[str], within: list[str], name: str = "prop") -> DataFrame:
    """Rows per key and their share of the enclosing group (or of the table)."""
    n = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    return attach(n, within, _t=F.sum("n")).withColumn(name, F.col("n") / F.col("_t")).drop("_t")
