"""Repeatable randomness: every draw is a function of a row key and a seed, never of the partitioning."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkframe.operators.grouping import FEW, group_join, match_join
from larkframe.session import materialized

PREFIXES = 1 << 18  # rows of a table of prefix counts that goes to every task


def digest(keys: list[str], seed: str) -> Column:
    return F.md5(F.concat_ws("-", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def uniform(keys: list[str], seed: str) -> Column:
    """Number in [0, 1) from the first 52 bits of the digest, as many as a double holds exactly."""
    return F.conv(F.substring(digest(keys, seed), 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def hash_positions(
    df: DataFrame, keys: list[str], seed: str, by: list[str] | None = None, name: str = "pos", total: str = "total",
    digits: int = 4, alike: dict[str, Column] | None = None,
) -> DataFrame:
    """1-based place of each row in digest order (per group), and the group size.

    Digest prefixes are evenly filled, so each window holds 1/65536 of a group however large the group is;
    prefix counts (at most 65536 per group) turn local places into whole-table places. Digests travel as 16 bytes, and equal ones
    mean equal keys where there is one key, so the key itself travels only if a later step reads it.
    ``alike`` are aggregates over the rows with equal keys, which lie side by side.
    """
    by = by or []
    d = df.withColumn("_h", digest(keys, seed)).withColumn("_b", F.substring("_h", 1, digits))
    counts = _prefix_counts(d, by, total)
    d = d.withColumn("_h", F.unhex("_h"))
    order = ["_h"] if len(keys) == 1 else ["_h", *keys]
    d = d.withColumn("_r", F.row_number().over(Window.partitionBy(*by, "_b").orderBy(*order)))
    same = Window.partitionBy(*by, "_b", *order)
    d = d.withColumns({n: c.over(same) for n, c in (alike or {}).items()})
    return (
        group_join(d, counts.drop("_c"), by + ["_b"], few=PREFIXES)
        .withColumn(name, F.col("_r") + F.col("_before"))
        .drop("_h", "_b", "_r", "_before")
    )


def _prefix_counts(d: DataFrame, by: list[str], total: str) -> DataFrame:
    """Per group and prefix ``_b`` the rows ``_c``, the rows of smaller prefixes ``_before`` and the group size."""
    counts = d.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_c"))
    group = Window.partitionBy(*(by or [F.lit(0)]))
    before = group.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        *by, "_b", "_c", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"), F.sum("_c").over(group).alias(total)
    )


def hash_ranges(df: DataFrame, keys: list[str], seed: str, edges: Callable[[Column], list[Column]], by: list[str] | None = None, name: str = "range") -> DataFrame:
    """Number from 1 of the range of places, in digest order (per group), that holds each row.

    ``edges`` gives, from the group size, the rising last places of all ranges but the last. The row at every edge is found from prefix
    counts and the rows of its prefix; rows are then compared with those few and stay where they are. Where rows with one key lie on
    both sides of an edge, or groups are many, the places themselves are taken.
    """
    by = by or []
    d = df.withColumn("_h", digest(keys, seed))
    own = F.struct("_h", *keys)
    rows = d.select(*by, "_h", *[k for k in keys if k not in by]).withColumn("_b", F.substring("_h", 1, 4))
    counts = materialized(_prefix_counts(rows, by, "_n"))
    groups = counts.groupBy(*by).agg(F.max("_n").alias("_n"))
    few = groups.limit(FEW + 1).count()
    if few == 0:
        return df.withColumn(name, F.lit(1))
    if few <= FEW:
        at = F.explode(F.array(*[e.cast("long") for e in edges(F.col("_n"))]))
        marks = counts.withColumn("_edge", at).where((F.col("_edge") > F.col("_before")) & (F.col("_edge") <= F.col("_before") + F.col("_c")))
        marks = marks.groupBy(*by, "_b").agg(F.collect_list(F.col("_edge") - F.col("_before")).alias("_at"))
        inside = group_join(rows, marks, by + ["_b"])
        place = Window.partitionBy(*by, "_b").orderBy("_h", *keys)
        inside = inside.withColumn("_r", F.row_number().over(place)).withColumn("_next", F.lead(own).over(place))
        hit = F.filter("_at", lambda e: e == F.col("_r"))  # empty ranges share an edge
        found = materialized(inside.select(*by, own.alias("_mark"), "_next", F.explode(hit)).drop("col"))
        if found.where(F.col("_mark") == F.col("_next")).isEmpty():
            passed = F.size(F.filter(F.array(*[e.cast("long") for e in edges(F.col("_n"))]), lambda e: e <= 0))
            groups = groups.select(*by, passed.alias("_passed"))
            if by:
                lists = found.groupBy(*by).agg(F.collect_list("_mark").alias("_marks"))
                table = match_join(groups, lists, by, "left")
                joined = group_join(d, table, by)
            else:  # one row for all; the length of every digest is its key, as a join without one is a nested loop
                both = groups.unionByName(found.select("_mark"), allowMissingColumns=True)
                one = both.agg(F.max(F.lit(32)).alias("_l"), F.max("_passed").alias("_passed"), F.collect_list("_mark").alias("_marks"))
                joined = d.join(F.broadcast(one), F.length("_h") == F.col("_l")).drop("_l")
            over = F.size(F.filter(F.coalesce("_marks", F.array()), lambda m: m < own))
            return joined.withColumn(name, (1 + F.col("_passed") + over).cast("int")).drop("_h", "_passed", "_marks")
    d = hash_positions(df, keys, seed, by, "_pos", "_n")
    number = sum((F.when(F.col("_pos") > e, 1).otherwise(0) for e in edges(F.col("_n"))), F.lit(1))
    return d.withColumn(name, number.cast("int")).drop("_pos", "_n")
