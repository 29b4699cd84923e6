"""Long and wide forms, missing combinations, and group rows packed into arrays of bounded length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkframe.operators.grouping import match_join
from larkframe.operators.ordering import positions

PACK_ROWS = 1000


def longer(df: DataFrame, ids: list[str], cols: list[str], names_to: str, values_to: str) -> DataFrame:
    return df.unpivot(ids, cols, names_to, values_to)


def longer_values(df: DataFrame, ids: list[str], parts: dict[str, dict[str, str]], names_to: str) -> DataFrame:
    """Several value columns at once: ``parts[label][value name] = source column``."""
    rows = [
        F.struct(F.lit(label).alias(names_to), *[F.col(src).alias(v) for v, src in cols.items()])
        for label, cols in parts.items()
    ]
    return df.select(*ids, F.explode(F.array(*rows)).alias("_s")).select(*ids, "_s.*")


def wider(df: DataFrame, ids: list[str], names_from: str, names: list, aggs: list[Column], rename=None) -> DataFrame:
    """Long to wide with a declared list of names, so that no extra job looks them up."""
    out = df.groupBy(*ids).pivot(names_from, names).agg(*aggs)
    return out.withColumnsRenamed({c: rename(c) for c in out.columns if c not in ids}) if rename else out


def pack(df: DataFrame, by: list[str], order: list[str], item: Column, name: str, rows: int = PACK_ROWS) -> DataFrame:
    """Group rows as arrays: one array per group and ``part_no``, each holding at most ``rows`` items in order.

    A group of any size is kept whole, as several parts, so no task or row holds an unbounded list.
    """
    placed = positions(df.withColumn("_item", item), by, order, "_pos")
    placed = placed.withColumn("part_no", F.floor((F.col("_pos") - 1) / rows))
    packed = placed.groupBy(*by, "part_no").agg(
        F.sort_array(F.collect_list(F.struct("_pos", "_item"))).alias("_items"))
    return packed.withColumn(name, F.transform("_items", lambda s: s["_item"])).drop("_items")


def paste(df: DataFrame, by: list[str], value: str, order: list[str], sep: str, name: str, rows: int = PACK_ROWS) -> DataFrame:
    """Group values as text, in parts of at most ``rows`` values."""
    packed = pack(df, by, order, F.col(value).cast("string"), name, rows)
    return packed.withColumn(name, F.array_join(name, sep))


def pair_up(left: DataFrame, right: DataFrame, order: list[str]) -> DataFrame:
    """Every left row with every right row, as an equi-join on the row number of the right side.

    The product is the asked-for result; each right row number is its own join key, so the work spreads evenly.
    """
    numbered = positions(right, [], order, "_k")
    size = max(1, numbered.count())
    spread = left.withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(size))))
    return spread.join(numbered, "_k").drop("_k")


def expand(df: DataFrame, *cols: str) -> DataFrame:
    """All combinations of the observed values of the columns."""
    out = df.select(cols[0]).distinct()
    for c in cols[1:]:
        out = pair_up(out, df.select(c).distinct(), [c])
    return out


def complete(df: DataFrame, cols: list[str], fill: dict | None = None) -> DataFrame:
    """Missing combinations as rows with nulls, or with the given defaults."""
    out = match_join(expand(df, *cols), df, cols, "left")
    return out.fillna(fill) if fill else out
