"""Order-dependent columns over groups of any size.

A window ordered over a whole table, or over one hot group, runs in one task. Here the rows are range-partitioned on
(group, order), the partition number is fixed by a checkpoint, the window runs per partition, and one small table of
partition totals carries the running state across partition borders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkframe.operators.grouping import group_join
from larkframe.session import shared_folder


def _sort_columns(order: list) -> list[Column]:
    return [F.col(o).asc_nulls_last() if isinstance(o, str) else o for o in order]


def chunked(df: DataFrame, by: list[str], order: list) -> DataFrame:
    """Rows range-partitioned on (by, order) with the partition number in ``_chunk``.

    The checkpoint keeps the numbers the same for every later use, also when an executor is lost.
    """
    shared_folder(df.sparkSession)
    keys = [F.col(b).asc_nulls_last() for b in by] + _sort_columns(order)
    return df.repartitionByRange(*keys).withColumn("_chunk", F.spark_partition_id()).checkpoint()


def running(df: DataFrame, by: list[str], order: list, **outs: tuple[str, str]) -> DataFrame:
    """Running aggregates in the given order; ``out=(kind, column)`` with kind sum, count, max, min or last.

    ``order`` must be total inside a group for kinds whose value depends on ties. ``last`` carries the latest
    non-null value forward and needs ascending column names as order.
    """
    ch = chunked(df, by, order)
    here = Window.partitionBy(*by, "_chunk").orderBy(*_sort_columns(order)).rowsBetween(Window.unboundedPreceding, 0)
    before = (
        Window.partitionBy(*(by or [F.lit(0)])).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    fns = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}
    totals, carried, local, final = [], [], {}, {}
    for out, (kind, col) in outs.items():
        c = F.col(col)
        if kind == "last":
            place = F.when(c.isNotNull(), F.struct(*order))
            totals.append(F.max_by(c, place).alias(f"_t_{out}"))
            carried.append(F.last(f"_t_{out}", ignorenulls=True).over(before).alias(f"_p_{out}"))
            local[out] = F.last(c, ignorenulls=True).over(here)
            final[out] = F.coalesce(F.col(out), F.col(f"_p_{out}"))
            continue
        totals.append(fns[kind](c).alias(f"_t_{out}"))
        prior = fns["sum" if kind == "count" else kind](f"_t_{out}").over(before)
        carried.append(prior.alias(f"_p_{out}"))
        local[out] = fns[kind](c).over(here)
        if kind in ("sum", "count"):
            both = F.col(out) + F.coalesce(F.col(f"_p_{out}"), F.lit(0))
            final[out] = F.coalesce(both, F.col(f"_p_{out}"))
        else:
            final[out] = (F.greatest if kind == "max" else F.least)(F.col(out), F.col(f"_p_{out}"))
    state = ch.groupBy(*by, "_chunk").agg(*totals).select(*by, "_chunk", *carried)
    joined = group_join(ch.withColumns(local), state, by + ["_chunk"])
    return joined.withColumns(final).drop("_chunk", *[f"_p_{o}" for o in outs])


def positions(df: DataFrame, by: list[str], order: list, name: str = "pos") -> DataFrame:
    """1-based row number in a total order, per group or over the whole table."""
    return running(df.withColumn("_one", F.lit(1)), by, order, **{name: ("count", "_one")}).drop("_one")
