"""Test statistics from grouped sums; p-values are added on the result rows."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkframe.functions import tails
from larkframe.operators.grouping import attach, group_join
from larkframe.operators.quantiles import long_form, value_table


def tail(fn, *cols: Column) -> Column:
    """Tail probability of each result row."""
    @F.pandas_udf("double")
    def p(*args: pd.Series) -> pd.Series:
        return pd.Series([float("nan") if any(pd.isna(v) for v in row) else fn(*row) for row in zip(*args)], dtype="float64")

    return p(*cols)


def welch(df: DataFrame, value: str, in_a: Column, in_b: Column) -> DataFrame:
    """One row: means of both groups, t, degrees of freedom, p and the 95 % interval of the difference."""
    a, b = F.when(in_a, F.col(value)), F.when(in_b, F.col(value))
    s = df.agg(F.count(a).alias("n1"), F.avg(a).alias("m1"), F.var_samp(a).alias("v1"),
               F.count(b).alias("n2"), F.avg(b).alias("m2"), F.var_samp(b).alias("v2"))
    e1, e2 = F.col("v1") / F.col("n1"), F.col("v2") / F.col("n2")
    se = F.sqrt(e1 + e2)
    dof = (e1 + e2) * (e1 + e2) / (e1 * e1 / (F.col("n1") - 1) + e2 * e2 / (F.col("n2") - 1))
    s = s.withColumns({"se": se, "t": (F.col("m1") - F.col("m2")) / se, "df": dof})
    s = s.withColumns({"p": tail(tails.t_two_sided, F.col("t"), F.col("df")), "_q": tail(lambda d: tails.t_quantile(0.975, d), F.col("df"))})
    half = F.col("_q") * F.col("se")
    return s.withColumns({"lo": F.col("m1") - F.col("m2") - half, "hi": F.col("m1") - F.col("m2") + half}).drop("_q")


def anova(df: DataFrame, cols: list[str], group: str) -> DataFrame:
    """One-way F test per column: between and within sums of squares from one grouped pass."""
    g = long_form(df, [group], cols).groupBy("measure", group).agg(
        F.count("value").alias("n"), F.avg("value").alias("m"), F.coalesce(F.var_pop("value"), F.lit(0.0)).alias("v"))
    g = attach(g, ["measure"], _t=F.sum(F.col("n") * F.col("m")) / F.sum("n"))
    s = g.groupBy("measure").agg(
        (F.count(F.lit(1)) - 1).alias("df1"), (F.sum("n") - F.count(F.lit(1))).alias("df2"),
        F.sum(F.col("n") * (F.col("m") - F.col("_t")) * (F.col("m") - F.col("_t"))).alias("ssb"), F.sum(F.col("n") * F.col("v")).alias("ssw"))
    f = F.try_divide(F.col("ssb") / F.col("df1"), F.col("ssw") / F.col("df2"))
    s = s.withColumn("f", f)
    return s.withColumn("p", tail(tails.f_upper, F.col("f"), F.col("df1"), F.col("df2")))


def ks(df: DataFrame, cols: list[str], second: Column) -> DataFrame:
    """Two-sample D per column from one table of distinct values with counts of both samples."""
    long = long_form(df.withColumn("_s", second.cast("int")), ["_s"], cols)
    t = value_table(long, ["measure"], "value", a=1 - F.col("_s"), b=F.col("_s"))
    size = t.groupBy("measure").agg(F.sum("a").alias("na"), F.sum("b").alias("nb"))
    j = group_join(t, size, ["measure"])
    s = j.groupBy("measure").agg(
        F.max(F.abs(F.col("cum_a") / F.col("na") - F.col("cum_b") / F.col("nb"))).alias("d"), F.max("na").alias("na"), F.max("nb").alias("nb"))
    return s.withColumn("p", tail(tails.ks_upper, F.col("d"), F.col("na"), F.col("nb")))


def chisq(df: DataFrame, a: str, b: str) -> DataFrame:
    """Independence of two columns: statistic N (sum n^2 / (row total * column total) - 1) over the cells that occur."""
    c = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    c = attach(attach(c, [a], _r=F.sum("n")), [b], _c=F.sum("n"))
    s = c.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n") / (F.col("_r") * F.col("_c"))).alias("q"),
              F.countDistinct(a).alias("ra"), F.countDistinct(b).alias("rb"))
    s = s.select("n", (F.col("n") * (F.col("q") - 1)).alias("x2"), ((F.col("ra") - 1) * (F.col("rb") - 1)).alias("df"))
    return s.withColumn("p", tail(tails.chisq_upper, F.col("x2"), F.col("df")))
