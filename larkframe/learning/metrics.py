"""Regression and classification metrics as aggregate expressions or small result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkframe.operators.grouping import group_join
from larkframe.operators.quantiles import value_table


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rmse(y, p) -> Column:
    e = _c(y) - _c(p)
    return F.sqrt(F.avg(e * e))


def mae(y, p) -> Column:
    return F.avg(F.abs(_c(y) - _c(p)))


def rsq(y, p) -> Column:
    """Squared correlation; null when a side is constant."""
    ok = (F.var_pop(_c(y)) > 0) & (F.var_pop(_c(p)) > 0)
    c = F.covar_pop(_c(y), _c(p))
    return F.when(ok, c * c) / F.when(ok, F.var_pop(_c(y)) * F.var_pop(_c(p)))


def mape(y, p) -> Column:
    return F.avg(F.abs(F.try_divide(_c(y) - _c(p), _c(y)))) * 100


def ccc(y, p) -> Column:
    d = F.avg(_c(y)) - F.avg(_c(p))
    return 2 * F.covar_pop(_c(y), _c(p)) / (F.var_pop(_c(y)) + F.var_pop(_c(p)) + d * d)


def capped_mape(y, p, cap: float = 0.2) -> Column:
    return F.avg(F.least(F.abs(F.try_divide(_c(y) - _c(p), _c(y))), F.lit(cap)))


def asymmetric(y, p, under: float = 2.0) -> Column:
    e = _c(y) - _c(p)
    return F.sqrt(F.avg(F.when(e > 0, under * e * e).otherwise(e * e)))


def confusion(truth, pred) -> dict[str, Column]:
    """tp, fp, fn, tn counts; both columns hold 1 for the event."""
    t, p = _c(truth), _c(pred)
    return {"tp": F.count_if((t == 1) & (p == 1)), "fp": F.count_if((t == 0) & (p == 1)),
            "fn": F.count_if((t == 1) & (p == 0)), "tn": F.count_if((t == 0) & (p == 0))}


def rates(c: dict[str, Column]) -> dict[str, Column]:
    precision, recall = F.try_divide(c["tp"], c["tp"] + c["fp"]), F.try_divide(c["tp"], c["tp"] + c["fn"])
    return {
        "accuracy": (c["tp"] + c["tn"]) / (c["tp"] + c["tn"] + c["fp"] + c["fn"]),
        "precision": precision, "recall": recall, "f_meas": F.try_divide(2 * precision * recall, precision + recall),
        "specificity": F.try_divide(c["tn"], c["tn"] + c["fp"]),
    }


def curve(df: DataFrame, by: list[str], score: str, event: str) -> DataFrame:
    """One row per distinct score, highest first: n and e at the score, cum and cum_e down to it, totals n_all and e_all."""
    t = value_table(df, by, score, descending=True, e=F.col(event).cast("long"))
    if by:
        return group_join(t, t.groupBy(*by).agg(F.sum("n").alias("n_all"), F.sum("e").alias("e_all")), by)
    s = t.agg(F.sum("n").alias("a"), F.sum("e").alias("b")).first()
    return t.withColumns({"n_all": F.lit(s["a"]).cast("long"), "e_all": F.lit(s["b"]).cast("long")})


def roc_points(c: DataFrame, by: list[str]) -> DataFrame:
    neg = F.col("n_all") - F.col("e_all")
    return c.select(*by, F.col("v").alias("threshold"), F.try_divide("cum_e", "e_all").alias("sensitivity"),
                    (1 - F.try_divide(F.col("cum") - F.col("cum_e"), neg)).alias("specificity"))


def roc_auc(c: DataFrame, by: list[str]) -> DataFrame:
    """Share of event/non-event pairs in the right order, ties counting half, from the curve. Pairs are counted in doubles, as their number may leave 63 bits."""
    neg_at = F.col("n") - F.col("e")
    neg_all = F.col("n_all") - F.col("e_all")
    neg_below = neg_all - (F.col("cum") - F.col("cum_e"))
    return c.groupBy(*by).agg(F.try_divide(F.sum(F.col("e") * (neg_below + neg_at / 2)), F.max(F.col("e_all").cast("double") * neg_all)).alias("auc"))


def pr_auc(c: DataFrame, by: list[str]) -> DataFrame:
    """Trapezoids over recall and precision, starting at recall 0 and precision 1."""
    r0, r1 = (F.col("cum_e") - F.col("e")) / F.col("e_all"), F.col("cum_e") / F.col("e_all")
    p1 = F.col("cum_e") / F.col("cum")
    p0 = F.coalesce(F.try_divide(F.col("cum_e") - F.col("e"), F.col("cum") - F.col("n")), F.lit(1.0))
    return c.groupBy(*by).agg(F.sum((r1 - r0) * (p0 + p1) / 2).alias("pr_auc"))


def hand_till(df: DataFrame, cls: str, scores: dict, key: str) -> DataFrame:
    """Multi-class AUC: mean over class pairs of the two one-against-the-other areas.

    Each row takes part in 2 (k - 1) pair rankings: as event of its class and as non-event of the others.
    """
    levels = list(scores)
    rows = []
    for c in levels:
        for d in levels:
            if c != d:
                rows.append(F.when(F.col(cls) == c, F.struct(F.lit(f"{c}|{d}").alias("pair"), F.col(scores[c]).alias("score"), F.lit(1).alias("e"))))
                rows.append(F.when(F.col(cls) == c, F.struct(F.lit(f"{d}|{c}").alias("pair"), F.col(scores[d]).alias("score"), F.lit(0).alias("e"))))
    long = df.select(F.explode(F.filter(F.array(*rows), lambda s: s.isNotNull())).alias("s")).select("s.*")
    return roc_auc(curve(long, ["pair"], "score", "e"), ["pair"])
