"""Search over candidates. Grids and their results are tables; folds x candidates fits run concurrently on the cluster."""

from __future__ import annotations

import math
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from itertools import product

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkframe.learning import metrics as mt


def grid_regular(**levels: list) -> list[dict]:
    names = list(levels)
    return [{**dict(zip(names, v)), "config": "_".join(f"{x:g}" if isinstance(x, float) else str(x) for x in v)} for v in product(*levels.values())]


def log_levels(lo: float, hi: float, n: int) -> list[float]:
    return [float(10 ** (math.log10(lo) + (math.log10(hi) - math.log10(lo)) * i / (n - 1))) for i in range(n)]


def grid_random(size: int, seed: int, **ranges: tuple) -> list[dict]:
    """Random points; a range (lo, hi, "log") is drawn on the log scale."""
    rng = np.random.default_rng(seed)
    return [_point(i, {n: rng.random() for n in ranges}, ranges) for i in range(size)]


def grid_latin(size: int, seed: int, **ranges: tuple) -> list[dict]:
    """One point in each of ``size`` strata of every axis, strata paired at random."""
    rng = np.random.default_rng(seed)
    u = {n: (rng.permutation(size) + rng.random(size)) / size for n in ranges}
    return [_point(i, {n: u[n][i] for n in ranges}, ranges) for i in range(size)]


def _point(i: int, u: dict, ranges: dict) -> dict:
    out = {"config": f"p{i + 1:02d}"}
    for n, rng in ranges.items():
        lo, hi = rng[0], rng[1]
        if len(rng) > 2:
            out[n] = float(10 ** (math.log10(lo) + u[n] * (math.log10(hi) - math.log10(lo))))
        elif isinstance(lo, int):
            out[n] = int(lo + math.floor(u[n] * (hi - lo + 1)))
        else:
            out[n] = float(lo + u[n] * (hi - lo))
    return out


def fit_resamples(df: DataFrame, fold: str, y: str, fits: dict[str, Callable], threads: int = 4) -> DataFrame:
    """Metric rows for models that need a Spark fit per fold: ``fits[config](train) -> scorer(df) with column pred``.

    The folds are a bounded list; every fit and its scoring aggregation are Spark jobs, started from a few threads.
    """
    folds = [r[0] for r in df.select(fold).distinct().orderBy(fold).collect()]

    def one(task):
        config, f = task
        scored = fits[config](df.where(F.col(fold) != f))(df.where(F.col(fold) == f))
        m = scored.agg(mt.rmse(y, "pred").alias("rmse"), mt.rsq(y, "pred").alias("rsq"), mt.mae(y, "pred").alias("mae")).first()
        return [(config, f, name, m[name]) for name in ("rmse", "rsq", "mae")]

    with ThreadPoolExecutor(threads) as pool:
        rows = [r for part in pool.map(inheritable_thread_target(df.sparkSession)(one), product(fits, folds)) for r in part]
    return df.sparkSession.createDataFrame(rows, f"config string, {fold} {dict(df.dtypes)[fold]}, metric string, estimate double")


def show_best(summary: DataFrame, metric: str, n: int = 1) -> DataFrame:
    """Best candidates by the direction of the metric; equal means go to the first name."""
    up = metric in ("rsq", "accuracy", "roc_auc")
    d = summary.where(F.col("metric") == metric)
    return d.orderBy(F.col("mean").desc() if up else F.col("mean").asc(), "config").limit(n)


def table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    names = [c.strip().split(" ")[0] for c in schema.split(",")]
    return spark.createDataFrame([[r[n] for n in names] for r in rows], schema)


def anneal(score: Callable[[np.ndarray], float], dims: int, iters: int, seed: int, cooling: float = 0.02) -> list[dict]:
    """Random walk in the unit cube; worse points are accepted less and less often."""
    rng = np.random.default_rng(seed)
    here = rng.random(dims)
    cost = best = score(here)
    rows = [{"iter": 0, "u": here, "mean": cost, "accepted": 1}]
    for it in range(1, iters + 1):
        p = np.clip(here + rng.normal(0, 0.15, dims), 0, 1)
        s = score(p)
        worse = (s - cost) / abs(cost) * 100
        ok = s < cost or rng.random() < math.exp(-worse * it * cooling * 50)
        rows.append({"iter": it, "u": p, "mean": s, "accepted": int(ok)})
        if ok:
            here, cost = p, s
        best = min(best, s)
    return rows


def pareto(d: DataFrame, cost: str, loss: str, key: str) -> DataFrame:
    """Candidates for which no other has both measures no larger and one smaller.

    Along rising cost a candidate survives when its loss is the smallest so far, so the check is a sorted scan of the
    candidate table (one row per candidate), not a comparison of all pairs.
    """
    w = Window.partitionBy(F.lit(0)).orderBy(cost)
    before = F.min("_m").over(w.rowsBetween(Window.unboundedPreceding, -1))
    per = d.groupBy(cost).agg(F.min(loss).alias("_m")).withColumn("_b", before)
    return d.join(per, cost).withColumn("optimal", (F.col(loss) == F.col("_m")) & (F.col("_b").isNull() | (F.col(loss) < F.col("_b")))).drop("_m", "_b")
