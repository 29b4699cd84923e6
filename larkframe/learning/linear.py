"""Linear models from moment tables: all folds and all penalties come from one pass over the rows.

The driver holds a k x k matrix per fold. Training moments are the total minus the fold.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkframe.learning import metrics as mt
from larkframe.operators.moments import Moments, collect_moments


def elastic_net(m: Moments, y: str, xs: list[str], penalty: float, mixture: float, tol: float = 1e-12) -> tuple[float, np.ndarray]:
    """Coordinate descent on the correlation matrix; predictors and outcome standardised, as in the usual R fit.

    Minimises 1/(2n) RSS + penalty * (mixture * L1 + (1 - mixture)/2 * L2) on that scale; returns intercept and slopes.
    """
    ix, iy = [m.cols.index(x) for x in xs], m.cols.index(y)
    sd = np.sqrt(np.diag(m.cov))
    ok = sd[ix] > 0
    scale = np.where(ok, sd[ix], 1.0)
    r = m.cov[np.ix_(ix, ix)] / np.outer(scale, scale)
    c = m.cov[ix, iy] / (scale * sd[iy])
    lam = penalty / sd[iy]
    w = np.zeros(len(xs))
    for _ in range(10_000):
        before = w.copy()
        for j in np.flatnonzero(ok):
            rho = c[j] - r[j] @ w + r[j, j] * w[j]
            w[j] = np.sign(rho) * max(abs(rho) - lam * mixture, 0) / (r[j, j] + lam * (1 - mixture))
        if np.abs(w - before).max() < tol:
            break
    beta = w * sd[iy] / scale
    return float(m.mean[iy] - beta @ m.mean[ix]), beta


def fold_moments(df: DataFrame, fold: str, cols: list[str]) -> tuple[Moments, dict]:
    """Moments of all rows and per fold; the total is the merge of the folds."""
    per = collect_moments(df, cols, fold)
    n = sum(m.n for m in per.values())
    mean = sum(m.n * m.mean for m in per.values()) / n
    cov = sum(m.n * (m.cov + np.outer(m.mean - mean, m.mean - mean)) for m in per.values()) / n
    return Moments(n, mean, cov, cols), per


def cv_fits(df: DataFrame, fold: str, y: str, xs: list[str], candidates: list[dict]) -> DataFrame:
    """Coefficients per fold and candidate, from one pass: rows (fold, config, b0, b)."""
    total, per = fold_moments(df, fold, xs + [y])
    rows = []
    for f, m in per.items():
        train = total.minus(m)
        for c in candidates:
            b0, b = elastic_net(train, y, xs, c.get("penalty", 0.0), c.get("mixture", 0.0))
            rows.append((f, c["config"], b0, [float(v) for v in b]))
    kind = dict(df.dtypes)[fold]
    return df.sparkSession.createDataFrame(rows, f"{fold} {kind}, config string, b0 double, b array<double>")


def cv_predictions(df: DataFrame, fold: str, y: str, xs: list[str], candidates: list[dict]) -> DataFrame:
    """Held-out prediction of every row by every candidate; the coefficient table has folds x candidates rows."""
    fits = F.broadcast(cv_fits(df, fold, y, xs, candidates))
    pred = F.col("b0")
    for i, x in enumerate(xs):
        pred = pred + F.col("b")[i] * F.col(x)
    return df.join(fits, fold).withColumn("pred", pred).drop("b0", "b")


def cv_metrics(df: DataFrame, fold: str, y: str, xs: list[str], candidates: list[dict]) -> DataFrame:
    """Metric rows (config, fold, metric, estimate): one pass fits everything, one pass scores everything."""
    p = cv_predictions(df, fold, y, xs, candidates)
    wide = p.groupBy("config", fold).agg(mt.rmse(y, "pred").alias("rmse"), mt.rsq(y, "pred").alias("rsq"), mt.mae(y, "pred").alias("mae"))
    return wide.unpivot(["config", fold], ["rmse", "rsq", "mae"], "metric", "estimate")


def cv_rmse(total: Moments, per: dict, y: str, xs: list[str], penalty: float, mixture: float) -> dict:
    """Held-out rmse per fold straight from the moments: no further pass over the rows."""
    out = {}
    ix, iy = [total.cols.index(x) for x in xs], total.cols.index(y)
    for f, m in per.items():
        b0, b = elastic_net(total.minus(m), y, xs, penalty, mixture)
        gap = m.mean[iy] - b0 - b @ m.mean[ix]
        mse = gap**2 + m.cov[iy, iy] - 2 * b @ m.cov[ix, iy] + b @ m.cov[np.ix_(ix, ix)] @ b
        out[f] = float(np.sqrt(mse))
    return out


def collect_metrics(results: DataFrame) -> DataFrame:
    """Mean, number of folds and standard error per candidate and metric."""
    return results.groupBy("config", "metric").agg(
        F.avg("estimate").alias("mean"), F.count("estimate").alias("n"), (F.stddev_samp("estimate") / F.sqrt(F.count("estimate"))).alias("std_err"))
