"""Means and co-moments per group in one aggregation, and the least-squares fits that follow from them."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Moments:
    n: int
    mean: np.ndarray
    cov: np.ndarray  # population covariance
    cols: list[str]

    def minus(self, other: "Moments") -> "Moments":
        """Moments of the rows of self that are not in other (training rows = all rows minus the fold)."""
        n = self.n - other.n
        mean = (self.n * self.mean - other.n * other.mean) / n
        d = other.mean - mean
        m2 = self.n * self.cov - other.n * other.cov - (n * other.n / self.n) * np.outer(d, d)
        return Moments(n, mean, m2 / n, self.cols)


def moment_table(df: DataFrame, cols: list[str], by: list[str] | None = None) -> DataFrame:
    """n, averages and population covariances of all column pairs; stable and mergeable, so it combines map-side."""
    pairs = list(combinations_with_replacement(range(len(cols)), 2))
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]
    aggs += [F.covar_pop(cols[i], cols[j]).alias(f"c{i}_{j}") for i, j in pairs]
    return df.groupBy(*(by or [])).agg(*aggs)


def row_moments(row, cols: list[str]) -> Moments:
    k = len(cols)
    cov = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            cov[i, j] = cov[j, i] = row[f"c{i}_{j}"]
    return Moments(row["n"], np.array([row[f"m{i}"] for i in range(k)], dtype=float), cov, cols)


def collect_moments(df: DataFrame, cols: list[str], by: str | None = None) -> dict:
    """Moments per value of ``by`` on the driver: a k x k matrix for each of a bounded set of groups (folds)."""
    rows = moment_table(df, cols, [by] if by else []).collect()
    return {(r[by] if by else None): row_moments(r, cols) for r in rows}


@dataclass
class Fit:
    intercept: float
    coef: np.ndarray
    rss: float
    n: int
    names: list[str]
    inv: np.ndarray  # inverse of the centred cross-product matrix
    centre: np.ndarray
    tss: float

    @property
    def rank(self) -> int:
        """Number of predictors with a coefficient; aliased ones have NaN."""
        return int((~np.isnan(self.coef)).sum())

    @property
    def sigma2(self) -> float:
        return self.rss / (self.n - self.rank - 1)

    @property
    def r2(self) -> float:
        return 1 - self.rss / self.tss

    def predict(self):
        """The fitted line as a column expression."""
        out = F.lit(float(self.intercept))
        for name, b in zip(self.names, self.coef):
            if not np.isnan(b):
                out = out + F.lit(float(b)) * F.col(name)
        return out

    def leverage(self):
        """x'(X'X)^-1 x of a row, as a column expression."""
        out = F.lit(1.0 / self.n)
        d = [F.col(c) - F.lit(float(m)) for c, m in zip(self.names, self.centre)]
        own = np.flatnonzero(~np.isnan(self.coef))
        for i in own:
            for j in own:
                out = out + F.lit(float(self.inv[i, j])) * d[i] * d[j]
        return out


#: Share of a column's variance that the columns before it must leave, for it to count as one of its own. Moments in double
#: precision cannot tell less from rounding.
ALIAS = 1e-10


def independent(cov: np.ndarray, mean: np.ndarray | None = None, tol: float = ALIAS) -> list[int]:
    """Columns that are no linear combination of those before them, by a Cholesky factor that passes over the others.

    A column whose variance is rounding of its mean is constant. Order decides which of several dependent columns stay: the first.
    """
    var = np.diag(cov)
    noise = 1e-24 * np.square(mean) if mean is not None else np.zeros(len(var))
    some = var > noise
    sd = np.sqrt(np.where(some, var, 1.0))
    corr = cov / np.outer(sd, sd)
    kept: list[int] = []
    low = np.zeros((len(var), len(var)))
    for j in np.flatnonzero(some):
        row = np.zeros(len(var))
        for k, i in enumerate(kept):
            row[k] = (corr[j, i] - row[:k] @ low[k, :k]) / low[k, k]
        left = corr[j, j] - row @ row
        if left > tol:
            row[len(kept)] = np.sqrt(left)
            low[len(kept)] = row
            kept.append(int(j))
    return kept


def inverse_on(cov: np.ndarray, kept: list[int]) -> np.ndarray:
    """Inverse over the kept columns, zero elsewhere: a generalised inverse of the whole."""
    out = np.zeros_like(cov, dtype=float)
    at = np.ix_(kept, kept)
    sd = np.sqrt(np.diag(cov)[kept])
    out[at] = np.linalg.inv(cov[at] / np.outer(sd, sd)) / np.outer(sd, sd)
    return out


def solve(m: Moments, y: str, xs: list[str], ridge: float = 0.0) -> Fit:
    """Least squares of y on xs; ``ridge`` adds n * ridge to the diagonal of the centred cross products.

    Without a ridge, constant columns and combinations of earlier columns are aliased: their coefficient is NaN.
    """
    ix = [m.cols.index(x) for x in xs]
    iy = m.cols.index(y)
    sxx = m.n * m.cov[np.ix_(ix, ix)]
    sxy = m.n * m.cov[ix, iy]
    kept = independent(sxx, np.sqrt(m.n) * m.mean[ix]) if ridge == 0 else list(range(len(ix)))
    inv = inverse_on(sxx + ridge * m.n * np.eye(len(ix)), kept)
    coef = inv @ sxy
    tss = m.n * m.cov[iy, iy]
    rss = float(tss - 2 * coef @ sxy + coef @ sxx @ coef)
    intercept = float(m.mean[iy] - coef @ m.mean[ix])
    coef[[i for i in range(len(ix)) if i not in kept]] = np.nan
    return Fit(intercept, coef, rss, m.n, xs, inv, m.mean[ix], float(tss))


def inflation(m: Moments) -> list[float | None]:
    """1 / (1 - R2) of every column on the others; null for a constant column or one that the others give exactly."""
    out: list[float | None] = []
    for j in range(len(m.cols)):
        rest = [i for i in range(len(m.cols)) if i != j]
        cov = m.cov[np.ix_(rest + [j], rest + [j])]
        kept = independent(cov, m.mean[rest + [j]])
        out.append(float(inverse_on(cov, kept)[-1, -1] * m.cov[j, j]) if len(rest) in kept else None)
    return out


def fit_ols(df: DataFrame, y: str, xs: list[str]) -> Fit:
    return solve(collect_moments(df, xs + [y])[None], y, xs)


def correlations(m: Moments) -> np.ndarray:
    sd = np.sqrt(np.diag(m.cov))
    with np.errstate(divide="ignore", invalid="ignore"):
        return m.cov / np.outer(sd, sd)
