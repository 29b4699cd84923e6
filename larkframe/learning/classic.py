"""Learners that are closed forms over aggregates or neighbour search: discriminants, nearest neighbours, kernel features."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkframe.operators.moments import independent, inverse_on, moment_table, row_moments
from larkframe.operators.neighbors import knn


def argmax(scores: dict) -> Column:
    """Key of the largest score column; the first key wins ties."""
    top = F.greatest(*[F.col(c) for c in scores.values()])
    out = None
    for k, c in scores.items():
        out = F.when(F.col(c) == top, k) if out is None else out.when(F.col(c) == top, k)
    return out


def discriminant(train: DataFrame, y: str, xs: list[str]):
    """Linear discriminant: class means and the pooled covariance from one moment row per class.

    Columns that are constant within classes, or given by those before them, take no part.
    """
    k = len(xs)
    per = {r[y]: row_moments(r, xs) for r in moment_table(train, xs, [y]).collect()}  # one row per class
    n = sum(m.n for m in per.values())
    pooled = sum(m.n * m.cov for m in per.values()) / (n - len(per))
    inv = inverse_on(pooled, independent(pooled, sum(m.n * m.mean for m in per.values()) / n))

    def apply(df: DataFrame) -> DataFrame:
        out = df
        for c in sorted(per):
            m = per[c]
            w = inv @ m.mean
            s = F.lit(float(math.log(m.n / n) - 0.5 * m.mean @ w))
            for i in range(k):
                s = s + F.lit(float(w[i])) * F.col(xs[i])
            out = out.withColumn(f"score_{c}", s)
        return out.withColumn("pred", argmax({c: f"score_{c}" for c in sorted(per)}))
    return apply


def knn_vote(train: DataFrame, df: DataFrame, key: str, vec: str, y: str, k: int) -> DataFrame:
    """Majority class of the k nearest training rows; equal votes go to the smallest class."""
    near = knn(train, df, k, key=key, vec=vec, same=False)
    votes = near.join(train.select(F.col(key).alias("nid"), F.col(y).alias("_y")), "nid").groupBy("qid", "_y").agg(F.count(F.lit(1)).alias("_v"))
    best = votes.groupBy("qid").agg(F.max_by("_y", F.struct("_v", -F.col("_y"))).alias("pred"))  # at most k rows per query
    return df.join(best.withColumnRenamed("qid", key), key)


def fourier_features(xs: list[str], sigma: float, size: int, seed: int) -> list[Column]:
    """Random Fourier features of a Gaussian kernel exp(-sigma |a - b|^2) (Rahimi and Recht 2007)."""
    rng = np.random.default_rng(seed)
    w = rng.normal(0, math.sqrt(2 * sigma), (size, len(xs)))
    b = rng.uniform(0, 2 * math.pi, size)
    out = []
    for j in range(size):
        a = F.lit(float(b[j]))
        for i, x in enumerate(xs):
            a = a + F.lit(float(w[j, i])) * F.col(x)
        out.append((F.cos(a) * math.sqrt(2 / size)).alias(f"rff_{j}"))
    return out
