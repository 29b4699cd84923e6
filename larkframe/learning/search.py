"""Searches whose steps are distributed fits: racing over folds, and Bayesian optimisation with several points in flight.

A search decides which (candidate, fold) fits to run next and gives them to ``run`` as one list; ``run`` fits them on Spark, several at a time, and
returns their scores (smaller is better). Nothing is fitted that the search has not asked for.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkframe.functions import tails
from larkframe.learning import metrics as mt

Task = tuple  # (candidate, fold)


def fold_fits(df: DataFrame, fold: str, y: str, fit: Callable, threads: int = 4) -> Callable[[list[Task]], list[float]]:
    """``run`` for candidates that need a Spark fit: ``fit(candidate, train)`` gives a scorer that adds ``pred``; the score is the rmse."""

    def one(task: Task) -> float:
        candidate, f = task
        scored = fit(candidate, df.where(F.col(fold) != f))(df.where(F.col(fold) == f))
        return scored.agg(mt.rmse(y, "pred").alias("rmse")).first()["rmse"]

    def run(tasks: list[Task]) -> list[float]:
        with ThreadPoolExecutor(threads) as pool:
            return list(pool.map(inheritable_thread_target(df.sparkSession)(one), tasks))

    return run


def behind(scores: np.ndarray, alpha: float) -> np.ndarray:
    """Which rows (candidates) of candidates x folds are worse than the best one.

    Repeated measures: score = candidate + fold + rest. The rest of all candidates gives one variance with (candidates - 1) (folds - 1)
    degrees of freedom; a candidate is behind when its lead over the best, against that variance, is significant one-sided.
    """
    c, f = scores.shape
    means = scores.mean(axis=1)
    rest = scores - means[:, None] - scores.mean(axis=0)[None, :] + scores.mean()
    df = (c - 1) * (f - 1)
    gap = means - means.min()
    error = math.sqrt(2 * float((rest**2).sum()) / df / f)
    if error == 0:
        return gap > 0
    p = np.array([tails.t_two_sided(g / error, df) / 2 if g > 0 else 1.0 for g in gap])
    return p <= alpha


def race(run: Callable[[list[Task]], list[float]], candidates: list, folds: list, burn_in: int = 3, num_ties: int = 5, alpha: float = 0.05) -> tuple[list[dict], int]:
    """All candidates on the first ``burn_in`` folds, then fold by fold only those that are not behind.

    Two candidates that stay level for ``num_ties`` folds after the burn-in are a tie: the one with the better mean goes on alone. One row per
    candidate (mean, n folds, finished), and the number of fits.
    """
    scores: dict = {c: [] for c in candidates}
    alive, fits, level = list(candidates), 0, 0

    def go(fs: list) -> int:
        tasks = [(c, f) for f in fs for c in alive]
        for (c, _), s in zip(tasks, run(tasks)):
            scores[c].append(s)
        return len(tasks)

    fits += go(folds[:burn_in])
    for f in [*folds[burn_in:], None]:
        if len(alive) > 1:
            lost = behind(np.array([scores[c] for c in alive]), alpha)
            alive = [c for c, out in zip(alive, lost) if not out]
            level = level + 1 if len(alive) == 2 else 0
            if level >= num_ties:
                alive = [min(alive, key=lambda c: np.mean(scores[c]))]
        if f is None:
            break
        fits += go([f])
    rows = [{"config": c, "mean": float(np.mean(v)), "n": len(v), "finished": int(c in alive)} for c, v in scores.items()]
    return rows, fits


# Bayesian optimisation

def _kernel(a: np.ndarray, b: np.ndarray, length: float) -> np.ndarray:
    """Matern 5/2."""
    r = np.sqrt(np.maximum(((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2), 0)) * math.sqrt(5) / length
    return (1 + r + r * r / 3) * np.exp(-r)


class Surrogate:
    """Gaussian process on scaled scores; length and noise are those of largest marginal likelihood on a small grid."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.x, self.mean, self.scale = x, y.mean(), y.std() or 1.0
        z = (y - self.mean) / self.scale
        best = -math.inf
        for length in (0.15, 0.3, 0.6, 1.2):
            for noise in (1e-6, 1e-3, 1e-1):
                low = np.linalg.cholesky(_kernel(x, x, length) + noise * np.eye(len(x)))
                half = np.linalg.solve(low, z)
                likelihood = -0.5 * half @ half - np.log(np.diag(low)).sum()
                if likelihood > best:
                    best, self.length, self.low, self.weights = likelihood, length, low, np.linalg.solve(low.T, half)

    def __call__(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = _kernel(at, self.x, self.length)
        half = np.linalg.solve(self.low, k.T)
        return self.mean + self.scale * (k @ self.weights), self.scale * np.sqrt(np.maximum(1 - (half**2).sum(axis=0), 1e-12))


def expected_improvement(mu: np.ndarray, sd: np.ndarray, best: float) -> np.ndarray:
    g = (best - mu) / sd
    cdf = 0.5 * (1 + np.array([math.erf(v / math.sqrt(2)) for v in g]))
    return (best - mu) * cdf + sd * np.exp(-0.5 * g * g) / math.sqrt(2 * math.pi)


def propose(space: np.ndarray, seen: list[int], scores: list[float], n: int, explore: bool = False) -> list[int]:
    """The next ``n`` places of the space. Each proposal is taken as scored by the mean there, so that the following ones go elsewhere."""
    seen, scores, out = list(seen), list(scores), []
    for _ in range(min(n, len(space) - len(set(seen)))):
        gp = Surrogate(space[seen], np.array(scores))
        left = np.setdiff1d(np.arange(len(space)), seen)
        mu, sd = gp(space[left])
        i = int(left[np.argmax(sd if explore else expected_improvement(mu, sd, min(scores)))])
        out.append(i)
        scores.append(float(mu[list(left).index(i)]))
        seen.append(i)
    return out


def bayes(
    run: Callable[[list[Task]], list[float]], points: list[dict], folds: list, initial: int = 5, iters: int = 10, no_improve: int = 5,
    uncertain: int = 5, in_flight: int = 2, seed: int = 1,
) -> list[dict]:
    """Minimise the mean score over the folds on a list of points (dicts of numbers or of codes).

    ``initial`` points at random, then up to ``iters`` more by expected improvement, ``in_flight`` at a time with all their folds. After ``uncertain``
    points without improvement one step takes the points known least; after ``no_improve`` such points the search ends.
    """
    raw = np.array([[float(v) for v in p.values()] for p in points])
    low, span = raw.min(axis=0), np.ptp(raw, axis=0)
    space = (raw - low) / np.where(span > 0, span, 1.0)
    rng = np.random.default_rng(seed)
    chosen = [int(i) for i in rng.permutation(len(points))[:initial]]
    seen, scores, rows = [], [], []

    def go(places: list[int], it: int, how: str) -> None:
        tasks = [(i, f) for i in places for f in folds]
        got = np.array(run(tasks)).reshape(len(places), len(folds)).mean(axis=1)
        for i, s in zip(places, got):
            seen.append(i)
            scores.append(float(s))
            rows.append({"iter": it, "how": how, **points[i], "mean": float(s)})

    go(chosen, 0, "random")
    done = stale = calm = 0
    while done < iters and stale < no_improve and len(seen) < len(points):
        explore = calm >= uncertain
        places = propose(space, seen, scores, min(in_flight, iters - done), explore)
        best = min(scores)
        done += len(places)
        go(places, done, "uncertain" if explore else "improvement")
        better = min(scores) < best
        stale = 0 if better else stale + len(places)
        calm = 0 if better or explore else calm + len(places)
    return rows
