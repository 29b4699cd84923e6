"""k-medoids on a mixed-type distance.

The distance of two rows is the mean over the columns of |a - b| / range for numbers and of mismatch for categories; a column that is null in
either row is left out, and rows without a common column are at distance 1. There are no means under it, so centres are rows.

Build takes the medoid of least total distance, then again and again the one that lowers the total most. Swap then replaces a medoid by a
candidate while that lowers the total. What every swap would change follows from each row's two nearest medoids, so one pass
over all rows weighs all swaps of k medoids with all candidates; a task sends k x candidates sums, whatever its number of rows.

Candidates are ``candidates`` rows by digest, a new draw whenever a draw has no swap left, until ``draws`` draws in a row had none. A table with no
more distinct rows than that has all of them as candidates, and the result is that of build and swap over the whole table. The total is
always that of all rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkframe.operators.grouping import one_row
from larkframe.operators.hashing import digest
from larkframe.session import materialized

ROWS = 2048  # of one block of distances
LESS = 1e-9  # what a swap must gain, as sums differ in their last digits


@dataclass
class Medoids:
    rows: list  # one per cluster: key, numbers over their ranges, categories
    cost: float
    swaps: int
    passes: int


def scaled(df: DataFrame, key: str, numbers: list[str], categories: list[str]) -> DataFrame:
    """(key, x, c): numbers over the range of their column (a constant column gives no difference), categories as text."""
    span = one_row(df, **{n: F.max(n) - F.min(n) for n in numbers})
    unit = [F.col(n).cast("double") / F.lit(float(span[n]) if span[n] else 1.0) for n in numbers]
    texts = [F.col(c).cast("string") for c in categories]
    return df.select(key, F.array(*unit).cast("array<double>").alias("x"), F.array(*texts).cast("array<string>").alias("c"))


def _coded(batch: pd.DataFrame, words: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers, and categories as the numbers of the candidates' own words (-1 any other word, -2 null)."""
    x = np.array([[np.nan if v is None else v for v in row] for row in batch["x"]], dtype=float).reshape(len(batch), -1)
    c = np.array([[-2 if v is None else w.get(v, -1) for v, w in zip(row, words)] for row in batch["c"]], dtype=np.int64).reshape(len(batch), -1)
    return x, c


def block(x: np.ndarray, c: np.ndarray, mx: np.ndarray, mc: np.ndarray) -> np.ndarray:
    """Distances of the rows (x, c) to the rows (mx, mc)."""
    total, n = np.zeros((len(x), len(mx))), np.zeros((len(x), len(mx)))
    for j in range(x.shape[1]):
        d = np.abs(x[:, j, None] - mx[None, :, j])
        known = ~np.isnan(d)
        total += np.where(known, d, 0.0)
        n += known
    for j in range(c.shape[1]):
        known = (c[:, j, None] != -2) & (mc[None, :, j] != -2)
        total += known & (c[:, j, None] != mc[None, :, j])
        n += known
    return np.where(n > 0, total / np.maximum(n, 1), 1.0)


def _tables(rows: list) -> tuple[list[dict], np.ndarray, np.ndarray]:
    words = [{v: i for i, v in enumerate(sorted({r["c"][j] for r in rows if r["c"][j] is not None}))} for j in range(len(rows[0]["c"]))]
    return words, *_coded(pd.DataFrame({"x": [r["x"] for r in rows], "c": [r["c"] for r in rows]}), words)


def _sums(data: DataFrame, rows: list, of, shape: tuple[int, ...]) -> np.ndarray:
    """Over all rows the sum of ``of(distances to the rows)``, an array of the given shape."""
    words, mx, mc = _tables(rows)

    def add(batches):
        total = np.zeros(shape)
        for batch in batches:
            for a in range(0, len(batch), ROWS):
                total += of(block(*_coded(batch.iloc[a : a + ROWS], words), mx, mc))
        yield pd.DataFrame({"i": np.arange(total.size), "v": total.ravel()})

    out = np.zeros(int(np.prod(shape)))
    for r in data.mapInPandas(add, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r["i"]] = r["v"]
    return out.reshape(shape)


def _build(data: DataFrame, cand: list, k: int) -> tuple[list, float]:
    chosen: list = []
    cost = 0.0
    for _ in range(min(k, len(cand))):
        m, near = len(chosen), [*chosen, *cand]

        def gain(d, m=m):
            best = d[:, :m].min(axis=1, keepdims=True) if m else np.inf
            return np.minimum(d[:, m:], best).sum(axis=0)

        totals = _sums(data, near, gain, (len(cand),))
        at = int(np.argmin(np.round(totals, 9)))
        chosen.append(cand[at])
        cost = float(totals[at])
    return chosen, cost


def _swap(data: DataFrame, chosen: list, cand: list) -> np.ndarray:
    """Change of the total by putting candidate j in the place of medoid i, for all i and j."""
    k = len(chosen)

    def change(d):
        own, other = d[:, :k], d[:, k:]
        nearest = own.argmin(axis=1)
        two = np.partition(np.hstack([own, np.full((len(own), 1), np.inf)]), 1, axis=1)[:, :2]
        d1, d2 = two[:, :1], two[:, 1:]
        if_kept = np.minimum(other - d1, 0.0)
        out = np.tile(if_kept.sum(axis=0), (k, 1))
        for i in range(k):
            mine = nearest == i
            out[i] += (np.minimum(other[mine], d2[mine]) - d1[mine] - if_kept[mine]).sum(axis=0)
        return out

    return _sums(data, [*chosen, *cand], change, (k, len(cand)))


def k_medoids(df: DataFrame, key: str, numbers: list[str], categories: list[str], k: int, candidates: int = 256, draws: int = 3, most_swaps: int = 200) -> Medoids:
    """Medoids by build and swap; ties go to the smaller place in the draw."""
    data = materialized(scaled(df, key, numbers, categories))
    distinct = materialized(data.groupBy("x", "c").agg(F.min(key).alias(key)))
    whole = distinct.count() <= candidates

    def draw(i: int) -> list:
        order = [F.col(key)] if whole else [digest([key], f"medoid{i}"), F.col(key)]
        return distinct.orderBy(*order).limit(candidates).collect()  # at most ``candidates`` rows

    cand = draw(0)
    if not cand:
        return Medoids([], 0.0, 0, 0)
    chosen, cost = _build(data, cand, k)
    swaps, stale, round_, passes = 0, 0, 0, len(chosen)
    while swaps < most_swaps:
        change = _swap(data, chosen, cand)
        passes += 1
        i, j = divmod(int(np.argmin(np.round(change, 9))), len(cand))
        if change[i, j] < -LESS:
            chosen[i], cost, swaps, stale = cand[j], cost + float(change[i, j]), swaps + 1, 0
            continue
        stale += 1
        if whole or stale >= draws:
            break
        round_ += 1
        cand = draw(round_)
    chosen.sort(key=lambda r: r[key])
    return Medoids(chosen, cost, swaps, passes)


def distance(x: str, c: str, row) -> Column:
    """Distance of the columns (x, c) to one row, as an expression."""
    parts = [F.abs(F.col(x)[j] - F.lit(v)) for j, v in enumerate(row["x"])]
    parts += [(F.col(c)[j] != F.lit(v)).cast("double") for j, v in enumerate(row["c"])]
    n = sum((p.isNotNull().cast("int") for p in parts[1:]), parts[0].isNotNull().cast("int"))
    total = sum((F.coalesce(p, F.lit(0.0)) for p in parts[1:]), F.coalesce(parts[0], F.lit(0.0)))
    return F.when(n == 0, F.lit(1.0)).otherwise(F.try_divide(total, n))


def assigned(df: DataFrame, key: str, numbers: list[str], categories: list[str], model: Medoids) -> DataFrame:
    """(key, medoid, dist): the nearest medoid of every row, equal distances to the smaller key."""
    rows = scaled(df, key, numbers, categories)
    near = F.array_min(F.array(*[F.struct(distance("x", "c", m).alias("dist"), F.lit(m[key]).alias("medoid")) for m in model.rows]))
    return rows.select(key, near.alias("near")).select(key, "near.medoid", "near.dist")
