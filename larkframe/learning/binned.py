"""Fits of many tree settings on the folds of one table, whose rows are read once for all of them.

A tree sees of a row only the bins that its predictors fall into. So all that the fits of a search need are, per fold, the cells (one bin of each predictor)
with the number of their rows and the sum and the sum of squares of the outcome: of the held-out rows, of the training rows, and of every bootstrap
replicate of these. One pass counts them; a fit then grows its trees on cells, as many as the bins allow, however many rows there are.

Thresholds are MLlib's, from the same sample of a fold's training rows, as are bins, split rule (largest loss of variance, first of equals), least rows of a
node and depth. A replicate takes every training row as often as a Poisson(1) number says, drawn for row and replicate.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkframe.learning.models import SEED
from larkframe.session import materialized

BINS = 32
CELLS = 1 << 16  # of a fold; a tally holds the cells of all folds and replicates of a task's rows
BUFFER = 100_000  # rows counted at a time
HELD, WHOLE = -1, 0  # bags of a fold: held-out rows, training rows; replicates are 1, 2, ...


def thresholds(values: np.ndarray, expected: float, most: int) -> np.ndarray:
    """Where MLlib cuts a predictor, from a sample of its values of which ``expected`` were to be drawn (missing ones count as zeros)."""
    seen, counts = np.unique(values[values != 0], return_counts=True)
    if not len(seen):
        return np.zeros(0)
    counts, zeros = counts.astype(float), expected - counts.sum()
    if zeros > np.finfo(float).eps * counts.sum() * 100:
        at = np.searchsorted(seen, 0.0)
        seen, counts = np.insert(seen, at, 0.0), np.insert(counts, at, zeros)
    middle = (seen[:-1] + seen[1:]) / 2
    if len(middle) <= most:
        return middle
    out, stride, now = [], expected / (most + 1), counts[0]
    goal = stride
    for i in range(1, len(seen)):
        before, now = now, now + counts[i]
        if abs(before - goal) < abs(now - goal):
            out.append(middle[i - 1])
            goal += stride
    return np.array(out)


def cuts(train: DataFrame, xs: list[str], n: int) -> list[np.ndarray]:
    """Thresholds of every predictor from the sample that MLlib draws of ``n`` training rows."""
    if not n:
        raise ValueError("no training rows")
    share = min(1.0, max(BINS * BINS, 10_000) / n)
    rows, spark = train.select(*xs), train.sparkSession
    if share < 1:
        seed = spark._jvm.org.apache.spark.util.random.XORShiftRandom(SEED).nextInt()
        drawn = rows._jdf.toJavaRDD().sample(False, share, seed)
        rows = DataFrame(spark._jsparkSession.createDataFrame(drawn, rows._jdf.schema()), spark)
    got = rows.toPandas()
    return [thresholds(got[x].to_numpy(dtype=float), share * n, min(BINS, n) - 1) for x in xs]


@dataclass
class Binned:
    """Per fold and bag one row of ``table`` with its cells; ``shape`` are the bins of every predictor by fold."""

    table: DataFrame
    shape: dict[int, tuple[int, ...]]

    def bags(self, fold: int, held: bool = False) -> DataFrame:
        mine = self.table.where(F.col("fold") == fold)
        return mine.where(F.col("bag") == HELD if held else F.col("bag") != HELD)


def binned(df: DataFrame, fold: str, y: str, xs: list[str], bags: int = 0) -> Binned:
    """The cells of all folds: of the training rows, or with ``bags`` of that many replicates of them."""
    rows = df.groupBy(fold).agg(F.count(F.lit(1)).alias("n"), F.avg(y).alias("mean")).collect()
    total, middle = sum(r["n"] for r in rows), float(np.mean([r["mean"] or 0.0 for r in rows]))  # only keeps sums of squares small
    folds = sorted(r[fold] for r in rows)
    size = {r[fold]: r["n"] for r in rows}
    points = {f: cuts(df.where(F.col(fold) != f), xs, total - size[f]) for f in folds}
    shape = {f: tuple(len(c) + 1 for c in points[f]) for f in folds}
    if max(int(np.prod(s)) for s in shape.values()) > CELLS:
        raise ValueError(f"more than {CELLS} cells of {len(xs)} predictors")

    def tally(batches):
        rng = np.random.default_rng([SEED, TaskContext.get().partitionId()])
        first = 1 if bags else WHOLE
        sums = {f: np.zeros((1 + max(bags, 1), 3, int(np.prod(shape[f])))) for f in folds}  # held-out rows, then bags

        def add(table: pa.Table) -> None:
            own, v = table[fold].to_numpy(), table[y].to_numpy()
            x = [table[c].to_numpy() for c in xs]
            if table.column(y).null_count or not np.isfinite(v).all() or any(table.column(c).null_count or np.isnan(a).any() for c, a in zip(xs, x)):
                raise ValueError(f"null or NaN in {y}, {', '.join(xs)}")
            v = v - middle
            weight = rng.poisson(1.0, (len(v), bags)).astype(float) if bags else None
            for f in folds:
                cell = np.ravel_multi_index([np.searchsorted(c, a) for c, a in zip(points[f], x)], shape[f])
                n_cells, out = sums[f].shape[2], own == f
                for bag, rows in [(0, out)] if bags else [(0, out), (1, ~out)]:
                    c, u = cell[rows], v[rows]
                    for k, w in enumerate((None, u, u * u)):
                        sums[f][bag, k] += np.bincount(c, w, n_cells)
                if bags:
                    order = np.flatnonzero(~out)
                    if len(order):
                        order = order[np.argsort(cell[order], kind="stable")]
                        c, w, u = cell[order], weight[order], v[order][:, None]
                        start = np.flatnonzero(np.diff(c, prepend=-1))
                        for k in range(3):
                            sums[f][1:, k, c[start]] += np.add.reduceat(w, start, axis=0).T
                            w = w * u

        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n >= BUFFER:
                add(pa.Table.from_batches(held))
                held, n = [], 0
        if n:
            add(pa.Table.from_batches(held))
        for f in folds:
            for at in range(len(sums[f])):
                cell = np.flatnonzero(sums[f][at, 0])
                if len(cell):
                    n, s, q = sums[f][at][:, cell]
                    bag = HELD if at == 0 else first + at - 1
                    yield pa.RecordBatch.from_pydict({"fold": np.full(len(cell), f, "int32"), "bag": np.full(len(cell), bag, "int32"), "cell": cell.astype("int32"), "n": n, "s": s, "q": q})

    cells = df.select(F.col(fold).cast("int").alias(fold), F.col(y).cast("double").alias(y), *[F.col(x).cast("double").alias(x) for x in xs]).mapInArrow(
        tally, "fold int, bag int, cell int, n double, s double, q double")
    cells = cells.groupBy("fold", "bag", "cell").agg(*[F.sum(c).alias(c) for c in ("n", "s", "q")])

    def packed(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("cell")
        return pd.DataFrame({"fold": [g["fold"].iloc[0]], "bag": [g["bag"].iloc[0]], "cell": [g["cell"].to_numpy("int32").tobytes()],
                             "sums": [g[["n", "s", "q"]].to_numpy("float64").T.tobytes()]})

    return Binned(materialized(cells.groupBy("fold", "bag").applyInPandas(packed, "fold int, bag int, cell binary, sums binary")), shape)


def grow(sums: np.ndarray, depth: int, min_n: int, mtry: int, rng: np.random.Generator) -> list[tuple]:
    """Leaves (lows, highs, value) of a tree on n, sum and sum of squares by cell, breadth first; ``mtry`` predictors are drawn for every node."""
    dims = sums.ndim - 1

    def split(low: list[int], high: list[int]) -> tuple | None:
        box = sums[(slice(None), *map(slice, low, high))]
        n, s, q = box.reshape(3, -1).sum(axis=1)
        best, found = 0.0, None
        for k in sorted(rng.permutation(dims)[:mtry]) if mtry < dims else range(dims):
            if high[k] - low[k] < 2:
                continue
            left = np.cumsum(box.sum(axis=tuple(a + 1 for a in range(dims) if a != k)), axis=1)[:, :-1]
            right = np.array([[n], [s], [q]]) - left
            ok = (left[0] >= max(min_n, 1)) & (right[0] >= max(min_n, 1))
            with np.errstate(divide="ignore", invalid="ignore"):
                lost = sum(x[2] - x[1] ** 2 / x[0] for x in (left, right))
            gain = np.where(ok, ((q - s * s / n) - lost) / n, -np.inf)
            if gain.max() > best:
                best, found = gain.max(), (k, low[k] + 1 + int(gain.argmax()))
        return found

    leaves, level = [], [([0] * dims, list(sums.shape[1:]))]
    for d in range(depth + 1):
        below = []
        for low, high in level:
            at = split(low, high) if d < depth else None
            if at is None:
                n, s, _ = sums[(slice(None), *map(slice, low, high))].reshape(3, -1).sum(axis=1)
                leaves.append((low, high, s / n))
            else:
                k, edge = at
                below += [(low, [*high[:k], edge, *high[k + 1:]]), ([*low[:k], edge, *low[k + 1:]], high)]
        level = below
    return leaves


def fit(data: Binned, fold: int, depth: int = 5, min_n: int = 1, mtry: int | None = None) -> list:
    """The leaves of one tree per bag of the fold's training rows; a Spark job in which every bag is a row."""
    shape = data.shape[fold]

    def trees(batches):
        for batch in batches:
            for bag, cell, sums in zip(batch["bag"], batch["cell"], batch["sums"]):
                cell = np.frombuffer(cell, "int32")
                whole = np.zeros((3, int(np.prod(shape))))
                whole[:, cell] = np.frombuffer(sums).reshape(3, -1)
                leaves = grow(whole.reshape(3, *shape), depth, min_n, mtry or len(shape), np.random.default_rng([SEED, bag]))
                yield pd.DataFrame([(bag, *leaf) for leaf in leaves], columns=["bag", "low", "high", "value"])

    return data.bags(fold).mapInPandas(trees, "bag int, low array<int>, high array<int>, value double").collect()


def rmse(data: Binned, fold: int, leaves: list) -> float:
    """Error of the mean of the trees on the fold's held-out rows, from the sums of their cells."""
    shape, bags = data.shape[fold], len({r["bag"] for r in leaves})
    boxes = [(tuple(map(slice, r["low"], r["high"])), r["value"]) for r in leaves]

    def scored(batches):
        pred = np.zeros(shape)
        for box, value in boxes:
            pred[box] += value / bags
        for batch in batches:
            for cell, sums in zip(batch["cell"], batch["sums"]):
                p = pred.ravel()[np.frombuffer(cell, "int32")]
                n, s, q = np.frombuffer(sums).reshape(3, -1)
                yield pd.DataFrame({"n": [n.sum()], "sse": [(q - 2 * p * s + p * p * n).sum()]})

    return data.bags(fold, held=True).mapInPandas(scored, "n double, sse double").agg(F.sqrt(F.sum("sse") / F.sum("n")).alias("rmse")).first()["rmse"]


def fold_fits(data: Binned, settings: Callable, threads: int = 4) -> Callable[[list[tuple]], list[float]]:
    """``run`` for a search over tree settings: ``settings(candidate)`` gives depth, min_n and mtry; the score is the rmse on the held-out rows."""

    def one(task: tuple) -> float:
        candidate, f = task
        return rmse(data, f, fit(data, f, **settings(candidate)))

    def run(tasks: list[tuple]) -> list[float]:
        with ThreadPoolExecutor(threads) as pool:
            return list(pool.map(inheritable_thread_target(data.table.sparkSession)(one), tasks))

    return run
