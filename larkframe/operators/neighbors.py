"""Exact k nearest neighbours by boxes of a k-d partition and bounds in two rounds.

A sample of the points, of bounded size, only says where to cut: halves along the widest side, until a cell is to hold some ``chunk`` points. Boxes are then
taken from all points of a cell. Round one searches every query's own cell; the k-th distance found there (or, where the cell is too small, to the
farthest corner of the box of a cell that holds k points) bounds the true k-th distance. Round two sends a query once to each other cell whose box is
within its bound. The result is exact. In a task the points of a cell are cut again, into leaves of ``leaf`` points, and a query
meets only leaves whose boxes are within its bound.

Cells are dealt in chunks and their queries salted, so a hot cell is many tasks; a task returns the k best of its chunk, never all pairs, and a
last pass per query keeps the k best of all chunks. No candidate is capped or sampled. Copies of one vector are searched once. Where vectors of many
dimensions have no structure every cell is in reach: all pairs are compared, a chunk of queries and a chunk of points in memory at a time.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkframe.operators.hashing import digest
from larkframe.session import shared_folder

CHUNK = 20_000
LEAF = 256
CELLS = 4096  # boxes that go to every task; cells grow beyond this, and are searched in chunks
NUMBERS = 1 << 21  # of the sample that says where to cut
PAIRS = 1 << 20  # distances in memory at a time


def distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """All distances between two small blocks, from differences (not from the expanded square) for exact ties."""
    out = np.zeros((len(a), len(b)))
    if a.shape[1] < 8:
        for k in range(a.shape[1]):
            d = a[:, k, None] - b[None, :, k]
            out += np.abs(d) if metric == "l1" else d * d
        return out if metric == "l1" else np.sqrt(out, out=out)
    step = max(1, PAIRS // max(1, b.size))
    for i in range(0, len(a), step):
        d = a[i:i + step, None, :] - b[None, :, :]
        out[i:i + step] = np.abs(d).sum(axis=2) if metric == "l1" else np.sqrt(np.einsum("ijk,ijk->ij", d, d))
    return out


def knn(
    points: DataFrame, queries: DataFrame, k: int, key: str = "id", vec: str = "vec", same: bool = True, metric: str = "l2",
    leaf: int = LEAF, chunk: int = CHUNK, tally: dict | None = None,
) -> DataFrame:
    """For every query the k nearest points: (``qid``, ``nid``, ``dist``, ``place``), ties by point key.

    ``same`` says that both frames hold the same keys and a row is not its own neighbour. Keys are whole numbers or
    text, ``vec`` is an array of doubles. The search runs on distinct vectors, each with its first few keys, so any
    number of copies of one vector is one point of the search. Vectors that are null or hold null or NaN are at no distance from any. ``tally`` is given the number of distinct (query, point)
    pairs in visited leaves and of all pairs.
    """
    shared_folder(points.sparkSession)
    need = k + 1 if same else k
    whole = ~F.exists(vec, lambda x: x.isNull() | F.isnan(x))  # null for no vector
    pts = points.where(whole).select(F.col(key).alias("nid"), F.col(vec).alias("pv"))
    qs = queries.where(whole).select(F.col(key).alias("qid"), F.col(vec).alias("qv"))
    first = Window.partitionBy("pv").orderBy("nid")  # the row limit is applied before the shuffle too
    keys = pts.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= need)
    keys = keys.withColumn("rep", F.min("nid").over(Window.partitionBy("pv"))).checkpoint()  # few rows of a vector are left
    reps = keys.where("_r = 1").select(F.col("rep").alias("nid"), "pv")
    members = keys.select("rep", "nid")
    asked = qs.groupBy("qv").agg(F.min("qid").alias("qid")).checkpoint()
    near = _search(reps, asked, need, metric, leaf, chunk, tally).withColumnRenamed("nid", "rep").join(members, "rep")
    w = Window.partitionBy("qid").orderBy("dist", "nid")  # at most need x need rows per distinct query
    near = near.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= need).select(F.col("qid").alias("_q"), "nid", "dist")
    owners = qs.join(asked.withColumnRenamed("qid", "_q"), "qv").select("qid", "_q")
    out = owners.join(near, "_q").drop("_q")
    if same:
        out = out.where(F.col("qid") != F.col("nid"))
    return out.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def _meet(left: DataFrame, right: DataFrame, fn, schema: str, chunk: int) -> DataFrame:
    """fn(rows of left, rows of right) for the rows of each cell, in parts of at most about ``chunk`` rows of either side."""

    def parts(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias(name))

    shape = parts(left, "_salts").join(parts(right, "_parts"), "cell", "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))

    def deal(n: str, columns: list[str]) -> Column:
        return F.pmod(F.xxhash64(*columns), F.col(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    a = left.join(shape, "cell").withColumn("_salt", deal("_salts", left.columns)).withColumn("_part", every("_parts"))
    b = right.join(shape, "cell").withColumn("_part", deal("_parts", right.columns)).withColumn("_salt", every("_salts"))
    group = ["cell", "_part", "_salt"]
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # small tables, much work: not fewer tasks
    a, b = (x.select(*[F.col(c).alias(c) for c in (*rows.columns, "_part", "_salt")]).repartition(n, *group) for x, rows in ((a, left), (b, right)))
    return a.groupBy(*group).cogroup(b.groupBy(*group)).applyInPandas(fn, schema)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64, copy=False)


def _none(**columns: str) -> pd.DataFrame:
    """No rows; an empty list would have a type that cannot become an array column."""
    return pd.DataFrame({name: pd.Series(dtype=kind) for name, kind in columns.items()})


def _within(qv: np.ndarray, bound: np.ndarray, pv: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, point, distance) of the pairs within the query's bound.

    For vectors of some length the expanded square leaves out what is farther than the bound and its rounding; the rest is from differences.
    """
    if metric == "l1" or qv.shape[1] < 8:
        d = distances(qv, pv, metric)
        i, j = np.nonzero(d <= bound[:, None])
        return i, j, d[i, j]
    q2, p2 = np.einsum("ij,ij->i", qv, qv), np.einsum("ij,ij->i", pv, pv)
    room = bound * bound * (1 + 1e-9) + 1e-11 * (q2 + p2.max())
    i, j = np.nonzero(q2[:, None] + p2[None, :] - 2 * (qv @ pv.T) <= room[:, None])
    dist = np.empty(len(i))
    step = max(1, PAIRS // qv.shape[1])
    for k in range(0, len(i), step):
        d = qv[i[k:k + step]] - pv[j[k:k + step]]
        dist[k:k + step] = np.sqrt(np.einsum("ij,ij->i", d, d))
    keep = dist <= bound[i]
    return i[keep], j[keep], dist[keep]


def _best_of(i: np.ndarray, nid: np.ndarray, dist: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` nearest of every query i, ties by point key."""
    o = np.lexsort((nid, dist, i))
    first = np.searchsorted(i[o], np.arange(i.max() + 1 if len(i) else 0))
    return o[np.arange(len(o)) - first[i[o]] < most] if len(o) else o


def _halve(x: np.ndarray, most: int) -> tuple[list[tuple], np.ndarray]:
    """A k-d partition of the rows into parts of at most ``most``: inner nodes (column, cut, left, right), with leaf i as -1 - i, and each row's leaf.

    Rows up to the cut are left. Rows are different, so that some column always splits them.
    """
    nodes, leaf, count = [], np.zeros(len(x), dtype=np.int64), 0
    todo = [(np.arange(len(x)), None)]
    while todo:
        rows, above = todo.pop()
        if len(rows) <= most or not (np.ptp(x[rows], axis=0) > 0).any():
            number, count = -1 - count, count + 1
            leaf[rows] = -1 - number
        else:
            v = x[rows]
            column = int(np.ptp(v, axis=0).argmax())
            v = v[:, column]
            cut = np.partition(v, (len(v) - 1) // 2)[(len(v) - 1) // 2]
            if cut == v.max():
                cut = v[v < cut].max()
            number = len(nodes)
            nodes.append([column, cut, None, None])
            todo += [(rows[v <= cut], (number, 2)), (rows[v > cut], (number, 3))]
        if above:
            nodes[above[0]][above[1]] = number
    return nodes, leaf


def _descend(nodes: list[list], x: np.ndarray) -> np.ndarray:
    """The leaf of every row."""
    out = np.zeros(len(x), dtype=np.int64)
    todo = [(0, np.arange(len(x)))] if nodes else []
    while todo:
        at, rows = todo.pop()
        if at < 0:
            out[rows] = -1 - at
        elif len(rows):
            column, cut, left, right = nodes[at]
            less = x[rows, column] <= cut
            todo += [(left, rows[less]), (right, rows[~less])]
    return out


def _to_boxes(q: np.ndarray, low: np.ndarray, high: np.ndarray, metric: str, farthest: bool = False) -> np.ndarray:
    """Distances of all queries to the nearest (or farthest) points of all boxes."""
    total = np.zeros((len(q), len(low)))
    for k in range(q.shape[1]):
        v = q[:, k, None]
        gap = np.maximum(np.abs(v - low[:, k]), np.abs(v - high[:, k])) if farthest else np.maximum(np.maximum(low[:, k] - v, v - high[:, k]), 0)
        total += gap if metric == "l1" else gap * gap
    return total if metric == "l1" else np.sqrt(total)


def _near(q: np.ndarray, bound: np.ndarray, low: np.ndarray, high: np.ndarray, metric: str) -> np.ndarray:
    """Which boxes can hold a point within the bound; rounding never leaves one out."""
    return ~(_to_boxes(q, low, high, metric) * (1 - 1e-12) - 1e-12 > bound[:, None])


def _nearest_in(qv: np.ndarray, bound: np.ndarray, pv: np.ndarray, pid: np.ndarray, need: int, metric: str, leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query, point, distance) of the ``need`` nearest points within the bound of every query, ties by the numbers ``pid``; and the pairs in visited leaves."""
    nodes, of = _halve(pv, max(leaf, need))
    o = np.argsort(of, kind="stable")
    pv, of, back = pv[o], of[o], o
    edge = np.append(np.flatnonzero(np.diff(of, prepend=-1)), len(of))
    low, high = np.minimum.reduceat(pv, edge[:-1]), np.maximum.reduceat(pv, edge[:-1])
    home, bound, met = _descend(nodes, qv), bound.copy(), 0
    for h in np.unique(home):  # the own leaf lowers the bound
        rows = np.flatnonzero(home == h)
        here = pv[edge[h]:edge[h + 1]]
        met += len(rows) * len(here)
        if len(here) >= need:
            for k in range(0, len(rows), max(1, PAIRS // len(here))):
                some = rows[k:k + max(1, PAIRS // len(here))]
                last = np.partition(distances(qv[some], here, metric), need - 1, axis=1)[:, need - 1]
                bound[some] = np.minimum(bound[some], last * (1 + 1e-12) + 1e-12)
    parts = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    step = max(1, PAIRS // len(low))
    for k in range(0, len(qv), step):
        q, b = qv[k:k + step], bound[k:k + step]
        near, got, held = _near(q, b, low, high, metric), [], 0
        met += int((near * np.diff(edge)).sum()) - int(np.diff(edge)[home[k:k + step]].sum())

        def best():
            i, j, dist = (np.concatenate(x) for x in zip(*got))
            keep = _best_of(i, pid[j], dist, need)
            return [(i[keep], j[keep], dist[keep])]

        for c in np.flatnonzero(near.any(axis=0)):
            ask = np.flatnonzero(near[:, c])
            for m in range(0, len(ask), max(1, PAIRS // int(edge[c + 1] - edge[c]))):
                some = ask[m:m + max(1, PAIRS // int(edge[c + 1] - edge[c]))]
                i, j, dist = _within(q[some], b[some], pv[edge[c]:edge[c + 1]], metric)
                got.append((some[i], back[j + edge[c]], dist))
                held += len(i)
                if held > PAIRS:
                    got, held = best(), 0
        if got:
            i, j, dist = best()[0]
            parts.append((i + k, j, dist))
    return *(np.concatenate(x) for x in zip(*parts)), met


def _search(pts: DataFrame, qs: DataFrame, need: int, metric: str, leaf: int, chunk: int, tally: dict | None) -> DataFrame:
    """The ``need`` nearest of the distinct points for every distinct query."""
    spark, kind = pts.sparkSession, dict(pts.dtypes)["nid"]
    met = spark.sparkContext.accumulator(0) if tally is not None else None
    size = pts.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("pv")).alias("d")).first()
    n, dims = size["n"], size["d"] or 1
    wide = "double"
    if dims >= 8 and all(rows.where(F.exists(c, lambda x: x.cast("float").cast("double") != x)).isEmpty() for rows, c in ((pts, "pv"), (qs, "qv"))):
        wide = "float"  # all numbers are floats: half the memory and half of what is sent
    cell = max(min(chunk, 2048), need, min(chunk, -(-n // (2 * spark.sparkContext.defaultParallelism))), -(-n // CELLS))
    nodes = []
    if n > cell:
        share = min(1.0, 64.0 / cell, NUMBERS / dims / n)
        drawn = pts.where(F.pmod(F.xxhash64("pv"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) + 1)).select("pv").toPandas()
        if len(drawn):
            x = _matrix(drawn["pv"])
            nodes, _ = _halve(x, max(1, round(cell * len(x) / n)))

    def placed(rows: DataFrame, key: str, vec: str) -> DataFrame:
        def place(batches):
            for batch in batches:
                if len(batch):
                    yield batch.assign(cell=_descend(nodes, _matrix(batch[vec])))

        return rows.select(key, F.col(vec).cast(f"array<{wide}>").alias(vec)).mapInPandas(place, f"{key} {kind}, {vec} array<{wide}>, cell long")

    points = placed(pts, "nid", "pv").checkpoint()
    home = placed(qs, "qid", "qv").withColumn("bound", F.lit(float("inf"))).checkpoint()

    def extent(g: pd.DataFrame) -> pd.DataFrame:
        x = _matrix(g["pv"])
        return pd.DataFrame({"cell": [g["cell"].iloc[0]], "n": [len(g)], "low": [x.min(axis=0)], "high": [x.max(axis=0)]})

    def extents(batches):
        for batch in batches:
            if len(batch):
                yield pd.concat([extent(g) for _, g in batch.groupby("cell")])

    some = points.select("cell", "pv").mapInPandas(extents, "cell long, n long, low array<double>, high array<double>")
    each = [F.min(F.col("low")[k]).alias(f"l{k}") for k in range(dims)] + [F.max(F.col("high")[k]).alias(f"h{k}") for k in range(dims)]
    boxes = some.groupBy("cell").agg(F.sum("n").alias("n"), *each).toPandas()  # at most some CELLS rows
    cells, counts = boxes["cell"].to_numpy(), boxes["n"].to_numpy()
    low, high = (boxes[[f"{e}{k}" for k in range(dims)]].to_numpy(dtype=float) for e in "lh")

    def best(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        if q.empty or p.empty:
            return _none(qid=q["qid"].dtype, nid=p["nid"].dtype, dist="float64")
        p = p.sort_values("nid", kind="stable")
        pid, qid = p["nid"].to_numpy(), q["qid"].to_numpy()
        i, j, dist, pairs = _nearest_in(_matrix(q["qv"]), q["bound"].to_numpy(), _matrix(p["pv"]), np.arange(len(p)), need, metric, leaf)
        if met is not None:
            met.add(pairs)
        return pd.DataFrame({"qid": qid[i], "nid": pid[j], "dist": dist})

    def found(q: DataFrame) -> DataFrame:
        return _meet(q.select("cell", "qid", "qv", "bound"), points, best, f"qid {kind}, nid {kind}, dist double", chunk)

    w = Window.partitionBy("qid").orderBy("dist", "nid")  # at most need rows per visited chunk

    def nearest(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_p", F.row_number().over(w)).where(F.col("_p") <= need).drop("_p")

    first = nearest(found(home)).checkpoint()
    if len(cells) > 1:
        last = first.groupBy("qid").agg(F.count(F.lit(1)).alias("_n"), F.max("dist").alias("_last"))
        # rounding may lift a computed distance over the bound it must meet
        limit = F.when(F.col("_n") >= need, F.col("_last") * (1 + 1e-12) + 1e-12).otherwise(F.lit(float("inf")))
        asked = home.drop("bound").join(last, "qid", "left").select("qid", "qv", F.col("cell").alias("own"), limit.alias("bound"))

        def sent(batches):
            step = max(1, min(1024, PAIRS // len(cells)))  # also bounds the vectors of what is given out
            for batch in batches:
                for k in range(0, len(batch), step):
                    g = batch.iloc[k:k + step]
                    qv, bound, own = _matrix(g["qv"]), g["bound"].to_numpy().copy(), g["own"].to_numpy()
                    open_ = np.isinf(bound)
                    if open_.any() and (counts >= need).any():
                        far = _to_boxes(qv[open_], low[counts >= need], high[counts >= need], metric, farthest=True)
                        bound[open_] = far.min(axis=1) * (1 + 1e-12) + 1e-12
                    i, j = np.nonzero(_near(qv, bound, low, high, metric) & (own[:, None] != cells[None, :]))
                    yield pd.DataFrame({"cell": cells[j], "qid": g["qid"].to_numpy()[i], "qv": g["qv"].to_numpy()[i], "bound": bound[i]})

        visits = asked.mapInPandas(sent, f"cell long, qid {kind}, qv array<{wide}>, bound double").checkpoint()
        first = first.unionByName(found(visits))
        first = nearest(first if tally is None else first.checkpoint())
    if tally is not None:
        tally["visited"], tally["all"] = met.value, n * qs.count()
    return first
