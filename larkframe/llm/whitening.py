"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its triangular factor.

The entries of a vector become whole numbers x = floor(64 c) + 1,000,000. The fit list holds every distinct x once: its number n and sums S are
exact. Each task centres its part of the list exactly (n x - S is a whole number) and adds up the products; rows of the scatter
are summed per dimension, so no task holds more than one table of dims x dims. The covariance V = L L' is factored with pivoting, which
stops where what is left is rounding; rotations then make the columns of L orthogonal. Their squared lengths are the eigenvalues of V, the columns
over their lengths its eigenvectors, found to full relative accuracy without forming a product of L with itself.

Vectors of different lengths are fitted apart, each length with its own n, S and components; more than ``MOST_LENGTHS`` lengths are an error.
The model that goes to every task is (mean, 16 components) per length, so its size is bounded by the dimensions.

Defined cases: vectors that are null, or hold null or non-finite entries, and empty vectors give no rows; components whose eigenvalue is
rounding (rank below 16, as for constant columns, few or equal rows) are left out, so a table with one distinct vector gives no rows; copies
count once in the fit and each gives its own rows; rows that repeat vec_id are rows of their own; of equal eigenvalues any orthogonal choice
is a right one; the entry of largest size in a component is positive. Entries beyond 2^40 / 64, and n times the largest x beyond 62 bits, are an
error. Deviations are decimals of 38 digits; the query gives them as long, null where they leave 63 bits. Other columns are not looked at.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkframe.llm.common import lengths_of, written
from larkframe.llm.registry import query, table

UNIT, SHIFT = 64, 1_000_000
COMPONENTS = 16
LARGEST = float(1 << 40)
MOST_LENGTHS = 256
ROWS = 4096  # vectors of one matrix product
WIDE = pa.decimal128(38, 0)


def whole_vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, x) of the usable vectors of a list column, per length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.asarray(column.value_lengths().fill_null(0))
    flat = column.flatten()
    entries = np.asarray(flat.cast(pa.float64()).fill_null(np.nan))
    ends = np.cumsum(sizes)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(entries))])
    sound = (sizes > 0) & (bad[ends] == bad[ends - sizes])
    for dims in np.unique(sizes[sound]):
        places = np.flatnonzero(sound & (sizes == dims))
        x = np.floor(UNIT * entries[(ends[places] - dims)[:, None] + np.arange(dims)])
        if np.abs(x).max() > LARGEST:
            raise ValueError("an entry is too large for exact sums")
        yield places, x.astype(np.int64) + SHIFT


def _lists(batches) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            part = batch.slice(a, ROWS)
            yield part, part.column("embedding")


def _grids(batches) -> Iterator[np.ndarray]:
    """Matrices of the x of a fit list, read back from their bytes; rows of one batch are grouped by length."""
    for batch in batches:
        dims = np.asarray(batch.column("dims"))
        for d in np.unique(dims):
            x = batch.column("x").filter(pa.array(dims == d)).to_pylist()
            for a in range(0, len(x), ROWS):
                yield np.frombuffer(b"".join(x[a : a + ROWS]), dtype="<i8").reshape(-1, d)


def fit_list(vectors: DataFrame) -> DataFrame:
    """(dims, x): every distinct x once, as the bytes of 64-bit numbers."""
    schema = pa.schema([("dims", pa.int32()), ("x", pa.binary())])

    def bytes_of(batches):
        for _, column in _lists(batches):
            for _, x in whole_vectors(column):
                rows = [r.tobytes() for r in np.ascontiguousarray(x, dtype="<i8")]
                yield pa.record_batch([pa.array([x.shape[1]] * len(rows), pa.int32()), pa.array(rows, pa.binary())], schema)

    return written(vectors.select("embedding").mapInArrow(bytes_of, "dims int, x binary").distinct(), "fit-list")


def sums(fit: DataFrame) -> dict[int, tuple[int, np.ndarray]]:
    """(n, S) by length, exact; each task sends one row per length and dimension, Spark adds them up as decimals of 38 digits."""
    schema = pa.schema([("dims", pa.int32()), ("i", pa.int32()), ("n", pa.int64()), ("s", pa.int64()), ("top", pa.int64())])

    def add(batches):
        got: dict[int, list] = {}
        for x in _grids(batches):
            n, s, top = got.setdefault(x.shape[1], (0, np.zeros(x.shape[1], dtype=np.int64), np.zeros(x.shape[1], dtype=np.int64)))
            got[x.shape[1]] = (n + len(x), s + x.sum(axis=0), np.maximum(top, np.abs(x).max(axis=0)))
        for d, (n, s, top) in got.items():
            yield pa.record_batch([pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array(s), pa.array(top)], schema)

    rows = fit.mapInArrow(add, "dims int, i int, n long, s long, top long").groupBy("dims", "i").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.max("top").alias("top"))
    out: dict[int, tuple[int, np.ndarray]] = {}
    for r in rows.collect():  # as many rows as the lengths have dimensions
        if r.n * r.top >= 1 << 62:
            raise ValueError("sums leave 63 bits")
        s = out.setdefault(r.dims, (r.n, np.zeros(r.dims, dtype=np.int64)))[1]
        s[r.i] = int(r.s)
    return out


def centred(x: np.ndarray, n: int, s: np.ndarray) -> np.ndarray:
    """x - S / n from the exact n x - S."""
    return (n * x - s) / n


def squares(whole: np.ndarray) -> pa.Array:
    """Sum of the squares of every row, exact: in 64 bits where it fits, else in whole numbers of any size."""
    if (np.square(whole.astype(float)).sum(axis=1) < 2.0**62).all():
        return pa.array((whole * whole).sum(axis=1)).cast(WIDE)
    return pa.array([Decimal(sum(v * v for v in row)) for row in whole.tolist()], WIDE)


def scatter(fit: DataFrame, totals: dict[int, tuple[int, np.ndarray]], view=None) -> dict[int, np.ndarray]:
    """Per length the mean of centred products, V; with ``view`` (length to matrix) of the rows after that matrix.

    A task sends one row per length and dimension; the rows of a dimension are added where its key leads.
    """
    schema = pa.schema([("dims", pa.int32()), ("i", pa.int32()), ("row", pa.list_(pa.float64()))])

    def rows_of(got: dict[int, np.ndarray]):
        for d, m in got.items():
            yield pa.record_batch([pa.array([d] * len(m), pa.int32()), pa.array(range(len(m)), pa.int32()), pa.array(list(m), pa.list_(pa.float64()))], schema)

    def multiply(batches):
        got: dict[int, np.ndarray] = {}
        for x in _grids(batches):
            d = x.shape[1]
            c = centred(x, *totals[d])
            if view is not None:
                if d not in view:
                    continue
                c = c @ view[d]
            got[d] = got.get(d, 0) + c.T @ c
        yield from rows_of(got)

    def add(batches):
        got: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for d, i, row in zip(*(batch.column(c).to_pylist() for c in ("dims", "i", "row"))):
                got[d, i] = got.get((d, i), 0) + np.array(row)
        for (d, i), row in got.items():
            yield pa.record_batch([pa.array([d], pa.int32()), pa.array([i], pa.int32()), pa.array([row], pa.list_(pa.float64()))], schema)

    kind = "dims int, i int, row array<double>"
    out: dict[int, np.ndarray] = {}
    for r in fit.mapInArrow(multiply, kind).repartition("dims", "i").mapInArrow(add, kind).collect():  # dims x dims numbers per length
        out.setdefault(r.dims, np.zeros((len(r.row), len(r.row))))[r.i] = r.row
    return {d: m / totals[d][0] for d, m in out.items()}


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """L (dims x rank, rows in the order of v) with v = L L'; the largest remaining diagonal entry is the next pivot."""
    left = np.diag(v).copy()
    bar = len(v) * np.finfo(float).eps * max(left.max(initial=0.0), 0.0)
    factor = np.zeros(v.shape)
    for r in range(len(v)):
        p = int(np.argmax(left))
        if not left[p] > bar:
            return factor[:, :r]
        column = v[:, p] - factor[:, :r] @ factor[p, :r]
        factor[:, r] = column / np.sqrt(left[p])
        left -= factor[:, r] ** 2
        left[p] = 0.0
    return factor


def _rounds(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Disjoint pairs of 0..n-1, n - 1 rounds that meet every pair once (n even)."""
    ring = list(range(1, n))
    for _ in range(n - 1):
        line = [0, *ring]
        yield np.array(line[: n // 2]), np.array(line[n // 2 :][::-1])
        ring = ring[-1:] + ring[:-1]


def jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, eigenvectors as columns) of factor @ factor.T, by rotations of its columns until all are orthogonal."""
    a = np.array(factor, dtype=float)
    if a.shape[1] % 2:
        a = np.hstack([a, np.zeros((len(a), 1))])
    tiny = len(a) * np.finfo(float).eps
    for _ in range(sweeps):
        turned = False
        for i, j in _rounds(a.shape[1]):
            x, y = a[:, i], a[:, j]
            alpha, beta, gamma = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            on = np.abs(gamma) > tiny * np.sqrt(alpha * beta)
            if not on.any():
                continue
            turned = True
            zeta = np.where(on, (beta - alpha) / np.where(on, 2 * gamma, 1.0), 0.0)
            t = np.where(on, np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            c = 1 / np.hypot(1.0, t)
            a[:, i], a[:, j] = c * (x - t * y), c * (t * x + y)
        if not turned:
            break
    else:
        raise ArithmeticError("rotations did not come to an end")
    norms = np.sqrt((a * a).sum(axis=0))
    order = [k for k in np.argsort(-norms, kind="stable") if norms[k] > 0]
    vectors = a[:, order] / norms[order]
    signs = np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(len(order))])
    return norms[order] ** 2, vectors * signs


def components(v: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    values, vectors = jacobi(pivoted_cholesky(v))
    sure = values > len(v) ** 2 * np.finfo(float).eps * values.max(initial=0.0)
    return values[sure][:most], vectors[:, sure][:, :most]


def whitened(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """(vec_id, dims, component, n, deviation, whitened, explained, identity_error) of every usable vector and component."""
    fit = fit_list(vectors)
    lengths_of(fit, MOST_LENGTHS)
    totals = sums(fit)
    model = {}
    for d, v in scatter(fit, totals).items():
        values, axes = components(v, most)
        if len(values):
            model[d] = (values / np.trace(v), axes / np.sqrt(values))
    unit = scatter(fit, totals, {d: w for d, (_, w) in model.items()})  # keyed by length, components x components
    error = {d: float(np.abs(m - np.eye(len(m))).max()) for d, m in unit.items()}
    id_type = pa.string() if dict(vectors.dtypes)["vec_id"] == "string" else pa.int64()
    kind = "string" if id_type == pa.string() else "long"
    schema = pa.schema([("vec_id", id_type), ("dims", pa.int32()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", WIDE),
                        ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])

    def project(batches):
        for batch, column in _lists(batches):
            ids = batch.column("vec_id").cast(id_type)
            for places, x in whole_vectors(column):
                d = x.shape[1]
                if d not in model:
                    continue
                (n, s), (share, axes) = totals[d], model[d]
                apart = n * x - s
                k = axes.shape[1]
                yield pa.record_batch([
                    ids.take(pa.array(np.repeat(places, k))), pa.array(np.full(len(x) * k, d, dtype=np.int32)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(x) * k, n, dtype=np.int64)),
                    squares(apart).take(pa.array(np.repeat(np.arange(len(x)), k))), pa.array((apart / n @ axes).ravel()),
                    pa.array(np.tile(share, len(x))), pa.array(np.full(len(x) * k, error[d]))], schema)

    return vectors.select("vec_id", "embedding").mapInArrow(
        project, f"vec_id {kind}, dims int, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")


@query("op12_cholesky_jacobi")
def op12(spark, sf_dir):
    rows = whitened(table(spark, sf_dir, "embeddings"))
    return rows.select("vec_id", "component", "n", F.expr("try_cast(deviation AS bigint)").alias("deviation"), "whitened", "explained", "identity_error")
