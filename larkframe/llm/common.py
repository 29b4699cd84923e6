"""Small helpers that several operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkframe.session import new_folder


def written(df: DataFrame, name: str, *partition_by: str, dense: bool = False, tasks: int | None = None) -> DataFrame:
    """The rows as a Parquet table in the shared folder, read back: costly steps run once, and a lost executor loses none.

    At most ``tasks`` tasks write: a file costs time, and on a local file system a process to set its mode.
    """
    path = new_folder(df.sparkSession, name)
    df = df.coalesce(tasks) if tasks else df
    out = df.write.option("compression", "zstd") if dense else df.write
    if partition_by:
        out = out.partitionBy(*partition_by)
    out.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Remove the tables under these frames, all made by ``written``, once nothing still to be run reads them."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if folder.rsplit("/", 2)[1] != "larkframe":
                raise ValueError(f"not a table of this package: {folder}")
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def keyed(docs: DataFrame, whole: bool = False) -> DataFrame:
    """(doc_id, text, k), and with ``whole`` the row as a struct, so that no column of the table can clash with ours.

    k tells apart texts under one doc_id. Rows that repeat both have the same k and count as one document in several rows.
    """
    k = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit("/"), "text")
    return docs.select("doc_id", "text", k.alias("k"), *([F.struct("*").alias("row")] if whole else []))


def place(*more: str) -> Column:
    """Order of documents: by doc_id with null last, then by k, then by what is named."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k", *more)


def same_doc(a: str, b: str) -> Column:
    return (F.col(f"{a}.k") == F.col(f"{b}.k")) & F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id"))


def slices(sizes: Iterable[int], most: int) -> Iterator[slice]:
    """Runs of neighbouring items whose sizes add up to at most ``most``; a larger item is a run by itself."""
    begin, total, at = 0, 0, -1
    for at, n in enumerate(sizes):
        if at > begin and total + n > most:
            yield slice(begin, at)
            begin, total = at, 0
        total += n
    if at >= begin:
        yield slice(begin, at + 1)


def lengths_of(rows: DataFrame, most: int = 10_000) -> list[int]:
    """The different numbers in dims, one pass for each; more than ``most`` are an error, so that none is left out."""
    got = sorted(r[0] for r in rows.select("dims").distinct().limit(most + 1).collect())
    if len(got) > most:
        raise ValueError(f"more than {most} lengths of vectors")
    return got


def release() -> None:
    """Freed memory goes back to the system: Python workers stay for later stages, and would keep it beside what those need."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library of Linux has it
    if trim:
        trim(0)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The function of batches, with freed memory given back after each batch and at the end of the task."""

    def go(batches):
        def each():
            for batch in batches:
                yield batch
                release()

        yield from run(each())
        release()

    return go


_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(texts: list[str], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word (run of bytes other than ASCII white space), and the number of words per text."""
    raw = [(t.lower() if lower else t).encode("utf-8", "surrogatepass") for t in texts]
    b = np.frombuffer(b" " + b" ".join(raw) + b" ", dtype=np.uint8)
    blank = _SPACE[b]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    first, end = edge[::2], edge[1::2]
    total = np.zeros(len(b) + 1, dtype=np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * powers(_ODD, len(b)), out=total[1:])
    inverse = powers(_INVERSE, len(b))
    hashes = mix((total[end] - total[first]) * inverse[first])
    ends = 1 + np.cumsum([len(r) + 1 for r in raw])
    return hashes, np.diff(np.searchsorted(first, ends), prepend=0)


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from every place on; the last size - 1 places are left out."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * powers(_ODD, len(words)), out=total[1:])
    return mix((total[size:] - total[:-size]) * powers(_INVERSE, n))


ROWS_A_TASK = 200_000


def connected(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges (a, b), with one label per component; nodes are digests, so in random order.

    Each round every node steps to its smallest neighbour, if that is smaller, and edges are rewritten to where their ends went;
    on random numbers a round removes a constant share of the nodes. Small tables are written by few tasks.
    """
    left = written(edges.where("a <> b").select("a", "b").distinct(), "edges")
    steps = []
    while n := left.count():
        tasks = 1 + n // ROWS_A_TASK
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to")).select("node", F.least("node", "to").alias("to"))
        step = written(step.coalesce(tasks), "step")
        moved = left.join(step.select(F.col("node").alias("a"), F.col("to").alias("x")), "a").join(
            step.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        left = written(moved.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct().coalesce(tasks), "edges")
        steps.append(step)
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).where(F.lit(False))
    labels = steps[-1].select("node", F.col("to").alias("label"))
    for step in reversed(steps[:-1]):
        later = labels.select(F.col("node").alias("to"), "label")
        labels = step.join(later, "to", "left").select("node", F.coalesce("label", "to").alias("label"))
    return written(labels, "components")
