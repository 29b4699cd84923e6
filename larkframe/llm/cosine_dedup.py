"""Near-duplicate vectors by PCA-ordered tiled comparison.

Vectors are scaled to length one and turned to the principal axes of the table, so that the leading dimensions hold most of
a product. Per label they are sorted by the first axis and cut into tiles of TILE vectors. Two vectors with cosine c are sqrt(2 - 2c)
apart, so tiles whose ranges on the first axis are further apart are never paired. In a pair of tiles products add up the
leading dimensions first; what is left is at most the product of the two suffix norms, and a vector pair stops when even that
cannot reach the threshold. Pairs that get through are decided by their cosine in the given coordinates.

A tile is one row with its vectors as given, not turned. Tiles travel in blocks of neighbours, of BLOCK numbers at most: a task compares the
tiles of two blocks of a label, so a vector is sent once per block of its label and not once per tile. Every pair of blocks is a task of its own with two
blocks in memory; the products stay as many as all pairs of tiles in reach, which are quadratic where the vectors have no structure.

Copies of a vector under one label are one node from the start. A pair of blocks gives out how many links each of its vectors has and
no more links than join its parts, never all pairs.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and rows with a null label, link with nothing;
rows that repeat a vec_id each get a row, and a component's number is the smallest vec_id in it; rows with a null vec_id
count as vectors but give no number. Vectors of any finite size other than zero link. Vectors of unequal length do not link. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkframe.llm.bag_minhash import forest
from larkframe.llm.common import connected, dropped, lengths_of, release, written
from larkframe.llm.registry import query, table

TILE = 512
VALUES = 1 << 17  # numbers in a tile, for long vectors
BLOCK = 1 << 21  # numbers in a block of tiles
LEAST = 3  # blocks of a label, if it has as many tiles
STEP = 16  # dimensions added between two tests
SLACK = 1e-9  # rounding of turned coordinates


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, v, node) of the rows that can link; node is a digest of label and vector. Vectors of floats stay floats."""
    wide = F.transform("embedding", lambda x: x.cast("double"))
    v = F.col("embedding") if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else wide
    rows = vectors.where(_linkable()).select("vec_id", F.col("label").cast("string").alias("label"), v.alias("v"))
    text = F.transform("v", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x.cast("double")).cast("string"))
    return rows.withColumn("node", F.unhex(F.sha2(F.concat_ws("/", F.col("label"), F.array_join(text, ",")), 256)))


def scaled(v: np.ndarray) -> np.ndarray:
    """The rows at length one; by their largest component first, so that no square leaves the range of doubles."""
    x = v / np.abs(v).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def stacked(v: pd.Series) -> np.ndarray:
    return np.stack(v.to_numpy()).astype(np.float64)


def axes(nodes: DataFrame, dims: int) -> np.ndarray:
    """Principal axes (rows, largest first) of the scaled vectors, from their moments summed inside the tasks."""

    def moments(batches):
        total = np.zeros((dims, dims))
        for batch in batches:
            x = scaled(stacked(batch["v"]))
            total += x.T @ x
        yield pd.DataFrame({"i": np.repeat(np.arange(dims), dims), "j": np.tile(np.arange(dims), dims), "s": total.ravel()})

    sums = nodes.select("v").mapInPandas(moments, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    m = np.zeros((dims, dims))
    for r in sums:
        m[r.i, r.j] = r.s
    _, vectors = np.linalg.eigh((m + m.T) / 2)
    return vectors.T[::-1].copy()


def pack(tile: int, kind: str):
    """Rows sorted by (label, dims, first) as one row per tile: neighbours on the first axis, at most ``tile`` of them and VALUES numbers."""

    def rows_of(dims: int) -> int:
        return max(1, min(tile, VALUES // dims))

    def run(batches):
        number, held = TaskContext.get().partitionId() << 32, None

        def packed(g: pd.DataFrame) -> tuple:
            nonlocal number
            number += 1
            first = g["first"].to_numpy()
            return (g["label"].iloc[0], g["dims"].iloc[0], number, len(g), first.min(), first.max(), b"".join(g["node"]), g["n"].to_numpy().astype("<i8").tobytes(),
                    np.stack(g["v"].to_numpy()).astype(kind).tobytes())

        def table(rows: list) -> pd.DataFrame:
            return pd.DataFrame(rows, columns=["label", "dims", "tile", "size", "low", "high", "nodes", "n", "v"])

        for batch in batches:
            g = batch if held is None else pd.concat([held, batch])
            label, dims = g["label"].to_numpy(), g["dims"].to_numpy()
            edge = [0, *(np.flatnonzero((label[1:] != label[:-1]) | (dims[1:] != dims[:-1])) + 1), len(g)]
            out, held = [], None
            for low, high in zip(edge, edge[1:]):
                for at in range(low, high, rows_of(dims[low])):
                    end = min(at + rows_of(dims[low]), high)
                    if end == len(g):  # more rows of this tile may come
                        held = g.iloc[at:end]
                    else:
                        out.append(packed(g.iloc[at:end]))
            yield table(out)
        if held is not None and len(held):
            yield table([packed(held)])

    return run


class Tile:
    """The vectors of a packed row: turned (x), and what is left of their length after every STEP dimensions."""

    def __init__(self, row, kind: str, turn: np.ndarray):
        self.given = np.frombuffer(row.v, dtype=kind).reshape(row.size, row.dims)
        self.low, self.high, self.n = row.low, row.high, np.frombuffer(row.n, dtype="<i8")
        self.x = scaled(self.given.astype(np.float64)) @ turn.T
        rest = np.sqrt(np.maximum(np.cumsum((self.x * self.x)[:, ::-1], axis=1)[:, ::-1], 0))
        self.rest = {high: rest[:, high].copy() for high in range(STEP, row.dims, STEP)}

    def exact(self) -> tuple[np.ndarray, np.ndarray]:
        """Given coordinates times a power of two, so that no bit of the cosine changes, and their lengths; not kept, as few tiles need them."""
        v = self.given.astype(np.float64)
        v = np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1])
        return v, np.sqrt((v * v).sum(axis=1))


def compare(a: Tile, b: Tile, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(row of a, row of b) of the links between two tiles; with both the same, each link once."""
    dot = np.zeros((len(a.x), len(b.x)))
    dims = a.x.shape[1]
    alive = None
    for low in range(0, dims, STEP):
        high = min(low + STEP, dims)
        if alive is None:
            dot += a.x[:, low:high] @ b.x[:, low:high].T
            bound = dot + (a.rest[high][:, None] * b.rest[high][None, :] if high < dims else 0.0)
            if high == dims or (bound >= threshold - SLACK).mean() < 0.1:
                alive = np.argwhere(bound >= threshold - SLACK)
                part = dot[alive[:, 0], alive[:, 1]]
        else:
            i, j = alive[:, 0], alive[:, 1]
            part = part + (a.x[i, low:high] * b.x[j, low:high]).sum(axis=1)
            ok = part + (a.rest[high][i] * b.rest[high][j] if high < dims else 0.0) >= threshold - SLACK
            alive, part = alive[ok], part[ok]
    i, j = alive[:, 0], alive[:, 1]
    if a is b:
        i, j = i[i < j], j[i < j]
    if not len(i):
        return i, j
    (v, v_norm), (w, w_norm) = a.exact(), b.exact()
    cosine = np.concatenate([(v[i[k : k + 65536]] * w[j[k : k + 65536]]).sum(axis=1) for k in range(0, len(i), 65536)])
    ok = cosine / (v_norm[i] * w_norm[j]) >= threshold
    return i[ok], j[ok]


def compare_blocks(g: pd.DataFrame, threshold: float, reach: float, kind: str, turns: dict[int, np.ndarray]) -> pd.DataFrame:
    """For the tiles of a pair of blocks (own: 0 or 1): the links each vector has into the other block, and links that join the parts.

    With both blocks the same, every tile stands once with own 0.
    """
    g = g.sort_values(["own", "tile"])
    tiles = [Tile(r, kind, turns[r.dims]) for r in g.itertuples()]
    node = [r.nodes[k : k + 32] for r in g.itertuples() for k in range(0, len(r.nodes), 32)]
    start = np.concatenate([[0], np.cumsum(g["size"].to_numpy())])
    left = int((g["own"] == 0).sum())
    n_links, joined = np.zeros(len(node), dtype=np.int64), np.zeros((0, 2), dtype=np.int64)
    found, waiting = [], 0

    def settled() -> np.ndarray:
        return np.array(forest(len(node), np.concatenate([joined, *found])), dtype=np.int64).reshape(-1, 2)

    for s in range(left):
        for t in range(s, left) if left == len(tiles) else range(left, len(tiles)):
            a, b = tiles[s], tiles[t]
            if b.low - a.high > reach or a.low - b.high > reach:
                continue
            i, j = compare(a, b, threshold)
            if not len(i):
                continue
            n_links[start[s] : start[s + 1]] += np.bincount(i, b.n[j], len(a.n)).astype(np.int64)
            n_links[start[t] : start[t + 1]] += np.bincount(j, a.n[i], len(b.n)).astype(np.int64)
            shift = 0 if s == t else len(a.n)  # one numbering of the rows of both tiles
            near = np.array(forest(len(a.n) + len(b.n), np.stack([i, j + shift], axis=1)), dtype=np.int64)
            found.append(np.stack([near[:, 0] + start[s], near[:, 1] - shift + start[t]], axis=1))
            waiting += len(near)
            if waiting > 200_000:
                joined, found, waiting = settled(), [], 0
    joined = settled()
    rows = [(node[i], None, int(n_links[i])) for i in np.flatnonzero(n_links)] + [(node[i], node[j], 0) for i, j in joined]
    return pd.DataFrame(rows, columns=["a", "b", "n_links"], dtype=object).astype({"n_links": "int64"})


def near_vectors(vectors: DataFrame, threshold: float = 0.93, tile: int = TILE) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per row of vectors(vec_id, embedding, label)."""
    spark = vectors.sparkSession
    base = written(usable(vectors), "cosine-rows")
    kind = "<f4" if base.schema["v"].dataType.simpleString() == "array<float>" else "<f8"
    nodes = written(
        base.groupBy("node").agg(F.first("label").alias("label"), F.first("v").alias("v"), F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least_id"))
        .withColumn("dims", F.size("v")), "cosine-nodes")
    ids = written(base.select("vec_id", "node"), "cosine-ids")
    dropped(base)
    turned, turns = [], {}
    for dims in lengths_of(nodes):
        some = nodes.where(F.col("dims") == dims)
        turns[dims] = axes(some, dims)

        def along(batches, axis=turns[dims][0]):
            for batch in batches:
                yield batch.assign(first=scaled(stacked(batch["v"])) @ axis)

        turned.append(some.select("node", "label", "dims", "n", "v").mapInPandas(
            along, f"node binary, label string, dims int, n long, v {base.schema['v'].dataType.simpleString()}, first double"))
    if not turned:
        linked = spark.createDataFrame([], "node binary, n_links long")
        links = spark.createDataFrame([], "a binary, b binary")
    else:
        rows = turned[0]
        for more in turned[1:]:
            rows = rows.unionByName(more)
        order = ["label", "dims", "first", "node"]
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        tiles = written(rows.mapInPandas(pack(tile, kind), "label string, dims int, tile long, size int, low double, high double, nodes binary, n binary, v binary"), "cosine-tiles")
        nodes, wide = written(nodes.select("node", "n", "least_id"), "cosine-counts"), nodes
        dropped(wide)
        reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6
        of = Window.partitionBy("label", "dims")  # one narrow row per tile
        most = F.greatest(F.lit(1), F.floor(F.lit(BLOCK) / (F.col("dims") * F.col("_size"))))
        spans = tiles.select("label", "dims", "tile", "low", "high", F.max("size").over(of).alias("_size"), F.count(F.lit(1)).over(of).alias("_tiles"),
                             F.row_number().over(of.orderBy("tile")).alias("_at"))
        block = F.floor((F.col("_at") - 1) / F.least(most, F.ceil(F.col("_tiles") / LEAST)))
        spans = written(spans.select("label", "dims", "tile", "low", "high", block.alias("block")), "cosine-spans")
        blocks = spans.groupBy("label", "dims", "block").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        one = blocks.select("label", "dims", F.col("block").alias("t"), F.col("low").alias("l"), F.col("high").alias("h"))
        # both sides hold one row per block; the range condition prunes, no vectors travel here
        pairs = blocks.join(one, ["label", "dims"]).where((F.col("block") <= F.col("t")) & (F.col("l") - F.col("high") <= reach) & (F.col("low") - F.col("h") <= reach))
        pairs = written(pairs.select("label", "dims", F.col("block").alias("t0"), F.col("t").alias("t1"), F.xxhash64("label", "dims", "block", "t").alias("pair")), "cosine-pairs")
        sides = pairs.select("label", "dims", F.col("t0").alias("block"), "pair", F.lit(0).alias("own")).unionByName(
            pairs.where("t0 <> t1").select("label", "dims", F.col("t1").alias("block"), "pair", F.lit(1).alias("own")))
        goals = written(sides.join(spans, ["label", "dims", "block"]).select("label", "dims", "block", "tile", "pair", "own"), "cosine-goals")
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))  # few rows, much work: not fewer tasks
        work = tiles.join(goals.select("tile", "pair", "own"), "tile").repartition(tasks, "pair")

        def run(g: pd.DataFrame) -> pd.DataFrame:
            out = compare_blocks(g, threshold, reach, kind, turns)
            release()
            return out

        found = written(work.groupBy("pair").applyInPandas(run, "a binary, b binary, n_links long"), "cosine-links")
        linked = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n_links").alias("n_links"))
        links = found.where("b is not null").select("a", "b")
    labels = connected(links)
    named = nodes.select("node", "n", "least_id").join(labels, "node", "left").join(linked, "node", "left")
    named = written(named.select("node", "least_id", F.coalesce("label", "node").alias("label"), (F.col("n") - 1 + F.coalesce("n_links", F.lit(0))).alias("n_links")), "cosine-labels")
    smallest = written(named.groupBy("label").agg(F.min("least_id").alias("component_id")), "cosine-smallest")
    named = written(named.join(smallest, "label").select("node", "n_links", "component_id"), "cosine-classes")
    ids = ids.join(named, "node").select("vec_id", "n_links", "component_id")
    rest = vectors.where(~_linkable()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return ids.unionByName(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _linkable():
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    return F.col("label").isNotNull() & F.coalesce(whole & some, F.lit(False))


SQL = """WITH v AS (SELECT vec_id, label, embedding::double[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY 1),
r AS (WITH RECURSIVE w(vec_id, reach) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT w.vec_id, l.b FROM w JOIN l ON w.reach = l.a)
  SELECT vec_id, min(reach) AS component_id FROM w GROUP BY 1)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e LEFT JOIN n ON e.vec_id = n.vec_id JOIN r ON e.vec_id = r.vec_id"""


@query("op3_pca_tiles", SQL)
def op3(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
