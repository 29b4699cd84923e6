"""Exact top-k by inner product with two cover trees, one over queries and one over data.

Every row goes to the cell of its nearest pivot (pivots are chosen farthest first from a bounded sample; all rows are
indexed, and a cell's radius is over all its rows). Query groups first meet the cells that promise the highest products, which gives
each query a kth score; then they meet every other cell whose bound still reaches the group's worst kth score. Inside a pair
of query group and data block both sides get a cover tree: children are centres chosen farthest first, so centres of a node
are at least as far apart as the radius that covers its points. Each query first takes a kth score from the leaf whose centre promises
most. A pair of nodes with centres q, p and radii Q, P is skipped when q.p + Q|p| + P|q| + QP is below the worst kth score among the
queries of the node; in a leaf of queries each query's own vector is held against the data leaves that are left.

Components are turned into floor(256 * x), so scores are whole numbers and ties are exact; they go to the smaller vec_id.

Defined cases: vectors that are null, empty or hold null or non-finite components take no part, nor do rows without vec_id; rows that
repeat vec_id and vector are one; a query is never its own answer, whatever its vector; vectors of unequal length are not
compared; a component of which floor(256 * x), or an answer of which the score, does not fit 63 bits is an error. Other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkframe.llm.common import lengths_of, written
from larkframe.llm.registry import query, table

SCALE = 256
SAMPLE = 4096  # rows from which pivots are chosen
CELLS = 256  # most pivots
BLOCK = 8192  # data rows of one task's tree
GROUP = 2048  # queries of one task's tree
LEAF = 64  # data points of a leaf
ASKING = 32  # queries of a leaf: their worst kth score prunes, so leaves are small
FANOUT = 48
RUN = 8  # data leaves that a query leaf meets at a time
EXACT = float(2**53)
LIMIT = float(2**62)
TOP = 2**63 - 1  # a score of this size is an error


@dataclass
class Node:
    low: int  # rows order[low:high] of the tree
    high: int
    center: np.ndarray
    length: float
    radius: float
    children: list
    ball: tuple  # centres, lengths and radii of the children


def _centres(x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Farthest-first centres (row numbers), the centre of every row, and its distance to it."""
    rows = [0]
    size = (x * x).sum(axis=1)
    best = np.sqrt(((x - x[0]) ** 2).sum(axis=1))
    owner = np.zeros(len(x), dtype=np.int64)
    while len(rows) < most:
        far = int(best.argmax())
        if best[far] == 0:
            break
        d = np.sqrt(np.maximum(size + size[far] - 2 * (x @ x[far]), 0))
        d[far] = 0
        nearer = d < best
        owner[nearer], best[nearer] = len(rows), d[nearer]
        rows.append(far)
    return np.array(rows), owner, best


def balls(nodes: list[Node]) -> tuple:
    return np.stack([n.center for n in nodes]), np.array([n.length for n in nodes]), np.array([n.radius for n in nodes])


def cover_tree(x: np.ndarray, leaf: int = LEAF) -> tuple[Node, np.ndarray]:
    """The root, and the row numbers in tree order. A node has as many children as leaves would hold its rows, at most FANOUT."""
    order = np.arange(len(x))

    def build(low: int, high: int, center: np.ndarray) -> Node:
        rows = order[low:high]
        node = Node(low, high, center, float(np.sqrt((center**2).sum())), float(np.sqrt(((x[rows] - center) ** 2).sum(axis=1).max())), [], ())
        if high - low > leaf and node.radius > 0:
            centres, owner, _ = _centres(x[rows], min(FANOUT, -(-(high - low) // leaf)))
            by = np.argsort(owner, kind="stable")
            order[low:high] = rows[by]
            cut = np.searchsorted(owner[by], np.arange(len(centres) + 1))
            where = x[rows[centres]]
            parts = [i for i in range(len(centres)) if cut[i] < cut[i + 1]]
            if len(parts) > 1:  # distances that round to nothing leave a node whole
                node.children = [build(low + int(cut[i]), low + int(cut[i + 1]), where[i]) for i in parts]
                node.ball = balls(node.children)
        return node

    return build(0, len(x), x.mean(axis=0)), order


def bounds(center: np.ndarray, length, radius, ball: tuple) -> np.ndarray:
    """Most that an inner product of a point of each left ball and a point of each right ball can be."""
    centres, lengths, radii = ball
    far, near = np.asarray(radius)[..., None], np.asarray(length)[..., None]
    return center @ centres.T + far * lengths + radii * near + far * radii + 1e-9 * (1 + (near + far) * (lengths + radii))


def bound(a: Node, b: Node) -> float:
    return float(bounds(a.center, a.length, a.radius, balls([b]))[0])


def products(q: np.ndarray, p: np.ndarray, most: float) -> np.ndarray:
    """Exact inner products of whole numbers, those beyond TOP as TOP; ``most`` is no less than any absolute sum of products."""
    if most < EXACT:
        return q @ p.T  # doubles hold them
    if most < LIMIT:
        return q.astype(np.int64) @ p.astype(np.int64).T
    return np.clip(q.astype(object) @ p.astype(object).T, -TOP, TOP).astype(np.int64)  # numbers of any size


class Best:
    """The k best (score, data row) of every query so far, ties to the smaller id, and the kth score."""

    def __init__(self, n: int, k: int, ids: np.ndarray, kth: np.ndarray):
        self.k, self.ids, self.kth = k, ids, kth
        self.scores = np.zeros((n, k), dtype=np.int64)
        self.rows = np.full((n, k), -1, dtype=np.int64)

    def take(self, low: int, at: np.ndarray, rows: np.ndarray, scores: np.ndarray) -> None:
        """Pairs of the query ``low + at`` and a data row; the queries concerned are merged with what they have."""
        mine = np.unique(at)
        old, slot = np.nonzero(self.rows[low + mine] >= 0)
        at = np.concatenate([mine[old], at])
        rows = np.concatenate([self.rows[low + mine[old], slot], rows])
        scores = np.concatenate([self.scores[low + mine[old], slot], scores])
        by = np.lexsort((self.ids[rows], -scores, at))
        at, rows, scores = at[by], rows[by], scores[by]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        ok = rank < self.k
        at, rows, scores, rank = at[ok] + low, rows[ok], scores[ok], rank[ok]
        self.rows[at, rank], self.scores[at, rank] = rows, scores
        last = rank == self.k - 1
        self.kth[at[last]] = np.maximum(self.kth[at[last]], scores[last])


def leaves_of(node: Node) -> list[Node]:
    return [x for c in node.children for x in leaves_of(c)] if node.children else [node]


def _first_scores(q, queries, data, own, data_ids, leaves, po, most, kth, k) -> int:
    """Raise each kth score to what the rows of the most promising leaf reach; gives the number of products computed."""
    centres, _, _ = balls(leaves)
    choice = (q @ centres.T).argmax(axis=1)
    made = 0
    for leaf in np.unique(choice):
        rows, cols = np.flatnonzero(choice == leaf), po[leaves[leaf].low : leaves[leaf].high]
        s = products(queries[rows], data[cols], most).astype(np.float64)  # rounding keeps the order, so no tie is lost
        made += s.size
        s[own[rows][:, None] == data_ids[cols][None, :]] = -np.inf
        if len(cols) >= k:
            kth[rows] = np.maximum(kth[rows], np.partition(s, len(cols) - k, axis=1)[:, len(cols) - k])
    return made


def search(queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, data_ids: np.ndarray, k: int, floor: np.ndarray):
    """(query row, data row, score) triples that may belong to the k best, and the number of products computed.

    floor holds scores known to be reached k times. The walk goes down the query tree; each node hands its children the data
    nodes that its bound leaves over. A query leaf meets the data leaves best first, RUN at a time, those that a query's own vector still reaches.
    """
    q, p = queries.astype(np.float64), data.astype(np.float64)
    most = float(np.abs(q).max(initial=0)) * float(np.abs(p).max(initial=0)) * q.shape[1]
    if most < EXACT:
        queries, data = q, p
    (qt, qo), (pt, po) = cover_tree(q, ASKING), cover_tree(p)
    kth = floor.astype(np.float64).copy()
    compared = _first_scores(q, queries, data, query_ids, data_ids, leaves_of(pt), po, most, kth, k)
    best = Best(len(q), k, data_ids, kth[qo])  # queries in tree order

    def reached(a: Node, nodes: list[Node], ball: tuple) -> list[Node]:
        worst = best.kth[a.low : a.high].min()
        return [nodes[i] for i in np.flatnonzero(bounds(a.center, a.length, a.radius, ball) >= worst)]

    def opened(a: Node, nodes: list[Node], larger_than: float) -> list[Node]:
        """The nodes with those of a larger radius opened, again and again, and dropped where the bound is too low."""
        done = []
        while nodes:
            done += [n for n in nodes if not n.children or n.radius <= larger_than]
            nodes = [c for n in nodes if n.children and n.radius > larger_than for c in reached(a, n.children, n.ball)]
        return done

    stack = [(qt, [pt])]
    while stack:
        a, met = stack.pop()
        met = reached(a, met, balls(met)) if met else met
        if a.children:
            met = opened(a, met, a.radius)
            stack += [(c, met) for c in a.children]
            continue
        met = opened(a, met, -1.0)
        if not met:
            continue
        rows = qo[a.low : a.high]
        size = np.sqrt((q[rows] ** 2).sum(axis=1))
        reach = bounds(q[rows], size, np.zeros(len(rows)), balls(met))
        turn = np.argsort(-reach.max(axis=0), kind="stable")
        for at in range(0, len(turn), RUN):
            some = turn[at : at + RUN]
            some = some[(reach[:, some] >= best.kth[a.low : a.high, None]).any(axis=0)]
            if not len(some):
                continue
            cols = np.concatenate([po[met[i].low : met[i].high] for i in some])
            s = products(queries[rows], data[cols], most)
            compared += s.size
            i, j = np.nonzero((s >= best.kth[a.low : a.high, None]) & (query_ids[rows][:, None] != data_ids[cols][None, :]))
            if len(i):
                best.take(a.low, i, cols[j], s[i, j].astype(np.int64))
    i, slot = np.nonzero(best.rows >= 0)
    return np.stack([qo[i], best.rows[i, slot], best.scores[i, slot]], axis=1).astype(np.int64), compared


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """(vec_id, v, dims) of the rows that take part."""
    sound: Column = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & F.coalesce(sound, F.lit(False)))
    fits = lambda x: F.abs(x.cast("double") * SCALE) < F.lit(float(2**63))
    whole = lambda x: F.when(fits(x), F.floor(x.cast("double") * SCALE).cast("long")).otherwise(
        F.raise_error(F.lit("floor(256 * x) of a component does not fit 63 bits")).cast("long"))
    v = F.transform("embedding", whole)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), F.size("embedding").alias("dims")).dropDuplicates(["vec_id", "v"])


def _in_cells(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    size = (pivots**2).sum(axis=1)

    def assign(batches):
        for batch in batches:
            x = np.stack(batch["v"].to_numpy()).astype(np.float64)
            d = (x**2).sum(axis=1)[:, None] + size - 2 * (x @ pivots.T)
            cell = d.argmin(axis=1)
            yield batch.assign(cell=cell, far=np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1)))

    return rows.select("vec_id", "v").mapInPandas(assign, "vec_id long, v array<long>, cell int, far double")


def _met(pairs: list[tuple], data: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score) candidates of the given (group, cell) pairs; queries: (vec_id, v, grp, floor)."""
    spark = data.sparkSession
    listed = spark.createDataFrame(pairs, "grp int, cell int")  # at most groups times CELLS
    blocks = data.select("cell", "part").distinct()
    work = written(listed.join(blocks, "cell"), "search-pairs")
    side = F.lit(None).cast("long")
    left = work.join(queries, "grp").select("grp", "cell", "part", F.lit(True).alias("asks"), "vec_id", "v", "floor")
    right = work.join(data.select("vec_id", "v", "cell", "part"), ["cell", "part"]).select(
        "grp", "cell", "part", F.lit(False).alias("asks"), "vec_id", "v", side.alias("floor"))

    def run(g: pd.DataFrame) -> pd.DataFrame:
        asks = g["asks"].to_numpy()
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        if asks.all() or not asks.any():
            return empty
        v, ids = np.stack(g["v"].to_numpy()), g["vec_id"].to_numpy()
        floor = np.where(g["floor"].isna(), -np.inf, g["floor"].astype("float64"))[asks]
        got, _ = search(v[asks], ids[asks], v[~asks], ids[~asks], k, floor)
        return pd.DataFrame({"query_id": ids[asks][got[:, 0]], "vec_id": ids[~asks][got[:, 1]], "score": got[:, 2]}) if len(got) else empty

    return left.unionByName(right).groupBy("grp", "cell", "part").applyInPandas(run, "query_id long, vec_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _one_length(rows: DataFrame, is_query: Column, k: int) -> DataFrame:
    rows = written(rows, "search-rows")
    n = rows.count()
    sample = [r[0] for r in rows.orderBy(F.xxhash64("vec_id", "v")).limit(SAMPLE).select("v").collect()]
    x = np.array(sample, dtype=np.float64)
    pivots = x[_centres(x, min(CELLS, 1 + n // BLOCK))[0]]
    data = _in_cells(rows, pivots)
    data = written(data, "search-cells")
    stats = {r.cell: r for r in data.groupBy("cell").agg(F.max("far").alias("far"), F.count(F.lit(1)).alias("n"), F.sum(is_query.cast("int")).alias("asking")).collect()}
    parts = F.element_at(F.create_map(*[F.lit(y) for c, r in stats.items() for y in (c, -(-r.n // BLOCK))]), F.col("cell"))
    data = data.withColumn("part", F.pmod(F.xxhash64("vec_id"), parts).cast("int"))
    # Query groups: neighbouring cells share a group until it is full, a large cell has several.
    groups: dict[int, list[int]] = {}
    first, held, number = {}, 0, 0
    for c in sorted(stats):
        asking = stats[c].asking
        if not asking:
            continue
        if held and held + asking > GROUP:
            number, held = number + 1, 0
        split = -(-asking // GROUP)
        first[c] = (number, split)
        for i in range(split):
            groups.setdefault(number + i, []).append(c)
        held += asking
        if split > 1:
            number, held = number + split, 0
    if not groups:
        return rows.sparkSession.createDataFrame([], "query_id long, vec_id long, score long")
    base = F.element_at(F.create_map(*[F.lit(y) for c, (g, _) in first.items() for y in (c, g)]), F.col("cell"))
    split = F.element_at(F.create_map(*[F.lit(y) for c, (_, s) in first.items() for y in (c, s)]), F.col("cell"))
    queries = data.where(is_query).select("vec_id", "v", (base + F.pmod(F.xxhash64("vec_id", "v"), split)).cast("int").alias("grp"))
    queries = written(queries, "search-queries")
    nodes = {c: Node(0, 0, pivots[c], float(np.sqrt((pivots[c] ** 2).sum())), r.far, [], ()) for c, r in stats.items()}
    near: list[tuple] = []
    for g, cells in groups.items():
        chosen = set()
        for qc in cells:
            held = 0
            for c in sorted(stats, key=lambda c: -float(pivots[qc] @ pivots[c])):
                chosen.add(c)
                held += stats[c].n
                if held > k:
                    break
        near += [(g, c) for c in sorted(chosen)]
    found = written(_met(near, data, queries.withColumn("floor", F.lit(None).cast("long")), k), "search-near")
    kth = _ranked(found, k).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
    queries = written(queries.join(kth, "vec_id", "left"), "search-floors")
    worst = {r.grp: r.w for r in queries.groupBy("grp").agg(F.when(F.count("floor") == F.count(F.lit(1)), F.min("floor")).alias("w")).collect()}
    known = set(near)
    rest = [
        (g, c) for g, cells in groups.items() for c in stats
        if (g, c) not in known and (worst.get(g) is None or max(bound(nodes[qc], nodes[c]) for qc in cells) >= worst[g])]
    if rest:
        found = found.unionByName(_met(rest, data, queries, k))
    return found


def top_products(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of every query row; ``is_query`` is a condition on vec_id."""
    rows = whole_numbers(vectors)
    out = None
    for dims in lengths_of(rows):
        found = _one_length(rows.where(F.col("dims") == dims).select("vec_id", "v"), is_query, k)
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = vectors.sparkSession.createDataFrame([], "query_id long, vec_id long, score long")
    score = F.when((F.col("score") < TOP) & (F.col("score") > -TOP), F.col("score")).otherwise(
        F.raise_error(F.lit("an inner product of floor(256 * x) does not fit 63 bits")).cast("long"))
    return _ranked(out, k).select("query_id", "rank", "vec_id", score.alias("score"))


SQL = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) AS e FROM embeddings WHERE embedding IS NOT NULL),
s AS (SELECT q.vec_id AS query_id, d.vec_id, cast(list_dot_product(q.e, d.e) AS bigint) AS score FROM v q JOIN v d ON q.vec_id <> d.vec_id
  WHERE q.vec_id % 50 = 0),
r AS (SELECT *, cast(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS integer) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


@query("op2_dual_cover_tree", SQL)
def op2(spark, sf_dir):
    return top_products(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)
