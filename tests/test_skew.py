"""Hot groups: a third or more of all rows under one key, value or point. Results must equal plain brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkframe.learning import clustering as cu
from larkframe.operators import chartstats as cs
from larkframe.operators import reshape as rs
from larkframe.operators.components import components
from larkframe.operators.density import dbscan
from larkframe.operators.hashing import hash_positions
from larkframe.operators.neighbors import knn
from larkframe.operators.ordering import positions, running
from larkframe.operators.quantiles import quantiles, value_table


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(1)
    g = np.where(rng.random(3000) < 0.4, "hot", np.char.add("g", rng.integers(0, 40, 3000).astype(str)))
    x = np.where(rng.random(3000) < 0.35, 7.0, rng.integers(0, 500, 3000)).astype(float)
    rows = [(i, str(a), float(b)) for i, (a, b) in enumerate(zip(g, x))]
    return spark.createDataFrame(rows, "id long, g string, x double").repartition(7), rows


def by_group(rows):
    out = {}
    for i, g, x in rows:
        out.setdefault(g, []).append((i, x))
    return out


def test_quantiles(skewed):
    d, rows = skewed
    got = {r["g"]: (r["a"], r["b"]) for r in quantiles(d, ["g"], "x", {"a": 0.1, "b": 0.5}).collect()}
    for g, v in by_group(rows).items():
        assert np.allclose(got[g], np.quantile([x for _, x in v], [0.1, 0.5]))


def test_running_sum_and_positions(skewed):
    d, rows = skewed
    got = {r["id"]: (r["pos"], r["s"]) for r in running(d.withColumn("one", F.lit(1)), ["g"], ["x", "id"], pos=("count", "one"), s=("sum", "x")).collect()}
    for v in by_group(rows).values():
        total = 0.0
        for k, (i, x) in enumerate(sorted(v, key=lambda p: (p[1], p[0])), 1):
            total += x
            assert got[i] == (k, pytest.approx(total))


def test_value_table_ties(skewed):
    d, rows = skewed
    xs = sorted(x for _, _, x in rows)
    for r in value_table(d, [], "x").collect():
        assert (r["cum"] - r["n"], r["n"]) == (xs.index(r["v"]), xs.count(r["v"]))


def test_hash_positions_do_not_depend_on_partitions(skewed):
    d, rows = skewed
    a = {r["id"]: r["pos"] for r in hash_positions(d, ["id"], "s", ["g"]).collect()}
    b = {r["id"]: r["pos"] for r in hash_positions(d.repartition(3, "x"), ["id"], "s", ["g"]).collect()}
    assert a == b
    for v in by_group(rows).values():
        assert sorted(a[i] for i, _ in v) == list(range(1, len(v) + 1))


def test_pack_keeps_all_rows(skewed):
    d, rows = skewed
    out = rs.pack(d, ["g"], ["id"], F.col("id"), "ids", rows=100).collect()
    assert max(len(r["ids"]) for r in out) == 100
    for g, v in by_group(rows).items():
        parts = sorted((r for r in out if r["g"] == g), key=lambda r: r["part_no"])
        assert [i for r in parts for i in r["ids"]] == [i for i, _ in v]


def points(spark, n=400, dims=2, hot=0.4, grid=None, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, dims))
    if grid:
        x = np.round(x / grid) * grid
    x[rng.random(n) < hot] = x[0]  # copies of one point
    d = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(x)], "id long, vec array<double>")
    return d, x


def brute_knn(x, q, k, same, l1=False):
    out = {}
    for i in range(len(q)):
        d = np.abs(x - q[i]).sum(1) if l1 else np.sqrt(((x - q[i]) ** 2).sum(1))
        order = [j for j in sorted(range(len(x)), key=lambda j: (d[j], j)) if not (same and j == i)][:k]
        out[i] = [(j, round(float(d[j]), 9)) for j in order]
    return out


@pytest.mark.parametrize("dims,grid,metric,chunk,leaf", [(2, None, "l2", 20000, 512), (2, 0.5, "l2", 50, 16), (8, None, "l1", 30, 20), (3, 1.0, "l1", 20000, 6)])
def test_knn_equals_brute_force(spark, dims, grid, metric, chunk, leaf):
    d, x = points(spark, dims=dims, grid=grid)
    got = {}
    for r in knn(d, d, 4, metric=metric, chunk=chunk, leaf=leaf).collect():
        got.setdefault(r["qid"], []).append((r["place"], r["nid"], round(r["dist"], 9)))
    want = brute_knn(x, x, 4, True, metric == "l1")
    assert {i: [(j, e) for _, j, e in sorted(v)] for i, v in got.items()} == want


def test_knn_few_points(spark):
    d, x = points(spark, n=3, hot=0)
    assert knn(d, d, 5).count() == 6  # fewer points than neighbours: all others are returned


@pytest.mark.parametrize("dims,spread", [(2, None), (4, None), (16, 0.2)])
def test_knn_visits_few_points(spark, dims, spread):
    rng = np.random.default_rng(dims)
    x = rng.random((6000, dims)) if spread is None else rng.normal(size=(40, dims))[rng.integers(0, 40, 6000)] * 4 + rng.normal(size=(6000, dims)) * spread
    d = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(x)], "id long, vec array<double>")
    tally = {}
    got = {(r["qid"], r["place"]): r["nid"] for r in knn(d, d, 5, leaf=96, tally=tally).collect()}
    print(f"{dims} dimensions, spread {spread}: {tally['visited'] / tally['all']:.3f} of all pairs visited")
    assert len(got) == 30_000 and tally["all"] == 36_000_000 and tally["visited"] < 0.2 * tally["all"]
    for i in rng.integers(0, 6000, 40):
        dist = np.sqrt(((x - x[i]) ** 2).sum(1))
        assert [got[i, p] for p in range(1, 6)] == [j for j in np.lexsort((np.arange(6000), dist)) if j != i][:5]


@pytest.mark.parametrize("kind", ["f4", "f8"])
def test_knn_without_structure(spark, monkeypatch, kind):
    """Every cell is in reach; few distances and few rows are in memory at a time. Numbers that are floats travel as floats."""
    from larkframe.operators import neighbors as nb

    x = np.random.default_rng(5).normal(size=(900, 24)).astype(kind).astype(float)
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
    tally, seen, meet = {}, [], nb._meet

    def spy(left, right, *more):
        seen.append((dict(left.dtypes)["qv"], left.count(), left.select("qid", "cell").distinct().count()))
        return meet(left, right, *more)

    monkeypatch.setattr(nb, "_meet", spy)
    got = {(r.qid, r.place): (r.nid, round(r.dist, 9)) for r in nb.knn(d, d, 4, chunk=100, leaf=20, tally=tally).collect()}
    assert {i: [got[i, p] for p in range(1, 5)] for i in range(900)} == brute_knn(x, x, 4, True)
    assert [s[0] for s in seen] == [f"array<{'float' if kind == 'f4' else 'double'}>"] * 2 and seen[0][1] == 900
    assert seen[1][1] == seen[1][2] <= 900 * 40 and tally["visited"] <= tally["all"]  # once to a cell, which holds some 100 points


def test_nearest_inside_a_cell(monkeypatch):
    from larkframe.operators import neighbors as nb

    monkeypatch.setattr(nb, "PAIRS", 64)
    rng = np.random.default_rng(7)
    for dims, metric in ((1, "l2"), (3, "l1"), (12, "l2")):
        p, q = np.unique(rng.integers(0, 6, (300, dims)), axis=0).astype(float), rng.integers(-1, 7, (50, dims)).astype(float)
        key = rng.permutation(len(p))
        bound = np.where(rng.random(50) < 0.5, np.inf, 2.0)
        i, j, dist, met = nb._nearest_in(q, bound, p, key, 3, metric, 7)
        far = nb.distances(q, p, metric)
        for r in range(50):
            want = [c for c in np.lexsort((key, far[r])) if far[r, c] <= bound[r]][:3]
            mine = sorted(zip(dist[i == r], key[j[i == r]]))
            assert mine == [(far[r, c], key[c]) for c in want]
        assert met <= 50 * len(p)


@pytest.mark.parametrize("leaf", [512, 12])
def test_knn_other_queries(spark, leaf):
    d, x = points(spark, n=200)
    q, y = points(spark, n=50, seed=9)
    got = {}
    for r in knn(d, q, 3, same=False, leaf=leaf).collect():
        got.setdefault(r["qid"], []).append((r["place"], r["nid"]))
    want = {i: [j for j, _ in v] for i, v in brute_knn(x, y, 3, False).items()}
    assert {i: [j for _, j in sorted(v)] for i, v in got.items()} == want


def brute_dbscan(x, eps, min_pts):
    n = len(x)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    core = (d <= eps).sum(1) >= min_pts
    label = {}
    for i in range(n):
        if core[i] and i not in label:
            stack = [i]
            label[i] = i
            while stack:
                a = stack.pop()
                for b in np.flatnonzero((d[a] <= eps) & core):
                    if b not in label:
                        label[b] = i
                        stack.append(b)
    number = {r: k for k, r in enumerate(sorted(set(label.values())), 1)}
    out = {}
    for i in range(n):
        if core[i]:
            out[i] = (number[label[i]], True)
        else:
            near = sorted((d[i, j], j) for j in np.flatnonzero(core) if d[i, j] <= eps)
            out[i] = (number[label[near[0][1]]] if near else 0, False)
    return out


@pytest.mark.parametrize("eps,min_pts,seed", [(0.15, 4, 3), (0.3, 8, 5), (0.05, 3, 6)])
def test_dbscan_equals_brute_force(spark, eps, min_pts, seed):
    rng = np.random.default_rng(seed)
    x = np.vstack([rng.normal(0, 0.05, (150, 2)), rng.normal([0.6, 0], 0.05, (100, 2)), rng.uniform(-2, 2, (120, 2))])
    d = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, x double, y double")
    got = {r["id"]: (r["cluster"], r["core"]) for r in dbscan(d, "id", "x", "y", eps, min_pts).collect()}
    assert got == brute_dbscan(x, eps, min_pts)


def test_components_chain_and_star(spark):
    nodes = spark.range(60).withColumnRenamed("id", "node")
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(30, i) for i in range(31, 50)], "a long, b long")
    got = {r["node"]: r["label"] for r in components(nodes, edges).collect()}
    assert all(got[i] == 0 for i in range(21)) and all(got[i] == 30 for i in range(30, 50)) and all(got[i] == i for i in range(50, 60))


def test_lof_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(0, 1, (80, 2)), [[8.0, 8.0]]])
    d = spark.createDataFrame([(i, [float(a), float(b)]) for i, (a, b) in enumerate(x)], "id long, vec array<double>")
    k = 5
    near = brute_knn(x, x, k, True)
    kd = {i: v[-1][1] for i, v in near.items()}
    lrd = {i: k / sum(max(kd[j], e) for j, e in v) for i, v in near.items()}
    want = {i: sum(lrd[j] for j, _ in v) / k / lrd[i] for i, v in near.items()}
    got = {r["id"]: r["lof"] for r in cu.lof(d, "id", "vec", k).collect()}
    assert max(abs(got[i] - want[i]) for i in want) < 1e-6 and max(got, key=got.get) == 80


def test_loess_ties(spark):
    d = spark.createDataFrame([(float(i // 2), float(i)) for i in range(40)], "x double, y double")
    assert cs.loess(d, "x", "y", [10.0], 0.5).first()["fit"] == pytest.approx(20.5)
