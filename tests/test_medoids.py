"""Clusters around medoids on a mixed-type distance, against plain build and swap."""

import itertools

import numpy as np
import pytest

from larkframe.learning.medoids import assigned, k_medoids


def plain_distances(rows, spans):
    def one(a, b):
        got = [abs(x - y) / s for x, y, s in zip(a[1], b[1], spans) if x is not None and y is not None]
        got += [float(x != y) for x, y in zip(a[2], b[2]) if x is not None and y is not None]
        return sum(got) / len(got) if got else 1.0

    return np.array([[one(a, b) for b in rows] for a in rows])


def plain_pam(d, k):
    chosen = []
    for _ in range(k):
        now = d[:, chosen].min(axis=1) if chosen else np.full(len(d), np.inf)
        chosen.append(min(range(len(d)), key=lambda j: (round(np.minimum(now, d[:, j]).sum(), 9), j)))
    while True:
        cost = d[:, chosen].min(axis=1).sum()
        tries = [(round(d[:, chosen[:i] + [j] + chosen[i + 1 :]].min(axis=1).sum() - cost, 9), i, j) for i in range(k) for j in range(len(d))]
        change, i, j = min(tries)
        if change > -1e-9:
            return sorted(chosen), cost
        chosen[i] = j


@pytest.fixture(scope="module")
def mixed(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(90):
        g = int(rng.integers(0, 4))
        x = [float(np.round(g + rng.normal() * 0.4, 2)), None if i % 11 == 0 else float(np.round(rng.random(), 2))]
        rows.append((i, x, [None if i % 13 == 0 else "abcd"[g if rng.random() < 0.8 else 0], "uv"[i % 2]]))
    rows += [(100 + i, *rows[5][1:]) for i in range(60)] + [(200, [None, None], [None, None])]  # copies, and a row without values
    flat = [(i, *x, *c, 0.0) for i, x, c in rows]
    return rows, spark.createDataFrame(flat, "id long, a double, b double, c string, e string, x double").repartition(4)


@pytest.mark.parametrize("k", [1, 2, 4])
def test_medoids_equal_build_and_swap(mixed, k):
    rows, df = mixed
    spans = [max(v) - min(v) for v in ([r[1][j] for r in rows if r[1][j] is not None] for j in (0, 1))]
    d = plain_distances(rows, spans)
    want, cost = plain_pam(d, k)
    args = (df, "id", ["a", "b"], ["c", "e"])
    model = k_medoids(*args, k)
    assert model.cost == pytest.approx(cost) and [m["id"] for m in model.rows] == [rows[j][0] for j in want]
    near = {rows[i][0]: min((round(d[i, j], 12), rows[j][0]) for j in want) for i in range(len(rows))}
    got = {r["id"]: (round(r["dist"], 12), r["medoid"]) for r in assigned(*args, model).collect()}
    assert {i: v[0] for i, v in got.items()} == pytest.approx({i: v[0] for i, v in near.items()})
    assert sum(v[0] for v in got.values()) == pytest.approx(cost)


def test_small_draws_come_near_the_whole(mixed):
    rows, df = mixed
    args = (df, "id", ["a", "b"], ["c", "e"], 3)
    whole, drawn = k_medoids(*args), k_medoids(*args, candidates=20, draws=4)
    assert len(drawn.rows) == 3 and whole.cost * (1 - 1e-9) <= drawn.cost <= 1.1 * whole.cost


def test_medoids_of_few_rows(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (2, 2.0, "a")], "id long, v double, c string")
    model = k_medoids(df, "id", ["v"], ["c"], 3)
    assert [m["id"] for m in model.rows] == [1] and model.cost == 0
    assert k_medoids(df.limit(0), "id", ["v"], ["c"], 3).rows == []


def test_two_medoids_are_the_best_pair(mixed):
    rows, df = mixed
    some = [r for r in rows if r[0] < 40]
    spans = [max(v) - min(v) for v in ([r[1][j] for r in some if r[1][j] is not None] for j in (0, 1))]
    d = plain_distances(some, spans)
    best = min(d[:, list(p)].min(axis=1).sum() for p in itertools.combinations(range(len(some)), 2))
    assert k_medoids(df.where("id < 40"), "id", ["a", "b"], ["c", "e"], 2).cost == pytest.approx(best, rel=0.03)
