"""Racing and Bayesian search: what is fitted, what is dropped, what is found."""

import numpy as np
import pytest

from larkframe.learning import search as se


def counted(score):
    calls = []

    def run(tasks):
        calls.extend(tasks)
        return [score(*t) for t in tasks]

    return run, calls


def test_race_skips_fits_of_those_behind():
    rng = np.random.default_rng(1)
    noise = rng.normal(size=(50, 10)) * 0.05
    run, calls = counted(lambda c, f: 1 + c * 0.05 + f * 3 + noise[c, f])
    rows, fits = se.race(run, list(range(50)), list(range(10)))
    assert fits == len(calls) == sum(r["n"] for r in rows) < 250 < 500
    assert min((r for r in rows if r["finished"]), key=lambda r: r["mean"])["config"] == 0
    for r in rows:  # a dropped candidate is never fitted on a later fold
        assert sorted(f for c, f in calls if c == r["config"]) == list(range(r["n"])) and r["n"] >= 3
    assert all(r["n"] == 3 for r in rows if r["config"] >= 10)


def test_race_of_equals_goes_on_and_ties_are_broken():
    rng = np.random.default_rng(2)
    noise = rng.normal(size=(2, 12))
    run, calls = counted(lambda c, f: noise[c, f])
    rows, fits = se.race(run, [0, 1], list(range(12)), num_ties=4)
    assert fits == 2 * 6 + 6 and sorted(r["n"] for r in rows) == [6, 12]
    run, _ = counted(lambda c, f: 1.0)
    rows, fits = se.race(run, ["a", "b", "c"], [1, 2, 3, 4])
    assert fits == 12 and all(r["finished"] for r in rows)


def test_behind_equals_the_textbook_contrast():
    rng = np.random.default_rng(3)
    scores = rng.normal(size=(4, 6)) + np.array([0, 0.2, 1.5, 4])[:, None] + rng.normal(size=6)[None, :] * 5
    c, f = scores.shape
    x = np.zeros((c * f, c + f - 1))  # best candidate and first fold are the base
    base = int(scores.mean(axis=1).argmin())
    others = [i for i in range(c) if i != base]
    x[:, 0] = 1
    for i in range(c):
        for j in range(f):
            if i != base:
                x[i * f + j, 1 + others.index(i)] = 1
            if j:
                x[i * f + j, c + j - 1] = 1
    beta, rss, *_ = np.linalg.lstsq(x, scores.ravel(), rcond=None)
    error = np.sqrt(np.diag(np.linalg.inv(x.T @ x)) * rss[0] / ((c - 1) * (f - 1)))
    from larkframe.functions import tails

    for alpha in (0.3, 0.05, 1e-4):
        want = [i != base and tails.t_two_sided(beta[1 + others.index(i)] / error[1 + others.index(i)], (c - 1) * (f - 1)) / 2 <= alpha for i in range(c)]
        assert list(se.behind(scores, alpha)) == want


@pytest.mark.parametrize("in_flight", [1, 3])
def test_bayes_finds_no_worse_than_random(in_flight):
    points = [{"mtry": m, "min_n": n} for m in range(5, 21) for n in range(5, 31)]
    loss = lambda p: ((p["mtry"] - 13) / 16) ** 2 + ((p["min_n"] - 9) / 26) ** 2 + 0.05 * np.sin(p["mtry"])
    found, drawn = [], []
    for seed in range(8):
        run, calls = counted(lambda i, f: loss(points[i]) + f)
        rows = se.bayes(run, points, [0, 1], iters=12, no_improve=12, in_flight=in_flight, seed=seed)
        assert len(calls) == 2 * len(rows) == 2 * 17 and len({(r["mtry"], r["min_n"]) for r in rows}) == 17
        found.append(min(r["mean"] for r in rows))
        drawn.append(min(loss(points[i]) + 0.5 for i in np.random.default_rng(100 + seed).permutation(len(points))[:17]))
    assert np.mean(found) < np.mean(drawn) and sum(a <= b for a, b in zip(found, drawn)) >= 6


def test_bayes_stops_and_explores():
    points = [{"a": a} for a in range(40)]
    run, calls = counted(lambda i, f: 1.0)
    rows = se.bayes(run, points, [0], iters=30, no_improve=8, uncertain=3, in_flight=1)
    assert len(rows) == 5 + 8 and [r["how"] for r in rows].count("uncertain") == 2
    run, calls = counted(lambda i, f: float(i))
    assert len(se.bayes(run, points[:6], [0], iters=30, no_improve=30)) == 6  # no point is tried twice


def test_fits_run_on_spark(spark):
    from larkframe.learning import models as md

    d = spark.createDataFrame([(float(i), float((i * 7) % 5), 3.0 * i + (i * 7) % 5, i % 3) for i in range(120)], "a double, b double, y double, fold int")
    run = se.fold_fits(d, "fold", "y", lambda xs, tr: (lambda m: lambda df: md.predict(m, df))(md.linear(tr, "y", list(xs))))
    good, bad = run([(("a", "b"), 0), (("b",), 0)])
    assert good < 1e-6 < bad


def line_folds(spark, n=3000, folds=3):
    rng = np.random.default_rng(6)
    x = np.stack([rng.integers(0, 60, n), rng.normal(size=n), rng.integers(0, 4, n)], axis=1).astype(float)
    y = x[:, 0] + 5 * x[:, 1] * (x[:, 2] > 1) + rng.normal(size=n)
    return spark.createDataFrame([(int(i % folds), float(y[i]), *map(float, x[i])) for i in range(n)], "fold int, y double, a double, b double, c double").repartition(4).checkpoint()


def test_trees_on_cells_are_those_of_mllib(spark):
    from larkframe.learning import binned as bn
    from larkframe.learning import models as md
    from larkframe.session import shared_folder

    shared_folder(spark)
    for n in (3000, 16_000):  # all training rows give the thresholds, a sample of them
        d = line_folds(spark, n)
        cells = bn.binned(d, "fold", "y", ["a", "b", "c"])
        for depth, min_n in ((1, 5), (4, 5), (6, 40)):
            want = se.fold_fits(d, "fold", "y", lambda c, tr: (lambda m: lambda df: md.predict(m, df))(md.tree_reg(tr, "y", ["a", "b", "c"], depth, min_n)))([(0, f) for f in range(3)])
            got = bn.fold_fits(cells, lambda c: {"depth": depth, "min_n": min_n})([(0, f) for f in range(3)])
            assert np.allclose(got, want, rtol=1e-9)


def test_forests_on_cells_count_replicates(spark):
    from larkframe.learning import binned as bn
    from larkframe.learning import models as md
    from larkframe.session import shared_folder

    shared_folder(spark)
    d = line_folds(spark)
    cells = bn.binned(d, "fold", "y", ["a", "b", "c"], bags=20)
    rows = {(r["fold"], r["bag"]): np.frombuffer(r["sums"]).reshape(3, -1)[0].sum() for r in cells.table.collect()}
    assert sorted(rows) == [(f, b) for f in range(3) for b in (-1, *range(1, 21))] and all(rows[f, -1] == 1000 for f in range(3))
    drawn = np.array([rows[f, b] for f in range(3) for b in range(1, 21)])
    assert abs(drawn.mean() - 2000) < 40 and 15 < drawn.std() < 75  # Poisson sums of 2,000 rows: deviation 45
    for mtry in (2, 3):
        want = se.fold_fits(d, "fold", "y", lambda c, tr: (lambda m: lambda df: md.predict(m, df))(md.forest_reg(tr, "y", ["a", "b", "c"], 20, 5, str(mtry), 5)))([(0, f) for f in range(3)])
        got = bn.fold_fits(cells, lambda c: {"mtry": mtry, "min_n": 5})([(0, f) for f in range(3)])
        assert np.allclose(got, want, rtol=0.15)  # other draws of rows and predictors
    empty = spark.createDataFrame([(0, 1.0, None, 1.0, 1.0), (1, 2.0, 1.0, 1.0, 1.0)], d.schema)
    with pytest.raises(Exception, match="null or NaN"):
        bn.binned(empty, "fold", "y", ["a", "b", "c"])


def test_searches_over_trees_read_the_rows_once(spark, tables, monkeypatch):
    from larkframe.learning import models as md
    from larkframe.plans import QUERIES

    monkeypatch.setattr(md, "tree_reg", None)  # each fit read all rows before
    monkeypatch.setattr(md, "forest_reg", None)
    assert len(QUERIES["tune_race_trees"](tables).collect()) == 8
    assert len(QUERIES["tune_bayes"](tables).collect()) >= 7
