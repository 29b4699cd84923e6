"""Regression on dependent columns, and tree samples of the whole table."""

import math

import numpy as np
import pandas as pd
import pytest

from larkframe.learning import classic, clustering
from larkframe.operators.moments import collect_moments, fit_ols, independent, inflation


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(2)
    p = pd.DataFrame(rng.normal(size=(400, 3)) * [1, 1e-4, 1e5] + [0, 1, 1e6], columns=["a", "b", "c"])
    p["y"] = 3 + p.a - 2e3 * p.b + 1e-5 * p.c + rng.normal(size=400)
    p["flat"], p["copy"], p["sum"] = 1e6 + 0.1, p.a, p.a + 1e4 * p.b - 2
    p["cls"] = (p.a > 0).astype(int) + (p.b > 1).astype(int)
    return p


def test_dependent_columns_have_no_estimate(spark, frame):
    df = spark.createDataFrame(frame).repartition(5)
    xs = ["flat", "a", "copy", "b", "sum", "c"]
    fit = fit_ols(df, "y", xs)
    x = np.column_stack([np.ones(400), frame.a, frame.b, frame.c])
    want, rss, *_ = np.linalg.lstsq(x, frame.y, rcond=None)
    assert [n for n, b in zip(xs, fit.coef) if np.isnan(b)] == ["flat", "copy", "sum"]
    assert np.allclose([fit.intercept, *fit.coef[[1, 3, 5]]], want, rtol=1e-5)
    assert fit.rank == 3 and math.isclose(fit.sigma2, rss[0] / 396, rel_tol=1e-6)
    got = df.select(fit.predict().alias("p"), fit.leverage().alias("h"), "a").orderBy("a").toPandas()
    order = np.argsort(frame.a.to_numpy())
    assert np.allclose(got.p, (x @ want)[order], atol=1e-5)
    assert np.allclose(got.h, np.diag(x @ np.linalg.inv(x.T @ x) @ x.T)[order], atol=1e-6)


def test_inflation(spark, frame):
    df = spark.createDataFrame(frame)
    got = inflation(collect_moments(df, ["a", "b", "c"])[None])
    assert np.allclose(got, np.diag(np.linalg.inv(np.corrcoef(frame[["a", "b", "c"]].T))), rtol=1e-6)
    got = inflation(collect_moments(df, ["a", "b", "c", "sum", "flat"])[None])
    assert [v is None for v in got] == [True, True, False, True, True]


def test_nearly_dependent_columns_stay():
    base = np.random.default_rng(0).normal(size=(1000, 2))
    x = np.column_stack([base, base[:, 0] + 1e-3 * np.random.default_rng(1).normal(size=1000)])
    assert independent(np.cov(x.T)) == [0, 1, 2]


def test_discriminant_without_the_dependent_column(spark, frame):
    df = spark.createDataFrame(frame)
    plain = classic.discriminant(df, "cls", ["a", "b"])(df).select("pred").toPandas()
    more = classic.discriminant(df, "cls", ["a", "b", "sum", "flat", "copy"])(df).select("pred").toPandas()
    assert plain.pred.tolist() == more.pred.tolist()


@pytest.mark.parametrize("n", [0, 40, 256, 20_000])
def test_tree_samples_are_of_the_whole_table(spark, n):
    df = spark.range(n).selectExpr("id", "cast(id AS double) AS x")
    got = clustering.tree_samples(df, "id", ["x"], n, 30, 256).toPandas()
    assert (got.groupby("tree").size() == min(n, 256)).all() and got.tree.nunique() == (30 if n else 0)
    if n == 20_000:
        every = df.selectExpr("id", "explode(sequence(1, 30)) AS tree").selectExpr("id", "tree", "xxhash64(id, tree) AS h").toPandas()
        want = every.sort_values("h").groupby("tree").head(256)
        assert set(zip(want.tree, want.id)) == set(zip(got.tree, got.id))
        assert got.id.nunique() > 5_500  # 30 x 256 draws of 20,000 rows
