"""Properties of splits, feature steps, models, tuning and clusters."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SMALL
from larkframe.learning import clustering as cu
from larkframe.learning import features as fe
from larkframe.learning import linear as ln
from larkframe.learning import models as md
from larkframe.learning import resample as rs
from larkframe.learning import tuning as tn
from larkframe.learning.registry import ModelStore
from larkframe.operators.moments import collect_moments, fit_ols
from larkframe.session import new_folder

XS = ["x1", "x2", "x3"]


@pytest.fixture(scope="module")
def reg(tables):
    return tables.reg.select("key", "cat", "y", *XS).checkpoint() if tables.spark.sparkContext.getCheckpointDir() else tables.reg.select("key", "cat", "y", *XS)


def run(spark, name):
    return entry.queries()[name](spark, SMALL)


def test_folds_are_even_and_stable(spark, reg):
    a = rs.vfold(reg.select("key"), ["key"], 7)
    sizes = [r["count"] for r in a.groupBy("fold").count().collect()]
    assert len(sizes) == 7 and max(sizes) - min(sizes) <= 1
    b = rs.vfold(reg.select("key").repartition(5), ["key"], 7)
    assert a.exceptAll(b).count() == 0


def test_strata_keep_the_mix(spark, tables):
    s = rs.initial_split(tables.labels, ["doc_id"], strata=["quality"])
    for q, n in fe.class_counts(tables.labels, "quality").items():
        assert s.where((F.col("quality") == q) & (F.col("role") == "train")).count() == int(n * 0.75)


def test_out_of_bag_share(spark):
    for r in run(spark, "rs_oob").collect():
        assert abs(r["oob"] - 0.3679) < 0.04


def test_normalize_on_training_rows(spark, reg):
    train, test = reg.where(F.col("x2") < 6), reg.where(F.col("x2") >= 6)
    done = fe.prep(train, [fe.normalize(XS)])
    s = fe.bake(done, train).agg(F.avg("x1").alias("m"), F.stddev_samp("x1").alias("s")).first()
    assert abs(s["m"]) < 1e-9 and abs(s["s"] - 1) < 1e-9
    assert abs(fe.bake(done, test).agg(F.avg("x2")).first()[0]) > 1  # test rows do not change the fit


def test_constant_column_scales_to_null(spark):
    d = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    assert fe.bake(fe.prep(d, [fe.normalize(["x"])]), d).first()["x"] is None


def test_poly_is_orthogonal(spark, reg):
    d = fe.bake(fe.prep(reg, [fe.poly2("x1")]), reg)
    s = d.agg(F.sum("x1_poly_1"), F.sum("x1_poly_2"), F.sum(F.col("x1_poly_1") * F.col("x1_poly_2")), F.sum(F.col("x1_poly_2") * F.col("x1_poly_2"))).first()
    assert max(abs(s[0]), abs(s[1]), abs(s[2])) < 1e-6 and abs(s[3] - 1) < 1e-9


def test_spline_is_linear_outside(spark):
    d = spark.range(101).select(F.col("id").cast("double").alias("x"))
    done = fe.prep(d, [fe.natural_spline("x")])
    out = fe.bake(done, spark.createDataFrame([(110.0,), (120.0,), (130.0,)], "x double")).orderBy("x").collect()
    for i in range(1, 6):
        a, b, c = (r[f"x_ns_{i}"] for r in out)
        assert abs((c - b) - (b - a)) < 1e-6


def test_power_reduces_skew(spark, reg):
    d = reg.select(F.exp(F.col("x1") / 10).alias("x"))
    done = fe.bake(fe.prep(d, [fe.power(["x"])]), d)
    assert abs(done.agg(F.skewness("x")).first()[0]) < abs(d.agg(F.skewness("x")).first()[0])


def test_nzv_and_correlation_filters(spark, reg):
    d = reg.withColumns({"one": F.lit(1.0), "twin": F.col("x1") * 2})
    assert fe.near_zero_variance(d, XS + ["one"]) == ["one"]
    assert len(fe.correlated(d, XS + ["twin"], 0.9)) == 1


def test_impute_knn_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 3))
    gap = rng.random(200) < 0.2
    rows = [(i, None if gap[i] else float(x[i, 0]), float(x[i, 1]), float(x[i, 2])) for i in range(200)]
    d = spark.createDataFrame(rows, "id long, a double, b double, c double")
    got = {r["id"]: r["a"] for r in fe.bake(fe.prep(d, [fe.impute_knn("id", "a", ["b", "c"], 5)]), d).collect()}
    z = x[:, 1:] / x[:, 1:].std(0, ddof=1)
    for i in np.flatnonzero(gap):
        dist = np.sqrt(((z - z[i]) ** 2).sum(1))
        near = [j for j in np.argsort(dist) if not gap[j]][:5]
        assert got[i] == pytest.approx(x[near, 0].mean())


def test_pca_matches_numpy(spark):
    share = [r["share"] for r in run(spark, "fe_pca").orderBy("component").collect()]
    x = np.array([r[0] for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("embedding").collect()], dtype=float)
    w = np.linalg.eigvalsh(np.cov(x.T))[::-1]
    assert np.allclose(share, w[:10] / w.sum(), atol=1e-5)


def test_class_balance(spark, tables):
    n = fe.class_counts(tables.labels, "quality")
    assert set(fe.class_counts(fe.upsample(tables.labels, "doc_id", "quality"), "quality").values()) == {max(n.values())}
    assert set(fe.class_counts(fe.downsample(tables.labels, "doc_id", "quality"), "quality").values()) == {min(n.values())}
    rose = fe.class_counts(run(spark, "fe_rose"), "quality")
    assert set(rose.values()) == {sum(n.values()) // 2}


def test_elastic_net_matches_mllib(spark, reg):
    m = collect_moments(reg, XS + ["y"])[None]
    for penalty, mixture in ((0.0, 0.0), (2.0, 0.0), (2.0, 1.0), (5.0, 0.5)):
        b0, b = ln.elastic_net(m, "y", XS, penalty, mixture)
        fit = md.linear(reg, "y", XS, penalty, mixture, tol=1e-10, maxIter=500).stages[-1]
        assert np.allclose(b, fit.coefficients.toArray(), atol=1e-3) and abs(b0 - fit.intercept) < 2e-2


def test_fold_errors_from_moments(spark, reg):
    d = rs.vfold(reg, ["key"], 4)
    total, per = ln.fold_moments(d, "fold", XS + ["y"])
    fast = ln.cv_rmse(total, per, "y", XS, 0.0, 0.0)
    for f in (1, 4):
        fit = fit_ols(d.where(F.col("fold") != f), "y", XS)
        slow = d.where(F.col("fold") == f).agg(F.sqrt(F.avg((F.col("y") - fit.predict()) ** 2))).first()[0]
        assert fast[f] == pytest.approx(slow)


def test_path_gets_sparser(spark):
    n = {r["penalty"]: r["nonzero"] for r in run(spark, "ml_reg_path").collect()}
    counts = [n[p] for p in sorted(n)]
    assert counts[0] == 4 and counts[-1] < 4 and counts == sorted(counts, reverse=True)


def test_models_beat_the_null(spark, reg):
    sd = reg.agg(F.stddev_samp("y")).first()[0]
    for name in ("ml_tree_reg", "ml_rf_reg", "ml_gbt", "ml_bag"):
        assert all(r["rmse"] < sd / 2 for r in run(spark, name).collect()), name
    for name in ("ml_multinom", "ml_tree_class", "ml_rf_class", "ml_mlp"):
        rows = run(spark, name).collect()
        assert np.mean([r["cls"] == r["pred"] for r in rows]) > 0.6, name
    one = run(spark, "ml_svm_rbf").collect()
    assert np.mean([r["one"] == r["pred_one"] for r in one]) > 0.8


def test_logistic_and_svm(spark):
    rows = run(spark, "ml_logistic").collect()
    assert np.mean([r["event"] == r["pred_class"] for r in rows]) > 0.8
    rows = run(spark, "ml_svm_linear").collect()
    assert np.mean([r["event"] == r["pred"] for r in rows]) > 0.8


def test_tuning(spark):
    grid = run(spark, "tune_grid_regular").collect()
    assert len(grid) == 15 and min(grid, key=lambda r: r["mean"])["penalty"] <= 0.1
    bayes = run(spark, "tune_bayes").collect()
    first = min(r["mean"] for r in bayes if r["iter"] == 0)
    assert min(r["mean"] for r in bayes) <= first
    race = run(spark, "tune_race").collect()
    assert sum(r["n"] for r in race) == race[0]["fits"] < 250
    assert min((r for r in race if r["n"] == 5), key=lambda r: r["mean"])["finished"] == 1
    u = sorted(p["mixture"] for p in tn.grid_latin(10, 1, mixture=(0.0, 1.0)))
    assert all(i / 10 <= v < (i + 1) / 10 for i, v in enumerate(u))
    assert len(run(spark, "tune_nested").collect()) == 5


def test_blend_weights(spark):
    rows = run(spark, "ens_weight_opt").collect()
    w = {r["model"]: r["weight"] for r in rows}
    assert abs(sum(w.values()) - 1) < 1e-4 and min(w.values()) >= 0
    singles = {r["model"]: r["rmse"] for r in run(spark, "ens_compare").collect()}
    assert rows[0]["rmse"] <= min(singles.values()) + 1e-4
    c = run(spark, "ens_cascade").first()
    assert c["rmse_both"] < c["rmse_first"]


def test_elbow_falls(spark):
    w = [r["wcss"] for r in run(spark, "un_elbow").orderBy("k").collect()]
    assert all(a > b for a, b in zip(w, w[1:]))


def test_rand_index_ignores_names(spark):
    d = spark.createDataFrame([(i % 3, (i % 3 + 1) % 3) for i in range(30)], "a int, b int")
    assert cu.adjusted_rand(d, "a", "b").first()["ari"] == 1.0


def test_isolation_score_ranks_outlier_first(spark):
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(0, 1, (300, 2)), [[9.0, -9.0]]])
    d = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, a double, b double")
    assert cu.isolation_forest(d, "id", ["a", "b"], trees=30, sample=64).orderBy(F.col("score").desc()).first()["id"] == 300


def test_ward_joins_near_groups():
    c = np.array([[0.0, 0], [0.1, 0], [5, 5], [5.1, 5]])
    assert cu.ward_merge(c, np.ones(4), 2) == [1, 1, 2, 2]


def test_store_orders_versions_by_number(spark, reg):
    store = ModelStore(spark, new_folder(spark, "t"))
    m = md.linear(reg, "y", ["x1"])
    for v in ("1.9.0", "1.10.0", "1.2.0"):
        store.register(m, "m", v, "rmse", 1.0, 1)
    assert store.latest("m")["version"] == "1.10.0"
    assert store.load("m", "1.2.0").stages[-1].intercept == m.stages[-1].intercept
    with pytest.raises(KeyError):
        store.load("m", "3.0.0")


def test_pareto(spark):
    d = spark.createDataFrame([("a", 1, 5.0), ("b", 2, 3.0), ("c", 2, 4.0), ("d", 3, 3.0), ("e", 4, 1.0)], "config string, cost int, loss double")
    got = {r["config"]: r["optimal"] for r in tn.pareto(d, "cost", "loss", "config").collect()}
    assert got == {"a": True, "b": True, "c": False, "d": False, "e": True}


def test_retrain_recovers(spark):
    rows = run(spark, "ops_retrain").collect()
    hit = [r for r in rows if r["refitted"]]
    assert hit and all(r["rmse_after"] < r["rmse"] for r in hit)


def test_sampling_with_replacement(spark, tables):
    n = tables.orders.count()
    assert abs(run(spark, "sample_replace").count() - 2 * n) < 4 * (2 * n) ** 0.5
