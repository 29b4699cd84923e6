"""Models on the derived tables with a known signal."""

import math

import numpy as np
from pyspark.ml import classification as C
from pyspark.ml import regression as R
from pyspark.ml.functions import vector_to_array

from larkframe.learning import classic as cl
from larkframe.learning import linear as ln
from larkframe.learning import metrics as mt
from larkframe.learning import models as md
from larkframe.learning.resample import initial_split
from larkframe.operators.hashing import hash_positions
from larkframe.operators.moments import collect_moments, fit_ols
from larkframe.plans.base import *
from larkframe.plans.features import ROLE, split
from larkframe.plans.resampling import cnt_sql, rank_sql
from larkframe.plans.sqltext import fitted_sql, ols_sql, ridge_sql
from larkframe.session import materialized
from larkframe.tables import CLS_SQL, MULTI_SQL, REG_SQL

XS = ["x1", "x2", "x3"]
FX = ["f1", "f2", "f3", "f4"]
EX = ["e1", "e2", "e3"]
COEF_SQL = " UNION ALL ".join(["SELECT '(Intercept)' AS term, round(b0, 4) AS estimate FROM ols"] + [f"SELECT '{x}', round(b_{x}, 5) FROM ols" for x in XS])


def coefs(t, model, xs=XS) -> DataFrame:
    lin = model.stages[-1]
    rows = [("(Intercept)", round(float(lin.intercept), 4))] + [(x, round(float(b), 5)) for x, b in zip(xs, lin.coefficients)]
    return t.spark.createDataFrame(rows, "term string, estimate double")


def estimates(t, fit) -> DataFrame:
    rows = [("(Intercept)", round(fit.intercept, 4))] + [(x, None if np.isnan(b) else round(float(b), 5)) for x, b in zip(fit.names, fit.coef)]
    return t.spark.createDataFrame(rows, "term string, estimate double")


@query("ml_lm", f"WITH {REG_SQL}, {ols_sql('reg', 'y', XS)} {COEF_SQL}")
def ml_lm(t):
    return estimates(t, fit_ols(t.reg, "y", XS))


ALIASED = ["x1", "x2", "twice", "one", "x3", "all"]


@query("ml_lm_aliased", f"WITH {REG_SQL}, {ols_sql('reg', 'y', XS)} {COEF_SQL} UNION ALL SELECT unnest(['twice', 'one', 'all']), NULL::double")
def ml_lm_aliased(t):
    """Predictors that earlier ones give exactly, and a constant, have no estimate; the others are as without them."""
    d = t.reg.withColumns({"twice": 2 * col("x1"), "one": F.lit(7.0), "all": 3 + col("x1") - 0.5 * col("x2") + 4 * col("x3")})
    return estimates(t, fit_ols(d, "y", ALIASED))


@query("ml_ridge", f"WITH {REG_SQL}, {ols_sql('reg', 'y', XS, ridge=ridge_sql('5.0::double'))} {COEF_SQL}")
def ml_ridge(t):
    return coefs(t, md.linear(t.reg, "y", XS, 5.0, 0.0, solver="normal"))


@query("ml_lasso")
def ml_lasso(t):
    return coefs(t, md.linear(t.reg, "y", XS, 3.0, 1.0))


@query("ml_elastic")
def ml_elastic(t):
    return coefs(t, md.linear(t.reg, "y", XS, 3.0, 0.5))


@query("ml_reg_path")
def ml_reg_path(t):
    """Coefficients along a list of penalties: the path needs one moment pass, however many penalties there are."""
    cols = XS + ["x12"]
    m = collect_moments(t.reg.withColumn("x12", col("x1") * col("x2")), cols + ["y"])[None]
    rows = []
    for i in range(20):
        lam = 100 * 0.7**i
        b0, b = ln.elastic_net(m, "y", cols, lam, 1.0)
        rows += [(round(lam, 6), x, round(float(v), 5), int((np.abs(b) > 0).sum())) for x, v in zip(cols, b)]
    return t.spark.createDataFrame(rows, "penalty double, term string, estimate double, nonzero int")


@query("ml_glm", f"WITH {REG_SQL}, {ols_sql('reg', 'y', XS)} {COEF_SQL}")
def ml_glm(t):
    return coefs(t, md.assembled(XS, R.GeneralizedLinearRegression(family="gaussian", link="identity", labelCol="y")).fit(t.reg))


@query("ml_logistic")
def ml_logistic(t):
    d = materialized(t.cls.select("doc_id", "event", *FX))
    m = md.logistic(d, "event", FX, 0.01)
    return md.predict_prob(m, d).select("doc_id", "event", r(col("p_event"), 4).alias("p_event"), "pred_class")


@query("ml_multinom")
def ml_multinom(t):
    return classified(t, lambda tr: md.multinom(tr, "y", EX, 0.001))


def multi_split(t):
    d = materialized(initial_split(t.multi.withColumn("y", col("cls") - 1), ["vec_id"]))
    return d.where(col("role") == "train"), d.where(col("role") == "test")


def classified(t, fit) -> DataFrame:
    """Test rows with class and prediction of a model fitted on the training rows."""
    train, test = multi_split(t)
    return md.predict(fit(train), test).select("vec_id", "cls", (col("pred") + 1).cast("int").alias("pred"))


@query("ml_tree_class")
def ml_tree_class(t):
    return classified(t, lambda tr: md.tree_class(tr, "y", EX, depth=6))


@query("ml_rf_class")
def ml_rf_class(t):
    return classified(t, lambda tr: md.forest_class(tr, "y", EX, trees=20, depth=6))


@query("ml_mlp")
def ml_mlp(t):
    est = C.MultilayerPerceptronClassifier(labelCol="y", layers=[3, 6, 3], maxIter=60, seed=md.SEED)
    return classified(t, lambda tr: md.assembled(EX, est).fit(tr))


def regressed(t, **fits) -> DataFrame:
    """Test error of regression models fitted on the training rows."""
    train, d = split(t)
    test = d.where(col("role") == "test")
    out = None
    for name, fit in fits.items():
        p = md.predict(fit(train), test).agg(r(mt.rmse("y", "pred"), 4).alias("rmse"), r(mt.rsq("y", "pred")).alias("rsq")).select(F.lit(name).alias("model"), "rmse", "rsq")
        out = p if out is None else out.unionByName(p)
    return out


@query("ml_tree_reg")
def ml_tree_reg(t):
    return regressed(t, depth3=lambda tr: md.tree_reg(tr, "y", XS, 3), depth6=lambda tr: md.tree_reg(tr, "y", XS, 6))


@query("ml_rf_reg")
def ml_rf_reg(t):
    return regressed(t, forest=lambda tr: md.forest_reg(tr, "y", XS, trees=20, depth=6, mtry="2"))


@query("ml_gbt")
def ml_gbt(t):
    return regressed(t, boosted=lambda tr: md.boosted(tr, "y", XS, rounds=10, depth=4, rate=0.3, share=0.8))


@query("ml_bag")
def ml_bag(t):
    return regressed(t, one_tree=lambda tr: md.tree_reg(tr, "y", XS, 8), bagged=lambda tr: md.forest_reg(tr, "y", XS, trees=10, depth=8, mtry="all"))


@query("ml_svm_linear")
def ml_svm_linear(t):
    d = materialized(t.cls.select("doc_id", "event", *FX))
    cost = 1.0
    m = md.assembled(FX, C.LinearSVC(labelCol="event", regParam=1.0 / (d.count() * cost), maxIter=50)).fit(d)
    return md.predict(m, d).select("doc_id", "event", col("pred").cast("int").alias("pred"))


@query("ml_svm_rbf")
def ml_svm_rbf(t):
    """Kernel margin by random Fourier features: class 1 against the rest, and a regression on the same features."""
    feats = cl.fourier_features(EX, 4.0, 60, 11)
    names = [f"rff_{i}" for i in range(60)]
    d = materialized(t.multi.select("vec_id", (col("cls") == 1).cast("int").alias("one"), (col("e1") - col("e2") * col("e3")).alias("y"), *feats))
    c = md.predict(md.assembled(names, C.LinearSVC(labelCol="one", regParam=1e-3, maxIter=50)).fit(d), d, "pred_one")
    g = md.predict(md.linear(d, "y", names, 1e-3, 0.0), d, "pred_y").select("vec_id", "y", "pred_y")
    return c.select("vec_id", "one", col("pred_one").cast("int").alias("pred_one")).join(g, "vec_id").select("vec_id", "one", "pred_one", r(col("y"), 5).alias("y"), r(col("pred_y"), 4).alias("pred_y"))


MROLE = f"CASE WHEN {rank_sql('vec_id', 'split')} <= floor({cnt_sql()} * 0.75) THEN 'train' ELSE 'test' END AS role"


@query("ml_knn", f"""WITH {MULTI_SQL}, s AS (SELECT *, embedding::double[64] AS v, {MROLE} FROM multi), kn AS (SELECT b.vec_id, a.cls, row_number() OVER (PARTITION BY b.vec_id ORDER BY array_distance(a.v, b.v), a.vec_id) AS k
FROM s a, s b WHERE a.role = 'train' AND b.role = 'test'), vt AS (SELECT vec_id, cls, count(*) AS n FROM kn WHERE k <= 5 GROUP BY 1, 2)
SELECT vec_id, s.cls, p.pred FROM s JOIN (SELECT vec_id, arg_max(cls, (n, -cls)) AS pred FROM vt GROUP BY 1) p USING (vec_id)""")
def ml_knn(t):
    train, test = multi_split(t)
    vec = F.transform("embedding", lambda x: x.cast("double")).alias("vec")
    cols = ("vec_id", "cls", vec)
    return cl.knn_vote(train.select(*cols), test.select(*cols), "vec_id", "vec", "cls", 5).select("vec_id", "cls", "pred")


@query("ml_nb", f"""WITH {MULTI_SQL}, e AS (SELECT cls, count(*) AS n, {', '.join(f'avg({x}) AS m_{x}, var_pop({x}) AS v_{x}' for x in EX)} FROM multi GROUP BY 1),
l AS (SELECT vec_id, multi.cls AS truth, e.cls AS c, ln(n / (SELECT count(*) FROM multi)) {''.join(f' - 0.5::double * ln(2 * pi() * v_{x}) - pow({x} - m_{x}, 2) / (2 * v_{x})' for x in EX)} AS ll FROM multi, e)
SELECT vec_id, arg_max(c, ll) AS pred, any_value(truth) AS cls, round(1 / sum(exp(ll - (SELECT max(k.ll) FROM l k WHERE k.vec_id = l.vec_id))), 4) AS p_top FROM l GROUP BY 1""")
def ml_nb(t):
    d = t.multi.withColumn("y", col("cls") - 1)
    out = md.assembled(EX, C.NaiveBayes(labelCol="y", modelType="gaussian")).fit(d).transform(d)
    return out.select("vec_id", (col("prediction") + 1).cast("int").alias("pred"), "cls", r(F.array_max(vector_to_array("probability")), 4).alias("p_top"))


@query("ml_lda", f"""WITH {MULTI_SQL}, g AS (SELECT cls, count(*) AS n, avg(e1) AS m1, avg(e2) AS m2, var_pop(e1) AS s11, var_pop(e2) AS s22, covar_pop(e1, e2) AS s12 FROM multi GROUP BY 1),
p AS (SELECT sum(n) AS nn, sum(n * s11) / (sum(n) - 3) AS p11, sum(n * s22) / (sum(n) - 3) AS p22, sum(n * s12) / (sum(n) - 3) AS p12 FROM g),
w AS (SELECT cls AS c, (p22 * m1 - p12 * m2) / (p11 * p22 - p12 * p12) AS w1, (p11 * m2 - p12 * m1) / (p11 * p22 - p12 * p12) AS w2, m1, m2, ln(n / nn) AS prior FROM g, p),
sc AS (SELECT vec_id, cls, c, prior - 0.5::double * (m1 * w1 + m2 * w2) + w1 * e1 + w2 * e2 AS s FROM multi, w) SELECT vec_id, cls, arg_max(c, s) AS pred, round(max(s), 5) AS score FROM sc GROUP BY 1, 2""")
def ml_lda(t):
    d = cl.discriminant(t.multi, "cls", ["e1", "e2"])(t.multi)
    return d.select("vec_id", "cls", "pred", r(F.greatest("score_1", "score_2", "score_3"), 5).alias("score"))


@query("ml_null", f"WITH {REG_SQL} SELECT key, (SELECT round(avg(y), 5) FROM reg) AS pred, (SELECT cat FROM reg GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS pred_class FROM reg")
def ml_null(t):
    mean = one_row(t.reg, m=F.avg("y"))["m"]
    top = t.reg.groupBy("cat").agg(F.count(F.lit(1)).alias("n")).orderBy(col("n").desc(), "cat").first()["cat"]
    return t.reg.select("key", r(F.lit(mean), 5).alias("pred"), F.lit(top).alias("pred_class"))


@query("ml_predict_types")
def ml_predict_types(t):
    d = materialized(t.cls.select("doc_id", "event", *FX))
    p = md.predict_prob(md.logistic(d, "event", FX, 0.01), d)
    return p.select("doc_id", F.when(col("pred_class") == 1, "bad").otherwise("good").alias(".pred_class"), r(col("p_event"), 4).alias(".pred_bad"), r(1 - col("p_event"), 4).alias(".pred_good"))


@query("ml_tidy_coefs", f"WITH {REG_SQL}, {ols_sql('reg', 'y', XS)}, sd AS (SELECT {', '.join(f'stddev_samp({x}) AS s_{x}' for x in XS)} FROM reg) " + " UNION ALL ".join(f"SELECT '{x}' AS term, round(b_{x}, 5) AS estimate, round(b_{x} * s_{x}, 4) AS scaled FROM ols, sd" for x in XS))
def ml_tidy_coefs(t):
    """Slopes and standardised slopes, largest first."""
    m = md.linear(t.reg, "y", XS, solver="normal").stages[-1]
    sd = one_row(t.reg, **{x: F.stddev_samp(x) for x in XS})
    rows = [(x, round(float(b), 5), round(float(b) * sd[x], 4)) for x, b in zip(XS, m.coefficients)]
    return t.spark.createDataFrame(rows, "term string, estimate double, scaled double").orderBy(F.abs("scaled").desc())


@query("ml_importance")
def ml_importance(t):
    m = md.forest_reg(split(t)[0], "y", XS, trees=10, depth=5).stages[-1]
    rows = sorted(((x, round(float(v), 6)) for x, v in zip(XS, m.featureImportances.toArray())), key=lambda p: -p[1])
    return t.spark.createDataFrame(rows, "feature string, importance double").orderBy(col("importance").desc())


def shuffled(df: DataFrame, key: str, x: str, seed: str) -> DataFrame:
    """Column x with its values moved between rows: the value at a row's place in one hash order comes from that place in another."""
    a = hash_positions(df, [key], seed + "a", None, "_pos", "_n").drop("_n")
    b = hash_positions(df.select(key, x), [key], seed + "b", None, "_pos", "_n").select("_pos", col(x).alias("_x"))
    return a.join(b, "_pos").withColumn(x, col("_x")).drop("_pos", "_x")


def _perm_sql(x: str) -> str:
    return (f"SELECT '{x}' AS feature, round(sqrt(avg((a.y - (b0 + {' + '.join(f'b_{z} * ' + ('b.' if z == x else 'a.') + z for z in XS)})) ** 2)) - max(base), 4) AS rise "
            f"FROM (SELECT *, {rank_sql('key', f'perm-{x}a')} AS pos FROM reg) a JOIN (SELECT {x}, {rank_sql('key', f'perm-{x}b')} AS pos FROM reg) b USING (pos), ols, bs")


@query("ml_perm_importance", f"WITH {REG_SQL}, {ols_sql('reg', 'y', XS)}, bs AS (SELECT sqrt(avg((y - {fitted_sql(XS, 'ols.')}) ** 2)) AS base FROM reg, ols) " + " UNION ALL ".join(_perm_sql(x) for x in XS))
def ml_perm_importance(t):
    d = materialized(t.reg.select("key", "y", *XS))
    f = fit_ols(d, "y", XS)
    base = one_row(d, e=mt.rmse(col("y"), f.predict()))["e"]
    out = None
    for x in XS:
        e = shuffled(d, "key", x, f"perm-{x}").agg(r(mt.rmse(col("y"), f.predict()) - base, 4).alias("rise")).select(F.lit(x).alias("feature"), "rise")
        out = e if out is None else out.unionByName(e)
    return out.orderBy(col("rise").desc())


SPECS = [("ridge", 1.0), ("ridge", 10.0), ("lasso", 1.0), ("tree", 3.0), ("tree", 5.0)]


@query("ml_spec_grid")
def ml_spec_grid(t):
    """One fitted model per row of a parameter table, with its training error."""
    d = materialized(t.reg.select("key", "y", *XS))
    make = {"ridge": lambda v: md.linear(d, "y", XS, v, 0.0), "lasso": lambda v: md.linear(d, "y", XS, v, 1.0), "tree": lambda v: md.tree_reg(d, "y", XS, int(v))}
    out = None
    for kind, value in SPECS:
        e = md.predict(make[kind](value), d).agg(r(mt.rmse("y", "pred"), 4).alias("rmse")).select(F.lit(kind).alias("model"), F.lit(value).alias("value"), "rmse")
        out = e if out is None else out.unionByName(e)
    return out
