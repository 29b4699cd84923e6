"""Workflows, resampled evaluation and tuning."""

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml import regression as R
from pyspark.ml.feature import RFormula, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array

from larkframe.learning import binned as bn
from larkframe.learning import features as fe
from larkframe.learning import linear as ln
from larkframe.learning import metrics as mt
from larkframe.learning import models as md
from larkframe.learning import resample as rs
from larkframe.learning import search as se
from larkframe.learning import tuning as tn
from larkframe.operators.moments import Moments, collect_moments, fit_ols, solve
from larkframe.plans.base import *
from larkframe.plans.features import ROLE, split
from larkframe.plans.resampling import cnt_sql, rank_sql
from larkframe.plans.sqltext import fitted_sql, ols_sql, ridge_sql
from larkframe.session import materialized
from larkframe.tables import REG_SQL

XS = ["x1", "x2", "x3"]
LAMS = [0.0, 5.0, 50.0]
RIDGES = [{"config": f"{v:g}", "penalty": v} for v in LAMS]


def folds(t, v: int = 5) -> DataFrame:
    return rs.vfold(t.reg, ["key"], v)


def fold_rows(t, v: int = 5) -> DataFrame:
    """What fits on Spark need of the folds, written once for all of them."""
    return materialized(folds(t, v).select("fold", "y", *XS))


FOLD_SQL = REG_SQL + ", fd AS (SELECT *, ntile(5) OVER (ORDER BY md5(concat_ws('-', key, 'fold')), key)::int AS fold FROM reg)"
CV_SQL = FOLD_SQL + f""", ft AS (SELECT f, lam, x1, x2, x3, y FROM fd, range(1, 6) q(f), (SELECT unnest([{', '.join(f'{v}::double' for v in LAMS)}]) AS lam) l WHERE fold <> f),
{ols_sql('ft', 'y', XS, by='f, lam', ridge=ridge_sql('lam'))},
sc AS (SELECT key, f::int AS fold, printf('%g', lam) AS config, y, {fitted_sql(XS, 'o.')} AS pred FROM fd JOIN ols o ON fd.fold = o.f),
res AS (SELECT config, fold, sqrt(avg((y - pred) ** 2)) AS rmse, corr(y, pred) ** 2 AS rsq, avg(abs(y - pred)) AS mae FROM sc GROUP BY 1, 2),
lg AS (SELECT config, fold, 'rmse' AS metric, rmse AS estimate FROM res UNION ALL SELECT config, fold, 'rsq', rsq FROM res UNION ALL SELECT config, fold, 'mae', mae FROM res),
sm AS (SELECT config, metric, avg(estimate) AS mean, count(*) AS n, stddev_samp(estimate) / sqrt(count(*)) AS std_err FROM lg GROUP BY 1, 2)"""


def results(t, candidates=None) -> DataFrame:
    return ln.cv_metrics(folds(t), "fold", "y", XS, candidates or RIDGES)


@query("wf_fit_predict")
def wf_fit_predict(t):
    """One object from raw rows to predictions: steps and learner fitted together."""
    train, d = split(t)
    stages = [RFormula(formula="y ~ x1 + x2 + x3 + x1:x2 + cat", labelCol="label"), R.LinearRegression(labelCol="y", solver="normal")]
    return md.predict(Pipeline(stages=stages).fit(train), d).select("key", "role", r(col("pred"), 4).alias("pred"))


CATS = "cd AS (SELECT *, (cat = 'A')::int::double AS ca, (cat = 'N')::int::double AS cn FROM reg)"


@query("wf_formula", f"WITH {REG_SQL}, {CATS}, {ols_sql('cd', 'y', ['x1', 'x2', 'ca', 'cn'])} SELECT key, round({fitted_sql(['x1', 'x2', 'ca', 'cn'])}, 4) AS pred FROM cd, ols")
def wf_formula(t):
    m = Pipeline(stages=[RFormula(formula="y ~ x1 + x2 + cat", labelCol="label"), R.LinearRegression(labelCol="y", solver="normal")]).fit(t.reg)
    return md.predict(m, t.reg).select("key", r(col("pred"), 4).alias("pred"))


@query("wf_variables", f"WITH {REG_SQL}, {ols_sql('reg', 'y', XS)} SELECT key, round({fitted_sql(XS)}, 4) AS pred FROM reg, ols")
def wf_variables(t):
    return md.predict(md.linear(t.reg, "y", XS, solver="normal"), t.reg).select("key", r(col("pred"), 4).alias("pred"))


@query("wf_extract")
def wf_extract(t):
    m = md.linear(t.reg, "y", XS, solver="normal")
    rows = [(i, type(s).__name__, float(s.intercept) if hasattr(s, "intercept") else None) for i, s in enumerate(m.stages)]
    return t.spark.createDataFrame(rows, "position int, stage string, intercept double").withColumn("intercept", r(col("intercept"), 4))


@query("wf_remove_model", f"WITH {REG_SQL} SELECT key, {', '.join(f'round(({x} - avg({x}) OVER ()) / stddev_samp({x}) OVER (), 5) AS {x}' for x in XS)} FROM reg")
def wf_remove_model(t):
    """The fitted transformation without its learner."""
    stages = [VectorAssembler(inputCols=XS, outputCol="v"), StandardScaler(inputCol="v", outputCol="features", withMean=True), R.LinearRegression(labelCol="y")]
    fitted = Pipeline(stages=stages).fit(t.reg)
    a = vector_to_array("features")
    return PipelineModel(fitted.stages[:-1]).transform(t.reg).select("key", *[r(a[i], 5).alias(x) for i, x in enumerate(XS)])


@query("wf_set")
def wf_set(t):
    """Every preprocessing with every model."""
    train, d = split(t)
    test = d.where(col("role") == "test")
    pre = {"raw": ([], XS), "scaled": ([fe.normalize(XS)], XS), "product": ([fe.interact("x1", "x2")], XS + ["x1_x_x2"])}
    fit = {"linear": lambda df, xs: md.linear(df, "y", xs), "tree": lambda df, xs: md.tree_reg(df, "y", xs, 4)}
    out = None
    for p, (steps, xs) in pre.items():
        done = fe.prep(train, steps)
        a, b = fe.bake(done, train), fe.bake(done, test)
        for f, make in fit.items():
            e = md.predict(make(a, xs), b).agg(r(mt.rmse("y", "pred"), 4).alias("rmse")).select(F.lit(f"{p}_{f}").alias("wflow"), "rmse")
            out = e if out is None else out.unionByName(e)
    return out


@query("wf_fit_resamples", f"WITH {CV_SQL} SELECT fold, metric, round(estimate, 5) AS estimate FROM lg WHERE config = '0'")
def wf_fit_resamples(t):
    return results(t, RIDGES[:1]).select("fold", "metric", r(col("estimate"), 5).alias("estimate"))


@query("wf_collect_metrics", f"WITH {CV_SQL} SELECT config, metric, round(mean, 5) AS mean, n, round(std_err, 5) AS std_err FROM sm")
def wf_collect_metrics(t):
    return ln.collect_metrics(results(t)).select("config", "metric", r(col("mean"), 5).alias("mean"), "n", r(col("std_err"), 5).alias("std_err"))


@query("wf_collect_predictions", f"WITH {CV_SQL} SELECT key, fold, config, round(pred, 4) AS pred FROM sc")
def wf_collect_predictions(t):
    p = ln.cv_predictions(folds(t), "fold", "y", XS, RIDGES)
    return p.select("key", "fold", "config", r(col("pred"), 4).alias("pred"))


@query("wf_last_fit", f"WITH {REG_SQL}, s AS (SELECT *, {ROLE} FROM reg), tr AS (SELECT * FROM s WHERE role = 'train'), {ols_sql('tr', 'y', XS)}, p AS (SELECT y, {fitted_sql(XS)} AS pred FROM s, ols WHERE role = 'test') SELECT round(sqrt(avg((y - pred) ** 2)), 4) AS rmse, round(corr(y, pred) ** 2, 6) AS rsq, round(avg(abs(y - pred)), 4) AS mae FROM p")
def wf_last_fit(t):
    train, d = split(t)
    p = md.predict(md.linear(train, "y", XS, solver="normal"), d.where(col("role") == "test"))
    return p.agg(r(mt.rmse("y", "pred"), 4).alias("rmse"), r(mt.rsq("y", "pred")).alias("rsq"), r(mt.mae("y", "pred"), 4).alias("mae"))


@query("wf_compare_models")
def wf_compare_models(t):
    d = fold_rows(t, 3)
    fits = {"tree": lambda tr: (lambda m: lambda df: md.predict(m, df))(md.tree_reg(tr, "y", XS, 5)),
            "forest": lambda tr: (lambda m: lambda df: md.predict(m, df))(md.forest_reg(tr, "y", XS, trees=10, depth=5))}
    both = ln.cv_metrics(d, "fold", "y", XS, RIDGES[:2]).select("config", "fold", "metric", "estimate").unionByName(tn.fit_resamples(d, "fold", "y", fits))
    return ln.collect_metrics(both).select("config", "metric", r(col("mean"), 4).alias("mean"), "n", r(col("std_err"), 4).alias("std_err"))


RECIPES = {"main": ["x1", "x2", "x3"], "product": ["x1", "x2", "x3", "x12"], "few": ["x1", "x2"]}


def _recipe_sql(name: str, xs: list[str]) -> str:
    return f"""{ols_sql('fx', 'y', xs, by='f', name='o_' + name)}, e_{name} AS (SELECT f, sqrt(avg((y - {fitted_sql(xs, 'o.')}) ** 2)) AS e FROM px JOIN o_{name} o ON px.fold = o.f GROUP BY 1)"""


@query("wf_compare_preproc", f"WITH {FOLD_SQL}, px AS (SELECT *, x1 * x2 AS x12 FROM fd), fx AS (SELECT f, x1, x2, x3, x12, y FROM px, range(1, 6) q(f) WHERE fold <> f), " + ", ".join(_recipe_sql(n, xs) for n, xs in RECIPES.items())
       + " " + " UNION ALL ".join(f"SELECT '{n}' AS recipe, round(avg(e), 5) AS rmse, round(stddev_samp(e) / sqrt(5), 5) AS std_err FROM e_{n}" for n in RECIPES))
def wf_compare_preproc(t):
    """Recipes that differ in their columns: one moment table over all columns serves every recipe and fold."""
    cols = ["x1", "x2", "x3", "x12", "y"]
    total, per = ln.fold_moments(folds(t).withColumn("x12", col("x1") * col("x2")), "fold", cols)
    rows = []
    for name, xs in RECIPES.items():
        e = list(ln.cv_rmse(total, per, "y", xs, 0.0, 0.0).values())
        rows.append((name, round(float(np.mean(e)), 5), round(float(np.std(e, ddof=1) / np.sqrt(len(e))), 5)))
    return t.spark.createDataFrame(rows, "recipe string, rmse double, std_err double")


def _scheme(name: str, assign: str) -> str:
    return f"""a_{name} AS ({assign}), {ols_sql(f'(SELECT * FROM a_{name} WHERE NOT held)', 'y', XS, by='f', name='o_' + name)}, e_{name} AS (SELECT f, sqrt(avg((y - {fitted_sql(XS, 'o.')}) ** 2)) AS e FROM a_{name} JOIN o_{name} o USING (f) WHERE held GROUP BY 1)"""


def _vf(v: int) -> str:
    return f"SELECT f, x1, x2, x3, y, k = f AS held FROM (SELECT *, ntile({v}) OVER (ORDER BY md5(concat_ws('-', key, 'fold')), key) AS k FROM reg), range(1, {v + 1}) q(f)"


MC = "SELECT f, x1, x2, x3, y, row_number() OVER (PARTITION BY f ORDER BY md5(concat_ws('-', key, f, 'mc')), key) > floor(count(*) OVER (PARTITION BY f) * 0.9) AS held FROM reg, range(1, 4) q(f)"


@query("wf_compare_resampling", f"WITH {REG_SQL}, {_scheme('v5', _vf(5))}, {_scheme('v10', _vf(10))}, {_scheme('mc', MC)} " + " UNION ALL ".join(
    f"SELECT '{n}' AS scheme, count(*) AS n, round(avg(e), 5) AS rmse, round(stddev_samp(e) / sqrt(count(*)), 5) AS std_err FROM e_{n}" for n in ("v5", "v10", "mc")))
def wf_compare_resampling(t):
    """Linear fits under three resampling schemes; each scheme is one moment pass."""
    base = materialized(t.reg)
    rows = []

    def add(name, e):
        rows.append((name, len(e), round(float(np.mean(e)), 5), round(float(np.std(e, ddof=1) / np.sqrt(len(e))), 5)))

    for name, v in (("v5", 5), ("v10", 10)):
        total, per = ln.fold_moments(rs.vfold(base, ["key"], v), "fold", XS + ["y"])
        add(name, list(ln.cv_rmse(total, per, "y", XS, 0.0, 0.0).values()))
    mc = rs.mc_split(base, ["key"], 0.9, 3).withColumn("part", F.concat_ws("|", "rep", "role"))
    m = collect_moments(mc, XS + ["y"], "part")
    add("mc", [held_out_rmse(m[f"{i}|analysis"], m[f"{i}|assessment"]) for i in (1, 2, 3)])
    return t.spark.createDataFrame(rows, "scheme string, n long, rmse double, std_err double")


def held_out_rmse(train: Moments, test: Moments) -> float:
    both_n = train.n + test.n
    mean = (train.n * train.mean + test.n * test.mean) / both_n
    cov = sum(x.n * (x.cov + np.outer(x.mean - mean, x.mean - mean)) for x in (train, test)) / both_n
    return ln.cv_rmse(Moments(both_n, mean, cov, train.cols), {0: test}, "y", XS, 0.0, 0.0)[0]


# Tuning

def long_table(t, candidates, schema_cols: str, scores: dict) -> DataFrame:
    rows = [{**c, "mean": round(float(np.mean(list(scores[c["config"]].values()))), 5), "n": len(scores[c["config"]])} for c in candidates]
    return tn.table(t.spark, rows, f"config string, {schema_cols}, mean double, n int")


def scored_grid(t, candidates, d=None) -> dict:
    """Held-out rmse per fold for penalised fits: the rows are passed over once for the whole grid."""
    total, per = ln.fold_moments(d if d is not None else folds(t), "fold", XS + ["y"])
    return {c["config"]: ln.cv_rmse(total, per, "y", XS, c["penalty"], c["mixture"]) for c in candidates}


PM = "penalty double, mixture double"


@query("tune_grid_regular")
def tune_grid_regular(t):
    grid = tn.grid_regular(penalty=tn.log_levels(0.01, 100, 5), mixture=[0.0, 0.5, 1.0])
    return long_table(t, grid, PM, scored_grid(t, grid))


@query("tune_grid_random")
def tune_grid_random(t):
    """Random tree settings; every candidate and fold is a Spark fit, several at a time."""
    d = fold_rows(t, 3)
    grid = tn.grid_random(4, 21, depth=(2, 6), min_n=(1, 40))
    fits = {c["config"]: (lambda tr, c=c: (lambda m: lambda df: md.predict(m, df))(md.tree_reg(tr, "y", XS, c["depth"], c["min_n"]))) for c in grid}
    res = ln.collect_metrics(tn.fit_resamples(d, "fold", "y", fits)).where(col("metric") == "rmse")
    specs = tn.table(t.spark, grid, "config string, depth int, min_n int")
    return specs.join(res, "config").select("config", "depth", "min_n", r(col("mean"), 4).alias("mean"), "n")


@query("tune_lhs")
def tune_lhs(t):
    grid = tn.grid_latin(12, 5, penalty=(0.01, 100.0, "log"), mixture=(0.0, 1.0))
    return long_table(t, grid, PM, scored_grid(t, grid))


@query("tune_select", f"WITH {CV_SQL}, k AS (SELECT metric, config, mean, row_number() OVER (PARTITION BY metric ORDER BY CASE WHEN metric = 'rsq' THEN -mean ELSE mean END, config) AS place FROM sm) SELECT metric, config, round(mean, 5) AS mean, place FROM k WHERE place <= 2 AND metric <> 'mae'")
def tune_select(t):
    s = ln.collect_metrics(results(t))
    out = None
    for m in ("rmse", "rsq"):
        d = tn.show_best(s, m, 2)
        order = col("mean").desc() if m == "rsq" else col("mean").asc()
        d = d.withColumn("place", F.row_number().over(Window.partitionBy("metric").orderBy(order, "config")))  # two rows
        out = d if out is None else out.unionByName(d)
    return out.select("metric", "config", r(col("mean"), 5).alias("mean"), "place")


@query("tune_bayes")
def tune_bayes(t):
    """Forest settings by expected improvement: 5 random points, up to 10 more, two at a time; every point and fold is a Spark fit of 20 trees."""
    d = bn.binned(fold_rows(t, 3), "fold", "y", XS, bags=20)
    points = [{"mtry": m, "min_n": n} for m in range(1, len(XS) + 1) for n in range(5, 31)]
    rows = se.bayes(bn.fold_fits(d, lambda i: points[i], threads=6), points, [1, 2, 3], initial=5, iters=10, no_improve=5, uncertain=5, seed=456)
    return tn.table(t.spark, [{**x, "mean": round(x["mean"], 4)} for x in rows], "iter int, how string, mtry int, min_n int, mean double")


RACE = "n int, finished int"


@query("tune_race")
def tune_race(t):
    """50 penalties and mixtures race over 5 folds; those behind after 3 folds are fitted no further. Fits solve the moments of their fold."""
    grid = tn.grid_latin(50, 8, penalty=(1e-4, 1.0, "log"), mixture=(0.0, 1.0))
    by = {c["config"]: c for c in grid}
    total, per = ln.fold_moments(folds(t), "fold", XS + ["y"])
    run = lambda tasks: [ln.cv_rmse(total, {f: per[f]}, "y", XS, by[c]["penalty"], by[c]["mixture"])[f] for c, f in tasks]
    rows, fits = se.race(run, list(by), sorted(per))
    return tn.table(t.spark, [{**by[x["config"]], **x, "mean": round(x["mean"], 5), "fits": fits} for x in rows], f"config string, {PM}, mean double, {RACE}, fits int")


@query("tune_race_trees")
def tune_race_trees(t):
    """Tree settings race over 5 folds, each a Spark fit: those behind after 3 folds are not fitted on the others."""
    grid = tn.grid_regular(depth=[1, 2, 4, 6], min_n=[5, 30])
    by = {c["config"]: c for c in grid}
    d = bn.binned(fold_rows(t), "fold", "y", XS)
    settings = lambda name: {k: by[name][k] for k in ("depth", "min_n")}
    rows, fits = se.race(bn.fold_fits(d, settings, threads=6), list(by), [1, 2, 3, 4, 5])
    return tn.table(t.spark, [{**by[x["config"]], **x, "mean": round(x["mean"], 4), "fits": fits} for x in rows], f"config string, depth int, min_n int, mean double, {RACE}, fits int")


@query("tune_anneal")
def tune_anneal(t):
    total, per = ln.fold_moments(folds(t), "fold", XS + ["y"])
    score = lambda u: float(np.mean(list(ln.cv_rmse(total, per, "y", XS, 10 ** (4 * u[0] - 2), u[1]).values())))
    rows = tn.anneal(score, 2, 20, seed=9)
    return t.spark.createDataFrame([(x["iter"], round(10 ** (4 * float(x["u"][0]) - 2), 5), round(float(x["u"][1]), 5), round(x["mean"], 5), x["accepted"]) for x in rows], f"iter int, {PM}, mean double, accepted int")


@query("tune_nested")
def tune_nested(t):
    """Penalty chosen inside each outer fold, score on its outer rows: one moment table over outer x inner folds."""
    cols = XS + ["y"]
    d = rs.vfold(rs.vfold(t.reg, ["key"], 5, "outer", name="outer_fold"), ["key"], 4, "inner", name="inner_fold")
    m = collect_moments(d.withColumn("cell", F.concat_ws("|", "outer_fold", "inner_fold")), cols, "cell")
    merge = lambda ms: _merged(list(ms), cols)
    total = merge(m.values())
    rows = []
    for o in range(1, 6):
        held = merge(v for k, v in m.items() if k.startswith(f"{o}|"))
        inner = {i: merge(v for k, v in m.items() if k.endswith(f"|{i}") and not k.startswith(f"{o}|")) for i in range(1, 5)}
        train = merge(inner.values())
        cv = {p: float(np.mean(list(ln.cv_rmse(train, inner, "y", XS, p, 0.0).values()))) for p in tn.log_levels(0.01, 100, 5)}
        best = min(cv, key=cv.get)
        rows.append((o, best, round(cv[best], 5), round(ln.cv_rmse(total, {0: held}, "y", XS, best, 0.0)[0], 5)))
    return t.spark.createDataFrame(rows, "outer int, penalty double, inner_rmse double, outer_rmse double")


def _merged(ms: list[Moments], cols: list[str]) -> Moments:
    n = sum(m.n for m in ms)
    mean = sum(m.n * m.mean for m in ms) / n
    return Moments(n, mean, sum(m.n * (m.cov + np.outer(m.mean - mean, m.mean - mean)) for m in ms) / n, cols)


@query("tune_multi_metric", f"WITH {CV_SQL}, k AS (SELECT metric, config, row_number() OVER (PARTITION BY metric ORDER BY CASE WHEN metric = 'rsq' THEN -mean ELSE mean END, config) AS p FROM sm), b AS (SELECT metric AS chosen_by, config FROM k WHERE p = 1) SELECT chosen_by, config, round(max(mean) FILTER (metric = 'rmse'), 5) AS rmse, round(max(mean) FILTER (metric = 'rsq'), 5) AS rsq, round(max(mean) FILTER (metric = 'mae'), 5) AS mae FROM b JOIN sm USING (config) GROUP BY 1, 2")
def tune_multi_metric(t):
    s = materialized(ln.collect_metrics(results(t)))
    best = None
    for m in ("rmse", "rsq", "mae"):
        b = tn.show_best(s, m).select(F.lit(m).alias("chosen_by"), "config")
        best = b if best is None else best.unionByName(b)
    wide = s.groupBy("config").pivot("metric", ["rmse", "rsq", "mae"]).agg(F.first("mean"))
    return best.join(wide, "config").select("chosen_by", "config", *[r(col(m), 5).alias(m) for m in ("rmse", "rsq", "mae")])


@query("tune_coarse_fine")
def tune_coarse_fine(t):
    d = fold_rows(t)
    coarse = [{"config": f"coarse{i}", "penalty": p, "mixture": 0.0} for i, p in enumerate(tn.log_levels(0.01, 100, 5))]
    a = scored_grid(t, coarse, d)
    best = min(coarse, key=lambda c: np.mean(list(a[c["config"]].values())))
    fine = [{"config": f"fine{i}", "penalty": p, "mixture": 0.0} for i, p in enumerate(tn.log_levels(best["penalty"] / 10, best["penalty"] * 10, 7))]
    return long_table(t, coarse + fine, PM, {**a, **scored_grid(t, fine, d)})


@query("tune_diagnostics", f"WITH {CV_SQL} SELECT config, metric, round(avg(estimate), 5) AS mean, round(stddev_samp(estimate), 5) AS sd, round(stddev_samp(estimate) / avg(estimate), 5) AS cv FROM lg GROUP BY 1, 2")
def tune_diagnostics(t):
    e = "estimate"
    return results(t).groupBy("config", "metric").agg(r(F.avg(e), 5).alias("mean"), r(F.stddev_samp(e), 5).alias("sd"), r(F.try_divide(F.stddev_samp(e), F.avg(e)), 5).alias("cv"))


SUBSETS = [["x1"], ["x2"], ["x3"], ["x1", "x2"], ["x1", "x3"], ["x2", "x3"], ["x1", "x2", "x3"]]


@query("tune_pareto", f"WITH {REG_SQL}, " + ", ".join(ols_sql("reg", "y", xs, name="o_" + "".join(xs)) for xs in SUBSETS) + ", c AS (" + " UNION ALL ".join(
    f"SELECT '{'+'.join(xs)}' AS config, {len(xs)} AS complexity, round(sqrt(rss / n), 5) AS rmse FROM o_{''.join(xs)}" for xs in SUBSETS) + """)
SELECT config, complexity, rmse, NOT EXISTS (SELECT 1 FROM c d WHERE d.complexity <= c.complexity AND d.rmse <= c.rmse AND (d.complexity < c.complexity OR d.rmse < c.rmse)) AS optimal, round(-rmse - complexity, 4) AS score FROM c""")
def tune_pareto(t):
    m = collect_moments(t.reg, XS + ["y"])[None]
    rows = [("+".join(xs), len(xs), round(float(np.sqrt(solve(m, "y", xs).rss / m.n)), 5)) for xs in SUBSETS]
    d = t.spark.createDataFrame(rows, "config string, complexity int, rmse double")
    p = tn.pareto(d, "complexity", "rmse", "config")
    return p.select("config", "complexity", "rmse", "optimal", r(-col("rmse") - col("complexity"), 4).alias("score"))


@query("tune_finalize")
def tune_finalize(t):
    """Best penalty by cross-validation on the training rows, refit on all of them, error on the test rows."""
    train, d = split(t)
    grid = tn.grid_regular(penalty=tn.log_levels(0.01, 100, 5), mixture=[0.0, 1.0])
    cv = scored_grid(t, grid, rs.vfold(train, ["key"], 5))
    best = min(grid, key=lambda c: np.mean(list(cv[c["config"]].values())))
    p = md.predict(md.linear(train, "y", XS, best["penalty"], best["mixture"]), d.where(col("role") == "test"))
    return p.agg(r(mt.rmse("y", "pred"), 4).alias("rmse"), r(mt.rsq("y", "pred")).alias("rsq")).select(F.lit(best["config"]).alias("config"), "rmse", "rsq")
