"""Blends, votes, stacking and boosting by hand."""

import numpy as np

from larkframe.learning import metrics as mt
from larkframe.learning import models as md
from larkframe.learning import resample as rs
from larkframe.operators.hashing import hash_positions
from larkframe.operators.moments import collect_moments, fit_ols, solve
from larkframe.operators.quantiles import quantiles
from larkframe.plans.base import *
from larkframe.plans.features import split
from larkframe.plans.resampling import rank_sql
from larkframe.plans.sqltext import fitted_sql, ols_sql
from larkframe.plans.stats import three_models
from larkframe.session import materialized
from larkframe.tables import CLS_SCORED_SQL, REG_SQL, u_sql

XS = ["x1", "x2", "x3"]
PS = ["p1", "p2", "p3"]
BLEND_SQL = REG_SQL + """, bl AS (SELECT *, 12 + 2.1::double * x1 + 2.8::double * x2 + 0.5::double * x1 * x2 - x3 AS p1, 8 + 2.0::double * x1 + 3.2::double * x2 + 0.52::double * x1 * x2 AS p2,
-40 + 4.5::double * x1 + 15.6::double * x2 - x3 AS p3 FROM reg)"""


def blends(t) -> DataFrame:
    """Predictions of three fixed formulas."""
    x1, x2, x3 = col("x1"), col("x2"), col("x3")
    return t.reg.withColumns({"p1": 12 + 2.1 * x1 + 2.8 * x2 + 0.5 * x1 * x2 - x3, "p2": 8 + 2.0 * x1 + 3.2 * x2 + 0.52 * x1 * x2, "p3": -40 + 4.5 * x1 + 15.6 * x2 - x3})


AVG, WTD = "(p1 + p2 + p3) / 3", "0.2::double * p1 + 0.4::double * p2 + 0.4::double * p3"


def average() -> Column:
    return (col("p1") + col("p2") + col("p3")) / 3


def weighted() -> Column:
    return 0.2 * col("p1") + 0.4 * col("p2") + 0.4 * col("p3")


@query("ens_average", f"WITH {BLEND_SQL} SELECT key, round({AVG}, 5) AS pred FROM bl")
def ens_average(t):
    return blends(t).select("key", r(average(), 5).alias("pred"))


@query("ens_weighted", f"WITH {BLEND_SQL} SELECT key, round({WTD}, 5) AS pred FROM bl")
def ens_weighted(t):
    return blends(t).select("key", r(weighted(), 5).alias("pred"))


@query("ens_compare", f"WITH {BLEND_SQL} " + " UNION ALL ".join(f"SELECT '{n}' AS model, round(sqrt(avg((y - ({e})) ** 2)), 5) AS rmse FROM bl" for n, e in (("p1", "p1"), ("p2", "p2"), ("p3", "p3"), ("average", AVG), ("weighted", WTD))))
def ens_compare(t):
    d = blends(t).withColumns({"average": average(), "weighted": weighted()})
    names = PS + ["average", "weighted"]
    return d.agg(*[r(mt.rmse("y", n), 5).alias(n) for n in names]).unpivot([], names, "model", "rmse")


M_SQL = CLS_SCORED_SQL + ", m AS (SELECT doc_id, event, p, round(1 / (1 + exp(-(40 * f3 - 2))), 6) AS q, round(1 / (1 + exp(-(30 * f2 + 20 * f3 - 2.5))), 6) AS w FROM cls_scored)"


@query("ens_hard_vote", f"WITH {M_SQL} SELECT doc_id, ((p > 0.5)::int + (q > 0.5)::int + (w > 0.5)::int >= 2)::int AS vote FROM m")
def ens_hard_vote(t):
    votes = sum(((col(c) > 0.5).cast("int") for c in "qw"), (col("p") > 0.5).cast("int"))
    return three_models(t).select("doc_id", (votes >= 2).cast("int").alias("vote"))


@query("ens_soft_vote", f"WITH {M_SQL} SELECT doc_id, round((p + q + w) / 3, 6) AS mean_p, ((p + q + w) / 3 > 0.5)::int AS vote FROM m")
def ens_soft_vote(t):
    m = (col("p") + col("q") + col("w")) / 3
    return three_models(t).select("doc_id", r(m).alias("mean_p"), (m > 0.5).cast("int").alias("vote"))


ROLE3 = f"CASE WHEN {rank_sql('key', 'three')} <= floor(count(*) OVER () * 0.6) THEN 'train' WHEN {rank_sql('key', 'three')} <= floor(count(*) OVER () * 0.8) THEN 'validation' ELSE 'test' END AS role"


@query("ens_stack", f"""WITH {BLEND_SQL}, s AS (SELECT *, {ROLE3} FROM bl), tr AS (SELECT * FROM s WHERE role = 'train'), {ols_sql('tr', 'y', ['x1', 'x2'], name='oa')}, {ols_sql('tr', 'y', ['p2'], name='ob')},
f AS (SELECT s.role, s.y, {fitted_sql(['x1', 'x2'], 'oa.')} AS g1, {fitted_sql(['p2'], 'ob.')} AS g2 FROM s, oa, ob WHERE role <> 'train'), vd AS (SELECT * FROM f WHERE role = 'validation'), {ols_sql('vd', 'y', ['g1', 'g2'], name='om')}
SELECT round(sqrt(avg((y - g1) ** 2)), 4) AS rmse_1, round(sqrt(avg((y - g2) ** 2)), 4) AS rmse_2, round(sqrt(avg((y - {fitted_sql(['g1', 'g2'], 'om.')}) ** 2)), 4) AS rmse_stack FROM f, om WHERE role = 'test'""")
def ens_stack(t):
    """Base fits on training rows, a linear meta fit on their validation scores, errors on test rows."""
    d = materialized(rs.three_way(blends(t), ["key"], 0.6, 0.2))
    train = d.where(col("role") == "train")
    a, b = fit_ols(train, "y", ["x1", "x2"]), fit_ols(train, "y", ["p2"])
    s = d.withColumns({"s1": a.predict(), "s2": b.predict()})
    meta = fit_ols(s.where(col("role") == "validation"), "y", ["s1", "s2"])
    return s.where(col("role") == "test").agg(r(mt.rmse("y", "s1"), 4).alias("rmse_1"), r(mt.rmse("y", "s2"), 4).alias("rmse_2"), r(mt.rmse(col("y"), meta.predict()), 4).alias("rmse_stack"))


def simplex_weights(m, y: str, ps: list[str], steps: int = 20_000) -> np.ndarray:
    """Weights >= 0 with sum 1 of least squared error, by projected gradient on the k x k second-moment matrix."""
    ix, iy = [m.cols.index(p) for p in ps], m.cols.index(y)
    d = m.mean[iy] - m.mean[ix]
    # errors e_j = y - p_j: E[e e'] from the moments; with weights of sum 1 the blend error is w'e
    e = m.cov[iy, iy] - m.cov[iy, ix][:, None] - m.cov[iy, ix][None, :] + m.cov[np.ix_(ix, ix)] + np.outer(d, d)
    w = np.full(len(ps), 1 / len(ps))
    rate = 1 / (2 * np.linalg.eigvalsh(e).max())
    for _ in range(steps):
        v = w - rate * 2 * e @ w
        u = np.sort(v)[::-1]
        k = np.arange(1, len(u) + 1)
        rho = k[u + (1 - np.cumsum(u)) / k > 0][-1]
        new = np.maximum(v + (1 - u[:rho].sum()) / rho, 0)
        if np.abs(new - w).max() < 1e-13:
            return new
        w = new
    return w


@query("ens_weight_opt")
def ens_weight_opt(t):
    m = collect_moments(blends(t), PS + ["y"])[None]
    w = simplex_weights(m, "y", PS)
    blend = sum((F.lit(float(v)) * col(p) for v, p in zip(w[1:], PS[1:])), F.lit(float(w[0])) * col(PS[0]))
    e = one_row(blends(t), e=mt.rmse(col("y"), blend))["e"]
    return t.spark.createDataFrame([(p, round(float(v), 5), round(e, 5)) for p, v in zip(PS, w)], "model string, weight double, rmse double")


@query("ens_cascade")
def ens_cascade(t):
    """A second model for the rows that the first one gets most wrong."""
    d = materialized(t.reg.select("key", "y", *XS))
    f = fit_ols(d, "y", XS)
    e = d.withColumns({"first": f.predict(), "resid": col("y") - f.predict()}).withColumn("size", F.abs("resid"))
    cutoff = quantiles(e, [], "size", {"q": 0.75}).first()["q"]
    m = md.boosted(e.where(col("size") > cutoff), "resid", XS, rounds=5, depth=3, rate=0.3)
    s = md.predict(m, e, "extra").withColumn("both", F.when(col("size") > cutoff, col("first") + col("extra")).otherwise(col("first")))
    return s.agg(r(mt.rmse("y", "first"), 4).alias("rmse_first"), r(mt.rmse("y", "both"), 4).alias("rmse_both"), r(F.lit(cutoff), 4).alias("cutoff"))


@query("ens_region_select", f"""WITH {BLEND_SQL}, g AS (SELECT *, (x1 > 25)::int * 2 + (x2 > 5)::int AS region FROM bl), e AS (""" + " UNION ALL ".join(f"SELECT region, '{p}' AS model, sqrt(avg((y - {p}) ** 2)) AS rmse FROM g GROUP BY 1" for p in PS) + """),
b AS (SELECT region, arg_min(model, rmse) AS model FROM e GROUP BY 1) SELECT key, region, model, round(CASE model WHEN 'p1' THEN p1 WHEN 'p2' THEN p2 ELSE p3 END, 5) AS pred FROM g JOIN b USING (region)""")
def ens_region_select(t):
    """Per region the model with the smallest error there."""
    g = blends(t).withColumn("region", (col("x1") > 25).cast("int") * 2 + (col("x2") > 5).cast("int"))
    e = g.groupBy("region").agg(*[mt.rmse("y", p).alias(p) for p in PS]).unpivot(["region"], PS, "model", "rmse")
    best = e.groupBy("region").agg(F.min_by("model", "rmse").alias("model"))
    d = group_join(g, best, ["region"])
    pred = F.when(col("model") == "p1", col("p1")).when(col("model") == "p2", col("p2")).otherwise(col("p3"))
    return d.select("key", "region", "model", r(pred, 5).alias("pred"))


def _boost_sql(rounds: int, rate: float) -> str:
    ctes, prev = [], "b0 AS (SELECT key, x1, x2, x3, y, avg(y) OVER () AS f FROM reg)"
    ctes.append(prev)
    for i in range(rounds):
        x = XS[i % 3]
        ctes.append(f"c{i} AS (SELECT regr_slope(y - f, {x}) AS s, regr_intercept(y - f, {x}) AS a FROM b{i})")
        ctes.append(f"b{i + 1} AS (SELECT key, x1, x2, x3, y, f + {rate}::double * (a + s * {x}) AS f FROM b{i}, c{i})")
    return f"WITH {REG_SQL}, " + ", ".join(ctes) + " " + " UNION ALL ".join(f"SELECT {i} AS round, round(sqrt(avg((y - f) ** 2)), 4) AS rmse FROM b{i}" for i in range(rounds + 1))


@query("ens_boost_scratch", _boost_sql(6, 0.5))
def ens_boost_scratch(t):
    """Boosting with one-variable lines: each round fits the residual and adds half of the fit.

    Every residual is linear in the columns, so all rounds follow from one moment table; the errors of all rounds are
    one more aggregation.
    """
    m = collect_moments(t.reg, XS + ["y"])[None]
    iy = 3
    b0, b = float(m.mean[iy]), np.zeros(3)
    preds = [(b0, b.copy())]
    for i in range(6):
        j = i % 3
        slope = (m.cov[j, iy] - m.cov[j, :3] @ b) / m.cov[j, j]
        icept = (m.mean[iy] - b0 - b @ m.mean[:3]) - slope * m.mean[j]
        b0, b = b0 + 0.5 * float(icept), b.copy()
        b[j] += 0.5 * slope
        preds.append((b0, b))
    line = lambda p: sum((F.lit(float(v)) * col(x) for v, x in zip(p[1], XS)), F.lit(p[0]))
    names = [str(i) for i in range(7)]
    wide = t.reg.agg(*[r(mt.rmse(col("y"), line(p)), 4).alias(n) for n, p in zip(names, preds)])
    return wide.unpivot([], names, "round", "rmse").withColumn("round", col("round").cast("int"))


@query("ens_bootstrap_models", f"""WITH {REG_SQL}, p AS (SELECT *, {rank_sql('key', 'boot')} AS pos, count(*) OVER () AS n FROM reg), dr AS (SELECT rep, floor({u_sql('rep, pos', 'boot')} * n)::bigint + 1 AS pick FROM p, range(1, 6) x(rep)),
f AS (SELECT rep, regr_slope(y, x1) AS b, regr_intercept(y, x1) AS a FROM dr JOIN p ON pick = pos GROUP BY 1), s AS (SELECT key, y, avg(a + b * x1) AS mean_pred FROM reg, f GROUP BY 1, 2), e AS (SELECT rep, sqrt(avg((y - a - b * x1) ** 2)) AS rmse FROM reg, f GROUP BY 1)
SELECT round((SELECT sqrt(avg((y - mean_pred) ** 2)) FROM s), 4) AS rmse_of_mean, round((SELECT avg(rmse) FROM e), 4) AS mean_rmse, (SELECT count(*) FROM e) AS models""")
def ens_bootstrap_models(t):
    d = materialized(t.reg.select("key", "x1", "y"))
    x, y = col("x1"), col("y")
    # a drawn key stands for all rows that have it; the sums over these lie beside every row, so that keys are not joined
    alike = {"n": F.count(F.lit(1)), "sx": F.sum(x), "sy": F.sum(y), "sxx": F.sum(x * x), "sxy": F.sum(x * y)}
    placed = hash_positions(d, ["key"], "boot", None, "_pos", "_n", alike=alike).where(col("key").isNotNull()).select("_pos", *alike)
    b = rs.drawn(t.spark, d.count(), 5).join(placed, "_pos").select(F.posexplode("draws").alias("rep", "w"), *alike).where("w > 0")
    s = b.groupBy("rep").agg(*[F.sum(col("w") * col(c)).alias(c) for c in alike]).collect()  # one row per replicate
    fits = []
    for v in s:
        slope = (v["sxy"] - v["sx"] * v["sy"] / v["n"]) / (v["sxx"] - v["sx"] ** 2 / v["n"])
        fits.append((v["sy"] / v["n"] - slope * v["sx"] / v["n"], slope))
    lines = [F.lit(a) + F.lit(c) * x for a, c in fits]
    mean = sum(lines[1:], lines[0]) / len(lines)
    errs = [mt.rmse(y, p) for p in lines]
    return d.agg(r(mt.rmse(y, mean), 4).alias("rmse_of_mean"), r(sum(errs[1:], errs[0]) / len(errs), 4).alias("mean_rmse"), F.max(F.lit(len(lines)).cast("long")).alias("models"))


def sweep_fits(t, name: str, fits: dict) -> DataFrame:
    train, d = split(t)
    out = None
    for value, fit in fits.items():
        e = md.predict(fit(train), d).groupBy("role").agg(r(mt.rmse("y", "pred"), 4).alias("rmse")).select(F.lit(value).alias(name), "role", "rmse")
        out = e if out is None else out.unionByName(e)
    return out


@query("ens_lr_sweep")
def ens_lr_sweep(t):
    return sweep_fits(t, "rate", {v: (lambda tr, v=v: md.boosted(tr, "y", XS, rounds=5, depth=3, rate=v)) for v in (0.05, 0.3, 0.8)})


@query("ens_mtry_sweep")
def ens_mtry_sweep(t):
    return sweep_fits(t, "mtry", {v: (lambda tr, v=v: md.forest_reg(tr, "y", XS, trees=8, depth=5, mtry=v)) for v in ("1", "2", "all")})


@query("ens_diverse_vs_similar", f"""WITH {M_SQL}, a AS (SELECT event, ((p + w) / 2 > 0.5)::int AS "similar", ((p + q) / 2 > 0.5)::int AS diverse FROM m) SELECT round(avg(("similar" = event)::int), 6) AS "similar", round(avg((diverse = event)::int), 6) AS diverse FROM a""")
def ens_diverse_vs_similar(t):
    pair = lambda b: (((col("p") + col(b)) / 2 > 0.5).cast("int") == col("event")).cast("double")
    return three_models(t).agg(r(F.avg(pair("w"))).alias("similar"), r(F.avg(pair("q"))).alias("diverse"))
