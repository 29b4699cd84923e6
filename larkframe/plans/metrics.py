"""Metrics over the scored tables."""

from larkframe.learning import metrics as mt
from larkframe.operators.moments import collect_moments, solve
from larkframe.operators.verbs import cut
from larkframe.plans.base import *
from larkframe.plans.resampling import rank_sql, cnt_sql
from larkframe.plans.sqltext import fitted_sql, ols_sql
from larkframe.tables import CLS_SCORED_SQL, MULTI_SQL, REG_SQL, SCORED_SQL

Y, P = "y", "pred"


@query("met_rmse_mae_rsq", f"WITH {SCORED_SQL} SELECT round(sqrt(avg((y - pred) ** 2)), 6) AS rmse, round(avg(abs(y - pred)), 6) AS mae, round(corr(y, pred) ** 2, 6) AS rsq FROM scored")
def met_rmse_mae_rsq(t):
    return t.scored.agg(r(mt.rmse(Y, P)).alias("rmse"), r(mt.mae(Y, P)).alias("mae"), r(mt.rsq(Y, P)).alias("rsq"))


@query("met_mape", f"WITH {SCORED_SQL} SELECT round(avg(abs((y - pred) / y)) * 100, 4) AS mape FROM scored")
def met_mape(t):
    return t.scored.agg(r(mt.mape(Y, P), 4).alias("mape"))


@query("met_ccc", f"WITH {SCORED_SQL} SELECT round(2 * covar_pop(y, pred) / (var_pop(y) + var_pop(pred) + (avg(y) - avg(pred)) ** 2), 6) AS ccc FROM scored")
def met_ccc(t):
    return t.scored.agg(r(mt.ccc(Y, P)).alias("ccc"))


@query("met_custom_capped_mape", f"WITH {SCORED_SQL} SELECT round(avg(least(abs((y - pred) / y), 0.2::double)), 6) AS capped, round(avg(abs((y - pred) / y)), 5) AS plain FROM scored")
def met_custom_capped_mape(t):
    return t.scored.agg(r(mt.capped_mape(Y, P)).alias("capped"), r(mt.mape(Y, P) / 100, 5).alias("plain"))


@query("met_asymmetric", f"WITH {SCORED_SQL} SELECT round(sqrt(avg(CASE WHEN y > pred THEN 2 * (y - pred) ** 2 ELSE (y - pred) ** 2 END)), 6) AS loss FROM scored")
def met_asymmetric(t):
    return t.scored.agg(r(mt.asymmetric(Y, P)).alias("loss"))


# The multipliers 2, 0.5 and 3 and the border at -5 must match.
@query("met_business", f"""WITH {SCORED_SQL}, e AS (SELECT (pred - y) / y * 100 AS pct FROM scored)
SELECT CASE WHEN pct > 0 THEN 'over' WHEN pct > -5 THEN 'small under' ELSE 'large under' END AS category, count(*) AS n,
round(avg(CASE WHEN pct > 0 THEN abs(pct) * 2 WHEN pct > -5 THEN abs(pct) * 0.5::double ELSE abs(pct) * 3 END), 3) AS penalty FROM e GROUP BY 1""")
def met_business(t):
    e = t.scored.select((F.try_divide(col(P) - col(Y), col(Y)) * 100).alias("pct"))
    pct = col("pct")
    penalty = F.when(pct > 0, F.abs(pct) * 2).when(pct > -5, F.abs(pct) * 0.5).otherwise(F.abs(pct) * 3)
    kind = F.when(pct > 0, "over").when(pct > -5, "small under").otherwise("large under")
    return e.groupBy(kind.alias("category")).agg(F.count(F.lit(1)).alias("n"), r(F.avg(penalty), 3).alias("penalty"))


CM = "tp::double AS tp, fp::double AS fp, fn::double AS fn, tn::double AS tn"
COUNTS = "count(*) FILTER (event = 1 AND pred = 1) AS tp, count(*) FILTER (event = 0 AND pred = 1) AS fp, count(*) FILTER (event = 1 AND pred = 0) AS fn, count(*) FILTER (event = 0 AND pred = 0) AS tn"
RATES = "round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall, round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f_meas"


@query("met_accuracy", f"WITH {CLS_SCORED_SQL}, c AS (SELECT {COUNTS} FROM cls_scored) SELECT {RATES} FROM c")
def met_accuracy(t):
    q = mt.rates(mt.confusion("event", "pred"))
    return t.cls_scored.agg(*[r(q[k]).alias(k) for k in ("accuracy", "precision", "recall", "f_meas")])


@query("met_specificity", f"WITH {CLS_SCORED_SQL} SELECT round(count(*) FILTER (event = 0 AND pred = 0) / count(*) FILTER (event = 0), 6) AS specificity FROM cls_scored")
def met_specificity(t):
    return t.cls_scored.agg(r(mt.rates(mt.confusion("event", "pred"))["specificity"]).alias("specificity"))


@query("met_conf_mat", f"WITH {CLS_SCORED_SQL} SELECT pred, count(*) FILTER (event = 1) AS truth_1, count(*) FILTER (event = 0) AS truth_0 FROM (SELECT pred, event FROM cls_scored UNION ALL SELECT unnest([0, 1]), NULL) GROUP BY 1")
def met_conf_mat(t):
    """All pairs of levels are shown, also those that do not occur."""
    levels = t.spark.createDataFrame([(0,), (1,)], "pred int")
    c = t.cls_scored.groupBy("pred").pivot("event", [1, 0]).count()
    return levels.join(c, "pred", "left").fillna(0).toDF("pred", "truth_1", "truth_0")


CURVE_SQL = CLS_SCORED_SQL + """,
g AS (SELECT p, count(*) AS n, sum(event) AS e FROM cls_scored GROUP BY 1),
cv AS (SELECT p, n, e, sum(n) OVER w AS cum, sum(e) OVER w AS cum_e, sum(n) OVER () AS n_all, sum(e) OVER () AS e_all FROM g WINDOW w AS (ORDER BY p DESC))"""


def label_curve(t) -> DataFrame:
    return mt.curve(t.cls_scored, [], "p", "event")


@query("met_roc_curve", f"WITH {CURVE_SQL} SELECT p AS threshold, round(cum_e / e_all, 6) AS sensitivity, round(1 - (cum - cum_e) / (n_all - e_all), 6) AS specificity FROM cv")
def met_roc_curve(t):
    d = mt.roc_points(label_curve(t), [])
    return d.select("threshold", r(col("sensitivity")).alias("sensitivity"), r(col("specificity")).alias("specificity"))


@query("met_roc_auc", f"""WITH {CLS_SCORED_SQL}, k AS (SELECT event, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2 AS rk FROM cls_scored)
SELECT round((sum(rk) FILTER (event = 1) - sum(event) * (sum(event) + 1) / 2) / (sum(event) * (count(*) - sum(event))), 6) AS auc FROM k""")
def met_roc_auc(t):
    return mt.roc_auc(label_curve(t), []).select(r(col("auc")).alias("auc"))


SOFT_SQL = MULTI_SQL + """,
sm AS (SELECT vec_id, cls, round(exp(4 * e1) / (exp(4 * e1) + exp(4 * e2) + exp(4 * e3)), 6) AS s1, round(exp(4 * e2) / (exp(4 * e1) + exp(4 * e2) + exp(4 * e3)), 6) AS s2,
round(exp(4 * e3) / (exp(4 * e1) + exp(4 * e2) + exp(4 * e3)), 6) AS s3 FROM multi)"""


def softmax(t) -> DataFrame:
    ex = {i: F.exp(4 * col(f"e{i}")) for i in (1, 2, 3)}
    total = ex[1] + ex[2] + ex[3]
    return t.multi.select("vec_id", "cls", *[F.round(ex[i] / total, 6).alias(f"s{i}") for i in (1, 2, 3)])


@query("met_roc_auc_multi", f"WITH {SOFT_SQL}, pr AS (" + " UNION ALL ".join(f"SELECT '{c}|{d}' AS pair, s{c} AS s, (cls = {c})::int AS e FROM sm WHERE cls IN ({c}, {d})" for c in (1, 2, 3) for d in (1, 2, 3) if c != d) + """),
k AS (SELECT pair, e, rank() OVER (PARTITION BY pair ORDER BY s) + (count(*) OVER (PARTITION BY pair, s) - 1) / 2 AS rk FROM pr),
a AS (SELECT pair, (sum(rk) FILTER (e = 1) - sum(e) * (sum(e) + 1) / 2) / (sum(e) * (count(*) - sum(e))) AS auc FROM k GROUP BY 1) SELECT round(avg(auc), 6) AS auc, count(*) AS pairs FROM a""")
def met_roc_auc_multi(t):
    a = mt.hand_till(softmax(t), "cls", {1: "s1", 2: "s2", 3: "s3"}, "vec_id")
    return a.agg(r(F.avg("auc")).alias("auc"), F.count(F.lit(1)).alias("pairs"))


@query("met_pr_auc", f"""WITH {CURVE_SQL}, l AS (SELECT cum_e / e_all AS rc, cum_e / cum AS pc, coalesce(lag(cum_e / e_all) OVER (ORDER BY p DESC), 0) AS r0, coalesce(lag(cum_e / cum) OVER (ORDER BY p DESC), 1) AS p0 FROM cv)
SELECT round(sum((rc - r0) * (pc + p0) / 2), 6) AS pr_auc FROM l""")
def met_pr_auc(t):
    return mt.pr_auc(label_curve(t), []).select(r(col("pr_auc")).alias("pr_auc"))


BIN_SQL = "CASE WHEN p <= 0.1 THEN 0 " + " ".join(f"WHEN p <= {i / 10 + 0.1:.1f} THEN {i}" for i in range(1, 10)) + " END"


@query("met_calibration", f"WITH {CLS_SCORED_SQL} SELECT {BIN_SQL} AS bin, round(avg(p), 6) AS mean_predicted, round(avg(event), 6) AS observed, count(*) AS n FROM cls_scored GROUP BY 1 HAVING count(*) > 5")
def met_calibration(t):
    bins = cut(col("p"), [round(i / 10, 1) for i in range(11)], list(range(10)), include_lowest=True)
    g = t.cls_scored.groupBy(bins.alias("bin")).agg(r(F.avg("p")).alias("mean_predicted"), r(F.avg("event")).alias("observed"), F.count(F.lit(1)).alias("n"))
    return g.where(col("n") > 5)


def swept(df: DataFrame, thresholds: list[float]) -> DataFrame:
    """Counts at each of a fixed list of thresholds: rows collapse to distinct scores before they are repeated."""
    g = df.groupBy("p", "event").agg(F.count(F.lit(1)).alias("k"))
    g = g.withColumn("threshold", F.explode(F.array(*[F.lit(x) for x in thresholds]))).withColumn("hit", (col("p") > col("threshold")).cast("int"))
    n = lambda e, h: F.coalesce(F.sum(F.when((col("event") == e) & (col("hit") == h), col("k"))), F.lit(0))
    return g.groupBy("threshold").agg(n(1, 1).alias("tp"), n(0, 1).alias("fp"), n(1, 0).alias("fn"), n(0, 0).alias("tn"))


def th_sql(lo, n, step):
    return f"(SELECT round({lo} + {step} * i, 2)::double AS threshold FROM range({n}) x(i)) th"


SWEEP = "count(*) FILTER (event = 1 AND p > threshold) AS tp, count(*) FILTER (event = 0 AND p > threshold) AS fp, count(*) FILTER (event = 1 AND p <= threshold) AS fn, count(*) FILTER (event = 0 AND p <= threshold) AS tn"


@query("met_threshold_sweep", f"WITH {CLS_SCORED_SQL}, c AS (SELECT threshold, {SWEEP} FROM cls_scored, {th_sql(0.1, 9, 0.1)} GROUP BY 1) SELECT threshold, {RATES} FROM c")
def met_threshold_sweep(t):
    d = swept(t.cls_scored, [round(i / 10, 2) for i in range(1, 10)])
    q = mt.rates({k: col(k) for k in ("tp", "fp", "fn", "tn")})
    return d.select("threshold", *[r(q[k]).alias(k) for k in ("accuracy", "precision", "recall", "f_meas")])


@query("met_cost_threshold", f"WITH {CLS_SCORED_SQL}, c AS (SELECT threshold, {SWEEP} FROM cls_scored, {th_sql(0.1, 81, 0.01)} GROUP BY 1) SELECT threshold, fp + 5 * fn AS cost, {RATES} FROM c ORDER BY cost, threshold LIMIT 1")
def met_cost_threshold(t):
    d = swept(t.cls_scored, [round(0.1 + i / 100, 2) for i in range(81)])
    q = mt.rates({k: col(k) for k in ("tp", "fp", "fn", "tn")})
    cost = (col("fp") + 5 * col("fn")).alias("cost")
    return d.select("threshold", cost, *[r(q[k]).alias(k) for k in ("accuracy", "precision", "recall", "f_meas")]).orderBy("cost", "threshold").limit(1)


DEG = [["x1"], ["x1", "x1_2"], ["x1", "x1_2", "x1_3"]]


@query("met_overfit_gap", f"""WITH {REG_SQL}, s AS (SELECT key, y, x1 / 50 AS x1, (x1 / 50) ** 2 AS x1_2, (x1 / 50) ** 3 AS x1_3, CASE WHEN {rank_sql('key', 'split')} <= floor({cnt_sql()} * 0.75) THEN 'train' ELSE 'test' END AS role FROM reg),
tr AS (SELECT * FROM s WHERE role = 'train'), """ + ", ".join(ols_sql("tr", "y", xs, name=f"d{i + 1}") for i, xs in enumerate(DEG)) + " " + " UNION ALL ".join(
    f"SELECT {i + 1} AS degree, role, round(sqrt(avg((y - {fitted_sql(xs, f'd{i + 1}.')}) ** 2)), 5) AS rmse FROM s, d{i + 1} GROUP BY role" for i, xs in enumerate(DEG)))
def met_overfit_gap(t):
    """Error on both sets by degree: one moment pass fits all degrees, one pass scores them."""
    from larkframe.learning.resample import initial_split

    x = col("x1") / 50
    d = t.reg.select("key", "y", x.alias("x1"), F.pow(x, F.lit(2)).alias("x1_2"), F.pow(x, F.lit(3)).alias("x1_3"))
    s = initial_split(d, ["key"])
    m = collect_moments(s.where(col("role") == "train"), DEG[-1] + ["y"])[None]
    fits = [solve(m, "y", xs) for xs in DEG]
    wide = s.groupBy("role").agg(*[r(mt.rmse(col("y"), f.predict()), 5).alias(str(i)) for i, f in enumerate(fits, 1)])
    return wide.unpivot(["role"], ["1", "2", "3"], "degree", "rmse").withColumn("degree", col("degree").cast("int"))


@query("met_pred_error_bins", f"""WITH {SCORED_SQL} SELECT key, round(pred - y, 4) AS error, round((pred - y) / y * 100, 4) AS pct FROM scored""")
def met_pred_error_bins(t):
    return t.scored.select("key", r(col(P) - col(Y), 4).alias("error"), r(F.try_divide(col(P) - col(Y), col(Y)) * 100, 4).alias("pct"))
