"""Bootstrap, tests of hypotheses, and regression diagnostics."""

import math

import numpy as np

from larkframe.functions import tails
from larkframe.operators import hypothesis as hy
from larkframe.operators.hashing import digest
from larkframe.operators.moments import collect_moments, fit_ols, inflation, solve
from larkframe.operators.ordering import positions
from larkframe.operators.quantiles import quantiles
from larkframe.plans.aggregates import guarded_corr
from larkframe.plans.base import *
from larkframe.plans.sqltext import *
from larkframe.tables import CLS_SCORED_SQL, REG_SQL, SCORED_SQL

REPS = 40
STEPS = 9  # Poisson(1) counts above 9 have probability 1e-7 and are folded into 9


def _cum() -> list[float]:
    out, p, c = [], math.exp(-1), 0.0
    for k in range(STEPS):
        c += p
        out.append(c)
        p /= k + 1
    return out


def with_weights(df: DataFrame, key: str, reps: int) -> DataFrame:
    """Each row with its Poisson(1) count ``w`` in replicates 0..reps-1; one digest serves two replicates, 52 bits each."""
    digests = F.array(*[digest([key], f"boot{b}") for b in range(-(-reps // 2))])
    d = df.select("*", F.posexplode(digests).alias("_b", "_h")).withColumn("_k", F.explode(F.array(F.lit(0), F.lit(1))))
    u = F.conv(F.substring(col("_h"), 1 + 16 * col("_k"), F.lit(13)), 16, 10).cast("long") / F.lit(float(2**52))
    d = d.withColumn("_u", u)
    w = None
    for k, c in enumerate(_cum()):
        w = F.when(col("_u") < c, k) if w is None else w.when(col("_u") < c, k)
    return d.withColumn("w", w.otherwise(STEPS)).withColumn("rep", col("_b") * 2 + col("_k")).where(col("rep") < reps).drop("_b", "_h", "_k", "_u")


def weight_sql(key: str, rep: str = "rep") -> str:
    u = f"(('0x' || substr(md5(concat_ws('-', {key}, 'boot' || ({rep} // 2))), 1 + 16 * ({rep} % 2)::int, 13))::bigint / 4503599627370496::double)"
    return "(" + " + ".join(f"({u} >= {c!r}::double)::int" for c in _cum()) + ")"


@query("stat_bootstrap_mean", f"""WITH m AS (SELECT rep, sum(w * value) / sum(w) AS m FROM (SELECT value, rep, {weight_sql('event_id')} AS w FROM events, range({REPS}) x(rep)) GROUP BY 1)
SELECT round(avg(m), 6) AS mean, round(stddev_samp(m), 6) AS se, round(quantile_cont(m, 0.025), 6) AS lo, round(quantile_cont(m, 0.975), 6) AS hi, count(*) AS reps FROM m""")
def stat_bootstrap_mean(t):
    """Poisson bootstrap: replicates are weighted means, combined map-side into one row per replicate."""
    d = with_weights(t.events.select("event_id", "value"), "event_id", REPS)
    m = d.groupBy("rep").agg((F.sum(col("w") * col("value")) / F.sum("w")).alias("m"))
    return m.agg(r(F.avg("m")).alias("mean"), r(F.stddev_samp("m")).alias("se"), r(F.percentile("m", F.lit(0.025))).alias("lo"),
                 r(F.percentile("m", F.lit(0.975))).alias("hi"), F.count(F.lit(1)).alias("reps"))  # 40 replicate rows


MULTI_REPS = 12


@query("stat_bootstrap_multi", f"""WITH w AS (SELECT value, rep, {weight_sql('event_id')} AS w FROM events, range({MULTI_REPS}) x(rep)),
c AS (SELECT rep, value FROM w, range(9) k(i) WHERE i < w),
s AS (SELECT rep, avg(value) AS mean, median(value) AS median, stddev_samp(value) AS sd, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr FROM c GROUP BY 1),
l AS (UNPIVOT s ON mean, median, sd, iqr INTO NAME stat VALUE v)
SELECT stat, round(avg(v), 6) AS est, round(quantile_cont(v, 0.025), 6) AS lo, round(quantile_cont(v, 0.975), 6) AS hi FROM l GROUP BY 1""")
def stat_bootstrap_multi(t):
    d = with_weights(t.events.select("event_id", "value"), "event_id", MULTI_REPS).where(col("w") > 0)
    d = d.groupBy("rep", "value").agg(F.sum("w").alias("w"))  # equal values collapse before the order statistics
    q = quantiles(d, ["rep"], "value", {"q1": 0.25, "median": 0.5, "q3": 0.75}, weight=col("w"))
    n, s1, s2 = F.sum("w"), F.sum(col("w") * col("value")), F.sum(col("w") * col("value") * col("value"))
    m = d.groupBy("rep").agg((s1 / n).alias("mean"), F.sqrt((s2 - s1 * s1 / n) / (n - 1)).alias("sd"))
    s = q.join(m, "rep").withColumn("iqr", col("q3") - col("q1"))
    return s.unpivot(["rep"], ["mean", "median", "sd", "iqr"], "stat", "v").groupBy("stat").agg(
        r(F.avg("v")).alias("est"), r(F.percentile("v", F.lit(0.025))).alias("lo"), r(F.percentile("v", F.lit(0.975))).alias("hi"))


def welch_sql(src: str, value: str, a: str, b: str) -> str:
    return f"""w0 AS (SELECT count(*) FILTER ({a}) AS n1, avg({value}) FILTER ({a}) AS m1, var_samp({value}) FILTER ({a}) AS v1,
count(*) FILTER ({b}) AS n2, avg({value}) FILTER ({b}) AS m2, var_samp({value}) FILTER ({b}) AS v2 FROM {src}),
w1 AS (SELECT *, sqrt(v1 / n1 + v2 / n2) AS se, pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)) AS df FROM w0),
welch AS (SELECT *, (m1 - m2) / se AS t FROM w1)"""


Z = 1.959963984540054


@query("stat_ttest", f"""WITH {welch_sql('events', 'value', "event_type = 'click'", "event_type = 'view'")}
SELECT n1, n2, round(m1, 6) AS m1, round(m2, 6) AS m2, round(t, 6) AS t, round(df, 4) AS df, round({t_p_sql('t', 'df')}, 6) AS p, round(m1 - m2 - {t_quantile_sql(Z, 'df')} * se, 5) AS lo, round(m1 - m2 + {t_quantile_sql(Z, 'df')} * se, 5) AS hi FROM welch""")
def stat_ttest(t):
    d = hy.welch(t.events, "value", col("event_type") == "click", col("event_type") == "view")
    return d.select("n1", "n2", r(col("m1")).alias("m1"), r(col("m2")).alias("m2"), r(col("t")).alias("t"), r(col("df"), 4).alias("df"), r(col("p")).alias("p"),
                    r(col("lo"), 5).alias("lo"), r(col("hi"), 5).alias("hi"))


def anova_sql(src: str, cols: list[str], group: str) -> str:
    one = lambda c: f"""SELECT '{c}' AS measure, count(*) - 1 AS df1, sum(n) - count(*) AS df2, sum(n * (m - t) * (m - t)) AS ssb, sum(n * v) AS ssw FROM
(SELECT {group}, count(*) AS n, avg({c}) AS m, var_pop({c}) AS v FROM {src} GROUP BY 1), (SELECT avg({c}) AS t FROM {src})"""
    return "an0 AS (" + "\nUNION ALL ".join(one(c) for c in cols) + "), an AS (SELECT measure, df1::bigint AS df1, df2::bigint AS df2, ssb, ssw, (ssb / df1) / (ssw / df2) AS f FROM an0)"


@query("stat_anova", f"""WITH o AS (SELECT o_orderpriority, o_totalprice AS price, o_totalprice + CASE WHEN o_orderpriority = '5-LOW' THEN 9000 ELSE 0 END AS shifted FROM orders), {anova_sql('o', ['price', 'shifted'], 'o_orderpriority')}
SELECT measure, df1, df2, round(f, 5) AS f, round({f_p_sql('f', 'df1', 'df2')}, 6) AS p, CASE WHEN {f_p_sql('f', 'df1', 'df2')} < 0.001 THEN 'High' WHEN {f_p_sql('f', 'df1', 'df2')} < 0.05 THEN 'Medium' ELSE 'Low' END AS importance FROM an""")
def stat_anova(t):
    d = t.orders.select("o_orderpriority", col("o_totalprice").alias("price"), (col("o_totalprice") + F.when(col("o_orderpriority") == "5-LOW", 9000).otherwise(0)).alias("shifted"))
    return importance(hy.anova(d, ["price", "shifted"], "o_orderpriority"))


def importance(d: DataFrame) -> DataFrame:
    level = F.when(col("p") < 0.001, "High").when(col("p") < 0.05, "Medium").otherwise("Low")
    return d.select("measure", "df1", "df2", r(col("f"), 5).alias("f"), r(col("p")).alias("p"), level.alias("importance"))


HALVES_SQL = """med AS (SELECT median(date_diff('day', DATE '1970-01-01', o_orderdate::date)) AS m FROM orders),
hv AS (SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus, o_orderdate, (date_diff('day', DATE '1970-01-01', o_orderdate::date) >= m) AS late,
CASE WHEN date_diff('day', DATE '1970-01-01', o_orderdate::date) >= m THEN o_totalprice * 1.2::double ELSE o_totalprice END AS price, o_custkey::double AS cust FROM orders, med)"""


def halves(t) -> DataFrame:
    """Early and late orders; late totals are raised by a fifth."""
    d = t.orders.withColumn("day", F.unix_date(F.to_date("o_orderdate")))
    m = quantiles(d, [], "day", {"m": 0.5}).first()["m"]
    return d.withColumn("late", col("day") >= m).withColumn("price", F.when(col("late"), col("o_totalprice") * 1.2).otherwise(col("o_totalprice"))).withColumn(
        "cust", col("o_custkey").cast("double"))


def ks_sql(src: str, c: str, late: str) -> str:
    return f"""SELECT '{c}' AS measure, max(abs(ca / na - cb / nb)) AS d, max(na)::bigint AS na, max(nb)::bigint AS nb FROM (SELECT sum((NOT {late})::int) OVER (ORDER BY {c})::double AS ca, sum({late}::int) OVER (ORDER BY {c})::double AS cb,
count(*) FILTER (NOT {late}) OVER () AS na, count(*) FILTER ({late}) OVER () AS nb FROM {src})"""


@query("stat_ks", f"WITH {HALVES_SQL}, k AS ({ks_sql('hv', 'price', 'late')} UNION ALL {ks_sql('hv', 'cust', 'late')}) SELECT measure, na, nb, round(d, 6) AS d, round({ks_p_sql('d', 'na', 'nb')}, 6) AS p FROM k")
def stat_ks(t):
    return hy.ks(halves(t), ["price", "cust"], col("late")).select("measure", "na", "nb", r(col("d")).alias("d"), r(col("p")).alias("p"))


def chisq_sql(src: str, a: str, b: str) -> str:
    return f"""SELECT sum(n) AS n, sum(n) * (sum(n * n / (ra * cb)::double) - 1) AS x2, (count(DISTINCT {a}) - 1) * (count(DISTINCT {b}) - 1) AS df FROM
(SELECT {a}, {b}, n, sum(n) OVER (PARTITION BY {a}) AS ra, sum(n) OVER (PARTITION BY {b}) AS cb FROM (SELECT {a}, {b}, count(*) AS n FROM {src} GROUP BY 1, 2))"""


@query("stat_chisq", f"WITH {HALVES_SQL}, x AS ({chisq_sql('hv', 'late', 'o_orderpriority')}) SELECT n::bigint AS n, round(x2, 6) AS x2, df, round({chisq_p_sql('x2', 'df')}, 6) AS p FROM x")
def stat_chisq(t):
    return hy.chisq(halves(t), "late", "o_orderpriority").select("n", r(col("x2")).alias("x2"), "df", r(col("p")).alias("p"))


XS = ["x1", "x2", "x3"]
X4 = "x4 AS (SELECT *, x1 + 2 * x2 AS mix FROM reg)"


@query("stat_vif", f"""WITH {REG_SQL}, d AS (SELECT x1, x2, x3, x1 + x2 + x3 * x3 AS mix FROM reg), """ + ",\n".join(
    ols_sql("d", x, [o for o in ("x1", "x2", "x3", "mix") if o != x], name=f"o_{x}") for x in ("x1", "x2", "x3", "mix")) + " " + " UNION ALL ".join(
    f"SELECT '{x}' AS term, round(tss / rss, 6) AS vif FROM o_{x}" for x in ("x1", "x2", "x3", "mix")))
def stat_vif(t):
    """Diagonal of the inverse correlation matrix; the matrix is one k x k row set from one pass. Exact dependencies give null."""
    xs = ["x1", "x2", "x3", "mix"]
    d = t.reg.withColumn("mix", col("x1") + col("x2") + col("x3") * col("x3"))
    vif = inflation(collect_moments(d, xs)[None])
    return t.spark.createDataFrame([(x, None if v is None else round(v, 6)) for x, v in zip(xs, vif)], "term string, vif double")


def glance(f) -> tuple:
    """r2, adjusted r2, AIC, BIC, sigma of a fit (Gaussian likelihood; the error variance counts as a parameter)."""
    k = f.rank
    ll = -f.n / 2 * (math.log(2 * math.pi) + math.log(f.rss / f.n) + 1)
    adj = 1 - (1 - f.r2) * (f.n - 1) / (f.n - k - 1)
    return f.r2, adj, -2 * ll + 2 * (k + 2), -2 * ll + math.log(f.n) * (k + 2), math.sqrt(f.sigma2)


def glance_sql(name: str, k: int) -> str:
    ll = f"(-n / 2.0::double * (ln(2 * pi()) + ln(rss / n) + 1))"
    return (f"round(1 - rss / tss, 6) AS r2, round(1 - (rss / tss) * (n - 1) / (n - {k + 1}), 6) AS adj, round(-2 * {ll} + {2 * (k + 2)}, 2) AS aic, "
            f"round(-2 * {ll} + ln(n) * {k + 2}, 2) AS bic, round(sqrt(s2), 5) AS sigma FROM {name}")


def glance_row(f, digits=(6, 6, 2, 2, 5)) -> list:
    return [round(float(v), d) for v, d in zip(glance(f), digits)]


GL = "r2 double, adj double, aic double, bic double, sigma double"


@query("stat_lm_glance", f"WITH {REG_SQL}, {ols_sql('reg', 'y', XS)} SELECT n, {glance_sql('ols', 3)}")
def stat_lm_glance(t):
    f = fit_ols(t.reg, "y", XS)
    return t.spark.createDataFrame([[f.n] + glance_row(f)], "n long, " + GL)


@query("stat_formula_compare", f"WITH {REG_SQL}, r2x AS (SELECT *, x1 * x2 AS x12 FROM reg), " + ", ".join(ols_sql("r2x", "y", xs, name=f"o{i}") for i, xs in enumerate([["x1"], ["x1", "x2"], XS, XS + ["x12"]])) + " " + " UNION ALL ".join(
    f"SELECT '{m}' AS model, {glance_sql(f'o{i}', k)}" for i, (m, k) in enumerate([("x1", 1), ("x1+x2", 2), ("x1+x2+x3", 3), ("x1+x2+x3+x12", 4)])))
def stat_formula_compare(t):
    """Nested models from one moment table: one pass over the rows serves every formula."""
    cols = XS + ["x12", "y"]
    m = collect_moments(t.reg.withColumn("x12", col("x1") * col("x2")), cols)[None]
    rows = [["+".join(cols[:k])] + glance_row(solve(m, "y", cols[:k])) for k in (1, 2, 3, 4)]
    return t.spark.createDataFrame(rows, "model string, " + GL)


@query("stat_residuals", f"WITH {REG_SQL}, {ols_sql('reg', 'y', XS)}, e AS (SELECT key, y - {fitted_sql(XS, 'ols.')} AS e FROM reg, ols) SELECT key, round(e, 4) AS resid, round(e / (SELECT stddev_samp(e) FROM e), 4) AS std, round(abs(e), 4) AS size FROM e")
def stat_residuals(t):
    f = fit_ols(t.reg, "y", XS)
    sd = math.sqrt(f.rss / (f.n - 1))  # residuals of a least-squares fit have mean zero
    e = col("y") - f.predict()
    return t.reg.select("key", r(e, 4).alias("resid"), r(e / sd, 4).alias("std"), r(F.abs(e), 4).alias("size"))


@query("stat_leverage", f"""WITH {REG_SQL}, {ols_sql('reg', 'y', XS)}, e AS (SELECT key, y - {fitted_sql(XS, 'ols.')} AS e, {leverage_sql(XS, 'ols.')} AS h, s2 FROM reg, ols)
SELECT key, round(h * 1000, 6) AS lev, round(e / sqrt(s2 * (1 - h)), 4) AS std, round(e * e / (4 * s2) * h / ((1 - h) * (1 - h)) * 1000, 5) AS cook FROM e""")
def stat_leverage(t):
    f = fit_ols(t.reg, "y", XS)
    d = t.reg.select("key", (col("y") - f.predict()).alias("e"), f.leverage().alias("h"))
    e, h, s2 = col("e"), col("h"), f.sigma2
    return d.select("key", r(h * 1000).alias("lev"), r(e / F.sqrt(s2 * (1 - h)), 4).alias("std"), r(e * e / (4 * s2) * h / ((1 - h) * (1 - h)) * 1000, 5).alias("cook"))


@query("stat_qq", f"""WITH {SCORED_SQL}, e AS (SELECT key, y - pred AS e FROM scored), p AS (SELECT key, e, row_number() OVER (ORDER BY e, key) AS i, count(*) OVER () AS n FROM e),
q AS (SELECT key, e, (i - 0.5::double) / n AS pr FROM p) SELECT key, round((e - (SELECT avg(e) FROM e)) / (SELECT stddev_samp(e) FROM e), 5) AS sample, round({normal_quantile_text('pr')}, 5) AS theory FROM q""")
def stat_qq(t):
    d = t.scored.select("key", (col("y") - col("pred")).alias("e"))
    s = one_row(d, m=F.avg("e"), s=F.stddev_samp("e"), n=F.count(F.lit(1)))
    d = positions(d, [], ["e", "key"]).withColumn("pr", (col("pos") - 0.5) / F.lit(float(s["n"])))
    return d.select("key", r((col("e") - s["m"]) / s["s"], 5).alias("sample"), r(F.expr(normal_quantile_text("pr")), 5).alias("theory"))


@query("stat_log_refit", f"""WITH {REG_SQL}, l AS (SELECT *, ln(y + 20) AS ly FROM reg), {ols_sql('l', 'y', ['x1', 'x2'], name='oa')}, {ols_sql('l', 'ly', ['x1', 'x2'], name='ob')}
SELECT 'linear' AS model, key, round({fitted_sql(['x1', 'x2'], 'oa.')}, 4) AS fitted, round(y - {fitted_sql(['x1', 'x2'], 'oa.')}, 4) AS resid FROM l, oa
UNION ALL SELECT 'log', key, round({fitted_sql(['x1', 'x2'], 'ob.')}, 4), round(ly - {fitted_sql(['x1', 'x2'], 'ob.')}, 4) FROM l, ob""")
def stat_log_refit(t):
    d = t.reg.withColumn("ly", F.ln(col("y") + 20))
    m = collect_moments(d, ["x1", "x2", "y", "ly"])[None]
    out = []
    for name, y in (("linear", "y"), ("log", "ly")):
        f = solve(m, y, ["x1", "x2"])
        out.append(d.select(F.lit(name).alias("model"), "key", r(f.predict(), 4).alias("fitted"), r(col(y) - f.predict(), 4).alias("resid")))
    return out[0].unionByName(out[1])


@query("stat_confidence_band", f"""WITH {REG_SQL}, {ols_sql('reg', 'y', XS)}, e AS (SELECT key, {fitted_sql(XS, 'ols.')} AS f, {t_quantile_sql(Z, 'n - 4')} * sqrt(s2 * {leverage_sql(XS, 'ols.')}) AS half FROM reg, ols)
SELECT key, round(f, 4) AS fit, round(f - half, 4) AS lo, round(f + half, 4) AS hi FROM e""")
def stat_confidence_band(t):
    f = fit_ols(t.reg, "y", XS)
    half = tails.t_quantile(0.975, f.n - 4) * F.sqrt(f.sigma2 * f.leverage())
    return t.reg.select("key", r(f.predict(), 4).alias("fit"), r(f.predict() - half, 4).alias("lo"), r(f.predict() + half, 4).alias("hi"))


@query("stat_disagreement", f"""WITH {CLS_SCORED_SQL}, m AS (SELECT p, round(1 / (1 + exp(-(40 * f3 - 2))), 6) AS q, round(1 / (1 + exp(-(30 * f2 + 20 * f3 - 2.5))), 6) AS w FROM cls_scored)
SELECT round((corr(p, q) + corr(p, w) + corr(q, w)) / 3, 6) AS mean_cor, round(avg(((p > 0.5) <> (q > 0.5) OR (p > 0.5) <> (w > 0.5))::int), 6) AS differ FROM m""")
def stat_disagreement(t):
    d = three_models(t)
    pairs = [guarded_corr("p", "q"), guarded_corr("p", "w"), guarded_corr("q", "w")]
    v = lambda c: col(c) > 0.5
    differ = (v("p") != v("q")) | (v("p") != v("w"))
    return d.agg(r(sum(pairs[1:], pairs[0]) / 3).alias("mean_cor"), r(F.avg(differ.cast("double"))).alias("differ"))


def three_models(t) -> DataFrame:
    """Three fixed-formula event probabilities per labelled document."""
    q = F.round(1 / (1 + F.exp(-(40 * col("f3") - 2))), 6)
    w = F.round(1 / (1 + F.exp(-(30 * col("f2") + 20 * col("f3") - 2.5))), 6)
    return t.cls_scored.withColumns({"q": q, "w": w})
