"""Monitoring, experiments, batch scoring and the model store."""

from larkframe.learning import metrics as mt
from larkframe.learning import models as md
from larkframe.learning.registry import ModelStore
from larkframe.operators import hypothesis as hy
from larkframe.operators.hashing import uniform
from larkframe.operators.quantiles import quantiles
from larkframe.plans.base import *
from larkframe.plans.sqltext import *
from larkframe.plans.stats import HALVES_SQL, chisq_sql, halves, ks_sql, welch_sql
from larkframe.session import materialized, new_folder
from larkframe.tables import REG_SQL, SCORED_SQL, u_sql

XS = ["x1", "x2", "x3"]
MET = "sqrt(avg((y - pred) ** 2)) AS rmse, avg(abs(y - pred)) AS mae, corr(y, pred) ** 2 AS rsq"


def metric_aggs() -> list[Column]:
    return [mt.rmse("y", "pred").alias("rmse"), mt.mae("y", "pred").alias("mae"), mt.rsq("y", "pred").alias("rsq")]


def degraded(now: Column, base: Column, metric: Column) -> Column:
    """Percent change in the bad direction: up for errors, down for rsq."""
    change = F.try_divide(now - base, base) * 100
    return F.when(metric == "rsq", -change).otherwise(change)


DRIFTED = "dr AS (SELECT year(ship) AS yr, y, pred + CASE WHEN year(ship) >= 2000 THEN 5 ELSE 0 END AS pred FROM scored)"


def drifted(t) -> DataFrame:
    """Scores of which the later years are biased."""
    return t.scored.select(F.year("ship").cast("long").alias("yr"), "y", (col("pred") + F.when(F.year("ship") >= 2000, 5).otherwise(0)).alias("pred"), "key", *XS)


@query("ops_metric_monitor", f"""WITH {SCORED_SQL}, {DRIFTED}, n AS (UNPIVOT (SELECT yr, {MET} FROM dr WHERE yr >= 1998 GROUP BY 1) ON rmse, mae, rsq INTO NAME metric VALUE now), b AS (UNPIVOT (SELECT {MET} FROM dr WHERE yr < 1998) ON rmse, mae, rsq INTO NAME metric VALUE base),
j AS (SELECT yr, metric, now, base, CASE WHEN metric = 'rsq' THEN -1 ELSE 1 END * (now - base) / base * 100 AS worse FROM n JOIN b USING (metric)) SELECT yr, metric, round(now, 5) AS now, round(base, 5) AS base, round(worse, 4) AS worse, worse > 10 AS alert FROM j""")
def ops_metric_monitor(t):
    d = drifted(t)
    names = ["rmse", "mae", "rsq"]
    now = d.where(col("yr") >= 1998).groupBy("yr").agg(*metric_aggs()).unpivot(["yr"], names, "metric", "now")
    base = d.where(col("yr") < 1998).agg(*metric_aggs()).unpivot([], names, "metric", "base")
    j = now.join(base, "metric").withColumn("worse", degraded(col("now"), col("base"), col("metric")))
    return j.select("yr", "metric", r(col("now"), 5).alias("now"), r(col("base"), 5).alias("base"), r(col("worse"), 4).alias("worse"), (col("worse") > 10).alias("alert"))


@query("ops_timeline", f"WITH {SCORED_SQL} SELECT cast(ship::date AS varchar) AS d, count(*) AS requests, round(sqrt(avg((y - pred) ** 2)), 5) AS rmse, sqrt(avg((y - pred) ** 2)) > 8 AS alert FROM scored GROUP BY 1")
def ops_timeline(t):
    g = t.scored.groupBy(F.to_date("ship").cast("string").alias("d")).agg(F.count(F.lit(1)).alias("requests"), mt.rmse("y", "pred").alias("e"))
    return g.select("d", "requests", r(col("e"), 5).alias("rmse"), (col("e") > 8).alias("alert"))


@query("ops_drift_numeric", f"""WITH {HALVES_SQL}, k AS ({ks_sql('hv', 'price', 'late')} UNION ALL {ks_sql('hv', 'cust', 'late')}), m AS (SELECT 'price' AS measure, avg(price) FILTER (NOT late) AS a, avg(price) FILTER (late) AS b FROM hv UNION ALL SELECT 'cust', avg(cust) FILTER (NOT late), avg(cust) FILTER (late) FROM hv)
SELECT measure, round({ks_p_sql('d', 'na', 'nb')}, 6) AS p, {ks_p_sql('d', 'na', 'nb')} < 0.1 AS drift, round(a, 3) AS train_mean, round(b, 3) AS now_mean, round(abs(a - b) / a, 6) AS shift FROM k JOIN m USING (measure)""")
def ops_drift_numeric(t):
    d = materialized(halves(t))
    cols = ["price", "cust"]
    k = hy.ks(d, cols, col("late"))
    wide = d.agg(*[F.struct(F.lit(c).alias("measure"), F.avg(F.when(~col("late"), col(c))).alias("a"), F.avg(F.when(col("late"), col(c))).alias("b")).alias(c) for c in cols])
    m = wide.select(F.inline(F.array(*cols)))
    return k.join(m, "measure").select("measure", r(col("p")).alias("p"), (col("p") < 0.1).alias("drift"), r(col("a"), 3).alias("train_mean"), r(col("b"), 3).alias("now_mean"), r(F.abs(col("a") - col("b")) / col("a")).alias("shift"))


@query("ops_drift_categorical", f"WITH {HALVES_SQL}, x AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, * FROM ({chisq_sql('hv', 'late', c)})" for c in ("o_orderstatus", "o_orderpriority")) + f") SELECT feature, round(x2, 6) AS x2, df, round({chisq_p_sql('x2', 'df')}, 6) AS p, {chisq_p_sql('x2', 'df')} < 0.1 AS drift FROM x")
def ops_drift_categorical(t):
    d = materialized(halves(t))
    out = None
    for c in ("o_orderstatus", "o_orderpriority"):
        x = hy.chisq(d, "late", c).select(F.lit(c).alias("feature"), r(col("x2")).alias("x2"), "df", r(col("p")).alias("p"), (col("p") < 0.1).alias("drift"))
        out = x if out is None else out.unionByName(x)
    return out


AB = f"CASE WHEN {u_sql('user_id', 'ab')} < 0.5 THEN 'A' ELSE 'B' END"


def assigned(t) -> DataFrame:
    """Users in two groups by their hash, so a user keeps the group in every request."""
    return t.events.withColumn("arm", F.when(uniform(["user_id"], "ab") < 0.5, "A").otherwise("B"))


@query("ops_ab_assign", f"SELECT event_id, user_id, {AB} AS arm FROM events")
def ops_ab_assign(t):
    return assigned(t).select("event_id", "user_id", "arm")


AB_SQL = f"ab AS (SELECT arm, value - CASE arm WHEN 'A' THEN 10 ELSE 11 END AS e, abs(value - CASE arm WHEN 'A' THEN 10 ELSE 11 END) AS ae FROM (SELECT value, {AB} AS arm FROM events))"
AB_WELCH = welch_sql("ab", "ae", "arm = 'A'", "arm = 'B'")


@query("ops_ab_test", f"""WITH {AB_SQL}, {AB_WELCH} SELECT arm, count(*) AS n, round(sqrt(avg(e * e)), 5) AS rmse, round(avg(ae), 5) AS mae, round(median(ae), 5) AS med, (SELECT round({t_p_sql('t', 'df')}, 6) FROM welch) AS p,
(SELECT CASE WHEN {t_p_sql('t', 'df')} >= 0.05 THEN 'none' WHEN m1 < m2 THEN 'A' ELSE 'B' END FROM welch) AS winner FROM ab GROUP BY 1""")
def ops_ab_test(t):
    """Errors of two constant predictors on their halves of the users, with a test of the difference."""
    e = col("value") - F.when(col("arm") == "A", 10).otherwise(11)
    d = materialized(assigned(t).select("arm", e.alias("e"), F.abs(e).alias("ae")))
    w = hy.welch(d, "ae", col("arm") == "A", col("arm") == "B").first()
    winner = "none" if w["p"] >= 0.05 else ("A" if w["m1"] < w["m2"] else "B")
    g = d.groupBy("arm").agg(F.count(F.lit(1)).alias("n"), r(F.sqrt(F.avg(col("e") * col("e"))), 5).alias("rmse"), r(F.avg("ae"), 5).alias("mae"))
    med = quantiles(d, ["arm"], "ae", {"med": 0.5})
    return match_join(g, med, ["arm"]).select("arm", "n", "rmse", "mae", r(col("med"), 5).alias("med"), F.lit(round(w["p"], 6)).alias("p"), F.lit(winner).alias("winner"))


@query("ops_retrain")
def ops_retrain(t):
    """Year by year: score with the current model; when the error has grown by a tenth, refit on the rows up to that
    year and report the error of the next year for both models."""
    d = t.reg.select(F.year("ship").alias("yr"), *XS, (col("y") + F.when(F.year("ship") >= 1998, 3 * col("x3")).otherwise(0)).alias("y"))
    d = materialized(d)
    span = one_row(d, lo=F.min("yr"), hi=F.max("yr"))
    model = md.linear(d.where(col("yr") == span["lo"]), "y", XS)
    error = lambda m, yr: md.predict(m, d.where(col("yr") == yr)).agg(mt.rmse("y", "pred").alias("e")).first()["e"]
    base, rows = error(model, span["lo"]), []
    for yr in range(span["lo"] + 1, span["hi"] + 1):
        now = error(model, yr)
        worse = (now - base) / base * 100
        after = None
        if worse > 10:
            # the year is split: the model is refitted on the years before it and half of it, and checked on the other half
            part = F.pmod(F.xxhash64(*XS, "y"), F.lit(2))
            model = md.linear(d.where((col("yr") < yr) | ((col("yr") == yr) & (part == 0))), "y", XS)
            after = md.predict(model, d.where((col("yr") == yr) & (part == 1))).agg(mt.rmse("y", "pred").alias("e")).first()["e"]
            base = after
        rows.append((yr, round(now, 4), round(worse, 3), int(after is not None), None if after is None else round(after, 4)))
    return t.spark.createDataFrame(rows, "yr int, rmse double, worse double, refitted int, rmse_after double")


@query("ops_registry")
def ops_registry(t):
    """Three versions of a model; the latest is the highest version number, not the last in text order."""
    store = ModelStore(t.spark, new_folder(t.spark, "store"))
    d = materialized(t.reg.select("y", *XS))
    n = d.count()
    for version, xs in (("1.2.0", ["x1"]), ("1.9.0", ["x1", "x2"]), ("1.10.0", XS)):
        m = md.linear(d, "y", xs)
        e = md.predict(m, d).agg(mt.rmse("y", "pred").alias("e")).first()["e"]
        store.register(m, "price", version, "rmse", round(e, 4), n)
    top = store.latest("price")["version"]
    return store.versions("price").select("name", "version", "metric", "value", "n_train", (col("version") == top).alias("latest"))


@query("ops_model_save", f"WITH {REG_SQL}, {ols_sql('reg', 'y', XS)} SELECT key, round({fitted_sql(XS)}, 4) AS pred, true AS same FROM reg, ols")
def ops_model_save(t):
    """Predictions of a saved and reloaded model, compared with the model before saving."""
    store = ModelStore(t.spark, new_folder(t.spark, "saved"))
    m = md.linear(t.reg, "y", XS, solver="normal")
    store.register(m, "price", "1.0.0", "rmse", 0.0, 0)
    both = md.predict(store.load("price"), md.predict(m, t.reg, "before"), "after")
    return both.select("key", r(col("after"), 4).alias("pred"), (col("before") == col("after")).alias("same"))


@query("ops_batch_score", f"WITH {REG_SQL}, {ols_sql('reg', 'y', XS)} SELECT key, CASE WHEN x1 BETWEEN 5 AND 45 AND x2 <= 9 THEN round({fitted_sql(XS)}, 4) END AS pred, CASE WHEN NOT x1 BETWEEN 5 AND 45 THEN 'x1 out of range' WHEN x2 > 9 THEN 'x2 out of range' END AS error FROM reg, ols")
def ops_batch_score(t):
    """Scores for valid rows, a reason for the others."""
    store = ModelStore(t.spark, new_folder(t.spark, "batch"))
    store.register(md.linear(t.reg, "y", XS, solver="normal"), "price", "1.0.0", "rmse", 0.0, 0)
    error = F.when(~col("x1").between(5, 45), "x1 out of range").when(col("x2") > 9, "x2 out of range")
    p = md.predict(store.load("price"), t.reg.withColumn("error", error))
    return p.select("key", F.when(col("error").isNull(), r(col("pred"), 4)).alias("pred"), "error")


@query("ops_request_log", """SELECT event_id, 'req-' || lpad(event_id::varchar, 10, '0') AS request, CASE WHEN value < 1 THEN 'too small' WHEN value > 30 THEN 'too large' WHEN (props->>'k')::int IS NULL THEN 'no key' ELSE 'ok' END AS status, date_diff('millisecond', ts, ts + to_milliseconds(round(value * 10)::bigint)) AS latency FROM events""")
def ops_request_log(t):
    k = F.from_json("props", "struct<k:int>")["k"]
    status = F.when(col("value") < 1, "too small").when(col("value") > 30, "too large").when(k.isNull(), "no key").otherwise("ok")
    start = col("ts").cast("timestamp")
    end = F.timestamp_millis(F.unix_millis(start) + F.round(col("value") * 10).cast("long"))
    return t.events.select("event_id", F.format_string("req-%010d", "event_id").alias("request"), status.alias("status"), (F.unix_millis(end) - F.unix_millis(start)).alias("latency"))


@query("ops_dashboard_summary", """WITH d AS (SELECT ts::date AS d, count(*) AS requests, avg(value) AS mean, count(DISTINCT user_id) AS users, avg((event_type = 'error')::int) AS errors FROM events GROUP BY 1)
SELECT sum(requests)::bigint AS requests, round(avg(requests), 4) AS per_day, round(avg(mean), 6) AS mean_value, max(users) AS top_users, round(avg(errors) * 100, 6) AS error_pct FROM d""")
def ops_dashboard_summary(t):
    d = t.events.groupBy(F.to_date("ts").alias("d")).agg(
        F.count(F.lit(1)).alias("requests"), F.avg("value").alias("mean"), F.countDistinct("user_id").alias("users"), F.avg((col("event_type") == "error").cast("double")).alias("errors"))
    return d.agg(F.sum("requests").alias("requests"), r(F.avg("requests"), 4).alias("per_day"), r(F.avg("mean")).alias("mean_value"), F.max("users").alias("top_users"), r(F.avg("errors") * 100).alias("error_pct"))
