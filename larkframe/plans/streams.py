"""Streaming forms over the events, landed as files."""

from larkframe.learning import metrics as mt
from larkframe.learning import models as md
from larkframe.operators.hashing import uniform
from larkframe.plans.base import *
from larkframe.plans.sqltext import fitted_sql, ols_sql
from larkframe.streaming import jobs
from larkframe.streaming.limits import rate_limited
from larkframe.tables import u_sql

SPAN = "yyyy-MM-dd HH:mm:ss"


UNIT, LATE = "month", "31 days"  # files arrive month by month, so a row is at most 31 days late


def arriving(t, extra: DataFrame | None = None) -> DataFrame:
    d = t.events.withColumn("ts", col("ts").cast("timestamp"))
    if extra is not None:
        d = d.unionByName(extra)
    return jobs.stream(t.spark, jobs.landed_in_order(d, "ts", UNIT, "arrived"), d.schema)


@query("st_chunk_agg", "SELECT cast(ts::date AS varchar) AS day, count(*) AS n, round(avg(value), 6) AS mean FROM events GROUP BY 1")
def st_chunk_agg(t):
    """Per micro-batch partial sums by day, merged at the end."""
    d = t.events.select(F.to_date("ts").cast("string").alias("day"), "value")
    s = jobs.stream(t.spark, jobs.landed(d, "chunks"), d.schema, files=2)
    p = jobs.partials(s, lambda b: b.groupBy("day").agg(F.count(F.lit(1)).alias("k"), F.sum("value").alias("s")), "chunk-sums")
    return p.groupBy("day").agg(F.sum("k").alias("n"), r(F.sum("s") / F.sum("k")).alias("mean"))


@query("st_event_counts", "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def st_event_counts(t):
    w = jobs.windowed(arriving(t), "ts", LATE, "1 hour", ["event_type"], n=F.count(F.lit(1)))
    d = jobs.latest(jobs.run(w, "update", "counts"), ["start", "event_type"])
    return d.select(F.date_format("start", SPAN).alias("start"), "event_type", "n")


K_SQL = "ev AS (SELECT event_id, value, (props->>'k')::double AS k, hour(ts)::double AS h FROM events)"


@query("st_score", f"WITH {K_SQL}, {ols_sql('ev', 'value', ['k', 'h'])} SELECT event_id, round({fitted_sql(['k', 'h'])}, 5) AS pred FROM ev, ols")
def st_score(t):
    """Rows scored as they arrive, by a model fitted before."""
    def inputs(d):
        return d.select("event_id", "value", F.from_json("props", "struct<k:double>")["k"].alias("k"), F.hour("ts").cast("double").alias("h"))

    m = md.linear(inputs(t.events), "value", ["k", "h"], solver="normal")
    s = md.predict(m, inputs(arriving(t))).select("event_id", r(col("pred"), 5).alias("pred"))
    return jobs.run(s, "append", "scores").drop("batch")


@query("st_monitor", "SELECT cast(ts::date AS varchar) AS d, count(*) AS requests, round(sqrt(avg((value - 10) ** 2)), 5) AS rmse, sqrt(avg((value - 10) ** 2)) > 10 AS alert FROM events GROUP BY 1")
def st_monitor(t):
    e = col("value") - 10
    w = jobs.windowed(arriving(t), "ts", LATE, "1 day", [], requests=F.count(F.lit(1)), rmse=F.sqrt(F.avg(e * e)))
    d = jobs.latest(jobs.run(w, "update", "monitor"), ["start"])
    return d.select(F.date_format("start", "yyyy-MM-dd").alias("d"), "requests", r(col("rmse"), 5).alias("rmse"), (col("rmse") > 10).alias("alert"))


@query("st_drift", """WITH b AS (SELECT event_type, count(*) / sum(count(*)) OVER () AS base FROM events WHERE ts < TIMESTAMP '2024-01-08' GROUP BY 1), w AS (SELECT ts::date AS d, event_type, count(*) AS n FROM events GROUP BY 1, 2)
SELECT cast(d AS varchar) AS d, event_type, n, round(n / sum(n) OVER (PARTITION BY d) - base, 6) AS shift FROM w JOIN b USING (event_type)""")
def st_drift(t):
    """Category shares per day against the shares of the first week."""
    first = t.events.where(col("ts") < F.lit("2024-01-08").cast("timestamp_ntz"))
    base = share_of(first, ["event_type"], [], "base").select("event_type", "base")
    w = jobs.windowed(arriving(t), "ts", LATE, "1 day", ["event_type"], n=F.count(F.lit(1)))
    d = jobs.latest(jobs.run(w, "update", "drift"), ["start", "event_type"])
    d = attach(d, ["start"], _t=F.sum("n")).join(base, "event_type")
    return d.select(F.date_format("start", "yyyy-MM-dd").alias("d"), "event_type", "n", r(col("n") / col("_t") - col("base")).alias("shift"))


@query("st_dedup_requests", "SELECT event_id, user_id, value FROM events")
def st_dedup_requests(t):
    """Some requests arrive twice; the first row per id is kept."""
    again = t.events.withColumn("ts", col("ts").cast("timestamp")).where(uniform(["event_id"], "twice") < 0.2)
    d = jobs.deduplicated(arriving(t, again), "ts", LATE, ["event_id"]).select("event_id", "user_id", "value")
    return jobs.run(d, "append", "dedup").drop("batch")


@query("st_rate_limit_state", "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS start, user_id, count(*) AS calls FROM events GROUP BY 1, 2 HAVING count(*) > 1")
def st_rate_limit_state(t):
    """Users with more calls in an hour than allowed."""
    w = jobs.windowed(arriving(t), "ts", LATE, "1 hour", ["user_id"], calls=F.count(F.lit(1)))
    d = jobs.latest(jobs.run(w.where(col("calls") > 1), "update", "limits"), ["start", "user_id"])
    return d.select(F.date_format("start", SPAN).alias("start"), "user_id", "calls")


def _limit_sql(scope: str, key: str, limit: int) -> str:
    return f"""SELECT '{scope}' AS scope, e.k, event_id, e.ts, s.start, row_number() OVER (PARTITION BY e.k, s.start ORDER BY e.ts, event_id) AS p, {limit} AS most
  FROM (SELECT '{scope}' AS scope, cast({key} AS varchar) AS k, event_id, ts FROM events) e ASOF JOIN w s ON s.scope = e.scope AND e.k = s.k AND e.ts >= s.start"""


CALLS = (("user", "user_id", 100), ("type", "event_type", 4))
CALLS_SQL = f"""WITH RECURSIVE e AS ({' UNION ALL '.join(f"SELECT '{s}' AS scope, cast({k} AS varchar) AS k, ts FROM events" for s, k, _ in CALLS)}),
w AS (SELECT scope, k, min(ts) AS start FROM e GROUP BY ALL
  UNION ALL SELECT w.scope, w.k, min(e.ts) FROM w JOIN e ON e.scope = w.scope AND e.k = w.k AND e.ts > w.start + INTERVAL 1 HOUR GROUP BY w.scope, w.k),
p AS ({' UNION ALL '.join(_limit_sql(*c) for c in CALLS)})
SELECT scope, k AS key, event_id, strftime(start, '%Y-%m-%d %H:%M:%S') AS start, least(p, most + 1) AS calls, p <= most + 1 AS allowed FROM p"""


@query("st_rate_limit_calls", CALLS_SQL)
def st_rate_limit_calls(t):
    """Every call with the decision of the limiter: 100 an hour for a user, 4 for a type of event, the hour counted from the first call."""
    d = t.events.select("event_id", "user_id", "event_type", col("ts").cast("timestamp").alias("ts"))
    out = None
    for scope, key, limit in CALLS:
        calls = d.select(col(key).cast("string").alias("key"), col("event_id").alias("id"), "ts")
        got = rate_limited(calls, UNIT, LATE, limit, 3600).select(
            F.lit(scope).alias("scope"), "key", col("id").alias("event_id"), F.date_format("start", SPAN).alias("start"), "calls", "allowed")
        out = got if out is None else out.unionByName(got)
    return out
