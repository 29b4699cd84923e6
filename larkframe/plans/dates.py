"""Dates, times, zones, spans and business days."""

from larkframe.functions import dates as dt
from larkframe.plans.base import *

DS = "o_orderdate::date"
OK = "o_orderkey"
E_TS = "ts"


def D() -> Column:
    return F.to_date("o_orderdate")


def s(c: Column) -> Column:
    return c.cast("string")


@query("date_parse", f"SELECT {OK}, cast({DS} AS varchar) AS ymd, cast({DS} AS varchar) AS mdy, cast({DS} AS varchar) AS dmy, strftime(o_orderdate, '%Y-%m-%d 13:05:09') AS hms FROM orders")
def date_parse(t):
    def back(fmt):
        return s(F.try_to_timestamp(F.date_format("o_orderdate", fmt), F.lit(fmt)).cast("date"))

    stamp = F.concat(F.date_format("o_orderdate", "yyyy/MM/dd"), F.lit(" 13:05:09"))
    return t.orders.select(OK, back("yyyyMMdd").alias("ymd"), back("MM/dd/yyyy").alias("mdy"), back("dd-MM-yyyy").alias("dmy"),
                           s(F.try_to_timestamp(stamp, F.lit("yyyy/MM/dd HH:mm:ss"))).alias("hms"))


@query("date_parse_orders", f"SELECT {OK}, CASE WHEN o_orderkey % 3 <> 2 THEN cast({DS} AS varchar) END AS d FROM orders")
def date_parse_orders(t):
    k = col(OK) % 3
    x = F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k == 1, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(F.lit("soon"))
    return t.orders.select(OK, s(dt.first_format(x, ["yyyy-MM-dd", "dd/MM/yyyy"])).alias("d"))


@query("date_parts", f"SELECT {OK}, year(o_orderdate)::int AS y, month(o_orderdate)::int AS m, day(o_orderdate)::int AS d, quarter(o_orderdate)::int AS q, dayofyear(o_orderdate)::int AS yd FROM orders")
def date_parts(t):
    o = col("o_orderdate")
    return t.orders.select(OK, F.year(o).alias("y"), F.month(o).alias("m"), F.dayofmonth(o).alias("d"), F.quarter(o).alias("q"), F.dayofyear(o).alias("yd"))


@query("date_labels", f"SELECT {OK}, strftime(o_orderdate, '%B') AS month, strftime(o_orderdate, '%A') AS wday, strftime(o_orderdate, '%b') AS short FROM orders")
def date_labels(t):
    return t.orders.select(OK, F.date_format("o_orderdate", "MMMM").alias("month"), F.date_format("o_orderdate", "EEEE").alias("wday"), F.date_format("o_orderdate", "MMM").alias("short"))


@query("date_wday", f"SELECT {OK}, dayofweek(o_orderdate)::int + 1 AS wday, dayofweek(o_orderdate) IN (0, 6) AS weekend FROM orders")
def date_wday(t):
    return t.orders.select(OK, F.dayofweek("o_orderdate").alias("wday"), dt.is_weekend(col("o_orderdate")).alias("weekend"))


@query("date_week", f"SELECT {OK}, ((dayofyear(o_orderdate) - 1) // 7 + 1)::int AS wk FROM orders")
def date_week(t):
    return t.orders.select(OK, dt.week(col("o_orderdate")).alias("wk"))


@query("date_days_in_month", f"SELECT {OK}, day(last_day(o_orderdate))::int AS n FROM orders")
def date_days_in_month(t):
    return t.orders.select(OK, F.dayofmonth(F.last_day("o_orderdate")).alias("n"))


@query("date_plus", f"SELECT {OK}, cast({DS} + 30 AS varchar) AS d30, cast(({DS} + INTERVAL 2 MONTH)::date AS varchar) AS m2, cast(({DS} + INTERVAL 1 YEAR)::date AS varchar) AS y1, cast((last_day(o_orderdate) + INTERVAL 1 MONTH)::date AS varchar) AS clamp FROM orders")
def date_plus(t):
    return t.orders.select(OK, s(F.date_add(D(), 30)).alias("d30"), s(F.add_months(D(), 2)).alias("m2"), s(F.add_months(D(), 12)).alias("y1"), s(F.add_months(F.last_day(D()), 1)).alias("clamp"))


@query("date_ceil_floor", f"""SELECT {OK}, cast({DS} + (7 - dayofweek({DS}))::int AS varchar) AS week_up, cast({DS} - dayofweek({DS})::int AS varchar) AS week_down,
cast((date_trunc('month', o_orderdate) + INTERVAL 1 MONTH)::date AS varchar) AS month_up, cast(date_trunc('year', o_orderdate)::date AS varchar) AS year_down FROM orders""")
def date_ceil_floor(t):
    return t.orders.select(OK, s(dt.ceiling(D(), "week")).alias("week_up"), s(dt.floor(D(), "week")).alias("week_down"), s(dt.ceiling(D(), "month")).alias("month_up"), s(dt.floor(D(), "year")).alias("year_down"))


@query("date_diff_units", "SELECT event_id, date_diff('microsecond', TIMESTAMP '2024-01-01', ts) AS us, date_diff('microsecond', TIMESTAMP '2024-01-01', ts) / 6e7::double AS mins, date_diff('microsecond', TIMESTAMP '2024-01-01', ts) / 8.64e10::double AS days FROM events")
def date_diff_units(t):
    us = F.unix_micros(col("ts").cast("timestamp")) - F.unix_micros(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return t.events.select("event_id", us.alias("us"), (us / 6e7).alias("mins"), (us / 8.64e10).alias("days"))


@query("time_parts", "SELECT event_id, hour(ts)::int AS h, minute(ts)::int AS m, strftime(ts, '%p') AS ampm, strftime(ts, '%H:%M:%S') AS clock, cast(ts::date AS varchar) AS d FROM events")
def time_parts(t):
    return t.events.select("event_id", F.hour("ts").alias("h"), F.minute("ts").alias("m"), F.date_format("ts", "a").alias("ampm"), F.date_format("ts", "HH:mm:ss").alias("clock"), s(F.to_date("ts")).alias("d"))


FMT, SFMT = "yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S"


@query("tz_with", f"SELECT event_id, strftime(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York', '{SFMT}') AS ny, strftime(ts AT TIME ZONE 'UTC' AT TIME ZONE 'Asia/Tokyo', '{SFMT}') AS tokyo FROM events")
def tz_with(t):
    ts = col("ts").cast("timestamp")
    return t.events.select("event_id", F.date_format(F.from_utc_timestamp(ts, "America/New_York"), FMT).alias("ny"), F.date_format(F.from_utc_timestamp(ts, "Asia/Tokyo"), FMT).alias("tokyo"))


@query("tz_force", f"SELECT event_id, strftime(ts AT TIME ZONE 'America/New_York' AT TIME ZONE 'UTC', '{SFMT}') AS instant FROM events")
def tz_force(t):
    return t.events.select("event_id", F.date_format(F.to_utc_timestamp(col("ts").cast("timestamp"), "America/New_York"), FMT).alias("instant"))


@query("interval_overlap", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (least(o_orderdate, l_shipdate) <= o_orderdate + INTERVAL 90 DAY AND o_orderdate + INTERVAL 30 DAY <= greatest(o_orderdate, l_shipdate)) AS hit
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def interval_overlap(t):
    j = t.lineitem.join(t.orders, col("l_orderkey") == col("o_orderkey"))
    o, l = F.to_date("o_orderdate"), F.to_date("l_shipdate")
    hit = dt.overlaps(F.least(o, l), F.greatest(o, l), F.date_add(o, 30), F.date_add(o, 90))
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", hit.alias("hit"))


@query("duration_vs_period", f"""WITH i AS (SELECT o_orderkey, o_orderdate + INTERVAL 12 HOUR AS local, (o_orderdate + INTERVAL 12 HOUR) AT TIME ZONE 'America/New_York' AT TIME ZONE 'UTC' AS inst FROM orders)
SELECT o_orderkey, strftime(inst + INTERVAL 24 HOUR, '{SFMT}') AS duration, strftime((local + INTERVAL 1 DAY) AT TIME ZONE 'America/New_York' AT TIME ZONE 'UTC', '{SFMT}') AS period FROM i""")
def duration_vs_period(t):
    local = col("o_orderdate").cast("timestamp") + F.expr("INTERVAL 12 HOURS")
    zone = "America/New_York"
    duration = F.to_utc_timestamp(local, zone) + F.expr("INTERVAL 24 HOURS")
    period = F.to_utc_timestamp(local + F.expr("INTERVAL 1 DAY"), zone)
    return t.orders.select(OK, F.date_format(duration, FMT).alias("duration"), F.date_format(period, FMT).alias("period"))


@query("seq_dates", "SELECT cast(unnest(generate_series(date_trunc('month', min(o_orderdate)), max(o_orderdate), INTERVAL 1 MONTH))::date AS varchar) AS d FROM orders")
def seq_dates(t):
    span = t.orders.agg(F.trunc(F.min("o_orderdate"), "month").alias("a"), F.to_date(F.max("o_orderdate")).alias("b"))
    return span.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MONTH"))).alias("d")).select(s(col("d")).alias("d"))


@query("date_range_weekly", "SELECT cast(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 7 DAY))::date AS varchar) AS d FROM orders")
def date_range_weekly(t):
    span = t.orders.agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b"))
    return span.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 7 DAY"))).alias("d")).select(s(col("d")).alias("d"))


TODAY = "2024-06-15"


@query("date_age", f"SELECT {OK}, (2024 - year(o_orderdate) - (strftime(o_orderdate, '%m%d') > '0615')::int)::int AS age FROM orders")
def date_age(t):
    return t.orders.select(OK, dt.age(D(), F.lit(TODAY).cast("date")).alias("age"))


@query("next_birthday", f"""WITH n AS (SELECT o_orderkey, CASE WHEN ({DS} + to_years((2024 - year(o_orderdate))::int))::date >= DATE '{TODAY}' THEN ({DS} + to_years((2024 - year(o_orderdate))::int))::date
ELSE ({DS} + to_years((2025 - year(o_orderdate))::int))::date END AS d FROM orders) SELECT o_orderkey, cast(d AS varchar) AS d, strftime(d, '%A') AS wday, (d - DATE '{TODAY}')::int AS days FROM n""")
def next_birthday(t):
    today = F.lit(TODAY).cast("date")
    nxt = dt.next_anniversary(D(), today)
    return t.orders.select(OK, nxt.alias("n")).select(OK, s(col("n")).alias("d"), F.date_format("n", "EEEE").alias("wday"), F.datediff("n", today).alias("days"))


@query("business_days_add", f"""SELECT {OK}, cast(CASE WHEN o_orderkey % 12 = 0 THEN {DS} ELSE list_filter(generate_series({DS} + 1, {DS} + 30, INTERVAL 1 DAY), lambda x: isodow(x) < 6)[o_orderkey % 12]::date END AS varchar) AS due FROM orders""")
def business_days_add(t):
    return t.orders.select(OK, s(dt.add_business_days(D(), (col(OK) % 12).cast("int"))).alias("due"))


@query("business_timeline", f"""WITH b AS (SELECT o_orderkey, o_custkey, {DS} AS start, list_filter(generate_series({DS} + 1, {DS} + 30, INTERVAL 1 DAY), lambda x: isodow(x) < 6)[1 + o_orderkey % 9]::date AS due FROM orders)
SELECT o_orderkey, cast(due AS varchar) AS due, (due - start)::int AS days, (lead(start) OVER (PARTITION BY o_custkey ORDER BY start, o_orderkey) - due)::int AS slack FROM b""")
def business_timeline(t):
    """Due date per task, elapsed days, and days to the start of the customer's next task."""
    from larkframe.operators.ordering import positions

    d = t.orders.select(OK, "o_custkey", D().alias("start"), dt.add_business_days(D(), (1 + col(OK) % 9).cast("int")).alias("due"))
    d = positions(d, ["o_custkey"], ["start", OK])
    nxt = d.select("o_custkey", (col("pos") - 1).alias("pos"), col("start").alias("next_start"))
    j = match_join(d, nxt, ["o_custkey", "pos"], "left")
    return j.select(OK, s(col("due")).alias("due"), F.datediff("due", "start").alias("days"), F.datediff("next_start", "due").alias("slack"))


@query("date_now", None)
def date_now(t):
    """Days since each order, by the current date."""
    return t.orders.select(OK, F.datediff(F.current_date(), D()).alias("days"), (F.current_timestamp() > col("o_orderdate")).alias("past"))
