"""Ranks, offsets, running and rolling values.

Ranks and running totals over a whole table go through value tables and range partitions. Plain windows are kept where
the input is one row per calendar day, which stays small whatever the size of the source.
"""

from larkframe.operators.hashing import uniform
from larkframe.operators.ordering import positions, running
from larkframe.operators.quantiles import value_table
from larkframe.plans.base import *
from larkframe.tables import DAILY_SQL, u_sql

KEY = ["p_partkey", "p_size"]


def ranked(df: DataFrame, value: str) -> DataFrame:
    """Rows with the rank facts of their value: count of equal values n, inclusive count cum, dense number."""
    return match_join(df, value_table(df, [], value).withColumnRenamed("v", value), [value], "left")


@query("win_rank", "SELECT p_partkey, p_size, rank() OVER (ORDER BY p_size) + (count(*) OVER (PARTITION BY p_size) - 1) / 2 AS rk FROM part")
def win_rank(t):
    return ranked(t.part.select(*KEY), "p_size").select(*KEY, (col("cum") - col("n") + 1 + (col("n") - 1) / 2).alias("rk"))


@query("win_dense_rank", """SELECT p_partkey, p_size, dense_rank() OVER (ORDER BY p_size) AS up, dense_rank() OVER (ORDER BY p_size DESC) AS down FROM part""")
def win_dense_rank(t):
    d = ranked(t.part.select(*KEY), "p_size")
    top = one_row(d, m=F.max("dense"))["m"]
    return d.select(*KEY, col("dense").alias("up"), (F.lit(top) + 1 - col("dense")).alias("down"))


@query("win_row_number", "SELECT p_partkey, p_size, row_number() OVER (ORDER BY p_size, p_partkey) AS pos FROM part")
def win_row_number(t):
    return positions(t.part.select(*KEY), [], ["p_size", "p_partkey"])


@query("win_percent_rank", "SELECT p_partkey, p_size, round(percent_rank() OVER (ORDER BY p_size), 6) AS pr FROM part")
def win_percent_rank(t):
    n = t.part.where(col("p_size").isNotNull()).count()
    return ranked(t.part.select(*KEY), "p_size").select(*KEY, r((col("cum") - col("n")) / F.lit(max(n - 1, 1))).alias("pr"))


def ntile_of(pos: Column, n, k: int) -> Column:
    """Bucket of a 1-based position when n rows go to k buckets, larger buckets first."""
    n = n if isinstance(n, Column) else F.lit(n)
    size, extra = F.floor(n / k), n % k
    edge = extra * (size + 1)
    return F.when(pos <= edge, F.ceil(pos / (size + 1))).otherwise(extra + F.ceil(F.try_divide(pos - edge, size))).cast("int")


@query("win_ntile", "SELECT p_partkey, p_size, ntile(4) OVER (ORDER BY p_size, p_partkey)::int AS bucket FROM part")
def win_ntile(t):
    d = positions(t.part.select(*KEY), [], ["p_size", "p_partkey"])
    return d.select(*KEY, ntile_of(col("pos"), t.part.count(), 4).alias("bucket"))


@query("win_zscore", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round((l_quantity - avg(l_quantity) OVER w) / stddev_samp(l_quantity) OVER w, 6) AS z
FROM lineitem WINDOW w AS (PARTITION BY l_returnflag)""")
def win_zscore(t):
    d = attach(t.lineitem, ["l_returnflag"], m=F.avg("l_quantity"), s=F.stddev_samp("l_quantity"))
    return d.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", r(F.try_divide(col("l_quantity") - col("m"), col("s"))).alias("z"))


def by_date() -> Window:
    # one row per day: a century is 36,525 rows
    return Window.partitionBy(F.lit(0)).orderBy("d")


DAY = "cast(d AS varchar) AS d"
DW = "WINDOW w AS (ORDER BY d)"


def day() -> Column:
    return col("d").cast("string").alias("d")


@query("win_lag_lead", f"WITH {DAILY_SQL} SELECT {DAY}, n, lag(n) OVER w AS before, lead(n) OVER w AS after, lag(n, 7) OVER w AS week FROM daily {DW}")
def win_lag_lead(t):
    w = by_date()
    return t.daily.select(day(), "n", F.lag("n").over(w).alias("before"), F.lead("n").over(w).alias("after"), F.lag("n", 7).over(w).alias("week"))


@query("win_growth", """WITH y AS (SELECT year(o_orderdate) AS y, sum(o_totalprice) AS s FROM orders GROUP BY 1)
SELECT y, round(s, 2) AS s, round((s - lag(s) OVER (ORDER BY y)) / lag(s) OVER (ORDER BY y) * 100, 6) AS growth FROM y""")
def win_growth(t):
    y = t.orders.groupBy(F.year("o_orderdate").alias("y")).agg(F.sum("o_totalprice").alias("s"))
    prev = F.lag("s").over(Window.partitionBy(F.lit(0)).orderBy("y"))  # one row per year
    return y.select("y", r(col("s"), 2).alias("s"), r(F.try_divide(col("s") - prev, prev) * 100).alias("growth"))


@query("win_diff", f"WITH {DAILY_SQL} SELECT {DAY}, n - lag(n) OVER w AS d1, round(revenue - lag(revenue, 7) OVER w, 2) AS d7 FROM daily {DW}")
def win_diff(t):
    w = by_date()
    return t.daily.select(day(), (col("n") - F.lag("n").over(w)).alias("d1"), r(col("revenue") - F.lag("revenue", 7).over(w), 2).alias("d7"))


RUN = "WINDOW w AS (ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)"
ORDER = ["o_orderdate", "o_orderkey"]


@query("win_cumsum", f"SELECT o_orderkey, round(sum(o_totalprice) OVER w, 2) AS total FROM orders {RUN}")
def win_cumsum(t):
    d = running(t.orders.select(*ORDER, "o_totalprice"), [], ORDER, total=("sum", "o_totalprice"))
    return d.select("o_orderkey", r(col("total"), 2).alias("total"))


@query("win_cummean", f"SELECT o_orderkey, sum(round(o_totalprice * 100)::bigint) OVER w / (100::double * count(*) OVER w) AS mean FROM orders {RUN}")
def win_cummean(t):
    cents = F.round(col("o_totalprice") * 100).cast("long")  # whole cents add up the same in any order
    d = running(t.orders.select(*ORDER, cents.alias("c")), [], ORDER, s=("sum", "c"), k=("count", "c"))
    return d.select("o_orderkey", F.try_divide(col("s"), col("k") * 100.0).alias("mean"))


@query("win_cummax", f"""SELECT o_orderkey, max(coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END, 0)) OVER w AS top FROM orders {RUN}""")
def win_cummax(t):
    price = F.coalesce(F.when(col("o_orderstatus") != "P", col("o_totalprice")), F.lit(0.0))
    return running(t.orders.select(*ORDER, price.alias("x")), [], ORDER, top=("max", "x")).select("o_orderkey", "top")


def rolling(fn, c: str, k: int) -> Column:
    """Trailing value over k rows; null until k rows are there."""
    w = by_date().rowsBetween(-(k - 1), 0)
    return F.when(F.count(c).over(w) == k, fn(c).over(w))


@query("win_rollmean", f"""WITH {DAILY_SQL} SELECT {DAY}, CASE WHEN count(revenue) OVER w = 7 THEN round(avg(revenue) OVER w, 4) END AS m7 FROM daily
WINDOW w AS (ORDER BY d ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def win_rollmean(t):
    return t.daily.select(day(), r(rolling(F.avg, "revenue", 7), 4).alias("m7"))


@query("win_rollsd", f"""WITH {DAILY_SQL} SELECT {DAY}, CASE WHEN count(revenue) OVER w = 7 THEN round(stddev_samp(revenue) OVER w, 2) END AS s7 FROM daily
WINDOW w AS (ORDER BY d ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def win_rollsd(t):
    return t.daily.select(day(), r(rolling(F.stddev_samp, "revenue", 7), 2).alias("s7"))


@query("win_lag_features", f"""WITH {DAILY_SQL}, f AS (SELECT {DAY}, n, lag(n, 1) OVER w AS lag1, lag(n, 7) OVER w AS lag7, lag(n, 30) OVER w AS lag30, lag(n, 365) OVER w AS lag365
FROM daily {DW}) SELECT * FROM f WHERE lag365 IS NOT NULL""")
def win_lag_features(t):
    w = by_date()
    return t.daily.select(day(), "n", *[F.lag("n", k).over(w).alias(f"lag{k}") for k in (1, 7, 30, 365)]).dropna()


@query("win_group_mean", "SELECT p_partkey, p_brand, round(avg(p_retailprice) OVER (PARTITION BY p_brand), 6) AS mean FROM part")
def win_group_mean(t):
    return attach(t.part, ["p_brand"], mean=F.avg("p_retailprice")).select("p_partkey", "p_brand", r(col("mean")).alias("mean"))


@query("win_group_share", """SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY o_orderstatus), 6) AS prop
FROM orders GROUP BY 1, 2""")
def win_group_share(t):
    return share_of(t.orders, ["o_orderstatus", "o_orderpriority"], ["o_orderstatus"]).withColumn("prop", r(col("prop")))


FULL_SQL = f"""{DAILY_SQL}, dates AS (SELECT unnest(generate_series((SELECT min(d) FROM daily)::timestamp, (SELECT max(d) FROM daily)::timestamp, INTERVAL 1 DAY))::date AS d),
full_days AS (SELECT dates.d, n, revenue FROM dates LEFT JOIN (SELECT * FROM daily WHERE {u_sql('d', 'gap')} >= 0.1) g USING (d))"""


def full_days(t) -> DataFrame:
    """Every calendar day; a tenth of the days, drawn by the digest of the date, are gaps."""
    span = t.daily.agg(F.min("d").alias("a"), F.max("d").alias("b"))
    dates = span.select(F.explode(F.sequence("a", "b")).alias("d"))
    return dates.join(t.daily.where(uniform(["d"], "gap") >= 0.1), "d", "left")


@query("win_fill_down", f"""WITH {FULL_SQL} SELECT {DAY}, n, last_value(n IGNORE NULLS) OVER (ORDER BY d ROWS UNBOUNDED PRECEDING) AS filled FROM full_days""")
def win_fill_down(t):
    return running(full_days(t), [], ["d"], filled=("last", "n")).select(day(), "n", "filled")


@query("win_interpolate", f"""WITH {FULL_SQL}, e AS (SELECT d, revenue, last_value(revenue IGNORE NULLS) OVER a AS v0, last_value(CASE WHEN revenue IS NOT NULL THEN d END IGNORE NULLS) OVER a AS d0,
first_value(revenue IGNORE NULLS) OVER b AS v1, first_value(CASE WHEN revenue IS NOT NULL THEN d END IGNORE NULLS) OVER b AS d1 FROM full_days
WINDOW a AS (ORDER BY d ROWS UNBOUNDED PRECEDING), b AS (ORDER BY d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT {DAY}, round(CASE WHEN revenue IS NOT NULL THEN revenue ELSE v0 + (v1 - v0) * (d - d0) / (d1 - d0) END, 4) AS filled FROM e""")
def win_interpolate(t):
    at = F.when(col("revenue").isNotNull(), col("d"))
    back = by_date().rowsBetween(Window.unboundedPreceding, 0)
    ahead = by_date().rowsBetween(0, Window.unboundedFollowing)
    d = full_days(t).withColumns({
        "v0": F.last("revenue", True).over(back), "d0": F.last(at, True).over(back),
        "v1": F.first("revenue", True).over(ahead), "d1": F.first(at, True).over(ahead)})
    line = col("v0") + (col("v1") - col("v0")) * F.datediff("d", "d0") / F.datediff("d1", "d0")
    return d.select(day(), r(F.when(col("revenue").isNotNull(), col("revenue")).otherwise(line), 4).alias("filled"))


@query("win_fill_mean", f"WITH {FULL_SQL} SELECT {DAY}, round(coalesce(revenue, (SELECT avg(revenue) FROM full_days)), 4) AS filled FROM full_days")
def win_fill_mean(t):
    d = attach(full_days(t), [], m=F.avg("revenue"))
    return d.select(day(), r(F.coalesce("revenue", "m"), 4).alias("filled"))


@query("win_since_start", "SELECT o_orderkey, date_diff('day', (SELECT min(o_orderdate) FROM orders), o_orderdate)::int AS days FROM orders")
def win_since_start(t):
    d = attach(t.orders, [], start=F.min("o_orderdate"))
    return d.select("o_orderkey", F.datediff("o_orderdate", "start").alias("days"))
