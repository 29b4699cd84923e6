"""Whole-table and grouped aggregates."""

from itertools import combinations

from larkframe.operators.moments import collect_moments, correlations
from larkframe.operators.ordering import running
from larkframe.operators.quantiles import long_form, quantiles, quantiles_of
from larkframe.operators.reshape import paste
from larkframe.plans.base import *
from larkframe.tables import DAILY_SQL, PLACED_SQL

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def guarded_corr(x: str, y: str) -> Column:
    """Pearson correlation; a constant side gives null instead of a division error."""
    return F.when((F.var_pop(x) > 0) & (F.var_pop(y) > 0), F.covar_pop(x, y)) / F.when(
        (F.var_pop(x) > 0) & (F.var_pop(y) > 0), F.stddev_pop(x) * F.stddev_pop(y))


@query("agg_basic", """SELECT count(*) AS n, round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS sd,
min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem""")
def agg_basic(t):
    q = "l_quantity"
    return t.lineitem.agg(F.count(F.lit(1)).alias("n"), r(F.avg(q)).alias("mean"), r(F.stddev_samp(q)).alias("sd"),
                          F.min(q).alias("lo"), F.max(q).alias("hi"))


@query("agg_sum_median_pct", """SELECT round(sum(l_extendedprice), 2) AS total, round(median(l_extendedprice), 4) AS med,
round(avg((l_quantity > 25)::int) * 100, 6) AS pct FROM lineitem""")
def agg_sum_median_pct(t):
    p = "l_extendedprice"
    med = quantiles(t.lineitem, [], p, {"med": 0.5}).first()["med"]
    return t.lineitem.agg(r(F.sum(p), 2).alias("total"), r(F.lit(med), 4).alias("med"),
                          r(F.avg((col("l_quantity") > 25).cast("double")) * 100).alias("pct"))


@query("agg_group", "SELECT p_type, count(*) AS n, round(avg(p_retailprice), 6) AS mean, max(p_size) AS hi FROM part GROUP BY 1")
def agg_group(t):
    return t.part.groupBy("p_type").agg(F.count(F.lit(1)).alias("n"), r(F.avg("p_retailprice")).alias("mean"), F.max("p_size").alias("hi"))


@query("agg_multi", "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS qty, round(avg(l_discount), 6) AS disc FROM lineitem GROUP BY 1, 2")
def agg_multi(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), r(F.sum("l_quantity"), 2).alias("qty"), r(F.avg("l_discount")).alias("disc"))


@query("agg_n_distinct", "SELECT o_orderstatus, count(DISTINCT o_custkey) AS customers, count(DISTINCT o_orderdate) AS days FROM orders GROUP BY 1")
def agg_n_distinct(t):
    return t.orders.groupBy("o_orderstatus").agg(F.countDistinct("o_custkey").alias("customers"), F.countDistinct("o_orderdate").alias("days"))


@query("agg_weighted_mean", "SELECT l_returnflag, round(sum(l_discount * l_quantity) / sum(l_quantity), 6) AS wmean FROM lineitem GROUP BY 1")
def agg_weighted_mean(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        r(F.try_divide(F.sum(col("l_discount") * col("l_quantity")), F.sum("l_quantity"))).alias("wmean"))


@query("agg_cor", """SELECT l_linestatus, round(corr(l_quantity, l_extendedprice), 6) AS c, NULL::double AS constant FROM lineitem GROUP BY 1""")
def agg_cor(t):
    d = t.lineitem.withColumn("one", F.lit(1.0))
    return d.groupBy("l_linestatus").agg(r(guarded_corr("l_quantity", "l_extendedprice")).alias("c"),
                                         guarded_corr("l_quantity", "one").alias("constant"))


@query("agg_quantile", "SELECT event_type, " + ", ".join(f"round(quantile_cont(value, {p}), 6) AS p{int(p * 100)}" for p in (0.05, 0.25, 0.5, 0.95)) + " FROM events GROUP BY 1")
def agg_quantile(t):
    q = quantiles(t.events, ["event_type"], "value", {"p5": 0.05, "p25": 0.25, "p50": 0.5, "p95": 0.95})
    return q.select("event_type", *[r(col(c)).alias(c) for c in ("p5", "p25", "p50", "p95")])


@query("agg_iqr_mad", """WITH m AS (SELECT *, median(value) OVER (PARTITION BY event_type) AS med FROM events)
SELECT event_type, round(quantile_cont(value, 0.75) - quantile_cont(value, 0.25), 6) AS iqr, round(1.4826::double * median(abs(value - med)), 6) AS mad FROM m GROUP BY 1""")
def agg_iqr_mad(t):
    q = quantiles(t.events, ["event_type"], "value", {"a": 0.25, "med": 0.5, "b": 0.75})
    dev = group_join(t.events, q, ["event_type"]).withColumn("dev", F.abs(col("value") - col("med")))
    mad = quantiles(dev, ["event_type"], "dev", {"m": 0.5})
    return match_join(q, mad, ["event_type"]).select("event_type", r(col("b") - col("a")).alias("iqr"), r(1.4826 * col("m")).alias("mad"))


@query("agg_range", "SELECT p_brand, max(p_retailprice) - min(p_retailprice) AS spread FROM part GROUP BY 1")
def agg_range(t):
    return t.part.groupBy("p_brand").agg((F.max("p_retailprice") - F.min("p_retailprice")).alias("spread"))


@query("agg_cv_se", "SELECT l_returnflag, round(stddev_samp(l_quantity) / avg(l_quantity), 6) AS cv, round(stddev_samp(l_quantity) / sqrt(count(l_quantity)), 6) AS se FROM lineitem GROUP BY 1")
def agg_cv_se(t):
    q = "l_quantity"
    return t.lineitem.groupBy("l_returnflag").agg(r(F.try_divide(F.stddev_samp(q), F.avg(q))).alias("cv"),
                                                  r(F.stddev_samp(q) / F.sqrt(F.count(q))).alias("se"))


@query("agg_skewness", """WITH m AS (SELECT *, avg(l_extendedprice) OVER (PARTITION BY l_returnflag) AS mu FROM lineitem)
SELECT l_returnflag, round(avg(pow(l_extendedprice - mu, 3)) / pow(avg(pow(l_extendedprice - mu, 2)), 1.5), 6) AS skew FROM m GROUP BY 1""")
def agg_skewness(t):
    return t.lineitem.groupBy("l_returnflag").agg(r(F.skewness("l_extendedprice")).alias("skew"))


@query("agg_string", """WITH d AS (SELECT DISTINCT p_type, p_brand FROM part),
n AS (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_brand) - 1 AS i FROM d)
SELECT p_type, (i // 1000)::bigint AS part_no, string_agg(p_brand, ', ' ORDER BY p_brand) AS brands FROM n GROUP BY 1, 2""")
def agg_string(t):
    return paste(t.part.select("p_type", "p_brand").distinct(), ["p_type"], "p_brand", ["p_brand"], ", ", "brands")


@query("agg_cond_count", f"""WITH {PLACED_SQL} SELECT c_custkey, count(o_orderkey) AS n, count(*) FILTER (o_totalprice > 480000) AS top FROM customer
LEFT JOIN placed USING (c_custkey) GROUP BY 1""")
def agg_cond_count(t):
    per = t.placed.groupBy("c_custkey").agg(F.count("o_orderkey").alias("n"), F.count_if(col("o_totalprice") > 480000).alias("top"))
    return t.customer.select("c_custkey").join(per, "c_custkey", "left").fillna(0, ["n", "top"])


@query("agg_by_flag_mean", "SELECT event_type, round(avg((value > 20)::int), 6) AS rate FROM events GROUP BY 1")
def agg_by_flag_mean(t):
    return t.events.groupBy("event_type").agg(r(F.avg((col("value") > 20).cast("double"))).alias("rate"))


@query("count_keys", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2")
def count_keys(t):
    return t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n")).orderBy("o_orderstatus", "o_orderpriority")


@query("count_prop", "SELECT o_orderpriority, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS prop FROM orders GROUP BY 1")
def count_prop(t):
    return share_of(t.orders, ["o_orderpriority"], []).withColumn("prop", r(col("prop")))


@query("agg_across", "\nUNION ALL ".join(f"""SELECT c_mktsegment, '{c}' AS variable, round(avg({c}::double), 4) AS mean, round(stddev_samp({c}::double), 4) AS sd
FROM customer GROUP BY 1""" for c in ("c_acctbal", "c_nationkey")))
def agg_across(t):
    cols = ["c_acctbal", "c_nationkey"]
    wide = t.customer.groupBy("c_mktsegment").agg(
        *[r(f(c), 4).alias(f"{c}__{n}") for c in cols for n, f in (("mean", F.avg), ("sd", F.stddev_samp))])
    return wide.select("c_mktsegment", F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"), col(f"{c}__mean").alias("mean"), col(f"{c}__sd").alias("sd")) for c in cols])).alias("s")
    ).select("c_mktsegment", "s.*")


@query("agg_profile_long", "\nUNION ALL ".join(f"""SELECT '{c}' AS measure, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS sd,
min({c}) AS lo, max({c}) AS hi FROM lineitem""" for c in MEASURES))
def agg_profile_long(t):
    return long_form(t.lineitem, [], MEASURES).groupBy("measure").agg(
        r(F.avg("value")).alias("mean"), r(F.stddev_samp("value")).alias("sd"), F.min("value").alias("lo"), F.max("value").alias("hi"))


@query("agg_crosstab", """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O",
count(*) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1""")
def agg_crosstab(t):
    return t.orders.groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).count().fillna(0)


COR_SQL = "\nUNION ALL ".join(f"SELECT '{a}' AS var1, '{b}' AS var2, corr({a}, {b}) AS c FROM x" for a, b in combinations(["l_discount", "l_extendedprice", "l_quantity", "l_tax", "net"], 2))
COR_CTE = "WITH x AS (SELECT *, l_extendedprice * (1 - l_discount) AS net FROM lineitem), m AS (" + COR_SQL + ")"


def cor_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """Upper triangle of the correlation matrix in long form, from one aggregation."""
    cols = sorted(cols)
    pairs = list(combinations(cols, 2))
    wide = df.agg(*[guarded_corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), col(f"c{i}").alias("c")) for i, (a, b) in enumerate(pairs)])).alias("s")).select("s.*")


def _net(t):
    return t.lineitem.withColumn("net", col("l_extendedprice") * (1 - col("l_discount")))


@query("agg_cor_matrix", COR_CTE + " SELECT var1, var2, round(c, 6) AS c FROM m")
def agg_cor_matrix(t):
    return cor_pairs(_net(t), MEASURES + ["net"]).withColumn("c", r(col("c")))


@query("agg_high_cor_pairs", COR_CTE + " SELECT var1, var2, round(c, 6) AS c FROM m WHERE abs(c) > 0.8")
def agg_high_cor_pairs(t):
    return cor_pairs(_net(t), MEASURES + ["net"]).where(F.abs("c") > 0.8).orderBy(F.abs("c").desc()).withColumn("c", r(col("c")))


@query("agg_distinct_ratio", """WITH q AS (SELECT median(p_retailprice) AS m FROM part)
SELECT p_retailprice > m AS dear, p_type, count(DISTINCT p_brand) AS brands, round(count(DISTINCT p_brand) / count(*), 6) AS ratio FROM part, q GROUP BY 1, 2""")
def agg_distinct_ratio(t):
    m = quantiles(t.part, [], "p_retailprice", {"m": 0.5}).first()["m"]
    return t.part.groupBy((col("p_retailprice") > m).alias("dear"), "p_type").agg(
        F.countDistinct("p_brand").alias("brands"), r(F.countDistinct("p_brand") / F.count(F.lit(1))).alias("ratio"))


@query("agg_argmax", f"WITH {DAILY_SQL} SELECT year(d) AS y, cast(arg_max(d, (revenue, -epoch(d))) AS varchar) AS best, max(revenue) AS revenue FROM daily GROUP BY 1")
def agg_argmax(t):
    first = F.struct("revenue", -F.unix_date("d"))
    return t.daily.groupBy(F.year("d").alias("y")).agg(F.max_by(col("d"), first).cast("string").alias("best"), F.max("revenue").alias("revenue"))
