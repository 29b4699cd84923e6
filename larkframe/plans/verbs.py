"""Filters, projections, row expressions, sorting and sampling."""

from pyspark.sql import types as T

from larkframe.operators import verbs as v
from larkframe.operators.hashing import hash_positions, uniform
from larkframe.operators.ordering import positions
from larkframe.operators.quantiles import quantile_values
from larkframe.plans.base import *
from larkframe.tables import LINE_KEY_SQL, ORDERS_NULLS_SQL, PLACED_SQL, line_key, u_sql

LINE_COLS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def flagship(t: Tables) -> DataFrame:
    joined = (
        t.lineitem.where((col("l_discount") >= 0.02) & (col("l_quantity") > 5))
        .join(t.orders, col("l_orderkey") == col("o_orderkey"))
        .join(t.customer, col("o_custkey") == col("c_custkey"))
        .join(t.nation, col("c_nationkey") == col("n_nationkey"))
    )
    by = (
        joined.groupBy("n_name", "c_mktsegment")
        .agg(F.count(F.lit(1)).alias("n"), r(F.sum(col("l_extendedprice") * (1 - col("l_discount"))), 4).alias("revenue"))
        .where(col("n") >= 2)
    )
    # at most nations x segments rows are ranked
    rank = F.dense_rank().over(Window.partitionBy("c_mktsegment").orderBy(col("revenue").desc()))
    return by.withColumn("place", rank).orderBy("c_mktsegment", "place", "n_name")


@query("join_filter_rank", """
SELECT *, dense_rank() OVER (PARTITION BY c_mktsegment ORDER BY revenue DESC) AS place FROM (
 SELECT n_name, c_mktsegment, count(*) AS n, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
 JOIN nation ON c_nationkey = n_nationkey WHERE l_discount >= 0.02 AND l_quantity > 5 GROUP BY 1, 2 HAVING count(*) >= 2)""")
def join_filter_rank(t):
    return flagship(t)


@query("filter_eq", "SELECT * FROM part WHERE p_type = 'ECONOMY'")
def filter_eq(t):
    return t.part.where(col("p_type") == "ECONOMY")


@query("filter_and", "SELECT * FROM part WHERE p_type = 'ECONOMY' AND p_size > 25")
def filter_and(t):
    return t.part.where((col("p_type") == "ECONOMY") & (col("p_size") > 25))


@query("filter_or", "SELECT * FROM part WHERE p_size < 5 OR p_retailprice > 1050")
def filter_or(t):
    return t.part.where((col("p_size") < 5) | (col("p_retailprice") > 1050))


@query("filter_in", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('P', 'F')")
def filter_in(t):
    return t.orders.where(col("o_orderstatus").isin("P", "F")).select("o_orderkey", "o_orderstatus")


@query("filter_notnull", f"""WITH {ORDERS_NULLS_SQL} SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders_nulls
WHERE o_orderpriority IS NOT NULL AND o_totalprice > 100000 AND o_totalprice < 400000""")
def filter_notnull(t):
    price = col("o_totalprice")
    return t.orders_nulls.where(col("o_orderpriority").isNotNull() & (price > 100000) & (price < 400000)).select(
        "o_orderkey", "o_orderpriority", "o_totalprice")


@query("filter_between", f"SELECT {LINE_COLS}, l_quantity FROM lineitem WHERE l_quantity BETWEEN 10 AND 20")
def filter_between(t):
    return t.lineitem.where(col("l_quantity").between(10, 20)).select(*LINE_COLS.split(", "), "l_quantity")


@query("filter_complex", """SELECT l_orderkey, l_linenumber, l_partkey, o_custkey, l_extendedprice FROM lineitem
JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' AND l_quantity > 30 AND l_discount < 0.05
AND o_orderstatus IN ('O', 'F') ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 20""")
def filter_complex(t):
    lines = t.lineitem.where((col("l_returnflag") == "R") & (col("l_quantity") > 30) & (col("l_discount") < 0.05))
    orders = t.orders.where(col("o_orderstatus").isin("O", "F"))
    return (
        lines.join(orders, col("l_orderkey") == col("o_orderkey"))
        .select("l_orderkey", "l_linenumber", "l_partkey", "o_custkey", "l_extendedprice")
        .orderBy(col("l_extendedprice").desc(), "l_orderkey", "l_linenumber", "l_partkey").limit(20)
    )


@query("filter_by_group_stat", f"""SELECT {LINE_COLS}, round(z, 6) AS z FROM (SELECT *,
 (l_extendedprice - avg(l_extendedprice) OVER w) / stddev_samp(l_extendedprice) OVER w AS z
 FROM lineitem WINDOW w AS (PARTITION BY l_returnflag)) WHERE abs(z) < 1.5""")
def filter_by_group_stat(t):
    d = attach(t.lineitem, ["l_returnflag"], m=F.avg("l_extendedprice"), s=F.stddev_samp("l_extendedprice"))
    z = F.try_divide(col("l_extendedprice") - col("m"), col("s"))
    return d.withColumn("z", z).where(F.abs("z") < 1.5).select(*LINE_COLS.split(", "), r(col("z")).alias("z"))


@query("filter_after_agg", """SELECT o_custkey, count(*) AS n, round(avg(o_totalprice), 6) AS mean_price FROM orders
GROUP BY 1 HAVING count(*) >= 10""")
def filter_after_agg(t):
    g = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), r(F.avg("o_totalprice")).alias("mean_price"))
    return g.where(col("n") >= 10)


@query("select_names", "SELECT p_partkey, p_brand, p_size FROM part")
def select_names(t):
    return t.part.select("p_partkey", "p_brand", "p_size")


@query("select_range", "SELECT p_name, p_brand, p_type, p_size FROM part")
def select_range(t):
    return t.part.select(v.name_range(t.part, "p_name", "p_size"))


@query("select_drop", "SELECT p_partkey, p_type, p_size, p_retailprice FROM part")
def select_drop(t):
    return t.part.drop("p_name", "p_brand")


@query("select_prefix", "SELECT l_linenumber, l_linestatus, l_shipdate, l_discount, l_tax, l_orderkey FROM lineitem")
def select_prefix(t):
    d = t.lineitem
    names = v.starts_with(d, "l_line") + v.ends_with(d, "date") + v.contains(d, "disc") + v.matches(d, "tax$|order")
    return d.select(names)


@query("select_rename", "SELECT p_partkey AS id, p_name AS label, p_retailprice AS price FROM part")
def select_rename(t):
    return t.part.select(col("p_partkey").alias("id"), "p_name", "p_retailprice").withColumnsRenamed(
        {"p_name": "label", "p_retailprice": "price"})


@query("select_everything", "SELECT p_size, p_type, p_partkey, p_name, p_brand, p_retailprice FROM part")
def select_everything(t):
    return t.part.select(v.everything_after(t.part, ["p_size", "p_type"]))


@query("select_where_type", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def select_where_type(t):
    return t.lineitem.select(v.numeric(t.lineitem))


@query("select_where_stat", "SELECT round(avg(l_extendedprice), 4) AS l_extendedprice, count(l_orderkey) AS n FROM lineitem HAVING avg(l_extendedprice) > 20000")
def select_where_stat(t):
    measures = v.where_type(t.lineitem, T.DoubleType)
    means = one_row(t.lineitem, **{c: F.avg(c) for c in measures})
    keep = [c for c in measures if means[c] > 20000]
    return t.lineitem.agg(*[r(F.avg(c), 4).alias(c) for c in keep], F.count("l_orderkey").alias("n"))


@query("select_combined", "SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem")
def select_combined(t):
    d = t.lineitem
    return d.select([c for c in v.numeric(d) if c in v.contains(d, "key")])


@query("select_all_any_of", "SELECT p_partkey, p_size, p_brand FROM part")
def select_all_any_of(t):
    return t.part.select(v.all_of(t.part, ["p_partkey", "p_size"]) + v.any_of(t.part, ["p_brand", "p_colour"]))


@query("mutate_arith", f"""SELECT {LINE_COLS}, l_extendedprice / l_quantity AS unit,
round(l_extendedprice * (1 - l_discount), 4) AS net, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross FROM lineitem""")
def mutate_arith(t):
    d = t.lineitem.withColumn("unit", F.try_divide("l_extendedprice", "l_quantity"))
    d = d.withColumn("net", col("l_extendedprice") * (1 - col("l_discount")))
    d = d.withColumn("gross", col("net") * (1 + col("l_tax")))
    return d.select(*LINE_COLS.split(", "), "unit", r(col("net"), 4).alias("net"), "gross")


@query("case_when", """SELECT p_partkey, CASE WHEN p_size > 40 THEN 'large' WHEN p_size > 20 THEN 'medium' ELSE 'small' END AS size_class FROM part""")
def case_when(t):
    c = F.when(col("p_size") > 40, "large").when(col("p_size") > 20, "medium").otherwise("small")
    return t.part.select("p_partkey", c.alias("size_class"))


@query("if_else", f"""WITH {ORDERS_NULLS_SQL} SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'rush'
WHEN NOT o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'normal' END AS speed FROM orders_nulls""")
def if_else(t):
    rush = col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return t.orders_nulls.select("o_orderkey", v.if_else(rush, "rush", "normal").alias("speed"))


@query("cut_breaks", f"""SELECT {LINE_COLS}, CASE WHEN l_quantity > 0 AND l_quantity <= 10 THEN 'low' WHEN l_quantity > 10 AND l_quantity <= 30
THEN 'mid' WHEN l_quantity > 30 THEN 'high' END AS bin FROM lineitem""")
def cut_breaks(t):
    return t.lineitem.select(*LINE_COLS.split(", "), v.cut(col("l_quantity"), [0, 10, 30, None], ["low", "mid", "high"]).alias("bin"))


@query("cut_quantile", """WITH q AS (SELECT quantile_cont(p_retailprice, 0.25) AS a, quantile_cont(p_retailprice, 0.5) AS b,
quantile_cont(p_retailprice, 0.75) AS c, max(p_retailprice) AS hi, min(p_retailprice) AS lo FROM part)
SELECT p_partkey, CASE WHEN p_retailprice <= a THEN 'Q1' WHEN p_retailprice <= b THEN 'Q2' WHEN p_retailprice <= c THEN 'Q3' ELSE 'Q4' END AS quarter FROM part, q""")
def cut_quantile(t):
    q = quantile_values(t.part, ["p_retailprice"], {"q0": 0, "q1": 0.25, "q2": 0.5, "q3": 0.75, "q4": 1})["p_retailprice"]
    breaks = [q[f"q{i}"] for i in range(5)]
    return t.part.select("p_partkey", v.cut(col("p_retailprice"), breaks, ["Q1", "Q2", "Q3", "Q4"], True).alias("quarter"))


@query("as_factor", """SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN 1 WHEN '3-MEDIUM' THEN 2 WHEN '2-HIGH' THEN 3
WHEN '1-URGENT' THEN 4 END AS level FROM orders""")
def as_factor(t):
    return t.orders.select("o_orderkey", v.factor(col("o_orderpriority"), ["5-LOW", "3-MEDIUM", "2-HIGH", "1-URGENT"]).alias("level"))


@query("coalesce", f"WITH {ORDERS_NULLS_SQL} SELECT o_orderkey, coalesce(o_orderpriority, o_orderstatus, 'none') AS tag FROM orders_nulls")
def coalesce(t):
    return t.orders_nulls.select("o_orderkey", F.coalesce("o_orderpriority", "o_orderstatus", F.lit("none")).alias("tag"))


@query("replace_na", """WITH b AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, CASE WHEN o_totalprice < 300000 THEN o_totalprice END AS price FROM orders)
SELECT o_orderkey, coalesce(status, 'unknown') AS status, round(coalesce(price, (SELECT avg(price) FROM b)), 4) AS price FROM b""")
def replace_na(t):
    b = t.orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"),
                        F.when(col("o_totalprice") < 300000, col("o_totalprice")).alias("price"))
    mean = one_row(b, m=F.avg("price"))["m"]
    return b.fillna({"status": "unknown", "price": mean}).withColumn("price", r(col("price"), 4))


# every customer with its orders: no order for a tenth of the customers, no priority for a tenth of the orders
WITH_GAPS = f"""WITH {PLACED_SQL}, j AS (SELECT c_custkey, o_orderkey, o_orderpriority FROM customer LEFT JOIN placed USING (c_custkey))"""


def with_gaps(t) -> DataFrame:
    return t.customer.select("c_custkey").join(t.placed, "c_custkey", "left").select("c_custkey", "o_orderkey", "o_orderpriority")


@query("drop_na", WITH_GAPS + """
SELECT 'any' AS rule, * FROM j WHERE o_orderkey IS NOT NULL AND o_orderpriority IS NOT NULL
UNION ALL SELECT 'key' AS rule, * FROM j WHERE o_orderkey IS NOT NULL""")
def drop_na(t):
    j = with_gaps(t)
    rule = lambda d, name: d.select(F.lit(name).alias("rule"), "*")
    return rule(j.dropna(), "any").unionByName(rule(j.dropna(subset=["o_orderkey"]), "key"))


@query("across_list", f"""SELECT {LINE_COLS}, ln(l_quantity).round(6) AS l_quantity_log, sqrt(l_quantity).round(6) AS l_quantity_root,
ln(l_extendedprice).round(6) AS l_extendedprice_log, sqrt(l_extendedprice).round(6) AS l_extendedprice_root FROM lineitem""")
def across_list(t):
    fns = {"log": F.ln, "root": F.sqrt}
    return t.lineitem.select(*LINE_COLS.split(", "), *[
        r(f(col(c))).alias(f"{c}_{n}") for c in ("l_quantity", "l_extendedprice") for n, f in fns.items()])


@query("rowwise_cols", f"""SELECT {LINE_COLS}, round((l_quantity + l_discount + l_tax) / 3, 6) AS mean3,
greatest(l_quantity, l_discount, l_tax) AS max3, least(l_quantity, l_discount, l_tax) AS min3 FROM lineitem""")
def rowwise_cols(t):
    cs = ["l_quantity", "l_discount", "l_tax"]
    return t.lineitem.select(*LINE_COLS.split(", "), r(sum(map(col, cs[1:]), col(cs[0])) / 3).alias("mean3"),
                             F.greatest(*cs).alias("max3"), F.least(*cs).alias("min3"))


@query("row_sums", f"""SELECT {LINE_COLS}, round(l_discount + l_tax, 6) AS total, round((l_discount + l_tax) / 2, 6) AS mean FROM lineitem""")
def row_sums(t):
    total = col("l_discount") + col("l_tax")
    return t.lineitem.select(*LINE_COLS.split(", "), r(total).alias("total"), r(total / 2).alias("mean"))


@query("rowwise_list", """SELECT vec_id, len(embedding) AS n, round(list_sum(list_transform(embedding, lambda x: x::double)), 5) AS total,
round(list_avg(list_transform(embedding, lambda x: x::double)), 6) AS mean FROM embeddings""")
def rowwise_list(t):
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    n = F.size("embedding")
    return t.embeddings.select("vec_id", n.alias("n"), r(total, 5).alias("total"), r(total / n).alias("mean"))


@query("mutate_by", "SELECT p_partkey, p_brand, count(*) OVER (PARTITION BY p_brand) AS freq FROM part")
def mutate_by(t):
    return attach(t.part, ["p_brand"], freq=F.count(F.lit(1))).select("p_partkey", "p_brand", "freq")


@query("distinct", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct(t):
    return t.orders.select("o_orderstatus", "o_orderpriority").distinct()


@query("pull_scalar", "SELECT o_orderkey, round(o_totalprice / (SELECT max(o_totalprice) FROM orders), 6) AS rel FROM orders")
def pull_scalar(t):
    top = t.orders.orderBy(col("o_totalprice").desc()).select("o_totalprice").first()[0]
    return t.orders.select("o_orderkey", r(col("o_totalprice") / F.lit(top)).alias("rel"))


@query("glimpse_summary", "\nUNION ALL ".join(f"""SELECT '{c}' AS measure, min({c})::double AS lo, quantile_cont({c}::double, 0.25) AS q1,
quantile_cont({c}::double, 0.5) AS med, round(avg({c}::double), 6) AS mean, quantile_cont({c}::double, 0.75) AS q3, max({c})::double AS hi,
count(*) - count({c}) AS missing FROM part""" for c in ("p_size", "p_retailprice")))
def glimpse_summary(t):
    from larkframe.operators.quantiles import long_form, quantiles_of

    cols = ["p_size", "p_retailprice"]
    q = quantiles_of(t.part, cols, {"q1": 0.25, "med": 0.5, "q3": 0.75})
    s = long_form(t.part, [], cols).groupBy("measure").agg(
        F.min("value").alias("lo"), r(F.avg("value")).alias("mean"), F.max("value").alias("hi"),
        F.count_if(col("value").isNull()).alias("missing"))
    return s.join(q, "measure")


@query("compose_fn", """SELECT event_type, count(*) AS n, round(avg(value * 2 + 1), 6) AS score FROM events WHERE value IS NOT NULL GROUP BY 1""")
def compose_fn(t):
    clean = lambda d: d.dropna(subset=["value"])
    score = lambda d: d.withColumn("score", col("value") * 2 + 1)
    total = lambda d: d.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), r(F.avg("score")).alias("score"))
    return t.events.transform(clean).transform(score).transform(total)


@query("udf_pairwise_ratio", """SELECT o_orderkey, (floor(year(o_orderdate) / 10) * 10)::bigint AS decade, (floor(o_totalprice / 50000) * 50)::bigint AS band FROM orders""")
def udf_pairwise_ratio(t):
    return t.orders.select("o_orderkey", (F.floor(F.year("o_orderdate") / 10) * 10).alias("decade"),
                           (F.floor(col("o_totalprice") / 50000) * 50).alias("band"))


# Sorting and limits. Output order itself is shown by a position column, from range partitions.

@query("arrange", """SELECT p_partkey, p_type, p_retailprice, row_number() OVER (ORDER BY p_type, p_retailprice DESC, p_partkey) AS pos FROM part""")
def arrange(t):
    d = t.part.select("p_partkey", "p_type", "p_retailprice")
    return positions(d, [], [col("p_type").asc_nulls_last(), col("p_retailprice").desc_nulls_last(), col("p_partkey").asc()])


@query("arrange_null_first", WITH_GAPS + """ SELECT *, row_number() OVER (ORDER BY o_orderpriority IS NULL DESC, o_orderpriority, c_custkey, o_orderkey NULLS LAST) AS pos FROM j""")
def arrange_null_first(t):
    p = col("o_orderpriority")
    return positions(with_gaps(t), [], [p.isNull().desc(), p.asc_nulls_last(), col("c_custkey").asc(), col("o_orderkey").asc_nulls_last()])


@query("arrange_custom", """SELECT o_orderkey, o_orderpriority, row_number() OVER (ORDER BY CASE o_orderpriority WHEN '3-MEDIUM' THEN 1 WHEN '1-URGENT' THEN 2
WHEN '5-LOW' THEN 3 END NULLS LAST, o_orderkey) AS pos FROM orders""")
def arrange_custom(t):
    level = v.factor(col("o_orderpriority"), ["3-MEDIUM", "1-URGENT", "5-LOW"])
    return positions(t.orders.select("o_orderkey", "o_orderpriority"), [], [level.asc_nulls_last(), col("o_orderkey").asc()])


@query("head", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 15")
def head(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(col("o_totalprice").desc_nulls_last(), "o_orderkey").limit(15)


@query("tail", "SELECT event_id, event_type, value FROM (SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 12)")
def tail(t):
    last = t.events.orderBy(col("ts").desc(), col("event_id").desc()).limit(12)
    return last.orderBy("ts", "event_id").select("event_id", "event_type", "value")


@query("slice_max", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) = 1")
def slice_max(t):
    # the rank filter is applied before the shuffle as well (window group limit), so hot groups arrive thinned
    w = Window.partitionBy("o_custkey").orderBy(col("o_totalprice").desc())
    return t.orders.withColumn("k", F.rank().over(w)).where(col("k") <= 1).select("o_custkey", "o_orderkey", "o_totalprice")


@query("topk_dense", "SELECT p_type, p_partkey, p_retailprice, dense_rank() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC) AS k FROM part QUALIFY k <= 3")
def topk_dense(t):
    w = Window.partitionBy("p_type").orderBy(col("p_retailprice").desc())
    return t.part.withColumn("k", F.dense_rank().over(w)).where(col("k") <= 3).select("p_type", "p_partkey", "p_retailprice", "k")


@query("sample_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(concat_ws('-', o_orderkey, '42')), o_orderkey LIMIT 500")
def sample_n(t):
    from larkframe.operators.hashing import digest

    return t.orders.select("o_orderkey", "o_totalprice").orderBy(digest(["o_orderkey"], "42"), "o_orderkey").limit(500)


def poisson_copies(u: Column, rate: float, most: int = 40) -> Column:
    """Poisson count from one uniform: the number of cumulative probabilities at or below u."""
    import math

    p, cum, out = math.exp(-rate), 0.0, F.lit(0)
    for k in range(most):
        cum += p
        out = out + (u >= F.lit(cum)).cast("int")
        p *= rate / (k + 1)
    return out


@query("sample_replace")
def sample_replace(t):
    """Each order is drawn Poisson(2) times, so the sample has about twice the rows."""
    copies = poisson_copies(uniform(["o_orderkey"], "draw"), 2.0)
    d = t.orders.select("o_orderkey", "o_totalprice", copies.alias("copies")).where(col("copies") > 0)
    return d.select("o_orderkey", "o_totalprice", F.explode(F.sequence(F.lit(1), col("copies"))).alias("draw"))
