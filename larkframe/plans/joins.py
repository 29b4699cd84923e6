"""Joins, combinations and set operations."""

from functools import reduce

from larkframe.operators.hashing import uniform
from larkframe.operators.reshape import expand, pair_up
from larkframe.plans.base import *
from larkframe.tables import ORDERS_NULLS_SQL, PLACED_SQL, SCORED_SQL, u_sql


def sides(t):
    """All customers and all orders; both have unmatched rows."""
    return t.customer.select("c_custkey", "c_mktsegment"), t.placed.select("c_custkey", "o_orderkey", "o_totalprice")


SIDES = f"""WITH {PLACED_SQL}, c AS (SELECT c_custkey, c_mktsegment FROM customer),
o AS (SELECT c_custkey, o_orderkey, o_totalprice FROM placed)"""


@query("join_inner", SIDES + " SELECT * FROM c JOIN o USING (c_custkey)")
def join_inner(t):
    c, o = sides(t)
    return match_join(c, o, ["c_custkey"])


@query("join_left", SIDES + " SELECT * FROM c LEFT JOIN o USING (c_custkey)")
def join_left(t):
    c, o = sides(t)
    return match_join(c, o, ["c_custkey"], "left")


@query("join_right", SIDES + " SELECT * FROM c RIGHT JOIN o USING (c_custkey)")
def join_right(t):
    c, o = sides(t)
    return match_join(c, o, ["c_custkey"], "right")


@query("join_full", SIDES + " SELECT * FROM c FULL JOIN o USING (c_custkey)")
def join_full(t):
    c, o = sides(t)
    return match_join(c, o, ["c_custkey"], "full")


@query("join_semi", SIDES + " SELECT * FROM c WHERE c_custkey IN (SELECT c_custkey FROM o)")
def join_semi(t):
    c, o = sides(t)
    return match_join(c, o, ["c_custkey"], "left_semi")


@query("join_anti", SIDES + " SELECT * FROM c WHERE c_custkey NOT IN (SELECT c_custkey FROM o)")
def join_anti(t):
    c, o = sides(t)
    return match_join(c, o, ["c_custkey"], "left_anti")


@query("join_null_keys", f"""WITH {ORDERS_NULLS_SQL}, p AS (SELECT o_orderpriority, count(*) AS n FROM orders_nulls GROUP BY 1)
SELECT a.o_orderkey, a.o_orderpriority, p.n FROM orders_nulls a JOIN p ON a.o_orderpriority IS NOT DISTINCT FROM p.o_orderpriority""")
def join_null_keys(t):
    d = t.orders_nulls
    p = d.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return match_join(d, p, ["o_orderpriority"]).select("o_orderkey", "o_orderpriority", "n")


@query("join_anti_all", f"SELECT * FROM orders WHERE {u_sql('o_orderkey', 'picked')} >= 0.75")
def join_anti_all(t):
    # the rows that a draw of three quarters left over
    picked = t.orders.where(uniform(["o_orderkey"], "picked") < 0.75)
    return match_join(t.orders, picked, t.orders.columns, "left_anti")


@query("join_multi_key", """WITH k AS (SELECT *, year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS dd FROM orders),
s AS (SELECT y, m, dd, count(*) AS n FROM k WHERE o_orderstatus = 'F' GROUP BY ALL)
SELECT o_orderkey, y, m, dd, n FROM k LEFT JOIN s USING (y, m, dd)""")
def join_multi_key(t):
    d = t.orders.select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"),
                        F.dayofmonth("o_orderdate").alias("dd"))
    s = d.where(col("o_orderstatus") == "F").groupBy("y", "m", "dd").agg(F.count(F.lit(1)).alias("n"))
    return d.join(s, ["y", "m", "dd"], "left").select("o_orderkey", "y", "m", "dd", "n")


@query("join_chain", """SELECT n_name, count(o_orderkey) AS orders, round(coalesce(sum(o_totalprice), 0), 2) AS total,
CASE WHEN coalesce(sum(o_totalprice), 0) > 10000000 THEN 'high' WHEN coalesce(sum(o_totalprice), 0) > 1000000 THEN 'medium' ELSE 'low' END AS level
FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1""")
def join_chain(t):
    # orders collapse to one row per customer before the star join
    per = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("k"), F.sum("o_totalprice").alias("s"))
    j = t.nation.join(t.customer, col("n_nationkey") == col("c_nationkey"), "left").join(per, col("c_custkey") == col("o_custkey"), "left")
    g = j.groupBy("n_name").agg(F.coalesce(F.sum("k"), F.lit(0)).alias("orders"), F.coalesce(F.sum("s"), F.lit(0.0)).alias("total"))
    level = F.when(col("total") > 10000000, "high").when(col("total") > 1000000, "medium").otherwise("low")
    return g.select("n_name", "orders", r(col("total"), 2).alias("total"), level.alias("level"))


@query("join_summary_four", """WITH a AS (SELECT l_suppkey, count(*) AS lines, round(avg(l_quantity), 6) AS qty, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1),
b0 AS (SELECT l_suppkey, p_type, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
b AS (SELECT * FROM b0 QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, p_type) = 1)
SELECT s_suppkey, n_name, lines, qty, parts, p_type AS top_type, n AS top_n FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN a ON s_suppkey = a.l_suppkey JOIN b ON s_suppkey = b.l_suppkey""")
def join_summary_four(t):
    a = t.lineitem.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("lines"), r(F.avg("l_quantity")).alias("qty"), F.countDistinct("l_partkey").alias("parts"))
    types = t.lineitem.join(t.part, col("l_partkey") == col("p_partkey")).groupBy("l_suppkey", "p_type").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("l_suppkey").orderBy(col("n").desc(), "p_type")
    b = types.withColumn("k", F.row_number().over(w)).where(col("k") == 1).select("l_suppkey", col("p_type").alias("top_type"), col("n").alias("top_n"))
    s = t.supplier.join(t.nation, col("s_nationkey") == col("n_nationkey"))
    return a.join(b, "l_suppkey").join(s, col("l_suppkey") == col("s_suppkey")).select("s_suppkey", "n_name", "lines", "qty", "parts", "top_type", "top_n")


@query("join_reduce_full", """WITH a AS (SELECT c_nationkey AS k, count(*) AS customers FROM customer GROUP BY 1),
b AS (SELECT s_nationkey AS k, count(*) AS suppliers FROM supplier GROUP BY 1),
c AS (SELECT c_nationkey AS k, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
SELECT k, customers, suppliers, orders FROM a FULL JOIN b USING (k) FULL JOIN c USING (k)""")
def join_reduce_full(t):
    n = lambda d, key, name: d.groupBy(col(key).alias("k")).agg(F.count(F.lit(1)).alias(name))
    frames = [
        n(t.customer, "c_nationkey", "customers"),
        n(t.supplier, "s_nationkey", "suppliers"),
        n(t.orders.join(t.customer, col("o_custkey") == col("c_custkey")), "c_nationkey", "orders"),
    ]
    return reduce(lambda a, b: a.join(b, "k", "full"), frames)


@query("join_sql_left_agg", f"""WITH {PLACED_SQL} SELECT c_custkey, c_name, count(o_orderkey) AS n, round(coalesce(sum(o_totalprice), 0), 2) AS total FROM customer
LEFT JOIN placed USING (c_custkey) GROUP BY 1, 2""")
def join_sql_left_agg(t):
    per = t.placed.groupBy("c_custkey").agg(
        F.count("o_orderkey").alias("n"), F.sum("o_totalprice").alias("total"))
    d = t.customer.join(per, "c_custkey", "left").fillna({"n": 0, "total": 0.0})
    return d.select("c_custkey", "c_name", "n", r(col("total"), 2).alias("total"))


@query("join_lookup_default", f"""WITH c AS (SELECT c_custkey, CASE WHEN {u_sql('c_custkey', 'unknown')} < 0.1 THEN -1 ELSE c_nationkey END AS k FROM customer)
SELECT c_custkey, coalesce(n_name, 'elsewhere') AS place FROM c LEFT JOIN nation ON k = n_nationkey""")
def join_lookup_default(t):
    k = F.when(uniform(["c_custkey"], "unknown") < 0.1, -1).otherwise(col("c_nationkey"))
    j = t.customer.select("c_custkey", k.alias("k")).join(t.nation, col("k") == col("n_nationkey"), "left")
    return j.select("c_custkey", F.coalesce("n_name", F.lit("elsewhere")).alias("place"))


@query("join_baseline", f"""WITH {SCORED_SQL}, e AS (SELECT year(ship) AS y, sqrt(avg(pow(y - pred, 2))) AS rmse, avg(abs(y - pred)) AS mae FROM scored GROUP BY 1),
b AS (SELECT sqrt(avg(pow(y - pred, 2))) AS rmse, avg(abs(y - pred)) AS mae FROM scored),
l AS (SELECT y, 'rmse' AS metric, rmse AS v FROM e UNION ALL SELECT y, 'mae', mae FROM e), bl AS (SELECT 'rmse' AS metric, rmse AS base FROM b UNION ALL SELECT 'mae', mae FROM b)
SELECT y, metric, round(v, 6) AS v, round(base, 6) AS base, round((v - base) / base * 100, 4) AS change FROM l JOIN bl USING (metric)""")
def join_baseline(t):
    e = col("y") - col("pred")
    d = t.scored.select(F.year("ship").alias("yr"), e.alias("e"))
    aggs = [F.sqrt(F.avg(col("e") * col("e"))).alias("rmse"), F.avg(F.abs("e")).alias("mae")]
    now = d.groupBy("yr").agg(*aggs).unpivot(["yr"], ["rmse", "mae"], "metric", "v")
    base = d.agg(*aggs).unpivot([], ["rmse", "mae"], "metric", "base")
    return now.join(base, "metric").select(col("yr").cast("bigint").alias("y"), "metric", r(col("v")).alias("v"), r(col("base")).alias("base"),
                                           r((col("v") - col("base")) / col("base") * 100, 4).alias("change"))


@query("cross_grid", "SELECT * FROM (SELECT DISTINCT c_mktsegment FROM customer), (SELECT r_name FROM region)")
def cross_grid(t):
    return pair_up(t.customer.select("c_mktsegment").distinct(), t.region.select("r_name"), ["r_name"]).orderBy("c_mktsegment", "r_name")


@query("expand_cols", "SELECT * FROM (SELECT DISTINCT o_orderstatus FROM orders), (SELECT DISTINCT o_orderpriority FROM orders)")
def expand_cols(t):
    return expand(t.orders, "o_orderstatus", "o_orderpriority")


@query("expand_nesting", "SELECT DISTINCT p_brand, p_type FROM part")
def expand_nesting(t):
    return t.part.select("p_brand", "p_type").distinct()


@query("bind_cols", f"WITH {SCORED_SQL} SELECT key, round(y, 6) AS truth, round(pred, 6) AS pred FROM scored")
def bind_cols(t):
    # columns of two tables meet on the row key; Spark rows have no position
    truth = t.reg.select("key", r(col("y")).alias("truth"))
    return truth.join(t.scored.select("key", r(col("pred")).alias("pred")), "key")


@query("self_pair_join", """SELECT a.label AS label, count(*) AS pairs, round(sum(array_distance(a.e, b.e) ** 2), 4) AS spread FROM
(SELECT vec_id, label, embedding::double[64] AS e FROM embeddings) a JOIN (SELECT vec_id, label, embedding::double[64] AS e FROM embeddings) b
ON a.label = b.label AND a.vec_id < b.vec_id GROUP BY 1""")
def self_pair_join(t):
    """Number of pairs i < j with equal label and the sum of their squared distances.

    No pair is formed: with n rows, n(n-1)/2 pairs have total squared distance n * sum(x^2) - (sum x)^2 per element.
    """
    e = t.embeddings.select("label", F.posexplode("embedding").alias("i", "x")).withColumn("x", col("x").cast("double"))
    per = e.groupBy("label", "i").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("s"), F.sum(col("x") * col("x")).alias("q"))
    return per.groupBy("label").agg((F.max("n") * (F.max("n") - 1) / 2).cast("long").alias("pairs"),
                                    r(F.sum(col("n") * col("q") - col("s") * col("s")), 4).alias("spread"))


# Set operations

@query("bind_rows", "SELECT o_orderkey, o_custkey, NULL::double AS o_totalprice FROM orders UNION ALL SELECT o_orderkey, NULL, o_totalprice FROM orders")
def bind_rows(t):
    a, b = t.orders.select("o_orderkey", "o_custkey"), t.orders.select("o_orderkey", "o_totalprice")
    return a.unionByName(b, allowMissingColumns=True)


@query("bind_rows_id", "SELECT 'orders' AS g, o_orderkey FROM orders UNION ALL SELECT 'lines', l_orderkey FROM lineitem")
def bind_rows_id(t):
    frames = {"orders": t.orders.select("o_orderkey"), "lines": t.lineitem.select(col("l_orderkey").alias("o_orderkey"))}
    return reduce(DataFrame.unionByName, [d.select(F.lit(g).alias("g"), "o_orderkey") for g, d in frames.items()])


@query("set_intersect", f"""WITH {PLACED_SQL} SELECT o_custkey FROM orders INTERSECT SELECT c_custkey FROM placed
INTERSECT SELECT c_custkey FROM customer""")
def set_intersect(t):
    return reduce(DataFrame.intersect, [t.orders.select("o_custkey"), t.placed.select("c_custkey"), t.customer.select("c_custkey")])


@query("set_union", "SELECT p_type AS level FROM part UNION SELECT p_brand FROM part")
def set_union(t):
    return t.part.select(col("p_type").alias("level")).union(t.part.select("p_brand")).distinct()


@query("set_diff", f"WITH {PLACED_SQL} SELECT c_custkey AS k FROM customer EXCEPT SELECT c_custkey FROM placed")
def set_diff(t):
    return t.customer.select(col("c_custkey").alias("k")).subtract(t.placed.select("c_custkey"))
