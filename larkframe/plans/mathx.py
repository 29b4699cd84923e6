"""Elementwise math."""

from larkframe.operators.quantiles import quantile_values
from larkframe.plans.base import *
from larkframe.tables import CLS_SCORED_SQL, CLS_SQL

K = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
KS = ", ".join(K)


@query("math_basic", f"""SELECT {KS}, round(sqrt(l_extendedprice), 6) AS root, abs(l_quantity - 25) AS dist, floor(l_extendedprice / 1000)::bigint AS thousands, round(pow(l_quantity, 2), 6) AS sq,
((l_quantity - 25) - 7 * floor((l_quantity - 25) / 7)) AS md, round(l_discount, 1) AS rounded FROM lineitem""")
def math_basic(t):
    q = col("l_quantity")
    return t.lineitem.select(*K, r(F.sqrt("l_extendedprice")).alias("root"), F.abs(q - 25).alias("dist"), F.floor(col("l_extendedprice") / 1000).alias("thousands"),
                             r(F.pow(q, F.lit(2))).alias("sq"), F.pmod(q - 25, F.lit(7.0)).alias("md"), F.round("l_discount", 1).alias("rounded"))


@query("math_log", f"SELECT {KS}, round(ln(l_quantity), 6) AS ln, round(log10(l_quantity), 6) AS l10, round(log2(l_quantity), 6) AS l2, round(exp(l_discount), 6) AS ex FROM lineitem")
def math_log(t):
    q = col("l_quantity")
    return t.lineitem.select(*K, r(F.ln(q)).alias("ln"), r(F.log10(q)).alias("l10"), r(F.log2(q)).alias("l2"), r(F.exp("l_discount")).alias("ex"))


@query("math_trig", "SELECT o_orderkey, round(sin(2 * pi() * month(o_orderdate) / 12), 6) + 0.0 AS s, round(cos(2 * pi() * month(o_orderdate) / 12), 6) + 0.0 AS c FROM orders")
def math_trig(t):
    a = 2 * F.pi() * F.month("o_orderdate") / 12
    return t.orders.select("o_orderkey", (r(F.sin(a)) + 0.0).alias("s"), (r(F.cos(a)) + 0.0).alias("c"))


@query("math_clip", "SELECT c_custkey, greatest(0.0, least(5000.0, c_acctbal)) AS x FROM customer")
def math_clip(t):
    return t.customer.select("c_custkey", F.greatest(F.lit(0.0), F.least(F.lit(5000.0), col("c_acctbal"))).alias("x"))


@query("math_scale", f"SELECT {KS}, round((l_quantity - (SELECT avg(l_quantity) FROM lineitem)) / (SELECT stddev_samp(l_quantity) FROM lineitem), 6) AS z FROM lineitem")
def math_scale(t):
    s = one_row(t.lineitem, m=F.avg("l_quantity"), s=F.stddev_samp("l_quantity"))
    return t.lineitem.select(*K, r((col("l_quantity") - s["m"]) / F.nullif(F.lit(s["s"]), F.lit(0.0))).alias("z"))


@query("math_winsorize", f"""WITH q AS (SELECT quantile_cont(l_extendedprice, 0.05) AS lo, quantile_cont(l_extendedprice, 0.95) AS hi FROM lineitem)
SELECT {KS}, round(greatest(lo, least(hi, l_extendedprice)), 4) AS x FROM lineitem, q""")
def math_winsorize(t):
    q = quantile_values(t.lineitem, ["l_extendedprice"], {"lo": 0.05, "hi": 0.95})["l_extendedprice"]
    return t.lineitem.select(*K, r(F.greatest(F.lit(q["lo"]), F.least(F.lit(q["hi"]), col("l_extendedprice"))), 4).alias("x"))


@query("math_sigmoid_odds", f"WITH {CLS_SCORED_SQL} SELECT doc_id, round(1 / (1 + exp(-f2)), 6) AS sig, round(p / (1 - p), 6) AS odds, round(ln(p / (1 - p)), 6) AS logit FROM cls_scored")
def math_sigmoid_odds(t):
    p = col("p")
    odds = F.try_divide(p, 1 - p)
    return t.cls_scored.select("doc_id", r(1 / (1 + F.exp(-col("f2")))).alias("sig"), r(odds).alias("odds"), r(F.ln(odds)).alias("logit"))


@query("math_entropy_gini", f"""WITH {CLS_SQL}, s AS (SELECT source, avg(event) AS p FROM cls GROUP BY 1)
SELECT source, round(2 * p * (1 - p), 6) AS gini, round(CASE WHEN p IN (0, 1) THEN 0 ELSE -p * log2(p) - (1 - p) * log2(1 - p) END, 6) AS entropy FROM s""")
def math_entropy_gini(t):
    s = t.cls.groupBy("source").agg(F.avg("event").alias("p"))
    p = col("p")
    ent = F.when(p.isin(0.0, 1.0), 0.0).otherwise(-p * F.log2(p) - (1 - p) * F.log2(1 - p))
    return s.select("source", r(2 * p * (1 - p)).alias("gini"), r(ent).alias("entropy"))


@query("math_euclid", """WITH e AS (SELECT label, unnest(embedding)::double AS x, generate_subscripts(embedding, 1) AS i FROM embeddings), c AS (SELECT label, i, avg(x) AS m FROM e GROUP BY 1, 2)
SELECT a.label AS a, b.label AS b, round(sqrt(sum((a.m - b.m) ** 2)), 6) AS dist FROM c a JOIN c b ON a.i = b.i AND a.label < b.label GROUP BY 1, 2""")
def math_euclid(t):
    """Distances between the label means: pairs of labels, never pairs of rows."""
    e = t.embeddings.select("label", F.posexplode("embedding").alias("i", "x"))
    c = e.groupBy("label", "i").agg(F.avg(col("x").cast("double")).alias("m"))
    a, b = c.toDF("a", "i", "ma"), c.toDF("b", "i", "mb")
    j = a.join(b, (a["i"] == b["i"]) & (col("a") < col("b")))
    return j.groupBy("a", "b").agg(r(F.sqrt(F.sum((col("ma") - col("mb")) * (col("ma") - col("mb"))))).alias("dist"))
