"""Chart statistics."""

from itertools import combinations

import numpy as np

from larkframe.learning import models as md
from larkframe.operators import chartstats as cs
from larkframe.operators.moments import collect_moments, correlations
from larkframe.operators.quantiles import long_form
from larkframe.plans.aggregates import MEASURES, cor_pairs
from larkframe.plans.base import *
from larkframe.tables import DAILY_SQL, REG_SQL


@query("viz_hist", """WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, count(*) AS n FROM lineitem), b AS (SELECT least(floor((l_extendedprice - lo) / ((hi - lo) / 30)), 29)::int AS bin, count(*) AS n FROM lineitem, s GROUP BY 1)
SELECT bin, round(lo + bin * ((hi - lo) / 30), 4) AS "left", b.n, round(b.n / (s.n * ((hi - lo) / 30)) * 1000, 6) AS density FROM b, s""")
def viz_hist(t):
    d = cs.histogram(t.lineitem, "l_extendedprice", 30)
    return d.select("bin", r(col("left"), 4).alias("left"), "n", r(col("density") * 1000).alias("density"))


@query("viz_bar", "SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY o_orderstatus), 6) AS share FROM orders GROUP BY 1, 2")
def viz_bar(t):
    return share_of(t.orders, ["o_orderstatus", "o_orderpriority"], ["o_orderstatus"], "share").withColumn("share", r(col("share")))


def density_sql(by: str, points: int) -> str:
    g, j = (f"{by}, ", f"JOIN s USING ({by})") if by else ("", ", s")
    grp = f" GROUP BY {by}" if by else ""
    return f"""WITH s AS (SELECT {g}count(*) AS n, min(value) AS lo, max(value) AS hi, 0.9::double * least(stddev_samp(value), (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) / 1.34::double) * pow(count(*), -0.2::double) AS h FROM events{grp}),
k AS (SELECT {g}i, lo + (hi - lo) * i / {points - 1} AS x, h, n, value FROM events {j}, range({points}) p(i))
SELECT {g}i::int AS i, round(min(x), 4) AS x, round(sum(exp(-0.5::double * pow((x - value) / h, 2)) / (h * sqrt(2 * pi()))) / max(n), 6) AS density FROM k GROUP BY ALL"""


@query("viz_density", density_sql("", 40).replace("GROUP BY ALL", "GROUP BY i"))
def viz_density(t):
    return cs.density(t.events, [], "value", 40).select("i", r(col("x"), 4).alias("x"), r(col("density")).alias("density"))


@query("viz_violin_ridge", density_sql("event_type", 24).replace("GROUP BY ALL", "GROUP BY event_type, i"))
def viz_violin_ridge(t):
    return cs.density(t.events, ["event_type"], "value", 24).select("event_type", "i", r(col("x"), 4).alias("x"), r(col("density")).alias("density"))


@query("viz_boxplot", """WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1, median(l_extendedprice) AS med, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1),
d AS (SELECT *, l_extendedprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM lineitem JOIN q USING (l_returnflag))
SELECT l_returnflag, round(max(q1), 4) AS q1, round(max(med), 4) AS med, round(max(q3), 4) AS q3, min(l_extendedprice) FILTER (inside) AS lo, max(l_extendedprice) FILTER (inside) AS hi, count(*) FILTER (NOT inside) AS outliers FROM d GROUP BY 1""")
def viz_boxplot(t):
    d = cs.boxplot(t.lineitem, ["l_returnflag"], "l_extendedprice")
    return d.select("l_returnflag", *[r(col(c), 4).alias(c) for c in ("q1", "med", "q3")], "lo", "hi", "outliers")


@query("viz_lm_smooth", f"""WITH {REG_SQL}, s AS (SELECT cat, count(*) AS n, avg(x1) AS mx, var_pop(x1) AS vx, min(x1) AS a0, max(x1) AS a1, regr_slope(y, x1) AS b, regr_intercept(y, x1) AS a,
count(*) * (var_pop(y) - regr_slope(y, x1) * covar_pop(x1, y)) / (count(*) - 2) AS s2 FROM reg GROUP BY 1), g AS (SELECT *, a0 + (a1 - a0) * i / 9 AS x FROM s, range(10) p(i)),
f AS (SELECT *, a + b * x AS fit, 1.96::double * sqrt(s2 * (1 / n + pow(x - mx, 2) / (n * vx))) AS half FROM g)
SELECT cat, round(x, 4) AS x, round(fit, 4) AS fit, round(fit - half, 4) AS lo, round(fit + half, 4) AS hi FROM f""")
def viz_lm_smooth(t):
    d = cs.line_fit(t.reg, ["cat"], "y", "x1", 10)
    return d.select("cat", *[r(col(c), 4).alias(c) for c in ("x", "fit", "lo", "hi")])


@query("viz_logit_smooth")
def viz_logit_smooth(t):
    """Event probability along one feature, from a logistic fit, on a grid between its extremes."""
    d = t.cls.select("f2", "event")
    m = md.logistic(d, "event", ["f2"])
    g = d.agg(F.min("f2").alias("lo"), F.max("f2").alias("hi")).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(49))))
    grid = g.select((col("lo") + (col("hi") - col("lo")) * col("i") / 49).alias("f2"))
    return md.predict_prob(m, grid).select(r(col("f2")).alias("f2"), r(col("p_event")).alias("p"))


LOESS_SQL = f"""WITH {DAILY_SQL}, dd AS (SELECT date_diff('day', DATE '1995-01-01', d)::double AS x, revenue / 1000 AS y FROM daily), g AS (SELECT x0 + (x1 - x0) * i / 10 AS g FROM (SELECT min(x) AS x0, max(x) AS x1 FROM dd), range(11) p(i)),
p AS (SELECT g, x, y, abs(x - g) AS dist, row_number() OVER (PARTITION BY g ORDER BY abs(x - g)) AS k, ceil(0.3::double * count(*) OVER (PARTITION BY g)) AS q FROM dd, g),
rr AS (SELECT *, max(dist) FILTER (k = q) OVER (PARTITION BY g) AS radius FROM p), w AS (SELECT g, x - g AS c, y, pow(1 - pow(dist / radius, 3), 3) AS w FROM rr WHERE dist < radius),
s AS (SELECT g, sum(w) AS s0, sum(w * c) AS s1, sum(w * c * c) AS s2, sum(w * y) AS t0, sum(w * c * y) AS t1 FROM w GROUP BY 1)
SELECT g AS x, round((s2 * t0 - s1 * t1) / (s0 * s2 - s1 * s1), 3) AS fit FROM s"""


@query("viz_loess", LOESS_SQL)
def viz_loess(t):
    d = t.daily.select(F.datediff("d", F.lit("1995-01-01").cast("date")).cast("double").alias("x"), (col("revenue") / 1000).alias("y"))
    s = one_row(d, x0=F.min("x"), x1=F.max("x"))
    return cs.loess(d, "x", "y", [s["x0"] + (s["x1"] - s["x0"]) * i / 10 for i in range(11)], 0.3).select("x", r(col("fit"), 3).alias("fit"))


@query("viz_density2d", """WITH s AS (SELECT min(l_quantity) AS x0, max(l_quantity) AS x1, min(l_extendedprice) AS y0, max(l_extendedprice) AS y1, count(*) AS n FROM lineitem),
b AS (SELECT least(floor((l_quantity - x0) / (x1 - x0) * 12), 11)::int AS bx, least(floor((l_extendedprice - y0) / (y1 - y0) * 12), 11)::int AS by_, count(*) AS z FROM lineitem, s GROUP BY 1, 2),
g AS (SELECT gx, gy, sum(z * exp(-0.5::double * pow((gx - bx) / 1.5::double, 2)) * exp(-0.5::double * pow((gy - by_) / 1.5::double, 2)) / (1.5::double * 1.5::double * 2 * pi())) AS z FROM b, range(12) p(gx), range(12) q(gy) GROUP BY 1, 2)
SELECT gx::int AS bx, gy::int AS "by", round(z / n, 6) AS density FROM g, s""")
def viz_density2d(t):
    return cs.density2d(t.lineitem, "l_quantity", "l_extendedprice", 12, 1.5).withColumn("density", r(col("density")))


@query("viz_hex", """WITH s AS (SELECT min(l_quantity) AS x0, max(l_quantity) AS x1, min(l_extendedprice) AS y0, max(l_extendedprice) AS y1 FROM lineitem),
p AS (SELECT (l_quantity - x0) * 20 / (x1 - x0) AS sx, (l_extendedprice - y0) * 20 / (y1 - y0) / sqrt(3) AS sy FROM lineitem, s),
c AS (SELECT sx, sy, floor(sx + 0.5::double) AS i1, floor(sy + 0.5::double) AS j1, floor(sx) AS i2, floor(sy) AS j2 FROM p),
h AS (SELECT CASE WHEN pow(sx - i1, 2) + 3 * pow(sy - j1, 2) <= pow(sx - i2 - 0.5::double, 2) + 3 * pow(sy - j2 - 0.5::double, 2) THEN [2 * i1, 2 * j1] ELSE [2 * i2 + 1, 2 * j2 + 1] END AS h FROM c)
SELECT h[1]::bigint AS hx, h[2]::bigint AS hy, count(*) AS n FROM h GROUP BY 1, 2""")
def viz_hex(t):
    return cs.hexagons(t.lineitem, "l_quantity", "l_extendedprice", 20)


@query("viz_facet", " UNION ALL ".join(f"SELECT l_returnflag, '{c}' AS measure, count(*) AS n, round(avg({c}), 6) AS mean FROM lineitem GROUP BY 1" for c in MEASURES))
def viz_facet(t):
    return long_form(t.lineitem, ["l_returnflag"], MEASURES).groupBy("l_returnflag", "measure").agg(F.count("value").alias("n"), r(F.avg("value")).alias("mean"))


@query("viz_line_band", "SELECT year(o_orderdate)::int AS y, round(avg(o_totalprice), 4) AS mean, round(avg(o_totalprice) - stddev_samp(o_totalprice) / sqrt(count(*)), 4) AS lo, round(avg(o_totalprice) + stddev_samp(o_totalprice) / sqrt(count(*)), 4) AS hi FROM orders GROUP BY 1")
def viz_line_band(t):
    p = "o_totalprice"
    m, se = F.avg(p), F.stddev_samp(p) / F.sqrt(F.count(p))
    return t.orders.groupBy(F.year("o_orderdate").alias("y")).agg(r(m, 4).alias("mean"), r(m - se, 4).alias("lo"), r(m + se, 4).alias("hi"))


@query("viz_area_total", "SELECT year(o_orderdate)::int AS y, o_orderstatus, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1, 2")
def viz_area_total(t):
    return t.orders.groupBy(F.year("o_orderdate").alias("y"), "o_orderstatus").agg(r(F.sum("o_totalprice"), 2).alias("total"))


@query("viz_centroid_labels", "SELECT p_type, round(avg(p_size), 6) AS x, round(avg(p_retailprice), 6) AS y FROM part GROUP BY 1")
def viz_centroid_labels(t):
    return t.part.groupBy("p_type").agg(r(F.avg("p_size")).alias("x"), r(F.avg("p_retailprice")).alias("y"))


@query("viz_top_labels", "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10")
def viz_top_labels(t):
    return t.customer.orderBy(col("c_acctbal").desc(), "c_custkey").limit(10).select("c_custkey", "c_name", "c_acctbal")


@query("viz_pairs", " UNION ALL ".join(f"SELECT '{a}' AS var1, '{b}' AS var2, round(corr({a}, {b}), 6) AS c FROM lineitem" for a, b in combinations(sorted(MEASURES), 2)))
def viz_pairs(t):
    return cor_pairs(t.lineitem, MEASURES).withColumn("c", r(col("c")))


@query("viz_corr_order")
def viz_corr_order(t):
    """Correlation matrix in long form; variables are ordered by their weight in the first component."""
    cols = ["x1", "x2", "x3", "y", "x12"]
    c = correlations(collect_moments(t.reg.withColumn("x12", col("x1") * col("x2")), cols)[None])
    vec = np.linalg.eigh(c)[1][:, -1]
    vec = vec * np.sign(vec[np.argmax(np.abs(vec))])
    place = {cols[i]: int(k) + 1 for k, i in enumerate(np.argsort(-vec, kind="stable"))}
    rows = [(a, b, place[a], place[b], round(float(c[i, j]), 6)) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return t.spark.createDataFrame(rows, "var1 string, var2 string, row int, col int, c double")


@query("viz_ellipse", """WITH e AS (SELECT label, embedding[1]::double AS x, embedding[2]::double AS y FROM embeddings),
m AS (SELECT label, avg(x) AS mx, avg(y) AS my, var_samp(x) AS sxx, var_samp(y) AS syy, covar_samp(x, y) AS sxy FROM e GROUP BY 1),
l AS (SELECT *, (sxx + syy) / 2 + sqrt(pow((sxx - syy) / 2, 2) + sxy * sxy) AS l1, (sxx + syy) / 2 - sqrt(pow((sxx - syy) / 2, 2) + sxy * sxy) AS l2 FROM m)
SELECT label, round(mx, 6) AS mx, round(my, 6) AS my, round(sqrt(5.991464547107979::double * l1), 6) AS major, round(sqrt(5.991464547107979::double * l2), 6) AS minor, round(atan2(l1 - sxx, sxy), 5) AS angle FROM l""")
def viz_ellipse(t):
    """95 % ellipse per group: half axes from the eigenvalues of the 2 x 2 covariance (chi-square quantile 5.991)."""
    e = t.embeddings.select("label", col("embedding")[0].cast("double").alias("x"), col("embedding")[1].cast("double").alias("y"))
    m = e.groupBy("label").agg(F.avg("x").alias("mx"), F.avg("y").alias("my"), F.var_samp("x").alias("sxx"), F.var_samp("y").alias("syy"), F.covar_samp("x", "y").alias("sxy"))
    mid, gap = (col("sxx") + col("syy")) / 2, F.sqrt(F.pow((col("sxx") - col("syy")) / 2, F.lit(2)) + col("sxy") * col("sxy"))
    q = 5.991464547107979
    return m.select("label", r(col("mx")).alias("mx"), r(col("my")).alias("my"), r(F.sqrt(q * (mid + gap))).alias("major"), r(F.sqrt(q * (mid - gap))).alias("minor"),
                    r(F.atan2(mid + gap - col("sxx"), col("sxy")), 5).alias("angle"))


@query("viz_decision_grid")
def viz_decision_grid(t):
    """Class over a 100 x 100 grid spanned by the extremes of two features."""
    d = t.multi.select("e1", "e2", (col("cls") - 1).alias("cls"))
    m = md.tree_class(d, "cls", ["e1", "e2"], depth=4)
    g = d.agg(F.min("e1").alias("x0"), F.max("e1").alias("x1"), F.min("e2").alias("y0"), F.max("e2").alias("y1"))
    steps = F.sequence(F.lit(0), F.lit(99))
    g = g.withColumn("i", F.explode(steps)).withColumn("j", F.explode(steps))
    grid = g.select((col("x0") + (col("x1") - col("x0")) * col("i") / 99).alias("e1"), (col("y0") + (col("y1") - col("y0")) * col("j") / 99).alias("e2"))
    return m.transform(grid).select(r(col("e1")).alias("e1"), r(col("e2")).alias("e2"), (col("prediction") + 1).cast("int").alias("cls"))
