"""Unsupervised learning."""

import numpy as np
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.fpm import FPGrowth
from pyspark.ml.functions import vector_to_array

from larkframe.learning import clustering as cu
from larkframe.learning.features import levels_of
from larkframe.learning.medoids import assigned, k_medoids
from larkframe.learning.resample import bootstraps
from larkframe.operators import hypothesis as hy
from larkframe.operators.components import components
from larkframe.operators.density import dbscan
from larkframe.operators.neighbors import knn
from larkframe.operators.ordering import positions
from larkframe.operators.quantiles import quantiles
from larkframe.plans.base import *
from larkframe.plans.sqltext import f_p_sql
from larkframe.plans.stats import anova_sql, importance
from larkframe.session import materialized
from larkframe.tables import MULTI_SQL, REG_SQL

SEG = ["acct", "orders", "total", "mean_price"]
EX = ["e1", "e2", "e3"]


def segments(t, scaled: bool = True) -> DataFrame:
    """Customers with their order totals, standardised."""
    o = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).cast("double").alias("orders"), F.sum("o_totalprice").alias("total"), F.avg("o_totalprice").alias("mean_price"))
    d = t.customer.join(o, col("c_custkey") == col("o_custkey")).select("c_custkey", col("c_acctbal").alias("acct"), "orders", "total", "mean_price")
    if scaled:
        s = one_row(d, **{f"m_{c}": F.avg(c) for c in SEG}, **{f"s_{c}": F.stddev_samp(c) for c in SEG})
        d = d.withColumns({c: (col(c) - s[f"m_{c}"]) / s[f"s_{c}"] for c in SEG})
    return materialized(d)


def plane(t) -> DataFrame:
    """Customers as points: balance in thousands and order total in hundred thousands."""
    o = t.orders.groupBy("o_custkey").agg(F.sum(F.round(col("o_totalprice") * 100).cast("long")).alias("cents"))
    return t.customer.join(o, col("c_custkey") == col("o_custkey")).select(
        "c_custkey", (col("c_acctbal") / 1000).alias("x"), (F.round(col("cents") / 10000).cast("long") / 1000).alias("y"))


PLANE_SQL = """pl AS (SELECT c_custkey, c_acctbal / 1000 AS x, round(sum(round(o_totalprice * 100)::bigint)::double / 10000)::bigint / 1000 AS y FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_acctbal)"""


@query("un_kmeans")
def un_kmeans(t):
    d = segments(t)
    return cu.labelled(cu.kmeans(d, SEG, 4), d).select("c_custkey", "cluster")


@query("un_elbow")
def un_elbow(t):
    d = segments(t)
    one = one_row(d, v=sum((F.var_pop(c) for c in SEG[1:]), F.var_pop(SEG[0])), n=F.count(F.lit(1)))
    rows = [(1, round(one["v"] * one["n"], 4))] + [(k, round(cu.kmeans(d, SEG, k, seeds=2).stages[-1].summary.trainingCost, 4)) for k in range(2, 7)]
    return t.spark.createDataFrame(rows, "k int, wcss double")


@query("un_silhouette")
def un_silhouette(t):
    d = segments(t)
    rows = [(k, round(cu.silhouette(cu.labelled(cu.kmeans(d, SEG, k, seeds=1), d), SEG, "cluster"), 5)) for k in range(2, 6)]
    return t.spark.createDataFrame(rows, "k int, silhouette double")


@query("un_cluster_profile", f"WITH {MULTI_SQL} " + " UNION ALL ".join(f"SELECT label AS cluster, '{x}' AS variable, count(*) AS n, round(avg({x}), 6) AS mean, round(stddev_samp({x}), 6) AS sd, CASE WHEN avg({x}) > 0.01 THEN 'high' WHEN avg({x}) < -0.01 THEN 'low' ELSE 'middle' END AS level FROM multi GROUP BY 1" for x in EX))
def un_cluster_profile(t):
    from larkframe.operators.quantiles import long_form

    g = long_form(t.multi, ["label"], EX).groupBy(col("label").alias("cluster"), col("measure").alias("variable")).agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), r(F.stddev_samp("value")).alias("sd"))
    level = F.when(col("mean") > 0.01, "high").when(col("mean") < -0.01, "low").otherwise("middle")
    return g.select("cluster", "variable", "n", r(col("mean")).alias("mean"), "sd", level.alias("level"))


@query("un_hclust")
def un_hclust(t):
    return cu.hclust(segments(t), SEG, 4).select("c_custkey", "cluster")


SIGNS = "((e1 > 0)::int * 2 + (e2 > 0)::int)"


def two_labels(t) -> DataFrame:
    return t.multi.withColumn("signs", (col("e1") > 0).cast("int") * 2 + (col("e2") > 0).cast("int"))


@query("un_cluster_crosstab", f"WITH {MULTI_SQL} SELECT cls, " + ", ".join(f"count(*) FILTER ({SIGNS} = {i}) AS s{i}" for i in range(4)) + " FROM multi GROUP BY 1")
def un_cluster_crosstab(t):
    c = two_labels(t).groupBy("cls").pivot("signs", [0, 1, 2, 3]).count().fillna(0)
    return c.toDF("cls", *[f"s{i}" for i in range(4)])


EPS, MIN_PTS = 0.35, 5


@query("un_dbscan", f"""WITH RECURSIVE {PLANE_SQL}, pr AS (SELECT a.c_custkey AS a, b.c_custkey AS b, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d FROM pl a JOIN pl b ON abs(a.x - b.x) <= {EPS} AND abs(a.y - b.y) <= {EPS}),
nb AS (SELECT * FROM pr WHERE d <= {EPS}::double), co AS (SELECT a AS k FROM nb GROUP BY 1 HAVING count(*) >= {MIN_PTS}), ce AS (SELECT a, b FROM nb WHERE a IN (SELECT k FROM co) AND b IN (SELECT k FROM co)),
rc AS (SELECT k AS root, k AS node FROM co UNION SELECT rc.root, ce.b FROM rc JOIN ce ON rc.node = ce.a), lb AS (SELECT node, min(root) AS root FROM rc GROUP BY 1),
bd AS (SELECT a AS node, arg_min(lb.root, (d, b)) AS root FROM nb JOIN lb ON lb.node = nb.b WHERE a NOT IN (SELECT k FROM co) GROUP BY 1),
al AS (SELECT node, root, true AS core FROM lb UNION ALL SELECT node, root, false FROM bd), nm AS (SELECT root, dense_rank() OVER (ORDER BY root) AS cluster FROM (SELECT DISTINCT root FROM lb))
SELECT c_custkey, coalesce(cluster, 0)::int AS cluster, coalesce(core, false) AS core FROM pl LEFT JOIN al ON c_custkey = node LEFT JOIN nm USING (root)""")
def un_dbscan(t):
    return dbscan(plane(t), "c_custkey", "x", "y", EPS, MIN_PTS)


@query("un_knn_dist", """WITH e AS (SELECT vec_id, embedding::double[64] AS v FROM embeddings), k AS (SELECT a.vec_id, array_distance(a.v, b.v) AS d, row_number() OVER (PARTITION BY a.vec_id ORDER BY array_distance(a.v, b.v), b.vec_id) AS k FROM e a JOIN e b ON a.vec_id <> b.vec_id)
SELECT vec_id, round(d, 6) AS dist FROM k WHERE k = 4""")
def un_knn_dist(t):
    d = t.embeddings.select(col("vec_id").alias("id"), F.transform("embedding", lambda x: x.cast("double")).alias("vec"))
    near = knn(d, d, 4).where(col("place") == 4)
    return near.select(col("qid").alias("vec_id"), r(col("dist")).alias("dist")).orderBy("dist")


@query("un_pca_scores")
def un_pca_scores(t):
    """Scores, loadings and variance share of the customer measures in one long table."""
    d = segments(t)
    v = VectorAssembler(inputCols=SEG, outputCol="v").transform(d)
    m = PCA(k=2, inputCol="v", outputCol="pc").fit(v)
    a = vector_to_array("pc")
    scores = m.transform(v).select(F.lit("score").alias("kind"), col("c_custkey").cast("string").alias("name"), r(a[0], 5).alias("pc1"), r(a[1], 5).alias("pc2"))
    load = m.pc.toArray()
    rows = [("loading", x, round(float(load[i, 0]), 5), round(float(load[i, 1]), 5)) for i, x in enumerate(SEG)]
    rows.append(("share", "variance", *[round(float(s), 5) for s in m.explainedVariance.toArray()]))
    return scores.unionByName(t.spark.createDataFrame(rows, "kind string, name string, pc1 double, pc2 double"))


@query("un_zscore_outlier", f"WITH {REG_SQL}, z AS (SELECT key, " + ", ".join(f"abs(({x} - avg({x}) OVER ()) / stddev_samp({x}) OVER ()) AS z_{x}" for x in ("x1", "x2", "y")) + " FROM reg) SELECT key, greatest(z_x1, z_x2, z_y) > 2.2 AS outlier FROM z")
def un_zscore_outlier(t):
    return z_outliers(t.reg, "key", ["x1", "x2", "y"], 2.2)


def z_outliers(d: DataFrame, key: str, xs: list[str], cut: float) -> DataFrame:
    s = one_row(d, **{f"m_{c}": F.avg(c) for c in xs}, **{f"s_{c}": F.stddev_samp(c) for c in xs})
    z = [F.abs((col(c) - s[f"m_{c}"]) / s[f"s_{c}"]) for c in xs]
    return d.select(key, (F.greatest(*z) > cut).alias("outlier"))


@query("un_iforest")
def un_iforest(t):
    s = materialized(cu.isolation_forest(segments(t), "c_custkey", SEG))
    cut = quantiles(s, [], "score", {"q": 0.95}).first()["q"]
    return s.select("c_custkey", r(col("score")).alias("score"), (col("score") > cut).alias("outlier"))


def _lof_sql(k: int) -> str:
    return f"""{PLANE_SQL}, kn0 AS (SELECT a.c_custkey AS q, b.c_custkey AS n, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d FROM pl a JOIN pl b ON a.c_custkey <> b.c_custkey),
kn AS (SELECT q, n, d FROM kn0 QUALIFY row_number() OVER (PARTITION BY q ORDER BY d, n) <= {k}), kd AS (SELECT q, max(d) AS kd FROM kn GROUP BY 1),
lr AS (SELECT kn.q, count(*) / sum(greatest(kd.kd, d)) AS lrd FROM kn JOIN kd ON kn.n = kd.q GROUP BY 1), lof AS (SELECT kn.q AS c_custkey, avg(o.lrd) / max(s.lrd) AS lof FROM kn JOIN lr o ON kn.n = o.q JOIN lr s ON kn.q = s.q GROUP BY 1)"""


def plane_lof(t, k: int) -> DataFrame:
    return cu.lof(plane(t).select("c_custkey", F.array("x", "y").alias("vec")), "c_custkey", "vec", k)


@query("un_lof", f"WITH {_lof_sql(10)} SELECT c_custkey, round(lof, 5) AS lof, lof > 1.5 AS outlier FROM lof")
def un_lof(t):
    return plane_lof(t, 10).select("c_custkey", r(col("lof"), 5).alias("lof"), (col("lof") > 1.5).alias("outlier"))


@query("un_outlier_consensus")
def un_outlier_consensus(t):
    """Rows that at least two of three methods call outliers, and the means of both kinds."""
    p = materialized(plane(t))
    z = z_outliers(p, "c_custkey", ["x", "y"], 2.5).withColumnRenamed("outlier", "z")
    f = materialized(cu.isolation_forest(p, "c_custkey", ["x", "y"]))
    cut = quantiles(f, [], "score", {"q": 0.95}).first()["q"]
    l = cu.lof(p.select("c_custkey", F.array("x", "y").alias("vec")), "c_custkey", "vec", 10).select("c_custkey", (col("lof") > 1.5).alias("l"))
    j = p.join(z, "c_custkey").join(f.select("c_custkey", (col("score") > cut).alias("f")), "c_custkey").join(l, "c_custkey")
    votes = col("z").cast("int") + col("f").cast("int") + col("l").cast("int")
    return j.withColumn("outlier", votes >= 2).groupBy("outlier").agg(F.count(F.lit(1)).alias("n"), r(F.avg("x"), 5).alias("mean_x"), r(F.avg("y"), 5).alias("mean_y"))


BASKET_SQL = """it AS (SELECT p_type, row_number() OVER (ORDER BY p_type) - 1 AS b FROM (SELECT DISTINCT p_type FROM part)),
bk AS (SELECT l_orderkey, bit_or(1::bigint << b::bigint) AS m FROM lineitem JOIN part ON l_partkey = p_partkey JOIN it USING (p_type) GROUP BY 1), nb AS (SELECT count(*) AS n FROM bk), bc AS (SELECT m, count(*) AS k FROM bk GROUP BY 1),
ms AS (SELECT i::bigint AS s FROM range(1, (1 << (SELECT count(*) FROM it)::int)) r(i)), sp AS (SELECT s, sum(k) FILTER (m & s = s) AS c FROM ms, bc GROUP BY 1),
ru AS (SELECT a.s AS lhs, c.s AS rhs, u.c / n AS support, u.c / a.c AS confidence, (u.c / a.c) / (c.c / n) AS lift FROM sp a, sp c, sp u, nb WHERE bit_count(c.s) = 1 AND a.s & c.s = 0 AND u.s = a.s | c.s AND u.c / n >= 0.1 AND u.c / a.c >= 0.4),
nm AS (SELECT s, string_agg(p_type, ',' ORDER BY p_type) AS items FROM ms, it WHERE (s >> b::bigint) & 1 = 1 GROUP BY 1)"""


def baskets(t) -> DataFrame:
    # a basket holds distinct part types, so its size is bounded by their number
    d = t.lineitem.join(t.part, col("l_partkey") == col("p_partkey")).select("l_orderkey", "p_type").distinct()
    return d.groupBy("l_orderkey").agg(F.collect_set("p_type").alias("items"))


def rules(t) -> DataFrame:
    m = FPGrowth(itemsCol="items", minSupport=0.1, minConfidence=0.4).fit(materialized(baskets(t)))
    return m.associationRules


@query("un_apriori", f"WITH {BASKET_SQL} SELECT a.items AS lhs, c.items AS rhs, round(support, 6) AS support, round(confidence, 6) AS confidence, round(lift, 6) AS lift FROM ru JOIN nm a ON a.s = lhs JOIN nm c ON c.s = rhs")
def un_apriori(t):
    side = lambda c: F.array_join(F.sort_array(c), ",")
    return rules(t).select(side("antecedent").alias("lhs"), side("consequent").alias("rhs"), r(col("support")).alias("support"), r(col("confidence")).alias("confidence"), r(col("lift")).alias("lift")).orderBy(col("lift").desc())


@query("un_rule_table", f"WITH {BASKET_SQL} SELECT concat(chr(123), a.items, chr(125), ' => ', chr(123), c.items, chr(125)) AS rule, bit_count(lhs)::int AS size, round(confidence, 6) AS confidence FROM ru JOIN nm a ON a.s = lhs JOIN nm c ON c.s = rhs WHERE lift > 1")
def un_rule_table(t):
    side = lambda c: F.array_join(F.sort_array(c), ",")
    text = F.concat(F.lit("{"), side("antecedent"), F.lit("} => {"), side("consequent"), F.lit("}"))
    return rules(t).where(col("lift") > 1).select(text.alias("rule"), F.size("antecedent").alias("size"), r(col("confidence")).alias("confidence"))


CI_SQL = f"""WITH {MULTI_SQL}, c AS (SELECT cls, count(*) AS n, {', '.join(f'avg({x}) AS m{i}' for i, x in enumerate(EX))}, {' + '.join(f'var_pop({x})' for x in EX)} AS v FROM multi GROUP BY 1),
rd AS (SELECT cls, avg(sqrt({' + '.join(f'pow({x} - m{i}, 2)' for i, x in enumerate(EX))})) AS s FROM multi JOIN c USING (cls) GROUP BY 1),
tt AS (SELECT {', '.join(f'avg({x}) AS t{i}' for i, x in enumerate(EX))}, count(*) AS nn FROM multi), w AS (SELECT sum(n * v) AS wcss, count(*) AS k FROM c), bt AS (SELECT sum(n * ({' + '.join(f'pow(m{i} - t{i}, 2)' for i in range(3))})) AS b FROM c, tt),
pd AS (SELECT a.cls AS a, b.cls AS b, sqrt({' + '.join(f'pow(a.m{i} - b.m{i}, 2)' for i in range(3))}) AS d FROM c a JOIN c b ON a.cls <> b.cls),
db AS (SELECT avg(r) AS db FROM (SELECT a, max((x.s + y.s) / d) AS r FROM pd JOIN rd x ON x.cls = a JOIN rd y ON y.cls = b GROUP BY 1)),
q AS (SELECT a.vec_id, a.cls AS ca, b.cls AS cb, sum({' + '.join(f'pow(a.{x} - b.{x}, 2)' for x in EX)}) AS s, count(*) AS n FROM multi a JOIN multi b ON true GROUP BY 1, 2, 3),
si AS (SELECT vec_id, max(s / (n - 1)) FILTER (ca = cb) AS inn, min(s / n) FILTER (ca <> cb) AS out FROM q GROUP BY 1)
SELECT round((SELECT avg((out - inn) / greatest(out, inn)) FROM si), 5) AS silhouette, round(wcss, 5) AS wcss, round((b / (k - 1)) / (wcss / (nn - k)), 4) AS calinski_harabasz, round(db, 5) AS davies_bouldin, round((SELECT min(d) FROM pd) / (2 * (SELECT max(s) FROM rd)), 5) AS dunn FROM w, bt, tt, db"""


@query("un_cluster_indices", CI_SQL)
def un_cluster_indices(t):
    d = t.multi.select("vec_id", "cls", *EX)
    i = cu.indices(d, EX, "cls")
    row = (round(cu.silhouette(d, EX, "cls"), 5), round(i["wcss"], 5), round(i["calinski_harabasz"], 4), round(i["davies_bouldin"], 5), round(i["dunn"], 5))
    return t.spark.createDataFrame([row], "silhouette double, wcss double, calinski_harabasz double, davies_bouldin double, dunn double")


@query("un_stability", f"""WITH {MULTI_SQL}, c AS (SELECT cls AS a, {SIGNS} AS b, count(*) AS n FROM multi GROUP BY 1, 2), p AS (SELECT sum(n * (n - 1) / 2) AS x, sum(n) AS t FROM c),
ra AS (SELECT sum(n * (n - 1) / 2) AS x FROM (SELECT sum(n) AS n FROM c GROUP BY a)), rb AS (SELECT sum(n * (n - 1) / 2) AS x FROM (SELECT sum(n) AS n FROM c GROUP BY b))
SELECT round((p.x - ra.x * rb.x / (t * (t - 1) / 2)) / ((ra.x + rb.x) / 2 - ra.x * rb.x / (t * (t - 1) / 2)), 6) AS ari FROM p, ra, rb""")
def un_stability(t):
    return cu.adjusted_rand(two_labels(t), "cls", "signs").select(r(col("ari")).alias("ari"))


@query("un_stability_bootstrap")
def un_stability_bootstrap(t):
    """Mean adjusted Rand index between k-means labelings that were fitted on bootstrap samples."""
    d = segments(t)
    b = materialized(bootstraps(d, ["c_custkey"], 3, "stab").join(d, "c_custkey").withColumn("_c", F.explode(F.sequence(F.lit(1).cast("long"), col("times")))))
    lab = d.select("c_custkey", *SEG)
    for i in (1, 2, 3):
        lab = cu.labelled(cu.kmeans(b.where(col("rep") == i), SEG, 3, seeds=1), lab, f"l{i}")
    lab = materialized(lab)
    out = None
    for i, j in ((1, 2), (1, 3), (2, 3)):
        a = cu.adjusted_rand(lab, f"l{i}", f"l{j}")
        out = a if out is None else out.unionByName(a)
    return out.agg(r(F.avg("ari")).alias("stability"), F.count(F.lit(1)).alias("pairs"))


@query("un_gower", """WITH s AS (SELECT s_suppkey, s_nationkey, s_acctbal / (SELECT max(s_acctbal) - min(s_acctbal) FROM supplier) AS a FROM supplier), k AS (SELECT p.s_suppkey, q.s_suppkey AS nid, (abs(p.a - q.a) + (p.s_nationkey <> q.s_nationkey)::int) / 2 AS g,
row_number() OVER (PARTITION BY p.s_suppkey ORDER BY abs(p.a - q.a) + (p.s_nationkey <> q.s_nationkey)::int, q.s_suppkey) AS place FROM s p JOIN s q ON p.s_suppkey <> q.s_suppkey) SELECT s_suppkey, nid, place::int AS place, round(g, 6) AS gower FROM k WHERE place <= 3""")
def un_gower(t):
    """Nearest suppliers under the mixed distance: range-scaled difference and category mismatch, averaged.

    With half indicators per category the distance is a sum of absolute differences, so the exact search applies.
    """
    s = one_row(t.supplier, lo=F.min("s_acctbal"), hi=F.max("s_acctbal"))
    nations = levels_of(t.supplier, "s_nationkey")
    vec = F.array(col("s_acctbal") / (s["hi"] - s["lo"]), *[F.when(col("s_nationkey") == n, 0.5).otherwise(0.0) for n in nations])
    d = t.supplier.select(col("s_suppkey").alias("id"), vec.alias("vec"))
    return knn(d, d, 3, metric="l1").select(col("qid").alias("s_suppkey"), "nid", "place", r(col("dist") / 2).alias("gower"))


# All pairs of rows as medoids: with two clusters the best pair can be found by trying all.
GOWER2_SQL = """s AS (SELECT s_suppkey, s_nationkey, s_acctbal / (SELECT max(s_acctbal) - min(s_acctbal) FROM supplier) AS a FROM supplier),
k AS (SELECT p.s_suppkey AS i, q.s_suppkey AS m, (abs(p.a - q.a) + (p.s_nationkey <> q.s_nationkey)::int) / 2 AS g FROM s p, s q),
c AS (SELECT a.m AS m1, b.m AS m2, sum(least(a.g, b.g)) AS cost FROM k a JOIN k b ON a.i = b.i AND a.m < b.m GROUP BY 1, 2),
best AS (SELECT m1, m2, cost FROM c ORDER BY round(cost, 9), m1, m2 LIMIT 1)"""


@query("un_gower_medoids", f"""WITH {GOWER2_SQL} SELECT a.i AS s_suppkey, CASE WHEN a.g <= b.g THEN m1 ELSE m2 END AS medoid, round(least(a.g, b.g), 6) AS gower, round(cost, 5) AS cost
FROM best JOIN k a ON a.m = m1 JOIN k b ON b.m = m2 AND b.i = a.i""")
def un_gower_medoids(t):
    """Two clusters of suppliers around medoids under the mixed distance, and the total distance of all rows."""
    args = (t.supplier, "s_suppkey", ["s_acctbal"], ["s_nationkey"])
    model = k_medoids(*args, 2, candidates=1024)
    return assigned(*args, model).select("s_suppkey", "medoid", r(col("dist")).alias("gower"), F.lit(round(model.cost, 5)).alias("cost"))


EC_SQL = f"""WITH RECURSIVE {MULTI_SQL}, m AS (SELECT vec_id, label AS a, cls AS b, {SIGNS} AS c FROM multi), tp AS (SELECT DISTINCT a, b, c, a * 100 + b * 10 + c AS id FROM m),
ed AS (SELECT x.id AS i, y.id AS j FROM tp x JOIN tp y ON (x.a = y.a)::int + (x.b = y.b)::int + (x.c = y.c)::int >= 2),
rc AS (SELECT id AS root, id AS node FROM tp UNION SELECT rc.root, ed.j FROM rc JOIN ed ON rc.node = ed.i), lb AS (SELECT node, min(root) AS root FROM rc GROUP BY 1)
SELECT vec_id, root AS consensus FROM m JOIN lb ON a * 100 + b * 10 + c = node"""


@query("un_ensemble_cluster", EC_SQL)
def un_ensemble_cluster(t):
    """Consensus of three labelings: rows that share more than half of their labels, directly or through others.

    Rows with the same three labels agree fully, so the graph is built on the distinct label triples, not on rows.
    """
    m = two_labels(t).select("vec_id", col("label").alias("a"), col("cls").alias("b"), col("signs").alias("c")).withColumn("id", col("a") * 100 + col("b") * 10 + col("c"))
    tp = materialized(m.select("a", "b", "c", "id").distinct())
    edges = None
    for keys in (["a", "b"], ["a", "c"], ["b", "c"]):
        # every triple is tied to the smallest triple that shares the two labels: same components, no pairs
        first = tp.groupBy(*keys).agg(F.min("id").alias("b_"))
        e = tp.join(first, keys).select(col("id").alias("a"), col("b_").alias("b"))
        edges = e if edges is None else edges.unionByName(e)
    lab = components(tp, edges, "id")
    return m.join(lab, "id").select("vec_id", col("label").alias("consensus"))


@query("un_cluster_anova", f"WITH {MULTI_SQL}, {anova_sql('multi', EX, 'cls')} SELECT measure, df1, df2, round(f, 5) AS f, round({f_p_sql('f', 'df1', 'df2')}, 6) AS p, CASE WHEN {f_p_sql('f', 'df1', 'df2')} < 0.001 THEN 'High' WHEN {f_p_sql('f', 'df1', 'df2')} < 0.05 THEN 'Medium' ELSE 'Low' END AS importance FROM an")
def un_cluster_anova(t):
    return importance(hy.anova(t.multi, EX, "cls"))


@query("un_scale_effect")
def un_scale_effect(t):
    a, b = segments(t), segments(t, scaled=False)
    j = cu.labelled(cu.kmeans(a, SEG, 3, seeds=1), a, "scaled").select("c_custkey", "scaled").join(
        cu.labelled(cu.kmeans(b, SEG, 3, seeds=1), b, "raw").select("c_custkey", "raw"), "c_custkey")
    return j.groupBy("scaled", "raw").agg(F.count(F.lit(1)).alias("n"))
