"""Clusters, their validity, outliers and association rules."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkframe.operators.grouping import group_join, one_row
from larkframe.operators.neighbors import knn
from larkframe.session import materialized

SEED = 7


def kmeans(df: DataFrame, xs: list[str], k: int, seeds: int = 3) -> PipelineModel:
    """Best of several starts by within-cluster sum of squares."""
    fits = [Pipeline(stages=[VectorAssembler(inputCols=xs, outputCol="features"), KMeans(k=k, seed=SEED + s, maxIter=30)]).fit(df) for s in range(seeds)]
    return min(fits, key=lambda m: m.stages[-1].summary.trainingCost)


def labelled(model: PipelineModel, df: DataFrame, name: str = "cluster") -> DataFrame:
    return model.transform(df).select(*df.columns, (F.col("prediction") + 1).alias(name))


def silhouette(df: DataFrame, xs: list[str], cluster: str) -> float:
    """Mean silhouette under squared Euclidean distance, from cluster sums (no pairs of rows)."""
    v = VectorAssembler(inputCols=xs, outputCol="features").transform(df).withColumn("_p", F.col(cluster).cast("double"))
    return ClusteringEvaluator(predictionCol="_p", featuresCol="features").evaluate(v)


def ward_merge(centres: np.ndarray, sizes: np.ndarray, k: int) -> list[int]:
    """Ward's merging of weighted centroids until k groups remain; the input is a bounded list of micro-clusters."""
    groups = [[i] for i in range(len(centres))]
    c, n = [np.array(v, float) for v in centres], [float(s) for s in sizes]
    while len(groups) > k:
        best = None
        for i in range(len(groups)):
            for j in range(i + 1, len(groups)):
                d = n[i] * n[j] / (n[i] + n[j]) * float(((c[i] - c[j]) ** 2).sum())
                if best is None or d < best[0]:
                    best = (d, i, j)
        _, i, j = best
        c[i] = (n[i] * c[i] + n[j] * c[j]) / (n[i] + n[j])
        n[i] += n[j]
        groups[i] += groups[j]
        del groups[j], c[j], n[j]
    label = [0] * len(centres)
    for g, members in enumerate(sorted(groups, key=min), 1):
        for m in members:
            label[m] = g
    return label


def hclust(df: DataFrame, xs: list[str], k: int, micro: int = 40) -> DataFrame:
    """Tree clusters: k-means condenses the rows to micro-clusters, Ward's method merges those."""
    m = kmeans(df, xs, micro, seeds=1)
    rows = labelled(m, df, "micro")
    sizes = {r["micro"]: r["n"] for r in rows.groupBy("micro").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per micro-cluster
    centres = np.array([v for v in m.stages[-1].clusterCenters()])
    lab = ward_merge(centres, np.array([max(1, sizes.get(i + 1, 0)) for i in range(len(centres))]), k)
    table = df.sparkSession.createDataFrame([(i + 1, v) for i, v in enumerate(lab)], "micro int, cluster int")
    return rows.join(F.broadcast(table), "micro").drop("micro")  # one row per micro-cluster


def centroid_table(df: DataFrame, xs: list[str], cluster: str) -> DataFrame:
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"), *[F.avg(x).alias(f"m_{x}") for x in xs], *[F.var_pop(x).alias(f"v_{x}") for x in xs])


def indices(df: DataFrame, xs: list[str], cluster: str) -> dict:
    """Within sum of squares, Calinski-Harabasz, Davies-Bouldin and the centroid form of Dunn's index.

    Cluster sizes, centroids and mean radii are one row per cluster; every index follows from them.
    """
    cen = centroid_table(df, xs, cluster)
    j = group_join(df.select(cluster, *xs), cen, [cluster])
    d2 = sum(((F.col(x) - F.col(f"m_{x}")) * (F.col(x) - F.col(f"m_{x}")) for x in xs[1:]), (F.col(xs[0]) - F.col(f"m_{xs[0]}")) * (F.col(xs[0]) - F.col(f"m_{xs[0]}")))
    radius = {r[cluster]: r["s"] for r in j.groupBy(cluster).agg(F.avg(F.sqrt(d2)).alias("s")).collect()}
    rows = cen.collect()
    k, n = len(rows), sum(r["n"] for r in rows)
    c = np.array([[r[f"m_{x}"] for x in xs] for r in rows])
    size = np.array([r["n"] for r in rows], float)
    s = np.array([radius[r[cluster]] for r in rows])
    wcss = float(sum(r["n"] * sum(r[f"v_{x}"] for x in xs) for r in rows))
    mean = (size[:, None] * c).sum(0) / n
    between = float((size * ((c - mean) ** 2).sum(1)).sum())
    dist = np.sqrt(((c[:, None, :] - c[None, :, :]) ** 2).sum(2))
    np.fill_diagonal(dist, np.inf)
    return {"wcss": wcss, "calinski_harabasz": between / (k - 1) / (wcss / (n - k)), "davies_bouldin": float(((s[:, None] + s[None, :]) / dist).max(1).mean()),
            "dunn": float(dist.min() / (2 * s.max()))}


def adjusted_rand(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row with the adjusted Rand index, from pair counts of the contingency table."""
    pairs = lambda n: n * (n - 1) / 2
    cells = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    side = lambda c: one_row(cells.groupBy(c).agg(F.sum("n").alias("n")), p=F.sum(pairs(F.col("n"))))["p"]
    pa, pb = F.lit(side(a)), F.lit(side(b))
    s = cells.agg(F.sum(pairs(F.col("n"))).alias("both"), F.sum("n").alias("n"))
    expect = pa * pb / pairs(F.col("n"))
    return s.select(F.try_divide(F.col("both") - expect, (pa + pb) / 2 - expect).alias("ari"))


# Outliers

def lof(df: DataFrame, key: str, vec: str, k: int) -> DataFrame:
    """Local outlier factor from exact neighbours: reach distance, local density, ratio of densities."""
    pts = df.select(key, vec)
    near = materialized(knn(pts, pts, k, key=key, vec=vec))
    kd = near.groupBy("qid").agg(F.max("dist").alias("kd"))
    reach = near.join(kd.withColumnRenamed("qid", "nid"), "nid").withColumn("reach", F.greatest("kd", "dist"))
    lrd = materialized(reach.groupBy("qid").agg(F.try_divide(F.count(F.lit(1)).cast("double"), F.sum("reach")).alias("lrd")))
    other = near.join(lrd.select(F.col("qid").alias("nid"), F.col("lrd").alias("other")), "nid").groupBy("qid").agg(F.avg("other").alias("other"))
    # copies of one point have no reach: their density is unbounded and their factor is 1
    return lrd.join(other, "qid").select(F.col("qid").alias(key), F.coalesce(F.try_divide("other", "lrd"), F.lit(1.0)).alias("lof"))


def _grow(x: np.ndarray, rng, depth: int, limit: int) -> list:
    """Isolation tree as nested lists: [column, cut, left, right] or [size]."""
    if depth >= limit or len(x) <= 1 or (x.max(0) == x.min(0)).all():
        return [len(x)]
    j = int(rng.choice(np.flatnonzero(x.max(0) > x.min(0))))
    cut = float(rng.uniform(x[:, j].min(), x[:, j].max()))
    low = x[:, j] < cut
    return [j, cut, _grow(x[low], rng, depth + 1, limit), _grow(x[~low], rng, depth + 1, limit)]


def _path(n: float) -> float:
    return 0.0 if n <= 1 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def _depth(tree: list, x: np.ndarray, idx: np.ndarray, depth: int, out: np.ndarray) -> None:
    if len(tree) == 1:
        out[idx] += depth + _path(tree[0])
        return
    low = x[idx, tree[0]] < tree[1]
    _depth(tree[2], x, idx[low], depth + 1, out)
    _depth(tree[3], x, idx[~low], depth + 1, out)


def tree_samples(df: DataFrame, key: str, xs: list[str], n: int, trees: int, sample: int) -> DataFrame:
    """(tree, key, xs, _h): for every tree its own sample of the whole table, the ``sample`` smallest 64-bit hashes of (key, tree).

    One pass over the rows keeps, per tree, the hashes under a bar that some 1.6 x sample + 50 rows pass whatever n is;
    only those are shuffled. That a tree gets less than its sample is ten deviations away, and the bar is doubled then.
    """
    want = min(sample, n)
    share = min(1.0, (sample + 10 * math.sqrt(sample) + 50) / max(n, 1))
    rows = df.select(key, *[F.col(x).cast("double").alias(x) for x in xs]).withColumn("tree", F.explode(F.sequence(F.lit(1), F.lit(trees))))
    rows = rows.withColumn("_h", F.xxhash64(key, "tree"))
    w = Window.partitionBy("tree").orderBy("_h", key)
    while True:
        under = rows.where(F.col("_h") < int(-(2**63) + share * 2**64)) if share < 1 else rows
        drawn = materialized(under.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= want).drop("_r"))
        if share >= 1 or drawn.groupBy("tree").count().where(F.col("count") == want).count() == trees:
            return drawn
        share *= 2


def isolation_forest(df: DataFrame, key: str, xs: list[str], trees: int = 100, sample: int = 256) -> DataFrame:
    """Isolation score per row. Each tree grows from its own sample of the whole table, the trees in parallel tasks;
    the grown trees (bounded by trees x sample nodes) go back to the scoring tasks."""
    import json

    n = df.count()
    drawn = tree_samples(df, key, xs, n, trees, sample)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values(["_h", key])[xs].to_numpy(float)
        t = int(pdf["tree"].iloc[0])
        grown = _grow(x, np.random.default_rng(t), 0, math.ceil(math.log2(max(2, len(x)))))
        return pd.DataFrame({"tree": [t], "body": [json.dumps(grown)]})

    bodies = drawn.groupBy("tree").applyInPandas(grow, "tree int, body string").orderBy("tree").collect()  # one row per tree
    forest = [json.loads(b["body"]) for b in bodies]
    size = _path(min(sample, n))

    @F.pandas_udf("double")
    def score(*cols: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(float) for c in cols])
        out = np.zeros(len(x))
        for tree in forest:
            _depth(tree, x, np.arange(len(x)), 0, out)
        return pd.Series(2.0 ** (-(out / len(forest)) / size))

    return df.select(key, score(*[F.col(x).cast("double") for x in xs]).alias("score"))
