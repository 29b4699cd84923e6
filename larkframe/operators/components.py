"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkframe.session import new_folder


def _written(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder. Reading it back starts a fresh plan, so rounds cost the same."""
    path = new_folder(df.sparkSession, "components")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(nodes: DataFrame, edges: DataFrame, node: str = "node", max_rounds: int = 100) -> DataFrame:
    """(node, label) with the smallest node of each component as its label.

    Every node points at a smaller node. A round looks at the grandparents of the neighbours, hangs the node and its
    parent under the smallest of them, and shortens the way to the root (the FastSV scheme of Zhang, Azad and Hu 2020),
    so the number of rounds grows with the logarithm of the longest chain. Minima combine map-side, so a node with very
    many edges is no hot spot.
    """
    both = _written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    cur = _written(nodes.select(F.col(node).alias("node"), F.col(node).alias("label")))
    for _ in range(max_rounds):
        up = cur.select(F.col("node").alias("label"), F.col("label").alias("top"))
        g = cur.join(up, "label").select("node", "label", "top")
        near = both.join(g.select(F.col("node").alias("b"), "top"), "b").groupBy(F.col("a").alias("node")).agg(F.min("top").alias("near"))
        g = _written(g.join(near, "node", "left"))
        hook = g.groupBy(F.col("label").alias("node")).agg(F.min("near").alias("hook"))
        nxt = g.join(hook, "node", "left").select(
            "node", F.col("label").alias("old"), F.least("label", "top", "near", "hook").alias("label"))
        nxt = _written(nxt)
        done = nxt.where(F.col("old") != F.col("label")).limit(1).count() == 0
        cur = nxt.select("node", "label")
        if done:
            return cur.withColumnRenamed("node", node)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
