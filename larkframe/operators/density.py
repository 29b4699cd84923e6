"""Density clusters of points in the plane, exact, by grid cells.

The cell diagonal is eps, so the points of a cell are all neighbours of each other. A cell with min_pts points needs no
distance at all; a thinner cell has fewer than min_pts points, so the pairs formed per point are bounded by a constant.
Whether two cells are joined is decided by comparing ever finer sub-cells through their bounding boxes and one
representative point each, so two hot cells are never compared point by point.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkframe.operators.components import components
from larkframe.operators.ordering import positions
from larkframe.session import shared_folder

REACH = 2  # cells in each direction that can hold a neighbour
CHUNK = 50_000


def _dist(ax: str, ay: str, bx: str, by: str) -> Column:
    dx, dy = F.col(ax) - F.col(bx), F.col(ay) - F.col(by)
    return F.sqrt(dx * dx + dy * dy)


def _around(df: DataFrame) -> DataFrame:
    """Rows repeated for the cells around theirs, in columns nx, ny."""
    steps = F.array(*[F.lit(i) for i in range(-REACH, REACH + 1)])
    return df.withColumn("_i", F.explode(steps)).withColumn("_j", F.explode(steps)).withColumns(
        {"nx": F.col("cx") + F.col("_i"), "ny": F.col("cy") + F.col("_j")}).drop("_i", "_j")


def _near(thin: DataFrame, points: DataFrame, cells: DataFrame, eps: float) -> DataFrame:
    """Pairs within eps between points of thin cells (tid, tx, ty) and any points (id, x, y, ...).

    Points of one cell are spread over chunks; the few thin points around a cell go to each of its chunks.
    """
    parts = cells.select(F.col("cx").alias("nx"), F.col("cy").alias("ny"), F.ceil(F.col("n") / CHUNK).cast("int").alias("parts"))
    left = _around(thin.select(F.col("id").alias("tid"), F.col("x").alias("tx"), F.col("y").alias("ty"), "cx", "cy")).drop("cx", "cy")
    left = left.join(parts, ["nx", "ny"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    right = points.withColumnsRenamed({"cx": "nx", "cy": "ny"}).join(parts, ["nx", "ny"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    j = left.drop("parts").join(right.drop("parts"), ["nx", "ny", "part"])
    return j.withColumn("dist", _dist("tx", "ty", "x", "y")).where(F.col("dist") <= eps)


def _box(df: DataFrame, keys: list[str]) -> DataFrame:
    """Bounding box and the first point of each group."""
    return df.groupBy(*keys).agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"),
                                 F.min(F.struct("x", "y")).alias("rep"))


def _joined_cells(core: DataFrame, side: float, eps: float) -> DataFrame:
    """Pairs of cells (a, b) that hold core points within eps of each other."""
    pts = core.withColumn("cell", F.concat_ws(":", "cx", "cy"))
    box = _box(pts, ["cell", "cx", "cy"])
    ahead = _around(box.select("cell", "cx", "cy")).withColumnsRenamed({"cell": "a"}).drop("cx", "cy")
    pairs = ahead.join(box.select(F.col("cell").alias("b"), F.col("cx").alias("nx"), F.col("cy").alias("ny")), ["nx", "ny"]).where(F.col("a") < F.col("b"))
    todo = pairs.select("a", "b", F.col("a").alias("sa"), F.col("b").alias("sb")).checkpoint()
    known, width = None, side
    level = pts.withColumn("sub", F.col("cell"))
    while True:
        boxes = _box(level, ["sub"])
        left = boxes.select(F.col("sub").alias("sa"), *[F.col(c).alias(f"a_{c}") for c in ("x0", "x1", "y0", "y1", "rep")])
        right = boxes.select(F.col("sub").alias("sb"), *[F.col(c).alias(f"b_{c}") for c in ("x0", "x1", "y0", "y1", "rep")])
        gap = lambda v: F.greatest(F.col(f"a_{v}0") - F.col(f"b_{v}1"), F.col(f"b_{v}0") - F.col(f"a_{v}1"), F.lit(0.0))
        d = todo.join(left, "sa").join(right, "sb").withColumns({
            "near": F.sqrt(gap("x") * gap("x") + gap("y") * gap("y")), "rep_dist": _dist("a_rep.x", "a_rep.y", "b_rep.x", "b_rep.y"),
            "single": (F.col("a_x0") == F.col("a_x1")) & (F.col("a_y0") == F.col("a_y1")) & (F.col("b_x0") == F.col("b_x1")) & (F.col("b_y0") == F.col("b_y1"))})
        d = d.where(F.col("near") <= eps).select("a", "b", "sa", "sb", "rep_dist", "single").checkpoint()
        hit = d.where(F.col("rep_dist") <= eps).select("a", "b").distinct()
        known = hit if known is None else known.unionByName(hit).distinct()
        known = known.checkpoint()
        todo = d.where(~F.col("single")).join(known, ["a", "b"], "left_anti").select("a", "b", "sa", "sb").checkpoint()
        if todo.limit(1).count() == 0:
            return known
        width /= 4
        used = todo.select(F.col("sa").alias("sub")).unionByName(todo.select(F.col("sb").alias("sub"))).distinct()
        level = level.join(used, "sub", "left_semi").withColumn("up", F.col("sub")).withColumn(
            "sub", F.concat_ws("/", "up", F.floor(F.col("x") / width).cast("string"), F.floor(F.col("y") / width).cast("string"))).checkpoint()
        child = level.select("up", "sub").distinct()
        todo = todo.join(child.select(F.col("up").alias("sa"), F.col("sub").alias("ca")), "sa").join(
            child.select(F.col("up").alias("sb"), F.col("sub").alias("cb")), "sb").select("a", "b", F.col("ca").alias("sa"), F.col("cb").alias("sb")).checkpoint()


def dbscan(df: DataFrame, key: str, x: str, y: str, eps: float, min_pts: int) -> DataFrame:
    """(key, cluster, core): cluster 0 is noise; clusters are numbered by their smallest key.

    A point is core when at least min_pts points (itself included) lie within eps. A border point joins the cluster of
    its nearest core point, ties by the smaller key.
    """
    shared_folder(df.sparkSession)
    side = eps / math.sqrt(2)
    pts = df.select(F.col(key).alias("id"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).withColumns(
        {"cx": F.floor(F.col("x") / side), "cy": F.floor(F.col("y") / side)}).checkpoint()
    cells = pts.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n")).checkpoint()
    sized = pts.join(cells, ["cx", "cy"])
    thin = sized.where(F.col("n") < min_pts).drop("n")
    counts = _near(thin, pts, cells, eps).groupBy("tid").agg(F.count(F.lit(1)).alias("k"))
    thin_core = counts.where(F.col("k") >= min_pts).select(F.col("tid").alias("id"))
    core = sized.where(F.col("n") >= min_pts).drop("n").unionByName(thin.join(thin_core, "id", "left_semi").select(*thin.columns)).checkpoint()
    cell = core.withColumn("cell", F.concat_ws(":", "cx", "cy"))
    label = components(cell.select("cell").distinct(), _joined_cells(core, side, eps), "cell")
    placed = cell.join(label, "cell").select("id", "x", "y", "cx", "cy", "label").checkpoint()
    border = _near(thin.join(core, "id", "left_anti"), placed, cells, eps).groupBy(F.col("tid").alias("id")).agg(
        F.min_by("label", F.struct("dist", "id")).alias("label"))
    firsts = placed.groupBy("label").agg(F.min("id").alias("first"))
    number = positions(firsts, [], ["first"], "cluster").select("label", "cluster")
    member = placed.select("id", "label", F.lit(True).alias("core")).unionByName(border.select("id", "label", F.lit(False).alias("core")))
    out = pts.select("id").join(member, "id", "left").join(number, "label", "left")
    return out.select(F.col("id").alias(key), F.coalesce("cluster", F.lit(0)).cast("int").alias("cluster"), F.coalesce("core", F.lit(False)).alias("core"))
