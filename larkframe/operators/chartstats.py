"""The tables behind charts: bins, densities, smooth lines, boxes, hexagons and ellipses."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkframe.operators.grouping import attach, group_join, match_join, one_row
from larkframe.operators.quantiles import quantiles


def histogram(df: DataFrame, x: str, bins: int) -> DataFrame:
    """Equal-width bins between the extremes; the largest value falls in the last bin."""
    s = one_row(df, lo=F.min(x), hi=F.max(x), n=F.count(x))
    width = (s["hi"] - s["lo"]) / bins
    place = F.least(F.floor((F.col(x) - s["lo"]) / width), F.lit(bins - 1)).cast("int")
    g = df.where(F.col(x).isNotNull()).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return g.select("bin", (s["lo"] + F.col("bin") * width).alias("left"), "n", (F.col("n") / F.lit(s["n"] * width)).alias("density"))


def bandwidth(n: Column, sd: Column, iqr: Column) -> Column:
    """Rule-of-thumb bandwidth: 0.9 min(sd, IQR / 1.34) n^(-1/5)."""
    return 0.9 * F.least(sd, iqr / 1.34) * F.pow(n, F.lit(-0.2))


def density(df: DataFrame, by: list[str], x: str, points: int) -> DataFrame:
    """Gaussian kernel density on an even grid per group.

    Equal values are counted once; each then adds its kernel to the fixed number of grid points, summed map-side.
    """
    v = df.where(F.col(x).isNotNull()).groupBy(*by, F.col(x).alias("v")).agg(F.count(F.lit(1)).alias("k"))
    s = df.groupBy(*by).agg(F.count(x).alias("n"), F.stddev_samp(x).alias("sd"), F.min(x).alias("lo"), F.max(x).alias("hi"))
    q = quantiles(df, by, x, {"q1": 0.25, "q3": 0.75})
    if by:
        v = group_join(v, match_join(s, q, by), by)
    else:
        v = v.withColumns({k: F.lit(z) for k, z in {**s.first().asDict(), **q.first().asDict()}.items()})
    v = v.withColumn("h", bandwidth(F.col("n"), F.col("sd"), F.col("q3") - F.col("q1")))
    g = v.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    at = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("i") / (points - 1)
    u = (at - F.col("v")) / F.col("h")
    kernel = F.exp(-0.5 * u * u) / (F.col("h") * math.sqrt(2 * math.pi))
    return g.groupBy(*by, "i").agg(F.min(at).alias("x"), (F.sum(F.col("k") * kernel) / F.max("n")).alias("density"))


def boxplot(df: DataFrame, by: list[str], x: str) -> DataFrame:
    """Quartiles, whiskers at the last values within 1.5 IQR, and the number of outliers."""
    q = quantiles(df, by, x, {"q1": 0.25, "med": 0.5, "q3": 0.75})
    d = group_join(df.select(*by, x), q, by)
    iqr = F.col("q3") - F.col("q1")
    inside = F.col(x).between(F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr)
    w = d.groupBy(*by).agg(F.min(F.when(inside, F.col(x))).alias("lo"), F.max(F.when(inside, F.col(x))).alias("hi"), F.count_if(~inside).alias("outliers"))
    return match_join(q, w, by)


def line_fit(df: DataFrame, by: list[str], y: str, x: str, points: int, z: float = 1.96) -> DataFrame:
    """Fitted line with a band on an even grid per group."""
    s = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(x).alias("mx"), F.var_pop(x).alias("vx"), F.min(x).alias("lo"), F.max(x).alias("hi"),
        F.regr_slope(y, x).alias("b"), F.regr_intercept(y, x).alias("a"), F.var_pop(y).alias("vy"), F.covar_pop(x, y).alias("cxy"))
    s2 = F.col("n") * (F.col("vy") - F.col("b") * F.col("cxy")) / (F.col("n") - 2)
    g = s.withColumn("s2", s2).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    g = g.withColumn("x", F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("i") / (points - 1))
    half = z * F.sqrt(F.col("s2") * (1 / F.col("n") + (F.col("x") - F.col("mx")) * (F.col("x") - F.col("mx")) / (F.col("n") * F.col("vx"))))
    fit = F.col("a") + F.col("b") * F.col("x")
    return g.select(*by, "x", fit.alias("fit"), (fit - half).alias("lo"), (fit + half).alias("hi"))


def loess(df: DataFrame, x: str, y: str, grid: list[float], span: float) -> DataFrame:
    """Local linear fits with tricube weights at the grid points.

    ``df`` must be pre-binned (here one row per day). The radius of a grid point is the distance of its q-th nearest
    row, found by the same exact order statistics as everywhere else; then one grouped pass gives weighted sums.
    """
    n = df.count()
    q = max(2, math.ceil(span * n))
    g = df.withColumn("g", F.explode(F.array(*[F.lit(float(v)) for v in grid])))
    g = g.withColumn("dist", F.abs(F.col(x) - F.col("g")))
    radius = quantiles(g, ["g"], "dist", {"radius": (q - 1) / (n - 1)})
    g = match_join(g, radius, ["g"]).where(F.col("dist") < F.col("radius"))
    u = F.col("dist") / F.col("radius")
    g = g.withColumn("w", F.pow(1 - u * u * u, F.lit(3))).withColumn("c", F.col(x) - F.col("g"))
    w, c, v = F.col("w"), F.col("c"), F.col(y)
    s = g.groupBy("g").agg(F.sum(w).alias("s0"), F.sum(w * c).alias("s1"), F.sum(w * c * c).alias("s2"), F.sum(w * v).alias("t0"), F.sum(w * c * v).alias("t1"))
    fit = (F.col("s2") * F.col("t0") - F.col("s1") * F.col("t1")) / (F.col("s0") * F.col("s2") - F.col("s1") * F.col("s1"))
    return s.select(F.col("g").alias("x"), fit.alias("fit"))


def density2d(df: DataFrame, x: str, y: str, bins: int, h: float) -> DataFrame:
    """Counts on a square grid smoothed by a Gaussian kernel of ``h`` cells, one axis after the other."""
    s = one_row(df, x0=F.min(x), x1=F.max(x), y0=F.min(y), y1=F.max(y), n=F.count(F.lit(1)))

    def cell(c, lo, hi):
        return F.least(F.floor((F.col(c) - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("int")

    g = df.groupBy(cell(x, s["x0"], s["x1"]).alias("bx"), cell(y, s["y0"], s["y1"]).alias("by")).agg(F.count(F.lit(1)).cast("double").alias("z"))
    for b in ("bx", "by"):
        other = "by" if b == "bx" else "bx"
        g = g.withColumn("_g", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
        u = (F.col("_g") - F.col(b)) / h
        g = g.groupBy(F.col("_g").alias(b), other).agg(F.sum(F.col("z") * F.exp(-0.5 * u * u) / (h * math.sqrt(2 * math.pi))).alias("z"))
    return g.select("bx", "by", (F.col("z") / F.lit(float(s["n"]))).alias("density"))


def hexagons(df: DataFrame, x: str, y: str, bins: int) -> DataFrame:
    """Counts per hexagon: each point goes to the nearer of two shifted rectangular lattices."""
    s = one_row(df, x0=F.min(x), x1=F.max(x), y0=F.min(y), y1=F.max(y))
    sx = (F.col(x) - s["x0"]) * bins / (s["x1"] - s["x0"])
    sy = (F.col(y) - s["y0"]) * bins / (s["y1"] - s["y0"]) / math.sqrt(3)
    d = df.select(sx.alias("sx"), sy.alias("sy"))
    i1, j1 = F.floor(F.col("sx") + 0.5), F.floor(F.col("sy") + 0.5)
    i2, j2 = F.floor("sx"), F.floor("sy")
    dist = lambda a, b: (F.col("sx") - a) * (F.col("sx") - a) + 3 * (F.col("sy") - b) * (F.col("sy") - b)
    first = dist(i1, j1) <= dist(i2 + 0.5, j2 + 0.5)
    d = d.select(F.when(first, i1 * 2).otherwise(i2 * 2 + 1).alias("hx"), F.when(first, j1 * 2).otherwise(j2 * 2 + 1).alias("hy"))
    return d.groupBy("hx", "hy").agg(F.count(F.lit(1)).alias("n"))
