"""Polygon work that needs rows: rasterising, hulls of point sets, fits at a fixed heading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wayfold.functions import geometry as E
from wayfold.operators.grid import floor_div


def raster_spans(shapes: DataFrame, key: str, ring: str, res: float, by: Sequence[str] = ()) -> DataFrame:
    """Runs a..b of cells whose centre lies inside each ring: (by, key, iy, a, b).

    Works by scan line: every cell row of a shape gets its sorted edge crossings, and the cells
    between each pair of crossings follow as a range.
    """
    b = shapes.select(*by, key, ring, E.bbox(F.col(ring)).alias("_b"))
    rows = F.explode(F.sequence(floor_div(F.col("_b.miny"), res), floor_div(F.col("_b.maxy"), res))).alias("iy")
    y = (F.col("iy") + 0.5) * F.lit(res)
    cross = E.pairs(F.col(ring), lambda a, b_: F.when((a["y"] > y) != (b_["y"] > y), (b_["x"] - a["x"]) * (y - a["y"]) / (b_["y"] - a["y"]) + a["x"]))
    g = b.select("*", rows).select(*by, key, "iy", F.array_sort(F.array_compact(cross)).alias("_x")).filter(F.size("_x") >= 2)
    first = lambda v: F.ceil(v / res - 0.5).cast("long")
    spans = F.transform(F.sequence(F.lit(0), F.floor(F.size("_x") / 2).cast("int") - 1),
                        lambda i: F.struct(first(F.get("_x", 2 * i)).alias("a"), (first(F.get("_x", 2 * i + 1)) - 1).alias("b")))
    return g.select(*by, key, "iy", F.explode(spans).alias("_s")).filter("_s.a <= _s.b").select(*by, key, "iy", "_s.a", "_s.b")


def rasterise(shapes: DataFrame, key: str, ring: str, res: float, by: Sequence[str] = ()) -> DataFrame:
    """Cells whose centre lies inside each ring: (by, key, ix, iy)."""
    return raster_spans(shapes, key, ring, res, by).select(*by, key, F.explode(F.sequence("a", "b")).alias("ix"), "iy")


def raster_blocks(shapes: DataFrame, key: str, ring: str, res: float, side: int, by: Sequence[str] = ()) -> DataFrame:
    """Cells of each ring counted by blocks of side x side cells: (by, key, jx, jy, n), a row for each cell row of a block.

    No row is made for a single cell, so a join with blocks meets a fraction of the rows.
    """
    block = lambda c: F.floor(F.col(c) / F.lit(side)).cast("long")
    s = raster_spans(shapes, key, ring, res, by).select(*by, key, "a", "b", block("iy").alias("jy"), F.explode(F.sequence(block("a"), block("b"))).alias("jx"))
    n = F.least("b", F.col("jx") * side + side - 1) - F.greatest("a", F.col("jx") * side) + 1
    return s.select(*by, key, "jx", "jy", n.alias("n"))


def hull_of(points: DataFrame, by: Sequence[str], bucket: int = 4096) -> DataFrame:
    """Convex hull ring per key.

    Only the lowest and highest point of every distinct x can be hull vertices, so the first cut is
    a plain aggregate. Keys that still hold more than ``bucket`` points are split into salted
    buckets whose hulls are merged, so no task sees a large group.
    """
    by = list(by)
    col = points.groupBy(*by, "x").agg(F.min("y").alias("_a"), F.max("y").alias("_b"))
    cut = col.select(*by, "x", F.explode(F.array_distinct(F.array("_a", "_b"))).alias("y"))
    size = cut.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    salt = F.pmod(F.xxhash64("x", "y"), F.ceil(F.col("_n") / bucket)).alias("_s")
    vert = F.collect_list(E.xy(F.col("x"), F.col("y"))).alias("v")
    mid = cut.join(size, by).select(*by, salt, "x", "y", (F.col("_n") > bucket).alias("_big")).groupBy(*by, "_s", "_big").agg(vert)
    small = mid.filter("not _big").select(*by, "v")
    big = mid.filter("_big").select(*by, E.convex_hull("v").alias("v")).groupBy(*by).agg(F.flatten(F.collect_list("v")).alias("v"))
    return small.unionByName(big).select(*by, E.convex_hull("v").alias("hull"))


def direction(points: DataFrame, by: Sequence[str]) -> DataFrame:
    """Principal direction per key from covariances (NULL under two points)."""
    a = points.groupBy(*by).agg(F.var_samp("x").alias("_xx"), F.var_samp("y").alias("_yy"), F.covar_samp("x", "y").alias("_xy"), F.count(F.lit(1)).alias("n"))
    return a.select(*by, "n", F.when(F.col("n") >= 2, E.direction_deg(F.col("_xx"), F.col("_yy"), F.col("_xy"))).alias("direction"))


def rect_at_heading(points: DataFrame, by: Sequence[str], heading: Column, lo: float = 0.05, hi: float = 0.95) -> DataFrame:
    """Rectangle along a given heading that covers the lo..hi share of the points on both axes."""
    c, s = F.cos(F.radians(heading)), F.sin(F.radians(heading))
    p = points.withColumn("_c", c).withColumn("_s", s)
    p = p.select(*by, "_c", "_s", (F.col("x") * F.col("_c") + F.col("y") * F.col("_s")).alias("_u"), (F.col("y") * F.col("_c") - F.col("x") * F.col("_s")).alias("_v"))
    q = lambda v: F.percentile(v, F.array(F.lit(lo), F.lit(hi)))
    a = p.groupBy(*by).agg(F.max("_c").alias("_c"), F.max("_s").alias("_s"), q("_u").alias("_qu"), q("_v").alias("_qv"))
    u0, u1, v0, v1 = F.get("_qu", 0), F.get("_qu", 1), F.get("_qv", 0), F.get("_qv", 1)
    mu, mv = (u0 + u1) / 2, (v0 + v1) / 2
    return a.select(*by, (u1 - u0).alias("along"), (v1 - v0).alias("across"), (mu * F.col("_c") - mv * F.col("_s")).alias("cx"), (mu * F.col("_s") + mv * F.col("_c")).alias("cy"))
