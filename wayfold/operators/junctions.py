"""Shapes of intersections as cell sets, for all seeds at once.

Around a seed the local road are the road cells within a radius; where there are none the radius grows along a ladder, then
satellite cells fill in, then a plain circle. The shape is the core (road near the seed) united with the arms (road along
the lines that pass the seed). A shape that covers too little of the local road is tried again with wider arms if enough
arms leave the core, and replaced by the local road if that does not help.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from wayfold.functions.geometry import segment_distance
from wayfold.operators.clusters import disc_cells
from wayfold.operators.joins import near_segments, within
from wayfold.session import checkpoint


@dataclass(frozen=True)
class ShapeRules:
    res: float = 4.0
    cap: float = 25.0  # reach of the arms and of the first look at the road
    retries: tuple[float, ...] = (50.0, 80.0)
    max_offset: float = 30.0  # a local road that starts farther away is none
    sat_reach: float = 80.0
    circle: float = 12.0
    core_ratio: float = 0.6
    core: tuple[float, float] = (12.0, 22.0)
    arm: float = 5.0
    arm_add: float = 0.5
    coverage: float = 0.9
    min_arms: int = 3

    @property
    def core_radius(self) -> float:
        return min(max(self.core_ratio * self.cap, self.core[0]), self.core[1])


CELLS = ("ix", "iy")


def _centres(cells: DataFrame, res: float) -> DataFrame:
    return cells.select(*CELLS).distinct().withColumn("x", (F.col("ix") + 0.5) * res).withColumn("y", (F.col("iy") + 0.5) * res)


def local_cells(seeds: DataFrame, road: DataFrame, sat: DataFrame | None, r: ShapeRules) -> DataFrame:
    """(seed, ix, iy, dist, src, step, radius): the local road of every seed (seed, sx, sy)."""
    pending, found = seeds, []
    for step, radius in enumerate((r.cap, *r.retries)):
        got = within(road, pending, radius, rx="sx", ry="sy", root=True).select("seed", *CELLS, "dist", F.lit("road_polygon").alias("src"), F.lit(step).alias("step"), F.lit(radius).alias("radius"))
        found.append(checkpoint(got))
        pending = checkpoint(pending.join(found[-1].select("seed").distinct(), "seed", "left_anti"))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    near = out.groupBy("seed").agg(F.min("dist").alias("_d")).where(F.col("_d") <= r.max_offset)
    out = out.join(near.select("seed"), "seed", "left_semi")
    left, last = seeds.join(near.select("seed"), "seed", "left_anti"), F.lit(len(r.retries))
    if sat is not None:
        fill = checkpoint(within(sat, left, r.sat_reach, rx="sx", ry="sy", root=True).select("seed", *CELLS, "dist", F.lit("sat_fill").alias("src"), last.alias("step"), F.lit(r.sat_reach).alias("radius")))
        out, left = out.unionByName(fill), left.join(fill.select("seed").distinct(), "seed", "left_anti")
    circle = disc_cells(left.select("seed", F.col("sx").alias("x"), F.col("sy").alias("y")), ["seed"], F.lit(r.circle), r.res)
    return out.unionByName(circle.select("seed", *CELLS, F.col("cell_dist").alias("dist"), F.lit("seed_circle").alias("src"), last.alias("step"), F.lit(r.circle).alias("radius")))


def arm_cells(seeds: DataFrame, road: DataFrame, segments: DataFrame, r: ShapeRules) -> DataFrame:
    """(seed, ix, iy, dist, off, sector): road cells within the widest arm of a line that passes the seed, within its reach."""
    wide = r.arm + r.arm_add
    # lines matter near seeds only: a segment is tried if it comes as close as a cell of it can lie
    close = near_segments(seeds.select("seed", F.col("sx").alias("x"), F.col("sy").alias("y")), segments, r.cap + wide).select("seed", F.col("x").alias("sx"), F.col("y").alias("sy"), "ax", "ay", "bx", "by_")
    cells = within(road, seeds, r.cap, rx="sx", ry="sy", root=True).select("seed", *CELLS, "x", "y", "dist")
    off = segment_distance(F.col("x"), F.col("y"), F.col("ax"), F.col("ay"), F.col("bx"), F.col("by_"))
    near = close.join(cells, "seed").withColumn("off", off).where(F.col("off") <= wide)
    sector = F.pmod(F.floor((F.atan2(F.col("y") - F.col("sy"), F.col("x") - F.col("sx")) / (2 * F.pi()) + 1) * 8), F.lit(8)).cast("int")
    return near.groupBy("seed", *CELLS, "dist", sector.alias("sector")).agg(F.min("off").alias("off"))


def seed_shapes(seeds: DataFrame, road: DataFrame, segments: DataFrame, sat: DataFrame | None = None, rules: ShapeRules = ShapeRules()) -> tuple[DataFrame, DataFrame]:
    """Cells (seed, ix, iy) of the shapes, and one row per seed: cells, area, coverage, arms, source, retries, quality, reason.

    ``seeds`` has seed, sx, sy; ``road`` and ``sat`` have ix, iy; ``segments`` has ax, ay, bx, by_.
    """
    r = rules
    seeds = checkpoint(seeds.select("seed", "sx", "sy"))
    road = checkpoint(_centres(road, r.res))
    local = checkpoint(local_cells(seeds, road, sat and _centres(sat, r.res), r))
    arms = checkpoint(arm_cells(seeds, road, segments, r))
    key = ["seed", *CELLS]

    # every cell that may belong to a shape, once, with what it is
    is_core = F.when(F.col("src") == "road_polygon", F.col("dist") <= r.core_radius).otherwise(F.lit(True))
    road_core = within(road, seeds, r.core_radius, rx="sx", ry="sy", root=True).join(local.where("src = 'road_polygon'").select("seed").distinct(), "seed", "left_semi")
    mark = lambda d, **flags: d.select(*key, *[flags.get(n, F.lit(False)).alias(n) for n in ("local", "core", "arm", "arm_wide")])
    parts = mark(local, local=F.lit(True), core=is_core).unionByName(mark(road_core, core=F.lit(True))).unionByName(mark(arms, arm=F.col("off") <= r.arm, arm_wide=F.lit(True)))
    cells = checkpoint(parts.groupBy(*key).agg(*[F.max(n).alias(n) for n in ("local", "core", "arm", "arm_wide")]))
    count = lambda c: F.count_if(c)
    plain, wide = F.col("core") | F.col("arm"), F.col("core") | F.col("arm_wide")
    sums = cells.groupBy("seed").agg(count("local").alias("n_local"), count(plain & F.col("local")).alias("c_plain"), count(wide & F.col("local")).alias("c_wide"), F.max("arm").alias("has_arm"))
    leaving = arms.where((F.col("off") <= r.arm) & (F.col("dist") >= r.core_radius)).groupBy("seed").agg(F.count_distinct("sector").alias("arms"))
    about = local.groupBy("seed").agg(F.first("src").alias("src"), F.first("step").alias("retries"), F.first("radius").alias("radius"))
    j = sums.join(about, "seed").join(leaving, "seed", "left").withColumn("arms", F.coalesce("arms", F.lit(0)))
    share = lambda c: F.col(c) / F.greatest("n_local", F.lit(1))
    low = share("c_plain") < r.coverage
    retried = low & (F.col("arms") >= r.min_arms) & (share("c_wide") >= r.coverage)
    use = F.when(retried, "wide").when(low, "local").otherwise("plain")
    reason = F.when(retried, "coverage_retry").when(low, "coverage_fallback_road_local").when(F.col("src") == "sat_fill", "sat_fill_fallback").when(F.col("src") == "seed_circle", "seed_circle_fallback").when(F.col("has_arm"), "refined_arms").otherwise("core_only")
    coverage = F.when(retried, share("c_wide")).when(low, 1.0).otherwise(share("c_plain"))
    quality = F.when(F.col("src") == "seed_circle", "very_low").when(use == "local", "low").otherwise("ok")
    j = checkpoint(j.select("seed", "src", "retries", "radius", F.col("arms").cast("int").alias("arms"), use.alias("use"), reason.alias("reason"), coverage.alias("coverage"), quality.alias("quality")))
    shape = cells.join(j.select("seed", "use"), "seed").where(F.when(F.col("use") == "local", F.col("local")).when(F.col("use") == "wide", wide).otherwise(plain)).select(*key)
    size = shape.groupBy("seed").agg(F.count(F.lit(1)).alias("cells"))
    return shape, j.join(size, "seed").withColumn("area_m2", F.col("cells") * r.res * r.res).drop("use")
