"""Sparse-grid aggregations: one row per occupied cell, an absent row means no data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from wayfold.functions.stats import cell_percentiles, exact_percentiles
from wayfold.operators.components import cell_component_sizes, cell_components
from wayfold.operators.groups import group_key, null_groups
from wayfold.operators.ordered import with_one_row
from wayfold.operators.rowruns import cells_of, hole_runs
from wayfold.session import checkpoint, shuffled

CELL = ("ix", "iy")


def floor_div(v: Column, res: float) -> Column:
    return F.floor(v / F.lit(float(res))).cast("long")


def with_cell(df: DataFrame, res: float, x0: float | Column = 0.0, y0: float | Column = 0.0, y_down: bool = False) -> DataFrame:
    """Grid key by floor; ``y_down`` counts rows from the top edge ``y0`` down."""
    lit = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    iy = floor_div(lit(y0) - F.col("y"), res) if y_down else floor_div(F.col("y") - lit(y0), res)
    return df.withColumn("ix", floor_div(F.col("x") - lit(x0), res)).withColumn("iy", iy)


def cell_density(points: DataFrame, res: float, by: Sequence[str] = ()) -> DataFrame:
    return with_cell(points, res).groupBy(*by, *CELL).agg(F.count(F.lit(1)).alias("n"))


def merge_counts(*parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add the counts of several cell tables."""
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy(*by, *CELL).agg(F.sum("n").alias("n"))


def height_p10(points: DataFrame, res: float, by: Sequence[str]) -> DataFrame:
    return cell_percentiles(with_cell(points, res), [*by, *CELL], "z", {"height_p10": 0.1}).withColumnRenamed("n", "density_all")


@null_groups
def with_height(points: DataFrame, res: float, by: Sequence[str]) -> DataFrame:
    """Points with their cell's p10 height."""
    return with_cell(points, res).join(height_p10(points, res, by), [*by, *CELL])


@null_groups
def ground_rasters(points: DataFrame, res: float, dz: float, by: Sequence[str]) -> DataFrame:
    """p10 height and density of all points, then density, max intensity and roughness of the ground band."""
    p = with_height(points, res, by)
    ground = F.col("z") <= F.col("height_p10") + dz
    g = lambda c: F.when(ground, F.col(c))
    return p.groupBy(*by, *CELL).agg(
        F.max("height_p10").alias("height_p10"), F.max("density_all").alias("density_all"),
        F.count(g("z")).alias("density"), F.max(g("intensity")).alias("intensity_max"), F.stddev_pop(g("z")).alias("roughness"))


@null_groups
def height_and_intensity(points: DataFrame, res: float, by: Sequence[str]) -> DataFrame:
    c = with_cell(points, res)
    return cell_percentiles(c, [*by, *CELL], "z", {"height_p10": 0.1}).drop("n").join(
        c.groupBy(*by, *CELL).agg(F.avg("intensity").alias("intensity_mean")), [*by, *CELL])


@null_groups
def height_stats(points: DataFrame, res: float, min_points: int, by: Sequence[str]) -> DataFrame:
    """mean / p10 / p95 height; cells under ``min_points`` read 0."""
    c = with_cell(points, res)
    p = cell_percentiles(c, [*by, *CELL], "z", {"p10": 0.1, "p95": 0.95})
    m = c.groupBy(*by, *CELL).agg(F.avg("z").alias("mean"))
    ok = F.col("n") >= min_points
    j = p.join(m, [*by, *CELL])
    return j.select(*by, *CELL, "n", *[F.when(ok, F.col(k)).otherwise(0.0).alias(k) for k in ("mean", "p10", "p95")])


def _spread(cells: DataFrame, axis: str, r: int) -> DataFrame:
    offs = F.explode(F.sequence(F.lit(-r), F.lit(r))).alias("_o")
    return cells.select("*", offs).withColumn(axis, F.col(axis) + F.col("_o")).drop("_o")


@null_groups
def box_window(cells: DataFrame, value: str, r: int, by: Sequence[str], own_only: bool = True) -> DataFrame:
    """Square-window count/sum/sum of squares/mean/std over cells, as two one-axis passes.

    Each pass copies a cell 2r+1 times and merges map-side; no row or column of the grid is ever
    collected into one task. ``own_only=False`` also keeps empty cells that see data.
    """
    k = [*by, *CELL]
    s = cells.filter(F.col(value).isNotNull()).select(*k, F.lit(1).cast("long").alias("_n"), F.col(value).alias("_s"), (F.col(value) * F.col(value)).alias("_q"))
    for axis in CELL:
        s = _spread(s, axis, r).groupBy(*k).agg(F.sum("_n").alias("_n"), F.sum("_s").alias("_s"), F.sum("_q").alias("_q"))
    mean = F.col("_s") / F.col("_n")
    out = s.select(*k, F.col("_n").alias("win_n"), F.col("_s").alias("win_sum"), mean.alias("win_mean"),
                   F.sqrt(F.greatest(F.col("_q") / F.col("_n") - mean * mean, F.lit(0.0))).alias("win_std"))
    return cells.join(out, k) if own_only else out


def _window_values(cells: DataFrame, value: str, r: int, by: Sequence[str]) -> DataFrame:
    s = cells.filter(F.col(value).isNotNull()).select(*by, *CELL, F.col(value).alias("_v"))
    return _spread(_spread(s, "ix", r), "iy", r)


@null_groups
def window_median(cells: DataFrame, value: str, r: int, by: Sequence[str], own_only: bool = True) -> DataFrame:
    k = [*by, *CELL]
    m = _window_values(cells, value, r, by).groupBy(*k).agg(F.percentile("_v", F.lit(0.5)).alias("win_median"))
    return cells.join(m, k) if own_only else m


@null_groups
def window_mad(cells: DataFrame, value: str, r: int, by: Sequence[str]) -> DataFrame:
    """Median and median absolute deviation of the window around each cell."""
    k = [*by, *CELL]
    m = window_median(cells, value, r, by)
    dev = _window_values(cells, value, r, by).join(m.select(*k, "win_median"), k)
    mad = dev.groupBy(*k).agg(F.percentile(F.abs(F.col("_v") - F.col("win_median")), F.lit(0.5)).alias("win_mad"))
    return m.join(mad, k)


def min_height(points: DataFrame, res: float, by: Sequence[str]) -> DataFrame:
    return with_cell(points, res).groupBy(*by, *CELL).agg(F.min("z").alias("z_base"))


@null_groups
def candidate_stats(points: DataFrame, base: DataFrame, res: float, dz: float, by: Sequence[str]) -> DataFrame:
    """Points within ``dz`` over the base surface: count, sums, max intensity."""
    p = with_cell(points, res).join(base, [*by, *CELL]).filter(F.col("z") - F.col("z_base") <= dz)
    return p.groupBy(*by, *CELL).agg(
        F.count(F.lit(1)).alias("cand_n"), F.sum("z").alias("sum_z"), F.sum(F.col("z") * F.col("z")).alias("sum_z2"),
        F.max("intensity").alias("intensity_max"))


def moment_std(n: Column, s: Column, q: Column) -> Column:
    """Population std from count, sum and sum of squares; negative variance reads 0."""
    return F.when(n > 0, F.sqrt(F.greatest(q / n - (s / n) * (s / n), F.lit(0.0)))).otherwise(F.lit(0.0))


@null_groups
def slope(cells: DataFrame, value: str, res: float, by: Sequence[str]) -> DataFrame:
    """Gradient length: central differences, one-sided at the grid border, NULL next to a gap.

    Every cell sends its value to its four neighbours; one shuffle replaces four self joins.
    """
    k = [*by, *CELL]
    moves = [("me", 0, 0), ("w", 1, 0), ("e", -1, 0), ("s", 0, 1), ("n", 0, -1)]
    sent = cells.select(*k, F.col(value).alias("_v"), F.explode(F.array(*[
        F.struct(F.lit(m).alias("m"), F.lit(a).alias("dx"), F.lit(b).alias("dy")) for m, a, b in moves])).alias("o"))
    sent = sent.select(*by, (F.col("ix") + F.col("o.dx")).alias("ix"), (F.col("iy") + F.col("o.dy")).alias("iy"), F.col("o.m").alias("m"), "_v")
    g = sent.groupBy(*k).agg(*[F.max(F.when(F.col("m") == m, F.col("_v"))).alias("_" + m) for m, _, _ in moves]).filter(F.col("_me").isNotNull())
    b = cells.groupBy(*by).agg(*[f(c).alias(f"_{n}_{c}") for c in CELL for n, f in (("lo", F.min), ("hi", F.max))])
    j = g.join(b, list(by)) if by else with_one_row(g, b)
    me = F.col("_me")

    def diff(c: str, lo: Column, hi: Column) -> Column:
        return (F.when(F.col(f"_lo_{c}") == F.col(f"_hi_{c}"), F.lit(0.0)).when(F.col(c) == F.col(f"_lo_{c}"), hi - me)
                .when(F.col(c) == F.col(f"_hi_{c}"), me - lo).otherwise((hi - lo) / 2)) / res

    return j.select(*k, me.alias(value), F.hypot(diff("ix", F.col("_w"), F.col("_e")), diff("iy", F.col("_s"), F.col("_n"))).alias("slope"))


@null_groups
def surface_mask(stats: DataFrame, slopes: DataFrame, min_pts: int, rough_max: float, slope_max: float, by: Sequence[str]) -> DataFrame:
    std = moment_std(F.col("cand_n"), F.col("sum_z"), F.col("sum_z2"))
    return (stats.join(slopes, [*by, *CELL]).withColumn("z_std", std)
            .filter((F.col("cand_n") >= min_pts) & (F.col("z_std") <= rough_max) & (F.col("slope") <= slope_max)))


def reference_surface(points: DataFrame, res: float, q_low: float, min_pts: int, by: Sequence[str]) -> DataFrame:
    """Low quantile of the heights per cell; cells with fewer than ``min_pts`` points drop out."""
    return cell_percentiles(with_cell(points, res), [*by, *CELL], "z", {"z_ref": q_low}).filter(F.col("n") >= min_pts)


@null_groups
def smooth_and_fill(cells: DataFrame, value: str, r: int, by: Sequence[str]) -> DataFrame:
    """Window mean wherever the window sees data, then window median of the means one ring further out."""
    k = [*by, *CELL]
    sm = box_window(cells, value, r, by, own_only=False).select(*k, F.col("win_mean").alias("z_smooth"))
    fill = window_median(sm, "z_smooth", r, by, own_only=False).join(sm, k, "left_anti")
    return sm.select(*k, "z_smooth", F.lit(False).alias("filled")).unionByName(
        fill.select(*k, F.col("win_median").alias("z_smooth"), F.lit(True).alias("filled")))


@null_groups
def terrain_grid(points: DataFrame, res: float, min_pts: int, by: Sequence[str]) -> DataFrame:
    c = with_cell(points, res)
    med = cell_percentiles(c, [*by, *CELL], "z", {"z_median": 0.5})
    std = c.groupBy(*by, *CELL).agg(F.stddev_pop("z").alias("z_std"))
    return med.join(std, [*by, *CELL]).filter(F.col("n") >= min_pts)


@null_groups
def bev_tiles(points: DataFrame, res: float, tile_px: int, by: Sequence[str]) -> DataFrame:
    """Max intensity and density by tile/row/col, rows counted from the top edge of each key's extent."""
    b = points.groupBy(*by).agg(F.min("x").alias("_x0"), F.max("y").alias("_y1"))
    p = with_cell(points.join(F.broadcast(b) if not by else b, list(by)), res, F.col("_x0"), F.col("_y1"), y_down=True)
    t = lambda c: F.floor(F.col(c) / tile_px).cast("long")
    return (p.withColumn("tile_x", t("ix")).withColumn("tile_y", t("iy"))
            .withColumn("col", F.col("ix") - F.col("tile_x") * tile_px).withColumn("row", F.col("iy") - F.col("tile_y") * tile_px)
            .groupBy(*by, "tile_x", "tile_y", "row", "col")
            .agg(F.max("intensity").alias("intensity_max"), F.count(F.lit(1)).alias("density")))


def tile_summary(tiles: DataFrame, res: float, min_area: float, by: Sequence[str]) -> DataFrame:
    """Tiles whose covered area reaches ``min_area``, and the share of tiles dropped."""
    per = tiles.groupBy(*by, "tile_x", "tile_y").agg((F.count(F.lit(1)) * res * res).alias("area"))
    return per.groupBy(*by).agg(F.count(F.lit(1)).alias("tiles"), F.count_if(F.col("area") >= min_area).alias("kept"),
                                F.avg((F.col("area") < min_area).cast("double")).alias("empty_ratio"))


@null_groups
def marking_contrast(points: DataFrame, res: float, dz: float, r: int, by: Sequence[str]) -> DataFrame:
    """p95 of ground-band intensity per cell minus its window mean, floored at 0."""
    g = with_height(points, res, by).filter(F.col("z") <= F.col("height_p10") + dz)
    p95 = cell_percentiles(g, [*by, *CELL], "intensity", {"p95": 0.95}).drop("n")
    w = box_window(p95, "p95", r, by)
    return w.select(*by, *CELL, "p95", F.greatest(F.col("p95") - F.col("win_mean"), F.lit(0.0)).alias("contrast"))


@null_groups
def road_points(points: DataFrame, res: float, dz: float, min_density: int, rough_max: float, by: Sequence[str]) -> DataFrame:
    """Ground-band points on road cells, with the cell statistics."""
    road = road_cells(ground_rasters(points, res, dz, by), min_density, rough_max)
    return with_cell(points, res).join(road, [*by, *CELL]).filter(F.col("z") <= F.col("height_p10") + dz)


def road_cells(rasters: DataFrame, min_density: int, rough_max: float) -> DataFrame:
    return rasters.filter(F.col("height_p10").isNotNull() & (F.col("density_all") >= min_density)
                          & (F.col("roughness").isNull() | (F.col("roughness") <= rough_max)))


@null_groups
def marking_score(road_pts: DataFrame, pctl: float, by: Sequence[str], width: float) -> DataFrame:
    """Per road cell: share of points at or over the road-wide intensity percentile of their key."""
    road_pts = checkpoint(road_pts.select(*by, *CELL, "intensity"))
    thr = exact_percentiles(road_pts, by, "intensity", {"thr": pctl}, width).drop("n")
    p = road_pts.join(thr, list(by))
    hit = F.count_if(F.col("intensity") >= F.col("thr"))
    return p.groupBy(*by, *CELL).agg((hit / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("score"), F.max("thr").alias("thr"))


@null_groups
def ratio_threshold(scores: DataFrame, value: str, lo: float, hi: float, by: Sequence[str], width: float) -> DataFrame:
    """Score threshold whose selected share lies in [lo, hi]: try the middle, then the violated bound."""
    mid = max(1e-6, min((lo + hi) * 0.5, 0.999))
    scores = checkpoint(scores.select(*by, value))
    t = exact_percentiles(scores, by, value, {"t_mid": 1 - mid, "t_lo": 1 - lo, "t_hi": 1 - hi}, width)
    j = scores.join(t, list(by)) if by else with_one_row(scores, t.drop("n"))
    share = lambda c: F.avg((F.col(value) >= F.col(c)).cast("double"))
    a = j.groupBy(*by).agg(*[F.max(c).alias(c) for c in ("t_mid", "t_lo", "t_hi")], *[share(c).alias("s" + c[1:]) for c in ("t_mid", "t_lo", "t_hi")])
    pick = lambda p: F.when(F.col("s_mid") < lo, F.col(p + "_lo")).when(F.col("s_mid") > hi, F.col(p + "_hi")).otherwise(F.col(p + "_mid"))
    return a.select(*by, pick("t").alias("threshold"), pick("s").alias("ratio"), ((1 - pick("s")) * 100).alias("percentile"))


def area_components(mask: DataFrame, res: float, by: Sequence[str], diagonal: bool) -> DataFrame:
    """Component sizes of a cell mask; the label is its smallest cell."""
    return cell_component_sizes(mask, by, diagonal).withColumn("area_m2", F.col("cells") * res * res)


@null_groups
def seeded_components(mask: DataFrame, seed: DataFrame, top_k: int, by: Sequence[str]) -> DataFrame:
    """Mask cells of the ``top_k`` largest components that touch a seed cell (ties: smaller label)."""
    k = [*by, *CELL]
    lab = cell_components(mask, by)
    s = lab.join(seed.select(*k).distinct().withColumn("_seed", F.lit(1)), k, "left")
    comp = s.groupBy(*by, "label").agg(F.count(F.lit(1)).alias("cells"), F.max("_seed").alias("_seed")).filter(F.col("_seed").isNotNull())
    w = W.partitionBy(*by).orderBy(F.desc("cells"), "label")
    keep = comp.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= top_k)
    return lab.join(keep.select(*by, "label", "cells"), [*by, "label"])


@null_groups
def flood_from_seed(mask: DataFrame, seed: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mask cells connected to a seed cell; a key without any seed on its mask keeps its whole mask."""
    k = [*by, *CELL]
    lab = cell_components(mask, by)
    hit = lab.join(seed.select(*k).distinct(), k, "left_semi").select(*by, "label").distinct()
    touched = lab.join(hit, [*by, "label"], "left_semi")
    unseeded = lab.join(hit.select(*by).distinct(), list(by), "left_anti")
    return touched.unionByName(unseeded).drop("label")


def voxel_first(points: DataFrame, size: float, by: Sequence[str]) -> DataFrame:
    """First point (by pt_id) of every voxel, keyed by the true 3-part index."""
    v = [floor_div(F.col(c), size).alias("v" + c) for c in "xyz"]
    p = points.select("*", *v)
    first = F.min(F.struct("pt_id", "x", "y", "z", "intensity")).alias("p")
    return p.groupBy(*by, "vx", "vy", "vz").agg(first).select(*by, "vx", "vy", "vz", "p.*")


def coverage(mask: DataFrame, roi: DataFrame, corridor: DataFrame, res: float, by: Sequence[str]) -> DataFrame:
    """Mask share of the ROI, corridor share covered, and mask outside the corridor, in one pass over cells."""
    k = [*by, *CELL]
    tag = lambda d, n: d.select(*k).distinct().withColumn("_t", F.lit(n))
    u = tag(mask, "m").unionByName(tag(roi, "r")).unionByName(tag(corridor, "c"))
    has = lambda n: (F.max((F.col("_t") == n).cast("int")) == 1).alias(n)
    c = u.groupBy(*k).agg(has("m"), has("r"), has("c"))
    a = res * res
    area = lambda cond: F.count_if(cond) * F.lit(a)
    m, r, co = F.col("m"), F.col("r"), F.col("c")
    s = c.groupBy(*by).agg(area(r).alias("roi"), area(m & r).alias("mask"), area(co).alias("corridor"),
                           area(m & co).alias("inside"), area(m & ~co & r).alias("outside"))
    d = lambda p, q: F.col(p) / F.greatest(F.col(q), F.lit(1e-6))
    return s.select(*by, F.col("mask").alias("mask_area_m2"), F.col("roi").alias("roi_area_m2"), F.col("corridor").alias("corridor_area_m2"),
                    d("mask", "roi").alias("mask_coverage"), d("inside", "corridor").alias("corridor_coverage"), d("outside", "roi").alias("outside_ratio"))


@null_groups
def surface_points(points: DataFrame, base: DataFrame, mask: DataFrame, res: float, dz: float, by: Sequence[str]) -> DataFrame:
    k = [*by, *CELL]
    p = with_cell(points, res).join(mask.select(*k), k, "left_semi").join(base.select(*k, "z_base"), k)
    return p.filter(F.col("z") - F.col("z_base") <= dz)


def roi_patches(points: DataFrame, rois: DataFrame, res: float, buf: float, cell: float) -> DataFrame:
    """Raster patch around each ROI box: (roi_id, row, col) with max intensity and density.

    ROI boxes are spread over the coarse cells they touch, so the join is an equi join.
    """
    r = rois.select("roi_id", (F.col("minx") - buf).alias("minx"), (F.col("miny") - buf).alias("miny"),
                    (F.col("maxx") + buf).alias("maxx"), (F.col("maxy") + buf).alias("maxy"))
    span = lambda lo, hi: F.explode(F.sequence(floor_div(F.col(lo), cell), floor_div(F.col(hi), cell)))
    r = r.withColumn("_gx", span("minx", "maxx")).withColumn("_gy", span("miny", "maxy"))
    p = points.withColumn("_gx", floor_div(F.col("x"), cell)).withColumn("_gy", floor_div(F.col("y"), cell))
    j = p.join(r, ["_gx", "_gy"]).filter(F.col("x").between(F.col("minx"), F.col("maxx")) & F.col("y").between(F.col("miny"), F.col("maxy")))
    return (j.withColumn("col", floor_div(F.col("x") - F.col("minx"), res)).withColumn("row", floor_div(F.col("maxy") - F.col("y"), res))
            .groupBy("roi_id", "row", "col").agg(F.max("intensity").alias("intensity_max"), F.count(F.lit(1)).alias("density")))


def contrast_features(cells: DataFrame, value: str, r_large: int, r_small: int, by: Sequence[str], eps: float = 1e-3) -> DataFrame:
    """Top-hat (value - large mean, floored), local z-score and difference of window means."""
    k = [*by, *CELL]
    big = box_window(cells, value, r_large, by).select(*k, value, F.col("win_mean").alias("m_l"), F.col("win_std").alias("s_l"))
    small = box_window(cells, value, r_small, by).select(*k, F.col("win_mean").alias("m_s"))
    j = big.join(small, k)
    return j.select(*k, F.greatest(F.col(value) - F.col("m_l"), F.lit(0.0)).alias("tophat"),
                    ((F.col(value) - F.col("m_l")) / (F.col("s_l") + eps)).alias("zscore"), (F.col("m_s") - F.col("m_l")).alias("dog"))


def dilate(mask: DataFrame, r: int, by: Sequence[str]) -> DataFrame:
    k = [*by, *CELL]
    d = mask.select(*k).distinct()
    for axis in CELL:
        d = _spread(d, axis, r).distinct()
    return d


def erode(mask: DataFrame, r: int, by: Sequence[str]) -> DataFrame:
    """Cells whose whole (2r+1)^2 neighbourhood is set; one axis after the other."""
    k = [*by, *CELL]
    d = mask.select(*k).distinct()
    for axis in CELL:
        d = _spread(d, axis, r).groupBy(*k).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == 2 * r + 1).drop("_n")
    return d


def close_mask(mask: DataFrame, r: int, by: Sequence[str]) -> DataFrame:
    return erode(dilate(mask, r, by), r, by)


def open_mask(mask: DataFrame, r: int, by: Sequence[str]) -> DataFrame:
    return dilate(erode(mask, r, by), r, by)


def close_in_corridor(mask: DataFrame, corridor: DataFrame, r: int, by: Sequence[str]) -> DataFrame:
    """Closing that neither starts from nor ends on cells outside the corridor."""
    k = [*by, *CELL]
    inside = mask.join(corridor.select(*k).distinct(), k, "left_semi")
    return close_mask(inside, r, by).join(corridor.select(*k).distinct(), k, "left_semi")


def holes(mask: DataFrame, by: Sequence[str]) -> DataFrame:
    """Cells of complement components (4-neighbour) that do not reach the outside; adds label and size."""
    return cells_of(hole_runs(mask, by)).select(*by, *CELL, "label", "hole_cells")


def fill_small_holes(mask: DataFrame, corridor: DataFrame | None, max_cells: int, by: Sequence[str]) -> DataFrame:
    """Add holes of at most ``max_cells`` cells; with a corridor only holes that touch it."""
    small = cells_of(hole_runs(mask, by).filter(F.col("hole_cells") <= max_cells)).select(*by, *CELL, group_key([*by, "label"]).alias("_hole"))
    if corridor is not None:
        met = corridor.select(group_key([*by, *CELL]).alias("_cell")).distinct()
        near = small.withColumn("_cell", group_key([*by, *CELL])).join(met, "_cell", "left_semi").select("_hole").distinct()
        small = small.join(near, "_hole", "left_semi")
    k = [*by, *CELL]
    return mask.select(*k).distinct().unionByName(small.select(*k))


def hole_stats(mask: DataFrame, res: float, by: Sequence[str]) -> DataFrame:
    h = hole_runs(mask, by).groupBy(*by, "label").agg(F.max("hole_cells").alias("c"))
    return h.groupBy(*by).agg(F.count(F.lit(1)).alias("holes"), (F.sum("c") * res * res).alias("hole_area_m2"),
                              (F.max("c") * res * res).alias("largest_hole_m2"))


def cell_set_overlap(a: DataFrame, b: DataFrame, key_a: str, key_b: str, by: Sequence[str] = ()) -> DataFrame:
    """IoU, overlap and inside ratio of rasterised shapes from one cell join plus two counts."""
    na = a.groupBy(*by, key_a).agg(F.count(F.lit(1)).alias("n_a"))
    nb = b.groupBy(*by, key_b).agg(F.count(F.lit(1)).alias("n_b"))
    both = a.join(shuffled(b), [*by, *CELL]).groupBy(*by, key_a, key_b).agg(F.count(F.lit(1)).alias("n_ab"))
    j = both.join(shuffled(na), [*by, key_a]).join(shuffled(nb), [*by, key_b])
    n, x, y = F.col("n_ab"), F.col("n_a"), F.col("n_b")
    return j.select(*by, key_a, key_b, n, (n / (x + y - n)).alias("iou"), (n / F.least(x, y)).alias("overlap"), (n / x).alias("inside_ratio"))
