"""End-to-end flows composed of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wayfold.functions import transforms as T
from wayfold.operators import grid as G, joins as J
from wayfold.plans.registry import register


def fuse_points(sweeps: DataFrame, poses: DataFrame, shift: dict[str, float]) -> tuple[DataFrame, DataFrame]:
    """Sensor points to map coordinates: (points, frames without pose). One join, no second read."""
    p = J.attach_pose(sweeps, poses)
    m = T.pose_matrix(*[F.col("p_" + k) for k in ("x", "y", "z", "roll", "pitch", "yaw")])
    w = p.select("drive_id", "frame_id", "pt_id", "intensity", *[v.alias(n) for v, n in zip(T.apply(m, F.col("x"), F.col("y"), F.col("z")), ("wx", "wy", "wz"))])
    u = T.similarity(F.col("wx"), F.col("wy"), F.col("wz"), shift["dx"], shift["dy"], shift["dz"], shift["yaw_deg"], shift["scale"])
    out = w.select("drive_id", "frame_id", "pt_id", "intensity", *[v.alias(n) for v, n in zip(u, "xyz")])
    return out, J.missing_frames(sweeps, sweeps, poses)


@register("ground_rasters")
def ground_rasters(points: DataFrame, res: float = 10.0, dz: float = 0.4567) -> DataFrame:
    return G.ground_rasters(points, res, dz, ["drive_id"])


@register("surface_mask")
def surface_mask(points: DataFrame, res: float = 10.0, dz: float = 1.0, min_pts: int = 2, rough_max: float = 0.3137, slope_max: float = 0.0403) -> DataFrame:
    """Points to the road-surface cell mask in one lazy plan."""
    by = ["drive_id"]
    base = G.min_height(points, res, by)
    return G.surface_mask(G.candidate_stats(points, base, res, dz, by), G.slope(base, "z_base", res, by), min_pts, rough_max, slope_max, by)
