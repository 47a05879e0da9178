"""Geometry on vertex arrays ``array<struct<x,y>>``: Column expressions, NumPy only for hulls and clips.

Rings are closed (first vertex repeated at the end).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T
from pyspark.sql.functions import pandas_udf

XY = T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))


def xy(x, y) -> Column:
    c = lambda v: v.cast("double") if isinstance(v, Column) else F.lit(float(v))
    return F.struct(c(x).alias("x"), c(y).alias("y"))


def pairs(v: Column, fn) -> Column:
    """fn(a, b) over consecutive vertices."""
    n = F.size(v)
    return F.zip_with(F.slice(v, 1, n - 1), F.slice(v, 2, n - 1), fn)


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, t: s + t)


def length(v: Column) -> Column:
    return total(pairs(v, lambda a, b: F.hypot(b["x"] - a["x"], b["y"] - a["y"])))


perimeter = length


def signed_area(ring: Column) -> Column:
    return total(pairs(ring, lambda a, b: a["x"] * b["y"] - b["x"] * a["y"])) / 2


def area(ring: Column) -> Column:
    return F.abs(signed_area(ring))


def centroid(ring: Column) -> Column:
    """Centre of gravity of a ring's area (null without area)."""
    cross = lambda a, b: a["x"] * b["y"] - b["x"] * a["y"]
    six = 6 * signed_area(ring)
    at = lambda c: F.when(six != 0, total(pairs(ring, lambda a, b: (a[c] + b[c]) * cross(a, b))) / six)
    return xy(at("x"), at("y"))


def bbox(v: Column) -> Column:
    xs, ys = F.transform(v, lambda p: p["x"]), F.transform(v, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"), F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy"))


def bbox_center(b: Column) -> Column:
    return xy((b["minx"] + b["maxx"]) / 2, (b["miny"] + b["maxy"]) / 2)


def make_box(x0, y0, x1, y1) -> Column:
    return F.struct(x0.alias("minx"), y0.alias("miny"), x1.alias("maxx"), y1.alias("maxy"))


def expand_box(b: Column, margin: float, width: float, height: float) -> Column:
    """Grow by a margin, clamp to the image, keep at least one pixel."""
    x0, y0 = F.greatest(F.lit(0.0), b["minx"] - margin), F.greatest(F.lit(0.0), b["miny"] - margin)
    x1, y1 = F.least(F.lit(width - 1.0), b["maxx"] + margin), F.least(F.lit(height - 1.0), b["maxy"] + margin)
    return make_box(x0, y0, F.when(x1 <= x0, x0 + 1.0).otherwise(x1), F.when(y1 <= y0, y0 + 1.0).otherwise(y1))


def shrink_box(b: Column, max_side: float, width: float, height: float) -> Column:
    """Scale the box about its centre so that its longer side is at most ``max_side``."""
    w, h = b["maxx"] - b["minx"], b["maxy"] - b["miny"]
    side = F.greatest(w, h)
    k = F.when(side > max_side, F.lit(max_side) / side)
    cx, cy = (b["minx"] + b["maxx"]) / 2, (b["miny"] + b["maxy"]) / 2
    x0, y0 = F.greatest(F.lit(0.0), cx - w * k / 2), F.greatest(F.lit(0.0), cy - h * k / 2)
    x1, y1 = F.least(F.lit(width - 1.0), cx + w * k / 2), F.least(F.lit(height - 1.0), cy + h * k / 2)
    small = make_box(x0, y0, F.when(x1 <= x0, x0 + 1.0).otherwise(x1), F.when(y1 <= y0, y0 + 1.0).otherwise(y1))
    return F.when(k.isNull(), make_box(b["minx"], b["miny"], b["maxx"], b["maxy"])).otherwise(small)


def box_area(b: Column) -> Column:
    return F.greatest(b["maxx"] - b["minx"], F.lit(0.0)) * F.greatest(b["maxy"] - b["miny"], F.lit(0.0))


def box_inter(a: Column, b: Column) -> Column:
    w = F.least(a["maxx"], b["maxx"]) - F.greatest(a["minx"], b["minx"])
    h = F.least(a["maxy"], b["maxy"]) - F.greatest(a["miny"], b["miny"])
    return F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))


def box_iou(a: Column, b: Column) -> Column:
    i = box_inter(a, b)
    u = box_area(a) + box_area(b) - i
    return F.when((i > 0) & (u > 0), i / u).otherwise(0.0)


def boxes_meet(a: Column, b: Column) -> Column:
    return (a["maxx"] >= b["minx"]) & (a["minx"] <= b["maxx"]) & (a["maxy"] >= b["miny"]) & (a["miny"] <= b["maxy"])


def in_box(b: Column, x: Column, y: Column) -> Column:
    return x.between(b["minx"], b["maxx"]) & y.between(b["miny"], b["maxy"])


def box_distance(b: Column, x: Column, y: Column) -> Column:
    z = F.lit(0.0)
    return F.hypot(F.greatest(b["minx"] - x, z, x - b["maxx"]), F.greatest(b["miny"] - y, z, y - b["maxy"]))


def circularity(a: Column, p: Column) -> Column:
    return F.when((a > 0) & (p > 0), 4 * math.pi * a / (p * p)).otherwise(0.0)


def roughness(a: Column, p: Column) -> Column:
    """P^2 / A, NULL for an empty area."""
    return F.when(a > 0, p * p / a)


def rect_ring(cx: Column, cy: Column, length_: Column, width: Column, deg: Column) -> Column:
    """Closed ring of a rotated rectangle."""
    c, s = F.cos(F.radians(deg)), F.sin(F.radians(deg))
    corner = lambda u, v: xy(cx + length_ * (u / 2) * c - width * (v / 2) * s, cy + length_ * (u / 2) * s + width * (v / 2) * c)
    return F.array(*[corner(u, v) for u, v in ((-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1))])


def rotate_ring(v: Column, cx: Column, cy: Column, deg: Column) -> Column:
    c, s = F.cos(F.radians(deg)), F.sin(F.radians(deg))
    return F.transform(v, lambda p: xy(cx + (p["x"] - cx) * c - (p["y"] - cy) * s, cy + (p["x"] - cx) * s + (p["y"] - cy) * c))


def in_ring(ring: Column, x: Column, y: Column) -> Column:
    """Ray casting: an odd number of crossed edges means inside."""
    hit = pairs(ring, lambda a, b: F.when(
        ((a["y"] > y) != (b["y"] > y)) & (x < (b["x"] - a["x"]) * (y - a["y"]) / (b["y"] - a["y"]) + a["x"]), 1).otherwise(0))
    return F.aggregate(hit, F.lit(0), lambda s, t: s + t) % 2 == 1


def segment_distance(x: Column, y: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    dx, dy = bx - ax, by - ay
    q = dx * dx + dy * dy
    t = F.when(q > 0, F.least(F.greatest(((x - ax) * dx + (y - ay) * dy) / q, F.lit(0.0)), F.lit(1.0))).otherwise(0.0)
    return F.hypot(x - (ax + t * dx), y - (ay + t * dy))


def line_distance(v: Column, x: Column, y: Column) -> Column:
    return F.array_min(pairs(v, lambda a, b: segment_distance(x, y, a["x"], a["y"], b["x"], b["y"])))


def heading_deg(dx: Column, dy: Column) -> Column:
    """Undirected heading in [0, 180); NULL for a zero segment."""
    a = F.degrees(F.atan2(dy, dx))
    return F.when((F.abs(dx) < 1e-6) & (F.abs(dy) < 1e-6), None).otherwise(F.when(a < 0, a + 180).otherwise(a))


def angle_diff_rad(a: Column, b: Column) -> Column:
    d = F.pmod(b - a, F.lit(2 * math.pi))
    return F.least(d, 2 * math.pi - d)


def angle_diff_180(a: Column, b: Column) -> Column:
    d = F.abs(a - b) % 180.0
    return F.least(d, 180.0 - d)


def angle_diff_360(a: Column, b: Column) -> Column:
    d = F.abs(a - b) % 360.0
    return F.least(d, 360.0 - d)


def sample_positions(len_: Column, step: float, whole_steps: bool = False) -> Column:
    """Arc positions along a line: n = max(2, ceil(L/step)+1) even positions, or i*step up to L."""
    if whole_steps:
        return F.transform(F.sequence(F.lit(0), F.floor(len_ / step).cast("int")), lambda i: i * F.lit(float(step)))
    n = F.greatest(F.lit(2), F.ceil(len_ / step).cast("int") + 1)
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: len_ * i / (n - 1))


def direction_deg(sxx: Column, syy: Column, sxy: Column) -> Column:
    """Principal direction of a point set from its covariances, in [0, 180)."""
    a = F.degrees(0.5 * F.atan2(2 * sxy, sxx - syy))
    return F.when(a < 0, a + 180).otherwise(a)


def ring_signature(v: Column, digits: int = 3) -> Column:
    """Hash of the rounded vertices, for exact de-duplication."""
    return F.sha2(F.to_json(F.transform(v, lambda p: F.array(F.bround(p["x"], digits), F.bround(p["y"], digits)))), 256)


def hull(points: np.ndarray) -> np.ndarray:
    """Convex hull by the monotone chain, counter-clockwise, not closed."""
    p = np.unique(points, axis=0)
    if len(p) < 3:
        return p

    def chain(seq):
        out: list = []
        for q in seq:
            while len(out) >= 2 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(q)
        return out

    return np.array(chain(p)[:-1] + chain(p[::-1])[:-1])


def min_rect(points: np.ndarray) -> tuple[float, float, float, float, float]:
    """Length, width, angle of the long side (deg, [0,180)), centre of the smallest enclosing rectangle."""
    h = hull(points)
    if len(h) < 2:
        return 0.0, 0.0, 0.0, float(h[0, 0]), float(h[0, 1])
    e = np.roll(h, -1, axis=0) - h
    a = np.arctan2(e[:, 1], e[:, 0])
    c, s = np.cos(a), np.sin(a)
    # every edge direction at once: one row per edge, one column per vertex
    u = np.outer(c, h[:, 0]) + np.outer(s, h[:, 1])
    v = np.outer(c, h[:, 1]) - np.outer(s, h[:, 0])
    u0, u1, v0, v1 = u.min(1), u.max(1), v.min(1), v.max(1)
    k = int(np.argmin(np.round((u1 - u0) * (v1 - v0), 9)))
    du, dv, mu, mv = u1[k] - u0[k], v1[k] - v0[k], (u1[k] + u0[k]) / 2, (v1[k] + v0[k]) / 2
    deg = np.degrees(a[k] if du >= dv else a[k] + np.pi / 2) % 180.0
    return (float(max(du, dv)), float(min(du, dv)), float(0.0 if deg > 180 - 1e-9 else deg),
            float(mu * c[k] - mv * s[k]), float(mu * s[k] + mv * c[k]))


RECT = T.StructType([T.StructField(n, T.DoubleType()) for n in ("rect_l", "rect_w", "angle", "cx", "cy")])


def flat(v: Column) -> Column:
    """Vertices as one array of doubles: Arrow hands it to NumPy without per-vertex objects."""
    return F.flatten(F.transform(v, lambda p: F.array(p["x"], p["y"])))


def _col(v) -> Column:
    return F.col(v) if isinstance(v, str) else v


def _xy_list(h: np.ndarray) -> list[dict]:
    return [{"x": float(a), "y": float(b)} for a, b in h]


@pandas_udf(RECT)
def _rect_udf(v: pd.Series) -> pd.DataFrame:
    rows = [min_rect(c.reshape(-1, 2)) if c is not None and len(c) else (None,) * 5 for c in v]
    return pd.DataFrame(rows, columns=["rect_l", "rect_w", "angle", "cx", "cy"])


def rotated_rect(v) -> Column:
    """Minimum rotated rectangle of the vertices."""
    return _rect_udf(flat(_col(v)))


@pandas_udf(XY)
def _hull_udf(v: pd.Series) -> pd.Series:
    def one(c):
        h = hull(c.reshape(-1, 2))
        return _xy_list(np.vstack([h, h[:1]]))

    return v.map(lambda c: one(c) if c is not None and len(c) else None)


def convex_hull(v) -> Column:
    """Closed ring of the convex hull."""
    return _hull_udf(flat(_col(v)))


def clip_area(a: np.ndarray, b: np.ndarray) -> float:
    """Area of the intersection of two convex rings (half-plane clipping of a by every edge of b)."""
    orient = lambda r: r if np.sum(r[:, 0] * np.roll(r[:, 1], -1) - np.roll(r[:, 0], -1) * r[:, 1]) >= 0 else r[::-1]
    out, b = orient(a), orient(b)
    for p, q in zip(b, np.roll(b, -1, axis=0)):
        if len(out) == 0:
            return 0.0
        side = (q[0] - p[0]) * (out[:, 1] - p[1]) - (q[1] - p[1]) * (out[:, 0] - p[0])
        nxt, ns = np.roll(out, -1, axis=0), np.roll(side, -1)
        keep: list = []
        for u, v, su, sv in zip(out, nxt, side, ns):
            if su >= 0:
                keep.append(u)
            if (su > 0 > sv) or (su < 0 < sv):
                keep.append(u + (v - u) * (su / (su - sv)))
        out = np.array(keep)
    if len(out) < 3:
        return 0.0
    return float(abs(np.sum(out[:, 0] * np.roll(out[:, 1], -1) - np.roll(out[:, 0], -1) * out[:, 1])) / 2)


@pandas_udf(T.DoubleType())
def _clip_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([clip_area(p.reshape(-1, 2)[:-1], q.reshape(-1, 2)[:-1]) for p, q in zip(a, b)], dtype=float)


def convex_overlap_area(a, b) -> Column:
    return _clip_udf(flat(_col(a)), flat(_col(b)))


def thin_line(v: np.ndarray, tol: float) -> np.ndarray:
    """Douglas-Peucker: keep the ends and every vertex further than ``tol`` from its chord."""
    keep = np.zeros(len(v), dtype=bool)
    keep[[0, -1]] = True
    work = [(0, len(v) - 1)]
    while work:
        i, j = work.pop()
        if j - i < 2:
            continue
        a, d = v[i], v[j] - v[i]
        q = float(d @ d)
        w = v[i + 1:j] - a
        t = np.clip(w @ d / q, 0, 1)[:, None] if q > 0 else np.zeros((len(w), 1))
        dist = np.hypot(*(w - t * d).T)
        k = int(np.argmax(dist))
        if dist[k] > tol:
            keep[i + 1 + k] = True
            work += [(i, i + 1 + k), (i + 1 + k, j)]
    return v[keep]


@pandas_udf(XY)
def _thin_udf(v: pd.Series, tol: pd.Series) -> pd.Series:
    return pd.Series([_xy_list(thin_line(c.reshape(-1, 2), float(t))) for c, t in zip(v, tol)])


def simplify(v, tol: Column) -> Column:
    return _thin_udf(flat(_col(v)), tol)
