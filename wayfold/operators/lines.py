"""Polylines as vertex rows (key, idx, x, y): arc length, sampling, cutting, offsetting, width probes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from wayfold.operators import ordered as O
from wayfold.operators.joins import _cell, nearest_segment
from wayfold.session import checkpoint, checkpoint_observed


def neighbours(v: DataFrame, by: Sequence[str], idx: str, cols: Sequence[str], k: int = 1) -> DataFrame:
    """Previous and next row values (p_*, n_*) along a dense index, without windowing a whole line."""
    w = O.halo_window(by, idx)
    h = O.with_halo(v, idx, k)
    out = h.select("*", *[F.lag(c, k).over(w).alias("p_" + c) for c in cols], *[F.lead(c, k).over(w).alias("n_" + c) for c in cols])
    return O.drop_halo(out, idx)


def arc_length(v: DataFrame, by: Sequence[str], idx: str) -> DataFrame:
    """Adds s, the distance along the line."""
    p = neighbours(v, by, idx, ["x", "y"])
    step = F.coalesce(F.hypot(F.col("x") - F.col("p_x"), F.col("y") - F.col("p_y")), F.lit(0.0))
    return O.running_sum(p.drop("n_x", "n_y"), by, [idx], F.floor(F.col(idx) / O.CHUNK), step, "s").drop("p_x", "p_y")


def segments(v: DataFrame, by: Sequence[str], idx: str) -> DataFrame:
    """(x, y, s) to (n_x, n_y, n_s) per segment."""
    return neighbours(arc_length(v, by, idx), by, idx, ["x", "y", "s"]).filter("n_x is not null").drop("p_x", "p_y", "p_s")


def sample(v: DataFrame, by: Sequence[str], idx: str, step: float, whole_steps: bool = False) -> DataFrame:
    """Points along each line: max(2, ceil(L/step)+1) even positions, or every whole multiple of step."""
    s = segments(v, by, idx)
    total = s.groupBy(*by).agg(F.max("n_s").alias("_len")).filter("_len > 0")
    s = s.join(total, list(by))
    n = (F.floor(F.col("_len") / step) + 1 if whole_steps else F.greatest(F.lit(2), F.ceil(F.col("_len") / step) + 1)).cast("long")
    s = s.withColumn("_n", n).withColumn("_d", F.lit(float(step)) if whole_steps else F.col("_len") / (F.col("_n") - 1))
    first = F.ceil(F.col("s") / F.col("_d")).cast("long")
    last = F.when(F.col("n_s") == F.col("_len"), F.col("_n") - 1).otherwise(F.ceil(F.col("n_s") / F.col("_d")).cast("long") - 1)
    s = s.withColumn("_a", first).withColumn("_b", F.least(last, F.col("_n") - 1)).filter("_a <= _b and n_s > s")
    s = s.withColumn("i", F.explode(F.sequence("_a", "_b")))
    t = (F.col("i") * F.col("_d") - F.col("s")) / (F.col("n_s") - F.col("s"))
    return s.select(*by, "i", (F.col("x") + (F.col("n_x") - F.col("x")) * t).alias("x"), (F.col("y") + (F.col("n_y") - F.col("y")) * t).alias("y"))


def cut(seg: DataFrame, start: Column, end: Column) -> DataFrame:
    """Part of every segment between two arc positions."""
    d = seg.withColumn("_a", F.greatest(F.col("s"), start)).withColumn("_b", F.least(F.col("n_s"), end)).filter("_b > _a")
    at = lambda c, p: F.col(c) + (F.col("n_" + c) - F.col(c)) * (F.col(p) - F.col("s")) / (F.col("n_s") - F.col("s"))
    keep = [c for c in seg.columns if c not in ("x", "y", "s", "n_x", "n_y", "n_s")]
    return d.select(*keep, at("x", "_a").alias("x"), at("y", "_a").alias("y"), F.col("_a").alias("s"),
                    at("x", "_b").alias("n_x"), at("y", "_b").alias("n_y"), F.col("_b").alias("n_s"))


def offset(v: DataFrame, by: Sequence[str], idx: str, dist: float) -> DataFrame:
    """Shift every vertex along the averaged normal of its two segments."""
    p = neighbours(v, by, idx, ["x", "y"])

    def normal(ax, ay, bx, by_):
        dx, dy = bx - ax, by_ - ay
        n = F.hypot(dx, dy)
        return F.when(n == 0, 0.0).otherwise(-dy / n), F.when(n == 0, 0.0).otherwise(dx / n)

    x, y = F.col("x"), F.col("y")
    px, py = normal(F.col("p_x"), F.col("p_y"), x, y)
    nx, ny = normal(x, y, F.col("n_x"), F.col("n_y"))
    sx, sy = px + nx, py + ny
    n = F.hypot(sx, sy)
    inner = F.col("p_x").isNotNull() & F.col("n_x").isNotNull()
    ux = F.when(inner, F.when(n != 0, sx / n).otherwise(nx)).otherwise(F.coalesce(nx, px))
    uy = F.when(inner, F.when(n != 0, sy / n).otherwise(ny)).otherwise(F.coalesce(ny, py))
    return p.select(*by, idx, (x + ux * dist).alias("x"), (y + uy * dist).alias("y"))


def tangents(v: DataFrame, by: Sequence[str], idx: str) -> DataFrame:
    """Unit tangent: central difference, one-sided at the ends, (1, 0) for a standstill."""
    p = neighbours(v, by, idx, ["x", "y"])
    d = lambda c: F.coalesce(F.col("n_" + c), F.col(c)) - F.coalesce(F.col("p_" + c), F.col(c))
    n = F.hypot(d("x"), d("y"))
    return p.select(*v.columns, F.when(n > 0, d("x") / n).otherwise(1.0).alias("tx"), F.when(n > 0, d("y") / n).otherwise(0.0).alias("ty"))


def ray_hits(rays: DataFrame, walls: DataFrame, reach: float) -> DataFrame:
    """Distance from each ray (ray_id, x, y, ux, uy) to the first wall segment (ax, ay, bx, by_) within reach."""
    span = lambda a, b: F.explode(F.sequence(_cell(F.least(a, b), reach), _cell(F.greatest(a, b), reach)))
    ex, ey = F.col("x") + F.col("ux") * reach, F.col("y") + F.col("uy") * reach
    r = rays.withColumn("_gx", span(F.col("x"), ex)).withColumn("_gy", span(F.col("y"), ey))
    w = walls.withColumn("_gx", span(F.col("ax"), F.col("bx"))).withColumn("_gy", span(F.col("ay"), F.col("by_")))
    j = r.join(w, ["_gx", "_gy"])
    sx, sy = F.col("bx") - F.col("ax"), F.col("by_") - F.col("ay")
    den = F.col("ux") * sy - F.col("uy") * sx
    qx, qy = F.col("ax") - F.col("x"), F.col("ay") - F.col("y")
    t, u = (qx * sy - qy * sx) / den, (qx * F.col("uy") - qy * F.col("ux")) / den
    hit = F.when(den != 0, F.when(t.between(0, reach) & u.between(0, 1), t))
    return j.groupBy("ray_id").agg(F.min(hit).alias("hit")).filter("hit is not null")


def width_profile(v: DataFrame, walls: DataFrame, by: Sequence[str], step: float, reach: float) -> DataFrame:
    """Road width at even samples of each line: distance to the walls left plus right, 0 without both."""
    pts = tangents(sample(v, by, "idx", step).withColumnRenamed("i", "idx"), by, "idx")
    node = F.struct(*by, "idx")
    r = pts.select(*by, "idx", "x", "y", "tx", "ty", F.explode(F.array(F.lit(1.0), F.lit(-1.0))).alias("side"))
    r = r.withColumn("ray_id", F.struct(node.alias("p"), F.col("side").alias("side")))
    h = ray_hits(r.select("ray_id", "x", "y", (-F.col("ty") * F.col("side")).alias("ux"), (F.col("tx") * F.col("side")).alias("uy")), walls, reach)
    w = h.groupBy(F.col("ray_id.p").alias("p")).agg(F.sum("hit").alias("w"), F.count(F.lit(1)).alias("_k")).filter("_k = 2")
    w = w.select("p.*", "w")
    return pts.join(w, [*by, "idx"], "left").withColumn("width", F.coalesce("w", F.lit(0.0))).drop("w")


def box_walls(boxes: DataFrame) -> DataFrame:
    """The four sides of each box as wall segments."""
    c = F.col
    side = lambda a, b, d, e: F.struct(c(a).alias("ax"), c(b).alias("ay"), c(d).alias("bx"), c(e).alias("by_"))
    return boxes.select(F.explode(F.array(side("minx", "miny", "maxx", "miny"), side("maxx", "miny", "maxx", "maxy"),
                                          side("maxx", "maxy", "minx", "maxy"), side("minx", "maxy", "minx", "miny"))).alias("w")).select("w.*")


def wall_cuts(v: DataFrame, by: Sequence[str], idx: str, walls: DataFrame, cell: float) -> DataFrame:
    """(by, idx, t): where segments cross wall segments (ax, ay, bx, by_), as a share of the segment; ends of segments are no cuts."""
    seg = segments(v, by, idx).select(F.struct(*by, idx).alias("_s"), "x", "y", "n_x", "n_y")
    span = lambda d, a, b, g: d.withColumn(g, F.explode(F.sequence(_cell(F.least(a, b), cell), _cell(F.greatest(a, b), cell))))
    s = span(span(seg, F.col("x"), F.col("n_x"), "_gx"), F.col("y"), F.col("n_y"), "_gy")
    w = span(span(walls, F.col("ax"), F.col("bx"), "_gx"), F.col("ay"), F.col("by_"), "_gy")
    dx, dy, sx, sy = F.col("n_x") - F.col("x"), F.col("n_y") - F.col("y"), F.col("bx") - F.col("ax"), F.col("by_") - F.col("ay")
    den = dx * sy - dy * sx
    ox, oy = F.col("ax") - F.col("x"), F.col("ay") - F.col("y")
    t, u = F.when(den != 0, (ox * sy - oy * sx) / den), F.when(den != 0, (ox * dy - oy * dx) / den)
    hits = s.join(w, ["_gx", "_gy"]).select("_s", F.round(t, 9).alias("t"), u.alias("u")).filter((F.col("t") > 0) & (F.col("t") < 1) & F.col("u").between(0, 1))
    return hits.select("_s", "t").distinct().select("_s.*", "t")


def split(v: DataFrame, by: Sequence[str], idx: str, cuts: DataFrame) -> DataFrame:
    """Vertices of the pieces that ``cuts`` (by, idx, t) leave of each line: (by, piece, idx, t, x, y, step).

    A cut ends one piece and starts the next; pieces are numbered along the line by a running count in two levels.
    ``step`` is the distance from the vertex before in the same piece (null at its start), so a line's steps add up to its length.
    """
    key = F.struct(F.lit(0).alias("_0"), *by)
    corner = neighbours(v, by, idx, ["x", "y"]).select(key.alias("_k"), F.col(idx).alias("idx"), "x", "y", "n_x", "n_y")
    marks = cuts.select(key.alias("_k"), F.col(idx).alias("idx"), F.col("t").cast("double").alias("t"))
    along = lambda c: (F.col(c) + (F.col("n_" + c) - F.col(c)) * F.col("t")).alias(c)
    inner = marks.join(corner, ["_k", "idx"]).select("_k", "idx", "t", along("x"), along("y"), F.lit(1).alias("cut"))
    every = corner.select("_k", "idx", F.lit(0.0).alias("t"), "x", "y", F.lit(0).alias("cut")).unionByName(inner)
    chunk = F.floor(F.col("idx") / O.CHUNK)
    every = O.running_sum(every, ["_k"], ["idx", "t"], chunk, F.col("cut"), "piece")
    # the vertex before, over chunk borders as well
    here = F.struct("x", "y")
    every = O.previous(every, ["_k"], ["idx", "t"], chunk, {"_p": here})
    gone = F.hypot(F.col("x") - F.col("_p.x"), F.col("y") - F.col("_p.y"))
    starts = F.filter(F.array(F.struct((F.col("piece") - F.col("cut")).alias("piece"), gone.alias("step")), F.when(F.col("cut") == 1, F.struct("piece", F.lit(None).cast("double").alias("step")))), lambda s: s.isNotNull())
    return every.select("_k", "idx", "t", "x", "y", F.explode(starts).alias("_s")).select(*[F.col("_k")[c].alias(c) for c in by], "_s.piece", F.col("idx").alias(idx), "t", "x", "y", "_s.step")


def separation(a: DataFrame, b: DataFrame, by: Sequence[str], idx: str, step: float) -> DataFrame:
    """Mean distance of even samples of line ``a`` from line ``b`` of the same key, at any distance."""
    pts = sample(a, by, idx, step)
    seg = segments(b, by, idx).select(*by, F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("n_x").alias("bx"), F.col("n_y").alias("by_"))
    return nearest_segment(pts, seg, by, step).groupBy(*by).agg(F.avg("dist").alias("separation"))


def simplified(vertices: DataFrame, by: Sequence[str], order: str, tol: float) -> DataFrame:
    """Douglas-Peucker on whole lines of any length: the vertices (by, order, x, y) that stay.

    All stretches of all lines are split at once. A round finds the vertex farthest from the chord of its stretch, a
    partial aggregate, and drops stretches that lie within ``tol``; as many rounds as the deepest split needs.
    ``order`` is unique within a line. Equal distances: the first vertex.
    """
    by = list(by)
    base = checkpoint(vertices.select(*by, F.col(order).alias("_i"), "x", "y"))
    ends = base.groupBy(*by).agg(F.min("_i").alias("_lo"), F.max("_i").alias("_hi"), F.min_by("x", "_i").alias("ax"), F.min_by("y", "_i").alias("ay"), F.max_by("x", "_i").alias("bx"), F.max_by("y", "_i").alias("by_"))
    chords = checkpoint(ends)
    kept = [base.join(chords.select(*by, "_lo", "_hi"), by).where("_i = _lo OR _i = _hi").select(*by, "_i", "x", "y")]
    inner, seen = checkpoint_observed(base.join(chords.select(*by, "_lo", "_hi"), by).where("_i > _lo AND _i < _hi").select(*by, "_i", "x", "y", "_lo"), n=F.count(F.lit(1)))
    while seen["n"]:
        dx, dy, px, py = F.col("bx") - F.col("ax"), F.col("by_") - F.col("ay"), F.col("x") - F.col("ax"), F.col("y") - F.col("ay")
        q = dx * dx + dy * dy
        t = F.when(q > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), (px * dx + py * dy) / F.when(q > 0, q)))).otherwise(F.lit(0.0))
        far = inner.join(chords, [*by, "_lo"]).groupBy(*by, "_lo").agg(F.max(F.struct(F.hypot(px - t * dx, py - t * dy).alias("d"), (-F.col("_i")).alias("k"), "x", "y")).alias("m")).where(F.col("m.d") > tol)
        split = checkpoint(far.select(*by, "_lo", (-F.col("m.k")).alias("_k"), F.col("m.x").alias("kx"), F.col("m.y").alias("ky")))
        kept.append(split.select(*by, F.col("_k").alias("_i"), F.col("kx").alias("x"), F.col("ky").alias("y")))
        at = inner.join(split.select(*by, "_lo", "_k"), [*by, "_lo"]).where("_i <> _k")
        inner, seen = checkpoint_observed(at.select(*by, "_i", "x", "y", F.when(F.col("_i") < F.col("_k"), F.col("_lo")).otherwise(F.col("_k")).alias("_lo")), n=F.count(F.lit(1)))
        half = F.explode(F.array(
            F.struct("_lo", F.col("_k").alias("_hi"), "ax", "ay", F.col("kx").alias("bx"), F.col("ky").alias("by_")),
            F.struct(F.col("_k").alias("_lo"), "_hi", F.col("kx").alias("ax"), F.col("ky").alias("ay"), "bx", "by_"))).alias("c")
        chords = checkpoint(chords.join(split, [*by, "_lo"]).select(*by, half).select(*by, "c.*"))
    out = kept[0]
    for k in kept[1:]:
        out = out.unionByName(k)
    return out.withColumnRenamed("_i", order)
