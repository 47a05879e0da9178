"""Spatial and as-of joins written as equi joins on grid cells plus an exact residual test."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from wayfold.session import checkpoint, checkpoint_observed, shuffled


def _cell(v: str | Column, size) -> Column:
    c = F.col(v) if isinstance(v, str) else v
    return F.floor(c / (size if isinstance(size, Column) else F.lit(float(size)))).cast("long")


def _ring() -> Column:
    return F.explode(F.array(*[F.struct(F.lit(a).cast("long").alias("dx"), F.lit(b).cast("long").alias("dy"))
                               for a in (-1, 0, 1) for b in (-1, 0, 1)])).alias("_o")


def around(df: DataFrame, size, x: str = "x", y: str = "y") -> DataFrame:
    """Copy every row into the 3x3 cells around it (columns _gx, _gy)."""
    return df.select("*", _ring()).withColumn("_gx", _cell(x, size) + F.col("_o.dx")).withColumn("_gy", _cell(y, size) + F.col("_o.dy")).drop("_o")


def within(left: DataFrame, right: DataFrame, dist: float, by: Sequence[str] = (), rx: str = "rx", ry: str = "ry", root: bool = False) -> DataFrame:
    """All (left, right) pairs at most ``dist`` apart; the right side is the one copied to nine cells.

    Right coordinates are ``rx``/``ry``; adds ``dist``. Squares are compared, with ``root`` the rounded root, which may let in a pair
    just beyond ``dist``. Merge copies before calling if only counts matter.
    """
    l = left.withColumn("_gx", _cell("x", dist)).withColumn("_gy", _cell("y", dist))
    r = around(right, dist, rx, ry)
    dx, dy = F.col("x") - F.col(rx), F.col("y") - F.col(ry)
    near = F.col("dist") <= dist if root else dx * dx + dy * dy <= F.lit(float(dist) * float(dist))
    return l.join(shuffled(r), [*by, "_gx", "_gy"]).withColumn("dist", F.hypot(dx, dy)).filter(near).drop("_gx", "_gy")


#: Candidates that a cell's points choose from; cells with more are split. Cells are not split below the finest size.
LIST, FINEST = 64, 1e-3

#: A wider cell with more rows than this is split on while more candidates than that are left, since every row of it goes through its list.
MANY, SHORT = 64, 8

#: With more candidate rows than this, left rows are shuffled to them instead of leaving that to the planner.
FEW = 65_536


def nearest(left: DataFrame, right: DataFrame, fields: Sequence[str], by: Sequence[str] = (), cell: float = 16.0, prefix: str = "near_") -> DataFrame:
    """Nearest right row per left row (ties: smallest first field); keeps every left row.

    Both sides are seen as grid pyramids (sizes cell*4^l) that are walked down together from one cell each: a left cell keeps the
    right cells that may hold the winner of one of its points, told by the least and the greatest distance between the boxes. As soon as they hold
    at most ``LIST`` rows and few points are in the left cell it is done, however wide, so a stretch far from all right rows costs few cells; else both are split.
    Candidates travel as an array per done cell and the winner is picked by an expression; where a cell of the size ``cell`` still has more,
    its points look again in finer ones (more rows than that at one distance from one spot stay together).
    The left side is never copied; of the right side only rows of a key that occurs on the left take part.
    """
    by, k = list(by), [*by, "_ix", "_iy"]
    placed = left.withColumn("_ix", _cell("x", cell)).withColumn("_iy", _cell("y", cell))
    cells = checkpoint(placed.select(*k).filter("_ix is not null and _iy is not null").groupBy(*k).agg(F.count(F.lit(1)).alias("_m")))
    ref = right.select(*by, F.col("x").alias("rx"), F.col("y").alias("ry"), *[F.col(f).alias("_f_" + f) for f in fields]).filter("rx is not null and ry is not null")
    ref = ref.join(cells.select(*by).distinct(), by, "left_semi") if by else ref
    # copies of one coordinate: only the one with the smallest tie-break can win
    ref = ref.groupBy(*by, "rx", "ry").agg(F.min(F.struct(*["_f_" + f for f in fields])).alias("_f"))
    ref = checkpoint(ref.withColumn("_gx", _cell("rx", cell)).withColumn("_gy", _cell("ry", cell)))
    ends = lambda d, x, y: d.agg(F.min(x), F.max(x), F.min(y), F.max(y)).first()
    wide = [w for w in (ends(cells, "_ix", "_iy"), ends(ref, "_gx", "_gy")) if w[0] is not None]
    extent = max((max(w[i + 1] for w in wide) - min(w[i] for w in wide) for i in (0, 2)), default=0) if wide else 0
    top = next(n for n in range(1, 32) if 4 ** n > extent or n == 31)
    up = lambda d, n, names: d.select(*[F.expr(f"shiftright({c}, cast(2 * ({n}) as int))").alias(c) if c in names else c for c in d.columns])
    # cells of level 1 are far fewer than those of level 0, the coarser ones are told from them
    total = lambda d, *keys: checkpoint(d.groupBy(*k, *keys).agg(F.sum("_m").alias("_m")))
    first = total(up(cells, 1, k[-2:]))
    coarse = total(up(first.select("*", F.explode(F.sequence(F.lit(1), F.lit(top))).alias("_l")), "_l - 1", k[-2:]), "_l")
    levels = lambda l: coarse.filter(F.col("_l") == l).drop("_l") if l else cells
    every = F.explode(F.sequence(F.lit(0), F.lit(top))).alias("_l")
    nodes = checkpoint(up(ref.select(*by, "rx", "ry", "_gx", "_gy", every), "_l", ["_gx", "_gy"]).groupBy(*by, "_l", "_gx", "_gy").agg(
        F.count(F.lit(1)).alias("_n"), F.min("rx").alias("x0"), F.max("rx").alias("x1"), F.min("ry").alias("y0"), F.max("ry").alias("y1")))
    pair = [*k, "_gx", "_gy"]

    def reach(size, x0, x1, y0, y1):
        """Least and greatest distance between a left cell of ``size`` and a box, the latter with what rounding may take."""
        sides = [(F.col(c) * size, (F.col(c) + 1) * size, lo, hi) for c, lo, hi in (("_ix", x0, x1), ("_iy", y0, y1))]
        least = F.hypot(*[F.greatest(lo - b, a - hi, F.lit(0.0)) for a, b, lo, hi in sides])
        most = F.hypot(*[F.greatest(hi - a, b - lo) for a, b, lo, hi in sides])
        return least, most * (1 + 1e-9) + 1e-5 * size

    lists, done, open_ = [], None, None
    for l in range(top, -1, -1):
        size, here = F.lit(float(cell) * 4.0 ** l), nodes.filter(F.col("_l") == l).drop("_l")
        if open_ is None:
            cand, parent = levels(l).join(here, by) if by else levels(l).crossJoin(here), []
        else:
            below = lambda d, x, y, px, py: d.select("*", F.shiftright(x, 2).alias(px), F.shiftright(y, 2).alias(py))
            cand = open_.join(shuffled(below(here, "_gx", "_gy", "_qx", "_qy")), [*by, "_qx", "_qy"])
            cand, parent = cand.join(shuffled(below(levels(l), "_ix", "_iy", "_px", "_py")), [*by, "_px", "_py"]), ["_px", "_py"]
        per = W.partitionBy(*by, *parent, "_ix", "_iy")
        least, most = reach(size, F.col("x0"), F.col("x1"), F.col("y0"), F.col("y1"))
        kept = cand.select(*by, *parent, "_ix", "_iy", "_gx", "_gy", "_m", "_n", least.alias("_least"), most.alias("_most")).withColumn("_most", F.min("_most").over(per))
        kept = kept.filter("_least <= _most").withColumn("_n", F.sum("_n").over(per))
        more = (F.col("_n") > LIST) | ((F.col("_m") > MANY) & (F.col("_n") > SHORT)) if l else F.col("_n") > LIST
        kept, seen = checkpoint_observed(kept.select(*pair, more.alias("_open")), open=F.count_if("_open"))
        fit = kept.filter("not _open") if l or cell >= FINEST else kept
        fine = fit.join(shuffled(up(ref, l, ["_gx", "_gy"])), [*by, "_gx", "_gy"])
        least, most = reach(size, *[F.col(c) for c in ("rx", "rx", "ry", "ry")])
        lists.append(fine.select(*k, F.lit(l).alias("_l"), "rx", "ry", "_f", least.alias("_least"), most.alias("_most")))
        if l:  # all cells of level 1 below a done one
            ends_here = fit.select(*k).distinct().withColumn("_l", F.lit(l))
            if done is not None:
                inherit = levels(l).select("*", F.shiftright("_ix", 2).alias("_px"), F.shiftright("_iy", 2).alias("_py"))
                ends_here = ends_here.unionByName(inherit.join(shuffled(done.withColumnsRenamed({"_ix": "_px", "_iy": "_py"})), [*by, "_px", "_py"]).select(*k, "_l"))
            done = checkpoint(ends_here)
            open_ = kept.filter("_open").select(*by, *[F.col(c).alias(n) for c, n in zip(pair[-4:], ("_px", "_py", "_qx", "_qy"))])
        if not seen["open"]:
            break
    for n in range(l - 1, 0, -1):  # nothing was left open: what is done reaches down to level 1
        inherit = levels(n).select("*", F.shiftright("_ix", 2).alias("_px"), F.shiftright("_iy", 2).alias("_py"))
        done = checkpoint(inherit.join(shuffled(done.withColumnsRenamed({"_ix": "_px", "_iy": "_py"})), [*by, "_px", "_py"]).select(*k, "_l"))
    rows = lists[0]
    for more in lists[1:]:
        rows = rows.unionByName(more)
    rows = rows.withColumn("_most", F.min("_most").over(W.partitionBy(*k, "_l"))).filter("_least <= _most")
    cand, met = checkpoint_observed(rows.groupBy(*k, "_l").agg(F.collect_list(F.struct("rx", "ry", "_f")).alias("_c")), n=F.count(F.lit(1)))
    side = shuffled if met["n"] > FEW else lambda d: d
    d2 = lambda v: (v["rx"] - F.col("x")) * (v["rx"] - F.col("x")) + (v["ry"] - F.col("y")) * (v["ry"] - F.col("y"))

    def pick(rows: DataFrame) -> DataFrame:
        level = done.select(*by, F.col("_ix").alias("_px"), F.col("_iy").alias("_py"), "_l")
        j = rows.withColumn("_px", F.shiftright("_ix", 2)).withColumn("_py", F.shiftright("_iy", 2)).join(side(level), [*by, "_px", "_py"], "left")
        j = up(j.withColumn("_l", F.coalesce("_l", F.lit(0))), "_l", ["_ix", "_iy"]).join(side(cand), [*k, "_l"], "left")
        j = j.withColumn("_b", F.array_min(F.transform("_c", lambda v: F.struct(d2(v).alias("d2"), v["_f"].alias("f")))))
        return j.select(*left.columns, F.sqrt("_b.d2").alias(prefix + "dist"), *[F.col(f"_b.f._f_{f}").alias(prefix + f) for f in fields])

    if l or not seen["open"] or cell < FINEST:
        return pick(placed)
    # cells with a long list: their points look again, from cells an eighth as wide and among those rows only
    dense = kept.filter("_open")
    rest = ref.join(shuffled(dense.select(*by, "_gx", "_gy").distinct()), [*by, "_gx", "_gy"], "left_semi")
    rest = rest.select(*by, F.col("rx").alias("x"), F.col("ry").alias("y"), *[F.col(f"_f._f_{f}").alias(f) for f in fields])
    long = dense.select(*k).distinct()
    again = nearest(placed.join(long, k, "left_semi").select(*left.columns), checkpoint(rest), fields, by, cell / 8, prefix)
    return pick(placed.join(long, k, "left_anti")).unionByName(again)


def in_boxes(points: DataFrame, boxes: DataFrame, cell: float, by: Sequence[str] = ()) -> DataFrame:
    """(point, box) pairs with the point inside [minx,maxx] x [miny,maxy]; boxes are spread over their cells."""
    span = lambda lo, hi: F.explode(F.sequence(_cell(lo, cell), _cell(hi, cell)))
    b = boxes.withColumn("_gx", span("minx", "maxx")).withColumn("_gy", span("miny", "maxy"))
    p = points.withColumn("_gx", _cell("x", cell)).withColumn("_gy", _cell("y", cell))
    j = p.join(b, [*by, "_gx", "_gy"]).drop("_gx", "_gy")
    return j.filter(F.col("x").between(F.col("minx"), F.col("maxx")) & F.col("y").between(F.col("miny"), F.col("maxy")))


def boxes_overlapping(a: DataFrame, b: DataFrame, cell: float, by: Sequence[str] = ()) -> DataFrame:
    """Pairs of overlapping boxes, each pair once: it is reported in the cell of its lower-left corner.

    Columns of ``a`` and ``b`` must differ except for ``by``; boxes are a_minx.. and b_minx...
    """
    def spread(d: DataFrame, p: str) -> DataFrame:
        span = lambda lo, hi: F.explode(F.sequence(_cell(p + lo, cell), _cell(p + hi, cell)))
        return d.withColumn("_gx", span("minx", "maxx")).withColumn("_gy", span("miny", "maxy"))

    j = spread(a, "a_").join(shuffled(spread(b, "b_")), [*by, "_gx", "_gy"])
    low = lambda c: _cell(F.greatest(F.col("a_" + c), F.col("b_" + c)), cell)
    meet = ((F.col("a_maxx") >= F.col("b_minx")) & (F.col("a_minx") <= F.col("b_maxx"))
            & (F.col("a_maxy") >= F.col("b_miny")) & (F.col("a_miny") <= F.col("b_maxy")))
    return j.filter(meet & (F.col("_gx") == low("minx")) & (F.col("_gy") == low("miny"))).drop("_gx", "_gy")


def near_segments(points: DataFrame, segments: DataFrame, dist: float, by: Sequence[str] = ()) -> DataFrame:
    """(point, segment) pairs at most ``dist`` apart; segments carry ax, ay, bx, by_ and are spread over cells."""
    from wayfold.functions.geometry import segment_distance

    lo, hi = lambda a, b: F.least(a, b) - dist, lambda a, b: F.greatest(a, b) + dist
    span = lambda a, b: F.explode(F.sequence(_cell(lo(F.col(a), F.col(b)), dist), _cell(hi(F.col(a), F.col(b)), dist)))
    s = segments.withColumn("_gx", span("ax", "bx")).withColumn("_gy", span("ay", "by_"))
    p = points.withColumn("_gx", _cell("x", dist)).withColumn("_gy", _cell("y", dist))
    j = p.join(shuffled(s), [*by, "_gx", "_gy"]).drop("_gx", "_gy")
    d = segment_distance(F.col("x"), F.col("y"), F.col("ax"), F.col("ay"), F.col("bx"), F.col("by_"))
    return j.withColumn("dist", d).filter(F.col("dist") <= dist)


def nearest_segment(points: DataFrame, segments: DataFrame, by: Sequence[str], start: float) -> DataFrame:
    """Points with ``dist``, the distance to the nearest segment (ax, ay, bx, by_) of their key, however far; keys without segments drop out.

    Rings of doubling reach: only points that found nothing within one reach look farther, where nothing nearer is left
    to meet. Segments are cut to the reach and dealt to cells along their way, so a long one never fills its box.
    """
    from wayfold.functions.geometry import segment_distance

    by, key = list(by), F.struct(F.lit(0).alias("_0"), *by)
    line = checkpoint(segments.select(key.alias("_k"), "ax", "ay", "bx", "by_").filter("ax is not null and ay is not null and bx is not null and by_ is not null"))
    todo = points.withColumn("_k", key).join(line.select("_k").distinct(), "_k", "left_semi").withColumn("_id", F.struct("x", "y"))
    spots = checkpoint(todo.select("_k", "_id", "x", "y").distinct())
    left, reach, found = spots, float(start), None
    while True:
        pieces = F.greatest(F.ceil(F.hypot(F.col("bx") - F.col("ax"), F.col("by_") - F.col("ay")) / reach), F.lit(1)).cast("long")
        at = lambda a, b, f: F.col(a) + (F.col(b) - F.col(a)) * f
        cut = line.withColumn("_n", pieces).withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
        mid = (F.col("_i") + 0.5) / F.col("_n")
        # a piece is at most one reach long: what is within reach of it has its middle within 1.5 cells of twice the reach
        cells = cut.select("_k", "ax", "ay", "bx", "by_", at("ax", "bx", mid).alias("mx"), at("ay", "by_", mid).alias("my"))
        cells = around(cells, 2 * reach, "mx", "my").select("_k", "_gx", "_gy", "ax", "ay", "bx", "by_").distinct()
        met = left.withColumn("_gx", _cell("x", 2 * reach)).withColumn("_gy", _cell("y", 2 * reach)).join(shuffled(cells), ["_k", "_gx", "_gy"])
        d = segment_distance(F.col("x"), F.col("y"), F.col("ax"), F.col("ay"), F.col("bx"), F.col("by_"))
        done = checkpoint(met.withColumn("dist", d).filter(F.col("dist") <= reach).groupBy("_k", "_id").agg(F.min("dist").alias("dist")))
        found = done if found is None else found.unionByName(done)
        left, seen = checkpoint_observed(left.join(done, ["_k", "_id"], "left_anti"), n=F.count(F.lit(1)))
        if not seen["n"]:
            break
        reach *= 2
    return todo.join(found, ["_k", "_id"]).drop("_k", "_id")


def attach_pose(points: DataFrame, poses: DataFrame) -> DataFrame:
    """Points with their frame's pose (p_x .. p_yaw); rows without a pose drop out."""
    p = poses.select("drive_id", "frame_id", *[F.col(c).alias("p_" + c) for c in ("x", "y", "z", "roll", "pitch", "yaw")])
    return points.join(p, ["drive_id", "frame_id"])


def missing_frames(expected: DataFrame, points: DataFrame, poses: DataFrame) -> DataFrame:
    """Expected frames without points or pose, with the first reason."""
    k = ["drive_id", "frame_id"]
    has = lambda d, n: d.select(*k).distinct().withColumn(n, F.lit(True))
    j = expected.select(*k).distinct().join(has(points, "_pts"), k, "left").join(has(poses, "_pose"), k, "left")
    reason = F.when(F.col("_pts").isNull(), "missing_velodyne").when(F.col("_pose").isNull(), "missing_pose_frame")
    return j.withColumn("reason", reason).filter(F.col("reason").isNotNull()).select(*k, "reason")


def part_of(s: Column, boundaries: Column) -> Column:
    """As-of part id: number of boundaries <= s (searchsorted, right)."""
    return F.size(F.filter(boundaries, lambda b: b <= s))


def closest_frame(targets: DataFrame, frames: DataFrame, by: Sequence[str], width: int) -> DataFrame:
    """Existing frame closest to each target (ties low), by one bucketed as-of step in each direction.

    Frames are reduced to the first and last frame of every bucket of ``width`` ids plus the
    bucket's own members, so a target is matched against its own and the adjacent filled buckets only.
    """
    by = list(by)
    f = frames.select(*by, "frame_id").distinct().withColumn("_b", _cell("frame_id", width))
    t = targets.withColumn("_b", _cell("target", width))
    # the last frame of each filled bucket is visible to every later bucket through a running max over buckets
    edge = f.groupBy(*by, "_b").agg(F.min("frame_id").alias("_lo"), F.max("frame_id").alias("_hi"))
    need = t.select(*by, "_b").distinct().join(edge, [*by, "_b"], "full")
    # both directions look back from a row: a frame that runs to the end of its partition is summed up anew for every row
    before = lambda order: W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    need = need.withColumn("_prev", F.max("_hi").over(before(F.asc("_b")))).withColumn("_next", F.min("_lo").over(before(F.desc("_b"))))
    outer = t.join(need.select(*by, "_b", "_prev", "_next"), [*by, "_b"]).select(
        *t.columns, F.explode(F.array("_prev", "_next")).alias("frame_id")).filter("frame_id is not null")
    cand = t.join(f, [*by, "_b"]).select(*t.columns, "frame_id").unionByName(outer)
    best = F.min(F.struct(F.abs(F.col("frame_id") - F.col("target")).alias("gap"), F.col("frame_id").alias("frame_id"))).alias("m")
    return cand.groupBy(*[c for c in t.columns if c != "_b"]).agg(best).select("*", F.col("m.frame_id").alias("frame_id"), F.col("m.gap").alias("gap")).drop("m")
