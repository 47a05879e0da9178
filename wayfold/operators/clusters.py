"""Clusters by arbitrary pair tests, greedy centroid clusters, merged entities."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wayfold.functions import geometry as E
from wayfold.functions.stats import top_per_group
from wayfold.operators import components as CC, greedy as GR, tiles as T
from wayfold.operators.audits import distinct_steps
from wayfold.operators.joins import within
from wayfold.operators.groups import group_key
from wayfold.operators.shapes import hull_of
from wayfold.session import checkpoint, shuffled


def predicate_components(df: DataFrame, key: str, by: Sequence[str], reach: float, test: GR.Pair, leaders: int = 2) -> DataFrame:
    """Connected components of a symmetric pair test whose rows are at most ``reach`` apart on both axes.

    Pairs inside a tile are made, tested and joined up by one task. Rows near a tile's border or in a crowded tile go
    through ``_pruned_components``, and what they link joins parts of tiles. Rows with a null in ``by`` stay alone.
    """
    by = list(by)
    grouped = F.lit(True)
    for c in by:
        grouped = grouped & F.col(c).isNotNull()
    rows, hot, alone = T.tiled(df.filter(grouped), key, reach, by, "x", "y")
    lab = checkpoint(T.tested_parts(rows, key, reach, "x", "y", lambda d: test(lambda c: F.col("_r_" + c), lambda c: F.col(c))))
    rim = lab.filter("_rim").drop("_rim", "_open")
    if hot is not None:
        hot = checkpoint(hot.withColumn("_part", F.col(key)))
        rim = rim.unionByName(hot)
        lab = lab.unionByName(hot.withColumns({"_rim": F.lit(True), "_open": F.lit(True)}))
    met = _pruned_components(rim.drop("_part"), key, by, reach, test, leaders).select(key, "label")
    links = rim.select(key, "_part").join(shuffled(met), key).select(F.col("_part").alias("src"), F.col("label").alias("dst"))
    cc = CC.connected_components(links).select(F.col("id").alias("_part"), "label")
    crossing = lab.filter("_open").join(shuffled(cc), "_part", "left").withColumn("label", F.coalesce("label", F.col("_part")))
    names = [*df.columns, "label"]
    out = lab.filter("not _open").withColumn("label", F.col("_part")).select(*names).unionByName(crossing.select(*names))
    return out.unionByName(alone.unionByName(df.filter(~grouped)).withColumn("label", F.col(key)).select(*names))


def _pruned_components(df: DataFrame, key: str, by: Sequence[str], reach: float, test: GR.Pair, leaders: int = 2) -> DataFrame:
    """``predicate_components`` by joins.

    Pairs are pruned by component: first a few leader rows per cell are tested against their 3x3
    neighbourhood and joined up; then only (cell, component) groups with different components are
    paired. A crowded cell usually is one component after the first step and is never paired with
    itself, and no pair that still matters is skipped, so the result is exact.
    """
    by = list(by)
    cell = lambda c: F.floor(F.col(c) / F.lit(float(reach))).cast("long")
    base = checkpoint(df.withColumn("_cx", cell("x")).withColumn("_cy", cell("y")))
    cols = base.columns
    k = [*by, "_cx", "_cy"]
    ring = lambda half: F.explode(F.array(*[F.struct(F.lit(a).cast("long").alias("dx"), F.lit(b).cast("long").alias("dy"))
                                            for a in (-1, 0, 1) for b in (-1, 0, 1) if not half or (a, b) >= (0, 0)])).alias("_o")
    move = lambda d, half: d.select("*", ring(half)).withColumn("_cx", F.col("_cx") + F.col("_o.dx")).withColumn("_cy", F.col("_cy") + F.col("_o.dy")).drop("_o")
    lead_of = lambda d: d.select(*k, *[F.col(c).alias("_r_" + c) for c in cols if c not in k])
    same = F.col("_r_" + key) == F.col(key)
    rest, edges = base, None
    for _ in range(leaders):
        row = F.struct(key, *[c for c in cols if c not in (key, *k)])
        lead = rest.groupBy(*k).agg(F.min(row).alias("_m")).select(*k, "_m.*").select(*cols)
        hit = base.join(shuffled(move(lead_of(lead), False)), k).filter(same | test(lambda c: F.col("_r_" + c), lambda c: F.col(c)))
        e = checkpoint(hit.select(F.col(key).alias("src"), F.col("_r_" + key).alias("dst")))
        edges = e if edges is None else edges.unionByName(e)
        rest = rest.join(e.select(F.col("src").alias(key)).distinct(), key, "left_anti")
    lab = checkpoint(CC.label_all(base, key, edges))
    groups = lab.select(*k, "label").distinct()
    other = move(groups.withColumnRenamed("label", "_l2").withColumn("_hx", F.col("_cx")).withColumn("_hy", F.col("_cy")), True)
    gp = groups.join(shuffled(other), k).filter(F.col("label") != F.col("_l2"))
    left = gp.join(shuffled(lab), [*k, "label"])
    right = lab.select(*by, *[F.col(c).alias("_r_" + c) for c in cols if c not in by], F.col("label").alias("_l2"), F.col("_cx").alias("_hx"), F.col("_cy").alias("_hy"))
    more = left.join(shuffled(right), [*by, "_hx", "_hy", "_l2"]).filter(test(lambda c: F.col("_r_" + c), lambda c: F.col(c)))
    more = more.select(F.col("label").alias("src"), F.col("_l2").alias("dst")).distinct()
    top = CC.connected_components(more).select(F.col("id").alias("label"), F.col("label").alias("_top"))
    return lab.join(shuffled(top), "label", "left").withColumn("label", F.coalesce("_top", "label")).drop("_top", "_cx", "_cy")


class _Centre:
    __slots__ = ("x", "y", "name", "rank", "n")

    def __init__(self, x, y, name, rank):
        self.x, self.y, self.name, self.rank, self.n = x, y, name, rank, 1


class _Centres:
    """Open centres by cell: a row looks at the nine cells around its own, however many centres are open."""

    def __init__(self, size: float):
        self.size, self.cells, self.opened = size, {}, 0

    def _cell(self, x: float, y: float) -> tuple[int, int]:
        return math.floor(x / self.size), math.floor(y / self.size)

    def around(self, x: float, y: float):
        """(distance, centre) of the centres in the nine cells; none farther than ``size`` can be left out by mistake."""
        cx, cy = self._cell(x, y)
        for a in (cx - 1, cx, cx + 1):
            for b in (cy - 1, cy, cy + 1):
                for c in self.cells.get((a, b), ()):
                    yield math.hypot(c.x - x, c.y - y), c

    def nearest(self, x: float, y: float):
        return min(self.around(x, y), key=lambda p: (p[0], p[1].rank), default=None)

    def first(self, x: float, y: float):
        """The centre opened first of those within ``size``."""
        return min((c for d, c in self.around(x, y) if d <= self.size), key=lambda c: c.rank, default=None)

    def open(self, x: float, y: float, name) -> None:
        self.cells.setdefault(self._cell(x, y), []).append(_Centre(x, y, name, self.opened))
        self.opened += 1

    def move(self, c: _Centre, x: float, y: float) -> None:
        was, now = self._cell(c.x, c.y), self._cell(x, y)
        c.x, c.y = x, y
        if was != now:
            self.cells[was].remove(c)
            self.cells.setdefault(now, []).append(c)


def merge_instances(df: DataFrame, key: str, by: Sequence[str], order: str, radius: float) -> DataFrame:
    """``df`` with ``cluster``: rows in the order of ``order`` join the first open cluster of their group whose mean lies within ``radius``, else open one.

    A cluster's mean is within the radius of its latest member, so rows that are not linked at 2 * radius never meet: the
    fold runs per linked component. ``cluster`` is the key of the row that opened it.
    """
    # groups with null parts are groups like any other
    base = df.select(group_key(by).alias("g"), F.col(order).alias("o"), F.col(key).alias("k"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    lab = CC.centroid_clusters(base, "k", 2 * radius, ["g"])

    def step(centres, row):
        c = centres.first(row.x, row.y)
        if c is None:
            centres.open(row.x, row.y, row.k)
            return row.k, row.k
        c.n += 1
        centres.move(c, (c.x * (c.n - 1) + row.x) / c.n, (c.y * (c.n - 1) + row.y) / c.n)
        return row.k, c.name

    t = lab.schema["k"].dataType.simpleString()
    src = lab.select(F.xxhash64("g", "label").alias("part"), F.to_json("g").alias("g"), F.to_json(F.struct("label")).alias("label"), "o", "k", "x", "y")
    out = GR.ordered_fold(src, ["part", "g", "label"], ["o", "k"], lambda: _Centres(radius), step, f"k {t}, cluster {t}")
    return df.join(out.withColumnRenamed("k", key), key)


def dense_cell_instances(points: DataFrame, by: Sequence[str], frame: str, size: float, min_points: int, labels: int, min_area: float) -> DataFrame:
    """One instance per label and frame: the k-th densest cell of a frame's points is label k (ties: the lower cell).

    Gives (by, frame, label, points, hull, area_m2, x, y), the hull's centroid; hulls under ``min_area`` drop out.
    """
    k = [*by, frame]
    p = points.select(*k, "x", "y", F.floor(F.col("x") / size).cast("long").alias("gx"), F.floor(F.col("y") / size).cast("long").alias("gy"))
    cells = p.groupBy(*k, "gx", "gy").agg(F.count(F.lit(1)).alias("points")).filter(F.col("points") >= min_points)
    top = top_per_group(cells, k, [F.desc("points"), F.col("gx"), F.col("gy")], labels).select(*k, "gx", "gy", "points", F.col("rank").alias("label"))
    hulls = hull_of(p.join(top, [*k, "gx", "gy"]).select(*k, "label", "x", "y"), [*k, "label"])
    out = top.join(hulls, [*k, "label"]).withColumn("area_m2", E.area(F.col("hull"))).filter(F.col("area_m2") >= min_area)
    return out.withColumn("_c", E.centroid(F.col("hull"))).select(*k, "label", "points", "hull", "area_m2", F.col("_c.x").alias("x"), F.col("_c.y").alias("y"))


def merged_instances(instances: DataFrame, by: Sequence[str], frame: str, radius: float, min_frames: int) -> DataFrame:
    """Instances of one label merged over frames by ``radius``; clusters seen in fewer than ``min_frames`` frames drop out."""
    group = [*by, "label"]
    one = instances.withColumn("_id", F.to_json(F.struct(*group, frame)))
    c = merge_instances(one.select(*group, frame, "_id", "x", "y"), "_id", group, frame, radius).select("_id", "cluster")
    j = one.join(c, "_id").groupBy(*group, "cluster")
    return j.agg(F.min(frame).alias("first_frame"), F.count_distinct(frame).alias("frames_hit"), F.sum("points").alias("points"), F.avg("x").alias("x"), F.avg("y").alias("y"), F.sum("area_m2").alias("area_m2")).filter(F.col("frames_hit") >= min_frames).drop("cluster")


def running_centroids(df: DataFrame, key: str, by: Sequence[str], order: str, tol: str, max_tol: float) -> DataFrame:
    """Greedy clusters with a moving centre, in the order of ``order``.

    A row joins the nearest centre within its ``tol`` and pulls it half way, else it opens a centre
    of its own. A centre is never further than tol/2 from its latest member, so rows of different
    single-linkage components at 2 * max_tol cannot meet: the fold runs per component, streamed
    from a sorted shuffle, and keeps the open centres as its only state, by cells of ``max_tol``.
    """
    by = list(by)
    lab = CC.centroid_clusters(df, key, 2 * max_tol, by).select(*by, "label", F.col(order).alias("_o"), F.col(key).alias("_key"), "x", "y", F.col(tol).alias("_tol"))
    def step(centres, row):
        near = centres.nearest(row.x, row.y)
        if near is not None and near[0] <= row.t:
            gap, c = near
            centres.move(c, (c.x + row.x) / 2, (c.y + row.y) / 2)
            return row.k, c.name, gap
        centres.open(row.x, row.y, row.k)
        return row.k, row.k, 0.0

    part = [f"g{i}" for i in range(len(by))]
    src = lab.select(*[F.col(b).alias(p) for b, p in zip(by, part)], "label", F.col("_o").alias("o"), F.col("_key").alias("k"), "x", "y", F.col("_tol").alias("t"))
    t = src.schema["k"].dataType.simpleString()
    out = GR.ordered_fold(src, [*part, "label"], ["o", "k"], lambda: _Centres(max_tol), step, f"k {t}, centre {t}, snap double")
    return df.join(out.withColumnRenamed("k", key), key)


def leader_clusters(df: DataFrame, key: str, by: Sequence[str], order: str, reach: float, test: GR.Pair, score: Callable) -> DataFrame:
    """First-come leaders (a row near an earlier leader joins, else leads); members go to their best earlier leader.

    ``score(leader, row)`` is minimised; ``reach`` bounds the test on both axes.
    """
    by = list(by)
    kept = GR.greedy_keep(df, key, by, [-F.col(order), -F.col(key)], reach, test)
    lead = kept.filter("kept").select(*by, *[F.col(c).alias("_r_" + c) for c in df.columns if c not in by], F.col("x").alias("rx"), F.col("y").alias("ry"))
    cand = within(df, lead, reach * 2 ** 0.5, by)
    r, m = lambda c: F.col("_r_" + c), lambda c: F.col(c)
    earlier = (r(order) < F.col(order)) | ((r(order) == F.col(order)) & (r(key) < F.col(key)))
    ok = cand.filter((r(key) == F.col(key)) | (earlier & test(r, m)))
    best = ok.groupBy(key).agg(F.min(F.struct((r(key) != F.col(key)).alias("_self"), score(r, m).alias("d"), r(key).alias("leader"))).alias("_b"))
    return df.join(best.select(key, F.col("_b.leader").alias("leader")), key)


def entities(members: DataFrame, cluster: Sequence[str]) -> DataFrame:
    """Frames hit, provider hits (sorted text), median heading difference and extent per cluster."""
    c = list(cluster)
    prov = members.groupBy(*c, "model").agg(F.count(F.lit(1)).alias("_k"))
    prov = prov.groupBy(*c).agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "model", F.col("_k").cast("string")))), ",").alias("provider_hits"))
    a = members.groupBy(*c).agg(F.countDistinct("frame_id").alias("frames_hit"), F.count(F.lit(1)).alias("members"), F.percentile("angle", F.lit(0.5)).alias("heading"),
                                F.avg("x").alias("cx"), F.avg("y").alias("cy"))
    return a.join(prov, c)


def arm_count(df: DataFrame, by: Sequence[str], angle: str, period: float, width: float, out: str) -> DataFrame:
    """Number of angle groups per key: a gap over ``width`` between neighbouring angles starts a group,
    and the two ends join when they meet across the period."""
    by = list(by)
    s = distinct_steps(df, by, angle, 9, period / 64)
    lim = df.groupBy(*by).agg(F.min(angle).alias("_lo"), F.max(angle).alias("_hi"))
    k = s.groupBy(*by).agg((1 + F.count_if(F.col("step") > width)).alias("_k")).join(lim, by)
    wrap = (F.col("_k") > 1) & (F.col("_lo") + period - F.col("_hi") <= width)
    return k.select(*by, (F.col("_k") - F.when(wrap, 1).otherwise(0)).cast("int").alias(out))


def disc_cells(seeds: DataFrame, key: Sequence[str], radius: Column, res: float) -> DataFrame:
    """Cells whose centre is within ``radius`` of each seed: (key, ix, iy, cell_dist)."""
    n = F.floor(F.col("_r") / res).cast("long") + 1
    seq = lambda c: F.explode(F.sequence(F.floor(F.col(c) / res).cast("long") - n, F.floor(F.col(c) / res).cast("long") + n))
    d = seeds.withColumn("_r", radius).select("*", seq("x").alias("ix")).select("*", seq("y").alias("iy"))
    dist = F.hypot((F.col("ix") + 0.5) * res - F.col("x"), (F.col("iy") + 0.5) * res - F.col("y"))
    return d.withColumn("cell_dist", dist).filter(F.col("cell_dist") <= F.col("_r")).select(*key, "ix", "iy", "cell_dist")
