"""Cut lines, nearest segments at any distance, intersection shapes and merged instances against plain walks."""

import math
import random

import pytest
from pyspark.sql import functions as F

from wayfold.functions import geometry as E
from wayfold.operators import clusters, joins, junctions, lines, ordered

C = F.col


def seg_dist(x, y, ax, ay, bx, by):
    q = (bx - ax) ** 2 + (by - ay) ** 2
    t = min(max(((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / q, 0), 1) if q else 0
    return math.hypot(x - ax - t * (bx - ax), y - ay - t * (by - ay))


@pytest.mark.parametrize("chunk", [4096, 3])
def test_split_keeps_the_length(spark, monkeypatch, chunk):
    monkeypatch.setattr(ordered, "CHUNK", chunk)
    rnd = random.Random(5)
    rows = [(k, i, rnd.uniform(0, 100), rnd.uniform(0, 100)) for k in (None, 1, 2) for i in range(25)]
    v = spark.createDataFrame(rows, "k long, i long, x double, y double")
    boxes = spark.createDataFrame([(10.0, 10.0, 60.0, 40.0), (50.0, 30.0, 90.0, 95.0)], "minx double, miny double, maxx double, maxy double")
    cuts = lines.wall_cuts(v, ["k"], "i", lines.box_walls(boxes), 16.0)
    got = lines.split(v, ["k"], "i", cuts).collect()
    n_cuts = {(r.k, r.i, r.t) for r in cuts.collect()}
    for k in (None, 1, 2):
        own = [r for r in rows if r[0] == k]
        whole = sum(math.hypot(a[2] - b[2], a[3] - b[3]) for a, b in zip(own, own[1:]))
        mine = [r for r in got if r.k == k]
        assert sum(r.step or 0 for r in mine) == pytest.approx(whole, abs=1e-6)
        cut_here = sorted((i, t) for kk, i, t in n_cuts if kk == k)
        assert {r.piece for r in mine} == set(range(len(cut_here) + 1)) and len(mine) == 25 + 2 * len(cut_here) and len(cut_here) > 10
        for p in range(len(cut_here) + 1):
            at = sorted((r.i, r.t) for r in mine if r.piece == p)
            lo, hi = ((-1, 0.0) if p == 0 else cut_here[p - 1]), (cut_here[p] if p < len(cut_here) else (99, 0.0))
            assert at == sorted([(i, 0.0) for i in range(25) if lo < (i, 0.0) < hi] + [c for c in (lo, hi) if 0 <= c[0] < 99])
            assert sum(r.step is None for r in mine if r.piece == p) == 1


def test_nearest_segment_at_any_distance(spark):
    rnd = random.Random(6)
    segs = [(k, *(rnd.uniform(-50, 50) for _ in range(4))) for k in (None, 1) for _ in range(30)] + [(1, 5000.0, 0.0, 9000.0, 7000.0), (2, 0.0, 0.0, 0.0, 0.0), (3, None, 1.0, 2.0, 3.0)]
    pts = [(k, i, rnd.uniform(-80, 80) * rnd.choice([1, 1, 40]), rnd.uniform(-80, 80) * rnd.choice([1, 1, 40])) for k in (None, 1, 2, 3) for i in range(40)]
    got = joins.nearest_segment(spark.createDataFrame(pts, "k long, i long, x double, y double"), spark.createDataFrame(segs, "k long, ax double, ay double, bx double, by_ double"), ["k"], 2.0).collect()
    want = {(k, i): min(seg_dist(x, y, *s[1:]) for s in segs if s[0] == k and None not in s[1:]) for k, i, x, y in pts if k != 3}
    assert {(r.k, r.i) for r in got} == set(want) and all(r.dist == pytest.approx(want[r.k, r.i]) for r in got) and len(got) == len(want)


def shape_brute(seed, road, segs, sat, r):
    centre = lambda c: ((c[0] + 0.5) * r.res, (c[1] + 0.5) * r.res)
    dist = lambda c: math.hypot(centre(c)[0] - seed[0], centre(c)[1] - seed[1])
    src, local = "road_polygon", set()
    for radius in (r.cap, *r.retries):
        local = local or {c for c in road if dist(c) <= radius}
    if not local or min(map(dist, local)) > r.max_offset:
        src, local = "sat_fill", {c for c in sat if dist(c) <= r.sat_reach}
    if not local:
        n = int(r.circle / r.res) + 2
        x, y = int(seed[0] // r.res), int(seed[1] // r.res)
        src, local = "seed_circle", {c for c in ((x + i, y + j) for i in range(-n, n + 1) for j in range(-n, n + 1)) if dist(c) <= r.circle}
    core = {c for c in road if dist(c) <= r.core_radius} if src == "road_polygon" else local
    off = {c: min(seg_dist(*centre(c), *s) for s in segs) for c in road if dist(c) <= r.cap}
    arm, wide = ({c for c, o in off.items() if o <= w} for w in (r.arm, r.arm + r.arm_add))
    sector = lambda c: math.floor((math.atan2(centre(c)[1] - seed[1], centre(c)[0] - seed[0]) / (2 * math.pi) + 1) * 8) % 8
    arms = len({sector(c) for c in arm if dist(c) >= r.core_radius})
    share = lambda s: len(s & local) / len(local)
    if share(core | arm) >= r.coverage:
        return core | arm, {"sat_fill": "sat_fill_fallback", "seed_circle": "seed_circle_fallback"}.get(src) or ("refined_arms" if arm else "core_only")
    if arms >= r.min_arms and share(core | wide) >= r.coverage:
        return core | wide, "coverage_retry"
    return local, "coverage_fallback_road_local"


def test_seed_shapes_against_plain_sets(spark):
    rnd = random.Random(8)
    r = junctions.ShapeRules(res=2.0, cap=12.0, retries=(20.0, 30.0), max_offset=22.0, sat_reach=25.0, circle=5.0, core=(3.0, 9.0), arm=2.0, arm_add=2.5, coverage=0.75, min_arms=2)
    road = {(rnd.randrange(0, 50), rnd.randrange(0, 50)) for _ in range(260)} | {(i, 25) for i in range(50)} | {(25, i) for i in range(50)}
    sat = {(rnd.randrange(60, 80), rnd.randrange(0, 30)) for _ in range(80)}
    segs = [(0.0, 51.0, 100.0, 51.0), (51.0, 0.0, 51.0, 100.0), (10.0, 10.0, 60.0, 90.0)]
    seeds = [(i, rnd.uniform(0, 100), rnd.uniform(0, 100)) for i in range(25)] + [(30, 51.0, 51.0), (31, 140.0, 20.0), (32, 400.0, 400.0), (33, 120.0, 50.0)]
    df = lambda cells: spark.createDataFrame(list(cells), "ix long, iy long")
    cells, about = junctions.seed_shapes(spark.createDataFrame(seeds, "seed long, sx double, sy double"), df(road), spark.createDataFrame(segs, "ax double, ay double, bx double, by_ double"), df(sat), r)
    got = {}
    for row in cells.collect():
        got.setdefault(row.seed, set()).add((row.ix, row.iy))
    why = {row.seed: row for row in about.collect()}
    want = {i: shape_brute((x, y), road, segs, sat, r) for i, x, y in seeds}
    assert got == {i: s for i, (s, _) in want.items()} and {i: w.reason for i, w in why.items()} == {i: reason for i, (_, reason) in want.items()}
    assert len({w.reason for w in why.values()}) >= 5 and all(w.area_m2 == len(got[i]) * 4.0 for i, w in why.items())


def merged(rows, radius):
    """{(group, id): first id of its cluster}, by a walk over all open clusters."""
    out, open_ = {}, {}
    for g, i, x, y in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        for c in open_.setdefault(g, []):
            if math.hypot(c[0] - x, c[1] - y) <= radius:
                c[2] += 1
                c[0], c[1] = (c[0] * (c[2] - 1) + x) / c[2], (c[1] * (c[2] - 1) + y) / c[2]
                out[g, i] = c[3]
                break
        else:
            open_[g].append([x, y, 1, i])
            out[g, i] = i
    return out


def test_merge_instances_against_walk(spark):
    rnd = random.Random(10)
    rows = [(g, 1000 * k + i, rnd.uniform(0, 60), rnd.uniform(0, 60)) for k, g in enumerate(("a", "b")) for i in range(250)]
    df = spark.createDataFrame(rows, "g string, id long, x double, y double")
    got = {(r.g, r.id): r.cluster for r in clusters.merge_instances(df, "id", ["g"], "id", 6.0).collect()}
    assert got == merged(rows, 6.0) and 20 < len(set(got.values())) < 200


def test_many_open_centres_in_one_component(spark):
    n, step = 100_000, 1.5
    df = spark.range(n).select("id", F.lit("a").alias("g"), ((C("id") % 400) * step).alias("x"), (F.floor(C("id") / 400) * step).cast("double").alias("y"))
    out = clusters.merge_instances(df, "id", ["g"], "id", 1.0)
    assert out.where("cluster = id").count() == n


def test_centroid_of_ring(spark):
    ring = [{"x": x, "y": y} for x, y in [(2.0, 1.0), (6.0, 1.0), (6.0, 3.0), (2.0, 3.0), (2.0, 1.0)]]
    df = spark.createDataFrame([(ring,), (ring[::-1],), ([ring[0], ring[1], ring[0]],)], "r array<struct<x double, y double>>")
    assert [tuple(r.c) for r in df.select(E.centroid(C("r")).alias("c")).collect()] == [(4.0, 2.0), (4.0, 2.0), (None, None)]


def test_nearest_splits_cells_with_long_lists(spark, monkeypatch):
    seen = []
    inner = joins.nearest

    def counted(left, right, fields, by=(), cell=16.0, prefix="near_"):
        seen.append((cell, right.count()))
        return inner(left, right, fields, by, cell, prefix)

    monkeypatch.setattr(joins, "nearest", counted)
    n = 1_000_000  # all in one cell of 16 m
    right = spark.range(n).select(C("id"), ((C("id") % 1000) * 0.0159).alias("x"), (F.floor(C("id") / 1000) * 0.0159).alias("y"))
    rnd = random.Random(12)
    pts = [(i, rnd.uniform(0, 16), rnd.uniform(0, 16)) for i in range(60)] + [(90, 400.0, -300.0), (91, 0.0, 0.0)]
    got = joins.nearest(spark.createDataFrame(pts, "i long, x double, y double"), right, ["id"]).collect()
    assert len(got) == len(pts) and len(seen) >= 3
    for i, x, y in pts:
        a, b = (min(max(round(v / 0.0159), 0), 999) for v in (x, y))
        near = [(math.hypot(p * 0.0159 - x, q * 0.0159 - y), p + 1000 * q) for p in range(max(a - 1, 0), min(a + 2, 1000)) for q in range(max(b - 1, 0), min(b + 2, 1000))]
        row = next(r for r in got if r.i == i)
        assert row.near_dist == pytest.approx(min(near)[0]) and row.near_id == min(near)[1]
