"""Brute-force and invariant checks on small fixtures, including crowded keys."""

import datetime as dt
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfold.functions import geometry as E, stats, transforms as T
from wayfold.operators import audits, clusters, components, graph, greedy, grid, joins, lines, ordered, shapes
from wayfold.plans.registry import provider, register
from wayfold.sources import scans, sinks
from wayfold.streaming import streams

C = F.col
rnd = random.Random(7)


def crowd(n=400, hot=0.4):
    """Points of which a large share sits in one small spot."""
    pts = []
    for i in range(n):
        x, y = (rnd.uniform(50, 51), rnd.uniform(50, 51)) if rnd.random() < hot else (rnd.uniform(0, 100), rnd.uniform(0, 100))
        pts.append((i, round(x, 3), round(y, 3)))
    return pts


def labels_brute(pts, link):
    lab = {p[0]: p[0] for p in pts}

    def find(a):
        while lab[a] != a:
            a = lab[a]
        return a

    for a, b in itertools.combinations(pts, 2):
        if link(a, b):
            ra, rb = find(a[0]), find(b[0])
            if ra != rb:
                lab[max(ra, rb)] = min(ra, rb)
    return {p[0]: find(p[0]) for p in pts}


@pytest.mark.parametrize("eps", [1.5, 4.0, 9.0])
def test_distance_links_equal_single_linkage(spark, eps):
    pts = crowd()
    df = spark.createDataFrame(pts, "id long, x double, y double")
    got = {r["id"]: r["label"] for r in components.centroid_clusters(df, "id", eps).collect()}
    assert got == labels_brute(pts, lambda a, b: math.hypot(a[1] - b[1], a[2] - b[2]) <= eps)


def test_components_of_long_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)]
    got = {r["id"]: r["label"] for r in components.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert {got[i] for i in range(201)} == {0} and {got[1000 + i] for i in range(300)} == {1000}


def test_dbscan_against_brute_force(spark):
    pts = crowd(300)
    eps, k = 3.0, 5
    near = {a[0]: [b[0] for b in pts if math.hypot(a[1] - b[1], a[2] - b[2]) <= eps] for a in pts}
    core = {i for i, n in near.items() if len(n) >= k}
    lab = labels_brute([p for p in pts if p[0] in core], lambda a, b: b[0] in near[a[0]])
    want = {i: lab[i] if i in core else min((lab[j] for j in near[i] if j in core), default=None) for i in near}
    out = components.dbscan(spark.createDataFrame(pts, "id long, x double, y double"), "id", eps, k).collect()
    assert {r["id"]: r["label"] for r in out} == want
    assert {r["id"] for r in out if r["is_core"]} == core


def test_predicate_components_prunes_but_stays_exact(spark):
    pts = [(*p, float(rnd.choice([0, 30, 90]))) for p in crowd(300)]
    df = spark.createDataFrame(pts, "id long, x double, y double, a double")
    test = lambda p, q: (F.hypot(p("x") - q("x"), p("y") - q("y")) <= 5) & (E.angle_diff_180(p("a"), q("a")) <= 40)
    diff = lambda a, b: min(abs(a - b) % 180, 180 - abs(a - b) % 180)
    got = {r["id"]: r["label"] for r in clusters.predicate_components(df, "id", [], 5.0, test).collect()}
    assert got == labels_brute(pts, lambda a, b: math.hypot(a[1] - b[1], a[2] - b[2]) <= 5 and diff(a[3], b[3]) <= 40)


def test_greedy_rounds_equal_sequential_walk_and_small_path(spark):
    pts = [(*p, rnd.random()) for p in crowd(500, 0.5)]
    kept, owner = [], {}
    for p in sorted(pts, key=lambda p: (-p[3], p[0])):
        o = next((k for k in kept if math.hypot(k[1] - p[1], k[2] - p[2]) <= 6), None)
        owner[p[0]] = o[0] if o else p[0]
        if o is None:
            kept.append(p)
    df = spark.createDataFrame(pts, "id long, x double, y double, s double").withColumn("g", F.lit(1))
    near = lambda a, b: F.hypot(a("x") - b("x"), a("y") - b("y")) <= 6
    prio = [C("s"), -C("id")]
    for fn in (greedy.greedy_rounds, greedy.greedy_keep):
        assert {r["id"]: r["owner"] for r in fn(df, "id", ["g"], prio, 6.0, near).collect()} == owner


def test_greedy_keep_splits_big_groups(spark, monkeypatch):
    monkeypatch.setattr(greedy, "SMALL", 20)
    pts = [(*p, rnd.random(), int(p[0] < 60)) for p in crowd(75)]
    df = spark.createDataFrame(pts, "id long, x double, y double, s double, g int")
    near = lambda a, b: F.hypot(a("x") - b("x"), a("y") - b("y")) <= 6
    out = greedy.greedy_keep(df, "id", ["g"], [C("s"), -C("id")], 6.0, near).collect()
    assert len(out) == 75
    for a, b in itertools.combinations([r for r in out if r["kept"]], 2):
        assert a["g"] != b["g"] or math.hypot(a["x"] - b["x"], a["y"] - b["y"]) > 6


def test_distance_links_of_crowded_cells(spark):
    """Two crowded neighbouring cells, just apart and just linked; a wide scatter against brute force."""
    eps = 1.0
    for shift in (1.31, 1.28):
        pts = [(i, rnd.random() * 0.3, rnd.random() * 0.6) for i in range(3000)] + [(3000 + i, shift + rnd.random() * 0.3, rnd.random() * 0.6) for i in range(3000)]
        pts += [(6000, 0.3, 0.3), (6001, shift, 0.3)]
        out = components.centroid_clusters(spark.createDataFrame(pts, "id long, x double, y double"), "id", eps).select("label").distinct().count()
        gap = min(p[1] for p in pts if p[1] > 0.7) - max(p[1] for p in pts if p[1] < 0.7)
        assert out == (1 if gap <= eps else 2)
    pts = [(i, rnd.random() * 12, rnd.random() * 12) for i in range(260)]
    label = list(range(260))
    for i, j in itertools.combinations(range(260), 2):
        if math.hypot(pts[i][1] - pts[j][1], pts[i][2] - pts[j][2]) <= 0.8 and label[i] != label[j]:
            lo, hi = sorted((label[i], label[j]))
            label = [lo if v == hi else v for v in label]
    got = {r["id"]: r["label"] for r in components.centroid_clusters(spark.createDataFrame(pts, "id long, x double, y double"), "id", 0.8).collect()}
    assert [got[i] for i in range(260)] == label


def test_nearest_far_and_near(spark):
    left = [(i, rnd.uniform(0, 2000), rnd.uniform(0, 30)) for i in range(200)]
    right = [(i, rnd.uniform(900, 950), rnd.uniform(0, 30)) for i in range(50)]
    got = joins.nearest(spark.createDataFrame(left, "id long, x double, y double"), spark.createDataFrame(right, "rid long, x double, y double"), ["rid"], [], 8.0).collect()
    want = {a[0]: min(right, key=lambda b: (math.hypot(a[1] - b[1], a[2] - b[2]), b[0]))[0] for a in left}
    assert {r["id"]: r["near_rid"] for r in got} == want


def test_overlapping_boxes_beyond_any_fixed_reach(spark):
    """One path or the other: a group of 512 rows and one of 513 give the same selection."""
    from wayfold.functions import geometry as E

    for n in (512, 513):
        rows = [(0, 0.9, 0.0, 0.0, 2000.0, 2000.0), (1, 0.8, 400.0, 0.0, 2400.0, 2000.0)] + [(k, 0.5, 5000.0 * k, 0.0, 5000.0 * k + 1, 1.0) for k in range(2, n)]
        d = spark.createDataFrame(rows, "id long, s double, x0 double, y0 double, x1 double, y1 double").withColumn("g", F.lit(1)).withColumn("x", (C("x0") + C("x1")) / 2).withColumn("y", (C("y0") + C("y1")) / 2)
        box = lambda f: E.make_box(f("x0"), f("y0"), f("x1"), f("y1"))
        out = greedy.greedy_keep(d, "id", ["g"], [C("s"), -C("id")], F.greatest(C("x1") - C("x0"), C("y1") - C("y0")), lambda a, b: E.box_iou(box(a), box(b)) >= 0.5)
        assert out.filter("kept").count() == n - 1 and out.filter("id = 1").first()["owner"] == 0


def test_nearest_reaches_any_distance(spark):
    left = spark.createDataFrame([(1, 0.0, 0.0)], "id long, x double, y double")
    right = spark.createDataFrame([(7, 5_036_000.0, 3.0), (8, 6e6, 0.0)], "rid long, x double, y double")
    assert joins.nearest(left, right, ["rid"], [], 0.01).collect()[0]["near_rid"] == 7


def test_penalty_is_the_distance_outside_a_band(spark):
    from wayfold.operators import gates

    r = spark.createDataFrame([(v,) for v in (0.5, 0.55, 0.45, 0.3, 0.95, 0.99)], "x double").select(gates.band_penalty(C("x"), (0.55, 0.35), (0.90, 0.97)).alias("p")).collect()
    assert [round(x["p"], 6) for x in r] == [0.25, 0.0, 0.5, 100.5, round(0.05 / 0.07, 6), 100.2]


def test_nearest_without_targets_keeps_rows(spark):
    left = spark.createDataFrame([(1, 1.0, 2.0)], "id long, x double, y double")
    right = spark.createDataFrame([], "rid long, x double, y double")
    assert joins.nearest(left, right, ["rid"]).collect()[0]["near_rid"] is None


def test_two_level_windows_cross_chunks(spark):
    rows = [(k, i, float((i * 7) % 5)) for k in (1, 2) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, i long, v double")
    out = ordered.running_sum(df, ["k"], ["i"], F.floor(C("i") / 16), C("v"), "s")
    idx = ordered.dense_index(out, ["k"], [F.desc("i")], -F.floor(C("i") / 16), "n").collect()
    for r in idx:
        assert r["s"] == sum(float((j * 7) % 5) for j in range(r["i"] + 1)) and r["n"] == 299 - r["i"]
    w = ordered.halo_window(["k"], "i")
    h = ordered.drop_halo(ordered.with_halo(df, "i", 2, 16).withColumn("p", F.lag("v", 2).over(w)), "i", 16).collect()
    assert len(h) == 600 and all(r["p"] == (None if r["i"] < 2 else float(((r["i"] - 2) * 7) % 5)) for r in h)


def test_points_without_trajectory_keep_a_part(spark):
    from types import SimpleNamespace

    from wayfold.queries.q_g_clusters import cut_parts, refined

    poses = spark.createDataFrame([(1, k, 10.0 * k, 0.0) for k in range(70)], "drive_id int, frame_id long, x double, y double")
    points = spark.createDataFrame([(d, 45.0 * k, 3.0) for d in (1, 2, None) for k in range(15)], "drive_id int, x double, y double")
    c = SimpleNamespace(poses=poses, points=points)
    for parts in (cut_parts(c), refined(c, 60.0)):
        got = parts.collect()
        assert len(got) == 45 and all((r["part"] == -1) == (r["drive_id"] != 1) for r in got)
        assert len({r["part"] for r in got if r["drive_id"] == 1}) == 3


def test_null_keys_stay_in_rasters_and_two_level_windows(spark):
    rows = [(d, i, 0.3 * i, 0.0, float(i), 0.1) for d in (None, 1) for i in range(6)]
    p = spark.createDataFrame(rows, "drive_id int, i long, x double, y double, z double, intensity double")
    count = lambda d, n: sorted((r["drive_id"] or 0, r["ix"], r["iy"], r[n]) for r in d.collect())
    assert count(grid.ground_rasters(p, 1.0, 9.0, ["drive_id"]), "density_all") == count(grid.cell_density(p, 1.0, ["drive_id"]), "n")
    chunk = F.when(C("i") >= 2, F.floor(C("i") / 2))  # the first chunk is null
    out = ordered.dense_index(ordered.running_sum(p, ["drive_id"], ["i"], chunk, C("z"), "s"), ["drive_id"], ["i"], chunk, "n").collect()
    assert len(out) == 12 and all(r["n"] == r["i"] and r["s"] == sum(range(r["i"] + 1)) for r in out)


def test_exact_percentiles_match_numpy(spark):
    v = [rnd.choice([0.1, 0.5, rnd.random() * 9]) for _ in range(501)]
    df = spark.createDataFrame([(1, x) for x in v], "k int, v double")
    r = stats.exact_percentiles(df, ["k"], "v", {"a": .1, "b": .5, "c": .937}, 0.25).collect()[0]
    assert np.allclose([r["a"], r["b"], r["c"]], np.percentile(v, [10, 50, 93.7]))
    g = stats.exact_percentiles(df, [], "v", {"b": .5}, 0.25).collect()[0]
    assert math.isclose(g["b"], np.median(v))


def test_hull_and_rectangle(spark):
    t = math.radians(27)
    base = [(float(u), float(v)) for u in range(9) for v in range(4)]
    pts = [(1, u * math.cos(t) - v * math.sin(t), u * math.sin(t) + v * math.cos(t)) for u, v in base]
    df = spark.createDataFrame(pts, "k int, x double, y double")
    for bucket in (4096, 5):
        h = shapes.hull_of(df, ["k"], bucket)
        r = h.select(E.area(C("hull")).alias("a"), E.rotated_rect("hull").alias("m")).collect()[0]
        assert abs(r["a"] - 24) < 1e-6 and abs(r["m"]["rect_l"] - 8) < 1e-6 and abs(r["m"]["rect_w"] - 3) < 1e-6 and abs(r["m"]["angle"] - 27) < 1e-6


def test_convex_clip_matches_raster():
    a = np.array([(0, 0), (6, 1), (5, 5), (1, 4)], float)
    b = np.array([(3, -1), (8, 3), (4, 6)], float)

    def inside(r, x, y):
        n = np.roll(r, -1, axis=0)
        return np.all([(q[0] - p[0]) * (y - p[1]) - (q[1] - p[1]) * (x - p[0]) >= 0 for p, q in zip(r, n)], axis=0)

    g = np.arange(-2, 9, 0.01) + 0.005
    x, y = np.meshgrid(g, g)
    assert abs(E.clip_area(a, b) - np.sum(inside(a, x, y) & inside(b, x, y)) * 1e-4) < 0.05
    assert math.isclose(E.clip_area(a, b), E.clip_area(b[::-1], a))


def test_rasterise_concave_ring(spark):
    ring = [(0.0, 0.0), (6.0, 0.0), (6.0, 4.0), (4.0, 4.0), (4.0, 2.0), (2.0, 2.0), (2.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
    df = spark.createDataFrame([(1, [{"x": a, "y": b} for a, b in ring])], "id int, ring array<struct<x:double,y:double>>")
    got = {(r["ix"], r["iy"]) for r in shapes.rasterise(df, "id", "ring", 1.0).collect()}
    assert got == {(i, j) for i in range(6) for j in range(4)} - {(2, 2), (3, 2), (2, 3), (3, 3)}


def test_simplified_lines_are_not_cut(spark):
    """Whole lines, longer than any chunk, as the in-memory version gives them."""
    rows, want = [], {}
    for k in range(3):
        v = np.array([(i * 1.0, 40 * math.sin(i / 37 + k) + rnd.random()) for i in range(1300 + k)])
        rows += [(k, i * 2, float(a), float(b)) for i, (a, b) in enumerate(v)]
        want[k] = [tuple(p) for p in E.thin_line(v, 3.0)]
    rows.append((9, 0, 1.0, 1.0))
    got = lines.simplified(spark.createDataFrame(rows, "k int, i long, x double, y double"), ["k"], "i", 3.0).collect()
    assert {k: [(r["x"], r["y"]) for r in sorted(got, key=lambda r: r["i"]) if r["k"] == k] for k in range(3)} == want
    assert sum(r["k"] == 9 for r in got) == 1


def test_simplify_keeps_tolerance(spark):
    v = [{"x": float(i), "y": math.sin(i / 3)} for i in range(60)]
    df = spark.createDataFrame([(v,)], "v array<struct<x:double,y:double>>").select(E.simplify("v", F.lit(0.3)).alias("w"))
    w = [(p["x"], p["y"]) for p in df.collect()[0]["w"]]
    assert w[0] == (0.0, 0.0) and w[-1][0] == 59.0 and len(w) < 60
    xs = [p[0] for p in w]
    for p in v:
        assert abs(np.interp(p["x"], xs, [q[1] for q in w]) - p["y"]) <= 0.35


def test_ransac_finds_plane_and_ignores_clutter(spark):
    pts = [(1, rnd.uniform(0, 20), rnd.uniform(0, 20)) for _ in range(300)]
    rows = [(k, x, y, 0.1 * x - 0.05 * y + 2) for k, x, y in pts] + [(1, rnd.uniform(0, 20), rnd.uniform(0, 20), rnd.uniform(5, 9)) for _ in range(80)]
    r = audits.ransac_plane(spark.createDataFrame(rows, "k int, x double, y double, z double"), ["k"], 40, 0.1, 0.5).collect()[0]
    assert abs(r["a"] - 0.1) < 1e-6 and abs(r["b"] + 0.05) < 1e-6 and r["inliers"] >= 300 and r["n"] == 380


def test_fft_snr_prefers_stripes(spark):
    def patch(k, f):
        return [(k, r, c, float(f(r, c))) for r in range(32) for c in range(32)]

    noise = np.random.default_rng(1).random((32, 32))
    rows = patch(1, lambda r, c: 1 + math.cos(2 * math.pi * c / 4)) + patch(2, lambda r, c: float(noise[r, c]))
    out = {r["k"]: r["snr"] for r in audits.patch_snr(spark.createDataFrame(rows, "k int, row int, col int, v double"), ["k"], "v", 32).collect()}
    assert out[1] > 100 * out[2]


def test_width_profile_of_straight_road(spark):
    line = spark.createDataFrame([(1, i, 10.0 + 5 * i, 20.0) for i in range(17)], "k int, idx long, x double, y double")
    walls = lines.box_walls(spark.createDataFrame([(0.0, 14.0, 120.0, 29.0)], "minx double, miny double, maxx double, maxy double"))
    w = lines.width_profile(line, walls, ["k"], 10.0, 30.0).collect()
    assert len(w) == 9 and all(abs(r["width"] - 15.0) < 1e-9 for r in w)


def test_merge_dangling_is_sequential(spark):
    # node 1 and node 2 are dead ends close to each other: the first edge merges into node 2, which then is no dead end
    edges = spark.createDataFrame([(10, 5, 1, 20.0), (11, 6, 2, 20.0), (12, 5, 6, 20.0), (13, 5, 7, 20.0), (14, 6, 7, 20.0)], "edge_id long, from_node long, to_node long, length_m double")
    nodes = spark.createDataFrame([(1, 0, 0.0, 0.0), (2, 0, 1.0, 0.0), (5, 0, 50.0, 0.0), (6, 0, 0.0, 60.0), (7, 0, 90.0, 90.0)], "node_id long, bucket int, x double, y double")
    out = graph.merge_dangling(edges, nodes, 5.0, 3.0, "bucket").collect()
    assert [(r["edge_id"], r["node_id"], r["target"]) for r in out] == [(10, 1, 2)]


def test_merge_dangling_against_walk(spark):
    n, m = 60, 70
    xy = {i: (rnd.uniform(0, 30), rnd.uniform(0, 30)) for i in range(n)}
    es = [(e, rnd.randrange(n), rnd.randrange(n), 10.0) for e in range(m)]
    es = [e for e in es if e[1] != e[2]]
    deg = {i: 0 for i in range(n)}
    for _, a, b, _l in es:
        deg[a] += 1
        deg[b] += 1
    want = []
    for e, a, b, _l in es:
        if deg[a] == 1 or deg[b] == 1:
            v = a if deg[a] == 1 else b
            d, t = min((math.dist(xy[v], xy[j]), j) for j in range(n) if j != v)
            if d <= 4.0:
                deg[v] -= 1
                deg[t] += 1
                want.append((e, v, t))
    edges = spark.createDataFrame(es, "edge_id long, from_node long, to_node long, length_m double")
    nodes = spark.createDataFrame([(i, 0, *p) for i, p in xy.items()], "node_id long, bucket int, x double, y double")
    got = sorted((r["edge_id"], r["node_id"], r["target"]) for r in graph.merge_dangling(edges, nodes, 5.0, 4.0, "bucket").collect())
    assert got == sorted(want)


def test_running_centroids_against_walk(spark):
    pts = crowd(200)
    centres, want = [], {}
    for i, x, y in pts:
        best = min(centres, key=lambda c: math.hypot(c[0] - x, c[1] - y), default=None)
        if best is not None and math.hypot(best[0] - x, best[1] - y) <= 5.0:
            best[0], best[1] = (best[0] + x) / 2, (best[1] + y) / 2
            want[i] = best[2]
        else:
            centres.append([x, y, i])
            want[i] = i
    df = spark.createDataFrame(pts, "id long, x double, y double").withColumn("tol", F.lit(5.0)).withColumn("g", F.lit(1))
    assert {r["id"]: r["centre"] for r in clusters.running_centroids(df, "id", ["g"], "id", "tol", 5.0).collect()} == want


def test_grid_invariants(spark):
    df = spark.createDataFrame([(0, i % 37 * 1.0, i % 11 * 1.0, float(i % 7)) for i in range(900)], "drive_id int, x double, y double, z double")
    assert grid.cell_density(df, 5.0).agg(F.sum("n")).first()[0] == 900
    m = grid.with_cell(df, 5.0).select("drive_id", "ix", "iy").distinct()
    once = grid.close_mask(m, 1, ["drive_id"])
    assert m.join(once, ["drive_id", "ix", "iy"], "left_anti").isEmpty()
    assert once.exceptAll(grid.close_mask(once, 1, ["drive_id"])).isEmpty()
    o = grid.cell_set_overlap(m.withColumnRenamed("drive_id", "a"), m.withColumnRenamed("drive_id", "b"), "a", "b").first()
    assert o["iou"] == 1.0


def test_utm32_known_point(spark):
    df = spark.createDataFrame([(49.0, 9.0), (48.98, 8.39)], "lat double, lon double")
    e, n = T.to_utm32(C("lat"), C("lon"))
    r = df.select(e.alias("e"), n.alias("n")).collect()
    assert abs(r[0]["e"] - 500000) < 1e-6 and abs(r[0]["n"] - 5427455.7812) < 1e-3 and 455000 < r[1]["e"] < 456000


def test_sinks_round_trip(spark, tmp_path):
    p = spark.createDataFrame([(1, i // 10, i) for i in range(200)], "drive_id int, frame_id long, pt_id long")
    parts = sinks.frame_parts(p, 800, 6)
    sinks.write_parts(parts, str(tmp_path / "parts"), "drive_id", "part")
    assert spark.read.parquet(str(tmp_path / "parts")).count() == 200
    calls = []
    build = lambda: calls.append(1) or p
    for _ in range(2):
        assert sinks.cached(spark, str(tmp_path / "c"), {"a": 1}, [], build).count() == 200
    assert len(calls) == 1
    src = str(tmp_path / "src")
    p.write.parquet(src)
    fresh = lambda: sinks.cached(spark, str(tmp_path / "c"), {"b": 1}, [spark.read.parquet(src)], lambda: spark.read.parquet(src)).count()
    assert fresh() == fresh() == 200
    p.limit(50).write.mode("append").parquet(src)
    assert fresh() == 250  # changed input, new table
    sinks.write_jsonl(p, str(tmp_path / "j"))
    assert scans.read_jsonl(spark, str(tmp_path / "j"), "drive_id int, pt_id long").filter("not bad").count() == 200
    sinks.write_trace(p, str(tmp_path / "t"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "t")).count() == 200


def test_binary_sweeps_from_files(spark, tmp_path):
    d = tmp_path / "2013_05_28_drive_0007_sync"
    d.mkdir()
    (d / "0000000012.bin").write_bytes(np.arange(8, dtype="<f4").tobytes() + b"xyz")
    r = scans.read_sweeps(spark, str(tmp_path)).orderBy("pt_idx").collect()
    assert [(x["drive_id"], x["frame_id"], x["x"], x["intensity"]) for x in r] == [("2013_05_28_drive_0007_sync", 12, 0.0, 3.0), ("2013_05_28_drive_0007_sync", 12, 4.0, 7.0)]


def test_stream_drops_late_rows_and_repeats(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    t0 = dt.datetime(2024, 1, 1, 12)
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double"
    for k, rows in enumerate([[(1, t0, 1, "a", 1.0), (1, t0, 1, "a", 1.0), (2, t0 + dt.timedelta(hours=30), 1, "a", 2.0)], [(3, t0, 1, "a", 9.0), (4, t0 + dt.timedelta(hours=31), 1, "a", 3.0)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(src / f"b={k}"))
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src / "b=*"))
    streams.run_to_table(streams.drop_repeats(s, ["event_id"]), str(out), "append")
    ids = [r["event_id"] for r in spark.read.parquet(str(out / "table")).collect()]
    assert sorted(ids) in ([1, 2, 4], [1, 2, 3, 4]) and ids.count(1) == 1


def test_provider_registry(spark):
    @register("test_double")
    def double(df, k=2):
        return df.withColumn("v", C("v") * k)

    df = spark.createDataFrame([(3,)], "v int")
    assert df.transform(provider("test_double", k=4)).first()["v"] == 12
    with pytest.raises(KeyError):
        provider("absent")


def test_null_groups_are_groups_like_any_other(spark):
    r = random.Random(21)
    base = [(i, r.uniform(0, 40), r.uniform(0, 40), r.uniform(0, 3), r.random()) for i in range(300)]
    rows = [(d, k, x, y, z, v) for k, d in ((0, None), (1, 7)) for _, x, y, z, v in base]
    df = spark.createDataFrame(rows, "drive_id long, copy int, x double, y double, z double, intensity double")
    by = ["drive_id"]

    def same(out):
        got = {}
        for row in out.collect():
            d = row.asDict()
            got.setdefault(d.pop("drive_id"), []).append(tuple(round(v, 6) if isinstance(v, float) else v for _, v in sorted(d.items()) if not isinstance(v, tuple)))
        assert set(got) == {None, 7} and sorted(got[None], key=str) == sorted(got[7], key=str)

    base_z = grid.min_height(df, 4.0, by)
    same(grid.ground_rasters(df, 4.0, 0.5, by))
    same(grid.slope(base_z, "z_base", 4.0, by))
    same(grid.bev_tiles(df, 1.0, 8, by))
    same(grid.road_points(df, 4.0, 0.5, 1, 9.0, by).drop("copy"))
    same(grid.marking_score(grid.road_points(df, 4.0, 0.5, 1, 9.0, by), 0.9, by, 0.01))
    same(grid.surface_points(df, base_z, base_z.filter("z_base < 1"), 4.0, 0.5, by).drop("copy"))
    same(grid.box_window(base_z, "z_base", 1, by))
    ids = spark.createDataFrame([(d, i + 1000 * k, x, y, v) for k, d in ((0, None), (1, 7)) for i, x, y, _, v in base], "drive_id long, id long, x double, y double, q double")
    strip = lambda out, *cols: out.select("drive_id", *[(C(c) % 1000).alias(c) for c in cols])
    same(strip(components.centroid_clusters(ids, "id", 2.0, by), "id", "label"))
    for small in (512, 20):
        greedy.SMALL, was = small, greedy.SMALL
        try:
            kept = greedy.greedy_keep(ids, "id", by, [C("q"), -(C("id") % 1000)], 3.0, lambda a, b: F.hypot(a("x") - b("x"), a("y") - b("y")) <= 3)
            assert kept.columns[: len(ids.columns)] == ids.columns and kept.count() == 600
            same(strip(kept, "id", "owner"))
        finally:
            greedy.SMALL = was


def test_ground_rasters_shuffle_once_per_key(spark):
    df = spark.range(100).select((C("id") % 3).alias("drive_id"), (C("id") * 1.0).alias("x"), (C("id") * 1.0).alias("y"), (C("id") * 0.1).alias("z"), C("id").cast("double").alias("intensity"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = grid.ground_rasters(df, 4.0, 0.5, ["drive_id"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") <= 3


@pytest.mark.parametrize("diagonal", [True, False])
def test_cell_components_link_only_across_tiles(spark, monkeypatch, diagonal):
    """A solid block of cells over several tiles becomes a graph of its tiles, and cells without a place stay alone."""
    block = [(g, x, y) for g in (None, 1) for x in range(-70, 70) for y in range(-70, 70)] + [(1, 300, 300), (1, 301, 301), (1, None, 4)]
    met = []
    plain = components.connected_components

    def seen(edges, *args, **kwargs):
        met.append(edges.count())
        return plain(edges, *args, **kwargs)

    monkeypatch.setattr(components, "connected_components", seen)
    cells = spark.createDataFrame(block, "g long, ix long, iy long")
    n = grid.area_components(cells, 1.0, ["g"], diagonal).groupBy("g", "cells").count()
    got = {(r["g"], r["cells"]): r["count"] for r in n.collect()}
    assert got == ({(None, 19600): 1, (1, 19600): 1, (1, 2): 1, (1, 1): 1} if diagonal else {(None, 19600): 1, (1, 19600): 1, (1, 1): 3})
    assert sum(met) < 8000
    lab = components.cell_components(cells, ["g"], diagonal).filter("ix < 100").groupBy("g", "label").count().collect()
    assert {(r["g"], r["label"]["ix"], r["label"]["iy"], r["count"]) for r in lab} == {(None, -70, -70, 19600), (1, -70, -70, 19600)}


def test_closest_frame_looks_back_in_both_directions(spark):
    frames = spark.createDataFrame([(1, f) for f in (5, 400, 1000, 5000)], "d long, frame_id long")
    targets = spark.createDataFrame([(1, t) for t in (0, 200, 203, 702, 3000, 9000)], "d long, target long")
    out = joins.closest_frame(targets, frames, ["d"], 64)
    assert {r["target"]: r["frame_id"] for r in out.collect()} == {0: 5, 200: 5, 203: 400, 702: 1000, 3000: 1000, 9000: 5000}
    assert "unboundedfollowing" not in out._jdf.queryExecution().optimizedPlan().toString().lower()


def test_greedy_small_groups_are_cut_where_nothing_is_in_reach(spark):
    """As in the rounds for large groups, rows farther apart than the reach never meet, whatever the test says."""
    rows = [(i, 1, 100.0 * (i % 3) + 0.1 * i, 0.0) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, g long, x double, y double")
    small = greedy.greedy_keep(df, "id", ["g"], [-C("id")], 10.0, lambda a, b: F.lit(True))
    assert {r["id"]: r["owner"] for r in small.collect()} == {i: i % 3 for i in range(30)}


def test_raster_blocks_count_the_cells_of_rasterise(spark):
    rings = [(i, [(x + a, y + b) for a, b in ((0, 0), (7.3, 2.1), (5.2, 8.4), (-3.1, 4.4))]) for i, (x, y) in enumerate([(0.0, 0.0), (-20.3, -7.7), (100.9, 3.3)])]
    df = spark.createDataFrame(rings, "id long, ring array<struct<x:double,y:double>>")
    b = shapes.raster_blocks(df, "id", "ring", 0.5, 4)
    got = {(r["id"], r["jx"], r["jy"]): r["n"] for r in b.groupBy("id", "jx", "jy").agg(F.sum("n").alias("n")).collect()}
    cells = shapes.rasterise(df, "id", "ring", 0.5).withColumn("jx", F.floor(C("ix") / 4)).withColumn("jy", F.floor(C("iy") / 4))
    assert got == {(r["id"], r["jx"], r["jy"]): r["n"] for r in cells.groupBy("id", "jx", "jy").agg(F.count("*").alias("n")).collect()}
    assert b.count() * 2 < cells.count()


def test_marking_score_reads_its_points_once(spark, monkeypatch):
    kept, plain = [], grid.checkpoint
    monkeypatch.setattr(grid, "checkpoint", lambda df: kept.append(df.columns) or plain(df))
    pts = spark.createDataFrame([(1, i % 3, 0, i / 10) for i in range(12)], "g long, ix long, iy long, intensity double")
    s = {r["ix"]: r["score"] for r in grid.marking_score(pts, 0.75, ["g"], 0.1).collect()}
    assert s == {0: 0.25, 1: 0.25, 2: 0.25} and len(kept) == 1


def test_ransac_draws_are_the_same_in_parts(spark, monkeypatch):
    pts = spark.createDataFrame([(1, float(i % 7), float(i % 11), 0.1 * (i % 3)) for i in range(200)], "g long, x double, y double, z double")
    fit = lambda: [r.asDict() for r in audits.ransac_plane(pts, ["g"], 4, 0.4, 0.5).collect()]
    whole = fit()
    monkeypatch.setattr(audits, "DRAWN", 8)
    assert whole == fit() and whole[0]["n"] == 200


def _linked(rows, near):
    """Smallest id reachable over ``near``, by brute force."""
    label = {r[0]: r[0] for r in rows}
    while True:
        new = {a[0]: min([label[a[0]], *[label[b[0]] for b in rows if near(a, b)]]) for a in rows}
        if new == label:
            return label
        label = new


@pytest.mark.parametrize("side, crowd, dense", [(64, 4096, 64), (4, 4096, 64), (4, 20, 64), (2, 4096, 2)])
def test_clusters_and_snapped_ends_by_tiles(spark, monkeypatch, side, crowd, dense):
    from wayfold.operators import graph, tiles
    for name, v in (("SIDE", side), ("CROWD", crowd), ("DENSE", dense)):
        monkeypatch.setattr(tiles, name, v)
    rng = np.random.default_rng(5)
    pts = [(i, float(a), float(b)) for i, (a, b) in enumerate(np.round(rng.uniform(-30, 30, (220, 2)) * 2) / 2)]
    near = lambda a, b: np.hypot(a[1] - b[1], a[2] - b[2]) <= 2.5
    odd = [(1000, float("nan"), 1.0), (1001, None, 2.0), (1002, float("inf"), 2.0)]
    df = spark.createDataFrame(pts + odd, "end_id long, x double, y double")
    want = _linked(pts, near) | {o[0]: o[0] for o in odd}
    assert {r["end_id"]: r["label"] for r in components.centroid_clusters(df, "end_id", 2.5).collect()} == want
    owner = {}
    for p in pts:
        owner[p[0]] = next((q[0] for q in pts[:p[0]] if owner[q[0]] == q[0] and near(p, q)), p[0])
    got = {r["end_id"]: r["node_id"] for r in graph.snap_endpoints(df, 2.5).collect()}
    assert got == owner | {o[0]: o[0] for o in odd}


def test_only_rows_near_a_border_are_linked_by_joins(spark, monkeypatch):
    links, seen = components.distance_links, []

    def counted(df, *args, **kwargs):
        seen.append(df.count())
        return links(df, *args, **kwargs)

    monkeypatch.setattr(components, "distance_links", counted)
    df = spark.range(1000).selectExpr("id", "id * 0.4 + 1000 as x", "pmod(id * 7, 40) + 100.0 as y")
    assert components.centroid_clusters(df, "id", 1.0).count() == 1000
    assert sum(seen) < 200  # all 1000 before


@pytest.mark.parametrize("side, crowd, dense", [(64, 4096, 64), (4, 20, 64), (2, 4096, 2)])
def test_pair_components_by_tiles(spark, monkeypatch, side, crowd, dense):
    from wayfold.operators import tiles
    for name, v in (("SIDE", side), ("CROWD", crowd), ("DENSE", dense)):
        monkeypatch.setattr(tiles, name, v)
    pruned, seen = clusters._pruned_components, []
    monkeypatch.setattr(clusters, "_pruned_components", lambda df, *a, **k: seen.append(df.count()) or pruned(df, *a, **k))
    rng = np.random.default_rng(6)
    pts = [(i, float(a), float(b), i % 7, 0) for i, (a, b) in enumerate(np.round(rng.uniform(10, 70, (220, 2)) * 2) / 2)]
    near = lambda a, b: abs(a[1] - b[1]) <= 2 and abs(a[2] - b[2]) <= 2 and abs(a[3] - b[3]) <= 2
    test = lambda a, b: (F.abs(a("x") - b("x")) <= 2) & (F.abs(a("y") - b("y")) <= 2) & (F.abs(a("w") - b("w")) <= 2)
    odd = [(1000, float("nan"), 1.0, 1, 0), (1001, None, 2.0, 1, 0), (1002, 20.0, 20.0, 1, None)]
    df = spark.createDataFrame(pts + odd, "id long, x double, y double, w int, g int")
    got = {r["id"]: r["label"] for r in clusters.predicate_components(df, "id", ["g"], 2.0, test).collect()}
    assert got == _linked(pts, near) | {o[0]: o[0] for o in odd}
    assert side < 64 or seen == [0]  # all rows before


def test_trial_at_its_limit_does_not_depend_on_the_order_of_rows(spark):
    from types import SimpleNamespace

    from wayfold.queries.q_w_sequences import trials
    rows = [(i, "a", 0.5, v / 100, 1.0, 0.0) for i, p in enumerate(itertools.permutations([78, 91, 92, 93, 96])) for v in p]
    runs = spark.createDataFrame(rows, "drive_id long, arm string, c_ratio double, b_rough double, dangling_per_km double, conflict_rate double").coalesce(1)
    assert [r["ok"] for r in trials(SimpleNamespace(runs=runs)).collect()] == [True] * 120
