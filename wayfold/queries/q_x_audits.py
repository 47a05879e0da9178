"""Audits, refinements and selections."""

from pyspark.sql import functions as F

from wayfold.functions import geometry as E, records as R
from wayfold.functions.stats import exact_percentiles, top_per_group
from wayfold.operators import clusters as K, components as CC, gates as V, greedy as GR, grid as G, joins as J, junctions as JN, lines as L, ordered as O, shapes as S
from wayfold.queries.catalog import C, query
from wayfold.queries.q_a_aggregates import PLANE
from wayfold.queries.q_e_geometry import CELLSET, INSIDE, LINE, SEGD, ringed, sample_sql
from wayfold.queries.q_g_clusters import DIST15, LOCAL, WALLS, clustered, frame_candidates, link_sql, local_cells, validity
from wayfold.queries.q_j_joins import SUP, support
from wayfold.queries.q_p_scalars import MAT, pose12, posed
from wayfold.queries.q_r_grid import BASE, BY, CELLS, MASK, RAST, RES, SEED, cc_sql, near, seeds, surface
from wayfold.functions import transforms as T
from wayfold.session import shuffled


def N():
    return F.count(F.lit(1))


def med(v):
    return F.percentile(v, F.lit(0.5))


@query("a31_line_match", f"""WITH {sample_sql("CAST(floor(len/20) AS BIGINT)+1", "CAST(20 AS DOUBLE)")}, p AS (SELECT drive_id, i, sx, sy FROM pts WHERE r=1), d AS (SELECT p.drive_id, p.i, min(sqrt(pow(c.x-sx,2)+pow(c.y-sy,2))) AS d FROM p JOIN candidates c ON c.x BETWEEN sx-40 AND sx+40 AND sqrt(pow(c.x-sx,2)+pow(c.y-sy,2))<=40 GROUP BY 1,2)
 SELECT p.drive_id, count(*) AS samples, round_even(count(*) FILTER (d.d<=10)/CAST(count(*) AS DOUBLE),4) AS match_ratio, round(quantile_cont(d.d,0.5),4) AS dist_p50, round(quantile_cont(d.d,0.95),4) AS dist_p95 FROM p LEFT JOIN d ON d.drive_id=p.drive_id AND d.i=p.i GROUP BY 1""")
def _(c):
    s = L.sample(c.poses.select("drive_id", C("frame_id").alias("idx"), "x", "y"), ["drive_id"], "idx", 20.0, whole_steps=True)
    ref = c.candidates.select(C("x").alias("rx"), C("y").alias("ry")).distinct()
    d = J.within(s, ref, 40.0, root=True).groupBy("drive_id", "i").agg(F.min("dist").alias("d"))
    j = s.join(d, ["drive_id", "i"], "left")
    q = exact_percentiles(j, ["drive_id"], "d", {"dist_p50": .5, "dist_p95": .95}, 1.0).drop("n")
    a = j.groupBy("drive_id").agg(N().alias("samples"), F.bround(F.count_if(C("d") <= 10) / N(), 4).alias("match_ratio"))
    return a.join(q, "drive_id", "left").select("drive_id", "samples", "match_ratio", F.round("dist_p50", 4).alias("dist_p50"), F.round("dist_p95", 4).alias("dist_p95"))


@query("a32_width_profile")
def _(c):
    w = L.width_profile(c.poses.select("drive_id", C("frame_id").alias("idx"), "x", "y"), L.box_walls(c.priors), ["drive_id"], 25.0, 60.0)
    q = exact_percentiles(w.filter("width > 0"), ["drive_id"], "width", {"width_median_m": .5, "width_p95_m": .95}, 1.0)
    return q.select("drive_id", C("n").alias("samples"), F.round("width_median_m", 3).alias("width_median_m"), F.round("width_p95_m", 3).alias("width_p95_m"))


@query("a33_centerline_metrics", f"""WITH {sample_sql("CAST(floor(len/10) AS BIGINT)+1", "CAST(10 AS DOUBLE)")}, p AS (SELECT drive_id, i, sx, sy FROM pts WHERE r=1), h AS (SELECT DISTINCT p.drive_id, i FROM p JOIN priors ON sx BETWEEN minx AND maxx AND sy BETWEEN miny AND maxy), n AS (SELECT p.drive_id, count(*) AS n, count(h.i) AS k FROM p LEFT JOIN h ON h.drive_id=p.drive_id AND h.i=p.i GROUP BY 1)
 SELECT n.drive_id, round(len,4) AS length_m, round(k/CAST(n AS DOUBLE),6) AS in_polygon_ratio FROM n JOIN ln ON ln.drive_id=n.drive_id""")
def _(c):
    v = c.poses.select("drive_id", C("frame_id").alias("idx"), "x", "y")
    s = L.sample(v, ["drive_id"], "idx", 10.0, whole_steps=True)
    hit = J.in_boxes(s, c.priors, 64.0).select("drive_id", "i").distinct().withColumn("h", F.lit(1))
    r = s.join(hit, ["drive_id", "i"], "left").groupBy("drive_id").agg((F.count("h") / N()).alias("in_polygon_ratio"))
    ln = L.arc_length(v, ["drive_id"], "idx").groupBy("drive_id").agg(F.round(F.max("s"), 4).alias("length_m"))
    return ln.join(r, "drive_id")


@query("a33_dual_ratio_separation", f"""WITH {LINE}, mode AS (SELECT n_nationkey AS drive_id FROM nation WHERE n_regionkey<>0),
 nb AS (SELECT *, sqrt(pow(x-px,2)+pow(y-py,2)) AS lp, sqrt(pow(nx-x,2)+pow(ny-y,2)) AS ln_ FROM vt),
 nv AS (SELECT drive_id, frame_id, x, y, nx, px, CASE WHEN lp=0 THEN 0 ELSE -(y-py)/lp END AS ax, CASE WHEN lp=0 THEN 0 ELSE (x-px)/lp END AS ay, CASE WHEN ln_=0 THEN 0 ELSE -(ny-y)/ln_ END AS bx, CASE WHEN ln_=0 THEN 0 ELSE (nx-x)/ln_ END AS by_ FROM nb),
 ov AS (SELECT drive_id, frame_id, x, y, CASE WHEN px IS NULL THEN bx WHEN nx IS NULL THEN ax WHEN sqrt(pow(ax+bx,2)+pow(ay+by_,2))<>0 THEN (ax+bx)/sqrt(pow(ax+bx,2)+pow(ay+by_,2)) ELSE bx END AS ux, CASE WHEN px IS NULL THEN by_ WHEN nx IS NULL THEN ay WHEN sqrt(pow(ax+bx,2)+pow(ay+by_,2))<>0 THEN (ay+by_)/sqrt(pow(ax+bx,2)+pow(ay+by_,2)) ELSE by_ END AS uy FROM nv WHERE px IS NOT NULL OR nx IS NOT NULL),
 li AS (SELECT drive_id, frame_id, side, x+ux*side*3.5::DOUBLE AS x, y+uy*side*3.5::DOUBLE AS y FROM ov JOIN mode USING (drive_id), (SELECT UNNEST([1, -1]) AS side)),
 ls AS (SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM li WINDOW w AS (PARTITION BY drive_id, side ORDER BY frame_id)),
 lc AS (SELECT *, sqrt(pow(nx-x,2)+pow(ny-y,2)) AS l, sum(coalesce(sqrt(pow(nx-x,2)+pow(ny-y,2)),0)) OVER (PARTITION BY drive_id, side ORDER BY frame_id) - coalesce(sqrt(pow(nx-x,2)+pow(ny-y,2)),0) AS s FROM ls),
 tl AS (SELECT drive_id, side, sum(l) AS len FROM lc GROUP BY 1,2), nn AS (SELECT drive_id, len, CAST(greatest(2, ceil(len/25.0)+1) AS BIGINT) AS n FROM tl WHERE side=1),
 ii AS (SELECT drive_id, n, len, UNNEST(range(n)) AS i FROM nn), sp AS (SELECT drive_id, i, arg_max(x+(nx-x)*least(1,(i*len/(n-1)-s)/l), s) AS x, arg_max(y+(ny-y)*least(1,(i*len/(n-1)-s)/l), s) AS y FROM ii JOIN lc USING (drive_id) WHERE side=1 AND l>0 AND s<=i*len/(n-1) GROUP BY 1,2),
 dd AS (SELECT sp.drive_id, sp.i, min(sqrt(pow(sp.x-(r.x+least(greatest(((sp.x-r.x)*(r.nx-r.x)+(sp.y-r.y)*(r.ny-r.y))/(r.l*r.l),0),1)*(r.nx-r.x)),2)+pow(sp.y-(r.y+least(greatest(((sp.x-r.x)*(r.nx-r.x)+(sp.y-r.y)*(r.ny-r.y))/(r.l*r.l),0),1)*(r.ny-r.y)),2))) AS d FROM sp JOIN lc r ON r.drive_id=sp.drive_id AND r.side=-1 AND r.l>0 GROUP BY 1,2)
 SELECT ln.drive_id, CASE WHEN m.drive_id IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS dual_ratio, round(sep,5) AS dual_sep_m, round(coalesce(two, ln.len),4) AS total_m FROM ln LEFT JOIN mode m ON m.drive_id=ln.drive_id LEFT JOIN (SELECT drive_id, avg(d) AS sep FROM dd GROUP BY 1) q ON q.drive_id=ln.drive_id LEFT JOIN (SELECT drive_id, sum(len) AS two FROM tl GROUP BY 1) t ON t.drive_id=ln.drive_id""")
def _(c):
    v = c.poses.select("drive_id", C("frame_id").alias("idx"), "x", "y")
    split = c.nation.filter("n_regionkey <> 0").select(C("n_nationkey").cast("long").alias("drive_id"))
    dual = v.join(split, "drive_id", "left_semi")
    sides = {m: L.offset(dual, ["drive_id"], "idx", d) for m, d in (("dual_left", 3.5), ("dual_right", -3.5))}
    lines = v.join(split, "drive_id", "left_anti").withColumn("lane_mode", F.lit("single"))
    for m, side in sides.items():
        lines = lines.unionByName(side.withColumn("lane_mode", F.lit(m)))
    length = L.arc_length(lines, ["drive_id", "lane_mode"], "idx").groupBy("drive_id", "lane_mode").agg(F.max("s").alias("length_m"))
    ratio = length.groupBy("drive_id").agg((F.sum(F.when(C("lane_mode") != "single", C("length_m")).otherwise(0.0)) / F.sum("length_m")).alias("dual_ratio"), F.round(F.sum("length_m"), 4).alias("total_m"))
    sep = L.separation(sides["dual_left"], sides["dual_right"], ["drive_id"], "idx", 25.0)
    return ratio.join(sep, "drive_id", "left").select("drive_id", "dual_ratio", F.round("separation", 5).alias("dual_sep_m"), "total_m")


@query("x01_frame_gaps", """WITH f AS (SELECT DISTINCT drive_id, frame_id//3 AS f FROM trace), b AS (SELECT drive_id, min(f) lo, max(f) hi, count(*) n FROM f GROUP BY 1) SELECT drive_id, lo AS min_frame, hi AS max_frame, n AS frames, hi-lo+1-n AS missing, round((SELECT count(*) FROM trace t WHERE t.drive_id=b.drive_id)/CAST(n AS DOUBLE)*(hi-lo+1),6) AS estimated_total FROM b""")
def _(c):
    f = c.trace.select("drive_id", F.expr("frame_id div 3").alias("f"))
    per = f.groupBy("drive_id", "f").agg(N().alias("k"))
    b = per.groupBy("drive_id").agg(F.min("f").alias("min_frame"), F.max("f").alias("max_frame"), N().alias("frames"), F.sum("k").alias("s"))
    span = C("max_frame") - C("min_frame") + 1
    return b.select("drive_id", "min_frame", "max_frame", "frames", (span - C("frames")).alias("missing"), (C("s") / C("frames") * span).alias("estimated_total"))


@query("x02_run_comparison", """WITH w AS (SELECT drive_id, count(*) n, max(x)-min(x) sx FROM points WHERE z<=4.9 GROUP BY 1), u AS (SELECT drive_id, count(*) n, (max(x)-min(x))/CASE WHEN drive_id%3=0 THEN 8 ELSE 1 END sx FROM points WHERE drive_id%2=0 OR z<=4.9 GROUP BY 1)
 SELECT w.drive_id, w.n AS n_a, u.n AS n_b, CASE WHEN w.n<>u.n THEN 'loss' WHEN w.sx/u.sx>5 THEN 'quantisation' ELSE 'display' END AS verdict FROM w JOIN u USING (drive_id)""")
def _(c):
    span = F.max("x") - F.min("x")
    a = c.points.filter("z <= 4.9").groupBy("drive_id").agg(N().alias("n_a"), span.alias("s_a"))
    b = c.points.filter("drive_id % 2 = 0 or z <= 4.9").groupBy("drive_id").agg(N().alias("n_b"), span.alias("s"))
    s_b = C("s") / F.when(C("drive_id") % 3 == 0, 8).otherwise(1)
    v = R.first_reason([("loss", C("n_a") != C("n_b")), ("quantisation", C("s_a") / s_b > 5)], "display")
    return a.join(b, "drive_id").select("drive_id", "n_a", "n_b", v.alias("verdict"))


@query("x03_chain_ab_check", f"""WITH {MAT}, d AS (SELECT drive_id, frame_id, sqrt(pow(a00*x+a01*y+a02*z-(cos(yaw)*x-sin(yaw)*y),2)+pow(a10*x+a11*y+a12*z-(sin(yaw)*x+cos(yaw)*y),2)) AS e FROM rm), f AS (SELECT drive_id, frame_id, sqrt(avg(e*e)) AS rms, max(e) AS mx FROM d GROUP BY 1,2)
 SELECT drive_id, count(*) AS frames, round(median(rms),6) AS rms_p50, round(max(mx),6) AS worst, CASE WHEN median(rms)>0.3137 THEN 'use full pose' ELSE 'either' END AS advice FROM f GROUP BY 1""")
def _(c):
    full = T.apply(pose12(), C("x"), C("y"), C("z"))
    flat = T.planar(C("x"), C("y"), C("p_x"), C("p_y"), C("p_yaw"))
    d = posed(c).select("drive_id", "frame_id", F.hypot(full[0] - flat[0], full[1] - flat[1]).alias("e"))
    f = d.groupBy("drive_id", "frame_id").agg(F.sqrt(F.avg(C("e") * C("e"))).alias("rms"), F.max("e").alias("mx"))
    q = exact_percentiles(f, ["drive_id"], "rms", {"rms_p50": .5}, 0.05).withColumnRenamed("n", "frames")
    w = f.groupBy("drive_id").agg(F.max("mx").alias("worst"))
    return q.join(w, "drive_id").withColumn("advice", F.when(C("rms_p50") > 0.3137, "use full pose").otherwise("either"))


@query("x04_lidar_vs_trajectory", """WITH m AS (SELECT drive_id, frame_id, avg(x) x, avg(y) y FROM sweeps GROUP BY 1,2), d AS (SELECT m.drive_id, m.x-p.x dx, m.y-p.y dy FROM m JOIN poses p ON p.drive_id=m.drive_id AND p.frame_id=m.frame_id) SELECT drive_id, count(*) n, round(quantile_cont(dx,0.5),6)+0.0 dx_p50, round(quantile_cont(dy,0.5),6)+0.0 dy_p50, round(quantile_cont(sqrt(dx*dx+dy*dy),0.9),6) dist_p90 FROM d GROUP BY 1""")
def _(c):
    m = c.sweeps.groupBy("drive_id", "frame_id").agg(F.avg("x").alias("x"), F.avg("y").alias("y"))
    p = c.poses.select("drive_id", "frame_id", C("x").alias("px"), C("y").alias("py"))
    d = m.join(p, ["drive_id", "frame_id"]).select("drive_id", (C("x") - C("px")).alias("dx"), (C("y") - C("py")).alias("dy")).withColumn("dist", F.hypot("dx", "dy"))
    q = lambda v, ps: exact_percentiles(d, ["drive_id"], v, ps, 8.0)
    return q("dx", {"dx_p50": .5}).join(q("dy", {"dy_p50": .5}).drop("n"), "drive_id").join(q("dist", {"dist_p90": .9}).drop("n"), "drive_id")


@query("x05_additive_raster", f"WITH b AS (SELECT min(x) x0, max(y) y1, CAST(ceil((max(x)-min(x))/10.0) AS BIGINT) w, CAST(ceil((max(y)-min(y))/10.0) AS BIGINT) h FROM points) SELECT least(CAST(floor((x-x0)/10.0) AS BIGINT), w-1) AS ix, least(CAST(floor((y1-y)/10.0) AS BIGINT), h-1) AS iy, count(*) AS n, round(CASE WHEN count(*)>=40 THEN sum(intensity) ELSE 0 END,6) AS total FROM points, b GROUP BY 1,2")
def _(c):
    n = lambda k: F.ceil((F.max(k) - F.min(k)) / 10.0).cast("long")
    b = c.points.agg(F.min("x").alias("x0"), F.max("y").alias("y1"), n("x").alias("w"), n("y").alias("h"))
    p = O.with_one_row(c.points, b)
    g = p.groupBy(F.least(G.floor_div(C("x") - C("x0"), 10.0), C("w") - 1).alias("ix"), F.least(G.floor_div(C("y1") - C("y"), 10.0), C("h") - 1).alias("iy"))
    return g.agg(N().alias("n"), F.sum("intensity").alias("s")).select("ix", "iy", "n", F.when(C("n") >= 40, C("s")).otherwise(0.0).alias("total"))


@query("x06_ground_residual", f"""WITH {CELLS}, dtm AS (SELECT drive_id, ix, iy, median(z) AS h FROM cells GROUP BY 1,2,3 HAVING count(*)>=3), r AS (SELECT c.drive_id, c.frame_id, z-h AS r FROM cells c JOIN dtm ON dtm.drive_id=c.drive_id AND dtm.ix=c.ix AND dtm.iy=c.iy) SELECT drive_id, frame_id, count(*) AS n, round(median(r),6)+0.0 AS residual FROM r GROUP BY 1,2""")
def _(c):
    dtm = G.terrain_grid(c.points, RES, 3, BY).select(*BY, "ix", "iy", "z_median")
    r = G.with_cell(c.points, RES).join(dtm, [*BY, "ix", "iy"]).select("drive_id", "frame_id", (C("z") - C("z_median")).alias("r"))
    return G.cell_percentiles(r, ["drive_id", "frame_id"], "r", {"residual": .5})


@query("x07_pose_source_agreement", """WITH a AS (SELECT drive_id, frame_id, x, y, yaw FROM poses), b AS (SELECT user_id AS drive_id, event_id, value FROM events) SELECT a.drive_id, a.frame_id, round(sqrt(pow(a.x-q.x,2)+pow(a.y-q.y,2)),6) AS dt, round(least(abs(degrees(a.yaw-q.yaw))%360, 360-abs(degrees(a.yaw-q.yaw))%360),5) AS dyaw
 FROM a JOIN (SELECT drive_id, frame_id, x+(event_id%3)*0.1::DOUBLE AS x, y-(event_id%5)*0.1::DOUBLE AS y, yaw+(event_id%4)*0.05::DOUBLE AS yaw FROM poses) q ON q.drive_id=a.drive_id AND q.frame_id=a.frame_id""")
def _(c):
    a = c.poses.select("drive_id", "frame_id", "x", "y", "yaw")
    i = C("event_id")
    b = c.poses.select("drive_id", "frame_id", (C("x") + i % 3 * F.lit(0.1)).alias("bx"), (C("y") - i % 5 * F.lit(0.1)).alias("by"), (C("yaw") + i % 4 * F.lit(0.05)).alias("byaw"))
    return a.join(b, ["drive_id", "frame_id"]).select("drive_id", "frame_id", F.hypot(C("x") - C("bx"), C("y") - C("by")).alias("dt"), F.round(E.angle_diff_360(F.degrees("yaw"), F.degrees("byaw")), 5).alias("dyaw"))


OUTL = "md AS (SELECT frame_id, median(x) mx, median(y) my FROM candidates GROUP BY 1), ol AS (SELECT c.*, sqrt(pow(x-mx,2)+pow(y-my,2))>70.0137 AS o FROM candidates c JOIN md ON md.frame_id=c.frame_id)"


def outliers(c):
    m = c.candidates.groupBy("frame_id").agg(med("x").alias("mx"), med("y").alias("my"))
    return c.candidates.join(m, "frame_id").withColumn("o", F.hypot(C("x") - C("mx"), C("y") - C("my")) > 70.0137)


@query("x08_cluster_outliers", f"WITH {OUTL}, sh AS (SELECT frame_id, drive_id, avg(CAST(o AS INT)) AS s FROM ol GROUP BY 1,2) SELECT ol.frame_id, count(*) AS members, count(*) FILTER (o) AS outliers, count(*) FILTER (s<=0.8) AS kept FROM ol JOIN sh ON sh.frame_id=ol.frame_id AND sh.drive_id=ol.drive_id GROUP BY 1")
def _(c):
    o = outliers(c)
    s = o.groupBy("frame_id", "drive_id").agg(F.avg(C("o").cast("int")).alias("s"))
    return o.join(s, ["frame_id", "drive_id"]).groupBy("frame_id").agg(N().alias("members"), F.count_if("o").alias("outliers"), F.count_if(C("s") <= 0.8).alias("kept"))


@query("x09_support_scoring", """WITH s AS (SELECT drive_id, frame_id, raw_has_crosswalk AS gore, (1.0::DOUBLE*points_support+100.0::DOUBLE*iou_bbox)*CASE WHEN raw_has_crosswalk=1 THEN 0.2::DOUBLE ELSE 1 END*CASE WHEN proj_method='plane' THEN 0.4::DOUBLE ELSE 1 END*CASE WHEN drift_flag=1 THEN 0.3::DOUBLE ELSE 1 END AS sc FROM trace), r AS (SELECT *, row_number() OVER (PARTITION BY drive_id ORDER BY gore, sc DESC, frame_id) AS rank FROM s) SELECT drive_id, frame_id, gore, round(sc,6) AS score, rank FROM r WHERE rank<=5""")
def _(c):
    pen = lambda cond, f: F.when(cond, f).otherwise(1.0)
    sc = (C("points_support") * 1.0 + C("iou_bbox") * 100.0) * pen(C("raw_has_crosswalk") == 1, 0.2) * pen(C("proj_method") == "plane", 0.4) * pen(C("drift_flag") == 1, 0.3)
    s = c.trace.select("drive_id", "frame_id", C("raw_has_crosswalk").alias("gore"), sc.alias("score"))
    return top_per_group(s, ["drive_id"], [C("gore"), F.desc("score"), C("frame_id")], 5)


@query("x10_review_and_final_layers", """WITH g AS (SELECT frame_id, count(*) h, median(rect_w) w, median(rect_l) l, avg(rectangularity) r FROM candidates GROUP BY 1), f AS (SELECT *, CASE WHEN h<3 THEN 'frames_hit_support' WHEN NOT (w BETWEEN 1.5 AND 8 AND l BETWEEN 3 AND 25) THEN 'size' WHEN r<0.45 THEN 'rectangularity' ELSE 'pass' END AS reason FROM g) SELECT CASE WHEN reason='pass' THEN 'final' ELSE 'review' END AS layer, reason, count(*) AS clusters, CAST(sum(h) AS BIGINT) AS members FROM f GROUP BY 1,2""")
def _(c):
    g = c.candidates.groupBy("frame_id").agg(N().alias("h"), med("rect_w").alias("w"), med("rect_l").alias("l"), F.avg("rectangularity").alias("r"))
    no = F.lit(None).cast("double")
    g = g.withColumn("reason", V.final_fail_reason(C("h"), F.lit(False), C("w"), C("l"), C("r"), no, F.lit(0.0), no))
    return g.groupBy(F.when(C("reason") == "pass", "final").otherwise("review").alias("layer"), "reason").agg(N().alias("clusters"), F.sum("h").alias("members"))


@query("x11_rebuild_finals", f"""WITH RECURSIVE {link_sql('candidates', 'cand_id', DIST15)}, m AS (SELECT c.*, label, rectangularity>=0.3 AS strict FROM candidates c JOIN cc ON cc.id=c.cand_id), s AS (SELECT label, bool_or(strict) AS any_strict, count(DISTINCT frame_id) AS fh FROM m GROUP BY 1), u AS (SELECT m.*, fh FROM m JOIN s ON s.label=m.label WHERE fh>=2 AND (strict OR NOT any_strict)), q AS (SELECT label, median(rect_w) w, median(rect_l) l FROM u GROUP BY 1)
 SELECT u.label, any_value(fh) AS frames_hit, arg_min(cand_id, {{'h': angle, 'd': abs(rect_w-w)+abs(rect_l-l), 'i': cand_id}}) AS representative FROM u JOIN q ON q.label=u.label GROUP BY 1""")
def _(c):
    m = clustered(c).withColumn("strict", C("rectangularity") >= 0.3)
    s = m.groupBy("label").agg(F.bool_or("strict").alias("any_strict"), F.countDistinct("frame_id").alias("fh")).filter("fh >= 2")
    u = m.join(s, "label").filter(C("strict") | ~C("any_strict"))
    q = u.groupBy("label").agg(med("rect_w").alias("w"), med("rect_l").alias("l"))
    d = F.abs(C("rect_w") - C("w")) + F.abs(C("rect_l") - C("l"))
    return u.join(q, "label").groupBy("label").agg(F.max("fh").alias("frames_hit"), F.min_by("cand_id", F.struct(C("angle"), d.alias("d"), C("cand_id"))).alias("representative"))


@query("x12_expected_clusters", """WITH g AS (SELECT drive_id, count(*) FILTER (geom_ok=1) AS hit, count(*) FILTER (stage2_added=1) AS s2, avg(raw_has_crosswalk) AS gore, median(iou_bbox) AS p50 FROM trace GROUP BY 1) SELECT drive_id, hit, s2, round(p50,6) AS iou_p50 FROM g WHERE (hit>=40 OR s2>=15) AND gore<=0.7 AND p50>=0.05""")
def _(c):
    t = c.trace
    p = exact_percentiles(t, ["drive_id"], "iou_bbox", {"iou_p50": .5}, 0.02).drop("n")
    g = t.groupBy("drive_id").agg(F.count_if(C("geom_ok") == 1).alias("hit"), F.count_if(C("stage2_added") == 1).alias("s2"), F.avg("raw_has_crosswalk").alias("gore"))
    j = g.join(p, "drive_id", "left").filter(((C("hit") >= 40) | (C("s2") >= 15)) & (C("gore") <= 0.7) & (C("iou_p50") >= 0.05))
    return j.drop("gore")


@query("x13_trace_assembly", """WITH sp AS (SELECT UNNEST(range(0, (SELECT max(frame_id)+1 FROM candidates))) AS frame_id), a AS (SELECT frame_id, count(*) n, max(conf) conf FROM candidates GROUP BY 1), d AS (SELECT frame_id, count(*) n, max(score) s FROM detections GROUP BY 1), p AS (SELECT frame_id, count(*) n FROM points GROUP BY 1), t AS (SELECT frame_id, k FROM trace)
 SELECT sp.frame_id, coalesce(a.n,0) AS candidates, coalesce(d.n,0) AS detections, coalesce(p.n,0) AS points, round(a.conf,6) AS best_conf, round(d.s,6) AS best_score, t.k AS support FROM sp LEFT JOIN a USING (frame_id) LEFT JOIN d USING (frame_id) LEFT JOIN p USING (frame_id) LEFT JOIN t USING (frame_id)""")
def _(c):
    top = c.candidates.agg(F.max("frame_id").alias("m"))  # one row
    # chunk numbers first, then their members after a shuffle, so that many tasks make the spine
    size = 4096
    chunks = top.select("m", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"m div {size}"))).alias("chunk")).repartition("chunk")
    spine = chunks.select(F.explode(F.sequence(C("chunk") * size, F.least(C("m"), C("chunk") * size + (size - 1)))).alias("frame_id"))
    a = c.candidates.groupBy("frame_id").agg(N().alias("a_n"), F.max("conf").alias("best_conf"))
    d = c.detections.groupBy("frame_id").agg(N().alias("d_n"), F.max("score").alias("best_score"))
    p = c.points.groupBy("frame_id").agg(N().alias("p_n"))
    j = spine.join(a, "frame_id", "left").join(d, "frame_id", "left").join(p, "frame_id", "left").join(c.trace.select("frame_id", C("k").alias("support")), "frame_id", "left")
    z = lambda k, n: F.coalesce(k, F.lit(0)).alias(n)
    return j.select("frame_id", z("a_n", "candidates"), z("d_n", "detections"), z("p_n", "points"), "best_conf", "best_score", "support")


@query("x14_primary_candidate", "SELECT frame_id, arg_min(cand_id, {'r': CASE WHEN model='F' AND rectangularity>=0.5 THEN 0 WHEN rectangularity>=0.5 THEN 1 ELSE 2 END, 'i': cand_id}) AS cand_id FROM candidates GROUP BY 1")
def _(c):
    ok = C("rectangularity") >= 0.5
    r = F.when((C("model") == "F") & ok, 0).when(ok, 1).otherwise(2)
    return c.candidates.groupBy("frame_id").agg(F.min_by("cand_id", F.struct(r.alias("r"), C("cand_id"))).alias("cand_id"))


@query("x15_qa_frames", """WITH a AS (SELECT DISTINCT frame_id FROM candidates WHERE conf>=0.9), r AS (SELECT drive_id, arg_max(frame_id, {'c': conf, 'i': -cand_id}) AS frame_id, count(*) AS n FROM candidates WHERE conf<0.9 GROUP BY 1), t AS (SELECT frame_id FROM r ORDER BY n DESC, drive_id LIMIT 5) SELECT frame_id FROM a UNION SELECT frame_id FROM t""")
def _(c):
    a = c.candidates.filter("conf >= 0.9").select("frame_id")
    r = c.candidates.filter("conf < 0.9").groupBy("drive_id").agg(F.max_by("frame_id", F.struct("conf", (-C("cand_id")).alias("i"))).alias("frame_id"), N().alias("n"))
    return a.union(r.orderBy(F.desc("n"), "drive_id").limit(5).select("frame_id")).distinct()


@query("x16_forced_frames", """WITH ex AS (SELECT DISTINCT drive_id, frame_id FROM candidates), b AS (SELECT drive_id, min(frame_id) lo, max(frame_id) hi FROM ex GROUP BY 1), tk AS (SELECT drive_id, UNNEST([lo, hi, CAST(round_even(lo+0.25::DOUBLE*greatest(1,hi-lo),0) AS BIGINT), CAST(round_even(lo+0.5::DOUBLE*greatest(1,hi-lo),0) AS BIGINT), CAST(round_even(lo+0.75::DOUBLE*greatest(1,hi-lo),0) AS BIGINT)]) AS target FROM b)
 SELECT DISTINCT t.drive_id, e.frame_id FROM (SELECT DISTINCT * FROM tk) t, LATERAL (SELECT frame_id FROM ex WHERE ex.drive_id=t.drive_id ORDER BY abs(frame_id-t.target), frame_id LIMIT 1) e""")
def _(c):
    b = c.candidates.groupBy("drive_id").agg(F.min("frame_id").alias("lo"), F.max("frame_id").alias("hi"))
    at = lambda p: F.bround(C("lo") + F.lit(p) * F.greatest(F.lit(1), C("hi") - C("lo")), 0).cast("long")
    t = b.select("drive_id", F.explode(F.array(C("lo"), C("hi"), at(0.25), at(0.5), at(0.75))).alias("target")).distinct()
    return J.closest_frame(t, c.candidates, ["drive_id"], 64).select("drive_id", "frame_id").distinct()


@query("x17_box_shape_filter", "SELECT det_id, round((x1-x0)/(y1-y0),6) AS aspect, round((y1-y0)/376.0,6) AS h_ratio FROM detections WHERE greatest(1,x1-x0)/greatest(1,y1-y0)>=1.2 AND (y1-y0)/376.0<=0.22 AND 0.5*(y0+y1)/376.0>=0.2")
def _(c):
    w, h = F.greatest(F.lit(1.0), C("x1") - C("x0")), F.greatest(F.lit(1.0), C("y1") - C("y0"))
    return c.detections.filter((w / h >= 1.2) & (h / 376.0 <= 0.22) & ((C("y0") + C("y1")) * 0.5 / 376.0 >= 0.2)).select("det_id", (w / h).alias("aspect"), (h / 376.0).alias("h_ratio"))


def frame_mask(c):
    return c.points.filter("intensity >= 0.05").select(C("frame_id").alias("drive_id"), G.floor_div(C("x"), 8.0).alias("ix"), G.floor_div(C("y"), 8.0).alias("iy")).distinct()


@query("x18_stripe_count", f"""WITH RECURSIVE fm AS (SELECT DISTINCT frame_id AS drive_id, CAST(floor(x/8.0) AS BIGINT) AS ix, CAST(floor(y/8.0) AS BIGINT) AS iy FROM points WHERE intensity>=0.05), {cc_sql('fm')}, z AS (SELECT drive_id, label, max(ix)-min(ix)+1 AS w, max(iy)-min(iy)+1 AS h FROM msk JOIN cc USING (id) GROUP BY 1,2) SELECT drive_id AS frame_id, count(*) AS components, count(*) FILTER (greatest(w,h)/CAST(least(w,h) AS DOUBLE)>=1.5) AS stripes FROM z GROUP BY 1""")
def _(c):
    lab = CC.cell_components(frame_mask(c), ["drive_id"])
    ext = lambda k: F.max(k) - F.min(k) + 1
    z = lab.groupBy("drive_id", "label").agg(ext("ix").alias("w"), ext("iy").alias("h"))
    return z.groupBy(C("drive_id").alias("frame_id")).agg(N().alias("components"), F.count_if(F.greatest("w", "h") / F.least("w", "h") >= 1.5).alias("stripes"))


@query("x19_evidence_cleaning", f"""WITH {CELLSET}, road AS (SELECT DISTINCT CAST(floor(x/2.0) AS BIGINT) AS jx, CAST(floor(y/2.0) AS BIGINT) AS jy FROM points), o AS (SELECT cs.cand_id, count(*) n, count(jx) k FROM cs LEFT JOIN road ON jx=CAST(floor(ix/4.0) AS BIGINT) AND jy=CAST(floor(iy/4.0) AS BIGINT) GROUP BY 1), cl AS (SELECT cand_id, n, k FROM o WHERE k/CAST(n AS DOUBLE)>=0.2137 AND k*0.25>=2)
 SELECT class, count(*) AS before_n, count(cl.cand_id) AS after_n, round(coalesce(sum(cl.k),0)*0.25::DOUBLE,6) AS area_after FROM candidates c LEFT JOIN cl ON cl.cand_id=c.cand_id GROUP BY 1""")
def _(c):
    cs = S.raster_blocks(ringed(c), "cand_id", "ring", 0.5, 4)
    road = c.points.select(G.floor_div(C("x"), 2.0).alias("jx"), G.floor_div(C("y"), 2.0).alias("jy")).distinct().withColumn("r", F.lit(1))
    o = cs.join(shuffled(road), ["jx", "jy"], "left").groupBy("cand_id").agg(F.sum("n").alias("n"), F.sum(C("n") * F.coalesce("r", F.lit(0))).alias("k"))
    keep = o.filter((C("k") / C("n") >= 0.2137) & (C("k") * 0.25 >= 2)).select("cand_id", "k")
    return c.candidates.select("cand_id", "class").join(keep, "cand_id", "left").groupBy("class").agg(N().alias("before_n"), F.count("k").alias("after_n"), (F.coalesce(F.sum("k"), F.lit(0)) * 0.25).alias("area_after"))


@query("x20_focus_index", """WITH n AS (SELECT drive_id, count(*) AS k FROM candidates GROUP BY 1), t AS (SELECT drive_id FROM n ORDER BY k DESC, drive_id LIMIT 1), d AS (SELECT drive_id FROM t UNION SELECT UNNEST([0,1]::BIGINT[])), f AS (SELECT DISTINCT c.drive_id, frame_id FROM candidates c JOIN d ON d.drive_id=c.drive_id), r AS (SELECT *, row_number() OVER (PARTITION BY drive_id ORDER BY frame_id)-1 AS i FROM f) SELECT drive_id, frame_id FROM r WHERE i%5=0 AND i//5<50""")
def _(c):
    top = c.candidates.groupBy("drive_id").agg(N().alias("k")).orderBy(F.desc("k"), "drive_id").limit(1).select("drive_id")
    named = c.candidates.filter(C("drive_id").isin(0, 1)).select("drive_id").distinct()
    f = c.candidates.join(top.union(named).distinct(), "drive_id", "left_semi").select("drive_id", "frame_id").distinct()
    i = O.dense_index(f, ["drive_id"], ["frame_id"], F.floor(C("frame_id") / O.CHUNK), "i")
    return i.filter((C("i") % 5 == 0) & (C("i") / 5 < 50)).select("drive_id", "frame_id")


@query("x21_complete_runs", """WITH s AS (SELECT o_orderkey//40 AS run, o_custkey%8 AS d, bool_and(o_orderstatus<>'P' OR o_totalprice>100000) AS ok FROM orders GROUP BY 1,2), r AS (SELECT run FROM s GROUP BY 1 HAVING count(*)=8 AND bool_and(ok)), m AS (SELECT max(run) AS run FROM r) SELECT o_orderkey//40 AS run, o_custkey%8 AS drive_id, count(*) AS n FROM orders WHERE o_orderkey//40=(SELECT run FROM m) GROUP BY 1,2""")
def _(c):
    o = c.orders.select(F.expr("o_orderkey div 40").alias("run"), (C("o_custkey") % 8).alias("drive_id"), ((C("o_orderstatus") != "P") | (C("o_totalprice") > 100000)).alias("ok"))
    s = o.groupBy("run", "drive_id").agg(F.bool_and("ok").alias("ok"), N().alias("n"))
    r = s.groupBy("run").agg(N().alias("k"), F.bool_and("ok").alias("ok")).filter("k = 8 and ok").agg(F.max("run").alias("run"))
    return s.join(r, "run").select("run", "drive_id", "n")


@query("x22_area_of_interest", "SELECT round(min(minx)-50,6) AS minx, round(min(miny)-50,6) AS miny, round(max(maxx)+50,6) AS maxx, round(max(maxy)+50,6) AS maxy FROM priors")
def _(c):
    return c.priors.agg((F.min("minx") - 50).alias("minx"), (F.min("miny") - 50).alias("miny"), (F.max("maxx") + 50).alias("maxx"), (F.max("maxy") + 50).alias("maxy"))


@query("x23_missing_junction_diagnosis", """WITH s AS (SELECT prior_id, (minx+maxx)/2 AS px, (miny+maxy)/2 AS py FROM priors), n AS (SELECT prior_id, arg_min(cand_id, {'d': pow(x-px,2)+pow(y-py,2), 'i': cand_id}) AS seed, min(sqrt(pow(x-px,2)+pow(y-py,2))) AS d FROM s JOIN candidates ON pow(x-px,2)+pow(y-py,2)<=1600.0 GROUP BY 1)
 SELECT s.prior_id, n.seed, round(n.d,6) AS dist, CASE WHEN n.seed IS NULL THEN 'no_seed' WHEN c.rectangularity>=0.5 THEN 'kept' ELSE 'dropped' END AS state FROM s LEFT JOIN n USING (prior_id) LEFT JOIN candidates c ON c.cand_id=n.seed""")
def _(c):
    s = c.priors.select("prior_id", ((C("minx") + C("maxx")) / 2).alias("rx"), ((C("miny") + C("maxy")) / 2).alias("ry"))
    d = J.within(c.candidates.select("cand_id", "x", "y", "rectangularity"), s, 40.0)
    n = d.groupBy("prior_id").agg(F.min(F.struct("dist", "cand_id", "rectangularity")).alias("m"))
    j = c.priors.select("prior_id").join(n, "prior_id", "left")
    st = R.first_reason([("no_seed", C("m").isNull()), ("kept", C("m.rectangularity") >= 0.5)], "dropped")
    return j.select("prior_id", C("m.cand_id").alias("seed"), C("m.dist").alias("dist"), st.alias("state"))


HYBF = """vf AS (SELECT cand_id, model, conf, NOT (rect_l*rect_w<4 OR rect_l*rect_w>30 OR 4*pi()*rect_l*rect_w/pow(2*(rect_l+rect_w),2)<0.45 OR greatest(rect_l,rect_w)/least(rect_l,rect_w)>4.5 OR rectangularity<0.25) AS valid FROM candidates)"""


@query("x24_hybrid_choice", f"""WITH {CELLSET}, {HYBF}, n AS (SELECT cand_id, count(*) AS n FROM cs GROUP BY 1), ab AS (SELECT a.cand_id AS a_id, b.cand_id AS b_id, count(*) AS k FROM cs a JOIN cs b ON a.ix=b.ix AND a.iy=b.iy WHERE a.model='F' AND b.model='O' GROUP BY 1,2), io AS (SELECT a_id, b_id, k/CAST(p.n+q.n-k AS DOUBLE) AS iou FROM ab JOIN n p ON p.cand_id=a_id JOIN n q ON q.cand_id=b_id), bs AS (SELECT a_id, arg_max(b_id, {{'i': iou, 'b': -b_id}}) AS b_id, max(iou) AS iou FROM io GROUP BY 1)
 SELECT f.cand_id, bs.b_id AS partner, round(bs.iou,6) AS iou, CASE WHEN f.valid AND (o.valid IS NULL OR NOT o.valid OR f.conf>=o.conf) THEN 'algo' WHEN o.valid AND bs.iou>=0.1037 THEN 'sat' WHEN f.valid THEN 'algo' ELSE 'reject' END AS choice FROM vf f LEFT JOIN bs ON bs.a_id=f.cand_id LEFT JOIN vf o ON o.cand_id=bs.b_id WHERE f.model='F'""")
def _(c):
    cs = S.rasterise(ringed(c), "cand_id", "ring", 0.5, ["model"])
    side = lambda m, k: cs.filter(C("model") == m).select(C("cand_id").alias(k), "ix", "iy")
    io = G.cell_set_overlap(side("F", "a_id"), side("O", "b_id"), "a_id", "b_id")
    bs = io.groupBy("a_id").agg(F.max(F.struct("iou", (-C("b_id")).alias("o"))).alias("m")).select(C("a_id").alias("cand_id"), (-C("m.o")).alias("partner"), C("m.iou").alias("iou"))
    v = validity(c)
    o = v.select(C("cand_id").alias("partner"), C("valid").alias("o_valid"), C("conf").alias("o_conf"))
    j = v.filter("model = 'F'").join(bs, "cand_id", "left").join(o, "partner", "left")
    ch = R.first_reason([("algo", C("valid") & (C("o_valid").isNull() | ~C("o_valid") | (C("conf") >= C("o_conf")))), ("sat", C("o_valid") & (C("iou") >= 0.1037)), ("algo", C("valid"))], "reject")
    return j.select("cand_id", "partner", "iou", ch.alias("choice"))


@query("x25_augment_score", "SELECT drive_id, round(count(*) FILTER (model='O')*avg(rectangularity)/(1.0+quantile_cont(y,0.95)),6) AS score FROM candidates GROUP BY 1")
def _(c):
    q = exact_percentiles(c.candidates, ["drive_id"], "y", {"p95": .95}, 1.0).drop("n")
    a = c.candidates.groupBy("drive_id").agg(F.count_if(C("model") == "O").alias("k"), F.avg("rectangularity").alias("o"))
    return a.join(q, "drive_id").select("drive_id", (C("k") * C("o") / (1.0 + C("p95"))).alias("score"))


@query("x26_mask_parameter_grid", f"""WITH {RAST}, {SEED}, pg AS (SELECT * FROM (SELECT UNNEST([3,5,7]) AS dmin), (SELECT UNNEST([0.1137::DOUBLE,0.2137]) AS rmax)), tr AS (SELECT dmin, rmax, r.drive_id, density_all>=dmin AND (roughness IS NULL OR roughness<=rmax) AS m, s.ix IS NOT NULL AS t FROM rast r LEFT JOIN seed s ON s.drive_id=r.drive_id AND s.ix=r.ix AND s.iy=r.iy, pg),
 g AS (SELECT dmin, rmax, avg(CAST(m AS INT)) AS cover, count(*) FILTER (m AND t)/CAST(greatest(count(*) FILTER (t),1) AS DOUBLE) AS traj FROM tr GROUP BY 1,2) SELECT CAST(dmin AS INTEGER) AS dmin, rmax, round(cover,6) AS road_cover, round(traj,6) AS traj_cover, round(CASE WHEN cover BETWEEN 0.45 AND 0.95 THEN 1 ELSE 0 END+CASE WHEN traj>=0.85 THEN 2 ELSE 0 END+traj,6) AS score FROM g""")
def _(c):
    r = G.ground_rasters(c.points, RES, 0.4567, BY).join(seeds(c).withColumn("t", F.lit(True)), [*BY, "ix", "iy"], "left")
    grid = F.explode(F.array(*[F.struct(F.lit(d).alias("dmin"), F.lit(q).alias("rmax")) for d in (3, 5, 7) for q in (0.1137, 0.2137)])).alias("g")
    d = r.select("density_all", "roughness", F.coalesce("t", F.lit(False)).alias("t"), grid).select("*", "g.*")
    m = (C("density_all") >= C("dmin")) & (C("roughness").isNull() | (C("roughness") <= C("rmax")))
    s = d.groupBy("dmin", "rmax").agg(F.avg(m.cast("int")).alias("road_cover"), (F.count_if(m & C("t")) / F.greatest(F.count_if("t"), F.lit(1))).alias("traj_cover"))
    return s.withColumn("score", F.when(C("road_cover").between(0.45, 0.95), 1.0).otherwise(0.0) + F.when(C("traj_cover") >= 0.85, 2.0).otherwise(0.0) + C("traj_cover"))


@query("x27_largest_seeded_component", f"""WITH RECURSIVE {MASK}, {SEED}, {cc_sql('surf')}, z AS (SELECT m.drive_id, label, count(*) AS n, count(s.ix) AS hits FROM msk m JOIN cc USING (id) LEFT JOIN seed s ON s.drive_id=m.drive_id AND s.ix=m.ix AND s.iy=m.iy GROUP BY 1,2), k AS (SELECT *, row_number() OVER (PARTITION BY drive_id ORDER BY n DESC, label) AS r FROM z WHERE hits>0) SELECT drive_id, n AS cells FROM k WHERE r=1""")
def _(c):
    return G.seeded_components(surface(c), seeds(c), 1, BY).groupBy("drive_id").agg(F.max("cells").alias("cells"))


@query("x28_params_hash_check", """WITH h AS (SELECT p_partkey AS run, md5(p_brand||p_name) AS a, CASE WHEN p_size%7=0 THEN '' WHEN p_size%5=0 THEN md5('x') ELSE md5(p_brand||p_name) END AS b, CASE WHEN p_size%11=0 THEN '' WHEN p_size%6=0 THEN md5('y') ELSE md5(p_brand||p_name) END AS o FROM part) SELECT run, CASE WHEN b<>'' AND b<>a THEN 'summary_hash_mismatch' WHEN o<>'' AND o<>a THEN 'output_hash_mismatch' WHEN o='' THEN 'output_hash_missing' ELSE 'ok' END AS state FROM h""")
def _(c):
    md = lambda v: F.md5(v.cast("binary"))
    a = md(F.concat("p_brand", "p_name"))
    s = C("p_size")
    h = c.part.select(C("p_partkey").alias("run"), a.alias("a"), F.when(s % 7 == 0, "").when(s % 5 == 0, md(F.lit("x"))).otherwise(a).alias("b"), F.when(s % 11 == 0, "").when(s % 6 == 0, md(F.lit("y"))).otherwise(a).alias("o"))
    bad = lambda v: (C(v) != "") & (C(v) != C("a"))
    return h.select("run", R.first_reason([("summary_hash_mismatch", bad("b")), ("output_hash_mismatch", bad("o")), ("output_hash_missing", C("o") == "")], "ok").alias("state"))


@query("x29_pose_fallback", "SELECT drive_id, frame_id, 'candidate' AS source, round(avg(x),6) AS x FROM candidates GROUP BY 1,2 UNION ALL SELECT p.drive_id, p.frame_id, 'trajectory', round(p.x,6) FROM poses p WHERE (p.drive_id, p.frame_id) NOT IN (SELECT (drive_id, frame_id) FROM candidates)")
def _(c):
    k = ["drive_id", "frame_id"]
    a = c.candidates.groupBy(*k).agg(F.avg("x").alias("x")).withColumn("source", F.lit("candidate"))
    b = c.poses.join(a, k, "left_anti").select(*k, "x", F.lit("trajectory").alias("source"))
    return a.unionByName(b)


@query("x31_dense_cell_instances", """WITH c AS (SELECT drive_id, frame_id, CAST(floor(x/40.0) AS BIGINT) gx, CAST(floor(y/40.0) AS BIGINT) gy, count(*) n, avg(x) x, avg(y) y, (max(x)-min(x))*(max(y)-min(y)) AS a FROM points WHERE z BETWEEN 0.3 AND 4.5 GROUP BY 1,2,3,4 HAVING count(*)>=2), r AS (SELECT *, row_number() OVER (PARTITION BY drive_id, frame_id ORDER BY n DESC, gx, gy) AS r FROM c)
 SELECT drive_id, frame_id, r AS rank, n, round(x,6) AS x, round(y,6) AS y FROM r WHERE r<=3 AND a>=1""")
def _(c):
    p = c.points.filter(C("z").between(0.3, 4.5))
    ext = lambda k: F.max(k) - F.min(k)
    g = p.groupBy("drive_id", "frame_id", G.floor_div(C("x"), 40.0).alias("gx"), G.floor_div(C("y"), 40.0).alias("gy")).agg(N().alias("n"), F.avg("x").alias("x"), F.avg("y").alias("y"), (ext("x") * ext("y")).alias("a")).filter("n >= 2")
    return top_per_group(g, ["drive_id", "frame_id"], [F.desc("n"), C("gx"), C("gy")], 3).filter("a >= 1").select("drive_id", "frame_id", "rank", "n", "x", "y")


INSTANCES = """c AS (SELECT drive_id, frame_id//5 AS frame_id, CAST(floor(x/100.0) AS BIGINT) gx, CAST(floor(y/100.0) AS BIGINT) gy, x, y FROM points WHERE z BETWEEN 0.3 AND 4.5), r AS (SELECT *, row_number() OVER (PARTITION BY drive_id, frame_id ORDER BY n DESC, gx, gy) AS label FROM (SELECT drive_id, frame_id, gx, gy, count(*) AS n FROM c GROUP BY ALL HAVING count(*)>=3)),
 pt AS (SELECT DISTINCT drive_id, frame_id, label, n, x, y FROM c JOIN r USING (drive_id, frame_id, gx, gy) WHERE label<=3),
 he AS (SELECT a.drive_id, a.frame_id, a.label, a.n, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS by_ FROM pt a JOIN pt b ON a.drive_id=b.drive_id AND a.frame_id=b.frame_id AND a.label=b.label AND (a.x<>b.x OR a.y<>b.y) WHERE NOT EXISTS (SELECT 1 FROM pt p WHERE p.drive_id=a.drive_id AND p.frame_id=a.frame_id AND p.label=a.label AND ((b.x-a.x)*(p.y-a.y)-(b.y-a.y)*(p.x-a.x)<0 OR ((b.x-a.x)*(p.y-a.y)-(b.y-a.y)*(p.x-a.x)=0 AND ((p.x-a.x)*(p.x-b.x)+(p.y-a.y)*(p.y-b.y))>0)))),
 hu AS (SELECT drive_id, frame_id, label, n, sum(ax*by_-bx*ay)/2 AS area, sum((ax+bx)*(ax*by_-bx*ay))/(3*sum(ax*by_-bx*ay)) AS x, sum((ay+by_)*(ax*by_-bx*ay))/(3*sum(ax*by_-bx*ay)) AS y FROM he GROUP BY 1,2,3,4 HAVING sum(ax*by_-bx*ay)/2>=1)"""


def instances(c):
    p = c.points.filter(C("z").between(0.3, 4.5)).withColumn("frame_id", F.expr("frame_id div 5"))
    return K.dense_cell_instances(p, ["drive_id"], "frame_id", 100.0, 3, 3, 1.0)


@query("x31_frame_instances", f"WITH {INSTANCES} SELECT drive_id, frame_id, CAST(label AS INTEGER) AS label, n AS points, round(area,6) AS area_m2, round(x,5) AS x, round(y,5) AS y FROM hu")
def _(c):
    return instances(c).select("drive_id", "frame_id", "label", "points", "area_m2", F.round("x", 5).alias("x"), F.round("y", 5).alias("y"))


@query("x31_merged_instances", f"""WITH RECURSIVE {INSTANCES}, o AS (SELECT *, row_number() OVER (PARTITION BY drive_id, label ORDER BY frame_id) AS r FROM hu),
 f AS (SELECT drive_id, label, r, frame_id, frame_id AS first_frame, [{{'k': frame_id, 'x': x, 'y': y, 'n': 1}}] AS cs FROM o WHERE r=1
  UNION ALL SELECT drive_id, label, r, frame_id, coalesce(h, frame_id), CASE WHEN h IS NULL THEN list_append(cs, {{'k': frame_id, 'x': x, 'y': y, 'n': 1}}) ELSE list_transform(cs, lambda k: CASE WHEN k.k=h THEN {{'k': k.k, 'x': (k.x*k.n+x)/(k.n+1), 'y': (k.y*k.n+y)/(k.n+1), 'n': k.n+1}} ELSE k END) END
  FROM (SELECT o.*, f.cs, list_filter(f.cs, lambda k: sqrt(pow(k.x-o.x,2)+pow(k.y-o.y,2))<=18)[1].k AS h FROM f JOIN o ON o.drive_id=f.drive_id AND o.label=f.label AND o.r=f.r+1))
 SELECT drive_id, CAST(label AS INTEGER) AS label, first_frame, count(DISTINCT frame_id) AS frames_hit, CAST(sum(n) AS BIGINT) AS points, round(avg(x),5) AS x, round(avg(y),5) AS y, round(sum(area),4) AS area_m2 FROM f JOIN hu USING (drive_id, label, frame_id) GROUP BY 1,2,3 HAVING count(DISTINCT frame_id)>=3""")
def _(c):
    m = K.merged_instances(instances(c), ["drive_id"], "frame_id", 18.0, 3)
    return m.select("drive_id", "label", "first_frame", "frames_hit", "points", F.round("x", 5).alias("x"), F.round("y", 5).alias("y"), F.round("area_m2", 4).alias("area_m2"))


@query("x32_pixel_road_mask", f"""WITH RECURSIVE px AS (SELECT l_suppkey%8 AS drive_id, CAST(floor(l_partkey*0.25::DOUBLE/10.0) AS BIGINT) AS ix, CAST(floor((l_orderkey%997)*0.25::DOUBLE/10.0) AS BIGINT) AS iy, avg(l_discount) AS s, avg(l_tax) AS v FROM lineitem GROUP BY 1,2,3), mk AS (SELECT drive_id, ix, iy FROM px WHERE s<=0.0613 AND v BETWEEN 0.0213 AND 0.0613), o AS (SELECT UNNEST(range(-1,2)) AS d), dl AS (SELECT DISTINCT drive_id, ix+a.d AS ix, iy+b.d AS iy FROM mk, o a, o b), cl AS (SELECT b.drive_id, b.ix, b.iy {near('dl', 'b.drive_id, b.ix, b.iy', 1)} HAVING count(*)=9),
 {cc_sql('cl')}, z AS (SELECT drive_id, label, count(*) AS n FROM msk JOIN cc USING (id) GROUP BY 1,2) SELECT drive_id, count(*) AS parts, CAST(sum(n) AS BIGINT) AS cells FROM z WHERE n>=4 GROUP BY 1""")
def _(c):
    px = c.lineitem.select((C("l_suppkey") % 8).alias("drive_id"), (C("l_partkey") * F.lit(0.25)).alias("x"), (C("l_orderkey") % 997 * F.lit(0.25)).alias("y"), C("l_discount").alias("s"), C("l_tax").alias("v"))
    m = G.with_cell(px, RES).groupBy(*BY, "ix", "iy").agg(F.avg("s").alias("s"), F.avg("v").alias("v")).filter((C("s") <= 0.0613) & C("v").between(0.0213, 0.0613))
    a = G.area_components(G.close_mask(m, 1, BY), RES, BY, True).filter("cells >= 4")
    return a.groupBy("drive_id").agg(N().alias("parts"), F.sum("cells").alias("cells"))


@query("x34_score_inside_polygon", f"""WITH q AS (SELECT CAST(floor(x/2.0) AS BIGINT) ix, CAST(floor(y/2.0) AS BIGINT) iy, avg(intensity) AS s FROM points GROUP BY 1,2), p AS (SELECT (ix+0.5)*2.0::DOUBLE+0.0137::DOUBLE AS px, (iy+0.5)*2.0::DOUBLE+0.0171::DOUBLE AS py, s FROM q) SELECT cand_id, count(*) AS cells, round(avg(s),6) AS mean_score FROM p JOIN candidates c ON px BETWEEN c.x-7 AND c.x+7 AND py BETWEEN c.y-7 AND c.y+7 WHERE {INSIDE} GROUP BY 1""")
def _(c):
    q = c.points.groupBy(G.floor_div(C("x"), 2.0).alias("ix"), G.floor_div(C("y"), 2.0).alias("iy")).agg(F.avg("intensity").alias("s"))
    p = q.select(((C("ix") + 0.5) * 2.0 + 0.0137).alias("x"), ((C("iy") + 0.5) * 2.0 + 0.0171).alias("y"), "s")
    j = J.in_boxes(p, ringed(c).select("cand_id", "ring", "minx", "miny", "maxx", "maxy"), 16.0)
    return j.filter(E.in_ring(C("ring"), C("x"), C("y"))).groupBy("cand_id").agg(N().alias("cells"), F.avg("s").alias("mean_score"))


@query("x35_map_pixel_feature", f"""WITH {SUP}, k AS (SELECT det_id, count(*) AS n FROM sp GROUP BY 1) SELECT d.det_id, coalesce(n,0) AS points, CASE WHEN coalesce(n,0)>=2 THEN 'lidar' WHEN class IN ('click','view','error') THEN 'ground_plane' ELSE 'drop' END AS geometry_source, CASE WHEN coalesce(n,0)>=2 THEN 'strong' WHEN class IN ('click','view','error') THEN 'weak' END AS evidence_strength, CASE WHEN coalesce(n,0)<2 AND class IN ('click','view','error') THEN CASE WHEN n IS NULL THEN 'no_points' ELSE 'few_points' END END AS weak_reason FROM detections d LEFT JOIN k USING (det_id)""")
def _(c):
    k = support(c).groupBy("det_id").agg(N().alias("n"))
    j = c.detections.select("det_id", "class").join(k, "det_id", "left")
    n, ground = F.coalesce("n", F.lit(0)), C("class").isin("click", "view", "error")
    return j.select("det_id", n.alias("points"), R.first_reason([("lidar", n >= 2), ("ground_plane", ground)], "drop").alias("geometry_source"), R.first_reason([("strong", n >= 2), ("weak", ground)], None).alias("evidence_strength"),
                    F.when((n < 2) & ground, F.when(C("n").isNull(), "no_points").otherwise("few_points")).alias("weak_reason"))


@query("x36_support_ladder", f"""WITH {SUP}, q AS (SELECT det_id, quantile_cont(intensity,0.8) AS top, quantile_cont(z,0.5) AS zm, min(z) AS z0 FROM sp GROUP BY 1), f AS (SELECT s.det_id, count(*) FILTER (abs(z-zm)<=0.1137) AS g_local, count(*) FILTER (z-z0<=0.3137) AS g_plane, count(*) FILTER (intensity>=top) AS tops, count(*) AS n FROM sp s JOIN q ON q.det_id=s.det_id GROUP BY 1)
 SELECT det_id, CASE WHEN g_local>=2 THEN 'ground_local' WHEN g_plane>=2 THEN 'plane' WHEN tops>=2 THEN 'top_intensity' WHEN n>=2 THEN 'bbox' ELSE 'none' END AS source, CASE WHEN g_local>=2 THEN g_local WHEN g_plane>=2 THEN g_plane WHEN tops>=2 THEN tops ELSE n END AS points FROM f""")
def _(c):
    s = support(c)
    q = s.groupBy("det_id").agg(F.percentile("intensity", F.lit(.8)).alias("top"), med("z").alias("zm"), F.min("z").alias("z0"))
    f = s.join(q, "det_id").groupBy("det_id").agg(F.count_if(F.abs(C("z") - C("zm")) <= 0.1137).alias("g_local"), F.count_if(C("z") - C("z0") <= 0.3137).alias("g_plane"), F.count_if(C("intensity") >= C("top")).alias("tops"), N().alias("n"))
    rules = [("ground_local", C("g_local") >= 2), ("plane", C("g_plane") >= 2), ("top_intensity", C("tops") >= 2), ("bbox", C("n") >= 2)]
    return f.select("det_id", R.first_reason(rules, "none").alias("source"), F.when(C("g_local") >= 2, C("g_local")).when(C("g_plane") >= 2, C("g_plane")).when(C("tops") >= 2, C("tops")).otherwise(C("n")).alias("points"))


@query("x37_snap_to_heading", """WITH h AS (SELECT c.cand_id, c.x, c.y, c.rect_l, c.rect_w, angle, (frame_id*3)%180 AS hd FROM candidates c), d AS (SELECT *, least(abs(angle-hd)%180,180-abs(angle-hd)%180) AS df FROM h) SELECT cand_id, round(df,6) AS diff, CASE WHEN df<=20 THEN CAST(hd AS DOUBLE) ELSE angle END AS angle, round(x+rect_l/2*abs(cos(radians(CASE WHEN df<=20 THEN hd ELSE angle END)))+rect_w/2*abs(sin(radians(CASE WHEN df<=20 THEN hd ELSE angle END))),5)+0.0 AS max_x FROM d""")
def _(c):
    hd = (C("frame_id") * 3 % 180).cast("double")
    d = c.candidates.withColumn("hd", hd).withColumn("diff", E.angle_diff_180(C("angle"), C("hd")))
    d = d.withColumn("new", F.when(C("diff") <= 20, C("hd")).otherwise(C("angle")))
    ring = E.rotate_ring(E.rect_ring(C("x"), C("y"), C("rect_l"), C("rect_w"), C("angle")), C("x"), C("y"), C("new") - C("angle"))
    d = d.withColumn("max_x", F.round(E.bbox(ring)["maxx"], 5))
    return d.select("cand_id", "diff", C("new").alias("angle"), "max_x")


@query("x38_gated_support_levels", """WITH g AS (SELECT drive_id, frame_id, iou_bbox+0.01::DOUBLE*points_support AS sc, CASE WHEN geom_ok=1 AND proj_method='lidar' AND drift_flag=0 AND points_support>=10 AND iou_bbox>=0.10 THEN 0 WHEN geom_ok=1 AND proj_method='lidar' AND drift_flag=0 AND points_support>=5 AND iou_bbox>=0.05 THEN 1 WHEN geom_ok=1 AND drift_flag=0 AND iou_bbox>=0.02 THEN 2 END AS lv FROM trace), m AS (SELECT drive_id, min(lv) AS lv FROM g GROUP BY 1)
 SELECT g.drive_id, m.lv AS level, count(*) AS frames, round(max(sc),6) AS best FROM g JOIN m ON m.drive_id=g.drive_id AND m.lv=g.lv GROUP BY 1,2""")
def _(c):
    base = (C("geom_ok") == 1) & (C("drift_flag") == 0)
    lid = base & (C("proj_method") == "lidar")
    lv = F.when(lid & (C("points_support") >= 10) & (C("iou_bbox") >= 0.10), 0).when(lid & (C("points_support") >= 5) & (C("iou_bbox") >= 0.05), 1).when(base & (C("iou_bbox") >= 0.02), 2)
    g = c.trace.select("drive_id", (C("iou_bbox") + 0.01 * C("points_support")).alias("sc"), lv.alias("level"))
    s = g.filter("level is not null").groupBy("drive_id", "level").agg(N().alias("frames"), F.max("sc").alias("best"))
    m = s.groupBy("drive_id").agg(F.min("level").alias("level"))
    return s.join(m, ["drive_id", "level"])


@query("x39_alignment_verdict", """WITH o AS (SELECT drive_id, frame_id%5-2 AS off, count(*) AS n FROM trace WHERE raw_has_crosswalk=1 GROUP BY 1,2), m AS (SELECT drive_id, arg_max(off, {'n': n, 'o': -off}) AS off FROM o GROUP BY 1), q AS (SELECT drive_id, median(iou_bbox) FILTER (proj_method='lidar') AS l, median(iou_bbox) FILTER (proj_method='plane') AS p FROM trace GROUP BY 1)
 SELECT q.drive_id, m.off AS offset_mode, round(l,6) AS iou_lidar, round(p,6) AS iou_plane, CASE WHEN m.off<>0 THEN 'frame_offset' WHEN l<p-0.0137 THEN 'lidar_projection' WHEN l<0.05 THEN 'calibration' ELSE 'ok' END AS cause FROM q LEFT JOIN m USING (drive_id)""")
def _(c):
    o = c.trace.filter("raw_has_crosswalk = 1").groupBy("drive_id", (C("frame_id") % 5 - 2).alias("off")).agg(N().alias("n"))
    m = o.groupBy("drive_id").agg(F.max_by("off", F.struct("n", (-C("off")).alias("o"))).alias("offset_mode"))
    q = exact_percentiles(c.trace, ["drive_id", "proj_method"], "iou_bbox", {"p": .5}, 0.02)
    q = q.groupBy("drive_id").agg(F.max(F.when(C("proj_method") == "lidar", C("p"))).alias("iou_lidar"), F.max(F.when(C("proj_method") == "plane", C("p"))).alias("iou_plane"))
    cause = R.first_reason([("frame_offset", C("offset_mode") != 0), ("lidar_projection", C("iou_lidar") < C("iou_plane") - 0.0137), ("calibration", C("iou_lidar") < 0.05)], "ok")
    return q.join(m, "drive_id", "left").select("drive_id", "offset_mode", "iou_lidar", "iou_plane", cause.alias("cause"))


@query("x40_shape_retries", """WITH sd AS (SELECT prior_id, (minx+maxx)/2 AS px, (miny+maxy)/2 AS py FROM priors), n AS (SELECT prior_id, r, count(*) AS k FROM sd, (SELECT UNNEST([15.0::DOUBLE,25.0,40.0]) AS r), candidates WHERE pow(x-px,2)+pow(y-py,2)<=r*r AND rectangularity>=0.5 GROUP BY 1,2), f AS (SELECT prior_id, min(r) AS r, arg_min(k, r) AS k FROM n WHERE k>=2 GROUP BY 1)
 SELECT sd.prior_id, coalesce(f.r, 12.0) AS radius, coalesce(f.k,0) AS arms, CASE WHEN f.r IS NULL THEN 'seed_circle' WHEN f.r=15 THEN 'local_road' ELSE 'local_road_retry' END AS source, CASE WHEN f.k>=3 THEN 'good' WHEN f.k>=2 THEN 'weak' ELSE 'poor' END AS quality FROM sd LEFT JOIN f USING (prior_id)""")
def _(c):
    s = c.priors.select("prior_id", ((C("minx") + C("maxx")) / 2).alias("rx"), ((C("miny") + C("maxy")) / 2).alias("ry"))
    d = J.within(c.candidates.filter("rectangularity >= 0.5").select("x", "y"), s, 40.0)
    radii = F.array(*[F.lit(r) for r in (15.0, 25.0, 40.0)])
    n = d.select("prior_id", F.explode(F.filter(radii, lambda r: C("dist") <= r)).alias("r")).groupBy("prior_id", "r").agg(N().alias("k"))
    f = n.filter("k >= 2").groupBy("prior_id").agg(F.min(F.struct("r", "k")).alias("m"))
    j = c.priors.select("prior_id").join(f, "prior_id", "left")
    r, k = C("m.r"), C("m.k")
    return j.select("prior_id", F.coalesce(r, F.lit(12.0)).alias("radius"), F.coalesce(k, F.lit(0)).alias("arms"), R.first_reason([("seed_circle", r.isNull()), ("local_road", r == 15)], "local_road_retry").alias("source"),
                    R.first_reason([("good", k >= 3), ("weak", k >= 2)], "poor").alias("quality"))


SHAPES = """sd AS (SELECT prior_id AS seed, (minx+maxx)/2 AS px, (miny+maxy)/2 AS py FROM priors),
 road AS (SELECT ix, iy, (ix+0.5::DOUBLE)*4.0::DOUBLE AS x, (iy+0.5::DOUBLE)*4.0::DOUBLE AS y FROM (SELECT DISTINCT CAST(floor(x/4.0) AS BIGINT) ix, CAST(floor(y/4.0) AS BIGINT) iy FROM points WHERE z>=4.9 AND x>=100)),
 sat AS (SELECT ix, iy, (ix+0.5::DOUBLE)*4.0::DOUBLE AS x, (iy+0.5::DOUBLE)*4.0::DOUBLE AS y FROM (SELECT DISTINCT CAST(floor(x/4.0) AS BIGINT) ix, CAST(floor(y/4.0) AS BIGINT) iy FROM points WHERE z<0.3 AND x<85)),
 rd AS (SELECT seed, px, py, ix, iy, x, y, sqrt(pow(x-px,2)+pow(y-py,2)) AS d FROM sd, road WHERE sqrt(pow(x-px,2)+pow(y-py,2))<=30),
 rr AS (SELECT seed, CASE WHEN min(d)<=9 THEN 9.0::DOUBLE WHEN min(d)<=14 THEN 14.0::DOUBLE ELSE 30.0::DOUBLE END AS radius FROM rd GROUP BY 1 HAVING min(d)<=20),
 st AS (SELECT seed, ix, iy FROM sd, sat WHERE seed NOT IN (SELECT seed FROM rr) AND sqrt(pow(x-px,2)+pow(y-py,2))<=30),
 gx AS (SELECT *, UNNEST(range(CAST(floor(px/4.0) AS BIGINT)-2, CAST(floor(px/4.0) AS BIGINT)+3)) AS ix FROM sd WHERE seed NOT IN (SELECT seed FROM rr) AND seed NOT IN (SELECT seed FROM st)),
 ci AS (SELECT seed, ix, iy FROM (SELECT *, UNNEST(range(CAST(floor(py/4.0) AS BIGINT)-2, CAST(floor(py/4.0) AS BIGINT)+3)) AS iy FROM gx) WHERE sqrt(pow((ix+0.5)*4.0-px,2)+pow((iy+0.5)*4.0-py,2))<=5),
 loc AS (SELECT rd.seed, ix, iy, 'road_polygon' AS src, CASE radius WHEN 9 THEN 0 WHEN 14 THEN 1 ELSE 2 END AS step, radius FROM rd JOIN rr USING (seed) WHERE d<=radius
  UNION ALL SELECT seed, ix, iy, 'sat_fill', 2, 30.0::DOUBLE FROM st UNION ALL SELECT seed, ix, iy, 'seed_circle', 2, 5.0::DOUBLE FROM ci),
 atx AS (SELECT rd.seed, ix, iy, d, rd.x AS cx, rd.y AS cy, rd.px, rd.py, g.x AS ax, g.y AS ay, nx-g.x AS dx, ny-g.y AS dy FROM rd JOIN sg g ON g.nx IS NOT NULL AND rd.d<=9),
 ar AS (SELECT seed, ix, iy, d, CAST(floor((atan2(cy-py,cx-px)/(2*pi())+1)*8) AS BIGINT)%8 AS sector, min(sqrt(pow(cx-(ax+t*dx),2)+pow(cy-(ay+t*dy),2))) AS off
  FROM (SELECT *, CASE WHEN dx*dx+dy*dy>0 THEN least(greatest(((cx-ax)*dx+(cy-ay)*dy)/(dx*dx+dy*dy),0),1) ELSE 0 END AS t FROM atx) GROUP BY ALL),
 aw AS (SELECT * FROM ar WHERE off<=2.5),
 ce AS (SELECT seed, ix, iy, bool_or(l) AS l, bool_or(c) AS c, bool_or(a) AS a, bool_or(w) AS w FROM (SELECT seed, ix, iy, true AS l, src<>'road_polygon' AS c, false AS a, false AS w FROM loc UNION ALL SELECT seed, ix, iy, false, true, false, false FROM rd JOIN rr USING (seed) WHERE d<=5.4
  UNION ALL SELECT seed, ix, iy, false, false, off<=1, true FROM aw) GROUP BY 1,2,3),
 cs AS (SELECT seed, count(*) FILTER (l) AS nl, count(*) FILTER (l AND (c OR a))/CAST(count(*) FILTER (l) AS DOUBLE) AS cp, count(*) FILTER (l AND (c OR w))/CAST(count(*) FILTER (l) AS DOUBLE) AS cw, bool_or(a) AS ha FROM ce GROUP BY 1),
 na AS (SELECT seed, count(DISTINCT sector) AS arms FROM aw WHERE off<=1 AND d>=5.4 GROUP BY 1),
 us AS (SELECT cs.*, coalesce(arms,0) AS arms, CASE WHEN cp<0.8 AND coalesce(arms,0)>=2 AND cw>=0.8 THEN 'wide' WHEN cp<0.8 THEN 'local' ELSE 'plain' END AS use FROM cs LEFT JOIN na USING (seed)),
 sh AS (SELECT seed, ix, iy FROM ce JOIN us USING (seed) WHERE CASE use WHEN 'local' THEN l WHEN 'wide' THEN c OR w ELSE c OR a END)"""
SHAPE_RULES = JN.ShapeRules(cap=9.0, retries=(14.0, 30.0), max_offset=20.0, sat_reach=30.0, circle=5.0, core=(2.0, 22.0), arm=1.0, arm_add=1.5, coverage=0.8, min_arms=2)


def junction_shapes(c):
    seeds = c.priors.select(C("prior_id").alias("seed"), ((C("minx") + C("maxx")) / 2).alias("sx"), ((C("miny") + C("maxy")) / 2).alias("sy"))
    seg = L.segments(c.poses.select("drive_id", C("frame_id").alias("idx"), "x", "y"), ["drive_id"], "idx").select(C("x").alias("ax"), C("y").alias("ay"), C("n_x").alias("bx"), C("n_y").alias("by_"))
    return JN.seed_shapes(seeds, G.with_cell(c.points.filter("z >= 4.9 and x >= 100"), 4.0), seg, G.with_cell(c.points.filter("z < 0.3 and x < 85"), 4.0), SHAPE_RULES)


@query("x40_intersection_shape", f"""WITH {LINE}, {SHAPES} SELECT us.seed, any_value(src) AS src, CAST(any_value(step) AS INTEGER) AS retries, round(any_value(radius),6) AS radius, CAST(any_value(arms) AS INTEGER) AS arms,
 CASE WHEN any_value(use)='wide' THEN 'coverage_retry' WHEN any_value(use)='local' THEN 'coverage_fallback_road_local' WHEN any_value(src)='sat_fill' THEN 'sat_fill_fallback' WHEN any_value(src)='seed_circle' THEN 'seed_circle_fallback' WHEN any_value(ha) THEN 'refined_arms' ELSE 'core_only' END AS reason,
 round(CASE any_value(use) WHEN 'wide' THEN any_value(cw) WHEN 'local' THEN 1 ELSE any_value(cp) END,6) AS coverage, CASE WHEN any_value(src)='seed_circle' THEN 'very_low' WHEN any_value(use)='local' THEN 'low' ELSE 'ok' END AS quality,
 any_value(n) AS cells, round(any_value(n)*16.0::DOUBLE,6) AS area_m2 FROM us JOIN loc USING (seed) JOIN (SELECT seed, count(*) AS n FROM sh GROUP BY 1) USING (seed) GROUP BY 1""")
def _(c):
    return junction_shapes(c)[1]


@query("x40_shape_cells", f"WITH {LINE}, {SHAPES} SELECT * FROM sh")
def _(c):
    return junction_shapes(c)[0]


SEEDQ = """sq AS (SELECT cand_id, CASE class WHEN '1-URGENT' THEN 'osm' WHEN '2-HIGH' THEN 'traj' WHEN '3-MEDIUM' THEN 'geom' ELSE 'sat' END AS src_seed, x, y, frame_id//4 AS tile, sqrt(rect_l*rect_w/pi()) AS radius FROM candidates),
 o AS (SELECT *, row_number() OVER (PARTITION BY tile ORDER BY CASE src_seed WHEN 'osm' THEN 0 WHEN 'traj' THEN 1 WHEN 'geom' THEN 2 ELSE 3 END, cand_id) AS r FROM sq),
 f AS (SELECT tile, r, cand_id, true AS keep, [{'x': x, 'y': y}] AS ks FROM o WHERE r=1 UNION ALL SELECT tile, r, cand_id, NOT hit, CASE WHEN hit THEN ks ELSE list_append(ks, {'x': x, 'y': y}) END FROM (SELECT o.*, ks, len(list_filter(ks, lambda k: sqrt(pow(k.x-o.x,2)+pow(k.y-o.y,2))<=25))>0 AS hit FROM f JOIN o ON o.tile=f.tile AND o.r=f.r+1))"""


@query("x41_seed_collection", f"WITH RECURSIVE {SEEDQ} SELECT sq.cand_id, src_seed, round(radius,6) AS radius FROM f JOIN sq USING (cand_id) WHERE keep")
def _(c):
    part = lambda cls, src: c.candidates.filter(C("class").isin(*cls)).select("cand_id", "x", "y", F.floor(C("frame_id") / 4).alias("tile"), F.sqrt(C("rect_l") * C("rect_w") / F.pi()).alias("radius"), F.lit(src).alias("src_seed"))
    u = part(["1-URGENT"], "osm").unionByName(part(["2-HIGH"], "traj")).unionByName(part(["3-MEDIUM"], "geom")).unionByName(part(["4-NOT SPECIFIED", "5-LOW"], "sat"))
    rank = F.when(C("src_seed") == "osm", 0).when(C("src_seed") == "traj", 1).when(C("src_seed") == "geom", 2).otherwise(3)
    k = GR.greedy_keep(u, "cand_id", ["tile"], [-rank, -C("cand_id")], 25.0, lambda a, b: F.hypot(a("x") - b("x"), a("y") - b("y")) <= 25)
    return k.filter("kept").select("cand_id", "src_seed", "radius")


@query("x42_qa_rows", """WITH n AS (SELECT p.drive_id, p.frame_id, count(*) AS k, count(*) FILTER (rectangularity>=0.5) AS fin, list_sort(list(DISTINCT class)) AS kinds FROM poses p JOIN candidates c ON c.drive_id=p.drive_id AND pow(c.x-p.x,2)+pow(c.y-p.y,2)<=400.0 GROUP BY 1,2)
 SELECT p.drive_id, p.frame_id, coalesce(k,0) AS candidates, coalesce(fin,0) AS finals, coalesce(kinds,[]) AS kinds, CASE WHEN fin>0 THEN 'yes' ELSE 'no' END AS support FROM poses p LEFT JOIN n ON n.drive_id=p.drive_id AND n.frame_id=p.frame_id""")
def _(c):
    p = c.poses.select("drive_id", C("frame_id").alias("pf"), C("x").alias("rx"), C("y").alias("ry"))
    j = J.within(c.candidates.select("drive_id", "x", "y", "rectangularity", "class"), p, 20.0, ["drive_id"])
    n = j.groupBy("drive_id", C("pf").alias("frame_id")).agg(N().alias("k"), F.count_if(C("rectangularity") >= 0.5).alias("fin"), F.array_sort(F.collect_set("class")).alias("kinds"))
    q = c.poses.select("drive_id", "frame_id").join(n, ["drive_id", "frame_id"], "left")
    return q.select("drive_id", "frame_id", F.coalesce("k", F.lit(0)).alias("candidates"), F.coalesce("fin", F.lit(0)).alias("finals"), F.coalesce("kinds", F.array().cast("array<string>")).alias("kinds"), F.when(C("fin") > 0, "yes").otherwise("no").alias("support"))


@query("x43_surface_from_cells", f"WITH {CELLS}, oc AS (SELECT drive_id, ix, iy, avg(z) AS h FROM cells GROUP BY 1,2,3 HAVING count(*)>=4), {SEED}, o AS (SELECT UNNEST(range(-1,2)) AS d), cor AS (SELECT DISTINCT drive_id, ix+a.d AS ix, iy+b.d AS iy FROM seed, o a, o b) SELECT drive_id, count(*) AS cells, round(avg(h),6) AS height FROM oc SEMI JOIN cor USING (drive_id, ix, iy) GROUP BY 1")
def _(c):
    occ = G.height_stats(c.points, RES, 4, BY).filter("n >= 4")
    return occ.join(G.dilate(seeds(c), 1, BY), [*BY, "ix", "iy"], "left_semi").groupBy(*BY).agg(N().alias("cells"), F.avg("mean").alias("height"))


@query("x44_entity_confidence", "SELECT frame_id, round(least(1.0, 0.4+CASE WHEN bool_or(model='F') THEN 0.3 ELSE 0 END+CASE WHEN bool_or(model='O') THEN 0.2 ELSE 0 END+CASE WHEN bool_or(model='P') THEN 0.1 ELSE 0 END)::DOUBLE,6) AS confidence FROM candidates GROUP BY 1")
def _(c):
    add = lambda m, v: F.when(F.bool_or(C("model") == m), v).otherwise(0.0)
    return c.candidates.groupBy("frame_id").agg(F.least(F.lit(1.0), 0.4 + add("F", 0.3) + add("O", 0.2) + add("P", 0.1)).alias("confidence"))


@query("x46_contour_crops", """WITH v AS (SELECT drive_id, frame_id AS pos, frame_id//16 AS part, x, y FROM poses WHERE frame_id%2=0), l AS (SELECT *, CASE WHEN y BETWEEN 110 AND 150 THEN 0 WHEN y BETWEEN 104 AND 190 THEN 1 END AS lv FROM v), k AS (SELECT drive_id, part, count(*) FILTER (lv=0) AS strict, count(lv) AS relaxed FROM l GROUP BY 1,2) SELECT drive_id, part, CASE WHEN strict>=4 THEN 'strict' ELSE 'relaxed' END AS crop, CASE WHEN strict>=4 THEN strict ELSE relaxed END AS points FROM k""")
def _(c):
    v = c.poses.filter("frame_id % 2 = 0").select("drive_id", F.expr("frame_id div 16").alias("part"), "y")
    k = v.groupBy("drive_id", "part").agg(F.count_if(C("y").between(110, 150)).alias("s"), F.count_if(C("y").between(104, 190)).alias("r"))
    return k.select("drive_id", "part", F.when(C("s") >= 4, "strict").otherwise("relaxed").alias("crop"), F.when(C("s") >= 4, C("s")).otherwise(C("r")).alias("points"))


@query("x48_top_failures", "WITH t AS (SELECT proj_method, UNNEST(string_split(reject_reasons,',')) AS reason FROM trace WHERE geom_ok=0 AND reject_reasons<>''), n AS (SELECT proj_method, reason, count(*) AS n, row_number() OVER (PARTITION BY proj_method ORDER BY count(*) DESC, reason) AS rank FROM t GROUP BY 1,2) SELECT proj_method, reason, n, rank FROM n WHERE rank<=3")
def _(c):
    t = c.trace.filter("geom_ok = 0").select("proj_method", F.explode(R.tokens(C("reject_reasons"))).alias("reason"))
    return top_per_group(t.groupBy("proj_method", "reason").agg(N().alias("n")), ["proj_method"], [F.desc("n"), C("reason")], 3)
