"""Spatial, nearest, range and as-of joins."""

from pyspark.sql import Window as W, functions as F

from wayfold.functions import geometry as E
from wayfold.operators import grid as G, joins as J, lines as L, shapes as S
from wayfold.operators.ordered import with_one_row
from wayfold.queries.catalog import C, query
from wayfold.queries.q_e_geometry import CELLSET, LINE, SEGD, cells_of
from wayfold.session import shuffled

NEAR = """nn AS (SELECT q.*, p.frame_id AS nf, p.yaw AS nyaw, p.z AS nz, p.dx AS ndist FROM {src} q, LATERAL (SELECT frame_id, yaw, z, (poses.x-q.x)*(poses.x-q.x)+(poses.y-q.y)*(poses.y-q.y) AS dx FROM poses WHERE poses.drive_id=q.drive_id ORDER BY dx, frame_id LIMIT 1) p)"""


@query("j01_points_with_pose", "SELECT s.drive_id, s.frame_id, s.pt_id, round(p.x,6) AS p_x, round(p.yaw,6) AS p_yaw FROM sweeps s JOIN poses p ON s.drive_id=p.drive_id AND s.frame_id=p.frame_id")
def _(c):
    return J.attach_pose(c.sweeps, c.poses).select("drive_id", "frame_id", "pt_id", "p_x", "p_yaw")


MISS = """ex AS (SELECT drive_id, frame_id FROM sweeps UNION SELECT drive_id, frame_id FROM poses UNION SELECT drive_id, frame_id+3 FROM poses),
 ms AS (SELECT drive_id, frame_id, CASE WHEN (drive_id, frame_id) NOT IN (SELECT (drive_id, frame_id) FROM sweeps) THEN 'missing_velodyne' WHEN (drive_id, frame_id) NOT IN (SELECT (drive_id, frame_id) FROM poses) THEN 'missing_pose_frame' END AS reason FROM ex)"""


def missing(c):
    k = ["drive_id", "frame_id"]
    p = c.poses.select(*k)
    ex = c.sweeps.select(*k).unionByName(p).unionByName(p.withColumn("frame_id", C("frame_id") + 3))
    return J.missing_frames(ex, c.sweeps, c.poses)


@query("j01_missing_frames", f"WITH {MISS} SELECT drive_id, frame_id, reason FROM ms WHERE reason IS NOT NULL")
def _(c):
    return missing(c)


@query("a04_missing_reason_histogram", f"WITH {MISS} SELECT reason, count(*) AS n FROM ms WHERE reason IS NOT NULL GROUP BY 1")
def _(c):
    return missing(c).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def near_pose(c, df):
    return J.nearest(df, c.poses.select("drive_id", "frame_id", "x", "y", "yaw", "z"), ["frame_id", "yaw", "z"], ["drive_id"], 32.0)


@query("j02_nearest_vertex", f"WITH {NEAR.format(src='points')} SELECT drive_id, nf AS near_frame_id, count(*) AS n, round(min(sqrt(ndist)),5) AS d_min, round(max(sqrt(ndist)),5) AS d_max FROM nn GROUP BY ALL")
def _(c):
    n = near_pose(c, c.points.select("drive_id", "x", "y"))
    return n.groupBy("drive_id", "near_frame_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.min("near_dist"), 5).alias("d_min"), F.round(F.max("near_dist"), 5).alias("d_max"))


@query("r13_layer_reject", f"WITH {NEAR.format(src='points')} SELECT drive_id, count(*) AS kept, round(avg(z),6) AS z_mean FROM nn WHERE z >= nz-0.5137 AND z <= nz+3.1371 GROUP BY 1")
def _(c):
    n = near_pose(c, c.points.select("drive_id", "x", "y", C("z").alias("pz")))
    keep = n.filter((C("pz") >= C("near_z") - 0.5137) & (C("pz") <= C("near_z") + 3.1371))
    return keep.groupBy("drive_id").agg(F.count(F.lit(1)).alias("kept"), F.avg("pz").alias("z_mean"))


@query("j03_candidates_near_line", f"""WITH {LINE}, q AS (SELECT cand_id, drive_id, x AS qx, y AS qy FROM candidates), t AS (SELECT cand_id, {SEGD} AS t, x, y, nx, ny, qx, qy, frame_id FROM q JOIN sg ON q.drive_id=sg.drive_id AND nx IS NOT NULL AND qx BETWEEN least(x,nx)-15 AND greatest(x,nx)+15 AND qy BETWEEN least(y,ny)-15 AND greatest(y,ny)+15)
 SELECT cand_id, count(*) AS segments FROM t WHERE pow(qx-x-t*(nx-x),2)+pow(qy-y-t*(ny-y),2)<=225 GROUP BY 1""")
def _(c):
    seg = L.segments(c.poses.select("drive_id", "frame_id", "x", "y"), ["drive_id"], "frame_id")
    seg = seg.select("drive_id", C("x").alias("ax"), C("y").alias("ay"), C("n_x").alias("bx"), C("n_y").alias("by_"))
    return J.near_segments(c.candidates.select("cand_id", "drive_id", "x", "y"), seg, 15.0, ["drive_id"]).groupBy("cand_id").agg(F.count(F.lit(1)).alias("segments"))


BOXD = "sqrt(pow(greatest(minx-x,0,x-maxx),2)+pow(greatest(miny-y,0,y-maxy),2))"


@query("j04_drive_by_containment_or_nearest", f"""WITH d AS (SELECT cand_id, prior_id, {BOXD} AS d, row_number() OVER (PARTITION BY cand_id ORDER BY {BOXD}, prior_id) AS r FROM candidates, priors WHERE x BETWEEN minx-60 AND maxx+60 AND y BETWEEN miny-60 AND maxy+60)
 SELECT cand_id, prior_id, round(d,6) AS dist FROM (SELECT cand_id FROM candidates) LEFT JOIN (SELECT * FROM d WHERE r=1 AND d<=60) USING (cand_id)""")
def _(c):
    wide = c.priors.select("prior_id", *[(C(k) - 60).alias(k) for k in ("minx", "miny")], *[(C(k) + 60).alias(k) for k in ("maxx", "maxy")])
    j = J.in_boxes(c.candidates.select("cand_id", "x", "y"), shuffled(wide), 128.0)
    box = E.make_box(C("minx") + 60, C("miny") + 60, C("maxx") - 60, C("maxy") - 60)
    j = j.select("cand_id", F.struct(E.box_distance(box, C("x"), C("y")).alias("d"), "prior_id").alias("m"))
    near = j.groupBy("cand_id").agg(F.min("m").alias("m")).select("cand_id", "m.prior_id", C("m.d").alias("dist")).filter("dist <= 60")
    return c.candidates.select("cand_id").join(near, "cand_id", "left")


def box_pairs(c):
    return J.in_boxes(c.candidates.select("cand_id", "x", "y"), c.priors, 64.0)


@query("j05_largest_box_wins", """WITH d AS (SELECT cand_id, arg_max(prior_id, {'a': (maxx-minx)*(maxy-miny), 'i': prior_id}) AS prior_id FROM candidates JOIN priors ON x BETWEEN minx AND maxx AND y BETWEEN miny AND maxy GROUP BY 1)
 SELECT c.cand_id, d.prior_id FROM candidates c LEFT JOIN d USING (cand_id)""")
def _(c):
    best = box_pairs(c).groupBy("cand_id").agg(F.max(F.struct(((C("maxx") - C("minx")) * (C("maxy") - C("miny"))).alias("a"), "prior_id")).alias("m"))
    return c.candidates.select("cand_id").join(best, "cand_id", "left").select("cand_id", "m.prior_id")


@query("j05_first_box_wins", """WITH d AS (SELECT cand_id, min(prior_id) AS prior_id FROM candidates JOIN priors ON x BETWEEN minx AND maxx AND y BETWEEN miny AND maxy GROUP BY 1)
 SELECT count(*) AS total, count(d.prior_id) AS matched, count(*)-count(d.prior_id) AS unmatched, CAST(sum(d.prior_id) AS BIGINT) AS id_sum FROM candidates LEFT JOIN d USING (cand_id)""")
def _(c):
    best = box_pairs(c).groupBy("cand_id").agg(F.min("prior_id").alias("prior_id"))
    n = F.count(F.lit(1))
    return c.candidates.select("cand_id").join(best, "cand_id", "left").agg(n.alias("total"), F.count("prior_id").alias("matched"), (n - F.count("prior_id")).alias("unmatched"), F.sum("prior_id").alias("id_sum"))


@query("j06_frame_by_nearest_pose", f"WITH {NEAR.format(src='candidates')} SELECT cand_id, nf AS near_frame_id, round(sqrt(ndist),5) AS near_dist FROM nn")
def _(c):
    return near_pose(c, c.candidates.select("cand_id", "drive_id", "x", "y")).select("cand_id", "near_frame_id", F.round("near_dist", 5).alias("near_dist")).filter("near_frame_id is not null")


def pose_pairs(c, d):
    p = c.poses.select("drive_id", C("frame_id").alias("pose_frame"), C("x").alias("rx"), C("y").alias("ry"), "yaw")
    p = p.join(c.candidates.select("drive_id").distinct(), "drive_id", "left_semi")  # poses of other drives would be copied to cells in vain
    return J.within(c.candidates.select("cand_id", "drive_id", "x", "y"), p, d, ["drive_id"])


@query("j07_frames_within_radius", "SELECT cand_id, count(DISTINCT p.frame_id) AS frames FROM candidates c JOIN poses p ON p.drive_id=c.drive_id AND pow(c.x-p.x,2)+pow(c.y-p.y,2)<=400.0 GROUP BY 1")
def _(c):
    return pose_pairs(c, 20.0).groupBy("cand_id").agg(F.countDistinct("pose_frame").alias("frames"))


@query("j08_first_tile", """WITH t AS (SELECT n_nationkey AS tile, n_nationkey*40.0::DOUBLE AS minx, n_nationkey*40.0::DOUBLE+70 AS maxx, 0.0::DOUBLE AS miny, 150.0::DOUBLE AS maxy FROM nation)
 SELECT tile, CAST(sum(w) AS BIGINT) AS n FROM (SELECT x, y, any_value(w) AS w, min(tile) AS tile FROM (SELECT x, y, count(*) AS w FROM points GROUP BY 1,2) LEFT JOIN t ON x BETWEEN minx AND maxx AND y BETWEEN miny AND maxy GROUP BY 1,2) GROUP BY 1""")
def _(c):
    t = c.nation.select(C("n_nationkey").alias("tile"), (C("n_nationkey") * F.lit(40.0)).alias("minx"), (C("n_nationkey") * F.lit(40.0) + 70).alias("maxx"), F.lit(0.0).alias("miny"), F.lit(150.0).alias("maxy"))
    p = c.points.groupBy("x", "y").agg(F.count(F.lit(1)).alias("w"))  # points at one spot share the tile
    hit = J.in_boxes(p, t, 64.0).groupBy("x", "y").agg(F.min("tile").alias("tile"))
    return p.join(hit, ["x", "y"], "left").groupBy("tile").agg(F.sum("w").alias("n"))


@query("j09_support_frames", f"""WITH {CELLSET}, n AS (SELECT cand_id, count(*) AS n FROM cs GROUP BY 1), ab AS (SELECT a.cand_id AS a_id, b.cand_id AS b_id, count(*) AS k FROM cs a JOIN cs b ON a.ix=b.ix AND a.iy=b.iy WHERE a.model='F' AND b.model='O' GROUP BY ALL)
 SELECT a_id, count(DISTINCT q.frame_id) AS support_frames FROM ab JOIN n na ON na.cand_id=a_id JOIN n nb ON nb.cand_id=b_id JOIN candidates p ON p.cand_id=a_id JOIN candidates q ON q.cand_id=b_id
 WHERE k/CAST(na.n+nb.n-k AS DOUBLE)>=0.1037 AND pow(p.x-q.x,2)+pow(p.y-q.y,2)<=16.0 GROUP BY 1""")
def _(c):
    ov = G.cell_set_overlap(cells_of(c, "F", "a_id"), cells_of(c, "O", "b_id"), "a_id", "b_id").filter("iou >= 0.1037")
    at = lambda p: c.candidates.select(C("cand_id").alias(p + "_id"), C("x").alias(p + "x"), C("y").alias(p + "y"), C("frame_id").alias(p + "f"))
    j = ov.join(at("a"), "a_id").join(at("b"), "b_id").filter(F.hypot(C("ax") - C("bx"), C("ay") - C("by")) <= 4.0)
    return j.groupBy("a_id").agg(F.countDistinct("bf").alias("support_frames"))


SUP = """pv AS (SELECT frame_id // 2 AS frame_id, (x*7) AS u, (y+20)*6 AS v, z, intensity FROM sweeps),
 sp AS (SELECT d.det_id, p.* FROM detections d JOIN pv p ON p.frame_id=d.frame_id AND u BETWEEN x0 AND x1 AND v BETWEEN y0 AND y1)"""


def support(c):
    """Projected points inside each detection box of their frame, bucketed by image column."""
    pv = c.sweeps.select(F.expr("frame_id div 2").alias("frame_id"), (C("x") * 7).alias("x"), ((C("y") + 20) * 6).alias("y"), "z", "intensity")
    d = c.detections.select("det_id", "frame_id", C("x0").alias("minx"), C("y0").alias("miny"), C("x1").alias("maxx"), C("y1").alias("maxy"))
    return J.in_boxes(pv, d, 128.0, ["frame_id"])


@query("j10_lidar_support", f"""WITH {SUP}, q AS (SELECT det_id, quantile_cont(intensity,0.9) AS top, quantile_cont(z,0.5) AS zm FROM sp GROUP BY 1)
 SELECT s.det_id, count(*) AS points_in_bbox, count(*) FILTER (intensity>=top) AS points_top, count(*) FILTER (abs(z-zm)<=0.3137) AS points_ground FROM sp s JOIN q ON q.det_id=s.det_id GROUP BY 1""")
def _(c):
    s = support(c)
    q = s.groupBy("det_id").agg(F.percentile("intensity", F.lit(0.9)).alias("top"), F.percentile("z", F.lit(0.5)).alias("zm"))
    return s.join(q, "det_id").groupBy("det_id").agg(F.count(F.lit(1)).alias("points_in_bbox"), F.count_if(C("intensity") >= C("top")).alias("points_top"),
                                                     F.count_if(F.abs(C("z") - C("zm")) <= 0.3137).alias("points_ground"))


@query("j11_nearest_heading", f"""WITH {NEAR.format(src='candidates')}, rd AS (SELECT cand_id, count(*) AS n, degrees(0.5*atan2(2*covar_samp(p.x,p.y), var_samp(p.x)-var_samp(p.y))) AS a FROM candidates c JOIN poses p ON p.drive_id=c.drive_id AND pow(c.x-p.x,2)+pow(c.y-p.y,2)<=900.0 GROUP BY 1)
 SELECT nn.cand_id, round(coalesce(CASE WHEN rd.n>=2 THEN CASE WHEN a<0 THEN a+180 ELSE a END END, (degrees(nyaw)%360)),5) AS heading, CASE WHEN rd.n>=2 THEN 'trajectory' ELSE 'yaw' END AS source FROM nn LEFT JOIN rd ON rd.cand_id=nn.cand_id""")
def _(c):
    near = near_pose(c, c.candidates.select("cand_id", "drive_id", "x", "y")).filter("near_frame_id is not null")
    pts = pose_pairs(c, 30.0).select("cand_id", C("rx").alias("x"), C("ry").alias("y"))
    j = near.join(S.direction(pts, ["cand_id"]), "cand_id", "left")
    return j.select("cand_id", F.round(F.coalesce("direction", F.degrees("near_yaw") % 360), 5).alias("heading"), F.when(C("direction").isNotNull(), "trajectory").otherwise("yaw").alias("source"))


@query("j12_missing_junctions", "SELECT drive_id, count(*) AS missing FROM poses p WHERE NOT EXISTS (SELECT 1 FROM candidates c WHERE c.drive_id=p.drive_id AND pow(c.x-p.x,2)+pow(c.y-p.y,2)<=225.0) GROUP BY 1")
def _(c):
    hit = pose_pairs(c, 15.0).select("drive_id", C("pose_frame").alias("frame_id")).distinct()
    return c.poses.join(hit, ["drive_id", "frame_id"], "left_anti").groupBy("drive_id").agg(F.count(F.lit(1)).alias("missing"))


@query("j13_nearest_degree", """WITH n AS (SELECT prior_id, (minx+maxx)/2 AS px, (miny+maxy)/2 AS py, prior_id%5+1 AS degree FROM priors), d AS (SELECT cand_id, arg_min(degree, {'d': pow(x-px,2)+pow(y-py,2), 'i': prior_id}) AS degree FROM candidates JOIN n ON pow(x-px,2)+pow(y-py,2)<=625.0 GROUP BY 1)
 SELECT coalesce(degree,2) AS degree, count(*) AS n FROM candidates LEFT JOIN d USING (cand_id) GROUP BY 1""")
def _(c):
    n = c.priors.select("prior_id", ((C("minx") + C("maxx")) / 2).alias("rx"), ((C("miny") + C("maxy")) / 2).alias("ry"), (C("prior_id") % 5 + 1).alias("degree"))
    best = J.within(c.candidates.select("cand_id", "x", "y"), n, 25.0).groupBy("cand_id").agg(F.min(F.struct("dist", "prior_id", "degree")).alias("m"))
    j = c.candidates.select("cand_id").join(best, "cand_id", "left").select(F.coalesce("m.degree", F.lit(2)).cast("long").alias("degree"))
    return j.groupBy("degree").agg(F.count(F.lit(1)).alias("n"))


@query("j14_expected_vs_final", """WITH e AS (SELECT cand_id, x, y FROM candidates WHERE class='1-URGENT'), f AS (SELECT cand_id, x, y FROM candidates WHERE class='2-HIGH'),
 m AS (SELECT count(*) AS n FROM e WHERE EXISTS (SELECT 1 FROM f WHERE abs(e.x-f.x)<=8 AND pow(e.x-f.x,2)+pow(e.y-f.y,2)<=64)), p AS (SELECT count(*) AS n FROM f WHERE NOT EXISTS (SELECT 1 FROM e WHERE abs(e.x-f.x)<=15 AND pow(e.x-f.x,2)+pow(e.y-f.y,2)<=225))
 SELECT (SELECT count(*) FROM e) AS expected, m.n AS matched, round(m.n/CAST((SELECT count(*) FROM e) AS DOUBLE),6) AS recall, p.n AS false_positives FROM m, p""")
def _(c):
    e = c.candidates.filter("class = '1-URGENT'").select("cand_id", "x", "y")
    f = c.candidates.filter("class = '2-HIGH'").select("cand_id", "x", "y")
    r = lambda d: d.select(C("x").alias("rx"), C("y").alias("ry")).distinct()
    hit = J.within(e, r(f), 8.0).select("cand_id").distinct()
    near = J.within(f, r(e), 15.0).select("cand_id").distinct()
    a = e.join(hit.withColumn("h", F.lit(1)), "cand_id", "left").agg(F.count(F.lit(1)).alias("expected"), F.count("h").alias("matched"))
    b = f.join(near, "cand_id", "left_anti").agg(F.count(F.lit(1)).alias("false_positives"))
    return with_one_row(a, b).select("expected", "matched", (C("matched") / C("expected")).alias("recall"), "false_positives")


@query("j15_baseline_delta", """WITH cur AS (SELECT drive_id, max(n_intersections) AS max_degree, count(*) FILTER (dangling_per_km>5) AS issues, count(*) AS actions FROM runs GROUP BY 1), base AS (SELECT c_custkey AS drive_id, CAST(c_nationkey%8 AS BIGINT) AS b_degree, CAST(c_nationkey AS BIGINT) AS b_issues FROM customer WHERE c_acctbal>0)
 SELECT cur.drive_id, list_filter([CASE WHEN b_degree IS NULL THEN 'baseline missing' END, CASE WHEN max_degree>b_degree THEN 'max_degree' END, CASE WHEN issues>b_issues+2 THEN 'issues_count' END], lambda v: v IS NOT NULL) AS reasons, max_degree-b_degree AS delta_degree FROM cur LEFT JOIN base USING (drive_id)""")
def _(c):
    cur = c.runs.groupBy("drive_id").agg(F.max("n_intersections").alias("max_degree"), F.count_if(C("dangling_per_km") > 5).alias("issues"))
    base = c.customer.filter("c_acctbal > 0").select(C("c_custkey").alias("drive_id"), (C("c_nationkey") % 8).cast("long").alias("b_degree"), C("c_nationkey").cast("long").alias("b_issues"))
    from wayfold.functions.records import reasons
    r = reasons({"baseline missing": C("b_degree").isNull(), "max_degree": C("max_degree") > C("b_degree"), "issues_count": C("issues") > C("b_issues") + 2})
    return cur.join(base, "drive_id", "left").select("drive_id", r.alias("reasons"), (C("max_degree") - C("b_degree")).alias("delta_degree"))


@query("j16_part_by_arc_length", f"WITH {LINE} SELECT drive_id, CAST((s>=100)::INT+(s>=200)::INT+(s>=400)::INT+(s>=800)::INT AS INTEGER) AS part, count(*) AS n FROM sl GROUP BY ALL")
def _(c):
    s = L.arc_length(c.poses.select("drive_id", "frame_id", "x", "y"), ["drive_id"], "frame_id")
    b = F.array(*[F.lit(float(v)) for v in (100, 200, 400, 800)])
    return s.select("drive_id", J.part_of(C("s"), b).alias("part")).groupBy("drive_id", "part").agg(F.count(F.lit(1)).alias("n"))


@query("j17_closest_frame", """WITH ex AS (SELECT DISTINCT drive_id, frame_id FROM candidates), tg AS (SELECT DISTINCT drive_id % 8 AS drive_id, event_id*2 AS target FROM poses), r AS (SELECT t.drive_id, t.target, e.frame_id, abs(e.frame_id-t.target) AS gap FROM tg t, LATERAL (SELECT frame_id FROM ex WHERE ex.drive_id=t.drive_id ORDER BY abs(frame_id-t.target), frame_id LIMIT 1) e)
 SELECT drive_id, target, frame_id, gap FROM r""")
def _(c):
    t = c.poses.select((C("drive_id") % 8).alias("drive_id"), (C("event_id") * 2).alias("target")).distinct()
    return J.closest_frame(t, c.candidates, ["drive_id"], 64)


@query("j18_error_suspects", """WITH d AS (SELECT event_type AS code, string_split(CASE event_type WHEN 'click' THEN 'M2,M5' WHEN 'view' THEN 'M6a' WHEN 'error' THEN 'M0,M7,M8' ELSE 'M9' END,',') AS mods FROM (SELECT DISTINCT event_type FROM events))
 SELECT m AS module, count(*) AS issues FROM (SELECT UNNEST(mods) AS m FROM events JOIN d ON d.code=event_type) GROUP BY 1""")
def _(c):
    code = c.events.select(C("event_type").alias("code")).distinct()
    mods = F.when(C("code") == "click", "M2,M5").when(C("code") == "view", "M6a").when(C("code") == "error", "M0,M7,M8").otherwise("M9")
    dim = code.select("code", F.split(mods, ",").alias("mods"))
    per = c.events.groupBy(C("event_type").alias("code")).agg(F.count(F.lit(1)).alias("n"))
    return per.join(dim, "code").select(F.explode("mods").alias("module"), "n").groupBy("module").agg(F.sum("n").alias("issues"))


@query("j19_reference_check", """WITH a AS (SELECT l_orderkey AS action_id, UNNEST([l_orderkey, l_orderkey+l_linenumber*3000]) AS issue_id FROM lineitem) SELECT issue_id, count(*) AS actions FROM a WHERE issue_id NOT IN (SELECT o_orderkey FROM orders) GROUP BY 1""")
def _(c):
    a = c.lineitem.select(F.explode(F.array(C("l_orderkey"), C("l_orderkey") + C("l_linenumber") * 3000)).alias("issue_id"))
    return a.groupBy("issue_id").agg(F.count(F.lit(1)).alias("actions")).join(c.orders.select(C("o_orderkey").alias("issue_id")), "issue_id", "left_anti")


COVER = """l AS (SELECT DISTINCT user_id AS d, event_id//3 AS f FROM events WHERE event_type<>'error'), i0 AS (SELECT DISTINCT user_id AS d, event_id//3 AS f FROM events WHERE event_type='click'), i1 AS (SELECT DISTINCT user_id AS d, event_id//3 AS f FROM events WHERE event_type='view'), ps AS (SELECT DISTINCT user_id AS d, event_id//3 AS f FROM events WHERE value>30)"""


@query("j20_modality_coverage", f"""WITH {COVER} SELECT d AS drive_id, count(*) AS lidar, count(*) FILTER ((d,f) IN (SELECT (d,f) FROM i0) OR (d,f) IN (SELECT (d,f) FROM i1)) AS img_any, count(*) FILTER ((d,f) IN (SELECT (d,f) FROM ps)) AS pose FROM l GROUP BY 1""")
def _(c):
    k = ["drive_id", "frame"]
    ids = lambda cond: c.events.filter(cond).select(C("user_id").alias("drive_id"), F.expr("event_id div 3").alias("frame")).distinct()
    lidar = ids(C("event_type") != "error")
    img = ids(C("event_type") == "click").union(ids(C("event_type") == "view")).distinct().withColumn("img", F.lit(1))
    pose = ids(C("value") > 30).withColumn("pose", F.lit(1))
    j = lidar.join(img, k, "left").join(pose, k, "left")
    return j.groupBy("drive_id").agg(F.count(F.lit(1)).alias("lidar"), F.count("img").alias("img_any"), F.count("pose").alias("pose"))
