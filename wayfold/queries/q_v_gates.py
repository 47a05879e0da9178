"""Gates, scores, validation and report tables."""

from pyspark.sql import functions as F

from wayfold.functions import geometry as E, records as R
from wayfold.operators import gates as V, grid as G, joins as J
from wayfold.queries.catalog import C, query
from wayfold.queries.q_r_grid import BASE, BY, RES


def N():
    return F.count(F.lit(1))


@query("v01_cba_gate", """SELECT drive_id, window_id, CASE WHEN c_ratio<0.80 THEN 'C_below' WHEN b_rough>0.40 THEN 'B_above' WHEN dangling_per_km>7.0 THEN 'A_above' ELSE 'ok' END AS reason FROM runs""")
def _(c):
    return c.runs.select("drive_id", "window_id", V.cba_gate(C("c_ratio"), C("b_rough"), C("dangling_per_km")).alias("reason"))


@query("v02_geometry_metrics", """SELECT drive_id, round_even(avg(c_ratio),4) AS c, round_even(avg(b_rough)/greatest(avg(line_len)/1000,0.001),4) AS b, round_even(sum(dangling_per_km)/greatest(sum(line_len)/1000,0.001),3) AS a FROM runs GROUP BY 1""")
def _(c):
    km = lambda v: F.greatest(v / 1000, F.lit(0.001))
    return c.runs.groupBy("drive_id").agg(F.bround(F.avg("c_ratio"), 4).alias("c"), F.bround(F.avg("b_rough") / km(F.avg("line_len")), 4).alias("b"), F.bround(F.sum("dangling_per_km") / km(F.sum("line_len")), 3).alias("a"))


@query("v03_coverage_arms", """SELECT drive_id, arm, round_even(avg(c_ratio),4) AS "C", round_even(avg(b_rough),4) AS "B", round_even(avg(dangling_per_km),3) AS "A", round(avg(conflict_rate),6) AS conflict, count(*) AS windows,
 CASE WHEN round_even(avg(c_ratio),4)<0.8 THEN 'C_below' WHEN round_even(avg(b_rough),4)>0.4 THEN 'B_above' WHEN round_even(avg(dangling_per_km),3)>7.0 THEN 'A_above' ELSE 'ok' END AS gate FROM runs GROUP BY 1,2""")
def _(c):
    # measured per arm, not derived from the coverage
    m = c.runs.groupBy("drive_id", "arm").agg(F.bround(F.avg("c_ratio"), 4).alias("C"), F.bround(F.avg("b_rough"), 4).alias("B"), F.bround(F.avg("dangling_per_km"), 3).alias("A"), F.avg("conflict_rate").alias("conflict"), N().alias("windows"))
    return m.withColumn("gate", V.cba_gate(C("C"), C("B"), C("A")))


@query("v04_geometry_params", """WITH p AS (SELECT p_partkey, (p_size%50)/CAST(50 AS DOUBLE) AS d, (p_partkey%20)/CAST(10 AS DOUBLE) AS sl, (p_size%7)*CAST(1 AS DOUBLE) AS ms, p_retailprice/31 AS se FROM part)
 SELECT p_partkey, CAST(least(greatest(round_even(2+d*8,0),2),10) AS INTEGER) AS density_thr, round_even(least(greatest(12.0::DOUBLE+ms*2.0::DOUBLE,15),22),3) AS corridor_m, round_even(least(greatest(2.0::DOUBLE-sl*0.8::DOUBLE,0.3::DOUBLE),2),3) AS simplify_m, round_even(least(greatest(se/3.0::DOUBLE,6),20),3) AS centerline_offset_m,
 round_even(least(greatest(1.6::DOUBLE-d*0.3::DOUBLE,1.4::DOUBLE),1.7::DOUBLE),3) AS width_peak_ratio, round_even(least(greatest(0.8::DOUBLE+(ms-1.0::DOUBLE)*0.1::DOUBLE,0.6::DOUBLE),1),3) AS width_buffer_mult FROM p""")
def _(c):
    m = V.geometry_params(C("p_size") % 50 / F.lit(50.0), C("p_partkey") % 20 / F.lit(10.0), (C("p_size") % 7).cast("double"), C("p_retailprice") / 31)
    return c.part.select("p_partkey", *[v.alias(k) for k, v in m.items()])


def pu(x, t, h):
    return f"CASE WHEN {x}<={t} THEN 0 WHEN {x}>={h} THEN 100.0+({x}-{h})*10.0 ELSE ({x}-{t})/({h}-{t}) END"


def pl(x, t, h):
    return f"CASE WHEN {x}>={t} THEN 0 WHEN {x}<={h} THEN 100.0+({h}-{x})*10.0 ELSE ({t}-{x})/({t}-{h}) END"


def pr(x, t, h):
    return f"(CASE WHEN {x} BETWEEN {t[0]} AND {t[1]} THEN 0 WHEN {x}<{t[0]} THEN {pl(x, t[0], h[0])} ELSE {pu(x, t[1], h[1])} END)"


@query("v06_penalty_scores", f"""WITH s AS (SELECT drive_id, avg(c_ratio) AS cover, avg(b_rough)/10 AS mark, avg(conflict_rate) AS pts, max(n_intersections)*3.0::DOUBLE AS cw FROM runs GROUP BY 1)
 SELECT drive_id, round(3.0*{pr('cover', (0.55, 0.90), (0.35, 0.97))}+3.0*{pr('mark', (0.005, 0.06), (0.0, 0.12))}+2.0*{pr('pts', (0.002, 0.05), (0.0, 0.10))}+1.0*({pu('cw', 10.0, 25.0)}),6) AS road_penalty, round(4.0*({pl('cover', 0.70, 0.60)})+3.0*({pu('mark', 0.04, 0.18)}),6) AS aerial_penalty FROM s""")
def _(c):
    s = c.runs.groupBy("drive_id").agg(F.avg("c_ratio").alias("cover"), (F.avg("b_rough") / 10).alias("mark"), F.avg("conflict_rate").alias("pts"), (F.max("n_intersections") * 3.0).alias("cw"))
    road = (3.0 * V.band_penalty(C("cover"), (0.55, 0.35), (0.90, 0.97)) + 3.0 * V.band_penalty(C("mark"), (0.005, 0.0), (0.06, 0.12))
            + 2.0 * V.band_penalty(C("pts"), (0.002, 0.0), (0.05, 0.10)) + V.band_penalty(C("cw"), high=(10.0, 25.0)))
    return s.select("drive_id", road.alias("road_penalty"), (4.0 * V.band_penalty(C("cover"), (0.70, 0.60)) + 3.0 * V.band_penalty(C("mark"), high=(0.04, 0.18))).alias("aerial_penalty"))


@query("v08_regression_gate", """WITH cur AS (SELECT drive_id, CAST(max(n_intersections) AS DOUBLE) AS deg, CAST(count(*) AS DOUBLE) AS act FROM runs GROUP BY 1), b AS (SELECT c_custkey AS drive_id, CASE WHEN c_nationkey%5=0 THEN NULL ELSE c_nationkey%7 END AS bd, c_nationkey AS ba FROM customer)
 SELECT cur.drive_id, list_filter([CASE WHEN bd IS NULL THEN 'missing max_degree' END, CASE WHEN deg>bd+1 THEN 'max_degree over baseline' END, CASE WHEN ba IS NULL THEN 'missing actions' END, CASE WHEN act>ba THEN 'actions over baseline' END], lambda v: v IS NOT NULL) AS reasons, deg<=6 AND act<=20 AS absolute_ok FROM cur LEFT JOIN b USING (drive_id)""")
def _(c):
    cur = c.runs.groupBy("drive_id").agg(F.max("n_intersections").cast("double").alias("deg"), N().cast("double").alias("act"))
    b = c.customer.select(C("c_custkey").alias("drive_id"), F.when(C("c_nationkey") % 5 != 0, C("c_nationkey") % 7).alias("bd"), C("c_nationkey").alias("ba"))
    j = cur.join(b, "drive_id", "left")
    return j.select("drive_id", V.delta_reasons({"max_degree": (C("deg"), C("bd"), 1), "actions": (C("act"), C("ba"), 0)}).alias("reasons"), ((C("deg") <= 6) & (C("act") <= 20)).alias("absolute_ok"))


@query("v09_geometry_score", """WITH s AS (SELECT drive_id, avg(c_ratio) AS r, min(n_intersections) AS comp, avg(conflict_rate) AS m, max(dangling_per_km) AS p95 FROM runs GROUP BY 1), b AS (SELECT c_custkey AS drive_id, (c_nationkey%10)/CAST(20 AS DOUBLE) AS br FROM customer)
 SELECT s.drive_id, CASE WHEN r<br-0.02 THEN 'FAIL' WHEN comp<>0 THEN 'FAIL' WHEN p95>9 THEN 'SKIPPED' ELSE 'PASS' END AS status, CASE WHEN r<br-0.02 THEN 'centerlines_ratio_drop' WHEN comp<>0 THEN 'road_components' WHEN p95>9 THEN 'osm_metrics_invalid' ELSE '' END AS reason, round(CASE WHEN r<br-0.02 OR comp<>0 OR p95>9 THEN NULL ELSE m-0.05*p95 END,6) AS score FROM s LEFT JOIN b USING (drive_id)""")
def _(c):
    s = c.runs.groupBy("drive_id").agg(F.avg("c_ratio").alias("r"), F.min("n_intersections").alias("comp"), F.avg("conflict_rate").alias("m"), F.max("dangling_per_km").alias("p95"))
    b = c.customer.select(C("c_custkey").alias("drive_id"), (C("c_nationkey") % 10 / F.lit(20.0)).alias("br"))
    j = s.join(b, "drive_id", "left")
    drop, comp, inval = C("r") < C("br") - 0.02, C("comp") != 0, C("p95") > 9
    return j.select("drive_id", R.first_reason([("FAIL", drop | comp), ("SKIPPED", inval)], "PASS").alias("status"),
                    R.first_reason([("centerlines_ratio_drop", drop), ("road_components", comp), ("osm_metrics_invalid", inval)], "").alias("reason"),
                    F.when(F.coalesce(drop | comp | inval, F.lit(False)), None).otherwise(C("m") - 0.05 * C("p95")).alias("score"))


@query("v10_shape_gate", """WITH s AS (SELECT cand_id, rect_l*rect_w AS a, 4*pi()*rect_l*rect_w/pow(2*(rect_l+rect_w),2) AS ci, rectangularity AS ov, frame_id%5 AS arms FROM candidates) SELECT cand_id, NOT (a<6 OR a>35) AND arms<>0 AND ov>=0.3 AND ci<=0.7 AS ok, CASE WHEN ci>0.7 THEN 'circularity' WHEN ov<0.3 THEN 'overlap' END AS reason FROM s""")
def _(c):
    a = C("rect_l") * C("rect_w")
    ci, ov = E.circularity(a, 2 * (C("rect_l") + C("rect_w"))), C("rectangularity")
    ok = a.between(6, 35) & (C("frame_id") % 5 != 0) & (ov >= 0.3) & (ci <= 0.7)
    return c.candidates.select("cand_id", ok.alias("ok"), R.first_reason([("circularity", ci > 0.7), ("overlap", ov < 0.3)], None).alias("reason"))


@query("v11_final_fail_reason", """WITH g AS (SELECT frame_id, count(*) AS h, bool_or(conf>0.995) AS bad, median(rect_w) w, median(rect_l) l, avg(rectangularity) r, min(angle) hd, stddev_pop(y)/8 j, CASE WHEN frame_id%3=0 THEN NULL ELSE max(rectangularity) END i FROM candidates GROUP BY 1)
 SELECT frame_id, CASE WHEN h<3 THEN 'frames_hit_support' WHEN bad THEN 'metric_bad' WHEN NOT (w BETWEEN 1.5 AND 8 AND l BETWEEN 3 AND 25) THEN 'size' WHEN r<0.45 THEN 'rectangularity' WHEN hd>25 THEN 'heading_diff' WHEN j>8 THEN 'jitter' WHEN coalesce(i,1)<0.5 THEN 'inside_ratio' ELSE 'pass' END AS reason FROM g""")
def _(c):
    med = lambda k: F.percentile(k, F.lit(.5))
    g = c.candidates.groupBy("frame_id").agg(N().alias("h"), F.bool_or(C("conf") > 0.995).alias("bad"), med("rect_w").alias("w"), med("rect_l").alias("l"), F.avg("rectangularity").alias("r"), F.min("angle").alias("hd"),
                                           (F.stddev_pop("y") / 8).alias("j"), F.max("rectangularity").alias("mx"))
    i = F.when(C("frame_id") % 3 != 0, C("mx"))
    return g.select("frame_id", V.final_fail_reason(C("h"), C("bad"), C("w"), C("l"), C("r"), C("hd"), C("j"), i).alias("reason"))


@query("v12_lidar_drop_reason", """SELECT frame_id, CASE WHEN x0<5 OR x1>430 THEN 'CALIB_IMAGE_SIZE_MISMATCH' WHEN k<10 AND v<0.2 THEN 'CALIB_POINTS_BEHIND_CAMERA' WHEN k<10 AND v<0.5 THEN 'CALIB_PROJ_OUTSIDE' WHEN k<10 THEN 'LIDAR_CALIB_MISMATCH' WHEN k<25 THEN 'LIDAR_NO_POINTS_BBOX' ELSE 'ok' END AS reason, count(*) AS n
 FROM (SELECT d.frame_id, x0, x1, t.points_support AS k, t.iou_dilated AS v FROM detections d JOIN trace t ON t.frame_id=d.det_id) GROUP BY 1,2""")
def _(c):
    t = c.trace.select(C("frame_id").alias("det_id"), C("points_support").alias("k"), C("iou_dilated").alias("v"))
    few = C("k") < 10
    r = R.first_reason([("CALIB_IMAGE_SIZE_MISMATCH", (C("x0") < 5) | (C("x1") > 430)), ("CALIB_POINTS_BEHIND_CAMERA", few & (C("v") < 0.2)), ("CALIB_PROJ_OUTSIDE", few & (C("v") < 0.5)),
                        ("LIDAR_CALIB_MISMATCH", few), ("LIDAR_NO_POINTS_BBOX", C("k") < 25)], "ok")
    return c.detections.join(t, "det_id").groupBy("frame_id", r.alias("reason")).agg(N().alias("n"))


@query("v13_candidate_score", "SELECT cand_id, round(0.6*rectangularity+0.25*conf+0.15*CASE WHEN frame_id%4=0 THEN 0.5 ELSE greatest(0,1-least(angle/45.0::DOUBLE,1)) END,6) AS score FROM candidates")
def _(c):
    return c.candidates.select("cand_id", V.candidate_score(C("rectangularity"), C("conf"), F.when(C("frame_id") % 4 != 0, C("angle"))).alias("score"))


@query("v14_heuristic_reasons", """WITH t AS (SELECT frame_id, CASE WHEN k%9=0 THEN 0 ELSE points_support END AS p, proj_method AS m, CASE WHEN k%4=0 THEN 0 ELSE iou_bbox END AS b, CASE WHEN k%8=0 THEN 0 ELSE iou_dilated END AS d FROM trace), r AS (SELECT *, list_filter([CASE WHEN p=0 THEN 'SUPPORT_EMPTY' END, CASE WHEN m<>'lidar' THEN 'NON_LIDAR' END, CASE WHEN b=0 AND d>0 THEN 'THIN_MASK_EFFECT' END, CASE WHEN b=0 AND d=0 THEN 'PROJ_OR_ROI_MISMATCH' END], lambda v: v IS NOT NULL) AS l FROM t)
 SELECT frame_id, CASE WHEN len(l)=0 AND b<0.2 THEN 'LOW_IOU' ELSE array_to_string(l,'|') END AS reason FROM r""")
def _(c):
    k = C("k")
    t = c.trace.select("frame_id", F.when(k % 9 == 0, 0).otherwise(C("points_support")).alias("p"), C("proj_method").alias("m"), F.when(k % 4 == 0, 0.0).otherwise(C("iou_bbox")).alias("b"), F.when(k % 8 == 0, 0.0).otherwise(C("iou_dilated")).alias("d"))
    l = R.reasons({"SUPPORT_EMPTY": C("p") == 0, "NON_LIDAR": C("m") != "lidar", "THIN_MASK_EFFECT": (C("b") == 0) & (C("d") > 0), "PROJ_OR_ROI_MISMATCH": (C("b") == 0) & (C("d") == 0)})
    return t.withColumn("l", l).select("frame_id", F.when((F.size("l") == 0) & (C("b") < 0.2), "LOW_IOU").otherwise(F.array_join("l", "|")).alias("reason"))


@query("v15_stage2_trial", """WITH e AS (SELECT drive_id, count(*) FILTER (class='1-URGENT') AS ex, count(*) FILTER (class='2-HIGH') AS fin, count(*) FILTER (class='2-HIGH' AND rectangularity>0.5) AS hit, count(*) FILTER (class='2-HIGH' AND conf<0.002) AS fp, avg(conf) AS st FROM candidates GROUP BY 1), s AS (SELECT *, hit/CAST(greatest(ex,1) AS DOUBLE) AS rec FROM e)
 SELECT drive_id, round(rec,6) AS recall, round(rec-0.2*fp+0.3*st,6) AS score, (ex>0 AND fin>=1 AND rec>=0.8 AND fp<=1) OR (rec-0.2*fp+0.3*st>=0.55 AND fp<=1 AND abs(fin-ex)<=40) AS stop FROM s""")
def _(c):
    n = lambda cond: F.count_if(cond)
    ex, fin = C("class") == "1-URGENT", C("class") == "2-HIGH"
    e = c.candidates.groupBy("drive_id").agg(n(ex).alias("ex"), n(fin).alias("fin"), n(fin & (C("rectangularity") > 0.5)).alias("hit"), n(fin & (C("conf") < 0.002)).alias("fp"), F.avg("conf").alias("st"))
    rec = C("hit") / F.greatest(C("ex"), F.lit(1))
    s = e.withColumn("recall", rec).withColumn("score", C("recall") - 0.2 * C("fp") + 0.3 * C("st"))
    done = (C("ex") > 0) & (C("fin") >= 1) & (C("recall") >= 0.8) & (C("fp") <= 1)
    return s.select("drive_id", "recall", "score", (done | ((C("score") >= 0.55) & (C("fp") <= 1) & (F.abs(C("fin") - C("ex")) <= 40))).alias("stop"))


@query("v16_surface_gates", f"""WITH {BASE}, s AS (SELECT c.drive_id, min(x)<max(x) AS b, avg(CASE WHEN z-z_base<=0.5 THEN 1.0::DOUBLE ELSE 0 END) AS g, count(DISTINCT (c.ix,c.iy))/1250.0::DOUBLE AS dem FROM cells c JOIN base ON base.drive_id=c.drive_id AND base.ix=c.ix AND base.iy=c.iy GROUP BY 1)
 SELECT drive_id, b AS bbox_ok, g>=0.02 AS points_ok, dem>=0.3 AS dem_ok, CASE WHEN NOT (b AND g>=0.02 AND dem>=0.3) THEN 'FAIL' WHEN g<0.26 THEN 'WARN' ELSE 'PASS' END AS status FROM s""")
def _(c):
    p = G.with_cell(c.points, RES).join(G.min_height(c.points, RES, BY), [*BY, "ix", "iy"])
    a = p.groupBy(*BY).agg((F.min("x") < F.max("x")).alias("bbox_ok"), F.avg((C("z") - C("z_base") <= 0.5).cast("double")).alias("g"))
    dem = G.cell_density(c.points, RES, BY).groupBy(*BY).agg((N() / 1250.0).alias("dem"))
    j = a.join(dem, BY).select(*BY, "bbox_ok", (C("g") >= 0.02).alias("points_ok"), (C("dem") >= 0.3).alias("dem_ok"), "g")
    return j.withColumn("status", V.status([C("bbox_ok"), C("points_ok"), C("dem_ok")], C("g") < 0.26)).drop("g")


@query("v18_frame_evidence", """WITH e AS (SELECT frame_id, drive_id FROM trace WHERE raw_has_crosswalk=1), ok AS (SELECT drive_id, count(*) n, count(*) FILTER (frame_id BETWEEN 250 AND 50000) i FROM e GROUP BY 1)
 SELECT drive_id, n, n-i AS outside, round(i/CAST(n AS DOUBLE),6) AS ratio, n>=5 AND i/CAST(n AS DOUBLE)>=0.7 AS ok FROM ok""")
def _(c):
    e = c.trace.filter("raw_has_crosswalk = 1").select("drive_id", "frame_id")
    rng = c.trace.filter(C("frame_id").between(250, 50000)).select("frame_id")
    out = e.join(rng, "frame_id", "left_anti").groupBy("drive_id").agg(N().alias("outside"))
    a = e.groupBy("drive_id").agg(N().alias("n")).join(out, "drive_id", "left").select("drive_id", "n", F.coalesce("outside", F.lit(0)).alias("outside"))
    r = (C("n") - C("outside")) / C("n")
    return a.select("drive_id", "n", "outside", r.alias("ratio"), ((C("n") >= 5) & (r >= 0.7)).alias("ok"))


@query("v20_baseline_refresh", """SELECT drive_id AS drive, round_even(sum(line_len),3) AS centerline_total_len_m, CAST(sum(n_intersections) AS BIGINT) AS intersections_count, round_even(avg(c_ratio),4) AS centerlines_in_polygon_ratio, count(*) AS windows FROM runs GROUP BY 1""")
def _(c):
    return c.runs.groupBy(C("drive_id").alias("drive")).agg(F.bround(F.sum("line_len"), 3).alias("centerline_total_len_m"), F.sum("n_intersections").alias("intersections_count"),
                                                            F.bround(F.avg("c_ratio"), 4).alias("centerlines_in_polygon_ratio"), N().alias("windows"))


@query("v21_ablation_table", """SELECT drive_id, round(avg(c_ratio) FILTER (arm='1-URGENT'),6) AS arm1, round(avg(c_ratio) FILTER (arm='2-HIGH'),6) AS arm2, round(avg(c_ratio) FILTER (arm='3-MEDIUM'),6) AS arm3, round(avg(c_ratio) FILTER (arm='4-NOT SPECIFIED'),6) AS arm4, round(avg(c_ratio) FILTER (arm='5-LOW'),6) AS arm5 FROM runs GROUP BY 1""")
def _(c):
    p = c.runs.groupBy("drive_id").pivot("arm", ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]).agg(F.avg("c_ratio"))
    return p.select("drive_id", C("1-URGENT").alias("arm1"), C("2-HIGH").alias("arm2"), C("3-MEDIUM").alias("arm3"), C("4-NOT SPECIFIED").alias("arm4"), C("5-LOW").alias("arm5"))


@query("u01_union_layers", "SELECT source, count(*) AS n, count(conf) AS with_conf, round(avg(score),6) AS score FROM (SELECT 'map' AS source, conf, NULL AS score FROM candidates UNION ALL SELECT 'image', NULL, score FROM detections) GROUP BY 1")
def _(c):
    a = c.candidates.select(F.lit("map").alias("source"), "conf")
    b = c.detections.select(F.lit("image").alias("source"), "score")
    u = a.unionByName(b, allowMissingColumns=True)
    return u.groupBy("source").agg(N().alias("n"), F.count("conf").alias("with_conf"), F.avg("score").alias("score"))


SETS = "a AS (SELECT DISTINCT user_id, event_id//4 AS f FROM events WHERE event_type='click'), b AS (SELECT DISTINCT user_id, event_id//4 AS f FROM events WHERE event_type='view')"


def sets(c):
    s = lambda t: c.events.filter(C("event_type") == t).select("user_id", F.expr("event_id div 4").alias("f")).distinct()
    return s("click"), s("view")


@query("u02_frame_set_intersect_union", f"WITH {SETS} SELECT 'intersect' AS op, count(*) AS n FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT 'union', count(*) FROM (SELECT * FROM a UNION SELECT * FROM b)")
def _(c):
    a, b = sets(c)
    cnt = lambda d, n: d.agg(N().alias("n")).withColumn("op", F.lit(n))
    return cnt(a.intersect(b), "intersect").unionByName(cnt(a.union(b).distinct(), "union"))


@query("u03_frame_set_difference", f"WITH {SETS} SELECT user_id, f FROM a EXCEPT SELECT user_id, f FROM b")
def _(c):
    a, b = sets(c)
    return a.join(b, ["user_id", "f"], "left_anti")


@query("u04_dedup_by_signature", "SELECT rect_l, rect_w, angle, min(cand_id) AS cand_id, count(*) AS copies FROM candidates GROUP BY 1,2,3")
def _(c):
    return c.candidates.groupBy("rect_l", "rect_w", "angle").agg(F.min("cand_id").alias("cand_id"), N().alias("copies"))


@query("u05_grouping_sets", "SELECT drive_id, class, grouping_id(drive_id, class) AS gid, count(*) AS n, round(avg(conf),6) AS conf FROM candidates GROUP BY CUBE (drive_id, class)")
def _(c):
    return c.candidates.cube("drive_id", "class").agg(F.grouping_id().cast("long").alias("gid"), N().alias("n"), F.avg("conf").alias("conf"))


@query("f01_f03_f04_text_array_json", """SELECT drive_id, count(*) AS n, count(DISTINCT reject_reasons) AS variants, max(lpad(CAST(frame_id AS VARCHAR),10,'0')) AS last_frame, list_sort(list(DISTINCT kind)) AS kinds, CAST(sum(k) AS BIGINT) AS k_sum FROM trace GROUP BY 1""")
def _(c):
    e = c.events.withColumn("p", F.from_json("props", "k long"))
    t = c.trace.select(C("frame_id").alias("event_id"), "drive_id", "reject_reasons", "kind").join(e.select("event_id", "p.k"), "event_id")
    return t.groupBy("drive_id").agg(N().alias("n"), F.countDistinct("reject_reasons").alias("variants"), F.max(F.lpad(C("event_id").cast("string"), 10, "0")).alias("last_frame"),
                                     F.array_sort(F.collect_set("kind")).alias("kinds"), F.sum("k").alias("k_sum"))


@query("f02_math_functions", "SELECT drive_id, frame_id, round(sqrt(x*x+y*y),6) AS h, round(atan2(y,x),6) AS a, round(acos(least(greatest(z/2,-1),1)),6) AS ac, CAST(floor(x) AS BIGINT) AS fl, CAST(ceil(y) AS BIGINT) AS ce FROM poses")
def _(c):
    return c.poses.select("drive_id", "frame_id", F.hypot("x", "y").alias("h"), F.atan2("y", "x").alias("a"), F.acos(F.least(F.greatest(C("z") / 2, F.lit(-1.0)), F.lit(1.0))).alias("ac"), F.floor("x").alias("fl"), F.ceil("y").alias("ce"))


@query("f05_timestamps", "SELECT user_id AS drive_id, strftime(min(ts), '%Y-%m-%dT%H:%M:%S') AS first_seen, strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS last_seen FROM events GROUP BY 1")
def _(c):
    f = lambda v: F.date_format(v, "yyyy-MM-dd'T'HH:mm:ss")
    return c.events.groupBy(C("user_id").alias("drive_id")).agg(f(F.min("ts")).alias("first_seen"), f(F.max("ts")).alias("last_seen"))
