"""Quality aggregates, fits, rank statistics and roll-ups."""

from pyspark.sql import functions as F

from wayfold.functions import geometry as E, records as R
from wayfold.functions.stats import cohen_d, discrete_percentile, exact_percentiles, ordinal_auc, rank_auc, rank_labellings, rank_value, top_per_group
from wayfold.operators import audits as A, grid as G, joins as J, lines as L, ordered as O
from wayfold.queries.catalog import C, query
from wayfold.queries.q_e_geometry import LINE, model_pairs
from wayfold.queries.q_p_scalars import CX, CY, FX, HEIGHT, P_RECT, PIX, WIDTH, posed, rectified
from wayfold.functions import transforms as T
from wayfold.session import shuffled

def N():
    return F.count(F.lit(1))


@query("a01_extent_and_intensity", """SELECT drive_id, round(min(x),6) minx, round(max(x),6) maxx, round(min(y),6) miny, round(max(y),6) maxy, round(min(z),6) minz, round(max(z),6) maxz, round(min(intensity),6) i_min, round(avg(intensity),6) i_mean, round(max(intensity),6) i_max,
 round(count(*) FILTER (intensity>0)/CAST(count(*) AS DOUBLE),6) nonzero_ratio, count(*) n FROM points GROUP BY 1""")
def _(c):
    return A.extent_and_intensity(c.points, ["drive_id"])


@query("a02_intensity_percentiles", """SELECT drive_id, count(*) n, round(quantile_cont(intensity,0.5),6) p50, round(quantile_cont(intensity,0.9),6) p90, round(quantile_cont(intensity,0.95),6) p95, round(quantile_cont(intensity,0.99),6) p99,
 round(quantile_cont(intensity,0.99)-quantile_cont(intensity,0.5),6) dynamic_range FROM points GROUP BY 1""")
def _(c):
    q = exact_percentiles(c.points, ["drive_id"], "intensity", {"p50": .5, "p90": .9, "p95": .95, "p99": .99}, 0.0005)
    return q.withColumn("dynamic_range", C("p99") - C("p50"))


@query("a03_banding", """WITH u AS (SELECT DISTINCT drive_id, round_even(y,3) AS v FROM points), d AS (SELECT drive_id, v-lag(v) OVER (PARTITION BY drive_id ORDER BY v) AS s FROM u)
 SELECT drive_id, min(round_even(s,6)) FILTER (s>0) AS min_step, count(*) AS unique_values, coalesce(min(round_even(s,6)) FILTER (s>0)<=0.01,false) AS ok FROM d GROUP BY 1""")
def _(c):
    return A.banding(c.points, ["drive_id"])


@query("x30_banding_parts", """WITH s AS (SELECT l_suppkey%8 AS part, l_extendedprice AS y FROM lineitem), u AS (SELECT DISTINCT part, round_even(y,3) v FROM s), d AS (SELECT part, v-lag(v) OVER (PARTITION BY part ORDER BY v) AS s FROM u), p AS (SELECT part, count(*)+1 AS n, min(s) mn, quantile_cont(s,0.5) p50, quantile_cont(s,0.9) p90 FROM d WHERE s>0 GROUP BY 1)
 SELECT part, n AS distinct_y, round(mn,4) AS min_step, round(p50,4) AS p50, round(p90,4) AS p90, mn>0.05 AS coarse FROM p""")
def _(c):
    s = c.lineitem.select((C("l_suppkey") % 8).alias("part"), C("l_extendedprice").alias("y"))
    d = A.distinct_steps(s, ["part"], "y", 3, 64.0).filter("step > 0")
    q = exact_percentiles(d, ["part"], "step", {"min_step": 0.0, "p50": .5, "p90": .9}, 1.0)
    return q.select("part", (C("n") + 1).alias("distinct_y"), *[F.round(k, 4).alias(k) for k in ("min_step", "p50", "p90")], (C("min_step") > 0.05).alias("coarse"))


@query("a05_class_stats", """SELECT class, count(*) n, round(quantile_cont(rect_l,0.1),6) length_p10, round(quantile_cont(rect_l,0.5),6) length_p50, round(quantile_cont(rect_l,0.9),6) length_p90, round(quantile_cont(rect_l*rect_w,0.5),6) area_p50, round(quantile_cont(rectangularity,0.5),6) in_road_p50 FROM candidates GROUP BY 1""")
def _(c):
    d = c.candidates.withColumn("area", C("rect_l") * C("rect_w"))
    q = lambda v, ps, w: exact_percentiles(d, ["class"], v, ps, w)
    a = q("rect_l", {"length_p10": .1, "length_p50": .5, "length_p90": .9}, 1.0)
    return a.join(q("area", {"area_p50": .5}, 1.0).drop("n"), "class").join(q("rectangularity", {"in_road_p50": .5}, 0.1).drop("n"), "class")


@query("a06_instances_per_frame", """WITH f AS (SELECT class, frame_id, count(*) AS k FROM detections GROUP BY ALL) SELECT class, count(*) n, round(quantile_cont(k,0.5),6) p50, round(quantile_cont(k,0.9),6) p90, max(k) AS top FROM f GROUP BY 1""")
def _(c):
    f = c.detections.groupBy("class", "frame_id").agg(N().alias("k"))
    return exact_percentiles(f, ["class"], "k", {"p50": .5, "p90": .9}, 64.0).join(f.groupBy("class").agg(F.max("k").alias("top")), "class")


@query("a07_weak_ratio_rollup", """SELECT drive_id, kind, count(*) n, count(*) FILTER (geom_ok=0) AS weak, round(count(*) FILTER (geom_ok=0)/CAST(count(*) AS DOUBLE),6) AS weak_ratio, count(*) FILTER (geom_ok=0 AND proj_method='plane') AS weak_plane FROM trace GROUP BY ROLLUP (drive_id, kind)""")
def _(c):
    weak = C("geom_ok") == 0
    return c.trace.rollup("drive_id", "kind").agg(N().alias("n"), F.count_if(weak).alias("weak"), (F.count_if(weak) / N()).alias("weak_ratio"), F.count_if(weak & (C("proj_method") == "plane")).alias("weak_plane"))


@query("a08_frames_hit_histogram", """WITH t AS (SELECT drive_id, kind, count(DISTINCT frame_id//50) AS h FROM trace GROUP BY ALL) SELECT kind, CASE WHEN h<=1 THEN '1' WHEN h<=3 THEN '2-3' WHEN h<=7 THEN '4-7' WHEN h<=15 THEN '8-15' ELSE '16+' END AS bucket, count(*) n FROM t GROUP BY ALL""")
def _(c):
    t = c.trace.select("drive_id", "kind", F.expr("frame_id div 50").alias("f")).distinct().groupBy("drive_id", "kind").agg(N().alias("h"))
    return t.groupBy("kind", A.frames_hit_bucket(C("h")).alias("bucket")).agg(N().alias("n"))


@query("a09_track_stability", """WITH o AS (SELECT drive_id AS track, event_id//7 AS f, min({'x': x, 'y': y}) AS p FROM poses GROUP BY ALL), g AS (SELECT track, f, p.x AS x, p.y AS y, f-lag(f) OVER w AS gap, sqrt(pow(p.x-lag(p.x) OVER w,2)+pow(p.y-lag(p.y) OVER w,2)) AS mv FROM o WINDOW w AS (PARTITION BY track ORDER BY f))
 SELECT track, count(*) AS frames_hit, max(gap) AS gap_max, count(*) FILTER (gap>20) AS long_gaps, round(avg(mv),5) AS jitter_mean, round(max(mv),5) AS jitter_max, round(sqrt(pow(max(x)-min(x),2)+pow(max(y)-min(y),2)),5) AS extent, sqrt(pow(max(x)-min(x),2)+pow(max(y)-min(y),2))>400.0 AS collision FROM g GROUP BY 1""")
def _(c):
    o = c.poses.select(C("drive_id").alias("track"), F.expr("event_id div 7").alias("frame_id"), "x", "y")
    s = A.track_stability(o, "track", 10, 400.0)
    return s.select("track", "frames_hit", "gap_max", "long_gaps", *[F.round(k, 5).alias(k) for k in ("jitter_mean", "jitter_max", "extent")], "collision")




@query("a10_trace_subsets", """WITH s AS (SELECT UNNEST(list_filter(['S0_ALL_FRAMES', CASE WHEN raw_has_crosswalk=1 AND geom_ok=1 THEN 'S1_VALID_ANY_GEOM' END, CASE WHEN raw_has_crosswalk=1 AND geom_ok=1 AND proj_method='lidar' THEN 'S2_VALID_LIDAR' END, CASE WHEN stage2_added=1 AND geom_ok=1 THEN 'S3_VALID_STAGE2_ADDED' END], lambda v: v IS NOT NULL)) AS subset, * FROM trace)
 SELECT subset, count(*) n, (SELECT count(*) FROM trace) AS total, round(count(*)/CAST((SELECT count(*) FROM trace) AS DOUBLE),6) AS ratio, round(quantile_cont(iou_bbox,0.1),6) iou_bbox_p10, round(quantile_cont(iou_bbox,0.5),6) iou_bbox_p50, round(quantile_cont(iou_bbox,0.9),6) iou_bbox_p90, round(avg(iou_bbox),6) iou_bbox_mean,
 round(quantile_cont(center_err,0.5),6) center_err_p50, round(quantile_cont(center_err,0.9),6) center_err_p90, round(avg(center_err),6) center_err_mean FROM s GROUP BY 1""")
def _(c):
    ok, raw = C("geom_ok") == 1, C("raw_has_crosswalk") == 1
    return A.subset_stats(c.trace, {"S0_ALL_FRAMES": F.lit(True), "S1_VALID_ANY_GEOM": raw & ok, "S2_VALID_LIDAR": raw & ok & (C("proj_method") == "lidar"), "S3_VALID_STAGE2_ADDED": (C("stage2_added") == 1) & ok},
                          {"iou_bbox": ((.1, .5, .9), 0.01), "center_err": ((.5, .9), 1.0)})


FAILT = "ft AS (SELECT *, CASE WHEN geom_ok=0 THEN 'GEOM' WHEN iou_bbox<0.0517 THEN 'LOW_IOU' WHEN points_support<20 THEN 'FEW_POINTS' ELSE 'OTHER' END AS fail_type FROM trace)"


def fail_types(c):
    rules = [("GEOM", C("geom_ok") == 0), ("LOW_IOU", C("iou_bbox") < 0.0517), ("FEW_POINTS", C("points_support") < 20)]
    return c.trace.withColumn("fail_type", R.first_reason(rules, "OTHER"))


@query("a11_fail_types", f"""WITH {FAILT}, r AS (SELECT *, row_number() OVER (PARTITION BY fail_type ORDER BY iou_bbox, points_support DESC, frame_id) AS r FROM ft)
 SELECT fail_type, count(*) n, round(count(*)/CAST((SELECT count(*) FROM ft) AS DOUBLE),6) ratio, round(quantile_cont(iou_bbox,0.5),6) iou_p50, string_agg(CAST(frame_id AS VARCHAR), ';' ORDER BY r) FILTER (r<=5) AS rep_frames FROM r GROUP BY 1""")
def _(c):
    f = fail_types(c)
    tot = f.agg(N().alias("t"))  # one row
    rep = top_per_group(f, ["fail_type"], [C("iou_bbox"), F.desc("points_support"), C("frame_id")], 5)
    rep = rep.groupBy("fail_type").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "frame_id"))), lambda s: s["frame_id"].cast("string")), ";").alias("rep_frames"))
    q = exact_percentiles(f, ["fail_type"], "iou_bbox", {"iou_p50": .5}, 0.01)
    return O.with_one_row(q, tot).join(rep, "fail_type").select("fail_type", "n", (C("n") / C("t")).alias("ratio"), "iou_p50", "rep_frames")


@query("a12_intersection_rollup", """WITH i AS (SELECT drive_id, CASE WHEN n_intersections>=3 THEN '3+' ELSE CAST(n_intersections AS VARCHAR) END AS arms, dangling_per_km FROM runs)
 SELECT drive_id, count(*) n, count(*) FILTER (arms='0') arms_0, count(*) FILTER (arms='1') arms_1, count(*) FILTER (arms='2') arms_2, count(*) FILTER (arms='3+') arms_3p, round(count(*) FILTER (arms='3+')/CAST(count(*) AS DOUBLE),6) ge3_ratio, count(*) FILTER (dangling_per_km>7) AS weak FROM i GROUP BY ROLLUP (drive_id)""")
def _(c):
    a = C("n_intersections")
    cnt = lambda cond, n: F.count_if(cond).alias(n)
    return c.runs.rollup("drive_id").agg(N().alias("n"), cnt(a == 0, "arms_0"), cnt(a == 1, "arms_1"), cnt(a == 2, "arms_2"), cnt(a >= 3, "arms_3p"), (F.count_if(a >= 3) / N()).alias("ge3_ratio"), cnt(C("dangling_per_km") > 7, "weak"))


@query("a13_discrete_percentiles", """WITH s AS (SELECT drive_id, c_ratio, row_number() OVER (PARTITION BY drive_id ORDER BY c_ratio)-1 AS r, count(*) OVER (PARTITION BY drive_id) AS n FROM runs)
 SELECT drive_id, max(n) AS n, round(max(c_ratio) FILTER (r=CAST(round_even((n-1)*0.25::DOUBLE,0) AS BIGINT)),6) AS q25, round(max(c_ratio) FILTER (r=n//2),6) AS upper_mid, round(max(c_ratio) FILTER (r=CAST(floor(n*0.75) AS BIGINT)),6) AS q75 FROM s GROUP BY 1""")
def _(c):
    k, n = ["drive_id"], C("_n")
    q = lambda pos, name: rank_value(c.runs, k, "c_ratio", pos, 0.05, name)
    a = q(F.bround((n - 1) * F.lit(0.25), 0).cast("long"), "q25")
    return a.join(q(F.floor(n / 2), "upper_mid").drop("n"), k).join(q(F.floor(n * F.lit(0.75)), "q75").drop("n"), k)


@query("a14_qc_windows", """SELECT drive_id, arm, round_even(avg(coalesce(CASE WHEN window_id%4=0 THEN NULL ELSE line_len END,0)),3) AS line_len_avg, max(n_intersections) AS components_max, round_even(min(c_ratio),4) AS ratio_min, CAST(round_even(avg(n_intersections),0) AS BIGINT) AS intersections FROM runs GROUP BY ALL""")
def _(c):
    ln = F.when(C("window_id") % 4 != 0, C("line_len"))
    return c.runs.groupBy("drive_id", "arm").agg(F.bround(F.avg(F.coalesce(ln, F.lit(0.0))), 3).alias("line_len_avg"), F.max("n_intersections").alias("components_max"),
        F.bround(F.min("c_ratio"), 4).alias("ratio_min"), F.bround(F.avg("n_intersections"), 0).cast("long").alias("intersections"))


@query("a15_dataset_coverage", """WITH t AS (SELECT user_id d, count(*) l, count(*) FILTER (event_type IN ('click','view')) i, count(*) FILTER (value>30) p FROM events GROUP BY 1)
 SELECT count(*) drive_count, CAST(sum(l) AS BIGINT) total_lidar, CAST(sum(i) AS BIGINT) total_img_any, CAST(sum(p) AS BIGINT) total_pose, round_even(sum(i)/CAST(sum(l) AS DOUBLE),4) image_coverage, round_even(sum(p)/CAST(sum(l) AS DOUBLE),4) pose_coverage, count(*) FILTER (p<28) AS low_pose_drives FROM t""")
def _(c):
    t = c.events.groupBy("user_id").agg(N().alias("l"), F.count_if(C("event_type").isin("click", "view")).alias("i"), F.count_if(C("value") > 30).alias("p"))
    s = lambda k: F.sum(k)
    return t.agg(N().alias("drive_count"), s("l").alias("total_lidar"), s("i").alias("total_img_any"), s("p").alias("total_pose"),
                 F.bround(s("i") / s("l"), 4).alias("image_coverage"), F.bround(s("p") / s("l"), 4).alias("pose_coverage"), F.count_if(C("p") < 28).alias("low_pose_drives"))


@query("a16_line_stats", """SELECT drive_id, count(*) segments, round(quantile_cont(length_m,0.5),6) length_p50, round(quantile_cont(length_m,0.9),6) length_p90 FROM edges GROUP BY 1""")
def _(c):
    return exact_percentiles(c.edges, ["drive_id"], "length_m", {"length_p50": .5, "length_p90": .9}, 0.05).withColumnRenamed("n", "segments")


@query("a16_counts_per_drive", """WITH n AS (SELECT drive_id, count(*) k FROM poses GROUP BY 1) SELECT min(k) AS lo, median(k) AS median, max(k) AS hi FROM n""")
def _(c):
    n = c.poses.groupBy("drive_id").agg(N().alias("k"))
    q = exact_percentiles(n, [], "k", {"median": .5}, 64.0)
    return O.with_one_row(n.agg(F.min("k").alias("lo"), F.max("k").alias("hi")), q.select("median"))


@query("a17_angle_stats", """WITH h AS (SELECT c.drive_id, abs(angle-degrees(yaw))%180 AS d FROM candidates c JOIN poses p ON p.drive_id=c.drive_id AND p.frame_id=c.frame_id), m AS (SELECT drive_id, abs(least(d,180-d)-90) AS a FROM h) SELECT drive_id, count(*) n, round(quantile_cont(a,0.5),6) p50, round(quantile_cont(a,0.9),6) p90 FROM m GROUP BY 1""")
def _(c):
    p = c.poses.select("drive_id", "frame_id", "yaw")
    d = c.candidates.join(p, ["drive_id", "frame_id"]).select("drive_id", F.abs(E.angle_diff_180(C("angle"), F.degrees("yaw")) - 90).alias("a"))
    return exact_percentiles(d, ["drive_id"], "a", {"p50": .5, "p90": .9}, 1.0)


@query("a18_highway_counts", "SELECT h AS highway, count(*) n FROM (SELECT UNNEST(CASE WHEN edge_id%3=0 THEN [lower(highway),'service'] ELSE [lower(highway)] END) AS h FROM edges) GROUP BY 1")
def _(c):
    h = F.when(C("edge_id") % 3 == 0, F.array(F.lower("highway"), F.lit("service"))).otherwise(F.array(F.lower("highway")))
    return c.edges.select(F.explode(h).alias("highway")).groupBy("highway").agg(N().alias("n"))


@query("a19_top_reject_reasons", "WITH t AS (SELECT UNNEST(string_split(reject_reasons,',')) AS r FROM trace WHERE reject_reasons<>'') SELECT r AS reason, count(*) n FROM t GROUP BY 1 ORDER BY n DESC, r LIMIT 2")
def _(c):
    t = c.trace.select(F.explode(R.tokens(C("reject_reasons"))).alias("reason"))
    return t.groupBy("reason").agg(N().alias("n")).orderBy(F.desc("n"), "reason").limit(2)


@query("a20_drift_and_accumulation", """SELECT drive_id, round_even(count(*) FILTER (drift_flag=1)/CAST(count(*) AS DOUBLE),3) AS drift_ratio, round_even(count(*) FILTER (raw_has_crosswalk=1 AND proj_method='lidar' AND fit_source='accum')/CAST(greatest(count(*) FILTER (raw_has_crosswalk=1 AND proj_method='lidar'),1) AS DOUBLE),3) AS accum_ratio FROM trace GROUP BY 1""")
def _(c):
    base = (C("raw_has_crosswalk") == 1) & (C("proj_method") == "lidar")
    return c.trace.groupBy("drive_id").agg(F.bround(F.count_if(C("drift_flag") == 1) / N(), 3).alias("drift_ratio"),
        F.bround(F.count_if(base & (C("fit_source") == "accum")) / F.greatest(F.count_if(base), F.lit(1)), 3).alias("accum_ratio"))


SCORED = "sc AS (SELECT d.doc_id, d.n_chars AS s, l.quality AS y FROM documents d JOIN labels l ON l.doc_id=d.doc_id)"


def scored(c):
    return c.documents.select("doc_id", C("n_chars").alias("s")).join(c.labels.select("doc_id", C("quality").alias("y")), "doc_id")


@query("a21_rank_auc", f"""WITH {SCORED}, r AS (SELECT y, (rank() OVER (ORDER BY s) + rank() OVER (ORDER BY s) + count(*) OVER (PARTITION BY s) - 1)/2.0 AS k FROM sc)
 SELECT count(*) FILTER (y=1) n_pos, count(*) FILTER (y=0) n_neg, round((CAST(sum(k) FILTER (y=1) AS DOUBLE)-count(*) FILTER (y=1)*(count(*) FILTER (y=1)+1)*0.5)/(count(*) FILTER (y=1)*count(*) FILTER (y=0)),6) AS auc FROM r""")
def _(c):
    return rank_auc(scored(c), [], "s", "y", 64.0)


@query("a21_ordinal_auc", f"""WITH {SCORED}, r AS (SELECT y, row_number() OVER (ORDER BY s, doc_id) AS k FROM sc)
 SELECT count(*) FILTER (y=1) n_pos, count(*) FILTER (y=0) n_neg, round((CAST(sum(k) FILTER (y=1) AS DOUBLE)-count(*) FILTER (y=1)*(count(*) FILTER (y=1)+1)*0.5)/(count(*) FILTER (y=1)*count(*) FILTER (y=0)),6) AS auc FROM r""")
def _(c):
    return ordinal_auc(scored(c), "s", "doc_id", "y", 64.0)


@query("a22_effect_size", f"""WITH {SCORED}, a AS (SELECT avg(s) FILTER (y=1) ma, avg(s) FILTER (y=0) mb, count(*) FILTER (y=1) na, count(*) FILTER (y=0) nb, var_pop(s) FILTER (y=1) va, var_pop(s) FILTER (y=0) vb, var_samp(s) FILTER (y=1) sa, var_samp(s) FILTER (y=0) sb FROM sc)
 SELECT 'pooled' AS kind, na, nb, round((ma-mb)/sqrt(((na-1)*va+(nb-1)*vb)/(na+nb-2)),6) AS d FROM a UNION ALL SELECT 'unpooled', na, nb, round((ma-mb)/sqrt((sa+sb)/2),6) FROM a""")
def _(c):
    s = scored(c)
    d = lambda pooled, n: cohen_d(s, "s", C("y") == 1, pooled).withColumn("kind", F.lit(n))
    return d(True, "pooled").unionByName(d(False, "unpooled"))


SHIFT = """sh AS (SELECT * FROM (SELECT UNNEST([-2.0::DOUBLE,0,2]) AS dx), (SELECT UNNEST([-2.0::DOUBLE,0,2]) AS dy)), bx AS (SELECT prior_id, dx, dy, minx+dx x0, miny+dy y0, maxx+dx x1, maxy+dy y1 FROM priors, sh),
 hit AS (SELECT dx, dy, intensity, CASE WHEN x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1 THEN 1 ELSE 0 END AS y FROM points JOIN bx ON x BETWEEN x0-5 AND x1+5 AND y BETWEEN y0-5 AND y1+5)"""


@query("a23_shift_grid", f"""WITH {SHIFT}, r AS (SELECT dx, dy, y, (2*rank() OVER (PARTITION BY dx,dy ORDER BY intensity) + count(*) OVER (PARTITION BY dx,dy,intensity) - 1)/2.0 AS k, intensity FROM hit)
 SELECT dx, dy, count(*) FILTER (y=1) n_pos, count(*) FILTER (y=0) n_neg, round((CAST(sum(k) FILTER (y=1) AS DOUBLE)-count(*) FILTER (y=1)*(count(*) FILTER (y=1)+1)*0.5)/(count(*) FILTER (y=1)*CAST(count(*) FILTER (y=0) AS DOUBLE)),6) AS auc, round(quantile_cont(intensity,0.95) FILTER (y=1),6) AS inside_p95, round(quantile_cont(intensity,0.95) FILTER (y=0),6) AS bg_p95 FROM r GROUP BY ALL""")
def _(c):
    # a point meets every box once; where it lies to the shifted box is told per axis, and its cases under all shifts stay in one row
    steps, pad = (-2.0, 0.0, 2.0), 7
    b = c.priors.select(*[(C(k) + o).alias(k) for k, o in (("minx", -pad), ("miny", -pad), ("maxx", pad), ("maxy", pad))])
    j = J.in_boxes(c.points.select("x", "y", "intensity"), shuffled(b), 32.0)

    def sides(p, lo, hi):
        inside = lambda d, more: C(p).between(C(lo) + pad + d - more, C(hi) - pad + d + more).cast("int")
        return sum(((inside(d, 0) + inside(d, 5)) * 3 ** i for i, d in enumerate(steps)), F.lit(0))

    shifts = [(i, k) for i in range(3) for k in range(3)]
    label = lambda x, y: sum(min(x // 3 ** i % 3, y // 3 ** k % 3) * 3 ** n for n, (i, k) in enumerate(shifts))
    codes = F.array(*[F.lit(label(x, y)) for x in range(27) for y in range(27)])
    j = j.select("intensity", F.get(codes, sides("x", "minx", "maxx") * 27 + sides("y", "miny", "maxy")).alias("code"))
    s = rank_labellings(j, "intensity", "code", len(shifts), 0.0001, .95)
    of = lambda n: F.get(F.array(*[F.lit(steps[s[n]]) for s in shifts]), C("i"))
    return s.select(of(0).alias("dx"), of(1).alias("dy"), "n_pos", "n_neg", "auc", C("pos_p").alias("inside_p95"), C("neg_p").alias("bg_p95"))


@query("a24_dominant_mode", """WITH g AS (SELECT drive_id, frame_id, z FROM points), l AS (SELECT drive_id, frame_id, min(z) lo, max(z) hi, count(*) n FROM g GROUP BY 1,2), b AS (SELECT drive_id, frame_id, CAST(floor((z-lo)/0.4137) AS BIGINT) bn, count(*) k FROM g JOIN l USING (drive_id, frame_id) GROUP BY ALL),
 t AS (SELECT drive_id, frame_id, max(k) k, arg_max(bn, {'k': k, 'o': -bn}) bn FROM b GROUP BY 1,2), q AS (SELECT drive_id, frame_id, quantile_cont(z,0.1) p, quantile_cont(z,0.2) p20 FROM g GROUP BY 1,2), f AS (SELECT *, CASE WHEN hi-lo<0.4137 THEN 0 ELSE k/CAST(n AS DOUBLE) END AS sh FROM l JOIN t USING (drive_id, frame_id) JOIN q USING (drive_id, frame_id))
 SELECT drive_id, frame_id, round(CASE WHEN hi-lo>=0.4137 AND sh>=0.2 THEN lo+(bn+0.5)*0.4137 WHEN hi-lo<0.4137 THEN p ELSE p20 END,6) AS ground_z, CASE WHEN hi-lo>=0.4137 AND sh>=0.2 THEN 'mode' ELSE 'pctl' END AS source, round(sh,6) AS share FROM f""")
def _(c):
    return A.dominant_mode(c.points, ["drive_id", "frame_id"], "z", 0.4137, 0.2, 10.0, 20.0)


SIM = "pq AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE)*100 sx, CAST(embedding[2] AS DOUBLE)*100 sy, 3+1.2*(CAST(embedding[1] AS DOUBLE)*100*cos(0.3)-CAST(embedding[2] AS DOUBLE)*100*sin(0.3))+CAST(embedding[3] AS DOUBLE)*10 dx, -5+1.2*(CAST(embedding[1] AS DOUBLE)*100*sin(0.3)+CAST(embedding[2] AS DOUBLE)*100*cos(0.3))+CAST(embedding[4] AS DOUBLE)*10 dy FROM embeddings)"


def fit_sql(src, dst):
    return f"""{dst}a AS (SELECT avg(sx) mx, avg(sy) my, avg(dx) ux, avg(dy) uy, covar_pop(sx,dx)+covar_pop(sy,dy) p, covar_pop(sx,dy)-covar_pop(sy,dx) q, var_pop(sx)+var_pop(sy) v FROM {src}), {dst} AS (SELECT atan2(q,p) yaw, sqrt(p*p+q*q)/v sc, ux-sqrt(p*p+q*q)/v*(cos(atan2(q,p))*mx-sin(atan2(q,p))*my) tx, uy-sqrt(p*p+q*q)/v*(sin(atan2(q,p))*mx+cos(atan2(q,p))*my) ty FROM {dst}a)"""


RES = "sqrt(pow(sc*(cos(yaw)*sx-sin(yaw)*sy)+tx-dx,2)+pow(sc*(sin(yaw)*sx+cos(yaw)*sy)+ty-dy,2))"


@query("a25_similarity_fit", f"""WITH {SIM}, {fit_sql('pq', 'm0')}, r0 AS (SELECT pq.*, {RES} AS res FROM pq, m0), k AS (SELECT *, row_number() OVER (ORDER BY res) AS r, count(*) OVER () AS n FROM r0), inl AS (SELECT * FROM k WHERE r<=greatest(3,floor(n*0.9))),
 {fit_sql('inl', 'm1')}, r1 AS (SELECT {RES} AS res FROM inl, m1)
 SELECT round(degrees(yaw),5) yaw_deg, round(sc,6) AS scale, round(tx,5) tx, round(ty,5) ty, round((SELECT sqrt(avg(res*res)) FROM r0),5) rms_raw, (SELECT count(*) FROM r0) n_rms_raw, round((SELECT sqrt(avg(res*res)) FROM r1),5) rms_inlier, (SELECT count(*) FROM r1) n_rms_inlier FROM m1""")
def _(c):
    e = lambda i: F.get("embedding", i).cast("double")
    a, b = e(0) * 100, e(1) * 100
    d = c.embeddings.select(a.alias("sx"), b.alias("sy"), (3 + 1.2 * (a * F.cos(F.lit(0.3)) - b * F.sin(F.lit(0.3))) + e(2) * 10).alias("dx"), (-5 + 1.2 * (a * F.sin(F.lit(0.3)) + b * F.cos(F.lit(0.3))) + e(3) * 10).alias("dy"))
    m = A.fit_similarity(d, 0.9)
    return m.select(*[F.round(k, 5).alias(k) for k in ("yaw_deg", "tx", "ty", "rms_raw", "rms_inlier")], "scale", "n_rms_raw", "n_rms_inlier")


@query("a26_offset_evidence", """WITH o AS (SELECT s.drive_id, s.frame_id, p.x-s.x dx, p.y-s.y dy FROM sweeps s JOIN poses p USING (drive_id, frame_id)), m AS (SELECT drive_id, quantile_cont(dx,0.5) mx, quantile_cont(dy,0.5) my FROM o GROUP BY 1), f AS (SELECT o.drive_id, frame_id, any_value(mx) mx, any_value(my) my, sqrt(avg(pow(dx-mx,2)+pow(dy-my,2))) r FROM o JOIN m USING (drive_id) GROUP BY 1,2)
 SELECT drive_id, round(any_value(mx),6)+0.0 AS dx, round(any_value(my),6)+0.0 AS dy, round(avg(r),6) AS rms, count(*) AS frames FROM f GROUP BY 1""")
def _(c):
    o = posed(c).select("drive_id", "frame_id", (C("p_x") - C("x")).alias("dx"), (C("p_y") - C("y")).alias("dy"))
    k = ["drive_id"]
    m = exact_percentiles(o, k, "dx", {"mx": .5}, 4.0).drop("n").join(exact_percentiles(o, k, "dy", {"my": .5}, 4.0).drop("n"), k)
    f = o.join(m, k).groupBy("drive_id", "frame_id").agg(F.max("mx").alias("mx"), F.max("my").alias("my"), F.sqrt(F.avg((C("dx") - C("mx")) ** 2 + (C("dy") - C("my")) ** 2)).alias("r"))
    return f.groupBy(*k).agg(F.max("mx").alias("dx"), F.max("my").alias("dy"), F.avg("r").alias("rms"), N().alias("frames"))


PLANE = """pl AS (SELECT drive_id, frame_id, avg(x) mx, avg(y) my, avg(z) mz, var_pop(x) xx, var_pop(y) yy, covar_pop(x,y) xy, covar_pop(x,z) xz, covar_pop(y,z) yz FROM points GROUP BY 1,2),
 pc AS (SELECT drive_id, frame_id, (xz*yy-yz*xy)/(xx*yy-xy*xy) a, (yz*xx-xz*xy)/(xx*yy-xy*xy) b, mz-(xz*yy-yz*xy)/(xx*yy-xy*xy)*mx-(yz*xx-xz*xy)/(xx*yy-xy*xy)*my c FROM pl WHERE abs(xx*yy-xy*xy)>1e-9)"""


@query("a27_plane_fit", f"""WITH {PLANE}, d AS (SELECT p.drive_id, p.frame_id, a, b, abs(a*x+b*y+c-z)/sqrt(a*a+b*b+1) AS d FROM points p JOIN pc USING (drive_id, frame_id)) SELECT drive_id, frame_id, round(any_value(a),6)+0.0 a, round(any_value(b),6)+0.0 b, round(quantile_cont(d,0.1),6) p10, round(quantile_cont(d,0.5),6) p50, round(quantile_cont(d,0.9),6) p90 FROM d GROUP BY 1,2""")
def _(c):
    k = ["drive_id", "frame_id"]
    d = c.points.join(A.fit_plane(c.points, k).filter("a is not null"), k).select(*k, "a", "b", A.plane_distance().alias("d"))
    q = F.percentile("d", F.array(F.lit(.1), F.lit(.5), F.lit(.9)))
    return d.groupBy(*k).agg(F.max("a").alias("a"), F.max("b").alias("b"), q.alias("q")).select(*k, "a", "b", *[F.get("q", i).alias(n) for i, n in enumerate(("p10", "p50", "p90"))])


@query("a28_ransac_plane")
def _(c):
    return A.ransac_plane(c.points, ["drive_id", "frame_id"], 24, 0.4, 0.5)


@query("a29_roundtrip_metrics", """WITH pr AS (SELECT a.class, a.x0 ax0, a.y0 ay0, a.x1 ax1, a.y1 ay1, b.x0 bx0, b.y0 by0, b.x1 bx1, b.y1 by1 FROM detections a JOIN detections b ON a.frame_id=b.frame_id AND a.class=b.class WHERE a.model='m0' AND b.model<>'m0'),
 i AS (SELECT *, greatest(least(ax1,bx1)-greatest(ax0,bx0),0)*greatest(least(ay1,by1)-greatest(ay0,by0),0) i, greatest(least(ax1+5,bx1+5)-greatest(ax0-5,bx0-5),0)*greatest(least(ay1+5,by1+5)-greatest(ay0-5,by0-5),0) e FROM pr),
 m AS (SELECT class, CASE WHEN i>0 THEN i/((ax1-ax0)*(ay1-ay0)+(bx1-bx0)*(by1-by0)-i) ELSE 0 END iou, CASE WHEN e>0 THEN e/((ax1-ax0+10)*(ay1-ay0+10)+(bx1-bx0+10)*(by1-by0+10)-e) ELSE 0 END iou_d, sqrt(pow((ax0+ax1-bx0-bx1)/2,2)+pow((ay0+ay1-by0-by1)/2,2)) ce, (bx1-bx0)*(by1-by0)/((ax1-ax0)*(ay1-ay0)) ar FROM i)
 SELECT class, count(*) n, round(quantile_cont(iou,0.5),6) iou_p50, round(quantile_cont(iou,0.9),6) iou_p90, round(quantile_cont(iou_d,0.5),6) dilated_p50, round(quantile_cont(ce,0.5),6) center_p50, round(quantile_cont(ar,0.5),6) area_ratio_p50 FROM m GROUP BY 1""")
def _(c):
    a, b = C("a"), C("b")
    pad = lambda q: E.make_box(q["minx"] - 5, q["miny"] - 5, q["maxx"] + 5, q["maxy"] + 5)
    ca, cb = E.bbox_center(a), E.bbox_center(b)
    m = model_pairs(c).select("class", E.box_iou(a, b).alias("iou"), E.box_iou(pad(a), pad(b)).alias("iou_d"), F.hypot(ca["x"] - cb["x"], ca["y"] - cb["y"]).alias("ce"), (E.box_area(b) / E.box_area(a)).alias("ar"))
    q = lambda v, ps, w: exact_percentiles(m, ["class"], v, ps, w)
    out = q("iou", {"iou_p50": .5, "iou_p90": .9}, 0.01)
    for v, n, w in (("iou_d", "dilated_p50", 0.01), ("ce", "center_p50", 1.0), ("ar", "area_ratio_p50", 0.05)):
        out = out.join(q(v, {n: .5}, w).drop("n"), "class")
    return out


@query("a30_projection_sanity", f"""WITH {PIX}, q AS (SELECT drive_id, rz_ d, CASE WHEN rz_>1e-6 THEN ({FX}*rx_+{CX}*rz_)/rz_ END u, CASE WHEN rz_>1e-6 THEN ({FX}*ry_+{CY}*rz_)/rz_ END v FROM rct), i AS (SELECT *, coalesce(u>=0 AND u<1408 AND v>=0 AND v<376,false) AS ii FROM q)
 SELECT drive_id, round(max(d),6) z_max, round(median(d) FILTER (d>0),6) z_median, round(max(u) FILTER (ii)-min(u) FILTER (ii),5) u_range, round(max(v) FILTER (ii)-min(v) FILTER (ii),5) v_range, count(DISTINCT CASE WHEN ii THEN round_even(v,0)*100000+round_even(u,0) END) unique_pixels, round(avg(CAST(ii AS INT)),6) in_image_ratio FROM i GROUP BY 1""")
def _(c):
    u, v, d, ok = T.project_rect(P_RECT, *rectified())
    p = posed(c).select("drive_id", d.alias("d"), u.alias("u"), v.alias("v"), T.in_image(u, v, ok, WIDTH, HEIGHT).alias("ii"))
    med = exact_percentiles(p.filter("d > 0"), ["drive_id"], "d", {"z_median": .5}, 0.25).drop("n")
    on = lambda k: F.when(C("ii"), C(k))
    pix = F.when(C("ii"), F.bround("v", 0) * 100000 + F.bround("u", 0))
    a = p.groupBy("drive_id").agg(F.max("d").alias("z_max"), F.round(F.max(on("u")) - F.min(on("u")), 5).alias("u_range"), F.round(F.max(on("v")) - F.min(on("v")), 5).alias("v_range"),
                                  F.countDistinct(pix).alias("unique_pixels"), F.avg(C("ii").cast("int")).alias("in_image_ratio"))
    return a.join(med, "drive_id", "left")


@query("a34_density_audit", """WITH t AS (SELECT o_custkey AS run, sum(o_totalprice) AS pts, count(*) FILTER (o_orderstatus='P') AS miss, count(*) AS n FROM orders GROUP BY 1), e AS (SELECT c_custkey AS run, c_acctbal*300 AS expected FROM customer WHERE c_acctbal>0)
 SELECT t.run, round(pts/expected,6) AS points_ratio, round(miss/CAST(n AS DOUBLE),6) AS missing_ratio, CASE WHEN miss/CAST(n AS DOUBLE)>0.1 THEN 'frames dropped' WHEN pts/expected<0.7 THEN 'points dropped' ELSE 'display thinning' END AS verdict FROM t LEFT JOIN e USING (run)""")
def _(c):
    t = c.orders.groupBy(C("o_custkey").alias("run")).agg(F.sum("o_totalprice").alias("pts"), (F.count_if(C("o_orderstatus") == "P") / N()).alias("missing_ratio"))
    e = c.customer.filter("c_acctbal > 0").select(C("c_custkey").alias("run"), (C("c_acctbal") * 300).alias("expected"))
    d = t.join(e, "run", "left").withColumn("points_ratio", C("pts") / C("expected"))
    v = R.first_reason([("frames dropped", C("missing_ratio") > 0.1), ("points dropped", C("points_ratio") < 0.7)], "display thinning")
    return d.select("run", "points_ratio", "missing_ratio", v.alias("verdict"))


@query("a35_boundary_coverage", """WITH b AS (SELECT p.drive_id%8 AS drive_id, p.drive_id AS trip, p.frame_id, p.x, p.y, q.x-p.x vx, q.y-p.y vy FROM poses p JOIN poses q ON q.drive_id=p.drive_id AND q.frame_id=p.frame_id+1 WHERE p.frame_id%20=10)
 SELECT b.trip, b.frame_id, count(*) FILTER (t.frame_id%2=0) AS part_a, count(*) FILTER (t.frame_id%2=1) AS part_b, count(*) FILTER ((t.x-b.x)*vx+(t.y-b.y)*vy>=0) AS forward FROM b JOIN points t ON t.drive_id=b.drive_id AND t.x BETWEEN b.x-15 AND b.x+15 AND pow(t.x-b.x,2)+pow(t.y-b.y,2)<=225 GROUP BY ALL""")
def _(c):
    p = c.poses
    nxt = p.select("drive_id", (C("frame_id") - 1).alias("frame_id"), C("x").alias("nx"), C("y").alias("ny"))
    b = p.join(nxt, ["drive_id", "frame_id"]).filter("frame_id % 20 = 10").select(
        (C("drive_id") % 8).alias("drive_id"), C("drive_id").alias("trip"), C("frame_id").alias("bf"), C("x").alias("rx"), C("y").alias("ry"), (C("nx") - C("x")).alias("vx"), (C("ny") - C("y")).alias("vy"))
    j = J.within(c.points.select("drive_id", C("frame_id").alias("pf"), "x", "y"), b, 15.0, ["drive_id"])
    dot = (C("x") - C("rx")) * C("vx") + (C("y") - C("ry")) * C("vy")
    return j.groupBy("trip", C("bf").alias("frame_id")).agg(F.count_if(C("pf") % 2 == 0).alias("part_a"), F.count_if(C("pf") % 2 == 1).alias("part_b"), F.count_if(dot >= 0).alias("forward"))


@query("a36_offset_mode", """WITH o AS (SELECT drive_id, frame_id//5 AS f, frame_id%5-2 AS off, round(iou_bbox*10000)+points_support AS s FROM trace), b AS (SELECT drive_id, f, arg_max(off, {'s': s, 'o': -off}) AS off FROM o GROUP BY 1,2), h AS (SELECT drive_id, off, count(*) n FROM b GROUP BY 1,2)
 SELECT drive_id, arg_max(off, {'n': n, 'o': -off}) AS mode_offset, CAST(sum(n) AS BIGINT) AS frames FROM h GROUP BY 1""")
def _(c):
    o = c.trace.select("drive_id", F.expr("frame_id div 5").alias("f"), (C("frame_id") % 5 - 2).alias("off"), (F.round(C("iou_bbox") * 10000) + C("points_support")).alias("s"))
    b = o.groupBy("drive_id", "f").agg(F.max_by("off", F.struct("s", (-C("off")).alias("o"))).alias("off"))
    h = b.groupBy("drive_id", "off").agg(N().alias("n"))
    return h.groupBy("drive_id").agg(F.max_by("off", F.struct("n", (-C("off")).alias("o"))).alias("mode_offset"), F.sum("n").alias("frames"))


PROF = """pa AS (SELECT drive_id, frame_id, avg(x) mx, avg(y) my, 0.5*atan2(2*covar_samp(x,y), var_samp(x)-var_samp(y)) a FROM points GROUP BY 1,2), pu AS (SELECT p.drive_id, p.frame_id, intensity, (y-my)*cos(a)-(x-mx)*sin(a) u FROM points p JOIN pa USING (drive_id, frame_id)), pb AS (SELECT drive_id, frame_id, min(u) lo, max(u) hi FROM pu GROUP BY 1,2),
 pf AS (SELECT drive_id, frame_id, CASE WHEN hi>lo THEN CAST(floor((u-lo)/((hi-lo)/39)+1e-9) AS BIGINT) ELSE 0 END AS bin, avg(intensity) AS mean, count(*) AS n FROM pu JOIN pb USING (drive_id, frame_id) GROUP BY 1,2,3), sp AS (SELECT drive_id, frame_id, UNNEST(range(40)) AS bin FROM pb), pv AS (SELECT sp.*, coalesce(mean,0) AS v FROM sp LEFT JOIN pf USING (drive_id, frame_id, bin))"""


def prof(c):
    return A.profile(c.points, ["drive_id", "frame_id"], "intensity", 40)


@query("a37_stripe_profile", f"""WITH {PROF}, pk AS (SELECT drive_id, frame_id, bin, v > lag(v) OVER w AND v > lead(v) OVER w AND v > 0.5*max(v) OVER (PARTITION BY drive_id, frame_id) AS p FROM pv WINDOW w AS (PARTITION BY drive_id, frame_id ORDER BY bin)), g AS (SELECT drive_id, frame_id, bin-lag(bin) OVER (PARTITION BY drive_id, frame_id ORDER BY bin) AS gap FROM pk WHERE p), s AS (SELECT drive_id, frame_id, count(*) k, stddev_pop(gap)/avg(gap) cv FROM g GROUP BY 1,2)
 SELECT b.drive_id, b.frame_id, coalesce(k,0) AS peaks, round(CASE WHEN coalesce(k,0)<2 THEN 1 ELSE cv END,5) AS spacing_cv FROM pb b LEFT JOIN s USING (drive_id, frame_id)""")
def _(c):
    return A.stripe_peaks(prof(c), ["drive_id", "frame_id"], 40).withColumn("spacing_cv", F.round("spacing_cv", 5))


@query("x45_band_energy", f"""WITH {PROF}, c AS (SELECT drive_id, frame_id, bin, v-avg(v) OVER (PARTITION BY drive_id, frame_id) AS v FROM pv), f AS (SELECT drive_id, frame_id, k, sum(v*cos({2 * 3.141592653589793!r}::DOUBLE/40*k*bin)) re, sum(v*sin({2 * 3.141592653589793!r}::DOUBLE/40*k*bin)) im FROM c, (SELECT UNNEST(range(21)) AS k) GROUP BY 1,2,3)
 SELECT drive_id, frame_id, round(coalesce(sum(re*re+im*im) FILTER (k/CAST(40*0.1 AS DOUBLE) BETWEEN 1.25 AND 2.857),0)/sum(re*re+im*im),5) AS band_ratio FROM f GROUP BY 1,2""")
def _(c):
    return A.band_energy(prof(c), ["drive_id", "frame_id"], 0.1, 40, 1.25, 2.857).withColumn("band_ratio", F.round("band_ratio", 5))


@query("x45_combined_objective", f"""WITH {PROF}, c AS (SELECT drive_id, frame_id, bin, v-avg(v) OVER (PARTITION BY drive_id, frame_id) AS v FROM pv), f AS (SELECT drive_id, frame_id, k, sum(v*cos({2 * 3.141592653589793!r}::DOUBLE/40*k*bin)) re, sum(v*sin({2 * 3.141592653589793!r}::DOUBLE/40*k*bin)) im FROM c, (SELECT UNNEST(range(21)) AS k) GROUP BY 1,2,3),
 br AS (SELECT drive_id, frame_id, coalesce(sum(re*re+im*im) FILTER (k/CAST(40*0.1 AS DOUBLE) BETWEEN 1.25 AND 2.857),0)/sum(re*re+im*im) AS band FROM f GROUP BY 1,2),
 hit AS (SELECT drive_id, frame_id, intensity, CASE WHEN EXISTS (SELECT 1 FROM priors WHERE x BETWEEN minx AND maxx AND y BETWEEN miny AND maxy) THEN 1 ELSE 0 END AS y FROM points),
 r AS (SELECT *, (2*rank() OVER (PARTITION BY drive_id, frame_id ORDER BY intensity) + count(*) OVER (PARTITION BY drive_id, frame_id, intensity) - 1)/2.0::DOUBLE AS k FROM hit),
 m AS (SELECT drive_id, frame_id, count(*) FILTER (y=1) AS n1, count(*) FILTER (y=0) AS n0, CAST(sum(k) FILTER (y=1) AS DOUBLE) AS s1, avg(intensity) FILTER (y=1) AS m1, avg(intensity) FILTER (y=0) AS m0, var_pop(intensity) FILTER (y=1) AS v1, var_pop(intensity) FILTER (y=0) AS v0 FROM r GROUP BY 1,2),
 q AS (SELECT drive_id, frame_id, n1>0 AND n0>0 AS bo, (s1-n1*(n1+1)/2.0::DOUBLE)/nullif(n1*CAST(n0 AS DOUBLE),0) AS auc, CASE WHEN n1+n0>2 AND ((n1-1)*v1+(n0-1)*v0)>0 THEN (m1-m0)/sqrt(((n1-1)*v1+(n0-1)*v0)/(n1+n0-2)) ELSE 0 END AS d FROM m)
 SELECT drive_id, frame_id, round(CASE WHEN bo THEN auc ELSE 0 END,5) AS auc, round(CASE WHEN bo THEN d ELSE 0 END,4) AS d, round(CASE WHEN bo THEN 2*auc+1.5::DOUBLE*greatest(0,least(d/2,1))+greatest(0,least(ln(greatest(band,1e-6::DOUBLE))/ln(5),1)) ELSE 0 END,4) AS objective FROM q JOIN br USING (drive_id, frame_id)""")
def _(c):
    k = ["drive_id", "frame_id"]
    inside = J.in_boxes(c.points.select("x", "y").distinct(), c.priors, 32.0).select("x", "y").distinct().withColumn("in", F.lit(1))
    p = c.points.select(*k, "x", "y", "intensity").join(inside, ["x", "y"], "left").select(*k, "intensity", F.coalesce("in", F.lit(0)).alias("y"))
    auc = rank_auc(p, k, "intensity", "y", 0.05).select(*k, "auc")
    band = A.band_energy(prof(c), k, 0.1, 40, 1.25, 2.857)
    j = A.effect_sizes(p, k, "intensity", C("y") == 1).join(auc, k).join(band, k)
    both = (C("n_in") > 0) & (C("n_bg") > 0)
    return j.select(*k, F.round(F.when(both, C("auc")).otherwise(0.0), 5).alias("auc"), F.round(F.when(both, C("d")).otherwise(0.0), 4).alias("d"),
                    F.round(F.when(both, A.objective(C("auc"), C("d"), C("band_ratio"))).otherwise(0.0), 4).alias("objective"))


@query("a38_periodic_snr")
def _(c):
    cells = G.with_cell(c.points, 4.0).groupBy("drive_id", "ix", "iy").agg(F.max("intensity").alias("v"))
    t = lambda k: F.floor(C(k) / 32).cast("long")
    p = cells.select("drive_id", t("ix").alias("tile_x"), t("iy").alias("tile_y"), (C("ix") - t("ix") * 32).cast("int").alias("col"), (C("iy") - t("iy") * 32).cast("int").alias("row"), "v")
    return A.patch_snr(p, ["drive_id", "tile_x", "tile_y"], "v", 32)


@query("a39_model_class_deltas", """WITH a AS (SELECT class, count(*) n, quantile_cont((x1-x0)*(y1-y0),0.5) a FROM detections WHERE model='m0' GROUP BY 1), b AS (SELECT class, count(*) n, quantile_cont((x1-x0)*(y1-y0),0.5) a FROM detections WHERE model='m1' GROUP BY 1)
 SELECT class, coalesce(b.n,0)-coalesce(a.n,0) AS d_count, round(coalesce(b.a,0)-coalesce(a.a,0),6) AS d_area FROM a FULL JOIN b USING (class) ORDER BY abs(coalesce(b.n,0)-coalesce(a.n,0))+abs(coalesce(b.a,0)-coalesce(a.a,0)) DESC, class LIMIT 3""")
def _(c):
    d = c.detections.withColumn("area", (C("x1") - C("x0")) * (C("y1") - C("y0")))
    s = lambda m: exact_percentiles(d.filter(C("model") == m), ["class"], "area", {"a": .5}, 64.0).select("class", C("n").alias("n_" + m), C("a").alias("a_" + m))
    z = lambda k: F.coalesce(C(k), F.lit(0))
    j = s("m0").join(s("m1"), "class", "full").select("class", (z("n_m1") - z("n_m0")).alias("d_count"), (z("a_m1") - z("a_m0")).alias("d_area"))
    return j.orderBy(F.desc(F.abs("d_count") + F.abs("d_area")), "class").limit(3)


@query("a40_candidate_rollup", """WITH e AS (SELECT o_custkey AS cand, CASE WHEN o_orderstatus='P' THEN 'SKIPPED' WHEN o_totalprice<20000 THEN 'FAIL' ELSE 'PASS' END AS status, CASE WHEN o_orderstatus='P' THEN 'missing_summary' WHEN o_totalprice<20000 THEN 'road_components_not_1' END AS reason, o_totalprice/500000 AS score FROM orders)
 SELECT cand, CASE WHEN count(*) FILTER (status='FAIL')>0 THEN 'FAIL' WHEN count(*) FILTER (status='PASS')=0 THEN 'SKIPPED' ELSE 'PASS' END AS status, round(avg(score) FILTER (status='PASS'),6) AS avg_score, count(*) FILTER (status='PASS') pass_count, count(*) FILTER (status='FAIL') fail_count, count(*) FILTER (status='SKIPPED') skipped_count, coalesce(string_agg(DISTINCT reason, ';' ORDER BY reason),'') AS reasons FROM e GROUP BY 1""")
def _(c):
    skip, fail = C("o_orderstatus") == "P", C("o_totalprice") < 20000
    e = c.orders.select(C("o_custkey").alias("cand"), R.first_reason([("SKIPPED", skip), ("FAIL", fail)], "PASS").alias("s"),
                        R.first_reason([("missing_summary", skip), ("road_components_not_1", fail)], None).alias("reason"), (C("o_totalprice") / 500000).alias("score"))
    n = lambda v: F.count_if(C("s") == v)
    a = e.groupBy("cand").agg(n("PASS").alias("pass_count"), n("FAIL").alias("fail_count"), n("SKIPPED").alias("skipped_count"), F.avg(F.when(C("s") == "PASS", C("score"))).alias("avg_score"), F.array_join(F.array_sort(F.collect_set("reason")), ";").alias("reasons"))
    return a.withColumn("status", F.when(C("fail_count") > 0, "FAIL").when(C("pass_count") == 0, "SKIPPED").otherwise("PASS"))


@query("a41_confidence_tiers", """WITH m AS (SELECT cand_id, drive_id, rect_l*rect_w AS area, CASE WHEN rect_l*rect_w<4 OR rect_l*rect_w>36 THEN 'low' WHEN frame_id%9>=5 THEN 'high' WHEN frame_id%9>=3 THEN 'med' ELSE 'low' END AS tier FROM candidates) SELECT drive_id, tier, count(*) n, round(sum(area),6) area FROM m GROUP BY 1,2""")
def _(c):
    a, s = C("rect_l") * C("rect_w"), C("frame_id") % 9
    tier = F.when((a < 4) | (a > 36), "low").when(s >= 5, "high").when(s >= 3, "med").otherwise("low")
    return c.candidates.groupBy("drive_id", tier.alias("tier")).agg(N().alias("n"), F.sum(a).alias("area"))


@query("a42_distinct_class_ids", "SELECT l_suppkey%8 AS drive_id, count(DISTINCT l_partkey%37) AS n, list_sort(list(DISTINCT l_partkey%37)) AS ids FROM lineitem GROUP BY 1")
def _(c):
    d = c.lineitem.select((C("l_suppkey") % 8).alias("drive_id"), (C("l_partkey") % 37).alias("id")).distinct()
    return d.groupBy("drive_id").agg(N().alias("n"), F.array_sort(F.collect_list("id")).alias("ids"))


@query("v17_fusion_gates", """WITH b AS (SELECT drive_id, max(intensity) i, min(x) x0, max(x) x1, count(DISTINCT round_even(y,3)) u FROM points GROUP BY 1) SELECT drive_id, i>0.05 AS intensity_ok, x0<x1 AS bbox_ok, u>=100 AS banding_ok, CASE WHEN NOT i>0.05 THEN 'intensity' WHEN NOT x0<x1 THEN 'bbox' WHEN NOT u>=100 THEN 'banding' ELSE 'ok' END AS gate FROM b""")
def _(c):
    b = c.points.groupBy("drive_id").agg(F.max("intensity").alias("i"), F.min("x").alias("x0"), F.max("x").alias("x1"))
    u = c.points.select("drive_id", F.bround("y", 3).alias("v")).distinct().groupBy("drive_id").agg(N().alias("u"))
    d = b.join(u, "drive_id").select("drive_id", (C("i") > 0.05).alias("intensity_ok"), (C("x0") < C("x1")).alias("bbox_ok"), (C("u") >= 100).alias("banding_ok"))
    return d.withColumn("gate", R.first_reason([("intensity", ~C("intensity_ok")), ("bbox", ~C("bbox_ok")), ("banding", ~C("banding_ok"))], "ok"))
