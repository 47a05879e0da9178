"""Ordered sequences, ranking and top-k."""

from pyspark.sql import functions as F

from wayfold.functions import geometry as E, transforms as T
from wayfold.functions.stats import exact_percentiles, top_per_group
from wayfold.operators import chains as CH, greedy as GR, lines as L, ordered as O
from wayfold.queries.catalog import C, query
from wayfold.queries.q_e_geometry import LINE, sample_sql
from wayfold.queries.q_p_scalars import pose12

def N():
    return F.count(F.lit(1))


def trip(c, *more):
    return c.poses.select("drive_id", C("frame_id").alias("idx"), "x", "y", *more)


@query("w01_arc_length", f"WITH {LINE} SELECT drive_id, frame_id AS idx, round(s,5) AS s FROM sl")
def _(c):
    return L.arc_length(trip(c), ["drive_id"], "idx").select("drive_id", "idx", F.round("s", 5).alias("s"))


TURN = f"""{LINE}, tn AS (SELECT drive_id, frame_id AS idx, x, y, acos(greatest(least(((x-px)*(nx-x)+(y-py)*(ny-y))/(sqrt(pow(x-px,2)+pow(y-py,2))*sqrt(pow(nx-x,2)+pow(ny-y,2))),1),-1)) AS ang FROM vt WHERE px IS NOT NULL AND nx IS NOT NULL AND sqrt(pow(x-px,2)+pow(y-py,2))>0 AND sqrt(pow(nx-x,2)+pow(ny-y,2))>0)"""


def turns(c, thr):
    p = L.neighbours(trip(c), ["drive_id"], "idx", ["x", "y"]).filter("p_x is not null and n_x is not null")
    ax, ay, bx, by = C("x") - C("p_x"), C("y") - C("p_y"), C("n_x") - C("x"), C("n_y") - C("y")
    n = F.hypot(ax, ay) * F.hypot(bx, by)
    ang = F.acos(F.greatest(F.least((ax * bx + ay * by) / n, F.lit(1.0)), F.lit(-1.0)))
    return p.filter(n > 0).select("drive_id", "idx", "x", "y", ang.alias("ang")).filter(C("ang") >= thr)


@query("w02_turn_points", f"WITH {TURN} SELECT drive_id, idx, round(ang,6) AS ang FROM tn WHERE ang>=1.4")
def _(c):
    return turns(c, 1.4).select("drive_id", "idx", "ang")


@query("w02_spaced_turn_points", f"""WITH RECURSIVE {TURN}, t AS (SELECT drive_id, idx, x, y, row_number() OVER (PARTITION BY drive_id ORDER BY idx) AS r FROM tn WHERE ang>=1.4),
 f AS (SELECT drive_id, r, idx, true AS keep, x AS lx, y AS ly FROM t WHERE r=1 UNION ALL SELECT t.drive_id, t.r, t.idx, sqrt(pow(t.x-lx,2)+pow(t.y-ly,2))>=40, CASE WHEN sqrt(pow(t.x-lx,2)+pow(t.y-ly,2))>=40 THEN t.x ELSE lx END, CASE WHEN sqrt(pow(t.x-lx,2)+pow(t.y-ly,2))>=40 THEN t.y ELSE ly END FROM f JOIN t ON t.drive_id=f.drive_id AND t.r=f.r+1)
 SELECT drive_id, idx FROM f WHERE keep""")
def _(c):
    return CH.spaced(turns(c, 1.4), ["drive_id"], "idx", 40.0).select("drive_id", "idx")


@query("w03_road_heading", """WITH m AS (SELECT drive_id, max(frame_id) AS m FROM poses GROUP BY 1) SELECT p.drive_id, p.frame_id AS idx, round(CASE WHEN a.frame_id<>b.frame_id AND (abs(b.x-a.x)>1e-3 OR abs(b.y-a.y)>1e-3) THEN degrees(atan2(b.y-a.y,b.x-a.x)) ELSE degrees(p.yaw) END,6)+0.0 AS heading
 FROM poses p JOIN m ON m.drive_id=p.drive_id JOIN poses a ON a.drive_id=p.drive_id AND a.frame_id=greatest(0,p.frame_id-3) JOIN poses b ON b.drive_id=p.drive_id AND b.frame_id=least(m.m,p.frame_id+3)""")
def _(c):
    k = 3
    w = O.halo_window(["drive_id"], "idx")
    h = O.with_halo(trip(c, "yaw"), "idx", k)
    side = lambda f, col: F.coalesce(*[f(col, j).over(w) for j in range(k, 0, -1)], C(col))
    h = h.select("*", side(F.lag, "x").alias("ax"), side(F.lag, "y").alias("ay"), side(F.lead, "x").alias("bx"), side(F.lead, "y").alias("by_"))
    dx, dy = C("bx") - C("ax"), C("by_") - C("ay")
    hd = F.when((F.abs(dx) > 1e-3) | (F.abs(dy) > 1e-3), F.degrees(F.atan2(dy, dx))).otherwise(F.degrees("yaw"))
    return O.drop_halo(h, "idx").select("drive_id", "idx", hd.alias("heading"))


REL = """mt AS (SELECT drive_id, frame_id, x, y, z, cos(yaw) c1, sin(yaw) s1, cos(pitch) c2, sin(pitch) s2, cos(roll) c3, sin(roll) s3 FROM poses), rm AS (SELECT drive_id, frame_id, x, y, z, c1*c2 a00, c1*s2*s3-s1*c3 a01, c1*s2*c3+s1*s3 a02, s1*c2 a10, s1*s2*s3+c1*c3 a11, s1*s2*c3-c1*s3 a12, -s2 a20, c2*s3 a21, c2*c3 a22 FROM mt)"""


@query("w04_relative_pose", f"""WITH {REL} SELECT b.drive_id, b.frame_id, round(sqrt(pow(b.x-a.x,2)+pow(b.y-a.y,2)+pow(b.z-a.z,2)),5) AS dt, round(degrees(acos(greatest(least((a.a00*b.a00+a.a10*b.a10+a.a20*b.a20+a.a01*b.a01+a.a11*b.a11+a.a21*b.a21+a.a02*b.a02+a.a12*b.a12+a.a22*b.a22-1)/2,1),-1))),4) AS ang
 FROM rm a JOIN rm b ON a.drive_id=b.drive_id AND b.frame_id=a.frame_id+1""")
def _(c):
    m = T.pose_matrix(*[C(k) for k in ("x", "y", "z", "roll", "pitch", "yaw")])
    p = c.poses.select("drive_id", "frame_id", *[v.alias(f"m{i}") for i, v in enumerate(m)])
    q = p.select("drive_id", (C("frame_id") + 1).alias("frame_id"), *[C(f"m{i}").alias(f"q{i}") for i in range(12)])
    j = p.join(q, ["drive_id", "frame_id"])
    rot = [i for i in range(12) if i % 4 != 3]
    trace = sum((C(f"m{i}") * C(f"q{i}") for i in rot[1:]), C("m0") * C("q0"))
    d2 = sum(((C(f"m{i}") - C(f"q{i}")) ** 2 for i in (7, 11)), (C("m3") - C("q3")) ** 2)
    ang = F.degrees(F.acos(F.greatest(F.least((trace - 1) / 2, F.lit(1.0)), F.lit(-1.0))))
    return j.select("drive_id", "frame_id", F.round(F.sqrt(d2), 5).alias("dt"), F.round(ang, 4).alias("ang"))


def smooth5(d, key, idx, v):
    """Upper middle of the truncated five-wide window."""
    h = O.with_halo(d, idx, 2)
    a = F.array_sort(F.collect_list(v).over(O.halo_window(key, idx).rowsBetween(-2, 2)))
    return O.drop_halo(h.withColumn("smooth", F.get(a, F.floor(F.size(a) / 2).cast("int"))), idx)


@query("w05_moving_median", """WITH w AS (SELECT drive_id, frame_id AS idx, list_sort(list(y) OVER (PARTITION BY drive_id ORDER BY frame_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)) AS a FROM poses) SELECT drive_id, idx, round(a[len(a)//2+1],6) AS smooth FROM w""")
def _(c):
    return smooth5(trip(c), ["drive_id"], "idx", "y").select("drive_id", "idx", "smooth")


PEAK = """md AS (SELECT drive_id, quantile_cont(y,0.5)*1.05 AS thr FROM poses GROUP BY 1), pk AS (SELECT p.drive_id, frame_id AS idx, x, y, y>thr AS peak FROM poses p JOIN md ON md.drive_id=p.drive_id),
 lg AS (SELECT *, lag(peak) OVER w AS lp, lag(x) OVER w AS lx, lag(y) OVER w AS ly FROM pk WINDOW w AS (PARTITION BY drive_id ORDER BY idx)), br AS (SELECT *, sum(CASE WHEN lp AND sqrt(pow(x-lx,2)+pow(y-ly,2))<=30 THEN 0 ELSE 1 END) OVER (PARTITION BY drive_id ORDER BY idx) AS g FROM lg WHERE peak)"""


@query("w06_peak_clusters", f"WITH {PEAK} SELECT drive_id, CAST(g AS BIGINT) AS cluster, count(*) AS n, round(avg(x),5) AS cx, round(avg(y),5) AS cy FROM br GROUP BY 1,2")
def _(c):
    t = trip(c)
    thr = exact_percentiles(t, ["drive_id"], "y", {"m": .5}, 2.0).select("drive_id", (C("m") * 1.05).alias("thr"))
    p = L.neighbours(t, ["drive_id"], "idx", ["x", "y"]).join(thr, "drive_id").filter(C("y") > C("thr"))
    joined = (C("p_y") > C("thr")) & (F.hypot(C("x") - C("p_x"), C("y") - C("p_y")) <= 30)
    p = p.withColumn("brk", F.when(joined, 0).otherwise(1).cast("long"))
    g = O.running_sum(p, ["drive_id"], ["idx"], F.floor(C("idx") / O.CHUNK), C("brk"), "cluster")
    return g.groupBy("drive_id", "cluster").agg(N().alias("n"), F.round(F.avg("x"), 5).alias("cx"), F.round(F.avg("y"), 5).alias("cy"))


RUNS = """d AS (SELECT DISTINCT drive_id, frame_id//20 AS f FROM trace WHERE geom_ok=1), g AS (SELECT drive_id, f, f-row_number() OVER (PARTITION BY drive_id ORDER BY f) AS k FROM d), rn AS (SELECT drive_id, min(f) AS a, max(f) AS b, count(*) AS n FROM g GROUP BY drive_id, k)"""


def runs(c):
    d = c.trace.filter("geom_ok = 1").select("drive_id", F.expr("frame_id div 20").alias("f")).distinct()
    return O.islands(d, ["drive_id"], "f")


@query("w07_longest_run", f"WITH {RUNS} SELECT drive_id, max(n) AS longest FROM rn GROUP BY 1")
def _(c):
    return runs(c).groupBy("drive_id").agg(F.max("n").alias("longest"))


@query("w08_segment_count", """WITH l AS (SELECT conv_id, role='assistant' AS f, lag(role='assistant') OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations) SELECT conv_id, count(*) FILTER (f AND NOT coalesce(p,false)) AS segments FROM l GROUP BY 1""")
def _(c):
    d = c.conversations.select("conv_id", "turn", (C("role") == "assistant").alias("f"))
    prev = d.select("conv_id", (C("turn") + 1).alias("turn"), C("f").alias("p"))  # turns are dense: the previous one is an equi join
    start = C("f") & ~F.coalesce("p", F.lit(False))
    return d.join(prev, ["conv_id", "turn"], "left").groupBy("conv_id").agg(F.count_if(start).alias("segments"))


@query("w09_frame_ranges", f"WITH {RUNS} SELECT drive_id, string_agg(CASE WHEN a=b THEN lpad(CAST(a AS VARCHAR),10,'0') ELSE lpad(CAST(a AS VARCHAR),10,'0')||'-'||lpad(CAST(b AS VARCHAR),10,'0') END, ', ' ORDER BY a) AS ranges FROM rn GROUP BY 1")
def _(c):
    pad = lambda v: F.lpad(C(v).cast("string"), 10, "0")
    t = F.when(C("run_start") == C("run_end"), pad("run_start")).otherwise(F.concat_ws("-", pad("run_start"), pad("run_end")))
    return runs(c).groupBy("drive_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("run_start", t.alias("t")))), lambda s: s["t"]), ", ").alias("ranges"))


DRIFT = """q AS (SELECT user_id AS seed, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r, value AS area FROM events),
 f AS (SELECT seed, r, event_id, area, area<2 AS drift, CASE WHEN area<2 THEN NULL ELSE area END AS last, CASE WHEN area<2 THEN 1 ELSE 0 END AS consec, false AS stop FROM q WHERE r=1
  UNION ALL SELECT q.seed, q.r, q.event_id, q.area, q.area<2 OR (last IS NOT NULL AND (q.area/last<0.25 OR q.area/last>4)), CASE WHEN q.area<2 OR (last IS NOT NULL AND (q.area/last<0.25 OR q.area/last>4)) THEN last ELSE q.area END,
   CASE WHEN q.area<2 OR (last IS NOT NULL AND (q.area/last<0.25 OR q.area/last>4)) THEN consec+1 ELSE 0 END, CASE WHEN q.area<2 OR (last IS NOT NULL AND (q.area/last<0.25 OR q.area/last>4)) THEN consec+1 ELSE 0 END >= 3 FROM f JOIN q ON q.seed=f.seed AND q.r=f.r+1 WHERE NOT stop)"""


@query("w10_drift_stop", f"WITH RECURSIVE {DRIFT} SELECT seed, event_id, drift FROM f WHERE NOT stop")
def _(c):
    d = c.events.select(C("user_id").alias("seed"), "event_id", C("value").alias("area"))
    return CH.drift_stop(d, ["seed"], "event_id", "area", least=2, low=0.25, high=4, stop=3).select("seed", "event_id", "drift")


@query("w11_frame_windows", """WITH k AS (SELECT *, row_number() OVER (PARTITION BY drive_id ORDER BY conf DESC, cand_id) AS r FROM candidates), w AS (SELECT drive_id, UNNEST(range(greatest(0,frame_id-4), frame_id+5)) AS frame_id FROM k WHERE r<=20) SELECT DISTINCT drive_id, CAST(frame_id AS BIGINT) AS frame_id FROM w""")
def _(c):
    top = top_per_group(c.candidates, ["drive_id"], [F.desc("conf"), C("cand_id")], 20)
    return top.select("drive_id", F.explode(F.sequence(F.greatest(C("frame_id") - 4, F.lit(0)), C("frame_id") + 4)).alias("frame_id")).dropDuplicates(["drive_id", "frame_id"])


@query("w12_windows_by_stride", "SELECT drive_id, frame_id//700 AS win, count(*) AS n, round(sum(iou_bbox),6) AS iou_sum FROM trace GROUP BY 1,2")
def _(c):
    w = c.trace.withColumn("win", F.expr("frame_id div 700"))
    return w.groupBy("drive_id", "win").agg(N().alias("n"), F.sum("iou_bbox").alias("iou_sum"))


@query("w13_list_chunks", "WITH i AS (SELECT drive_id, (row_number() OVER (PARTITION BY drive_id ORDER BY cand_id)-1)//64 AS part, cand_id FROM candidates) SELECT drive_id, part, count(*) AS n, min(cand_id) AS lo, max(cand_id) AS hi FROM i GROUP BY 1,2")
def _(c):
    i = O.dense_index(c.candidates.select("drive_id", "cand_id"), ["drive_id"], ["cand_id"], F.floor(C("cand_id") / O.CHUNK), "i")
    return i.groupBy("drive_id", F.expr("i div 64").alias("part")).agg(N().alias("n"), F.min("cand_id").alias("lo"), F.max("cand_id").alias("hi"))


@query("w14_fill_unique", """WITH u AS (SELECT drive_id, frame_id AS f, 1 AS p, iou_bbox AS v FROM trace WHERE geom_ok=1 UNION ALL SELECT drive_id, frame_id, 2, iou_bbox FROM trace), d AS (SELECT drive_id, f, min({'p': p, 'v': v}) AS b FROM u GROUP BY 1,2), r AS (SELECT *, row_number() OVER (PARTITION BY drive_id ORDER BY b, f) AS r FROM d) SELECT drive_id, f AS frame_id, r AS rank FROM r WHERE r<=12""")
def _(c):
    t = c.trace.select("drive_id", "frame_id", "iou_bbox", "geom_ok")
    u = t.filter("geom_ok = 1").withColumn("p", F.lit(1)).unionByName(t.withColumn("p", F.lit(2)))
    d = u.groupBy("drive_id", "frame_id").agg(F.min(F.struct("p", "iou_bbox")).alias("b"))
    return top_per_group(d, ["drive_id"], [C("b"), C("frame_id")], 12).select("drive_id", "frame_id", "rank")


@query("w15_distance_boundaries", f"WITH {LINE}, b AS (SELECT drive_id, CAST(floor(s/300) AS BIGINT) AS part, min(frame_id) AS frame_id FROM sl GROUP BY 1,2) SELECT * FROM b WHERE part>=1")
def _(c):
    s = L.arc_length(trip(c), ["drive_id"], "idx")
    return s.groupBy("drive_id", F.floor(C("s") / 300).alias("part")).agg(F.min("idx").alias("frame_id")).filter("part >= 1")


@query("w15_byte_boundaries", """WITH RECURSIVE q AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r, event_id, CAST(round(value*100) AS BIGINT) AS b FROM events),
 f AS (SELECT user_id, r, event_id, CASE WHEN b>=20000 THEN 0 ELSE b END AS acc, b>=20000 AS cut FROM q WHERE r=1 UNION ALL SELECT q.user_id, q.r, q.event_id, CASE WHEN acc+b>=20000 THEN 0 ELSE acc+b END, acc+b>=20000 FROM f JOIN q ON q.user_id=f.user_id AND q.r=f.r+1) SELECT user_id AS drive_id, event_id FROM f WHERE cut""")
def _(c):
    d = c.events.select(C("user_id").alias("drive_id"), "event_id", F.round(C("value") * 100).cast("long").alias("b"))
    return CH.budget_cuts(d, ["drive_id"], "event_id", C("b"), 20000).select("drive_id", "event_id")


@query("w16_tangents", f"""WITH {LINE}, d AS (SELECT drive_id, frame_id AS idx, coalesce(nx,x)-coalesce(px,x) dx, coalesce(ny,y)-coalesce(py,y) dy FROM vt) SELECT drive_id, idx, round(CASE WHEN dx=0 AND dy=0 THEN 1 ELSE dx/sqrt(dx*dx+dy*dy) END,6)+0.0 AS tx, round(CASE WHEN dx=0 AND dy=0 THEN 0 ELSE dy/sqrt(dx*dx+dy*dy) END,6)+0.0 AS ty FROM d""")
def _(c):
    return L.tangents(trip(c), ["drive_id"], "idx").select("drive_id", "idx", "tx", "ty")


@query("k01_top_areas", "WITH r AS (SELECT drive_id, cand_id, rect_l*rect_w AS area, row_number() OVER (PARTITION BY drive_id ORDER BY rect_l*rect_w DESC, cand_id) AS rank FROM candidates WHERE rect_l*rect_w>=12) SELECT drive_id, cand_id, round(area,6) AS area, rank FROM r WHERE rank<=10")
def _(c):
    d = c.candidates.select("drive_id", "cand_id", (C("rect_l") * C("rect_w")).alias("area")).filter("area >= 12")
    return top_per_group(d, ["drive_id"], [F.desc("area"), C("cand_id")], 10)


@query("k02_cap_per_class", "WITH r AS (SELECT class, cand_id, conf, row_number() OVER (PARTITION BY class ORDER BY conf DESC, cand_id) AS rank FROM candidates) SELECT class, cand_id, round(conf,6) AS conf, rank FROM r WHERE rank<=50")
def _(c):
    return top_per_group(c.candidates.select("class", "cand_id", "conf"), ["class"], [F.desc("conf"), C("cand_id")], 50)


def scored(c):
    from wayfold.functions.records import gore_like

    g = gore_like(C("rect_w"), C("rect_l"), C("rectangularity"))
    return c.candidates.select("cand_id", C("frame_id").alias("cluster"), "x", "y", ((C("conf") + C("rectangularity")) * F.when(g, 0.2).otherwise(1.0)).alias("base"))


@query("k03_spaced_seeds", """WITH s AS (SELECT cand_id, frame_id AS cluster, x, y, (conf+rectangularity)*CASE WHEN (rect_l>10 AND rect_w>0 AND rect_w<2) OR (rectangularity>0 AND rectangularity<0.2 AND rect_l>rect_w*3) THEN 0.2 ELSE 1 END AS base FROM candidates),
 a AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY base DESC, cand_id) AS r FROM s), b AS (SELECT s.*, row_number() OVER (PARTITION BY s.cluster ORDER BY s.base DESC, s.cand_id) AS r FROM s JOIN a ON a.cluster=s.cluster AND a.r=1 AND s.cand_id<>a.cand_id AND sqrt(pow(s.x-a.x,2)+pow(s.y-a.y,2))>=60)
 SELECT cluster, cand_id, 1 AS pick FROM a WHERE r=1 UNION ALL SELECT cluster, cand_id, 2 FROM b WHERE r=1""")
def _(c):
    return GR.pick_spaced(scored(c), "cand_id", ["cluster"], [C("base"), -C("cand_id")], 2, 60.0).select("cluster", "cand_id", "pick")


def greedy_sql(src, by, key, order, fields, test):
    """SQL: the sequential walk as a recursion over the rank, carrying the list of kept rows."""
    st = "{" + ", ".join(f"'{f}': {f}" for f in [key, *fields]) + "}"
    on = " AND ".join(f"o.{k}=f.{k}" for k in by)
    g = ", ".join(by)
    hit = f"list_filter(f.kept_rows, lambda k: {test})"
    return f"""o AS (SELECT *, {st} AS b, row_number() OVER (PARTITION BY {g} ORDER BY {order}) AS r FROM {src}),
 f AS (SELECT {g}, r, {key}, {key} AS owner, [b] AS kept_rows FROM o WHERE r=1 UNION ALL SELECT {', '.join('o.' + k for k in by)}, o.r, o.{key}, coalesce({hit}[1].{key}, o.{key}), CASE WHEN len({hit})>0 THEN f.kept_rows ELSE list_append(f.kept_rows, o.b) END FROM f JOIN o ON {on} AND o.r=f.r+1)"""


BOX4 = ["x0", "y0", "x1", "y1"]


def iou_test(thr, k="k", b="o.b"):
    w, h = f"greatest(least({k}.x1,{b}.x1)-greatest({k}.x0,{b}.x0),0)", f"greatest(least({k}.y1,{b}.y1)-greatest({k}.y0,{b}.y0),0)"
    return f"{w}*{h} > 0 AND {w}*{h}/(({k}.x1-{k}.x0)*({k}.y1-{k}.y0)+({b}.x1-{b}.x0)*({b}.y1-{b}.y0)-{w}*{h}) >= {thr}"


def nms(c, by, thr):
    d = c.detections.withColumn("x", (C("x0") + C("x1")) / 2).withColumn("y", (C("y0") + C("y1")) / 2)
    box = lambda f: E.make_box(f("x0"), f("y0"), f("x1"), f("y1"))
    side = F.greatest(C("x1") - C("x0"), C("y1") - C("y0"))  # overlapping boxes have centres at most the larger side apart
    return GR.greedy_keep(d, "det_id", by, [C("score"), -C("det_id")], side, lambda a, b: E.box_iou(box(a), box(b)) >= thr)


@query("k04_nms", f"WITH RECURSIVE {greedy_sql('detections', ['frame_id', 'class'], 'det_id', 'score DESC, det_id', BOX4, iou_test(0.5))} SELECT f.frame_id, f.class, f.det_id, round(d.score,6) AS score FROM f JOIN detections d ON d.det_id=f.det_id WHERE owner=f.det_id")
def _(c):
    return nms(c, ["frame_id", "class"], 0.5).filter("kept").select("frame_id", "class", "det_id", "score")


@query("k05_ensemble_merge", f"""WITH RECURSIVE {greedy_sql('detections', ['frame_id'], 'det_id', 'score DESC, det_id', BOX4, iou_test(0.6))}
 SELECT f.frame_id, owner, round(max(d.score) FILTER (owner=f.det_id),6) AS score, list_sort(list(DISTINCT d.model)) AS support_models, count(*) AS members, CAST(count(DISTINCT d.model) AS INTEGER) AS support_count FROM f JOIN detections d ON d.det_id=f.det_id GROUP BY 1,2""")
def _(c):
    n = nms(c, ["frame_id"], 0.6)
    g = n.groupBy("frame_id", "owner").agg(F.max(F.when(C("kept"), C("score"))).alias("score"), F.array_sort(F.collect_set("model")).alias("support_models"), N().alias("members"))
    return g.withColumn("support_count", F.size("support_models"))


@query("k06_source_priority_dedup", f"""WITH RECURSIVE cb AS (SELECT *, x-rect_l/2 x0, y-rect_w/2 y0, x+rect_l/2 x1, y+rect_w/2 y1, CASE model WHEN 'F' THEN 4 WHEN 'O' THEN 3 ELSE 2 END AS src, conf+0.1*rect_w-0.5*rectangularity AS q, drive_id*1000+CAST(floor(x/200) AS BIGINT) AS gr FROM candidates),
 {greedy_sql('cb', ['gr'], 'cand_id', 'src DESC, q DESC, cand_id', BOX4, iou_test(0.25))} SELECT gr, cand_id, owner, owner=cand_id AS kept FROM f""")
def _(c):
    src = F.when(C("model") == "F", 4).when(C("model") == "O", 3).otherwise(2)
    d = c.candidates.withColumn("q", C("conf") + 0.1 * C("rect_w") - 0.5 * C("rectangularity")).withColumn("src", src)
    d = d.select("cand_id", (C("drive_id") * 1000 + F.floor(C("x") / 200)).alias("gr"), "x", "y", "src", "q", "rect_l", "rect_w")
    box = lambda f: E.make_box(f("x") - f("rect_l") / 2, f("y") - f("rect_w") / 2, f("x") + f("rect_l") / 2, f("y") + f("rect_w") / 2)
    k = GR.greedy_keep(d, "cand_id", ["gr"], [C("src"), C("q"), -C("cand_id")], 16.0, lambda a, b: E.box_iou(box(a), box(b)) >= 0.25)
    return k.select("gr", "cand_id", "owner", "kept")


@query("k07_median_size_representative", """WITH m AS (SELECT frame_id, median(rect_w) w, median(rect_l) l FROM candidates GROUP BY 1) SELECT c.frame_id, arg_min(cand_id, {'d': abs(rect_w-w)+abs(rect_l-l), 'i': cand_id}) AS cand_id, round(any_value(w),6) AS med_w, round(any_value(l),6) AS med_l FROM candidates c JOIN m ON m.frame_id=c.frame_id GROUP BY 1""")
def _(c):
    m = c.candidates.groupBy("frame_id").agg(F.percentile("rect_w", F.lit(.5)).alias("med_w"), F.percentile("rect_l", F.lit(.5)).alias("med_l"))
    d = F.abs(C("rect_w") - C("med_w")) + F.abs(C("rect_l") - C("med_l"))
    return c.candidates.join(m, "frame_id").groupBy("frame_id").agg(F.min_by("cand_id", F.struct(d.alias("d"), C("cand_id"))).alias("cand_id"), F.max("med_w").alias("med_w"), F.max("med_l").alias("med_l"))


@query("k08_near_final_clusters", """SELECT drive_id AS cluster, count(*) FILTER (geom_ok=1) AS hits_support, count(*) FILTER (stage2_added=1) AS stage2, count(*) AS hits_all FROM trace GROUP BY 1 HAVING count(*) FILTER (drift_flag=1)>3 ORDER BY 2 DESC, 3 DESC, 4 DESC, 1 LIMIT 10""")
def _(c):
    s = c.trace.groupBy(C("drive_id").alias("cluster")).agg(F.count_if(C("geom_ok") == 1).alias("hits_support"), F.count_if(C("stage2_added") == 1).alias("stage2"), N().alias("hits_all"), F.count_if(C("drift_flag") == 1).alias("d"))
    return s.filter("d > 3").drop("d").orderBy(F.desc("hits_support"), F.desc("stage2"), F.desc("hits_all"), "cluster").limit(10)


@query("k09_representative_drives", """WITH t AS (SELECT user_id, count(*) n, count(*) FILTER (event_type='click')/CAST(count(*) AS DOUBLE) cov FROM events GROUP BY 1), o AS (SELECT user_id, row_number() OVER (ORDER BY cov, n, user_id)-1 AS r, count(*) OVER () AS m FROM t), p AS (SELECT DISTINCT CAST(round_even(i*(m-1)/CAST(6 AS DOUBLE),0) AS BIGINT) AS r FROM o, (SELECT UNNEST(range(7)) AS i)) SELECT user_id AS drive_id, r AS position FROM o JOIN p USING (r)""")
def _(c):
    t = c.events.groupBy(C("user_id").alias("drive_id")).agg(N().alias("n"), (F.count_if(C("event_type") == "click") / N()).alias("cov"))
    o = O.dense_index(t, [], ["cov", "n", "drive_id"], F.floor(C("cov") * 64), "position")
    m = t.agg(N().alias("m"))
    p = m.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(6)), lambda i: F.bround(i * (C("m") - 1) / 6.0, 0).cast("long"))).alias("position")).distinct()
    return o.join(p, "position").select("drive_id", "position")


TRIAL = """tr AS (SELECT o_custkey AS trial, o_orderpriority AS arm, avg(o_totalprice/500009) AS c, avg((o_orderkey%100)/CAST(100 AS DOUBLE)) AS b, avg(o_orderkey%11) AS a, avg((o_custkey%5)/CAST(50 AS DOUBLE)) AS k FROM orders GROUP BY 1,2),
 sc AS (SELECT trial, bool_and(c>=0.2 AND b<=0.9 AND a<=9) AS ok, sum(c-0.25*b-0.01*a-0.5*k) AS score, min(a) AS tie FROM tr GROUP BY 1)"""


def trials(c):
    # shares have two digits and their mean may lie at the limit: they are summed as whole hundredths, so that no order of rows matters
    b = F.sum(F.round(C("b_rough") * 100).cast("long"))
    t = c.runs.groupBy(C("drive_id").alias("trial"), "arm").agg(F.avg("c_ratio").alias("c"), (b / F.count("b_rough") / 100).alias("b"), (b <= 90 * F.count("b_rough")).alias("b_ok"), F.avg("dangling_per_km").alias("a"), F.avg("conflict_rate").alias("k"))
    return t.groupBy("trial").agg(F.every((C("c") >= 0.2) & C("b_ok") & (C("a") <= 9)).alias("ok"), F.sum(C("c") - 0.25 * C("b") - 0.01 * C("a") - 0.5 * C("k")).alias("score"), F.min("a").alias("tie"))


@query("k10_leaderboard", f"WITH {TRIAL} SELECT trial, round(score,6) AS score, round(tie,6) AS tie FROM sc WHERE ok ORDER BY sc.score DESC, sc.tie, trial LIMIT 20")
def _(c):
    return trials(c).filter("ok").select("trial", "score", "tie").orderBy(F.desc("score"), "tie", "trial").limit(20)


@query("v05_trial_score", f"WITH {TRIAL} SELECT trial, ok, round(score,6)+0.0 AS score FROM sc")
def _(c):
    return trials(c).select("trial", "ok", "score")


@query("k11_top_per_module", "WITH s AS (SELECT p_brand AS module, p_partkey AS impl, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice-p_size DESC, p_partkey) AS rank FROM part WHERE p_size>5) SELECT module, impl, rank FROM s WHERE rank<=3")
def _(c):
    d = c.part.filter("p_size > 5").select(C("p_brand").alias("module"), C("p_partkey").alias("impl"), (C("p_retailprice") - C("p_size")).alias("s"))
    return top_per_group(d, ["module"], [F.desc("s"), C("impl")], 3).drop("s")
