"""Clustering, entity building, road graph and spatial cuts."""

from pyspark.sql import functions as F

from wayfold.functions import geometry as E, records as R
from wayfold.functions.stats import exact_percentiles, top_per_group
from wayfold.operators import clusters as K, components as CC, graph as GR, greedy, grid as G, joins as J, lines as L, ordered as O, shapes as S
from wayfold.operators.ordered import with_one_row
from wayfold.queries.catalog import C, query
from wayfold.queries.q_e_geometry import INSIDE, LINE, RING
from wayfold.queries.q_r_grid import BASE, BY, RES, cc_sql, near
from wayfold.queries.q_w_sequences import TURN, turns
from wayfold.session import checkpoint


def N():
    return F.count(F.lit(1))


def link_sql(nodes, key, cond, prefix=""):
    """SQL: smallest-key component labels of a pair condition over ``nodes``."""
    return f"""adj AS (SELECT a.{key} AS s, b.{key} AS d FROM {nodes} a JOIN {nodes} b ON a.{key}<>b.{key} AND {cond}),
 cc(id, label) USING KEY (id) AS (SELECT {key}, {key} FROM {nodes} UNION SELECT adj.d, min(cc.label) FROM cc JOIN adj ON adj.s=cc.id JOIN recurring.cc AS r ON r.id=adj.d WHERE cc.label < r.label GROUP BY adj.d)"""


DIST15 = "a.drive_id=b.drive_id AND a.x BETWEEN b.x-15 AND b.x+15 AND sqrt(pow(a.x-b.x,2)+pow(a.y-b.y,2))<=15"


def clustered(c):
    return CC.centroid_clusters(c.candidates, "cand_id", 15.0, ["drive_id"])


@query("g01_centroid_clusters", f"WITH RECURSIVE {link_sql('candidates', 'cand_id', DIST15)} SELECT c.drive_id, cand_id, label FROM candidates c JOIN cc ON cc.id=c.cand_id")
def _(c):
    return clustered(c).select("drive_id", "cand_id", "label")


BX = """bx AS (SELECT *, rect_l/2*abs(cos(radians(angle)))+rect_w/2*abs(sin(radians(angle))) AS hx, rect_l/2*abs(sin(radians(angle)))+rect_w/2*abs(cos(radians(angle))) AS hy FROM candidates),
 cb AS (SELECT *, x-hx AS x0, y-hy AS y0, x+hx AS x1, y+hy AS y1 FROM bx)"""
PAIR_BOX = """greatest(least(a.x1,b.x1)-greatest(a.x0,b.x0),0)*greatest(least(a.y1,b.y1)-greatest(a.y0,b.y0),0)"""
G2COND = f"""a.x BETWEEN b.x-12 AND b.x+12 AND sqrt(pow(a.x-b.x,2)+pow(a.y-b.y,2))<=12 AND least(abs(a.angle-b.angle)%180,180-abs(a.angle-b.angle)%180)<=40 AND ({PAIR_BOX} >= 0.2*((a.x1-a.x0)*(a.y1-a.y0)+(b.x1-b.x0)*(b.y1-b.y0)-{PAIR_BOX}) OR sqrt(pow(greatest(a.x0-b.x1,b.x0-a.x1,0),2)+pow(greatest(a.y0-b.y1,b.y0-a.y1,0),2))<=3.0)"""


def boxed(c):
    b = E.bbox(RING())
    return c.candidates.withColumn("b", b).select("cand_id", "drive_id", "x", "y", "angle", "rect_l", "conf", C("b.minx").alias("x0"), C("b.miny").alias("y0"), C("b.maxx").alias("x1"), C("b.maxy").alias("y1"))


def near_test(a, b):
    box = lambda f: E.make_box(f("x0"), f("y0"), f("x1"), f("y1"))
    gap = F.hypot(F.greatest(a("x0") - b("x1"), b("x0") - a("x1"), F.lit(0.0)), F.greatest(a("y0") - b("y1"), b("y0") - a("y1"), F.lit(0.0)))
    return (F.hypot(a("x") - b("x"), a("y") - b("y")) <= 12) & (E.angle_diff_180(a("angle"), b("angle")) <= 40) & ((E.box_iou(box(a), box(b)) >= 0.2) | (gap <= 3.0))


@query("g02_candidate_clusters", f"WITH RECURSIVE {BX}, {link_sql('cb', 'cand_id', 'a.drive_id=b.drive_id AND ' + G2COND)} SELECT cand_id, label FROM cb JOIN cc ON cc.id=cand_id")
def _(c):
    return K.predicate_components(boxed(c), "cand_id", ["drive_id"], 12.0, near_test).select("cand_id", "label")


@query("g02_clusters_across_drives", f"WITH RECURSIVE {BX}, {link_sql('cb', 'cand_id', G2COND)} SELECT cand_id, label FROM cb JOIN cc ON cc.id=cand_id")
def _(c):
    return K.predicate_components(boxed(c), "cand_id", [], 12.0, near_test).select("cand_id", "label")


STRIPE = "a.x BETWEEN b.x-9 AND b.x+9 AND least(abs(a.angle-b.angle)%180,180-abs(a.angle-b.angle)%180)<=25 AND sqrt(pow(greatest(a.x0-b.x1,b.x0-a.x1,0),2)+pow(greatest(a.y0-b.y1,b.y0-a.y1,0),2))<=1.5 AND abs(a.rect_l-b.rect_l)/greatest(a.rect_l,b.rect_l)<=0.6137"


def stripe_test(a, b):
    gap = F.hypot(F.greatest(a("x0") - b("x1"), b("x0") - a("x1"), F.lit(0.0)), F.greatest(a("y0") - b("y1"), b("y0") - a("y1"), F.lit(0.0)))
    return (E.angle_diff_180(a("angle"), b("angle")) <= 25) & (gap <= 1.5) & (F.abs(a("rect_l") - b("rect_l")) / F.greatest(a("rect_l"), b("rect_l")) <= 0.6137)


def stripe_clusters(c):
    # boxes are at most 11 m long, so touching ones have centres within 12.5 m
    return K.predicate_components(boxed(c), "cand_id", ["drive_id"], 12.5, stripe_test)


STRIPE_SQL = STRIPE.replace("b.x-9 AND b.x+9", "b.x-12.5 AND b.x+12.5")


@query("g03_stripe_clusters", f"WITH RECURSIVE {BX}, {link_sql('cb', 'cand_id', 'a.drive_id=b.drive_id AND ' + STRIPE_SQL)} SELECT cand_id, label FROM cb JOIN cc ON cc.id=cand_id")
def _(c):
    return stripe_clusters(c).select("cand_id", "label")


@query("x33_stripes_to_crosswalk", f"""WITH RECURSIVE {BX}, {link_sql('cb', 'cand_id', 'a.drive_id=b.drive_id AND ' + STRIPE_SQL)}, g AS (SELECT label, count(*) n, avg(conf) s, max(x1)-min(x0) w, max(y1)-min(y0) h FROM cb JOIN cc ON cc.id=cand_id GROUP BY 1)
 SELECT label, n AS stripes, round(s,6) AS mean_score, round(w,6) AS width, round(h,6) AS height FROM g WHERE n>=3 AND s>=0.3137 AND greatest(w,h)<=60""")
def _(c):
    g = stripe_clusters(c).groupBy("label").agg(N().alias("stripes"), F.avg("conf").alias("mean_score"), (F.max("x1") - F.min("x0")).alias("width"), (F.max("y1") - F.min("y0")).alias("height"))
    return g.filter((C("stripes") >= 3) & (C("mean_score") >= 0.3137) & (F.greatest("width", "height") <= 60))


def bucketed(c):
    """Line endpoints with their junction bucket and snap tolerance."""
    return c.candidates.select("cand_id", F.floor(C("frame_id") / 2).alias("bucket"), "x", "y", F.when(C("drive_id") % 2 == 0, 40.0).otherwise(25.0).alias("tol"))


RUNC = """p AS (SELECT cand_id, frame_id//2 AS bucket, x, y, CASE WHEN drive_id%2=0 THEN 40.0::DOUBLE ELSE 25.0 END AS tol, row_number() OVER (PARTITION BY frame_id//2 ORDER BY cand_id) AS r FROM candidates),
 f AS (SELECT bucket, r, cand_id, cand_id AS centre, 0.0::DOUBLE AS snap, [{'i': cand_id, 'x': x, 'y': y}] AS cs FROM p WHERE r=1
  UNION ALL SELECT bucket, r, cand_id, CASE WHEN b.d<=tol THEN b.i ELSE cand_id END, CASE WHEN b.d<=tol THEN b.d ELSE 0 END, CASE WHEN b.d<=tol THEN list_transform(cs, lambda k: CASE WHEN k.i=b.i THEN {'i': k.i, 'x': (k.x+x)/2, 'y': (k.y+y)/2} ELSE k END) ELSE list_append(cs, {'i': cand_id, 'x': x, 'y': y}) END
  FROM (SELECT p.*, f.cs, list_min(list_transform(f.cs, lambda k: {'d': sqrt(pow(k.x-p.x,2)+pow(k.y-p.y,2)), 'i': k.i})) AS b FROM f JOIN p ON p.bucket=f.bucket AND p.r=f.r+1))"""


@query("g04_running_centroids_g16_bucket_snap", f"WITH RECURSIVE {RUNC} SELECT bucket, cand_id, centre, round(snap,6) AS snap FROM f")
def _(c):
    return K.running_centroids(bucketed(c), "cand_id", ["bucket"], "cand_id", "tol", 40.0).select("bucket", "cand_id", "centre", "snap")


def lead_test(a, b):
    return (F.hypot(a("x") - b("x"), a("y") - b("y")) <= 30.0) & (E.angle_diff_180(a("angle"), b("angle")) <= 60.0)


def leaders(c):
    d = c.candidates.select("cand_id", F.floor(C("frame_id") / 3).alias("win"), "frame_id", "x", "y", "angle")
    return K.leader_clusters(d, "cand_id", ["win"], "frame_id", 30.0, lead_test, lambda a, b: F.hypot(a("x") - b("x"), a("y") - b("y")))


LEAD = """p AS (SELECT cand_id, frame_id//3 AS win, frame_id, x, y, angle, row_number() OVER (PARTITION BY frame_id//3 ORDER BY frame_id, cand_id) AS r FROM candidates),
 f AS (SELECT win, r, cand_id, cand_id AS leader, [{'i': cand_id, 'x': x, 'y': y, 'a': angle}] AS cs FROM p WHERE r=1 UNION ALL SELECT win, r, cand_id, coalesce(b.i, cand_id), CASE WHEN b.i IS NOT NULL THEN cs ELSE list_append(cs, {'i': cand_id, 'x': x, 'y': y, 'a': angle}) END
  FROM (SELECT p.*, f.cs, list_min(list_transform(list_filter(f.cs, lambda k: sqrt(pow(k.x-p.x,2)+pow(k.y-p.y,2))<=30 AND least(abs(k.a-p.angle)%180,180-abs(k.a-p.angle)%180)<=60), lambda k: {'d': sqrt(pow(k.x-p.x,2)+pow(k.y-p.y,2)), 'i': k.i})) AS b FROM f JOIN p ON p.win=f.win AND p.r=f.r+1))"""


@query("g05_leader_clusters", f"WITH RECURSIVE {LEAD} SELECT win, cand_id, leader FROM f")
def _(c):
    return leaders(c).select("win", "cand_id", "leader")


@query("g05_merge_support_counts", f"WITH RECURSIVE {LEAD}, s AS (SELECT leader, count(DISTINCT p.frame_id) AS k FROM f JOIN p USING (cand_id) GROUP BY 1) SELECT CASE WHEN k<2 THEN 'min_support' ELSE 'kept' END AS reason, count(*) AS n FROM s GROUP BY 1")
def _(c):
    s = leaders(c).groupBy("leader").agg(F.countDistinct("frame_id").alias("k"))
    return s.groupBy(F.when(C("k") < 2, "min_support").otherwise("kept").alias("reason")).agg(N().alias("n"))


@query("x47_canonical_merge_with_shapes", f"WITH RECURSIVE {LEAD} SELECT leader, count(*) AS members, count(DISTINCT p.frame_id) AS frames, round(sum(c.rect_l*c.rect_w),6) AS area, min(p.frame_id) AS first_frame FROM f JOIN p USING (cand_id) JOIN candidates c USING (cand_id) GROUP BY 1 HAVING count(DISTINCT p.frame_id)>=2")
def _(c):
    raw = c.candidates.select("cand_id", (C("rect_l") * C("rect_w")).alias("a"))
    j = leaders(c).join(raw, "cand_id").groupBy("leader").agg(N().alias("members"), F.countDistinct("frame_id").alias("frames"), F.sum("a").alias("area"), F.min("frame_id").alias("first_frame"))
    return j.filter("frames >= 2")


DB = """nb AS (SELECT a.cand_id, count(*) AS k FROM candidates a JOIN candidates b ON a.drive_id=b.drive_id AND a.x BETWEEN b.x-20 AND b.x+20 AND sqrt(pow(a.x-b.x,2)+pow(a.y-b.y,2))<=20 GROUP BY 1), core AS (SELECT c.* FROM candidates c JOIN nb USING (cand_id) WHERE k>=4)"""


@query("g06_dbscan", f"""WITH RECURSIVE {DB}, {link_sql('core', 'cand_id', DIST15.replace('15', '20'))}, bd AS (SELECT c.cand_id, min(cc.label) AS label FROM candidates c ANTI JOIN core USING (cand_id) JOIN core k ON k.drive_id=c.drive_id AND abs(k.x-c.x)<=20 AND sqrt(pow(k.x-c.x,2)+pow(k.y-c.y,2))<=20 JOIN cc ON cc.id=k.cand_id GROUP BY 1)
 SELECT c.cand_id, coalesce(cc.label, bd.label) AS label, cc.label IS NOT NULL AS is_core FROM candidates c LEFT JOIN cc ON cc.id=c.cand_id LEFT JOIN bd ON bd.cand_id=c.cand_id""")
def _(c):
    return CC.dbscan(c.candidates, "cand_id", 20.0, 4, ["drive_id"]).select("cand_id", "label", "is_core")


@query("g06_largest_cluster", f"""WITH RECURSIVE {DB}, {link_sql('core', 'cand_id', DIST15.replace('15', '20'))}, bd AS (SELECT c.cand_id, min(cc.label) AS label FROM candidates c ANTI JOIN core USING (cand_id) JOIN core k ON k.drive_id=c.drive_id AND abs(k.x-c.x)<=20 AND sqrt(pow(k.x-c.x,2)+pow(k.y-c.y,2))<=20 JOIN cc ON cc.id=k.cand_id GROUP BY 1),
 a AS (SELECT drive_id, coalesce(cc.label, bd.label) AS label, count(*) AS n FROM candidates c LEFT JOIN cc ON cc.id=c.cand_id LEFT JOIN bd ON bd.cand_id=c.cand_id WHERE coalesce(cc.label, bd.label) IS NOT NULL GROUP BY 1,2) SELECT drive_id, arg_max(label, {{'n': n, 'l': -label}}) AS label, max(n) AS n FROM a GROUP BY 1""")
def _(c):
    a = CC.dbscan(c.candidates, "cand_id", 20.0, 4, ["drive_id"]).filter("label is not null").groupBy("drive_id", "label").agg(N().alias("n"))
    return a.groupBy("drive_id").agg(F.max_by("label", F.struct("n", (-C("label")).alias("l"))).alias("label"), F.max("n").alias("n"))


@query("g07_buffer_union_clusters", f"""WITH RECURSIVE cl AS (SELECT DISTINCT drive_id, CAST(floor(x/5.0) AS BIGINT) AS ix, CAST(floor(y/5.0) AS BIGINT) AS iy FROM candidates), o AS (SELECT UNNEST(range(-1,2)) AS d), dl AS (SELECT DISTINCT drive_id, ix+a.d AS ix, iy+b.d AS iy FROM cl, o a, o b),
 {cc_sql('dl', False).replace('100000000', '1000000000000').replace('10000 +', '1000000 +')}, z AS (SELECT drive_id, label, count(*) AS n FROM msk JOIN cc USING (id) GROUP BY 1,2) SELECT drive_id, n AS cells, count(*) AS clusters FROM z GROUP BY 1,2""")
def _(c):
    cells = G.dilate(G.with_cell(c.candidates, 5.0).select("drive_id", "ix", "iy"), 1, ["drive_id"])
    return G.area_components(cells, 5.0, ["drive_id"], False).groupBy("drive_id", "cells").agg(N().alias("clusters"))


LINES = """ln AS (SELECT cand_id, drive_id, x, y, angle, rect_l, x-rect_l/2*cos(radians(angle)) ax, y-rect_l/2*sin(radians(angle)) ay, x+rect_l/2*cos(radians(angle)) bx, y+rect_l/2*sin(radians(angle)) by_ FROM candidates)"""
ENDGAP = "least(sqrt(pow(a.ax-b.ax,2)+pow(a.ay-b.ay,2)), sqrt(pow(a.ax-b.bx,2)+pow(a.ay-b.by_,2)), sqrt(pow(a.bx-b.ax,2)+pow(a.by_-b.ay,2)), sqrt(pow(a.bx-b.bx,2)+pow(a.by_-b.by_,2)))"
LCOND = f"a.drive_id=b.drive_id AND a.x BETWEEN b.x-14 AND b.x+14 AND least(abs(a.angle-b.angle)%180,180-abs(a.angle-b.angle)%180)<=30 AND (sqrt(pow(a.x-b.x,2)+pow(a.y-b.y,2))<=6 OR {ENDGAP}<=4)"


def center_lines(c):
    l, t = C("rect_l") / 2, F.radians("angle")
    return c.candidates.select("cand_id", "drive_id", "x", "y", "angle", "rect_l", (C("x") - l * F.cos(t)).alias("ax"), (C("y") - l * F.sin(t)).alias("ay"),
                               (C("x") + l * F.cos(t)).alias("bx"), (C("y") + l * F.sin(t)).alias("by_"))


def line_test(a, b):
    d = lambda p, q, r, s: F.hypot(a(p) - b(r), a(q) - b(s))
    gap = F.least(d("ax", "ay", "ax", "ay"), d("ax", "ay", "bx", "by_"), d("bx", "by_", "ax", "ay"), d("bx", "by_", "bx", "by_"))
    return (E.angle_diff_180(a("angle"), b("angle")) <= 30) & ((F.hypot(a("x") - b("x"), a("y") - b("y")) <= 6) | (gap <= 4))


@query("g08_line_aggregation", f"WITH RECURSIVE {LINES}, {link_sql('ln', 'cand_id', LCOND)} SELECT label, count(*) AS lines, round(sum(rect_l),6) AS length, max(cand_id) AS last_member FROM ln JOIN cc ON cc.id=cand_id GROUP BY 1 HAVING sum(rect_l)>=8")
def _(c):
    # lines are at most 10 m long, so ends within 4 m put the middles within 14 m
    k = K.predicate_components(center_lines(c), "cand_id", ["drive_id"], 14.0, line_test)
    return k.groupBy("label").agg(N().alias("lines"), F.sum("rect_l").alias("length"), F.max("cand_id").alias("last_member")).filter("length >= 8")


ENT = f"""{link_sql('candidates', 'cand_id', DIST15)}, m AS (SELECT c.*, label FROM candidates c JOIN cc ON cc.id=c.cand_id), pv AS (SELECT label, string_agg(model||':'||k, ',' ORDER BY model) AS provider_hits FROM (SELECT label, model, CAST(count(*) AS VARCHAR) k FROM m GROUP BY 1,2) GROUP BY 1),
 en AS (SELECT drive_id, label, count(DISTINCT frame_id) AS frames_hit, count(*) AS members, median(angle) AS heading, avg(x) AS cx, avg(y) AS cy FROM m GROUP BY 1,2)"""


@query("g09_entities", f"""WITH RECURSIVE {ENT}, px AS (SELECT label, count(DISTINCT p.frame_id) AS k FROM en JOIN poses p ON p.drive_id=en.drive_id AND pow(cx-p.x,2)+pow(cy-p.y,2)<=400.0 GROUP BY 1), f AS (SELECT en.*, CASE WHEN frames_hit<2 THEN coalesce(k,0) ELSE frames_hit END AS hits FROM en LEFT JOIN px USING (label))
 SELECT drive_id, f.label, hits AS frames_hit, members, round(heading,6) AS heading, round(cx,6) AS cx, round(cy,6) AS cy, provider_hits FROM f JOIN pv ON pv.label=f.label WHERE hits>=2""")
def _(c):
    e = K.entities(clustered(c), ["drive_id", "label"])
    p = c.poses.select("drive_id", C("frame_id").alias("pf"), C("x").alias("rx"), C("y").alias("ry"))
    near_ = J.within(e.select("drive_id", "label", C("cx").alias("x"), C("cy").alias("y")), p, 20.0, ["drive_id"]).groupBy("label").agg(F.countDistinct("pf").alias("k"))
    j = e.join(near_, "label", "left").withColumn("frames_hit", F.when(C("frames_hit") < 2, F.coalesce("k", F.lit(0))).otherwise(C("frames_hit")))
    return j.drop("k").filter("frames_hit >= 2")


# drive 5 has no trajectory here
BND = f"""{LINE.replace("FROM poses WINDOW", "FROM poses WHERE drive_id<>5 WINDOW")}, fb AS (SELECT drive_id, CAST(floor(s/300) AS BIGINT) AS k, min(frame_id) AS f FROM sl GROUP BY 1,2), tg AS (SELECT drive_id, frame_id, s, x, y, coalesce(nx,x)-coalesce(px,x) dx, coalesce(ny,y)-coalesce(py,y) dy FROM sl),
 bd AS (SELECT fb.drive_id, row_number() OVER (PARTITION BY fb.drive_id ORDER BY k)-1 AS b, s AS bs, x AS bx, y AS by_, dx/sqrt(dx*dx+dy*dy) AS vx, dy/sqrt(dx*dx+dy*dy) AS vy FROM fb JOIN tg ON tg.drive_id=fb.drive_id AND tg.frame_id=fb.f WHERE k>=1),
 ns AS (SELECT p.drive_id, p.x, p.y, q.s AS s FROM points p, LATERAL (SELECT s FROM sl WHERE sl.drive_id=p.drive_id ORDER BY (sl.x-p.x)*(sl.x-p.x)+(sl.y-p.y)*(sl.y-p.y), frame_id LIMIT 1) q),
 p0 AS (SELECT ns.*, (SELECT count(*) FROM bd WHERE bd.drive_id=ns.drive_id AND bs<=ns.s) AS part FROM ns UNION ALL SELECT drive_id, x, y, NULL, -1 FROM points WHERE drive_id NOT IN (SELECT drive_id FROM sl))"""


def cut_line(c):
    """Trajectory vertices with the part they lie in, and the boundaries between parts, numbered along each drive.

    A part starts at the first vertex of every 300 m that has one, so a vertex's part is the rank of its stretch: no vertex
    meets more than its own boundary.
    """
    line = L.arc_length(c.poses.filter("drive_id <> 5").select("drive_id", C("frame_id").alias("idx"), "x", "y"), ["drive_id"], "idx").withColumn("k", F.floor(C("s") / 300).cast("long"))
    first = line.groupBy("drive_id", "k").agg(F.min("idx").alias("idx"))
    ranked = checkpoint(O.dense_index(first.filter("k >= 1"), ["drive_id"], ["k"], F.floor(C("k") / O.CHUNK), "b"))
    last = ranked.groupBy("drive_id").agg((F.max("b") + 1).alias("parts"))
    line = checkpoint(line.join(ranked.select("drive_id", "k", "b"), ["drive_id", "k"], "left").join(last, "drive_id", "left")
                      .select("drive_id", "idx", "x", "y", F.coalesce(C("b") + 1, F.lit(0)).alias("part"), F.coalesce("parts", F.lit(0)).alias("parts")))
    bounds = L.tangents(line.select("drive_id", "idx", "x", "y"), ["drive_id"], "idx").join(ranked.select("drive_id", "idx", "b"), ["drive_id", "idx"])
    return line, checkpoint(bounds.select("drive_id", "b", "x", "y", "tx", "ty"))


def parted(c, line):
    near_ = J.nearest(c.points.select("drive_id", "x", "y"), line.withColumnRenamed("idx", "frame_id"), ["frame_id", "part", "parts"], ["drive_id"], 32.0)
    return near_.select("drive_id", "x", "y", F.coalesce("near_part", F.lit(-1)).cast("int").alias("part"), C("near_parts").cast("int").alias("parts"))


def cut_parts(c):
    """Points with the spatial-cut part of their nearest trajectory vertex; -1: there is no trajectory."""
    return parted(c, cut_line(c)[0])


@query("g10_spatial_cut", f"WITH {BND} SELECT drive_id, CAST(part AS INTEGER) AS part, count(*) AS n FROM p0 GROUP BY 1,2")
def _(c):
    return cut_parts(c).groupBy("drive_id", "part").agg(N().alias("n"))


def refined(c, band):
    """Inside the band of a boundary its half-plane decides, boundary by boundary; a point meets those of the cells around it."""
    def step(a, b):
        near_ = F.hypot(C("x") - b["x"], C("y") - b["y"]) < band
        ahead = (C("x") - b["x"]) * b["tx"] + (C("y") - b["y"]) * b["ty"] >= 0
        one = lambda cond: F.when(cond, 1).otherwise(0)
        at_b = (a["part"] == b["b"]) & near_
        mid = a["part"] + one(at_b & ahead)
        at_f = (mid == b["b"] + 1) & near_
        return F.struct((mid - one(at_f & ~ahead)).alias("part"), (a["checked"] + one(at_b) + one(at_f)).alias("checked"), (a["flipped"] + one(at_b & ahead) + one(at_f & ~ahead)).alias("flipped"))

    line, bounds = cut_line(c)
    near_ = J.around(bounds.withColumn("b", C("b").cast("int")), band).groupBy("drive_id", "_gx", "_gy").agg(F.array_sort(F.collect_list(F.struct("b", "x", "y", "tx", "ty"))).alias("near"))
    z = F.lit(0)
    start = F.struct(C("part").alias("part"), z.alias("checked"), z.alias("flipped"))
    p = parted(c, line).withColumn("_gx", J._cell("x", band)).withColumn("_gy", J._cell("y", band)).join(near_, ["drive_id", "_gx", "_gy"], "left")
    p = p.withColumn("r", F.when(C("near").isNull(), start).otherwise(F.aggregate("near", start, step)))
    part = F.when(C("part") < 0, C("part")).otherwise(F.least(F.greatest(C("r.part"), z), C("parts")))
    return p.select("drive_id", "x", "y", part.alias("part"), C("r.checked").alias("checked"), C("r.flipped").alias("flipped"))


CUT = f"""{BND}, st AS (SELECT drive_id, x, y, 0 AS i, part, 0 AS checked, 0 AS flipped FROM p0 UNION ALL SELECT drive_id, x, y, i+1, CASE WHEN m=i+1 AND nr AND NOT ah THEN m-1 ELSE m END, checked+(CASE WHEN part=i AND nr THEN 1 ELSE 0 END)+(CASE WHEN m=i+1 AND nr THEN 1 ELSE 0 END), flipped+(CASE WHEN part=i AND nr AND ah THEN 1 ELSE 0 END)+(CASE WHEN m=i+1 AND nr AND NOT ah THEN 1 ELSE 0 END)
  FROM (SELECT *, CASE WHEN part=i AND nr AND ah THEN part+1 ELSE part END AS m FROM (SELECT st.*, sqrt(pow(st.x-bx,2)+pow(st.y-by_,2))<60 AS nr, (st.x-bx)*vx+(st.y-by_)*vy>=0 AS ah FROM st JOIN bd ON bd.drive_id=st.drive_id AND bd.b=st.i))),
 nb AS (SELECT drive_id, count(*) AS k FROM bd GROUP BY 1), fin AS (SELECT st.* FROM st LEFT JOIN nb ON nb.drive_id=st.drive_id WHERE i=coalesce(k,0))"""


@query("g11_boundary_refine_g12_parts_g13_stats", f"WITH RECURSIVE {CUT} SELECT drive_id, CAST(part AS INTEGER) AS part, count(*) AS n, CAST(sum(checked) AS BIGINT) AS checked, CAST(sum(flipped) AS BIGINT) AS flipped FROM fin GROUP BY 1,2")
def _(c):
    return refined(c, 60.0).groupBy("drive_id", "part").agg(N().alias("n"), F.sum("checked").alias("checked"), F.sum("flipped").alias("flipped"))


@query("g12_no_duplicate_total", f"WITH RECURSIVE {CUT}, t AS (SELECT (SELECT count(*) FROM points) AS points, (SELECT count(*) FROM fin) AS written) SELECT points, written, points=written AS ok FROM t")
def _(c):
    w = refined(c, 60.0).groupBy("drive_id", "part").agg(N().alias("n")).agg(F.sum("n").alias("written"))
    return with_one_row(c.points.agg(N().alias("points")), w).withColumn("ok", C("points") == C("written"))


NODEXY = "en AS (SELECT edge_id, drive_id, highway, length_m, from_node*2.0::DOUBLE+(edge_id%3)*0.2::DOUBLE ax, CAST((from_node*17)%50 AS DOUBLE) ay, to_node*2.0::DOUBLE bx, CAST((to_node*17)%50 AS DOUBLE)+(edge_id%4)*0.2::DOUBLE by_ FROM edges)"


def edge_lines(c):
    f, t, i = C("from_node"), C("to_node"), C("edge_id")
    return c.edges.select("edge_id", "drive_id", "highway", "length_m", (f * F.lit(2.0) + i % 3 * F.lit(0.2)).alias("ax"), (f * 17 % 50).cast("double").alias("ay"),
                          (t * F.lit(2.0)).alias("bx"), ((t * 17 % 50).cast("double") + i % 4 * F.lit(0.2)).alias("by_"))


def snapped(c):
    return GR.snap_endpoints(GR.endpoints(edge_lines(c)), 0.55)


SNAPQ = f"""{NODEXY}, ep AS (SELECT edge_id, side, CASE side WHEN 0 THEN ax ELSE bx END AS x, CASE side WHEN 0 THEN ay ELSE by_ END AS y, edge_id*2+side AS end_id FROM en, (VALUES (0),(1)) AS q(side)),
 {link_sql('ep', 'end_id', 'a.x BETWEEN b.x-0.55 AND b.x+0.55 AND sqrt(pow(a.x-b.x,2)+pow(a.y-b.y,2))<=0.55')}, g AS (SELECT ep.*, label AS grp, row_number() OVER (PARTITION BY label ORDER BY end_id) AS r FROM ep JOIN cc ON cc.id=end_id),
 f AS (SELECT grp, r, end_id, end_id AS node_id, [{{'i': end_id, 'x': x, 'y': y}}] AS ks FROM g WHERE r=1 UNION ALL SELECT g.grp, g.r, g.end_id, coalesce(h.i, g.end_id), CASE WHEN h.i IS NOT NULL THEN ks ELSE list_append(ks, {{'i': g.end_id, 'x': g.x, 'y': g.y}}) END FROM (SELECT g.*, ks, list_filter(ks, lambda k: sqrt(pow(k.x-g.x,2)+pow(k.y-g.y,2))<=0.55)[1] AS h FROM f JOIN g ON g.grp=f.grp AND g.r=f.r+1) g),
 np AS (SELECT edge_id, max(node_id) FILTER (side=0) AS from_node, max(node_id) FILTER (side=1) AS to_node FROM f JOIN ep USING (end_id) GROUP BY 1)"""


@query("g14_snapped_junctions", f"""WITH RECURSIVE {SNAPQ}, bo AS (SELECT from_node AS node_id, to_node AS nbr, edge_id FROM np WHERE from_node<>to_node UNION ALL SELECT to_node, from_node, edge_id FROM np WHERE from_node<>to_node)
 SELECT node_id, count(DISTINCT nbr) AS degree, count(DISTINCT bo.edge_id) AS incident, list_sort(list(DISTINCT highway)) AS kinds FROM bo JOIN edges e ON e.edge_id=bo.edge_id GROUP BY 1 HAVING count(DISTINCT nbr)>=3""")
def _(c):
    p = GR.node_pairs(snapped(c)).join(c.edges.select("edge_id", "highway"), "edge_id")
    return GR.junctions(p, 3, "highway")


@query("g17_edge_build", f"""WITH RECURSIVE {SNAPQ}, d AS (SELECT f.end_id, f.node_id, ep.edge_id, ep.side, sqrt(pow(ep.x-k.x,2)+pow(ep.y-k.y,2)) AS snap FROM f JOIN ep USING (end_id) JOIN ep k ON k.end_id=f.node_id),
 e AS (SELECT edge_id, max(node_id) FILTER (side=0) a0, max(node_id) FILTER (side=1) a1, max(snap) FILTER (side=0) d0, max(snap) FILTER (side=1) d1 FROM d GROUP BY 1)
 SELECT edge_id, CASE WHEN a0=a1 AND NOT d1>=d0 THEN -(edge_id*2+1) ELSE a0 END AS from_node, CASE WHEN a0=a1 AND d1>=d0 THEN -(edge_id*2+2) ELSE a1 END AS to_node, a0=a1 AS split, CAST((CASE WHEN d0>0 THEN 1 ELSE 0 END)+(CASE WHEN d1>0 THEN 1 ELSE 0 END) AS BIGINT) AS snap_actions FROM e""")
def _(c):
    s = snapped(c)
    at = s.filter("end_id = node_id").select("node_id", C("x").alias("kx"), C("y").alias("ky"))
    d = s.join(at, "node_id").withColumn("snap", F.hypot(C("x") - C("kx"), C("y") - C("ky")))
    pick = lambda v, k: F.max(F.when(C("side") == k, C(v)))
    e = d.groupBy("edge_id").agg(pick("node_id", 0).alias("a0"), pick("node_id", 1).alias("a1"), pick("snap", 0).alias("d0"), pick("snap", 1).alias("d1"))
    loop, last = C("a0") == C("a1"), C("d1") >= C("d0")
    one = lambda cond: F.when(cond, 1).otherwise(0)
    return e.select("edge_id", F.when(loop & ~last, -(C("edge_id") * 2 + 1)).otherwise(C("a0")).alias("from_node"), F.when(loop & last, -(C("edge_id") * 2 + 2)).otherwise(C("a1")).alias("to_node"),
                    loop.alias("split"), (one(C("d0") > 0) + one(C("d1") > 0)).cast("long").alias("snap_actions"))


WALLS = """w AS (SELECT prior_id, minx ax, miny ay, maxx bx, miny by_ FROM priors UNION ALL SELECT prior_id, maxx, miny, maxx, maxy FROM priors UNION ALL SELECT prior_id, maxx, maxy, minx, maxy FROM priors UNION ALL SELECT prior_id, minx, maxy, minx, miny FROM priors)"""


@query("g15_split_lines_by_boxes", f"""WITH {LINE}, {WALLS}, h AS (SELECT drive_id, frame_id, ((ax-x)*(by_-ay)-(ay-y)*(bx-ax))/nullif((nx-x)*(by_-ay)-(ny-y)*(bx-ax),0) AS t, ((ax-x)*(ny-y)-(ay-y)*(nx-x))/nullif((nx-x)*(by_-ay)-(ny-y)*(bx-ax),0) AS u FROM sg JOIN w ON nx IS NOT NULL AND least(x,nx)<=greatest(ax,bx) AND greatest(x,nx)>=least(ax,bx) AND least(y,ny)<=greatest(ay,by_) AND greatest(y,ny)>=least(ay,by_))
 SELECT drive_id, count(*) AS cuts, round(sum(t),5) AS t_sum FROM (SELECT DISTINCT drive_id, frame_id, round(t,9) AS t FROM h WHERE t>0 AND t<1 AND u BETWEEN 0 AND 1) GROUP BY 1""")
def _(c):
    seg = L.segments(c.poses.select("drive_id", C("frame_id").alias("idx"), "x", "y"), ["drive_id"], "idx")
    s = seg.select(F.struct("drive_id", "idx").alias("sid"), "x", "y", "n_x", "n_y")
    span = lambda d, a, b, g: d.withColumn(g, F.explode(F.sequence(J._cell(F.least(a, b), 32.0), J._cell(F.greatest(a, b), 32.0))))
    s = span(span(s, C("x"), C("n_x"), "_gx"), C("y"), C("n_y"), "_gy")
    w = L.box_walls(c.priors)
    w = span(span(w, C("ax"), C("bx"), "_gx"), C("ay"), C("by_"), "_gy")
    j = s.join(w, ["_gx", "_gy"])
    dx, dy, sx, sy = C("n_x") - C("x"), C("n_y") - C("y"), C("bx") - C("ax"), C("by_") - C("ay")
    den = dx * sy - dy * sx
    t = F.when(den != 0, ((C("ax") - C("x")) * sy - (C("ay") - C("y")) * sx) / den)
    u = F.when(den != 0, ((C("ax") - C("x")) * dy - (C("ay") - C("y")) * dx) / den)
    cuts = j.select("sid", F.round(t, 9).alias("t"), u.alias("u")).filter((C("t") > 0) & (C("t") < 1) & C("u").between(0, 1)).select("sid", "t").distinct()
    return cuts.groupBy(C("sid.drive_id").alias("drive_id")).agg(N().alias("cuts"), F.round(F.sum("t"), 5).alias("t_sum"))


@query("g15_cut_lines", f"""WITH {LINE}, {WALLS}, h AS (SELECT drive_id, frame_id, s, ns, ((ax-x)*(by_-ay)-(ay-y)*(bx-ax))/nullif((nx-x)*(by_-ay)-(ny-y)*(bx-ax),0) AS t, ((ax-x)*(ny-y)-(ay-y)*(nx-x))/nullif((nx-x)*(by_-ay)-(ny-y)*(bx-ax),0) AS u FROM sg JOIN w ON nx IS NOT NULL AND least(x,nx)<=greatest(ax,bx) AND greatest(x,nx)>=least(ax,bx) AND least(y,ny)<=greatest(ay,by_) AND greatest(y,ny)>=least(ay,by_)),
 k AS (SELECT DISTINCT drive_id, frame_id, round(t,9) AS t FROM h WHERE t>0 AND t<1 AND u BETWEEN 0 AND 1),
 ev AS (SELECT drive_id, frame_id, 0.0::DOUBLE AS t, false AS cut FROM vt UNION ALL SELECT drive_id, frame_id, t, true FROM k),
 nu AS (SELECT ev.*, count(*) FILTER (cut) OVER (PARTITION BY drive_id ORDER BY frame_id, t ROWS UNBOUNDED PRECEDING) AS c FROM ev),
 pt AS (SELECT nu.drive_id, nu.frame_id, nu.t, cut, c, x+(coalesce(nx,x)-x)*t AS x, y+(coalesce(ny,y)-y)*t AS y FROM nu JOIN sg ON sg.drive_id=nu.drive_id AND sg.frame_id=nu.frame_id),
 pc AS (SELECT drive_id, c AS piece, frame_id, t, x, y FROM pt UNION ALL SELECT drive_id, c-1, frame_id, t, x, y FROM pt WHERE cut),
 ll AS (SELECT *, sqrt(pow(x-lag(x) OVER w,2)+pow(y-lag(y) OVER w,2)) AS d FROM pc WINDOW w AS (PARTITION BY drive_id, piece ORDER BY frame_id, t))
 SELECT drive_id, piece, count(*) AS vertices, round(sum(d),4) AS length_m, round(arg_min(x, frame_id+t)+1.3e-7::DOUBLE,4) AS x0, round(arg_min(y, frame_id+t)+1.3e-7::DOUBLE,4) AS y0, round(arg_max(x, frame_id+t)+1.3e-7::DOUBLE,4) AS x1, round(arg_max(y, frame_id+t)+1.3e-7::DOUBLE,4) AS y1 FROM ll GROUP BY 1,2""")
def _(c):
    v = c.poses.select("drive_id", C("frame_id").alias("idx"), "x", "y")
    p = L.split(v, ["drive_id"], "idx", L.wall_cuts(v, ["drive_id"], "idx", L.box_walls(c.priors), 32.0))
    at = F.struct("idx", "t")
    ends = lambda v, f, n: F.round(f(v, at) + 1.3e-7, 4).alias(n)
    return p.groupBy("drive_id", "piece").agg(N().alias("vertices"), F.round(F.sum("step"), 4).alias("length_m"), ends("x", F.min_by, "x0"), ends("y", F.min_by, "y0"), ends("x", F.max_by, "x1"), ends("y", F.max_by, "y1"))


DEG = "dg AS (SELECT n AS node_id, count(*) AS degree FROM (SELECT UNNEST([from_node, to_node]) AS n FROM edges) GROUP BY 1)"


@query("g18_node_degree", f"WITH {DEG} SELECT node_id, degree FROM dg")
def _(c):
    return GR.degrees(c.edges)


SPUR = f"{DEG}, sp AS (SELECT e.*, f.degree AS df, t.degree AS dt, (f.degree=1 OR t.degree=1) AND length_m<9.0 AS spur FROM edges e JOIN dg f ON f.node_id=from_node JOIN dg t ON t.node_id=to_node)"


def spurs(c):
    return GR.spur_flag(c.edges, 9.0)


@query("g19_spur_removal", f"WITH {SPUR} SELECT 'spur_'||CAST(edge_id AS VARCHAR) AS issue_id, [edge_id] AS involved_edges, [from_node, to_node] AS involved_nodes, 'DanglingEnd' AS rule_failed, 'S1' AS severity, ['remove_spur'] AS recommend_actions, 'E08' AS error_code FROM sp WHERE spur")
def _(c):
    return GR.removal_records(spurs(c).filter("spur"), 9.0)[0]


def nodes(c):
    return c.edges.select(F.explode(F.array("from_node", "to_node")).alias("node_id")).distinct().select(
        "node_id", (C("node_id") % 5).alias("bucket"), (C("node_id") * F.lit(2.0)).alias("x"), (C("node_id") * 17 % 50).cast("double").alias("y"))


@query("g20_merge_dangling")
def _(c):
    return GR.merge_dangling(spurs(c).filter("not spur").drop("deg_from", "deg_to", "spur"), nodes(c), 9.0, 30.0, "bucket")


@query("g21_isolated_nodes", f"WITH {SPUR}, kept AS (SELECT UNNEST([from_node, to_node]) AS n FROM sp WHERE NOT spur) SELECT node_id FROM dg WHERE node_id NOT IN (SELECT n FROM kept)")
def _(c):
    kept = spurs(c).filter("not spur").select(F.explode(F.array("from_node", "to_node")).alias("node_id")).distinct()
    return nodes(c).select("node_id").join(kept, "node_id", "left_anti")


GSIZE = """WITH RECURSIVE {pre}, nd AS (SELECT DISTINCT UNNEST([from_node, to_node]) AS n FROM {src}), bo AS (SELECT from_node s, to_node d FROM {src} UNION ALL SELECT to_node, from_node FROM {src}),
 cc(id, label) USING KEY (id) AS (SELECT n, n FROM nd UNION SELECT bo.d, min(cc.label) FROM cc JOIN bo ON bo.s=cc.id JOIN recurring.cc AS r ON r.id=bo.d WHERE cc.label < r.label GROUP BY bo.d), z AS (SELECT label, count(*) AS nodes FROM cc GROUP BY 1) SELECT nodes, count(*) AS components FROM z WHERE nodes>1 GROUP BY 1"""


@query("g22_component_sizes", GSIZE.format(pre="z0 AS (SELECT 1)", src="edges"))
def _(c):
    return GR.component_sizes(c.edges).groupBy("nodes").agg(N().alias("components"))


@query("g22_component_sizes_pruned", GSIZE.format(pre=f"{SPUR}, kp AS (SELECT * FROM sp WHERE NOT spur)", src="kp"))
def _(c):
    return GR.component_sizes(spurs(c).filter("not spur")).groupBy("nodes").agg(N().alias("components"))


@query("g23_degree_histogram", f"WITH {DEG} SELECT degree, count(*) AS n, degree>5 AS over_merged FROM dg GROUP BY 1")
def _(c):
    return GR.degrees(c.edges).groupBy("degree").agg(N().alias("n")).withColumn("over_merged", C("degree") > 5)


@query("v07_graph_checks", f"""WITH {SPUR}, ds AS (SELECT sum(degree) AS s FROM dg), nd AS (SELECT DISTINCT UNNEST([from_node, to_node]) AS n FROM edges), iss AS (SELECT 'spur_' || CAST(edge_id AS VARCHAR) AS i FROM sp WHERE spur), act AS (SELECT 'act_spur_' || CAST(edge_id AS VARCHAR) AS a, 'spur_' || CAST(edge_id AS VARCHAR) AS i FROM sp WHERE spur)
 SELECT 'edge_ids_unique' AS "check", count(*)=count(DISTINCT edge_id) AS ok, count(*)-count(DISTINCT edge_id) AS detail FROM edges UNION ALL SELECT 'degree_sum', (SELECT s FROM ds)=2*count(*), CAST((SELECT s FROM ds) AS BIGINT) FROM edges
 UNION ALL SELECT 'edge_nodes_exist', count(*) FILTER (k=0)=0, count(*) FILTER (k=0) FROM (SELECT n, (SELECT count(*) FROM dg WHERE dg.node_id=nd.n) AS k FROM nd) UNION ALL SELECT 'actions_reference_issues', count(*)=0, count(*) FROM act ANTI JOIN iss USING (i)""")
def _(c):
    issues, actions = GR.removal_records(spurs(c).filter("spur"), 9.0)
    return GR.checks(nodes(c), c.edges, issues, actions)


ARM = """sd AS (SELECT prior_id, (minx+maxx)/2 AS px, (miny+maxy)/2 AS py FROM priors), an AS (SELECT prior_id, l.angle%180 AS a180, CASE WHEN pow(px-ax,2)+pow(py-ay,2)<=pow(px-bx,2)+pow(py-by_,2) THEN degrees(atan2(by_-ay,bx-ax)) ELSE degrees(atan2(ay-by_,ax-bx)) END AS a FROM sd JOIN ln l ON pow(l.x-px,2)+pow(l.y-py,2)<=1600.0),
 ar AS (SELECT prior_id, list_sort(list(a180)) AS h, list_sort(list(CASE WHEN a<0 THEN a+360 ELSE a END)) AS p FROM an GROUP BY 1)"""


def bins_sql(v, period, w):
    k = f"(1+list_sum(list_transform(range(2,len({v})+1), lambda i: CASE WHEN {v}[i]-{v}[i-1]>{w} THEN 1 ELSE 0 END)))"
    return f"CAST(CASE WHEN len({v})=1 THEN 1 ELSE {k}-CASE WHEN {k}>1 AND {v}[1]+{period}-{v}[len({v})]<={w} THEN 1 ELSE 0 END END AS INTEGER)"


@query("g24_arm_count", f"WITH {LINES}, {ARM} SELECT prior_id, CAST(len(h) AS INTEGER) AS crossing, {bins_sql('h', 180, 10.5)} AS heading_arms, {bins_sql('p', 360, 20.5)} AS approach_arms FROM ar")
def _(c):
    seed = c.priors.select("prior_id", ((C("minx") + C("maxx")) / 2).alias("rx"), ((C("miny") + C("maxy")) / 2).alias("ry"))
    j = J.within(center_lines(c), seed, 40.0)
    first = (C("rx") - C("ax")) ** 2 + (C("ry") - C("ay")) ** 2 <= (C("rx") - C("bx")) ** 2 + (C("ry") - C("by_")) ** 2
    a = F.degrees(F.when(first, F.atan2(C("by_") - C("ay"), C("bx") - C("ax"))).otherwise(F.atan2(C("ay") - C("by_"), C("ax") - C("bx"))))
    d = checkpoint(j.select("prior_id", (C("angle") % 180).alias("h"), F.when(a < 0, a + 360).otherwise(a).alias("p")))
    n = d.groupBy("prior_id").agg(N().cast("int").alias("crossing"))
    return n.join(K.arm_count(d, ["prior_id"], "h", 180.0, 10.5, "heading_arms"), "prior_id").join(K.arm_count(d, ["prior_id"], "p", 360.0, 20.5, "approach_arms"), "prior_id")


def road_mask(c):
    return G.with_cell(c.points, 4.0).select("ix", "iy").distinct()


LOCAL = """sd AS (SELECT prior_id, (minx+maxx)/2 AS px, (miny+maxy)/2 AS py FROM priors), road AS (SELECT DISTINCT CAST(floor(x/4.0) AS BIGINT) ix, CAST(floor(y/4.0) AS BIGINT) iy FROM points WHERE z>2.5),
 gx AS (SELECT *, UNNEST(range(CAST(floor(px/4.0) AS BIGINT)-6, CAST(floor(px/4.0) AS BIGINT)+7)) AS ix FROM sd), ds AS (SELECT * FROM (SELECT *, UNNEST(range(CAST(floor(py/4.0) AS BIGINT)-6, CAST(floor(py/4.0) AS BIGINT)+7)) AS iy FROM gx) WHERE sqrt(pow((ix+0.5)*4.0-px,2)+pow((iy+0.5)*4.0-py,2))<=20),
 lc AS (SELECT prior_id AS drive_id, ds.ix, ds.iy FROM ds JOIN road USING (ix, iy))"""


def local_cells(c):
    seed = c.priors.select("prior_id", ((C("minx") + C("maxx")) / 2).alias("x"), ((C("miny") + C("maxy")) / 2).alias("y"))
    road = G.with_cell(c.points.filter("z > 2.5"), 4.0).select("ix", "iy").distinct()
    return K.disc_cells(seed, ["prior_id"], F.lit(20.0), 4.0).join(road, ["ix", "iy"], "left_semi")


@query("g25_refine_intersection", f"""WITH RECURSIVE {LOCAL}, {cc_sql('lc', False).replace('100000000', '1000000000000').replace('10000 +', '1000000 +')}, z AS (SELECT drive_id, label, count(*) n FROM msk JOIN cc USING (id) GROUP BY 1,2), b AS (SELECT drive_id, max(n) n FROM z GROUP BY 1)
 SELECT s.prior_id, coalesce(b.n,0) AS cells, CASE WHEN b.n>=8 THEN 'refined' WHEN b.n IS NULL THEN 'empty' ELSE 'fallback_local' END AS reason FROM sd s LEFT JOIN b ON b.drive_id=s.prior_id""")
def _(c):
    loc = local_cells(c)
    lab = CC.cell_components(loc, ["prior_id"], diagonal=False).groupBy("prior_id", "label").agg(N().alias("n"))
    b = lab.groupBy("prior_id").agg(F.max("n").alias("n"))
    j = c.priors.select("prior_id").join(b, "prior_id", "left")
    return j.select("prior_id", F.coalesce("n", F.lit(0)).alias("cells"), R.first_reason([("refined", C("n") >= 8), ("empty", C("n").isNull())], "fallback_local").alias("reason"))


@query("g26_refine_seed", """WITH sd AS (SELECT prior_id, (minx+maxx)/2 AS px, (miny+maxy)/2 AS py FROM priors), a AS (SELECT prior_id, min(sqrt(pow(x-px,2)+pow(y-py,2))) AS d FROM sd JOIN candidates ON class='1-URGENT' AND pow(x-px,2)+pow(y-py,2)<=900.0 GROUP BY 1), b AS (SELECT prior_id, min(sqrt(pow(x-px,2)+pow(y-py,2))) AS d FROM sd JOIN candidates ON class<>'1-URGENT' AND pow(x-px,2)+pow(y-py,2)<=900.0 GROUP BY 1)
 SELECT s.prior_id, CASE WHEN a.d IS NOT NULL THEN 'junction' WHEN b.d IS NOT NULL THEN 'line' ELSE 'none' END AS source, round(coalesce(1-a.d/30, 1-b.d/30, 0),6) AS confidence FROM sd s LEFT JOIN a USING (prior_id) LEFT JOIN b USING (prior_id)""")
def _(c):
    seed = c.priors.select("prior_id", ((C("minx") + C("maxx")) / 2).alias("rx"), ((C("miny") + C("maxy")) / 2).alias("ry"))
    d = J.within(c.candidates.select("x", "y", "class"), seed, 30.0)
    urgent = C("class") == "1-URGENT"
    m = d.groupBy("prior_id").agg(F.min(F.when(urgent, C("dist"))).alias("a"), F.min(F.when(~urgent, C("dist"))).alias("b"))
    j = c.priors.select("prior_id").join(m, "prior_id", "left")
    return j.select("prior_id", R.first_reason([("junction", C("a").isNotNull()), ("line", C("b").isNotNull())], "none").alias("source"), F.coalesce(1 - C("a") / 30, 1 - C("b") / 30, F.lit(0.0)).alias("confidence"))


@query("g27_adaptive_radius", "SELECT cand_id, round(least(greatest(1.5*rect_w+2.0*greatest(0, frame_id%6-2),8.0),18.0),6) AS radius, CASE WHEN rect_w<=1 THEN 'fallback_default' ELSE 'width_local' END AS source FROM candidates")
def _(c):
    r = 1.5 * C("rect_w") + 2.0 * F.greatest(F.lit(0), C("frame_id") % 6 - 2)
    return c.candidates.select("cand_id", F.least(F.greatest(r, F.lit(8.0)), F.lit(18.0)).alias("radius"), F.when(C("rect_w") <= 1, "fallback_default").otherwise("width_local").alias("source"))


@query("g28_arm_source", """WITH a AS (SELECT frame_id, count(*) FILTER (model='F') AS cl, count(*) FILTER (model='O') AS osm, count(*) AS sk FROM candidates GROUP BY 1) SELECT frame_id, CASE WHEN cl>=3 THEN 'centerlines' WHEN osm>=3 THEN 'osm' WHEN sk>0 THEN 'skeleton' ELSE 'none' END AS source, CASE WHEN cl>=3 THEN cl WHEN osm>=3 THEN osm ELSE sk END AS arms FROM a""")
def _(c):
    a = c.candidates.groupBy("frame_id").agg(F.count_if(C("model") == "F").alias("cl"), F.count_if(C("model") == "O").alias("osm"), N().alias("sk"))
    src = R.first_reason([("centerlines", C("cl") >= 3), ("osm", C("osm") >= 3), ("skeleton", C("sk") > 0)], "none")
    return a.select("frame_id", src.alias("source"), F.when(C("cl") >= 3, C("cl")).when(C("osm") >= 3, C("osm")).otherwise(C("sk")).alias("arms"))


@query("g29_spur_prune", f"""WITH RECURSIVE {LOCAL}, od AS (SELECT lc.* FROM lc JOIN sd ON sd.prior_id=lc.drive_id WHERE sqrt(pow((ix+0.5)*4.0-px,2)+pow((iy+0.5)*4.0-py,2))>12), {cc_sql('od', False).replace('100000000', '1000000000000').replace('10000 +', '1000000 +')},
 z AS (SELECT drive_id, label, count(*)*16.0::DOUBLE AS area, greatest(max(ix)-min(ix)+1, max(iy)-min(iy)+1)*4.0::DOUBLE AS len FROM msk JOIN cc USING (id) GROUP BY 1,2)
 SELECT drive_id AS prior_id, count(*) FILTER (area/len<7.0 AND len>8.0) AS removed, count(*) FILTER (NOT (area/len<7.0 AND len>8.0)) AS kept, round(coalesce(sum(len) FILTER (area/len<7.0 AND len>8.0),0),6) AS removed_len FROM z GROUP BY 1""")
def _(c):
    out = local_cells(c).filter("cell_dist > 12").select("prior_id", "ix", "iy")
    lab = CC.cell_components(out, ["prior_id"], diagonal=False)
    ext = lambda k: F.max(k) - F.min(k) + 1
    z = lab.groupBy("prior_id", "label").agg((N() * 16.0).alias("area"), (F.greatest(ext("ix"), ext("iy")) * 4.0).alias("len"))
    spur = (C("area") / C("len") < 7.0) & (C("len") > 8.0)
    return z.groupBy("prior_id").agg(F.count_if(spur).alias("removed"), F.count_if(~spur).alias("kept"), F.coalesce(F.sum(F.when(spur, C("len"))), F.lit(0.0)).alias("removed_len"))


@query("g30_divider_decision", f"""WITH RECURSIVE {BASE}, dn AS (SELECT drive_id, ix, iy FROM base WHERE z_base<=0.8), {cc_sql('dn', False)}, z AS (SELECT drive_id, label, count(*) n, avg(ix) mx, avg(iy) my FROM msk JOIN cc USING (id) GROUP BY 1,2), r AS (SELECT *, row_number() OVER (PARTITION BY drive_id ORDER BY n DESC, label) AS r FROM z)
 SELECT a.drive_id, a.n AS first_cells, coalesce(b.n,0) AS second_cells, b.n IS NOT NULL AS divided, CASE WHEN b.n IS NULL THEN 'none' WHEN (b.my-a.my)>0 THEN 'L' ELSE 'R' END AS second_side FROM r a LEFT JOIN r b ON b.drive_id=a.drive_id AND b.r=2 WHERE a.r=1""")
def _(c):
    m = G.min_height(c.points, RES, BY).filter("z_base <= 0.8")
    z = CC.cell_components(m, BY, diagonal=False).groupBy("drive_id", "label").agg(N().alias("n"), F.avg("iy").alias("my"))
    t = top_per_group(z, ["drive_id"], [F.desc("n"), C("label")], 2)
    at = lambda k, v: F.max(F.when(C("rank") == k, C(v)))
    g = t.groupBy("drive_id").agg(at(1, "n").alias("first_cells"), F.coalesce(at(2, "n"), F.lit(0)).alias("second_cells"), at(1, "my").alias("m1"), at(2, "my").alias("m2"))
    # the base direction is +x, so the cross product is the y offset
    return g.select("drive_id", "first_cells", "second_cells", (C("second_cells") > 0).alias("divided"), F.when(C("m2").isNull(), "none").when(C("m2") > C("m1"), "L").otherwise("R").alias("second_side"))


@query("g31_offset_fallbacks")
def _(c):
    v = c.poses.select("drive_id", C("frame_id").alias("idx"), "x", "y")
    road = G.with_cell(c.points, 4.0).select("ix", "iy").distinct().withColumn("r", F.lit(1))
    parts = None
    for rank, off in enumerate((3.5, max(1.0, 3.5 * 0.7), max(0.8, 3.5 * 0.45))):
        for side, sign in (("L", 1), ("R", -1)):
            o = L.offset(v, ["drive_id"], "idx", off * sign).select("drive_id", "x", "y", F.lit(rank).alias("rank"), F.lit(side).alias("side"), F.lit(off).alias("offset_m"))
            parts = o if parts is None else parts.unionByName(o)
    s = G.with_cell(parts, 4.0).join(road, ["ix", "iy"], "left").groupBy("drive_id", "rank", "offset_m", "side").agg(F.avg(F.coalesce("r", F.lit(0))).alias("inside"))
    ok = s.groupBy("drive_id", "rank", "offset_m").agg(F.min("inside").alias("inside")).filter("inside >= 0.7")
    best = ok.groupBy("drive_id").agg(F.min(F.struct("rank", "offset_m", "inside")).alias("m"))
    return v.select("drive_id").distinct().join(best, "drive_id", "left").select("drive_id", F.coalesce("m.offset_m", F.lit(0.0)).alias("offset_m"), C("m.inside").alias("inside"))


@query("g32_turn_intersections", f"""WITH RECURSIVE {TURN}, t AS (SELECT drive_id, x AS px, y AS py FROM tn WHERE ang>=1.6), gx AS (SELECT *, UNNEST(range(CAST(floor(px/5.0) AS BIGINT)-4, CAST(floor(px/5.0) AS BIGINT)+5)) AS ix FROM t), ds AS (SELECT DISTINCT drive_id, ix, iy FROM (SELECT *, UNNEST(range(CAST(floor(py/5.0) AS BIGINT)-4, CAST(floor(py/5.0) AS BIGINT)+5)) AS iy FROM gx) WHERE sqrt(pow((ix+0.5)*5.0-px,2)+pow((iy+0.5)*5.0-py,2))<=15),
 {cc_sql('ds', False)}, z AS (SELECT drive_id, label, count(*)*25.0::DOUBLE AS a FROM msk JOIN cc USING (id) GROUP BY 1,2), r AS (SELECT *, row_number() OVER (PARTITION BY drive_id ORDER BY a DESC, label) AS r FROM z WHERE a>=700) SELECT drive_id, count(*) AS intersections, round(sum(a),6) AS area_m2 FROM r WHERE r<=5 GROUP BY 1""")
def _(c):
    t = turns(c, 1.6).select("drive_id", "x", "y")
    cells = K.disc_cells(t, ["drive_id"], F.lit(15.0), 5.0).select("drive_id", "ix", "iy").distinct()
    a = G.area_components(cells, 5.0, ["drive_id"], False).filter("area_m2 >= 700")
    k = top_per_group(a, ["drive_id"], [F.desc("area_m2"), C("label")], 5)
    return k.groupBy("drive_id").agg(N().alias("intersections"), F.sum("area_m2").alias("area_m2"))


@query("g33_crosswalk_detection")
def _(c):
    marks = G.with_cell(c.points.filter("intensity >= 0.085"), 4.0).select("drive_id", "ix", "iy").distinct()
    lab = CC.cell_components(G.close_mask(marks, 1, BY), BY, diagonal=False)
    hit = lab.join(marks.withColumn("m", F.lit(1)), ["drive_id", "ix", "iy"], "left")
    corner = lambda a, b: E.xy((C("ix") + a) * 4.0, (C("iy") + b) * 4.0)
    pts = hit.select("drive_id", "label", "ix", "iy", F.explode(F.array(corner(0, 0), corner(1, 0), corner(1, 1), corner(0, 1))).alias("p")).select("drive_id", "label", "p.x", "p.y")
    hull = S.hull_of(pts, ["drive_id", "label"])
    size = hit.groupBy("drive_id", "label").agg((N() * 16.0).alias("area_m2"), F.count("m").alias("components"))
    r = hull.select("drive_id", "label", E.rotated_rect("hull").alias("r")).join(size, ["drive_id", "label"])
    ok = C("r.rect_w").between(4, 40) & C("r.rect_l").between(4, 60) & C("area_m2").between(32, 1200) & (C("components") >= 2)
    return r.filter(ok).groupBy("drive_id").agg(N().alias("crosswalks"), F.sum("area_m2").alias("area_m2"), F.sum("components").alias("components"))


REJ = """list_filter([CASE WHEN max(rectangularity)<0.25 THEN 'inside_ratio' END, CASE WHEN max(rect_w)<2 THEN 'rect_w' END, CASE WHEN max(rect_l)>9.5 THEN 'rect_l' END, CASE WHEN median(angle)>120 THEN 'heading' END], lambda v: v IS NOT NULL)"""


def frame_candidates(c):
    g = c.candidates.groupBy("drive_id", "frame_id").agg(F.max("rectangularity").alias("inside"), F.max("rect_w").alias("w"), F.max("rect_l").alias("l"), F.percentile("angle", F.lit(0.5)).alias("heading"),
                                                       F.avg("x").alias("x"), F.avg("y").alias("y"), N().alias("hits"))
    return g.withColumn("reject", R.reasons({"inside_ratio": C("inside") < 0.25, "rect_w": C("w") < 2, "rect_l": C("l") > 9.5, "heading": C("heading") > 120}))


@query("g34_frame_candidates", f"SELECT drive_id, frame_id, count(*) AS hits, {REJ} AS reject FROM candidates GROUP BY 1,2")
def _(c):
    return frame_candidates(c).select("drive_id", "frame_id", "hits", "reject")


FC = f"""fc AS (SELECT drive_id, frame_id, drive_id*1000000000+frame_id AS fid, avg(x) AS x, avg(y) AS y, max(rect_w) AS w, max(rect_l) AS l, {REJ} AS reject FROM candidates GROUP BY 1,2)"""


@query("g35_final_entities", f"""WITH RECURSIVE {FC}, {link_sql('fc', 'fid', 'a.drive_id=b.drive_id AND a.x BETWEEN b.x-25 AND b.x+25 AND sqrt(pow(a.x-b.x,2)+pow(a.y-b.y,2))<=25')}, m AS (SELECT fc.*, label FROM fc JOIN cc ON cc.id=fid), s AS (SELECT label, count(*) FILTER (len(reject)=0) AS strict FROM m GROUP BY 1),
 u AS (SELECT m.*, strict FROM m JOIN s USING (label) WHERE strict=0 OR len(reject)=0), c0 AS (SELECT label, avg(x) mx, avg(y) my FROM u GROUP BY 1), j AS (SELECT u.*, sqrt(pow(x-mx,2)+pow(y-my,2)) AS d FROM u JOIN c0 USING (label))
 SELECT label, max(strict) AS strict_members, count(*) AS used, round(quantile_cont(d,0.9),6) AS jitter_p90, round(sqrt(pow(max(x)-min(x),2)+pow(max(y)-min(y),2)),6) AS span, round(median(w),6) AS med_w, list_filter([CASE WHEN max(strict)=0 THEN 'relaxed' END, CASE WHEN count(*)<2 THEN 'low_hit' END, CASE WHEN quantile_cont(d,0.9)>12.0137 THEN 'jitter' END], lambda v: v IS NOT NULL) AS reasons FROM j GROUP BY 1""")
def _(c):
    f = frame_candidates(c).withColumn("fid", C("drive_id") * 1000000000 + C("frame_id"))
    m = CC.centroid_clusters(f, "fid", 25.0, ["drive_id"])
    strict = F.size("reject") == 0
    s = m.groupBy("label").agg(F.count_if(strict).alias("strict"))
    u = m.join(s, "label").filter((C("strict") == 0) | strict)
    mid = u.groupBy("label").agg(F.avg("x").alias("mx"), F.avg("y").alias("my"))
    j = u.join(mid, "label").withColumn("d", F.hypot(C("x") - C("mx"), C("y") - C("my")))
    p90 = F.percentile("d", F.lit(.9))
    g = j.groupBy("label").agg(F.max("strict").alias("strict_members"), N().alias("used"), p90.alias("jitter_p90"), F.hypot(F.max("x") - F.min("x"), F.max("y") - F.min("y")).alias("span"), F.percentile("w", F.lit(.5)).alias("med_w"))
    return g.withColumn("reasons", R.reasons({"relaxed": C("strict_members") == 0, "low_hit": C("used") < 2, "jitter": C("jitter_p90") > 12.0137}))


@query("g36_sat_candidates", """WITH s AS (SELECT p_partkey, p_partkey*0.25::DOUBLE AS x, 100+(p_partkey%97)::DOUBLE AS y, (p_size%50)/50.0::DOUBLE AS conf FROM part WHERE (p_size%50)/50.0::DOUBLE>=0.3), t AS (SELECT p_partkey, count(*) AS k FROM s JOIN poses p ON pow(s.x-p.x,2)+pow(s.y-p.y,2)<=pow(12+20*conf,2) GROUP BY 1)
 SELECT p_partkey, round(12+20*conf,6) AS radius, round(conf,6) AS sat_confidence, coalesce(k,0) AS traj_support, round(pi()*pow(12+20*conf,2),4) AS area_m2 FROM s LEFT JOIN t USING (p_partkey)""")
def _(c):
    s = c.part.select("p_partkey", (C("p_partkey") * F.lit(0.25)).alias("rx"), (100 + C("p_partkey") % 97).cast("double").alias("ry"), (C("p_size") % 50 / F.lit(50.0)).alias("conf")).filter("conf >= 0.3").withColumn("radius", 12 + 20 * C("conf"))
    dx, dy = C("rx") - C("x"), C("ry") - C("y")  # squares are compared, as in the SQL: a root may round a pair onto the radius
    k = J.within(c.poses.select("x", "y"), s, 32.0).filter(dx * dx + dy * dy <= C("radius") * C("radius")).groupBy("p_partkey").agg(N().alias("k"))
    return s.join(k, "p_partkey", "left").select("p_partkey", "radius", C("conf").alias("sat_confidence"), F.coalesce("k", F.lit(0)).alias("traj_support"), F.round(F.pi() * C("radius") ** 2, 4).alias("area_m2"))


HYB = """fl AS (SELECT cand_id, frame_id, model, conf, rect_l*rect_w<4 OR rect_l*rect_w>30 AS f_area, 4*pi()*rect_l*rect_w/pow(2*(rect_l+rect_w),2)<0.45 AS f_compact, greatest(rect_l,rect_w)/least(rect_l,rect_w)>4.5 AS f_aspect, rectangularity<0.25 AS f_overlap FROM candidates), ok AS (SELECT *, NOT (f_area OR f_compact OR f_aspect OR f_overlap) AS valid FROM fl)"""


def validity(c):
    l, w = C("rect_l"), C("rect_w")
    d = c.candidates.select("cand_id", "frame_id", "model", "conf", ((l * w < 4) | (l * w > 30)).alias("f_area"), (E.circularity(l * w, 2 * (l + w)) < 0.45).alias("f_compact"),
                            (F.greatest(l, w) / F.least(l, w) > 4.5).alias("f_aspect"), (C("rectangularity") < 0.25).alias("f_overlap"))
    return d.withColumn("valid", ~(C("f_area") | C("f_compact") | C("f_aspect") | C("f_overlap")))


@query("g37_source_fusion", f"""WITH {HYB}, b AS (SELECT frame_id, max(conf) FILTER (model='F' AND valid) AS algo, max(conf) FILTER (model='O' AND valid) AS sat, count(*) FILTER (model='F') AS n_algo FROM ok GROUP BY 1)
 SELECT frame_id, CASE WHEN algo IS NOT NULL AND (sat IS NULL OR algo>=sat-0.1) THEN 'algo' WHEN sat IS NOT NULL THEN 'sat' WHEN n_algo>0 THEN 'algo_invalid' ELSE 'none' END AS choice, round(coalesce(algo,sat,0),6) AS score FROM b""")
def _(c):
    v = validity(c)
    best = lambda m: F.max(F.when((C("model") == m) & C("valid"), C("conf")))
    b = v.groupBy("frame_id").agg(best("F").alias("algo"), best("O").alias("sat"), F.count_if(C("model") == "F").alias("n_algo"))
    choice = R.first_reason([("algo", C("algo").isNotNull() & (C("sat").isNull() | (C("algo") >= C("sat") - 0.1))), ("sat", C("sat").isNotNull()), ("algo_invalid", C("n_algo") > 0)], "none")
    return b.select("frame_id", choice.alias("choice"), F.coalesce("algo", "sat", F.lit(0.0)).alias("score"))
