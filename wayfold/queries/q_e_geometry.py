"""Geometry on vertex arrays, rasterised shapes and polylines."""

from pyspark.sql import functions as F

from wayfold.functions import geometry as E, records as R
from wayfold.operators import grid as G, joins as J, lines as L, ordered as O, shapes as S
from wayfold.queries.catalog import C, query
from wayfold.session import shuffled


def RING():
    return E.rect_ring(C("x"), C("y"), C("rect_l"), C("rect_w"), C("angle"))


IMG = (1408.0, 376.0)

def DET_BOX():
    return E.make_box(C("x0"), C("y0"), C("x1"), C("y1"))


# SQL: the four corners of a candidate rectangle
CORNERS = """ang AS (SELECT *, cos(radians(angle)) AS ca, sin(radians(angle)) AS sa FROM candidates), vtx AS (SELECT cand_id, k, x+rect_l*u/2*ca-rect_w*v/2*sa AS vx, y+rect_l*u/2*sa+rect_w*v/2*ca AS vy
 FROM ang, (VALUES (1,-1,-1),(2,1,-1),(3,1,1),(4,-1,1)) AS q(k,u,v))"""
LINE = """vt AS (SELECT drive_id, frame_id, x, y, lead(x) OVER w AS nx, lead(y) OVER w AS ny, lag(x) OVER w AS px, lag(y) OVER w AS py FROM poses WINDOW w AS (PARTITION BY drive_id ORDER BY frame_id)),
 sl AS (SELECT *, coalesce(sum(coalesce(sqrt((x-px)*(x-px)+(y-py)*(y-py)),0)) OVER (PARTITION BY drive_id ORDER BY frame_id),0) AS s FROM vt),
 sg AS (SELECT *, lead(s) OVER (PARTITION BY drive_id ORDER BY frame_id) AS ns FROM sl), ln AS (SELECT drive_id, max(s) AS len FROM sl GROUP BY 1)"""


@query("e01_bbox", f"WITH {CORNERS} SELECT cand_id, round(min(vx),6) AS minx, round(min(vy),6) AS miny, round(max(vx),6) AS maxx, round(max(vy),6) AS maxy, round((min(vx)+max(vx))/2,6)+0.0 AS cx, round((min(vy)+max(vy))/2,6)+0.0 AS cy FROM vtx GROUP BY 1")
def _(c):
    return c.candidates.select("cand_id", E.bbox(RING()).alias("b")).select("cand_id", "b.*", E.bbox_center(C("b")).alias("m")).select(
        "cand_id", "minx", "miny", "maxx", "maxy", C("m.x").alias("cx"), C("m.y").alias("cy"))


@query("e01_box_expand_shrink", """WITH e AS (SELECT *, greatest(0,x0-15) ex0, greatest(0,y0-15) ey0, least(1407,x1+15) ex1, least(375,y1+15) ey1, greatest(x1-x0,y1-y0) sd FROM detections),
 k AS (SELECT *, 80/sd AS k, (x0+x1)/2 cx, (y0+y1)/2 cy, x1-x0 w, y1-y0 h FROM e)
 SELECT det_id, ex0, ey0, CASE WHEN ex1<=ex0 THEN ex0+1 ELSE ex1 END AS ex1, CASE WHEN ey1<=ey0 THEN ey0+1 ELSE ey1 END AS ey1,
 round(CASE WHEN sd<=80 THEN x0 ELSE greatest(0,cx-w*k/2) END,6) AS sx0, round(CASE WHEN sd<=80 THEN y0 ELSE greatest(0,cy-h*k/2) END,6) AS sy0, round(CASE WHEN sd<=80 THEN x1 ELSE least(1407,cx+w*k/2) END,6) AS sx1, round(CASE WHEN sd<=80 THEN y1 ELSE least(375,cy+h*k/2) END,6) AS sy1 FROM k""")
def _(c):
    d = c.detections.select("det_id", E.expand_box(DET_BOX(), 15.0, *IMG).alias("e"), E.shrink_box(DET_BOX(), 80.0, *IMG).alias("s"))
    m = [("minx", "x0"), ("miny", "y0"), ("maxx", "x1"), ("maxy", "y1")]
    return d.select("det_id", *[C(f"{p}.{a}").alias(p + b) for p in "es" for a, b in m])


def model_pairs(c):
    """Boxes of the same frame and class from model m0 against models m1 and m2."""
    a = c.detections.filter("model = 'm0'").select("frame_id", "class", C("det_id").alias("id_a"), DET_BOX().alias("a"))
    b = c.detections.filter("model <> 'm0'").select("frame_id", "class", C("det_id").alias("id_b"), DET_BOX().alias("b"))
    return a.join(b, ["frame_id", "class"])


PAIRS = """pr AS (SELECT a.det_id AS id_a, b.det_id AS id_b, a.x0 ax0, a.y0 ay0, a.x1 ax1, a.y1 ay1, b.x0 bx0, b.y0 by0, b.x1 bx1, b.y1 by1, greatest(least(a.x1,b.x1)-greatest(a.x0,b.x0),0)*greatest(least(a.y1,b.y1)-greatest(a.y0,b.y0),0) AS i
 FROM detections a JOIN detections b ON a.frame_id=b.frame_id AND a.class=b.class WHERE a.model='m0' AND b.model<>'m0')"""


@query("e02_box_iou", f"WITH {PAIRS} SELECT id_a, id_b, round(CASE WHEN i>0 THEN i/((ax1-ax0)*(ay1-ay0)+(bx1-bx0)*(by1-by0)-i) ELSE 0 END,6) AS iou FROM pr")
def _(c):
    return model_pairs(c).select("id_a", "id_b", E.box_iou(C("a"), C("b")).alias("iou"))


@query("e03_box_predicates", f"""WITH {PAIRS}, m AS (SELECT *, (bx0+bx1)/2 px, (by0+by1)/2 py FROM pr) SELECT id_a, id_b, ax1>=bx0 AND ax0<=bx1 AND ay1>=by0 AND ay0<=by1 AS meets, px BETWEEN ax0 AND ax1 AND py BETWEEN ay0 AND ay1 AS holds,
 round(sqrt(pow(greatest(ax0-px,0,px-ax1),2)+pow(greatest(ay0-py,0,py-ay1),2)),6) AS dist FROM m""")
def _(c):
    p = model_pairs(c).withColumn("m", E.bbox_center(C("b")))
    a, x, y = C("a"), C("m.x"), C("m.y")
    return p.select("id_a", "id_b", E.boxes_meet(a, C("b")).alias("meets"), E.in_box(a, x, y).alias("holds"), E.box_distance(a, x, y).alias("dist"))


@query("e04_area_perimeter_e05_circularity_e06_roughness", """SELECT cand_id, round(rect_l*rect_w,6) AS area, round(2*(rect_l+rect_w),6) AS perimeter, round(4*pi()*rect_l*rect_w/pow(2*(rect_l+rect_w),2),6) AS circularity,
 round(pow(2*(rect_l+rect_w),2)/(rect_l*rect_w),6) AS roughness, 5 AS vertices FROM candidates""")
def _(c):
    d = c.candidates.select("cand_id", RING().alias("r")).select("cand_id", E.area(C("r")).alias("area"), E.perimeter(C("r")).alias("perimeter"), F.size("r").alias("vertices"))
    a, p = C("area"), C("perimeter")
    return d.select("cand_id", a, p, E.circularity(a, p).alias("circularity"), E.roughness(a, p).alias("roughness"), "vertices")


@query("e07_min_rotated_rect", "SELECT cand_id, round(greatest(rect_l,rect_w),5) AS rect_l, round(least(rect_l,rect_w),5) AS rect_w, round(x,5) AS cx, round(y,5)+0.0 AS cy, round(greatest(rect_l,rect_w)/least(rect_l,rect_w),5) AS aspect, 1.0::DOUBLE AS rectangularity FROM candidates")
def _(c):
    d = c.candidates.select("cand_id", RING().alias("r")).select("cand_id", E.area(C("r")).alias("a"), E.rotated_rect("r").alias("m"))
    l, w = C("m.rect_l"), C("m.rect_w")
    vals = {"rect_l": l, "rect_w": w, "cx": C("m.cx"), "cy": C("m.cy") + 0.0, "aspect": F.when(w > 0, l / F.greatest(w, F.lit(1e-6))).otherwise(0.0), "rectangularity": F.when(l * w > 0, C("a") / (l * w)).otherwise(0.0)}
    return d.select("cand_id", *[F.round(v, 5).alias(k) for k, v in vals.items()])


@query("e08_convex_hull", """WITH p AS (SELECT DISTINCT drive_id, frame_id, x, y FROM points), e AS (SELECT a.drive_id, a.frame_id, a.x ax, a.y ay, b.x bx, b.y by_ FROM p a JOIN p b ON a.drive_id=b.drive_id AND a.frame_id=b.frame_id AND (a.x<>b.x OR a.y<>b.y)
  WHERE NOT EXISTS (SELECT 1 FROM p c WHERE c.drive_id=a.drive_id AND c.frame_id=a.frame_id AND ((b.x-a.x)*(c.y-a.y)-(b.y-a.y)*(c.x-a.x) < 0 OR ((b.x-a.x)*(c.y-a.y)-(b.y-a.y)*(c.x-a.x) = 0 AND ((c.x-a.x)*(c.x-b.x)+(c.y-a.y)*(c.y-b.y) > 0)))))
 SELECT drive_id, frame_id, count(*) AS hull_vertices, round(sum(ax*by_-bx*ay)/2,5) AS hull_area FROM e GROUP BY ALL HAVING count(*)>=3""")
def _(c):
    h = S.hull_of(c.points, ["drive_id", "frame_id"]).filter(F.size("hull") >= 4)
    return h.select("drive_id", "frame_id", (F.size("hull") - 1).cast("long").alias("hull_vertices"), F.round(E.area(C("hull")), 5).alias("hull_area"))


@query("e09_principal_direction", """WITH a AS (SELECT drive_id, frame_id, count(*) AS n, degrees(0.5*atan2(2*covar_samp(x,y), var_samp(x)-var_samp(y))) AS d FROM points GROUP BY ALL)
 SELECT drive_id, frame_id, n, round(CASE WHEN d<0 THEN d+180 ELSE d END,5) AS direction FROM a WHERE n>=2""")
def _(c):
    return S.direction(c.points, ["drive_id", "frame_id"]).filter("n >= 2").withColumn("direction", F.round("direction", 5))


def ringed(c):
    """Candidates with their ring and bounding box."""
    d = c.candidates.withColumn("ring", RING()).withColumn("b", E.bbox(C("ring")))
    return d.select("cand_id", "model", "class", "drive_id", "ring", C("x").alias("cx"), C("y").alias("cy"), "b.*")


# a point is inside the rotated rectangle when both local offsets are within half its sides
INSIDE = "abs((px-c.x)*cos(radians(angle))+(py-c.y)*sin(radians(angle))) < rect_l/2 AND abs((py-c.y)*cos(radians(angle))-(px-c.x)*sin(radians(angle))) < rect_w/2"


@query("e10_points_in_polygon", f"""WITH q AS (SELECT x+0.0137::DOUBLE AS px, y+0.0171::DOUBLE AS py FROM points) SELECT cand_id, count(*) AS n FROM q JOIN candidates c ON px BETWEEN c.x-7 AND c.x+7 AND py BETWEEN c.y-7 AND c.y+7 WHERE {INSIDE} GROUP BY 1""")
def _(c):
    p = c.points.select((C("x") + 0.0137).alias("x"), (C("y") + 0.0171).alias("y"))
    p = p.groupBy("x", "y").agg(F.count(F.lit(1)).alias("w"))  # copies travel once
    j = J.in_boxes(p, ringed(c).select("cand_id", "ring", "minx", "miny", "maxx", "maxy"), 16.0)
    return j.filter(E.in_ring(C("ring"), C("x"), C("y"))).groupBy("cand_id").agg(F.sum("w").alias("n"))


SEGD = "CASE WHEN (nx-x)*(nx-x)+(ny-y)*(ny-y)>0 THEN least(greatest(((qx-x)*(nx-x)+(qy-y)*(ny-y))/((nx-x)*(nx-x)+(ny-y)*(ny-y)),0),1) ELSE 0 END"


@query("e11_point_line_distance", f"""WITH {LINE}, q AS (SELECT cand_id, drive_id, x AS qx, y AS qy FROM candidates), t AS (SELECT cand_id, {SEGD} AS t, x, y, nx, ny, qx, qy FROM q JOIN sg ON q.drive_id=sg.drive_id AND nx IS NOT NULL AND qx BETWEEN least(x,nx)-12 AND greatest(x,nx)+12 AND qy BETWEEN least(y,ny)-12 AND greatest(y,ny)+12),
 d AS (SELECT cand_id, sqrt(pow(qx-x-t*(nx-x),2)+pow(qy-y-t*(ny-y),2)) AS d FROM t) SELECT cand_id, round(min(d),6) AS dist FROM d WHERE d<=12 GROUP BY 1""")
def _(c):
    seg = L.segments(c.poses.select("drive_id", "frame_id", "x", "y"), ["drive_id"], "frame_id")
    seg = seg.select("drive_id", C("x").alias("ax"), C("y").alias("ay"), C("n_x").alias("bx"), C("n_y").alias("by_"))
    return J.near_segments(c.candidates.select("cand_id", "drive_id", "x", "y"), seg, 12.0, ["drive_id"]).groupBy("cand_id").agg(F.min("dist").alias("dist"))


def trip(c):
    return c.poses.select("drive_id", C("frame_id").alias("idx"), "x", "y")


def sample_sql(n, d):
    return f"""{LINE}, sp AS (SELECT l.drive_id, UNNEST(range({n})) AS i, {d} AS d, len FROM ln l WHERE len>0), pts AS (SELECT p.drive_id, p.i, x+(nx-x)*(p.i*p.d-s)/(ns-s) AS sx, y+(ny-y)*(p.i*p.d-s)/(ns-s) AS sy, row_number() OVER (PARTITION BY p.drive_id, p.i ORDER BY s DESC) AS r
 FROM sp p JOIN sg ON sg.drive_id=p.drive_id AND ns>s AND p.i*p.d>=s-1e-9 AND (p.i*p.d<ns OR (p.i*p.d<=ns+1e-9)))"""


@query("e12_line_samples", f"""WITH {sample_sql("greatest(2,CAST(ceil(len/25) AS BIGINT)+1)", "len/(greatest(2,CAST(ceil(len/25) AS BIGINT)+1)-1)")} SELECT drive_id, i, round(sx,5) AS x, round(sy,5) AS y FROM pts WHERE r=1""")
def _(c):
    return L.sample(trip(c), ["drive_id"], "idx", 25.0).select("drive_id", "i", F.round("x", 5).alias("x"), F.round("y", 5).alias("y"))


@query("e12_line_samples_whole_steps", f"""WITH {sample_sql("CAST(floor(len/25) AS BIGINT)+1", "CAST(25 AS DOUBLE)")} SELECT drive_id, i, round(sx,5) AS x, round(sy,5) AS y FROM pts WHERE r=1""")
def _(c):
    return L.sample(trip(c), ["drive_id"], "idx", 25.0, whole_steps=True).select("drive_id", "i", F.round("x", 5).alias("x"), F.round("y", 5).alias("y"))


@query("e13_line_substring", f"""WITH {LINE} SELECT drive_id, count(*) AS segments, round(sum(least(ns,180.5)-greatest(s,60.25)),5) AS length, round(min(x+(nx-x)*(greatest(s,60.25)-s)/(ns-s)),5) AS min_x FROM sg WHERE least(ns,180.5)>greatest(s,60.25) GROUP BY 1""")
def _(c):
    k = L.cut(L.segments(trip(c), ["drive_id"], "idx"), F.lit(60.25), F.lit(180.5))
    return k.groupBy("drive_id").agg(F.count(F.lit(1)).alias("segments"), F.round(F.sum(C("n_s") - C("s")), 5).alias("length"), F.round(F.min("x"), 5).alias("min_x"))


@query("e14_offset_polyline", f"""WITH {LINE}, nm AS (SELECT *, CASE WHEN px IS NULL THEN NULL WHEN sqrt(pow(x-px,2)+pow(y-py,2))=0 THEN 0 ELSE -(y-py)/sqrt(pow(x-px,2)+pow(y-py,2)) END ax, CASE WHEN px IS NULL THEN NULL WHEN sqrt(pow(x-px,2)+pow(y-py,2))=0 THEN 0 ELSE (x-px)/sqrt(pow(x-px,2)+pow(y-py,2)) END ay,
  CASE WHEN nx IS NULL THEN NULL WHEN sqrt(pow(nx-x,2)+pow(ny-y,2))=0 THEN 0 ELSE -(ny-y)/sqrt(pow(nx-x,2)+pow(ny-y,2)) END bx, CASE WHEN nx IS NULL THEN NULL WHEN sqrt(pow(nx-x,2)+pow(ny-y,2))=0 THEN 0 ELSE (nx-x)/sqrt(pow(nx-x,2)+pow(ny-y,2)) END by_ FROM vt),
 av AS (SELECT *, sqrt(pow(ax+bx,2)+pow(ay+by_,2)) AS n FROM nm)
 SELECT drive_id, frame_id AS idx, round(x+3.5*CASE WHEN n IS NULL THEN coalesce(bx,ax) WHEN n<>0 THEN (ax+bx)/n ELSE bx END,5)+0.0 AS x, round(y+3.5*CASE WHEN n IS NULL THEN coalesce(by_,ay) WHEN n<>0 THEN (ay+by_)/n ELSE by_ END,5) AS y FROM av WHERE px IS NOT NULL OR nx IS NOT NULL""")
def _(c):
    o = L.offset(trip(c), ["drive_id"], "idx", 3.5)
    return o.select("drive_id", "idx", F.round("x", 5).alias("x"), F.round("y", 5).alias("y"))


def cells_of(c, model, key):
    """0.5 m cells of one model's shapes; shapes with the same vertices are rasterised once."""
    d = c.candidates.filter(C("model") == model).withColumn("ring", RING())
    return S.rasterise(d, "cand_id", "ring", 0.5).withColumnRenamed("cand_id", key)


CELLSET = f"""gr AS (SELECT c.*, UNNEST(range(CAST(floor((y-7)/0.5) AS BIGINT), CAST(floor((y+7)/0.5) AS BIGINT)+1)) AS iy FROM (SELECT *, UNNEST(range(CAST(floor((x-7)/0.5) AS BIGINT), CAST(floor((x+7)/0.5) AS BIGINT)+1)) AS ix FROM candidates) c),
 cs AS (SELECT cand_id, model, drive_id, ix, iy FROM (SELECT *, (ix+0.5)*0.5 AS px, (iy+0.5)*0.5 AS py FROM gr) c WHERE {INSIDE})"""


@query("e15_cell_set_overlap", f"""WITH {CELLSET}, n AS (SELECT cand_id, count(*) AS n FROM cs GROUP BY 1), ab AS (SELECT a.cand_id AS a_id, b.cand_id AS b_id, count(*) AS n_ab FROM cs a JOIN cs b ON a.ix=b.ix AND a.iy=b.iy WHERE a.model='F' AND b.model='O' GROUP BY ALL)
 SELECT a_id, b_id, n_ab, round(n_ab/CAST(p.n+q.n-n_ab AS DOUBLE),6) AS iou, round(n_ab/CAST(least(p.n,q.n) AS DOUBLE),6) AS overlap, round(n_ab/CAST(p.n AS DOUBLE),6) AS inside_ratio FROM ab JOIN n p ON p.cand_id=a_id JOIN n q ON q.cand_id=b_id""")
def _(c):
    return G.cell_set_overlap(cells_of(c, "F", "a_id"), cells_of(c, "O", "b_id"), "a_id", "b_id")


@query("e15_convex_clip_iou")
def _(c):
    a = ringed(c).filter("model = 'F'").select(C("cand_id").alias("a_id"), C("ring").alias("a_ring"), *[C(k).alias("a_" + k) for k in ("minx", "miny", "maxx", "maxy")])
    b = ringed(c).filter("model = 'O'").select(C("cand_id").alias("b_id"), C("ring").alias("b_ring"), *[C(k).alias("b_" + k) for k in ("minx", "miny", "maxx", "maxy")])
    j = J.boxes_overlapping(a, b, 16.0).withColumn("i", E.convex_overlap_area("a_ring", "b_ring"))
    return j.select("a_id", "b_id", "i", (C("i") / (E.area(C("a_ring")) + E.area(C("b_ring")) - C("i"))).alias("iou")).filter("i > 0")


@query("e20_corridor_points", f"""WITH {LINE}, q AS (SELECT pt_id, drive_id, x AS qx, y AS qy FROM points), t AS (SELECT q.drive_id, pt_id, qx, qy, {SEGD} AS t, x, y, nx, ny FROM q JOIN sg ON q.drive_id=sg.drive_id AND nx IS NOT NULL AND qx BETWEEN least(x,nx)-6 AND greatest(x,nx)+6 AND qy BETWEEN least(y,ny)-6 AND greatest(y,ny)+6)
 SELECT drive_id, CAST(floor(qx/10.0) AS BIGINT) AS ix, CAST(floor(qy/10.0) AS BIGINT) AS iy FROM t WHERE pow(qx-x-t*(nx-x),2)+pow(qy-y-t*(ny-y),2) <= 36.0 GROUP BY ALL""")
def _(c):
    seg = L.segments(c.poses.select("drive_id", "frame_id", "x", "y"), ["drive_id"], "frame_id")
    seg = seg.select("drive_id", C("x").alias("ax"), C("y").alias("ay"), C("n_x").alias("bx"), C("n_y").alias("by_"))
    p = J.near_segments(c.points.select("drive_id", "x", "y").distinct(), seg, 6.0, ["drive_id"])
    return G.with_cell(p, 10.0).select("drive_id", "ix", "iy").distinct()


@query("e21_road_clip", f"""WITH {CELLSET}, rd AS (SELECT DISTINCT CAST(floor(x/2.0) AS BIGINT) AS ix, CAST(floor(y/2.0) AS BIGINT) AS iy FROM points), r AS (SELECT cs.cand_id, avg(CASE WHEN rd.ix IS NULL THEN 0.0 ELSE 1.0 END) AS ratio FROM cs LEFT JOIN rd ON rd.ix=CAST(floor(cs.ix/4.0) AS BIGINT) AND rd.iy=CAST(floor(cs.iy/4.0) AS BIGINT) GROUP BY 1)
 SELECT cand_id, round(ratio,6) AS ratio FROM r WHERE ratio>=0.3117""")
def _(c):
    cs = S.raster_blocks(c.candidates.withColumn("ring", RING()), "cand_id", "ring", 0.5, 4)
    road = c.points.select(G.floor_div(C("x"), 2.0).alias("jx"), G.floor_div(C("y"), 2.0).alias("jy")).distinct().withColumn("r", F.lit(1))
    j = cs.join(shuffled(road), ["jx", "jy"], "left")
    return j.groupBy("cand_id").agg((F.sum(C("n") * F.coalesce("r", F.lit(0))) / F.sum("n")).alias("ratio")).filter("ratio >= 0.3117")


@query("e22_ring_signature", "SELECT count(*) AS shapes, count(DISTINCT (x, y, rect_l, rect_w, angle)) AS signatures FROM candidates")
def _(c):
    s = c.candidates.select(E.ring_signature(RING()).alias("s"))
    return s.groupBy("s").agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("shapes"), F.count(F.lit(1)).alias("signatures"))


@query("e23_rect_at_heading", """WITH h AS (SELECT *, radians(frame_id%180) AS a FROM points), r AS (SELECT drive_id, frame_id, cos(a) AS ca, sin(a) AS sa, x*cos(a)+y*sin(a) AS u, y*cos(a)-x*sin(a) AS v FROM h),
 q AS (SELECT drive_id, frame_id, max(ca) ca, max(sa) sa, quantile_cont(u,0.05) u0, quantile_cont(u,0.95) u1, quantile_cont(v,0.05) v0, quantile_cont(v,0.95) v1 FROM r GROUP BY 1,2)
 SELECT drive_id, frame_id, round(u1-u0,5) AS along, round(v1-v0,5) AS across, round((u0+u1)/2*ca-(v0+v1)/2*sa,5)+0.0 AS cx, round((u0+u1)/2*sa+(v0+v1)/2*ca,5)+0.0 AS cy FROM q""")
def _(c):
    r = S.rect_at_heading(c.points, ["drive_id", "frame_id"], (C("frame_id") % 180).cast("double"))
    return r.select("drive_id", "frame_id", *[(F.round(k, 5) + 0.0).alias(k) for k in ("along", "across", "cx", "cy")])


@query("e24_simplify")
def _(c):
    kept = L.simplified(c.poses.select("drive_id", "frame_id", "x", "y"), ["drive_id"], "frame_id", 10.0)
    kept = O.dense_index(kept, ["drive_id"], ["frame_id"], F.floor(C("frame_id") / O.CHUNK), "idx")
    count = F.count(F.lit(1))
    ln = L.arc_length(kept, ["drive_id"], "idx").groupBy("drive_id").agg(count.alias("kept"), F.max("s").alias("length"))
    return c.poses.groupBy("drive_id").agg(count.alias("vertices")).join(ln, "drive_id")


@query("e25_ray_probe", """WITH w AS (SELECT prior_id, minx ax, miny ay, maxx bx, miny by_ FROM priors UNION ALL SELECT prior_id, maxx, miny, maxx, maxy FROM priors UNION ALL SELECT prior_id, maxx, maxy, minx, maxy FROM priors UNION ALL SELECT prior_id, minx, maxy, minx, miny FROM priors),
 r AS (SELECT event_id AS ray_id, x, y, cos(yaw) ux, sin(yaw) uy FROM poses), j AS (SELECT ray_id, ((ax-x)*(by_-ay)-(ay-y)*(bx-ax))/nullif(ux*(by_-ay)-uy*(bx-ax),0) AS t, ((ax-x)*uy-(ay-y)*ux)/nullif(ux*(by_-ay)-uy*(bx-ax),0) AS u FROM r, w)
 SELECT ray_id, round(min(t),5) AS hit FROM j WHERE t BETWEEN 0 AND 30 AND u BETWEEN 0 AND 1 GROUP BY 1""")
def _(c):
    rays = c.poses.select(C("event_id").alias("ray_id"), "x", "y", F.cos("yaw").alias("ux"), F.sin("yaw").alias("uy"))
    return L.ray_hits(rays, L.box_walls(c.priors), 30.0).withColumn("hit", F.round("hit", 5))


@query("p35_image_tiles", """WITH im AS (SELECT p_partkey, 640+p_size*20 AS w, 376+p_size*8 AS h FROM part), t AS (SELECT *, UNNEST(range(0,h,448)) AS y0 FROM (SELECT *, UNNEST(range(0,w,448)) AS x0 FROM im))
 SELECT p_partkey, CAST(x0 AS BIGINT) AS x0, CAST(y0 AS BIGINT) AS y0, CAST(least(w,x0+512) AS BIGINT) AS x1, CAST(least(h,y0+512) AS BIGINT) AS y1 FROM t""")
def _(c):
    im = c.part.select("p_partkey", (640 + C("p_size") * 20).cast("long").alias("w"), (376 + C("p_size") * 8).cast("long").alias("h"))
    starts = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), C(n) - 1, F.lit(448).cast("long")))
    t = im.select("*", starts("w").alias("x0")).select("*", starts("h").alias("y0"))
    return t.select("p_partkey", "x0", "y0", F.least("w", C("x0") + 512).alias("x1"), F.least("h", C("y0") + 512).alias("y1"))
