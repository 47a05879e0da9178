"""Grid aggregations over the point table (10 m cells)."""

from pyspark.sql import functions as F

from wayfold.operators import grid as G
from wayfold.functions.stats import exact_percentiles
from wayfold.queries.catalog import C, query

RES, BY = 10.0, ["drive_id"]
CELLS = "cells AS (SELECT *, CAST(floor(x/10.0) AS BIGINT) AS ix, CAST(floor(y/10.0) AS BIGINT) AS iy FROM points)"
P10 = f"{CELLS}, p10 AS (SELECT drive_id, ix, iy, quantile_cont(z, 0.1) AS h, count(*) AS n FROM cells GROUP BY ALL)"
RAST = f"""{P10}, rast AS (SELECT c.drive_id, c.ix, c.iy, max(h) AS height_p10, max(n) AS density_all,
 count(*) FILTER (z <= h+0.4567) AS density, max(intensity) FILTER (z <= h+0.4567) AS intensity_max, stddev_pop(z) FILTER (z <= h+0.4567) AS roughness
 FROM cells c JOIN p10 p ON c.drive_id=p.drive_id AND c.ix=p.ix AND c.iy=p.iy GROUP BY c.drive_id, c.ix, c.iy)"""
ROAD = f"{RAST}, road AS (SELECT * FROM rast WHERE density_all >= 5 AND (roughness IS NULL OR roughness <= 0.4137))"
BASE = f"{CELLS}, base AS (SELECT drive_id, ix, iy, min(z) AS z_base FROM cells GROUP BY ALL)"
CAND = f"""{BASE}, cand AS (SELECT c.drive_id, c.ix, c.iy, count(*) AS cand_n, sum(z) AS sum_z, sum(z*z) AS sum_z2, max(intensity) AS intensity_max
 FROM cells c JOIN base b ON c.drive_id=b.drive_id AND c.ix=b.ix AND c.iy=b.iy WHERE z - z_base <= 1.0 GROUP BY c.drive_id, c.ix, c.iy)"""
SLOPE = f"""{CAND}, lim AS (SELECT drive_id, min(ix) lox, max(ix) hix, min(iy) loy, max(iy) hiy FROM base GROUP BY 1),
 slp AS (SELECT b.drive_id, b.ix, b.iy, b.z_base,
  CASE WHEN lox=hix THEN 0 WHEN b.ix=lox THEN e.z_base-b.z_base WHEN b.ix=hix THEN b.z_base-w.z_base ELSE (e.z_base-w.z_base)/2 END / 10.0 AS gx,
  CASE WHEN loy=hiy THEN 0 WHEN b.iy=loy THEN n.z_base-b.z_base WHEN b.iy=hiy THEN b.z_base-s.z_base ELSE (n.z_base-s.z_base)/2 END / 10.0 AS gy
  FROM base b JOIN lim USING (drive_id)
  LEFT JOIN base e ON e.drive_id=b.drive_id AND e.ix=b.ix+1 AND e.iy=b.iy LEFT JOIN base w ON w.drive_id=b.drive_id AND w.ix=b.ix-1 AND w.iy=b.iy
  LEFT JOIN base n ON n.drive_id=b.drive_id AND n.ix=b.ix AND n.iy=b.iy+1 LEFT JOIN base s ON s.drive_id=b.drive_id AND s.ix=b.ix AND s.iy=b.iy-1)"""
MASK = f"""{SLOPE}, surf AS (SELECT c.drive_id, c.ix, c.iy, z_base, sqrt(greatest(sum_z2/cand_n-(sum_z/cand_n)*(sum_z/cand_n),0)) AS z_std,
 sqrt(gx*gx+gy*gy) AS slope FROM cand c JOIN slp s ON c.drive_id=s.drive_id AND c.ix=s.ix AND c.iy=s.iy
 WHERE cand_n >= 2 AND sqrt(greatest(sum_z2/cand_n-(sum_z/cand_n)*(sum_z/cand_n),0)) <= 0.3137 AND sqrt(gx*gx+gy*gy) <= 0.0403)"""


def near(table, cols, r):
    """SQL: join every cell of ``b`` with the window of ``table`` around it."""
    return f"FROM {table} b JOIN {table} w ON w.drive_id=b.drive_id AND w.ix BETWEEN b.ix-{r} AND b.ix+{r} AND w.iy BETWEEN b.iy-{r} AND b.iy+{r} GROUP BY {cols}"


def cc_sql(mask, diagonal=True):
    """SQL: component label (smallest packed cell) of a mask with drive_id, ix, iy."""
    moves = [(x, y) for x in (-1, 0, 1) for y in (-1, 0, 1) if (x or y) and (diagonal or not (x and y))]
    o = ", ".join(f"({x},{y})" for x, y in moves)
    return f"""msk AS (SELECT *, (drive_id*100000000 + (ix+100)*10000 + iy+100) AS id FROM {mask}), mv AS (SELECT m.drive_id, m.id, m.ix+dx AS jx, m.iy+dy AS jy FROM msk m, (VALUES {o}) AS q(dx, dy)),
 adj AS (SELECT a.id AS s, b.id AS d FROM mv a JOIN msk b ON a.drive_id=b.drive_id AND b.ix=a.jx AND b.iy=a.jy),
 cc(id, label) USING KEY (id) AS (SELECT id, id FROM msk UNION
  SELECT adj.d, min(cc.label) FROM cc JOIN adj ON adj.s=cc.id JOIN recurring.cc AS r ON r.id=adj.d WHERE cc.label < r.label GROUP BY adj.d)"""


@query("r01_cell_density", f"WITH {CELLS} SELECT drive_id, ix, iy, count(*) AS n FROM cells GROUP BY ALL")
def _(c):
    return G.cell_density(c.points, RES, BY)


@query("r01_merged_density", """SELECT CAST(floor(x/10.0) AS BIGINT) AS ix, CAST(floor(y/10.0) AS BIGINT) AS iy, count(*) AS n
 FROM (SELECT x, y FROM points UNION ALL SELECT x, y FROM poses) GROUP BY ALL""")
def _(c):
    return G.merge_counts(G.cell_density(c.points, RES), G.cell_density(c.poses, RES)).withColumn("n", C("n").cast("long"))


@query("r02_ground_rasters", f"""WITH {RAST} SELECT drive_id, ix, iy, round(height_p10,6) AS height_p10, density_all, density, round(intensity_max,6) AS intensity_max, round(roughness,6) AS roughness FROM rast""")
def _(c):
    return G.ground_rasters(c.points, RES, 0.4567, BY)


@query("r03_height_and_intensity", f"WITH {CELLS} SELECT drive_id, ix, iy, round(quantile_cont(z,0.1),6) AS height_p10, round(avg(intensity),6) AS intensity_mean FROM cells GROUP BY ALL")
def _(c):
    return G.height_and_intensity(c.points, RES, BY)


@query("r04_height_stats_min_points", f"""WITH {CELLS} SELECT drive_id, ix, iy, count(*) AS n, CASE WHEN count(*)>=5 THEN round(avg(z),6) ELSE 0 END AS mean,
 CASE WHEN count(*)>=5 THEN round(quantile_cont(z,0.1),6) ELSE 0 END AS p10, CASE WHEN count(*)>=5 THEN round(quantile_cont(z,0.95),6) ELSE 0 END AS p95 FROM cells GROUP BY ALL""")
def _(c):
    return G.height_stats(c.points, RES, 5, BY)


@query("r05_box_window", f"""WITH {BASE} SELECT b.drive_id, b.ix, b.iy, any_value(round(b.z_base,6)) AS z_base, count(*) AS win_n, round(sum(w.z_base),6) AS win_sum,
 round(avg(w.z_base),6) AS win_mean, round(stddev_pop(w.z_base),6) AS win_std {near('base', 'b.drive_id, b.ix, b.iy', 2)}""")
def _(c):
    return G.box_window(G.min_height(c.points, RES, BY), "z_base", 2, BY)


@query("r06_window_median_mad", f"""WITH {BASE}, md AS (SELECT b.drive_id, b.ix, b.iy, median(w.z_base) AS m {near('base', 'b.drive_id, b.ix, b.iy', 1)})
 SELECT m.drive_id, m.ix, m.iy, round(any_value(b.z_base),6) AS z_base, round(any_value(m.m),6) AS win_median, round(median(abs(w.z_base-m.m)),6) AS win_mad FROM md m
 JOIN base b ON b.drive_id=m.drive_id AND b.ix=m.ix AND b.iy=m.iy
 JOIN base w ON w.drive_id=m.drive_id AND w.ix BETWEEN m.ix-1 AND m.ix+1 AND w.iy BETWEEN m.iy-1 AND m.iy+1 GROUP BY m.drive_id, m.ix, m.iy""")
def _(c):
    return G.window_mad(G.min_height(c.points, RES, BY), "z_base", 1, BY)


@query("r07_min_height", f"WITH {BASE} SELECT drive_id, ix, iy, round(z_base,6) AS z_base FROM base")
def _(c):
    return G.min_height(c.points, RES, BY)


@query("r08_candidate_stats", f"WITH {CAND} SELECT drive_id, ix, iy, cand_n, round(sum_z,6) AS sum_z, round(sum_z2,6) AS sum_z2, round(intensity_max,6) AS intensity_max FROM cand")
def _(c):
    return G.candidate_stats(c.points, G.min_height(c.points, RES, BY), RES, 1.0, BY)


@query("r09_moment_std", f"WITH {CAND} SELECT drive_id, ix, iy, round(sqrt(greatest(sum_z2/cand_n-(sum_z/cand_n)*(sum_z/cand_n),0)),6) AS z_std FROM cand")
def _(c):
    s = G.candidate_stats(c.points, G.min_height(c.points, RES, BY), RES, 1.0, BY)
    return s.select(*BY, "ix", "iy", G.moment_std(C("cand_n"), C("sum_z"), C("sum_z2")).alias("z_std"))


@query("r10_slope", f"WITH {SLOPE} SELECT drive_id, ix, iy, round(z_base,6) AS z_base, round(sqrt(gx*gx+gy*gy),6) AS slope FROM slp")
def _(c):
    return G.slope(G.min_height(c.points, RES, BY), "z_base", RES, BY)


def surface(c):
    base = G.min_height(c.points, RES, BY)
    return G.surface_mask(G.candidate_stats(c.points, base, RES, 1.0, BY), G.slope(base, "z_base", RES, BY), 2, 0.3137, 0.0403, BY)


@query("r11_surface_mask", f"WITH {MASK} SELECT drive_id, ix, iy, round(z_std,6) AS z_std, round(slope,6) AS slope FROM surf")
def _(c):
    return surface(c).select(*BY, "ix", "iy", "z_std", "slope")


@query("r12_reference_surface", f"""WITH {CELLS} SELECT drive_id, ix, iy, round(quantile_cont(z,0.05),6) AS z_ref, count(*) AS n FROM cells GROUP BY drive_id, ix, iy HAVING count(*)>=3""")
def _(c):
    return G.reference_surface(c.points, RES, 0.05, 3, BY)


@query("r14_smooth_and_fill", f"""WITH {CELLS}, ref AS (SELECT drive_id, ix, iy, quantile_cont(z,0.05) AS v FROM cells GROUP BY ALL HAVING count(*)>=12),
 o AS (SELECT UNNEST(range(-1,2)) AS d), t AS (SELECT DISTINCT drive_id, ix+a.d AS ix, iy+b.d AS iy FROM ref, o a, o b),
 sm AS (SELECT t.drive_id, t.ix, t.iy, avg(v) AS z FROM t JOIN ref w ON w.drive_id=t.drive_id AND w.ix BETWEEN t.ix-1 AND t.ix+1 AND w.iy BETWEEN t.iy-1 AND t.iy+1 GROUP BY ALL),
 t2 AS (SELECT DISTINCT drive_id, ix+a.d AS ix, iy+b.d AS iy FROM sm, o a, o b),
 fl AS (SELECT t.drive_id, t.ix, t.iy, median(w.z) AS z FROM t2 t ANTI JOIN sm USING (drive_id, ix, iy) JOIN sm w ON w.drive_id=t.drive_id AND w.ix BETWEEN t.ix-1 AND t.ix+1 AND w.iy BETWEEN t.iy-1 AND t.iy+1 GROUP BY ALL)
 SELECT drive_id, ix, iy, round(z,6) AS z_smooth, false AS filled FROM sm UNION ALL SELECT drive_id, ix, iy, round(z,6), true FROM fl""")
def _(c):
    return G.smooth_and_fill(G.reference_surface(c.points, RES, 0.05, 12, BY), "z_ref", 1, BY)


@query("r15_terrain_grid", f"WITH {CELLS} SELECT drive_id, ix, iy, count(*) AS n, round(median(z),6) AS z_median, round(stddev_pop(z),6) AS z_std FROM cells GROUP BY ALL HAVING count(*)>=4")
def _(c):
    return G.terrain_grid(c.points, RES, 4, BY)


@query("r15_terrain_std_percentiles", f"""WITH {CELLS}, t AS (SELECT drive_id, stddev_pop(z) AS s FROM cells GROUP BY drive_id, ix, iy HAVING count(*)>=4)
 SELECT drive_id, count(*) AS n, round(quantile_cont(s,0.5),6) AS median, round(quantile_cont(s,0.9),6) AS p90, round(quantile_cont(s,0.99),6) AS p99 FROM t GROUP BY 1""")
def _(c):
    return exact_percentiles(G.terrain_grid(c.points, RES, 4, BY), BY, "z_std", {"median": .5, "p90": .9, "p99": .99}, 0.01)


TILES = """b AS (SELECT drive_id, min(x) AS x0, max(y) AS y1 FROM points GROUP BY 1), rc AS (SELECT p.drive_id, intensity, CAST(floor((x-x0)/10.0) AS BIGINT) AS c, CAST(floor((y1-y)/10.0) AS BIGINT) AS r FROM points p JOIN b USING (drive_id)),
 tl AS (SELECT drive_id, c//8 AS tile_x, r//8 AS tile_y, r%8 AS "row", c%8 AS "col", max(intensity) AS intensity_max, count(*) AS density FROM rc GROUP BY ALL)"""


@query("r16_bev_tiles", f'WITH {TILES} SELECT drive_id, tile_x, tile_y, "row", "col", round(intensity_max,6) AS intensity_max, density FROM tl')
def _(c):
    return G.bev_tiles(c.points, RES, 8, BY)


@query("r16_bev_tile_summary", f"""WITH {TILES}, a AS (SELECT drive_id, count(*)*100.0::DOUBLE AS area FROM tl GROUP BY drive_id, tile_x, tile_y)
 SELECT drive_id, count(*) AS tiles, count(*) FILTER (area>=5000) AS kept, round(avg(CASE WHEN area<5000 THEN 1.0 ELSE 0.0 END),6) AS empty_ratio FROM a GROUP BY 1""")
def _(c):
    return G.tile_summary(G.bev_tiles(c.points, RES, 8, BY), RES, 5000.0, BY)


@query("r16_tophat_percentiles", f"""WITH {CELLS}, v AS (SELECT drive_id, ix, iy, max(intensity) AS z_base FROM cells GROUP BY ALL), t AS (SELECT b.drive_id, greatest(any_value(b.z_base)-avg(w.z_base),0) AS th {near('v', 'b.drive_id, b.ix, b.iy', 2)})
 SELECT drive_id, count(*) AS n, round(quantile_cont(th,0.95),6) AS p95, round(quantile_cont(th,0.98),6) AS p98 FROM t GROUP BY 1""")
def _(c):
    v = G.with_cell(c.points, RES).groupBy(*BY, *G.CELL).agg(F.max("intensity").alias("v"))
    t = G.contrast_features(v, "v", 2, 1, BY)
    return exact_percentiles(t, BY, "tophat", {"p95": .95, "p98": .98}, 0.001)


@query("r17_marking_contrast", f"""WITH {P10}, v AS (SELECT c.drive_id, c.ix, c.iy, quantile_cont(intensity,0.95) AS p95 FROM cells c JOIN p10 p ON c.drive_id=p.drive_id AND c.ix=p.ix AND c.iy=p.iy WHERE z<=h+0.4567 GROUP BY ALL)
 SELECT b.drive_id, b.ix, b.iy, round(any_value(b.p95),6) AS p95, round(greatest(any_value(b.p95)-avg(w.p95),0),6) AS contrast {near('v', 'b.drive_id, b.ix, b.iy', 2)}""")
def _(c):
    return G.marking_contrast(c.points, RES, 0.4567, 2, BY)


RPTS = f"{ROAD}, rp AS (SELECT c.drive_id, c.ix, c.iy, c.z, c.intensity FROM cells c JOIN road r ON c.drive_id=r.drive_id AND c.ix=r.ix AND c.iy=r.iy WHERE c.z<=r.height_p10+0.4567)"
SCORE = f"""{RPTS}, th AS (SELECT drive_id, quantile_cont(intensity,0.75) AS thr FROM rp GROUP BY 1),
 sc AS (SELECT drive_id, ix, iy, CAST(count(*) FILTER (intensity>=thr) AS DOUBLE)/count(*) AS score, max(thr) AS thr FROM rp JOIN th USING (drive_id) GROUP BY drive_id, ix, iy)"""


def scores(c):
    return G.marking_score(G.road_points(c.points, RES, 0.4567, 5, 0.4137, BY), 0.75, BY, 0.01)


@query("r18_marking_score", f"WITH {SCORE} SELECT drive_id, ix, iy, round(score,6) AS score, round(thr,6) AS thr FROM sc")
def _(c):
    return scores(c)


@query("r19_ratio_threshold", f"""WITH {SCORE}, q AS (SELECT drive_id, quantile_cont(score,0.85) AS tm, quantile_cont(score,0.95) AS tl, quantile_cont(score,0.75) AS th2 FROM sc GROUP BY 1),
 s AS (SELECT drive_id, any_value(tm) tm, any_value(tl) tl, any_value(th2) th2, avg(CAST(score>=tm AS INT)) AS sm, avg(CAST(score>=tl AS INT)) AS sl, avg(CAST(score>=th2 AS INT)) AS sh FROM sc JOIN q USING (drive_id) GROUP BY 1),
 f AS (SELECT drive_id, CASE WHEN sm<0.05 THEN tl WHEN sm>0.25 THEN th2 ELSE tm END AS t, CASE WHEN sm<0.05 THEN sl WHEN sm>0.25 THEN sh ELSE sm END AS r FROM s)
 SELECT drive_id, round(t,6) AS threshold, round(r,6) AS ratio, round((1-r)*100,6) AS percentile FROM f""")
def _(c):
    return G.ratio_threshold(scores(c), "score", 0.05, 0.25, BY, 0.001)


@query("r20_component_sizes", f"""WITH RECURSIVE {MASK}, {cc_sql('surf')}, z AS (SELECT drive_id, label, count(*) AS n FROM msk JOIN cc USING (id) GROUP BY ALL)
 SELECT drive_id, n AS cells, n*100.0::DOUBLE AS area_m2, count(*) AS components FROM z GROUP BY ALL""")
def _(c):
    a = G.area_components(surface(c), RES, BY, True)
    return a.groupBy("drive_id", "cells", "area_m2").agg(F.count(F.lit(1)).alias("components"))


SEED = "seed AS (SELECT DISTINCT drive_id % 8 AS drive_id, CAST(floor(x/10.0) AS BIGINT) AS ix, CAST(floor(y/10.0) AS BIGINT) AS iy FROM poses)"


def seeds(c):
    return G.with_cell(c.poses.withColumn("drive_id", C("drive_id") % 8), RES).select("drive_id", "ix", "iy").distinct()


@query("r20_seeded_components", f"""WITH RECURSIVE {MASK}, {SEED}, {cc_sql('surf')}, z AS (SELECT m.drive_id, label, count(*) AS n, count(s.ix) AS hits FROM msk m JOIN cc USING (id) LEFT JOIN seed s ON s.drive_id=m.drive_id AND s.ix=m.ix AND s.iy=m.iy GROUP BY ALL),
 k AS (SELECT *, row_number() OVER (PARTITION BY drive_id ORDER BY n DESC, label) AS r FROM z WHERE hits>0)
 SELECT m.drive_id, m.ix, m.iy, k.n AS cells FROM msk m JOIN cc USING (id) JOIN k ON k.drive_id=m.drive_id AND k.label=cc.label AND r<=5""")
def _(c):
    return G.seeded_components(surface(c), seeds(c), 5, BY).select(*BY, "ix", "iy", "cells")


@query("r21_seed_flood", f"""WITH RECURSIVE {MASK}, {SEED}, {cc_sql('surf')}, l AS (SELECT m.*, label FROM msk m JOIN cc USING (id)),
 h AS (SELECT DISTINCT l.drive_id, label FROM l JOIN seed s ON s.drive_id=l.drive_id AND s.ix=l.ix AND s.iy=l.iy)
 SELECT drive_id, ix, iy FROM l WHERE (drive_id, label) IN (SELECT (drive_id, label) FROM h) OR drive_id NOT IN (SELECT drive_id FROM h)""")
def _(c):
    return G.flood_from_seed(surface(c), seeds(c), BY).select(*BY, "ix", "iy")


@query("r22_mask_regions", f"""WITH RECURSIVE {MASK}, {cc_sql('surf', False)}, z AS (SELECT drive_id, label, count(*)*100.0::DOUBLE AS a FROM msk JOIN cc USING (id) GROUP BY ALL)
 SELECT drive_id, count(*) FILTER (a>=400) AS regions, round(sum(a) FILTER (a>=400),6) AS area_m2, round(max(a),6) AS largest_m2, count(*) FILTER (a<400) AS islands FROM z GROUP BY 1""")
def _(c):
    a = G.area_components(surface(c), RES, BY, False)
    big = C("area_m2") >= 400
    return a.groupBy(*BY).agg(F.count_if(big).alias("regions"), F.sum(F.when(big, C("area_m2"))).alias("area_m2"),
                              F.max("area_m2").alias("largest_m2"), F.count_if(~big).alias("islands"))


@query("r23_road_cells_by_drive", f"""WITH {ROAD} SELECT a.drive_id, count(r.ix) AS road_cells, round(count(r.ix)*100.0::DOUBLE,6) AS road_area_m2, round(count(r.ix)/CAST(count(*) AS DOUBLE),6) AS road_cover,
 CAST(sum(r.density) AS BIGINT) AS road_points FROM rast a LEFT JOIN road r ON a.drive_id=r.drive_id AND a.ix=r.ix AND a.iy=r.iy GROUP BY 1""")
def _(c):
    r = G.ground_rasters(c.points, RES, 0.4567, BY)
    ok = (C("density_all") >= 5) & (C("roughness").isNull() | (C("roughness") <= 0.4137))
    n = F.count_if(ok)
    return r.groupBy(*BY).agg(n.alias("road_cells"), (n * 100.0).alias("road_area_m2"), (n / F.count(F.lit(1))).alias("road_cover"),
                              F.sum(F.when(ok, C("density"))).alias("road_points"))


@query("r23_road_points", f"WITH {RPTS} SELECT drive_id, ix, iy, count(*) AS n, round(avg(z),6) AS z_mean FROM rp GROUP BY ALL")
def _(c):
    return G.road_points(c.points, RES, 0.4567, 5, 0.4137, BY).groupBy(*BY, *G.CELL).agg(F.count(F.lit(1)).alias("n"), F.avg("z").alias("z_mean"))


@query("r24_voxel_first", """SELECT drive_id, vx, vy, vz, s.pt_id AS pt_id, round(s.x,6) AS x, round(s.y,6) AS y, round(s.z,6) AS z, round(s.intensity,6) AS intensity FROM (
 SELECT drive_id, CAST(floor(x/5.0) AS BIGINT) AS vx, CAST(floor(y/5.0) AS BIGINT) AS vy, CAST(floor(z/5.0) AS BIGINT) AS vz, min({'pt_id':pt_id,'x':x,'y':y,'z':z,'intensity':intensity}) AS s FROM points GROUP BY ALL)""")
def _(c):
    return G.voxel_first(c.points, 5.0, BY)


@query("r25_coverage", f"""WITH {MASK}, {SEED}, o AS (SELECT UNNEST(range(-1,2)) AS d), cor AS (SELECT DISTINCT drive_id, ix+a.d AS ix, iy+b.d AS iy FROM seed, o a, o b), roi AS (SELECT DISTINCT drive_id, ix, iy FROM base),
 u AS (SELECT drive_id, ix, iy, max(m) m, max(r) r, max(c) c FROM (SELECT drive_id, ix, iy, 1 m, 0 r, 0 c FROM surf UNION ALL SELECT drive_id, ix, iy, 0,1,0 FROM roi UNION ALL SELECT drive_id, ix, iy, 0,0,1 FROM cor) GROUP BY ALL),
 s AS (SELECT drive_id, count(*) FILTER (r=1)*100.0::DOUBLE roi, count(*) FILTER (m=1 AND r=1)*100.0::DOUBLE mk, count(*) FILTER (c=1)*100.0::DOUBLE co, count(*) FILTER (m=1 AND c=1)*100.0::DOUBLE i, count(*) FILTER (m=1 AND c=0 AND r=1)*100.0::DOUBLE o FROM u GROUP BY 1)
 SELECT drive_id, mk AS mask_area_m2, roi AS roi_area_m2, co AS corridor_area_m2, round(mk/roi,6) AS mask_coverage, round(i/co,6) AS corridor_coverage, round(o/roi,6) AS outside_ratio FROM s""")
def _(c):
    return G.coverage(surface(c), G.min_height(c.points, RES, BY), G.dilate(seeds(c), 1, BY), RES, BY)


@query("r26_surface_points", f"""WITH {MASK} SELECT c.drive_id, c.ix, c.iy, count(*) AS n, round(max(c.intensity),6) AS intensity_max, count(*) FILTER (c.intensity>0) AS nonzero
 FROM cells c JOIN surf s ON c.drive_id=s.drive_id AND c.ix=s.ix AND c.iy=s.iy WHERE c.z-s.z_base<=0.5 GROUP BY ALL""")
def _(c):
    p = G.surface_points(c.points, G.min_height(c.points, RES, BY), surface(c), RES, 0.5, BY)
    return p.groupBy(*BY, *G.CELL).agg(F.count(F.lit(1)).alias("n"), F.max("intensity").alias("intensity_max"), F.count_if(C("intensity") > 0).alias("nonzero"))


ROI = """rois AS (SELECT prior_id AS roi_id, minx-3 AS minx, miny-3 AS miny, maxx+3 AS maxx, maxy+3 AS maxy FROM priors),
 px AS (SELECT roi_id, CAST(floor((maxy-y)/2.0) AS BIGINT) AS "row", CAST(floor((x-minx)/2.0) AS BIGINT) AS "col", max(intensity) AS intensity_max, count(*) AS density
 FROM points JOIN rois ON x BETWEEN minx AND maxx AND y BETWEEN miny AND maxy GROUP BY ALL)"""


def patches(c):
    return G.roi_patches(c.points, c.priors.withColumnRenamed("prior_id", "roi_id"), 2.0, 3.0, 32.0)


@query("r27_roi_patches", f'WITH {ROI} SELECT roi_id, "row", "col", round(intensity_max,6) AS intensity_max, density FROM px')
def _(c):
    return patches(c)


@query("r27_roi_patch_stats", f"WITH {ROI} SELECT roi_id, count(*) AS n, round(quantile_cont(intensity_max,0.5),6) AS p50, round(quantile_cont(intensity_max,0.95),6) AS p95, round(quantile_cont(intensity_max,0.98),6) AS p98 FROM px GROUP BY 1")
def _(c):
    return exact_percentiles(patches(c), ["roi_id"], "intensity_max", {"p50": .5, "p95": .95, "p98": .98}, 0.01)


@query("p36_contrast_features", f"""WITH {BASE}, l AS (SELECT b.drive_id, b.ix, b.iy, any_value(b.z_base) AS v, avg(w.z_base) AS ml, stddev_pop(w.z_base) AS sl {near('base', 'b.drive_id, b.ix, b.iy', 3)}),
 s AS (SELECT b.drive_id, b.ix, b.iy, avg(w.z_base) AS ms {near('base', 'b.drive_id, b.ix, b.iy', 1)})
 SELECT l.drive_id, l.ix, l.iy, round(greatest(v-ml,0),6) AS tophat, round((v-ml)/(sl+0.001),6)+0.0 AS zscore, round(ms-ml,6)+0.0 AS dog FROM l JOIN s ON l.drive_id=s.drive_id AND l.ix=s.ix AND l.iy=s.iy""")
def _(c):
    return G.contrast_features(G.min_height(c.points, RES, BY), "z_base", 3, 1, BY)


DENSE = f"{BASE}, surf AS (SELECT drive_id, ix, iy FROM base WHERE z_base <= 1.2)"


def dense(c):
    return G.min_height(c.points, RES, BY).filter("z_base <= 1.2")


CLOSE = f"""o AS (SELECT UNNEST(range(-1,2)) AS d), dl AS (SELECT DISTINCT drive_id, ix+a.d AS ix, iy+b.d AS iy FROM surf, o a, o b),
 cl AS (SELECT b.drive_id, b.ix, b.iy {near('dl', 'b.drive_id, b.ix, b.iy', 1)} HAVING count(*)=9)"""


@query("e16_close_mask", f"WITH {MASK}, {CLOSE} SELECT drive_id, ix, iy FROM cl")
def _(c):
    return G.close_mask(surface(c), 1, BY)


@query("e16_open_mask", f"""WITH {DENSE}, o AS (SELECT UNNEST(range(-1,2)) AS d), er AS (SELECT b.drive_id, b.ix, b.iy {near('surf', 'b.drive_id, b.ix, b.iy', 1)} HAVING count(*)=9)
 SELECT DISTINCT drive_id, ix+a.d AS ix, iy+b.d AS iy FROM er, o a, o b""")
def _(c):
    return G.open_mask(dense(c), 1, BY)


@query("e17_close_in_corridor", f"""WITH {SLOPE}, {SEED}, o AS (SELECT UNNEST(range(-1,2)) AS d), cor AS (SELECT DISTINCT drive_id, ix+a.d AS ix, iy+b.d AS iy FROM seed, o a, o b),
 surf AS (SELECT DISTINCT drive_id, ix, iy FROM base SEMI JOIN cor USING (drive_id, ix, iy) WHERE z_base > 0.6), {CLOSE.split(', ', 1)[1]} SELECT drive_id, ix, iy FROM cl SEMI JOIN cor USING (drive_id, ix, iy)""")
def _(c):
    m = G.min_height(c.points, RES, BY).filter("z_base > 0.6")
    return G.close_in_corridor(m, G.dilate(seeds(c), 1, BY), 1, BY)


HOLES = f"""lim2 AS (SELECT drive_id, min(ix) a, max(ix) b, min(iy) c, max(iy) d FROM surf GROUP BY 1),
 gap AS (SELECT drive_id, ix, iy, ix=a-1 OR ix=b+1 OR iy=c-1 OR iy=d+1 AS edge FROM (SELECT *, UNNEST(range(c-1,d+2)) AS iy FROM (SELECT *, UNNEST(range(a-1,b+2)) AS ix FROM lim2)) ANTI JOIN surf USING (drive_id, ix, iy)),
 {cc_sql('gap', False)}, hl AS (SELECT drive_id, label, count(*) AS n FROM msk JOIN cc USING (id) GROUP BY ALL HAVING NOT bool_or(edge))"""


@query("e18_fill_small_holes", f"WITH RECURSIVE {DENSE}, {HOLES} SELECT drive_id, ix, iy FROM surf UNION ALL SELECT m.drive_id, m.ix, m.iy FROM msk m JOIN cc USING (id) JOIN hl ON hl.drive_id=m.drive_id AND hl.label=cc.label WHERE n<=3")
def _(c):
    return G.fill_small_holes(dense(c), None, 3, BY)


@query("e18_fill_corridor_holes", f"""WITH RECURSIVE {DENSE}, {SEED}, {HOLES}, hit AS (SELECT DISTINCT m.drive_id, label FROM msk m JOIN cc USING (id) JOIN seed s ON s.drive_id=m.drive_id AND s.ix=m.ix AND s.iy=m.iy)
 SELECT drive_id, ix, iy FROM surf UNION ALL SELECT m.drive_id, m.ix, m.iy FROM msk m JOIN cc USING (id) JOIN hl ON hl.drive_id=m.drive_id AND hl.label=cc.label JOIN hit ON hit.drive_id=m.drive_id AND hit.label=cc.label WHERE n<=6""")
def _(c):
    return G.fill_small_holes(dense(c), seeds(c), 6, BY)


@query("e19_hole_stats", f"WITH RECURSIVE {DENSE}, {HOLES} SELECT drive_id, count(*) AS holes, round(sum(n)*100.0::DOUBLE,6) AS hole_area_m2, round(max(n)*100.0::DOUBLE,6) AS largest_hole_m2 FROM hl GROUP BY 1")
def _(c):
    return G.hole_stats(dense(c), RES, BY)
