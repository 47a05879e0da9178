"""Engine tables derived from the driver tables, as DataFrames and as the same SQL for the check.

Every mapping is a plain column expression over the whole table, so a query's work grows with it.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from wayfold.operators.ordered import dense_index

C = F.col
D = lambda v: F.lit(float(v))


class Catalog:
    """Lazy DataFrames over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        raise AttributeError(name)

    @cached_property
    def points(self) -> DataFrame:
        return self.lineitem.select(
            (C("l_suppkey") % 8).alias("drive_id"),
            F.expr("l_orderkey div 100").alias("frame_id"),
            (C("l_orderkey") * 10 + C("l_linenumber")).cast("long").alias("pt_id"),
            (C("l_partkey") * D(0.25)).alias("x"),
            ((C("l_orderkey") % 997) * D(0.25)).alias("y"),
            (C("l_quantity") / 10).alias("z"),
            (C("l_discount") + C("l_extendedprice") / 10000000).alias("intensity"),
        )

    @cached_property
    def sweeps(self) -> DataFrame:
        """Sensor-frame points: small offsets around the vehicle, keyed like the poses."""
        return self.events.select(
            C("user_id").alias("drive_id"), C("event_id").alias("pt_id"),
            F.expr("event_id % 66").alias("frame_id"),
            (C("value") / 10).alias("x"), ((C("event_id") % 41) - 20).cast("double").alias("y"),
            (C("event_id") % 7 * D(0.3) - D(1.0)).alias("z"),
            (C("value") / 600).alias("intensity"),
        )

    @cached_property
    def poses(self) -> DataFrame:
        e = dense_index(self.events, ["user_id"], ["ts", "event_id"], F.to_date("ts"), "frame_id")
        return e.select(
            C("user_id").alias("drive_id"), "frame_id", "event_id", "ts",
            (C("frame_id") * D(8.0)).alias("x"), (C("value") / 5 + 100).alias("y"),
            (C("event_id") % 13 * D(0.1)).alias("z"),
            (C("event_id") % 5 * D(0.01)).alias("roll"), (C("event_id") % 7 * D(0.01)).alias("pitch"),
            (C("event_id") % 63 * D(0.1)).alias("yaw"),
        )

    @cached_property
    def trace(self) -> DataFrame:
        """One row per processed frame with the verification fields."""
        k = F.get_json_object("props", "$.k").cast("long")
        e = self.events.withColumn("k", k)
        return e.select(
            C("event_id").alias("frame_id"), C("user_id").alias("drive_id"), "ts", "k",
            F.when(C("event_type").isin("click", "view", "purchase"), 1).otherwise(0).cast("long").alias("raw_has_crosswalk"),
            F.when(C("k") % 3 != 0, 1).otherwise(0).cast("long").alias("geom_ok"),
            F.when(C("event_type").isin("click", "signup"), F.lit("lidar")).otherwise(F.lit("plane")).alias("proj_method"),
            F.when(C("k") % 5 == 0, 1).otherwise(0).cast("long").alias("stage2_added"),
            F.when(C("k") % 10 == 0, 1).otherwise(0).cast("long").alias("drift_flag"),
            F.when(C("k") % 4 == 0, F.lit("accum")).otherwise(F.lit("single")).alias("fit_source"),
            (C("value") / 600).alias("iou_bbox"), F.least(C("value") / 500, D(1)).alias("iou_dilated"),
            (C("event_id") % 97 * D(1.5)).alias("center_err"), C("k").alias("points_support"),
            F.concat_ws(",", F.when(C("k") % 2 == 0, F.lit("low_iou")), F.when(C("k") % 3 == 0, F.lit("size")),
                        F.when(C("k") % 7 == 0, F.lit("heading"))).alias("reject_reasons"),
            C("event_type").alias("kind"),
        )

    @cached_property
    def detections(self) -> DataFrame:
        """Image boxes of three models: 1408 x 376 frames."""
        k = F.get_json_object("props", "$.k").cast("long")
        x0 = (C("event_id") * 37 % 300).cast("double")
        y0 = (C("event_id") * 53 % 120).cast("double")
        return self.events.withColumn("k", k).select(
            C("event_id").alias("det_id"), F.expr("event_id div 40").alias("frame_id"), C("event_type").alias("class"),
            F.concat(F.lit("m"), (C("user_id") % 3).cast("string")).alias("model"), (C("value") / 600).alias("score"),
            x0.alias("x0"), y0.alias("y0"), (x0 + 60 + C("k")).alias("x1"), (y0 + 40 + C("k") % 50).alias("y1"),
        )

    @cached_property
    def candidates(self) -> DataFrame:
        """Map candidates: rotated rectangles with their attributes."""
        return self.orders.select(
            C("o_orderkey").alias("cand_id"), (C("o_custkey") % 8).alias("drive_id"), F.expr("o_orderkey div 10").alias("frame_id"),
            (C("o_orderkey") * D(0.5)).alias("x"), ((C("o_custkey") % 200) * D(1)).alias("y"),
            (C("o_orderkey") % 9 + D(2)).alias("rect_l"), (C("o_custkey") % 4 + D(1)).alias("rect_w"),
            ((C("o_orderkey") * 7 + C("o_custkey")) % 180 * D(1)).alias("angle"),
            (C("o_totalprice") / 500009).alias("conf"), C("o_orderpriority").alias("class"), C("o_orderstatus").alias("model"),
            ((C("o_custkey") % 10) / D(10)).alias("rectangularity"),
        )

    @cached_property
    def edges(self) -> DataFrame:
        """Road-graph edges between junction numbers."""
        return self.orders.select(
            C("o_orderkey").alias("edge_id"), C("o_orderkey").alias("from_node"),
            F.when(C("o_custkey") % 3 == 0, C("o_orderkey")).otherwise(C("o_orderkey") + 1 + C("o_custkey") % 3).alias("to_node"),
            (C("o_totalprice") / 50000 + 5).alias("length_m"), (C("o_custkey") % 8).alias("drive_id"),
            C("o_orderpriority").alias("highway"),
        )

    @cached_property
    def runs(self) -> DataFrame:
        """Measured geometry runs per (drive, arm, window) for gates and scores."""
        return self.orders.select(
            C("o_custkey").alias("drive_id"), C("o_orderpriority").alias("arm"), C("o_orderkey").alias("window_id"),
            (C("o_totalprice") / 500009).alias("c_ratio"), (C("o_orderkey") % 100 / D(100)).alias("b_rough"),
            (C("o_orderkey") % 11 * D(1)).alias("dangling_per_km"), (C("o_custkey") % 5 / D(50)).alias("conflict_rate"),
            F.expr("o_orderkey % 7").alias("n_intersections"), (C("o_totalprice") / F.lit(99.7)).alias("line_len"),
        )

    @cached_property
    def priors(self) -> DataFrame:
        """Drive boxes of the map priors."""
        return self.supplier.select(
            C("s_suppkey").alias("prior_id"), (C("s_suppkey") * D(5)).alias("minx"), (C("s_nationkey") * D(8)).alias("miny"),
            (C("s_suppkey") * D(5) + 12 + C("s_nationkey")).alias("maxx"), (C("s_nationkey") * D(8) + 40).alias("maxy"),
            C("s_acctbal").alias("quality"),
        )


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

VIEWS = {
    "points": """SELECT l_suppkey % 8 AS drive_id, l_orderkey // 100 AS frame_id, l_orderkey*10+l_linenumber AS pt_id,
 l_partkey*CAST(0.25 AS DOUBLE) AS x, (l_orderkey % 997)*CAST(0.25 AS DOUBLE) AS y, l_quantity/10 AS z, l_discount+l_extendedprice/10000000 AS intensity FROM lineitem""",
    "sweeps": """SELECT user_id AS drive_id, event_id AS pt_id, event_id % 66 AS frame_id, value/10 AS x,
 CAST((event_id % 41) - 20 AS DOUBLE) AS y, (event_id % 7)*CAST(0.3 AS DOUBLE) - CAST(1.0 AS DOUBLE) AS z, value/600 AS intensity FROM events""",
    "poses": """SELECT user_id AS drive_id, frame_id, event_id, ts, frame_id*CAST(8 AS DOUBLE) AS x, value/5+100 AS y,
 (event_id % 13)*CAST(0.1 AS DOUBLE) AS z, (event_id % 5)*CAST(0.01 AS DOUBLE) AS roll, (event_id % 7)*CAST(0.01 AS DOUBLE) AS pitch,
 (event_id % 63)*CAST(0.1 AS DOUBLE) AS yaw
 FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)-1 AS frame_id FROM events)""",
    "trace": """SELECT event_id AS frame_id, user_id AS drive_id, ts, k,
 CAST(event_type IN ('click','view','purchase') AS BIGINT) AS raw_has_crosswalk, CAST(k % 3 <> 0 AS BIGINT) AS geom_ok,
 CASE WHEN event_type IN ('click','signup') THEN 'lidar' ELSE 'plane' END AS proj_method,
 CAST(k % 5 = 0 AS BIGINT) AS stage2_added, CAST(k % 10 = 0 AS BIGINT) AS drift_flag,
 CASE WHEN k % 4 = 0 THEN 'accum' ELSE 'single' END AS fit_source,
 value/600 AS iou_bbox, least(value/500, CAST(1 AS DOUBLE)) AS iou_dilated, (event_id % 97)*CAST(1.5 AS DOUBLE) AS center_err, k AS points_support,
 concat_ws(',', CASE WHEN k % 2 = 0 THEN 'low_iou' END, CASE WHEN k % 3 = 0 THEN 'size' END, CASE WHEN k % 7 = 0 THEN 'heading' END) AS reject_reasons,
 event_type AS kind FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""",
    "detections": """SELECT event_id AS det_id, event_id // 40 AS frame_id, event_type AS class, 'm' || CAST(user_id % 3 AS VARCHAR) AS model, value/600 AS score,
 x0, y0, x0+60+k AS x1, y0+40+k % 50 AS y1 FROM (SELECT *, CAST(event_id*37 % 300 AS DOUBLE) AS x0, CAST(event_id*53 % 120 AS DOUBLE) AS y0,
 CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""",
    "candidates": """SELECT o_orderkey AS cand_id, o_custkey % 8 AS drive_id, o_orderkey // 10 AS frame_id, o_orderkey*CAST(0.5 AS DOUBLE) AS x,
 (o_custkey % 200)*CAST(1 AS DOUBLE) AS y, (o_orderkey % 9)+CAST(2 AS DOUBLE) AS rect_l, (o_custkey % 4)+CAST(1 AS DOUBLE) AS rect_w,
 CAST((o_orderkey*7+o_custkey) % 180 AS DOUBLE) AS angle, o_totalprice/500009 AS conf, o_orderpriority AS class, o_orderstatus AS model,
 (o_custkey % 10)/CAST(10 AS DOUBLE) AS rectangularity FROM orders""",
    "edges": """SELECT o_orderkey AS edge_id, o_orderkey AS from_node, CASE WHEN o_custkey % 3 = 0 THEN o_orderkey ELSE o_orderkey+1+o_custkey % 3 END AS to_node,
 o_totalprice/50000+5 AS length_m, o_custkey % 8 AS drive_id, o_orderpriority AS highway FROM orders""",
    "runs": """SELECT o_custkey AS drive_id, o_orderpriority AS arm, o_orderkey AS window_id, o_totalprice/500009 AS c_ratio,
 (o_orderkey % 100)/CAST(100 AS DOUBLE) AS b_rough, (o_orderkey % 11)*CAST(1 AS DOUBLE) AS dangling_per_km, (o_custkey % 5)/CAST(50 AS DOUBLE) AS conflict_rate,
 o_orderkey % 7 AS n_intersections, o_totalprice/CAST(99.7 AS DOUBLE) AS line_len FROM orders""",
    "priors": """SELECT s_suppkey AS prior_id, s_suppkey*CAST(5 AS DOUBLE) AS minx, s_nationkey*CAST(8 AS DOUBLE) AS miny,
 s_suppkey*CAST(5 AS DOUBLE)+12+s_nationkey AS maxx, s_nationkey*CAST(8 AS DOUBLE)+40 AS maxy, s_acctbal AS quality FROM supplier""",
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def expand(sql: str) -> str:
    """Put the needed view definitions in front of a check query."""
    used = [v for v in VIEWS if re.search(rf"\b{v}\b", sql)]
    if not used:
        return sql.strip()
    ctes = ",\n".join(f"{v} AS ({VIEWS[v]})" for v in used)
    body = sql.strip()
    m = re.match(r"WITH\s+RECURSIVE\s+", body, re.I)
    if m:
        return f"WITH RECURSIVE {ctes},\n{body[m.end():]}"
    m = re.match(r"WITH\s+", body, re.I)
    if m:
        return f"WITH {ctes},\n{body[m.end():]}"
    return f"WITH {ctes}\n{body}"


def tidy(df: DataFrame) -> DataFrame:
    """Round doubles to six places (sums depend on the order) and drop the sign of zero."""
    return df.select([
        (F.round(F.col(f"`{f.name}`"), 6) + F.lit(0.0)).alias(f.name) if f.dataType.typeName() in ("double", "float") else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its DuckDB twin."""

    def wrap(fn: Callable[[Catalog], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: tidy(fn(Catalog(spark, sf_dir)))
        if sql:
            ORACLE[name] = expand(sql)
        return fn

    return wrap
