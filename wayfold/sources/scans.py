"""Scans: binary sweeps, pose and calibration text, GeoJSON and JSON lines, indexes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wayfold.functions.records import drive_of, frame_of


def decode_sweeps(files: DataFrame, by: Sequence[str]) -> DataFrame:
    """``content`` of float32 x, y, z, intensity records to rows; a trailing partial record is dropped."""
    by = list(by)

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            recs = [np.frombuffer(c[: len(c) // 16 * 16], dtype="<f4").reshape(-1, 4) for c in pdf["content"]]
            n = [len(r) for r in recs]
            out = pd.DataFrame(np.concatenate(recs).astype("float64") if recs else np.empty((0, 4)), columns=["x", "y", "z", "intensity"])
            for b in by:
                out[b] = np.repeat(pdf[b].to_numpy(), n)
            out["pt_idx"] = np.concatenate([np.arange(k, dtype="int64") for k in n]) if n else np.empty(0, dtype="int64")
            yield out[[*by, "pt_idx", "x", "y", "z", "intensity"]]

    src = files.select(*by, "content")
    keys = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in src.select(*by).schema.fields)
    return src.mapInPandas(decode, f"{keys}, pt_idx long, x double, y double, z double, intensity double")


def read_sweeps(spark: SparkSession, path: str) -> DataFrame:
    """Sweep files below ``path``; drive and frame come from the file name."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.bin").load(path)
    f = f.select(drive_of(F.col("path")).alias("drive_id"), frame_of(F.col("path")).cast("long").alias("frame_id"), "content")
    return decode_sweeps(f, ["drive_id", "frame_id"])


def numbers(text: Column) -> Column:
    """Whitespace-separated numbers; anything unreadable becomes NULL."""
    parts = F.filter(F.split(F.trim(text), r"\s+"), lambda t: t != "")
    return F.transform(parts, lambda t: t.try_cast("double"))


def parse_poses(lines: DataFrame, text: str) -> DataFrame:
    """lat, lon, alt, roll, pitch, yaw from the first six columns; short or unreadable lines drop out."""
    v = lines.withColumn("_v", numbers(F.col(text)))
    ok = (F.size("_v") >= 6) & F.forall(F.slice("_v", 1, 6), lambda x: x.isNotNull())
    names = ("lat", "lon", "alt", "roll", "pitch", "yaw")
    return v.filter(ok).select("*", *[F.get("_v", i).alias(n) for i, n in enumerate(names)]).drop("_v", text)


def parse_pose_matrices(lines: DataFrame, text: str) -> DataFrame:
    """frame number plus 12 or 16 row-major numbers to (frame_id, m array<double> of 12)."""
    v = lines.withColumn("_v", numbers(F.col(text)))
    ok = F.size("_v").isin(13, 17) & F.forall("_v", lambda x: x.isNotNull())
    return v.filter(ok).select(*[c for c in lines.columns if c != text], F.get("_v", 0).cast("long").alias("frame_id"), F.slice("_v", 2, 12).alias("m"))


def parse_calibration(lines: DataFrame, text: str) -> DataFrame:
    """``NAME: n1 n2 ...`` lines to (name, values)."""
    p = F.split(F.col(text), ":", 2)
    return lines.filter(F.col(text).contains(":")).select(*[c for c in lines.columns if c != text], F.trim(F.get(p, 0)).alias("name"), numbers(F.get(p, 1)).alias("values"))


def parse_geojson(docs: DataFrame, text: str) -> DataFrame:
    """One row per feature with its class ('unknown' when absent), confidence and vertices."""
    schema = "features array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:array<array<double>>>>>"
    f = docs.select(*[c for c in docs.columns if c != text], F.explode(F.from_json(text, schema)["features"]).alias("f"))
    prop = lambda n: F.col("f.properties")[n]
    return f.select(*[c for c in docs.columns if c != text], F.coalesce(prop("class"), F.lit("unknown")).alias("class"),
                    F.coalesce(prop("conf").try_cast("double"), prop("score").try_cast("double"), F.lit(0.0)).alias("conf"), F.col("f.geometry.type").alias("geom_type"),
                    F.transform("f.geometry.coordinates", lambda p: F.struct(F.get(p, 0).alias("x"), F.get(p, 1).alias("y"))).alias("geom"))


def parse_jsonl(lines: DataFrame, text: str, fields: str) -> DataFrame:
    """JSON lines with a fixed schema; ``bad`` marks rows that do not parse."""
    full = f"{fields}, _bad string"
    p = lines.withColumn("_p", F.from_json(text, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    names = [x.strip().split()[0] for x in fields.split(",")]
    return p.select(*[c for c in lines.columns if c != text], *[F.col(f"_p.{n}").alias(n) for n in names], F.col("_p._bad").isNotNull().alias("bad"))


def read_jsonl(spark: SparkSession, path: str, fields: str) -> DataFrame:
    return parse_jsonl(spark.read.text(path), "value", fields)


def road_features(features: DataFrame, highways: str, allow: Sequence[str]) -> DataFrame:
    """Features whose highway list meets the allow-list or its ``_link`` variants."""
    wide = [*allow, *[a + "_link" for a in allow]]
    return features.filter(F.arrays_overlap(F.col(highways), F.array(*[F.lit(a) for a in wide])))


def drive_index(lidar: DataFrame, images: Sequence[DataFrame], poses: DataFrame) -> DataFrame:
    """Per-drive frame counts and coverage of LiDAR frames by any image and by poses."""
    k = ["drive_id", "frame_id"]
    img = images[0].select(*k)
    for i in images[1:]:
        img = img.unionByName(i.select(*k))
    j = lidar.select(*k).distinct().join(img.distinct().withColumn("_i", F.lit(1)), k, "left").join(poses.select(*k).distinct().withColumn("_p", F.lit(1)), k, "left")
    a = j.groupBy("drive_id").agg(F.count(F.lit(1)).alias("lidar_count"), F.count("_i").alias("img_any_match"), F.count("_p").alias("pose_match"))
    r = lambda n: F.bround(F.col(n) / F.col("lidar_count"), 4)
    return a.select("*", r("img_any_match").alias("image_coverage"), r("pose_match").alias("pose_coverage"), (F.col("pose_match") > 0).alias("has_pose"))


def index_totals(index: DataFrame) -> DataFrame:
    s = lambda c: F.sum(c)
    return index.agg(F.count(F.lit(1)).alias("drives"), s("lidar_count").alias("total_lidar"), s("img_any_match").alias("total_img_any"), s("pose_match").alias("total_pose"),
                     F.bround(s("img_any_match") / s("lidar_count"), 4).alias("image_coverage"), F.bround(s("pose_match") / s("lidar_count"), 4).alias("pose_coverage"),
                     F.count_if(~F.col("has_pose")).alias("missing_pose_drives"))


def fingerprints(docs: DataFrame, key: str, content: str, head: int) -> DataFrame:
    """sha256 of the whole content and of its first ``head`` bytes (the head hash is the feature)."""
    b = F.col(content).cast("binary")
    return docs.select(key, F.sha2(b, 256).alias("sha256"), F.sha2(F.substring(b, 1, head), 256).alias("sha256_head"), F.octet_length(b).alias("bytes"))
