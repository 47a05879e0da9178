"""Survey files as DataFrames: sweeps, poses, pose matrices, calibration, vector layers, detections.

Drive and frame come from the file's path. Filters on them are filters on file metadata, which Spark applies while it
lists the files, so files of other drives and frames are never opened; columns are pruned as in any scan. Bad lines and
cut tails drop out (sweeps, poses) or are marked (``read_jsonl`` in ``scans``). Any store that Spark reads will do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wayfold.functions.records import drive_of, frame_of
from wayfold.sources import scans

KEYS = ("drive_id", "frame_id")


def _place(path: Column) -> tuple[Column, Column]:
    """Drive and frame by the last two parts of the path that name them; parts further up may hold any digits.

    The driver works this out for every listed file, so it takes no pattern that is tried again from each character.
    """
    tail = F.substring_index(path, "/", -2)
    return drive_of(path), F.nullif(frame_of(tail), F.lit("")).cast("long")


def survey_files(spark: SparkSession, kind: str, path: str, glob: str | None, drives: Sequence[str] | None, frames: tuple[int, int] | None, **options) -> DataFrame:
    """Files below ``path`` in one of Spark's formats, with drive_id and frame_id from their names."""
    r = spark.read.format(kind).option("recursiveFileLookup", "true")
    for k, v in options.items():
        r = r.option(k, v)
    drive, frame = _place(F.col("_metadata.file_path"))
    df = (r.option("pathGlobFilter", glob) if glob else r).load(path)
    if drives is not None:
        df = df.where(drive.isin(list(drives)))
    if frames is not None:
        df = df.where(frame.between(*frames))
    return df.select("*", drive.alias("drive_id"), frame.alias("frame_id"))


def read_sweeps(spark: SparkSession, path: str, drives: Sequence[str] | None = None, frames: tuple[int, int] | None = None, glob: str | None = "*.bin") -> DataFrame:
    """(drive_id, frame_id, pt_idx, x, y, z, intensity) of binary float32 records; a cut record at the end drops out."""
    return scans.decode_sweeps(survey_files(spark, "binaryFile", path, glob, drives, frames), KEYS)


def read_poses(spark: SparkSession, path: str, drives: Sequence[str] | None = None, frames: tuple[int, int] | None = None, glob: str | None = "*.txt") -> DataFrame:
    """(drive_id, frame_id, lat, lon, alt, roll, pitch, yaw) of every readable line."""
    lines = survey_files(spark, "text", path, glob, drives, frames).select(*KEYS, "value")
    return scans.parse_poses(lines, "value")


def read_pose_matrices(spark: SparkSession, path: str, drives: Sequence[str] | None = None, frames: tuple[int, int] | None = None, glob: str | None = "*.txt") -> DataFrame:
    """(drive_id, frame_id, m): the frame stands first on each line, so ``frames`` filters rows here."""
    lines = survey_files(spark, "text", path, glob, drives, None).select("drive_id", "value")
    m = scans.parse_pose_matrices(lines, "value")
    return m if frames is None else m.where(F.col("frame_id").between(*frames))


def read_calibration(spark: SparkSession, path: str, drives: Sequence[str] | None = None, glob: str | None = "*.txt") -> DataFrame:
    """(drive_id, name, rows, cols, values) of well-formed P_rect (3 x 4) and R_rect (3 x 3) lines; others drop out."""
    c = scans.parse_calibration(survey_files(spark, "text", path, glob, drives, None).select("drive_id", "value"), "value")
    cols = F.when(F.col("name").startswith("P_rect_"), 4).when(F.col("name").startswith("R_rect_"), 3)
    whole = (F.size("values") == 3 * cols) & F.forall("values", lambda v: v.isNotNull())
    return c.where(whole).select("drive_id", "name", F.lit(3).alias("rows"), cols.alias("cols"), "values")


def read_rigid(spark: SparkSession, path: str, drives: Sequence[str] | None = None, glob: str | None = "*.txt") -> DataFrame:
    """(drive_id, m): files that hold exactly the twelve numbers of a 3 x 4 transform, in any lines."""
    whole = survey_files(spark, "text", path, glob, drives, None, wholetext="true").select("drive_id", scans.numbers(F.col("value")).alias("m"))
    return whole.where((F.size("m") == 12) & F.forall("m", lambda v: v.isNotNull()))


def read_layers(spark: SparkSession, path: str, drives: Sequence[str] | None = None, frames: tuple[int, int] | None = None, glob: str | None = "*.geojson") -> DataFrame:
    """(drive_id, frame_id, class, conf, geom_type, geom) of the features of GeoJSON files; no class: 'unknown'."""
    docs = survey_files(spark, "text", path, glob, drives, frames, wholetext="true").select(*KEYS, "value")
    return scans.parse_geojson(docs, "value")


def read_detections(spark: SparkSession, path: str, drives: Sequence[str] | None = None, frames: tuple[int, int] | None = None, glob: str | None = "*.json") -> DataFrame:
    """(drive_id, frame_id, class, score, minx, miny, maxx, maxy) of JSON files that hold a list of detections, bare or under ``detections``."""
    box = "array<struct<label:string,class:string,score:double,conf:double,bbox:array<double>>>"
    text = survey_files(spark, "text", path, glob, drives, frames, wholetext="true").select(*KEYS, F.trim("value").alias("value"))
    items = F.when(F.col("value").startswith("["), F.from_json("value", box)).otherwise(F.from_json("value", f"detections {box}")["detections"])
    d = text.select(*KEYS, F.explode(items).alias("d")).where(F.size("d.bbox") == 4)
    ends = [F.get("d.bbox", i).alias(n) for i, n in enumerate(("minx", "miny", "maxx", "maxy"))]
    return d.select(*KEYS, F.coalesce("d.class", "d.label", F.lit("unknown")).alias("class"), F.coalesce("d.score", "d.conf", F.lit(0.0)).alias("score"), *ends)
