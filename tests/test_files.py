"""File readers (bad lines, cut tails, pruning by name) and the committed writer (killed attempts, part sizes)."""

import json
import os
import time

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from wayfold.sources import files, sinks

A, B = "2013_05_28_drive_0001_sync", "2013_05_28_drive_0002_sync"


def put(root, drive, name, content):
    d = root / "data_3d_raw" / drive / "data"
    d.mkdir(parents=True, exist_ok=True)
    (d / name).write_bytes(content if isinstance(content, bytes) else content.encode())


def test_sweeps_drop_cut_tails_and_prune(spark, tmp_path):
    for drive, frame, n in ((A, 1, 3), (A, 2, 0), (B, 1, 2), (B, 9, 1)):
        put(tmp_path, drive, f"{frame:010d}.bin", np.arange(4 * n, dtype="<f4").tobytes() + b"\x01" * (7 if n else 0))
    put(tmp_path, A, "notes.txt", "1 2 3")
    rows = files.read_sweeps(spark, str(tmp_path)).collect()
    assert sorted((r.drive_id, r.frame_id, r.pt_idx, r.x) for r in rows) == [(A, 1, 0, 0.0), (A, 1, 1, 4.0), (A, 1, 2, 8.0), (B, 1, 0, 0.0), (B, 1, 1, 4.0), (B, 9, 0, 0.0)]
    # a file of another drive or frame is not even opened: its content could not be read
    assert {r.drive_id for r in files.read_sweeps(spark, str(tmp_path), drives=[B]).collect()} == {B}
    one = files.read_sweeps(spark, str(tmp_path), drives=[B], frames=(5, 20))
    assert [(r.frame_id, r.x) for r in one.collect()] == [(9, 0.0)]
    got = files.survey_files(spark, "binaryFile", str(tmp_path), "*.bin", [B], (5, 20)).select(F.col("_metadata.file_path").alias("p"), "content")
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "file_path" in plan and got.count() == 1


def test_poses_skip_bad_lines(spark, tmp_path):
    put(tmp_path, A, "0000000007.txt", "48.5 8.5 110 0.1 0.2 0.3 9 9\n\n1 2 3\n48 8 x 0 0 0\n  49  8  1e2  0 0 -1  \n")
    got = sorted(tuple(r) for r in files.read_poses(spark, str(tmp_path)).collect())
    assert got == [(A, 7, 48.5, 8.5, 110.0, 0.1, 0.2, 0.3), (A, 7, 49.0, 8.0, 100.0, 0.0, 0.0, -1.0)]


def test_calibration_and_rigid(spark, tmp_path):
    p, r = " ".join(map(str, range(12))), " ".join(map(str, range(9)))
    put(tmp_path, A, "perspective.txt", f"calib_time: 09-Jan\nP_rect_00: {p}\nR_rect_00: {r}\nP_rect_01: 1 2 3\nR_rect_01: {r} x\nno colon\n")
    put(tmp_path, B, "cam_to_velo.txt", "1 0 0 5\n0 1 0 6\n0 0 1 7\n")
    got = sorted((c.name, c.rows, c.cols, c["values"][-1]) for c in files.read_calibration(spark, str(tmp_path), glob="perspective*").collect())
    assert got == [("P_rect_00", 3, 4, 11.0), ("R_rect_00", 3, 3, 8.0)]
    assert [(m.drive_id, m.m[3], m.m[11]) for m in files.read_rigid(spark, str(tmp_path)).collect()] == [(B, 5.0, 7.0)]


def test_layers_and_detections(spark, tmp_path):
    line = {"type": "LineString", "coordinates": [[0, 1], [2, 3]]}
    put(tmp_path, A, "0000000003.geojson", json.dumps({"features": [{"properties": {"class": "arrow", "score": "0.5"}, "geometry": line}, {"properties": {}, "geometry": line}]}))
    got = sorted((r["class"], r.conf, r.frame_id, r.geom[1].y) for r in files.read_layers(spark, str(tmp_path)).collect())
    assert got == [("arrow", 0.5, 3, 3.0), ("unknown", 0.0, 3, 3.0)]
    put(tmp_path, A, "0000000004.json", json.dumps([{"label": "car", "score": 0.9, "bbox": [1, 2, 3, 4]}, {"bbox": [1, 2]}]))
    put(tmp_path, B, "0000000005.json", json.dumps({"detections": [{"class": "sign", "conf": 0.4, "bbox": [5, 6, 7, 8]}]}))
    put(tmp_path, B, "0000000006.json", "{broken")
    got = sorted(tuple(r) for r in files.read_detections(spark, str(tmp_path)).collect())
    assert got == [(A, 4, "car", 0.9, 1.0, 2.0, 3.0, 4.0), (B, 5, "sign", 0.4, 5.0, 6.0, 7.0, 8.0)]


def test_committed_writes_survive_killed_attempts(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        sinks.read_committed(spark, path)
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    boom = df.withColumn("x", F.when(F.col("id") == 77, F.raise_error(F.lit("killed"))).otherwise(F.lit(None).cast("string")))
    with pytest.raises(PySparkException):
        sinks.write_committed(boom, path, ["k"])
    with pytest.raises(FileNotFoundError):
        sinks.read_committed(spark, path)
    # an attempt that wrote everything and died before its line in the manifest
    df.write.parquet(f"{path}/attempts/orphan")
    assert sinks.write_committed(df, path, ["k"]) == 100
    assert sinks.read_committed(spark, path).count() == 100
    with pytest.raises(PySparkException):
        sinks.write_committed(boom, path, ["k"])
    assert sorted(r.id for r in sinks.read_committed(spark, path).collect()) == list(range(100))
    sinks.write_committed(df.where("id < 10"), path)
    assert sinks.read_committed(spark, path).count() == 10 and "orphan" in os.listdir(f"{path}/attempts")


def test_sized_parts_are_bounded(spark):
    rows = [(d, f, i) for d in (None, 1) for f in range(40) for i in range((f * 7) % 5 + 1)]
    df = spark.createDataFrame(rows, "drive_id long, frame_id long, i long")
    got = sinks.sized_parts(df, ["drive_id"], "frame_id", 160, 16).collect()
    assert len(got) == len(rows)
    for d in (None, 1):
        own = [r for r in got if r.drive_id == d]
        frames = {}
        for r in own:
            frames.setdefault(r.frame_id, set()).add(r.part)
        assert all(len(p) == 1 for p in frames.values())
        order = [min(frames[f]) for f in sorted(frames)]
        assert order == sorted(order) and max(order) > 8
        assert max(sum(r.part == p for r in own) for p in set(order)) * 16 <= 160 + 5 * 16


def test_named_files_stand_side_by_side(spark, tmp_path):
    rows = [(d, f"{f:010d}", f"{48 + i} 8 {f} 0.1 0.2 {i}") for d in (A, B) for f in range(40) for i in range(f % 3 + 1)]
    sinks.write_named(spark.createDataFrame([*rows, (A, "0000000050", None), (A, "none", "1 2 3 4 5 6")], "folder string, name string, value string"), f"file:{tmp_path}/t")
    assert sorted(os.listdir(tmp_path / "t")) == [A, B]
    assert sorted(os.listdir(tmp_path / "t" / B)) == [f"{f:010d}.txt" for f in range(40)]
    assert (tmp_path / "t" / A / "0000000050.txt").read_bytes() == b"\n"
    assert sorted((tmp_path / "t" / A / "0000000005.txt").read_text().splitlines()) == [v for d, f, v in rows if d == A and f == "0000000005"]
    (tmp_path / "t" / A / "_killed").write_text("1 2 3 4 5 6\n")
    got = files.read_poses(spark, str(tmp_path / "t"), glob=None).collect()
    assert sorted((r.drive_id, r.frame_id, r.lat) for r in got if r.frame_id is not None) == sorted((d, int(f), float(v.split()[0])) for d, f, v in rows)
    assert [(r.drive_id, r.lat) for r in got if r.frame_id is None] == [(A, 1.0)]


def test_named_files_on_other_stores(spark, tmp_path):
    rows = [(d, f"{f:010d}", f"{48 + f} 8 1 0 0 0") for d in (A, B) for f in range(3)]
    sinks.write_named(spark.createDataFrame([*rows, (A, "none", "1 2 3 4 5 6")], "folder string, name string, value string"), str(tmp_path / "t"))  # no scheme: any store
    got = {(r.drive_id, r.frame_id, r.lat) for r in files.read_poses(spark, str(tmp_path / "t")).collect()}
    assert got == {(d, int(f), float(v.split()[0])) for d, f, v in rows} | {(A, None, 1.0)}


def test_place_is_linear_in_the_path(spark):
    long = "x" * 60_000
    paths = [(f"file:/1111111111/{A}/0000000003.txt",), (f"file:/1111111111/{A}/data/notes.txt",), (f"file:/{A}/{long}/{long}/0000000004.txt",)]
    df = spark.createDataFrame(paths, "p string").select(*(c.alias(n) for c, n in zip(files._place(F.col("p")), files.KEYS)))
    df.limit(1).collect()
    start = time.monotonic()
    assert [tuple(r) for r in df.collect()] == [(A, 3), (A, None), (A, 4)]
    assert time.monotonic() - start < 5  # half a minute and more with a pattern that starts at each character


def test_filed_frames_are_listed_without_a_job(spark):
    from wayfold.queries import q_s_sources as Q
    from wayfold.queries.catalog import Catalog

    df = spark.createDataFrame([(d, f) for d in (1, 2) for f in range(40)] + [(None, 7), (1, None)], "d long, f long")
    folder = Q.filed(Catalog(spark, ""), df, F.lit("48 8 110 0 0 0"))
    spark.sparkContext.setJobGroup("listing", "")
    try:
        poses = files.read_poses(spark, folder)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("listing")  # a folder per frame takes a task each
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    got = poses.collect()
    assert sorted((r.drive_id, r.frame_id) for r in got if r.drive_id and r.frame_id is not None) == [(d, f) for d in ("2013_05_28_drive_0001_sync", "2013_05_28_drive_0002_sync") for f in range(40)]
    assert sorted((r.drive_id, r.frame_id) for r in got if not r.drive_id or r.frame_id is None) == [("", 7), ("2013_05_28_drive_0001_sync", None)]
