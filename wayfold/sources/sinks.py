"""Sinks: partitioned parts, named files, keyed caches, report files."""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from wayfold.operators import ordered as O


def frame_parts(points: DataFrame, target_bytes: int, max_parts: int, record: int = 16) -> DataFrame:
    """Part number by frame rank: parts = ceil(points * record / target), at most ``max_parts`` files.

    The frame table is ranked (one row per frame), never the points.
    """
    frames = points.groupBy("drive_id", "frame_id").agg(F.count(F.lit(1)).alias("_n"))
    frames = O.dense_index(frames, ["drive_id"], ["frame_id"], F.floor(F.col("frame_id") / O.CHUNK), "_rank")
    per = frames.groupBy("drive_id").agg(F.sum("_n").alias("_pts"), F.count(F.lit(1)).alias("_frames"))
    parts = F.least(F.greatest(F.ceil(F.col("_pts") * record / target_bytes), F.lit(1)), F.lit(max_parts))
    size = F.ceil(F.col("_frames") / parts)
    part = frames.join(per, "drive_id").select("drive_id", "frame_id", F.floor(F.col("_rank") / size).cast("long").alias("part"))
    return points.join(part, ["drive_id", "frame_id"])


def write_parts(points: DataFrame, path: str, *keys: str) -> None:
    """One folder per key combination; rows are spread by frame so that a hot drive keeps many writers."""
    points.repartition(*[F.col(k) for k in keys], F.col("frame_id")).write.mode("overwrite").partitionBy(*keys).parquet(path)


def sized_parts(points: DataFrame, by: Sequence[str], frame: str, target_bytes: int, record: int = 16) -> DataFrame:
    """Points with ``part``: frames in order, a new part wherever the bytes before reach another ``target_bytes``.

    A part holds at most the target and one frame more, and there are as many parts as the points need.
    """
    key = F.struct(F.lit(0).alias("_0"), *by)
    frames = points.groupBy(key.alias("_k"), F.col(frame).alias("_f")).agg((F.count(F.lit(1)) * record).alias("_b"))
    frames = O.running_sum(frames, ["_k"], ["_f"], F.floor(F.col("_f") / O.CHUNK), F.col("_b"), "_upto")
    part = frames.select("_k", "_f", F.floor((F.col("_upto") - F.col("_b")) / target_bytes).cast("long").alias("part"))
    joined = points.withColumn("_k", key).withColumn("_f", F.col(frame)).join(part, ["_k", "_f"])
    return joined.select(*points.columns, "part")


def write_named(lines: DataFrame, path: str) -> None:
    """The lines (folder, name, value) as text files ``path/folder/name.txt``, all of a folder side by side in it.

    ``partitionBy`` makes a folder per file, which costs a reader one listing task each, and on a local or mounted store
    Hadoop starts six processes for every such file. So tasks write the files themselves there, a line at a time; each takes its
    name once it is whole, so a killed attempt leaves nothing that a reader sees. Other stores keep ``partitionBy``.
    """
    spread = lines.select("folder", "name", "value").repartition("folder", "name")
    if not path.startswith("file:"):
        spread.write.partitionBy("folder", "name").text(path)
        return
    root = path.removeprefix("file:").removeprefix("//")
    os.makedirs(root)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        n = 0
        for (folder, name), own in groupby(rows, itemgetter(0, 1)):
            os.makedirs(f"{root}/{folder}", exist_ok=True)
            hidden = f"{root}/{folder}/_{uuid.uuid4().hex}"
            with open(hidden, "wb") as f:
                f.writelines((v or b"") + b"\n" for _, _, v in own)
            os.replace(hidden, f"{root}/{folder}/{name}.txt")
            n += 1
        yield pa.RecordBatch.from_pydict({"files": pa.array([n], pa.int64())})

    ordered = spread.withColumn("value", F.col("value").cast("binary")).sortWithinPartitions("folder", "name")
    ordered.mapInArrow(write, "files long").agg(F.sum("files")).first()


MANIFEST = "version long, attempt string, rows long"


def write_committed(df: DataFrame, path: str, keys: Sequence[str] = (), writers: int = 16) -> int:
    """Write a new version of the table at ``path``; it counts once its line in the manifest stands, and not before.

    Every attempt has a folder of its own. An attempt that was killed leaves a folder that no line names, so readers never
    see a part of it, and the next attempt repeats nothing. The line is written last, by one task. Returns the rows.
    A key goes to up to ``writers`` files; one is enough where keys are small, as those of ``sized_parts``.
    """
    spark, root, attempt, seen = df.sparkSession, path.rstrip("/"), uuid.uuid4().hex, Observation()
    spread = df.repartition(*[F.col(k) for k in keys], F.pmod(F.xxhash64(*df.columns), F.lit(writers))) if keys else df
    w = spread.observe(seen, F.count(F.lit(1)).alias("n")).write
    (w.partitionBy(*keys) if keys else w).parquet(f"{root}/attempts/{attempt}")
    rows = seen.get["n"]
    spark.createDataFrame([(_latest(spark, root)[0] + 1, attempt, rows)], MANIFEST).coalesce(1).write.mode("append").json(f"{root}/manifest")
    return rows


def _latest(spark: SparkSession, root: str) -> tuple[int, str | None, int]:
    try:
        last = spark.read.schema(MANIFEST).json(f"{root}/manifest").agg(F.max(F.struct("version", "attempt", "rows")).alias("m")).first()["m"]
    except AnalysisException:  # no version yet
        last = None
    return (last.version, last.attempt, last.rows) if last else (0, None, 0)


def read_committed(spark: SparkSession, path: str) -> DataFrame:
    """The last version that was committed."""
    root = path.rstrip("/")
    _, attempt, _ = _latest(spark, root)
    if attempt is None:
        raise FileNotFoundError(f"no committed version at {path}")
    return spark.read.parquet(f"{root}/attempts/{attempt}")


def input_signature(df: DataFrame) -> str:
    """Hash over path, length and modification time of every file that ``df`` reads."""
    files = df.inputFiles()
    if not files:
        return ""
    seen = df.sparkSession.read.format("binaryFile").load(files).select(F.xxhash64("path", "length", F.col("modificationTime").cast("string")).alias("h"))
    r = seen.agg(F.count(F.lit(1)).alias("n"), F.bit_xor("h").alias("x"), F.sum(F.shiftright("h", 16)).alias("s")).first()
    return f"{r['n']}:{r['x']}:{r['s']}"


def cache_key(params: Mapping[str, object]) -> str:
    return hashlib.sha256(json.dumps(params, sort_keys=True, default=str).encode()).hexdigest()[:16]


def cached(spark: SparkSession, folder: str, params: Mapping[str, object], inputs: Sequence[DataFrame], build: Callable[[], DataFrame]) -> DataFrame:
    """Table keyed by its parameters and the files of its inputs: read it when complete, else build and write it.

    The key is written next to the table once the table is whole; only a table with its key counts.
    """
    path = f"{folder.rstrip('/')}/{cache_key({**params, '_inputs': [input_signature(i) for i in inputs]})}"
    try:
        spark.read.text(f"{path}/done").isEmpty()
    except AnalysisException:
        build().write.mode("overwrite").parquet(f"{path}/table")
        spark.range(1).selectExpr("'done' AS value").write.mode("overwrite").text(f"{path}/done")
    return spark.read.parquet(f"{path}/table")


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_trace(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)
