"""Session helpers: a tuned local session and reliable checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql.types import StructType


def get_spark(app: str = "wayfold", cpus: int | str = "*", shuffle: int = 8) -> SparkSession:
    """A local session for tests and the bench; on a cluster use spark-submit's own session."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the checkpoint folder the session names; invent one only on a single machine."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative operators")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-wayfold-ckpt-", dir="/tmp"))


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a join side that is never broadcast: rows that were copied to cells, or come from a packed file, are many
    more bytes than the planner takes them for, and would fill the driver."""
    return df.hint("merge")


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage by writing a table under the shared checkpoint folder and reading it back.

    Unlike RDD checkpoints this computes the plan once, and a lost executor costs no replay.
    """
    return _write_table(df, df.schema)


def checkpoint_observed(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
    """``checkpoint`` that also returns aggregates gathered while writing (no extra job)."""
    seen = Observation()
    out = _write_table(df.observe(seen, *[c.alias(n) for n, c in metrics.items()]), df.schema)
    return out, seen.get


def _write_table(df: DataFrame, schema: StructType) -> DataFrame:
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/wayfold-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)
