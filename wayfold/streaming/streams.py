"""Structured Streaming twins: windowed QC, sliding statistics, sessions, drift state, duplicate drop."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

LATE = "2 hours"


def window_qc(events: DataFrame, size: str = "6 hours") -> DataFrame:
    """Tumbling QC windows per kind."""
    return (events.withWatermark("ts", LATE).groupBy(F.window("ts", size).alias("w"), "event_type")
            .agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"), F.max("value").alias("top"))
            .select(F.col("w.start").alias("start"), "event_type", "n", "mean", "top"))


def sliding_stats(events: DataFrame, size: str = "12 hours", slide: str = "6 hours") -> DataFrame:
    return (events.withWatermark("ts", LATE).groupBy(F.window("ts", size, slide).alias("w"))
            .agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean")).select(F.col("w.start").alias("start"), "n", "mean"))


def detection_sessions(events: DataFrame, gap: str = "6 hours") -> DataFrame:
    """Runs of detections per drive that are at most ``gap`` apart."""
    return (events.withWatermark("ts", LATE).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n"))
            .select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n"))


def drop_repeats(events: DataFrame, keys: list[str]) -> DataFrame:
    """First row per key inside the watermark delay."""
    return events.withWatermark("ts", LATE).dropDuplicatesWithinWatermark(keys)


class _Drift(StatefulProcessor):
    """Last accepted area, drifts in a row and the stop flag of one seed; the state goes after ``idle_ms`` of event time without rows."""

    def __init__(self, low: float, high: float, min_area: float, stop_after: int, idle_ms: int):
        self.low, self.high, self.min_area, self.stop_after, self.idle_ms = low, high, min_area, stop_after, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("drift", "last double, run int, stopped boolean, seen long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last, run, stopped, seen = self.state.get() if self.state.exists() else (-1.0, 0, False, 0)
        new = []  # (event_id, value) of this micro-batch; its size is bounded by the source
        for part in rows:
            new += zip(part["event_id"].tolist(), part["value"].tolist())
            seen = max(seen, int(part["ts"].max().timestamp() * 1000))
        out = []
        for e, area in sorted(new):
            if stopped:
                break
            ratio = area / last if last > 0 else None
            drift = bool(area < self.min_area or (ratio is not None and not self.low <= ratio <= self.high))
            run = run + 1 if drift else 0
            last = last if drift else float(area)
            stopped = run >= self.stop_after
            if not stopped:
                out.append((int(key[0]), int(e), drift))
        self.state.update((float(last), int(run), bool(stopped), int(seen)))
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer(seen + self.idle_ms)
        yield pd.DataFrame(out, columns=["seed", "event_id", "drift"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        yield pd.DataFrame({"seed": pd.Series(dtype="int64"), "event_id": pd.Series(dtype="int64"), "drift": pd.Series(dtype="bool")})

    def close(self) -> None:
        pass


STORE = "spark.sql.streaming.stateStore.providerClass"


def drift_stream(events: DataFrame, low: float = 0.25, high: float = 4.0, min_area: float = 2.0, stop_after: int = 3, idle_hours: float = 24 * 365) -> DataFrame:
    """Area drift against the last accepted row per seed, kept as keyed state across micro-batches.

    A seed's state is dropped by an event-time timer once the watermark is ``idle_hours`` past its last row; rows that come
    later than the watermark allows are dropped before they reach it. Rows of one micro-batch are ordered by event id inside
    their key; bound the batch with the source's maxBytesPerTrigger / maxFilesPerTrigger.
    """
    # keyed state with timers asks for this store
    events.sparkSession.conf.set(STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    src = events.select("user_id", "event_id", "value", "ts").withWatermark("ts", LATE)
    return src.groupBy("user_id").transformWithStateInPandas(_Drift(low, high, min_area, stop_after, int(idle_hours * 3_600_000)), "seed long, event_id long, drift boolean", "append", "EventTime")


def closed(events: DataFrame, path: str, at: str = "2099-01-01") -> DataFrame:
    """``events`` and one row of only nulls and the time ``at``, written to ``path`` and read as a stream.

    It moves the watermark past all windows of a bounded replay, so that append mode emits them and drops their state; its
    own window never closes, so it shows up in no result.
    """
    spark, schema = events.sparkSession, events.schema
    row = [F.lit(at).cast("timestamp").alias("ts") if f.name == "ts" else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    spark.range(1).select(*row).coalesce(1).write.parquet(path)
    return events.unionByName(spark.readStream.schema(schema).parquet(path))


def run_to_table(stream: DataFrame, path: str, mode: str) -> None:
    """Drain the source once (availableNow) into a table; ``complete`` results replace the table per batch."""

    def sink(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode("overwrite" if mode == "complete" else "append").parquet(path + "/table")

    q = stream.writeStream.outputMode(mode).option("checkpointLocation", path + "/state").trigger(availableNow=True).foreachBatch(sink).start()
    q.awaitTermination()
