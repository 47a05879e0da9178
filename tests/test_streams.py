"""Streams in append mode: late rows are dropped, windows close, keyed state expires."""

import datetime as dt

from pyspark.sql import functions as F

from wayfold.streaming import streams

SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double"
T0 = dt.datetime(2024, 1, 1, 12)
at = lambda hours: T0 + dt.timedelta(hours=hours)


def feed(spark, root, batches):
    """A stream of one micro-batch per list of rows, in order."""
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/b={k}")
    return lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/b=*")


def run(stream, path):
    """All batches' progress and the rows appended."""
    out = []
    q = stream.writeStream.outputMode("append").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).foreachBatch(lambda b, _: out.extend(b.collect())).start()
    q.awaitTermination()
    return out, [p.json if hasattr(p, "json") else p for p in q.recentProgress]


def states(progress):
    import json

    return [sum(op["numRowsTotal"] for op in json.loads(p)["stateOperators"]) for p in progress if json.loads(p)["stateOperators"]]


def test_windows_close_and_late_rows_drop(spark, tmp_path):
    s = feed(spark, tmp_path / "in", [[(1, at(0), 1, "a", 1.0), (2, at(1), 1, "a", 3.0)], [(3, at(40), 1, "a", 5.0)], [(4, at(2), 1, "a", 99.0)], [(5, at(80), 2, "b", 7.0)]])
    rows, progress = run(streams.window_qc(streams.closed(s(), str(tmp_path / "end"))), tmp_path / "w")
    got = sorted((r.start, r.event_type, r.n, r.top) for r in rows)
    assert [g[1:] for g in got if g[1] == "a" and g[0] < at(6)] in ([("a", 2, 3.0)], [("a", 3, 99.0)])  # the first batch holds the closing row or not
    assert ("b", 1, 7.0) in [g[1:] for g in got] or got[-1][1] == "a"
    assert states(progress)[-1] <= 2  # the closing row's own window, and at most one that is still open


def test_sessions_in_append_mode(spark, tmp_path):
    s = feed(spark, tmp_path / "in", [[(1, at(0), 1, "a", 1.0), (2, at(5), 1, "a", 1.0), (3, at(12), 1, "a", 1.0), (4, at(1), 2, "a", 1.0)]])
    rows, progress = run(streams.detection_sessions(streams.closed(s(), str(tmp_path / "end"))), tmp_path / "w")
    assert sorted((r.user_id, r.start, r.end, r.n) for r in rows) == [(1, at(0), at(11), 2), (1, at(12), at(18), 1), (2, at(1), at(7), 1)]
    assert states(progress)[-1] == 1


def test_drift_state_crosses_batches_and_expires(spark, tmp_path):
    seeds = range(20)
    first = [(100 * k, at(0), k, "a", 10.0) for k in seeds]
    second = [(100 * k + 1, at(1), k, "a", 1.0) for k in seeds] + [(100 * k + 2, at(1), k, "a", 12.0) for k in seeds]
    third = [(100 * k + 3, at(2), k, "a", 500.0) for k in seeds]
    far = [(9001, at(500), 99, "a", 10.0)]
    last = [(9002, at(501), 99, "a", 11.0)]
    s = feed(spark, tmp_path / "in", [first, second, third, far, last])
    rows, progress = run(streams.drift_stream(s(), idle_hours=48), tmp_path / "w")
    got = {r.event_id: r.drift for r in rows}
    assert got == {100 * k + i: d for k in seeds for i, d in enumerate((False, True, False, True))} | {9001: False, 9002: False}
    n = states(progress)
    assert max(n) >= 20 and n[-1] <= 4  # one seed's value and timer are left
