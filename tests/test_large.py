"""What only shows on larger tables: join sides that outgrow their estimate, zero values, long ids, many parts."""

import os

from pyspark.sql import functions as F

from wayfold import session
from wayfold.functions import stats
from wayfold.operators import chains as CH, components as CC, grid as G, joins as J
from wayfold.queries import load_all
from wayfold.queries.catalog import QUERIES
from wayfold.sources import sinks


def plan_of(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def spots(spark, path, n=200):
    spark.range(n).select("id", (F.col("id") * 3 % 97).cast("double").alias("x"), (F.col("id") * 7 % 89).cast("double").alias("y")).write.parquet(path)
    return spark.read.parquet(path)


def test_copied_cells_are_not_broadcast(spark, tmp_path, capsys):
    d = spots(spark, str(tmp_path / "d"))
    cells = d.select("id", F.explode(F.sequence(F.lit(0), F.lit(50))).alias("ix"), F.lit(0).alias("iy"))
    overlap = G.cell_set_overlap(cells.withColumnRenamed("id", "a"), cells.withColumnRenamed("id", "b"), "a", "b")
    assert "BroadcastHashJoin" not in plan_of(overlap, capsys)


def test_pairs_within_are_not_broadcast(spark, tmp_path, capsys):
    d = spots(spark, str(tmp_path / "d"))
    near = J.within(d, d.select(F.col("id").alias("other"), F.col("x").alias("rx"), F.col("y").alias("ry")), 5.0)
    assert "BroadcastHashJoin" not in plan_of(near, capsys)
    rows = d.collect()
    assert near.count() == sum((a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 25 for a in rows for b in rows)


def test_dbscan_is_not_broadcast(spark, tmp_path, capsys):
    d = spots(spark, str(tmp_path / "d"))
    assert "BroadcastHashJoin" not in plan_of(CC.dbscan(d, "id", 5.0, 3), capsys)


def test_nearest_shuffles_many_candidates(spark, tmp_path, capsys, monkeypatch):
    d = spots(spark, str(tmp_path / "d"))
    want = {r.id: (r.near_dist, r.near_id) for r in J.nearest(d, d.filter("id % 3 = 0"), ["id"]).collect()}
    monkeypatch.setattr(J, "FEW", 0)
    near = J.nearest(d, d.filter("id % 3 = 0"), ["id"])
    assert "BroadcastHashJoin" not in plan_of(near, capsys)
    assert {r.id: (r.near_dist, r.near_id) for r in near.collect()} == want


def test_drift_stop_passes_zeros(spark):
    values = [5.0, 0.0, 6.0, 0.0, 0.0, 7.0, 40.0, 8.0, 0.0, 0.0, 0.0, 9.0]
    d = spark.createDataFrame([(1, i, v) for i, v in enumerate(values)], "k long, i long, v double")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with many keys: all ratios are written before a join
    try:
        got = [(r.i, r.drift) for r in CH.drift_stop(d, ["k"], "i", "v", 2, 0.25, 4, 3).orderBy("i").collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    drifts = {1, 3, 4, 6, 8, 9}
    assert got == [(i, i in drifts) for i in range(10)]


def test_long_ids_read_like_the_twins(spark, tmp_path):
    load_all()
    spark.sql("SELECT 1234567890L AS event_id, 98765L AS user_id, 'click' AS event_type").write.parquet(str(tmp_path / "events.parquet"))
    spark.sql("SELECT 123L AS s_suppkey, 1.5D AS s_acctbal, 4L AS s_nationkey").write.parquet(str(tmp_path / "supplier.parquet"))
    row = QUERIES["p19_frame_ids"](spark, str(tmp_path)).first()
    assert (row.label, row.num, row.kept) == ("1234567890", 123456789098765, "click")
    assert QUERIES["s04_calibration_text"](spark, str(tmp_path)).first().name == "P_12"


def test_small_parts_are_one_file_each(spark, tmp_path, monkeypatch):
    load_all()
    seen = {}
    write = sinks.write_committed
    monkeypatch.setattr(sinks, "write_committed", lambda df, path, *a, **b: seen.update(path=path) or write(df, path, *a, **b))
    spark.sql("SELECT id AS l_orderkey, 1 AS l_linenumber, 3L AS l_suppkey, id % 7 AS l_partkey, 1D AS l_quantity, 1D AS l_discount, 1D AS l_extendedprice FROM range(5000)").write.parquet(str(tmp_path / "lineitem.parquet"))
    got = QUERIES["s14_sized_parts_written"](spark, str(tmp_path)).collect()
    files = [f for _, _, names in os.walk(seen["path"].removeprefix("file:") + "/attempts") for f in names if f.endswith(".parquet")]
    assert len(got) == 4 and sum(r.points for r in got) == 5000 and len(files) == len(got)


def quantile(values, p):
    values, r = sorted(values), (len(values) - 1) * p
    lo, hi = values[int(r)], values[min(int(r) + 1, len(values) - 1)]
    return lo + (hi - lo) * (r - int(r))


def test_labellings_rank_like_brute_force(spark):
    rows = [((i * 37 % 50) / 8, i * 13 % 9) for i in range(400)] + [(None, 8), (1.0, 0)]
    got = {r.i: r for r in stats.rank_labellings(spark.createDataFrame(rows, "v double, c long"), "v", "c", 3, 0.25, .95).collect()}
    assert sorted(got) == [0, 1]  # no row has a third digit
    for i, r in got.items():
        pos, neg = ([v for v, c in rows if v is not None and c // 3 ** i % 3 == k] for k in (2, 1))
        wins = sum((a > b) + (a == b) / 2 for a in pos for b in neg)
        assert (r.n_pos, r.n_neg) == (len(pos), len(neg)) and abs(r.auc - wins / len(pos) / len(neg)) < 1e-12
        assert abs(r.pos_p - quantile(pos, .95)) < 1e-12 and abs(r.neg_p - quantile(neg, .95)) < 1e-12


def test_shift_grid_writes_a_hit_once(spark, tmp_path, monkeypatch):
    load_all()
    spark.sql("SELECT id AS l_orderkey, 1 AS l_linenumber, 0L AS l_suppkey, id * 7 % 200 AS l_partkey, 1D AS l_quantity, 0.01D AS l_discount, id * 10D AS l_extendedprice FROM range(3000)").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.sql("SELECT id AS s_suppkey, 1D AS s_acctbal, id % 3 AS s_nationkey FROM range(8)").write.parquet(str(tmp_path / "supplier.parquet"))
    hits = sum(5 * b - 7 <= i * 7 % 200 / 4 <= 5 * b + 19 + b % 3 and 8 * (b % 3) - 7 <= i % 997 / 4 <= 8 * (b % 3) + 47 for i in range(3000) for b in range(8))
    written, write = [], session._write_table
    monkeypatch.setattr(session, "_write_table", lambda df, schema: written.append(write(df, schema)) or written[-1])
    assert QUERIES["a23_shift_grid"](spark, str(tmp_path)).count() == 9
    big = [n for n in (d.count() for d in written) if n >= hits]
    assert hits > 1000 and big == [hits]


def test_support_on_the_radius_is_told_by_squares(spark, tmp_path):
    load_all()
    spark.sql("SELECT * FROM VALUES (32L, 22), (96L, 31), (40L, 22) AS t(p_partkey, p_size)").write.parquet(str(tmp_path / "part.parquet"))
    spark.sql("SELECT id AS event_id, id AS user_id, timestamp'2024-01-01' AS ts, IF(id = 0, 64D, 458D) AS value, 'click' AS event_type, '{}' AS props FROM range(2)").write.parquet(str(tmp_path / "events.parquet"))
    got = {r.p_partkey: r.traj_support for r in QUERIES["g36_sat_candidates"](spark, str(tmp_path)).collect()}
    assert got == {32: 0, 96: 0, 40: 0}  # 8² + 19.2² and 24² + 4.4² come out above 20.8² and 24.4², their roots do not


def test_pairs_within_compare_squares(spark):
    a, b = spark.sql("SELECT 24D AS x, 4.4D AS y"), spark.sql("SELECT 0D AS rx, 0D AS ry")
    assert J.within(a, b, 24.4).count() == 0 and J.within(a, b, 24.4, root=True).count() == 1


def test_nearest_far_away_keeps_wide_cells(spark, monkeypatch):
    left = spark.range(600).select("id", (F.col("id") % 2).alias("k"), (F.col("id") * 40.0 - 5000).alias("x"), (F.col("id") * 37 % 101).cast("double").alias("y"))
    right = spark.range(4000).select((F.col("id") % 40).alias("k"), F.col("id").alias("rid"), (F.col("id") * 0.5).alias("x"), (F.col("id") * 7 % 113).cast("double").alias("y"))
    want, rows = {}, right.filter("k < 2").collect()
    for q in left.collect():
        want[q.id] = min((((r.x - q.x) ** 2 + (r.y - q.y) ** 2), r.rid) for r in rows if r.k == q.k)[1]
    written, write = [], session._write_table
    monkeypatch.setattr(session, "_write_table", lambda df, schema: written.append(write(df, schema)) or written[-1])
    near = J.nearest(left, right, ["rid"], ["k"], 4.0)
    assert {r.id: r.near_rid for r in near.collect()} == want
    assert [d.count() for d in written if {"rx", "_f"} <= set(d.columns) and "_ix" not in d.columns] == [200]  # rows of other keys stay out
    assert sum(d.count() for d in written if "_c" in d.columns) < 300  # of 600 cells of the size asked for
