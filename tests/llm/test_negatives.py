"""Hard negatives against brute force."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wayfold.llm import negatives

C = F.col
SCHEMA = "vec_id long, embedding array<float>, label int, score double, id string, slot int, limits string"


def row(i, v, label):
    return (i, v, label, 0.5, "x", 1, None)


def brute(rows, positives=5, n=10, low=30, high=90):
    import math

    best = {}
    for r in rows:
        i, v, lab = r[:3]
        if i is None or v is None or lab is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        code = [math.floor(256 * x) for x in v]
        if i not in best or (lab, v) < best[i][2]:
            best[i] = (lab, code, (lab, v))
    out = []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for a, (lab, code, _) in best.items():
        if a % 100:
            continue
        scored = sorted((-dot(code, c), i, l) for i, (l, c, _) in best.items() if i != a)
        for s, p, _ in [x for x in scored if x[2] == lab][:positives]:
            fit = [(t, i) for t, i, l in scored if l != lab and low * -s <= 100 * -t <= high * -s][:n]
            out += [(a, p, k + 1, i, -s, -t) for k, (t, i) in enumerate(fit)]
    return sorted(out)


def mined(rows, spark, **more):
    df = spark.createDataFrame(rows, SCHEMA)
    out = negatives.hard_negatives(df, F.col("vec_id") % 100 == 0, **more)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, out.collect()))


def odd_rows():
    rnd = random.Random(5)
    vec = lambda n=6: [rnd.choice([-0.5, -0.26, 0.0, 0.125, 0.25, 0.5, 0.75]) for _ in range(n)]
    rows = [row(i, vec(), rnd.randrange(3)) for i in range(1, 700)]
    rows += [row(0, vec(), 1), row(0, vec(), 1), row(100, vec(), 2), rows[300], rows[300]]  # repeated ids, repeated rows
    rows += [row(800 + i, [0.5] * 6, 1) for i in range(60)]  # ties
    rows += [row(900, vec(), 7), row(-100, [0.5] * 6, 1), row(None, vec(), 1), row(1000, None, 1), row(1001, vec(), None), row(1100, [0.5, None], 1), row(1200, [float("nan")] * 6, 1),
             row(1300, [float("inf")] * 6, 1), row(1400, [], 1), row(1500, [0.5, 0.25], 2), row(1600, [0.75] * 9, 0), row(-7, [0.0] * 6, 2), row(1700, [-0.5] * 6, 1)]
    return rows


@pytest.mark.parametrize("tile", [(65_536, 8_192, 1 << 21), (300, 3, 64)])
def test_against_brute_force(spark, monkeypatch, tile):
    for name, value in zip(("ROWS", "ANCHORS", "CELLS"), tile):
        monkeypatch.setattr(negatives, name, value)
    rows = odd_rows()
    want = brute(rows)
    assert mined(rows, spark) == want and len(want) > 100
    if tile[1] == 3:
        assert mined(rows, spark, positives=3, negatives=4, low=0, high=100) == brute(rows, 3, 4, 0, 100)


def test_ids_that_are_no_numbers_take_no_part(spark):
    rows = [("100", [0.5], 1), ("x", [0.5], 1), ("1", [0.25], 1), ("2", [0.125], 2), ("", [0.125], 2)]
    df = spark.createDataFrame(rows, "vec_id string, embedding array<double>, label int")
    got = negatives.hard_negatives(df, C("vec_id").isin("100", "x")).collect()
    assert [tuple(r) for r in got] == [(100, 1, 1, 2, 128 * 64, 128 * 32)]


def test_empty_and_lonely(spark):
    assert mined([row(1, [0.5], 1)], spark) == []
    assert mined([row(100, [0.5], 1), row(1, [0.5], 2)], spark) == []
    assert spark.createDataFrame([], SCHEMA).transform(lambda d: negatives.hard_negatives(d, F.lit(True))).count() == 0


def test_whole_numbers_beyond_doubles(spark):
    big = float(1 << 20)
    rows = [row(100, [big, 1.0, 1.0], 1), row(1, [big, 2.0, 1.0], 1), row(2, [big / 2, 3.0, 1.0], 2), row(3, [big / 2, 3.00390625, 1.0], 2)]
    got = mined(rows, spark)
    assert got == brute(rows) and [g[3] for g in got] == [3, 2]


def test_slots_keep_ties_by_id():
    best = negatives._Best(2, 2)
    import numpy as np

    for group, score, i in [(0, 5, 9), (0, 5, 3), (1, -1, 4), (0, 7, 8), (0, 5, 1)]:
        best.add(*(np.array([x]) for x in (group, score, i)))
    assert [x.tolist() for x in best.settle()] == [[0, 0, 1], [7, 5, -1], [8, 1, 4]]


def test_shares_round_outwards(spark):
    df = spark.createDataFrame([(x,) for x in (-101, -100, -1, 0, 1, 99, 101, 2**63 - 1, -(2**63))], "s long")
    got = df.select("s", negatives._share(F.col("s"), 30, True).alias("lo"), negatives._share(F.col("s"), 90, False).alias("hi")).collect()
    assert all(r.lo == -(-30 * r.s // 100) and r.hi == 90 * r.s // 100 for r in got)
