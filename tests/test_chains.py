"""Rules on the last accepted row against plain walks, with chunks small enough to be crossed all the time."""

import math
import random

import pytest
from pyspark.sql import functions as F

from wayfold.operators import chains, ordered

C = F.col


def walks(rows, step):
    out, state, key = [], None, object()
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        if r[0] != key:
            key, state = r[0], {}
        if step(state, r):
            out.append((r[0], r[1]))
    return sorted(out, key=str)


@pytest.fixture(params=[4096, 5])
def small(request, monkeypatch):
    for m, n in ((chains, "STRIDE"), (chains, "CHUNK"), (ordered, "CHUNK")):
        monkeypatch.setattr(m, n, request.param)
    monkeypatch.setattr(chains, "FAN", 64 if request.param > 64 else 3)


def test_follow_long_chains(spark, small):
    rnd = random.Random(1)
    rows = [(k, i, i + rnd.choice([1, 1, 2, 3, 9]) if i < 198 else None, i in (0, 7)) for k in (1, 2) for i in range(200)]
    df = spark.createDataFrame(rows, "k long, pos long, to long, head boolean").withColumn("_k", F.struct("k"))
    want = set()
    for k in (1, 2):
        to = {r[1]: r[2] for r in rows if r[0] == k}
        for h in (0, 7):
            while h in to:
                want.add((k, h))
                h = to[h]
    assert {(r._k.k, r.pos) for r in chains.follow(df).collect()} == want


def test_budget_cuts(spark, small):
    rnd = random.Random(2)
    rows = [(k, i * 3, rnd.choice([0, 0, 1, 5, 30, 120, None])) for k in (None, 1, 2) for i in range(150)] + [(3, 0, 7)]

    def step(state, r):
        state["sum"] = state.get("sum", 0) + (r[2] or 0)
        if state["sum"] >= 100:
            state["sum"] = 0
            return True

    got = chains.budget_cuts(spark.createDataFrame(rows, "k long, o long, b long"), ["k"], "o", C("b"), 100)
    assert got.columns == ["k", "o", "b"] and sorted(((r.k, r.o) for r in got.collect()), key=str) == walks(rows, step)


def test_drift_stop(spark, small):
    rnd = random.Random(3)
    rows = []
    for k in [None, *range(30)]:
        v = 50.0
        for i in range(120 if k != 5 else 2):
            v = max(0.5, v * rnd.choice([0.9, 1.1, 1.0]))
            rows.append((k, i, 1.0 if k == 7 or (k == 8 and i < 2) else v * rnd.choice([1, 1, 1, 1, 1, 8, 0.01])))
    out = {}

    def step(state, r):
        if state.get("stop"):
            return False
        last = state.get("last")
        drift = r[2] < 2 or (last is not None and not 0.25 <= r[2] / last <= 4)
        state["n"] = state.get("n", 0) + 1 if drift else 0
        if not drift:
            state["last"] = r[2]
        state["stop"] = state["n"] >= 3
        out[r[0], r[1]] = drift
        return not state["stop"]

    want = walks(rows, step)
    got = chains.drift_stop(spark.createDataFrame(rows, "k long, o long, v double"), ["k"], "o", "v", 2, 0.25, 4, 3).collect()
    assert sorted(((r.k, r.o) for r in got), key=str) == want and all(out[r.k, r.o] == r.drift for r in got)


def test_spaced(spark, small):
    rnd = random.Random(4)
    rows = []
    for k in (None, 1, 2):
        x = y = 0.0
        for i in range(220):
            if not 60 < i < 160:  # a long stay in one place
                x, y = x + rnd.uniform(-6, 12), y + rnd.uniform(-6, 6)
            rows.append((k, i * 2, x + rnd.uniform(-3, 3), y))

    def step(state, r):
        if "at" not in state or math.hypot(r[2] - state["at"][0], r[3] - state["at"][1]) >= 25:
            state["at"] = r[2:]
            return True

    got = chains.spaced(spark.createDataFrame(rows, "k long, o long, x double, y double"), ["k"], "o", 25.0).collect()
    assert sorted(((r.k, r.o) for r in got), key=str) == walks(rows, step)


def test_empty(spark):
    df = spark.createDataFrame([], "k long, o long, x double, y double")
    assert chains.spaced(df, ["k"], "o", 5.0).count() == 0
    assert chains.drift_stop(df, ["k"], "o", "x", 2, 0.25, 4, 3).count() == 0
    assert chains.budget_cuts(df, ["k"], "o", C("x").cast("long"), 5).count() == 0
