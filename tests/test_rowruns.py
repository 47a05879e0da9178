"""Holes of run-length masks against a flood of the box, and on a mask whose box is far too large to fill."""

import random

import pytest

from wayfold.operators import grid, ordered, rowruns
from pyspark.sql import functions as F

SCHEMA = "drive_id long, ix long, iy long"


def flooded(cells):
    """{cell: (label, size)} of holes, by flooding the padded box."""
    xs, ys = [c[0] for c in cells], [c[1] for c in cells]
    box = {(x, y) for x in range(min(xs) - 1, max(xs) + 2) for y in range(min(ys) - 1, max(ys) + 2)} - set(cells)
    out = {}
    while box:
        part, todo = set(), [min(box)]
        while todo:
            x, y = todo.pop()
            if (x, y) in box:
                box.remove((x, y))
                part.add((x, y))
                todo += [(x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)]
        if min(xs) - 1 not in {c[0] for c in part}:
            label = min((y, x) for x, y in part)
            out |= {c: (label, len(part)) for c in part}
    return out


@pytest.mark.parametrize("chunk", [4096, 3])
def test_holes_against_flood(spark, monkeypatch, chunk):
    monkeypatch.setattr(rowruns, "CHUNK", chunk)
    rnd = random.Random(11)
    rows, want = [], set()
    for drive in (None, 1, 2, 3):
        cells = {(rnd.randrange(-9, 12), rnd.randrange(-9, 12)) for _ in range({None: 220, 1: 280, 2: 330, 3: 1}[drive])}
        rows += [(drive, *c) for c in cells] + [(drive, *next(iter(cells)))]
        want |= {(drive, *c, *label, n) for c, (label, n) in flooded(cells).items()}
    mask = spark.createDataFrame(rows, SCHEMA)
    got = {(r.drive_id, r.ix, r.iy, r.label.iy, r.label.ix, r.hole_cells) for r in grid.holes(mask, ["drive_id"]).collect()}
    assert got == want and len(want) > 100
    filled = {tuple(r) for r in grid.fill_small_holes(mask, None, 4, ["drive_id"]).collect()}
    assert filled == set(rows) | {w[:3] for w in want if w[5] <= 4}
    corridor = spark.createDataFrame([(d, 0, y) for d in (None, 2) for y in range(-9, 12)], SCHEMA)
    touched = {(w[0], *w[3:5]) for w in want if w[0] != 1 and w[1] == 0}
    filled = {tuple(r) for r in grid.fill_small_holes(mask, corridor, 4, ["drive_id"]).collect()}
    assert filled == set(rows) | {w[:3] for w in want if w[5] <= 4 and (w[0], *w[3:5]) in touched}


def test_sparse_ring_of_1e5(spark):
    n = 100_000
    stats = grid.hole_stats(ring(spark, n), 1.0, ["drive_id"]).collect()
    assert [tuple(r) for r in stats] == [(1, 1, float((n - 1) ** 2), float((n - 1) ** 2))]


def test_open_ring_has_no_hole(spark):
    assert grid.hole_stats(ring(spark, 500).filter("not (ix = 0 and iy = 5)"), 1.0, ["drive_id"]).count() == 0


def ring(spark, n):
    side = spark.range(n + 1)
    at = lambda x, y: side.select(F.lit(1).cast("long").alias("drive_id"), x.cast("long").alias("ix"), y.cast("long").alias("iy"))
    return at(F.col("id"), F.lit(0)).union(at(F.col("id"), F.lit(n))).union(at(F.lit(0), F.col("id"))).union(at(F.lit(n), F.col("id")))


def test_empty_mask(spark):
    assert grid.holes(spark.createDataFrame([], SCHEMA), ["drive_id"]).count() == 0


def test_fill_forward_crosses_chunks(spark):
    rows = [(k, i, i * 7 if i % 11 == 3 else None) for k in (1, 2) for i in range(60)]
    df = spark.createDataFrame(rows, "k long, i long, v long")
    got = {(r.k, r.i): r.last for r in ordered.fill_forward(df, ["k"], ["i"], F.floor(F.col("i") / 4), {"last": F.col("v")}).collect()}
    assert got == {(k, i): max((j * 7 for j in range(i + 1) if j % 11 == 3), default=None) for k, i, _ in rows}
