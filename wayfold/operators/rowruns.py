"""Masks as runs of cells per grid row: the work follows the set cells, never the box around them.

A hole is a 4-connected part of the complement that cannot reach the outside. Seen row by row it consists of gaps
between set cells; a gap is outside if it leads to a row end of a neighbouring row or to a row without cells, and what
touches an outside gap is outside as well. So no cell of an empty box is ever made.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from wayfold.operators.components import connected_components
from wayfold.operators.groups import group_key
from wayfold.operators.ordered import CHUNK, fill_forward
from wayfold.session import checkpoint


def _parts(by: Sequence[str]) -> list[Column]:
    return [F.col("_k")[c].alias(c) for c in by]


def inner_gaps(mask: DataFrame, by: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(_k, iy, g0, g1): gaps between set cells of a row, and (_k, iy, lo, hi): the rows' extents."""
    cells = checkpoint(mask.select(group_key(by).alias("_k"), F.col("ix").cast("long").alias("ix"), F.col("iy").cast("long").alias("iy")).distinct())
    cells = cells.withColumn("_chunk", F.floor(F.col("ix") / CHUNK))
    after = F.lead("ix").over(W.partitionBy("_k", "iy", "_chunk").orderBy("ix"))
    within = cells.select("_k", "iy", (F.col("ix") + 1).alias("g0"), (after - 1).alias("g1"))
    # rows of any width: one line per chunk that holds cells
    chunks = cells.groupBy("_k", "iy", "_chunk").agg(F.min("ix").alias("lo"), F.max("ix").alias("hi"))
    across = chunks.select("_k", "iy", (F.col("hi") + 1).alias("g0"), (F.lead("lo").over(W.partitionBy("_k", "iy").orderBy("_chunk")) - 1).alias("g1"))
    gaps = within.unionByName(across).filter("g1 >= g0")
    return gaps, chunks.groupBy("_k", "iy").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def hole_runs(mask: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, iy, ix0, ix1, label, hole_cells): the runs of all holes; ``label`` is the first cell of the hole's first gap."""
    gaps, extents = inner_gaps(mask, by)
    extents = checkpoint(extents)
    gap = F.struct("_k", "iy", "g0")
    for step in (-1, 1):
        beside = extents.select("_k", (F.col("iy") - step).alias("iy"), F.col("lo").alias(f"lo{step}"), F.col("hi").alias(f"hi{step}"))
        gaps = gaps.join(beside, ["_k", "iy"], "left")
    free = lambda step: F.col(f"lo{step}").isNull() | (F.col("g0") < F.col(f"lo{step}")) | (F.col("g1") > F.col(f"hi{step}"))
    gaps = checkpoint(gaps.select(gap.alias("id"), "_k", "iy", "g0", "g1", (free(-1) | free(1)).alias("outside")))

    # two gaps of neighbouring rows touch if the one that starts later starts inside the other
    sides = F.explode(F.array(F.struct(F.col("iy").alias("line"), F.lit(0).alias("side")), F.struct((F.col("iy") - 1).alias("line"), F.lit(1).alias("side")))).alias("s")
    lines = gaps.select("_k", "id", "g0", "g1", "outside", sides).select("_k", "s.line", "s.side", "id", "g0", "g1", "outside")
    seen = {f"last{s}": F.when(F.col("side") == s, F.struct("id", "g1", "outside")) for s in (0, 1)}
    lines = fill_forward(lines, ["_k", "line"], ["g0", "side"], F.floor(F.col("g0") / CHUNK), seen)
    other = F.when(F.col("side") == 0, F.col("last1")).otherwise(F.col("last0"))
    edges = lines.withColumn("_o", other).filter(F.col("_o.g1") >= F.col("g0")).filter(~(F.col("outside") & F.col("_o.outside"))).select(F.col("id").alias("src"), F.col("_o.id").alias("dst"))
    labels = connected_components(edges)
    gaps = gaps.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    whole = gaps.groupBy("label").agg(F.max("outside").alias("_out"), F.sum(F.col("g1") - F.col("g0") + 1).alias("hole_cells")).filter(~F.col("_out")).drop("_out")
    return gaps.join(whole, "label").select(*_parts(by), "iy", F.col("g0").alias("ix0"), F.col("g1").alias("ix1"), F.struct("label.iy", F.col("label.g0").alias("ix")).alias("label"), "hole_cells")


def cells_of(runs: DataFrame) -> DataFrame:
    """One row per cell of runs (ix0, ix1)."""
    return runs.withColumn("ix", F.explode(F.sequence("ix0", "ix1"))).drop("ix0", "ix1")
