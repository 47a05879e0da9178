"""Rules that depend on the last accepted row, without walking a key in one task.

Such a rule is a pointer from each row to the row that would be accepted next, if this one were. The pointers are found
for all rows at once; what is accepted are the rows that can be reached from the head of each key. ``follow`` finds these
in three steps: inside chunks of ``STRIDE`` rows all pointers are shortened together until they leave the chunk; the few
rows where pointers enter a chunk are then linked by doubling, in a logarithmic number of joins; last, each chunk marks
its rows from its entries on. Every task sees bounded chunks only.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from wayfold.operators.ordered import CHUNK, dense_index, drop_halo, fill_forward, halo_window, running_sum, with_halo
from wayfold.operators.groups import group_key
from wayfold.session import checkpoint, checkpoint_observed

STRIDE = 4096


def _arrays(chunk: pa.Table) -> tuple[np.ndarray, np.ndarray, int]:
    """Positions, and pointers as places in the chunk; ``n`` and more stand for pointers out of it, in order."""
    at, to = chunk.column("pos").to_numpy(), chunk.column("to").fill_null(-1).to_numpy()
    place = np.searchsorted(at, to)
    inside = (to >= 0) & (place < len(at))
    inside[inside] = at[place[inside]] == to[inside]
    place[~inside] = len(at)
    return to, place, len(at)


def _exits(chunk: pa.Table) -> pa.Table:
    """For every row the first position outside of the chunk on its chain, or null."""
    to, place, n = _arrays(chunk)
    # a row whose pointer leaves the chunk stays where it is
    step = np.where(place == n, np.arange(n), place)
    while True:
        far = step[step]
        if (far == step).all():
            break
        step = far
    out = to[step]
    return pa.table({"_k": chunk.column("_k"), "pos": chunk.column("pos"), "exit": pa.array(out, pa.int64(), mask=out < 0)})


def _marked(chunk: pa.Table) -> pa.Table:
    _, place, n = _arrays(chunk)
    hit = np.append(chunk.column("entry").to_numpy(), False)
    step = np.append(place, n)
    while True:  # after j turns all rows within 2^j steps of an entry are marked
        more = hit.copy()
        more[step[hit]] = True
        more[n] = False
        further = step[step]
        if (more == hit).all() and (further == step).all():
            break
        hit, step = more, further
    return chunk.select(["_k", "pos"]).filter(pa.array(hit[:n]))


def follow(links: DataFrame) -> DataFrame:
    """(_k, pos) of all rows reached: ``links`` has _k, pos, ``to`` (a later position of the key, or null) and ``head``."""
    links = checkpoint(links.select("_k", F.col("pos").cast("long").alias("pos"), F.col("to").cast("long").alias("to"), "head", F.floor(F.col("pos") / STRIDE).alias("_chunk")))
    key = links.schema["_k"].dataType.simpleString()
    sort = lambda fn: lambda chunk: fn(chunk.sort_by("pos"))
    exits = checkpoint(links.groupBy("_k", "_chunk").applyInArrow(sort(_exits), f"_k {key}, pos long, exit long"))
    heads = links.where("head").select("_k", "pos")
    doors = exits.where("exit is not null").select("_k", F.col("exit").alias("pos")).unionByName(heads).distinct()
    hops, seen = checkpoint_observed(exits.where("exit is not null").join(doors, ["_k", "pos"], "left_semi"), n=F.count(F.lit(1)))
    entries = heads
    while seen["n"]:
        entries = checkpoint(entries.unionByName(entries.join(hops, ["_k", "pos"]).select("_k", F.col("exit").alias("pos"))).distinct())
        further = hops.select("_k", F.col("pos").alias("exit"), F.col("exit").alias("far"))
        hops, seen = checkpoint_observed(hops.join(further, ["_k", "exit"]).select("_k", "pos", F.col("far").alias("exit")), n=F.count(F.lit(1)))
    entered = links.join(entries.select("_k", "pos", F.lit(True).alias("entry")), ["_k", "pos"], "left").withColumn("entry", F.coalesce("entry", F.lit(False)))
    return entered.select("_k", "_chunk", "pos", "to", "entry").groupBy("_k", "_chunk").applyInArrow(sort(_marked), f"_k {key}, pos long")


def _numbered(df: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """``df`` with _k and the dense position ``pos`` along ``order``, a whole number that tells the rows of a key apart."""
    return dense_index(df.withColumn("_k", group_key(by)), ["_k"], [order], F.floor(F.col(order) / CHUNK), "pos")


def budget_cuts(df: DataFrame, by: Sequence[str], order: str, amount: Column, budget: int) -> DataFrame:
    """Rows at which the amounts since the last cut reach ``budget`` (whole amounts, none negative, null: 0).

    The next cut after a row is where the running sum first reaches the row's own plus the budget: a search of all rows in
    the sorted sums at once, by filling back.
    """
    d = running_sum(_numbered(df, by, order), ["_k"], ["pos"], F.floor(F.col("pos") / CHUNK), F.coalesce(amount, F.lit(0)).cast("long"), "sum").withColumn("own", F.coalesce(amount, F.lit(0)).cast("long"))
    d = checkpoint(d)
    wide = max(budget, int((d.agg(F.avg("own")).first()[0] or 1) * CHUNK))
    asked = d.select("_k", "pos", (F.col("sum") + budget).alias("at"), F.lit(1).alias("asks"))
    there = d.select("_k", "pos", F.col("sum").alias("at"), F.lit(0).alias("asks"))
    # backwards: by falling sums; of rows with equal sums the first one answers, and comes before those who ask for it
    lines = asked.unionByName(there).select("_k", "pos", "asks", (-F.col("at")).alias("_at"), (-F.col("pos")).alias("_pos"))
    lines = fill_forward(lines, ["_k"], ["_at", "asks", "_pos"], F.floor(F.col("_at") / wide), {"to": F.when(F.col("asks") == 0, F.col("pos"))})
    to = lines.where("asks = 1").select("_k", "pos", "to")
    head = (F.col("sum") >= budget) & (F.col("sum") - F.col("own") < budget)
    cuts = follow(d.join(to, ["_k", "pos"]).select("_k", "pos", "to", head.alias("head")))
    return d.join(cuts, ["_k", "pos"], "left_semi").drop("_k", "pos", "sum", "own")


def drift_stop(df: DataFrame, by: Sequence[str], order: str, value: str, least: float, low: float, high: float, stop: int) -> DataFrame:
    """Rows until ``stop`` drifts in a row, with ``drift``: the value is under ``least``, or its ratio to the last accepted
    value lies outside of ``low`` to ``high``. The row that ends the propagation is left out, with all after it.

    The row accepted next is at most ``stop`` rows away, or there is none, so each row looks that far ahead.
    """
    d = checkpoint(_numbered(df, by, order))
    ahead = with_halo(d.select("_k", "pos", F.col(value).alias("v")), "pos", stop)
    w = halo_window(["_k"], "pos")
    # a value of zero is under ``least`` and never the last accepted one: its ratios are asked for but not used
    fits = [(F.lead("v", k).over(w) >= least) & F.try_divide(F.lead("v", k).over(w), F.col("v")).between(low, high) for k in range(1, stop + 1)]
    to = F.coalesce(*[F.when(f, F.col("pos") + k) for k, f in enumerate(fits, 1)])
    links = drop_halo(ahead.withColumn("to", to), "pos")
    first = links.where((F.col("v") >= least) & (F.col("pos") < stop)).groupBy("_k").agg(F.min("pos").alias("_first"))
    links = links.join(first, "_k", "left").select("_k", "pos", F.when(F.col("v") >= least, F.col("to")).alias("to"), (F.col("pos") == F.coalesce("_first", F.lit(-1))).alias("head"))
    kept = checkpoint(follow(links))
    last = kept.groupBy("_k").agg(F.max("pos").alias("_last"))
    d = d.join(kept.withColumn("_kept", F.lit(True)), ["_k", "pos"], "left").join(last, "_k", "left")
    return d.where(F.col("pos") < F.coalesce("_last", F.lit(-1)) + stop).withColumn("drift", F.col("_kept").isNull()).drop("_k", "pos", "_kept", "_last")


FAN = 64


def _boxes(d: DataFrame) -> DataFrame:
    """(_k, level, node, kids): up to FAN boxes below each node; on level 0 they are the points themselves."""
    kid = F.struct(F.col("pos").alias("at"), F.col("x").alias("x0"), F.col("x").alias("x1"), F.col("y").alias("y0"), F.col("y").alias("y1"))
    below, level, out = d.select("_k", "pos", kid.alias("kid")), 0, None
    while True:
        node = F.floor(F.col("pos") / FAN).cast("long")
        up = checkpoint(below.groupBy("_k", node.alias("node")).agg(F.array_sort(F.collect_list("kid")).alias("kids")))
        level_rows = up.select("_k", F.lit(level).alias("level"), "node", "kids")
        out = level_rows if out is None else out.unionByName(level_rows)
        if not up.where("node > 0").head(1):
            return out
        edge = lambda f, c: f(F.transform("kids", lambda b: b[c])).alias(c)
        box = F.struct(F.col("node").alias("at"), edge(F.array_min, "x0"), edge(F.array_max, "x1"), edge(F.array_min, "y0"), edge(F.array_max, "y1"))
        below, level = up.select("_k", F.col("node").alias("pos"), box.alias("kid")), level + 1


def spaced(df: DataFrame, by: Sequence[str], order: str, gap: float) -> DataFrame:
    """The first row of each key, and every row at least ``gap`` from the last one taken.

    The next row after each is found in a tree of boxes, FAN to a node: boxes that lie within the gap as a whole are
    skipped, others are opened. Almost all rows find theirs in their own node.
    """
    d = checkpoint(_numbered(df, by, order).withColumn("x", F.col("x").cast("double")).withColumn("y", F.col("y").cast("double")))
    tree = checkpoint(_boxes(d))
    top = (tree.agg(F.max("level")).first()[0] or 0)
    asks = d.select("_k", "pos", "x", "y", F.lit(0).alias("level"), (F.col("pos") + 1).alias("next"))
    found = None
    while True:
        j = asks.withColumn("node", F.floor(F.col("next") / FAN).cast("long")).join(tree, ["_k", "level", "node"], "left")
        reach = lambda b: F.hypot(F.greatest(F.abs(b["x0"] - F.col("x")), F.abs(b["x1"] - F.col("x"))), F.greatest(F.abs(b["y0"] - F.col("y")), F.abs(b["y1"] - F.col("y"))))
        far = F.filter(F.coalesce("kids", F.array().cast(tree.schema["kids"].dataType)), lambda b: (b["at"] >= F.col("next")) & (reach(b) >= gap))
        j, seen = checkpoint_observed(j.withColumn("hit", F.try_element_at(far, F.lit(1))["at"]).select("_k", "pos", "x", "y", "level", "node", "hit"),
                                      open=F.count_if(~((F.col("level") == 0) & F.col("hit").isNotNull()) & ~((F.col("level") == top) & F.col("hit").isNull())))
        done = j.where((F.col("level") == 0) & F.col("hit").isNotNull()).select("_k", "pos", F.col("hit").alias("to"))
        found = done if found is None else found.unionByName(done)
        if not seen["open"]:
            break
        # a box that must be opened: its first child, one level down; none: the node after this one, one level up
        down = j.where((F.col("level") > 0) & F.col("hit").isNotNull()).select("_k", "pos", "x", "y", (F.col("level") - 1).alias("level"), (F.col("hit") * FAN).alias("next"))
        up = j.where((F.col("level") < top) & F.col("hit").isNull()).select("_k", "pos", "x", "y", (F.col("level") + 1).alias("level"), (F.col("node") + 1).alias("next"))
        asks = down.unionByName(up)
    links = d.select("_k", "pos").join(found, ["_k", "pos"], "left").select("_k", "pos", "to", (F.col("pos") == 0).alias("head"))
    return d.join(follow(links), ["_k", "pos"], "left_semi").drop("_k", "pos")
