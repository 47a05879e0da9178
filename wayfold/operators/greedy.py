"""Greedy, order-dependent selections: parallel rounds where that is exact, a sorted fold where it is not."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from wayfold.operators.groups import null_groups
from wayfold.session import checkpoint

Pair = Callable[[Callable[[str], Column], Callable[[str], Column]], Column]


SMALL = 512


@null_groups
def greedy_keep(df: DataFrame, key: str, by: Sequence[str], priority: Sequence[Column], reach: float | Column, conflict: Pair) -> DataFrame:
    """Walk the rows of each group by descending priority; keep a row unless a kept one conflicts with it.

    Returns df plus ``owner`` (the kept row that claimed it, best priority first) and ``kept``.
    Groups of at most ``SMALL`` rows (counted first) are walked inside one array expression; larger
    groups go through ``greedy_rounds``, which never loads a group. Both give the same rows as long as
    no two conflicting rows are more than ``reach`` apart on an axis. A rule on distance knows its reach; for
    boxes pass the side as a column, and the reach is the largest side in ``df``.
    """
    by = list(by)
    if isinstance(reach, Column):
        reach = float(df.agg(F.max(reach)).first()[0] or 1.0)
    d = df.withColumn("_p", F.struct(*[p.alias(f"p{i}") for i, p in enumerate(priority)]))
    n = d.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    big = n.filter(F.col("_n") > SMALL)
    small = d.join(n.filter(F.col("_n") <= SMALL).select(*by), by, "left_semi")
    row = F.struct("_p", *df.columns)
    g = small.groupBy(*by).agg(F.sort_array(F.collect_list(row), asc=False).alias("r"))
    # rows farther apart than the reach never meet: a group is walked in pieces, cut where a strip of two reaches is empty
    strip = lambda r: F.coalesce(F.floor(r["x"] / F.lit(2.0 * reach)), F.lit(0))
    g = g.withColumn("_s", F.array_sort(F.array_distinct(F.transform("r", strip))))
    g = g.withColumn("_cut", F.filter("_s", lambda s, i: (i == 0) | (s - F.get("_s", i - 1) > 1)))
    last = lambda i: F.coalesce(F.get("_cut", i + 1) - 1, F.array_max("_s"))
    pieces = F.when(F.size("_cut") == 1, F.array("r")).otherwise(F.transform("_cut", lambda c, i: F.filter("r", lambda r: strip(r).between(c, last(i)))))
    g = g.select(F.explode(pieces).alias("r"))
    entry = lambda b, owner: F.struct(b.alias("b"), owner.alias("owner"))

    def add(acc: Column, b: Column) -> Column:
        hit = F.filter(acc, lambda o: (o["owner"] == o["b"][key]) & conflict(lambda c: o["b"][c], lambda c: b[c]))
        return F.concat(acc, F.array(entry(b, F.coalesce(F.get(hit, 0)["owner"], b[key]))))

    none = F.transform(F.filter("r", lambda r: F.lit(False)), lambda r: entry(r, r[key]))
    out = g.select(F.explode(F.aggregate("r", none, add)).alias("e")).select(*[F.col(f"e.b.{c}").alias(c) for c in df.columns], "e.owner")
    out = out.withColumn("kept", F.col("owner") == F.col(key))
    if big.isEmpty():
        return out
    return out.unionByName(greedy_rounds(df.join(big.select(*by), by, "left_semi"), key, by, priority, reach, conflict).select(*out.columns))


@null_groups
def greedy_rounds(df: DataFrame, key: str, by: Sequence[str], priority: Sequence[Column], reach: float, conflict: Pair, max_rounds: int = 100_000) -> DataFrame:
    """Walk the rows of each group by descending priority; keep a row unless a kept one conflicts with it.

    Needs ``x``/``y`` and a ``reach`` so that conflicting rows are at most ``reach`` apart on both axes.

    Runs in rounds instead of a loop over rows: a row that is the best undecided one of its 3x3
    cells can only have been blocked by rows decided earlier, so all such rows are kept at once and
    then claim what they conflict with. Per round only cell maxima and kept rows are copied, never
    pairs of undecided rows; the result equals the sequential walk.
    """
    by = list(by)
    cell = lambda c: F.floor(F.col(c) / F.lit(float(reach))).cast("long")
    alive = df.withColumn("_p", F.struct(*[p.alias(f"p{i}") for i, p in enumerate(priority)])).withColumn("_cx", cell("x")).withColumn("_cy", cell("y"))
    alive = checkpoint(alive)
    cols = alive.columns
    k = [*by, "_cx", "_cy"]
    ring = F.explode(F.array(*[F.struct(F.lit(a).cast("long").alias("dx"), F.lit(b).cast("long").alias("dy")) for a in (-1, 0, 1) for b in (-1, 0, 1)])).alias("_o")

    def spread(d: DataFrame) -> DataFrame:
        return d.select("*", ring).withColumn("_cx", F.col("_cx") + F.col("_o.dx")).withColumn("_cy", F.col("_cy") + F.col("_o.dy")).drop("_o")

    done: list[DataFrame] = []
    for _ in range(max_rounds):
        top = spread(alive.groupBy(*k).agg(F.max("_p").alias("_t"))).groupBy(*k).agg(F.max("_t").alias("_t"))
        lead = alive.join(top, k).filter(F.col("_p") == F.col("_t")).drop("_t")
        r = spread(lead.select(*k, *[F.col(c).alias("_r_" + c) for c in cols if c not in k]))
        test = conflict(lambda c: F.col("_r_" + c), lambda c: F.col(c)) | (F.col("_r_" + key) == F.col(key))
        claim = alive.join(r, k).filter(test).groupBy(key).agg(F.max(F.struct(F.col("_r__p"), F.col("_r_" + key).alias("owner"))).alias("_w"))
        step = checkpoint(alive.join(claim, key, "left").withColumn("owner", F.col("_w.owner")).drop("_w"))
        done.append(step.filter("owner is not null"))
        alive = step.filter("owner is null").select(*cols)
        if alive.isEmpty():
            break
    else:
        raise RuntimeError("greedy_keep did not finish; raise max_rounds")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.drop("_p", "_cx", "_cy").withColumn("kept", F.col("owner") == F.col(key))


def pick_spaced(df: DataFrame, key: str, by: Sequence[str], priority: Sequence[Column], n: int, min_dist: float) -> DataFrame:
    """Up to ``n`` best rows per group that keep ``min_dist`` from each other: one aggregate and one join per pick."""
    by = list(by)
    rest = df.withColumn("_p", F.struct(*[p.alias(f"p{i}") for i, p in enumerate(priority)]))
    picks: list[DataFrame] = []
    for i in range(n):
        best = checkpoint(rest.groupBy(*by).agg(F.max(F.struct("_p", F.col(key).alias("_k"), F.col("x").alias("_bx"), F.col("y").alias("_by"))).alias("_b")))
        picks.append(best.select(*by, F.col("_b._k").alias(key)).withColumn("pick", F.lit(i + 1)))
        if i + 1 < n:
            rest = rest.join(best.select(*by, F.col("_b._bx").alias("_bx"), F.col("_b._by").alias("_by"), F.col("_b._k").alias("_k")), by).filter(
                (F.col(key) != F.col("_k")) & (F.hypot(F.col("x") - F.col("_bx"), F.col("y") - F.col("_by")) >= min_dist)).drop("_bx", "_by", "_k")
    out = picks[0]
    for p in picks[1:]:
        out = out.unionByName(p)
    return df.join(out, [*by, key])


def ordered_fold(df: DataFrame, by: Sequence[str], order: Sequence[str], start: Callable[[], object], step: Callable, schema: str) -> DataFrame:
    """Sequential state machine per key for rules that depend on the last accepted row.

    Spark shuffles by key and sorts inside each partition (spilling as needed); the Python side
    streams over the sorted batches and holds one state at a time, so no group is loaded whole.
    ``step(state, row) -> output tuple or None`` sees rows as named tuples.
    """
    by = list(by)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state = None, None
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                k = tuple(getattr(row, b) for b in by)
                if k != current:
                    current, state = k, start()
                res = step(state, row)
                if res is not None:
                    out.append(res)
            yield pd.DataFrame(out, columns=names) if out else pd.DataFrame({n: [] for n in names})

    names = [p.strip().split()[0] for p in schema.split(",")]
    return df.repartition(*[F.col(b) for b in by]).sortWithinPartitions(*by, *order).mapInPandas(run, schema)
