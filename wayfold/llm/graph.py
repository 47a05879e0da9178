"""Connected components by hooking and contraction, with every hot vertex kept splittable.

Each round hooks a vertex to its smallest neighbour, shortens the paths, and replaces the ends of all
edges by their roots. Minima are partial aggregates; joins are between written tables, one side of
which is unique by key, so adaptive execution can split a vertex with very many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wayfold.session import checkpoint, checkpoint_observed


def _shortened(hooks: DataFrame) -> DataFrame:
    """Follow (id, root) pairs, roots smaller than ids, until every root is final."""
    while True:
        far = hooks.select(F.col("id").alias("root"), F.col("root").alias("far"))
        hooks, seen = checkpoint_observed(
            hooks.join(far, "root", "left").select("id", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")),
            n=F.count_if("moved"))
        hooks = hooks.drop("moved")
        if not seen["n"]:
            return hooks


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every end of an edge (``a``, ``b``) but the roots themselves; root: the smallest id reachable."""
    left, seen = checkpoint_observed(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), n=F.count(F.lit(1)))
    steps: list[DataFrame] = []
    while seen["n"]:
        ends = F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("b").alias("to")), F.struct(F.col("b").alias("id"), F.col("a").alias("to")))).alias("e")
        hooks = left.select(ends).groupBy("e.id").agg(F.min("e.to").alias("root")).where("root < id")
        hooks = _shortened(checkpoint(hooks))
        steps.append(hooks)
        # smaller ends first: they are the shared ones
        one = left.join(hooks.select(F.col("id").alias("a"), F.col("root").alias("ra")), "a", "left")
        two = one.join(hooks.select(F.col("id").alias("b"), F.col("root").alias("rb")), "b", "left")
        a, b = F.coalesce("ra", "a"), F.coalesce("rb", "b")
        left, seen = checkpoint_observed(two.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a <> b").distinct(), n=F.count(F.lit(1)))
    if not steps:
        return left.select(F.col("a").alias("id"), F.col("b").alias("root"))
    out = steps[-1]
    for earlier in reversed(steps[:-1]):
        later = out.select(F.col("id").alias("root"), F.col("root").alias("far"))
        moved = earlier.join(later, "root", "left").select("id", F.coalesce("far", "root").alias("root"))
        out = checkpoint(moved.unionByName(out))
    return out
