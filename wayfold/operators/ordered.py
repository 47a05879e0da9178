"""Ordered computations that never put one whole key into one task.

A drive may hold a third of all rows, so nothing here windows over a bare drive key.
``dense_index`` numbers rows in two levels (inside value chunks, then over chunk counts),
``running_sum`` does the same for prefix sums, and ``with_halo`` copies the few border rows a
lag/lead/moving window needs into the neighbouring chunk, so windows run per (key, chunk).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

CHUNK = 4096


def with_one_row(df: DataFrame, one: DataFrame) -> DataFrame:
    """Add the columns of a one-row aggregate to every row, as a scalar subquery (no join at all)."""
    s = one.select(F.struct(*one.columns).alias("_one")).scalar()
    return df.withColumn("_one", s).select(*df.columns, *[F.col("_one")[c].alias(c) for c in one.columns])


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on equal keys where null equals null; the keys come from ``left``."""
    named = right.select(*[F.col(k).alias(f"_r_{k}") if k in keys else F.col(k) for k in right.columns])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(named, same).drop(*[f"_r_{k}" for k in keys])


def _offsets(df: DataFrame, keys: Sequence[str], total: Column) -> DataFrame:
    """Exclusive prefix totals of the chunks: one row per (key, chunk), a tiny fraction of the rows."""
    w = W.partitionBy(*keys).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    totals = df.groupBy(*keys, "_chunk").agg(total.alias("_total"))
    return totals.select(*keys, "_chunk", F.coalesce(F.sum("_total").over(w), F.lit(0)).alias("_base"))


def dense_index(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], chunk: Column, out: str = "idx"
) -> DataFrame:
    """0-based row number per key; ``chunk`` must be monotone in the order."""
    d = df.withColumn("_chunk", chunk)
    base = _offsets(d, keys, F.count(F.lit(1)))
    w = W.partitionBy(*keys, "_chunk").orderBy(*order)
    return (
        join_on_keys(d.withColumn("_local", F.row_number().over(w) - 1), base, [*keys, "_chunk"])
        .withColumn(out, (F.col("_base") + F.col("_local")).cast("long"))
        .drop("_chunk", "_local", "_base")
    )


def running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], chunk: Column, value: Column, out: str
) -> DataFrame:
    """Inclusive prefix sum per key, in two levels."""
    d = df.withColumn("_chunk", chunk).withColumn("_v", value)
    base = _offsets(d, keys, F.sum("_v"))
    w = W.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return (
        join_on_keys(d.withColumn("_local", F.sum("_v").over(w)), base, [*keys, "_chunk"])
        .withColumn(out, F.col("_base") + F.col("_local"))
        .drop("_chunk", "_local", "_base", "_v")
    )


def fill_forward(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, values: Mapping[str, Column]) -> DataFrame:
    """Add the last value that is not null at or before each row of its key, in two levels; ``order`` tells all rows of a key apart, keys are not null."""
    names = list(values)
    d = df.withColumn("_chunk", chunk).select("*", *[v.alias(n) for n, v in values.items()])
    at = F.struct(*order)
    ends = d.groupBy(*keys, "_chunk").agg(*[F.max_by(n, F.when(F.col(n).isNotNull(), at)).alias(n) for n in names])
    before = W.partitionBy(*keys).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    ends = ends.select(*keys, "_chunk", *[F.last(n, ignorenulls=True).over(before).alias(f"_b_{n}") for n in names])
    inside = W.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    d = d.select(*[c for c in d.columns if c not in names], *[F.last(n, ignorenulls=True).over(inside).alias(n) for n in names])
    return d.join(ends, [*keys, "_chunk"]).select(*df.columns, *[F.coalesce(n, f"_b_{n}").alias(n) for n in names])


def previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, values: Mapping[str, Column]) -> DataFrame:
    """Add the values of the row before each row of its key (null for the first), in two levels; ``order`` tells all rows of a key apart, keys are not null."""
    names, at = list(values), F.struct(*order)
    d = df.withColumn("_chunk", chunk).select("*", *[v.alias(f"_v_{n}") for n, v in values.items()])
    ends = d.groupBy(*keys, "_chunk").agg(*[F.max_by(f"_v_{n}", at).alias(f"_e_{n}") for n in names])
    ends = ends.select(*keys, "_chunk", *[F.lag(f"_e_{n}").over(W.partitionBy(*keys).orderBy("_chunk")).alias(f"_b_{n}") for n in names])
    inside = W.partitionBy(*keys, "_chunk").orderBy(*order)
    first = F.row_number().over(inside) == 1
    d = d.select(*d.columns, first.alias("_first"), *[F.lag(f"_v_{n}").over(inside).alias(f"_l_{n}") for n in names])
    return d.join(ends, [*keys, "_chunk"]).select(*df.columns, *[F.when(F.col("_first"), F.col(f"_b_{n}")).otherwise(F.col(f"_l_{n}")).alias(n) for n in names])


def with_halo(df: DataFrame, index: str, k: int, size: int = CHUNK) -> DataFrame:
    """Copy rows within ``k`` of a chunk border into the next chunk (``_chunk``).

    Window over (keys, _chunk) ordered by the integer ``index``, then call ``drop_halo``.
    Grows the data by 2k/size.
    """
    i = F.col(index)
    near = F.array_distinct(
        F.array(*[F.floor((i + F.lit(d)) / F.lit(size)).cast("long") for d in (-k, 0, k)])
    )
    return df.withColumn("_chunk", F.explode(near))


def drop_halo(df: DataFrame, index: str, size: int = CHUNK) -> DataFrame:
    return df.filter(F.col("_chunk") == F.floor(F.col(index) / F.lit(size)).cast("long")).drop("_chunk")


def halo_window(keys: Sequence[str], index: str):
    return W.partitionBy(*keys, "_chunk").orderBy(index)


def islands(df: DataFrame, keys: Sequence[str], index: str, size: int = CHUNK) -> DataFrame:
    """Maximal runs of consecutive integers: one row per (key, run) with start, end, n.

    Input must be distinct in (key, index). The run key is index minus its dense position.
    """
    d = dense_index(df, keys, [index], F.floor(F.col(index) / size).cast("long"), "_pos")
    return (
        d.groupBy(*keys, (F.col(index) - F.col("_pos")).alias("_run"))
        .agg(F.min(index).alias("run_start"), F.max(index).alias("run_end"), F.count(F.lit(1)).alias("n"))
        .drop("_run")
    )
