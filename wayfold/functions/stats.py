"""Percentiles, ranks and effect sizes that stay exact when one group holds most rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from wayfold.operators.groups import group_key
from wayfold.operators.ordered import running_sum, with_one_row
from wayfold.session import checkpoint


def counted(df: DataFrame, keys: Sequence[str], value: str, width: float, weight: str | None = None) -> DataFrame:
    """Value-level histogram with its running count: (keys, value, _c, _cum) in two levels; written once, so ``df`` is read once."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    h = checkpoint(df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(n.alias("_c")))
    return running_sum(h, keys, [value], F.floor(F.col(value) / width), F.col("_c"), "_cum")


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, ps: Mapping[str, float], width: float, weight: str | None = None) -> DataFrame:
    """Linear-interpolation percentiles from value counts; no group is ever buffered whole. Null keys are a group like any other.

    ``width`` is the value step of one chunk of the running count (pick about range/1000).
    """
    keys = list(keys)
    h = counted(df.select(group_key(keys).alias("_k"), value, *([weight] if weight else [])), ["_k"], value, width, weight)
    n = h.groupBy("_k").agg(F.sum("_c").alias("_n"))
    j = h.join(n, "_k") if keys else with_one_row(h, n.select("_n"))
    at = lambda r: F.max(F.when((F.col("_cum") > r) & (F.col("_cum") - F.col("_c") <= r), F.col(value)))
    aggs = [F.max("_n").alias("n")]
    for name, p in ps.items():
        r = (F.col("_n") - 1) * F.lit(float(p))
        aggs += [at(F.floor(r)).alias(f"_{name}_lo"), at(F.ceil(r)).alias(f"_{name}_hi")]
    out = j.groupBy("_k").agg(*aggs) if keys else j.agg(*aggs)
    cols = []
    for name, p in ps.items():
        r = (F.col("n") - 1) * F.lit(float(p))
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        cols.append((lo + (hi - lo) * (r - F.floor(r))).alias(name))
    return out.select(*[F.col("_k")[k].alias(k) for k in keys], "n", *cols)


def cell_percentiles(df: DataFrame, keys: Sequence[str], value: str, ps: Mapping[str, float]) -> DataFrame:
    """Per-cell percentiles: copies of a value are merged before the shuffle, then weighted."""
    h = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    return h.groupBy(*keys).agg(
        F.sum("_c").alias("n"), *[F.percentile(value, F.lit(float(p)), F.col("_c")).alias(k) for k, p in ps.items()]
    )


def rank_auc(df: DataFrame, keys: Sequence[str], score: str, label: str, width: float, weight: str | None = None) -> DataFrame:
    """ROC-AUC per key with tie-averaged ranks (Mann-Whitney) from value counts; 0.5 if a class is empty."""
    keys = list(keys)
    w = F.col(weight) if weight else F.lit(1).cast("long")
    h = df.filter(F.col(score).isNotNull()).groupBy(*keys, F.col(score).alias("_s")).agg(
        F.sum(w).alias("_c"), F.sum(w * F.col(label).cast("long")).alias("_p"))
    h = running_sum(h, keys, ["_s"], F.floor(F.col("_s") / width), F.col("_c"), "_cum")
    mean_rank = F.col("_cum") - (F.col("_c") - 1) / F.lit(2.0)
    s = h.groupBy(*keys).agg(F.sum("_p").alias("n_pos"), F.sum(F.col("_c") - F.col("_p")).alias("n_neg"), F.sum(mean_rank * F.col("_p")).alias("r"))
    np_, nn = F.col("n_pos"), F.col("n_neg")
    return s.select(*keys, "n_pos", "n_neg", F.when((np_ == 0) | (nn == 0), 0.5).otherwise(
        (F.col("r") - np_ * (np_ + 1) * 0.5) / (np_ * nn)).alias("auc"))


def rank_labellings(df: DataFrame, score: str, code: str, count: int, width: float, p: float) -> DataFrame:
    """ROC-AUC and the ``p`` percentile of either class for ``count`` labellings (at most 39) of the same rows.

    ``code`` holds a row's labels as the ternary digits of a long, first labelling lowest: 2 positive, 1 negative, 0 none. Rows (``i``, ``n_pos``,
    ``n_neg``, ``auc``, ``pos_p``, ``neg_p``), one per labelling that has rows. Rows are written, shuffled and sorted once and not once per labelling:
    by value chunks of ``width`` (pick about range/1000), whose totals are then added up.
    """
    m = range(count)
    rows = checkpoint(df.select(F.col(score).alias("_s"), F.col(code).cast("long").alias("_code"))).filter("_s is not null and _code > 0")
    rows = rows.withColumn("_chunk", F.floor(F.col("_s") / width))
    digit = lambda unit: F.expr(f"_code div {unit} % 3")
    # sorted as they are: the columns of the labellings would fill the shuffle
    flags = rows.repartition("_chunk").sortWithinPartitions("_chunk", "_s").select(
        "_chunk", "_s", *[(digit(f"{3 ** i}L") == 2).cast("long").alias(f"_p{i}") for i in m], *[(digit(f"{3 ** i}L") == 1).cast("long").alias(f"_n{i}") for i in m])
    upto = W.partitionBy("_chunk").orderBy("_s").rangeBetween(W.unboundedPreceding, W.currentRow)
    runs = flags.select("*", *[F.sum(f"_{c}{i}").over(upto).alias(f"_{c}_upto{i}") for i in m for c in "pn"])
    # negatives up to each positive less positives up to each negative: ties cancel, twice the wins are this plus all pairs
    lead = lambda i: F.sum(F.col(f"_p{i}") * F.col(f"_n_upto{i}") - F.col(f"_n{i}") * F.col(f"_p_upto{i}"))
    chunks = runs.groupBy("_chunk").agg(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(3 ** i).cast("long").alias("_unit"), lead(i).alias("_lead"),
                                                           F.sum(f"_p{i}").alias("_p"), F.sum(f"_n{i}").alias("_n")) for i in m]).alias("_all"))
    chunks = checkpoint(chunks.select("_chunk", F.explode("_all").alias("_one")).select("_chunk", "_one.*"))
    all_, below = W.partitionBy("i"), W.partitionBy("i").orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    t = chunks.select("*", *[F.sum(c).over(all_).alias(f"{c}_all") for c in ("_p", "_n")], *[F.coalesce(F.sum(c).over(below), F.lit(0)).alias(f"{c}_below") for c in ("_p", "_n")])
    d = lambda c: F.col(c).cast("double")
    auc = t.groupBy("i").agg(F.sum("_p").alias("n_pos"), F.sum("_n").alias("n_neg"), F.sum((d("_lead") + d("_p") * d("_n")) / 2 + d("_p") * d("_n_below")).alias("_u"))
    none = (F.col("n_pos") == 0) | (F.col("n_neg") == 0)
    auc = auc.filter("n_pos + n_neg > 0").select("i", "n_pos", "n_neg", F.when(none, 0.5).otherwise(F.col("_u") / d("n_pos") / d("n_neg")).alias("auc"))
    # a percentile looks again at the chunks alone that hold its two ranks
    r = F.col("_sum") - 1
    ranks = t.select("i", "_unit", "_chunk", F.explode(F.array(*[F.struct(F.lit(k).alias("_lab"), F.col(c).alias("_in"), F.col(f"{c}_below").alias("_base"), F.col(f"{c}_all").alias("_sum")) for k, c in ((2, "_p"), (1, "_n"))])).alias("_one"))
    ranks = ranks.select("i", "_unit", "_chunk", "_one.*").withColumn("_r", r * F.lit(float(p))).filter((F.col("_base") <= F.ceil("_r")) & (F.col("_base") + F.col("_in") > F.floor("_r")) & (F.col("_in") > 0))
    k = ["i", "_lab", "_r", "_chunk", "_base"]
    met = rows.join(ranks, "_chunk").filter(digit("_unit") == F.col("_lab")).groupBy(*k, "_s").agg(F.count(F.lit(1)).alias("_c"))
    met = met.withColumn("_cum", F.col("_base") + F.sum("_c").over(W.partitionBy(*k).orderBy("_s").rowsBetween(W.unboundedPreceding, 0)))
    at = lambda rank: F.max(F.when((F.col("_cum") > rank) & (F.col("_cum") - F.col("_c") <= rank), F.col("_s")))
    q = met.groupBy("i", "_lab", "_r").agg(at(F.floor("_r")).alias("_lo"), at(F.ceil("_r")).alias("_hi"))
    q = q.withColumn("_v", F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_r") - F.floor("_r")))
    q = q.groupBy("i").agg(*[F.max(F.when(F.col("_lab") == lab, F.col("_v"))).alias(n) for n, lab in (("pos_p", 2), ("neg_p", 1))])
    return auc.join(q, "i")


def ordinal_auc(df: DataFrame, score: str, tie: str, label: str, width: float) -> DataFrame:
    """ROC-AUC on plain sort positions; ties are ordered by ``tie``; 0 if a class is empty."""
    d = running_sum(df, [], [score, tie], F.floor(F.col(score) / width), F.lit(1).cast("long"), "_r")
    s = d.agg(F.sum(F.col(label).cast("long")).alias("n_pos"), F.sum(1 - F.col(label).cast("long")).alias("n_neg"),
              F.sum(F.col("_r") * F.col(label).cast("long")).alias("r"))
    np_, nn = F.col("n_pos"), F.col("n_neg")
    return s.select("n_pos", "n_neg", F.when((np_ == 0) | (nn == 0), 0.0).otherwise(
        (F.col("r") - np_ * (np_ + 1) / 2.0) / (np_ * nn)).alias("auc"))


def cohen_d(df: DataFrame, value: str, flag: Column, pooled: bool = True) -> DataFrame:
    """Effect size between flag and not-flag rows: pooled population variance, or unpooled sample variance."""
    v = F.col(value)
    a, b = F.when(flag, v), F.when(~flag, v)
    s = df.agg(F.avg(a).alias("ma"), F.avg(b).alias("mb"), F.count(a).alias("na"), F.count(b).alias("nb"),
               (F.var_pop(a) if pooled else F.var_samp(a)).alias("va"), (F.var_pop(b) if pooled else F.var_samp(b)).alias("vb"))
    if pooled:
        p = ((F.col("na") - 1) * F.col("va") + (F.col("nb") - 1) * F.col("vb")) / F.greatest(F.col("na") + F.col("nb") - 2, F.lit(1))
        d = F.when((F.col("na") == 0) | (F.col("nb") == 0) | (p <= 1e-12), 0.0).otherwise((F.col("ma") - F.col("mb")) / F.sqrt(p))
    else:
        sx, sy = F.coalesce("va", F.lit(0.0)), F.coalesce("vb", F.lit(0.0))
        d = F.when((F.col("na") == 0) | (F.col("nb") == 0), 0.0).otherwise(
            (F.col("ma") - F.col("mb")) / F.when(sx + sy > 0, F.sqrt((sx + sy) / 2)).otherwise(1e-6))
    return s.select("na", "nb", d.alias("d"))


def discrete_percentile(sorted_array: Column, q: float) -> Column:
    """sorted[round((n-1)q)] with banker's rounding, NULL for an empty array."""
    n = F.size(sorted_array)
    i = F.bround((n - 1) * F.lit(float(q)), 0).cast("int")
    return F.when(n > 0, F.get(sorted_array, F.greatest(F.lit(0), F.least(n - 1, i))))


def rank_value(df: DataFrame, keys: Sequence[str], value: str, position: Column, width: float, out: str) -> DataFrame:
    """The value at a 0-based sorted position per key; ``position`` may use the group size ``_n``."""
    keys = list(keys)
    h = counted(df, keys, value, width)
    n = h.groupBy(*keys).agg(F.sum("_c").alias("_n"))
    j = (h.join(n, keys) if keys else with_one_row(h, n)).withColumn("_r", position)
    hit = (F.col("_cum") > F.col("_r")) & (F.col("_cum") - F.col("_c") <= F.col("_r"))
    return j.groupBy(*keys).agg(F.max("_n").alias("n"), F.max(F.when(hit, F.col(value))).alias(out))


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """row_number <= k; Spark's group limit cuts each group before the shuffle."""
    return df.withColumn(rank, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col(rank) <= k)
