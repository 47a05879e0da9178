"""Aggregations used by quality reports: fits, profiles, stability, roll-ups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from wayfold.operators import ordered as O


def extent_and_intensity(df: DataFrame, by: Sequence[str]) -> DataFrame:
    n = F.count(F.lit(1))
    box = [f(c).alias(f"{p}{c}") for c in "xyz" for p, f in (("min", F.min), ("max", F.max))]
    return df.groupBy(*by).agg(*box, F.min("intensity").alias("i_min"), F.avg("intensity").alias("i_mean"), F.max("intensity").alias("i_max"),
                               (F.count_if(F.col("intensity") > 0) / n).alias("nonzero_ratio"), n.alias("n"))


def distinct_steps(df: DataFrame, by: Sequence[str], value: str, digits: int, chunk: float) -> DataFrame:
    """Gaps between neighbouring distinct rounded values: (by, step). Two-level, no key in one task."""
    u = df.select(*by, F.bround(value, digits).alias("_v")).distinct()
    i = O.dense_index(u, by, ["_v"], F.floor(F.col("_v") / chunk), "_i")
    h = O.with_halo(i, "_i", 1)
    d = h.withColumn("step", F.col("_v") - F.lag("_v").over(O.halo_window(by, "_i")))
    return O.drop_halo(d, "_i").select(*by, "_v", "step")


def banding(df: DataFrame, by: Sequence[str], value: str = "y", limit: float = 0.01) -> DataFrame:
    """Smallest non-zero step of the distinct values at 1 mm; ok when it is at most ``limit``."""
    s = distinct_steps(df, by, value, 3, 16.0)
    m = F.min(F.when(F.col("step") > 0, F.bround("step", 6)))
    return s.groupBy(*by).agg(m.alias("min_step"), F.count(F.lit(1)).alias("unique_values")).withColumn(
        "ok", F.coalesce(F.col("min_step") <= limit, F.lit(False)))


def frames_hit_bucket(n: Column) -> Column:
    return F.when(n <= 1, "1").when(n <= 3, "2-3").when(n <= 7, "4-7").when(n <= 15, "8-15").otherwise("16+")


def track_stability(obs: DataFrame, track: str, stride: int, collision_m: float) -> DataFrame:
    """Per track: frames hit, gaps over 2 strides, centroid jitter, extent and collision flag.

    ``obs`` has (track, frame_id, x, y). Gaps and jitter follow the frame order through a dense
    index with one halo row, so one long track is spread over many tasks.
    """
    d = obs.groupBy(track, "frame_id").agg(F.min(F.struct("x", "y")).alias("p")).select(track, "frame_id", "p.*")
    i = O.dense_index(d, [track], ["frame_id"], F.floor(F.col("frame_id") / O.CHUNK), "_i")
    w = O.halo_window([track], "_i")
    h = O.with_halo(i, "_i", 1)
    h = h.withColumn("gap", F.col("frame_id") - F.lag("frame_id").over(w)).withColumn(
        "move", F.hypot(F.col("x") - F.lag("x").over(w), F.col("y") - F.lag("y").over(w)))
    s = O.drop_halo(h, "_i")
    span = F.hypot(F.max("x") - F.min("x"), F.max("y") - F.min("y"))
    return s.groupBy(track).agg(
        F.count(F.lit(1)).alias("frames_hit"), F.max("gap").alias("gap_max"), F.count_if(F.col("gap") > 2 * stride).alias("long_gaps"),
        F.avg("move").alias("jitter_mean"), F.max("move").alias("jitter_max"), span.alias("extent"), (span > collision_m).alias("collision"))


def fit_similarity(df: DataFrame, keep_share: float) -> DataFrame:
    """2-D similarity src -> dst in two passes: fit, drop the largest residuals, fit again.

    In the plane the best rotation has a closed form (atan2 of covariance sums), so both fits are
    single aggregates over (sx, sy, dx, dy); the residual cut-off is an order statistic.
    """
    from wayfold.functions.stats import rank_value

    def fit(d: DataFrame) -> DataFrame:
        a = d.agg(*[F.avg(c).alias("m" + c) for c in ("sx", "sy", "dx", "dy")],
                  *[F.covar_pop(p, q).alias(p + q) for p in ("sx", "sy") for q in ("dx", "dy")],
                  (F.var_pop("sx") + F.var_pop("sy")).alias("var"))
        p, q = F.col("sxdx") + F.col("sydy"), F.col("sxdy") - F.col("sydx")
        yaw, scale = F.atan2(q, p), F.when(F.col("var") > 0, F.hypot(p, q) / F.col("var")).otherwise(1.0)
        a = a.withColumn("yaw", yaw).withColumn("scale", scale)
        c, s = F.cos("yaw"), F.sin("yaw")
        return a.select("yaw", "scale", (F.col("mdx") - F.col("scale") * (c * F.col("msx") - s * F.col("msy"))).alias("tx"),
                        (F.col("mdy") - F.col("scale") * (s * F.col("msx") + c * F.col("msy"))).alias("ty"))

    def residual(d: DataFrame, m: DataFrame) -> DataFrame:
        j = O.with_one_row(d, m)
        c, s = F.cos("yaw"), F.sin("yaw")
        ex = F.col("scale") * (c * F.col("sx") - s * F.col("sy")) + F.col("tx") - F.col("dx")
        ey = F.col("scale") * (s * F.col("sx") + c * F.col("sy")) + F.col("ty") - F.col("dy")
        return j.withColumn("res", F.hypot(ex, ey)).drop("yaw", "scale", "tx", "ty")

    first = residual(df, fit(df))
    keep = F.greatest(F.lit(3), F.floor(F.col("_n") * F.lit(keep_share)).cast("int")) - 1
    cut = rank_value(first, [], "res", F.least(keep, F.col("_n") - 1), 0.01, "cut")
    inl = O.with_one_row(first, cut.select("cut")).filter(F.col("res") <= F.col("cut")).drop("cut", "res")
    model = fit(inl)
    again = residual(inl, model)
    rms = lambda d, n: d.agg(F.sqrt(F.avg(F.col("res") * F.col("res"))).alias(n), F.count(F.lit(1)).alias("n_" + n))
    return O.with_one_row(O.with_one_row(model, rms(first, "rms_raw")), rms(again, "rms_inlier")).withColumn("yaw_deg", F.degrees("yaw")).drop("yaw")


def fit_plane(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Least-squares z = a x + b y + c per key from centred covariances (NULL when degenerate)."""
    s = df.groupBy(*by).agg(F.avg("x").alias("mx"), F.avg("y").alias("my"), F.avg("z").alias("mz"), F.var_pop("x").alias("xx"), F.var_pop("y").alias("yy"),
                            F.covar_pop("x", "y").alias("xy"), F.covar_pop("x", "z").alias("xz"), F.covar_pop("y", "z").alias("yz"))
    det = F.col("xx") * F.col("yy") - F.col("xy") * F.col("xy")
    s = s.withColumn("_d", F.when(F.abs(det) > 1e-9, det))
    a = (F.col("xz") * F.col("yy") - F.col("yz") * F.col("xy")) / F.col("_d")
    b = (F.col("yz") * F.col("xx") - F.col("xz") * F.col("xy")) / F.col("_d")
    return s.select(*by, a.alias("a"), b.alias("b"), (F.col("mz") - a * F.col("mx") - b * F.col("my")).alias("c"))


def plane_distance() -> Column:
    a, b = F.col("a"), F.col("b")
    return F.abs(a * F.col("x") + b * F.col("y") + F.col("c") - F.col("z")) / F.sqrt(a * a + b * b + 1)


#: Points that one row of draws is made from.
DRAWN = 65_536


def ransac_plane(points: DataFrame, by: Sequence[str], iters: int, tol: float, min_nz: float) -> DataFrame:
    """Best of ``iters`` planes through three random points per key, re-fitted on its inliers.

    Each draw is the point of the key with the least hash for that trial, a partial aggregate over all
    points; every hypothesis is then scored on all points with one join and a partial aggregate, so a
    huge key is drawn from and counted by many tasks.
    """
    by = list(by)
    drawn = lambda t, k: F.min(F.struct(F.xxhash64(F.lit(t), F.lit(k), "x", "y", "z").alias("h"), "x", "y", "z")).alias(f"_{t}_{k}")
    draws = [drawn(t, k) for t in range(iters) for k in range(3)]
    # a row of draws is far wider than a point: points are brought together first, a huge key in parts, so that it is shuffled once a part
    n = points.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    part = F.pmod(F.xxhash64("x", "y", "z"), F.ceil(F.col("_n") / F.lit(DRAWN))).alias("_part")
    parts = points.select(*by, "x", "y", "z").join(n, by).select(*by, "x", "y", "z", part).repartition(*by, "_part")
    picks = parts.groupBy(*by, "_part").agg(*draws).groupBy(*by).agg(*[F.min(f"_{t}_{k}").alias(f"_{t}_{k}") for t in range(iters) for k in range(3)])
    trial = F.array(*[F.struct(F.lit(t).alias("trial"), *[F.col(f"_{t}_{k}").alias(n) for k, n in enumerate("ABD")]) for t in range(iters)])
    t = picks.select(*by, F.explode(trial).alias("_t")).select(*by, "_t.*")
    v = lambda q, c: F.col(f"{q}.{c}") - F.col(f"A.{c}")
    nx = v("B", "y") * v("D", "z") - v("B", "z") * v("D", "y")
    ny = v("B", "z") * v("D", "x") - v("B", "x") * v("D", "z")
    nz = v("B", "x") * v("D", "y") - v("B", "y") * v("D", "x")
    t = t.withColumn("nx", nx).withColumn("ny", ny).withColumn("nz", nz)
    t = t.withColumn("len", F.sqrt(F.col("nx") ** 2 + F.col("ny") ** 2 + F.col("nz") ** 2)).filter("len >= 1e-6")
    t = t.select(*by, "trial", *[(F.col(c) / F.col("len")).alias(c) for c in ("nx", "ny", "nz")], F.col("A"))
    t = t.filter(F.abs("nz") >= min_nz).withColumn("d", -(F.col("nx") * F.col("A.x") + F.col("ny") * F.col("A.y") + F.col("nz") * F.col("A.z"))).drop("A")
    hyp = t.groupBy(*by).agg(F.collect_list(F.struct("trial", "nx", "ny", "nz", "d")).alias("h"))
    dist = lambda h: F.abs(h["nx"] * F.col("x") + h["ny"] * F.col("y") + h["nz"] * F.col("z") + h["d"])
    votes = points.join(hyp, by).select(*by, F.explode(F.filter("h", lambda h: dist(h) < tol)).alias("h"))
    score = votes.groupBy(*by, "h").agg(F.count(F.lit(1)).alias("_k"))
    best = score.groupBy(*by).agg(F.max(F.struct("_k", (-F.col("h.trial")).alias("o"), "h")).alias("m")).select(*by, F.col("m.h").alias("h"))
    inl = points.join(best, by).filter(dist(F.col("h")) < tol)
    plane = fit_plane(inl, by).filter("a is not null")
    good = points.join(plane, by).withColumn("_d", plane_distance())
    return good.groupBy(*by).agg(F.max("a").alias("a"), F.max("b").alias("b"), F.max("c").alias("c"), F.count_if(F.col("_d") < tol).alias("inliers"), F.count(F.lit(1)).alias("n"))


def dominant_mode(df: DataFrame, by: Sequence[str], value: str, bin_m: float, min_share: float, flat_pctl: float, spread_pctl: float) -> DataFrame:
    """Centre of the fullest bin (bins start at the key's minimum) if its share is large enough, else a percentile:
    ``flat_pctl`` where all values fit in one bin, ``spread_pctl`` elsewhere. Both hold for keys of any size."""
    by = list(by)
    lim = df.groupBy(*by).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.count(F.lit(1)).alias("n"))
    b = df.join(lim, by).groupBy(*by, F.floor((F.col(value) - F.col("_lo")) / bin_m).alias("_b")).agg(F.count(F.lit(1)).alias("_k"))
    top = b.groupBy(*by).agg(F.max(F.struct("_k", (-F.col("_b")).alias("o"))).alias("m"))
    v = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_c"))
    pct = lambda q: F.percentile(value, F.lit(q / 100), F.col("_c"))
    p = v.groupBy(*by).agg(pct(flat_pctl).alias("_flat"), pct(spread_pctl).alias("_spread"))
    j = lim.join(top, by).join(p, by)
    flat = F.col("_hi") - F.col("_lo") < bin_m
    share = F.when(flat, 0.0).otherwise(F.col("m._k") / F.col("n"))
    is_mode = ~flat & (share >= min_share)
    mid = F.col("_lo") + (-F.col("m.o") + 0.5) * bin_m
    return j.select(*by, F.when(is_mode, mid).when(flat, F.col("_flat")).otherwise(F.col("_spread")).alias("ground_z"),
                    F.when(is_mode, "mode").otherwise("pctl").alias("source"), share.alias("share"))


def profile(cells: DataFrame, by: Sequence[str], value: str, bins: int) -> DataFrame:
    """Mean value along the normal of each key's principal direction: (by, bin, mean, n)."""
    by = list(by)
    s = cells.groupBy(*by).agg(F.avg("x").alias("mx"), F.avg("y").alias("my"), (0.5 * F.atan2(2 * F.covar_samp("x", "y"), F.var_samp("x") - F.var_samp("y"))).alias("_a"))
    p = cells.join(s, by).withColumn("_u", (F.col("y") - F.col("my")) * F.cos("_a") - (F.col("x") - F.col("mx")) * F.sin("_a"))
    lim = p.groupBy(*by).agg(F.min("_u").alias("_lo"), F.max("_u").alias("_hi"))
    j = p.join(lim, by)
    step = (F.col("_hi") - F.col("_lo")) / (bins - 1)
    return j.groupBy(*by, F.when(step > 0, F.floor((F.col("_u") - F.col("_lo")) / step + 1e-9)).otherwise(0).cast("long").alias("bin")).agg(
        F.avg(value).alias("mean"), F.count(F.lit(1)).alias("n"))


def stripe_peaks(prof: DataFrame, by: Sequence[str], bins: int) -> DataFrame:
    """Local maxima over half of the top value (empty bins read 0), and the variation of their spacing."""
    by = list(by)
    spine = prof.select(*by).distinct().withColumn("bin", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))))
    d = spine.join(prof, [*by, "bin"], "left").select(*by, "bin", F.coalesce("mean", F.lit(0.0)).alias("v"))
    w = W.partitionBy(*by).orderBy("bin")  # at most ``bins`` rows per key
    top = F.max("v").over(W.partitionBy(*by))
    d = d.withColumn("_p", (F.col("v") > F.lag("v").over(w)) & (F.col("v") > F.lead("v").over(w)) & (F.col("v") > 0.5 * top))
    pk = d.filter("_p").withColumn("gap", F.col("bin") - F.lag("bin").over(w))
    s = pk.groupBy(*by).agg(F.count(F.lit(1)).alias("peaks"), (F.stddev_pop("gap") / F.greatest(F.avg("gap"), F.lit(1e-6))).alias("cv"))
    return spine.select(*by).distinct().join(s, by, "left").select(*by, F.coalesce("peaks", F.lit(0)).alias("peaks"), F.when(F.coalesce("peaks", F.lit(0)) < 2, 1.0).otherwise(F.col("cv")).alias("spacing_cv"))


def band_energy(prof: DataFrame, by: Sequence[str], bin_m: float, bins: int, lo: float, hi: float) -> DataFrame:
    """Share of spectral energy of the centred profile inside [lo, hi] cycles per metre.

    The DFT is a sum of v cos and v sin over a table of at most ``bins`` frequencies per key.
    """
    by = list(by)
    spine = prof.select(*by).distinct().withColumn("bin", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))))
    d = spine.join(prof, [*by, "bin"], "left").select(*by, "bin", F.coalesce("mean", F.lit(0.0)).alias("v"))
    d = d.join(d.groupBy(*by).agg(F.avg("v").alias("m")), by).withColumn("v", F.col("v") - F.col("m"))
    f = d.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(bins // 2))))
    ang = F.lit(2 * np.pi / bins) * F.col("k") * F.col("bin")
    s = f.groupBy(*by, "k").agg(F.sum(F.col("v") * F.cos(ang)).alias("re"), F.sum(F.col("v") * F.sin(ang)).alias("im"))
    e = F.col("re") ** 2 + F.col("im") ** 2
    freq = F.col("k") / F.lit(bins * bin_m)
    return s.groupBy(*by).agg(F.sum(F.when(freq.between(lo, hi), e).otherwise(0.0)).alias("band"), F.sum(e).alias("all")).select(
        *by, F.when(F.col("all") > 0, F.col("band") / F.col("all")).otherwise(0.0).alias("band_ratio"))


def patch_snr(cells: DataFrame, by: Sequence[str], value: str, side: int) -> DataFrame:
    """Periodic signal to noise of one bounded patch per key by a 2-D FFT (centre block removed).

    ``col`` and ``row`` must lie in [0, side): a patch has at most side x side cells.
    """
    by = list(by)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        a = np.zeros((side, side))
        a[pdf["row"].to_numpy(), pdf["col"].to_numpy()] = pdf[value].to_numpy()
        p = np.abs(np.fft.fftshift(np.fft.fft2(a))) ** 2
        m = side // 2
        p[m - 1:m + 2, m - 1:m + 2] = 0.0
        pos = p[p > 0]
        out = {k: [pdf[k].iloc[0]] for k in by}
        out["snr"] = [float(p.max() / max(np.median(pos), 1e-6)) if pos.size else 0.0]
        return pd.DataFrame(out)

    src = cells.select(*by, "row", "col", value)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.select(*by).schema.fields] + ["snr double"])
    return src.groupBy(*by).applyInPandas(one, schema)


def subset_stats(df: DataFrame, subsets: Mapping[str, Column], metrics: Mapping[str, tuple[Sequence[float], float]]) -> DataFrame:
    """One row per named subset with count, ratio, metric percentiles and means; a row may be in many subsets.

    ``metrics`` maps a column to (percentiles, value step for the running count); subsets are large,
    so percentiles come from value counts instead of per-group buffers.
    """
    from wayfold.functions.stats import exact_percentiles

    names = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in subsets.items()]))
    d = df.withColumn("subset", F.explode(names))
    total = df.agg(F.count(F.lit(1)).alias("total"))  # one row
    out = O.with_one_row(d.groupBy("subset").agg(F.count(F.lit(1)).alias("n"), *[F.avg(m).alias(m + "_mean") for m in metrics]), total)
    out = out.withColumn("ratio", F.col("n") / F.col("total"))
    for m, (ps, width) in metrics.items():
        q = exact_percentiles(d, ["subset"], m, {f"{m}_p{int(round(p * 100))}": p for p in ps}, width).drop("n")
        out = out.join(q, "subset", "left")
    return out


def effect_sizes(df: DataFrame, by: Sequence[str], value: str, flag: Column) -> DataFrame:
    """Effect size per key between flag and not-flag rows by pooled population variance: (by, n_in, n_bg, d); no spread: 0."""
    a, b = F.when(flag, F.col(value)), F.when(~flag, F.col(value))
    g = df.groupBy(*by).agg(F.count(a).alias("n_in"), F.count(b).alias("n_bg"), F.avg(a).alias("_ma"), F.avg(b).alias("_mb"), F.var_pop(a).alias("_va"), F.var_pop(b).alias("_vb"))
    pooled = ((F.col("n_in") - 1) * F.col("_va") + (F.col("n_bg") - 1) * F.col("_vb"))
    free = F.col("n_in") + F.col("n_bg") - 2
    d = F.when((free > 0) & (pooled > 0), (F.col("_ma") - F.col("_mb")) / F.sqrt(pooled / free)).otherwise(0.0)
    return g.select(*by, "n_in", "n_bg", d.alias("d"))


def objective(auc: Column, d: Column, band_ratio: Column) -> Column:
    """Combined objective of an alignment: 2 for the ranking, up to 1.5 for the effect size, up to 1 for energy in the stripe band."""
    unit = lambda v: F.greatest(F.lit(0.0), F.least(v, F.lit(1.0)))
    return 2 * auc + 1.5 * unit(d / 2) + unit(F.log(F.greatest(band_ratio, F.lit(1e-6))) / F.log(F.lit(5.0)))
