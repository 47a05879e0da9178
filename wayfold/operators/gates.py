"""Gates, scores and penalty functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from wayfold.functions.records import first_reason, reasons

# acceptance limits of the C / B / A gate (fixed values)
C_MIN, B_MAX, A_MAX = 0.80, 0.40, 7.0


def cba_gate(c: Column, b: Column, a: Column, c_min: float = C_MIN, b_max: float = B_MAX, a_max: float = A_MAX) -> Column:
    return first_reason([("C_below", c < c_min), ("B_above", b > b_max), ("A_above", a > a_max)], "ok")


def clamp(v: Column, lo: float, hi: float) -> Column:
    return F.least(F.greatest(v, F.lit(float(lo))), F.lit(float(hi)))


def geometry_params(dummy_thr: Column, smooth_lambda: Column, max_shift: Column, split_eps: Column) -> dict[str, Column]:
    """Geometry settings derived from module parameters."""
    return {"density_thr": clamp(F.bround(2 + dummy_thr * 8, 0), 2, 10).cast("int"), "corridor_m": F.bround(clamp(12.0 + max_shift * 2.0, 15, 22), 3),
            "simplify_m": F.bround(clamp(2.0 - smooth_lambda * 0.8, 0.3, 2.0), 3), "centerline_offset_m": F.bround(clamp(split_eps / 3.0, 6, 20), 3),
            "width_peak_ratio": F.bround(clamp(1.6 - dummy_thr * 0.3, 1.4, 1.7), 3), "width_buffer_mult": F.bround(clamp(0.8 + (max_shift - 1.0) * 0.1, 0.6, 1.0), 3)}


def trial_score(c: Column, b: Column, a: Column, conflict: Column) -> Column:
    return c - 0.25 * b - 0.01 * a - 0.5 * conflict


def band_penalty(x: Column, low: tuple[float, float] | None = None, high: tuple[float, float] | None = None, steep: float = 10.0, jump: float = 100.0) -> Column:
    """Distance of ``x`` outside a band, in units of the way from a bound's target to its hard limit.

    ``low`` and ``high`` are (target, hard limit). From the hard limit on, ``jump`` plus ``steep`` per unit beyond it.
    """
    sides = [(F.lit(low[0]) - x, low[0] - low[1])] if low else []
    sides += [(x - high[0], high[1] - high[0])] if high else []
    cost = [F.when(gap <= 0, 0.0).when(gap < way, gap / way).otherwise(jump + steep * (gap - way)) for gap, way in sides]
    return F.greatest(*cost) if len(cost) > 1 else cost[0]


def delta_reasons(values: dict[str, tuple[Column, Column, float]]) -> Column:
    """Reasons where a value exceeds its baseline by more than its delta, or either is missing."""
    rules: dict[str, Column] = {}
    for n, (v, b, d) in values.items():
        rules[f"missing {n}"] = v.isNull() | b.isNull()
        rules[f"{n} over baseline"] = v > b + d
    return reasons(rules)


def final_fail_reason(hits: Column, bad: Column, w: Column, length: Column, rect: Column, heading: Column, jitter: Column, inside: Column) -> Column:
    size_ok = w.between(1.5, 8.0) & length.between(3.0, 25.0)
    return first_reason([("frames_hit_support", hits < 3), ("metric_bad", bad), ("size", ~size_ok), ("rectangularity", rect < 0.45), ("heading_diff", F.coalesce(heading, F.lit(0.0)) > 25.0),
                         ("jitter", jitter > 8.0), ("inside_ratio", F.coalesce(inside, F.lit(1.0)) < 0.5)], "pass")


def candidate_score(inside: Column, rect: Column, heading: Column) -> Column:
    h = F.when(heading.isNull(), 0.5).otherwise(F.greatest(F.lit(0.0), 1.0 - F.least(heading / 45.0, F.lit(1.0))))
    return 0.6 * inside + 0.25 * rect + 0.15 * h


def status(gates: list[Column], warn: Column | None = None) -> Column:
    ok = F.forall(F.array(*gates), lambda g: g)
    return F.when(~ok, "FAIL").when(warn if warn is not None else F.lit(False), "WARN").otherwise("PASS")
