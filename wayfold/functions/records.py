"""Record-level expressions: ids, reasons, aliases, signatures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

DRIVE_RE = r"(\d{4}_\d{2}_\d{2}_drive_\d{4}_sync)"
FRAME_RE = r"(\d{10})"


def frame_number(text: Column) -> Column:
    """Digits of the text as a number, NULL without digits."""
    d = F.regexp_replace(text, "[^0-9]", "")
    return F.when(d != "", d.try_cast("long"))


def frame_label(text: Column) -> Column:
    """Digits zero-padded to ten; text without digits is kept."""
    d = F.regexp_replace(text, "[^0-9]", "")
    return F.when(d == "", text).when(F.length(d) >= 10, d).otherwise(F.lpad(d, 10, "0"))


def drive_of(*texts: Column) -> Column:
    hit = [F.nullif(F.regexp_extract(t, DRIVE_RE, 1), F.lit("")) for t in texts]
    return F.coalesce(*hit, F.lit(""))


def frame_of(*texts: Column) -> Column:
    hit = [F.nullif(F.regexp_extract(t, FRAME_RE, 1), F.lit("")) for t in texts]
    return F.coalesce(*hit, F.lit(""))


def confidence(*aliases: Column) -> Column:
    """First alias that reads as a number, else 0."""
    return F.coalesce(*[a.try_cast("double") for a in aliases], F.lit(0.0))


def missing_fields(fields: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(c.isNull() | (c.cast("string") == ""), F.lit(n)) for n, c in fields.items()]))


def reasons(rules: dict[str, Column]) -> Column:
    """Names of all rules that hold, in the given order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))


def first_reason(rules: Sequence[tuple[str, Column]], otherwise: str | None) -> Column:
    """Name of the first rule that holds."""
    out = F.when(rules[0][1], F.lit(rules[0][0]))
    for n, c in rules[1:]:
        out = out.when(c, F.lit(n))
    return out.otherwise(F.lit(otherwise))


def tokens(text: Column) -> Column:
    """Comma- or bar-separated reasons as a clean array."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"[,|]"), lambda t: F.trim(t)), lambda t: t != "")


def append_reason(text: Column, reason: str) -> Column:
    t = tokens(text)
    return F.array_join(F.when(F.array_contains(t, reason), t).otherwise(F.concat(t, F.array(F.lit(reason)))), ",")


def gore_like(w: Column, length: Column, rectangularity: Column, strict: bool = False) -> Column:
    """Long thin or badly filled rectangles; ``strict`` adds the third rule."""
    r = (length > 10) & (w > 0) & (w < 2)
    r = r | ((rectangularity > 0) & (rectangularity < 0.2) & (length > w * 3))
    return r | ((rectangularity > 0) & (rectangularity < 0.7) & (length > w * 2)) if strict else r


def feature_id(cx: Column, cy: Column, angle: Column, area: Column, drive: Column) -> Column:
    key = F.format_string("%.2f|%.2f|%.1f|%.1f|%s", cx, cy, angle, area, drive.cast("string"))
    return F.substring(F.sha1(key), 1, 12)


def signature(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256)


def signature_bucket(sig: Column, n: int) -> Column:
    return F.conv(F.substring(sig, 1, 8), 16, 10).cast("long") % n
