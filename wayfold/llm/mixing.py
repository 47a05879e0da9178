"""Mixing sources to target weights by raking, with DataFrame expressions only.

Documents are summed up to a table of cells, one per combination of the margins (source, language, topic). Iterative
proportional fitting scales the cells' token weights to the target share of every category of one margin after the
other until all factors are 1, or, where the targets contradict each other on the cells that exist, until a full round no
longer moves the weights; the error that remains is logged per margin. A document is then drawn with probability min(1, c * weight / tokens) of its cell, c
chosen so that the expected tokens are ``keep`` of all; the draw is a hash of its id, so it is the same on every run.

Shapes: the margins may have any number of categories; cells, totals and targets stay tables, documents are summed to
cells by partial aggregates, and a round of fitting is three windows over the cells. Only scalars (errors, c, one sum per
margin) reach the driver. Documents are read twice, for the cells and for the draw, and shuffled only if cells outgrow a broadcast.

Rows: null categories are categories of their own. Null or empty texts have no tokens; a cell without tokens is never
drawn. Rows that share an id share the draw. A category without a target gets weight 0; targets of absent categories
are spread over the present ones. An empty table gives an empty result.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wayfold.session import checkpoint, checkpoint_observed

MARGINS = ("source", "lang", "topic")
#: Share of all tokens to keep, and the exponent that evens out the categories' own shares.
KEEP, TEMPER = 0.8, 0.7
TOLERANCE, ROUNDS = 1e-10, 100
#: Rounds of raking that one job makes between two looks at the errors.
ROUNDS_PER_JOB = 4
#: Share of all tokens by which no cell moves in a round once the weights have settled.
SETTLED = 1e-12

log = logging.getLogger(__name__)

# marks by which a text's topic is told, first match wins
TOPIC_MARKS = (
    ("legal", r"[Ll]icen[cs]e|[Cc]opyright"),
    ("contact", r"[A-Za-z0-9]@[A-Za-z0-9]|https?://"),
    ("table", r" \| "),
    ("emphatic", r"!!"),
)


def topic_of(text: Column) -> Column:
    """Coarse topic from marks in the whole text; ``prose`` if there is none."""
    out = F.lit("prose")
    for name, pattern in reversed(TOPIC_MARKS):
        out = F.when(text.rlike(pattern), name).otherwise(out)
    return out


def word_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _key(c: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))


def tempered_targets(cells: DataFrame, margin: str, temper: float = TEMPER) -> DataFrame:
    """(category, share) proportional to tokens^temper."""
    sums = checkpoint(cells.groupBy(margin).agg(F.sum("tokens").alias("t")).select(F.col(margin).alias("category"), F.pow("t", F.lit(temper)).alias("s")))
    total = sums.agg(F.sum("s")).first()[0] or 1.0
    return sums.select("category", (F.col("s") / total).alias("share"))


def _categories(cells: DataFrame, targets: dict[str, DataFrame] | None, temper: float, total: float) -> DataFrame:
    """(margin, category, aim) of the categories that have tokens: their targets, scaled so that each margin adds up to ``total``."""
    own = F.explode(F.array(*[F.struct(F.lit(m).alias("margin"), F.col(m).alias("category")) for m in MARGINS])).alias("c")
    found = cells.select(own, "tokens").groupBy("c.margin", "c.category").agg(F.sum("tokens").alias("t")).where("t > 0")
    if targets is None:
        found = found.withColumn("share", F.pow("t", F.lit(temper)))
    else:
        wanted = None
        for m, t in targets.items():
            t = t.select(F.lit(m).alias("margin"), "category", "share")
            wanted = t if wanted is None else wanted.unionByName(t)
        found = found.join(wanted.hint("merge"), ["margin", "category"])
    found = checkpoint(found.select("margin", "category", "share"))
    whole = F.lit(1.0)
    for r in found.groupBy("margin").agg(F.sum("share").alias("s")).collect():  # one row per margin
        whole = F.when(F.col("margin") == r.margin, F.lit(float(r.s or 1.0))).otherwise(whole)
    return found.select("margin", "category", (F.col("share") / whole * F.lit(total)).alias("aim"))


def _aim_of(aims: DataFrame, margin: str, name: str) -> DataFrame:
    return aims.where(F.col("margin") == margin).select(F.col("category").alias(margin), F.col("aim").alias(name)).hint("merge")


def rake(cells: DataFrame, targets: dict[str, DataFrame] | None = None, tolerance: float = TOLERANCE, rounds: int = ROUNDS, temper: float = TEMPER) -> DataFrame:
    """``cells`` (margins, tokens) with ``weight``: token weights whose sums over each margin meet its targets.

    Stops when no factor differs from 1 by more than ``tolerance``. Contradictory targets (a source that is the only one in
    its language has two aims) have no such weights: then the rounds go on until they repeat, or for ``rounds``
    rounds; the last margin is met, and ``margin_errors`` tells how far the others are off. Without ``targets`` the
    categories' own shares are tempered. A round is three windows over the cells, so a plan of several rounds stays small; a
    task sums the cells of a category, never its documents.
    """
    total = cells.agg(F.sum("tokens")).first()[0]
    if not total:
        return checkpoint(cells.withColumn("weight", F.col("tokens").cast("double")))
    aims, now = _categories(cells, targets, temper, float(total)), cells.withColumn("weight", F.col("tokens").cast("double"))
    for m in MARGINS:
        now = now.join(_aim_of(aims, m, f"aim_{m}"), m, "left")
    now = checkpoint(now)
    done, settled = 0, False
    while done < rounds and not settled:
        step, per = now, min(ROUNDS_PER_JOB, rounds - done)
        for k in range(per):
            step = step.withColumn("off", F.lit(0.0)).withColumn("before", F.col("weight"))
            for m in MARGINS:
                own = F.sum("weight").over(Window.partitionBy(m))
                step = step.withColumn("f", F.when(own > 0, F.coalesce(f"aim_{m}", F.lit(0.0)) / own).otherwise(F.lit(1.0)))
                step = step.withColumn("off", F.greatest("off", F.abs(F.col("f") - 1))).withColumn("weight", F.col("weight") * F.col("f")).drop("f")
        now, seen = checkpoint_observed(step, off=F.max("off"), moved=F.max(F.abs(F.col("weight") - F.col("before"))))
        now, done = now.drop("off", "before"), done + per
        settled = (seen["off"] or 0.0) <= tolerance
        if (seen["moved"] or 0.0) <= SETTLED * total:
            break
    now = now.select(*cells.columns, "weight")
    if not settled:
        for r in margin_errors(now, targets, temper).groupBy("margin").agg((F.sum(F.abs(F.col("share") - F.col("target"))) / 2).alias("e")).collect():
            log.warning("targets contradict each other on the cells or settle slowly: %s misses its targets by %.3g of all tokens", r.margin, r.e)
    return now


def margin_errors(weighted: DataFrame, targets: dict[str, DataFrame] | None = None, temper: float = TEMPER) -> DataFrame:
    """(margin, category, share, target) of raked cells: the share that each category got and the one it should have."""
    total = float(weighted.agg(F.sum("tokens")).first()[0] or 0)
    own = F.explode(F.array(*[F.struct(F.lit(m).alias("margin"), F.col(m).alias("category")) for m in MARGINS])).alias("c")
    got = weighted.select(own, "weight").groupBy("c.margin", "c.category").agg((F.sum("weight") / F.lit(total or 1.0)).alias("share"))
    aims = _categories(weighted, targets, temper, 1.0)
    return got.join(aims.hint("merge"), ["margin", "category"], "left").select("margin", "category", "share", F.coalesce("aim", F.lit(0.0)).alias("target"))


def probabilities(weighted: DataFrame, keep: float = KEEP) -> DataFrame:
    """``weighted`` with ``probability`` = min(1, c * weight / tokens); the expected tokens are ``keep`` of all if weights allow."""
    rated = weighted.withColumn("rate", F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(F.lit(0.0)))
    total = rated.agg(F.sum("tokens")).first()[0] or 0
    c = keep
    while True:  # cells only ever join the full ones, so this ends
        full = F.col("rate") * c >= 1
        got = rated.agg(F.sum(F.when(full, F.col("tokens")).otherwise(F.lit(0))).alias("full"), F.sum(F.when(full, F.lit(0.0)).otherwise(F.col("tokens") * F.col("rate"))).alias("open")).first()
        if not got["open"]:
            break
        following = max(c, (keep * total - got["full"]) / got["open"])
        if following <= c * (1 + 1e-13):
            break
        c = following
    return rated.withColumn("probability", F.least(F.lit(1.0), F.col("rate") * c)).drop("rate")


def draw(doc_id: Column, seed: str = "mix") -> Column:
    """A number in [0, 1) from the id alone."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def mixed(docs: DataFrame, targets: dict[str, DataFrame] | None = None, doc_id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang",
          topic: Column | None = None, keep: float = KEEP, temper: float = TEMPER, found: str = "mix") -> DataFrame:
    """``docs`` with a struct column ``found``: topic, tokens, probability, sampled.

    ``targets``: margin name (of MARGINS) to (category, share), where a category is written "=value" or "null"; without it
    the categories' own shares, tempered.
    """
    if found in docs.columns:
        raise ValueError(f"column {found} exists; name another one in found=")
    told = topic_of(F.col(text)) if topic is None else topic
    keyed = docs.select(F.struct(_key(source).alias("source"), _key(lang).alias("lang"), F.coalesce(F.concat(F.lit("="), told), F.lit("null")).alias("topic"), word_tokens(F.col(text)).alias("tokens")).alias(found), *docs.columns)
    part = lambda c: F.col(f"{found}.{c}")
    cells = checkpoint(keyed.select(*[part(c).alias(c) for c in (*MARGINS, "tokens")]).groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")))
    odds = checkpoint(probabilities(rake(cells, targets, temper=temper), keep).select(*[F.col(m).alias(f"_mix_{m}") for m in MARGINS], F.col("probability").alias("_mix_p")))
    same: Sequence[Column] = [part(m) == F.col(f"_mix_{m}") for m in MARGINS]
    out = keyed.join(odds, list(same), "left")
    p = F.coalesce("_mix_p", F.lit(0.0))
    topic_name = F.when(part("topic") != "null", F.substring(part("topic"), 2, 1 << 30))
    return out.select(*docs.columns, F.struct(topic_name.alias("topic"), part("tokens").alias("tokens"), p.alias("probability"), (draw(F.col(doc_id)) < p).alias("sampled")).alias(found))


def sample(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are drawn, with all their columns."""
    return mixed(docs, found="_mix", **options).where("_mix.sampled").drop("_mix")
