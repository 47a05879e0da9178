"""URL filters: list rules first, then a path-template tree learnt per host.

Every path becomes a template. Segments that look like numbers, dates or ids turn into wildcards by their form; then,
level by level, the segments below one parent turn into a wildcard if they are many and each has few pages. Sibling
branches with the same templates below them are sorted by their share of bad labels and merged while the next one's
share does not differ (two-proportion test at ``Z``); branches without labels merge only with each other. A template is rejected if its smoothed share of bad labels reaches
``REJECT``, however few of its pages are labelled, since the prior outweighs few labels; a template nobody labelled says nothing about its pages.

Pages are summed up by (host, template) before anything else, so a host with a third of all pages is a few rows.
Verdicts come back through one join on a table that is unique by key, which adaptive execution can split.

Rows: each row is judged, repeated rows and ids included. A null url, or one without "://", has an empty host and path and
no rule; such pages share the root template of the empty host. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from wayfold.session import checkpoint

#: More children than this, with fewer pages each than FEW on average, are variable.
MANY, FEW = 16, 8
#: Levels of the tree; what lies deeper is one segment.
LEVELS = 8
Z = 2.58
#: Weight and value of the neutral prior of a template.
PRIOR_WEIGHT, PRIOR = 4.0, 0.5
REJECT = 0.8

# fixed values: forms of segments that vary from page to page, most special first
FORMS = (
    (r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$", "{uuid}"),
    (r"^(19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}$", "{date}"),
    (r"^[0-9]+$", "{num}"),
    (r"^[0-9]+\.[A-Za-z]{2,5}$", "{num}.*"),
    (r"^[0-9a-f]{12,}$", "{hex}"),
    (r"[0-9].*[0-9].*[0-9].*[0-9]", "{slug}"),
)


@dataclass(frozen=True)
class Rule:
    """Fits a host and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def _lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first "://" up to "/", "?", "#" or the end, ASCII lower case; path: from there to "?" or "#"."""
    rest = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda k: F.coalesce(F.regexp_extract(url, rest, k), F.lit(""))
    return _lower_ascii(part(1)), part(2)


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """struct<length, name, verdict> of the longest rule that fits, else null."""
    fits = [F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path), F.struct(F.lit(len(r.name)).alias("length"), F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))) for r in rules]
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<length:int,name:string,verdict:string>")


def _form(segment: Column) -> Column:
    out = segment
    for pattern, name in reversed(FORMS):
        out = F.when(segment.rlike(pattern), name).otherwise(out)
    return out


def lexical_template(path: Column) -> Column:
    """Segments of a path with variable forms replaced; at most LEVELS of them, the rest as one."""
    segments = F.transform(F.split(F.regexp_replace(path, "^/", ""), "/"), _form)
    return F.when(F.size(segments) > LEVELS, F.concat(F.slice(segments, 1, LEVELS), F.array(F.lit("**")))).otherwise(segments)


_SUMS = ("pages", "labelled", "bad")
_sums = [F.sum(c).alias(c) for c in _SUMS]


def template_tree(pages: DataFrame) -> DataFrame:
    """From (host, segments, bad: 0, 1 or null) rows to one row per (host, segments): final template, counts, purity, reject."""
    leaves = checkpoint(pages.groupBy("host", "segments").agg(F.count(F.lit(1)).alias("pages"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")))
    depth = leaves.agg(F.max(F.size("segments"))).first()[0] or 0
    now = leaves.select("host", "segments", *_SUMS, F.lit("").alias("prefix"))
    for k in range(1, depth + 1):
        seg = F.try_element_at("segments", F.lit(k))
        now = checkpoint(_similar(checkpoint(_variable(now.withColumn("seg", seg))), k))
    final = now.groupBy("host", "prefix").agg(*_sums).withColumn("purity", (F.col("bad") + PRIOR_WEIGHT * PRIOR) / (F.col("labelled") + PRIOR_WEIGHT))
    final = final.withColumn("reject", F.col("purity") >= REJECT)
    return checkpoint(now.select("host", "segments", "prefix").join(checkpoint(final), ["host", "prefix"]).withColumnRenamed("prefix", "template"))


def _variable(rows: DataFrame) -> DataFrame:
    """Wildcards for the children of parents with many small ones."""
    children = rows.where("seg IS NOT NULL").groupBy("host", "prefix", "seg").agg(F.sum("pages").alias("pages"))
    parents = checkpoint(children.groupBy("host", "prefix").agg(F.count(F.lit(1)).alias("n"), F.sum("pages").alias("all")).where((F.col("n") > MANY) & (F.col("all") < FEW * F.col("n"))).select("host", "prefix", F.lit(True).alias("many")))
    return rows.join(parents, ["host", "prefix"], "left").withColumn("seg", F.when(F.col("seg").isNotNull() & F.coalesce("many", F.lit(False)), "*").otherwise(F.col("seg"))).drop("many")


def _similar(rows: DataFrame, level: int) -> DataFrame:
    """One branch, named after its first member, for siblings with equal templates below and like shares of bad labels; extends the prefix."""
    tail = F.xxhash64(F.slice("segments", level + 1, LEVELS + 1), F.size("segments"))
    # a merged branch may hold a tail several times
    branch = rows.where("seg IS NOT NULL").groupBy("host", "prefix", "seg", tail.alias("tail")).agg(*_sums)
    branch = branch.groupBy("host", "prefix", "seg").agg(F.bit_xor("tail").alias("shape"), *_sums)
    rate = F.col("bad") / F.greatest("labelled", F.lit(1))
    siblings = ["host", "prefix", "shape", (F.col("labelled") == 0)]
    by_rate = Window.partitionBy(*siblings).orderBy(rate, "seg")
    n, n0, bad0 = F.greatest("labelled", F.lit(1)), F.lag(F.greatest("labelled", F.lit(1))).over(by_rate), F.lag("bad").over(by_rate)
    pooled = (F.col("bad") + bad0) / (n + n0)
    apart = F.abs(rate - bad0 / n0) > Z * F.sqrt(pooled * (1 - pooled) * (1 / n + 1 / n0))
    cut = checkpoint(branch).withColumn("cut", F.coalesce(apart, F.lit(False)).cast("int"))
    group = Window.partitionBy(*siblings, "group")
    named = cut.withColumn("group", F.sum("cut").over(by_rate)).withColumn("members", F.count(F.lit(1)).over(group)).withColumn("first", F.min("seg").over(group)).where("members > 1")
    merged = checkpoint(named.select("host", "prefix", "seg", F.concat(F.lit("{"), "first", F.lit(",..}")).alias("merged")))
    out = rows.join(merged, ["host", "prefix", "seg"], "left")
    name = F.coalesce("merged", "seg")
    return out.withColumn("prefix", F.when(F.col("seg").isNull(), F.col("prefix")).otherwise(F.concat("prefix", F.lit("/"), name))).select("host", "segments", *_SUMS, "prefix")


def judge_urls(pages: DataFrame, rules: list[Rule], labels: DataFrame | None = None, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """Per row: page_id, host, path, rule (name or null), template, purity, verdict.

    ``labels`` (page_id, bad 0/1) teaches the tree; without it the pages that a rule decides do.
    """
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("segments", lexical_template(F.col("path"))).withColumn("hit", matching_rule(F.col("host"), F.col("path"), rules))
    if labels is None:
        seen = rows.withColumn("bad", (F.col("hit.verdict") == "block").cast("int"))
    else:
        known = labels.groupBy("page_id").agg(F.max("bad").cast("int").alias("bad"))
        seen = rows.join(known, "page_id", "left")
    tree = template_tree(seen.select("host", "segments", "bad"))
    out = rows.join(tree.select("host", "segments", "template", "purity", "reject"), ["host", "segments"], "left")
    method = F.when(F.col("reject"), "block").otherwise("allow")
    return out.select("page_id", "host", "path", F.col("hit.name").alias("rule"), "template", "purity", F.coalesce("hit.verdict", method).alias("verdict"))
