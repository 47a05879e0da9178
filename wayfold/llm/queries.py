"""Registered queries of the operators over the driver tables, with DuckDB twins where SQL can tell."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = r"[^\x20\x09-\x0D]+"


# ---------------------------------------------------------------- 5

OP5_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce({_LOW.format('text')}, ''), '{_ALNUM}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(coalesce({_LOW.format('text')}, ''), '{_ALNUM}') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS l, array_to_string(w[i:i + 9], ' ') AS k
       FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, l, i, array_to_string(w[i:i + l - 1], ' ') AS k
       FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM d, (SELECT DISTINCT l FROM iw))),
m AS (SELECT doc_id, item_id, i, dw.l FROM dw JOIN iw ON dw.k = iw.k AND dw.l = iw.l),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM m) GROUP BY 1),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list_distinct(list(CAST(item_id AS VARCHAR)))), ',') AS s FROM m GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""


@query("op5_decontaminate", OP5_SQL)
def op5(spark, sf_dir):
    from wayfold.llm.decontaminate import contamination

    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


# ---------------------------------------------------------------- 6

OP6_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
x AS (SELECT doc_id, i, array_to_string(w[i:i + 4], chr(10)) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM x QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1) GROUP BY 1),
l AS (SELECT *, len(regexp_extract_all(s, '{_WORD}')) AS lw, row_number() OVER (PARTITION BY doc_id, s ORDER BY p) > 1 AS dup
      FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS s, generate_subscripts(string_split(t, chr(10)), 1) AS p FROM d)),
f AS (SELECT doc_id, count(*) FILTER (dup) AS n_dup, coalesce(sum(lw) FILTER (dup OR sym * 100 > 30 * lw OR bars >= 3 OR (letters >= 20 AND 100 * capitals > 50 * letters) OR NOT ended OR phrase), 0) AS lost
      FROM (SELECT *, len(regexp_extract_all(s, '[#*$%&|<>]')) AS sym, len(regexp_extract_all(s, '[|>]')) AS bars,
                   len(regexp_extract_all(s, '[A-Za-z]')) AS letters, len(regexp_extract_all(s, '[A-Z]')) AS capitals,
                   regexp_matches(s, '[.!?:;"''…”»。！？)][\x20\x09-\x0D]*$') AS ended,
                   regexp_matches({_LOW.format('s')}, 'all rights reserved|cookie policy|enable javascript|lorem ipsum|privacy policy|sign up for our newsletter|terms of use') AS phrase
            FROM l WHERE lw > 0) GROUP BY 1),
b AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             coalesce(n_dup, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, CAST(coalesce(lost, 0) AS BIGINT) AS n_lost_words
      FROM d LEFT JOIN r USING (doc_id) LEFT JOIN f USING (doc_id))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * n_lost_words <= 50 * n_words AS kept FROM b
"""


@query("op6_quality_rules", OP6_SQL)
def op6(spark, sf_dir):
    from wayfold.llm.quality import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"), with_text=False)


# ---------------------------------------------------------------- 10

OP10_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(coalesce({_LOW.format('text')}, ''), '{_WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 75 * (x.n + y.n - i)),
c AS (SELECT doc_id AS a, doc_id AS r FROM d UNION SELECT e.b, c.r FROM c JOIN e ON e.a = c.a),
g AS (SELECT a AS doc_id, min(r) AS component_id FROM c GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept FROM d LEFT JOIN n USING (doc_id) JOIN g USING (doc_id)
"""


@query("op10_minhash_near_dedup", OP10_SQL)
def op10(spark, sf_dir):
    from wayfold.llm.neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


# ---------------------------------------------------------------- 2

OP2_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^.!?\n]*[.!?\n]+|[^.!?\n]+$') AS s FROM documents),
s AS (SELECT *, sum(len(w)) OVER (PARTITION BY doc_id ORDER BY p) AS upto
      FROM (SELECT doc_id, p, x, regexp_extract_all(x, '{_WORD}') AS w FROM (SELECT doc_id, unnest(s) AS x, generate_subscripts(s, 1) AS p FROM d))),
f AS (SELECT doc_id, upto, min(p) AS p FROM s GROUP BY 1, 2),
a AS (SELECT s.doc_id, s.p, s.upto - len(s.w) AS before, greatest(f.p, s.p + 1) AS z FROM s ASOF JOIN f ON s.doc_id = f.doc_id AND s.upto - len(s.w) + 12 <= f.upto),
n AS (SELECT doc_id, flatten(list(w ORDER BY p)) AS w, max(p) AS n FROM s GROUP BY 1),
r AS (SELECT a.doc_id, a.p, z, array_to_string(n.w[before + 1:e.upto], ' ') AS k FROM a JOIN n USING (doc_id) JOIN s e ON e.doc_id = a.doc_id AND e.p = z WHERE z <= n.n),
g AS (SELECT DISTINCT doc_id, unnest(range(p, z + 1)) AS p FROM (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, p) > 1)),
o AS (SELECT s.doc_id, count(*) AS n_sentences, count(g.p) AS n_removed, string_agg(x, '' ORDER BY s.p) FILTER (g.p IS NULL) AS text FROM s LEFT JOIN g ON s.doc_id = g.doc_id AND s.p = g.p GROUP BY 1)
SELECT doc_id, coalesce(n_sentences, 0) AS n_sentences, coalesce(n_removed, 0) AS n_removed, coalesce(o.text, '') AS text FROM d LEFT JOIN o USING (doc_id)
"""


@query("op2_substring_dedup", OP2_SQL)
def op2(spark, sf_dir):
    from wayfold.llm.spans import substring_dedup

    out = substring_dedup(table(spark, sf_dir, "documents"), found="found")
    return out.select("doc_id", F.col("found.n_sentences").cast("long").alias("n_sentences"), F.size("found.removed").cast("long").alias("n_removed"), F.coalesce("text", F.lit("")).alias("text"))


OP2_PASSAGES_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}[\x20\x09-\x0D]*') AS x, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
r AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1)),
o AS (SELECT s.doc_id, count(g.p) AS n, string_agg(x, '' ORDER BY s.p) FILTER (g.p IS NULL) AS text
      FROM (SELECT doc_id, unnest(x) AS x, generate_subscripts(x, 1) AS p FROM d) s LEFT JOIN g ON s.doc_id = g.doc_id AND s.p = g.p GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, regexp_extract(t, '^[\x20\x09-\x0D]*') || coalesce(o.text, '') AS text FROM d LEFT JOIN o USING (doc_id)
"""


@query("op2_repeated_passages", OP2_PASSAGES_SQL)
def op2_passages(spark, sf_dir):
    from wayfold.llm.spans import passage_dedup

    out = passage_dedup(table(spark, sf_dir, "documents"), found="found")
    return out.select("doc_id", F.col("found.n_words").cast("long").alias("n_words"), F.col("found.n_removed").cast("long").alias("n_removed"), F.coalesce("text", F.lit("")).alias("text"))


# ---------------------------------------------------------------- 7


def toxicity_model(spark, sf_dir):
    """The model of op7 and of the pipeline, learnt without the held-out labels."""
    from wayfold.llm.toxicity import fit, held_out

    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id", 4, 2))
    return fit(table(spark, sf_dir, "documents"), labels, "toxic")


@query("op7_toxicity")
def op7(spark, sf_dir):
    from wayfold.llm.toxicity import held_out, toxicity_scores

    scores = toxicity_scores(table(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir))
    return scores.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


# ---------------------------------------------------------------- 9


@query("op9_quality_classifier")
def op9(spark, sf_dir):
    from wayfold.llm.pulearn import fit, quality_scores
    from wayfold.llm.toxicity import held_out

    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id", 3, 1))
    scores = quality_scores(docs, fit(docs, labels, "quality"))
    return scores.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


# ---------------------------------------------------------------- 3

_ESC = r"([<\[])(\\*)(s>|/s>|INST\]|/INST\]|\|im_start\|>|\|im_end\|>|\|endoftext\|>|\|system\|>|\|user\|>|\|assistant\|>)"
OP3_SQL = rf"""
WITH m AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, regexp_replace(text, '{_ESC}', '\1\\\2\3', 'g') AS et, regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '{_ESC}', '\1\\\2\3', 'g') AS er FROM m)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(12 + length(er) + 1 + length(et) + 11) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


def conversation_log(rows: DataFrame) -> DataFrame:
    """The turns as an event log: each starts empty and is streamed in two deltas; equal turns stay apart by a copy number."""
    from pyspark.sql import Window

    text = F.coalesce("text", F.lit(""))
    copy = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    half = F.expr("char_length(coalesce(text, '')) div 2")
    events = F.array(
        F.struct(F.lit(0).alias("seq"), F.lit("start").alias("kind"), F.lit("").alias("text")),
        F.struct(F.lit(1).alias("seq"), F.lit("delta").alias("kind"), F.substring(text, F.lit(1), half.cast("int")).alias("text")),
        F.struct(F.lit(2).alias("seq"), F.lit("delta").alias("kind"), F.substring(text, (half + 1).cast("int"), F.char_length(text)).alias("text")))
    return rows.withColumn("msg", F.struct("turn", copy.alias("copy"))).select("conv_id", "msg", "role", F.explode(events).alias("e")).select("conv_id", "msg", "e.seq", "e.kind", "role", "e.text")


@query("op3_chat_format", OP3_SQL)
def op3(spark, sf_dir):
    from wayfold.llm.chat import format_log, masked_texts, parse

    said = F.lit("</s>[INST] ok [/INST]")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    out = format_log(conversation_log(rows)).withColumn("turns", parse(F.col("formatted"))).withColumn("loss", masked_texts(F.col("formatted"), F.col("loss_spans")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss", "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.char_length(loss).cast("long").alias("loss_chars"),
                      F.sha2(loss, 256).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"))


# ---------------------------------------------------------------- 4

URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


@query("op4_url_filter")
def op4(spark, sf_dir):
    from wayfold.llm.urls import Rule, judge_urls

    return judge_urls(table(spark, sf_dir, "pages"), [Rule(*r) for r in URL_RULES]).select("page_id", "host", "path", "rule", "verdict", "template")


# ---------------------------------------------------------------- 1

OP1_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, source, lang, CASE WHEN regexp_matches(text, '[Ll]icen[cs]e|[Cc]opyright') THEN 'legal' WHEN regexp_matches(text, '[A-Za-z0-9]@[A-Za-z0-9]|https?://') THEN 'contact'
                             WHEN contains(text, ' | ') THEN 'table' WHEN contains(text, '!!') THEN 'emphatic' ELSE 'prose' END AS topic,
                      CAST(coalesce(len(regexp_extract_all(text, '{_WORD}')), 0) AS BIGINT) AS n_tokens FROM documents),
k AS (SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS tokens FROM d GROUP BY ALL),
t AS (SELECT sum(tokens) AS total FROM k),
s AS (SELECT source, pow(sum(tokens), 0.7) / sum(pow(sum(tokens), 0.7)) OVER () * (SELECT total FROM t) AS aim FROM k GROUP BY 1),
l AS (SELECT lang, pow(sum(tokens), 0.7) / sum(pow(sum(tokens), 0.7)) OVER () * (SELECT total FROM t) AS aim FROM k GROUP BY 1),
o AS (SELECT topic, pow(sum(tokens), 0.7) / sum(pow(sum(tokens), 0.7)) OVER () * (SELECT total FROM t) AS aim FROM k GROUP BY 1),
r AS (SELECT 0 AS it, source, lang, topic, tokens, tokens AS w FROM k
      UNION ALL SELECT it + 1, source, lang, topic, tokens, w * o.aim / sum(w) OVER (PARTITION BY topic)
      FROM (SELECT it, source, lang, topic, tokens, w * l.aim / sum(w) OVER (PARTITION BY lang) AS w
            FROM (SELECT it, source, lang, topic, tokens, w * s.aim / sum(w) OVER (PARTITION BY source) AS w FROM r JOIN s USING (source) WHERE it < 60) JOIN l USING (lang)) JOIN o USING (topic)),
q AS (SELECT source, lang, topic, tokens, CASE WHEN tokens > 0 THEN w / tokens ELSE 0 END AS rate FROM r WHERE it = 60),
c AS (SELECT 0 AS it, CAST(0.8 AS DOUBLE) AS c
      UNION ALL SELECT it + 1, greatest(c, (0.8 * (SELECT total FROM t) - coalesce(sum(tokens) FILTER (rate * c >= 1), 0)) / nullif(sum(tokens * rate) FILTER (rate * c < 1), 0))
      FROM c, q WHERE it < 20 GROUP BY it, c),
p AS (SELECT source, lang, topic, least(1.0, rate * (SELECT max(c) FROM c)) AS p FROM q)
SELECT doc_id, d.source, d.lang, d.topic, n_tokens, round(p, 6) AS probability,
       CAST(('0x' || substr(md5('mix:' || CAST(doc_id AS VARCHAR)), 1, 12)) AS BIGINT) / 281474976710656.0 < p AS sampled
FROM d JOIN p ON d.source = p.source AND d.lang = p.lang AND d.topic = p.topic
"""


@query("op1_source_mixing", OP1_SQL)
def op1(spark, sf_dir):
    from wayfold.llm.mixing import mixed

    out = mixed(table(spark, sf_dir, "documents"), found="mix")
    return out.select("doc_id", "source", "lang", "mix.topic", F.col("mix.tokens").alias("n_tokens"), F.round("mix.probability", 6).alias("probability"), "mix.sampled")


# ---------------------------------------------------------------- 8


@query("op8_token_counts")
def op8(spark, sf_dir):
    from wayfold.llm.tokens import counted

    rows = counted(table(spark, sf_dir, "documents"))
    return rows.select(F.regexp_extract("path", "[^/]*$", 0).alias("shard"), F.col("doc").cast("long").alias("doc_no"), F.col("start").alias("first_token"), F.col("tokens").alias("n_tokens"))


# ---------------------------------------------------------------- 11

OP11_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 10
"""


@query("op11_hard_negatives", OP11_SQL)
def op11(spark, sf_dir):
    from wayfold.llm.negatives import hard_negatives

    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 100 == 0)


# ---------------------------------------------------------------- 12

OP12_SQL = rf"""
WITH c AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
                  coalesce(xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda b: CAST(ascii(b) AS BIGINT))),
                                  lambda s, b: list_reduce(list_prepend(xor(s, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295), 1) AS h FROM documents),
d AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS planted, h // 10 % greatest(len(w), 1) AS a, 1 + (len(w) - h // 10 % greatest(len(w), 1)) // (3 + h // 10 % 8) AS p FROM c),
x AS (SELECT doc_id, n, i, w[1 + CASE WHEN planted AND i >= a THEN a + (i - a) % p ELSE i END] AS word FROM (SELECT *, unnest(range(n)) AS i FROM d)),
e AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM x JOIN x AS y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
s AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM e) GROUP BY doc_id, q, k HAVING count(*) + q >= greatest(6, 4 * q)),
r AS (SELECT doc_id, start, length, min(q) AS period FROM s GROUP BY ALL),
b AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) = 1),
l AS (SELECT doc_id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS t FROM r GROUP BY 1),
g AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
k AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.i) AS t FROM x LEFT JOIN g ON x.doc_id = g.doc_id AND x.i = g.i WHERE g.i IS NULL GROUP BY 1)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, CAST(1000 * length // period AS BIGINT) AS exponent_milli, sha256(coalesce(l.t, '')) AS runs_sha256, sha256(coalesce(k.t, '')) AS collapsed_sha256
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN k USING (doc_id)
"""


def repeated_tail(doc_id, words: list) -> list:
    """Every tenth document, by the crc32 of its id, repeats a stretch of its own words from some word on."""
    from zlib import crc32

    h = crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


@query("op12_periodic_runs", OP12_SQL)
def op12(spark, sf_dir):
    from wayfold.llm.periodic import periodic_runs

    out = periodic_runs(table(spark, sf_dir, "documents"), rewrite=repeated_tail)
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws("", F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    best = F.col("strongest")
    return out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
                      F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"))


# ---------------------------------------------------------------- 13


@query("op13_secret_scan")
def op13(spark, sf_dir):
    from wayfold.llm.secretscan import KINDS, fit, secret_spans

    docs = table(spark, sf_dir, "documents")
    spans = secret_spans(docs, fit(docs)).withColumn("base", F.filter("spans", lambda s: s["kind"] != KINDS[-1]))
    listed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return spans.select("doc_id", *[count(k) for k in KINDS[:-1]], F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))
