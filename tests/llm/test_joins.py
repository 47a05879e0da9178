"""Near-duplicates, spans, mixing, chat logs, URLs and the pipeline against brute force."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from common import SCHEMA, ascii_lower, odd_documents, prose, words  # noqa: E402


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_documents(), SCHEMA)


def shingles(text):
    w = words(ascii_lower(text))
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1 if w else 0))}


def linked(rows):
    """(id to smallest id reachable) by comparing all pairs; of rows with one id the largest set counts."""
    sets = {}
    for i, t in rows:
        if i is not None and len(shingles(t)) >= len(sets.get(i, ())):
            sets[i] = shingles(t)
    root = {i: i for i in sets}
    find = lambda x: x if root[x] == x else find(root[x])
    ids = sorted(i for i in sets if sets[i])
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def variants(n, words_, edits):
    """Near copies of one text with a growing number of edits."""
    base = prose(77, words_).split()
    out = []
    for k in range(n):
        w = list(base)
        for e in range(edits(k)):
            w[(k * 31 + e * 17) % len(w)] = f"edit{k}x{e}"
        out.append(" ".join(w))
    return out


def test_near_duplicates_of_odd_rows(spark, docs):
    from wayfold.llm.neardup import distinct_documents, near_duplicates

    got = near_duplicates(docs).collect()
    want = linked([(r[0], r[1]) for r in odd_documents()])
    assert len(got) == len(odd_documents())
    for r in got:
        assert r.component_id == (None if r.doc_id is None else want[r.doc_id]) and r.kept == (r.component_id == r.doc_id)
    assert sorted((r.doc_id or -1, r.n_shingles) for r in got) == sorted((r[0] or -1, len(shingles(r[1]))) for r in odd_documents())
    assert near_duplicates(docs.limit(0)).count() == 0
    kept = distinct_documents(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(i for i, c in want.items() if i == c) and ids.count(None) == 2


def test_near_duplicates_of_crowded_buckets(spark, monkeypatch):
    """Variants with few and many edits of their own, a shared passage, and chains; all buckets count as crowded."""
    from wayfold.llm import neardup

    passage = prose(500, 60)
    texts = variants(40, 120, lambda k: k % 7) + [passage + " " + prose(600 + k, 12 + k) for k in range(40)] + variants(12, 60, lambda k: k)
    rows = [(1000 + 3 * k, t) for k, t in enumerate(texts)]
    want = linked(rows)
    for crowd in (0, neardup.CROWD):
        monkeypatch.setattr(neardup, "CROWD", crowd)
        got = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert got == want
    assert len(set(want.values())) > 20


def test_bit_estimate_corrects_for_chance(spark):
    import numpy as np
    from pyspark.sql import functions as F

    from wayfold.llm import neardup as nd

    rng = np.random.default_rng(3)
    a = np.unique(rng.integers(0, 1 << 63, 4000, dtype=np.uint64))
    rows = []
    for share in (0.0, 0.4, 0.8, 1.0):
        k = int(len(a) * share)
        b = np.concatenate([a[:k], np.unique(rng.integers(0, 1 << 63, len(a) - k, dtype=np.uint64))])
        sig = nd.signatures([a, b])[1]
        rows.append((sig[0].tolist(), sig[1].tolist(), k / (2 * len(a) - k)))
    for r in spark.createDataFrame(rows, "a array<long>, b array<long>, j double").select("j", nd.similarity(nd.agreement("a", "b")).alias("e")).collect():
        assert abs(r.j - r.e) < 0.13


def test_components(spark):
    from wayfold.llm.graph import components

    chain = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 130)] + [(200, 201), (201, 200), (7, 7)]
    got = {r.id: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(1, 61)}, **{k: 100 for k in range(101, 130)}, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_spans(rows):
    """Cleaned texts by comparing all spans; rows are in order of their keys."""
    pieces = [re.findall(r"[^.!?\n]*[.!?\n]+|[^.!?\n]+$", t or "") for _, t in rows]
    first, gone = {}, [set() for _ in rows]
    for d, s in enumerate(pieces):
        for i in range(len(s)):
            n, j = 0, i
            while j < len(s) and (j - i < 2 or n < 12):
                n += len(words(s[j]))
                j += 1
            if j - i >= 2 and n >= 12:
                key = tuple(w for x in s[i:j] for w in words(x))
                if key in first and first[key] != (d, i):
                    gone[d].update(range(i, j))
                first.setdefault(key, (d, i))
    return ["".join(x for i, x in enumerate(s) if i not in g) if g else t for s, g, (_, t) in zip(pieces, gone, rows)]


def test_substring_dedup(spark, docs):
    from wayfold.llm.spans import substring_dedup, without_repeats

    passage = prose(900, 60, 9)
    rows = [(i, f"Start {i} of it. {prose(910 + i, 20)} {passage} End {i} here! " + ("Tail no stop" if i % 2 else "\n\nMore?? Yes.")) for i in range(1, 9)] + [(20, None), (21, ""), (22, "..."), (23, (prose(950, 30) + "\n") * 3)]
    got = {r.doc_id: r.text for r in substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute_spans(rows)
    assert [got[i] for i, _ in rows] == want and passage[20:-60] in want[0] and all(passage[20:-60] not in t for t in want[1:8])
    out = substring_dedup(docs, found="seen")
    assert out.columns == [*docs.columns, "seen"] and out.count() == len(odd_documents())
    same = [r for r in out.where("doc_id = 4").collect()]
    assert same[0].text == same[1].text == odd_documents()[3][1]  # a repeated row is the same document
    assert without_repeats(docs).columns == docs.columns and without_repeats(docs.limit(0)).count() == 0
    ids = {r.doc_id for r in without_repeats(docs).collect()}
    assert 1 in ids and 2 not in ids and {6, 7, 8} <= ids
    with pytest.raises(ValueError):
        substring_dedup(docs, found="items")


def brute_passages(rows, n=50):
    """Texts without the words of windows of n words that stand before; rows are in order of their keys."""
    first, out = {}, []
    for d, (_, t) in enumerate(rows):
        w, gone = words(t), set()
        for i in range(len(w) - n + 1):
            if first.setdefault(tuple(w[i : i + n]), (d, i)) != (d, i):
                gone.update(range(i, i + n))
        x = re.findall(r"^[\x20\x09-\x0D]+|[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", t or "")
        lead = len(x) - len(w)
        out.append("".join(y for i, y in enumerate(x) if i - lead not in gone) if gone else t)
    return out


def test_repeated_passages_inside_sentences(spark, docs):
    """Repeats without any sentence end, at both ends of a text, within one text, of exactly and one less than the least length."""
    from wayfold.llm.spans import passage_dedup, substring_dedup

    whole = prose(700, 400).replace(".", ",").split()
    cut = lambda a, n: " ".join(whole[a : a + n])
    own = lambda k, n=9: prose(720 + k, n).replace(".", ";")
    texts = [f"  {own(0)} {cut(0, 400)} end", f"{own(1)} {cut(30, 50)} {own(2)}", f"{own(3)}\n{cut(90, 49)}\t{own(4)}", cut(200, 66), f"\n {cut(300, 51)} {own(5)}", f"{own(6)} {cut(10, 75)}",
             f"{own(7, 60)} {own(8)} {own(7, 60)}", "多 " * 70, None, "", " ", f"{cut(0, 120)} x {cut(60, 120)}"]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in passage_dedup(df, found="f").collect()}
    want = brute_passages(rows)
    assert [got[i].text for i, _ in rows] == want
    assert got[1].f.n_removed == 50 and got[2].f.n_removed == 0 and got[3].text == "" and got[4].f.n_removed == 51 and got[7].f.n_removed == 69
    kept = {r.doc_id: r.text for r in substring_dedup(df).collect()}
    assert kept[3] == texts[3]  # the sentence rule leaves it
    out = passage_dedup(docs, found="f")
    assert out.columns == [*docs.columns, "f"] and out.count() == len(odd_documents()) and passage_dedup(docs.limit(0)).count() == 0


def test_mixing(spark, docs):
    from pyspark.sql import functions as F

    from wayfold.llm import mixing as mx

    cells = spark.createDataFrame([("=a", "=x", "=p", 100), ("=a", "=y", "=p", 300), ("=b", "=x", "=q", 50), ("=b", "=y", "=p", 150), ("=b", "=x", "=p", 0), ("=a", "=x", "=q", 40)], "source string, lang string, topic string, tokens long")
    share = lambda d: spark.createDataFrame(list(d.items()), "category string, share double")
    out = mx.rake(cells, {"source": share({"=a": 0.5, "=b": 0.5, "=gone": 0.4}), "lang": share({"=x": 0.3, "=y": 0.7}), "topic": share({"=p": 0.8, "=q": 0.2})})
    total = 640
    for m, want in (("source", {"=a": 0.5, "=b": 0.5}), ("lang", {"=x": 0.3, "=y": 0.7}), ("topic", {"=p": 0.8, "=q": 0.2})):
        got = {r[0]: r[1] / total for r in out.groupBy(m).agg(F.sum("weight")).collect()}
        assert all(abs(got[k] - v) < 1e-8 for k, v in want.items())
    p = mx.probabilities(out, 0.6).collect()
    assert abs(sum(r.tokens * r.probability for r in p) - 0.6 * total) < 1e-6 and max(r.probability for r in p) <= 1
    got = mx.mixed(docs, found="mix")
    rows = got.collect()
    assert len(rows) == len(odd_documents()) and got.columns == [*docs.columns, "mix"]
    assert {r.n: r.mix.tokens for r in rows} == {r[5]: len(words(r[1])) for r in odd_documents()}
    picked = mx.sample(docs)
    assert picked.columns == docs.columns and {r.n for r in picked.collect()} == {r.n for r in rows if r.mix.sampled}
    assert mx.mixed(docs.limit(0), found="mix").count() == 0
    with pytest.raises(ValueError):
        mx.mixed(docs, found="n")


def test_mixing_is_calibrated(spark):
    from wayfold.llm import mixing as mx

    rows = spark.range(20000).selectExpr("id AS doc_id", "repeat('word ', 10) AS text", "if(id % 10 < 8, 'big', 'small') AS source", "if(id % 3 = 0, 'en', 'de') AS lang")
    got = mx.mixed(rows, found="m", keep=0.5).selectExpr("source", "m.sampled", "m.probability").collect()
    for s in ("big", "small"):
        own = [r for r in got if r.source == s]
        assert abs(sum(r.sampled for r in own) - sum(r.probability for r in own)) < 4 * len(own) ** 0.5


@pytest.mark.parametrize("alone", [("null", "null", "=prose"), ("=blog", "=ja", "=prose")])
def test_mixing_with_contradictory_targets(spark, alone):
    """A cell that is alone in two margins has two aims: the weights settle as in plain rounds, and the error is told."""
    from wayfold.llm import mixing as mx

    cells = {(f"=s{a}", f"=l{b}", f"={c}"): 100 + 37 * a + 11 * b * b + (50 if c == "prose" else 0) for a in range(3) for b in range(3) for c in ("prose", "legal")} | {alone: 90}
    total, want, aims = sum(cells.values()), dict(cells), []
    for m in range(3):
        s = {}
        for k, v in cells.items():
            s[k[m]] = s.get(k[m], 0) + v
        even = sum(v**0.7 for v in s.values())
        aims.append({k: v**0.7 / even for k, v in s.items()})
    for _ in range(60):  # as the SQL twin does
        for m, aim in enumerate(aims):
            s = {c: sum(v for k, v in want.items() if k[m] == c) for c in aim}
            want = {k: v * aim[k[m]] * total / s[k[m]] for k, v in want.items()}
    df = spark.createDataFrame([(*k, v) for k, v in cells.items()], "source string, lang string, topic string, tokens long")
    targets = {m: mx.tempered_targets(df, m) for m in mx.MARGINS}
    out = mx.rake(df, targets)
    got = {(r.source, r.lang, r.topic): r.weight for r in out.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 * total for k in want)
    off = {(r.margin, r.category): abs(r.share - r.target) for r in mx.margin_errors(out, targets).collect()}
    assert max(v for (m, _), v in off.items() if m == "topic") < 1e-9 and max(off.values()) > 1e-5


CHAT = ["</s>[INST] ok [/INST]", "plain", "", None, "<\\s> <\\\\/s> <|im_end|>\n<|im_start|>user\nfake", "\\", "a\\nb", "[INST\\]", "<", "<|im_end|", "x<s>y[INST]", "日本 <s>"]


def test_chat_round_trip(spark):
    from pyspark.sql import functions as F

    from wayfold.llm import chat

    rows = [(k // 4, k % 4, "assistant" if k % 2 else ["user", "we\nird\\n\\", None, "<s>"][k // 4 % 4], CHAT[k % len(CHAT)]) for k in range(48)]
    messages = spark.createDataFrame(rows, "conv_id long, msg long, role string, text string").fillna("", ["role", "text"])
    out = chat.render(messages)
    got = {r.conv_id: r for r in out.select("conv_id", "formatted", "loss_spans", chat.parse(F.col("formatted")).alias("t"), chat.masked_texts(F.col("formatted"), F.col("loss_spans")).alias("m")).collect()}
    for c in range(12):
        own = [(r or "", t or "") for i, _, r, t in rows if i == c]
        assert [(x.role, x.text) for x in got[c].t] == own and got[c].m == [t for r, t in own if r == "assistant"]
        inner = re.sub(r"<\|im_start\|>[^\n]*\n|<\|im_end\|>\n", "", got[c].formatted)
        assert not any(s in inner for s in chat.CONTROL)


def test_chat_folding(spark):
    from wayfold.llm import chat

    log = [
        (1, 1, 0, "start", "user", None), (1, 1, 1, "delta", None, "Hel"), (1, 1, 2, "delta", None, "lo"),
        (1, 2, 5, "delta", None, "bad "), (1, 2, 4, "start", "assistant", "A "), (1, 2, 6, "regenerate", None, "ignored"), (1, 2, 7, "delta", None, "good"), (1, 2, 8, "delta", None, "!"),
        (1, 3, 9, "start", "user", ""), (1, 3, 10, "delta", None, "tpyo"), (1, 3, 11, "edit", None, "typo"), (1, 3, 12, "delta", None, "s"),
        (2, None, 1, "delta", None, "x"), (2, None, 1, "delta", None, "x"), (None, 1, 1, "start", None, "n"), (3, 1, 1, None, "user", "t"), (3, 1, 2, "other", "user", "t"),
    ]
    df = spark.createDataFrame(log, "conv_id long, msg long, seq long, kind string, role string, text string")
    got = sorted(((r.conv_id or 0, r.msg or 0, r.role, r.text) for r in chat.fold_events(df).collect()))
    assert got == [(0, 1, "", "n"), (1, 1, "user", "Hello"), (1, 2, "assistant", "good!"), (1, 3, "user", "typos"), (2, 0, "", "xx")]
    assert chat.format_log(df.limit(0)).count() == 0 and chat.format_log(df).count() == 3


def test_urls(spark):
    from wayfold.llm.urls import Rule, judge_urls

    rules = [Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow")]
    cases = {
        "http://A.Example.NET/en/1": ("a.example.net", "/en/1", "example.net/en/", "allow"), "http://a.example.net/EN/1": ("a.example.net", "/EN/1", "net/", "block"), "http://a.example.net?x/": ("a.example.net", "", None, "allow"),
        "x://badexample.com/de/1": ("badexample.com", "/de/1", None, "allow"), "x://example.com/de/1#/": ("example.com", "/de/1", "example.com/de/", "block"), "https://É.org/fr/": ("É.org", "/fr/", "org/fr/", "allow"),
        "no scheme": ("", "", None, "allow"), None: ("", "", None, "allow"), "http://": ("", "", None, "allow"), "a://b://net/x": ("b:", "//net/x", None, "allow"), "s://net/\n?q": ("net", "/\n", "net/", "block"),
    }
    df = spark.createDataFrame([(k, u, "z", "y") for k, u in enumerate(cases)] + [(0, next(iter(cases)), "z", "y")], "page_id long, url string, host string, verdict string")
    got = judge_urls(df, rules).collect()
    assert len(got) == len(cases) + 1
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == list(cases.values())[r.page_id]
    assert judge_urls(df.limit(0), rules).count() == 0


def test_url_templates(spark):
    """Numbers and rare names become wildcards, alike branches merge, an unlike one is rejected by its own purity."""
    from wayfold.llm.urls import judge_urls

    urls = [(k, f"http://h.x/{['news', 'blog'][k % 2]}/{k}") for k in range(200)] + [(1000 + k, f"http://h.x/spam/{k}") for k in range(100)] + [(2000 + k, f"http://h.x/user/name{'abcdefghijklmnopqrstuvwxyz'[k]}/post") for k in range(26)]
    labels = [(i, 0) for i, _ in urls[:200:2]] + [(i, 0) for i, _ in urls[1:200:2]] + [(i, 1) for i, _ in urls[200:290]]
    out = {r.page_id: r for r in judge_urls(spark.createDataFrame(urls, "page_id long, url string"), [], spark.createDataFrame(labels, "page_id long, bad int")).collect()}
    assert out[0].template == out[1].template == "/{blog,..}/{num}" and out[1000].template == "/spam/{num}" and out[2000].template == "/user/*/post"
    assert {out[i].verdict for i, _ in urls[200:300]} == {"block"} and {out[i].verdict for i, _ in urls[:200]} == {"allow"} == {out[2003].verdict}
    assert abs(out[1000].purity - 92 / 94) < 1e-12


def test_url_labels_of_a_sample(spark):
    """Labels on a third of a bad template reject it, a few labels do not."""
    from wayfold.llm.urls import judge_urls

    urls = [(k, f"http://h.x/spam/{k}") for k in range(60)] + [(100 + k, f"http://g.x/rare/{k}") for k in range(60)]
    labels = [(k, 1) for k in range(20)] + [(100 + k, 1) for k in range(5)]
    out = {r.page_id: r.verdict for r in judge_urls(spark.createDataFrame(urls, "page_id long, url string"), [], spark.createDataFrame(labels, "page_id long, bad int")).collect()}
    assert {out[k] for k in range(60)} == {"block"} and {out[100 + k] for k in range(60)} == {"allow"}


def test_pipeline_stages(spark):
    """Every stage on its own input, at the smallest scale, against the operators and brute force."""
    import corpus_pipeline as cp
    from wayfold.llm.decontaminate import contamination
    from wayfold.session import checkpoint

    sf = os.environ.get("WAYFOLD_TEST_SF", "/root/testdata/sf0.001")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    inputs = [docs]
    for _, stage in cp.STAGES[:-1]:
        inputs.append(checkpoint(stage(spark, inputs[-1], sf)))
        assert inputs[-1].columns == docs.columns
    rows = [{r.doc_id: r.text for r in x.collect()} for x in inputs]
    sizes = [len(r) for r in rows]
    assert sizes == sorted(sizes, reverse=True)
    roots = linked(list(rows[1].items()))
    assert set(rows[2]) == {i for i, c in roots.items() if i == c}
    pairs = sorted(rows[2].items())
    cleaned = dict(zip([i for i, _ in pairs], brute_spans(pairs)))
    assert rows[3] == {i: t for i, t in cleaned.items() if words(t) or not words(rows[2][i]) or t == rows[2][i]}
    assert all(r.n_chars == len(r.text) for r in inputs[3].collect())
    hit = {r.doc_id for r in contamination(inputs[3], spark.read.parquet(f"{sf}/benchmark.parquet")).where("n_hit > 0").collect()}
    assert set(rows[4]) == set(rows[3]) - hit
    last = cp.run(spark, sf)
    assert last.columns == docs.columns and {r.doc_id for r in last.collect()} <= set(rows[4])


def test_registered_queries_match_their_sql(spark):
    """Each query against its DuckDB twin at the smallest scale."""
    import duckdb

    from wayfold.llm.queries import ORACLE, QUERIES

    sf = os.environ.get("WAYFOLD_TEST_SF", "/root/testdata/sf0.001")
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    for name, sql in ORACLE.items():
        df = QUERIES[name](spark, sf)
        cols = sorted(df.columns)
        res = con.execute(sql)
        names = [d[0] for d in res.description]
        assert sorted(names) == cols, name
        want = sorted((tuple(r[names.index(c)] for c in cols) for r in res.fetchall()), key=str)
        assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str) == want, name
