"""Decontamination, quality rules, scores and token counts against brute force."""

import hashlib
import math
import os
import sys
import tempfile
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from common import SCHEMA, ascii_lower, odd_documents, prose, words  # noqa: E402

from wayfold.llm import decontaminate, quality, textscan as ts  # noqa: E402

ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_documents(), SCHEMA)


def hits(text, patterns):
    w = words(ascii_lower(text), ALNUM)
    hit, items = set(), set()
    for size in {len(p) for p in patterns}:
        for k in range(len(w) - size + 1):
            own = patterns.get(tuple(w[k : k + size]))
            if own:
                hit.update(range(k, k + size))
                items |= own
    return len(w), len(hit), sorted(items)


def windows_of(items):
    out = {}
    for i, t in items:
        w = words(ascii_lower(t), ALNUM)
        for k in range(max(len(w) - 9, 1 if w else 0)):
            out.setdefault(tuple(w[k : k + 10]), set()).add(str(i))
    return out


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 4096])
def test_contamination(spark, docs, monkeypatch, block_bytes):
    items = [(1, prose(1, 14)), (10, prose(1, 14)), (2, "two"), (3, None), (4, " .,! "), (5, prose(9, 40)), (6, prose(3, 90)), (7, "GROSSE straße: àé"), (8, "Große STRASSE"), (9, "große straße"), (12, "A.")]
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(docs, bench).collect()
    patterns = windows_of(items)
    want = sorted((r[0] or -1, *hits(r[1], patterns)) for r in odd_documents())
    assert sorted((r.doc_id or -1, r.n_words, r.n_hit, r["items"]) for r in got) == want
    assert any(w[2] for w in want)
    kept = decontaminate.clean_documents(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.n for r in kept.collect()) == sorted(r[5] for r in odd_documents() if not hits(r[1], patterns)[1])


def test_contamination_of_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.clean_documents(docs, none).count() == len(odd_documents())
    assert decontaminate.contamination(docs.limit(0), none).count() == 0


def test_search_crosses_slices_and_lanes():
    text = " ".join(f"t{i}" for i in range(5000))
    block = decontaminate._Block([(b" t2040 t2041 t2042 t2043 t2044 t2045 t2046 t2047 t2048 t2049 ", "a"), (b" t7 ", "b"), (b" t4999 ", "c")])
    plain = decontaminate._Plain(pa.array([text, text, None]))
    edges, items = np.zeros(len(plain.start) + 1, np.int64), {}
    block.mark(plain, edges, items)
    assert items == {0: {"a", "b", "c"}, 1: {"a", "b", "c"}} and int((np.cumsum(edges) > 0).sum()) == 24


def brute_quality(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    rep = {p for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for p in range(i, i + 5)}
    lost, seen = 0, set()
    for x in lines:
        letters = [c for c in x if c.isascii() and c.isalpha()]
        bad = x in seen or 100 * sum(c in quality.SYMBOLS for c in x) > 30 * len(words(x)) or sum(c in quality.BARS for c in x) >= 3
        bad |= len(letters) >= 20 and 100 * sum(c.isupper() for c in letters) > 50 * len(letters)
        bad |= x.rstrip(" \t\n\r\x0b\x0c")[-1] not in quality.TERMINAL or any(p in ascii_lower(x) for p in quality.BOILERPLATE)
        lost += len(words(x)) * bad
        seen.add(x)
    failed = len(w) < 10 or 100 * len(rep) > 20 * len(w)
    return (len(w), sum(map(len, w)), sum(c in quality.SYMBOLS for c in text or ""), len(lines) - len(set(lines)), len(rep), lost, failed, not failed and 100 * lost <= 50 * len(w))


def test_quality_rules(spark, docs):
    lines = ["A fine line that ends well.", "A fine line that ends well.", "home | about | help | top", "NO SHOUTING IN THIS LINE PLEASE SIR!", "no end here", "Read our Privacy Policy today.", "x# y$ z% & <b>", "«Fin»", "终于。", "\x0b", ""]
    extra = [(100 + k, "\n".join(lines[k % 11 :] + lines[: k % 11] * (k // 11))) for k in range(33)]
    rows = [(r[0], r[1]) for r in odd_documents()] + extra
    got = quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    key = lambda x: (x[0] if x[0] is not None else -1, *map(int, x[1:]))
    assert sorted(key((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_lost_words, r.base_failed, r.kept)) for r in got) == sorted(key((i, *brute_quality(t))) for i, t in rows)
    by = {r.doc_id: r for r in got}
    assert by[100].clean_text == "A fine line that ends well.\n«Fin»\n终于。\n\x0b\n" and by[6].clean_text == "" and by[6].base_failed
    assert quality.quality_rules(docs.limit(0)).count() == 0


def test_hashes_do_not_depend_on_position():
    a, b = pa.array(["x y z", "a b c d e"]), pa.array(["c d e", "q b c d"])
    sets = []
    for col in (a, b):
        data, offs = ts.flat(col)
        w = ts.Words(data, offs, ts.SPACES)
        h = w.hashes(ts.byte_prefix(data))
        s, e, at = ts.windows(w.first, 3, short=True)
        sets.append(ts.run_hash(ts.run_prefix(h), s, e))
        assert at.tolist() == [0, 1, 4] if col is a else at.tolist() == [0, 1, 3]
    assert sets[0][3] == sets[1][0] and sets[0][2] == sets[1][2] and len(set(sets[0]) | set(sets[1])) == 5


def labelled(spark, n=900):
    rows = []
    for i in range(n):
        bad = i % 6 == 0
        text = prose(1000 + i, 40) + (f" such awful {['drivel', 'nonsense'][i % 4 // 2]} here" if bad else "")
        rows.append((i, text, int(bad)))
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(None, None, "x"), (n, "", "y"), (n + 1, None, "z")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, b) for i, _, b in rows] + [(None, 1), (3, None), (n + 5, 1), (5, 7)], "doc_id long, toxic int")
    return docs, labels, {i: b for i, _, b in rows}


def test_toxicity(spark):
    from wayfold.llm import toxicity as tx

    docs, labels, truth = labelled(spark)
    held = {r.doc_id for r in docs.where(tx.held_out("doc_id", 4, 2) & docs.doc_id.isNotNull()).collect()}
    assert held == {i for i in range(902) if zlib.crc32(str(i).encode()) % 4 == 2}
    model = tx.fit(docs, labels.where(~tx.held_out("doc_id", 4, 2)), "toxic")
    assert 0 < len(model[0]) < 2000  # sparse
    got = {r.doc_id: r.score for r in tx.toxicity_scores(docs, model).collect()}
    assert len(got) == 903 and all(0 <= s <= 1 for s in got.values()) and got[900] == got[901] == got[None]
    out = [i for i in held if i in truth]
    assert sum((got[i] >= 0.3) == bool(truth[i]) for i in out) / len(out) > 0.97
    kept = tx.mild_documents(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, s in got.items() if s < 0.3}
    again = tx.fit(docs, labels.where(~tx.held_out("doc_id", 4, 2)), "toxic")
    assert np.array_equal(model[0], again[0]) and np.array_equal(model[1], again[1])
    blank = tx.fit(docs, labels.limit(0), "toxic")
    assert {r.score for r in tx.toxicity_scores(docs, blank).collect()} == {0.5} and tx.toxicity_scores(docs.limit(0), model).count() == 0


def test_ftrl_is_the_published_update():
    from wayfold.llm.toxicity import _BIAS, ftrl

    w = ftrl([(1, np.array([5])), (0, np.array([5, 9]))], 1, alpha=0.5, beta=1.0, l1=0.1, l2=0.2)
    z, n, wt = Counter(), Counter(), Counter()
    for y, f in ((1, [5]), (0, [5, 9])):
        f = f + [_BIAS]
        for i in f:
            l1 = 0 if i == _BIAS else 0.1
            wt[i] = 0 if abs(z[i]) <= l1 else -(z[i] - math.copysign(l1, z[i])) / ((1 + n[i] ** 0.5) / 0.5 + 0.2)
        g = 1 / (1 + math.exp(-sum(wt[i] for i in f))) - y
        for i in f:
            z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / 0.5 * wt[i]
            n[i] += g * g
    want = {i: 0 if abs(z[i]) <= (0 if i == _BIAS else 0.1) else -(z[i] - math.copysign(0 if i == _BIAS else 0.1, z[i])) / ((1 + n[i] ** 0.5) / 0.5 + 0.2) for i in z}
    assert all(abs(w[i] - want[i]) < 1e-12 for i in want)


def test_quality_classifier(spark):
    from wayfold.llm import pulearn as pu

    rows = []
    for i in range(1200):
        good = i % 5 != 0
        t = prose(5000 + i, 60 + i % 50)
        rows.append((i, t if good else (t.replace(" ", " ### ") if i % 2 else t.upper().replace(" ", "!! ")), int(good)))
    docs = spark.createDataFrame([(i, t, 0.7) for i, t, _ in rows] + [(None, None, 0.1), (5000, "", 0.2)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, g) for i, _, g in rows if i % 3] + [(7, None), (None, 1)], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in pu.quality_scores(docs, pu.fit(docs, labels, "quality")).collect()}
    assert len(got) == 1202 and all(0 <= s <= 1 for s in got.values())
    out = [r for r in rows if r[0] % 3 == 0]
    assert sum((got[i] >= 0.5) == bool(g) for i, _, g in out) / len(out) > 0.95
    assert {r.score for r in pu.quality_scores(docs, pu.fit(docs, labels.limit(0), "quality")).collect()} == {0.5}


def test_risk_never_follows_a_negative_part():
    """With positives and unlabelled from one source, a prior of 1 leaves nothing to call bad."""
    from wayfold.llm import pulearn as pu

    x = np.random.default_rng(1).normal(size=(400, len(pu.FEATURES)))
    assert (pu.non_negative_fit(x[:200], x[200:], 0.99).score(x) > 0.5).mean() > 0.95


@pytest.mark.skipif(not os.path.exists("/opt/tokenizers"), reason="no vocabulary")
def test_token_counts(spark, docs):
    from wayfold.llm import tokens as tk

    encode = tk.Encoder(tk.RANKS)
    got = tk.counted(docs.repartition(3)).collect()
    assert sorted(r.tokens for r in got) == sorted(len(encode(r[1] or "")) for r in odd_documents()) and all(r.closed for r in got)
    assert tk.counted(docs.limit(0)).count() == 0


@pytest.mark.parametrize("width,block", [(2, 10), (4, 64), (2, 1 << 20)])
def test_separator_scan(spark, width, block, monkeypatch):
    from wayfold.llm import tokens as tk

    monkeypatch.setattr(tk, "CHUNK", 3)
    rng, want = np.random.default_rng(width), []
    folder = tempfile.mkdtemp(prefix="spark-tok-", dir="/tmp")
    for f in range(4):
        sizes = rng.integers(0, 40, 30).tolist() if f < 2 else []
        ids = [x for n in sizes for x in [*rng.integers(0, 99, n).tolist(), 99]] + ([1, 2, 3] if f in (1, 2) else [])
        np.array(ids, f"<u{width}").tofile(f"{folder}/f{f}.bin")
        at = np.cumsum([0] + [n + 1 for n in sizes])
        want += [(f"f{f}.bin", k, int(at[k]), n, True) for k, n in enumerate(sizes)] + ([(f"f{f}.bin", len(sizes), int(at[-1]), 3, False)] if f in (1, 2) else [])
    got = tk.token_counts(tk.token_files(spark, folder), end=99, width=width, block_bytes=block).collect()
    assert sorted((r.path.rpartition("/")[2], r.doc, r.start, r.tokens, r.closed) for r in got) == sorted(want)


def test_digest_of_items():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
