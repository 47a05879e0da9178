"""Secret scans: base spans against the plain patterns, the field against brute force and on secrets it has not seen."""

import itertools
import os
import random
import re
import sys

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from common import SCHEMA, odd_documents, prose  # noqa: E402

from wayfold.llm import secretscan as S  # noqa: E402

PATTERNS = (("assign", r"""(?ia:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6), ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]+", 0, 24))


def base(text):
    out = [(m.start(), k, name, m.end()) for k, (name, p, g, least) in enumerate(PATTERNS) for m in re.finditer(p, text or "") if len(m.group(g)) >= least]
    return [(name, a, b) for a, _, name, b in sorted(out)]


HEX = "0123456789abcdef"
TRICKY = [
    'é Token = "%s"' % (HEX * 2), "PASSWORD:abc", "secret=token:abcdefgh", "token: token=abcdefgh", "api_key' :  'a.b-c_d/e+f=' x", "APIKEY=\nabcdef", "tokenſecret=abcdef paſsword=abcdefg",
    "AKIA" + "A" * 16, "AKIA" + "B" * 15, "xAKIAAKIA" + "C" * 16 + "é", HEX + "01234567", HEX + "0123456", "A" + HEX * 3 + "Z", "token=" + HEX * 2 + " passwd = AKIA" + "Z9" * 9, "token =\ttabbed1", "",
]


def test_base_spans():
    for text in TRICKY + [" ".join(TRICKY)]:
        raw = text.encode()
        got = [(S.KINDS[k], len(raw[:a].decode()), len(raw[:b].decode())) for k, a, b, _, _ in S.base_matches(raw)]
        assert got == base(text)


def corpus(n=300):
    rnd = random.Random(2)
    pick = lambda chars, k: "".join(rnd.choice(chars) for _ in range(k))
    rows = []
    for i in range(n):
        words = prose(i, 60).split()
        if i % 3 == 0:
            at = rnd.randrange(60)
            words[at:at] = [rnd.choice(["password = %s", 'token: "%s"', "api_key=%s"]) % pick(HEX, rnd.choice([24, 32, 40]))]
        if i % 4 == 1:
            words[5:5] = ["https://host%d.example.org/page" % i, "Donaudampfschifffahrtsgesellschaft"]
        rows.append((i, " ".join(words), "en", "s", 1, i, "x", None))
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA)


@pytest.fixture(scope="module")
def model(docs):
    return S.fit(docs, train_docs=80)


def test_likelihood_and_gradients():
    rnd = np.random.default_rng(4)
    scores, moves = rnd.normal(size=(3, 4, 3)), rnd.normal(size=(3, 3))
    n, tags = np.array([4, 1, 3]), rnd.integers(0, 3, (3, 4)).astype(np.int8)

    def value(scores, moves):
        total = 0
        for r in range(3):
            path = lambda p: moves[0, p[0]] + sum(scores[r, t, s] for t, s in enumerate(p)) + sum(moves[a, b] for a, b in zip(p, p[1:])) + moves[p[-1], 0]
            total += path(tags[r, : n[r]]) - np.log(sum(np.exp(path(p)) for p in itertools.product(range(3), repeat=n[r])))
        return total

    got, by_score, by_move = S.likelihood(scores, moves, tags, n)
    assert got == pytest.approx(value(scores, moves))
    for x, g in ((scores, by_score), (moves, by_move)):
        for at in np.ndindex(x.shape):
            y = x.copy()
            y[at] += 1e-6
            change = (value(y, moves) if x is scores else value(scores, y)) - got
            assert g[at] == pytest.approx(change / 1e-6, abs=1e-4)


def test_decoding_is_best_path():
    rnd = np.random.default_rng(6)
    for _ in range(40):
        n = int(rnd.integers(1, 8))
        moves = rnd.normal(size=(3, 3)) * 2
        scores = rnd.normal(size=(n, 3)) * rnd.choice([1, 8])
        cut = int(rnd.integers(0, n + 1))
        tags = S.decode(scores, moves, np.array([0, cut, n]))
        for a, b in ((0, cut), (cut, n)):
            if a == b:
                continue
            path = lambda p: moves[0, p[0]] + sum(scores[a + t, s] for t, s in enumerate(p)) + sum(moves[x, y] for x, y in zip(p, p[1:])) + moves[p[-1], 0]
            assert path(tags[a:b]) == pytest.approx(max(map(path, itertools.product(range(3), repeat=b - a))))


def test_base_stays_and_odd_rows(spark, model):
    rows = odd_documents() + [(100 + k, t, None, None, None, None, None, None) for k, t in enumerate(TRICKY + ["é " + " ".join(TRICKY)])]
    df = spark.createDataFrame(rows, SCHEMA)
    got = S.secret_spans(df, model).collect()
    assert len(got) == len(rows)
    found = sorted((r.doc_id or -1, [(s.kind, s.start, s.end) for s in r.spans if s.kind != S.FIELD]) for r in got)
    assert found == sorted((r[0] or -1, base(r[1])) for r in rows)
    clean = S.without_secrets(df, model)
    assert clean.columns == df.columns and clean.schema == df.schema
    texts = {r.doc_id: r.text for r in clean.collect() if r.doc_id and r.doc_id >= 100}
    assert all(not base(t) for t in texts.values()) and texts[100] == 'é [secret]"'
    assert S.secret_spans(df.limit(0), model).count() == 0


def test_finds_unseen_secrets_and_leaves_words_alone(spark, model):
    rnd = random.Random(9)
    alnum = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    rows, want = [], {}
    for i in range(200):
        words = prose(1000 + i, 50).split()
        head = " ".join(words[:20]) + " "
        if i % 2:
            secret = "".join(rnd.choice(alnum) for _ in range(rnd.choice([24, 32, 40])))
            key = rnd.choice(["passphrase: ", "export AUTH=", 'credential = "', "signing key "])
            want[i] = (len(head + key), len(head + key) + len(secret))
            head += key + secret + " "
        rows.append((i, head + " ".join(words[20:]) + " Rindfleischetikettierungsgesetz 2024-01-02", None, None, None, None, None, None))
    got = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == S.FIELD] for r in S.secret_spans(spark.createDataFrame(rows, SCHEMA), model).collect()}
    hit = sum(want[i] in got[i] for i in want)
    false = sum(len(v) for i, v in got.items() if i not in want)
    assert hit >= 0.9 * len(want) and false <= 3


def test_without_any_secret_nothing_is_added(spark, docs):
    plain = docs.where("n % 3 <> 0").limit(40)
    weights, moves = S.fit(plain, train_docs=10)
    assert not weights.any()
    assert all(not r.spans for r in S.secret_spans(plain, (weights, moves)).collect())
    empty = plain.limit(0)
    assert S.secret_spans(empty, S.fit(empty)).count() == 0


def test_model_is_the_same_every_time(docs, model):
    weights, moves = S.fit(docs.repartition(5), train_docs=80)
    assert (weights == model[0]).all() and (moves == model[1]).all()


def test_token_features_do_not_depend_on_the_slice():
    texts = [r[1] or "" for r in odd_documents()] + TRICKY
    flat = lambda ts: (np.frombuffer("".join(ts).encode(), np.uint8), np.concatenate([[0], np.cumsum([len(t.encode()) for t in ts])]).astype(np.int64))
    whole = S.Tokens(*flat(texts))
    for k, t in enumerate(texts):
        own = S.Tokens(*flat([t]))
        assert (own.features == whole.features[whole.words.first[k] : whole.words.first[k + 1]]).all()
    assert whole.features.max() < S.N_FEATURES
