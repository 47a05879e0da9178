"""Periodic runs against brute force."""

import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from common import SCHEMA, odd_documents  # noqa: E402

from wayfold.llm import periodic  # noqa: E402
from wayfold.llm.queries import repeated_tail  # noqa: E402


def brute(words):
    n, best = len(words), {}
    for q in range(n // 4, 0, -1):
        i = 0
        while i + q < n:
            k = i
            while k + q < n and words[k] == words[k + q]:
                k += 1
            if k - i + q >= max(6, 4 * q):
                best[i, k - i + q] = q  # the smaller period comes last
            i = max(k, i + 1)
    return sorted(((s, n, q) for (s, n), q in best.items()), key=lambda r: (r[0], r[2]))


def without(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("n", [2, 8, 64, 128, 1024, 8192])
def test_transform_is_exact(n):
    rnd = np.random.default_rng(n)
    x = rnd.integers(0, periodic.PRIME, (3, n)).astype(float)
    y = periodic.transform(x)
    k = int(rnd.integers(n))
    root = pow(periodic.GENERATOR, (periodic.PRIME - 1) // n, periodic.PRIME)
    assert int(y[1, k]) == sum(int(v) * pow(root, i * k, periodic.PRIME) for i, v in enumerate(x[1])) % periodic.PRIME
    assert (periodic._mod(periodic.transform(y, inverse=True) * pow(n, -1, periodic.PRIME)) == x).all()


@pytest.mark.parametrize("size", [1, 4, 32, 256])
def test_mismatches(size):
    rnd = np.random.default_rng(size)
    a, w = rnd.integers(0, 9, (5, size)).astype(float), rnd.integers(0, 9, (5, 2 * size)).astype(float)
    w[2, size // 2 : size // 2 + size] = a[2]
    got = periodic.mismatches(a, w)
    want = np.array([[((a[r] - w[r, d : d + size]) ** 2).sum() for d in range(size)] for r in range(5)])
    assert (got == want).all() and got[2, size // 2] == 0


def sequences():
    rnd = random.Random(3)
    fib = [0], [0, 1]
    while len(fib[-1]) < 300:
        fib = fib[-1], fib[-1] + fib[-2]
    yield fib[-1] * 5
    yield [0] * 5
    yield [0] * 6
    yield [0, 1] * 3
    yield [0, 1] * 4
    yield []
    yield [0] * 500
    yield list(range(100)) * 4
    yield list(range(100)) * 4 + list(range(99))
    yield [7] + list(range(101)) * 3 + list(range(100))
    for k in range(150):
        out = []
        while len(out) < rnd.choice([30, 200, 900]):
            unit = [rnd.randrange(rnd.choice([1, 2, 3, 30])) for _ in range(rnd.choice([1, 2, 3, 5, 8, 13, 40]))]
            out += unit * rnd.choice([1, 1, 3, 4, 5, 9]) + unit[: rnd.randrange(len(unit))]
        yield out


def numbers(words):
    known = {}
    return np.array([known.setdefault(w, len(known)) for w in words], np.int64)


@pytest.mark.parametrize("max_block", [periodic.MAX_BLOCK, 4])
def test_runs(max_block):
    total = 0
    for words in sequences():
        got = periodic.runs(numbers(words), max_block=max_block)
        assert got == brute(words), words[:50]
        total += len(got)
    assert total > 300


def test_codes_that_agree_by_chance_are_compared(monkeypatch):
    monkeypatch.setattr(periodic, "_codes", lambda words, size: (words % 2).astype(float))
    for words in list(sequences())[:60]:
        assert periodic.runs(numbers(words)) == brute(words)


def test_strongest_is_exact():
    assert periodic.strongest([]) is None
    assert periodic.strongest([(9, 12, 3), (5, 8, 2), (5, 12, 3), (0, 31, 8)]) == (5, 8, 2)


def test_documents(spark):
    rows = odd_documents() + [(20, "a b " * 30 + "c d e " * 9, "en", "s", 1, 1, "x", "b"), (21, "x\ty\n" * 2000, None, None, None, None, None, None), (30, "la " * 20 + "é 你 é 你 é 你 é 你 é", None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for rewrite in (None, repeated_tail):
        got = sorted(((r.doc_id or -1, r.n_words, tuple(tuple(x) for x in r.runs), r.text) for r in periodic.periodic_runs(docs, rewrite=rewrite).collect()))
        want = []
        for r in rows:
            w = [x.decode() for x in (r[1] or "").encode().split()]
            w = rewrite(r[0], w) if rewrite else w
            found = brute(w) if len(w) < 5000 else [tuple(map(int, x)) for x in periodic.runs(numbers(w))]
            want.append((r[0] or -1, len(w), tuple(found), without(w, found)))
        assert got == sorted(want)
    assert spark.createDataFrame([], SCHEMA).transform(periodic.periodic_runs).count() == 0
