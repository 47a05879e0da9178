"""Periodic runs of words by block convolution.

A run is a maximal stretch of words with smallest period q whose length is at least ``exponent`` (4) times q and at
least ``least`` (6) words. Scale B looks for the periods from B to 2 B - 1 (the largest scale for all beyond): a run of
such a period holds an aligned block of B words together with its copy q words on, since 2 B - 1 <= 3 q. So

1. a block can only matter if each of its words comes again soon enough; that leaves few blocks of ordinary prose;
2. the sum of squared differences between the block and every position of the window that follows is a correlation of
   word codes. It is computed modulo a prime by a number-theoretic transform over all blocks of a scale at once, exact
   since the codes are small enough for the sum to stay below the prime. Zero marks an occurrence at distance d;
3. each distance seeds an extension to both sides in which the words themselves are compared, so codes that agree by
   chance do no harm. Stretches whose period is a multiple of a shorter one are that shorter run and are dropped;
   occurrences inside a run that is known already are not extended again.

The transform is built from matrix products of at most 64 x 64: residues under 2^23 keep their sums below 2^53, so
doubles hold them exactly.

Spark deals out rows; a task holds the words of one text at a time, and ``CELLS`` numbers of the convolution.

Rows: each row is judged alone, so repeated rows and ids get equal results. Null, empty and white-space texts have no
words and no runs; their collapsed text is empty. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from wayfold.llm import textscan as ts

#: Numbers of a convolution that a task holds at once, if a single block needs no more.
CELLS = 1 << 18
#: Largest block; twice of it is the longest transform that the prime has.
MAX_BLOCK = 1 << 19

# fixed values: a prime of the form 7 * 2^20 + 1, and a generator of its residues
PRIME, GENERATOR = 7_340_033, 3
_RADIX = 64
_BACK = 1.0 / PRIME

RUN = StructType([StructField("start", LongType()), StructField("length", LongType()), StructField("period", LongType())])


def _mod(x: np.ndarray) -> np.ndarray:
    x = x - np.floor(x * _BACK) * PRIME
    x[x < 0] += PRIME
    x[x >= PRIME] -= PRIME
    return x


@lru_cache(maxsize=64)
def _powers(n: int, inverse: bool) -> np.ndarray:
    """All powers of a root of unity of order n."""
    root = pow(GENERATOR, (PRIME - 1) // n, PRIME)
    root = pow(root, -1, PRIME) if inverse else root
    out = np.ones(1, np.int64)
    while len(out) < n:
        out = np.concatenate([out, out * pow(root, len(out), PRIME) % PRIME])
    return out.astype(np.float64)


@lru_cache(maxsize=16)
def _matrix(n: int, inverse: bool) -> np.ndarray:
    return _powers(n, inverse)[np.outer(np.arange(n), np.arange(n)) % n]


def transform(x: np.ndarray, inverse: bool = False) -> np.ndarray:
    """Number-theoretic transform of each row (residues; a power of two of them); the inverse is not scaled."""
    rows, n = x.shape
    if n <= _RADIX:
        return _mod(x @ _matrix(n, inverse))
    few = n // _RADIX
    x = _mod(_matrix(_RADIX, inverse) @ x.reshape(rows, _RADIX, few))
    x = _mod(x * _powers(n, inverse)[np.outer(np.arange(_RADIX), np.arange(few))])
    x = transform(x.reshape(rows * _RADIX, few), inverse).reshape(rows, _RADIX, few)
    return np.ascontiguousarray(x.transpose(0, 2, 1)).reshape(rows, n)


def mismatches(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Sums of squared differences, modulo the prime, of each block and the stretches at 0 to B - 1 of its window of 2 B."""
    size = blocks.shape[1]
    padded = np.concatenate([blocks, np.zeros_like(blocks)], axis=1)
    both = _mod(transform(windows) * transform(padded, inverse=True))
    product = _mod(transform(both, inverse=True)[:, :size] * float(pow(2 * size, -1, PRIME)))
    squares = np.cumsum(np.concatenate([np.zeros((len(windows), 1)), windows * windows], axis=1), axis=1)
    return _mod((blocks * blocks).sum(axis=1)[:, None] + squares[:, size : 2 * size] - squares[:, :size] - 2 * product)


def _codes(words: np.ndarray, size: int) -> np.ndarray:
    """Codes small enough for ``size`` squared differences to stay below the prime; distinct words share one only if they must."""
    kinds = int((PRIME // size) ** 0.5)
    if words.max() < kinds:
        return words.astype(np.float64)
    return (ts.mix(words.astype(ts.U64) + ts.U64(size)) % ts.U64(kinds)).astype(np.float64)


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common beginning."""
    at, step, n = 0, 32, min(len(a), len(b))
    while at < n:
        to = min(at + step, n)
        same = a[at:to] == b[at:to]
        if not same.all():
            return at + int(same.argmin())
        at, step = to, 2 * step
    return n


def _prime_factors(n: int) -> list[int]:
    out, k = [], 2
    while k * k <= n:
        if n % k == 0:
            out.append(k)
            while n % k == 0:
                n //= k
        k += 1
    return out + [n] * (n > 1)


class _Known:
    """The runs found so far, by the size of their period, to leave out occurrences inside them."""

    def __init__(self):
        self.by: dict[int, list[tuple[int, int, int]]] = {}

    def add(self, start: int, end: int, period: int) -> None:
        self.by.setdefault(period.bit_length(), []).append((start, end, period))

    def inside(self, start: np.ndarray, end: np.ndarray, distance: np.ndarray) -> np.ndarray:
        out = np.zeros(len(start), bool)
        for runs in self.by.values():
            r = np.array(sorted(runs))
            at = np.searchsorted(r[:, 0], start, "right") - 1
            own = r[np.maximum(at, 0)]
            out |= (at >= 0) & (own[:, 1] >= end) & (distance % own[:, 2] == 0)
        return out


def _occurrences(words: np.ndarray, blocks: np.ndarray, size: int, shifts: int):
    """(block start, distance) of all zero-mismatch occurrences in the ``shifts`` windows after each block, in pieces."""
    codes = np.concatenate([_codes(words, size), np.zeros((shifts + 3) * size)])
    step = max(1, CELLS // (2 * size))
    for at in range(0, len(blocks), step):
        start = blocks[at : at + step]
        block = codes[start[:, None] + np.arange(size)]
        for k in range(1, shifts + 1):
            hit = mismatches(block, codes[start[:, None] + k * size + np.arange(2 * size)]) == 0
            a, d = np.nonzero(hit)
            d += k * size
            fits = start[a] + d + size <= len(words)
            yield start[a[fits]], d[fits]


def runs(words: np.ndarray, exponent: int = 4, least: int = 6, max_block: int = MAX_BLOCK) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of numbers from 0, by start, then period; ``exponent`` is 4 or more."""
    n, found, known = len(words), set(), _Known()
    if n < max(least, exponent):
        return []
    by = np.argsort(words, kind="stable")
    again = np.full(n, n)
    same = words[by[1:]] == words[by[:-1]]
    again[by[:-1][same]] = (by[1:] - by[:-1])[same]
    longest, size = n // exponent, 1
    while size <= longest:
        last = 2 * size > max_block
        shifts = longest // size if last else 1
        soon = again <= min((shifts + 1) * size - 1, longest)
        full = n // size
        blocks = np.flatnonzero(soon[: full * size].reshape(full, size).all(axis=1)) * size
        for start, distance in _occurrences(words, blocks, size, shifts) if len(blocks) else ():
            while len(start):
                fresh = ~known.inside(start, start + distance + size, distance)
                start, distance = start[fresh], distance[fresh]
                if not len(start):
                    break
                s, d = int(start[0]), int(distance[0])
                right = _agree(words[s:], words[s + d :])
                left = _agree(words[:s][::-1], words[: s + d][::-1][: s]) if right >= size else 0
                lo, hi = s - left, s + right + d
                if right < size:
                    start, distance = start[1:], distance[1:]
                    continue
                rest = (distance != d) | (start < lo) | (start + distance + size > hi)
                start, distance = start[rest], distance[rest]
                if hi - lo >= max(least, exponent * d) and not any(np.array_equal(words[lo : lo + d], words[lo + d // f : lo + d // f + d]) for f in _prime_factors(d)):
                    found.add((lo, hi - lo, d))
                    known.add(lo, hi, d)
        if last:
            break
        size *= 2
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words joined by spaces, but for those that any run holds after its first period."""
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        gone[start + period] += 1
        gone[start + length] -= 1
    keep = np.cumsum(gone)[:-1] == 0 if found else ()
    return b" ".join([w for w, k in zip(words, keep) if k] if found else words)


def strongest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest length / period, compared exactly; ties: the smallest start, then period."""
    return min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rewrite: Callable[[object, list[bytes]], list[bytes]] | None = None,
                  exponent: int = 4, least: int = 6) -> DataFrame:
    """(doc_id, n_words, runs, strongest, text): all runs, the strongest one, and the text without the repeats.

    ``rewrite`` may change the words (as bytes) of a row before they are searched.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = StructType([rows.schema["doc_id"], StructField("n_words", LongType()), StructField("runs", ArrayType(RUN)), StructField("strongest", RUN), StructField("text", StringType())])
    run_type = pa.struct([(f.name, pa.int64()) for f in RUN])
    as_row = lambda r: r and dict(zip(RUN.names, r))

    def emit(part: pa.RecordBatch) -> pa.RecordBatch:
        n, all_runs, best, texts = [], [], [], []
        data, offs = ts.flat(part.column("text"))
        for k, i in enumerate(part.column("doc_id").to_pylist()):
            words = data[offs[k] : offs[k + 1]].tobytes().split()
            if rewrite:
                words = rewrite(i, words)
            number: dict[bytes, int] = {}
            found = runs(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)), exponent, least)
            n.append(len(words))
            all_runs.append([as_row(r) for r in found])
            best.append(as_row(strongest(found)))
            texts.append(collapsed(words, found))
        return pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(all_runs, pa.list_(run_type)), pa.array(best, run_type), pa.array(texts, pa.binary()).cast(pa.string())],
                                          names=schema.names)

    return ts.map_slices(rows, "text", emit, schema)
