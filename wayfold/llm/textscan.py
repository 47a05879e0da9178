"""NumPy scans over the flat bytes of an Arrow text column, shared by the text operators.

Spark partitions the work; these helpers see one slice of a partition at a time (``SLICE_BYTES`` of
text, or one document if it is longer), so their memory does not depend on the size of the table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Text bytes handled at once in a task.
SLICE_BYTES = 2 << 20
#: Rows of an Arrow batch; long texts make a batch large well before Spark's default of 10 000 rows.
BATCH_ROWS = 512

U64 = np.uint64


def _splitmix(n: int, seed: int) -> np.ndarray:
    z = np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed)
    z = (z ^ (z >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> U64(27))) * U64(0x94D049BB133111EB)
    return z ^ (z >> U64(31))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = (h ^ (h >> U64(32))) * U64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return h ^ (h >> U64(32))


class _Powers:
    """Powers of an odd base modulo 2^64 and of its inverse, kept for the longest slice seen."""

    def __init__(self, base: int):
        self.base, self.inverse = U64(base), U64(pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, U64)

    def grow(self, n: int) -> None:
        if len(self.up) < n:
            for name, b in (("up", self.base), ("down", self.inverse)):
                p = np.full(n, b, U64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))


_BYTES, _WORDS = _Powers(0xA0761D6478BD642F), _Powers(0xE7037ED1A0B428DB)
_BYTE_CODE = _splitmix(256, 11)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def table_of(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values and the n + 1 offsets between them; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offs[0] : offs[-1]], offs - offs[0]


def slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that no part holds more than SLICE_BYTES of text, but for single longer rows."""
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), np.int64)
    total, at = np.concatenate([[0], np.cumsum(size)]), 0
    while at < len(size):
        to = max(at + 1, int(np.searchsorted(total, total[at] + SLICE_BYTES, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def map_slices(df: DataFrame, text: str, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: StructType) -> DataFrame:
    """Apply ``fn`` to bounded slices of the rows of ``df``."""
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                out = fn(part)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def bound_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small for long texts, unless the session asks for smaller ones."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


class Words:
    """Words of a slice: maximal runs of bytes outside ``breaks``, never across documents or ``cuts``.

    ``first[d]`` to ``first[d + 1]`` are the words of document d; ``start`` and ``end`` are byte positions.
    """

    def __init__(self, data: np.ndarray, offs: np.ndarray, breaks: np.ndarray, cuts: np.ndarray | None = None):
        n = len(data)
        inside = ~breaks[data] if n else np.zeros(0, bool)
        fresh = np.zeros(n + 1, bool)
        fresh[offs] = True
        if cuts is not None:
            fresh[cuts] = True
        before = np.concatenate([[False], inside[:-1]]) if n else inside
        after = np.concatenate([inside[1:], [False]]) if n else inside
        self.start = np.flatnonzero(inside & (~before | fresh[:n]))
        self.end = np.flatnonzero(inside & (~after | fresh[1:])) + 1
        self.first = np.searchsorted(self.start, offs)
        self.inside, self.data, self.offs = inside, data, offs

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, prefix: np.ndarray) -> np.ndarray:
        return span_hash(prefix, self.start, self.end)


def byte_prefix(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which the hash of any byte span follows in constant time."""
    _BYTES.grow(len(data) + 1)
    out = np.zeros(len(data) + 1, U64)
    code = _BYTE_CODE[data]
    code *= _BYTES.up[: len(data)]
    np.cumsum(code, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Equal byte spans get equal hashes, wherever they lie."""
    _BYTES.grow(len(prefix))
    return mix((prefix[end] - prefix[start]) * _BYTES.down[start] + (end - start).astype(U64))


def run_prefix(hashes: np.ndarray) -> np.ndarray:
    _WORDS.grow(len(hashes) + 1)
    out = np.zeros(len(hashes) + 1, U64)
    np.cumsum(hashes * _WORDS.up[: len(hashes)], out=out[1:])
    return out


def run_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the word sequence from ``start`` to ``end`` (word numbers)."""
    _WORDS.grow(len(prefix))
    return mix((prefix[end] - prefix[start]) * _WORDS.down[start] + (end - start).astype(U64))


def windows(first: np.ndarray, size: int, short: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and per-document offsets of all windows of ``size`` words; ``short``: fewer words make one window."""
    n = np.diff(first)
    count = np.maximum(n - size + 1, ((n > 0) & short).astype(n.dtype))
    offs = np.concatenate([[0], np.cumsum(count)])
    start = np.repeat(first[:-1] - offs[:-1], count) + np.arange(offs[-1])
    return start, np.minimum(start + size, np.repeat(first[1:], count)), offs
