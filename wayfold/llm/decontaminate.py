"""Benchmark decontamination by Wu-Manber multi-pattern search.

Patterns are windows of consecutive item words, written as " w1 w2 ... wn ". Texts are brought to the
same form, so a byte search finds whole words only. Per group of pattern lengths a shift table over
byte blocks skips impossible positions, a bucket of the hash of the last block selects patterns, their
first block is compared, and a direct comparison confirms. Thousands of cursors move through a slice
of text in step, which keeps the search in NumPy.

Patterns travel to the tasks in blocks of at most ``BLOCK_BYTES``; a task scans its text against one
block after another, so a benchmark of any size works with bounded memory.

Rows: every row of the documents gives one result row, repeated rows and ids included. Null or empty
texts have no words and are clean. Items without words have no window. An empty benchmark leaves all
documents clean. Other columns are never looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from wayfold.llm import textscan as ts

#: Words of a window.
WINDOW = 10
#: Bytes of patterns and item names that one block may hold.
BLOCK_BYTES = 16 << 20
#: Lower bounds of the groups of pattern lengths, and bytes of a block in each.
LENGTH_GROUPS = ((32, 8), (8, 4), (3, 2))
HASH_BITS = 18
#: Bytes between cursors.
LANE = 2048

# fixed values: bytes that part words (all ASCII but digits and letters; letters count as lower-cased)
_BREAKS = np.zeros(256, bool)
_BREAKS[:128] = True
_BREAKS[0x30:0x3A] = False
_BREAKS[0x61:0x7B] = False


class _Plain:
    """A slice of texts as " w1 w2 ... " + NUL per document."""

    def __init__(self, column: pa.Array):
        data, offs = ts.flat(column)
        low = ts.LOWER[data]
        w = self.words = ts.Words(low, offs, _BREAKS)
        docs = len(offs) - 1
        size = w.end - w.start
        doc = np.repeat(np.arange(docs), np.diff(w.first))
        shift = np.arange(1, len(w) + 1) + 2 * doc
        kept = np.concatenate([[0], np.cumsum(size)])
        text = np.full(kept[-1] + len(w) + 2 * docs + 8, 0x20, np.uint8)
        text[np.arange(kept[-1]) + np.repeat(shift, size)] = low[w.inside]
        text[kept[w.first[1:]] + w.first[1:] + 2 * np.arange(docs) + 1] = 0
        text[-8:] = 0
        self.text, self.start, self.doc, self.docs = text, kept[:-1] + shift, doc, docs


def _eight(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as one number."""
    return np.lib.stride_tricks.as_strided(text.view(), (len(text) - 7, 8), (1, 1)).view("<u8")[:, 0]


def _slot(v: np.ndarray, mask: np.uint64) -> np.ndarray:
    return (((v & mask) * ts.U64(0x9E3779B97F4A7C15)) >> ts.U64(64 - HASH_BITS)).astype(np.int64)


class _Group:
    """Shift table and suffix buckets for the patterns of one length group."""

    def __init__(self, patterns: list[bytes], numbers: np.ndarray, block: int):
        self.patterns, self.numbers = patterns, numbers
        self.m = min(map(len, patterns))
        self.block, self.mask = block, ts.U64((1 << (8 * block)) - 1)
        joined = np.frombuffer(b"".join(patterns) + bytes(8), np.uint8)
        at = np.concatenate([[0], np.cumsum([len(p) for p in patterns])])[:-1]
        eight = _eight(joined)
        self.shift = np.full(1 << HASH_BITS, self.m - block + 1, np.int64)
        for j in range(self.m - block + 1):
            self.shift[_slot(eight[at + j], self.mask)] = self.m - block - j
        suffix = _slot(eight[at + self.m - block], self.mask)
        order = np.argsort(suffix, kind="stable")
        self.order, self.bucket = order, np.searchsorted(suffix[order], np.arange((1 << HASH_BITS) + 1))
        self.prefix = eight[at] & self.mask

    def occurrences(self, text: np.ndarray, raw: bytes) -> list[tuple[int, int]]:
        """(position, pattern number) of all occurrences."""
        last = len(text) - 8 - self.m  # eight bytes of padding end a slice
        if last < 0:
            return []
        eight, ahead = _eight(text), self.m - self.block
        cur = np.arange(0, last + 1, LANE)
        stop = np.minimum(cur + LANE, last + 1)
        found = []
        while len(cur):
            step = self.shift[_slot(eight[cur + ahead], self.mask)]
            if not step.all():
                found.append(cur[step == 0])
            cur = cur + np.maximum(step, 1)
            live = cur < stop
            if not live.all():
                cur, stop = cur[live], stop[live]
        if not found:
            return []
        c = np.concatenate(found)
        slot = _slot(eight[c + ahead], self.mask)
        n = self.bucket[slot + 1] - self.bucket[slot]
        pos = np.repeat(c, n)
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        p = self.order[np.repeat(self.bucket[slot], n) + inner]
        alike = (eight[pos] & self.mask) == self.prefix[p]
        return [(x, int(self.numbers[k])) for x, k in zip(pos[alike].tolist(), p[alike].tolist()) if raw.startswith(self.patterns[k], x)]


class _Block:
    """One block of patterns, ready to scan with; ``items`` are those of each pattern."""

    def __init__(self, rows: list[tuple[bytes, str]]):
        by: dict[bytes, list[str]] = {}
        for pattern, item in rows:
            by.setdefault(pattern, []).append(item)
        self.patterns, self.items = list(by), list(by.values())
        self.n_words = [p.count(b" ") - 1 for p in self.patterns]
        self.groups, taken = [], np.array([len(p) for p in self.patterns], np.int64)
        above = 1 << 62
        for least, block in LENGTH_GROUPS:
            own = np.flatnonzero((taken >= least) & (taken < above))
            above = least
            if len(own):
                self.groups.append(_Group([self.patterns[i] for i in own], own, block))

    def mark(self, plain: _Plain, edges: np.ndarray, items: dict[int, set[str]]) -> None:
        """Add the hit words to ``edges`` (a difference array) and the items to their documents."""
        raw = plain.text.tobytes()
        for g in self.groups:
            for pos, k in g.occurrences(plain.text, raw):
                w = int(np.searchsorted(plain.start, pos + 1))
                edges[w] += 1
                edges[w + self.n_words[k]] -= 1
                items.setdefault(int(plain.doc[w]), set()).update(self.items[k])


def item_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct (pattern, item) pairs of a benchmark."""
    schema = StructType([StructField("pattern", StringType()), StructField("item", StringType())])

    def emit(part: pa.RecordBatch) -> pa.RecordBatch:
        plain = _Plain(part.column("text"))
        w = plain.words
        start, end, offs = ts.windows(w.first, window, short=True)
        raw, size = plain.text.tobytes(), w.end - w.start
        names = np.repeat(np.arange(plain.docs), np.diff(offs))
        return pa.RecordBatch.from_arrays(
            [pa.array([raw[plain.start[a] - 1 : plain.start[b - 1] + size[b - 1] + 1].decode() for a, b in zip(start, end)], pa.string()),
             part.column("item").take(pa.array(names))], names=["pattern", "item"])

    rows = items.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text"))
    return ts.map_slices(rows, "text", emit, schema).distinct()


def _blocks(pairs: DataFrame) -> list:
    """The pairs as broadcasts of bounded size."""
    pairs = pairs.persist()
    size = pairs.agg(F.sum(F.octet_length("pattern") + F.coalesce(F.octet_length("item"), F.lit(0)) + 64)).first()[0] or 0
    n = -(-2 * size // BLOCK_BYTES)  # hashing fills blocks unevenly, so aim at half
    out = []
    for k in range(n):
        rows = pairs.where(F.pmod(F.xxhash64("pattern", "item"), F.lit(n)) == k).collect()
        out.append(pairs.sparkSession.sparkContext.broadcast([(r.pattern.encode(), r.item) for r in rows]))
    pairs.unpersist()
    return out


class _Scanner:
    """Scans slices in a task; keeps the tables when there is a single block."""

    def __init__(self, blocks: list):
        self.blocks, self.ready = blocks, None

    def _tables(self):
        if len(self.blocks) == 1:
            self.ready = self.ready or _Block(self.blocks[0].value)
            yield self.ready
            return
        for b in self.blocks:
            yield _Block(b.value)
            b._value = None  # one block in memory at a time
            del b._value

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
        plain = _Plain(column)
        edges, items = np.zeros(len(plain.start) + 1, np.int64), {}
        for block in self._tables():
            block.mark(plain, edges, items)
        hit = np.concatenate([[0], np.cumsum(np.cumsum(edges[:-1]) > 0)])
        first = plain.words.first
        return np.diff(first), hit[first[1:]] - hit[first[:-1]], [sorted(items.get(d, ()), key=lambda s: s or "") for d in range(plain.docs)]


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per document row: ``doc_id, n_words, n_hit, items`` (ids as strings, sorted, of items with an occurring window)."""
    scan = _Scanner(_blocks(item_windows(items, text=text, window=window)))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = StructType([rows.schema["doc_id"], StructField("n_words", LongType()), StructField("n_hit", LongType()), StructField("items", ArrayType(StringType()))])

    def judge(part: pa.RecordBatch) -> pa.RecordBatch:
        n, hit, found = scan(part.column("text"))
        return pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(hit, pa.int64()), pa.array(found, pa.list_(pa.string()))], names=schema.names)

    return ts.map_slices(rows, "text", judge, schema)


def clean_documents(docs: DataFrame, items: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, in which no window of an item occurs."""
    scan = _Scanner(_blocks(item_windows(items, text=text, window=window)))
    return ts.map_slices(docs, text, lambda part: part.filter(pa.array(scan(part.column(text))[1] == 0)), docs.schema)
