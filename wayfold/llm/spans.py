"""Substring de-duplication by sliding spans of consecutive sentences.

A sentence runs to the end of a group of ``.``, ``!``, ``?`` and line breaks. From every sentence starts one span: the
shortest run of at least ``MIN_SENTENCES`` sentences and ``MIN_WORDS`` words. Spans with the same word sequence are joined
over the whole corpus; the first (smallest document id, then position) stays, and every sentence covered by
any other one is removed. Texts of any length are hashed with prefix sums, so each span costs the same.

Hot spans: the first occurrence of a span is a partial aggregate. Only repeated spans are joined back, and both
sides of that join are written tables, one of them unique by key, so adaptive execution can split a passage
that a third of all documents share.

Passages that start or end inside a sentence: ``passage_dedup`` cuts every word of ``PASSAGE`` words in a row that stand
anywhere before, wherever sentences end. Its first scan hashes only word groups chosen by their content, at least one out of any ``PASSAGE`` words
and the same one in every copy; all windows around the repeated ones are then compared, so none is missed.

Rows: null and empty texts have no sentences and stay as they are. Rows with a null id come after all others and
are told apart by their text. Rows that share id and text are one document and get the same text; of rows that
share an id but not the text, each is cleaned by itself, in the order of their fingerprints. Other columns pass
through untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType

from wayfold.llm import textscan as ts
from wayfold.session import checkpoint

MIN_SENTENCES = 2
MIN_WORDS = 12
#: Words in a row that may stand only once, and the words of a group that the first scan hashes.
PASSAGE, GROUP = 50, 20

# fixed values: characters that end a sentence
_ENDS = ts.table_of(b".!?\n")


class _Sentences:
    """Sentences of a slice of texts: byte positions ``start`` and ``end``, ``first[d]`` to ``first[d + 1]`` of document d."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        n = len(data)
        mark = _ENDS[data]
        last = np.zeros(n + 1, bool)  # a sentence ends before this byte
        if n:
            last[1:n] = mark[:-1] & ~mark[1:]
            last[offs[1:]] = True
        last[0] = False
        self.end = np.flatnonzero(last)
        self.start = np.concatenate([[0], self.end[:-1]]) if len(self.end) else self.end
        self.first = np.searchsorted(self.end, offs, "right")


def span_hashes(column: pa.Array, min_sentences: int, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the span that starts at each sentence (0: there is none), and the offsets of the documents."""
    data, offs = ts.flat(column)
    s = _Sentences(data, offs)
    w = ts.Words(data, offs, ts.SPACES, cuts=s.start)
    at = np.searchsorted(w.start, np.concatenate([s.start, [len(data)]]))  # words before each sentence
    count = len(s.start)
    last = np.repeat(s.first[1:], np.diff(s.first))
    # the first sentence after which enough words have passed, and enough sentences
    stop = np.maximum(np.searchsorted(at, at[:count] + min_words), np.arange(count) + min_sentences)
    whole = stop <= last
    stop = np.minimum(stop, last)
    h = ts.run_hash(ts.run_prefix(w.hashes(ts.byte_prefix(data))), at[:count], at[stop])
    return np.where(whole, h | ts.U64(1), ts.U64(0)).view(np.int64), s.first


def _span_rows(docs: DataFrame, doc_id: str, text: str, min_sentences: int, min_words: int) -> DataFrame:
    """(key, spans) per distinct document; key: the id and a fingerprint of the text."""
    rows = docs.select(_key(doc_id, text).alias("key"), F.col(text).alias("text"))
    schema = StructType([rows.schema["key"], StructField("spans", ArrayType(LongType()))])

    def emit(part: pa.RecordBatch) -> pa.RecordBatch:
        h, first = span_hashes(part.column("text"), min_sentences, min_words)
        return pa.RecordBatch.from_arrays([part.column("key"), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(h))], names=["key", "spans"])

    return ts.map_slices(rows, "text", emit, schema)


def _key(doc_id: str, text: str):
    """Orders documents by id, nulls last, and tells texts of one id apart."""
    return F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.xxhash64(text).alias("print"))


def covered_sentences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS) -> DataFrame:
    """(none, id, print, starts): sentence numbers, from 0, at which repeated non-first spans of a document start."""
    spans = checkpoint(_span_rows(docs, doc_id, text, min_sentences, min_words))
    flat = spans.select(F.col("key.none").alias("none"), F.col("key.id").alias("id"), F.col("key.print").alias("print"), F.posexplode("spans").alias("p", "h")).where("h <> 0")
    return _starts(flat.join(_repeated(flat), "h").where(_place() != F.col("first")))


def _place():
    return F.struct("none", "id", "print", "p")


def _repeated(flat: DataFrame) -> DataFrame:
    """(h, first) of the hashes that stand at several places."""
    return checkpoint(flat.groupBy("h").agg(F.min(_place()).alias("first"), F.max(_place()).alias("last")).where("first <> last").select("h", "first"))


def _starts(flat: DataFrame) -> DataFrame:
    return flat.groupBy("none", "id", "print").agg(F.collect_set("p").alias("starts"))


def _cleaner(min_sentences: int, min_words: int):
    def clean(column: pa.Array, starts: list) -> tuple[list, list[list[int]], np.ndarray]:
        """Texts without the covered sentences, the numbers of those, and the sentence counts."""
        data, offs = ts.flat(column)
        s = _Sentences(data, offs)
        w = ts.Words(data, offs, ts.SPACES, cuts=s.start)
        at = np.searchsorted(w.start, np.concatenate([s.start, [len(data)]]))
        raw, texts, gone = data.tobytes(), column.to_pylist(), []
        for d, own in enumerate(starts):
            if not own:
                gone.append([])
                continue
            a = np.asarray(own, np.int64) + s.first[d]
            z = np.maximum(np.searchsorted(at, at[a] + min_words), a + min_sentences)
            edges = np.zeros(s.first[d + 1] - s.first[d] + 1, np.int64)
            np.add.at(edges, a - s.first[d], 1)
            np.add.at(edges, z - s.first[d], -1)
            cover = np.cumsum(edges[:-1]) > 0
            gone.append(np.flatnonzero(cover).tolist())
            stay = np.flatnonzero(~cover) + s.first[d]
            texts[d] = b"".join(raw[x:y] for x, y in zip(s.start[stay].tolist(), s.end[stay].tolist())).decode()
        return texts, gone, np.diff(s.first)

    return clean


def _marked(docs: DataFrame, starts: DataFrame, doc_id: str, text: str, found: str, how: str = "left") -> DataFrame:
    """``docs`` with the starts of their document as a column ``found``."""
    keyed = docs.withColumn(found, _key(doc_id, text))
    marks = starts.select(F.struct("none", "id", "print").alias(found), F.col("starts").alias(f"{found}_starts"))
    same = (keyed[found]["none"] == marks[found]["none"]) & keyed[found]["id"].eqNullSafe(marks[found]["id"]) & (keyed[found]["print"] == marks[found]["print"])
    return keyed.join(marks, same, how).select(*[keyed[c] for c in docs.columns], F.col(f"{found}_starts").alias(found))


def substring_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS,
                    found: str = "span_dedup") -> DataFrame:
    """``docs`` with ``text`` cleaned and a struct column ``found``: n_sentences, removed (sentence numbers).

    ``found`` must not be a column of ``docs``.
    """
    if found in docs.columns:
        raise ValueError(f"column {found} exists; name another one in found=")
    starts = covered_sentences(docs, doc_id, text, min_sentences, min_words)
    joined = _marked(docs, starts, doc_id, text, found)
    shape = StructType([StructField("n_sentences", IntegerType()), StructField("removed", ArrayType(IntegerType()))])
    schema = StructType([*docs.schema.fields, StructField(found, shape)])
    clean, where, names = _cleaner(min_sentences, min_words), docs.columns.index(text), docs.columns

    def emit(part: pa.RecordBatch) -> pa.RecordBatch:
        texts, gone, n = clean(part.column(text), part.column(found).to_pylist())
        cols = [part.column(c) for c in names]
        cols[where] = pa.array(texts, pa.string())
        return pa.RecordBatch.from_arrays([*cols, pa.StructArray.from_arrays([pa.array(n, pa.int32()), pa.array(gone, pa.list_(pa.int32()))], names=["n_sentences", "removed"])], names=[*names, found])

    return ts.map_slices(joined, text, emit, schema)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with cleaned texts; documents of which nothing but white space is left go, others keep their row."""
    out = substring_dedup(docs, doc_id, text, found="_span_dedup")
    emptied = (F.size("_span_dedup.removed") > 0) & ~F.col(text).rlike(r"[^\x20\x09-\x0D]")
    return out.where(~emptied).drop("_span_dedup")


def _reach(values: np.ndarray, n: int, pick, none) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) of each value and the n - 1 after it; ``none`` lies behind the end."""
    out, have = values, 1
    while have < n:
        step = min(have, n - have)
        out = pick(out, np.concatenate([out[step:], np.full(min(step, len(out)), none, out.dtype)]))
        have += step
    return out


def _word_runs(w: ts.Words, prefix: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``n`` words from each word on, and whether they lie within its document."""
    at = np.arange(len(w))
    inside = at + n <= np.repeat(w.first[1:], np.diff(w.first))
    return ts.run_hash(prefix, at, np.where(inside, at + n, at)) | ts.U64(1), inside


def _anchors(w: ts.Words, words: int, group: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the groups that are the least of all groups in some window of ``words`` words."""
    prefix, most = ts.run_prefix(w.hashes(ts.byte_prefix(w.data))), ts.U64(0xFFFFFFFFFFFFFFFF)
    h, whole = _word_runs(w, prefix, group)
    n = words - group + 1
    inside = np.arange(len(w)) + words <= np.repeat(w.first[1:], np.diff(w.first))
    least = np.where(inside, _reach(np.where(whole, h, most), n, np.minimum, most), ts.U64(0))  # per window
    top = _reach(least[::-1], n, np.maximum, ts.U64(0))[::-1]  # of the windows that hold the group
    at = np.flatnonzero(whole & (h == top))
    return at, h[at]


def _copies(h: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Which hashes stand earlier in the same document."""
    order = np.lexsort((np.arange(len(h)), h, d))
    out = np.zeros(len(h), bool)
    out[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (d[order[1:]] == d[order[:-1]])
    return out


def _flat_rows(rows: DataFrame, of: str, pick) -> DataFrame:
    """(of, p, h, again) for what ``pick`` chooses of a slice: word numbers and hashes; again: stands earlier in the document."""
    schema = StructType([rows.schema[of], StructField("p", IntegerType()), StructField("h", LongType()), StructField("again", BooleanType())])

    def emit(part: pa.RecordBatch) -> pa.RecordBatch:
        data, offs = ts.flat(part.column("text"))
        w = ts.Words(data, offs, ts.SPACES)
        at, h = pick(w, part)
        d = np.searchsorted(w.first, at, "right") - 1
        return pa.RecordBatch.from_arrays([part.column(of).take(pa.array(d)), pa.array((at - w.first[d]).astype(np.int32)), pa.array(h.view(np.int64)), pa.array(_copies(h, d))], names=[of, "p", "h", "again"])

    return checkpoint(ts.map_slices(rows, "text", emit, schema))


def repeated_windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = PASSAGE, group: int = GROUP) -> DataFrame:
    """(none, id, print, starts): word numbers, from 0, at which ``words`` words start that stand before as well.

    Only documents with repeated groups go on. They are numbered in their order, so a window travels as two numbers.
    """
    if not 0 < group <= words:
        raise ValueError("group must be within 1 and words")
    rows = docs.select(_key(doc_id, text).alias("key"), F.col(text).alias("text"))
    anchors = _flat_rows(rows, "key", lambda w, part: _anchors(w, words, group))
    often = checkpoint(anchors.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"))
    near = checkpoint(_starts(anchors.join(often, "h").select("key.none", "key.id", "key.print", "p")))
    near = checkpoint(near.orderBy("none", "id", "print").withColumn("doc", F.monotonically_increasing_id()))

    def around(w: ts.Words, part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        h, inside = _word_runs(w, ts.run_prefix(w.hashes(ts.byte_prefix(w.data))), words)
        own = part.column("near").field(0)
        first = np.repeat(w.first[:-1], own.value_lengths().to_numpy(zero_copy_only=False))
        a = own.flatten().to_numpy(zero_copy_only=False) + first
        edges = np.zeros(len(w) + 1, np.int64)
        np.add.at(edges, np.maximum(a - (words - group), first), 1)
        np.add.at(edges, a + 1, -1)
        at = np.flatnonzero((np.cumsum(edges[:-1]) > 0) & inside)
        return at, h[at]

    marks = near.select("none", "id", "print", F.struct("starts", "doc").alias("starts"))
    marked = _marked(docs.select(doc_id, text), marks, doc_id, text, "near", "inner")
    flat = _flat_rows(marked.select(F.col(text).alias("text"), "near", F.col("near.doc").alias("doc")), "doc", around)
    fresh = flat.where("NOT again")
    repeated = checkpoint(fresh.groupBy("h").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last").select("h", "first"))
    later = fresh.join(repeated, "h").where(F.col("doc") > F.col("first")).select("doc", "p")
    starts = later.unionByName(flat.where("again").select("doc", "p")).groupBy("doc").agg(F.collect_set("p").alias("starts"))
    return near.drop("starts").join(starts, "doc").drop("doc")


def passage_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = PASSAGE, found: str = "passage_dedup") -> DataFrame:
    """``docs`` without the words, and the white space after them, of repeated windows; ``found``: n_words, n_removed."""
    if found in docs.columns:
        raise ValueError(f"column {found} exists; name another one in found=")
    joined = _marked(docs, repeated_windows(docs, doc_id, text, words, min(GROUP, words)), doc_id, text, found)
    schema = StructType([*docs.schema.fields, StructField(found, StructType([StructField("n_words", IntegerType()), StructField("n_removed", IntegerType())]))])
    where, names = docs.columns.index(text), docs.columns

    def emit(part: pa.RecordBatch) -> pa.RecordBatch:
        column = part.column(text)
        data, offs = ts.flat(column)
        w = ts.Words(data, offs, ts.SPACES)
        texts, gone = column.to_pylist(), np.zeros(len(column), np.int32)
        for d, own in enumerate(part.column(found).to_pylist()):
            if own:
                a, z = w.first[d], w.first[d + 1]
                edges = np.zeros(z - a + 1, np.int64)
                np.add.at(edges, np.asarray(own, np.int64), 1)
                np.add.at(edges, np.asarray(own, np.int64) + words, -1)
                cover = np.cumsum(edges[:-1]) > 0
                stay = np.repeat(np.concatenate([[True], ~cover]), np.diff(np.concatenate([[offs[d]], w.start[a:z], [offs[d + 1]]])))
                texts[d], gone[d] = data[offs[d] : offs[d + 1]][stay].tobytes().decode(), cover.sum()
        cols = [part.column(c) for c in names]
        cols[where] = pa.array(texts, pa.string())
        return pa.RecordBatch.from_arrays([*cols, pa.StructArray.from_arrays([pa.array(np.diff(w.first).astype(np.int32)), pa.array(gone)], names=["n_words", "n_removed"])], names=[*names, found])

    return ts.map_slices(joined, text, emit, schema)
