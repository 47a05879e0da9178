"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the distinct buckets of its words, pairs of neighbouring words and pairs with one word
between (words are lower-cased runs of letters, digits and non-ASCII characters). FTRL keeps a learning rate per
bucket and an L1 term that leaves most weights at zero, so the model is a short list of (bucket, weight):
at most 2^``BITS`` entries, which is the bound of the one broadcast that scoring needs.

Fitting reads a bounded sample: the ``TRAIN_ROWS`` labelled rows that come first by a hash of their id. Features of
the sample are made in parallel on whole texts; one task then passes over them ``EPOCHS`` times in hash order, so the
model is the same on every run. Scoring reads every row and every whole text.

Rows: each row is scored alone. Null and empty texts have no features and score the model's base rate. Labels
other than 0 and 1, null labels and labels without a document are left out. Without any usable label all scores
are 0.5. Other columns are never inputs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, StructField, StructType

from wayfold.llm import textscan as ts

BITS = 21
#: Labelled rows that the model may learn from.
TRAIN_ROWS = 12_000
EPOCHS = 5
ALPHA, BETA, L1, L2 = 0.5, 1.0, 10.0, 0.1

_BIAS = 1 << BITS
# fixed values: bytes that part words (ASCII other than letters and digits)
_BREAKS = np.ones(256, bool)
_BREAKS[128:] = False
_BREAKS[0x30:0x3A] = False
_BREAKS[0x61:0x7B] = False


def gram_buckets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(document number, bucket) of every word, word pair and skip pair, repeats included."""
    data, offs = ts.flat(column)
    low = ts.LOWER[data]
    w = ts.Words(low, offs, _BREAKS)
    h = w.hashes(ts.byte_prefix(low))
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(w.first))
    grams, owners = [h], [doc]
    for gap, salt in ((1, 0x9FB21C651E98DF25), (2, 0xC2B2AE3D27D4EB4F)):
        inside = doc[gap:] == doc[:-gap]
        grams.append(ts.mix(h[:-gap][inside] * ts.U64(salt) ^ h[gap:][inside]))
        owners.append(doc[gap:][inside])
    return np.concatenate(owners), (np.concatenate(grams) >> ts.U64(64 - BITS)).astype(np.int64)


def _features(rows: DataFrame) -> DataFrame:
    """(order, label, buckets) for rows (order, label, text)."""
    schema = StructType([rows.schema["order"], rows.schema["label"], StructField("buckets", ArrayType(IntegerType()))])

    def emit(part: pa.RecordBatch) -> pa.RecordBatch:
        doc, bucket = gram_buckets(part.column("text"))
        both = np.unique(doc << BITS | bucket)
        offs = np.searchsorted(both >> BITS, np.arange(part.num_rows + 1)).astype(np.int32)
        return pa.RecordBatch.from_arrays([part.column("order"), part.column("label"), pa.ListArray.from_arrays(pa.array(offs), pa.array((both & (_BIAS - 1)).astype(np.int32)))],
                                          names=schema.names)

    return ts.map_slices(rows, "text", emit, schema)


def ftrl(examples: list[tuple[int, np.ndarray]], epochs: int, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> np.ndarray:
    """Weights by bucket, the bias last (it has no L1 term)."""
    z, n = np.zeros(_BIAS + 1), np.zeros(_BIAS + 1)
    thrift = np.full(_BIAS + 1, l1)
    thrift[_BIAS] = 0
    weight = lambda i: np.where(np.abs(z[i]) <= thrift[i], 0.0, (np.sign(z[i]) * thrift[i] - z[i]) / ((beta + np.sqrt(n[i])) / alpha + l2))
    for _ in range(epochs):
        for label, buckets in examples:
            i = np.append(buckets, _BIAS)
            w = weight(i)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha * w
            n[i] += g * g
    return weight(np.arange(_BIAS + 1))


def fit(docs: DataFrame, labels: DataFrame, label: str, doc_id: str = "doc_id", text: str = "text", train_rows: int = TRAIN_ROWS, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, weights), sorted by bucket; only weights other than zero."""
    order = F.struct(F.xxhash64(F.lit("toxicity"), F.col(doc_id)), F.col(doc_id), F.col(label).cast("int"))
    chosen = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"), order.alias("order")).orderBy("order").limit(train_rows)
    # at most train_rows rows of a few numbers
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id").select("order", "label", "text")
    examples = _features(rows).repartition(1).sortWithinPartitions("order", F.hash("buckets"))
    schema = StructType([StructField("bucket", IntegerType()), StructField("weight", FloatType())])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [(y, np.asarray(b)) for part in batches for y, b in zip(part.column("label").to_pylist(), part.column("buckets").to_numpy(zero_copy_only=False))]
        if seen:
            w = ftrl(seen, epochs)
            at = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(w[at].astype(np.float32))], names=["bucket", "weight"])

    got = examples.mapInArrow(learn, schema).toArrow()
    at = got.column("bucket").to_numpy()
    by = np.argsort(at)
    return at[by], got.column("weight").to_numpy()[by].astype(np.float64)


class Scorer:
    """Scores slices in a task from a broadcast model."""

    def __init__(self, spark, model: tuple[np.ndarray, np.ndarray]):
        self.model, self.dense = spark.sparkContext.broadcast(model), None

    def __call__(self, column: pa.Array) -> np.ndarray:
        if self.dense is None:
            self.dense = np.zeros(_BIAS + 1)
            at, w = self.model.value
            self.dense[at] = w
        doc, bucket = gram_buckets(column)
        live = self.dense[bucket] != 0
        both = np.unique(doc[live] << BITS | bucket[live])
        total = np.bincount(both >> BITS, weights=self.dense[both & (_BIAS - 1)], minlength=len(column)) + self.dense[_BIAS]
        return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def toxicity_scores(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) for every row; higher: more likely toxic."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = StructType([rows.schema["doc_id"], StructField("score", DoubleType())])
    score = Scorer(docs.sparkSession, model)
    return ts.map_slices(rows, "text", lambda part: pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score(part.column("text")))], names=schema.names), schema)


def mild_documents(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], text: str = "text", below: float = 0.3) -> DataFrame:
    """The rows of ``docs``, all columns, that score under ``below``."""
    score = Scorer(docs.sparkSession, model)
    return ts.map_slices(docs, text, lambda part: part.filter(pa.array(score(part.column(text)) < below)), docs.schema)


def held_out(doc_id: str, parts: int, part: int) -> Column:
    """Rows whose labels are never learnt from: crc32 of the id as text leaves ``part``; null ids as well."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts == part, F.lit(True))
