"""Quality classifier by positive-unlabelled learning with a non-negative unbiased risk.

Trusted positives are labelled documents; everything else is judged from plain web text. With the class prior p,
the risk is p * loss(positives as good) + max(0, loss(unlabelled as bad) - p * loss(positives as bad)); whenever the
second part would turn negative, the step descends from it instead, so the model can't fit the positives away.

A text is described by ``FEATURES``, shares that need one pass over its bytes. Each feature is cut at quantiles of
the sample and becomes one-hot bins of a linear model, so its effect may bend freely.

Fitting reads a bounded sample: at most ``SAMPLE_ROWS`` positives and as many unlabelled documents, those that come first by
a hash of their id; features are made in parallel on whole texts, the numbers of the sample are fitted in one
task. The prior is estimated from the labels given (share of positives, with one of each added).
Scoring reads every row and every whole text.

Rows: each row is scored alone. Null and empty texts are all-zero features. Labels other than 0 and 1 and null
labels are left out; without positives all scores are 0.5. Other columns are never inputs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from wayfold.llm import textscan as ts
from wayfold.llm.quality import _later, _per

FEATURES = ("words", "word_chars", "symbols", "capitals", "digits", "marks", "bars", "ended_lines", "repeated_lines", "repeated_runs", "same_words")
BINS = 12
SAMPLE_ROWS = 20_000
STEPS, RATE, DECAY = 400, 0.1, 3e-3


def features(column: pa.Array) -> np.ndarray:
    """n x len(FEATURES) numbers, one row per text."""
    data, offs = ts.flat(column)
    w = ts.Words(data, offs, ts.SPACES)
    docs, prefix = len(offs) - 1, ts.byte_prefix(data)
    lo, hi = offs[:-1], offs[1:]
    count = lambda chars: _per(ts.table_of(chars)[data], lo, hi)
    n = np.diff(w.first)
    some, size = np.maximum(n, 1), np.maximum(_per(w.inside, lo, hi), 1)
    owner = np.repeat(np.arange(docs), n)
    h = w.hashes(prefix)
    ws, we, wo = ts.windows(w.first, 3, short=False)
    runs = _later(np.repeat(np.arange(docs), np.diff(wo)), ts.run_hash(ts.run_prefix(h), ws, we))[0]
    breaks = data == 10
    n_lines = _per(breaks, lo, hi) + 1
    at = np.flatnonzero(breaks)
    start, end = np.sort(np.concatenate([lo, at + 1])), np.sort(np.concatenate([at, hi]))
    of = np.repeat(np.arange(docs), n_lines)
    filled = end > start
    again = _later(of[filled], ts.span_hash(prefix, start[filled], end[filled]))[0]
    stops = ts.table_of(b".!?")
    ended = np.zeros(len(start), bool)
    ended[filled] = stops[data[end[filled] - 1]]
    capitals, small = count(bytes(range(65, 91))), count(bytes(range(97, 123)))
    lines = np.maximum(np.bincount(of[filled], minlength=docs), 1)
    return np.stack([
        np.log1p(n), size / some, count(b"#*$%&|<>~^=_{}[]\\@") / some, capitals / np.maximum(capitals + small, 1), count(b"0123456789") / size, count(b"!?") / some, count(b"|") / some,
        np.bincount(of[ended], minlength=docs) / lines, np.bincount(of[filled][again], minlength=docs) / lines,
        np.bincount(np.repeat(np.arange(docs), np.diff(wo))[runs], minlength=docs) / some, np.bincount(owner[_later(owner, h)[0]], minlength=docs) / some,
    ], axis=1)


def described(rows: DataFrame, text: str = "text") -> DataFrame:
    """All columns but ``text``, and ``x``: the features."""
    names = [c for c in rows.columns if c != text]
    schema = StructType([*(rows.schema[c] for c in names), StructField("x", ArrayType(DoubleType()))])

    def emit(part: pa.RecordBatch) -> pa.RecordBatch:
        x = features(part.column(text))
        offs = pa.array(np.arange(0, x.size + 1, len(FEATURES)).astype(np.int32))
        return pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.ListArray.from_arrays(offs, pa.array(x.ravel()))], names=[*names, "x"])

    return ts.map_slices(rows, text, emit, schema)


class Model:
    """Cuts of the features and a weight for each bin; ``bias`` last."""

    def __init__(self, cuts: np.ndarray, weights: np.ndarray):
        self.cuts, self.weights = cuts, weights

    @staticmethod
    def bins(x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """n x features: number of the one-hot column that is set."""
        return np.stack([np.searchsorted(cuts[j], x[:, j], "right") + j * BINS for j in range(x.shape[1])], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.weights[self.bins(x, self.cuts)].sum(axis=1) + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def non_negative_fit(good: np.ndarray, web: np.ndarray, prior: float, steps: int = STEPS, rate: float = RATE, decay: float = DECAY) -> Model:
    """Full-batch Adam on the non-negative risk with the logistic loss."""
    width = len(FEATURES) * BINS + 1
    cuts = np.quantile(web, np.arange(1, BINS) / BINS, axis=0).T
    gb, wb = Model.bins(good, cuts), Model.bins(web, cuts)
    theta, m, v = np.zeros(width), np.zeros(width), np.zeros(width)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -35, 35)))
    spread = lambda bins, r: np.append(np.bincount(bins.ravel(), weights=np.repeat(r, bins.shape[1]), minlength=width - 1), r.sum())
    for t in range(1, steps + 1):
        zg, zw = theta[gb].sum(axis=1) + theta[-1], theta[wb].sum(axis=1) + theta[-1]
        bad_risk = np.logaddexp(0, zw).mean() - prior * np.logaddexp(0, zg).mean()
        bad_step = spread(wb, sig(zw)) / len(web) - prior * spread(gb, sig(zg)) / len(good)
        step = prior * spread(gb, sig(zg) - 1) / len(good) + bad_step if bad_risk >= 0 else -bad_step
        step[:-1] += decay * theta[:-1]
        m, v = 0.9 * m + 0.1 * step, 0.999 * v + 0.001 * step * step
        theta = theta - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return Model(cuts, theta)


def fit(docs: DataFrame, labels: DataFrame, label: str, doc_id: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from the labels given and from ``docs`` as unlabelled text."""
    usable = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
    counts = usable.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("p")).first()
    prior = (counts["p"] + 1) / (counts["n"] + 2)
    first = lambda df, salt: df.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("id")).distinct().orderBy(F.xxhash64(F.lit(salt), "id"), "id").limit(sample_rows)
    # two lists of at most sample_rows ids
    chosen = first(usable.where(F.col(label) == 1), "good").withColumn("good", F.lit(1)).unionByName(first(docs, "web").withColumn("good", F.lit(0)))
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")
    sample = described(rows).repartition(1).sortWithinPartitions("good", "id", "x")
    schema = StructType([StructField("cuts", ArrayType(DoubleType())), StructField("weights", ArrayType(DoubleType()))])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, good = [np.zeros((0, len(FEATURES)))], [np.zeros(0, np.int32)]
        for part in batches:
            x.append(part.column("x").flatten().to_numpy().reshape(-1, len(FEATURES)))
            good.append(part.column("good").to_numpy())
        x, good = np.concatenate(x), np.concatenate(good)
        if good.any() and not good.all():
            m = non_negative_fit(x[good == 1], x[good == 0], prior)
            yield pa.RecordBatch.from_arrays([pa.array([m.cuts.ravel().tolist()], pa.list_(pa.float64())), pa.array([m.weights.tolist()], pa.list_(pa.float64()))], names=["cuts", "weights"])

    got = sample.mapInArrow(learn, schema).collect()
    if not got:
        return Model(np.zeros((len(FEATURES), BINS - 1)), np.zeros(len(FEATURES) * BINS + 1))
    return Model(np.array(got[0].cuts).reshape(len(FEATURES), BINS - 1), np.array(got[0].weights))


def quality_scores(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) for every row; higher: more likely good."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = StructType([rows.schema["doc_id"], StructField("score", DoubleType())])
    cuts, weights = model.cuts, model.weights  # a few hundred numbers
    return ts.map_slices(rows, "text", lambda part: pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(Model(cuts, weights).score(features(part.column("text"))))], names=schema.names), schema)
