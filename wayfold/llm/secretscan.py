"""Secret scans: base patterns, and a linear-chain conditional random field that finds what they miss.

Base patterns give spans that always stay. The field tags every token of a text as begin, inside or outside of a secret.
A token's features are its shape (length, classes of characters, digits, changes of class, hexadecimal or not), the
words beside it, the signs between it and them, and what kind of file it stands in (shares of digits and of
assignments). Tokens are runs of bytes other than white space, quotes, brackets, commas and ``:;=<>|``.

Learning is supervised by the base patterns on a bounded sample: ``TRAIN_DOCS`` texts with a secret and as many without,
the first by a hash, one excerpt each (around a secret; else around the longest token, for half of the texts, or
anywhere). So that the field does not just repeat the patterns, every excerpt is also
learnt with its key word replaced by an unknown one, with the secret written in other characters, with both, and with an
ordinary word or several joined in the secret's place (then it is none). The likelihood is exact (forward-backward), its gradient is
followed for ``ROUNDS`` rounds in one task.

Decoding is Viterbi's algorithm. A token whose outside score leads by more than any two transitions can give back is
outside on every best path, which cuts a text into short chains; all chains of a slice are decoded together.

Memory: the model is a table of about 17 000 x 3 numbers, broadcast; a task sees one slice of text at a time.

Rows: each row is judged alone, so repeated rows and ids get equal results. Null and empty texts have no spans. Without
any base secret in the corpus the field adds nothing. Other columns are ignored. Positions count code points.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, FloatType, IntegerType, LongType, StringType, StructField, StructType

from wayfold.llm import textscan as ts

#: Texts with, and texts without a base secret that the model may learn from.
TRAIN_DOCS = 600
ROUNDS, RATE, L2 = 60, 0.2, 1e-3
#: Bytes of an excerpt before and after the place that was chosen.
BEFORE, AFTER = 120, 80
WORD_BITS = 12
OUT, BEGIN, INSIDE = 0, 1, 2

# fixed values: the base patterns, in the order of their kinds; the group whose length counts, and its least length
BASE = (
    ("assign", re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE), 2, 6),
    ("access", re.compile(rb"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(rb"[0-9a-f]+"), 0, 24),
)
FIELD = "field"
KINDS = [b[0] for b in BASE] + [FIELD]

_BREAKS = ts.SPACES | ts.table_of(b"\"'`()[]{},:;=<>|")
_DIGIT, _UPPER, _LOWER = ts.table_of(b"0123456789"), ts.table_of(bytes(range(65, 91))), ts.table_of(bytes(range(97, 123)))
_HEX = ts.table_of(b"0123456789abcdef")
_HIGH = np.arange(256) >= 128
_CLASS = (_DIGIT * 1 + _UPPER * 2 + _LOWER * 3 + _HIGH * 4).astype(np.int8)
_KEYS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_HEX_RUN = bytes(120 if _HEX[i] else 46 for i in range(256))
_LENGTHS = np.array([2, 3, 5, 8, 12, 16, 20, 24, 32, 40, 64])
_SHARES = np.array([1, 20, 40, 70])

# tables of features, one entry of each per token
_SIZES = {"shape": 12 * 32, "digits": 12 * 5, "changes": 12 * 5, "hex": 12 * 2, "word": 1 << WORD_BITS, "before": 1 << WORD_BITS, "before2": 1 << WORD_BITS, "after": 1 << WORD_BITS,
          "gap": 12 * 8, "gap_after": 12 * 8, "file": 12 * 16, "classes": 32, "digit_share": 5, "change_share": 5}
_STARTS = dict(zip(_SIZES, np.concatenate([[0], np.cumsum(list(_SIZES.values()))[:-1]])))
N_FEATURES = sum(_SIZES.values())


def base_matches(raw: bytes) -> list[tuple[int, int, int, int, int]]:
    """(kind number, start, end, start of the secret, its end) in bytes, by start, then kind; failing matches are dropped."""
    low, out = raw.lower(), []
    wanted = (any(k in low for k in _KEYS), b"AKIA" in raw, b"x" * 24 in raw.translate(_HEX_RUN))
    for kind, (_, pattern, group, least) in enumerate(BASE):
        if wanted[kind]:
            out += [(kind, *m.span(), *m.span(group)) for m in pattern.finditer(raw) if m.end(group) - m.start(group) >= least]
    return sorted(out, key=lambda m: (m[1], m[0]))


class Tokens:
    """Tokens of a slice, and the features of each: an array (token, table) of entries of the weight table."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, file: np.ndarray | None = None):
        low = ts.LOWER[data]
        w = self.words = ts.Words(data, offs, _BREAKS)
        n = len(w)
        count = lambda marks: np.concatenate([[0], np.cumsum(marks, dtype=np.int32)])
        own = lambda c: c[w.end] - c[w.start]
        kind = _CLASS[data]
        digits, upper, lower, high, hexes = (count(t[data]) for t in (_DIGIT, _UPPER, _LOWER, _HIGH, _HEX))
        change = np.zeros(len(data), bool)
        change[1:] = kind[1:] != kind[:-1]
        changes, signs = count(change), count(ts.table_of(b":=")[data])
        quotes, lines = count(ts.table_of(b"\"'`")[data]), count(data == 10)
        if file is None:
            per_doc = lambda c: c[offs[1:]] - c[offs[:-1]]
            size, words = np.maximum(np.diff(offs), 1), np.maximum(np.diff(w.first), 1)
            file = np.minimum(per_doc(digits) * 40 // size, 3) * 4 + np.minimum(per_doc(signs) * 10 // words, 3)
        doc = np.repeat(np.arange(len(offs) - 1), np.diff(w.first))
        length = w.end - w.start
        size = np.searchsorted(_LENGTHS, length, "right")
        n_digits, n_upper, n_lower, n_high = own(digits), own(upper), own(lower), own(high)
        symbols = length - n_digits - n_upper - n_lower - n_high
        shape = (n_digits > 0) * 1 + (n_upper > 0) * 2 + (n_lower > 0) * 4 + (n_high > 0) * 8 + (symbols > 0) * 16
        inner = changes[w.end] - changes[np.minimum(w.start + 1, len(data))] if n else length
        hashes = (ts.span_hash(ts.byte_prefix(low), w.start, w.end) >> ts.U64(64 - WORD_BITS)).astype(np.int64)
        hashes[length > 16] = 0
        first = np.zeros(n + 1, bool)
        first[w.first] = True
        left = lambda x, edge: np.where(first[:n], edge, np.concatenate([[edge], x[:-1]])) if n else x
        before = left(hashes, 1)
        before2 = np.where(first[:n], 1, left(before, 1))
        after = np.where(first[1:], 1, np.concatenate([hashes[1:], [1]])) if n else hashes
        # from the end of the token before, or of the text
        since = left(w.end, 0)
        since = np.where(first[:n], offs[doc], since) if n else since
        until = np.where(first[1:], offs[doc + 1], np.concatenate([w.start[1:], [0]])) if n else since
        between = lambda c, a, b: np.minimum(c[b] - c[a], 1)
        gap = between(signs, since, w.start) + 2 * between(quotes, since, w.start) + 4 * between(lines, since, w.start)
        gap_after = between(signs, w.end, until) + 2 * between(quotes, w.end, until) + 4 * between(lines, w.end, until)
        self.file = file
        share = lambda part: np.searchsorted(_SHARES, 100 * part // np.maximum(length, 1), "right")
        digit_share, change_share = share(n_digits), share(inner)
        per = {"shape": size * 32 + shape, "digits": size * 5 + digit_share, "changes": size * 5 + change_share, "classes": shape, "digit_share": digit_share, "change_share": change_share, "hex": size * 2 + (own(hexes) == length),
               "word": hashes, "before": before, "before2": before2, "after": after, "gap": size * 8 + gap, "gap_after": size * 8 + gap_after, "file": size * 16 + file[doc]}
        self.features = np.stack([per[k] + _STARTS[k] for k in _SIZES], axis=1).astype(np.int32) if n else np.zeros((0, len(_SIZES)), np.int32)


# ---------------------------------------------------------------- learning


def _variants(raw: bytes, start: int, end: int, seed: int) -> Iterator[tuple[bytes, int, int]]:
    """An excerpt with the secret at start to end, and what else is learnt from it; an empty span: no secret."""
    rnd = np.random.default_rng(seed)
    letters = b"abcdefghijklmnopqrstuvwxyz"
    pick = lambda chars, n: bytes(chars[i] for i in rnd.integers(0, len(chars), n))
    key = next((m for m in re.finditer(rb"[A-Za-z_]+", raw[:start][::-1])), None)
    at = (start - key.end(), start - key.start()) if key else (start, start)
    masked = lambda secret: (head := raw[: at[0]] + pick(letters, int(rnd.integers(4, 10))) + raw[at[1] : start]) and (head + secret + raw[end:], len(head), len(head) + len(secret))
    other = pick(letters + letters.upper() + b"0123456789", int(rnd.integers(16, 44)))
    some = [w for w in re.findall(rb"[A-Za-z]{3,}", raw[:start] + b" " + raw[end:])] or [b"word"]
    word = b"".join(some[i] for i in rnd.integers(0, len(some), int(rnd.integers(1, 6))))  # also a long compound
    yield raw, start, end
    yield raw[:start] + other + raw[end:], start, start + len(other)
    yield masked(raw[start:end])
    yield masked(other)
    yield raw[:start] + word + raw[end:], 0, 0


def _chains(excerpts: list[tuple[bytes, int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, tags, lengths) of excerpts and all their variants, padded to the longest."""
    raws, spans, files = [], [], []
    for k, (raw, file, at) in enumerate(excerpts):
        secrets = [m[3:] for m in base_matches(raw) if m[3] <= at < m[4]]
        for text, a, b in _variants(raw, *secrets[0], k) if secrets else [(raw, 0, 0)]:
            raws.append(text)
            spans.append((a, b))
            files.append(file)
    offs = np.concatenate([[0], np.cumsum([len(r) for r in raws])])
    t = Tokens(np.frombuffer(b"".join(raws), np.uint8), offs, np.array(files))
    first, n = t.words.first, np.diff(t.words.first)
    longest = int(n.max(initial=1))
    x, y = np.zeros((len(raws), longest, len(_SIZES)), np.int32), np.zeros((len(raws), longest), np.int8)
    for k, (a, b) in enumerate(spans):
        own = slice(first[k], first[k + 1])
        x[k, : n[k]] = t.features[own]
        start, end = t.words.start[own] - offs[k], t.words.end[own] - offs[k]
        held = np.flatnonzero((start < b) & (end > a))
        y[k, held] = INSIDE
        y[k, held[:1]] = BEGIN
    return x, y, n


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def likelihood(scores: np.ndarray, moves: np.ndarray, tags: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log likelihood of tagged chains that start and end outside, and its gradients by scores and by moves."""
    rows, longest, states = scores.shape
    live = np.arange(longest) < n[:, None]
    ahead, behind = np.zeros_like(scores), np.zeros_like(scores)
    ahead[:, 0] = scores[:, 0] + moves[OUT]
    for t in range(1, longest):
        ahead[:, t] = np.where(live[:, t, None], scores[:, t] + _log_sum(ahead[:, t - 1, :, None] + moves, 1), ahead[:, t - 1])
    total = _log_sum(ahead[:, -1] + moves[:, OUT], 1)
    behind[:, -1] = moves[:, OUT]
    for t in range(longest - 2, -1, -1):
        on = _log_sum(moves + (scores[:, t + 1] + behind[:, t + 1])[:, None], 2)
        behind[:, t] = np.where(live[:, t + 1, None], on, behind[:, t + 1])
    here = np.exp(ahead + behind - total[:, None, None])
    chosen = np.eye(states)[tags] * live[:, :, None]
    by_score = chosen - here * live[:, :, None]
    by_move = np.zeros_like(moves)
    by_move[OUT] += by_score[:, 0].sum(axis=0)
    ends = np.maximum(n - 1, 0)
    by_move[:, OUT] += by_score[np.arange(rows), ends].sum(axis=0)
    for t in range(1, longest):
        pair = np.exp(ahead[:, t - 1, :, None] + moves + (scores[:, t] + behind[:, t])[:, None] - total[:, None, None])
        by_move += ((chosen[:, t - 1, :, None] * chosen[:, t, None] - pair) * live[:, t, None, None]).sum(axis=0)
    last = tags[np.arange(rows), ends]
    own = (scores * chosen).sum() + moves[OUT, tags[:, 0]].sum() + moves[last, OUT].sum() + (moves[tags[:, :-1], tags[:, 1:]] * live[:, 1:]).sum()
    return float(own - total.sum()), by_score, by_move


def learn(excerpts: list[tuple[bytes, int, int]], rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(weights, moves) from excerpts (bytes, kind of file, byte at which a secret was seen)."""
    x, y, n = _chains([e for e in excerpts])
    keep = n > 0
    x, y, n = x[keep], y[keep], n[keep]
    live = np.arange(x.shape[1]) < n[:, None]
    sizes = [N_FEATURES * 3, 9]
    theta = np.zeros(sum(sizes))
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    flat = x[live]
    for k in range(1, rounds + 1):
        weights, moves = theta[: sizes[0]].reshape(N_FEATURES, 3), theta[sizes[0] :].reshape(3, 3)
        scores = weights[x].sum(axis=2)
        _, by_score, by_move = likelihood(scores, moves, y, n)
        g = by_score[live]
        by_weight = np.stack([np.bincount(flat.ravel(), np.repeat(g[:, s], flat.shape[1]), N_FEATURES) for s in range(3)], axis=1)
        grad = np.concatenate([by_weight.ravel(), by_move.ravel()]) / len(n) - L2 * theta
        # steps scaled by running moments of the gradient
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad * grad
        theta = theta + RATE * (mean / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-8)
    return theta[: sizes[0]].reshape(N_FEATURES, 3).astype(np.float32), theta[sizes[0] :].reshape(3, 3)


def _excerpts(rows: DataFrame) -> DataFrame:
    """(order, positive, raw, file, at): one excerpt of every row (order, text)."""
    schema = StructType([StructField("order", LongType()), StructField("positive", BooleanType()), StructField("raw", BinaryType()), StructField("file", IntegerType()), StructField("at", IntegerType())])

    def emit(part: pa.RecordBatch) -> pa.RecordBatch:
        data, offs = ts.flat(part.column("text"))
        t, out = Tokens(data, offs), []
        first, length = t.words.first, t.words.end - t.words.start
        for k, order in enumerate(part.column("order").to_pylist()):
            raw = data[offs[k] : offs[k + 1]].tobytes()
            if not raw:
                continue
            found = base_matches(raw)
            at = order // 2 % len(raw)
            if found:
                at = found[order % len(found)][3]
            elif order % 2 and first[k] < first[k + 1]:
                at = int(t.words.start[first[k] + length[first[k] : first[k + 1]].argmax()] - offs[k])
            start = max(0, at - BEFORE)
            end = (found[order % len(found)][4] if found else at) + AFTER
            out.append((order, bool(found), raw[start:end], int(t.file[k]), at - start))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, [pa.int64(), pa.bool_(), pa.binary(), pa.int32(), pa.int32()])], names=schema.names)

    return ts.map_slices(rows, "text", emit, schema)


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", train_docs: int = TRAIN_DOCS, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """The field, learnt from the first ``train_docs`` texts of either kind by a hash; the part of the table that is read for them widens until it holds enough."""
    whole = 1 << 62
    rows = docs.select(F.shiftrightunsigned(F.xxhash64(F.lit("secrets"), F.col(doc_id), F.col(text)), 2).alias("order"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    share = min(1.0, 4 * train_docs / max(1, docs.count()))
    schema = StructType([StructField("weights", ArrayType(FloatType())), StructField("moves", ArrayType(FloatType())), StructField("seen", IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [(r["raw"], r["file"], r["at"]) for b in batches for r in b.to_pylist()]
        positive = sum(any(m[3] <= at < m[4] for m in base_matches(raw)) for raw, _, at in seen)
        if positive:
            weights, moves = learn(seen, rounds)
            yield pa.RecordBatch.from_arrays([pa.array([weights.ravel().tolist()], pa.list_(pa.float32())), pa.array([moves.ravel().tolist()], pa.list_(pa.float32())), pa.array([positive], pa.int32())], names=schema.names)

    while True:
        # a bounded number of rows leaves each kind, in expectation at most some times train_docs
        part = _excerpts(rows.where(F.col("order") < F.lit(int(share * whole)))).dropDuplicates(["order"])
        chosen = [part.where(F.col("positive") == p).orderBy("order").limit(train_docs) for p in (True, False)]
        if share < 1 and chosen[0].count() < train_docs:
            share = min(1.0, 16 * share)
            continue
        model = chosen[0].unionByName(chosen[1]).repartition(1).sortWithinPartitions("order").mapInArrow(run, schema).collect()
        if not model:
            return np.zeros((N_FEATURES, 3), np.float32), np.zeros((3, 3))
        return np.array(model[0].weights, np.float32).reshape(N_FEATURES, 3), np.array(model[0].moves, np.float64).reshape(3, 3)


# ---------------------------------------------------------------- decoding


def viterbi(scores: np.ndarray, moves: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Best tags of all tokens; chains of tokens start to end lie between outside states, tokens in no chain are outside."""
    tags = np.zeros(len(scores), np.int8)
    order = np.argsort(start - end, kind="stable")
    start, n = start[order], (end - start)[order]
    longest = int(n.max(initial=0))
    back = np.zeros((len(scores), 3), np.int8)
    at = np.zeros((len(start), 3))
    at[:] = moves[OUT]
    for t in range(longest):
        m = int(np.searchsorted(-n, -t, "left"))  # chains with a token t
        if t:
            ways = at[:m, :, None] + moves
            back[start[:m] + t] = ways.argmax(axis=1)
            at[:m] = ways.max(axis=1)
        at[:m] += scores[start[:m] + t]
    tag = (at + moves[:, OUT]).argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        m = int(np.searchsorted(-n, -t, "left"))
        tags[start[:m] + t] = tag[:m]
        tag[:m] = back[start[:m] + t, tag[:m]]
    return tags


def decode(scores: np.ndarray, moves: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Tags of the tokens of texts ``first[d]`` to ``first[d + 1]``."""
    n = len(scores)
    gain = np.array([(moves[:, s] - moves[:, OUT]).max() + (moves[s] - moves[OUT]).max() for s in (BEGIN, INSIDE)])
    sure = ((scores[:, :1] - scores[:, 1:]) > gain).all(axis=1)
    edge = np.zeros(n + 1, bool)
    edge[first] = True
    open_ = ~sure
    start = np.flatnonzero(open_ & (edge[:n] | np.concatenate([[True], sure[:-1]]))) if n else np.zeros(0, int)
    end = np.flatnonzero(open_ & (edge[1:] | np.concatenate([sure[1:], [True]]))) + 1 if n else start
    return viterbi(scores, moves, start, end)


class Scanner:
    """Finds the spans of slices in a task from a broadcast model."""

    def __init__(self, spark, model: tuple[np.ndarray, np.ndarray]):
        self.model = spark.sparkContext.broadcast(model)

    def __call__(self, column: pa.Array) -> list[list[tuple[str, int, int]]]:
        data, offs = ts.flat(column)
        weights, moves = self.model.value
        t = Tokens(data, offs)
        begin = end = text_of = np.zeros(0, np.int64)
        if weights.any():
            scores = np.zeros((len(t.words), 3), np.float64)
            for k in range(len(_SIZES)):
                scores += weights[t.features[:, k]]
            tags = decode(scores, moves, t.words.first)
            edge = np.zeros(len(tags) + 1, bool)
            edge[t.words.first] = True
            held = tags != OUT
            fresh = held & ((tags == BEGIN) | edge[:-1] | ~np.concatenate([[False], held[:-1]])) if len(tags) else held
            last = held & np.concatenate([fresh[1:] | ~held[1:], [True]]) | held & edge[1:] if len(tags) else held
            begin, end = t.words.start[fresh], t.words.end[last]
            text_of = np.searchsorted(offs, begin, "right") - 1
        starts = np.searchsorted(text_of, np.arange(len(offs)))
        out = []
        for k in range(len(offs) - 1):
            raw = data[offs[k] : offs[k + 1]].tobytes()
            base = base_matches(raw)
            spans = [(kind, a, b) for kind, a, b, _, _ in base]
            for a, b in zip(begin[starts[k] : starts[k + 1]] - offs[k], end[starts[k] : starts[k + 1]] - offs[k]):
                b = a + len(raw[a:b].rstrip(b".!?"))
                if b > a and not any(x < b and y > a for _, x, y, _, _ in base):
                    spans.append((len(BASE), int(a), int(b)))
            spans.sort(key=lambda s: (s[1], s[0]))
            if spans and not raw.isascii():
                points = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
                spans = [(kind, int(points[a]), int(points[b])) for kind, a, b in spans]
            out.append([(KINDS[kind], a, b) for kind, a, b in spans])
        return out


SPAN = StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType())])


def secret_spans(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans): kind, start and end (exclusive) of every secret, by start, then kind; the field's spans lie outside of the base ones."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = StructType([rows.schema["doc_id"], StructField("spans", ArrayType(SPAN))])
    scan = Scanner(docs.sparkSession, model)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def emit(part: pa.RecordBatch) -> pa.RecordBatch:
        found = [[dict(zip(SPAN.names, s)) for s in spans] for spans in scan(part.column("text"))]
        return pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, kind)], names=schema.names)

    return ts.map_slices(rows, "text", emit, schema)


def without_secrets(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], text: str = "text", mark: str = "[secret]") -> DataFrame:
    """The rows of ``docs``, all columns; every span of the text, or of several that overlap, is replaced by ``mark``."""
    scan = Scanner(docs.sparkSession, model)

    def emit(part: pa.RecordBatch) -> pa.RecordBatch:
        column, texts = part.column(text), []
        for t, spans in zip(column.to_pylist(), scan(column)):
            pieces, at = [], 0
            for _, a, b in spans:
                if a >= at:
                    pieces += [t[at:a], mark]
                at = max(at, b)
            texts.append(t if t is None else "".join(pieces) + t[at:])
        return part.set_column(part.schema.get_field_index(text), part.schema.field(text), pa.array(texts, column.type))

    return ts.map_slices(docs, text, emit, docs.schema)
