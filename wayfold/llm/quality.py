"""Quality rules, line first: judge every line, drop failing lines, then reject documents that lost too much.

A line with words fails if it does not end in terminal punctuation, has too many symbols for its words,
looks like a navigation bar, is mostly capitals, holds a boilerplate phrase, or repeats an earlier line
of the document. Independently of the lines a document fails the base rules if it has too few words or
consists largely of repeated word windows.

Rows: each row is judged alone, so repeated rows and ids get equal results. Null and empty texts have no
words, fail the base rules and keep an empty text. All other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from wayfold.llm import textscan as ts

# characters that may end a line, symbols (the contract's), separators of navigation bars, boilerplate phrases
TERMINAL = ".!?:;\"')…”»。！？"
SYMBOLS = "#*$%&|<>"
BARS = "|>"
BOILERPLATE = ("all rights reserved", "cookie policy", "enable javascript", "lorem ipsum", "privacy policy", "sign up for our newsletter", "terms of use")


@dataclass(frozen=True)
class Rules:
    """Limits of the rules; shares are compared in whole numbers (a > b times the limit in percent)."""

    min_words: int = 10
    repeat_window: int = 5
    max_repeat_pct: int = 20
    max_symbols_pct: int = 30  # symbols per 100 words of a line
    min_bars: int = 3
    max_capitals_pct: int = 50  # of a line's ASCII letters
    min_letters: int = 20  # fewer ASCII letters are never called capitals
    max_lost_pct: int = 50  # words of a document in failing lines


def _per(marks: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
    return total[end] - total[start]


def _later(owner: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows with (owner, key): has an equal row before it; has an equal row anywhere."""
    order = np.lexsort((key, owner))
    same = (owner[order][1:] == owner[order][:-1]) & (key[order][1:] == key[order][:-1])
    later, any_ = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order[1:]] = same
    any_[order[1:]] |= same
    any_[order[:-1]] |= same
    return later, any_


class _Lines:
    """Words, lines and verdicts of a slice of texts."""

    def __init__(self, column: pa.Array, rules: Rules):
        data, offs = ts.flat(column)
        self.data, self.offs = data, offs
        w = ts.Words(data, offs, ts.SPACES)
        prefix = ts.byte_prefix(data)
        docs = len(offs) - 1
        self.n_words = np.diff(w.first)
        self.word_chars = _per(w.inside & ((data & 0xC0) != 0x80), offs[:-1], offs[1:])
        symbol = ts.table_of(SYMBOLS.encode())[data]
        self.n_symbols = _per(symbol, offs[:-1], offs[1:])

        breaks = np.flatnonzero(data == 10)
        start = np.sort(np.concatenate([offs[:-1], breaks + 1]))
        end = np.sort(np.concatenate([breaks, offs[1:]]))
        of = np.repeat(np.arange(docs), _per(data == 10, offs[:-1], offs[1:]) + 1)
        low, high = np.searchsorted(w.start, start), np.searchsorted(w.start, end)
        real = high > low
        self.start, self.end, self.of = start, end, of
        # lines with words, equal to an earlier one; the sort is stable, so "earlier" is by position
        dup = np.zeros(len(start), bool)
        dup[real] = _later(of[real], ts.span_hash(prefix, start[real], end[real]))[0]
        self.n_dup_lines = np.bincount(of[dup], minlength=docs)

        hashes = w.hashes(prefix)
        k = rules.repeat_window
        ws, we, wo = ts.windows(w.first, k, short=False)
        again = _later(np.repeat(np.arange(docs), np.diff(wo)), ts.run_hash(ts.run_prefix(hashes), ws, we))[1]
        edges = np.zeros(len(w) + 1, np.int64)
        np.add.at(edges, ws[again], 1)
        np.add.at(edges, we[again], -1)
        covered = np.cumsum(edges[:-1]) > 0
        self.n_repeat_words = _per(covered, w.first[:-1], w.first[1:])

        words = high - low
        fails = dup | (100 * _per(symbol, start, end) > rules.max_symbols_pct * words)
        fails |= _per(ts.table_of(BARS.encode())[data], start, end) >= rules.min_bars
        capital = (data >= 65) & (data <= 90)
        letters = _per(capital | ((data >= 97) & (data <= 122)), start, end)
        fails |= (letters >= rules.min_letters) & (100 * _per(capital, start, end) > rules.max_capitals_pct * letters)
        fails[real] |= ~self._ended(w.end[high[real] - 1])
        raw = ts.LOWER[data].tobytes()
        for phrase in BOILERPLATE:
            at = raw.find(phrase.encode())
            while at >= 0:
                line = int(np.searchsorted(start, at, "right")) - 1
                fails[line] |= at + len(phrase) <= end[line]
                at = raw.find(phrase.encode(), at + 1)
        self.fails = fails & real
        self.lost = np.bincount(of[self.fails], weights=words[self.fails], minlength=docs).astype(np.int64)
        self.base_failed = (self.n_words < rules.min_words) | (100 * self.n_repeat_words > rules.max_repeat_pct * self.n_words)
        self.kept = ~self.base_failed & (100 * self.lost <= rules.max_lost_pct * self.n_words)

    def _ended(self, at: np.ndarray) -> np.ndarray:
        """Is the character that ends before byte ``at`` terminal?"""
        byte = lambda k: np.where(at >= k, self.data[np.maximum(at - k, 0)], 0).astype(np.int64)
        one = byte(1)
        two = byte(2) << 8 | one
        three = byte(3) << 16 | two
        code = lambda n: [int.from_bytes(c.encode(), "big") for c in TERMINAL if len(c.encode()) == n]
        return np.isin(one, code(1)) | np.isin(two, code(2)) | np.isin(three, code(3))

    def cleaned(self) -> list[str]:
        """Texts without their failing lines."""
        raw, out = self.data.tobytes(), [[] for _ in range(len(self.offs) - 1)]
        for s, e, d, bad in zip(self.start.tolist(), self.end.tolist(), self.of.tolist(), self.fails.tolist()):
            if not bad:
                out[d].append(raw[s:e])
        return [b"\n".join(x).decode(errors="replace") for x in out]


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lost_words")


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: Rules = Rules(), with_text: bool = True) -> DataFrame:
    """Per row: ``doc_id``, the counts of ``COUNTS``, ``base_failed``, ``kept`` and, if asked for, ``clean_text``."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = StructType([rows.schema["doc_id"], *(StructField(c, LongType()) for c in COUNTS), StructField("base_failed", BooleanType()), StructField("kept", BooleanType()),
                         *([StructField("clean_text", StringType())] if with_text else [])])

    def judge(part: pa.RecordBatch) -> pa.RecordBatch:
        x = _Lines(part.column("text"), rules)
        cols = [part.column("doc_id"), *(pa.array(c, pa.int64()) for c in (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.lost)),
                pa.array(x.base_failed), pa.array(x.kept)]
        return pa.RecordBatch.from_arrays(cols + ([pa.array(x.cleaned(), pa.string())] if with_text else []), names=schema.names)

    return ts.map_slices(rows, "text", judge, schema)
