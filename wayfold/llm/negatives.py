"""Hard negatives by slot-decomposed selection.

An anchor's positives are its best rows of the same label. For each positive the negatives wanted are the best rows
of other labels whose score lies in a window below the positive's own: the windows of one anchor overlap, and each is
given by its upper limit first. So:

1. Anchors (a stated query set) meet all rows in tiles: a task holds the anchors of one tile and streams the rows past
   them. The ``positives`` best of each tile are ranked again over all tiles.
2. The distinct upper limits of an anchor's positives cut the scores into disjoint slots. A second pass over the tiles
   keeps the ``negatives`` best of every slot: a row belongs to one slot, however many windows hold it.
3. Slots are merged from the lowest up: the best of slot j and of the merge below it answer every window with the upper
   limit j; what lies under the window's lower limit falls off the end.

Scores are inner products of the components ``floor(scale * x)``, as whole numbers of 64 bits; they are exact as long as
they fit, and wrap beyond. Larger scores come first, ties by the smaller id.

A tile's memory is its anchors (``ANCHORS``), what they keep, and one batch of rows. Nothing is dealt by label or
vector, so neither a frequent label nor equal vectors make a hot task. Each row is sent once for every ``ANCHORS``
anchors, each anchor once for every ``ROWS`` rows.

Rows: those with a null id, label or vector, or with a null or non-finite component, take no part, nor do ids that are not
whole numbers. Of rows that share
an id the least one by label, then vector, takes part, once. A vector that is shorter than another one counts as zero
where it ends. Anchors without positives, or whose windows hold no row, return nothing. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from wayfold.session import checkpoint

#: Rows and anchors of a tile, at most; fewer rows where that gives idle cores work.
ROWS, ANCHORS = 65_536, 8_192
#: Scores that a task looks at together.
CELLS = 1 << 21

_NONE = np.iinfo(np.int64).min
_FOUND = StructType([StructField("anchor_id", LongType()), StructField("slot", IntegerType()), StructField("id", LongType()), StructField("score", LongType())])


def usable(rows: DataFrame, vec_id: str, label: str, vector: str) -> DataFrame:
    """(id, label, vec) of the rows that take part; ids may still repeat."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    number = F.col(vec_id).try_cast("long")
    return rows.where(number.isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & sound).select(
        number.alias("id"), F.col(label).alias("label"), F.col(vector).alias("vec"))


class _Best:
    """The ``k`` best (score, id) of every group, gathered from batches of candidates."""

    def __init__(self, groups: int, k: int):
        self.groups, self.k = groups, k
        self.kept = [np.zeros(0, np.int64)] * 3
        self.new: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting = 0
        self.least = np.full(groups, _NONE)  # no score under it can still enter

    def add(self, group: np.ndarray, score: np.ndarray, row: np.ndarray) -> None:
        self.new.append((group, score, row))
        self.waiting += len(group)
        if self.waiting > max(CELLS // 8, len(self.kept[0])):
            self.settle()

    def settle(self) -> list[np.ndarray]:
        group, score, row = (np.concatenate([x, *y]) for x, y in zip(self.kept, zip(*self.new))) if self.new else self.kept
        # ~score reverses the order without overflow
        by = np.lexsort((row, ~score, group))
        first = np.searchsorted(group[by], np.arange(self.groups))
        by = by[np.arange(len(by)) - first[group[by]] < self.k]
        self.kept, self.new, self.waiting = [x[by] for x in (group, score, row)], [], 0
        full = np.bincount(self.kept[0], minlength=self.groups) == self.k
        self.least[full] = self.kept[1][np.cumsum(np.bincount(self.kept[0], minlength=self.groups))[full] - 1]
        return self.kept


def _codes(column: pa.Array, scale: float) -> np.ndarray:
    """Whole components, one row each, zeros where a vector is shorter than the longest."""
    offs = column.offsets.to_numpy()
    size = np.diff(offs)
    flat = np.floor(scale * column.values.to_numpy(zero_copy_only=False)[offs[0] : offs[-1]].astype(np.float64))
    out = np.zeros((len(size), int(size.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < size[:, None]] = np.clip(flat, -(2.0**62), 2.0**62).astype(np.int64)
    return out


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    n = min(a.shape[1], b.shape[1])
    a, b = a[:, :n], b[:, :n]
    if not n:
        return np.zeros((len(a), len(b)), np.int64)
    reach = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * n
    # whole numbers under 2^53 are exact as doubles
    return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64) if reach < 2.0**53 else a @ b.T


class _Tile:
    """The anchors of a tile and the best rows of each of their slots so far."""

    def __init__(self, anchors: list[pa.RecordBatch], k: int, scale: float, same: bool):
        t = pa.Table.from_batches(anchors).combine_chunks()
        col = lambda n: t.column(n).chunk(0)
        self.id, self.label, self.same = col("id").to_numpy(), np.asarray(col("label")), same
        self.codes = _codes(col("vec"), scale)
        limits = col("limits").to_pylist()
        self.slots = max(map(len, limits))
        # unused slots are empty: nothing is at most the smallest number and above it
        self.top = np.array([x + [_NONE] * (self.slots - len(x)) for x in limits], np.int64).reshape(len(limits), self.slots)
        self.least = col("least").to_numpy()
        self.best = _Best(len(limits) * self.slots, k)

    def meet(self, row: np.ndarray, label: np.ndarray, codes: np.ndarray) -> None:
        step = max(1, CELLS // max(1, len(row)))
        for at in range(0, len(self.id), step):
            part = slice(at, min(at + step, len(self.id)))
            score = _scores(self.codes[part], codes)
            fits = (self.label[part, None] == label) == self.same
            fits &= (score >= self.least[part, None]) & (self.id[part, None] != row)
            for j in range(self.slots):
                group = np.arange(part.start, part.stop) * self.slots + j
                own = fits & (score <= self.top[part, j, None])
                if j + 1 < self.slots:
                    own &= score > self.top[part, j + 1, None]
                floor = self.best.least[group]
                if len(row) > self.best.k:
                    floor = np.maximum(floor, np.partition(np.where(own, score, _NONE), len(row) - self.best.k, axis=1)[:, len(row) - self.best.k])
                a, b = np.nonzero(own & (score >= floor[:, None]))
                self.best.add(group[a], score[a, b], row[b])

    def rows(self) -> pa.RecordBatch:
        group, score, row = self.best.settle()
        return pa.RecordBatch.from_arrays([pa.array(self.id[group // self.slots]), pa.array((group % self.slots).astype(np.int32)), pa.array(row), pa.array(score)], names=_FOUND.names)


def _select(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, k: int, scale: float, same: bool) -> DataFrame:
    """(anchor_id, slot, id, score): the ``k`` best rows of every slot of every anchor (id, label, vec, limits, least)."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    rows_per = min(ROWS, max(1024, n_rows // (2 * cores)))
    across, down = -(-n_anchors // ANCHORS) or 1, -(-n_rows // rows_per) or 1
    slot_type = anchors.schema["limits"].dataType
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    held = anchors.select(F.lit(0).alias("kind"), dealt(across).alias("across"), spread(down).alias("down"), "id", "label", "vec", "limits", "least")
    past = rows.select(F.lit(1).alias("kind"), spread(across).alias("across"), dealt(down).alias("down"), "id", "label", "vec",
                       F.lit(None).cast(slot_type).alias("limits"), F.lit(None).cast("long").alias("least"))
    tiles = held.unionByName(past).repartition(across * down, "across", "down").sortWithinPartitions("across", "down", "kind", "id", "label", "vec")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, anchors_of, tile, last = None, [], None, None
        for whole in batches:
            across, down, kind = (whole.column(i).to_numpy() for i in (1, 2, 0))
            edges = np.flatnonzero((np.diff(across) != 0) | (np.diff(down) != 0) | (np.diff(kind) != 0)) + 1
            for at, to in zip([0, *edges], [*edges, whole.num_rows]):
                part = whole.slice(at, to - at)
                if key != (here := (across[at], down[at])):
                    if tile:
                        yield tile.rows()
                    key, anchors_of, tile, last = here, [], None, None
                if kind[at] == 0:
                    anchors_of.append(part)
                    continue
                if not anchors_of:
                    continue
                tile = tile or _Tile(anchors_of, k, scale, same)
                row = part.column("id").to_numpy()
                fresh = np.append(last is None or row[0] != last, np.diff(row) != 0)
                last = row[-1]
                tile.meet(row[fresh], np.asarray(part.column("label"))[fresh], _codes(part.column("vec"), scale)[fresh])
        if tile:
            yield tile.rows()

    found = tiles.mapInArrow(run, _FOUND)
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _share(score: Column, percent: int, up: bool) -> Column:
    """percent / 100 of a score as a whole number, rounded down or up, without overflow."""
    rest = F.pmod(score, F.lit(100))
    hundreds = F.call_function("div", score, F.lit(100)) - F.when((score < 0) & (rest != 0), 1).otherwise(0)
    return hundreds * percent + F.call_function("div", rest * percent + (99 if up else 0), F.lit(100))


def hard_negatives(rows: DataFrame, anchor: Column, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding", positives: int = 5, negatives: int = 10,
                   low: int = 30, high: int = 90, scale: float = 256.0) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for every anchor and positive.

    ``anchor`` is a condition on ``rows``; ``low`` and ``high`` are percents of the positive's score between which a
    negative's score must lie, ends included.
    """
    every = usable(rows, vec_id, label, vector)
    asked = usable(rows.where(anchor), vec_id, label, vector).groupBy("id").agg(F.min(F.struct("label", "vec")).alias("x")).select("id", "x.label", "x.vec")
    asked = checkpoint(asked)
    n_rows, n_anchors = rows.count(), asked.count()

    open_ended = asked.withColumn("limits", F.array(F.lit(2**63 - 1))).withColumn("least", F.lit(_NONE + 1).cast("long"))
    best = _select(every, open_ended, n_rows, n_anchors, positives, scale, same=True)
    order = F.sort_array(F.collect_list(F.struct("rank", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), _share(F.col("score"), low, True).alias("low"),
                                                 _share(F.col("score"), high, False).alias("high"))))
    wanted = best.groupBy(F.col("anchor_id").alias("id")).agg(order.alias("positives")).withColumn("positives", F.filter("positives", lambda p: p["low"] <= p["high"])).where(F.size("positives") > 0)
    limits = F.array_distinct(F.transform("positives", lambda p: p["high"]))
    wanted = wanted.withColumn("limits", limits).withColumn("least", F.array_min(F.transform("positives", lambda p: p["low"])))
    asked = checkpoint(asked.join(wanted, "id"))

    found = _select(every, asked.select("id", "label", "vec", "limits", "least"), n_rows, n_anchors, negatives, scale, same=False)
    slots = found.groupBy(F.col("anchor_id").alias("id")).agg(F.sort_array(F.collect_list(F.struct("slot", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")))).alias("found"))
    # one descending pass: the merge at a slot is the slot's own best, then the merge below it
    own = lambda j: F.filter("found", lambda x: x["slot"] == j)
    below = lambda merges: F.coalesce(F.try_element_at(merges, F.lit(1)), F.array().cast(slots.schema["found"].dataType))
    merge = lambda merges, j: F.concat(F.array(F.slice(F.concat(own(j), below(merges)), 1, negatives)), merges)
    start = F.array().cast(f"array<{slots.schema['found'].dataType.simpleString()}>")
    merges = F.aggregate(F.reverse(F.sequence(F.lit(0), F.size("limits") - 1)), start, merge)
    pairs = asked.select("id", "positives", "limits").join(slots, "id").withColumn("merges", merges).select("id", "limits", "merges", F.explode("positives").alias("p"))
    at = F.array_position("limits", F.col("p.high")).cast("int")
    inside = F.filter(F.element_at("merges", at), lambda x: x["negative_score"] >= F.col("p.low"))
    return pairs.select(F.col("id").alias("anchor_id"), "p.positive_id", "p.positive_score", F.posexplode(inside).alias("pos", "n")).select(
        "anchor_id", "positive_id", (F.col("pos") + 1).alias("rank"), "n.negative_id", "positive_score", "n.negative_score")
