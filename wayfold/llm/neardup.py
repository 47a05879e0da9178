"""Near-duplicate documents by b-bit MinHash.

1. Every text becomes the set of its 5-word shingles; texts with equal sets form one class.
2. ``BANDS`` x ``ROWS`` minima per class. A band's minima, hashed, name a bucket; the low ``B_BITS`` of all minima
   are the packed signature.
3. In each bucket the smallest id is paired with the others. Bit counts of the signatures give a similarity,
   corrected for chance agreement of the low bits; pairs well below the threshold go.
4. Links are confirmed on the full sets: first the best pair of each class, then the pairs that would still join
   two components, then all pairs of bucket members that do not lie in one component yet.

A pair at the threshold shares no bucket with probability (1 - 0.75^5)^45 = 5e-6 and is lost by the bit counts
with about 1e-6; above the threshold both fall quickly. Everything else is exact.

Hot groups: copies collapse in step 1 before anything is paired; a bucket of many variants gives one pair per
member; the members are then in one component and step 4 leaves them alone. In crowded buckets (``CROWD``) that
hold several components, a class is set aside if too few of its shingles occur in any other such class for a link
to be possible: that is exact, and it clears unlike documents that only share a long passage. The others meet in
blocks of ``BLOCK`` members, where bit counts of a long one-bit signature (``WIDE`` minima) leave pairs close to the
threshold; no row is made for any other pair. Pairs always lead from outside a bucket's largest component.

Rows: null ids, null texts and texts without words are linked with nothing (component: the own id). Rows that
share an id are one document, represented by the row with the largest set. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from wayfold.llm import textscan as ts
from wayfold.llm.graph import components
from wayfold.session import checkpoint

SHINGLE = 5
#: Similarity at which documents are linked, in percent.
THRESHOLD = 75
BANDS, ROWS = 45, 5
B_BITS = 2
#: Standard deviations below the threshold at which the signature still keeps a pair.
SLACK = 4.8
#: Members of a bucket above which classes without enough common shingles are set aside before pairing.
CROWD = 64
#: Bits of the filter that spares texts without candidates the second scan; beyond its capacity it only spares less.
FILTER_BITS = 1 << 23
#: Minima of the one-bit signatures for crowded buckets; members of a bucket that one group of a task holds, twice at most.
WIDE, BLOCK = 4096, 512

_HASHES = BANDS * ROWS
_FACTORS = (ts._splitmix(_HASHES, 77) >> ts.U64(32)).astype(np.uint32) | np.uint32(1)
_LONGS = -(-_HASHES // 64)
_WIDE_FACTORS = (ts._splitmix(WIDE, 99) >> ts.U64(32)).astype(np.uint32) | np.uint32(1)


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    data, offs = ts.flat(column)
    low = ts.LOWER[data]
    w = ts.Words(low, offs, ts.SPACES)
    start, end, at = ts.windows(w.first, SHINGLE, short=True)
    h = ts.run_hash(ts.run_prefix(w.hashes(ts.byte_prefix(low))), start, end)
    return [np.unique(h[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket names (n x BANDS) and packed low bits (n x B_BITS * _LONGS) of non-empty sets."""
    x = (np.concatenate(sets) >> ts.U64(32)).astype(np.uint32)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    least, work = np.empty((len(sets), _HASHES), np.uint32), np.empty_like(x)
    for i, f in enumerate(_FACTORS):
        np.multiply(x, f, out=work)
        np.minimum.reduceat(work, at, out=least[:, i])
    h = np.tile(np.arange(1, BANDS + 1, dtype=ts.U64), (len(sets), 1))
    for r in range(ROWS):
        h = ts.mix(h ^ least[:, r::ROWS])
    bits = np.zeros((len(sets), B_BITS, 64 * _LONGS), np.uint8)
    for b in range(B_BITS):
        bits[:, b, :_HASHES] = (ts.mix(least.astype(ts.U64)) >> ts.U64(b)) & ts.U64(1)
    return h.view(np.int64), np.packbits(bits, axis=-1).reshape(len(sets), -1).view(np.int64)


def wide_signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One bit of each of WIDE minima, packed (n x WIDE / 8 bytes)."""
    x = (np.concatenate(sets) >> ts.U64(32)).astype(np.uint32)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    bits, work = np.empty((len(sets), WIDE), np.uint8), np.empty_like(x)
    for i, f in enumerate(_WIDE_FACTORS):
        np.multiply(x, f, out=work)
        bits[:, i] = ts.mix(np.minimum.reduceat(work, at).astype(ts.U64)) & ts.U64(1)
    return np.packbits(bits, axis=-1)


def _longs(rows: np.ndarray, valid: np.ndarray, width: int) -> pa.Array:
    """One list of ``width`` numbers per valid document, else null."""
    offs = np.concatenate([[0], np.cumsum(np.where(valid, width, 0))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(rows.ravel()), mask=pa.array(~valid))


def sketches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n (set size), a 128-bit fingerprint of the set, bucket names and packed signature."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    longs = ArrayType(LongType())
    schema = StructType([StructField("doc_id", LongType()), StructField("n", LongType()), StructField("f1", LongType()), StructField("f2", LongType()),
                         StructField("bands", longs), StructField("sig", longs)])

    def sketch(part: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(part.column("text"))
        n = np.array([len(s) for s in sets], np.int64)
        full = n > 0
        some = [s for s in sets if len(s)]
        f1 = np.array([int(s.sum(dtype=ts.U64)) for s in sets], ts.U64)
        f2 = np.array([int(ts.mix(s ^ ts.U64(0x5851F42D4C957F2D)).sum(dtype=ts.U64)) for s in sets], ts.U64)
        bands, sig = signatures(some) if some else (np.zeros((0, BANDS), np.int64), np.zeros((0, B_BITS * _LONGS), np.int64))
        return pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)),
                                           _longs(bands, full, BANDS), _longs(sig, full, B_BITS * _LONGS)], names=schema.names)

    return ts.map_slices(rows, "text", sketch, schema)


def _settled(rows: DataFrame, repeated: DataFrame, key: str) -> DataFrame:
    """One row for each id: of repeated ids the one with the largest set."""
    names = [c for c in rows.columns if c != key]
    again = rows.join(repeated, key, "left_semi").groupBy(key).agg(F.max(F.struct(*names)).alias("r")).select(key, *[F.col("r")[c].alias(c) for c in names])
    return rows.join(repeated, key, "left_anti").unionByName(again)


def agreement(a: str, b: str) -> Column:
    """Signature positions on which two classes agree, by bit counts."""
    s, t = F.col(a), F.col(b)
    differ = [F.bit_count(_any([s[p * _LONGS + k].bitwiseXOR(t[p * _LONGS + k]) for p in range(B_BITS)])) for k in range(_LONGS)]
    return F.lit(_HASHES) - sum(differ[1:], differ[0])


def _any(bits: list[Column]) -> Column:
    out = bits[0]
    for x in bits[1:]:
        out = out.bitwiseOR(x)
    return out


def similarity(matches: Column) -> Column:
    """Jaccard estimate from agreeing positions, corrected for chance agreement of B_BITS bits."""
    chance = 2.0**-B_BITS
    return (matches / F.lit(_HASHES) - F.lit(chance)) / F.lit(1 - chance)


def _least_matches(threshold: int, hashes: int = _HASHES, bits: int = B_BITS) -> float:
    p = 2.0**-bits
    p += (1 - p) * threshold / 100
    return hashes * p - SLACK * (hashes * p * (1 - p)) ** 0.5


class _Pairs:
    """Candidate filter and exact confirmation over the classes ``k`` (id, n, sig, bands)."""

    def __init__(self, docs: DataFrame, k: DataFrame, repeated: DataFrame, threshold: int):
        self.docs, self.k, self.repeated, self.threshold = docs, k, repeated, threshold

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Distinct pairs (a, b) whose sizes and signatures allow a link, with the estimate."""
        a, b = (self.k.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("sig").alias(f"s{x}")) for x in "ab")
        sizes = F.expr(f"100 * least(na, nb) >= {self.threshold} * greatest(na, nb)")
        matched = pairs.join(a, "a").join(b, "b").where(sizes).withColumn("m", agreement("sa", "sb")).where(F.col("m") >= _least_matches(self.threshold))
        return matched.select("a", "b", similarity(F.col("m")).alias("estimate"))

    def sets(self, ids: DataFrame) -> DataFrame:
        """(id, n, items) of the classes listed in ``ids`` (distinct), and maybe of some more."""
        bits = FILTER_BITS
        spot = lambda seed: F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(bits))
        words = ids.select(F.explode(F.array(spot(1), spot(2))).alias("p")).groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, int(p & 63))")).alias("bits"))
        got = words.toArrow()  # at most FILTER_BITS / 64 rows
        held = np.zeros(bits // 64, np.int64)
        held[got.column("w").to_numpy()] = got.column("bits").to_numpy()
        sent = ids.sparkSession.sparkContext.broadcast(held)

        rows = self.docs.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("id"), "text").select("id", spot(1).alias("p1"), spot(2).alias("p2"), "text")
        schema = StructType([StructField("id", LongType()), StructField("n", LongType()), StructField("items", ArrayType(LongType()))])

        def emit(part: pa.RecordBatch) -> pa.RecordBatch | None:
            hit = np.ones(part.num_rows, bool)
            for name in ("p1", "p2"):
                p = part.column(name).to_numpy()
                hit &= (sent.value[p >> 6] >> (p & 63)) & 1 == 1
            if not hit.any():
                return None
            part = part.filter(pa.array(hit))
            sets = shingle_sets(part.column("text"))
            n = np.array([len(s) for s in sets], np.int64)
            items = np.concatenate(sets).view(np.int64)
            return pa.RecordBatch.from_arrays([part.column("id"), pa.array(n), _ragged(items, n)], names=schema.names)

        found = ts.map_slices(rows, "text", emit, schema)
        return checkpoint(_settled(found, self.repeated.withColumnRenamed("doc_id", "id"), "id"))

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose full sets meet the threshold."""
        pairs = checkpoint(pairs.select("a", "b"))
        if pairs.isEmpty():
            return pairs
        sets = self.sets(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
        b = sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("items").alias("xb"))
        a = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("items").alias("xa"))
        both = pairs.join(b, "b").join(a, "a").withColumn("i", F.size(F.array_intersect("xa", "xb")).cast("long"))
        return checkpoint(both.where(F.expr(f"100 * i >= {self.threshold} * (na + nb - i)")).select("a", "b"))


def _ragged(values: np.ndarray, n: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(values))


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose ends lie in different components."""
    for x in "ab":
        pairs = pairs.join(roots.select(F.col("id").alias(x), F.col("root").alias(f"r{x}")), x, "left")
    return pairs.where("coalesce(ra, a) <> coalesce(rb, b)").drop("ra", "rb")


def _mixed(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(bucket, id, root) of the buckets whose members lie in several components."""
    rooted = members.join(roots, "id", "left").select("bucket", "id", F.coalesce("root", "id").alias("root"))
    rooted = checkpoint(rooted)
    mixed = checkpoint(rooted.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count(F.lit(1)).alias("size")).where("x <> y").select("bucket", "size"))
    return rooted.join(mixed, "bucket")


def _met(rows: DataFrame) -> DataFrame:
    """Distinct pairs of members of one bucket with unequal roots; one of the two is outside the bucket's largest component."""
    size = rows.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("c"))
    main = checkpoint(size.groupBy("bucket").agg(F.max(F.struct("c", "root")).alias("m")).select("bucket", F.col("m.root").alias("main")))
    odd = checkpoint(rows.join(main, "bucket").where("root <> main").select("bucket", F.col("id").alias("o"), F.col("root").alias("ro")))
    met = rows.select("bucket", "id", "root").join(odd, "bucket").where("id <> o AND root <> ro")
    return met.select(F.least("id", "o").alias("a"), F.greatest("id", "o").alias("b")).distinct()


def _close(crowded: DataFrame, pairs: _Pairs) -> DataFrame:
    """Pairs of members of crowded buckets (bucket, id, root, size) with unequal roots that may well be links."""
    ids = checkpoint(crowded.select("id").distinct())
    none = crowded.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)
    if ids.isEmpty():
        return none
    sets = checkpoint(pairs.sets(ids).join(ids, "id", "left_semi"))
    crowded = checkpoint(_linkable(crowded, sets, pairs.threshold))
    left = checkpoint(crowded.select("id").distinct())
    if left.isEmpty():
        return none
    schema = StructType([StructField("id", LongType()), StructField("n", LongType()), StructField("wide", BinaryType())])

    def sketch(batches):
        for part in batches:
            for at in range(0, part.num_rows, 64):
                some = part.slice(at, 64)
                wide = wide_signatures([np.asarray(x).view(ts.U64) for x in some.column("items").to_numpy(zero_copy_only=False)])
                yield pa.RecordBatch.from_arrays([some.column("id"), some.column("n"), pa.array([w.tobytes() for w in wide], pa.binary())], names=schema.names)

    wide = checkpoint(sets.join(left, "id", "left_semi").mapInArrow(sketch, schema).join(pairs.k.select("id", "bands"), "id"))
    rows = crowded.join(wide, "id")
    # each member's block meets every block of its bucket, so each pair of members meets in one group
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    rows = rows.withColumn("own", F.pmod(F.hash("id"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.select("bucket", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "id", "root", "n", "wide", "bands")
    least, threshold = _least_matches(pairs.threshold, WIDE, 1), pairs.threshold

    def compare(group: pa.Table) -> pa.Table:
        ident, root, n, own = (group.column(c).to_numpy() for c in ("id", "root", "n", "own"))
        bits = np.stack([np.frombuffer(w, "<u8") for w in group.column("wide").to_pylist()])
        names, count = np.unique(root, return_counts=True)
        main = names[np.argmax(count)]
        two = own.min() != own.max()
        bands = group.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
        # pairs that share an earlier bucket meet there
        bands = bands[:, : int(np.flatnonzero(bands[0] == group.column("bucket")[0].as_py())[0])]
        left, right = [], []
        for o in np.flatnonzero(root != main):
            may = (root != root[o]) & (100 * np.minimum(n, n[o]) >= threshold * np.maximum(n, n[o])) & ((own != own[o]) | (not two))
            other = np.flatnonzero(may)
            near = other[WIDE - np.bitwise_count(bits[other] ^ bits[o]).sum(axis=1, dtype=np.int64) >= least]
            near = near[~(bands[near] == bands[o]).any(axis=1)]
            left.append(np.minimum(ident[near], ident[o]))
            right.append(np.maximum(ident[near], ident[o]))
        both = np.unique(np.stack([np.concatenate(left), np.concatenate(right)], axis=1), axis=0) if left else np.zeros((0, 2), np.int64)
        return pa.table({"a": pa.array(both[:, 0], pa.int64()), "b": pa.array(both[:, 1], pa.int64())})

    return rows.groupBy("bucket", "p", "q").applyInArrow(compare, "a long, b long")


def _linkable(crowded: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Members of crowded buckets but those that no other member can overlap enough.

    With c shingles that occur in another class of these buckets, and partners of at least m shingles, no similarity
    exceeds c / (n + m - c).
    """
    schema = StructType([StructField("s", LongType()), StructField("k", LongType()), StructField("id", LongType())])

    def counted(batches):
        """Each shingle of a batch once, with the number of its classes and one of them."""
        for part in batches:
            items, n = part.column("items").flatten().to_numpy(), np.asarray(part.column("n"))
            own, at, k = np.unique(items, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(k), pa.array(np.repeat(np.asarray(part.column("id")), n)[at])], names=schema.names)

    # a shingle of one class only names that class
    once = sets.mapInArrow(counted, schema).groupBy("s").agg(F.sum("k").alias("k"), F.min("id").alias("id")).where("k = 1")
    alone = once.groupBy("id").agg(F.count(F.lit(1)).alias("u"))
    sized = crowded.join(sets.select("id", "n"), "id")
    least = checkpoint(sized.groupBy("bucket").agg(F.min("n").alias("m")))
    partner = sized.join(least, "bucket").groupBy("id", "n").agg(F.min("m").alias("m"))
    low = F.greatest("m", F.ceil(F.col("n") * threshold / 100))
    c = F.col("n") - F.coalesce("u", F.lit(0))
    able = checkpoint(partner.join(alone, "id", "left").where(100 * c >= threshold * (F.col("n") + low - c)).select("id"))
    return crowded.join(able, "id", "left_semi")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id`` (smallest id linked, directly or through others) and ``kept``."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = checkpoint(sketches(docs))
    real = rows.where("n > 0 AND doc_id IS NOT NULL")
    repeated = checkpoint(real.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("doc_id"))
    one = _settled(real, repeated, "doc_id")
    k = checkpoint(one.groupBy("f1", "f2", "n").agg(F.min(F.struct("doc_id", "bands", "sig")).alias("r"))
                   .select(F.col("r.doc_id").alias("id"), "n", "f1", "f2", "r.bands", "r.sig"))
    copies = one.select("doc_id", "f1", "f2", "n").join(k.select("f1", "f2", "n", "id"), ["f1", "f2", "n"])

    rows_of = k.select("id", F.explode("bands").alias("bucket"))
    shared = checkpoint(rows_of.groupBy("bucket").agg(F.min("id").alias("least"), F.max("id").alias("top")).where("least < top").select("bucket", "least"))
    members = checkpoint(rows_of.join(shared, "bucket"))
    pairs = _Pairs(docs, k, repeated, threshold)
    star = checkpoint(pairs.likely(members.where("id <> least").select(F.col("least").alias("a"), F.col("id").alias("b")).distinct()))

    best = star.groupBy("b").agg(F.min_by("a", F.struct(-F.col("estimate"), F.col("a"))).alias("a"))
    links = pairs.confirmed(best)
    roots = components(links)
    links = links.unionByName(pairs.confirmed(_apart(star, roots)))
    roots = components(links)

    mixed = checkpoint(_mixed(members.select("bucket", "id"), roots))
    few = pairs.likely(_met(mixed.where(F.col("size") <= CROWD)))
    late = pairs.confirmed(few.select("a", "b").unionByName(_close(mixed.where(F.col("size") > CROWD), pairs)).distinct())
    if not late.isEmpty():
        roots = components(links.unionByName(late))

    label = copies.join(roots, "id", "left").select("doc_id", F.coalesce("root", "id").alias("component_id"))
    out = rows.select("doc_id", F.col("n").alias("n_shingles")).join(label, "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def distinct_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that stay: one of each group. Of rows that share an id, the least one stays;
    rows with a null id all stay."""
    found = checkpoint(near_duplicates(docs, doc_id, text, threshold).where(F.col("doc_id").isNotNull()))
    dropped = checkpoint(found.where(~F.col("kept")).select("doc_id").distinct()).withColumnRenamed("doc_id", doc_id)
    again = checkpoint(found.where("kept").groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("doc_id")).withColumnRenamed("doc_id", doc_id)
    left = docs.join(dropped, doc_id, "left_anti")
    one = left.join(again, doc_id, "left_semi").groupBy(doc_id).agg(F.min(F.struct(*docs.columns)).alias("_row")).select("_row.*")
    return left.join(again, doc_id, "left_anti").select(docs.columns).unionByName(one.select(docs.columns))
