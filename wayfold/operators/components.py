"""Connected components and distance-linked clusters as iterated joins.

Hot cells are handled by construction: points of one small cell are linked as a star (they are
all within eps of each other), and cell pairs are compared by boxes that shrink where it is undecided,
so no cell ever emits all of its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from wayfold.operators import tiles as T
from wayfold.operators.groups import null_groups
from wayfold.session import checkpoint, checkpoint_observed, shuffled


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """(id, label): label is the smallest id of the component; nodes without a partner are not listed.

    Alternating large-star / small-star contraction: the edge set never grows and the number of
    rounds is logarithmic in the component size. Every round is written out once; its size and
    fingerprint are observed during the write and decide when to stop.
    """
    mark = {"n": F.count(F.lit(1)), "h": F.bit_xor(F.xxhash64("u", "v"))}
    raw = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).filter("a <> b")
    e, before = checkpoint_observed(raw.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), **mark)
    for _ in range(max_rounds):
        if not before["n"]:
            break
        turn = F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("p")
        both = e.select(turn).select("p.u", "p.v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # every node hands its larger neighbours to its smallest one (repeats are merged below)
        large = both.filter("v > u").join(shuffled(low), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        star = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                 F.struct(F.col("u").alias("u"), F.col("m").alias("v"))))
        small = large.join(shuffled(low2), "u").select(star.alias("p")).select("p.u", "p.v").filter("u <> v").distinct()
        e, after = checkpoint_observed(small, **mark)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("connected components did not settle; raise max_rounds")
    return e.select(F.col("u").alias("id"), F.col("v").alias("label")).unionByName(
        e.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct())


def label_all(nodes: DataFrame, key: str, edges: DataFrame) -> DataFrame:
    """Attach ``label`` to every node; isolated nodes label themselves."""
    cc = connected_components(edges)
    return nodes.join(shuffled(cc.withColumnRenamed("id", key)), key, "left").withColumn("label", F.coalesce("label", F.col(key)))


def _half_offsets(r: int) -> list[tuple[int, int]]:
    return [(dx, dy) for dx in range(0, r + 1) for dy in range(-r, r + 1) if dx > 0 or dy > 0]


#: Pairs of spots that two cells may have to be compared directly; with more, the cells are halved first.
DIRECT = 1024


@null_groups
def distance_links(df: DataFrame, key: str, eps: float, by: Sequence[str] = (), x: str = "x", y: str = "y") -> DataFrame:
    """Edges whose components equal single linkage at distance <= eps.

    Cells have side eps/sqrt(2): a cell is a clique and becomes a star. Of two cells only the boxes around their
    points are compared: the pair is out if the boxes are more than eps apart, and linked if no two of their
    points can be. What is left open is compared point by point if that takes at most ``DIRECT`` tests, and else
    descends into the quarters of both cells, where the same is asked again. So no pair of cells costs more than
    ``DIRECT`` rows a step, however many points it holds, and the result is exact.
    """
    side = eps / 2 ** 0.5 * (1 - 1e-12)
    names = [f"_g{i}" for i in range(len(by))]
    at = lambda c, size: F.floor(F.col(c) / F.lit(size)).cast("long")
    cells = df.select(*[F.col(c).alias(n) for c, n in zip(by, names)], F.col(key).alias("_id"), F.col(x).alias("_x"), F.col(y).alias("_y")).select(
        "*", at("_x", side).alias("_cx"), at("_y", side).alias("_cy"))
    cell = [*names, "_cx", "_cy"]
    spots = checkpoint(cells.groupBy(*cell, "_x", "_y").agg(F.min("_id").alias("_id")))
    box = checkpoint(spots.groupBy(*cell).agg(F.min("_id").alias("rep"), *_box()))
    star = cells.join(shuffled(box.select(*cell, "rep")), cell).filter("_id <> rep").select(F.col("_id").alias("src"), F.col("rep").alias("dst"))

    offs = F.explode(F.array(*[F.struct(F.lit(a).cast("long").alias("dx"), F.lit(b).cast("long").alias("dy")) for a, b in _half_offsets(2)])).alias("o")
    side_of = lambda d, p: d.select(*names, F.col("_cx").alias(f"{p}_cx"), F.col("_cy").alias(f"{p}_cy"), *[F.col(c).alias(f"{p}_{c}") for c in d.columns if c not in cell])
    left = side_of(box, "a").select("*", offs).withColumn("b_cx", F.col("a_cx") + F.col("o.dx")).withColumn("b_cy", F.col("a_cy") + F.col("o.dy")).drop("o")
    pairs = left.join(shuffled(side_of(box, "b")), [*names, "b_cx", "b_cy"])
    links, ends = [star], [F.col("a_rep").alias("src"), F.col("b_rep").alias("dst")]
    while True:
        pairs, seen = checkpoint_observed(_gaps(pairs).filter(F.col("near") <= eps), open=F.count_if(F.col("wide") > eps))
        sure = pairs.filter(F.col("wide") <= eps).select(*ends).distinct()
        links.append(sure)
        if not seen["open"]:
            break
        # a pair of cells is done once one pair of their parts is linked
        still = pairs.filter(F.col("wide") > eps).join(shuffled(sure.select(F.col("src").alias("a_rep"), F.col("dst").alias("b_rep"))), ["a_rep", "b_rep"], "left_anti")
        still = checkpoint(still.select(*names, *[f"{p}_{c}" for p in "ab" for c in ("cx", "cy", "rep", "n")]))
        few = still.filter(F.col("a_n") * F.col("b_n") <= DIRECT)
        now = spots.select(*names, "_x", "_y", at("_x", side).alias("_cx"), at("_y", side).alias("_cy"))
        met = few
        for p in "ab":
            met = met.join(shuffled(side_of(now, p)), [*names, f"{p}_cx", f"{p}_cy"])
        links.append(met.filter(F.hypot(F.col("a__x") - F.col("b__x"), F.col("a__y") - F.col("b__y")) <= eps).select(*ends).distinct())
        side /= 2  # halving is exact, so parts nest
        parts = checkpoint(spots.select(*names, "_x", "_y", at("_x", side).alias("_cx"), at("_y", side).alias("_cy")).groupBy(*cell).agg(*_box()))
        pairs = still.filter(F.col("a_n") * F.col("b_n") > DIRECT).drop("a_n", "b_n")
        for p in "ab":
            quarter = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)])).alias("o")
            pairs = pairs.select("*", quarter).withColumn(f"{p}_cx", 2 * F.col(f"{p}_cx") + F.col("o.i")).withColumn(f"{p}_cy", 2 * F.col(f"{p}_cy") + F.col("o.j")).drop("o")
            pairs = pairs.join(shuffled(side_of(parts, p)), [*names, f"{p}_cx", f"{p}_cy"])
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return out


def _box() -> list[Column]:
    return [F.min("_x").alias("x0"), F.max("_x").alias("x1"), F.min("_y").alias("y0"), F.max("_y").alias("y1"), F.count(F.lit(1)).alias("n")]


def _gaps(pairs: DataFrame) -> DataFrame:
    """Adds the least and the largest distance that points of two boxes can have."""
    gap = lambda lo, hi: F.greatest(F.col("b_" + lo) - F.col("a_" + hi), F.col("a_" + lo) - F.col("b_" + hi), F.lit(0.0))
    far = lambda lo, hi: F.greatest(F.col("b_" + hi) - F.col("a_" + lo), F.col("a_" + hi) - F.col("b_" + lo))
    return pairs.withColumn("near", F.hypot(gap("x0", "x1"), gap("y0", "y1"))).withColumn("wide", F.hypot(far("x0", "x1"), far("y0", "y1")))


@null_groups
def centroid_clusters(df: DataFrame, key: str, eps: float, by: Sequence[str] = (), x: str = "x", y: str = "y") -> DataFrame:
    """Single-linkage clusters (order-independent); label = smallest member key.

    Tiles are labelled inside tasks; only rows near a tile's border or in a crowded tile are linked by joins, so what is
    shuffled again follows the borders. Rows with a null key or a place that is no number stay alone.
    """
    rows, hot, alone = T.tiled(df, key, eps, by, x, y)
    out, names = whole_parts(T.linked_parts(rows, key, eps, x, y), hot, key, eps, by, x, y), [*df.columns, "label"]
    return out.select(*names).unionByName(alone.withColumn("label", F.col(key)).select(*names))


def whole_parts(parts: DataFrame, hot: DataFrame | None, key: str, eps: float, by: Sequence[str], x: str, y: str) -> DataFrame:
    """Parts of tiles, linked across their borders: adds ``label``."""
    lab = checkpoint(parts)
    rim = lab.filter("_rim").select(*by, "_part", x, y)
    if hot is not None:
        hot = checkpoint(hot.withColumn("_part", F.col(key)))
        rim = rim.unionByName(hot.select(*rim.columns))
        lab = lab.unionByName(hot.withColumns({"_rim": F.lit(True), "_open": F.lit(True)}), allowMissingColumns=True)
    cc = connected_components(distance_links(rim, "_part", eps, by, x, y)).withColumnRenamed("id", "_part")
    crossing = lab.filter("_open").join(shuffled(cc), "_part", "left").withColumn("label", F.coalesce("label", F.col("_part")))
    return lab.filter("not _open").withColumn("label", F.col("_part")).unionByName(crossing)


#: Side of a tile in cells: a tile is labelled whole inside a task, so it holds at most TILE * TILE distinct cells.
TILE = 64


def _tile_parts(at: np.ndarray, ix: np.ndarray, iy: np.ndarray, there: np.ndarray, offs: Sequence[tuple[int, int]]) -> np.ndarray:
    """Position of the first cell of its part, for every cell; rows come by tile (``at``), ix, iy, and parts stay inside tiles."""
    lx, ly = ix % TILE, iy % TILE
    code = (at * TILE + lx) * (2 * TILE) + ly  # a row is as wide again as a tile, so no step reaches the next one
    code = np.where(there, code, -1)
    pos = np.flatnonzero(there)
    own = code[pos]
    lab = np.arange(len(code))
    a, b = [], []
    if len(pos) > 1:  # copies of a cell
        same = own[1:] == own[:-1]
        a.append(pos[1:][same]), b.append(pos[:-1][same])
    for dx, dy in offs:
        inside = pos[(lx[pos] + dx < TILE) & (ly[pos] + dy >= 0) & (ly[pos] + dy < TILE)]
        want = code[inside] + dx * 2 * TILE + dy
        hit = np.searchsorted(own, want)
        met = hit < len(own)
        met[met] = own[hit[met]] == want[met]
        a.append(inside[met]), b.append(pos[hit[met]])
    a, b = np.concatenate(a) if a else pos[:0], np.concatenate(b) if b else pos[:0]
    return T.join_up(lab, a, b)


def _tiles(cells: DataFrame, by: Sequence[str], offs: Sequence[tuple[int, int]], ix: str, iy: str) -> DataFrame:
    """One row per tile: (by, cells, at, open). ``at`` is the place of the smallest cell of each cell's part, ``open`` tells if the part reaches the border."""
    rest = [c for c in cells.columns if c not in (*by, ix, iy)]
    tile = [F.floor(F.col(c) / F.lit(TILE)).alias(t) for c, t in ((ix, "_tx"), (iy, "_ty"))]
    rows = F.sort_array(F.collect_list(F.struct(F.col(ix).cast("long").alias("ix"), F.col(iy).cast("long").alias("iy"), *[F.col(c) for c in rest])))
    lists = cells.select("*", *tile).groupBy(*by, "_tx", "_ty").agg(rows.alias("cells")).drop("_tx", "_ty")
    schema = lists.select("*", F.lit(None).cast("array<int>").alias("at"), F.lit(None).cast("array<boolean>").alias("open")).schema

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            many = batch.column("cells")
            ends = many.offsets.to_numpy()
            flat = many.flatten()
            x, y = flat.field("ix"), flat.field("iy")
            there = pc.and_(pc.is_valid(x), pc.is_valid(y)).to_numpy(zero_copy_only=False)
            num = lambda v: pc.fill_null(v, 0).to_numpy(zero_copy_only=False)
            sizes = np.diff(ends)
            got = _tile_parts(np.repeat(np.arange(len(sizes)), sizes), num(x), num(y), there, offs)
            rim = there & (np.isin(num(x) % TILE, (0, TILE - 1)) | np.isin(num(y) % TILE, (0, TILE - 1)))
            reach = np.zeros(len(got), bool)
            reach[got[rim]] = True
            listed = lambda v, t: pa.ListArray.from_arrays(pa.array(ends - ends[0], pa.int32()), pa.array(v, t))
            new = [listed(got - np.repeat(ends[:-1] - ends[0], sizes), pa.int32()), listed(reach[got], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, "at", "open"])

    return checkpoint(lists.mapInArrow(label, schema))


def _cell_parts(cells: DataFrame, by: Sequence[str], diagonal: bool, ix: str, iy: str) -> tuple[DataFrame, DataFrame]:
    """Cells with ``_part``, the smallest cell of their tile that they are linked to, and ``_open``: the part reaches a tile's
    border; and (_part, label) of the parts that are linked across borders."""
    offs = [(1, 0), (0, 1)] + ([(1, 1), (1, -1)] if diagonal else [])
    tiles = _tiles(cells, by, offs, ix, iy)
    node = lambda c: F.struct(*[F.col(b) for b in by], c["ix"].alias(ix), c["iy"].alias(iy))
    edge = lambda c: c["ix"].isNotNull() & c["iy"].isNotNull() & (F.pmod(c["ix"], F.lit(TILE)).isin(0, TILE - 1) | F.pmod(c["iy"], F.lit(TILE)).isin(0, TILE - 1))
    cell = F.col("e.cells")
    one = tiles.select(*by, F.explode(F.arrays_zip("cells", F.transform("at", lambda i: F.get("cells", i)).alias("first"), "open")).alias("e"))
    names = [f.name for f in tiles.schema["cells"].dataType.elementType.fields]
    lab = one.select(*by, *[cell[n].alias({"ix": ix, "iy": iy}.get(n, n)) for n in names], node(F.col("e.first")).alias("_part"), F.col("e.open").alias("_open"))
    # links over a border: of the cells on it only
    met = lambda c, a: F.struct(c["ix"].alias("ix"), c["iy"].alias("iy"), F.get("cells", a)["ix"].alias("px"), F.get("cells", a)["iy"].alias("py"))
    rim = tiles.select(*by, F.explode(F.filter(F.transform(F.arrays_zip("cells", "at"), lambda z: F.when(edge(z["cells"]), met(z["cells"], z["at"]))), lambda z: z.isNotNull())).alias("c"))
    rim = checkpoint(rim.select(*by, "c.*").distinct())
    part = lambda n: F.struct(*[F.col(b) for b in by], F.col("px").alias(ix), F.col("py").alias(iy)).alias(n)
    o = F.explode(F.array(*[F.struct(F.lit(a).alias("dx"), F.lit(b).alias("dy")) for a, b in offs])).alias("o")
    tile = lambda c: F.floor(c / F.lit(TILE))
    left = rim.select(*by, part("src"), "ix", "iy", o).select(*by, "src", (F.col("ix") + F.col("o.dx")).alias("_nx"), (F.col("iy") + F.col("o.dy")).alias("_ny"), "ix", "iy")
    left = left.filter((tile(F.col("ix")) != tile(F.col("_nx"))) | (tile(F.col("iy")) != tile(F.col("_ny")))).drop("ix", "iy")
    right = rim.select(*by, F.col("ix").alias("_nx"), F.col("iy").alias("_ny"), part("dst"))
    cc = connected_components(left.join(shuffled(right), [*by, "_nx", "_ny"]).select("src", "dst"))
    return lab, checkpoint(cc.withColumnRenamed("id", "_part"))


@null_groups
def cell_components(cells: DataFrame, by: Sequence[str] = (), diagonal: bool = True, ix: str = "ix", iy: str = "iy") -> DataFrame:
    """Connected components of occupied grid cells (8- or 4-neighbour); adds ``label``, the smallest cell of the component.

    The node id is the (by, ix, iy) struct itself, so it stays unique at any grid size. Tiles are labelled inside tasks; only
    their parts that meet across a border become edges of a graph, so its size follows the borders and not the cells.
    """
    lab, cc = _cell_parts(cells, by, diagonal, ix, iy)
    closed = lab.filter(~F.col("_open")).withColumn("label", F.col("_part"))
    crossing = lab.filter("_open").join(shuffled(cc), "_part", "left").withColumn("label", F.coalesce("label", F.col("_part")))
    names = [*cells.columns, "label"]
    return closed.select(*names).unionByName(crossing.select(*names))


@null_groups
def cell_component_sizes(cells: DataFrame, by: Sequence[str] = (), diagonal: bool = True, ix: str = "ix", iy: str = "iy") -> DataFrame:
    """(by, label, cells) of ``cell_components``; parts of tiles are counted before their labels are looked up."""
    lab, cc = _cell_parts(cells.select(*by, ix, iy), by, diagonal, ix, iy)
    n = lab.groupBy(*by, "_part", "_open").agg(F.count(F.lit(1)).alias("cells"))
    n = checkpoint(n)
    closed = n.filter(~F.col("_open")).select(*by, F.col("_part").alias("label"), "cells")
    crossing = n.filter("_open").join(shuffled(cc), "_part", "left").groupBy(*by, F.coalesce("label", F.col("_part")).alias("label")).agg(F.sum("cells").alias("cells"))
    return closed.unionByName(crossing.select(*closed.columns))


@null_groups
def dbscan(df: DataFrame, key: str, eps: float, min_pts: int, by: Sequence[str] = (), x: str = "x", y: str = "y") -> DataFrame:
    """DBSCAN: (key, is_core, label); noise has label NULL. A border point joins the smallest core label.

    Cells of side eps/sqrt(2) holding >= min_pts points are core as a whole and need no pair test;
    only points of sparser cells (fewer than min_pts each) are counted against their neighbourhood.
    """
    side = eps / 2 ** 0.5 * (1 - 1e-12)
    by = list(by)
    c = df.select(*by, F.col(key).alias("_id"), F.col(x).alias("_x"), F.col(y).alias("_y"))
    c = c.withColumn("_cx", F.floor(F.col("_x") / side).cast("long")).withColumn("_cy", F.floor(F.col("_y") / side).cast("long"))
    cell = [*by, "_cx", "_cy"]
    size = c.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n"))
    c = c.join(shuffled(size), cell)
    # copies of one coordinate count once with a weight, so a pile of copies is a single join row
    spots = c.groupBy(*cell, "_x", "_y").agg(F.count(F.lit(1)).alias("_w"))
    near = F.explode(F.array(*[F.struct(F.lit(a).cast("long").alias("dx"), F.lit(b).cast("long").alias("dy"))
                               for a in range(-2, 3) for b in range(-2, 3)])).alias("o")

    def around(points: DataFrame, others: DataFrame) -> DataFrame:
        p = points.select(*by, "_id", F.col("_x").alias("px"), F.col("_y").alias("py"), "_cx", "_cy", near)
        p = p.select(*by, "_id", "px", "py", (F.col("_cx") + F.col("o.dx")).alias("_cx"), (F.col("_cy") + F.col("o.dy")).alias("_cy"))
        return p.join(shuffled(others), cell).filter(F.hypot(F.col("px") - F.col("_x"), F.col("py") - F.col("_y")) <= eps)

    sparse = c.filter(F.col("_n") < min_pts)
    counts = around(sparse, spots).groupBy("_id").agg(F.sum("_w").alias("_k")).filter(F.col("_k") >= min_pts).select("_id")
    core_ids = c.filter(F.col("_n") >= min_pts).select("_id").unionByName(counts)
    core = checkpoint(c.join(shuffled(core_ids), "_id", "left_semi"))
    core_lab = centroid_clusters(core, "_id", eps, by, "_x", "_y").select(*cell, "_id", "_x", "_y", "label")
    # border points live in sparse cells only; each core cell carries one label (it is a clique)
    core_spots = core_lab.groupBy(*cell, "_x", "_y").agg(F.min("label").alias("label"))
    rest = sparse.join(shuffled(core_ids), "_id", "left_anti")
    border = around(rest, core_spots).groupBy("_id").agg(F.min("label").alias("label")).withColumn("is_core", F.lit(False))
    found = core_lab.select("_id", "label").withColumn("is_core", F.lit(True)).unionByName(border)
    return df.join(shuffled(found.withColumnRenamed("_id", key)), key, "left").withColumn("is_core", F.coalesce("is_core", F.lit(False)))
