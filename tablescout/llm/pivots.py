"""Near duplicates of embeddings by an index over permutations of reference points.

Method: at most PIVOTS reference vectors are fitted on a sample (farthest-first, so that a dense group gets one of them, not a share).
Every vector is described by its NEAREST nearest references in order. Two vectors are candidates if they share two of them or more:
the inverted lists are kept for pairs of references, so that a list holds just the vectors that share both. A pair is verified by its
exact cosine in the list of its two lowest shared references, hence counted once without a table of pairs.

Dense groups are settled without comparing their members: vectors whose first ORDERED references agree in order are a cell; the centre
of a cell is fitted on at most FITTED of its vectors; vectors within half the linking angle of it are a bundle, whose members are all
linked by the triangle inequality. A bundle stands in the lists of all of its members, once each, with its centre and radius; whether
all, none or some of its members link with those of another bundle or with a single vector follows from the angle of the centres. Only
`some` is compared member by member, in blocks. Equal vectors are one vector with a weight.

Exactness: every counted link has a cosine of at least `similarity`; what is missed are pairs that share fewer than two references
(tested: 0.9 of the pairs just at 0.9 are found, nearly all above 0.95). Lists of more than BLOCK entries are compared in blocks dealt to
several tasks, nothing is capped.

Cases: vectors that are null, of zero length, or hold null or non-finite components link with nothing and are their own component, as are
vectors of other dimensions to each other; a null id counts as a vector, but is never a component's id unless all ids are null, and is
then kept; repeated ids are vectors of their own; equal vectors link; an empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from tablescout.llm.common import arrow_map, components
from tablescout.session import cut_lineage

PIVOTS = 1024  # references at most
SAMPLE = 8192  # vectors that references are fitted on, about
NEAREST = 8  # references that describe a vector
ORDERED = 3  # of them, those that name its cell
FITTED = 16  # vectors that a cell's centre is fitted on
DENSE = 6  # of them, those that must lie together
BLOCK = 2048  # entries of a list, or members of a bundle, that one task compares with as many
SAFE = 1e-7  # radians; beyond the error of an angle
SHIFT = 12  # bits of a reference's number


def _units(raw: list[bytes], wide: bool) -> np.ndarray:
    """Unit vectors as rows, padded with zeros to the longest."""
    v = [np.frombuffer(b, np.float64 if wide else np.float32).astype(np.float64) for b in raw]
    out = np.zeros((len(v), max(map(len, v), default=0)))
    for row, x in zip(out, v):
        row[:len(x)] = x
    out /= np.abs(out).max(axis=1, keepdims=True, initial=1e-300)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def _spread(units: np.ndarray, most: int) -> np.ndarray:
    """Farthest-first references."""
    picked, near = [0], units @ units[0]
    while len(picked) < min(most, len(units)):
        picked.append(int(np.argmin(near)))
        near = np.maximum(near, units @ units[picked[-1]])
    return units[picked].astype(np.float32)


def _angle(cos: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cos, -1.0, 1.0))


def groups_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables that hold whole groups of rows sorted by `keys`."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        last = [batch.column(k)[-1] for k in keys]
        same = np.logical_and.reduce([batch.column(k).to_numpy() == x.as_py() for k, x in zip(keys, last)])
        cut = int(np.flatnonzero(~same)[-1]) + 1 if (~same).any() else 0
        before = [held[0].column(k)[0].as_py() for k in keys] != [x.as_py() for x in last]
        if cut or before:
            table = pa.Table.from_batches(held)
            keep = batch.num_rows - cut
            yield table.slice(0, table.num_rows - keep)
            held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


def _starts(columns: list[np.ndarray]) -> np.ndarray:
    change = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.concatenate(([0], np.flatnonzero(change) + 1, [len(columns[0])]))


def _close_pairs(units: np.ndarray, starts: np.ndarray, side: np.ndarray, floor: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(a, b, cosine) of the pairs of a group with a cosine from `floor`: all a < b of one side, or a row of each side."""
    size = np.diff(starts)
    two = np.logical_or.reduceat(side != 0, starts[:-1]) if len(size) else np.zeros(0, bool)
    rows = np.arange(len(units))
    end = np.repeat(starts[1:], size)
    rest = np.where(np.repeat((size <= 32) & ~two, size), end - rows - 1, 0)
    upto = np.cumsum(rest)
    for lo in range(0, int(upto[-1]) if len(upto) else 0, 50_000):
        k = np.arange(lo, min(lo + 50_000, int(upto[-1])))
        a = np.searchsorted(upto, k, "right")
        b = a + 1 + k - (upto[a] - rest[a])
        g = np.einsum("ij,ij->i", units[a], units[b])
        near = g >= floor
        yield a[near], b[near], g[near]
    for lo, hi, both in zip(starts[:-1].tolist(), starts[1:].tolist(), two.tolist()):
        if hi - lo > 32 or both:
            mid = lo + int(np.count_nonzero(side[lo:hi] == 0)) if both else lo
            last = mid if both else hi
            for s in range(lo, last, 512):
                e = min(last, s + 512)
                g = units[s:e] @ units[mid:hi].T
                a, b = np.nonzero(g >= floor)
                g = g[a, b]
                a, b = a + s, b + mid
                keep = a < b
                yield a[keep], b[keep], g[keep]


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row that each of `n` rows reaches over the links (a, b)."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    while (root[root] != root).any():
        root = root[root]
    return root


COUNT, LINK, ALL, SOME = 0, 1, 2, 3  # kinds of findings: n links of vector a; vectors, or units, a and b are linked; all, or some, members of a and b
FOUND = "kind int, a long, b long, n long"


def _rows(kind: int, a, b, n=None) -> pa.RecordBatch:
    m = len(a)
    n = np.zeros(m, np.int64) if n is None else n
    return pa.RecordBatch.from_arrays([pa.array(np.full(m, kind, np.int32)), pa.array(np.asarray(a, np.int64)), pa.array(np.asarray(b, np.int64)), pa.array(np.asarray(n, np.int64))], ["kind", "a", "b", "n"])


def _counted(unit: np.ndarray, weight: np.ndarray, a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    n = np.bincount(a, weight[b], len(unit)).astype(np.int64) + np.bincount(b, weight[a], len(unit)).astype(np.int64)
    at = np.flatnonzero(n)
    if len(at):
        yield _rows(COUNT, unit[at], unit[at], n[at])


def _compare_lists(similarity: float, wide: bool) -> Callable:
    """Findings within the lists, or blocks of them: rows sorted by (l, i, j, side)."""
    theta, mask = float(np.arccos(similarity)), (1 << SHIFT) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups_of(batches, ["l", "i", "j"]):
            l, i, j, side, unit, weight, r = (t[c].to_numpy() for c in ("l", "i", "j", "side", "unit", "w", "r"))
            starts = _starts([l, i, j])
            keep = np.repeat(np.diff(starts) > 1, np.diff(starts))
            if not keep.any():
                continue
            t = t.filter(pa.array(keep))
            l, i, j, side, unit, weight, r = (c[keep] for c in (l, i, j, side, unit, weight, r))
            starts, bundle = _starts([l, i, j]), unit < 0
            raw, dim = t["raw"].to_pylist(), int((l >> 2 * SHIFT).max())
            units = np.zeros((len(raw), dim))
            for which, w in ((bundle, True), (~bundle, wide)):
                at = np.flatnonzero(which)
                if len(at):
                    u = _units([raw[k] for k in at], w)
                    units[at, :u.shape[1]] = u
            desc = np.array(t["desc"].to_pylist(), np.int64)
            floor = similarity if not bundle.any() else float(np.cos(min(np.pi, theta + 2 * float(r.max()) + 2 * SAFE)))
            ones_a, ones_b = [], []
            for a, b, g in _close_pairs(units, starts, side, floor):
                lone = ~bundle[a] & ~bundle[b]
                x, y = a[lone & (g >= similarity)], b[lone & (g >= similarity)]
                if len(x):
                    shared = (desc[x][:, :, None] == desc[y][:, None, :]).any(axis=2)
                    nth = np.cumsum(shared, axis=1)
                    first = np.take_along_axis(desc[x], np.argmax(nth == 1, axis=1)[:, None], 1)[:, 0]
                    second = np.take_along_axis(desc[x], np.argmax(nth == 2, axis=1)[:, None], 1)[:, 0]
                    here = (first << SHIFT | second) == l[x] & (1 << 2 * SHIFT) - 1
                    ones_a.append(x[here]), ones_b.append(y[here])
                a, b, g = a[~lone], b[~lone], g[~lone]
                if len(a):
                    angle, reach = _angle(g), r[a] + r[b]
                    low, high = np.minimum(unit[a], unit[b]), np.maximum(unit[a], unit[b])
                    every = angle + reach <= theta - SAFE
                    some = ~every & (angle - reach <= theta + SAFE)
                    for kind, which in ((ALL, every), (SOME, some)):
                        if which.any():
                            p = np.unique(np.stack((low[which], high[which])), axis=1)
                            yield _rows(kind, p[0], p[1])
            if ones_a:
                a, b = np.concatenate(ones_a), np.concatenate(ones_b)
                yield from _counted(unit, weight, a, b)
                root = _forest(len(unit), a, b)
                at = np.flatnonzero(root != np.arange(len(unit)))
                if len(at):
                    yield _rows(LINK, unit[root[at]], unit[at])
    return run


def _compare_members(similarity: float, wide: bool) -> Callable:
    """Findings between two units, member by member: rows sorted by (a, b, i, j, side)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups_of(batches, ["a", "b", "i", "j"]):
            keys = [t[c].to_numpy() for c in ("a", "b", "i", "j")]
            node, weight, side = (t[c].to_numpy() for c in ("node", "w", "side"))
            units = _units(t["raw"].to_pylist(), wide)
            starts = _starts(keys)
            for a, b, _ in _close_pairs(units, starts, side, similarity):
                cross = side[a] != side[b]
                a, b = a[cross], b[cross]
                if len(a):
                    yield from _counted(node, weight, a, b)
                    p = np.unique(np.stack((keys[0][a], keys[1][a])), axis=1)
                    yield _rows(LINK, p[0], p[1])
    return run


def _described(nodes: DataFrame, pivots: np.ndarray, wide: bool) -> DataFrame:
    """Adds dim, desc (its nearest references, ascending) and cell (the first of them in order)."""
    k, ordered = min(NEAREST, len(pivots)), min(ORDERED, len(pivots))

    def kernel(batch: pa.RecordBatch) -> pa.Table:
        raw = batch.column(1).to_pylist()
        u = _units(raw, wide).astype(np.float32)
        w = min(u.shape[1], pivots.shape[1])
        near = np.argsort(-(u[:, :w] @ pivots[:, :w].T), axis=1, kind="stable")[:, :k].astype(np.int64)
        cell = np.zeros(len(raw), np.int64)
        for n in range(ordered):
            cell = cell << SHIFT | near[:, n]
        dim = np.array([len(b) // (8 if wide else 4) for b in raw], np.int64)
        desc = pa.FixedSizeListArray.from_arrays(pa.array(np.sort(near, axis=1).ravel()), k).cast(pa.list_(pa.int64()))
        return pa.Table.from_arrays([*batch.columns, pa.array(dim), desc, pa.array(cell)], names=["node", "raw", "w", "low", "dim", "desc", "cell"])

    return arrow_map(nodes.select("node", "raw", "w", "low"), kernel, "node long, raw binary, w long, low long, dim long, desc array<long>, cell long")


def _centres(d: DataFrame, similarity: float, wide: bool) -> DataFrame:
    """(bundle, dim, cell, centre) of the cells that have a dense middle; bundles are numbered below 0."""
    close = float(np.cos(np.arccos(similarity) * 0.75))

    def kernel(batch: pa.RecordBatch) -> pa.Table:
        out = []
        for raws in batch.column(2).to_pylist():
            u = _units(raws, wide)
            near = u @ u.T >= close
            k = int(np.argmax(near.sum(axis=1)))
            c = u[near[k]].sum(axis=0)
            out.append((c / np.linalg.norm(c)).tobytes() if near[k].sum() >= DENSE else None)
        return pa.Table.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["dim", "cell", "centre"])

    w = W.partitionBy("dim", "cell").orderBy(F.xxhash64("raw"), "node")
    fit = d.select("dim", "cell", "raw", "node").withColumn("k", F.row_number().over(w)).filter(F.col("k") <= FITTED)
    fit = fit.groupBy("dim", "cell").agg(F.collect_list("raw").alias("raws")).filter(F.size("raws") >= DENSE)
    found = arrow_map(fit, kernel, "dim long, cell long, centre binary").filter("centre IS NOT NULL")
    return found.select((-1 - F.monotonically_increasing_id()).alias("bundle"), "dim", "cell", "centre")


def _placed(d: DataFrame, centres: DataFrame, similarity: float, wide: bool) -> DataFrame:
    """Adds unit (the bundle of a vector, else the vector itself) and angle (to the bundle's centre)."""
    half = float(np.arccos(similarity)) / 2 - SAFE

    def kernel(batch: pa.RecordBatch) -> pa.Table:
        raw, centre, unit = batch.column(1).to_pylist(), batch.column(7).to_pylist(), batch.column(0).to_numpy().copy()
        angle, at = np.zeros(len(raw)), np.array([k for k, c in enumerate(centre) if c is not None], np.int64)
        if len(at):
            a = _angle(np.einsum("ij,ij->i", _units([raw[k] for k in at], wide), _units([centre[k] for k in at], True)))
            inside = at[a <= half]
            angle[inside] = a[a <= half]
            unit[inside] = batch.column(6).to_numpy(zero_copy_only=False)[inside]
        return pa.Table.from_arrays([*batch.columns[:6], pa.array(unit), pa.array(angle)], names=["node", "raw", "w", "low", "dim", "desc", "unit", "angle"])

    d = d.join(centres, ["dim", "cell"], "left").select("node", "raw", "w", "low", "dim", "desc", F.coalesce("bundle", F.lit(0).cast("long")).alias("bundle"), "centre")
    return arrow_map(d, kernel, "node long, raw binary, w long, low long, dim long, desc array<long>, unit long, angle double")


def _lists(k: int):
    pairs = [F.col("dim") * (1 << 2 * SHIFT) + F.col("desc")[i] * (1 << SHIFT) + F.col("desc")[j] for i in range(k) for j in range(i + 1, k)]
    return F.explode(F.array(*pairs)).alias("l") if pairs else F.explode(F.array().cast("array<long>")).alias("l")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", similarity: float = 0.9) -> DataFrame:
    """(id_col, n_links, component_id, kept) for each row."""
    v = F.col(f"`{vector_col}`")
    wide = not vectors.schema[vector_col].dataType.jsonValue().get("elementType") == "float"
    v = v.cast("array<double>") if wide else v
    fine = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False))

    def pack(batch: pa.RecordBatch) -> pa.Table:
        kind = np.float64 if wide else np.float32
        raw = [np.asarray(x.values, kind).tobytes() if x.is_valid else None for x in batch.column(1)]
        return pa.Table.from_arrays([batch.column(0), pa.array(raw, pa.binary())], names=["id", "raw"])

    rows = cut_lineage(arrow_map(vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.when(fine, v).alias("v")), pack, "id long, raw binary"))
    nodes = rows.filter("raw IS NOT NULL").groupBy("raw").agg(F.count(F.lit(1)).alias("w"), F.min("id").alias("low"))
    nodes = cut_lineage(nodes.withColumn("node", F.monotonically_increasing_id()))
    n = nodes.count()
    picked = nodes.filter(F.pmod(F.xxhash64("raw"), F.lit(-(-n // SAMPLE) or 1)) == 0).select("raw").orderBy("raw").toPandas()["raw"]
    sample = _units([bytes(b) for b in picked], wide)
    pivots = _spread(sample, min(PIVOTS, max(16, n // 8))) if len(sample) else np.zeros((0, 1), np.float32)
    lists = _lists(min(NEAREST, len(pivots)))

    d = cut_lineage(_described(nodes, pivots, wide))
    centres = cut_lineage(_centres(d, similarity, wide))
    d = cut_lineage(_placed(d, centres, similarity, wide))
    units = cut_lineage(d.groupBy("unit").agg(F.sum("w").alias("w"), F.min("low").alias("low"), F.max("angle").alias("r"), F.count(F.lit(1)).alias("members")))
    lone = d.filter("unit >= 0").select("unit", "w", "raw", "desc", F.lit(0.0).alias("r"), lists)
    dense = d.filter("unit < 0").select("unit", lists).distinct().join(units.select("unit", "w", "r"), "unit").join(centres.select(F.col("bundle").alias("unit"), F.col("centre").alias("raw")), "unit")
    entries = lone.union(dense.select("unit", "w", "raw", F.array_repeat(F.lit(-1).cast("long"), min(NEAREST, len(pivots))).alias("desc"), "r", "l"))
    found = cut_lineage(_dealt(entries).mapInArrow(_compare_lists(similarity, wide), FOUND))
    some = cut_lineage(found.filter(F.col("kind") == SOME).select("a", "b").distinct())
    if not some.isEmpty():
        found = found.union(cut_lineage(_met(some, units, d).mapInArrow(_compare_members(similarity, wide), FOUND)))

    every = found.filter(F.col("kind") == ALL).select("a", "b").distinct()
    both = every.union(every.select("b", "a")).toDF("unit", "b")
    of_unit = both.join(units.select(F.col("unit").alias("b"), "w"), "b").groupBy("unit").agg(F.sum("w").alias("more"))
    of_node = found.filter(F.col("kind") == COUNT).groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("own"))
    root = components(found.filter(F.col("kind").isin(LINK, ALL)), "a", "b").select(F.col("node").alias("unit"), "root")
    units = cut_lineage(units.join(of_unit, "unit", "left").join(root, "unit", "left").select("unit", "w", "low", F.coalesce("more", F.lit(0)).alias("more"), F.coalesce("root", "unit").alias("root")))
    least = units.groupBy("root").agg(F.min("low").alias("component_id"))
    units = units.join(least, "root").select("unit", (F.col("w") - 1 + F.col("more")).alias("base"), "component_id")
    nodes = d.select("node", "raw", "unit").join(units, "unit").join(of_node, "node", "left").select("raw", (F.col("base") + F.coalesce("own", F.lit(0))).alias("n_links"), "component_id")
    linked = rows.filter("raw IS NOT NULL").join(nodes, "raw").select("id", "n_links", "component_id")
    alone = rows.filter("raw IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.union(alone).select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _dealt(entries: DataFrame) -> DataFrame:
    """Entries sorted by list; those of long lists in blocks, each block with every other."""
    long = cut_lineage(entries.groupBy("l").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BLOCK).select("l", F.ceil(F.col("n") / BLOCK).cast("long").alias("blocks")))
    n = long.count()
    if n:
        entries = entries.join(F.broadcast(long) if n <= 100_000 else long, "l", "left")
        own = F.pmod(F.xxhash64("unit"), F.coalesce("blocks", F.lit(1)))
        entries = entries.withColumn("own", own).withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("blocks", F.lit(1)) - 1)))
        entries = entries.withColumn("i", F.least("own", "with")).withColumn("j", F.greatest("own", "with")).withColumn("side", F.when(F.col("own") == F.col("i"), 0).otherwise(1))
    else:
        entries = entries.select("*", F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j"), F.lit(0).alias("side"))
    d = entries.select("l", "i", "j", "side", "unit", "w", "r", "raw", "desc")
    return d.repartition("l", "i", "j").sortWithinPartitions("l", "i", "j", "side")


def _met(pairs: DataFrame, units: DataFrame, members: DataFrame) -> DataFrame:
    """Members of both units of each pair, in blocks, each block of the one with each of the other."""
    blocks = units.select("unit", F.ceil(F.col("members") / BLOCK).cast("long").alias("blocks"))
    upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    p = pairs.join(blocks.toDF("a", "na"), "a").join(blocks.toDF("b", "nb"), "b").select("a", "b", upto("na").alias("i"), "nb").select("a", "b", "i", upto("nb").alias("j"))
    m = members.join(blocks, "unit").select("unit", "node", "w", "raw", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"))
    left = p.join(m.withColumnsRenamed({"unit": "a", "block": "i"}), ["a", "i"]).withColumn("side", F.lit(0))
    right = p.join(m.withColumnsRenamed({"unit": "b", "block": "j"}), ["b", "j"]).withColumn("side", F.lit(1))
    cols = ["a", "b", "i", "j", "side", "node", "w", "raw"]
    return left.select(*cols).union(right.select(*cols)).repartition("a", "b", "i", "j").sortWithinPartitions("a", "b", "i", "j", "side")
