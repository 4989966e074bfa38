"""Near copies: texts whose sets of word shingles have a Jaccard similarity of at least `similarity`, in connected components.

Method: as in `simhash`, fingerprints of word shingles and vantage-point trees, then an exact check. Similar sets differ in some 15 % of
their fingerprints' bits, so a set has WORDS fingerprints of 64 bits. Each quarter of each has its tree, which finds the sets that differ
there in at most NEAR bits; they are tied if three of the fingerprints differ in at most BITS of 192. A pair of similarity 0.8 escapes all
quarters with a probability of 2e-6 (of 5 shingles or fewer: 6e-4). The upper levels of the trees deal out shards, a shard gives ties
that span its groups, and what is connected by ties is a family, so that pairs are never listed. A
family goes to one cell, where an index of its shingles gives the exact similarity of one member to all others at once; members of
the largest component found so far need no turn. A family too large for a cell is dealt by vantage points: its members are linked to
POINTS of them and fall into rings by their Jaccard distance to the first. By the triangle inequality a member has to visit only
the rings that its ball of radius 1 - similarity overlaps, and none where all belong to its component already. Visitors of a cell are
held against its index one by one. A cell gives links that span its groups, not all pairs.
Only distinct shingle sets take part; texts are read again for members of families only.

Cases: texts of fewer than `width` words are one shingle; null and empty texts are copies of each other; a null id is never the first of
its group unless the group has no other; rows of equal id and text are one document; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from tablescout.llm.common import arrow_map, components, keyed
from tablescout.llm.simhash import SAMPLE, branches, quarter, upper_tree
from tablescout.session import Rounds, cut_lineage

WORDS = 10  # fingerprints of a set
BANDS = 4 * WORDS  # their quarters, a tree for each
NEAR = 1  # bits of a quarter
BITS = 56  # bits of three fingerprints; sets without a common shingle differ in 96
SHARD = 1 << 19  # sets that live in a shard, on average
LEAF = 128  # values of a quarter below which they are compared
PAIRS = 1 << 18  # compared at once
BLOCK = 1 << 14  # shingles
OPEN = 64  # a cell is to hold OPEN * BLOCK shingles at home
OWN = 64  # what a member counts for beside its shingles
POINTS = 16  # vantage points of a family larger than a cell
FLIP = np.random.default_rng(17).integers(0, 2**64, WORDS, dtype=np.uint64)


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles."""
    from xxhash import xxh64_digest
    words = text.lower().split()  # of bytes: lower-cases A-Z, splits at [\x20\x09-\x0D]
    if not words:
        return np.zeros(0, np.uint64)
    parts = [xxh64_digest(b" ".join(words[i:i + width]), 42) for i in range(max(1, len(words) - width + 1))]
    return np.unique(np.frombuffer(b"".join(parts), np.uint64))


def fingerprints(s: np.ndarray) -> np.ndarray:
    """WORDS signed fingerprints: a bit is 1 if set in over half of the hashes."""
    bits = np.zeros(64 * WORDS, np.int64)
    for a in range(0, len(s), 2048):
        x = s[a:a + 2048, None] ^ FLIP
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        bits += np.unpackbits(x.view(np.uint8), axis=1).sum(axis=0, dtype=np.uint16)
    return np.packbits(2 * bits > len(s)).view(np.int64)


def _key(s: np.ndarray) -> int:
    from xxhash import xxh3_64_intdigest
    return int(np.uint64(xxh3_64_intdigest(s.tobytes())).view(np.int64))


def _signatures(width: int):
    def kernel(batch: pa.RecordBatch) -> pa.Table:
        sets = [shingles(t.as_py(), width) for t in batch.column(3)]
        return pa.Table.from_arrays([*batch.columns[:3], pa.array([_key(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int32()),
                                     pa.array([fingerprints(s) for s in sets], pa.list_(pa.int64()))], names=["null", "_i", "_h", "k", "n", "b"])
    return kernel


def _deal(trees, levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = np.asarray(batch.column(0))
            x = np.asarray(batch.column(1).flatten()).reshape(-1, WORDS)
            for b in range(BANDS if len(k) else 0):
                w, j = divmod(b, 4)
                at, node, home = branches(quarter(x[:, w].view(np.uint64), j), trees[w][j], levels, NEAR)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (node + b * 2**(levels + 1), home, k[at], *(x[at, (w + i) % WORDS] for i in range(3)))],
                                                 names=["shard", "home", "k", "x", "y", "z"])
    return run


def near_values(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of all distinct 16-bit values v[i] <= v[j] that differ in at most NEAR bits, by a vantage-point tree."""
    rng, todo, out = np.random.default_rng(11), [(np.arange(len(v)), np.ones(len(v), bool), 0)], []
    while todo:
        at, lives, fails = todo.pop()
        n = int(lives.sum())
        if n <= LEAF or fails > 3:
            mine = at[lives]
            i, j = np.nonzero((np.bitwise_count(v[mine][:, None] ^ v[at][None, :]) <= NEAR) & (mine[:, None] <= at[None, :]))
            out.append((mine[i], at[j]))
            continue
        d = np.bitwise_count(v[at] ^ np.uint16(rng.integers(0, 65536))).astype(np.int64)
        cut = int(np.median(d[lives]))
        left, right = d - NEAR <= cut, d + NEAR > cut
        l_home, r_home = (lives & (d <= cut))[left], (lives & (d > cut))[right]
        if not l_home.any() or not r_home.any():
            todo.append((at, lives, fails + 1))
            continue
        todo += [(at[left], l_home, 0), (at[right], r_home, 0)]
    return tuple(np.concatenate(c) for c in zip(*out))


class Ties:
    """Components of the sets of a shard, of which `x` holds three fingerprints."""

    def __init__(self, x: np.ndarray, home: np.ndarray):
        self.x, self.home, self.root = x, home, np.arange(len(x))

    def find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def compare(self, p: np.ndarray, r: np.ndarray) -> None:
        new = (self.home[p] | self.home[r]) & (self.root[p] != self.root[r])
        p, r = p[new], r[new]
        near = np.bitwise_count(self.x[p] ^ self.x[r]).sum(axis=1, dtype=np.int64) <= BITS
        if not near.any():
            return
        for a, b in np.unique(np.stack((self.root[p[near]], self.root[r[near]]), axis=1), axis=0).tolist():
            a, b = self.find(a), self.find(b)
            self.root[max(a, b)] = min(a, b)
        while (self.root[self.root] != self.root).any():
            self.root = self.root[self.root]

    def settle(self, at: np.ndarray) -> None:
        """All pairs of `at`. In the end all outside the largest component have had a turn."""
        done, turn = np.zeros(len(at), bool), 1
        while True:
            names, group = np.unique(self.root[at], return_inverse=True)
            open_ = np.flatnonzero(~done & (group != np.bincount(group).argmax()))
            if not len(open_):
                return
            open_ = open_[:max(1, min(turn, PAIRS // len(at)))]
            done[open_] = True
            turn *= 2
            self.compare(np.repeat(at[open_], len(at)), np.tile(at, len(open_)))


def spanning_roots(x: np.ndarray, home: np.ndarray, number: int) -> np.ndarray:
    """Root of each set of a shard: tied sets, one of them at home, have one root."""
    ties, q = Ties(x, home), quarter(x[:, 0], number).astype(np.uint16)
    order = np.argsort(q, kind="stable")
    values, start, count = np.unique(q[order], return_index=True, return_counts=True)
    a, b = near_values(values)
    work = count[a] * count[b]
    for i in np.flatnonzero(work > PAIRS):
        of = lambda v: order[start[v]:start[v] + count[v]]
        ties.settle(of(a[i]) if a[i] == b[i] else np.concatenate((of(a[i]), of(b[i]))))
    a, b, work = (c[work <= PAIRS] for c in (a, b, work))
    cuts = np.flatnonzero(np.diff(np.cumsum(work) // PAIRS)) + 1
    for a, b, work in zip(np.split(a, cuts), np.split(b, cuts), np.split(work, cuts)):
        pair = np.repeat(np.arange(len(work)), work)
        first, second = np.divmod(np.arange(len(pair)) - np.repeat(np.cumsum(work) - work, work), count[b][pair])
        ties.compare(order[start[a][pair] + first], order[start[b][pair] + second])
    return ties.root


def fingerprint_ties(sets: DataFrame) -> DataFrame:
    """(k, lead): ties of sets of near fingerprints (column b), spanning their groups."""
    n = sets.count()
    levels = max(0, int(np.ceil(np.log2(max(1, n) / SHARD))))
    sample = np.zeros((0, WORDS), np.uint64)
    if levels:
        rows = sets.select("b").sample(min(1.0, SAMPLE / n), seed=5).limit(2 * SAMPLE).collect()
        sample = np.array([r.b for r in rows], np.int64).reshape(-1, WORDS).view(np.uint64)
    trees = [upper_tree(sample[:, w], levels) for w in range(WORDS)]
    dealt = sets.select("k", "b").mapInArrow(_deal(trees, levels), "shard long, home boolean, k long, x long, y long, z long")

    def shard(t: pa.Table) -> pa.Table:
        x = np.stack([np.asarray(t[c].combine_chunks()).view(np.uint64) for c in "xyz"], axis=1)
        k, home = (np.asarray(t[c].combine_chunks()) for c in ("k", "home"))
        root = spanning_roots(x, home, (int(t["shard"][0].as_py()) >> (levels + 1)) % 4)
        at = np.flatnonzero(root != np.arange(len(x)))
        return pa.Table.from_arrays([pa.array(k[at]), pa.array(k[root[at]])], names=["k", "lead"])

    return dealt.groupBy("shard").applyInArrow(shard, "k long, lead long").distinct()


class Cell:
    """Members of a cell and an index of their shingles; `links` spans the components found."""

    def __init__(self, keys: list[int], roots: list[int], sets: list[np.ndarray], similarity: float):
        self.keys, self.similarity, self.links = keys, similarity, []
        self.sizes = np.array([len(s) for s in sets])
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        self.flat, self.owner = flat[order], np.repeat(np.arange(len(sets)), self.sizes)[order]
        names, self.group = np.unique(np.array(roots), return_inverse=True)
        self.name = {r: g for g, r in enumerate(names.tolist())}

    def near(self, s: np.ndarray) -> np.ndarray:
        """Members of a similar set."""
        first, end = np.searchsorted(self.flat, s), np.searchsorted(self.flat, s, "right")
        many = end - first
        at = np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())
        both = np.bincount(self.owner[at], minlength=len(self.keys))
        return np.flatnonzero(both >= self.similarity * (len(s) + self.sizes - both))

    def join(self, key: int, near: np.ndarray, group: int | None) -> None:
        """Links of `key`, which belongs to `group`, to one member of each other group that it is near to."""
        groups, first = np.unique(self.group[near], return_index=True)
        self.links += [(key, self.keys[near[i]]) for g, i in zip(groups.tolist(), first.tolist()) if g != group]
        if len(groups):
            self.group[np.isin(self.group, groups)] = groups[0] if group is None else group

    def settle(self, sets: list[np.ndarray]) -> None:
        """Links among the members. In the end all those outside the largest component have had a turn."""
        done = np.zeros(len(sets), bool)
        while True:
            open_ = np.flatnonzero(~done & (self.group != np.bincount(self.group).argmax()))
            if not len(open_):
                return
            q = int(open_[0])
            done[q] = True
            self.join(self.keys[q], self.near(sets[q]), int(self.group[q]))

    def visit(self, key: int, root: int, s: np.ndarray) -> None:
        known = self.name.get(root)
        if known is None or (self.group != known).any():
            self.join(key, self.near(s), None)


def _cells(width: int, similarity: float):
    """Rows of a cell lie together: its members, then its visitors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settled() -> Cell:
            c = Cell(keys, roots, sets, similarity)
            c.settle(sets)
            return c

        def links(found: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

        now, cell, keys, roots, sets = None, None, [], [], []
        for batch in batches:
            for at, visits, k, r, t in zip(*(batch.column(i).to_pylist() for i in range(4)), batch.column(4)):
                if at != now:
                    if keys:
                        yield links((cell or settled()).links)
                    now, cell, keys, roots, sets = at, None, [], [], []
                if visits and not keys:  # a part of a ring that the hash left empty
                    continue
                s = shingles(t.as_py(), width)
                if not visits:
                    keys.append(k)
                    roots.append(r)
                    sets.append(s)
                    continue
                cell = cell or settled()
                cell.visit(k, r, s)
        if keys:
            yield links((cell or settled()).links)
    return run


def _distances(width: int, similarity: float):
    """Rows of a block lie together: the vantage points of its family (`place` from 1), then its members (`place` 0)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, points = None, []
        for batch in batches:
            out = []
            for at, place, k, t in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3)):
                if at != now:
                    now, points = at, []
                s = shingles(t.as_py(), width)
                if place:
                    points.append((place, k, s))
                    continue
                linked, d = [], 1.0
                for number, p, o in points:
                    both = len(np.intersect1d(s, o, assume_unique=True))
                    if both >= similarity * (len(s) + len(o) - both) and p != k:
                        linked.append(p)
                    if number == 1:
                        d = 1 - both / max(1, len(s) + len(o) - both)
                out.append((k, d, linked))
            kinds = (pa.int64(), pa.float64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)], names=["k", "d", "p"])
    return run


def _ringed(large: DataFrame, content: DataFrame, rounds: Rounds, width: int, similarity: float, room: float) -> tuple[DataFrame, DataFrame]:
    """(links to vantage points; cell, visits, k, r of the members of families that are larger than a cell)."""
    parts = int(large.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = W.partitionBy("f").orderBy(F.xxhash64("k"), "k")
    points = rounds.put("points", large.select("f", "k", "blocks", F.row_number().over(first).alias("place")).filter(F.col("place") <= POINTS))
    block = lambda c: F.xxhash64("f", c)
    rows = points.select("f", "place", "k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("x"))
    rows = rows.select(block("x").alias("at"), "place", "k").union(
        large.select(block(F.pmod(F.xxhash64("k"), "blocks")).alias("at"), F.lit(0).alias("place"), "k"))
    rows = rows.join(content, "k").select("at", "place", "k", "t")
    far = rows.repartition(parts, "at").sortWithinPartitions("at", F.col("place") == 0, "place").mapInArrow(_distances(width, similarity), "k long, d double, p array<long>")
    far = rounds.put("far", far)
    links = rounds.put("pointed", far.select(F.col("k").alias("a"), F.explode("p").alias("b")))
    root = components(links, "a", "b", lambda df: rounds.put("point_stars", df)).select(F.col("node").alias("k"), F.col("root").alias("r"))
    member = rounds.put("member", large.select("f", "k", "w").join(far.select("k", "d"), "k").join(root, "k", "left")
                        .select("f", "k", "w", "d", F.coalesce("r", "k").alias("r"), F.floor(F.col("d") * 100).alias("bin")))
    # at most 101 bins of a family, as many neighbouring ones in a ring as fill a cell; a bin that is larger is split
    bins = member.groupBy("f", "bin").agg(F.sum("w").alias("w"), F.max("d").alias("top"), F.min("r").alias("lo"), F.max("r").alias("hi"))
    before = F.coalesce(F.sum("w").over(W.partitionBy("f").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    bins = rounds.put("bins", bins.withColumn("ring", F.floor(before / F.lit(room))))
    rings = bins.groupBy("f", "ring").agg(F.max("top").alias("top"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.ceil(F.sum("w") / F.lit(room)).alias("parts"))
    rings = rounds.put("rings", rings)
    own = member.join(bins.select("f", "bin", "ring"), ["f", "bin"]).join(rings.select("f", "ring", "parts"), ["f", "ring"])
    own = own.select("f", "k", "d", "r", "ring", F.pmod(F.xxhash64("k", F.lit(1)), "parts").alias("part"))
    all_ = rings.select(F.col("f").alias("g"), F.col("ring").alias("to"), "top", "lo", "hi", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("slot"))
    # of two cells the members of the farther one visit the nearer one
    visits = own.join(all_, (F.col("f") == F.col("g")) & ((F.col("to") < F.col("ring")) | (F.col("to") == F.col("ring")) & (F.col("slot") < F.col("part")))
                      & (F.col("top") >= F.col("d") - (1 - similarity) - 1e-9) & ~((F.col("lo") == F.col("hi")) & (F.col("lo") == F.col("r"))))
    cells = own.select(F.xxhash64("f", "ring", "part").alias("cell"), F.lit(False).alias("visits"), "k", "r").union(
        visits.select(F.xxhash64("f", "to", "slot").alias("cell"), F.lit(True).alias("visits"), "k", "r"))
    return links, cells


def verified_links(sets: DataFrame, docs: DataFrame, width: int, similarity: float) -> DataFrame | None:
    """(a, b) of keys of `sets` whose components are those of all similar pairs in a family; None without a family."""
    spark, rounds = sets.sparkSession, Rounds(sets.sparkSession, "copies")
    room, parts = OPEN * BLOCK, int(spark.conf.get("spark.sql.shuffle.partitions"))
    ties = rounds.put("ties", fingerprint_ties(sets))
    if ties.isEmpty():
        return None
    family = components(ties, "k", "lead", lambda df: rounds.put("stars", df)).select(F.col("node").alias("k"), F.col("root").alias("f"))
    family = rounds.put("family", sets.join(family, "k").select("f", "k", (F.col("n") + OWN).alias("w"), "one._i", "one._h"))
    texts = keyed(docs).select("_i", "_h", F.col("_t").cast("binary").alias("t"))
    content = rounds.put("content", texts.join(family.select("k", "_i", "_h"), ["_i", "_h"]).dropDuplicates(["k"]).select("k", "t"))
    sizes = family.groupBy("f").agg(F.sum("w").alias("all")).withColumn("blocks", F.ceil(F.col("all") / F.lit(room)))
    large = rounds.put("large", family.join(sizes.filter("blocks > 1"), "f").select("f", "k", "w", "blocks"))
    small = family.join(sizes.filter("blocks = 1"), "f")
    links, cells = spark.createDataFrame([], "a long, b long"), small.select(F.col("f").alias("cell"), F.lit(False).alias("visits"), "k", F.col("k").alias("r"))
    if not large.isEmpty():
        links, ringed = _ringed(large, content, rounds, width, similarity, room)
        cells = cells.union(ringed)
    cells = rounds.put("cells", cells).join(content, "k").select("cell", "visits", "k", "r", "t")
    found = cells.repartition(parts, "cell").sortWithinPartitions("cell", "visits").mapInArrow(_cells(width, similarity), "a long, b long")
    return rounds.put("found", found.union(links))


def without_near_copies(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """The first document of each group of near copies, once."""
    t = keyed(docs).select(F.col("_row.doc_id").isNull().alias("null"), "_i", "_h", F.col("_t").cast("binary").alias("t"))
    d = arrow_map(t, _signatures(width), "null boolean, _i long, _h long, k long, n int, b array<long>")
    sets = cut_lineage(d.groupBy("k").agg(F.min(F.struct("null", "_i", "_h")).alias("one"), F.min("n").alias("n"), F.min("b").alias("b")))
    links = verified_links(sets, docs, width, similarity)
    best = sets.select("k", "one")
    if links is not None:
        root = components(links, "a", "b").select(F.col("node").alias("k"), "root")
        best = best.join(root, "k", "left").groupBy(F.coalesce("root", "k").alias("k")).agg(F.min("one").alias("one"))
    kept = keyed(docs).join(best.select("one._i", "one._h"), ["_i", "_h"]).dropDuplicates(["_i", "_h"])
    return kept.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
