"""Near duplicates by 64-bit SimHash fingerprints, linked with vantage-point trees.

Method: fingerprints that differ in at most `radius` bits differ in at most radius // 4 bits of one of their four 16-bit quarters.
For each quarter a vantage-point tree splits the fingerprints by the Hamming distance of that quarter to a vantage point. A
fingerprint lives in one leaf and also visits the leaves that its ball overlaps by the triangle inequality; all other branches are
pruned. The upper levels are drawn up on the driver from at most SAMPLE fingerprints and deal out the shards; within a shard the
tree goes on until a leaf is small, where full distances are compared. A shard returns links that span its groups, not all pairs;
connected components over all shards are found with Spark joins. Only distinct fingerprints take part.

Cases: a null or empty text has fingerprint 0 and is linked like any other; a null id belongs to its group but is never the group's id
unless the group has no other; rows of equal id and text are one document, each of them is returned; other columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tablescout.llm.common import arrow_map, components, keyed
from tablescout.session import cut_lineage

SAMPLE = 8192  # fingerprints that the driver sees to place the upper splits
SHARD = 16384  # fingerprints that live in a shard, on average
LEAF = 256  # below it, or where a split does not help, distances are compared


def fingerprint(text: bytes, width: int) -> int:
    """Signed 64-bit fingerprint of the word shingles of a text."""
    from xxhash import xxh64_digest
    words = text.lower().split()  # of bytes: lower-cases A-Z, splits at [\x20\x09-\x0D]
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    if n == 1:
        digests = xxh64_digest(b" ".join(words), 42)
    else:
        flat = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
        digests = b"".join([xxh64_digest(flat[a:b], 42) for a, b in zip(starts, (ends[width - 1:] - 1).tolist())])
    bits = np.zeros(64, dtype=np.int64)
    octets = np.frombuffer(digests, dtype=np.uint8).reshape(n, 8)
    for a in range(0, n, 65536):
        bits += np.unpackbits(octets[a:a + 65536], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, width: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_i, _h, doc_id, fp) for each row."""
    def kernel(batch: pa.RecordBatch) -> pa.Table:
        fp = [fingerprint(t.as_py() or b"", width) for t in batch.column(3)]
        return pa.Table.from_arrays([*batch.columns[:3], pa.array(fp, pa.int64())], names=["_i", "_h", "doc_id", "fp"])

    d = keyed(docs, id_col, text_col).select("_i", "_h", F.col(f"_row.`{id_col}`").cast("long").alias("doc_id"), F.col("_t").cast("binary").alias("t"))
    return arrow_map(d, kernel, "_i long, _h long, doc_id long, fp long")


def quarter(x: np.ndarray, j: int) -> np.ndarray:
    return (x >> np.uint64(16 * j)) & np.uint64(0xFFFF)


def upper_tree(sample: np.ndarray, levels: int, seed: int = 7) -> list[list[tuple[int, int]]]:
    """For each quarter a heap of (vantage point, split distance): distance <= split goes left."""
    rng = np.random.default_rng(seed)
    trees = []
    for j in range(4):
        q, node, heap = quarter(sample, j), np.zeros(len(sample), dtype=np.int64), []
        for level in range(levels):
            for k in range(2**level):
                at = np.flatnonzero(node == 2**level - 1 + k)
                v = int(rng.integers(0, 65536))
                d = np.bitwise_count(q[at] ^ np.uint64(v)).astype(np.int64)
                cut = int(np.median(d)) if len(d) else 8
                if len(d) and (d > cut).sum() == 0 and cut > 0:
                    cut -= 1
                heap.append((v, cut))
                node[at] = 2 * node[at] + 1 + (d > cut)
        trees.append(heap)
    return trees


def branches(q: np.ndarray, heap: list[tuple[int, int]], levels: int, near: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(point, node, whether it lives there): leaves of an upper tree that the balls of radius `near` overlap."""
    at, node, home = np.arange(len(q)), np.zeros(len(q), dtype=np.int64), np.ones(len(q), dtype=bool)
    v, cut = (np.array(c) for c in zip(*heap)) if levels else (np.zeros(1, int), np.zeros(1, int))
    for _ in range(levels):
        d = np.bitwise_count(q[at] ^ v[node].astype(np.uint64)).astype(np.int64)
        r = cut[node]
        left, right = d - near <= r, d + near > r
        at = np.concatenate((at[left], at[right]))
        home = np.concatenate(((home & (d <= r))[left], (home & (d > r))[right]))
        node = np.concatenate((2 * node[left] + 1, 2 * node[right] + 2))
    return at, node, home


def _deal(trees, levels: int, near: int):
    def kernel(batch: pa.RecordBatch) -> pa.Table:
        x = np.asarray(batch.column(0)).view(np.uint64)
        shards, points, homes = [], [], []
        for j in range(4):
            at, node, home = branches(quarter(x, j), trees[j], levels, near)
            shards.append(node + j * 2**(levels + 1))
            points.append(x[at].view(np.int64))
            homes.append(home)
        return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in (shards, points, homes)], names=["shard", "fp", "home"])
    return kernel


def spanning_links(x: np.ndarray, home: np.ndarray, number: int, near: int, radius: int) -> np.ndarray:
    """Root of each point of a shard: points that links within `radius` join, each link with an end at home, have one root."""
    root = np.arange(len(x))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def compare(at: np.ndarray, lives: np.ndarray) -> None:
        mine = at[lives]
        step = max(1, 2_000_000 // max(1, len(at)))
        for s in range(0, len(mine), step):
            part = mine[s:s + step]
            i, j = np.nonzero(np.bitwise_count(x[part][:, None] ^ x[at][None, :]) <= radius)
            a, b = root[part[i]], root[at[j]]
            new = a != b
            if new.any():
                for p, q in np.unique(np.stack((a[new], b[new]), axis=1), axis=0).tolist():
                    p, q = find(p), find(q)
                    if p != q:
                        root[max(p, q)] = min(p, q)
                while (root[root] != root).any():
                    root[:] = root[root]

    rng, todo = np.random.default_rng(11), [(np.arange(len(x)), home, 0)]
    q = quarter(x, number)
    while todo:
        at, lives, fails = todo.pop()
        n = int(lives.sum())
        if n <= LEAF or fails > 3:
            if n:
                compare(at, lives)
            continue
        d = np.bitwise_count(q[at] ^ np.uint64(rng.integers(0, 65536))).astype(np.int64)
        cut = int(np.median(d[lives]))
        left, right = d - near <= cut, d + near > cut
        l_home, r_home = (lives & (d <= cut))[left], (lives & (d > cut))[right]
        if left.all() and l_home.sum() == n or right.all() and r_home.sum() == n or not l_home.any() or not r_home.any():
            todo.append((at, lives, fails + 1))
            continue
        todo += [(at[left], l_home, 0), (at[right], r_home, 0)]
    return root


def links(distinct_fp: DataFrame, radius: int = 4) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) whose connected components are those of all links."""
    n = distinct_fp.count()
    levels = max(0, int(np.ceil(np.log2(max(1, n) / SHARD))))
    sample = distinct_fp.sample(min(1.0, SAMPLE / max(1, n)), seed=5).limit(2 * SAMPLE).toPandas()["fp"].to_numpy(dtype=np.int64).view(np.uint64) if levels else np.zeros(0, np.uint64)
    near = radius // 4
    dealt = arrow_map(distinct_fp, _deal(upper_tree(sample, levels), levels, near), "shard long, fp long, home boolean")

    def shard(t: pa.Table) -> pa.Table:
        x = np.asarray(t["fp"].combine_chunks()).view(np.uint64)
        home = np.asarray(t["home"].combine_chunks())
        root = spanning_links(x, home, int(t["shard"][0].as_py()) >> (levels + 1), near, radius)
        at = np.flatnonzero(root != np.arange(len(x)))
        return pa.Table.from_arrays([pa.array(x[at].view(np.int64)), pa.array(x[root[at]].view(np.int64))], names=["a", "b"])

    return dealt.groupBy("shard").applyInArrow(shard, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_i, _h, doc_id, fingerprint, component_id, first): `first` marks the one document of each group that stays."""
    d = cut_lineage(fingerprints(docs, width, id_col, text_col))
    fps = cut_lineage(d.groupBy("fp").agg(F.min("doc_id").alias("low"), F.min(F.struct(F.col("doc_id").isNull(), "_i", "_h")).alias("one")))
    comp = components(links(fps.select("fp"), radius), "a", "b")
    of = fps.join(comp.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    best = of.groupBy("root").agg(F.min("low").alias("component_id"), F.min("one").alias("one"))
    of = of.select("fp", "root").join(best, "root").select("fp", "component_id", "one")
    return d.join(of, "fp").select("_i", "_h", "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
                                   (F.struct(F.col("doc_id").isNull(), "_i", "_h") == F.col("one")).alias("first"))


def without_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The first document of each group, once."""
    stays = near_duplicates(docs, **options).filter("first").select("_i", "_h").distinct()
    d = keyed(docs).join(stays, ["_i", "_h"]).dropDuplicates(["_i", "_h"])
    return d.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
