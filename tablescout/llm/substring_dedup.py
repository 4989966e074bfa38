"""Byte strings of a fixed length that occur more than once.

Method: a distributed merge sort of suffixes that knows common prefixes. Of each window of q-grams only the suffix at its smallest
hash is taken (leftmost of equals), so equal strings of `length` bytes take equal suffixes at equal offsets and each string has one
suffix in charge. Suffixes whose shared prefix is unique in the corpus are left out by its hash, and those whose whole reach is
repeated are settled by theirs. The others are cut from the texts, sorted locally into front-coded runs, exchanged, and merged by
loser trees that keep the common prefix of each head and never compare it again. Neighbours in the merged order, with the bytes to
their left, tell exactly which strings occur twice. Hot prefixes (more than HOT different reaches) do not meet in one task: each
string of theirs is counted by a 128-bit hash with partial sums instead.

Cases: a null or empty text has no bytes; texts shorter than `length` keep all; rows of equal id and text are one document, each of them
is returned, so they are no copies of each other; matches do not cross documents; other columns play no part; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tablescout.llm.common import arrow_map, keyed
from tablescout.session import cut_lineage

GRAM = 8
HOT = 20_000  # different reaches of one prefix that a task merges
RUN_ROWS = 20_000  # suffixes of a merge task, on average
ENTRY = "<qqqBHHH"  # document key, place, whether settled, common prefix, rest, left


def window_of(length: int) -> int:
    """Q-grams of a window: the largest power of two that fits, with its q-grams, into the string."""
    return 1 << ((length - GRAM + 1).bit_length() - 1)


def anchors(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, first, last): suffixes, and the first and last start of the strings each is in charge of."""
    n, w = len(data), window_of(length)
    if n < length:
        return (np.zeros(0, np.int64),) * 3
    g = np.frombuffer(data, np.uint8).astype(np.uint64)
    for s in (1, 2, 4):
        g = g[:-s] | (g[s:] << np.uint64(8 * s))
    g = g * np.uint64(0x9E3779B97F4A7C15)
    g ^= g >> np.uint64(29)
    g *= np.uint64(0xBF58476D1CE4E5B9)
    m = (g & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(g), dtype=np.uint64)
    s = 1
    while s < w:
        m = np.minimum(m[:-s], m[s:])
        s *= 2
    at = (m[:n - length + 1] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    return at[new], new, np.concatenate((new[1:], [len(at)])) - 1


def common(x: bytes, y: bytes, start: int) -> int:
    """Length of the common prefix, of which `start` bytes are known."""
    end = min(len(x), len(y))
    while start < end:
        a, b = x[start:start + 64], y[start:start + 64]
        if a != b:
            n = min(len(a), len(b))
            d = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
            return start + (n if d == 0 else (8 * n - d.bit_length()) // 8)
        start += len(a)
    return end


def merge(runs: list[tuple[list[bytes], list[int]]]) -> list[tuple[int, int, int]]:
    """(run, index, common prefix with the one before) of all strings of sorted runs, in order."""
    size = 1
    while size < len(runs):
        size *= 2
    text = [r[0] for r in runs] + [[]] * (size - len(runs))
    prefix = [r[1] for r in runs]
    at, known = [0] * size, [0 if t else -1 for t in text]  # -1: at its end, loses to all
    loser = [0] * size

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the known prefix of the loser becomes the one it shares with the winner."""
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        if known[a] < 0:
            return a, b
        x, y = text[a][at[a]], text[b][at[b]]
        c = common(x, y, known[a])
        if c == len(x) or (c < len(y) and x[c] < y[c]):
            known[b] = c
            return a, b
        known[a] = c
        return b, a

    def build(node: int) -> int:
        if node >= size:
            return node - size
        win, loser[node] = play(build(2 * node), build(2 * node + 1))
        return win

    best, out = build(1), []
    while known[best] >= 0:
        out.append((best, at[best], known[best]))
        at[best] += 1
        known[best] = prefix[best][at[best]] if at[best] < len(text[best]) else -1
        node = (best + size) // 2
        while node:
            best, loser[node] = play(best, loser[node])
            node //= 2
    return out


def repeats(rights: list[bytes], shared: list[int], lefts: list[bytes], most: np.ndarray, least: np.ndarray, length: int) -> list[tuple[int, int]]:
    """For each of a group of neighbours (largest, smallest) offset of its strings that another holds as well; (-1, ..) if none.

    shared: common prefix with the one before; lefts: bytes before the suffix, reversed; offsets run from least to most.
    """
    n = len(rights)
    high, low = [-1] * n, [length] * n
    if n <= 8:
        for a in range(n):
            r = length
            for b in range(a + 1, n):
                r = min(r, shared[b])
                top = min(int(most[a]), int(most[b]), common(lefts[a], lefts[b], 0))
                bottom = max(int(least[a]), int(least[b]), length - r)
                if bottom <= top:
                    for k in (a, b):
                        high[k], low[k] = max(high[k], top), min(low[k], bottom)
        return list(zip(high, low))
    order = sorted(range(n), key=lefts.__getitem__)
    left_shared = np.array([0] + [common(lefts[a], lefts[b], 0) for a, b in zip(order, order[1:])])
    shared = np.array([0, *shared[1:]])
    high, low = np.array(high), np.array(low)
    left_class = np.empty(n, dtype=np.int64)
    for o in range(int(least.min()), int(most.max()) + 1):
        left_class[order] = np.cumsum(left_shared < o)
        on = np.flatnonzero((least <= o) & (o <= most))
        code = np.cumsum(shared < length - o)[on] * (n + 1) + left_class[on]
        _, inverse, count = np.unique(code, return_inverse=True, return_counts=True)
        twice = on[count[inverse] > 1]
        high[twice] = o
        low[twice] = np.minimum(low[twice], o)
    return list(zip(high.tolist(), low.tolist()))


def _suffixes(length: int):
    right = length - window_of(length) + 1

    def kernel(batch: pa.RecordBatch) -> pa.Table:
        from xxhash import xxh64_intdigest
        k1, k2, row, place = [], [], [], []
        for r, t in enumerate(batch.column(2)):
            data = t.as_py()
            p, a, b = anchors(data, length)
            packed = (p << 20 | (p - a) << 10 | (p - b)).tolist()
            for p, a, b, x in zip(p.tolist(), a.tolist(), b.tolist(), packed):
                k1.append(xxh64_intdigest(data[p:p + right]))
                k2.append(xxh64_intdigest(data[a:b + length], x & 0xFFFFF))
            row += [r] * len(packed)
            place += packed
        row = pa.array(row, pa.int32())
        keys = [pa.array(np.array(k, dtype=np.uint64).view(np.int64)) for k in (k1, k2)]
        return pa.Table.from_arrays([*keys, batch.column(0).take(row), batch.column(1).take(row), pa.array(place, pa.int64())], names=["k1", "k2", "_i", "_h", "at"])
    return kernel


def _place(at: int) -> tuple[int, int, int]:
    """(place, largest, smallest offset) of a packed suffix."""
    return at >> 20, at >> 10 & 1023, at & 1023


def _runs(length: int, targets: int):
    def kernel(batch: pa.RecordBatch) -> pa.Table:
        by = defaultdict(list)
        for i, h, packed, need in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist()):
            data = zlib.decompress(packed.as_py())
            for x in need:
                p, most, least = _place(x["at"])
                by[x["k1"] % targets].append((data[p:p - least + length], data[p - most:p], i, h, x["at"], x["many"]))
        rows = []
        for target, run in by.items():
            run.sort(key=lambda e: e[0])
            parts, before = [], b""
            for s, left, i, h, at, many in run:
                c = common(before, s, 0)
                parts += [struct.pack(ENTRY, i, h, at, many, c, len(s) - c, len(left)), s[c:], left]
                before = s
            rows.append((target, b"".join(parts)))
        return pa.Table.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["target", "run"])
    return kernel


def _merge_runs(length: int):
    right = length - window_of(length) + 1

    def kernel(t: pa.Table) -> pa.Table:
        runs, facts = [], []
        for blob in t["run"].to_pylist():
            strings, shared, fact, o, s = [], [], [], 0, b""
            while o < len(blob):
                i, h, at, many, c, rest, left = struct.unpack_from(ENTRY, blob, o)
                o += struct.calcsize(ENTRY)
                s = s[:c] + blob[o:o + rest]
                strings.append(s)
                shared.append(c)
                fact.append((i, h, at, many, blob[o + rest:o + rest + left][::-1]))
                o += rest + left
            runs.append((strings, shared))
            facts.append(fact)
        order, out = merge(runs), []
        start = 0
        for end in range(1, len(order) + 1):
            if end < len(order) and order[end][2] >= right:
                continue
            group = order[start:end]
            start = end
            if len(group) < 2:
                continue
            f = [facts[r][k] for r, k, _ in group]
            at = np.array([x[2] for x in f])
            found = repeats([runs[r][0][k] for r, k, _ in group], [c for _, _, c in group], [x[4] for x in f], at >> 10 & 1023, at & 1023, length)
            for (i, h, x, many, _), (high, low) in zip(f, found):
                if high >= 0 and not many:
                    p = x >> 20
                    out.append((i, h, p - high, p - low + length))
        return pa.Table.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in range(4)], names=["_i", "_h", "a", "b"])
    return kernel


def _strings(length: int):
    def kernel(batch: pa.RecordBatch) -> pa.Table:
        from xxhash import xxh3_128_digest
        out = []
        for i, h, packed, need in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist()):
            data = zlib.decompress(packed.as_py())
            for x in need:
                p, most, least = _place(x["at"])
                # a settled reach stands for two or more equal ones
                out += [(xxh3_128_digest(data[s:s + length]), i, h, s, 1 + x["many"]) for s in range(p - most, p - least + 1)]
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        return pa.Table.from_arrays([pa.array([r[c] for r in out], k) for c, k in enumerate(kinds)], names=["key", "_i", "_h", "a", "n"])
    return kernel


def _with_id(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return keyed(docs, id_col, text_col).select("_i", "_h", F.col(f"_row.`{id_col}`").cast("long").alias("doc_id"), "_t")


def _packed(d: DataFrame) -> DataFrame:
    """(_i, _h, doc_id, z): texts compressed for the shuffle."""
    def kernel(batch: pa.RecordBatch) -> pa.Table:
        return pa.Table.from_arrays([*batch.columns[:3], pa.array([zlib.compress(t.as_py(), 1) for t in batch.column(3)], pa.binary())], names=["_i", "_h", "doc_id", "z"])
    return arrow_map(d.select("_i", "_h", "doc_id", F.col("_t").cast("binary").alias("t")), kernel, "_i long, _h long, doc_id long, z binary")


def repeated_spans(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_i, _h, a, b): byte ranges covered by a string of `length` bytes that also starts anywhere else; they may overlap."""
    d = _with_id(docs, id_col, text_col)
    plain = d.select("_i", "_h", F.col("_t").cast("binary").alias("t"))
    s = arrow_map(plain, _suffixes(length), "k1 long, k2 long, _i long, _h long, at long")
    place = F.struct("_i", "_h", "at")
    # rows of one document repeated count once: first and last place differ otherwise
    again = s.groupBy("k1").agg(F.min(place).alias("x"), F.max(place).alias("y")).filter("x < y").select("k1")
    # tables are written before their joins: Spark splits hot keys only if both sides come straight from a shuffle
    s = cut_lineage(s.join(cut_lineage(again), "k1"))
    reach = cut_lineage(s.groupBy("k1", "k2").agg(F.min(place).alias("one"), F.max(place).alias("last")).select(
        "k1", "k2", "one", (F.col("one") < F.col("last")).cast("int").alias("many")))
    settled = s.join(reach.filter("many = 1").select("k1", "k2"), ["k1", "k2"])
    at = lambda shift: F.shiftright("at", shift).bitwiseAND(F.lit(1023)) if shift else F.col("at").bitwiseAND(F.lit(1023))
    p = F.shiftright("at", 20)
    spans = settled.select("_i", "_h", (p - at(10)).alias("a"), (p - at(0) + length).alias("b"))
    groups = reach.groupBy("k1").agg(F.count("*").alias("reaches"), F.min("many").alias("fewest")).filter("reaches > 1 AND fewest = 0")
    need = reach.join(cut_lineage(groups), "k1").select("one.*", "k1", "many", (F.col("reaches") > HOT).alias("hot"))
    need = cut_lineage(need)
    count = {r["hot"]: r["n"] for r in need.groupBy("hot").agg(F.count("*").alias("n")).collect()}

    def with_text(hot: bool) -> DataFrame:
        wanted = need.filter(F.col("hot") == hot).groupBy("_i", "_h").agg(F.collect_list(F.struct("at", "k1", "many")).alias("need"))
        return _packed(d).join(wanted, ["_i", "_h"]).dropDuplicates(["_i", "_h"]).select("_i", "_h", "z", "need")

    if count.get(False):
        targets = -(-count[False] // RUN_ROWS)
        runs = arrow_map(with_text(False), _runs(length, targets), "target long, run binary")
        spans = spans.union(runs.groupBy("target").applyInArrow(_merge_runs(length), "_i long, _h long, a long, b long"))
    if count.get(True):
        strings = arrow_map(with_text(True), _strings(length), "key binary, _i long, _h long, a long, n long").distinct()
        twice = strings.groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1").select("key")
        spans = spans.union(strings.join(twice, "key").select("_i", "_h", "a", (F.col("a") + length).alias("b")))
    return spans


def remove_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed): removed holds the maximal ranges as (first byte, end)."""
    def kernel(batch: pa.RecordBatch) -> pa.Table:
        out = []
        for i, z, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
            data, merged, kept, last = zlib.decompress(z.as_py()), [], [], 0
            for x in sorted(spans or [], key=lambda x: (x["a"], x["b"])):
                if merged and x["a"] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], x["b"])
                else:
                    merged.append([x["a"], x["b"]])
            for a, b in merged:
                kept.append(data[last:a])
                last = b
            kept = b"".join([*kept, data[last:]])
            out.append((i, len(data), len(data) - len(kept), len(merged), hashlib.sha256(kept).hexdigest(), [{"first": a, "end": b} for a, b in merged]))
        kinds = (pa.int64(),) * 4 + (pa.string(), pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])))
        return pa.Table.from_arrays([pa.array([r[c] for r in out], k) for c, k in enumerate(kinds)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])

    d = _with_id(docs, id_col, text_col)
    spans = repeated_spans(docs, length, id_col, text_col).groupBy("_i", "_h").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    return arrow_map(_packed(d).join(spans, ["_i", "_h"], "left").select("doc_id", "z", "spans"), kernel,
                     "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<first:bigint,end:bigint>>")
