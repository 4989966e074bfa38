"""Packing of tokenized documents into sequences of a fixed length.

Method: pattern packing by non-negative least squares. The histogram of piece lengths (at most one row for each length, whatever
the corpus) is all the driver sees. Patterns of a few documents that fill a sequence are enumerated over length classes, the
repeat counts that reproduce the histogram are fitted by non-negative least squares and rounded down, and the residual pieces go
best fit, longest first, into the gaps and into new sequences. The outcome is a table of slots for each length; every piece finds
its slot by its rank within its length, and ranks are counted in buckets, so no length meets in one task.

Cases: a null or empty text is one piece that holds the end mark; longer documents are cut into full pieces and a rest; rows of equal
id are packed one by one; a null id is carried along; other columns play no part; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import os
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tablescout.llm.common import arrow_map, worker_state
from tablescout.session import cut_lineage

CLASSES = 256  # length classes of the patterns
PARTS = 2  # documents of a pattern at most
CACHED_WORDS = 300_000  # of each of the two generations of a worker's cache
BUCKET_ROWS = 50_000


def _encoder(path: str):
    """bytes -> ids as little-endian 32-bit integers. White space ends a word for this kind of tokenizer, so words are encoded once."""
    import gc
    from tokenizers import Tokenizer, pre_tokenizers
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tok, letters = Tokenizer.from_file(path), Tokenizer.from_file(path)
    # words of lower-case Latin letters are one piece in one normal form: no pattern and no normalizer has to look at them
    letters.normalizer, letters.pre_tokenizer = None, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    young: dict[bytes, bytes] = {}
    old: dict[bytes, bytes] = {}

    def ids(enc) -> bytes:
        return np.array(enc.ids, dtype="<u4").tobytes()

    def store(words: list[bytes], data: bytes, counts: np.ndarray) -> None:
        cut = [0, *(4 * np.cumsum(counts)).tolist()]
        young.update(zip(words, map(data.__getitem__, map(slice, cut, cut[1:]))))

    def learn(words) -> None:
        split, need = [], set()
        for w in words:
            core = w.rstrip(b".,;:!?")
            # letters and a mark are separate pieces; other ends may join the mark
            if len(core) < len(w) and core.decode("utf-8", "replace")[-1:].lower()[-1:].isalpha():
                mark = w[len(core):]
                split.append((w, core, mark))
                need.update((core, mark))
            else:
                need.add(w)
        need = [w for w in need if w not in young]
        strings = [w.decode("utf-8", "replace").lower() for w in need]
        latin = [x.isalpha() and max(x) < "\u0250" for x in strings]
        plain, texts = [w for w, a in zip(need, latin) if a], [x for x, a in zip(strings, latin) if a]
        if plain:
            enc = letters.encode(texts, is_pretokenized=True, add_special_tokens=False)
            store(plain, ids(enc), np.bincount(np.array(enc.word_ids, dtype=np.int64), minlength=len(plain)))
        other = [w for w, a in zip(need, latin) if not a]
        if other:  # all in one text; the offsets tell which ids are whose
            texts = [w.decode("utf-8", "replace") for w in other]
            enc = tok.encode(" ".join(texts), add_special_tokens=False)
            first = np.cumsum([0, *(len(x) + 1 for x in texts)])
            owner = np.searchsorted(first, [a for a, _ in enc.offsets], side="right") - 1
            store(other, ids(enc), np.bincount(owner, minlength=len(other)))
        for w, a, b in split:
            young[w] = young[a] + young[b]

    def encode(texts: list[bytes]) -> list[bytes]:
        gc.disable()  # what is made here refers to nothing; looking for cycles among so many objects costs more than the work
        try:
            return _encode(texts)
        finally:
            gc.enable()

    def _encode(texts: list[bytes]) -> list[bytes]:
        nonlocal young, old
        if len(young) > CACHED_WORDS:  # words that come again move on, the others are forgotten
            young, old = {}, young
        words = [None if b"<|" in t else t.lower().split() for t in texts]  # such texts may hold marks found before the split
        found = [None if w is None else list(map(young.get, w)) for w in words]
        new = {w for ws, f in zip(words, found) if ws and None in f for w, x in zip(ws, f) if x is None}
        again = {w: old[w] for w in new if w in old}
        young.update(again)
        learn(new.difference(again))
        return [ids(tok.encode(t.decode("utf-8", "replace"), add_special_tokens=False)) if w is None
                else b"".join([young[v] if x is None else x for v, x in zip(w, f)] if None in f else f)
                for t, w, f in zip(texts, words, found)]
    return encode


def token_pieces(docs: DataFrame, tokenizer: str, size: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of each piece of at most `size` tokens."""
    end = int(end_id).to_bytes(4, "little")

    def kernel(batch: pa.RecordBatch) -> pa.Table:
        import zlib
        encode = worker_state(f"encoder_{tokenizer}", lambda: _encoder(tokenizer))
        out = []
        for a in range(0, batch.num_rows, 200):
            part = batch.slice(a, 200)
            for i, data in zip(part.column(0).to_pylist(), encode([t or b"" for t in part.column(1).to_pylist()])):
                data += end
                n = len(data) // 4
                for piece, start in enumerate(range(0, n, size)):
                    stop = min(n, start + size)
                    out.append((i, piece, start, stop - start, zlib.crc32(data[4 * start:4 * stop])))
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("t"))
    return arrow_map(d, kernel, "doc_id long, piece int, start long, length long, ids_crc32 long")


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """min |a x - b| with x >= 0, by an active set."""
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], dtype=bool)
    for _ in range(3 * a.shape[0]):
        gain = a.T @ (b - a @ x)
        gain[free] = -np.inf
        j = int(np.argmax(gain))
        if gain[j] <= 1e-9 * (1 + np.abs(b).max(initial=0)):
            break
        free[j] = True
        while True:
            at = np.flatnonzero(free)
            z = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if (z > 0).all():
                x[:] = 0
                x[at] = z
                break
            low = z <= 0
            step = np.min(x[at][low] / np.maximum(x[at][low] - z[low], 1e-300))
            x[at] += step * (z - x[at])
            x[at[x[at] <= 1e-12]] = 0
            free &= x > 0
            if not free.any():
                break
    return x


@lru_cache(maxsize=None)
def patterns(total: int, parts: int, most: int) -> tuple[tuple[int, ...], ...]:
    """Ways to write total as a falling sum of 1 to parts numbers up to most."""
    if total == 0:
        return ((),)
    if parts == 0:
        return ()
    return tuple((p, *rest) for p in range(min(total, most), 0, -1) for rest in patterns(total - p, parts - 1, p))


def plan_histogram(hist: dict[int, int], size: int) -> list[tuple[list[tuple[int, int]], int]]:
    """[(content, copies)]: sequences as lists of (length, number), each made so many times."""
    left = {n: c for n, c in hist.items() if c > 0}
    done: list[tuple[list, int]] = []
    open_: dict[int, list] = defaultdict(list)  # free tokens -> [content, copies]
    if size in left:
        done.append(([(size, 1)], left.pop(size)))
    width = -(-size // CLASSES)
    classes: dict[int, list[list[int]]] = defaultdict(list)  # class -> [length, count], longest last
    for n in sorted(left):
        classes[-(-n // width)].append([n, left[n]])
    stock = {k: sum(c for _, c in v) for k, v in classes.items()}
    ways = [p for p in patterns(size // width, PARTS, size // width) if all(k in stock for k in p)]
    if ways:
        keys = sorted(stock)
        a = np.array([[p.count(k) for p in ways] for k in keys], dtype=float)
        b = np.array([stock[k] for k in keys], dtype=float)
        x = nnls(a, b / b.max()) * b.max()
        for j in np.argsort(-x, kind="stable"):
            need = {k: ways[j].count(k) for k in set(ways[j])}
            copies = min(int(x[j] + 1e-6), *(stock[k] // m for k, m in need.items()))
            for k, m in need.items():
                stock[k] -= m * copies
            while copies:
                content, times = [], copies
                for k, m in need.items():
                    while m:  # equal heads serve many copies at once
                        n, c = classes[k][-1]
                        take = min(m, c)
                        times = min(times, c // take if take == m else 1)
                        content.append([k, n, take])
                        m -= take
                        if m:
                            times = 1
                            classes[k].pop()
                if times == 1:
                    taken = defaultdict(int)
                    for k, n, take in content:
                        taken[k, n] += take
                    for (k, n), take in taken.items():
                        if classes[k] and classes[k][-1][0] == n:
                            classes[k][-1][1] -= take
                else:
                    for k, n, take in content:
                        classes[k][-1][1] -= take * times
                for k in need:
                    while classes[k] and classes[k][-1][1] == 0:
                        classes[k].pop()
                full = [(n, take) for _, n, take in content]
                open_[size - sum(n * t for n, t in full)].append([full, times])
                copies -= times
    rest = sorted(((n, c) for v in classes.values() for n, c in v if c), reverse=True)
    frees = sorted(open_)
    for n, count in rest:
        while count:
            at = bisect.bisect_left(frees, n)
            if at == len(frees):
                content, copies, free = [], count, size
                copies = -(-count // (size // n))
            else:
                free = frees[at]
                content, copies = open_[free].pop()
                if not open_[free]:
                    frees.pop(at)
            m = free // n
            whole = min(copies, count // m)
            for times, number in ((whole, m), (1 if whole < copies and count - whole * m else 0, count - whole * m)):
                if times:
                    gap = free - n * number
                    if not open_[gap]:
                        bisect.insort(frees, gap)
                    open_[gap].append([content + [(n, number)], times])
                    copies -= times
                    count -= times * number
            if copies and content:
                if not open_[free]:
                    bisect.insort(frees, free)
                open_[free].append([content, copies])
    return done + [(c, t) for v in open_.values() for c, t in v]


def slots(plan, size: int) -> np.ndarray:
    """Rows (length, first rank, last rank + 1, first sequence, number in each sequence, offset), sorted."""
    rank, seq, rows = defaultdict(int), 0, []
    for content, copies in plan:
        offset = 0
        for n, number in content:
            rows.append((n, rank[n], rank[n] + number * copies, seq, number, offset))
            rank[n] += number * copies
            offset += n * number
        seq += copies
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 6)


def pack(docs: DataFrame, tokenizer: str, size: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = cut_lineage(token_pieces(docs, tokenizer, size, end_id, id_col, text_col))
    hist = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `size` rows
    table = slots(plan_histogram(hist, size), size)
    buckets = max(1, -(-sum(hist.values()) // BUCKET_ROWS))
    p = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    # ranks within a length: within its buckets, and what lies in the buckets before
    before = p.groupBy("length", "bucket").agg(F.count("*").alias("n")).withColumn("before", F.sum("n").over(
        Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)))
    p = p.withColumn("nth", F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")))
    p = p.join(before.select("length", "bucket", "before"), ["length", "bucket"])
    p = p.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("nth") - 1 + F.coalesce("before", F.lit(0))).cast("long").alias("rank"))

    def kernel(batch: pa.RecordBatch) -> pa.Table:
        n, r = np.asarray(batch.column(3)), np.asarray(batch.column(5))
        ends = np.searchsorted(table[:, 0], [n, n + 1])  # slots of each length
        key = table[:, 0].astype(np.float64) * 2.0**40 + table[:, 1]
        at = np.searchsorted(key, n.astype(np.float64) * 2.0**40 + r, side="right") - 1
        assert ((at >= ends[0]) & (at < ends[1]) & (r < table[at, 2])).all()
        k = r - table[at, 1]
        seq, offset = table[at, 3] + k // table[at, 4], table[at, 5] + n * (k % table[at, 4])
        return pa.Table.from_batches([batch]).drop_columns(["rank"]).append_column("sequence_id", pa.array(seq)).append_column("offset", pa.array(offset))

    return arrow_map(p, kernel, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
