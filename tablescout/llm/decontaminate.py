"""Benchmark passages in documents, allowing for edits.

Method: a random walk (CGK) turns an item-sized window of words into a string whose Hamming distance follows the edit distance;
bit sampling over repeated walks gives LSH keys, and windows that share a key with an item of their size are verified by the exact
edit distance over words. A window with at most k edits keeps at least one of any k + 1 words of the item, and all but k of its
different words; so only windows around one of an item's k + 1 rarest words that hold that many are embedded. This loses nothing.

The benchmark travels to the executors in slices of at most SLICE_CHARS characters, one pass over the documents for each.

Cases: words are runs of letters and digits, lower-cased; an item without words (or null) matches nothing; a null or empty text
has no match; rows of equal id count one by one, equal matches once; other columns play no part; empty tables give no match.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tablescout.llm.common import arrow_map, keyed, worker_state

WORD = re.compile(r"[^\W_]+")
WALKS, TABLES, BITS = 8, 48, 2
SLICE_CHARS = 32_000_000


def numbers(words: list[str]) -> np.ndarray:
    return np.fromiter((zlib.crc32(w.encode()) + 1 for w in words), np.int64, len(words))


def sampled(size: int) -> np.ndarray:
    """Steps of the walk that each table looks at, for windows of this size."""
    return np.sort(np.random.default_rng(size).integers(0, 2 * size, (TABLES, BITS)), axis=1)


def lsh_keys(windows: np.ndarray) -> np.ndarray:
    """(windows, TABLES) keys of windows of equal size, given as word numbers."""
    n, size = windows.shape
    steps = sampled(size)
    padded = np.concatenate((windows, np.zeros((n, 2 * size), np.int64)), axis=1)
    rows = np.arange(n)[:, None]
    at = np.zeros((n, WALKS), dtype=np.int64)
    seeds = np.random.default_rng(17).integers(1, 2**62, WALKS)
    keys = np.zeros((n, TABLES), dtype=np.uint64)
    for t in range(int(steps.max(initial=0)) + 1):
        symbol = padded[rows, at]
        for table in np.flatnonzero((steps == t).any(axis=1)):
            keys[:, table] = keys[:, table] * np.uint64(0x9E3779B97F4A7C15) + symbol[:, table % WALKS].astype(np.uint64)
        mixed = (symbol + t * 0x5851F42D + seeds).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        at += (mixed >> np.uint64(61)).astype(np.int64) & 1  # the walk moves on or stays
    return keys


def infix_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """(edits, end): fewest edits between the item and any part of the text, and where that part ends."""
    row, cols = np.zeros(len(text) + 1, dtype=np.int64), np.arange(len(text) + 1)
    for i, w in enumerate(item, 1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (text != w))
        row = np.minimum.accumulate(new - cols) + cols
    end = int(row.argmin())
    return int(row[end]), end


class Matcher:
    def __init__(self, items: list[tuple[int, str]], similarity: float):
        self.items, self.anchors, self.vocabulary = {}, defaultdict(list), {}
        by_size = defaultdict(list)
        split = {key: WORD.findall((text or "").lower()) for key, text in items}
        common = Counter(w for words in split.values() for w in set(words))
        for key, words in split.items():
            if not words:
                continue
            self.vocabulary[key] = frozenset(words)
            edits = int((1 - similarity) * len(words) + 1e-9)
            self.items[key] = (numbers(words), edits)
            by_size[len(words)].append(key)
            for a in sorted(range(len(words)), key=lambda i: (common[words[i]], -len(words[i])))[:edits + 1]:
                self.anchors[words[a]].append((key, a))
        self.tables: dict[int, dict] = {}
        for size, keys in by_size.items():
            table = self.tables[size] = defaultdict(set)
            for key, row in zip(keys, lsh_keys(np.stack([self.items[k][0] for k in keys]))):
                for t, v in enumerate(row.tolist()):
                    table[t, v].add(key)

    def __call__(self, text: str) -> list[tuple[int, int, int]]:
        """(item, edits, place of the word after the match) of each item in the text."""
        words = WORD.findall(text.lower())
        anchors = self.anchors
        hits = [i for i, w in enumerate(words) if w in anchors]
        if not hits:
            return []
        starts: dict[int, dict[int, set]] = defaultdict(lambda: defaultdict(set))  # size -> start -> items it may be
        for key, at in {(key, i - a) for i in hits for key, a in anchors[words[i]]}:
            item, edits = self.items[key]
            own = self.vocabulary[key]
            if len(own.intersection(words[max(0, at - edits):at + edits + len(item) + edits])) >= len(own) - edits:
                for s in range(max(0, at - edits), min(len(words), at + edits + 1)):
                    starts[len(item)][s].add(key)
        nums = numbers(words)
        found: dict[int, tuple[int, int]] = {}
        for size, of in starts.items():
            padded, at = np.concatenate((nums, np.zeros(size, np.int64))), np.array(sorted(of))
            for lo in range(0, len(at), 4096):
                part = at[lo:lo + 4096]
                keys = lsh_keys(padded[part[:, None] + np.arange(size)])
                tried = defaultdict(list)
                for s, row in zip(part.tolist(), keys.tolist()):
                    for key in set().union(*(self.tables[size].get((t, v), ()) for t, v in enumerate(row))) & of[s]:
                        tried[key].append(s)
                for key, where in tried.items():
                    item, edits = self.items[key]
                    done = -1
                    for s in where:  # neighbouring starts share one verification
                        if s <= done:
                            continue
                        done = s + edits
                        base = max(0, s - 2 * edits)
                        d, end = infix_distance(item, nums[base:done + size + 2 * edits])
                        if d <= edits and (key not in found or d < found[key][0]):
                            found[key] = (d, base + end)
        return [(k, d, e) for k, (d, e) in found.items()]


def matches(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text",
            item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(_i, _h, doc_id, item_id, edits, n_words, similarity): each document and item that match, at its fewest edits."""
    b = benchmark.select(F.monotonically_increasing_id().alias("n"), F.col(f"`{item_id}`").cast("long").alias("id"), F.col(f"`{item_text}`").alias("t"))
    size = b.agg(F.sum(F.length("t")).alias("s")).first()["s"] or 0
    slices = max(1, -(-2 * size // SLICE_CHARS) if size > SLICE_CHARS else 1)
    d = keyed(docs, id_col, text_col).select("_i", "_h", F.col(f"_row.`{id_col}`").cast("long").alias("doc_id"), "_t")
    schema = "_i long, _h long, doc_id long, item_id long, edits int, n_words int, similarity double"
    found = None
    for k in range(slices):
        rows = b.filter(F.pmod(F.xxhash64("t"), F.lit(slices)) == k).select("id", "t").collect()  # bounded by the slice
        ids, items = [r["id"] for r in rows], [(n, r["t"]) for n, r in enumerate(rows)]

        def kernel(batch: pa.RecordBatch, items=items, ids=ids, k=k) -> pa.Table:
            mark = zlib.crc32(repr((similarity, items)).encode())
            match = worker_state(f"matcher_{mark}", lambda: Matcher(items, similarity))
            out = []
            for i, h, doc, text in zip(*(batch.column(c).to_pylist() for c in range(3)), batch.column(3)):
                for key, edits, _ in match(text.as_py()):
                    n = len(match.items[key][0])
                    out.append((i, h, doc, ids[key], edits, n, 1 - edits / n))
            kinds = (pa.int64(),) * 4 + (pa.int32(), pa.int32(), pa.float64())
            return pa.Table.from_arrays([pa.array([r[c] for r in out], t) for c, t in enumerate(kinds)], names=[x.split()[0] for x in schema.split(", ")])

        part = arrow_map(d, kernel, schema)
        found = part if found is None else found.union(part)
    return found.groupBy("_i", "_h", "doc_id", "item_id").agg(F.min(F.struct("edits", "n_words", "similarity")).alias("m")).select("_i", "_h", "doc_id", "item_id", "m.*")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that match no item."""
    bad = matches(docs, benchmark, **options).select("_i", "_h").distinct()
    d = keyed(docs).join(bad, ["_i", "_h"], "left_anti")
    return d.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
