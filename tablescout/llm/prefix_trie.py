"""Prefix trie of conversations from vertical bitmaps.

Method: conversations are dealt to shards of neighbouring ids. A shard holds, for each (position, turn), the bitset of its
conversations that have this turn there, and for each length the bitset of those that end there. Depth-first search starts from all
conversations: the turn of the lowest one left at the next position names a posting, its intersection with the parent's bitset is a
child, and the child's bits are struck from the rest. A node yields its path (a 128-bit hash of the parent's path and the turn), its
population count, its smallest conversation and the packed list of conversations that end there.

Nodes of equal path meet over all shards. Sums over subtrees are additive as well: a node counts in the shard that holds its smallest
conversation, and there its ancestors have that conversation too, so each shard adds up its own nodes in preorder with one stack.

Bounds: a shard has at most CONVERSATIONS conversations, or, beyond TURNS turns, ends with the conversation that passes them; only a
single conversation of more turns makes it larger (some 100 bytes a turn). No group of equal turns or conversations meets in a task:
a node has one row in each shard. The hash over the ids that end at a node is sequential by definition; it is streamed over the packed
lists in the order of their shards.

Cases: rows without conv_id belong to no conversation; a null turn comes first, rows of equal turn are ordered by the md5 of role and
text, repeated rows stay; null role or text is empty; an empty table gives no rows; texts of any length enter by their md5. Other
columns of the table play no part, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tablescout.llm.common import ranked
from tablescout.session import cut_lineage

CONVERSATIONS = 8192  # conversations of a shard
TURNS = 500_000  # turns after which a shard ends with the conversation it is in
WORD = "[^\\x20\\x09-\\x0D]+"
ROOT = bytes(16)  # path of the root
NODES = pa.schema([("shard", pa.int64()), ("at", pa.int64()), ("path", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()),
                   ("low", pa.int64()), ("n", pa.int64()), ("words", pa.int64()), ("ends", pa.binary())])


def turns(conversations: DataFrame) -> DataFrame:
    """(conv, pos, n, key, words): the turns of each conversation in order; `key` stands for role and text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    d = conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv"), "turn", key.alias("key"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    return ranked(d, ["conv"], [F.col("turn").asc_nulls_first(), F.col("key")]).select("conv", "pos", "n", F.unhex("key").alias("key"), "words")


def rebuilt(own: DataFrame, base: Column, head: Column) -> DataFrame:
    """(conv, pos, key, words): the first `head` turns of conversation `base`, then the own turns after the first `head`.

    Both are expressions over `conv`. Each conversation also has a row of position -1, also if no turn is left to it.
    """
    own = cut_lineage(own)
    convs = own.filter("pos = 0").select("conv", base.alias("base"), head.alias("head"))
    lent = own.filter(F.col("pos") < convs.agg(F.max("head").alias("m")).select("m").scalar()).select(F.col("conv").alias("base"), "pos", "key", "words")
    heads = convs.filter("head > 0").join(lent, "base").filter("pos < head").select("conv", "pos", "key", "words")
    rest = own.filter(F.col("pos") >= head).select("conv", "pos", "key", "words")
    marks = convs.select("conv", F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("binary").alias("key"), F.lit(0).cast("long").alias("words"))
    return heads.union(rest).union(marks)


def _search(conv: np.ndarray, where: np.ndarray, keys: list[bytes], words: np.ndarray) -> dict[str, list]:
    """Nodes of a shard in preorder. `conv`: its conversations; turn k belongs to conversation number where[k]; ordered turns."""
    m = len(conv)
    first = np.searchsorted(where, np.arange(m + 1))
    length = np.diff(first)
    start = first.tolist()
    depth_of = (np.arange(len(where)) - first[where]).tolist()
    posting: dict[tuple[int, bytes], int] = {}
    for o, d, key in zip(where.tolist(), depth_of, keys):
        posting[d, key] = posting.get((d, key), 0) | 1 << o
    ending: dict[int, int] = {}
    for o, d in enumerate(length.tolist()):
        ending[d] = ending.get(d, 0) | 1 << o
    words, size = words.tolist(), (m + 7) // 8
    out: dict[str, list] = {f: [] for f in ("path", "parent", "depth", "low", "n", "words", "ends")}
    todo = [((1 << m) - 1, 0, ROOT, None, 0)]
    while todo:
        bits, depth, path, parent, n_words = todo.pop()
        ends = bits & ending.get(depth, 0)
        packed = np.flatnonzero(np.unpackbits(np.frombuffer(ends.to_bytes(size, "little"), np.uint8), bitorder="little")) if ends else ()
        low = (bits & -bits).bit_length() - 1
        for f, v in zip(out, (path, parent, depth, int(conv[low]), bits.bit_count(), n_words, conv[packed].tobytes() if ends else None)):
            out[f].append(v)
        rest = bits ^ ends
        while rest:
            o = (rest & -rest).bit_length() - 1
            k = start[o] + depth
            child = bits & posting[depth, keys[k]]
            rest &= ~child
            todo.append((child, depth + 1, hashlib.blake2b(path + keys[k], digest_size=16).digest(), path, words[k]))
    return out


def local_nodes(sequences: DataFrame) -> DataFrame:
    """Nodes of each shard: (shard, at, path, parent, depth, low, n, words, ends); `shard` grows with the ids, `at` is the preorder."""
    parts = int(sequences.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    limit, most = CONVERSATIONS, TURNS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            conv, pos = rows["conv"].to_numpy(), rows["pos"].to_numpy()
            ids = np.unique(conv)
            real = pos >= 0
            found = _search(ids, np.searchsorted(ids, conv[real]), rows["key"].filter(pa.array(real)).to_pylist(), rows["words"].to_numpy()[real])
            n = len(found["path"])
            found |= {"shard": [int(ids[0])] * n, "at": list(range(n))}
            yield from pa.Table.from_pydict(found, schema=NODES).to_batches(max_chunksize=20_000)

        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            ids = batch.column(0).to_numpy()
            held.append(batch)
            fresh, last = len(ids) and (ids[0] != last or ids[0] != ids[-1]), ids[-1] if len(ids) else last
            if not fresh:  # the same conversation goes on
                continue
            table = pa.Table.from_batches(held)
            conv = table["conv"].to_numpy()
            starts = np.flatnonzero(np.diff(conv, prepend=conv[:1] - 1))
            done = 0
            while len(starts) > 1 and (len(starts) > limit or starts[-1] - done > most):
                by_size = int(np.searchsorted(starts, done + most, "left"))
                cut = int(starts[max(1, min(limit, by_size, len(starts) - 1))])
                yield from flush(table.slice(done, cut - done))
                done = cut
                starts = starts[starts >= done]
            held = table.slice(done).to_batches()
        if held:
            yield from flush(pa.Table.from_batches(held))

    d = sequences.repartitionByRange(parts, "conv").sortWithinPartitions("conv", "pos")
    return d.mapInArrow(run, "shard long, at long, path binary, parent binary, depth long, low long, n long, words long, ends binary")


def _subtree_sums(d: DataFrame) -> DataFrame:
    """(path, leaves, tokens): sums over the subtrees of each shard. `d`: (shard, at, depth, path, leaf, saved)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[list] = []
        shard = None
        for batch in batches:
            paths, leaves, tokens = [], [], []

            def close(depth: int) -> None:
                while stack and stack[-1][0] >= depth:
                    _, path, a, b = stack.pop()
                    paths.append(path), leaves.append(a), tokens.append(b)
                    if stack:
                        stack[-1][2] += a
                        stack[-1][3] += b

            for s, depth, path, a, b in zip(*[batch.column(c).to_pylist() for c in ("shard", "depth", "path", "leaf", "saved")]):
                close(0 if s != shard else depth)
                shard = s
                stack.append([depth, path, a, b])
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.binary()), pa.array(leaves, pa.int64()), pa.array(tokens, pa.int64())], ["path", "leaves", "tokens"])
        paths, leaves, tokens = [], [], []
        while stack:
            _, path, a, b = stack.pop()
            paths.append(path), leaves.append(a), tokens.append(b)
            if stack:
                stack[-1][2] += a
                stack[-1][3] += b
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.binary()), pa.array(leaves, pa.int64()), pa.array(tokens, pa.int64())], ["path", "leaves", "tokens"])

    d = d.repartition("shard").sortWithinPartitions("shard", "at")
    return d.mapInArrow(run, "path binary, leaves long, tokens long").groupBy("path").agg(F.sum("leaves").alias("leaves"), F.sum("tokens").alias("tokens"))


def _end_hashes(local: DataFrame) -> DataFrame:
    """(path, ends_sha256) of the nodes where conversations end: their decimal ids, ascending, with commas between them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, h, out = None, None, []
        for batch in batches:
            for p, ends in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                text = ",".join(map(str, np.frombuffer(ends, np.int64).tolist())).encode()
                if p == path:
                    h.update(b"," + text)
                    continue
                if path is not None:
                    out.append((path, h.hexdigest()))
                path, h = p, hashlib.sha256(text)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out])], ["path", "ends_sha256"])
                out = []
        if path is not None:
            yield pa.RecordBatch.from_arrays([pa.array([path], pa.binary()), pa.array([h.hexdigest()])], ["path", "ends_sha256"])

    d = local.filter("ends IS NOT NULL").select("path", "shard", "ends").repartition("path").sortWithinPartitions("path", "shard")
    return d.mapInArrow(run, "path binary, ends_sha256 string")


def trie(sequences: DataFrame) -> DataFrame:
    """One row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, path.

    `sequences`: (conv, pos, key, words) with a row of position -1 for each conversation, as `rebuilt` returns them.
    """
    local = cut_lineage(local_nodes(cut_lineage(sequences)))
    nodes = local.groupBy("path").agg(F.min("low").alias("low"), F.sum("n").alias("n_convs"), F.min("depth").alias("depth"), F.min("parent").alias("parent"), F.min("words").alias("words"))
    children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("path")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = cut_lineage(nodes.join(children, "path", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    own = local.join(nodes.select("path", F.col("low").alias("least"), "n_convs", "n_children"), "path")
    mine = F.col("low") == F.col("least")
    sums = _subtree_sums(own.select("shard", "at", "depth", "path", F.when(mine & (F.col("n_children") == 0), 1).otherwise(0).cast("long").alias("leaf"),
                                    F.when(mine, (F.col("n_convs") - 1) * F.col("words")).otherwise(0).alias("saved")))
    above = nodes.select(F.col("path").alias("parent"), F.col("low").alias("parent_conv_id"))
    d = nodes.join(sums, "path").join(_end_hashes(local), "path", "left").join(above, "parent", "left")
    return d.select(F.col("low").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("tokens").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"), F.lower(F.hex("path")).alias("path"))
