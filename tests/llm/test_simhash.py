import re

import numpy as np
import pytest
import xxhash

from tablescout.llm import simhash
from tablescout.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    s = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    root = {f: f for f in fps}
    def find(f):
        while root[f] != f:
            f = root[f]
        return f
    order = sorted(fps)
    for i, a in enumerate(order):
        for b in order[:i]:
            if (a ^ b).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def check(rows, out):
    fp = {i: brute_fingerprint(t) for i, t in rows}
    comp = brute_components(set(fp.values()))
    low = {}
    for i, f in fp.items():
        low[comp[f]] = min(low.get(comp[f], i), i)
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in out} == {(i, f"{f:016x}", low[comp[f]]) for i, f in fp.items()}


def test_query_against_brute_force(spark, data):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    out = QUERIES["op4_simhash_near_dedup"](spark, data).collect()
    assert len(out) == len(rows)
    check(rows, out)


@pytest.mark.parametrize("levels_from", [16384, 64])
def test_links_against_brute_force(spark, monkeypatch, levels_from):
    monkeypatch.setattr(simhash, "SHARD", levels_from)
    monkeypatch.setattr(simhash, "LEAF", 8)
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64)
    near = [int(b) ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(1, 7), replace=False)) for b in base[:200]]
    dense = [int(base[0]) ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (300, 2))]
    fps = sorted({int(b) for b in base} | set(near) | set(dense))
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(3)
    got = {r.node % 2**64: r.root for r in simhash.components(simhash.links(df), "a", "b").collect()}
    want = brute_components(set(fps))
    groups = {}
    for f in fps:
        groups.setdefault(want[f], set()).add(got.get(f, f if f < 2**63 else f - 2**64))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


@pytest.mark.parametrize("rows", [[], [(1, None), (2, ""), (None, "a b"), (3, "A  b"), (3, "A  b"), (4, "x " * 30000)]])
def test_odd_rows(spark, rows):
    d = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS fp", "2 AS `_i`")
    out = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(d).collect()}
    assert out == ({(1, 1), (2, 1), (None, 3), (3, 3), (4, 4)} if rows else set())
    kept = simhash.without_near_duplicates(d)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == ([1, 3, 4] if rows else [])
