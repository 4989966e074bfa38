import glob
import os
import random
import subprocess
import sys
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from tablescout.llm import shingle_dedup, simhash


def brute_kept(rows, similarity=0.8):
    sets, holds, both = {}, defaultdict(list), defaultdict(int)
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {b" ".join(w[a:a + 5]) for a in range(max(1, len(w) - 4))}
        for x in sets[i]:
            holds[x].append(i)
    for v in holds.values():
        for a in v:
            for b in v:
                if a < b:
                    both[a, b] += 1
    root = {i: i for i in sets}
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for (a, b), n in both.items():
        if n >= similarity * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return sorted(i for i in root if find(i) == i)


def test_stage_against_brute_force(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted(r.doc_id for r in corpus_pipeline.near_copies(spark, docs, d).collect())
    assert got == brute_kept(rows) and {1, 255} - set(got)


@pytest.mark.parametrize("open_pairs", [4, 0.01])
def test_families(spark, monkeypatch, open_pairs):
    monkeypatch.setattr(shingle_dedup, "OPEN", open_pairs)
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    rows = []
    for f in range(4):
        text = [word() for _ in range(150)]
        for k in range(40):
            own = list(text)
            for _ in range(rng.randint(0, 5)):
                own[rng.randrange(150)] = word()
            rows.append((100 * f + k, " ".join(own)))
            if f % 2:
                text[3 * k] = word()  # a chain: its ends are far apart
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(r.doc_id for r in shingle_dedup.without_near_copies(docs).collect())
    assert got == brute_kept(rows)


@pytest.mark.parametrize("rows", [[], [(1, None), (2, ""), (None, "a b"), (3, "A  b"), (3, "A  b"), (4, "x " * 30000)]])
def test_odd_rows(spark, rows):
    d = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS k", "2 AS `_i`")
    kept = shingle_dedup.without_near_copies(d)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == ([1, 3, 4] if rows else [])


def test_large_family_lists_no_pairs(spark):
    """Members that share bands but are not similar: what is written grows with the members, not with their pairs."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    text, rows = [word() for _ in range(150)], []
    for k in range(600):
        own = list(text)
        for _ in range(6):
            own[rng.randrange(150)] = word()
        rows.append((k, " ".join(own)))
    home = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    tables = lambda: {os.path.dirname(f) for f in glob.glob(f"{home}/tablescout-copies-*/*/*.parquet")}
    before = tables()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(r.doc_id for r in shingle_dedup.without_near_copies(docs).collect())
    assert got == brute_kept(rows) and len(got) > 300
    sizes = {os.path.basename(t): spark.read.parquet(t).count() for t in tables() - before}
    assert sizes and max(sizes.values()) <= shingle_dedup.BANDS * len(rows), sizes


@pytest.mark.parametrize("seed", [1, 2])
def test_cell_against_brute_force(seed):
    rng = random.Random(seed)
    sets = {k: sorted({b * 1000 + (rng.randrange(1000) if rng.random() < 0.08 else i) for i in range(40) for b in [rng.randrange(2) if k % 7 == 0 else k % 2]}) for k in range(80)}
    arrays = {k: np.array(s, np.uint64) for k, s in sets.items()}
    home, guests = list(range(50)), list(range(50, 80))
    cell = shingle_dedup.Cell(home, home, [arrays[k] for k in home], 0.8)
    cell.settle([arrays[k] for k in home])
    for k in guests:
        cell.visit(k, k, arrays[k])

    def groups(pairs):
        root = {k: k for k in sets}
        def find(i):
            while root[i] != i:
                i = root[i]
            return i
        for a, b in pairs:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
        return {k: find(k) for k in sets}

    near = lambda a, b: len(set(sets[a]) & set(sets[b])) >= 0.8 * len(set(sets[a]) | set(sets[b]))
    want = groups((a, b) for a in sets for b in home if a != b and near(a, b))
    assert groups(cell.links) == want and len(cell.links) < len(sets) and 2 < len(set(want.values())) < len(sets)


def groups_of(n, pairs):
    root = list(range(n))
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_near_values_against_brute_force(monkeypatch):
    monkeypatch.setattr(shingle_dedup, "LEAF", 8)
    rng = np.random.default_rng(3)
    for v in (np.unique(rng.integers(0, 65536, 3000)).astype(np.uint16), np.array([7], np.uint16)):
        i, j = np.nonzero(np.bitwise_count(v[:, None] ^ v[None, :]) <= shingle_dedup.NEAR)
        got = list(zip(*(c.tolist() for c in shingle_dedup.near_values(v))))
        assert len(got) == len(set(got)) and set(got) == {(a, b) for a, b in zip(i.tolist(), j.tolist()) if a <= b}


@pytest.mark.parametrize("pairs, every", [(1 << 18, 1), (16, 1), (16, 3)])
def test_shard_against_brute_force(monkeypatch, pairs, every):
    """Families of near fingerprints; pairs of two visitors are another shard's."""
    monkeypatch.setattr(shingle_dedup, "PAIRS", pairs)
    rng = np.random.default_rng(pairs + every)
    flips = np.packbits(rng.random((600, 192)) < 0.11, axis=1).view(np.uint64)
    x = rng.integers(0, 2**64, (40, 3), dtype=np.uint64)[rng.integers(0, 40, 600)] ^ flips
    home = np.arange(600) % every == 0
    near = np.bitwise_count(simhash.quarter(x[:, 0], 2)[:, None] ^ simhash.quarter(x[:, 0], 2)[None, :]) <= shingle_dedup.NEAR
    near &= np.bitwise_count(x[:, None] ^ x[None, :]).sum(axis=2) <= shingle_dedup.BITS
    want = groups_of(600, np.argwhere(near & (home[:, None] | home[None, :])).tolist())
    got = shingle_dedup.spanning_roots(x, home, 2)
    assert groups_of(600, enumerate(got.tolist())) == want and 40 < len(set(want)) < 600


@pytest.mark.parametrize("shard", [1 << 19, 60])
def test_trees_tie_all_planted_pairs(spark, monkeypatch, shard):
    """Pairs of similarity 0.8 to 0.82, 500 of them, in trees of one and of five upper levels."""
    monkeypatch.setattr(shingle_dedup, "SHARD", shard)
    rng, rows = np.random.default_rng(6), []
    for k in range(500):
        both = 8 * int(rng.integers(3, 30))
        own = both // 4  # both / (both + own) = 0.8
        s = np.unique(rng.integers(0, 2**64, both + own, dtype=np.uint64))
        cut = int(rng.integers(0, own + 1))
        rows += [(2 * k, s[:both + cut]), (2 * k + 1, np.concatenate((s[:both], s[both + cut:])))]
    sets = spark.createDataFrame([(k, shingle_dedup.fingerprints(s).tolist()) for k, s in rows], "k long, b array<long>")
    ties = {(min(r), max(r)) for r in shingle_dedup.fingerprint_ties(sets).collect()}
    assert ties == {(2 * k, 2 * k + 1) for k in range(500)}


def test_stage_works_by_fingerprint_trees(spark, monkeypatch):
    """Near copies reach the exact check through the trees alone."""
    docs = spark.createDataFrame([(1, "a b c d e f g h"), (2, "A b c d e f g h"), (3, " ".join(map(str, range(60)))), (4, " ".join(map(str, range(58))))], "doc_id long, text string")
    kept = lambda: sorted(r.doc_id for r in shingle_dedup.without_near_copies(docs).collect())
    assert kept() == [1, 3]
    monkeypatch.setattr(shingle_dedup, "fingerprint_ties", lambda sets: spark.createDataFrame([], "k long, lead long"))
    assert kept() == [1, 3, 4]


def test_kernels_load_without_the_library(tmp_path):
    """Workers need not have the repository on their path."""
    from pyspark import cloudpickle
    (tmp_path / "k").write_bytes(cloudpickle.dumps([shingle_dedup._deal([], 0), shingle_dedup.spanning_roots, shingle_dedup._signatures(5), shingle_dedup._cells(5, 0.8)]))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", "import pickle; pickle.load(open('k', 'rb'))"], cwd=tmp_path, env=env, check=True)
