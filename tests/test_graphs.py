"""Clusterings against plain numpy, and the shape of their plans."""

import hashlib

import numpy as np
import pytest

from tablescout.operators import graphs as G, textsim as X


def noise(i, k):
    return int(hashlib.md5(f"{i}|{k}".encode()).hexdigest()[:8], 16) / 2.0**32 * G.JITTER


def random_graph(seed, n=30, links=70):
    rng = np.random.default_rng(seed)
    names = [f"n{x:02d}" for x in range(n)]
    pairs = sorted({tuple(sorted(rng.choice(n, 2, replace=False).tolist())) for _ in range(links)})
    return names, [(names[a], names[b], float(rng.uniform(0.2, 1))) for a, b in pairs]


def brute_affinity(names, edges, q, rounds):
    at = {x: k for k, x in enumerate(names)}
    linked = sorted({x for a, b, _ in edges for x in (a, b)})
    pref = np.percentile(np.round([s for *_, s in edges], 6), q * 100)
    n = len(names)
    s = np.full((n, n), -np.inf)
    for a, b, w in edges:
        s[at[a], at[b]], s[at[b], at[a]] = w + noise(a, b), w + noise(b, a)
    for x in linked:
        s[at[x], at[x]] = pref + noise(x, x)
    on, r, a = np.isfinite(s), np.zeros((n, n)), np.zeros((n, n))
    idx = [at[x] for x in linked]
    for _ in range(rounds):
        v = np.where(on, a + s, -np.inf)
        for i in idx:
            for k in np.flatnonzero(on[i]):
                rest = np.delete(v[i], k)
                r[i, k] = 0.5 * r[i, k] + 0.5 * (s[i, k] - rest.max())
        pos = np.where(on, np.maximum(r, 0), 0)
        np.fill_diagonal(pos, 0)
        for k in idx:
            total = pos[:, k].sum()
            for i in np.flatnonzero(on[:, k]):
                a[i, k] = 0.5 * a[i, k] + 0.5 * (total if i == k else min(0, r[k, k] + total - pos[i, k]))

    def deal(ex):
        out = {}
        for i in idx:
            near = [k for k in ex if on[i, k]]
            out[i] = i if i in ex else max(near, key=lambda k: (s[i, k], -k)) if near else None
        return out
    c = deal({k for k in idx if r[k, k] + a[k, k] > 0})
    groups = {}
    for i, k in c.items():
        if k is not None:
            groups.setdefault(k, []).append(i)
    moved = {max(g, key=lambda j: (round(sum(s[i, j] for i in g if on[i, j]), 9), -j)) for g in groups.values()}
    final = deal(moved)
    return {x: names[final[at[x]]] if final.get(at[x]) is not None else x for x in names}


@pytest.mark.parametrize("seed", [1, 2])
def test_affinity_propagation_against_numpy(spark, seed):
    names, edges = random_graph(seed)
    names = [*names, "zz"]  # without an edge
    out = G.affinity_propagation(spark.createDataFrame([(x,) for x in names], "t string"), spark.createDataFrame(edges, "a string, b string, sim double"), "t", rounds=12, patience=None).collect()
    for q in G.SWEEP:
        assert {r.t: r.exemplar for r in out if r.q == q} == brute_affinity(names, edges, q, 12)


def test_affinity_propagation_ends_by_itself(spark):
    """Two stars of equal links: each has one exemplar, and the rounds end long before the limit."""
    edges = [("hub", f"h{k}", 0.8) for k in range(6)] + [("top", f"t{k}", 0.8) for k in range(5)]
    nodes = spark.createDataFrame([(x,) for x in {x for a, b, _ in edges for x in (a, b)}], "t string")
    out = G.affinity_propagation(nodes, spark.createDataFrame(edges, "a string, b string, sim double"), "t", sweep=(0.5,), patience=3, rounds=40).collect()
    assert {r.exemplar for r in out if r.t[0] == "h"} == {"hub"} or {r.exemplar for r in out} >= {"hub"}


def brute_linkage(names, edges, threshold):
    w, size, of = {}, {x: 1 for x in names}, {x: x for x in names}
    for a, b, s in edges:
        w[a, b] = s
    while True:
        best = min(((-round(v / (size[a] * size[b]), 9), a, b) for (a, b), v in w.items()), default=None)
        if best is None or best[0] > -threshold:
            return of
        _, a, b = best
        size[a] += size.pop(b)
        of = {x: a if c == b else c for x, c in of.items()}
        merged = {}
        for (x, y), v in w.items():
            x, y = sorted((a if x == b else x, a if y == b else y))
            if x != y:
                merged[x, y] = merged.get((x, y), 0) + v
        w = merged


@pytest.mark.parametrize("seed, threshold", [(3, 0.5), (4, 0.3), (5, 0.15)])
def test_average_linkage_against_one_merge_at_a_time(spark, seed, threshold):
    names, edges = random_graph(seed, 40, 160)
    out = G.average_linkage(spark.createDataFrame([(x,) for x in names], "t string"), spark.createDataFrame(edges, "a string, b string, sim double"), "t", threshold).collect()
    want = brute_linkage(names, edges, threshold)
    assert {r.t: r.cluster for r in out} == want and 1 < len(set(want.values())) < len(names)


def test_choice_of_clusters(spark):
    names, edges = random_graph(6, 30, 60)
    nodes, links = spark.createDataFrame([(x,) for x in names], "t string"), spark.createDataFrame(edges, "a string, b string, sim double")
    swept = G.chosen_clusters(nodes, links, "t", wanted=(1, 30), target=12, rounds=4, patience=None).collect()
    assert {r.method for r in swept} <= {f"affinity_{q}" for q in G.SWEEP}
    fall = G.chosen_clusters(nodes, links, "t", wanted=(0, 0), usable=(0, 0), rounds=2, patience=None).collect()
    assert {r.method for r in fall} == {"average_linkage"} and {r.t: r.cluster for r in fall} == brute_linkage(names, edges, 0.5)


def test_graphs_without_edges(spark):
    nodes, links = spark.createDataFrame([("x",), ("y",)], "t string"), spark.createDataFrame([], "a string, b string, sim double")
    assert {(r.t, r.cluster) for r in G.average_linkage(nodes, links, "t").collect()} == {("x", "x"), ("y", "y")}
    assert {(r.t, r.exemplar) for r in G.affinity_propagation(nodes, links, "t", rounds=2).collect()} == {("x", "x"), ("y", "y")}
    assert G.average_linkage(nodes.limit(0), links, "t").count() == 0


def components_of(names, pairs):
    root = {x: x for x in names}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in names}


@pytest.mark.parametrize("tries", [2, 50])
def test_spanning_links_keep_the_components(spark, monkeypatch, tries):
    """Large families by number, families that link by some members only, and words of their own."""
    monkeypatch.setattr(X, "TRIES", tries)
    rng = np.random.default_rng(4)
    parts = ["cli", "ente", "fono", "tel", "er", "ma", "sol", "dir"]
    words = {"".join(rng.choice(parts, rng.integers(2, 4))) + str(rng.integers(0, 30) or "") for _ in range(110)}
    names = sorted(words | {f"cliente{k}" for k in range(1, 60)} | {f"cliente id{k}" for k in range(1, 20)} | {"cliente123456789", "telefono 7"})
    d = spark.createDataFrame([(x,) for x in names], "t string")
    pairs = [(r.a, r.b) for r in X.similar_pairs(d, "t", 0.3).collect()]
    links = X.spanning_links(d, "t", 0.3).collect()
    assert {(r.a, r.b) for r in links} <= set(pairs)
    assert components_of(names, [(r.a, r.b) for r in links]) == components_of(names, pairs)
    assert tries > 2 or len(links) < 2 * len(names)


def test_one_family_has_links_in_proportion(spark):
    d = spark.createDataFrame([(f"cliente{k}",) for k in range(1, 201)], "t string")
    links = X.spanning_links(d, "t", 0.3).collect()
    assert 199 <= len(links) <= 600 < X.similar_pairs(d, "t", 0.3).count()
    names = [f"cliente{k}" for k in range(1, 201)]
    assert len(set(components_of(names, [(r.a, r.b) for r in links]).values())) == 1
