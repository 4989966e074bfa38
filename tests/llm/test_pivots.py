import numpy as np
import pytest

from tablescout.llm import pivots
from tablescout.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows):
    """Links of every pair in double precision."""
    ok = [(i, np.array(v, dtype=np.float64)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    n, root = len(ok), list(range(len(ok)))
    u = [v / np.linalg.norm(v / np.abs(v).max()) / np.abs(v).max() for _, v in ok]
    links = np.zeros((n, n), bool)
    for d in {len(x) for x in u}:
        at = [k for k in range(n) if len(u[k]) == d]
        m = np.stack([u[k] for k in at])
        links[np.ix_(at, at)] = m @ m.T >= 0.9
    np.fill_diagonal(links, False)

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    for a, b in zip(*np.nonzero(links)):
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    low = {}
    for k, (i, _) in enumerate(ok):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    comp = [low.get(find(k)) for k in range(n)]
    out = [(ok[k][0], int(links[k].sum()), comp[k], ok[k][0] == comp[k]) for k in range(n)]
    taken = [r for r in rows if not (r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1]))]
    return sorted(out + [(i, 0, i, True) for i, _ in taken], key=str)


def got(d):
    return sorted((tuple(r) for r in pivots.near_duplicates(d).collect()), key=str)


def noisy(rng, centre, n, cos):
    """Vectors at these cosines to the centre."""
    z = rng.normal(size=(n, len(centre)))
    z -= (z @ centre)[:, None] * centre
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    c = np.broadcast_to(np.asarray(cos, dtype=float), (n,))[:, None]
    return c * centre + np.sqrt(1 - c * c) * z


def planted(seed=3, n=1500):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    tight = noisy(rng, base[0], 700, 0.99)
    copies = np.repeat(base[1:2], 60, axis=0)
    small = np.concatenate([noisy(rng, base[k], 3, 0.985) for k in range(2, 80)])
    return np.concatenate((base, tight, copies, small)).astype(np.float32), rng


def test_query_on_the_table(spark, data):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{data}/embeddings.parquet").collect()]
    assert sorted((tuple(r) for r in QUERIES["op11_embedding_near_dedup"](spark, data).collect()), key=str) == brute(rows)


@pytest.mark.parametrize("block, dense", [(2048, 6), (40, 6), (64, 100)])
def test_copies_and_dense_groups_against_brute_force(spark, monkeypatch, block, dense):
    """Bundles, blocks of long lists, and both without bundles give the same links."""
    monkeypatch.setattr(pivots, "BLOCK", block)
    monkeypatch.setattr(pivots, "DENSE", dense)
    x, _ = planted()
    rows = [(int(k), v.tolist()) for k, v in enumerate(x)]
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows)


def test_bundles_that_link_in_part(spark):
    """Two dense groups whose members link with some of the other's, and single vectors between them."""
    rng = np.random.default_rng(5)
    a = np.eye(64)[0]
    b = noisy(rng, a, 1, 0.9)[0]
    x = np.concatenate((noisy(rng, a, 200, rng.uniform(0.985, 1, 200)), noisy(rng, b, 200, rng.uniform(0.985, 1, 200)), noisy(rng, a, 60, rng.uniform(0.85, 0.99, 60)),
                        noisy(rng, rng.normal(size=64) / 8, 300, 0.1))).astype(np.float32)
    rows = [(int(k), v.tolist()) for k, v in enumerate(x)]
    out, want = {r[0]: r for r in got(spark.createDataFrame(rows, SCHEMA))}, {r[0]: r for r in brute(rows)}
    found, all_ = sum(r[1] for r in out.values()), sum(r[1] for r in want.values())
    assert all(out[k][1] <= want[k][1] for k in want) and found >= 0.98 * all_


@pytest.mark.parametrize("cos, least", [(0.902, 0.9), (0.93, 0.95), (0.97, 0.99)])
def test_recall_of_pairs_near_the_limit(spark, cos, least):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(5000, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    x = np.concatenate((base, np.concatenate([noisy(rng, b, 1, cos) for b in base[:2000]]))).astype(np.float32)
    rows = [(int(k), v.tolist()) for k, v in enumerate(x)]
    out, want = got(spark.createDataFrame(rows, SCHEMA)), brute(rows)
    assert sum(r[1] for r in out) >= least * sum(r[1] for r in want)
    links = {r[0]: r[1] for r in want}
    assert all(r[1] <= links[r[0]] for r in out)


@pytest.mark.parametrize("rows", [
    [], [(1, None)], [(None, [1.0, 0.0])], [(5, [1.0, 2.0]), (5, [1.0, 2.0]), (None, [2.0, 4.0]), (3, [0.0, 0.0]), (4, []), (6, [1.0, None]), (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (9, [1.0, 2.0, 0.0]), (2, [1e-38, 2e-38]), (10, [-1.0, -2.0])],
    [(None, [1.0, 1.0]), (None, [1.0, 1.0]), (1, [1.0, -1.0])]])
def test_odd_rows(spark, rows):
    d = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS node", "3 AS unit", "4 AS raw", "5 AS label")
    assert got(d) == brute(rows)
    double = got(d.selectExpr("vec_id", "CAST(embedding AS ARRAY<DOUBLE>) AS embedding"))
    assert len(double) == len(rows)
