import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tablescout.llm import merkle
from tablescout.llm.queries import DOC_COLUMNS, QUERIES, ORACLES
from checks.verify import connect, oracle, rows_of


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def paths(hashes):
    """Root and, for each leaf, [(left, right)]."""
    at, found = list(range(len(hashes))), [[] for _ in hashes]
    while len(hashes) > 1:
        for k, i in enumerate(at):
            run = hashes[i - i % 3:i - i % 3 + 3]
            found[k].append(("".join(run[:i % 3]), "".join(run[i % 3 + 1:])))
        hashes = [sha("".join(hashes[i:i + 3])) for i in range(0, len(hashes), 3)]
        at = [i // 3 for i in at]
    return hashes[0], found


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(("s" + r[1]).encode() if r[1] is not None else b"", []).append(r)
    done = {}
    for g, rs in groups.items():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        done[g] = (rs, *paths([leaf_of(r) for r in rs]))
    names = sorted(done)
    root, high = paths([done[g][1] for g in names])
    out = []
    for g, above in zip(names, high):
        rs, sub, low = done[g]
        for r, path in zip(rs, low):
            path = path + above
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            acc = leaf_of([*r[:4], r[4].replace("\n", "") if bad else r[4]])
            for a, b in path:
                acc = sha(a + acc + b)
            out.append((r[0], leaf_of(r), sub, root, sha("".join(a + b for a, b in path)), acc, acc == root))
    return out


def spark_rows(d):
    d = merkle.manifest(d, DOC_COLUMNS, changed={"text": F.regexp_replace("text", "\n", "")}, tampered=F.crc32(F.col("doc_id").cast("string")) % 2 == 0)
    return [tuple(r) for r in d.collect()]


def order(rows):
    return sorted(rows, key=str)


def test_query_against_brute_force(spark, data):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    out = [tuple(r) for r in QUERIES["op12_merkle_manifest"](spark, data).collect()]
    assert order(out) == order(brute(rows))
    assert {r[6] for r in out} == {True, False}


def test_query_against_sql(spark, data):
    df = QUERIES["op12_merkle_manifest"](spark, data)
    cols, want = oracle(connect(data), ORACLES["op12_merkle_manifest"])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, want)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28, 82, 90])
def test_blocks_join_to_the_tree_of_all_leaves(spark, monkeypatch, n):
    monkeypatch.setattr(merkle, "DEPTH", 2)
    monkeypatch.setattr(merkle, "BLOCK", 9)
    rows = [(i, "hot" if i % 4 else f"s{i % 7}", "en", i, f"a\nb{i}") for i in range(n)]
    d = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    assert order(spark_rows(d)) == order(brute(rows))


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None), (None, None, "x", 1, "a\nb"), (3, "é", None, None, ""), (3, "é", None, None, ""), (4, "z", "y", 2, "\n" * 70000), (5, "", "", 0, "\n")]])
def test_odd_rows(spark, rows):
    d = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").selectExpr("*", "1 AS g", "2 AS h", "3 AS pos", "4 AS `_u`", "5 AS id")
    assert order(spark_rows(d)) == order(brute(rows) if rows else [])
