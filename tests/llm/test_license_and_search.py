import random

import numpy as np
import pytest

from checks.verify import connect, oracle, rows_of
from tablescout.llm import license_scan, topk, url_filter
from tablescout.llm.queries import ORACLES, QUERIES, URL_RULES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_duckdb(spark, data, name):
    df = QUERIES[name](spark, data)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    cols, want = oracle(connect(data), ORACLES[name])
    assert sorted(cols) == sorted(df.columns) and want
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, want)


def test_native_plans_hold_no_python(spark, data):
    for name in ("op2_line_dedup", "op8_license_scan", "op10_url_filter"):
        plan = QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def brute_top(rows, k):
    v = {i: np.floor(64 * np.array(x, dtype=float)).astype(int) for i, x in rows}
    out = set()
    for q in v:
        if q % 20 == 0:
            s = sorted(((-int(v[q] @ v[c]), c) for c in v if c != q and len(v[c]) == len(v[q])))[:k]
            out |= {(q, n, c, -x) for n, (x, c) in enumerate(s, 1)}
    return out


def test_top_k_with_ties_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 100)
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(6).round(1).tolist()) for i in range(400)] + [(400 + i, [1.0] * 6) for i in range(200)] + [(1000, [1.0]), (1001, [2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS score", "2 AS rank")
    df = df.withColumn("embedding", df.embedding.cast("array<double>"))
    got = topk.top_k(df, df.vec_id % 20 == 0, k=5).collect()
    assert {tuple(r) for r in got} == brute_top([(r.vec_id, r.embedding) for r in df.collect()], 5) and len(got) == len(set(got))


def test_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [0.5, 0.5]), (5, [0.5, 0.5]), (None, [1.0, 1.0]), (6, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk.top_k(df, df.vec_id % 20 == 0).collect()] == [(0, 1, 5, 2048)]
    assert topk.top_k(df.limit(0), df.vec_id == 0).count() == 0


def test_odd_urls(spark):
    urls = [None, "", "no scheme", "http://", "http://net", "http://a.NET/x", "http://xnet/x", "http://w.Example.net/en/1?u=://b", "ftp://example.com/de/", "https://b.org/fr/#x", "https://b.org/fr", "http://u@net:80/", "http://net/" + "a/" * 5000]
    df = spark.createDataFrame([(n if n % 5 else None, u) for n, u in enumerate(urls)], "page_id long, url string").selectExpr("*", "1 AS host", "2 AS bad")
    out = sorted((r.host, r.path[:6], r.rule, r.verdict) for r in url_filter.judge_urls(df, URL_RULES).collect())
    assert out == sorted([("", "", None, "allow")] * 4 + [("net", "", None, "allow"), ("a.net", "/x", "net/", "block"), ("xnet", "/x", None, "allow"), ("w.example.net", "/en/1", "example.net/en/", "allow"),
                          ("example.com", "/de/", "example.com/de/", "block"), ("b.org", "/fr/", "org/fr/", "allow"), ("b.org", "/fr", None, "allow"), ("u@net:80", "/", None, "allow"), ("net", "/a/a/a"[:6], "net/", "block")])
    assert url_filter.judge_urls(df.limit(0), URL_RULES).count() == 0


def test_tree_rejects_pure_branches_and_widens_numbers(spark):
    rows = [(f"http://h.x/ads/{n}", True) for n in range(30)] + [(f"http://h.x/news/{n}", False) for n in range(30)] + [("http://h.x/ads/new", None), ("http://h.x/news/new", None), ("http://h.x/ads/99", None)]
    rows += [(f"http://h.x/ads/{a}{b}", None) for a in "abcdefgh" for b in "abcdefgh"]
    df = spark.createDataFrame([(n, u, bad) for n, (u, bad) in enumerate(rows)], "page_id long, url string, bad boolean")
    out = {r.path: (r.verdict, r.template) for r in url_filter.judge_urls(df, [], label=df.bad).collect()}
    assert out["/ads/99"] == ("block", "ads/*") and out["/ads/ab"][0] == "block" and out["/news/3"] == ("allow", "news/*")


def test_license_edges_and_recall(spark):
    rng, rows = random.Random(4), []
    for n, (name, text) in enumerate(license_scan.NOTICES * 12):
        pad = lambda: " ".join(rng.choices("abcdefgh", k=rng.randint(0, 90)))
        rows.append((n, f"{pad()} {text.upper() if n % 2 else text} {pad()}"))
    rows += [(1000, None), (1001, ""), (None, "Released under the MIT License"), (1002, "x " * 100000 + "Released, under\nthe MIT License."), (1003, "released under the license MIT")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS license", "2 AS k")
    got = {(r.doc_id, r.license) for r in license_scan.scan(df).collect()}
    assert {(n, name) for n, (name, _) in enumerate(license_scan.NOTICES * 12)} <= got
    assert {(None, "MIT"), (1002, "MIT")} <= got and not {i for i, _ in got} & {1000, 1001, 1003}
    assert license_scan.scan(df.limit(0)).count() == 0
