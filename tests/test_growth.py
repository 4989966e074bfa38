"""Work that must grow with the rows: texts taken apart once, and what a shuffle carries."""

import time

import pytest
from pyspark.sql import functions as F

from checks import adapters as A
from tablescout.operators import catalog as C, textsim as X


def nodes(df):
    found = [df._jdf.queryExecution().optimizedPlan()]
    for n in found:
        found += [n.children().apply(i) for i in range(n.children().size())]
    return found


@pytest.mark.parametrize("text, want", [("ab cd  ef", ["ab", "cd", "ef", "ab cd", "cd ef"]), ("ab", ["ab"]), ("", []), ("x", [])])
def test_pairs(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(X.word_tokens(F.col("t"))).first()[0] == want


def test_long_text_in_time(spark):
    """With the list named in the lambda the text was taken apart 2 x 30,000 times."""
    t = spark.range(1).select(F.repeat(F.lit("word "), 30_000).alias("t"))
    began = time.time()
    assert t.select(F.size(X.word_tokens(F.col("t")))).first()[0] == 59_999
    assert time.time() - began < 30


def test_terms_need_no_shuffle_of_their_own(spark):
    docs = spark.range(10).select(F.col("id").alias("k"), F.lit("ab cd ab").alias("t"))
    plan = X.term_counts(docs, "k", X.word_tokens(F.col("t")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "hashpartitioning(k" in plan


def test_names_are_distinct_before_their_base_form(spark):
    names = spark.createDataFrame([("Nombre_1",)] * 3 + [("fecha",)], "name string")
    got = X.token_overlap(names, spark.createDataFrame([("nombre",)], "d string"), "name", "d")
    assert sorted(tuple(r) for r in got.collect()) == [("Nombre_1", 100.0), ("fecha", 0.0)]
    assert not [n for n in nodes(got) if n.nodeName() == "Aggregate" and "qs" in n.groupingExpressions().toString()]


def test_examples_of_candidates(spark, data):
    rows = [("a", "d1", "t", None), ("a", "d1", "t", " nan "), ("b", "d2", None, "zz"), ("b", "d1", "t", "é" * 400), ("b", "d1", "t", "zz"), ("c", "d1", "t", "x" * 400)]
    got = {r.name: (r.n_filas, r.datasets, r.tipos, r.desc_ejemplo) for r in C.pool_candidates(spark.createDataFrame(rows, "name string, dataset string, type string, description string")).collect()}
    assert got == {"a": (2, "d1", "t", ""), "b": (3, "d1 | d2", " | t", "zz"), "c": (1, "d1", "t", "x" * 300)}
    for n in nodes(C.pool_candidates(A.pool(spark, data))):
        if n.nodeName() in ("Join", "Aggregate"):
            assert "description" not in [n.output().apply(i).name() for i in range(n.output().size())]


@pytest.mark.parametrize("name", ["u3_split_overlap", "j7_split_membership"])
def test_binary_rows_are_made_once(spark, data, monkeypatch, name):
    from checks import all_queries, q_eval
    made = []
    real = q_eval._bin
    monkeypatch.setattr(q_eval, "_bin", lambda s, d: made.append(1) or real(s, d))
    df = all_queries()[0][name](spark, data)
    assert len(made) == 1 and not [n for n in nodes(df) if n.nodeName() == "Generate"]
