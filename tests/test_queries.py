"""Every registered query against its DuckDB text, and the shape of the plans."""

import duckdb
import pytest

from checks import all_queries
from checks.verify import connect, oracle, rows_of

QUERIES, ORACLES = all_queries()
FAST = sorted(ORACLES)


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", FAST)
def test_matches_duckdb(spark, data, con, name):
    df = QUERIES[name](spark, data)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cols, want = oracle(con, ORACLES[name])
    assert sorted(df.columns) == sorted(cols)
    assert got == rows_of(cols, want)


def test_model_queries_keep_their_invariants(spark, data):
    scored = QUERIES["m25_two_stage_scoring"](spark, data)
    bad = scored.filter("(pii AND entity IS NULL) OR (NOT pii AND entity IS NOT NULL) OR prob_pii NOT BETWEEN 0 AND 1 OR (override_aplicado AND prob_entity >= 0.5)")
    assert scored.count() > 0 and bad.count() == 0
    oof = QUERIES["m16_out_of_fold"](spark, data)
    assert oof.groupBy("name_norm").count().filter("count > 1").count() == 0
    assert {r.fold for r in oof.select("fold").distinct().collect()} == {0, 1, 2}
    same = QUERIES["s13_model_artefacts"](spark, data).first()
    assert same.n == same.same and same.threshold == 0.75 and same.threshold_previo == 0.5
