"""Balances that lie halfway between two scores of four digits."""

import duckdb
import pytest

from checks import all_queries
from checks.verify import oracle, rows_of

QUERIES, ORACLES = all_queries()


@pytest.mark.parametrize("name", ["s7_verdict_report", "f35_reported_probability"])
def test_ties_round_as_in_the_sql(spark, tmp_path, name):
    rows = spark.range(22_000).selectExpr("id AS c_custkey", "concat('c', id) AS c_name", "cast(id % 25 AS int) AS c_nationkey", "(id - 2000) / 2.0D + 0.5D AS c_acctbal", "'BUILDING' AS c_mktsegment")
    rows.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet/*.parquet'")
    df = QUERIES[name](spark, str(tmp_path))
    cols, want = oracle(con, ORACLES[name])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, want)
