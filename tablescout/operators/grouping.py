"""Bounded per-group helpers shared by the operators.

Groups may be very uneven, so nothing here ships a whole group to one task:
duplicates are removed and counts combined before the shuffle, and a top-k per
group is a `row_number() <= k` filter, which Spark also applies per input
partition (WindowGroupLimit) before exchanging rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int,
          rank: str = "rn") -> DataFrame:
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def first_values(df: DataFrame, keys: list[str], value: str, k: int, out: str,
                 sep: str = " | ") -> DataFrame:
    """The k smallest distinct values per group, sorted and joined."""
    kept = top_k(df.select(*keys, value).distinct(), keys, [F.col(value)], k, "_rn")
    return kept.groupBy(*keys).agg(
        F.array_join(F.sort_array(F.collect_list(value)), sep).alias(out))


def best_row(df: DataFrame, keys: list[str], order: list[str], payload: list[str]) -> DataFrame:
    """One row per key: the smallest `order` tuple, combined map-side."""
    fields = order + [c for c in payload if c not in order]
    return (df.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_best"))
            .select(*keys, *[F.col(f"_best.{c}").alias(c) for c in payload]))


def most_common(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Modal value per key; ties go to the smallest value."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return (counts.groupBy(*keys)
            .agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v"))).alias("_b"))
            .select(*keys, F.col("_b.v").alias(out), (-F.col("_b.n")).alias(f"{out}_n")))


def attach(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row aggregate through a scalar subquery."""
    return (df.withColumn("_one", one_row.select(F.struct(*one_row.columns)).scalar())
            .select(*df.columns, *[F.col(f"_one.{c}").alias(c) for c in one_row.columns]))
