"""Registered queries: name -> (Spark callable, DuckDB text or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablescout.session import SETTINGS

RUNTIME = ("spark.sql.session.timeZone", "spark.sql.adaptive.coalescePartitions.minPartitionSize")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            for key, value in SETTINGS.items():
                if key in RUNTIME:
                    spark.conf.set(key, value)
            return fn(spark, sf_dir)
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return wrap


def register(name: str, fn, sql: str | None = None) -> None:
    query(name, sql)(fn)
