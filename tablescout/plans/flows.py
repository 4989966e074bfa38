"""End-to-end plans composed from the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablescout.functions import rules as R, text as T, vocabulary as V
from tablescout.operators import catalog as C, decisions as X, labels as L, lifecycle as LC, retention as RT
from tablescout.sources.headers import scan_headers
from tablescout.sources.schema_scan import table_headers


def scan_report(columns: DataFrame) -> DataFrame:
    """Rule verdict per scanned column: normal form, first and unique match."""
    m = F.col("_m")
    first = F.when(F.size(m) > 0, F.element_at(m, 1)).otherwise(F.lit(V.OTHER_PII))
    return X.with_matches(columns, "name", "_m").select(
        *columns.columns, T.normalize_name("name").alias("name_norm"), first.alias("entity"),
        R.match_summary(m).alias("regex_match"), (F.size(m) > 0).alias("pii"))


def personal_columns(tables: dict[str, DataFrame]) -> DataFrame:
    """Which columns of these tables hold personal data, and of which kind."""
    return scan_report(table_headers(tables))


def personal_columns_of_files(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """The same over files: headers are read by tasks, one plan node for any number of paths."""
    return scan_report(scan_headers(spark, paths, fmt))


def transfer_labels(pool: DataFrame, gold: DataFrame, floor: float = 0.5, complete: bool = True) -> DataFrame:
    """Catalogue both sides, match names, apply the label rule, return every pool row."""
    pool_keys = C.key_rollup(C.name_catalog(pool)).filter("key <> ''")
    gold_keys = C.key_rollup(C.name_catalog(gold)).filter("key <> ''")
    per_key = L.transferred(L.neighbour_table(pool_keys, gold_keys, floor, complete))
    rows = pool.withColumn("key", T.join_key("name"))
    return L.propagate(rows, per_key)


def cleanup_plan(objects: DataFrame, history: DataFrame, root: str, ref: Column, cutoff_days: int) -> DataFrame:
    """New bundles past the cut-off, each marked kept or discarded."""
    return RT.keep_latest(RT.new_candidates(RT.bundle_scan(objects, root, ref, cutoff_days), history))


def stale_plan(projects: DataFrame, jobs: DataFrame, timeline: DataFrame, ref: Column, threshold: int) -> DataFrame:
    return LC.stale_projects(projects, jobs, timeline, ref, threshold)
