"""Backup-bundle paths."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F


def with_bundle_fields(df: DataFrame, path: str, root: str, whole_tail: bool = True) -> DataFrame:
    """Adds flow, env, nickname, proyecto and filename; all null where not a bundle.

    `root` is the first folder of the new layout root/env/nickname/project/file.
    Two older layouts are project/project_bundles/file and project/anything.
    `whole_tail=False` keeps only the fifth part as file name (older behaviour).
    """
    d = df.withColumn("_pp", F.split(F.regexp_replace(path, "^/+", ""), "/"))
    at = lambda i: F.get("_pp", F.lit(i))
    n = F.size("_pp")
    listed = (n >= 3) & (at(1) == "project_bundles")
    rest = lambda start: F.array_join(F.slice("_pp", F.lit(start), F.greatest(n - (start - 1), F.lit(0))), "/")
    d = d.withColumn("flow", F.when((n >= 5) & (at(0) == root), F.lit("NEW"))
                     .when(listed | ((n >= 2) & (at(0) != root)), F.lit("LEGACY")))
    new, old = F.col("flow") == "NEW", F.col("flow") == "LEGACY"
    return (d.withColumn("env", F.when(new, at(1)).when(old, F.lit("PROD")))
            .withColumn("nickname", F.when(new, at(2)).when(old, F.lit("LEGACY")))
            .withColumn("proyecto", F.when(new, at(3)).when(old, at(0)))
            .withColumn("filename", F.when(new, rest(5) if whole_tail else at(4)).when(old & listed, rest(3))
                        .when(old, rest(2)))
            .drop("_pp"))


def is_bundle(path: Column, flow: Column) -> Column:
    """New bundles are zip files; older ones need a file below a folder."""
    zipped = F.endswith(F.lower(path), F.lit(".zip"))
    clean = F.regexp_replace(F.regexp_replace(path, "^/+", ""), "/+$", "")
    nested = clean.contains("/")
    return F.coalesce(F.when(flow == "NEW", zipped).when(flow == "LEGACY", nested)
                      .otherwise(zipped | nested), F.lit(False))


def bundle_pattern(root: str) -> str:
    """One pattern for every path that parses and passes the bundle test.

    It can be evaluated on the raw path, next to the scan, before any parsing.
    """
    r = re.escape(root)
    new = rf"{r}/[^/]*/[^/]*/[^/]*/.*\.(?i:zip)"
    listed = rf"{r}/project_bundles/[^/]*(?:/[^/]*)?"
    other = rf"(?!{r}/)[^/]+/.*[^/]/*"
    return rf"(?s)^/*(?:{new}|{listed}|{other})$"


def path_id(path: Column) -> Column:
    return F.md5(path)


def megabytes(size_bytes: Column) -> Column:
    return F.bround(size_bytes / (1024 * 1024), 2)
