"""Backup-bundle retention: scan, keep-latest, history merge, reports.

The result is always a plan table; nothing is deleted here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablescout.functions import dates as D, paths as P, vocabulary as V

GROUP = ["flow", "env", "nickname", "proyecto"]


def bundle_scan(objects: DataFrame, root: str, ref: Column, cutoff_days: int = V.DEFAULT_CUTOFF_DAYS) -> DataFrame:
    """Parsed bundles older than the cut-off; age and path are tested before parsing."""
    aged = (objects.withColumn("creado", D.from_millis(F.col("lastModified")))
            .filter(D.older_than(F.col("creado"), ref, max(0, int(cutoff_days)))
                    & F.col("path").rlike(P.bundle_pattern(root))))
    return (P.with_bundle_fields(aged, "path", root)
            .select(P.path_id(F.col("path")).alias("id"), F.col("path").alias("s3_path"), *GROUP, "filename", "creado",
                    F.date_format("creado", "yyyy-MM-dd HH:mm:ss").alias("fecha_creacion_s3"),
                    P.megabytes(F.col("size")).alias("size")))


def new_candidates(bundles: DataFrame, history: DataFrame) -> DataFrame:
    return bundles.join(history.select("s3_path"), "s3_path", "left_anti")


def keep_latest(bundles: DataFrame, group: list[str] = GROUP) -> DataFrame:
    """Mark the newest bundle of each group as kept, the rest as discarded.

    The newest row per group comes from a combinable maximum; marking joins on
    the unique path, so a group of any size is never gathered in one task.
    """
    newest = (bundles.groupBy(*group)
              .agg(F.max(F.struct("creado", "filename", "s3_path")).alias("_b"))
              .select(F.col("_b.s3_path").alias("s3_path"), F.lit(True).alias("_keep")))
    return (bundles.join(newest, "s3_path", "left")
            .withColumn("estado", F.when(F.col("_keep"), F.lit(V.STATUS_KEEP)).otherwise(F.lit(V.STATUS_DISCARD)))
            .drop("_keep"))


def history_view(history: DataFrame, root: str) -> DataFrame:
    """History rows with environment, nickname and file name rebuilt from the path."""
    own = history.select("id", "s3_path", F.col("flow").alias("_flow"), F.col("proyecto").alias("_proyecto"),
                         "fecha_creacion_s3", "fecha_periodo_limpieza", "size")
    blank = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return P.with_bundle_fields(own, "s3_path", root).select(
        "id", "s3_path", D.first_filled(F.col("_flow"), F.col("flow"), default="").alias("flow"), blank("env"),
        blank("nickname"), F.col("_proyecto").alias("proyecto"), blank("filename"), "fecha_creacion_s3",
        "fecha_periodo_limpieza", "size", F.lit(V.STATUS_KEEP).alias("estado"))


def merge_history(history: DataFrame, marked: DataFrame, period: str) -> DataFrame:
    """Drop discarded paths, insert or overwrite kept ones.

    One full outer join on the unique path; each side is read once.
    """
    cols = [c for c in V.HISTORY_COLUMNS if c != "s3_path"]
    new = marked.withColumn("fecha_periodo_limpieza", F.lit(period)).withColumn(
        "id", D.first_filled(F.col("id"), P.path_id(F.col("s3_path")), default=""))
    new = new.select("s3_path", "estado", *[F.col(c).alias(f"_{c}") for c in cols])
    joined = history.select(*V.HISTORY_COLUMNS).join(new, "s3_path", "full_outer")
    kept = joined.filter(F.col("estado").isNull() | (F.col("estado") != V.STATUS_DISCARD))
    pick = lambda c: F.when(F.col("estado").isNotNull(), F.col(f"_{c}")).otherwise(F.col(c)).alias(c)
    return kept.select("s3_path", *[pick(c) for c in cols]).select(*V.HISTORY_COLUMNS)


def cleanup_report(marked: DataFrame, period: str) -> DataFrame:
    """Fixed-column report of one authorised run."""
    done = F.when(F.col("estado") == V.STATUS_DISCARD, F.lit(V.STATUS_DELETED)).otherwise(F.lit(V.STATUS_KEEP))
    return marked.withColumn("fecha_periodo_limpieza", F.lit(period)).select(
        *V.HISTORY_COLUMNS, done.alias("Estado"))


def global_report(bundles: DataFrame, history: DataFrame, period: str) -> DataFrame:
    """All bundles: history values where known, otherwise next to be removed."""
    cols = [c for c in V.HISTORY_COLUMNS if c != "s3_path"]
    h = history.select("s3_path", *[F.col(c).alias(f"h_{c}") for c in cols], F.lit(True).alias("_in"))
    j = bundles.withColumn("fecha_periodo_limpieza", F.lit(period)).join(h, "s3_path", "left")
    pick = lambda c: F.when(F.col("_in"), F.col(f"h_{c}")).otherwise(F.col(c)).alias(c)
    return j.select("s3_path", *[pick(c) for c in cols],
                    F.when(F.col("_in"), F.lit(V.STATUS_KEEP)).otherwise(F.lit(V.STATUS_NEXT)).alias("Estado")
                    ).select(*V.HISTORY_COLUMNS, "Estado")


def scan_and_history(scan: DataFrame, history: DataFrame) -> DataFrame:
    """Union by path; the scan row wins where both exist. Each side is read once."""
    cols = ["flow", "env", "proyecto", "size", "estado"]
    h = history.select("s3_path", *[F.col(c).alias(f"_{c}") for c in cols])
    joined = scan.select("s3_path", *cols, F.lit(True).alias("_scanned")).join(h, "s3_path", "full_outer")
    pick = lambda c: F.when(F.col("_scanned"), F.col(c)).otherwise(F.col(f"_{c}")).alias(c)
    return joined.select("s3_path", *[pick(c) for c in cols])


def environment_slices(bundles: DataFrame) -> DataFrame:
    return bundles.groupBy("flow", "env").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("estado") == V.STATUS_DISCARD).cast("long")).alias("n_discard"))


def storage_totals(bundles: DataFrame) -> DataFrame:
    """Total, to be freed and resulting megabytes (never below zero)."""
    free = F.when(F.col("estado") == V.STATUS_DISCARD, F.col("size")).otherwise(F.lit(0.0))
    return bundles.agg(F.sum("size").alias("t"), F.sum(free).alias("f")).select(
        F.round("t", 2).alias("total"), F.round("f", 2).alias("a_liberar"),
        F.round(F.greatest(F.col("t") - F.col("f"), F.lit(0.0)), 2).alias("resultante"))
