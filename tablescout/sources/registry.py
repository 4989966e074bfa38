"""Instance registry as a table: append, update, delete by id. No secrets."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablescout.operators.grouping import attach


def register(registry: DataFrame, new: DataFrame) -> DataFrame:
    """Append rows with fresh ids after the highest one in use (ids never repeat); blank rows get none."""
    from pyspark.sql import Window as W
    highest = registry.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_max"))
    # a registration is a handful of form entries
    filled = new.filter("trim(nombre) <> '' AND trim(url) <> ''")
    ready = attach(filled.withColumn("_n", F.row_number().over(W.orderBy("nombre", "url"))), highest).select(
        (F.col("_max") + F.col("_n")).cast("long").alias("id"), F.trim("nombre").alias("nombre"), F.trim("url").alias("url"))
    return registry.select("id", "nombre", "url").unionByName(ready)


def remove(registry: DataFrame, ids: DataFrame) -> DataFrame:
    return registry.join(ids.select("id"), "id", "left_anti")


def update(registry: DataFrame, changes: DataFrame) -> DataFrame:
    """Replace name and address of known ids; unknown ids change nothing."""
    c = changes.select("id", F.col("nombre").alias("_n"), F.col("url").alias("_u"))
    return registry.join(c, "id", "left").select(
        "id", F.coalesce("_n", "nombre").alias("nombre"), F.coalesce("_u", "url").alias("url"))
