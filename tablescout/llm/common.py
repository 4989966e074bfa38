"""Helpers shared by the operators: row keys, checkpoints, Arrow kernels, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tablescout.session import cut_lineage, ensure_checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\x0b\x0c\r"  # [\x20\x09-\x0D]


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`_i`, `_h`: never-null key of a row; `_row`: all its columns; `_t`: its text, null as empty.

    Rows of equal id and text are one document. Packing the columns into `_row` keeps them apart from working columns.
    """
    text = F.col(f"`{text_col}`")
    return docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(0)).alias("_i"),
        F.xxhash64(F.col(f"`{id_col}`").isNull(), text).alias("_h"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.coalesce(text, F.lit("")).alias("_t"))


def unpack(df: DataFrame, columns: list[str], **new: Column) -> DataFrame:
    """The columns packed by `keyed`, some of them replaced."""
    return df.select(*[new[c].alias(c) if c in new else F.col(f"_row.`{c}`").alias(c) for c in columns])


def arrow_map(df: DataFrame, kernel, schema: str) -> DataFrame:
    """mapInArrow over a kernel that turns one pyarrow table into another."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from kernel(batch).to_batches()
    return df.mapInArrow(run, schema)


def worker_state(name: str, make):
    """An object that a Python worker keeps from one task to the next."""
    import sys
    import types
    home = sys.modules.setdefault("_tablescout_worker", types.ModuleType("_tablescout_worker"))
    if not hasattr(home, name):
        setattr(home, name, make())
    return getattr(home, name)


def components(edges: DataFrame, a: str, b: str, persist=cut_lineage) -> DataFrame:
    """(node, root): for each node of an edge the smallest node it can reach. Nodes are longs.

    Alternates large stars and small stars until a round changes nothing; each round is checkpointed.
    Minima are combined before the shuffle, and the joins are plain sort-merge joins, whose hot keys
    Spark splits at run time.
    """
    cur = persist(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct())
    seen = None
    while True:
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u")
        cur = persist(small.select(F.col("u"), F.col("m").alias("v")).union(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))).filter("u <> v").distinct())
        now = cur.agg(F.count("u"), F.sum(F.xxhash64("u", "v") % 1000003), F.countDistinct("u")).first()
        if now == seen or now[0] == 0:
            break
        seen = now
    stars = cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = stars.select(F.col("root").alias("node"), "root").distinct()
    return stars.union(roots)


def ranked(df: DataFrame, groups: list[str], order: list[Column]) -> DataFrame:
    """`pos` (from 0) of each row in its group by `order`, `n` rows of the group. Group columns hold no null.

    Rows are dealt by range over group and order and counted in each slice, so that a group may be larger than a task. Rows that
    are equal in everything follow in the order of a number that is given once and kept.
    """
    d = cut_lineage(df.withColumn("_u", F.monotonically_increasing_id()))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = cut_lineage(d.repartitionByRange(parts, *groups, *order, "_u").withColumn("_s", F.spark_partition_id()))
    before = W.partitionBy(*groups).orderBy("_s").rowsBetween(W.unboundedPreceding, -1)
    starts = d.groupBy(*groups, "_s").agg(F.count(F.lit(1)).alias("_c")).select(
        *groups, "_s", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"), F.sum("_c").over(W.partitionBy(*groups)).alias("n"))
    here = F.row_number().over(W.partitionBy(*groups, "_s").orderBy(*order, "_u"))
    return d.join(starts, [*groups, "_s"]).withColumn("pos", F.col("_before") + here - 1).drop("_u", "_s", "_before")


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, shared by driver and executors."""
    ensure_checkpoint_dir(spark)
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
