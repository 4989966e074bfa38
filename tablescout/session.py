"""Session settings the library relies on."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # short strings unfold into many grams: keep small shuffles parallel
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "tablescout", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; where none is named, one in the warehouse, which is shared as well."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or f"{_warehouse(spark)}/_checkpoints")


def _warehouse(spark: SparkSession) -> str:
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh folder every executor can reach: below spark.checkpoint.dir, or in the warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or f"{_warehouse(spark)}/_scratch"
    return f"{shared.rstrip('/')}/tablescout-{name}-{uuid.uuid4().hex}"


class Rounds:
    """Tables that a loop writes anew in each round, below the shared folder; the last two states of each are on disk.

    A checkpoint keeps the optimizer's size estimate of the plan behind it. In a loop of joins these estimates multiply from round to
    round until they take longer than the work; a table that is read again has the size of its files, small ones are broadcast by it.
    """

    def __init__(self, spark: SparkSession, name: str = "rounds"):
        self.spark, self.root, self.turn = spark, scratch_dir(spark, name), {}

    def put(self, name: str, df: DataFrame) -> DataFrame:
        turn = self.turn[name] = 1 - self.turn.get(name, 1)
        path = f"{self.root}/{name}-{turn}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
