"""Readers with declared schemas and tolerant column handling."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

STAMP = T.StructType([T.StructField("lastModifiedOn", T.LongType())])
PROJECTS = T.StructType([
    T.StructField("projectKey", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("ownerLogin", T.StringType()), T.StructField("ownerDisplayName", T.StringType()),
    T.StructField("tags", T.ArrayType(T.StringType())), T.StructField("contributors", T.ArrayType(T.StringType())),
    T.StructField("tutorialProject", T.BooleanType()),
    T.StructField("versionTag", STAMP), T.StructField("creationTag", STAMP)])
JOBS = T.StructType([
    T.StructField("projectKey", T.StringType()),
    T.StructField("def", T.StructType([T.StructField("initiationTimestamp", T.LongType())])),
    T.StructField("startTime", T.LongType())])
TIMELINE = T.StructType([
    T.StructField("projectKey", T.StringType()),
    T.StructField("items", T.ArrayType(T.StructType([T.StructField("timestamp", T.LongType())])))])
OBJECTS = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("lastModified", T.LongType()),
    T.StructField("size", T.LongType())])

NAME_ALIASES = ["name", "columna", "column", "nombre_columna"]
TABLE_ALIASES = ["tabla", "dataset", "source_file"]


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def overwrite_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite").format(fmt)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def read_first(spark: SparkSession, paths: list[str], fmt: str = "parquet") -> DataFrame:
    """The first input that exists."""
    for path in paths:
        try:
            return read_table(spark, path, fmt)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
    raise FileNotFoundError(f"none of the inputs exists: {paths}")


def read_present(spark: SparkSession, paths: list[str], fmt: str = "parquet") -> list[DataFrame]:
    """Every input that exists, in order; missing ones are skipped."""
    out = []
    for path in paths:
        try:
            out.append(read_table(spark, path, fmt))
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
    return out


def union_present(frames: list[DataFrame | None]) -> DataFrame:
    present = [f for f in frames if f is not None]
    if not present:
        raise FileNotFoundError("no input available")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), present)


def resolve_aliases(df: DataFrame, default_table: str = "piloto") -> DataFrame:
    """Settle the name and table columns whatever the feeding system calls them."""
    name = next((c for c in NAME_ALIASES if c in df.columns), None)
    if name is None:
        raise ValueError(f"a column called one of {NAME_ALIASES} is required")
    table = next((c for c in TABLE_ALIASES if c in df.columns), None)
    out = df.withColumn("_name", F.col(name)).withColumn(
        "_tabla", F.col(table).cast("string") if table else F.lit(default_table))
    rest = [c for c in df.columns if c not in (name, table, "name", "tabla")]
    return out.select(F.col("_tabla").alias("tabla"), F.col("_name").alias("name"), *rest)


def list_objects(spark: SparkSession, folder: str) -> DataFrame:
    """(path, lastModified ms, size) of every file below a folder, contents unread."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).drop("content"))
    return files.select("path", F.unix_millis("modificationTime").alias("lastModified"), F.col("length").alias("size"))


def read_projects(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROJECTS).json(path)


def read_jobs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(JOBS).json(path)


def read_timeline(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TIMELINE).json(path)
