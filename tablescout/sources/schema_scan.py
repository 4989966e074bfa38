"""Table schemas as data: one row per column of every scanned table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

COLUMN_ROW = "source_file string, name string, dataset string, type string, position int"


def usable_header(name: str) -> bool:
    clean = name.strip()
    return bool(clean) and clean.lower() != "nan"


def schema_rows(tables: dict[str, DataFrame]) -> list[tuple]:
    """Headers of each table from its schema; no data is read."""
    return [(t, f.name.strip(), t, f.dataType.simpleString(), i)
            for t, df in tables.items() for i, f in enumerate(df.schema.fields) if usable_header(f.name)]


def scan_schemas(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    return spark.createDataFrame(schema_rows(tables), COLUMN_ROW)


def scan_paths(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> tuple[DataFrame, list[str]]:
    """Scan many paths; unreadable or empty ones become warnings."""
    tables, warnings = {}, []
    for name, path in paths.items():
        try:
            df = spark.read.format(fmt).option("header", "true").load(path)
        except Exception as e:  # one bad file must not stop the scan
            warnings.append(f"{name}: {type(e).__name__}")
            continue
        if df.columns:
            tables[name] = df
        else:
            warnings.append(f"{name}: no columns")
    return scan_schemas(spark, tables), warnings


def table_headers(tables: dict[str, DataFrame]) -> DataFrame:
    """(source_file, name, dataset, type, n_rows) per column, from schemas and row counts.

    A count without columns is answered from the file footers: no data page is read.
    """
    parts = []
    for t, df in tables.items():
        cells = F.array(*[F.struct(F.lit(f.name.strip()).alias("name"), F.lit(f.dataType.simpleString()).alias("type"))
                          for f in df.schema.fields if usable_header(f.name)])
        parts.append(df.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.inline(cells))
                     .select(F.lit(t).alias("source_file"), "name", F.lit(t).alias("dataset"), "type", "n_rows"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def profile_columns(tables: dict[str, DataFrame]) -> DataFrame:
    """(source_file, name, n_rows, n_null, accepts_null) per column.

    One aggregation per table; the null counts travel as one array.
    """
    parts = []
    for t, df in tables.items():
        cols = [c for c in df.columns if usable_header(c)]
        quoted = [F.col(f"`{c}`") for c in cols]
        agg = df.agg(F.count(F.lit(1)).alias("n_rows"),
                     *[F.count(F.when(q.isNull(), 1)).alias(f"_n{i}") for i, q in enumerate(quoted)])
        cells = F.array(*[F.struct(F.lit(c.strip()).alias("name"), F.col(f"_n{i}").alias("n_null"))
                          for i, c in enumerate(cols)])
        parts.append(agg.select(F.lit(t).alias("source_file"), "n_rows", F.explode(cells).alias("x"))
                     .select("source_file", "x.name", "n_rows", "x.n_null", (F.col("x.n_null") > 0).alias("accepts_null")))
    return reduce(lambda a, b: a.unionByName(b), parts)
