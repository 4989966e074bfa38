"""CSV and JSON exchange: tolerant reading, exact report layouts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablescout.functions import text as T, vocabulary as V

BOM = "﻿"


def read_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Header row, UTF-8 with an optional BOM, Latin-1 where UTF-8 does not decode.

    Each file is decoded on its own. Every value is text; callers cast. `multi_line`
    allows line breaks inside quotes, at the price of files that cannot be split.
    """
    def load(files: list[str], encoding: str) -> DataFrame:
        df = (spark.read.option("header", True).option("encoding", encoding).option("multiLine", multi_line)
              .option("quote", '"').option("escape", '"').csv(files))
        return df.toDF(*[c.lstrip(BOM).removeprefix("ï»¿").strip() for c in df.columns])

    lines = spark.read.text(path)
    flags = (lines.select(F.input_file_name().alias("file"), F.is_valid_utf8("value").alias("fine"))
             .groupBy("file").agg(F.every("fine").alias("fine")).filter(~F.col("fine")))
    broken = {r.file for r in flags.collect()}  # names of files only
    files = lines.inputFiles()
    parts = [load([f for f in files if (f in broken) == bad], encoding)
             for bad, encoding in ((False, "UTF-8"), (True, "ISO-8859-1")) if any((f in broken) == bad for f in files)]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def verdict_report(scored: DataFrame) -> DataFrame:
    """Six-column report: verdict words, percentages with two decimals."""
    percent = lambda c: F.format_string("%.2f", F.col(c) * 100)
    cells = [F.coalesce("tabla", F.lit("")), F.col("columna"),
             F.when(F.col("pii"), F.lit("PII")).otherwise(F.lit("NO PII")), percent("prob_pii"),
             F.coalesce("entity", F.lit("")),
             F.when(F.col("prob_entity").isNull(), F.lit("")).otherwise(percent("prob_entity"))]
    return scored.select(*[c.alias(h) for c, h in zip(cells, V.VERDICT_HEADER)])


def csv_line(cols: list[Column]) -> Column:
    """One CSV line; quotes only around values holding a comma, quote or newline."""
    def cell(c: Column) -> Column:
        v = T.text(c)
        quoted = F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.when(v.rlike('[",\\n]'), quoted).otherwise(v)
    return F.concat_ws(",", *[cell(c) for c in cols])


def write_report(df: DataFrame, path: str, bom: bool = False) -> None:
    """CSV with CRLF line ends: part files of lines, written by the executors.

    The header, with the BOM when asked for, starts the first part.
    """
    sep = "\r\n"
    header = (BOM if bom else "") + ",".join(df.columns)
    lines = df.select(csv_line([F.col(f"`{c}`") for c in df.columns]).alias("value"))
    head = df.sparkSession.createDataFrame([(header,)], "value string")
    head.union(lines).write.mode("overwrite").option("lineSep", sep).text(path)


def previous_verdicts(raw: DataFrame) -> DataFrame:
    """Earlier report rows as (tabla, key, pii_previo, prob_previo)."""
    return raw.select(
        F.trim(F.regexp_replace(T.text("Archivo"), r"\.xlsx?$", "")).alias("tabla"),
        T.join_key(F.trim(T.text("Nombre de Columna"))).alias("key"),
        (~F.upper(T.text("Prediccion")).contains("NO")).alias("pii_previo"),
        (F.col("Probabilidad PII (%)").try_cast("double") / 100).alias("prob_previo"))


def file_stem(path: Column) -> Column:
    return F.regexp_replace(F.substring_index(path, "/", -1), r"\.[^.]+$", "")


def metric_rows(spark: SparkSession, metrics: dict) -> DataFrame:
    """(metric, variant, value): scalars as text, nested values as JSON."""
    import json
    rows = [(k, "json" if isinstance(v, (dict, list)) else "value",
             json.dumps(v, ensure_ascii=False) if isinstance(v, (dict, list)) else str(v))
            for k, v in metrics.items()]
    return spark.createDataFrame(rows, "metric string, variant string, value string")


def findings_json(findings: DataFrame) -> DataFrame:
    """One JSON record list per finding type (a bounded dictionary of counts)."""
    item = F.struct((-F.col("n_obs")).alias("o"), F.col("valor"), F.col("n_obs"))
    g = findings.groupBy("tipo").agg(F.sort_array(F.collect_list(item)).alias("x"))
    return g.select("tipo", F.to_json(F.transform("x", lambda r: F.struct(r["valor"].alias("valor"), r["n_obs"].alias("n_obs")))).alias("records"))
