"""A corpus from raw documents to packed sequences. Each stage works on all that the stage before it kept.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns the columns of `docs`, the last one the packed
pieces. `run` applies them in turn, each result written as Parquet below spark.checkpoint.dir and read again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablescout.llm import decontaminate, line_dedup, packing, shingle_dedup, toxicity
from tablescout.llm.common import shared_dir, table, unpack
from tablescout.llm.queries import tokenizer_path


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network rejects go."""
    scored = toxicity.score_texts(docs, table(spark, sf_dir, "labels"))
    return unpack(scored.filter(F.col("predicted") == 0), docs.columns)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in at least 10 documents go."""
    return line_dedup.without_repeated_lines(docs, min_docs=10)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (Jaccard similarity 0.8 of five-word shingles) stays, the one of the smallest id."""
    return shingle_dedup.without_near_copies(docs, width=5, similarity=0.8)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"), similarity=0.8)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences."""
    return packing.pack(docs, tokenizer_path(), size=4096, end_id=1)


STAGES = [("toxicity", toxic_documents), ("line_dedup", repeated_lines), ("shingle_near_dedup", near_copies),
          ("benchmark_decontamination", benchmark_passages), ("pattern_packing", packed)]
ORACLE_SQL = None  # networks, trees and tokenizers have no SQL; the stages are tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, home = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{home}/{k}-{name}")
        docs = spark.read.parquet(f"{home}/{k}-{name}")
    return docs
