"""Saved models and the parameter table that travels with them."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def parameters(spark: SparkSession, threshold: float, variant: str = "A", target: str = "pii_final") -> DataFrame:
    return spark.createDataFrame([(float(threshold), variant, target)], "threshold double, variante string, target string")


def override_threshold(params: DataFrame, new: float, reason: str) -> DataFrame:
    """New threshold with the earlier value and the reason kept beside it."""
    return (params.withColumn("threshold_previo", F.col("threshold"))
            .withColumn("threshold", F.lit(float(new))).withColumn("threshold_motivo", F.lit(reason)))


def save_parameters(params: DataFrame, path: str) -> None:
    params.write.mode("overwrite").json(path)


def load_parameters(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)
