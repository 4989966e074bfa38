"""Encoders and weights for training tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablescout.operators.catalog import top_categories
from tablescout.operators.grouping import attach
from tablescout.operators.splits import bucket



def _smoothed(sy: Column, sw: Column, n: Column, prior: Column, alpha: float) -> Column:
    return (sy / sw * n + alpha * prior) / (n + alpha)


def target_encoding(rows: DataFrame, key: str, y: str, w: str, alpha: float = 10.0) -> DataFrame:
    """Smoothed weighted mean per key: (mean*n + alpha*global) / (n + alpha)."""
    yw = F.col(y) * F.col(w)
    per = rows.groupBy(key).agg(F.sum(yw).alias("sy"), F.sum(w).alias("sw"), F.count("*").alias("n"))
    prior = per.agg((F.sum("sy") / F.sum("sw")).alias("g"))
    return attach(per, prior).select(
        key, "n", _smoothed(F.col("sy"), F.col("sw"), F.col("n"), F.col("g"), alpha).alias("te"))


def target_encoding_oof(rows: DataFrame, key: str, y: str, w: str, fold: str,
                        alpha: float = 10.0) -> DataFrame:
    """Encoding of each (key, fold) from the other folds only.

    Totals minus the fold's own sums, so one aggregation serves all folds; keys
    seen in one fold only get the global mean.
    """
    yw = F.col(y) * F.col(w)
    part = rows.groupBy(key, fold).agg(F.sum(yw).alias("fy"), F.sum(w).alias("fw"), F.count("*").alias("fn"))
    prior = part.agg((F.sum("fy") / F.sum("fw")).alias("g"))
    total = part.groupBy(key).agg(F.sum("fy").alias("ty"), F.sum("fw").alias("tw"), F.sum("fn").alias("tn"))
    n = F.col("tn") - F.col("fn")
    value = F.when(n > 0, _smoothed(F.col("ty") - F.col("fy"), F.col("tw") - F.col("fw"), n, F.col("g"), alpha)
                   ).otherwise(F.col("g"))
    return attach(part.join(total, key), prior).select(key, fold, value.alias("te_oof"))


def one_hot_top(rows: DataFrame, key: str, col: str, n: int = 20) -> DataFrame:
    """Indicator rows (key, category) over the n top categories, rest as OTROS."""
    top = top_categories(rows, col, n).select(F.col(col).alias("_c"), F.lit(True).alias("_top"))
    # at most n rows
    j = rows.withColumn("_v", F.coalesce(F.col(col), F.lit(""))).join(
        F.broadcast(top), F.col("_v") == F.col("_c"), "left")
    return j.select(key, F.concat(F.lit("typ_"), F.when(F.col("_top"), F.col("_v"))
                                  .otherwise(F.lit("OTROS"))).alias("category"))


def masked(key: Column, share: float, seed: str = "mask") -> Column:
    """True for a fixed pseudo-random share of the rows."""
    return bucket(F.concat_ws("|", F.lit(seed), key.cast("string")), 1000) < int(round(share * 1000))


def drop_description(rows: DataFrame, key: str, share: float = 0.60) -> DataFrame:
    """Hide the description (and its flag) on a share of the training rows."""
    hide = masked(F.col(key), share)
    return (rows.withColumn("masked", hide)
            .withColumn("description", F.when(hide, F.lit("")).otherwise(F.col("description")))
            .withColumn("has_description", F.when(hide, F.lit(False)).otherwise(F.col("has_description"))))


def imbalance_weight(rows: DataFrame, y: str, w: str | None = None) -> DataFrame:
    """Weighted negatives, positives and their ratio, as one row."""
    weight = F.col(w) if w else F.lit(1.0)
    return rows.agg(F.sum(F.col(y) * weight).alias("pos"), F.sum((1 - F.col(y)) * weight).alias("neg")).select(
        F.round("pos", 6).alias("pos"), F.round("neg", 6).alias("neg"),
        F.round(F.col("neg") / F.greatest("pos", F.lit(1.0)), 6).alias("scale_pos_weight"))


def balanced_weights(rows: DataFrame, label: str) -> DataFrame:
    """(label, class_weight) = rows / (classes * rows of the class)."""
    per = rows.groupBy(label).agg(F.count("*").alias("n"))
    total = per.agg(F.sum("n").alias("all_n"), F.count("*").alias("classes"))
    return attach(per, total).select(label, (F.col("all_n") / (F.col("classes") * F.col("n"))).alias("class_weight"))
