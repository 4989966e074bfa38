"""Sigmoid calibration by Newton's method, and classifiers calibrated over folds.

A round of the fit is one aggregate of five sums over the scores; only those sums reach the driver, so its size does not follow the
data. The objective is the logistic loss plus half the squared slope, the intercept being free, as in a logistic regression with C = 1.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tablescout.operators.splits import fold_of
from tablescout.session import cut_lineage


@dataclass(frozen=True)
class Sigmoid:
    slope: float
    intercept: float

    def __call__(self, raw: Column) -> Column:
        return 1 / (1 + F.exp(-(raw * F.lit(self.slope) + F.lit(self.intercept))))


def fit_sigmoid(scored: DataFrame, raw: str = "oof_raw", y: str = "y", weight: str | None = None, penalty: float = 1.0, rounds: int = 25, tolerance: float = 1e-10) -> Sigmoid:
    """Slope and intercept of P(y = 1) over a raw score. Rows with a null or NaN score or label take no part.

    A round that would not lower the loss is halved, so separable scores end at the penalized optimum as well; without rows, or with
    one class only and no penalty to hold it, the last finite estimate is returned.
    """
    x, t, w = F.col(raw).cast("double"), F.col(y).cast("double"), F.col(weight).cast("double") if weight else F.lit(1.0)
    data = cut_lineage(scored.select(x.alias("x"), t.alias("t"), w.alias("w")).filter("x IS NOT NULL AND NOT isnan(x) AND t IS NOT NULL")
                       .groupBy("x", "t").agg(F.sum("w").alias("w")))
    a, b, at = 0.0, 0.0, _sums(data, 0.0, 0.0, penalty)
    for _ in range(rounds):
        loss, ga, gb, haa, hab, hbb = at
        det = haa * hbb - hab * hab
        if not det > 1e-300:
            break
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        step = 1.0
        at = _sums(data, a - da, b - db, penalty)
        while at[0] > loss + 1e-12 * abs(loss) and step > 1e-3:
            step /= 2
            at = _sums(data, a - step * da, b - step * db, penalty)
        a, b = a - step * da, b - step * db
        if max(abs(da), abs(db)) * step < tolerance:
            break
    return Sigmoid(a, b)


def _sums(data: DataFrame, a: float, b: float, penalty: float) -> tuple[float, ...]:
    """Loss, its gradient by slope and intercept, and its second derivatives."""
    x, t, w = F.col("x"), F.col("t"), F.col("w")
    z = x * F.lit(a) + F.lit(b)
    p = 1 / (1 + F.exp(-z))
    # log(1 + exp(z)) - t z without overflow
    loss = F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z))) - t * z
    h = w * p * (1 - p)
    s = data.agg(*[F.coalesce(F.sum(e), F.lit(0.0)) for e in (w * loss, w * (p - t) * x, w * (p - t), h * x * x, h * x, h)]).first()
    return s[0] + penalty * a * a / 2, s[1] + penalty * a, s[2], s[3] + penalty, s[4], s[5]


class AveragedModel:
    """Mean of calibrated scores of several fitted models."""

    def __init__(self, members: list):
        self.members = members  # (model, sigmoid): fitted on all folds but one, calibrated on that one

    def score(self, df: DataFrame, out: str = "prob") -> DataFrame:
        keep = df.columns
        for n, (model, sigmoid) in enumerate(self.members):
            df = model.score(df, f"_raw{n}").withColumn(f"_cal{n}", sigmoid(F.col(f"_raw{n}"))).drop(f"_raw{n}")
        mean = reduce(lambda p, q: p + q, [F.col(f"_cal{n}") for n in range(len(self.members))]) / len(self.members)
        return df.select(*keep, mean.alias(out))


def calibrated_over_folds(train: DataFrame, fit, key: Column, k: int = 3) -> AveragedModel:
    """`fit(rows)` on all folds but one, its scores calibrated on that one, for each of `k` folds by `key`."""
    rows = cut_lineage(train.withColumn("_fold", fold_of(key, k)))
    members = []
    for f in range(k):
        model = fit(rows.filter(F.col("_fold") != f).drop("_fold"))
        members.append((model, fit_sigmoid(model.score(rows.filter(F.col("_fold") == f), "_raw"), "_raw")))
    return AveragedModel(members)
