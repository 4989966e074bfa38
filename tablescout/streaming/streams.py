"""Streaming forms of rule scoring and drift monitoring."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tablescout.functions import rules as R, text as T, vocabulary as V
from tablescout.operators import decisions as X


def score_names(names: DataFrame, name: str = "name", prob: str = "prob") -> DataFrame:
    """Row-local scoring: normal form, first and unique rule, five-level decision.

    Works unchanged on a batch or a streaming DataFrame.
    """
    d = X.with_rule_levels(X.with_dotted_keys(X.with_matches(names, name, "_m"), name))
    d = X.five_level_decision(d, prob)
    first = F.when(F.size("_m") > 0, F.element_at("_m", 1)).otherwise(F.lit(V.OTHER_PII))
    return d.select(*names.columns, T.normalize_name(name).alias("name_norm"), first.alias("first_match"),
                    R.match_summary(F.col("_m")).alias("regex_match"), "pii", "prob_pii", "reason")


def score_with_bundle(names: DataFrame, bundle: PipelineModel) -> DataFrame:
    """Both stages of a saved bundle (`stages.scoring_bundle`) on a batch or a stream; one scan, no state."""
    return bundle.transform(names)


def drift_windows(scored: DataFrame, ts: str = "ts", prob: str = "prob", entity: str = "entity",
                  window: str = "1 day", review_below: float = 0.5) -> DataFrame:
    """Volume, mean probability, share without entity and share to review per window."""
    return (scored.groupBy(F.window(ts, window))
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(prob), 6).alias("prob_mean"),
                 F.round(F.avg(F.col(entity).isNull().cast("double")), 6).alias("no_entity_share"),
                 F.round(F.avg((F.col(prob) < review_below).cast("double")), 6).alias("review_share"))
            .select(F.col("window.start").alias("window_start"), "n", "prob_mean", "no_entity_share", "review_share"))


def watermarked_drift(stream: DataFrame, ts: str = "ts", delay: str = "1 hour", **kw) -> DataFrame:
    return drift_windows(stream.withWatermark(ts, delay), ts, **kw)


def run_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process everything available now and write it as Parquet (exactly once)."""
    q = (df.writeStream.format("parquet").outputMode(mode).option("path", path)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q
