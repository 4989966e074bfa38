"""Threshold curves, confusion metrics, slices, gates and calibration measures.

All metrics start from counts per distinct score: that table is combined
map-side, and every curve or grid is computed from it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tablescout.functions import vocabulary as V
from tablescout.operators.grouping import attach
from tablescout.session import cut_lineage

SLICES = 200


def score_counts(df: DataFrame, score: str, label: str) -> DataFrame:
    return df.groupBy(F.col(score).alias("score")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.count("*").alias("n"))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def rate_columns(tp: Column, fp: Column, fn: Column, tn: Column | None = None) -> dict[str, Column]:
    out = {
        "precision": _ratio(tp, tp + fp), "recall": _ratio(tp, tp + fn),
        "f1": _ratio(2 * tp, 2 * tp + fp + fn), "f2": _ratio(5 * tp, 5 * tp + fp + 4 * fn),
    }
    if tn is not None:
        out["accuracy"] = (tp + tn) / (tp + tn + fp + fn)
        out["especificidad"] = _ratio(tn, tn + fp)
    return out


def threshold_grid(df: DataFrame, score: str, label: str, thresholds=V.GRID_THRESHOLDS,
                   full: bool = False, digits: int = 6) -> DataFrame:
    """Confusion counts and rates at each threshold, from one aggregation pass."""
    hit = lambda t: (F.col("score") >= F.lit(t))
    aggs = [F.sum("pos").alias("p"), F.sum("n").alias("n")]
    for i, t in enumerate(thresholds):
        aggs += [F.sum(F.when(hit(t), F.col("pos")).otherwise(0)).alias(f"tp{i}"),
                 F.sum(F.when(hit(t), F.col("n")).otherwise(0)).alias(f"hit{i}")]
    wide = score_counts(df, score, label).agg(*aggs)
    cells = ", ".join(f"double({t}), tp{i}, hit{i}" for i, t in enumerate(thresholds))
    long = wide.selectExpr("p", "n", f"stack({len(thresholds)}, {cells}) AS (thr, tp, hit)")
    c = (long.withColumn("fp", F.col("hit") - F.col("tp")).withColumn("fn", F.col("p") - F.col("tp"))
         .withColumn("tn", F.col("n") - F.col("hit") - F.col("p") + F.col("tp")))
    rates = rate_columns(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    keep = list(rates) if full else ["precision", "recall", "f1", "f2"]
    return c.select("thr", "tp", "fp", "fn", "tn", *[F.round(rates[k], digits).alias(k) for k in keep])


def cumulative_counts(df: DataFrame, score: str, label: str) -> DataFrame:
    """(score, pos, n, tp, hit, p): counts at or above each distinct score.

    The data is read once into counts per score. Distributed running sum:
    distinct scores are cut into slices at their quantiles (a bounded list),
    slice totals give each slice its start, and a window runs inside a slice.
    `p` is the total of positives.
    """
    counts = cut_lineage(score_counts(df, score, label))
    cuts = counts.agg(F.percentile_approx("score", [i / SLICES for i in range(1, SLICES)]).alias("cuts"))
    sliced = attach(counts, cuts).withColumn(
        "slice", F.size(F.filter("cuts", lambda x: x <= F.col("score")))).drop("cuts")
    totals = sliced.groupBy("slice").agg(F.sum("pos").alias("sp"), F.sum("n").alias("sn"))
    # the windows below see at most SLICES rows
    above = W.orderBy(F.desc("slice")).rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select("slice", F.coalesce(F.sum("sp").over(above), F.lit(0)).alias("bp"),
                           F.coalesce(F.sum("sn").over(above), F.lit(0)).alias("bn"),
                           F.sum("sp").over(W.partitionBy(F.lit(1))).alias("p"))
    inside = W.partitionBy("slice").orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, 0)
    return (sliced.join(F.broadcast(starts), "slice")
            .select("score", "pos", "n", (F.col("bp") + F.sum("pos").over(inside)).alias("tp"),
                    (F.col("bn") + F.sum("n").over(inside)).alias("hit"), "p"))


def precision_recall_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    c = cumulative_counts(df, score, label)
    rates = rate_columns(F.col("tp"), F.col("hit") - F.col("tp"), F.col("p") - F.col("tp"))
    return c.select(F.col("score").alias("threshold"), "tp", (F.col("hit") - F.col("tp")).alias("fp"),
                    *[v.alias(k) for k, v in rates.items()])


def best_threshold(curve: DataFrame, thr: str, metric: str, digits: int = 9) -> DataFrame:
    """Highest metric; equal values go to the lowest threshold."""
    key = F.struct((-F.round(F.col(metric), digits)).alias("m"), F.col(thr).alias("t"))
    best = curve.agg(F.min(F.struct(key.alias("k"), F.struct(*curve.columns).alias("row"))).alias("b"))
    return best.select("b.row.*")


def threshold_below_best_f2(curve: DataFrame) -> DataFrame:
    """The score one step below the F2 maximum, with the metrics of the maximum.

    On the ascending curve the operating point is moved one distinct score
    down; at the lowest score it stays.
    """
    curve = cut_lineage(curve)
    best = best_threshold(curve, "threshold", "f2").select(
        F.col("threshold").alias("at"), F.col("f2").alias("f2max"), F.col("precision").alias("prec_en_thr"),
        F.col("recall").alias("rec_en_thr"))
    below = (attach(curve, best).filter(F.col("threshold") < F.col("at"))
             .agg(F.max("threshold").alias("lower")))
    return attach(best, below).select(F.coalesce("lower", "at").alias("thr_f2"), "f2max",
                                      "prec_en_thr", "rec_en_thr")


def recommended_threshold(grid: DataFrame, min_recall: float = V.RECOMMEND_MIN_RECALL,
                          min_precision: float = V.RECOMMEND_MIN_PRECISION) -> DataFrame:
    """Best F2 among feasible thresholds, else best F2 overall; flag tells which."""
    ok = (F.col("recall") >= min_recall) & (F.col("precision") >= min_precision)
    key = F.struct((~ok).alias("a"), (-F.col("f2")).alias("m"), F.col("thr").alias("t"))
    best = grid.withColumn("feasible", ok).agg(
        F.min(F.struct(key.alias("k"), F.struct(*grid.columns, "feasible").alias("row"))).alias("b"))
    return best.select("b.row.*")


def confusion(df: DataFrame, score: str, label: str, threshold: float, digits: int = 4) -> DataFrame:
    return threshold_grid(df, score, label, [threshold], full=True, digits=digits)


def recall_by_entity(df: DataFrame, score: str, label: str, entity: str, threshold: float) -> DataFrame:
    hit = (F.col(score) >= threshold).cast("long")
    return df.filter(F.col(label) == 1).groupBy(entity).agg(
        F.count("*").alias("n"), F.round(F.avg(hit.cast("double")), 6).alias("recall"))


def gate_recall(df: DataFrame, score: str, label: str, entity: str, threshold: float,
                gate: list[str], minimum: float = 1.0) -> DataFrame:
    """Recall of the gate entities; absent ones stay null and do not pass."""
    spark = df.sparkSession
    wanted = spark.createDataFrame([(g,) for g in gate], f"{entity} string")
    r = recall_by_entity(df.filter(F.col(entity).isin(gate)), score, label, entity, threshold)
    return wanted.join(r, entity, "left").select(
        entity, F.coalesce("n", F.lit(0)).alias("n"), "recall",
        F.coalesce(F.col("recall") >= minimum, F.lit(False)).alias("pass"))


def class_metrics(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Support, precision, recall and F1 per class; absent ratios count as 0."""
    pairs = df.groupBy(F.col(truth).alias("t"), F.col(pred).alias("p")).agg(F.count("*").alias("n"))
    cells = pairs.select(F.explode(F.array(
        F.struct(F.col("t").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0).alias("tp")),
        F.struct(F.col("p").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"),
                 F.lit(0).cast("long").alias("tp")))).alias("x")).select("x.*")
    g = cells.filter("class IS NOT NULL").groupBy("class").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp"))
    return g.select("class", "support", "tp",
                    F.round(_ratio(F.col("tp"), F.col("predicted")), 6).alias("precision"),
                    F.round(_ratio(F.col("tp"), F.col("support")), 6).alias("recall"),
                    F.round(_ratio(2 * F.col("tp"), F.col("support") + F.col("predicted")), 6).alias("f1"))


def macro_metrics(df: DataFrame, truth: str, pred: str) -> DataFrame:
    per = class_metrics(df, truth, pred)
    return per.agg(F.round(F.avg("f1"), 6).alias("macro_f1"), F.round(F.avg("recall"), 6).alias("macro_recall"),
                   F.round(F.sum("tp") / F.sum("support"), 6).alias("accuracy"), F.count("*").alias("n_classes"))


def average_precision(df: DataFrame, score: str, label: str) -> DataFrame:
    """Sum over distinct scores of (recall step x precision)."""
    return cumulative_counts(df, score, label).agg(
        F.round(F.sum(F.col("pos") / F.col("p") * F.col("tp") / F.col("hit")), 6).alias("pr_auc"))


def brier(df: DataFrame, score: str, label: str) -> DataFrame:
    c = score_counts(df, score, label)
    neg = F.col("n") - F.col("pos")
    loss = F.col("pos") * (F.col("score") - 1) * (F.col("score") - 1) + neg * F.col("score") * F.col("score")
    return c.agg(F.round(F.sum(loss) / F.sum("n"), 6).alias("brier"))


def calibration_error(df: DataFrame, score: str, label: str, bins: int = 10) -> DataFrame:
    """Expected calibration error over equal-width bins."""
    spot = F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)).cast("int")
    b = score_counts(df, score, label).groupBy(spot.alias("bin")).agg(
        F.sum("n").alias("n"), F.sum("pos").alias("pos"), F.sum(F.col("n") * F.col("score")).alias("s"))
    total = b.agg(F.sum("n").alias("all_n"))
    return attach(b, total).agg(F.round(F.sum(F.abs(F.col("pos") - F.col("s")) / F.col("all_n")), 6).alias("ece"))


def ranked_errors(df: DataFrame, score: str, label: str, threshold: float, name: str,
                  k: int = 15) -> DataFrame:
    """The k most probable misses and the k most probable false alarms."""
    hit = F.col(score) >= threshold
    base = df.select(name, F.round(score, 4).alias("prob"), (F.col(label) == 1).alias("real"), hit.alias("hit"))
    top = lambda d, kind: d.orderBy(F.desc("prob"), name).limit(k).select(
        F.lit(kind).alias("kind"), name, "prob")
    return top(base.filter("real AND NOT hit"), "FN").unionByName(top(base.filter("hit AND NOT real"), "FP"))


def quality_gates(metrics: DataFrame, gates=V.QUALITY_GATES) -> DataFrame:
    """(metric, value, op, bound, pass) for every gate; one without its metric fails."""
    g = metrics.sparkSession.createDataFrame([(m, o, float(b)) for m, o, b in gates], "metric string, op string, bound double")
    g = g.join(metrics.select("metric", "value"), "metric", "left")
    v, b = F.col("value"), F.col("bound")
    ok = (F.when(F.col("op") == ">=", v >= b).when(F.col("op") == "<=", v <= b).otherwise(v < b))
    return g.select("metric", "value", "op", "bound", F.coalesce(ok, F.lit(False)).alias("pass"))


def long_metrics(one_row: DataFrame, variant: str) -> DataFrame:
    """(metric, variant, value) rows of a one-row metric table."""
    cells = ", ".join(f"'{c}', double({c})" for c in one_row.columns)
    return one_row.selectExpr(f"stack({len(one_row.columns)}, {cells}) AS (metric, value)").select(
        "metric", F.lit(variant).alias("variant"), "value")


def compare_modes(df: DataFrame, mode: str, score: str, label: str, threshold: float = 0.5, contest: Column | None = None) -> DataFrame:
    """One row per value of `mode`, a small set such as masked / intact.

    Recall and F1 at `threshold`; the highest F2 with the operating threshold one
    score below it and the rates there; `ganador` marks the mode of the highest
    (F2, F1) among those that meet `contest` (all by default).
    """
    hit = F.col("score") >= threshold
    counts = cut_lineage(df.groupBy(mode, F.col(score).alias("score")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.count("*").alias("n")))
    fixed = counts.groupBy(mode).agg(F.sum("pos").alias("p"), F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
                                     F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("h"))
    rates = rate_columns(F.col("tp"), F.col("h") - F.col("tp"), F.col("p") - F.col("tp"))
    fixed = fixed.select(mode, F.round(rates["recall"], 3).alias("recall"), F.round(rates["f1"], 3).alias("f1"))
    values = [r[0] for r in fixed.select(mode).collect()]  # one row a mode
    best = [threshold_below_best_f2(precision_recall_curve(df.filter(F.col(mode).eqNullSafe(F.lit(v))), score, label)).select(
        F.lit(v).cast("string").alias(mode), *[F.round(c, 3).alias(c) for c in ("f2max", "thr_f2", "prec_en_thr", "rec_en_thr")]) for v in values]
    if not best:
        return fixed.select("*", *[F.lit(None).cast("double").alias(c) for c in ("f2max", "thr_f2", "prec_en_thr", "rec_en_thr")], F.lit(False).alias("ganador"))
    out = cut_lineage(fixed.join(reduce(lambda a, b: a.unionByName(b), best), mode))
    meets = contest if contest is not None else F.lit(True)
    first = out.filter(meets).agg(F.min(F.struct((-F.col("f2max")).alias("a"), (-F.col("f1")).alias("b"), F.col(mode).alias("m"))).alias("k")).select(F.col("k.m").alias("_first"))
    return attach(out, first).withColumn("ganador", F.coalesce(F.col(mode) == F.col("_first"), F.lit(False))).drop("_first")
