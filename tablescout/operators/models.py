"""Spark ML estimators for the two scoring stages.

Stage A says whether a name is personal data, stage B which entity it is.
Features are gram and word counts with the smoothed idf of `textsim`, unit
length, next to scaled numeric columns. Vocabularies are bounded by
`max_features`, so the vector width and what the driver holds are too.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression, OneVsRest,
                                       RandomForestClassifier)
from pyspark.ml.feature import (CountVectorizerModel, ElementwiseProduct, Normalizer,
                                StandardScaler, StringIndexer, VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, functions as F

from tablescout.functions import vocabulary as V
from tablescout.operators import evaluate as E
from tablescout.operators.calibration import Sigmoid, calibrated_over_folds, fit_sigmoid
from tablescout.operators.features import balanced_weights, imbalance_weight
from tablescout.operators.grouping import attach
from tablescout.operators.splits import fold_of
from tablescout.operators.stages import scoring_bundle
from tablescout.operators.textsim import char_wb_grams, term_counts, vocabulary, word_tokens
from tablescout.session import cut_lineage


def with_terms(df: DataFrame, text: str, lo: int = 2, hi: int = 5) -> DataFrame:
    return df.withColumn("grams", char_wb_grams(F.col(text), lo, hi)).withColumn("words", word_tokens(F.col(text)))


def fit_text_block(df: DataFrame, terms: str, out: str, min_df: int, max_features: int) -> list:
    """Fitted count -> idf -> unit length stages for one term column.

    The vocabulary is that of `textsim`: most frequent terms first, equal ones by name, so that its edge does not follow the partitions.
    """
    counts = term_counts(df.withColumn("_key", F.monotonically_increasing_id()), "_key", F.col(terms))
    # at most max_features rows
    known = sorted(vocabulary(counts, "_key", df, min_df, max_features).collect(), key=lambda r: (-r.df, r.term))
    counter = CountVectorizerModel.from_vocabulary([r.term for r in known], inputCol=terms, outputCol=f"{out}_tf")
    scale = ElementwiseProduct(scalingVec=Vectors.dense([r.idf for r in known]), inputCol=f"{out}_tf", outputCol=f"{out}_w")
    return [counter, scale, Normalizer(p=2.0, inputCol=f"{out}_w", outputCol=out)]


def fit_features(df: DataFrame, numeric: list[str] = (), min_df: int = 2, char_features: int = 5000,
                 word_features: int = 3000) -> PipelineModel:
    """Gram and word blocks plus numeric columns scaled without centring."""
    stages = fit_text_block(df, "grams", "f_char", min_df, char_features)
    stages += fit_text_block(df, "words", "f_word", min_df, word_features)
    blocks = ["f_char", "f_word"]
    if numeric:
        assemble = VectorAssembler(inputCols=list(numeric), outputCol="f_raw", handleInvalid="keep")
        scaler = StandardScaler(withMean=False, withStd=True, inputCol="f_raw", outputCol="f_num").fit(assemble.transform(df))
        stages += [assemble, scaler]
        blocks.append("f_num")
    stages.append(VectorAssembler(inputCols=blocks, outputCol="features"))
    return PipelineModel(stages=stages)


def binary_estimator(kind: str = "logistic", weight: str | None = None, **kw):
    common = dict(featuresCol="features", labelCol="y", **({"weightCol": weight} if weight else {}))
    if kind == "logistic":
        return LogisticRegression(maxIter=kw.get("max_iter", 25), regParam=kw.get("reg", 0.001), **common)
    if kind == "svm":
        return LinearSVC(maxIter=kw.get("max_iter", 25), regParam=kw.get("reg", 0.001), **common)
    if kind == "gbt":
        extra = {"validationIndicatorCol": kw["validation"]} if "validation" in kw else {}
        return GBTClassifier(maxIter=kw.get("max_iter", 20), maxDepth=4, seed=0, **extra, **common)
    raise ValueError(kind)


def entity_estimator(kind: str = "multinomial", weight: str | None = None, max_iter: int = 25):
    common = dict(featuresCol="features", labelCol="label")
    if kind == "multinomial":
        return LogisticRegression(family="multinomial", maxIter=max_iter, regParam=0.001,
                                  **({"weightCol": weight} if weight else {}), **common)
    if kind == "forest":
        return RandomForestClassifier(numTrees=40, maxDepth=8, seed=0, **({"weightCol": weight} if weight else {}), **common)
    if kind == "one_vs_rest":
        return OneVsRest(classifier=LogisticRegression(maxIter=max_iter, regParam=0.001), **common)
    raise ValueError(kind)


def raw_score(df: DataFrame) -> Column:
    """Probability of the positive class, or the margin where there is none."""
    col = "probability" if "probability" in df.columns else "rawPrediction"
    return vector_to_array(F.col(col))[1]


class BinaryModel:
    """Fitted features, classifier and (optionally) a one-feature calibrator."""

    def __init__(self, features: PipelineModel, classifier, calibrator=None):
        self.features, self.classifier, self.calibrator = features, classifier, calibrator

    def score(self, df: DataFrame, out: str = "prob") -> DataFrame:
        keep = df.columns
        s = self.classifier.transform(self.features.transform(df))
        s = s.withColumn("_raw", raw_score(s))
        value = self.calibrator(F.col("_raw")) if self.calibrator is not None else F.col("_raw")
        return s.select(*keep, value.alias(out))


def fit_binary(train: DataFrame, numeric: list[str] = (), kind: str = "logistic", weight: str | None = None,
               balance: bool = True, **features) -> BinaryModel:
    """`train` needs grams, words, y; class imbalance becomes a row weight."""
    if balance:
        ratio = imbalance_weight(train, "y", weight).first()["scale_pos_weight"] or 1.0
        base = F.col(weight) if weight else F.lit(1.0)
        train = train.withColumn("_w", base * F.when(F.col("y") == 1, F.lit(max(float(ratio), 1.0) if kind == "logistic" else float(ratio))).otherwise(F.lit(1.0)))
        weight = "_w"
    train = cut_lineage(train)  # read once per fitted stage below
    fitted = fit_features(train, list(numeric), **features)
    return BinaryModel(fitted, binary_estimator(kind, weight).fit(fitted.transform(train)))


def fit_platt(scored: DataFrame, raw: str = "oof_raw", y: str = "y") -> Sigmoid:
    """Sigmoid calibration: a logistic regression on the raw score alone."""
    return fit_sigmoid(scored, raw, y)


def apply_platt(model: Sigmoid, raw: Column) -> Column:
    return model(raw)


def out_of_fold(rows: DataFrame, k: int, numeric: list[str] = (), kind: str = "logistic", weight: str | None = None,
                synthetic: DataFrame | None = None, **features) -> DataFrame:
    """Out-of-fold scores of every real row; children train with their parent's folds.

    `rows`: grams, words, y, group. `synthetic`: grams, words, y, parent.
    """
    rows = rows.withColumn("fold", fold_of(F.col("group"), k))
    parts = []
    for f in range(k):
        train = rows.filter(F.col("fold") != f)
        if synthetic is not None:
            parents = train.select(F.col("group").alias("parent")).distinct()
            extra = synthetic.join(parents, "parent", "left_semi")
            train = train.unionByName(extra, allowMissingColumns=True)
        model = fit_binary(train, numeric, kind, weight, **features)
        parts.append(model.score(rows.filter(F.col("fold") == f), "oof_raw"))
    return reduce(lambda a, b: a.unionByName(b), parts)


class EntityModel:
    def __init__(self, features: PipelineModel, classifier, classes: list[str]):
        self.features, self.classifier, self.classes = features, classifier, classes

    def predict(self, df: DataFrame) -> DataFrame:
        """Adds entity_ml and prob_entity (null where the classifier has no probabilities)."""
        keep = df.columns
        s = self.classifier.transform(self.features.transform(df))
        names = F.array(*[F.lit(c) for c in self.classes])
        entity = F.element_at(names, (F.col("prediction") + 1).cast("int"))
        prob = F.array_max(vector_to_array("probability")) if "probability" in s.columns else F.lit(None).cast("double")
        return s.select(*keep, entity.alias("entity_ml"), prob.alias("prob_entity"))


def fit_entity(train: DataFrame, kind: str = "multinomial", weight: str | None = None, **features) -> EntityModel:
    """`train` needs grams, words, entity; classes are weighted to balance."""
    indexer = StringIndexer(inputCol="entity", outputCol="label", stringOrderType="alphabetAsc").fit(train)
    # one row per class
    w = F.broadcast(balanced_weights(train, "entity"))
    ready = indexer.transform(train.join(w, "entity")).withColumn(
        "_w", F.col("class_weight") * (F.col(weight) if weight else F.lit(1.0)))
    ready = cut_lineage(ready)
    fitted = fit_features(ready, **features)
    return EntityModel(fitted, entity_estimator(kind, "_w").fit(fitted.transform(ready)), list(indexer.labels))


def entity_out_of_fold(rows: DataFrame, k: int, synthetic: DataFrame | None = None, kind: str = "multinomial",
                       **features) -> DataFrame:
    """Out-of-fold predictions without and with synthetic children (base / aug)."""
    rows = rows.withColumn("fold", fold_of(F.col("group"), k))
    parts = []
    for f in range(k):
        train, test = rows.filter(F.col("fold") != f), rows.filter(F.col("fold") == f)
        base = fit_entity(train, kind, **features).predict(test).drop("prob_entity").withColumnRenamed("entity_ml", "pred_base")
        if synthetic is not None:
            parents = train.select(F.col("group").alias("parent")).distinct()
            extra = synthetic.join(parents, "parent", "left_semi")
            more = train.unionByName(extra, allowMissingColumns=True)
            base = fit_entity(more, kind, **features).predict(base).drop("prob_entity").withColumnRenamed("entity_ml", "pred_aug")
        else:
            base = base.withColumn("pred_aug", F.col("pred_base"))
        parts.append(base)
    return reduce(lambda a, b: a.unionByName(b), parts)


def compare_candidates(train: DataFrame, test: DataFrame, kinds: list[str], threshold: float, numeric: list[str] = (),
                       weight: str | None = None, key: str = "name_norm", entity: str | None = None, gate: list[str] = V.GATE_ENTITIES, folds: int = 3, **features) -> DataFrame:
    """Fit every candidate, score the same hold-out, rank by (recall, f1); the first one is the winner.

    Linear candidates are calibrated over `folds` folds of `key`. Each row has the confusion at `threshold`, the Brier score, the
    highest F2 with the operating threshold below it, and, with `entity`, the recall of each entity in `gate`.
    """
    parts = []
    for kind in kinds:
        fit = lambda rows: fit_binary(rows, numeric, kind, weight, **features)  # noqa: B023,E731
        model = fit(train) if kind == "gbt" else calibrated_over_folds(train, fit, F.col(key), folds)
        scored = cut_lineage(model.score(test, "prob").select("prob", "y", *([entity] if entity else [])))
        row = attach(attach(E.confusion(scored, "prob", "y", threshold, 3), E.brier(scored, "prob", "y")),
                     E.threshold_below_best_f2(E.precision_recall_curve(scored, "prob", "y")).select(F.round("f2max", 3).alias("f2max"), F.round("thr_f2", 3).alias("thr_f2")))
        if entity:
            gates = E.gate_recall(scored, "prob", "y", entity, threshold, gate)
            row = attach(row, gates.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(entity, "recall")))).alias("rec_gate")))
        parts.append(row.withColumn("modelo", F.lit(kind)))
    out = cut_lineage(reduce(lambda a, b: a.unionByName(b), parts))
    first = out.agg(F.min(F.struct((-F.col("recall")).alias("r"), (-F.col("f1")).alias("f"), "modelo")).alias("k")).select(F.col("k.modelo").alias("_first"))
    return attach(out, first).withColumn("ganador", F.col("modelo") == F.col("_first")).drop("_first").orderBy(F.desc("recall"), F.desc("f1"), "modelo")


def compare_masked(train: DataFrame, test: DataFrame, variants: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Union of scored variants in (variant, mode) form; see evaluate.compare_modes."""
    parts = []
    for name, (rows, numeric) in variants.items():
        model = fit_binary(rows, numeric)
        for mode, data in {"intacta": test, "enmascarada": test.withColumn("words", F.array().cast("array<string>"))
                           .withColumn("has_description", F.lit(0))}.items():
            parts.append(model.score(data, "prob").select("prob", "y", F.lit(f"{name}/{mode}").alias("mode")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def score_two_stages(names: DataFrame, binary: BinaryModel, entity: EntityModel, threshold: float,
                     entity_threshold: float = V.ENTITY_THRESHOLD) -> DataFrame:
    """Stage A on every row, stage B where it flags one, then the rule override.

    `names` needs tabla, name. Both stages are row-local and follow each other on
    the same rows, so the input is scanned and its terms are made once; what
    stage B says of rows that are not flagged is dropped.
    """
    o = scoring_bundle(binary, entity, threshold, entity_threshold).transform(names)
    return o.select("tabla", F.col("name").alias("columna"), "pii", "prob_pii", "entity", "prob_entity", "override_aplicado",
                    "regex_match", "name_norm")
