"""The two scoring stages as Spark ML transformers in one saved pipeline.

`scoring_bundle` puts the terms of a name, both fitted stages, calibration, gate, class names and the rule override into one
PipelineModel. It is saved and loaded as a whole, every part works on one row at a time, and so the same bundle scores a batch or a
stream in one scan. What the stages keep is bounded by the vocabularies and the number of classes, not by the data.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters as C
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from tablescout.functions import rules as R, scores as S, text as T, vocabulary as V
from tablescout.operators.textsim import char_wb_grams, word_tokens

WORKING = ["grams", "words", "features", "f_char", "f_char_tf", "f_char_w", "f_word", "f_word_tf", "f_word_w", "f_raw", "f_num",
           "rawPrediction", "probability", "prediction"]


class _Stage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A transformer whose whole state is its parameters."""

    def _value(self, name: str):
        return self.getOrDefault(self.getParam(name))


class NameTerms(_Stage):
    """Adds name_norm and, of it, the grams and words that both stages count."""

    nameCol = Param(Params._dummy(), "nameCol", "column of the raw name", C.toString)

    @keyword_only
    def __init__(self, *, nameCol="name"):
        super().__init__()
        self._setDefault(nameCol="name")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        d = df.withColumn("name_norm", T.normalize_name(self._value("nameCol")))
        return d.withColumn("grams", char_wb_grams(F.col("name_norm"), 2, 5)).withColumn("words", word_tokens(F.col("name_norm")))


class CalibratedGate(_Stage):
    """Adds prob_pii, the positive score after the sigmoid if there is one, and pii where it reaches the threshold; drops working columns."""

    scoreCol = Param(Params._dummy(), "scoreCol", "probability or rawPrediction of the classifier", C.toString)
    threshold = Param(Params._dummy(), "threshold", "score from which a name is flagged", C.toFloat)
    sigmoid = Param(Params._dummy(), "sigmoid", "slope and intercept, or nothing", C.toListFloat)
    keep = Param(Params._dummy(), "keep", "working columns that stay", C.toListString)

    @keyword_only
    def __init__(self, *, scoreCol="probability", threshold=0.5, sigmoid=[], keep=["grams", "words"]):
        super().__init__()
        self._setDefault(scoreCol="probability", threshold=0.5, sigmoid=[], keep=["grams", "words"])
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        raw, line = vector_to_array(F.col(self._value("scoreCol")))[1], self._value("sigmoid")
        prob = 1 / (1 + F.exp(-(raw * F.lit(line[0]) + F.lit(line[1])))) if line else raw
        d = df.withColumn("prob_pii", prob).withColumn("pii", F.col("prob_pii") >= F.lit(self._value("threshold")))
        return d.drop(*[c for c in WORKING if c not in self._value("keep")])


class EntityNames(_Stage):
    """Adds entity_ml and prob_entity by the class names, null where the gate has not flagged the row; drops working columns."""

    classes = Param(Params._dummy(), "classes", "class names in the order of the labels", C.toListString)

    @keyword_only
    def __init__(self, *, classes=[]):
        super().__init__()
        self._setDefault(classes=[])
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        names = F.array(*[F.lit(c) for c in self._value("classes")])
        entity = F.element_at(names, (F.col("prediction") + 1).cast("int"))
        prob = F.array_max(vector_to_array("probability")) if "probability" in df.columns else F.lit(None).cast("double")
        d = df.withColumn("entity_ml", F.when(F.col("pii"), entity)).withColumn("prob_entity", F.when(F.col("pii"), F.bround(prob, 4)))
        return d.drop(*WORKING)


class RuleOverride(_Stage):
    """Adds entity, override_aplicado and regex_match: a single rule beats an entity below the threshold; rounds prob_pii."""

    nameCol = Param(Params._dummy(), "nameCol", "column of the raw name", C.toString)
    threshold = Param(Params._dummy(), "threshold", "entity score below which a rule may decide", C.toFloat)

    @keyword_only
    def __init__(self, *, nameCol="name", threshold=V.ENTITY_THRESHOLD):
        super().__init__()
        self._setDefault(nameCol="name", threshold=float(V.ENTITY_THRESHOLD))
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        found = df.withColumn("_m", R.all_matches(F.col(self._value("nameCol"))))
        o = found.withColumn("_o", S.rule_override(F.col("entity_ml"), F.col("prob_entity"), F.col("_m"), self._value("threshold")))
        on = lambda c: F.when(F.col("pii"), F.col(c))
        return (o.withColumn("entity", on("_o.entity_final")).withColumn("override_aplicado", F.coalesce(on("_o.override_aplicado"), F.lit(False)))
                .withColumn("regex_match", F.col("_o.regex_match")).withColumn("prob_pii", F.bround("prob_pii", 4)).drop("_m", "_o", "entity_ml"))


def scoring_bundle(binary, entity, threshold: float, entity_threshold: float = V.ENTITY_THRESHOLD, name: str = "name") -> PipelineModel:
    """One pipeline of a fitted models.BinaryModel and models.EntityModel.

    Input: any columns with the name among them. Output: these, then name_norm, prob_pii, pii, prob_entity, entity, override_aplicado and
    regex_match. A null or empty name is scored as the empty name. Columns of the caller must not have the names in WORKING.
    """
    line = [binary.calibrator.slope, binary.calibrator.intercept] if binary.calibrator is not None else []
    score = "probability" if binary.classifier.hasParam("probabilityCol") else "rawPrediction"
    return PipelineModel(stages=[
        NameTerms(nameCol=name), *binary.features.stages, binary.classifier, CalibratedGate(scoreCol=score, threshold=float(threshold), sigmoid=line),
        *entity.features.stages, entity.classifier, EntityNames(classes=list(entity.classes)), RuleOverride(nameCol=name, threshold=float(entity_threshold))])
