"""Scalar decisions on similarities and probabilities."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tablescout.functions import rules as R, vocabulary as V


def similarity_bucket(sim: Column) -> Column:
    return (F.when(sim >= V.STRONG_SIMILARITY, F.lit(V.BUCKET_STRONG))
            .when(sim >= V.PARTIAL_SIMILARITY, F.lit(V.BUCKET_PARTIAL))
            .otherwise(F.lit(V.BUCKET_NONE)))


def transferred_label(sim: Column, neighbour_pii: Column, own_pii: Column) -> Column:
    """struct(pii_final, label_source, sample_weight) of the label-transfer rule."""
    strong, partial = sim >= V.STRONG_SIMILARITY, sim >= V.PARTIAL_SIMILARITY
    return F.struct(
        F.when(partial, neighbour_pii).otherwise(own_pii).alias("pii_final"),
        F.when(strong, F.lit("validado_21k")).when(partial, F.lit("evidencia_parcial"))
         .otherwise(F.lit("sin_evidencia_mantenido")).alias("label_source"),
        F.when(strong, F.lit(1.0)).when(partial, F.bround(sim / 100, 4))
         .otherwise(F.lit(V.NO_EVIDENCE_WEIGHT)).alias("sample_weight"))


def import_decision(sim: Column, neighbour_pii: Column) -> Column:
    """Closed-world routing; a strong match with a non-PII neighbour is reviewed."""
    return (F.when((sim >= V.STRONG_SIMILARITY) & neighbour_pii, F.lit("importar"))
            .when(sim >= V.PARTIAL_SIMILARITY, F.lit("revision"))
            .otherwise(F.lit("excluir")))


def reported_probability(p: Column, is_pii: Column) -> Column:
    """Probability of the shown verdict: complement where the verdict is negative."""
    return F.bround(F.when(is_pii, p).otherwise(1 - p), 4)


def verdict_probability(p: Column, is_pii: Column) -> Column:
    """Model probability, or the default that stands in when a model gives none."""
    return F.bround(F.coalesce(p, F.when(is_pii, F.lit(0.95)).otherwise(F.lit(0.05))), 4)


def review_flag(sim: Column, p: Column, threshold: float, band: float = 0.15) -> Column:
    return (sim < 60) | ((p >= threshold - band) & (p <= threshold + band))


def rule_override(entity: Column, prob_entity: Column, matches: Column,
                  threshold: float = V.ENTITY_THRESHOLD) -> Column:
    """struct(entity_final, override_aplicado, regex_match): unique rule beats a weak model."""
    flag = (F.coalesce(prob_entity, F.lit(1.0)) < threshold) & (F.size(matches) == 1)
    return F.struct(
        F.when(flag, F.element_at(matches, 1)).otherwise(entity).alias("entity_final"),
        flag.alias("override_aplicado"),
        R.match_summary(matches).alias("regex_match"))
