"""Rule engines as staged projections.

Each stage adds columns the next one reads, so a normal form or a keyword test
is computed once per row although many rules look at it. All stages are
row-local: they run next to the scan, in batch and in streams alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablescout.functions import rules as R, scores as S, text as T, vocabulary as V


def with_dotted_keys(df: DataFrame, name: str = "name") -> DataFrame:
    """Adds full_key and last_token of a dotted name."""
    d = df.withColumn("_clean", T.clean_dotted(name)).withColumn("_parts", T.dotted_parts(F.col("_clean")))
    some = F.size("_parts") > 0
    return (d.withColumn("full_key", F.when(some, F.array_join("_parts", " ")).otherwise(F.col("_clean")))
            .withColumn("last_token", F.when(some, F.element_at("_parts", -1)).otherwise(F.col("_clean")))
            .drop("_clean", "_parts"))


def with_rule_levels(df: DataFrame, normalize_rare: bool = False, classes=V.ENTITY_CLASSES) -> DataFrame:
    """Adds excluded, exact, rare, rescue and fallback from full_key and last_token.

    The rare patterns that hold an underscore can never match a key whose
    underscores became spaces; `normalize_rare` gives them a chance.
    """
    full, last = F.col("full_key"), F.col("last_token")
    d = df.withColumn("_fk", T.fix_typo(full)).withColumn("_lk", T.fix_typo(last))
    d = (d.withColumn("_rare_key", R.padded(F.col("_fk"), F.col("_lk")))
         .withColumn("_wide_key", R.padded(R.spaced(full), R.spaced(last)))
         .withColumn("_full_key", R.padded(R.spaced(full))))
    return (d.withColumn("excluded", R.is_system_field(full, last))
            .withColumn("exact", R.is_exact_key(F.col("_fk"), F.col("_lk")))
            .withColumn("rare", R.keyword_match(F.col("_rare_key"), V.RARE_RULES, normalize_rare))
            .withColumn("rescue", R.keyword_match(F.col("_wide_key"), V.RESCUE_RULES, True))
            .withColumn("fallback", R.keyword_match(F.col("_full_key"), V.FALLBACK_PAGE, False, classes))
            .drop("_fk", "_lk", "_rare_key", "_wide_key", "_full_key"))


def five_level_decision(df: DataFrame, prob: str = "prob", threshold: float = V.MODEL_THRESHOLD,
                        floor: float = V.RESCUE_FLOOR) -> DataFrame:
    """Adds pii, prob_pii, reason and prior_entity.

    Exclusion beats everything, then the model, exact keys, rare keys, and the
    rescue keywords inside the band between floor and threshold.
    """
    p, full = F.col(prob), F.col("full_key")
    by_model = p >= threshold
    reason = (F.when((full != "") & F.col("excluded"), F.lit("exclusion_sistema"))
              .when(by_model, F.lit("modelo")).when(full == "", F.lit(""))
              .when(F.col("exact"), F.lit("exacto")).when(F.col("rare").isNotNull(), F.lit("raro"))
              .when((p >= floor) & F.col("rescue").isNotNull(), F.lit("fuzzy")).otherwise(F.lit("")))
    r = F.col("reason")
    raised = F.when(r == "exclusion_sistema", F.lit(0.0))
    for level, value in V.RULE_PROBABILITY.items():
        raised = raised.when(r == level, F.greatest(p, F.lit(value)))
    prior = (F.when(r == "exacto", F.coalesce("rescue", "fallback"))
             .when(r == "raro", F.col("rare")).when(r == "fuzzy", F.col("rescue")))
    return (df.withColumn("reason", reason).withColumn("pii", ~r.isin("", "exclusion_sistema"))
            .withColumn("prob_pii", F.bround(raised.otherwise(p), 4)).withColumn("prior_entity", prior))


def resolve_entity(df: DataFrame, entity: str, prob: str, classes=V.ENTITY_CLASSES) -> DataFrame:
    """Adds entity_final and prob_entity_final: rule prior, weak-model fallback, classifier.

    Both are null where the row is not personal data.
    """
    p = F.col(prob)
    low = F.bround(p, 4) < V.ENTITY_THRESHOLD
    usable = F.coalesce(F.col("prior_entity").isin(classes), F.lit(False))
    d = (df.withColumn("_by_prior", usable & (F.col("reason").isin("exacto", "raro") | low))
         .withColumn("_fb", F.coalesce("rescue", "fallback")))
    use_fb = low & F.col("_fb").isNotNull()
    lifted = lambda floor: F.bround(F.greatest(p, F.lit(floor)), 4)
    no = ~F.col("pii")
    return (d.withColumn("entity_final", F.when(no, F.lit(None)).when(F.col("_by_prior"), F.col("prior_entity"))
                         .when(use_fb, F.col("_fb")).otherwise(F.col(entity)))
            .withColumn("prob_entity_final", F.when(no, F.lit(None)).when(F.col("_by_prior"), lifted(V.PRIOR_ENTITY_PROBABILITY))
                        .when(use_fb, lifted(V.FALLBACK_ENTITY_PROBABILITY)).otherwise(F.bround(p, 4)))
            .drop("_by_prior", "_fb"))


def with_matches(df: DataFrame, name: str = "name", out: str = "matches") -> DataFrame:
    return df.withColumn(out, R.all_matches(F.col(name)))


def override_by_rule(df: DataFrame, entity: str, prob: str, name: str = "name",
                     threshold: float = V.ENTITY_THRESHOLD) -> DataFrame:
    """Adds entity_final, override_aplicado and regex_match."""
    d = with_matches(df, name, "_m").withColumn("_o", S.rule_override(F.col(entity), F.col(prob), F.col("_m"), threshold))
    return d.select(*df.columns, "_o.*")


def keyword_correction(df: DataFrame, key: str, entity: str, prob: str, out: str, rules=V.FALLBACK_JUDGE,
                       threshold: float = V.ENTITY_THRESHOLD, classes: list[str] | None = None) -> DataFrame:
    """Keyword entity in place of a low-confidence prediction.

    With `classes`, only known classes count and a rule that merely repeats the
    prediction is passed over for the next one.
    """
    d = df.withColumn("_k", R.spaced(R.padded(F.coalesce(key, F.lit("")))))
    d = d.withColumn("_f", R.keyword_match(F.col("_k"), rules, False, classes,
                                           F.col(entity) if classes is not None else None))
    use = (F.col(prob) < threshold) & F.col("_f").isNotNull()
    return d.withColumn(out, F.when(use, F.col("_f")).otherwise(F.col(entity))).drop("_k", "_f")


def labelled_by_rules(df: DataFrame, name: str = "name") -> DataFrame:
    """Adds entity and motivo of the labelling rules."""
    d = df.withColumn("_flat", R.padded(R.spaced(T.normalize_light(name))))
    entity, motive = R.label_by_rules(F.col("_flat"))
    return d.withColumn("entity", entity).withColumn("motivo", motive).drop("_flat")


def canonicalised(df: DataFrame, raw: str = "entity", exemplar: str = "exemplar") -> DataFrame:
    """Adds entity_canon and metodo to discovered clusters."""
    d = df.withColumn("_r", F.lower(F.trim(F.coalesce(raw, F.lit(""))))).withColumn("_b", T.strip_trailing_number(F.col("_r")))
    d = d.withColumn("_w", F.when(F.col("_b") == "", F.col("_r")).otherwise(F.col("_b")))
    d = d.withColumn("_blob", F.concat_ws(" ", "_w", F.lower(F.coalesce(exemplar, F.lit("")))))
    d = d.withColumn("_kw", R.keyword_match(F.col("_blob"), V.CANONICAL_KEYWORDS))
    canon, method = R.canonical_entity(F.col("_w"), F.col("_blob"), F.col("_kw"))
    return d.withColumn("entity_canon", canon).withColumn("metodo", method).drop("_r", "_b", "_w", "_blob", "_kw")


def focus_tagged(df: DataFrame, norm: str = "name_norm") -> DataFrame:
    return df.withColumn("foco", R.focus_tags(F.col(norm)))
