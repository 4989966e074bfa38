"""Label transfer, source consolidation, routing and prediction history."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tablescout.functions import rules as R, scores as S, text as T, vocabulary as V
from tablescout.operators.grouping import best_row, top_k
from tablescout.operators.textsim import nearest_neighbours
from tablescout.session import Rounds



def neighbour_table(pool_keys: DataFrame, gold_keys: DataFrame, floor: float = 0.5,
                    complete: bool = True) -> DataFrame:
    """Per pool key: nearest gold key, its name and label, similarity.

    Both inputs are key roll-ups (see catalog.key_rollup). Keys that share no
    gram with the catalogue keep null neighbour columns and similarity 0; so do
    keys below the floor if `complete` is unset.
    """
    pool_keys = Rounds(pool_keys.sparkSession, "keys").put("pool", pool_keys)  # read twice
    nn = nearest_neighbours(pool_keys, gold_keys, "key", floor, complete)
    gold = gold_keys.select(F.col("key").alias("c"), F.col("name").alias("vecino"),
                            F.col("pii_majority").alias("vecino_pii"))
    return (pool_keys.join(nn.join(gold, "c").withColumnRenamed("q", "key"), "key", "left")
            .withColumn("similarity", F.coalesce("similarity", F.lit(0.0))))


def transferred(neighbours: DataFrame) -> DataFrame:
    """Label rule on top of the neighbour table, one row per key."""
    rule = S.transferred_label(F.col("similarity"), F.col("vecino_pii"), F.col("pii_majority"))
    return (neighbours.withColumn("_r", rule)
            .select("key", "vecino", "vecino_pii", "similarity",
                    "_r.pii_final", "_r.label_source", "_r.sample_weight"))


def propagate(rows: DataFrame, per_key: DataFrame, key: str = "key") -> DataFrame:
    """Bring per-key results back to every row; empty names get their own class.

    Rows with an empty or null key take no part in the join, where they would all meet in one task.
    """
    named = rows.filter(F.col(key) != "").withColumn("has_name", F.lit(True)).join(per_key, key, "left")
    named = (named.withColumn("similarity", F.col("similarity").cast("double")).withColumn("sample_weight", F.col("sample_weight").cast("double")))
    fixed = {"has_name": F.col(key) != "", "vecino_pii": F.lit(False), "similarity": F.lit(0.0), "label_source": F.lit("nombre_vacio"), "sample_weight": F.lit(0.0)}
    rest = rows.filter(F.coalesce(F.col(key) == "", F.lit(True)))
    rest = rest.select(*[fixed[c].alias(c) if c in fixed else F.col(c) if c in rows.columns else F.lit(None).cast(t).alias(c) for c, t in named.dtypes])
    return named.unionByName(rest)


def propagate_raw(rows: DataFrame, per_name: DataFrame) -> DataFrame:
    """Older form: join on the raw name, null where the name is unknown."""
    return rows.join(per_name, "name", "left")


def training_features(rows: DataFrame) -> DataFrame:
    """Description flag and raw length. Taken before the labels are joined, so that no description has to be shuffled for its flag."""
    return rows.withColumn("has_description", T.has_description("description")).withColumn("longitud", F.length(T.text("name")))


def enrich_training(rows: DataFrame) -> DataFrame:
    """Training table: description flag, raw length, named rows only."""
    rows = rows.filter("has_name")
    return rows if {"has_description", "longitud"} <= set(rows.columns) else training_features(rows)


def not_yet_labelled(pool: DataFrame, gold: DataFrame) -> DataFrame:
    """Pool rows whose trimmed name and whose normal form are both new."""
    names = gold.select(F.trim("name").alias("name")).distinct()
    lights = gold.select(T.normalize_light("name").alias("_light")).distinct()
    fresh = pool.withColumn("name", F.trim("name")).join(names, "name", "left_anti")
    return (fresh.withColumn("_light", T.normalize_light("name"))
            .join(lights, "_light", "left_anti").drop("_light"))


def labelled_source(rows: DataFrame, source: str, weight: float | None = None) -> DataFrame:
    """(name, entity, label_source, w) with trimmed names and lower-case entities."""
    w = V.SOURCE_WEIGHT[source] if weight is None else weight
    return (rows.select(F.trim("name").alias("name"), F.lower(F.trim("entity")).alias("entity"),
                        F.lit(source).alias("label_source"), F.lit(float(w)).alias("w"))
            .filter("entity IS NOT NULL AND entity <> '' AND name IS NOT NULL AND name <> ''"))


def union_sources(sources: dict[str, DataFrame | None]) -> DataFrame:
    """Union of the sources that exist, each with its own weight."""
    present = [labelled_source(df, s) for s, df in sources.items()
               if df is not None and {"name", "entity"} <= set(df.columns)]
    if not present:
        raise ValueError("no labelled source available")
    return reduce(lambda a, b: a.unionByName(b), present)


def consolidate(rows: DataFrame) -> DataFrame:
    """One row per name: the most authoritative source, then the smallest entity."""
    order = F.lit(V.UNKNOWN_PRIORITY)
    for source, p in V.SOURCE_PRIORITY.items():
        order = F.when(F.col("label_source") == source, F.lit(p)).otherwise(order)
    return best_row(rows.withColumn("_p", order), ["name"], ["_p", "entity", "w", "label_source"],
                    ["entity", "label_source", "w"])


def positives_win(rows: DataFrame) -> DataFrame:
    """One row per name by (pii desc, w desc), ties to the smallest entity."""
    return best_row(rows.withColumn("_a", -F.col("pii")).withColumn("_b", -F.col("w")),
                    ["name"], ["_a", "_b", "entity", "label_source"],
                    ["pii", "w", "entity", "label_source"])


def binary_rows(consolidated: DataFrame, gold: DataFrame, dialect: str = "catalog") -> DataFrame:
    """Positives from the consolidated labels, negatives from the validated table."""
    pos = consolidated.select("name", "entity", F.lit(1).alias("pii"), "w", "label_source")
    neg = (gold.filter(~T.truthy(F.col("pii"), dialect))
           .select(F.trim("name").alias("name"), F.lit("NO_PII").alias("entity"), F.lit(0).alias("pii"),
                   F.lit(1.0).alias("w"), F.lit("gold_validado").alias("label_source")).distinct())
    kept = positives_win(pos.unionByName(neg).filter("name <> ''"))
    light = T.normalize_light("name")
    return (kept.withColumn("light", light).filter("light <> ''")
            .withColumn("name_norm", T.strip_trailing_number(F.col("light")))
            .withColumn("group_id", F.regexp_replace("name_norm", r"[\s\-_]", ""))
            .withColumn("longitud", F.length("name"))
            .withColumn("n_tokens", T.token_count(F.col("name_norm")))
            .withColumn("tiene_sufijo", T.has_trailing_number(F.col("light")))
            .withColumn("key", F.col("light")))


def map_with_default(rows: DataFrame, mapping: DataFrame, key: str, value: str, default) -> DataFrame:
    """Left lookup with a default for misses; the mapping is keyed uniquely."""
    return rows.join(mapping.select(key, value), key, "left").withColumn(
        value, F.coalesce(value, F.lit(default)))


def canonical_lookup(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """(entity, cluster) -> canonical entity with null-safe keys, null on a miss."""
    m = mapping.select(F.col("entity").alias("_e"), F.col("cluster").alias("_c"), "entity_canon")
    cond = rows["entity"].eqNullSafe(F.col("_e")) & rows["cluster"].eqNullSafe(F.col("_c"))
    return rows.join(m, cond, "left").drop("_e", "_c")


def label_pair_join(manual: DataFrame, canon: DataFrame) -> DataFrame:
    """Manual rows with the canonical label of their name (one per name)."""
    one = best_row(canon, ["name"], ["entity_canon"], ["entity_canon"])
    return manual.join(one, "name", "left")


def route_imports(neighbours: DataFrame, gold_entities: DataFrame,
                  classifier: DataFrame | None = None) -> DataFrame:
    """Accepted imports, review queue and exclusions in one table with a `route`.

    Strong matches whose neighbour is positive inherit its entity; they need an
    entity on the neighbour and, where a classifier opinion exists, agreement.
    """
    ents = best_row(gold_entities.filter("entity IS NOT NULL AND entity <> ''"),
                    ["name"], ["entity"], ["entity"]).select(
        F.col("name").alias("vecino"), F.col("entity").alias("entity_vecino"))
    known = gold_entities.select(F.trim("name").alias("name")).distinct().withColumn("_known", F.lit(True))
    # names without a neighbour would all meet in the null key
    near = neighbours.filter("vecino IS NOT NULL").join(ents, "vecino", "left")
    j = near.unionByName(neighbours.filter("vecino IS NULL").withColumn("entity_vecino", F.lit(None).cast("string"))).join(known, "name", "left")
    if classifier is not None:
        j = j.join(classifier.select("name", "entity_juez", "prob_juez"), "name", "left")
    else:
        j = j.withColumn("entity_juez", F.lit(None).cast("string")).withColumn(
            "prob_juez", F.lit(None).cast("double"))
    act = S.import_decision(F.col("similarity"), F.coalesce("vecino_pii", F.lit(False)))
    agree = F.col("entity_juez").isNull() | (F.col("entity_juez") == F.col("entity_vecino"))
    route = (F.when((act == "importar") & F.coalesce("_known", F.lit(False)), F.lit("conocido"))
             .when((act == "importar") & F.col("entity_vecino").isNull(), F.lit("revision"))
             .when((act == "importar") & ~agree, F.lit("revision")).otherwise(act))
    motive = (F.when(route != "revision", F.lit(""))
              .when(act == "revision", F.lit("similarity 50-90: revision manual"))
              .when(F.col("entity_vecino").isNull(), F.lit("vecino sin entity en gold"))
              .otherwise(F.lit("desacuerdo juez/vecino")))
    return j.select("name", "vecino", F.round("similarity", 2).alias("similarity"), "entity_vecino",
                    "entity_juez", "prob_juez", route.alias("route"), motive.alias("motivo"))


def with_previous(scored: DataFrame, previous: DataFrame) -> DataFrame:
    """Earlier verdicts by (table, key) with agreement true, false or unknown."""
    j = scored.join(previous, ["tabla", "key"], "left")
    return j.withColumn("acuerdo", F.when(F.col("pii_previo").isNotNull(),
                                          F.col("pii") == F.col("pii_previo")))


def agreement_rate(compared: DataFrame) -> DataFrame:
    return compared.agg(F.count(F.lit(1)).alias("n"), F.count("acuerdo").alias("n_comparable"),
                        F.round(F.avg(F.col("acuerdo").cast("double")), 6).alias("rate"))


def disagreements(compared: DataFrame, limit: int = 30) -> DataFrame:
    return compared.filter("NOT acuerdo").orderBy(F.desc("prob_pii"), "tabla", "name").limit(limit)


def keyword_candidates(names: DataFrame, keywords=V.RESCUE_ROUND_KEYWORDS, anti=V.RESCUE_ROUND_ANTI,
                       top: int = V.RESCUE_ROUND_TOP) -> DataFrame:
    """Per entity the best names whose normal form holds one of its keywords.

    One scan tests all entities; a name may be a candidate of several.
    """
    flat = R.padded(F.replace(T.normalize_light("name"), F.lit("_"), F.lit(" ")))
    base = names.withColumn("_flat", flat)
    cells = []
    for entity, words in keywords.items():
        hits = F.array_compact(F.array(*[F.when(F.col("_flat").contains(w), F.lit(w)) for w in words]))
        ok = (F.size(hits) > 0) & ~T.contains_any(F.col("_flat"), anti.get(entity, []))
        cells.append(F.when(ok, F.struct(F.lit(entity).alias("entity_sugerida"),
                                         F.array_join(hits, ",").alias("motivo"))))
    long = (base.select("*", F.explode(F.array_compact(F.array(*cells))).alias("_c"))
            .select(*names.columns, "_c.entity_sugerida", "_c.motivo")
            .withColumn("_score", F.col("n_filas") * 10 + F.length("motivo")))
    return top_k(long, ["entity_sugerida"], [F.desc("_score"), F.asc("name")], top).drop("_score", "rn")


def labelling_round(candidates: DataFrame, low_confidence: DataFrame) -> DataFrame:
    """Keyword candidates plus low-confidence names, one row per name.

    A name keeps its first entity in keyword-list order; low-confidence names
    come last.
    """
    order = list(V.RESCUE_ROUND_KEYWORDS) + [V.OTHER_PII]
    rank = F.array_position(F.array(*[F.lit(e) for e in order]), F.col("entity_sugerida"))
    low = low_confidence.select(
        "name", "n_filas", F.lit("").alias("datasets"), F.lit("").alias("tipos"),
        F.lit("").alias("desc_ejemplo"), F.lit(V.OTHER_PII).alias("entity_sugerida"),
        F.concat(F.lit("prob_entity<0.5 pred="), "pred_top").alias("motivo"))
    cols = ["entity_sugerida", "n_filas", "datasets", "tipos", "desc_ejemplo", "motivo"]
    both = candidates.select("name", *cols).unionByName(low.select("name", *cols))
    return best_row(both.withColumn("_k", rank), ["name"], ["_k"] + cols, cols)


def discrepancy(scored: DataFrame, predicted: str, label: str) -> DataFrame:
    return scored.withColumn("discrepancia", (F.col(predicted) != F.col(label)).cast("int"))


def expected_failures(result: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected (name, entity) pairs the result does not reproduce."""
    got = result.select(F.coalesce("name", F.lit("")).alias("name"),
                        F.coalesce("entity", F.lit("")).alias("expected_entity"))
    return expected.join(got, ["name", "expected_entity"], "left_anti")


def regression_report(result: DataFrame, expected: DataFrame, forbidden: DataFrame) -> DataFrame:
    """One row per listed name: what was expected, what the result says, and which kind of failure it is.

    `result`: name, pii, entity, any number of rows a name; `expected`: name, expected_entity; `forbidden`: names that must stay
    unflagged. kind is `ok`, `no_marcado` (expected, but no row of the name is flagged or there is none), `entidad` (flagged, but no
    flagged row has the entity) or `falso_positivo` (forbidden, but flagged). A null name counts as the empty one. Result rows of other
    names end at the join with the lists before anything is grouped, so a name that fills the result costs one combined group.
    """
    key = F.coalesce(F.col("name"), F.lit("")).alias("name")
    listed = (expected.select(key, F.coalesce("expected_entity", F.lit("")).alias("expected_entity"))
              .unionByName(forbidden.select(key, F.lit(None).cast("string").alias("expected_entity"))).distinct())
    seen = (result.select(key, F.coalesce("pii", F.lit(False)).alias("pii"), F.coalesce("entity", F.lit("")).alias("entity"))
            .groupBy("name", "entity").agg(F.max("pii").alias("pii"))
            .join(listed.select("name").distinct(), "name", "left_semi"))
    got = seen.groupBy("name").agg(F.max("pii").alias("got_pii"), F.array_sort(F.collect_set(F.when(F.col("pii"), F.col("entity")))).alias("got"))
    both = listed.join(got, "name", "left").withColumn("got_pii", F.coalesce("got_pii", F.lit(False)))
    kind = (F.when(F.col("expected_entity").isNull(), F.when(F.col("got_pii"), "falso_positivo").otherwise("ok"))
            .when(~F.col("got_pii"), "no_marcado").when(~F.array_contains("got", F.col("expected_entity")), "entidad").otherwise("ok"))
    return both.select("name", "expected_entity", "got_pii", F.coalesce(F.array_join("got", ","), F.lit("")).alias("got_entity"), kind.alias("kind"))


def regression_passes(report: DataFrame) -> DataFrame:
    """One row: names checked, failures of each kind, and whether there is none."""
    n = lambda k: F.count(F.when(F.col("kind") == k, 1)).alias(k)
    return report.agg(F.count("*").alias("n"), *[n(k) for k in ("no_marcado", "entidad", "falso_positivo")],
                      (F.count(F.when(F.col("kind") != "ok", 1)) == 0).alias("pass"))


def taxonomy(names: DataFrame, expanded: str = "exp", cutoff: float = 80.0) -> DataFrame:
    """(name, entity, prob_entity, metodo): ordered patterns on the expanded name,
    else the example with the best token overlap at or above the cut-off.

    The examples are a fixed list of six, compared inside the row.
    """
    e = F.col(expanded)
    by_rule = R.first_match(e, V.TAXONOMY, ignore_case=False, default=None)
    toks = F.array_distinct(F.split(e, " "))

    def overlap(example: str) -> Column:
        d = F.array(*[F.lit(t) for t in example.split()])
        return 100.0 * F.size(F.array_intersect(toks, d)) / F.size(F.array_union(toks, d))

    best = F.greatest(*[F.struct(overlap(x).alias("s"), F.lit(-i).alias("o"), F.lit(ent).alias("e"))
                        for i, (ent, x) in enumerate(V.TAXONOMY_EXAMPLES)])
    d = names.withColumn("_rule", by_rule).withColumn("_near", best)
    by_rule, best, empty = F.col("_rule"), F.col("_near"), e == ""
    near, found = best["s"] >= cutoff, by_rule.isNotNull()
    return d.select(
        "name",
        F.when(empty, F.lit(V.TAXONOMY_UNKNOWN)).when(found, by_rule).when(near, best["e"])
         .otherwise(F.lit(V.TAXONOMY_UNKNOWN)).alias("entity"),
        F.when(empty, F.lit(0.0)).when(found, F.lit(1.0)).when(near, F.bround(best["s"] / 100, 2))
         .otherwise(F.lit(0.0)).alias("prob_entity"),
        F.when(empty, F.lit("vacio")).when(found, F.lit("regex")).when(near, F.lit("fuzzy"))
         .otherwise(F.lit("fallback")).alias("metodo"))
