"""Deterministic training-only augmentation.

The enumeration of variants is fixed, so the same input always gives the same
rows; ranks pick the first variants per entity up to the class deficit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tablescout.functions import rules as R, text as T, vocabulary as V
from tablescout.operators.catalog import deficit_table
from tablescout.operators.grouping import attach, best_row, top_k
from tablescout.operators.splits import bucket



def _variant(kind: str, order: Column | int, value: Column) -> Column:
    order = F.lit(order) if isinstance(order, int) else order
    return F.struct(order.cast("int").alias("ord"), F.lit(kind).alias("op"), value.alias("name"))


def parent_variants(parent: Column) -> Column:
    """Array of (ord, op, name): separators and casing, synonyms, qualifiers, suffixes."""
    out, i = [], 0
    for sep in V.VARIANT_SEPARATORS:
        joined = F.replace(parent, F.lit(" "), F.lit(sep))
        for styled in (joined, F.upper(joined)) + ((F.initcap(parent),) if sep == " " else ()):
            out.append(_variant("separador", i, styled))
            i += 1
    out = F.array(*out)
    toks = F.split(parent, " ")
    known = list(V.SYNONYMS)
    table = F.create_map(*[x for k, v in V.SYNONYMS.items()
                           for x in (F.lit(k), F.array(*[F.lit(s) for s in v]))])
    spot = F.array_position(F.transform(toks, lambda t: t.isin(known)), True).cast("int")
    word = F.get(toks, spot - 1)
    swapped = F.when(spot > 0, F.transform(
        F.element_at(table, word),
        lambda alt, j: _variant("abreviatura", j + 20, F.array_join(
            F.concat(F.slice(toks, F.lit(1), spot - 1), F.array(alt),
                     F.slice(toks, spot + 1, F.greatest(F.size(toks) - spot, F.lit(0)))), " "))))
    tail = []
    for n, word in enumerate(V.VARIANT_QUALIFIERS):
        tail.append(_variant("calificador", 30 + 2 * n, F.concat(F.lit(word + " "), parent)))
        tail.append(_variant("calificador", 31 + 2 * n, F.concat(parent, F.lit(" " + word))))
    for n, s in enumerate(V.VARIANT_SUFFIXES):
        tail.append(_variant("sufijo", 40 + n, F.concat(parent, F.lit(" " + s))))
    return F.concat(out, F.coalesce(swapped, F.slice(out, 1, 0)), F.array(*tail))


def synthetic_variants(rows: DataFrame, cap: int = V.VARIANT_CAP) -> DataFrame:
    """(name, entity, is_synthetic, parent_norm): new forms up to the entity deficit.

    A form must be new against every real normal form and is kept once over all
    entities. Parents take turns: first variant of each, then second, and so on.
    """
    pos = rows.filter("entity IS NOT NULL AND entity <> '' AND name_norm <> ''")
    need = deficit_table(pos, cap).filter("need_30 > 0").select("entity", "need_30")
    parents = (pos.select("entity", F.col("name_norm").alias("parent_norm")).distinct()
               .join(need.select("entity"), "entity", "left_semi"))
    made = (parents.withColumn("v", F.explode(parent_variants(F.col("parent_norm"))))
            .select("entity", "parent_norm", "v.ord", "v.op", "v.name")
            .withColumn("norm", T.normalize_name("name")).filter("norm <> ''"))
    fresh = made.join(pos.select(F.col("name_norm").alias("norm")).distinct(), "norm", "left_anti")
    once = best_row(fresh, ["norm"], ["ord", "parent_norm", "entity", "name"],
                    ["entity", "parent_norm", "ord", "name"])
    # every entity needs at most `cap` rows
    ranked = top_k(once, ["entity"], [F.asc("ord"), F.asc("parent_norm"), F.asc("name")], cap)
    return (ranked.join(need, "entity").filter("rn <= need_30")
            .select("name", "entity", F.lit(1).alias("is_synthetic"), "parent_norm"))


def children_of_parents(parents: DataFrame, wanted: DataFrame) -> DataFrame:
    """Round-robin: child k of an entity belongs to parent k mod (number of parents).

    `wanted` is (entity, need). Parents ranked beyond the largest need get no
    child, so they are counted but not ranked.
    """
    distinct = parents.select("entity", "parent_norm").distinct()
    most = wanted.agg(F.max("need")).first()[0] or 1
    first = top_k(distinct, ["entity"], [F.asc("parent_norm")], int(most))
    n = distinct.groupBy("entity").agg(F.count("*").alias("n"))
    slots = (wanted.filter("need > 0").join(n, "entity")
             .withColumn("k", F.explode(F.sequence(F.lit(0), F.col("need").cast("int") - 1)))
             .withColumn("rn", (F.pmod("k", "n") + 1).cast("int")))
    return slots.join(first, ["entity", "rn"]).select("entity", "k", "parent_norm")


def lexicon_rows(spark, lexicon=V.LEXICON) -> DataFrame:
    """The lexicon as (entity, e_ord, term, t_ord); a fixed list."""
    rows = [(e, i, t, j) for i, (e, ts) in enumerate(lexicon.items()) for j, t in enumerate(ts)]
    return spark.createDataFrame(rows, "entity string, e_ord int, term string, t_ord int")


def lexicon_variants(term: Column) -> Column:
    """Bare, glued, underscored, numbered and suffixed forms of a term, in order."""
    t = F.replace(term, F.lit("_"), F.lit(" "))
    digit = (bucket(term, 9) + 1).cast("string")
    forms = [t, F.replace(t, F.lit(" "), F.lit("")), F.replace(t, F.lit(" "), F.lit("_")),
             F.concat(t, F.lit(" "), digit), F.concat(t, digit)]
    forms += [F.concat(t, F.lit(s)) for s in V.LEXICON_SUFFIXES]
    return F.array(*[F.struct(F.lit(i).alias("v_ord"), f.alias("name")) for i, f in enumerate(forms)])


def lexicon_synthesis(base: DataFrame, lexicon: DataFrame | None = None, target: int = V.LEXICON_TARGET,
                      share: float = V.LEXICON_SHARE) -> DataFrame:
    """New lexicon forms per entity up to `target`, at most `share` of the base in total."""
    lexicon = lexicon if lexicon is not None else lexicon_rows(base.sparkSession)
    have = base.groupBy(F.lower(F.trim("entity")).alias("entity")).agg(F.count("*").alias("have"))
    made = (lexicon.withColumn("v", F.explode(lexicon_variants(F.col("term"))))
            .select("entity", "e_ord", "t_ord", "v.v_ord", F.trim("v.name").alias("name"))
            .withColumn("light", T.normalize_light("name")).filter("light <> ''"))
    for entity, anti in V.LEXICON_ANTI.items():
        made = made.filter(~((F.col("entity") == entity) & T.contains_any(F.col("light"), anti)))
    once = best_row(made, ["light"], ["e_ord", "t_ord", "v_ord", "name", "entity"],
                    ["entity", "e_ord", "t_ord", "v_ord", "name"])
    # the candidates come from the fixed lexicon, so the base is searched for them
    known = (base.select(T.normalize_light("name").alias("light"))
             .join(F.broadcast(once.select("light")), "light", "left_semi").distinct())
    fresh = once.join(known, "light", "left_anti").join(have, "entity", "left")
    picked = (top_k(fresh, ["entity"], [F.asc("t_ord"), F.asc("v_ord")], target)
              .filter(F.col("rn") <= F.greatest(F.lit(target) - F.coalesce("have", F.lit(0)), F.lit(0))))
    total = base.agg(F.floor(F.count("*") * F.lit(share)).alias("cap"))
    # at most lexicon size rows: a single ordered window is bounded
    capped = attach(picked.withColumn("n", F.row_number().over(W.orderBy("e_ord", "t_ord", "v_ord"))), total)
    return capped.filter("n <= cap").select("name", "entity", F.lit("sintetico").alias("label_source"),
                                            F.lit(V.LEXICON_WEIGHT).alias("w"))


def upsample_rare(rows: DataFrame, text: str, label: str, weight: str,
                  target: int = V.RARE_CLASS_TARGET) -> DataFrame:
    """Writing variants of rare-class rows until the class has `target` rows.

    Classes below the target have fewer than `target` rows, so their ranks are
    bounded. Child i copies row (i mod n) and varies spaces, underscores and a
    trailing number, inheriting its weight.
    """
    small = rows.groupBy(label).agg(F.count("*").alias("n")).filter(F.col("n") < target)
    pool = top_k(rows.select(label, text, weight).join(small, label), [label],
                 [F.asc(text), F.asc(weight)], target)
    slots = (small.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(target) - F.col("n") - 1)))
             .withColumn("rn", (F.pmod("i", "n") + 1).cast("int")).select(label, "i", "rn"))
    j = slots.join(pool, [label, "rn"])
    digit = (F.pmod("i", F.lit(8)) + 1).cast("string")
    form = F.pmod("i", F.lit(5))
    varied = (F.when(form == 0, F.regexp_replace(text, r"[\s\-_]", ""))
              .when(form == 1, F.concat(F.col(text), F.lit(" "), digit))
              .when(form == 2, F.concat(F.col(text), digit))
              .when(form == 3, F.regexp_replace(text, r"\s+", "_")).otherwise(F.col(text)))
    extra = j.select(label, varied.alias(text), weight, F.lit(1).alias("is_synthetic"), F.col(text).alias("parent"))
    return rows.select(label, text, weight, F.lit(0).alias("is_synthetic"),
                       F.lit(None).cast("string").alias("parent")).unionByName(extra)
