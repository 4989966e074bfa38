"""Distinct-name catalogues, coverage, audit and mining aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tablescout.functions import rules as R, scores as S, text as T, vocabulary as V
from tablescout.operators.evaluate import cumulative_counts
from tablescout.operators.grouping import attach, first_values, most_common
from tablescout.session import Rounds



def name_catalog(rows: DataFrame, name: str = "name", pii: str = "pii",
                 dialect: str = "catalog") -> DataFrame:
    """One row per distinct name with label counts and its normal forms.

    The normalisers run after the aggregation, once per distinct name.
    """
    g = (rows.filter(F.col(name).isNotNull())
         .groupBy(F.col(name).alias("name"))
         .agg(F.count("*").alias("n_rows"),
              F.sum(T.truthy(F.col(pii), dialect).cast("long")).alias("n_true")))
    return g.select(
        "name", "n_rows", "n_true",
        T.normalize_light("name").alias("light"), T.normalize_aggr("name").alias("aggr"),
        T.join_key("name").alias("key"),
        (F.col("n_true") > 0).alias("pii_any"),
        (F.col("n_true") * 2 >= F.col("n_rows")).alias("pii_majority"))


def key_rollup(catalog: DataFrame) -> DataFrame:
    """Catalogue per normalised key; the smallest name stands for the key."""
    g = catalog.groupBy("key").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_true").alias("n_true"),
        F.min("name").alias("name"))
    return g.withColumn("pii_majority", F.col("n_true") * 2 >= F.col("n_rows"))


def coverage_summary(matches: DataFrame) -> DataFrame:
    """Share of names and of rows per similarity bucket, with mean and median."""
    by = matches.groupBy(S.similarity_bucket(F.col("similarity")).alias("bucket")).agg(
        F.count("*").alias("n"), F.sum("n_rows").alias("rows"))
    total = by.agg(F.sum("n").alias("tn"), F.sum("rows").alias("tr"))
    mean = matches.agg(F.round(F.avg("similarity"), 1).alias("mean"))
    stats = attach(mean, exact_median(matches, "similarity").select(F.round("median", 1).alias("median")))
    return (attach(attach(by, total), stats)
            .select("bucket", "n", "rows",
                    F.round(100.0 * F.col("n") / F.col("tn"), 1).alias("pct_names"),
                    F.round(100.0 * F.col("rows") / F.col("tr"), 1).alias("pct_rows"),
                    "mean", "median"))


def exact_median(df: DataFrame, value: str) -> DataFrame:
    """Median of any number of values: counts per distinct value, then a sliced running sum."""
    c = cumulative_counts(df.filter(F.col(value).isNotNull()).withColumn("_one", F.lit(1)), value, "_one")
    from_top = lambda k: F.max(F.when(F.col("hit") >= F.col("p") - k + 1, F.col("score")))
    low, high = F.floor((F.col("p") + 1) / 2), F.ceil((F.col("p") + 1) / 2)
    return c.agg(((from_top(low) + from_top(high)) / 2).alias("median"))


def threshold_shares(matches: DataFrame, thresholds=V.COVERAGE_THRESHOLDS) -> DataFrame:
    """Percent of names at or above each similarity, in one pass."""
    wide = matches.agg(*[F.avg((F.col("similarity") >= t).cast("double")).alias(f"t{t}")
                         for t in thresholds])
    pairs = ", ".join(f"{t}, t{t}" for t in thresholds)
    return wide.selectExpr(f"stack({len(thresholds)}, {pairs}) AS (threshold, share)").select(
        "threshold", F.round(F.col("share") * 100, 4).alias("pct"))


def histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """Equal-width bins between min and max; the maximum falls in the last bin."""
    ends = df.agg(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    spot = F.floor((F.col(value) - F.col("lo")) / width).cast("int")
    return (attach(df.select(F.col(value).cast("double").alias(value)), ends)
            .withColumn("bin", F.least(F.when(width > 0, spot).otherwise(F.lit(0)), F.lit(bins - 1)))
            .groupBy("bin").agg(F.count("*").alias("n"), F.min("lo").alias("lo"), F.min("hi").alias("hi"))
            .select("bin", F.round(F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins, 6)
                    .alias("lower"), "n"))


def canonical_rollup(mapping: DataFrame) -> DataFrame:
    """Clusters, names and up to five exemplars per canonical entity."""
    base = mapping.groupBy("entity_canon").agg(
        F.countDistinct("cluster").alias("n_clusters"), F.sum("n").alias("n_names"))
    return base.join(first_values(mapping, ["entity_canon"], "exemplar", 5, "ejemplos"),
                     "entity_canon", "left")


def deficit_table(rows: DataFrame, cap: int = V.VARIANT_CAP) -> DataFrame:
    """Rows, distinct normal forms, tier and missing examples per entity."""
    g = (rows.filter(F.col("entity").isNotNull()).groupBy("entity")
         .agg(F.count("*").alias("n_total"), F.countDistinct("name_norm").alias("n_distinto_norm")))
    tier = R.tier_of(F.col("entity"))
    return g.select("entity", "n_total", "n_distinto_norm", tier.alias("tier"),
                    F.when(tier == "tier1_sin_sinteticos", F.lit(0).cast("long"))
                    .otherwise(F.greatest(F.lit(cap) - F.col("n_distinto_norm"), F.lit(0).cast("long")))
                    .alias("need_30"))


def _stacked_counts(names: DataFrame, tests: list[tuple[tuple[str, ...], Column]],
                    labels: list[str]) -> DataFrame:
    """Count every test in one aggregation, then one row per test."""
    wide = names.agg(*[F.sum(cond.cast("long")).alias(f"c{i}") for i, (_, cond) in enumerate(tests)])
    quote = lambda s: "'" + s.replace("'", "\\'") + "'"
    cells = ", ".join(", ".join(quote(x) for x in tag) + f", c{i}" for i, (tag, _) in enumerate(tests))
    return wide.selectExpr(f"stack({len(tests)}, {cells}) AS ({', '.join(labels)}, n_obs)")


def mine_families(names: DataFrame, families=V.LEXICAL_FAMILIES) -> DataFrame:
    """Substring counts per (family, variant); only the name column is read."""
    low = F.lower(T.text("name"))
    tests = [((fam, v), low.contains(v.lower())) for fam, vs in families.items() for v in vs]
    return _stacked_counts(names.select("name"), tests, ["familia", "variante"]).filter("n_obs > 0")


def mine_qualifiers(names: DataFrame, words=V.LEXICAL_QUALIFIERS) -> DataFrame:
    low = F.lower(T.text("name"))
    return _stacked_counts(names.select("name"), [((w,), low.contains(w)) for w in words],
                           ["calificador"]).filter("n_obs > 0")


def separator_profile(names: DataFrame) -> DataFrame:
    """How many names use each separator or casing style."""
    s = T.text("name")
    tests = [(("underscore",), s.contains("_")), (("guion",), s.contains("-")),
             (("espacio",), s.contains(" ")), (("punto",), s.contains(".")),
             (("sin_sep",), ~s.rlike(r"[_\- .]")), (("camel",), s.rlike("[a-z][A-Z]")),
             (("mayusculas_full",), s.rlike(r"^[A-Z0-9 _\-/\.]+$"))]
    return _stacked_counts(names.select("name"), tests, ["valor"])


def lexical_findings(names: DataFrame) -> DataFrame:
    """Families, qualifiers and separators as one (tipo, valor, n_obs) table."""
    fam = mine_families(names).select(F.col("familia").alias("tipo"), F.col("variante").alias("valor"), "n_obs")
    cal = mine_qualifiers(names).select(F.lit("calificador").alias("tipo"), F.col("calificador").alias("valor"), "n_obs")
    sep = separator_profile(names).select(F.lit("separador").alias("tipo"), "valor", "n_obs")
    return fam.unionByName(cal).unionByName(sep)


def mixed_label_families(rows: DataFrame, dialect: str = "gold") -> DataFrame:
    """Normal forms that carry both labels, with sample variants and entities."""
    base = (rows.filter(F.col("name").isNotNull())
            .groupBy("name", F.coalesce("entity", F.lit("")).alias("entity"))
            .agg(F.count("*").alias("n"), F.sum(T.truthy(F.col("pii"), dialect).cast("long")).alias("t"))
            .withColumn("name_norm", T.name_norm("name")))
    g = (base.groupBy("name_norm").agg(F.sum("t").alias("n_true"), F.sum("n").alias("n_total"))
         .withColumn("n_false", F.col("n_total") - F.col("n_true"))
         .filter("n_true > 0 AND n_false > 0"))
    mixed = base.join(g.select("name_norm"), "name_norm", "left_semi")
    variants = first_values(mixed, ["name_norm"], "name", 12, "variantes")
    entities = first_values(mixed.filter("entity <> ''"), ["name_norm"], "entity", 6, "entity_true")
    return (g.join(variants, "name_norm").join(entities, "name_norm", "left")
            .select("name_norm", "variantes", "n_true", "n_false",
                    F.coalesce("entity_true", F.lit("")).alias("entity_true"),
                    R.focus_tags(F.col("name_norm")).alias("foco"), F.lit("").alias("decision")))


def entity_support(rows: DataFrame) -> DataFrame:
    g = rows.groupBy("entity").agg(
        F.count("*").alias("n_filas"), F.countDistinct("name").alias("n_names"),
        F.countDistinct("group_id").alias("n_groups"))
    risk = (F.when(F.col("n_groups") < 5, F.lit("CRITICO(<5)"))
            .when(F.col("n_groups") <= 10, F.lit("BAJO(5-10)")).otherwise(F.lit("ok")))
    return g.withColumn("riesgo", risk)


def contingency(rows: DataFrame, left: str, right: str, missing: str = "(sin_canon)") -> DataFrame:
    return (rows.groupBy(left, F.coalesce(F.col(right), F.lit(missing)).alias(right))
            .agg(F.count("*").alias("n")))


def dominant_target(rows: DataFrame, left: str, right: str) -> DataFrame:
    """Most frequent target per entity with its share."""
    table = contingency(rows, left, right)
    g = table.groupBy(left).agg(
        F.sum("n").alias("n"),
        F.min(F.struct((-F.col("n")).alias("m"), F.col(right).alias("v"))).alias("b"))
    return g.select(left, "n", F.col("b.v").alias("canon_top"),
                    F.round(-F.col("b.m") * 100.0 / F.col("n"), 1).alias("pct_top"))


def clustering_agreement(rows: DataFrame, truth: str, found: str) -> DataFrame:
    """Homogeneity, completeness and V-measure from the contingency table."""
    t = (rows.filter(F.col(truth).isNotNull() & F.col(found).isNotNull())
         .groupBy(truth, found).agg(F.count("*").cast("double").alias("n")))
    by = lambda c: t.groupBy(c).agg(F.sum("n").alias("m"))
    total = t.agg(F.sum("n").alias("all_n"))
    entropy = lambda d, out: (attach(d, total).agg(
        F.sum(-F.col("m") / F.col("all_n") * F.log(F.col("m") / F.col("all_n"))).alias(out)))
    conditional = lambda c, out: (attach(t.join(by(c), c), total).agg(
        F.sum(-F.col("n") / F.col("all_n") * F.log(F.col("n") / F.col("m"))).alias(out)))
    parts = [entropy(by(truth), "hc"), entropy(by(found), "hk"),
             conditional(found, "hck"), conditional(truth, "hkc")]
    m = reduce(attach, parts)
    h = F.when(F.col("hc") == 0, F.lit(1.0)).otherwise(1 - F.col("hck") / F.col("hc"))
    c = F.when(F.col("hk") == 0, F.lit(1.0)).otherwise(1 - F.col("hkc") / F.col("hk"))
    return m.select(h.alias("h"), c.alias("c")).select(
        F.round("h", 6).alias("homogeneidad"), F.round("c", 6).alias("completitud"),
        F.round(F.when(F.col("h") + F.col("c") == 0, F.lit(0.0))
                .otherwise(2 * F.col("h") * F.col("c") / (F.col("h") + F.col("c"))), 6).alias("v"))


def pool_candidates(pool: DataFrame, example_chars: int = 300) -> DataFrame:
    """Per name: rows, sample datasets and types, one example description.

    The example is the smallest usable description. Descriptions are numbered in their order once, and a name takes the smallest
    number: rows carry two hashes (128 bits) of a description through the shuffle, never its text.
    """
    usable = ~F.trim(F.coalesce("description", F.lit(""))).isin("", "nan", "None")
    h = lambda text, seed: F.xxhash64(F.lit(seed), text)
    rounds = Rounds(pool.sparkSession, "descriptions")
    texts = rounds.put("texts", pool.filter(usable).select("description").distinct()).orderBy("description")
    texts = rounds.put("numbered", texts.select(h("description", 1).alias("h1"), h("description", 2).alias("h2"), F.monotonically_increasing_id().alias("number"),
                                                F.substring("description", 1, example_chars).alias("example")))
    # rows without a usable description match nothing and are dealt by name
    rows = pool.select("name", F.when(usable, h("description", 1)).otherwise(h("name", 1)).alias("h1"), F.when(usable, h("description", 2)).alias("h2"))
    base = rows.join(texts.select("h1", "h2", "number"), ["h1", "h2"], "left").groupBy("name").agg(
        F.count("*").alias("n_filas"), F.min("number").alias("number"))
    base = base.join(texts.select("number", "example"), "number", "left").select("name", "n_filas", F.coalesce("example", F.lit("")).alias("desc_ejemplo"))
    typed = pool.select("name", "dataset", F.coalesce("type", F.lit("")).alias("type"))
    return (base.join(first_values(typed, ["name"], "dataset", 5, "datasets"), "name")
            .join(first_values(typed, ["name"], "type", 5, "tipos"), "name")
            .select("name", "n_filas", "datasets", "tipos", "desc_ejemplo"))


def low_confidence_names(scored: DataFrame, threshold: float = V.ENTITY_THRESHOLD,
                         limit: int = V.RESCUE_ROUND_TOP) -> DataFrame:
    """The names with the lowest entity confidence and their usual prediction."""
    low = scored.filter(F.coalesce("prob_entity", F.lit(1.0)) < threshold)
    g = low.groupBy("name").agg(F.count("*").alias("n_filas"), F.min("prob_entity").alias("prob_min"))
    worst = g.orderBy("prob_min", "name").limit(limit)
    # at most `limit` names reach the second aggregate
    modal = most_common(low.join(F.broadcast(worst.select("name")), "name", "left_semi"),
                        ["name"], "entity", "pred_top")
    return worst.join(modal.select("name", "pred_top"), "name", "left")


def class_support(rows: DataFrame, target: str, minimum: int, merge_into: str | None = None,
                  keep: str | None = None) -> DataFrame:
    """Rare classes merged into one (`merge_into`) or dropped (except `keep`).

    The class counts are as few as the classes, so they are broadcast behind
    Spark's own size check (autoBroadcastJoinThreshold).
    """
    rows = rows.filter(F.col(target).isNotNull())
    counts = rows.groupBy(target).agg(F.count("*").alias("_support"))
    joined = rows.join(counts, target)
    if merge_into is not None:
        return joined.withColumn(target, F.when(F.col("_support") < minimum, F.lit(merge_into))
                                 .otherwise(F.col(target))).drop("_support")
    return joined.filter((F.col("_support") >= minimum) | (F.col(target) == F.lit(keep or ""))).drop("_support")


def integrity_checks(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row per check with the number of violating rows, in one pass."""
    return _stacked_counts(df, [((k,), F.coalesce(c, F.lit(False))) for k, c in checks.items()],
                           ["check"]).select("check", F.coalesce("n_obs", F.lit(0)).alias("violations"))


def flip_counts(df: DataFrame) -> DataFrame:
    """Label source distribution with flips in each direction."""
    was = F.upper(T.text("pii")) == "TRUE"
    now = F.col("pii_final")
    return df.groupBy("label_source").agg(
        F.count("*").alias("n"),
        F.sum((was & F.col("has_name") & ~now).cast("long")).alias("true_to_false"),
        F.sum((~was & F.col("has_name") & now).cast("long")).alias("false_to_true")).select(
        "label_source", "n", F.coalesce("true_to_false", F.lit(0)).alias("true_to_false"),
        F.coalesce("false_to_true", F.lit(0)).alias("false_to_true"))


def source_report(rows: DataFrame) -> DataFrame:
    """Row count and mean weight per (source, entity)."""
    return rows.groupBy("label_source", "entity").agg(
        F.count("*").alias("n"), F.round(F.avg("w"), 6).alias("w_mean"))


def group_labels(rows: DataFrame, group: str, label: str, entity: str | None = None) -> DataFrame:
    """Mean, max, size, majority (and modal entity) per group."""
    g = rows.groupBy(group).agg(
        F.avg(label).alias("y_mean"), F.max(label).alias("y_max"), F.count("*").alias("n"))
    g = g.withColumn("majority", (F.col("y_mean") >= 0.5).cast("int"))
    if entity is None:
        return g
    return g.join(most_common(rows, [group], entity, "modal_entity").select(group, "modal_entity"), group)


def vocabulary_gap(known: DataFrame, seen: DataFrame, col: str) -> DataFrame:
    """How much of the second vocabulary the first one has never seen."""
    vs, vb = known.select(col).distinct(), seen.select(col).distinct()
    flagged = vb.join(vs.withColumn("_in", F.lit(1)), col, "left")
    sizes = vs.agg(F.count("*").alias("known"))
    counts = flagged.agg(F.count("*").alias("seen"),
                         F.sum(F.col("_in").isNull().cast("long")).alias("oov"))
    return (attach(counts, sizes)
            .select("known", "seen", "oov",
                    F.round(F.col("oov") / F.greatest("seen", F.lit(1)), 6).alias("oov_rate")))


def exemplars(members: DataFrame) -> DataFrame:
    """Size of each (entity, cluster) and its most frequent name."""
    g = members.groupBy("entity", "cluster").agg(
        F.count("*").alias("n"),
        F.min(F.struct((-F.col("n_rows")).alias("m"), F.col("name").alias("v"))).alias("b"))
    return g.select("entity", "cluster", "n", F.col("b.v").alias("exemplar"))


def scan_summary(scored: DataFrame, table: str = "tabla", pii: str = "pii") -> DataFrame:
    return scored.groupBy(table).agg(
        F.count("*").alias("n_columns"), F.sum(F.col(pii).cast("long")).alias("n_pii"),
        F.round(F.avg(F.col(pii).cast("double")), 3).alias("pii_rate"))


def top_categories(rows: DataFrame, col: str, n: int) -> DataFrame:
    """The n most frequent values; ties in value order."""
    return (rows.groupBy(F.coalesce(F.col(col), F.lit("")).alias(col))
            .agg(F.count("*").alias("n")).orderBy(F.desc("n"), col).limit(n))


def agreement_by(rows: DataFrame, key: str, left: str, right: str, target: float) -> DataFrame:
    """Share of equal labels per key against a target (second labelling pass)."""
    share = F.avg(F.coalesce(F.col(left) == F.col(right), F.lit(False)).cast("double"))
    return rows.groupBy(key).agg(F.count("*").alias("n"), F.round(share, 6).alias("consistency"),
                                 (share >= target).alias("pass"))
