"""Catalogue aggregates (A), ranking (W), set operations (U), sources (S) and joins (J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import adapters as A, sqltext as S
from checks.q_names import CANON, _raw_words
from checks.registry import register
from tablescout.functions import rules as R, text as T, vocabulary as V
from tablescout.operators import catalog as C, decisions as DE, labels as L, splits as SP
from tablescout.plans import flows
from tablescout.session import scratch_dir
from tablescout.sources import files, headers, registry as REG, schema_scan, tables

TRUE_W = "pii IN ('TRUE')"
CAT = f"""cat AS (SELECT name, count(*) AS n_rows, CAST(sum(CASE WHEN pii = 'TRUE' THEN 1 ELSE 0 END) AS BIGINT) AS n_true FROM @SRC@ WHERE name IS NOT NULL GROUP BY name),
cat_n AS (SELECT *, {S.light('name')} AS light, n_true > 0 AS pii_any, n_true * 2 >= n_rows AS pii_majority FROM cat)"""
CATW = f"WITH {A.WORDS}, {S.fill(CAT, SRC='words')}"

register("a1_name_catalog", lambda s, d: C.name_catalog(A.words(s, d)),
         f"{CATW}, m AS (SELECT *, {S.untrail('light')} AS b FROM cat_n) SELECT name, n_rows, n_true, light, {S.roots('b')} AS aggr, light AS key, pii_any, pii_majority FROM m")
register("a2_key_rollup", lambda s, d: C.key_rollup(C.name_catalog(A.words(s, d))),
         f"{CATW} SELECT light AS key, CAST(sum(n_rows) AS BIGINT) AS n_rows, CAST(sum(n_true) AS BIGINT) AS n_true, min(name) AS name, sum(n_true) * 2 >= sum(n_rows) AS pii_majority FROM cat_n GROUP BY light")


def _rated(s, d):
    """Line items as matched names: similarity, row counts."""
    return A.table(s, d, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("name"),
        (F.round(F.col("l_quantity")) * 2).alias("similarity"), F.col("l_linenumber").cast("long").alias("n_rows"))


RATED = "rated AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS name, round(l_quantity) * 2 AS similarity, CAST(l_linenumber AS BIGINT) AS n_rows FROM lineitem)"
register("a3_coverage_summary", lambda s, d: C.coverage_summary(_rated(s, d)),
         f"""WITH {RATED}, b AS (SELECT {S.bucket_of('similarity')} AS bucket, count(*) AS n, CAST(sum(n_rows) AS BIGINT) AS rows FROM rated GROUP BY 1)
SELECT bucket, n, rows, round(100.0::DOUBLE * n / (SELECT sum(n) FROM b), 1) AS pct_names, round(100.0::DOUBLE * rows / (SELECT sum(rows) FROM b), 1) AS pct_rows,
 (SELECT round(avg(similarity), 1) FROM rated) AS mean, (SELECT round(quantile_cont(similarity, 0.5), 1) FROM rated) AS median FROM b""")
register("a4_threshold_shares", lambda s, d: C.threshold_shares(_rated(s, d)),
         f"WITH {RATED} SELECT t AS threshold, round(avg(CASE WHEN similarity >= t THEN 1.0::DOUBLE ELSE 0.0 END) * 100, 4) AS pct FROM rated, (VALUES (80), (85), (90), (95)) v(t) GROUP BY t")
register("a5_histogram", lambda s, d: C.histogram(_rated(s, d), "similarity"),
         f"""WITH {RATED}, e AS (SELECT min(similarity) AS lo, max(similarity) AS hi FROM rated)
SELECT bin, round(any_value(lo) + bin * (any_value(hi) - any_value(lo)) / 20, 6) AS lower, count(*) AS n FROM
 (SELECT lo, hi, CAST(least(floor((similarity - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin FROM rated, e) GROUP BY bin""")


def _clusters(s, d):
    r = _raw_words(s, d).withColumn("cluster", F.pmod("id", F.lit(40)).cast("int"))
    g = r.groupBy(F.col("raw").alias("entity"), "cluster").agg(F.count("*").alias("n"), F.min("exemplar").alias("exemplar"))
    return DE.canonicalised(g)


CLUSTERS = f"""{A.CODED}, s0 AS (SELECT id, name AS ex0, {S.light('name')} AS l FROM coded), s1 AS (SELECT *, string_split({S.roots('l')}, ' ')[1] AS raw FROM s0),
cl AS (SELECT raw, CAST(id % 40 AS INTEGER) AS cluster, count(*) AS n, min(ex0) AS exemplar FROM s1 GROUP BY 1, 2), """
from checks.q_names import CANON_SQL  # noqa: E402
CLUSTERS += S.fill(CANON_SQL, SRC="cl")
register("a6_canonical_rollup", lambda s, d: C.canonical_rollup(_clusters(s, d)),
         f"""WITH {CLUSTERS}, ex1 AS (SELECT DISTINCT entity_canon, exemplar FROM canon), ex2 AS (SELECT * FROM ex1 QUALIFY row_number() OVER (PARTITION BY entity_canon ORDER BY exemplar) <= 5),
g AS (SELECT entity_canon, count(DISTINCT cluster) AS n_clusters, CAST(sum(n) AS BIGINT) AS n_names FROM canon GROUP BY 1)
SELECT g.*, e.ejemplos FROM g JOIN (SELECT entity_canon, string_agg(exemplar, ' | ' ORDER BY exemplar) AS ejemplos FROM ex2 GROUP BY 1) e USING (entity_canon)""")
register("j11_canonical_lookup", lambda s, d: L.canonical_lookup(
    _raw_words(s, d).select("id", F.col("raw").alias("entity"), F.when(F.col("id") % 3 != 0, F.pmod("id", F.lit(40)).cast("int")).alias("cluster")), _clusters(s, d)),
    f"WITH {CLUSTERS} SELECT s1.id, s1.raw AS entity, CASE WHEN s1.id % 3 <> 0 THEN CAST(s1.id % 40 AS INTEGER) END AS cluster, c.entity_canon FROM s1 LEFT JOIN canon c ON c.raw = s1.raw AND c.cluster = CASE WHEN s1.id % 3 <> 0 THEN s1.id % 40 END")
register("w6_cluster_exemplar", lambda s, d: C.exemplars(_raw_words(s, d).select(
    F.col("raw").alias("entity"), "tabla", F.col("exemplar").alias("name"), F.col("id").alias("n_rows")).withColumnRenamed("tabla", "cluster")),
    f"WITH {CANON} SELECT raw AS entity, tabla AS cluster, count(*) AS n, arg_min(exemplar, (-id, exemplar)) AS exemplar FROM canon GROUP BY 1, 2")


def _deficit_rows(s, d):
    g = A.gold(s, d)
    extra = A.coded(s, d).select("name", F.col("entity_ml").alias("entity"))
    few = A.table(s, d, "region").select(F.col("r_name").alias("name"), F.lit("zona").alias("entity"))  # an entity of few forms at every scale
    return g.select("name", "entity").unionByName(extra).unionByName(few).withColumn("name_norm", T.normalize_name("name")).filter("name_norm <> ''")


DEF = f"dr AS (SELECT * FROM (SELECT name, entity, {S.name3('name')} AS name_norm FROM (SELECT name, entity FROM gold UNION ALL SELECT name, entity_ml FROM coded UNION ALL SELECT r_name, 'zona' FROM region)) WHERE name_norm <> '')"
register("a7_deficit_table", lambda s, d: C.deficit_table(_deficit_rows(s, d)),
         f"""WITH {A.GOLD}, {A.CODED}, {DEF}, g AS (SELECT entity, count(*) AS n_total, count(DISTINCT name_norm) AS n_distinto_norm, {S.tier('entity')} AS tier FROM dr WHERE entity IS NOT NULL GROUP BY entity)
SELECT entity, n_total, n_distinto_norm, tier, CAST(CASE WHEN tier = 'tier1_sin_sinteticos' THEN 0 ELSE greatest(30 - n_distinto_norm, 0) END AS BIGINT) AS need_30 FROM g""")

FAM = ", ".join(f"({S.q(f)}, {S.q(v)})" for f, vs in V.LEXICAL_FAMILIES.items() for v in vs)
FAM_SQL = f"SELECT familia, variante, count(*) AS n_obs FROM words, (VALUES {FAM}) v(familia, variante) WHERE contains(lower(name), variante) GROUP BY 1, 2"
QUAL_SQL = f"SELECT calificador, count(*) AS n_obs FROM words, (VALUES {', '.join(f'({S.q(x)})' for x in V.LEXICAL_QUALIFIERS)}) v(calificador) WHERE contains(lower(name), calificador) GROUP BY 1"
SEPS = {"underscore": "contains(name, '_')", "guion": "contains(name, '-')", "espacio": "contains(name, ' ')", "punto": "contains(name, '.')",
        "sin_sep": r"NOT regexp_matches(name, '[_\- .]')", "camel": "regexp_matches(name, '[a-z][A-Z]')",
        "mayusculas_full": r"regexp_matches(name, '^[A-Z0-9 _\-/\.]+$')"}
SEP_SQL = " UNION ALL ".join(f"SELECT {S.q(k)} AS valor, count(*) FILTER (WHERE {e}) AS n_obs FROM words" for k, e in SEPS.items())
register("a8_mine_families", lambda s, d: C.mine_families(A.words(s, d)), f"WITH {A.WORDS} {FAM_SQL}")
register("a9_separator_profile", lambda s, d: C.separator_profile(A.words(s, d)), f"WITH {A.WORDS} {SEP_SQL}")


def _qualified(s, d):
    """Words with a qualifier glued to those of some lengths; plain words hold none."""
    n = F.pmod(F.length("name"), F.lit(7))
    return A.words(s, d).select(F.concat("name", F.when(n == 0, F.lit("_Titular")).when(n == 3, F.lit("_cliente")).otherwise(F.lit(""))).alias("name"))


register("a10_mine_qualifiers", lambda s, d: C.mine_qualifiers(_qualified(s, d)),
         f"""WITH {A.WORDS}, tagged AS (SELECT name || CASE length(name) % 7 WHEN 0 THEN '_Titular' WHEN 3 THEN '_cliente' ELSE '' END AS name FROM words) {QUAL_SQL.replace('FROM words', 'FROM tagged')}""")
register("u6_lexical_findings", lambda s, d: C.lexical_findings(A.words(s, d)),
         f"WITH {A.WORDS} SELECT familia AS tipo, variante AS valor, n_obs FROM ({FAM_SQL}) UNION ALL SELECT 'calificador', calificador, n_obs FROM ({QUAL_SQL}) UNION ALL SELECT 'separador', valor, n_obs FROM ({SEP_SQL})")

FOCO = "list_filter([" + ", ".join(f"CASE WHEN {S.match('name_norm', [p])} THEN {S.q(p)} END" for p in V.FOCUS_PATTERNS) + "], lambda x: x IS NOT NULL)"
MIXED = f"""WITH {A.WORDS}, b AS (SELECT name, {S.norm('name')} AS name_norm, coalesce(entity, '') AS entity, pii FROM words),
g AS (SELECT name_norm, count(*) FILTER (WHERE pii = 'TRUE') AS n_true, count(*) FILTER (WHERE pii <> 'TRUE') AS n_false FROM b GROUP BY 1 HAVING n_true > 0 AND n_false > 0),
v AS (SELECT DISTINCT name_norm, name FROM b JOIN g USING (name_norm)), e AS (SELECT DISTINCT name_norm, entity FROM b JOIN g USING (name_norm) WHERE entity <> ''),
v2 AS (SELECT name_norm, string_agg(name, ' | ' ORDER BY name) AS variantes FROM (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY name_norm ORDER BY name) <= 12) GROUP BY 1),
e2 AS (SELECT name_norm, string_agg(entity, ' | ' ORDER BY entity) AS entity_true FROM (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY name_norm ORDER BY entity) <= 6) GROUP BY 1),
mixed AS (SELECT g.name_norm, variantes, n_true, n_false, coalesce(entity_true, '') AS entity_true, CASE WHEN len({FOCO.replace('name_norm', 'g.name_norm')}) = 0 THEN 'otra' ELSE array_to_string({FOCO.replace('name_norm', 'g.name_norm')}, ',') END AS foco, '' AS decision
  FROM g JOIN v2 USING (name_norm) LEFT JOIN e2 USING (name_norm))"""
register("a11_mixed_labels", lambda s, d: C.mixed_label_families(A.words(s, d)), f"{MIXED} SELECT * FROM mixed")
register("w12_report_order", lambda s, d: C.mixed_label_families(A.words(s, d)).withColumn("n_total", F.col("n_true") + F.col("n_false"))
         .orderBy("foco", F.desc("n_total"), "name_norm").select("foco", "n_total", "name_norm"),
         f"{MIXED} SELECT foco, n_true + n_false AS n_total, name_norm FROM mixed ORDER BY foco, n_total DESC, name_norm")

register("a12_entity_support", lambda s, d: C.entity_support(A.words(s, d).filter("pii = 'TRUE'").withColumn("group_id", T.group_id("name"))),
         f"""WITH {A.WORDS} SELECT entity, count(*) AS n_filas, count(DISTINCT name) AS n_names, count(DISTINCT {S.gid('name')}) AS n_groups,
 CASE WHEN count(DISTINCT {S.gid('name')}) < 5 THEN 'CRITICO(<5)' WHEN count(DISTINCT {S.gid('name')}) <= 10 THEN 'BAJO(5-10)' ELSE 'ok' END AS riesgo FROM words WHERE pii = 'TRUE' GROUP BY 1""")


def _two_labels(s, d):
    return A.table(s, d, "lineitem").select(F.col("l_returnflag").alias("entity"), F.when(F.col("l_tax") < 0.07, F.concat(F.lit("c"), F.round(F.col("l_tax") * 100).cast("int").cast("string"))).alias("entity_canon"))


TWO = "two AS (SELECT l_returnflag AS entity, CASE WHEN l_tax < 0.07 THEN 'c' || CAST(round(l_tax * 100) AS INTEGER) END AS entity_canon FROM lineitem)"
register("a13_contingency", lambda s, d: C.contingency(_two_labels(s, d), "entity", "entity_canon"),
         f"WITH {TWO} SELECT entity, coalesce(entity_canon, '(sin_canon)') AS entity_canon, count(*) AS n FROM two GROUP BY 1, 2")
register("a14_dominant_target", lambda s, d: C.dominant_target(_two_labels(s, d), "entity", "entity_canon"),
         f"""WITH {TWO}, t AS (SELECT entity, coalesce(entity_canon, '(sin_canon)') AS c, count(*) AS k FROM two GROUP BY 1, 2)
SELECT entity, CAST(sum(k) AS BIGINT) AS n, arg_min(c, (-k, c)) AS canon_top, round(max(k) * 100.0::DOUBLE / sum(k), 1) AS pct_top FROM t GROUP BY 1""")
register("a15_clustering_agreement", lambda s, d: C.clustering_agreement(_two_labels(s, d), "entity", "entity_canon"),
         f"""WITH {TWO}, t AS (SELECT entity, entity_canon, count(*)::DOUBLE AS n FROM two WHERE entity_canon IS NOT NULL GROUP BY 1, 2),
a AS (SELECT entity, sum(n) AS m FROM t GROUP BY 1), b AS (SELECT entity_canon, sum(n) AS m FROM t GROUP BY 1), tt AS (SELECT sum(n) AS tot FROM t),
x AS (SELECT (SELECT sum(-m / tot * ln(m / tot)) FROM a, tt) AS hc, (SELECT sum(-m / tot * ln(m / tot)) FROM b, tt) AS hk,
 (SELECT sum(-n / tot * ln(n / b.m)) FROM t JOIN b USING (entity_canon), tt) AS hck, (SELECT sum(-n / tot * ln(n / a.m)) FROM t JOIN a USING (entity), tt) AS hkc),
y AS (SELECT CASE WHEN hc = 0 THEN 1.0 ELSE 1 - hck / hc END AS h, CASE WHEN hk = 0 THEN 1.0 ELSE 1 - hkc / hk END AS c FROM x)
SELECT round(h, 6) AS homogeneidad, round(c, 6) AS completitud, round(CASE WHEN h + c = 0 THEN 0.0 ELSE 2 * h * c / (h + c) END, 6) AS v FROM y""")

CAND = f"""pc AS (SELECT name, count(*) AS n_filas, coalesce(substr(min(CASE WHEN trim(description) NOT IN ('', 'nan', 'None') THEN description END), 1, 300), '') AS desc_ejemplo FROM pool GROUP BY 1),
pd AS (SELECT name, string_agg(dataset, ' | ' ORDER BY dataset) AS datasets FROM (SELECT DISTINCT name, dataset FROM pool QUALIFY dense_rank() OVER (PARTITION BY name ORDER BY dataset) <= 5) GROUP BY 1),
pt AS (SELECT name, string_agg(type, ' | ' ORDER BY type) AS tipos FROM (SELECT DISTINCT name, type FROM pool QUALIFY dense_rank() OVER (PARTITION BY name ORDER BY type) <= 5) GROUP BY 1),
cands AS (SELECT name, n_filas, datasets, tipos, desc_ejemplo FROM pc JOIN pd USING (name) JOIN pt USING (name))"""
register("a16_pool_candidates", lambda s, d: C.pool_candidates(A.pool(s, d)), f"WITH {A.POOL}, {CAND} SELECT * FROM cands")


def _low(s, d):
    return A.coded(s, d).select(T.name_norm("name").alias("name"), F.col("entity_ml").alias("entity"), "prob_entity")


LOW = f"""lows AS (SELECT {S.norm('name')} AS name, entity_ml AS entity, prob_entity FROM coded WHERE prob_entity < 0.5),
low_g AS (SELECT name, count(*) AS n_filas, min(prob_entity) AS prob_min FROM lows GROUP BY 1 ORDER BY prob_min, name LIMIT 60),
low_m AS (SELECT name, arg_min(entity, (-k, entity)) AS pred_top FROM (SELECT name, entity, count(*) AS k FROM lows GROUP BY 1, 2) GROUP BY 1),
low_c AS (SELECT low_g.*, pred_top FROM low_g LEFT JOIN low_m USING (name))"""
register("a17_low_confidence", lambda s, d: C.low_confidence_names(_low(s, d)), f"WITH {A.CODED}, {LOW} SELECT name, n_filas, prob_min, pred_top FROM low_c")
register("a18_class_support", lambda s, d: C.class_support(A.coded(s, d).select(F.concat("entity_ml", F.pmod("id", F.lit(30)).cast("string")).alias("e")), "e", 3, merge_into="otros")
         .groupBy("e").agg(F.count("*").alias("n")).withColumn("mode", F.lit("merge"))
         .unionByName(C.class_support(A.coded(s, d).select(F.concat("entity_ml", F.pmod("id", F.lit(30)).cast("string")).alias("e")), "e", 3, keep="otro_pii5")
                      .groupBy("e").agg(F.count("*").alias("n")).withColumn("mode", F.lit("drop"))),
         f"""WITH {A.CODED}, r AS (SELECT entity_ml || (id % 30) AS e FROM coded), k AS (SELECT e, count(*) AS c FROM r GROUP BY 1)
SELECT CASE WHEN c < 3 THEN 'otros' ELSE e END AS e, count(*) AS n, 'merge' AS mode FROM r JOIN k USING (e) GROUP BY 1
UNION ALL SELECT e, count(*), 'drop' FROM r JOIN k USING (e) WHERE c >= 3 OR e = 'otro_pii5' GROUP BY 1""")
register("a19_integrity_checks", lambda s, d: C.integrity_checks(A.words(s, d), {
    "entity_without_pii": (F.col("pii") != "TRUE") & F.col("entity").isNotNull(), "pii_without_entity": (F.col("pii") == "TRUE") & F.col("entity").isNull(),
    "empty_name": F.col("name") == "", "short_name": F.length("name") < 2}),
    f"""WITH {A.WORDS} SELECT 'entity_without_pii' AS "check", count(*) FILTER (WHERE pii <> 'TRUE' AND entity IS NOT NULL) AS violations FROM words
UNION ALL SELECT 'pii_without_entity', count(*) FILTER (WHERE pii = 'TRUE' AND entity IS NULL) FROM words UNION ALL SELECT 'empty_name', count(*) FILTER (WHERE name = '') FROM words
UNION ALL SELECT 'short_name', count(*) FILTER (WHERE length(name) < 2) FROM words""")


def _flips(s, d):
    return A.pool(s, d).select("pii", (F.col("name") != "").alias("has_name"), F.when(F.col("name") != "", F.lower("name").contains("e")).alias("pii_final"),
                               F.when(F.length("name") > 6, F.lit("validado_21k")).when(F.length("name") > 3, F.lit("evidencia_parcial")).otherwise(F.lit("sin_evidencia_mantenido")).alias("label_source"))


register("a20_flip_counts", lambda s, d: C.flip_counts(_flips(s, d)),
         f"""WITH {A.POOL}, f AS (SELECT pii, name <> '' AS has_name, CASE WHEN name <> '' THEN contains(lower(name), 'e') END AS pf,
 CASE WHEN length(name) > 6 THEN 'validado_21k' WHEN length(name) > 3 THEN 'evidencia_parcial' ELSE 'sin_evidencia_mantenido' END AS label_source FROM pool)
SELECT label_source, count(*) AS n, count(*) FILTER (WHERE pii = 'TRUE' AND has_name AND NOT pf) AS true_to_false, count(*) FILTER (WHERE pii <> 'TRUE' AND has_name AND pf) AS false_to_true FROM f GROUP BY 1""")
register("a27_scan_summary", lambda s, d: C.scan_summary(A.coded(s, d).withColumn("pii", F.size(R.all_matches(F.col("name"))) > 0)),
         f"WITH {A.CODED} SELECT tabla, count(*) AS n_columns, count(*) FILTER (WHERE m) AS n_pii, round(avg(CASE WHEN m THEN 1.0::DOUBLE ELSE 0.0 END), 3) AS pii_rate FROM (SELECT tabla, len({S.matches('name')}) > 0 AS m FROM coded) GROUP BY 1")


# ---- previous predictions ------------------------------------------------------
def _previous_raw(s, d):
    return A.coded(s, d).select(
        F.concat("tabla", F.lit(".xlsx")).alias("Archivo"), F.concat(F.lit(" "), F.upper("name")).alias("Nombre de Columna"),
        F.when(F.col("id") % 3 == 0, F.lit("No PII")).otherwise(F.lit("PII")).alias("Prediccion"),
        F.when(F.col("id") % 7 == 0, F.lit("n/a")).otherwise((F.col("id") % 100).cast("string")).alias("Probabilidad PII (%)"))


PREV = f"""prev0 AS (SELECT tabla, {S.light('upper(name)')} AS key, id % 3 <> 0 AS pii_previo, CASE WHEN id % 7 <> 0 THEN (id % 100) / 100.0::DOUBLE END AS prob_previo FROM coded),
prev AS (SELECT tabla, key, bool_and(pii_previo) AS pii_previo, min(prob_previo) AS prob_previo FROM prev0 GROUP BY 1, 2)"""
NEW = f"""now AS (SELECT id, tabla, name, {S.light('name')} AS key, prob > 0.3 AS pii, prob AS prob_pii FROM coded),
cmp AS (SELECT now.*, pii_previo, prob_previo, pii = pii_previo AS acuerdo FROM now LEFT JOIN (SELECT * FROM prev WHERE tabla <> 'BUILDING') USING (tabla, key))"""


def _prev(s, d):
    p = files.previous_verdicts(_previous_raw(s, d))
    return p.groupBy("tabla", "key").agg(F.min("pii_previo").alias("pii_previo"), F.min("prob_previo").alias("prob_previo"))


def _compared(s, d):
    now = A.coded(s, d).select("id", "tabla", "name", T.join_key("name").alias("key"), (F.col("prob") > 0.3).alias("pii"), F.col("prob").alias("prob_pii"))
    return L.with_previous(now, _prev(s, d).filter("tabla <> 'BUILDING'"))


register("s14_previous_verdicts", lambda s, d: files.previous_verdicts(_previous_raw(s, d)),
         f"WITH {A.CODED}, {PREV} SELECT * FROM prev0")
register("j9_with_previous", lambda s, d: _compared(s, d).select("id", "key", "pii_previo", "prob_previo", "acuerdo"),
         f"WITH {A.CODED}, {PREV}, {NEW} SELECT id, key, pii_previo, prob_previo, acuerdo FROM cmp")
register("a28_agreement_rate", lambda s, d: L.agreement_rate(_compared(s, d)),
         f"WITH {A.CODED}, {PREV}, {NEW} SELECT count(*) AS n, count(acuerdo) AS n_comparable, round(avg(CASE WHEN acuerdo THEN 1.0::DOUBLE WHEN NOT acuerdo THEN 0.0 END), 6) AS rate FROM cmp")
register("a28_top_disagreements", lambda s, d: L.disagreements(_compared(s, d)).select("tabla", "name", "pii", "prob_pii", "pii_previo"),
         f"WITH {A.CODED}, {PREV}, {NEW} SELECT tabla, name, pii, prob_pii, pii_previo FROM cmp WHERE NOT acuerdo ORDER BY prob_pii DESC, tabla, name LIMIT 30")
register("a29_discrepancy", lambda s, d: L.discrepancy(A.coded(s, d).select("tabla", (F.col("prob") >= 0.3).cast("int").alias("pv"), F.col("own_pii").cast("int").alias("lab")), "pv", "lab")
         .groupBy("tabla").agg(F.sum("discrepancia").alias("n_dis"), F.round(F.avg("discrepancia"), 6).alias("rate")),
         f"WITH {A.CODED} SELECT tabla, CAST(sum(x) AS BIGINT) AS n_dis, round(avg(x::DOUBLE), 6) AS rate FROM (SELECT tabla, CASE WHEN (prob >= 0.3) <> own_pii THEN 1 ELSE 0 END AS x FROM coded) GROUP BY 1")

# ---- consolidation -------------------------------------------------------------
PRIO = "CASE label_source WHEN 'gold_validado' THEN 0 WHEN 'match_validado' THEN 1 WHEN 'manual_pool' THEN 2 WHEN 'sintetico' THEN 3 ELSE 9 END"
CONS = f"{A.SOURCES}, cons AS (SELECT name, entity, label_source, w FROM labelled QUALIFY row_number() OVER (PARTITION BY name ORDER BY {PRIO}, entity, w, label_source) = 1)"
_cons = lambda s, d: L.consolidate(L.union_sources(A.sources(s, d)))
register("u1_union_sources", lambda s, d: L.union_sources(A.sources(s, d)).groupBy("label_source", "entity", "w").agg(F.count("*").alias("n"), F.countDistinct("name").alias("names")),
         f"WITH {A.SOURCES} SELECT label_source, entity, w, count(*) AS n, count(DISTINCT name) AS names FROM labelled GROUP BY 1, 2, 3")
register("s6_optional_sources", lambda s, d: L.union_sources({"gold_validado": A.gold(s, d), "match_validado": None, "manual_pool": A.gold(s, d).select("name")})
         .groupBy("label_source", "entity").agg(F.count("*").alias("n")),
         f"WITH {A.GOLD} SELECT 'gold_validado' AS label_source, entity, count(*) AS n FROM gold WHERE entity IS NOT NULL AND trim(name) <> '' GROUP BY 2")
register("w2_authority_dedup", _cons, f"WITH {CONS} SELECT * FROM cons")
register("a30_source_report", lambda s, d: C.source_report(_cons(s, d)), f"WITH {CONS} SELECT label_source, entity, count(*) AS n, round(avg(w), 6) AS w_mean FROM cons GROUP BY 1, 2")
BIN = f"""{CONS}, bp AS (SELECT name, entity, 1 AS pii, w, label_source FROM cons UNION ALL SELECT DISTINCT trim(name), 'NO_PII', 0, 1.0::DOUBLE, 'gold_validado' FROM words WHERE pii <> 'TRUE'),
bk AS (SELECT *, {S.light('name')} AS light FROM bp WHERE name <> '' QUALIFY row_number() OVER (PARTITION BY name ORDER BY pii DESC, w DESC, entity, label_source) = 1),
bn AS (SELECT *, {S.untrail('light')} AS name_norm FROM bk WHERE light <> ''),
bin AS (SELECT *, {S.rep('name_norm', '[ _-]', '')} AS group_id, light AS key FROM bn)"""
_bin = lambda s, d: L.binary_rows(_cons(s, d), A.words(s, d))
register("w3_positives_win", lambda s, d: _bin(s, d).select("name", "entity", "pii", "w", "label_source", "light", "name_norm", "group_id", "longitud", "n_tokens", "tiene_sufijo"),
         f"""WITH {BIN} SELECT name, entity, pii, w, label_source, light, name_norm, group_id, CAST(length(name) AS INTEGER) AS longitud, CAST({S.tokens('name_norm')} AS INTEGER) AS n_tokens,
 CAST(regexp_matches(light, '\\p{{Nd}}+$') AS INTEGER) AS tiene_sufijo FROM bin""")
register("j12_map_with_default", lambda s, d: L.map_with_default(A.pool(s, d).select("dataset", "name"), _cons(s, d), "name", "w", 1.0).groupBy("dataset", "w").agg(F.count("*").alias("n")),
         f"WITH {A.POOL}, {CONS} SELECT dataset, coalesce(w, 1.0::DOUBLE) AS w, count(*) AS n FROM pool LEFT JOIN cons USING (name) GROUP BY 1, 2")
register("a31_group_majority", lambda s, d: C.group_labels(_bin(s, d), "group_id", "pii", "entity").select("group_id", "majority", "modal_entity", "n"),
         f"""WITH {BIN} SELECT group_id, CAST(avg(pii) >= 0.5 AS INTEGER) AS majority, any_value(m) AS modal_entity, count(*) AS n FROM bin JOIN
 (SELECT group_id, arg_min(entity, (-k, entity)) AS m FROM (SELECT group_id, entity, count(*) AS k FROM bin GROUP BY 1, 2) GROUP BY 1) USING (group_id) GROUP BY 1""")
register("a32_group_label_stats", lambda s, d: C.group_labels(A.words(s, d).withColumn("g", SP.leakage_key(T.base_entity("name"), F.col("dataset"))).withColumn("y", (F.col("pii") == "TRUE").cast("int")), "g", "y")
         .select("g", F.round("y_mean", 6).alias("y_mean"), "y_max", "n", "majority"),
         f"""WITH {A.WORDS} SELECT {S.base('name')} || '||' || dataset AS g, round(avg(CASE WHEN pii = 'TRUE' THEN 1.0::DOUBLE ELSE 0.0 END), 6) AS y_mean, max(CASE WHEN pii = 'TRUE' THEN 1 ELSE 0 END) AS y_max, count(*) AS n,
 CAST(avg(CASE WHEN pii = 'TRUE' THEN 1.0::DOUBLE ELSE 0.0 END) >= 0.5 AS INTEGER) AS majority FROM words GROUP BY 1""")
register("a34_self_consistency", lambda s, d: C.agreement_by(A.scored(s, d), "truth", "truth", "pred", 0.33),
         f"WITH {A.SCORED} SELECT truth, count(*) AS n, round(avg(CASE WHEN truth = pred THEN 1.0::DOUBLE ELSE 0.0 END), 6) AS consistency, avg(CASE WHEN truth = pred THEN 1.0::DOUBLE ELSE 0.0 END) >= 0.33 AS pass FROM scored GROUP BY 1")

# ---- joins ---------------------------------------------------------------------
register("j4_positive_columns_back", lambda s, d: (lambda cat: cat.join(cat.filter("pii_majority").select("name", T.name_norm("name").alias("entity")), "name", "left")
         .select("name", "n_rows", "entity"))(C.name_catalog(A.words(s, d))),
         f"{CATW} SELECT name, n_rows, CASE WHEN pii_majority THEN {S.untrail('light')} END AS entity FROM cat_n")
register("j3_propagate_raw", lambda s, d: L.propagate_raw(A.pool(s, d).select("dataset", "name"), C.name_catalog(A.gold(s, d)).select("name", "pii_majority"))
         .groupBy("dataset", "pii_majority").agg(F.count("*").alias("n")),
         f"WITH {A.POOL}, {A.GOLD}, {S.fill(CAT, SRC='gold')} SELECT dataset, pii_majority, count(*) AS n FROM pool LEFT JOIN cat_n USING (name) GROUP BY 1, 2")
register("j5_not_yet_labelled", lambda s, d: L.not_yet_labelled(A.pool(s, d).select("dataset", "name"), A.gold(s, d)).groupBy("name").agg(F.count("*").alias("n")),
         f"""WITH {A.POOL}, {A.GOLD}, gl AS (SELECT DISTINCT {S.light('name')} AS l FROM gold) SELECT trim(name) AS name, count(*) AS n FROM pool
 WHERE trim(name) NOT IN (SELECT trim(name) FROM gold) AND {S.light('trim(name)')} NOT IN (SELECT l FROM gl) GROUP BY 1""")
register("j10_label_pair_join", lambda s, d: L.label_pair_join(A.words(s, d).filter("pii = 'TRUE'").select("name", "entity"), A.gold(s, d).filter("entity IS NOT NULL").select("name", F.col("entity").alias("entity_canon")))
         .groupBy("entity", "entity_canon").agg(F.count("*").alias("n")),
         f"WITH {A.WORDS}, {A.GOLD}, one AS (SELECT name, min(entity) AS entity_canon FROM gold WHERE entity IS NOT NULL GROUP BY 1) SELECT w.entity, entity_canon, count(*) AS n FROM words w LEFT JOIN one USING (name) WHERE pii = 'TRUE' GROUP BY 1, 2")


def _registry(s, d):
    reg = A.table(s, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("nombre"), F.concat(F.lit("h"), F.col("s_nationkey").cast("string")).alias("url"))
    new = A.table(s, d, "nation").select(F.col("n_name").alias("nombre"), F.when(F.col("n_nationkey") == 3, F.lit(" ")).otherwise(F.col("n_name")).alias("url"))
    gone = A.table(s, d, "supplier").filter("s_acctbal < 0").select(F.col("s_suppkey").alias("id"))
    change = A.table(s, d, "supplier").filter("s_nationkey < 5").select(F.col("s_suppkey").alias("id"), F.lit("renamed").alias("nombre"), F.lit("h").alias("url"))
    return REG.register(REG.update(REG.remove(reg, gone), change), new)


register("j16_registry", _registry,
         """WITH kept AS (SELECT s_suppkey AS id, CASE WHEN s_nationkey < 5 THEN 'renamed' ELSE s_name END AS nombre, CASE WHEN s_nationkey < 5 THEN 'h' ELSE 'h' || s_nationkey END AS url FROM supplier WHERE NOT s_acctbal < 0)
SELECT * FROM kept UNION ALL SELECT m + n, nombre, url FROM (SELECT n_name AS nombre, CASE WHEN n_nationkey = 3 THEN ' ' ELSE n_name END AS url,
 row_number() OVER (ORDER BY n_name, CASE WHEN n_nationkey = 3 THEN ' ' ELSE n_name END) AS n, (SELECT max(id) FROM kept) AS m FROM nation WHERE n_nationkey <> 3)""")

# ---- ranking -------------------------------------------------------------------
def _candidates(s, d):
    n = A.words(s, d).unionByName(A.coded(s, d).select(F.col("tabla").alias("dataset"), "name", F.lit("TRUE").alias("pii"), F.lit(None).cast("string").alias("entity")))
    g = n.groupBy("name").agg(F.count("*").alias("n_filas"))
    return L.keyword_candidates(g.select("name", "n_filas", F.lit("").alias("datasets"), F.lit("").alias("tipos"), F.lit("").alias("desc_ejemplo")))


KW = []
for _e, _ws in V.RESCUE_ROUND_KEYWORDS.items():
    _hits = "list_filter([" + ", ".join(f"CASE WHEN contains(flat, {S.q(w)}) THEN {S.q(w)} END" for w in _ws) + "], lambda x: x IS NOT NULL)"
    _anti = f" AND NOT {S.any_of('flat', V.RESCUE_ROUND_ANTI[_e])}" if _e in V.RESCUE_ROUND_ANTI else ""
    KW.append(f"SELECT name, n_filas, {S.q(_e)} AS entity_sugerida, array_to_string({_hits}, ',') AS motivo FROM cg WHERE len({_hits}) > 0{_anti}")
KWC = f"""cg AS (SELECT name, n_filas, ' ' || replace({S.light('name')}, '_', ' ') || ' ' AS flat FROM (SELECT name, count(*) AS n_filas FROM (SELECT name FROM words UNION ALL SELECT name FROM coded) GROUP BY 1)),
kwc AS (SELECT * FROM ({' UNION ALL '.join(KW)}) QUALIFY row_number() OVER (PARTITION BY entity_sugerida ORDER BY n_filas * 10 + length(motivo) DESC, name) <= 60)"""
register("w4_top_candidates", lambda s, d: _candidates(s, d).select("name", "n_filas", "entity_sugerida", "motivo"), f"WITH {A.WORDS}, {A.CODED}, {KWC} SELECT * FROM kwc")
ORD = "CASE entity_sugerida " + " ".join(f"WHEN {S.q(e)} THEN {i}" for i, e in enumerate(V.RESCUE_ROUND_KEYWORDS)) + " ELSE 99 END"
ROUND = f"""rnd AS (SELECT name, n_filas, entity_sugerida, motivo FROM kwc UNION ALL SELECT name, n_filas, 'otro_pii', 'prob_entity<0.5 pred=' || pred_top FROM low_c),
round1 AS (SELECT * FROM rnd QUALIFY row_number() OVER (PARTITION BY name ORDER BY {ORD}) = 1)"""
_round = lambda s, d: L.labelling_round(_candidates(s, d), C.low_confidence_names(_low(s, d)))
register("u5_labelling_round", lambda s, d: _round(s, d).select("name", "n_filas", "entity_sugerida", "motivo"), f"WITH {A.WORDS}, {A.CODED}, {KWC}, {LOW}, {ROUND} SELECT * FROM round1")
register("w9_first_per_name", lambda s, d: _round(s, d).groupBy("entity_sugerida").agg(F.countDistinct("name").alias("n_nombres"), F.sum("n_filas").alias("n_filas")),
         f"WITH {A.WORDS}, {A.CODED}, {KWC}, {LOW}, {ROUND} SELECT entity_sugerida, count(DISTINCT name) AS n_nombres, CAST(sum(n_filas) AS BIGINT) AS n_filas FROM round1 GROUP BY 1")
register("w5_largest_per_bucket", lambda s, d: _rated(s, d).filter("similarity < 50").orderBy(F.desc("n_rows"), "name").limit(20),
         f"WITH {RATED} SELECT * FROM rated WHERE similarity < 50 ORDER BY n_rows DESC, name LIMIT 20")
register("w8_top_categories", lambda s, d: C.top_categories(A.words(s, d), "name", 20),
         f"WITH {A.WORDS} SELECT coalesce(name, '') AS name, count(*) AS n FROM words GROUP BY 1 ORDER BY n DESC, name LIMIT 20")

# ---- set operations ------------------------------------------------------------
_base_names = lambda df: df.select(T.base_entity("name").alias("b"))
register("u2_vocabulary_gap", lambda s, d: C.vocabulary_gap(_base_names(A.gold(s, d)), _base_names(A.pool(s, d)), "b"),
         f"""WITH {A.GOLD}, {A.POOL}, k AS (SELECT DISTINCT {S.base('name')} AS b FROM gold), v AS (SELECT DISTINCT {S.base('name')} AS b FROM pool)
SELECT (SELECT count(*) FROM k) AS known, count(*) AS seen, count(*) FILTER (WHERE b NOT IN (SELECT b FROM k)) AS oov, round(count(*) FILTER (WHERE b NOT IN (SELECT b FROM k)) / count(*)::DOUBLE, 6) AS oov_rate FROM v""")

# ---- sources and sinks -----------------------------------------------------------
register("s1_full_scan", lambda s, d: tables.read_table(s, f"{d}/supplier.parquet"), "SELECT * FROM supplier")


def _overwrite(s, d):
    path = f"{scratch_dir(s)}/t"
    for _ in range(2):
        tables.overwrite_table(A.table(s, d, "orders"), path, partition_by=["o_orderstatus"])
    return tables.read_table(s, path).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


register("s2_overwrite_table", _overwrite, "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")


def _csv(s, d):
    path = f"{scratch_dir(s)}/t"
    t = A.table(s, d, "conversations")
    rows = t.select(F.col("conv_id").cast("string").alias(" conv_id "), F.col("role").alias("role "), F.trim(F.regexp_replace("text", r"[^\x20-\xff]", " ")).alias("text"))
    for odd, encoding in ((0, "UTF-8"), (1, "ISO-8859-1")):  # a folder with files of both encodings
        rows.filter(F.col("` conv_id `").cast("long") % 2 == odd).write.mode("append").option("header", True).option("escape", '"').option("encoding", encoding).csv(path)
    return files.read_csv(s, path)


register("s3_read_csv", _csv, r"SELECT CAST(conv_id AS VARCHAR) AS conv_id, role, trim(regexp_replace(text, '[^\x20-\x{ff}]', ' ', 'g')) AS text FROM conversations")
COLS = {"region": ["r_regionkey", "r_name"], "nation": ["n_nationkey", "n_name", "n_regionkey"], "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
        "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"], "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
        "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
        "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
        "events": ["event_id", "ts", "user_id", "event_type", "value", "props"], "documents": ["doc_id", "text", "lang", "source", "n_chars"], "embeddings": ["vec_id", "embedding", "label"],
        "pages": ["page_id", "url", "html"], "benchmark": ["item_id", "text"], "labels": ["doc_id", "quality", "toxic"], "conversations": ["conv_id", "turn", "role", "text"]}
SCAN = " UNION ALL ".join(f"SELECT {S.q(t)} AS source_file, {S.q(c)} AS name, count(*) AS n_rows, count(*) - count({c}) AS n_null, count(*) > count({c}) AS accepts_null FROM {t}" for t, cs in COLS.items() for c in cs)
_paths = lambda d: {t: f"{d}/{t}.parquet" for t in A.TABLES}
_all = lambda s, d: {t: A.table(s, d, t) for t in A.TABLES}
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "FLOAT": "float", "FLOAT[]": "array<float>", "DATE": "date", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz"}
TYPE = lambda c: "CASE typeof(any_value(" + c + ")) " + " ".join(f"WHEN {S.q(a)} THEN {S.q(b)}" for a, b in TYPES.items()) + f" ELSE lower(typeof(any_value({c}))) END"
HEADERS = " UNION ALL ".join(f"SELECT {S.q(t)} AS source_file, {S.q(c)} AS name, {S.q(t)} AS dataset, {TYPE(c)} AS type, count(*) AS n_rows FROM {t}" for t, cs in COLS.items() for c in cs)
register("s4_header_scan", lambda s, d: schema_scan.table_headers(_all(s, d)), HEADERS)
register("s4_header_source", lambda s, d: headers.scan_headers(s, _paths(d), group=4), HEADERS)
register("s4_schema_scan", lambda s, d: schema_scan.profile_columns(_all(s, d)), SCAN)
FLAG = f"SELECT source_file, name, dataset, type, n_rows, {S.name3('name')} AS name_norm, {S.first_match('name')} AS entity, {S.summary(S.matches('name'))} AS regex_match, len({S.matches('name')}) > 0 AS pii FROM ({HEADERS})"
register("personal_columns_report", lambda s, d: flows.personal_columns_of_files(s, _paths(d)), FLAG)
register("s5_alias_resolution", lambda s, d: tables.resolve_aliases(A.table(s, d, "documents").select(F.col("source").alias("dataset"), F.col("lang").alias("columna"), "doc_id"))
         .groupBy("tabla", "name").agg(F.count("*").alias("n")), "SELECT source AS tabla, lang AS name, count(*) AS n FROM documents GROUP BY 1, 2")


def _scored_report(s, d):
    return A.coded(s, d).select("tabla", F.concat("name", F.when(F.col("id") % 4 == 0, F.lit(', "x"')).otherwise(F.lit(""))).alias("columna"), (F.col("prob") >= 0.3).alias("pii"), F.col("prob").alias("prob_pii"),
                                F.when(F.col("prob") >= 0.3, F.col("entity_ml")).alias("entity"), F.when(F.col("prob") >= 0.3, F.col("prob_entity")).alias("prob_entity"))


def _report_lines(s, d):
    r = files.verdict_report(_scored_report(s, d))
    return r.select(files.csv_line([F.col(f"`{c}`") for c in r.columns]).alias("line"))


register("s7_verdict_report", _report_lines,
         f"""WITH {A.CODED}, r AS (SELECT tabla, name || CASE WHEN id % 4 = 0 THEN ', "x"' ELSE '' END AS c, prob, entity_ml, prob_entity FROM coded)
SELECT tabla || ',' || CASE WHEN regexp_matches(c, '[",\\n]') THEN '"' || replace(c, '"', '""') || '"' ELSE c END || ',' || CASE WHEN prob >= 0.3 THEN 'PII' ELSE 'NO PII' END || ',' || printf('%.2f', prob * 100) || ','
 || CASE WHEN prob >= 0.3 THEN entity_ml ELSE '' END || ',' || CASE WHEN prob >= 0.3 THEN printf('%.2f', prob_entity * 100) ELSE '' END AS line FROM r""")
register("s10_findings_json", lambda s, d: files.findings_json(C.lexical_findings(A.words(s, d))))
register("s11_object_listing", lambda s, d: A.objects(s, d).groupBy(F.substring_index(F.regexp_replace("path", "^/+", ""), "/", 1).alias("root")).agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), F.max("lastModified").alias("newest")),
         f"WITH {A.OBJECTS} SELECT {A.PP}[1] AS root, count(*) AS n, CAST(sum(size) AS BIGINT) AS bytes, max(last_ms) AS newest FROM objects GROUP BY 1")


def _list_files(s, d):
    path = f"{scratch_dir(s)}/t"
    A.table(s, d, "customer").repartition(4).write.parquet(path)
    o = tables.list_objects(s, path).filter("path LIKE '%.parquet'")
    return o.agg(F.count("*").alias("n"), (F.min("size") > 0).alias("sized"), (F.min("lastModified") > 0).alias("stamped"))


register("s11_binary_listing", _list_files)


def _activity_files(s, d):
    path = scratch_dir(s)
    A.projects(s, d).write.json(f"{path}/p")
    A.jobs(s, d).write.json(f"{path}/j")
    A.timeline(s, d).write.json(f"{path}/t")
    from tablescout.operators import lifecycle as LC
    a = LC.project_activity(tables.read_projects(s, f"{path}/p"), tables.read_jobs(s, f"{path}/j"), tables.read_timeline(s, f"{path}/t"))
    return a.select("projectKey", F.coalesce("n_jobs", F.lit(0)).alias("n_jobs"), F.coalesce("n_commits", F.lit(0)).alias("n_commits"),
                    F.unix_millis("ultima_ejecucion").alias("run_ms"), F.unix_millis("ultima_modificacion").alias("mod_ms"))


register("s12_activity_records", _activity_files,
         f'WITH {A.PROJECTS} SELECT pk AS "projectKey", n_jobs, n_commits, epoch_ms(run) AS run_ms, epoch_ms("mod") AS mod_ms FROM activity')
