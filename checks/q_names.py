"""Normalisers (F) and rules (R)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import adapters as A, sqltext as S
from checks.registry import register
from tablescout.functions import dates as D, paths as P, rules as R, scores as SC, text as T, vocabulary as V
from tablescout.operators import catalog as C, decisions as DE, labels as L, lifecycle as LC, textsim as X

def on_names(qname, cols, sql_cols):
    """Row-level query over the distinct names: {alias: (spark fn, sql expr)}."""
    register(qname, lambda s, d: A.names(s, d).select("name", *[f(F.col("name")).alias(k) for k, f in cols.items()]),
             f"WITH {A.NAMES} SELECT name, " + ", ".join(f"{e} AS {k}" for k, e in sql_cols.items()) + " FROM names")


on_names("f1_normalize_light", {"light": T.normalize_light}, {"light": S.light("name")})
on_names("f2_name_norm", {"name_norm": T.name_norm}, {"name_norm": S.norm("name")})
on_names("f3_group_id", {"group_id": T.group_id}, {"group_id": S.gid("name")})
on_names("f7_split_camel", {"camel": T.split_camel}, {"camel": S.camel("name")})
on_names("f8_normalize_name", {"name_norm": T.normalize_name}, {"name_norm": S.name3("name")})
on_names("f9_clean_name", {"name_clean": T.clean_name}, {"name_clean": S.clean("name")})
on_names("f10_base_entity", {"base_entity": T.base_entity}, {"base_entity": S.base("name")})
on_names("f14_spoken_name", {"texto_completo": T.spoken_name}, {"texto_completo": "lower(trim(replace(name, '_', ' ')))"})
on_names("f36_number_token", {"masked": T.number_token}, {"masked": S.rep("name", r"\p{Nd}+", "<num>")})
on_names("f19_metadata_qualifier", {"is_metadata": T.is_metadata_name},
         {"is_metadata": S.match(S.clean("name"), V.METADATA_QUALIFIERS)})

register("f4_normalize_aggr", lambda s, d: A.names(s, d).select("name", T.normalize_aggr("name").alias("aggr")),
         f"WITH {A.NAMES}, n AS (SELECT name, {S.norm('name')} AS b FROM names) SELECT name, {S.roots('b')} AS aggr FROM n")
register("f5_light_split", lambda s, d: A.names(s, d).select("name", T.normalize_light_split("name").alias("split")),
         f"WITH {A.NAMES}, n AS (SELECT name, {S.light('name')} AS b FROM names) SELECT name, {S.roots('b')} AS split FROM n")
register("f6_join_key", lambda s, d: (A.names(s, d).groupBy(T.join_key("name").alias("key"))
                                      .agg(F.count("*").alias("n"), F.min("name").alias("first_name"))),
         f"WITH {A.NAMES} SELECT {S.light('name')} AS key, count(*) AS n, min(name) AS first_name FROM names GROUP BY 1")
register("f11_expand", lambda s, d: A.names(s, d).select("name", T.expand_abbreviations(T.clean_name("name")).alias("expanded")),
         f"WITH {A.NAMES}, n AS (SELECT name, {S.clean('name')} AS c FROM names) SELECT name, {S.expand('c')} AS expanded FROM n")
register("f12_dotted_keys", lambda s, d: DE.with_dotted_keys(A.names(s, d).withColumn("clean", T.clean_dotted("name"))),
    f"""WITH {A.NAMES}, n AS (SELECT name, {S.dotted('name')} AS clean FROM names),
p AS (SELECT *, {S.parts('clean')} AS ps FROM n)
SELECT name, clean, CASE WHEN len(ps) > 0 THEN array_to_string(ps, ' ') ELSE clean END AS full_key,
  CASE WHEN len(ps) > 0 THEN ps[-1] ELSE clean END AS last_token FROM p""")
register("f13_typo_fix", lambda s, d: A.names(s, d).select("name", T.fix_typo(T.normalize_light("name")).alias("fixed")),
         f"WITH {A.NAMES}, n AS (SELECT name, {S.light('name')} AS l FROM names) SELECT name, {S.typo('l')} AS fixed FROM n")
register("f15_length_tokens_suffix", lambda s, d: A.names(s, d).select(
    "name", F.length("name").alias("longitud"), T.token_count(T.name_norm("name")).alias("n_tokens"),
    T.has_trailing_number(T.normalize_light("name")).alias("tiene_sufijo")),
    f"""WITH {A.NAMES}, n AS (SELECT name, {S.light('name')} AS l FROM names), m AS (SELECT *, {S.untrail('l')} AS m FROM n)
SELECT name, CAST(length(name) AS INTEGER) AS longitud, CAST({S.tokens('m')} AS INTEGER) AS n_tokens,
  CAST(regexp_matches(l, '\\p{{Nd}}+$') AS INTEGER) AS tiene_sufijo FROM m""")


def _flag_sql(pattern: str) -> str:
    """One flag pattern; a boundary around a group applies to the whole group."""
    p = pattern.replace(r"\d", r"\p{Nd}")
    if p.startswith(r"\b(?:") and p.endswith(r")\b"):
        return f"regexp_matches(c, {S.q('(?:^|[^' + S.W + '])' + p[2:-2] + '(?:$|[^' + S.W + '])')})"
    return f"regexp_matches(c, {S.q(S.bound(p))})"


register("f16_numeric_features", lambda s, d: A.names(s, d).select(
    "name", *[c.alias(k) for k, c in T.numeric_features(T.clean_name("name")).items()]),
    f"""WITH {A.NAMES}, n AS (SELECT name, {S.clean('name')} AS c FROM names)
SELECT name, CAST(length(c) AS INTEGER) AS longitud, CAST({S.tokens('c')} AS INTEGER) AS n_tokens,
  CAST(regexp_matches(c, '\\p{{Nd}}') AS INTEGER) AS tiene_digito, CAST(len(regexp_extract_all(c, '\\p{{Nd}}')) AS INTEGER) AS n_digitos, """
    + ", ".join(f"CAST({_flag_sql(p)} AS INTEGER) AS rgx_{k}" for k, p in V.KEYWORD_FLAGS + V.SUFFIX_FLAGS) + " FROM n")
register("f17_has_description", lambda s, d: A.pool(s, d).groupBy("dataset", T.has_description("description").alias("has_description"))
         .agg(F.count("*").alias("n")),
         f"WITH {A.POOL} SELECT dataset, coalesce(trim(description) <> '', false) AS has_description, count(*) AS n FROM pool GROUP BY 1, 2")


def _dictionary(s, d):
    g = A.gold(s, d).filter("pii = 'TRUE'").select(T.base_entity("name").alias("base"))
    return C.top_categories(g, "base", 200).select("base")


TOP_BASE = f"""top_base AS (SELECT b AS base FROM (SELECT {S.base('name')} AS b, count(*) AS n FROM gold WHERE pii = 'TRUE' GROUP BY 1)
  ORDER BY n DESC, b LIMIT 200)"""
FUZZY_SQL = f"""{A.GOLD}, @SRC@, {TOP_BASE},
qs AS (SELECT name, list_distinct(list_filter(string_split_regex(b, '\\s+'), lambda t: t <> '')) AS ts FROM
  (SELECT DISTINCT name, {S.base('name')} AS b FROM @TAB@)),
ds AS (SELECT base, list_distinct(list_filter(string_split_regex(base, '\\s+'), lambda t: t <> '')) AS ts FROM top_base),
hit AS (SELECT q.name, d.base, len(q.ts) AS nq, len(d.ts) AS nd, count(*) AS i FROM (SELECT name, ts, unnest(ts) AS t FROM qs) q
  JOIN (SELECT base, ts, unnest(ts) AS t FROM ds) d ON q.t = d.t GROUP BY ALL),
best AS (SELECT name, max(100.0::DOUBLE * i / (nq + nd - i)) AS s FROM hit GROUP BY name)"""
register("f18_fuzzy_score", lambda s, d: X.token_overlap(A.names(s, d), _dictionary(s, d), "name", "base"),
         "WITH " + A.NAMES + ", " + S.fill(FUZZY_SQL, SRC="dummy AS (SELECT 1)", TAB="names")
         + " SELECT name, round(coalesce(s, 0.0), 6) AS fuzzy_score FROM qs LEFT JOIN best USING (name)")
register("j17_frequent_entity_lookup", lambda s, d: X.token_overlap(A.words(s, d), _dictionary(s, d), "name", "base")
         .groupBy("fuzzy_score").agg(F.count("*").alias("n_names")),
         "WITH " + S.fill(FUZZY_SQL, SRC=A.WORDS, TAB="words")
         + " SELECT fuzzy_score, count(*) AS n_names FROM (SELECT name, round(coalesce(s, 0.0), 6) AS fuzzy_score FROM qs LEFT JOIN best USING (name)) GROUP BY 1")

LABELS = ["TRUE", "true ", "1", "1.0", "T", "Si", "yes", "PII", "FALSE", "0"]
_raw = lambda: F.element_at(F.array(*[F.lit(x) for x in LABELS]), (F.pmod("c_custkey", F.lit(10)) + 1).cast("int"))
register("f20_truthy_dialects", lambda s, d: A.table(s, d, "customer").select("c_custkey", _raw().alias("raw")).select(
    "c_custkey", "raw", *[T.truthy(F.col("raw"), k).alias(k) for k in V.TRUTHY_WORDS]),
    f"SELECT c_custkey, raw, " + ", ".join(f"{S.truthy('raw', k)} AS {k}" for k in V.TRUTHY_WORDS)
    + f" FROM (SELECT c_custkey, ([{S.strs(LABELS)}])[c_custkey % 10 + 1] AS raw FROM customer)")

# similarity-driven rules on line item scores (0-100)
SIM = f"WITH {A.SCORED}, t AS (SELECT name, p * 100 AS sim, truth = 'R' AS np, pred = 'A' AS op FROM scored)"


def _sims(s, d):
    return A.scored(s, d).select("name", (F.col("p") * 100).alias("sim"), (F.col("truth") == "R").alias("np"), (F.col("pred") == "A").alias("op"))


register("f21_similarity_bucket", lambda s, d: _sims(s, d).groupBy(SC.similarity_bucket(F.col("sim")).alias("bucket")).agg(F.count("*").alias("n")),
         f"{SIM} SELECT {S.bucket_of('sim')} AS bucket, count(*) AS n FROM t GROUP BY 1")
register("f22_transferred_label", lambda s, d: _sims(s, d).withColumn("r", SC.transferred_label(F.col("sim"), F.col("np"), F.col("op")))
         .select("name", "r.*").groupBy("pii_final", "label_source", "sample_weight").agg(F.count("*").alias("n")),
         f"""{SIM} SELECT CASE WHEN sim >= 50 THEN np ELSE op END AS pii_final,
  CASE WHEN sim >= 90 THEN 'validado_21k' WHEN sim >= 50 THEN 'evidencia_parcial' ELSE 'sin_evidencia_mantenido' END AS label_source,
  CASE WHEN sim >= 90 THEN 1.0 WHEN sim >= 50 THEN round_even(sim / 100, 4) ELSE 0.3 END::DOUBLE AS sample_weight, count(*) AS n
FROM t GROUP BY 1, 2, 3""")
register("f23_import_decision", lambda s, d: _sims(s, d).groupBy("np", SC.import_decision(F.col("sim"), F.col("np")).alias("accion")).agg(F.count("*").alias("n")),
         f"{SIM} SELECT np, CASE WHEN sim >= 90 AND np THEN 'importar' WHEN sim >= 50 THEN 'revision' ELSE 'excluir' END AS accion, count(*) AS n FROM t GROUP BY 1, 2")
register("f35_reported_probability", lambda s, d: A.coded(s, d).select("id", SC.reported_probability(F.col("prob"), F.col("own_pii")).alias("p")),
         f"WITH {A.CODED} SELECT id, round_even(CASE WHEN own_pii THEN prob ELSE 1 - prob END, 4) AS p FROM coded")
register("f37_verdict_default", lambda s, d: A.coded(s, d).select(
    "id", SC.verdict_probability(F.when(F.col("prob") > 0.2, F.col("prob")), F.col("own_pii")).alias("p")),
    f"WITH {A.CODED} SELECT id, round_even(coalesce(CASE WHEN prob > 0.2 THEN prob END, CASE WHEN own_pii THEN 0.95::DOUBLE ELSE 0.05::DOUBLE END), 4) AS p FROM coded")
register("r19_review_flags", lambda s, d: A.coded(s, d).select(
    "id", SC.review_flag(F.col("prob_entity") * 100, F.col("prob"), 0.667).alias("needs_review"),
    F.when(F.col("prob_entity") < 0.5, F.lit("REVISAR")).otherwise(F.lit("")).alias("flag")),
    f"WITH {A.CODED} SELECT id, prob_entity * 100 < 60 OR (prob >= 0.667::DOUBLE - 0.15::DOUBLE AND prob <= 0.667::DOUBLE + 0.15::DOUBLE) AS needs_review, CASE WHEN prob_entity < 0.5 THEN 'REVISAR' ELSE '' END AS flag FROM coded")

# dates
_d = lambda c: F.col(c).cast("timestamp")
register("f24_from_millis", lambda s, d: A.jobs(s, d).select(D.from_millis(F.col("def.initiationTimestamp")).alias("t"))
         .groupBy(D.format_day(F.col("t")).alias("day")).agg(F.count("*").alias("n")),
         f"WITH {A.PROJECTS} SELECT coalesce(strftime({A.ts('init_ms')}, '%Y-%m-%d'), '-') AS day, count(*) AS n FROM jobs GROUP BY 1")
register("f25_months_idle", lambda s, d: A.table(s, d, "orders").select("o_orderkey", D.months_idle(_d("o_orderdate"), A.ref()).alias("months")),
         f"SELECT o_orderkey, CAST({S.months('o_orderdate', A.REF_SQL)} AS INTEGER) AS months FROM orders")
register("f26_idle_bucket", lambda s, d: A.table(s, d, "lineitem").groupBy(
    D.idle_bucket(D.months_idle(_d("l_shipdate"), A.ref())).alias("bucket")).agg(F.count("*").alias("n")),
    f"SELECT CAST(least({S.months('l_shipdate', A.REF_SQL)}, 4) AS INTEGER) AS bucket, count(*) AS n FROM lineitem GROUP BY 1")
register("f27_active_levels", lambda s, d: A.table(s, d, "part").select(
    "p_partkey", F.array_join(D.active_levels(F.pmod("p_size", F.lit(7))).cast("array<string>"), ",").alias("levels")),
    "SELECT p_partkey, CASE WHEN p_size % 7 <= 4 THEN array_to_string(list_filter([4, 3, 2, 1], lambda u: u >= p_size % 7), ',') ELSE CAST(p_size % 7 AS VARCHAR) END AS levels FROM part")
register("f28_parse_parameters", lambda s, d: A.table(s, d, "part").select(
    "p_partkey", D.parse_threshold(F.when(F.col("p_size") % 9 == 0, F.col("p_brand")).otherwise((F.col("p_size") - 5).cast("string"))).alias("threshold"),
    D.parse_cutoff_days(F.when(F.col("p_size") % 9 == 0, F.col("p_brand")).otherwise((F.col("p_size") - 5).cast("string"))).alias("cutoff")),
    """SELECT p_partkey, CASE WHEN v BETWEEN 1 AND 12 THEN v ELSE 4 END AS threshold, CASE WHEN v IS NULL THEN 180 ELSE greatest(v, 0) END AS cutoff FROM
(SELECT p_partkey, CASE WHEN p_size % 9 = 0 THEN NULL ELSE p_size - 5 END AS v FROM part)""")
register("f32_labels", lambda s, d: A.table(s, d, "orders").select(
    "o_orderkey", F.pmod("o_custkey", F.lit(3)).cast("int").alias("k")).select(
    "o_orderkey", D.criterion_label(F.element_at(F.array(F.lit(180), F.lit(0), F.lit(90)), F.col("k") + 1)).alias("criterio")),
    "SELECT o_orderkey, CASE o_custkey % 3 WHEN 0 THEN '> 6 meses' WHEN 1 THEN 'sin filtro (pruebas)' ELSE '> 90 días' END AS criterio FROM orders")
register("f34_owner_created", lambda s, d: LC.owner_and_created(A.projects(s, d)).select("projectKey", "dueno", "creado"),
         f"WITH {A.PROJECTS} SELECT pk AS \"projectKey\", coalesce(nullif(owner_login, ''), nullif(owner_display, ''), '-') AS dueno, strftime({A.ts('created_ms')}, '%Y-%m-%d') AS creado FROM projects")
register("f33_reason_chip", lambda s, d: LC.project_details(A.projects(s, d), A.jobs(s, d), A.timeline(s, d), A.ref()).select("id_proyecto", "motivo"),
         f"""WITH {A.PROJECTS} SELECT pk AS id_proyecto, CASE WHEN run IS NULL THEN 'Nunca ejecutado' WHEN n_contrib = 0 THEN 'Solo dueño'
  ELSE 'Abandonado hace ' || {S.months('greatest(mod, run)', A.REF_SQL)} || 'm' END AS motivo FROM activity""")

# paths
register("f29_parse_bundle_path", lambda s, d: P.with_bundle_fields(A.objects(s, d), "path", A.ROOT).filter("flow IS NOT NULL").select("path", "flow", "env", "nickname", "proyecto", "filename"),
         f"WITH {A.OBJECTS} SELECT path, flow, env, nickname, proyecto, filename FROM bundles_all")
register("f30_is_bundle", lambda s, d: P.with_bundle_fields(A.objects(s, d), "path", A.ROOT).select(
    "path", P.is_bundle(F.col("path"), F.col("flow")).alias("bundle")),
    f"""WITH {A.OBJECTS} SELECT path, CASE WHEN flow = 'NEW' THEN lower(path) LIKE '%.zip' WHEN flow = 'LEGACY' THEN n
  ELSE lower(path) LIKE '%.zip' OR n END AS bundle FROM (SELECT path, flow, contains(regexp_replace({A.CLEAN_PATH}, '/+$', ''), '/') AS n FROM parsed)""")
register("f31_path_id_megabytes", lambda s, d: A.objects(s, d).select("path", P.path_id(F.col("path")).alias("id"), P.megabytes(F.col("size")).alias("mb")),
         f"WITH {A.OBJECTS} SELECT path, md5(path) AS id, {A.MB} AS mb FROM objects")

# ---- rules ---------------------------------------------------------------------
register("r1_first_match", lambda s, d: A.coded(s, d).select("id", "name", R.first_match(F.col("name"), guard=F.col("own_pii")).alias("nocase"),
                                                             R.first_match(F.col("name"), guard=F.col("own_pii"), ignore_case=False).alias("exact_case")),
         f"""WITH {A.CODED} SELECT id, name, CASE WHEN own_pii THEN {S.first_match('name')} END AS nocase,
  CASE WHEN own_pii THEN {S.first_match('name', nocase=False)} END AS exact_case FROM coded""")
on_names("r2_all_matches", {"matched": lambda c: F.array_join(R.all_matches(c), ","), "regex_match": lambda c: R.match_summary(R.all_matches(c))},
         {"matched": f"array_to_string({S.matches('name')}, ',')", "regex_match": S.summary(S.matches("name"))})
register("r3_rule_override", lambda s, d: DE.override_by_rule(
    A.coded(s, d).withColumn("pe", F.when(F.col("prob_entity") > 0.05, F.col("prob_entity"))), "entity_ml", "pe")
    .select("id", "name", "entity_final", "override_aplicado", "regex_match"),
    f"""WITH {A.CODED}, m AS (SELECT *, {S.matches('name')} AS ms, coalesce(CASE WHEN prob_entity > 0.05 THEN prob_entity END, 1.0) AS pe FROM coded)
SELECT id, name, CASE WHEN pe < 0.5 AND len(ms) = 1 THEN ms[1] ELSE entity_ml END AS entity_final, pe < 0.5 AND len(ms) = 1 AS override_aplicado,
  {S.summary('ms')} AS regex_match FROM m""")


def _label_sql():
    arms, motives = [], []
    for e, pos, anti in V.LABELLING_RULES:
        cond = S.match("flat", pos) + (f" AND NOT {S.match('flat', anti)}" if anti else "")
        arms.append(f"WHEN {cond} THEN {S.q(e)}")
        hits = ", ".join(f"CASE WHEN {S.match('flat', [p])} THEN {S.q(p)} END" for p in pos)
        motives.append(f"WHEN {cond} THEN array_to_string(list_filter([{hits}], lambda h: h IS NOT NULL), ',')")
    return f"CASE {' '.join(arms)} ELSE '' END AS entity, CASE {' '.join(motives)} ELSE '' END AS motivo"


register("r4_labelling_rules", lambda s, d: DE.labelled_by_rules(A.names(s, d)),
         f"WITH {A.NAMES}, n AS (SELECT name, ' ' || replace({S.light('name')}, '_', ' ') || ' ' AS flat FROM names) SELECT name, {_label_sql()} FROM n")
SOME_CLASSES = ["curp", "rfc", "correo", "fecha_nacimiento"]


def _fallbacks(s, d):
    k = A.coded(s, d).withColumn("light", T.normalize_light("name"))
    k = DE.keyword_correction(k, "light", "entity_ml", "prob_entity", "judge")
    k = DE.keyword_correction(k, "light", "entity_ml", "prob_entity", "scoring", V.FALLBACK_SCORING, 0.5, SOME_CLASSES)
    return k.select("id", "name", "judge", "scoring")


register("r5_keyword_fallback", _fallbacks,
    f"""WITH {A.CODED}, n AS (SELECT *, replace(' ' || {S.light('name')} || ' ', '_', ' ') AS k FROM coded),
m AS (SELECT *, {S.keyword('k', V.FALLBACK_JUDGE)} AS f1, {S.keyword('k', V.FALLBACK_SCORING, allowed=['curp', 'rfc', 'correo', 'fecha_nacimiento'], other_than='entity_ml')} AS f2 FROM n)
SELECT id, name, CASE WHEN prob_entity < 0.5 AND f1 IS NOT NULL THEN f1 ELSE entity_ml END AS judge,
  CASE WHEN prob_entity < 0.5 AND f2 IS NOT NULL THEN f2 ELSE entity_ml END AS scoring FROM m""")

KEYS = f"""@SRC@, k0 AS (SELECT *, {S.dotted('name')} AS cl FROM @TAB@), k1 AS MATERIALIZED (SELECT *, {S.parts('cl')} AS ps FROM k0),
keys AS (SELECT *, CASE WHEN len(ps) > 0 THEN array_to_string(ps, ' ') ELSE cl END AS fk, CASE WHEN len(ps) > 0 THEN ps[-1] ELSE cl END AS lt FROM k1),
ruled AS MATERIALIZED (SELECT *, (fk IN ({S.strs(V.SYSTEM_FIELDS)}) OR lt IN ({S.strs(V.SYSTEM_FIELDS)})) AND NOT {S.any_of('fk', V.SYSTEM_FIELD_GUARDS)} AS excluded,
  {S.typo('fk')} IN ({S.strs(V.EXACT_KEYS)}) OR {S.typo('lt')} IN ({S.strs(V.EXACT_KEYS)}) AS exacto,
  ' ' || {S.typo('fk')} || ' ' || {S.typo('lt')} || ' ' AS rk,
  ' ' || replace(fk, '_', ' ') || ' ' || replace(lt, '_', ' ') || ' ' AS sk, ' ' || replace(fk, '_', ' ') || ' ' AS bk FROM keys),
levels AS MATERIALIZED (SELECT *, {S.keyword('rk', V.RARE_RULES)} AS raro, {S.keyword('sk', V.RESCUE_RULES, spaced=True)} AS rescate,
  {S.keyword('bk', V.FALLBACK_PAGE, allowed=V.ENTITY_CLASSES)} AS fallback FROM ruled)"""
NAME_KEYS = "WITH " + S.fill(KEYS, SRC=A.NAMES, TAB="names")
on = lambda c: (lambda s, d: DE.with_rule_levels(DE.with_dotted_keys(A.names(s, d))).select("name", F.col(c).alias("v")))
register("r7_system_exclusion", on("excluded"), f"{NAME_KEYS} SELECT name, excluded AS v FROM levels")
register("r8_exact_keys", on("exact"), f"{NAME_KEYS} SELECT name, exacto AS v FROM levels")
register("r9_rare_rules", on("rare"), f"{NAME_KEYS} SELECT name, raro AS v FROM levels")
register("r10_rescue_rules", on("rescue"), f"{NAME_KEYS} SELECT name, rescate AS v FROM levels")

DECIDED = "WITH " + S.fill(KEYS, SRC=A.CODED, TAB="coded") + """,
motive AS (SELECT *, CASE WHEN fk = '' THEN CASE WHEN prob >= 0.667 THEN 'modelo' ELSE '' END WHEN excluded THEN 'exclusion_sistema'
  WHEN prob >= 0.667 THEN 'modelo' WHEN exacto THEN 'exacto' WHEN raro IS NOT NULL THEN 'raro'
  WHEN prob >= 0.15 AND rescate IS NOT NULL THEN 'fuzzy' ELSE '' END AS reason FROM levels),
decided AS MATERIALIZED (SELECT *, reason NOT IN ('', 'exclusion_sistema') AS pii,
  CASE reason WHEN 'exacto' THEN coalesce(rescate, fallback) WHEN 'raro' THEN raro WHEN 'fuzzy' THEN rescate END AS prior_entity,
  round_even(CASE reason WHEN 'exclusion_sistema' THEN 0.0 WHEN 'exacto' THEN greatest(prob, 0.95) WHEN 'raro' THEN greatest(prob, 0.9)
    WHEN 'fuzzy' THEN greatest(prob, 0.8) ELSE prob END::DOUBLE, 4) AS p FROM motive)"""


def _five_levels(s, d):
    return DE.five_level_decision(DE.with_rule_levels(DE.with_dotted_keys(A.coded(s, d))))


register("r6_five_level_decision", lambda s, d: _five_levels(s, d).select("id", "name", "pii", F.col("prob_pii").alias("p"), "reason", "prior_entity"),
         f"{DECIDED} SELECT id, name, pii, p, reason, prior_entity FROM decided")
register("r11_entity_resolution", lambda s, d: DE.resolve_entity(_five_levels(s, d), "entity_ml", "prob_entity")
         .select("id", "name", F.col("entity_final").alias("entity"), F.col("prob_entity_final").alias("pe")),
    f"""{DECIDED}, r AS (SELECT *, coalesce(prior_entity IN ({S.strs(V.ENTITY_CLASSES)}), false) AND (reason IN ('exacto', 'raro') OR prob_entity < 0.5) AS bp,
  prob_entity < 0.5 AND coalesce(rescate, fallback) IS NOT NULL AS bf FROM decided)
SELECT id, name, CASE WHEN NOT pii THEN NULL WHEN bp THEN prior_entity WHEN bf THEN coalesce(rescate, fallback) ELSE entity_ml END AS entity,
  CASE WHEN pii THEN round_even(CASE WHEN bp THEN greatest(prob_entity, 0.9) WHEN bf THEN greatest(prob_entity, 0.8) ELSE prob_entity END::DOUBLE, 4) END AS pe FROM r""")


def _taxonomy(s, d):
    return L.taxonomy(A.names(s, d).select("name", T.expand_abbreviations(T.clean_name("name")).alias("exp")))


TAX_ARMS = " ".join(f"WHEN {S.match('exp', p)} THEN {S.q(e)}" for e, p in V.TAXONOMY)
EX_SETS = " UNION ALL ".join(f"SELECT {i} AS o, {S.q(e)} AS e, {S.q(t)} AS t, {len(x.split())} AS nd" for i, (e, x) in enumerate(V.TAXONOMY_EXAMPLES) for t in x.split())
register("r12_taxonomy", _taxonomy, f"""WITH {A.NAMES}, c AS (SELECT name, {S.clean('name')} AS cl FROM names), n AS (SELECT name, cl, {S.expand('cl')} AS exp FROM c),
m AS (SELECT name, cl, exp, CASE {TAX_ARMS} END AS ent FROM n), ex AS ({EX_SETS}),
tk AS (SELECT name, unnest(list_distinct(string_split(exp, ' '))) AS t, len(list_distinct(string_split(exp, ' '))) AS nq FROM m WHERE ent IS NULL AND cl <> ''),
sc AS (SELECT name, o, e, 100.0::DOUBLE * count(*) / (nq + nd - count(*)) AS s FROM tk JOIN ex USING (t) GROUP BY name, o, e, nq, nd),
best AS (SELECT name, e, s FROM sc QUALIFY row_number() OVER (PARTITION BY name ORDER BY s DESC, o) = 1)
SELECT m.name, CASE WHEN cl = '' THEN 'DESCONOCIDO' WHEN ent IS NOT NULL THEN ent WHEN s >= 80 THEN e ELSE 'DESCONOCIDO' END AS entity,
  CASE WHEN cl = '' THEN 0.0 WHEN ent IS NOT NULL THEN 1.0 WHEN s >= 80 THEN round_even(s / 100, 2) ELSE 0.0 END::DOUBLE AS prob_entity,
  CASE WHEN cl = '' THEN 'vacio' WHEN ent IS NOT NULL THEN 'regex' WHEN s >= 80 THEN 'fuzzy' ELSE 'fallback' END AS metodo
FROM m LEFT JOIN best USING (name)""")


def _raw_words(s, d):
    """First split token of each coded name, as a discovered cluster word."""
    return A.coded(s, d).select("id", "tabla", "own_pii", F.split(T.normalize_light_split("name"), " ")[0].alias("raw"), F.col("name").alias("exemplar"))


def _canonical(s, d):
    return DE.canonicalised(_raw_words(s, d), "raw").select("id", "raw", "entity_canon", "metodo")


CANON_SQL = f"""w AS (SELECT *, CASE WHEN b = '' THEN r ELSE b END AS word FROM (SELECT *, {S.untrail('r')} AS b FROM (SELECT *, lower(trim(coalesce(raw, ''))) AS r FROM @SRC@))),
bl AS (SELECT *, word || ' ' || lower(coalesce(exemplar, '')) AS blob FROM w),
cn AS (SELECT *, CASE word {' '.join(f"WHEN {S.q(a)} THEN {S.q(b)}" for a, b in V.CANONICAL_EXACT.items())} END AS ex, {S.keyword('blob', V.CANONICAL_KEYWORDS)} AS kw FROM bl),
canon AS (SELECT *, coalesce(ex, kw, CASE WHEN word IN ({S.strs(V.CANONICAL_NUMBER_WORDS)}) AND contains(blob, 'num') THEN 'numero' ELSE 'otros' END) AS entity_canon,
  CASE WHEN ex IS NOT NULL THEN 'exact' WHEN kw IS NOT NULL THEN 'exemplar' ELSE 'fallback' END AS metodo FROM cn)"""
CANON = f"""{A.CODED}, s0 AS (SELECT id, tabla, own_pii, name AS exemplar, {S.light('name')} AS l FROM coded), s1 AS (SELECT *, string_split({S.roots('l')}, ' ')[1] AS raw FROM s0),
{S.fill(CANON_SQL, SRC='s1')}"""
register("r13_canonical_entity", _canonical, f"WITH {CANON} SELECT id, raw, entity_canon, metodo FROM canon")
register("r14_focus_tags", lambda s, d: DE.focus_tagged(A.names(s, d).withColumn("name_norm", T.name_norm("name"))).select("name", "foco"),
         f"WITH {A.NAMES}, n AS (SELECT name, {S.norm('name')} AS m FROM names), h AS (SELECT name, list_filter(["
         + ", ".join(f"CASE WHEN {S.match('m', [p])} THEN {S.q(p)} END" for p in V.FOCUS_PATTERNS)
         + "], lambda x: x IS NOT NULL) AS hs FROM n) SELECT name, CASE WHEN len(hs) = 0 THEN 'otra' ELSE array_to_string(hs, ',') END AS foco FROM h")
register("r15_listable_projects", lambda s, d: LC.listable(A.projects(s, d)).select("projectKey"),
         f"WITH {A.PROJECTS} SELECT pk AS \"projectKey\" FROM projects WHERE NOT tutorial AND len(list_filter(tags, lambda t: lower(trim(t)) IN ({S.strs(V.PROTECTED_TAGS)}))) = 0")
register("r16_age_filter", lambda s, d: A.table(s, d, "orders").filter(D.older_than(_d("o_orderdate"), A.ref(), 180)).groupBy("o_orderstatus").agg(F.count("*").alias("n")),
         f"SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderdate < {A.REF_SQL} - INTERVAL 180 DAY GROUP BY 1")
register("r17_search_filter", lambda s, d: A.coded(s, d).filter(R.search_filter([F.col("tabla"), F.col("name"), F.col("entity_ml")], " TEL ", F.col("own_pii"))).select("id", "name"),
         f"WITH {A.CODED} SELECT id, name FROM coded WHERE own_pii AND (contains(lower(tabla), 'tel') OR contains(lower(name), 'tel') OR contains(lower(entity_ml), 'tel'))")
register("r18_tier", lambda s, d: A.coded(s, d).select("id", R.tier_of(F.when(F.col("id") % 5 == 0, F.lit("x")).otherwise(F.col("entity_ml"))).alias("tier")),
         f"WITH {A.CODED} SELECT id, {S.tier('e')} AS tier FROM (SELECT id, CASE WHEN id % 5 = 0 THEN 'x' ELSE entity_ml END AS e FROM coded)")
