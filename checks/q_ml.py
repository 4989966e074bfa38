"""Gram features, neighbours, label transfer, clustering, augmentation and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import adapters as A, sqltext as S
from checks.q_catalog import CAT, DEF, _deficit_rows
from checks.registry import register
from tablescout.functions import text as T, vocabulary as V
from tablescout.operators.stages import scoring_bundle
from tablescout.streaming import streams as ST
from tablescout.operators import augment as AU, calibration as CA, catalog as C, evaluate as E, features as FT, labels as L, models as M, textsim as X
from tablescout.operators.grouping import attach
from tablescout.operators.splits import bucket
from tablescout.plans import flows
from tablescout.session import cut_lineage, scratch_dir
from tablescout.sources import artefacts

# ---- grams -----------------------------------------------------------------------
_light_names = lambda s, d: A.gold(s, d).select(T.normalize_light("name").alias("light")).filter("light <> ''").distinct()
LN = f"ln AS (SELECT DISTINCT {S.light('name')} AS light FROM gold WHERE {S.light('name')} <> '')"
register("m1_char_tfidf", lambda s, d: X.tfidf(_light_names(s, d), "light", X.char_wb_grams(F.col("light"))).select("light", "term", "df", F.round("w", 6).alias("w")),
         f"WITH {A.GOLD}, {LN}, {S.grams('ln', 'light', 'light')}, {S.vectors('grams', 'ln')} SELECT k AS light, g AS term, df, round(w, 6) AS w FROM vec")
_m1b = f"""WITH {A.GOLD}, {LN}, {S.grams('ln', 'light', 'light', 2, 5)}, tf AS (SELECT k, g, count(*)::DOUBLE AS tf FROM grams GROUP BY 1, 2),
dfs AS (SELECT g, count(*) AS df, ln((1 + (SELECT count(*) FROM ln)) / CAST(1 + count(*) AS DOUBLE)) + 1 AS idf FROM tf GROUP BY 1 HAVING count(*) >= 2 ORDER BY sum(tf) DESC, g LIMIT 5000),
raw AS (SELECT k, g, tf * idf AS w FROM tf JOIN dfs USING (g)), nm AS (SELECT k, sqrt(sum(w * w)) AS n FROM raw GROUP BY 1) SELECT k AS light, g AS term, round(w / n, 6) AS w FROM raw JOIN nm USING (k)"""
register("m1_char_tfidf_limited", lambda s, d: X.tfidf(_light_names(s, d), "light", X.char_wb_grams(F.col("light"), 2, 5), 2, 5000).select("light", "term", F.round("w", 6).alias("w")), _m1b)


def _turns(s, d):
    return A.table(s, d, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("id"), "text")


_m2 = f"""WITH t AS (SELECT conv_id || '-' || turn AS id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS ws FROM conversations),
g AS (SELECT id, unnest(list_concat(ws, list_transform(generate_series(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1]))) AS g FROM t),
tf AS (SELECT id, g, count(*)::DOUBLE AS tf FROM g GROUP BY 1, 2), dfs AS (SELECT g, count(*) AS df, ln((1 + (SELECT count(*) FROM t)) / CAST(1 + count(*) AS DOUBLE)) + 1 AS idf FROM tf GROUP BY 1 HAVING count(*) >= 2 ORDER BY sum(tf) DESC, g LIMIT 3000),
raw AS (SELECT id, g, tf * idf AS w FROM tf JOIN dfs USING (g)), nm AS (SELECT id, sqrt(sum(w * w)) AS n FROM raw GROUP BY 1) SELECT id, g AS term, round(w / n, 6) AS w FROM raw JOIN nm USING (id)"""
register("m2_word_tfidf", lambda s, d: X.tfidf(_turns(s, d), "id", X.word_tokens(F.col("text")), 2, 3000).select("id", "term", F.round("w", 6).alias("w")), _m2)

# ---- neighbours --------------------------------------------------------------------
_keys = lambda df: C.key_rollup(C.name_catalog(df)).filter("key <> ''")
NN = f"""{A.POOL}, {A.GOLD}, {S.fill(CAT, SRC='pool').replace('cat_n', 'pcat_n').replace('cat AS', 'pcat AS').replace('FROM cat)', 'FROM pcat)')},
{S.fill(CAT, SRC='gold').replace('cat_n', 'gcat_n').replace('cat AS', 'gcat AS').replace('FROM cat)', 'FROM gcat)')},
pk AS (SELECT light AS key, min(name) AS name, sum(n_rows)::BIGINT AS n_rows, sum(n_true) * 2 >= sum(n_rows) AS pii_majority FROM pcat_n WHERE light <> '' GROUP BY 1),
gk AS (SELECT light AS key, min(name) AS name, sum(n_true) * 2 >= sum(n_rows) AS pii_majority FROM gcat_n WHERE light <> '' GROUP BY 1),
sides AS (SELECT 'q' || key AS k, key AS t FROM pk UNION ALL SELECT 'c' || key, key FROM gk), {S.grams('sides', 'k', 't')}, {S.vectors('grams', 'sides')},
vq AS (SELECT substr(k, 2) AS q, g, w FROM vec WHERE k[1] = 'q'), vc AS (SELECT substr(k, 2) AS c, g, w FROM vec WHERE k[1] = 'c'),
dots AS (SELECT q, c, sum(vq.w * vc.w) AS sim FROM vq JOIN vc USING (g) GROUP BY 1, 2),
nn AS (SELECT q, CASE WHEN max(CASE WHEN q = c THEN 1 ELSE 0 END) = 1 THEN q ELSE arg_min(c, (-round(sim, 9), c)) END AS c,
  CASE WHEN max(CASE WHEN q = c THEN 1 ELSE 0 END) = 1 THEN 1.0 ELSE arg_min(sim, (-round(sim, 9), c)) END AS sim FROM dots GROUP BY 1)"""
register("j1_nearest_at_floor", lambda s, d: X.nearest_neighbours(_keys(A.pool(s, d)), _keys(A.gold(s, d)), "key", 0.5).select("q", "c", F.round("similarity", 4).alias("similarity")),
         f"WITH {NN} SELECT q, c, round(sim * 100, 4) AS similarity FROM nn WHERE sim >= 0.5")
register("j1_nearest_complete", lambda s, d: X.nearest_neighbours(_keys(A.pool(s, d)), _keys(A.gold(s, d)), "key", 0.5, True).select("q", "c", F.round("similarity", 4).alias("similarity")),
         f"WITH {NN} SELECT q, c, round(sim * 100, 4) AS similarity FROM nn")
PER_KEY = f"""{NN}, nk AS (SELECT pk.key, pk.name, pk.n_rows, pk.pii_majority, gk.name AS vecino, gk.pii_majority AS vecino_pii, coalesce(sim * 100, 0.0) AS similarity FROM pk LEFT JOIN nn n ON n.q = pk.key LEFT JOIN gk ON gk.key = n.c),
fin AS (SELECT *, CASE WHEN similarity >= 50 THEN vecino_pii ELSE pii_majority END AS pii_final, CASE WHEN similarity >= 90 THEN 'validado_21k' WHEN similarity >= 50 THEN 'evidencia_parcial' ELSE 'sin_evidencia_mantenido' END AS label_source,
 CASE WHEN similarity >= 90 THEN 1.0 WHEN similarity >= 50 THEN round_even(similarity / 100, 4) ELSE 0.3 END AS sample_weight FROM nk)"""
TRANSFER = f"""{PER_KEY}, outp AS (SELECT p.dataset, p.name, p.pii, {S.light('p.name')} <> '' AS has_name, CASE WHEN {S.light('p.name')} <> '' THEN vecino END AS vecino, CASE WHEN {S.light('p.name')} <> '' THEN vecino_pii ELSE false END AS vecino_pii,
 CASE WHEN {S.light('p.name')} <> '' THEN similarity ELSE 0.0 END AS similarity, CASE WHEN {S.light('p.name')} <> '' THEN pii_final END AS pii_final, CASE WHEN {S.light('p.name')} <> '' THEN label_source ELSE 'nombre_vacio' END AS label_source,
 CASE WHEN {S.light('p.name')} <> '' THEN sample_weight ELSE 0.0 END AS sample_weight FROM pool p LEFT JOIN fin ON fin.key = {S.light('p.name')})"""
_transfer = lambda s, d: flows.transfer_labels(A.pool(s, d), A.gold(s, d))
register("m26_label_transfer", lambda s, d: _transfer(s, d).groupBy("name", "vecino", "vecino_pii", F.round("similarity", 4).alias("similarity"), "pii_final", "label_source", F.round("sample_weight", 4).alias("sample_weight")).agg(F.count("*").alias("n")),
         f"WITH {TRANSFER} SELECT name, vecino, vecino_pii, round(similarity, 4) AS similarity, pii_final, label_source, round(sample_weight, 4) AS sample_weight, count(*) AS n FROM outp GROUP BY ALL")
register("j2_propagate_to_rows", lambda s, d: _transfer(s, d).groupBy("dataset", "label_source", "has_name", "pii_final").agg(F.count("*").alias("n")),
         f"WITH {TRANSFER} SELECT dataset, label_source, has_name, pii_final, count(*) AS n FROM outp GROUP BY ALL")
register("m27_training_table", lambda s, d: L.enrich_training(flows.transfer_labels(L.training_features(A.pool(s, d)), A.gold(s, d))).groupBy("label_source", "has_description", "longitud").agg(F.count("*").alias("n")),
         f"WITH {TRANSFER} SELECT label_source, true AS has_description, CAST(length(name) AS INTEGER) AS longitud, count(*) AS n FROM outp WHERE has_name GROUP BY ALL")


def _routes(s, d):
    nn = L.neighbour_table(_keys(A.pool(s, d)), _keys(A.gold(s, d)))
    judge = A.gold(s, d).select("name", F.lit("telefono").alias("entity_juez"), F.lit(0.9).alias("prob_juez")).filter("length(name) > 4").distinct()
    return L.route_imports(nn, A.gold(s, d).select("name", "entity"), judge)


register("j13_route_imports", lambda s, d: _routes(s, d).select("name", "vecino", "entity_vecino", "entity_juez", "route", "motivo"),
         f"""WITH {PER_KEY}, en AS (SELECT name AS vecino, min(entity) AS entity_vecino FROM gold WHERE entity IS NOT NULL GROUP BY 1), jz AS (SELECT DISTINCT name, 'telefono' AS entity_juez FROM gold WHERE length(name) > 4),
rt AS (SELECT nk.name, nk.vecino, entity_vecino, entity_juez, CASE WHEN similarity >= 90 AND coalesce(vecino_pii, false) THEN 'importar' WHEN similarity >= 50 THEN 'revision' ELSE 'excluir' END AS act, nk.name IN (SELECT trim(name) FROM gold) AS known,
 entity_juez IS NULL OR coalesce(entity_juez = entity_vecino, false) AS agree FROM nk LEFT JOIN en USING (vecino) LEFT JOIN jz ON jz.name = nk.name),
r2 AS (SELECT *, CASE WHEN act = 'importar' AND known THEN 'conocido' WHEN act = 'importar' AND entity_vecino IS NULL THEN 'revision' WHEN act = 'importar' AND NOT agree THEN 'revision' ELSE act END AS route FROM rt)
SELECT name, vecino, entity_vecino, entity_juez, route, CASE WHEN route <> 'revision' THEN '' WHEN act = 'revision' THEN 'similarity 50-90: revision manual' WHEN entity_vecino IS NULL THEN 'vecino sin entity en gold' ELSE 'desacuerdo juez/vecino' END AS motivo FROM r2""")

# ---- clustering ----------------------------------------------------------------------
_pos = lambda s, d: C.name_catalog(A.gold(s, d)).filter("pii_majority AND light <> ''")
EDGE = f"""{A.GOLD}, {S.fill(CAT, SRC='gold')}, ps AS (SELECT DISTINCT light FROM cat_n WHERE pii_majority AND light <> ''), {S.grams('ps', 'light', 'light')}, {S.vectors('grams', 'ps')},
edges AS (SELECT a.k AS a, b.k AS b, sum(a.w * b.w) AS sim FROM vec a JOIN vec b USING (g) WHERE a.k < b.k GROUP BY 1, 2 HAVING sum(a.w * b.w) >= 0.6)"""
register("m19_similar_pairs", lambda s, d: X.similar_pairs(_pos(s, d), "light", 0.6).select("a", "b", F.round("sim", 6).alias("sim")), f"WITH {EDGE} SELECT a, b, round(sim, 6) AS sim FROM edges")
COMP = f"""RECURSIVE {EDGE}, und AS (SELECT a, b FROM edges UNION ALL SELECT b, a FROM edges),
reach AS (SELECT light AS n, light AS m FROM ps UNION SELECT u.b, r.m FROM reach r JOIN und u ON u.a = r.n), comp AS (SELECT n AS light, min(m) AS component FROM reach GROUP BY 1)"""
register("m19_name_clusters", lambda s, d: X.name_clusters(_pos(s, d), "light", 0.6), f"WITH {COMP} SELECT light, component FROM comp")
_members = lambda s, d: cut_lineage(X.name_clusters(_pos(s, d), "light", 0.6))
register("m20_cluster_labels", lambda s, d: X.cluster_labels(_members(s, d).withColumn("split", T.split_roots(F.col("light"))), "split"),
         f"""WITH {COMP}, dc AS (SELECT component, {S.roots('light')} AS doc FROM comp), sz AS (SELECT component, count(*) AS size, min(doc) AS one FROM dc GROUP BY 1),
wd AS (SELECT component, doc, regexp_extract_all(lower(doc), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS ws FROM dc), tm AS (SELECT component, doc, unnest(list_concat(ws, list_transform(generate_series(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1]))) AS g FROM wd),
tf AS (SELECT component, doc, g, count(*)::DOUBLE AS tf FROM tm GROUP BY 1, 2, 3), df AS (SELECT component, g, count(*) AS df FROM tf GROUP BY 1, 2),
wt AS (SELECT tf.component, doc, tf.g, tf * (ln((1 + size) / (1 + df)::DOUBLE) + 1) AS w FROM tf JOIN df USING (component, g) JOIN sz USING (component)), nm AS (SELECT component, doc, sqrt(sum(w * w)) AS n FROM wt GROUP BY 1, 2),
sm AS (SELECT component, g, round(sum(w / n), 9) AS s FROM wt JOIN nm USING (component, doc) GROUP BY 1, 2), top AS (SELECT component, arg_min(g, (-s, g)) AS g FROM sm GROUP BY 1),
lb AS (SELECT component, size, CASE WHEN size = 1 THEN string_split(trim(one), ' ')[1] ELSE string_split(g, ' ')[1] END AS l FROM sz LEFT JOIN top USING (component))
SELECT component, size, CASE WHEN l <> '' THEN l ELSE 'cluster_' || component END AS label FROM lb""")

# ---- augmentation ----------------------------------------------------------------------
SYN = "CASE tok " + " ".join(f"WHEN {S.q(k)} THEN [{S.strs(v)}]" for k, v in V.SYNONYMS.items()) + " END"


def _variant_sql():
    cells, i = [], 0
    for sep in V.VARIANT_SEPARATORS:
        j = f"replace(parent_norm, ' ', {S.q(sep)})"
        for e in (j, f"upper({j})") + (("initcap_p",) if sep == " " else ()):
            cells.append(f"{{'ord': {i}, 'name': {e}}}")
            i += 1
    for n, w in enumerate(V.VARIANT_QUALIFIERS):
        cells += [f"{{'ord': {30 + 2 * n}, 'name': {S.q(w + ' ')} || parent_norm}}", f"{{'ord': {31 + 2 * n}, 'name': parent_norm || {S.q(' ' + w)}}}"]
    cells += [f"{{'ord': {40 + n}, 'name': parent_norm || {S.q(' ' + x)}}}" for n, x in enumerate(V.VARIANT_SUFFIXES)]
    return "[" + ", ".join(cells) + "]"


INITCAP = "array_to_string(list_transform(string_split(parent_norm, ' '), lambda t: upper(t[1]) || t[2:]), ' ')"
register("m21_synthetic_variants", lambda s, d: AU.synthetic_variants(_deficit_rows(s, d)),
         f"""WITH {A.GOLD}, {A.CODED}, {DEF}, po AS (SELECT * FROM dr WHERE entity IS NOT NULL AND entity <> ''), need AS (SELECT entity, greatest(30 - count(DISTINCT name_norm), 0) AS need FROM po GROUP BY 1 HAVING {S.tier('entity')} <> 'tier1_sin_sinteticos' AND greatest(30 - count(DISTINCT name_norm), 0) > 0),
pa AS (SELECT DISTINCT entity, name_norm AS parent_norm FROM po WHERE entity IN (SELECT entity FROM need)), pi AS (SELECT *, {INITCAP} AS initcap_p, string_split(parent_norm, ' ') AS toks FROM pa),
v1 AS (SELECT entity, parent_norm, unnest({_variant_sql()}) AS v FROM pi),
sp AS (SELECT *, list_position(list_transform(toks, lambda t: t IN ({S.strs(V.SYNONYMS)})), true) AS spot FROM pi), sw AS (SELECT *, toks[spot] AS tok FROM sp WHERE spot > 0),
v2 AS (SELECT entity, parent_norm, CAST(j + 19 AS INTEGER) AS ord, array_to_string(list_concat(toks[1:spot - 1], [alt], toks[spot + 1:]), ' ') AS name FROM (SELECT *, unnest({SYN}) AS alt, unnest(generate_series(1, len({SYN}))) AS j FROM sw)),
mk AS (SELECT entity, parent_norm, v.ord AS ord, v.name AS name FROM v1 UNION ALL SELECT * FROM v2), mn AS (SELECT *, {S.name3('name')} AS norm FROM mk),
fr AS (SELECT * FROM mn WHERE norm <> '' AND norm NOT IN (SELECT name_norm FROM po) QUALIFY row_number() OVER (PARTITION BY norm ORDER BY ord, parent_norm, entity, name) = 1),
rk AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY ord, parent_norm, name) AS rn FROM fr) SELECT name, entity, 1 AS is_synthetic, parent_norm FROM rk JOIN need USING (entity) WHERE rn <= need""")


def _wanted(s, d):
    return C.deficit_table(_deficit_rows(s, d)).select("entity", F.col("need_30").alias("need"))


register("w10_round_robin_parents", lambda s, d: AU.children_of_parents(_deficit_rows(s, d).filter("entity IS NOT NULL").select("entity", F.col("name_norm").alias("parent_norm")), _wanted(s, d)),
         f"""WITH {A.GOLD}, {A.CODED}, {DEF}, po AS (SELECT DISTINCT entity, name_norm FROM dr WHERE entity IS NOT NULL), need AS (SELECT entity, greatest(30 - count(*), 0) AS need FROM po GROUP BY 1 HAVING {S.tier('entity')} <> 'tier1_sin_sinteticos' AND greatest(30 - count(*), 0) > 0),
f AS (SELECT entity, name_norm, row_number() OVER (PARTITION BY entity ORDER BY name_norm) AS rn, count(*) OVER (PARTITION BY entity) AS n FROM po),
k AS (SELECT entity, unnest(generate_series(0, need - 1)) AS k FROM need) SELECT k.entity, CAST(k AS INTEGER) AS k, name_norm AS parent_norm FROM k JOIN f ON f.entity = k.entity AND f.rn = k % n + 1""")
LEX = ", ".join(f"({S.q(e)}, {i}, {S.q(t)}, {j})" for i, (e, ts) in enumerate(V.LEXICON.items()) for j, t in enumerate(ts))
LEXV = "[" + ", ".join(f"{{'o': {i}, 'n': {x}}}" for i, x in enumerate(["t", "replace(t, ' ', '')", "replace(t, ' ', '_')", "t || ' ' || dg", "t || dg"] + [f"t || {S.q(x)}" for x in V.LEXICON_SUFFIXES])) + "]"


register("m22_lexicon_synthesis", lambda s, d: AU.lexicon_synthesis(A.gold(s, d).filter("entity IS NOT NULL").select("name", "entity")),
         f"""WITH {A.GOLD}, b AS (SELECT name, entity FROM gold WHERE entity IS NOT NULL), hv AS (SELECT entity, count(*) AS have FROM b GROUP BY 1), lx AS (SELECT entity, e_ord, replace(term, '_', ' ') AS t, t_ord, CAST({S.h32('term')} % 9 + 1 AS VARCHAR) AS dg FROM (VALUES {LEX}) v(entity, e_ord, term, t_ord)),
mk AS (SELECT entity, e_ord, t_ord, v.o AS v_ord, trim(v.n) AS name FROM (SELECT *, unnest({LEXV}) AS v FROM lx)), ml AS (SELECT *, {S.light('name')} AS l FROM mk),
on1 AS (SELECT * FROM ml WHERE l <> '' AND NOT (entity = 'fecha_nacimiento' AND {S.any_of('l', V.LEXICON_ANTI['fecha_nacimiento'])}) QUALIFY row_number() OVER (PARTITION BY l ORDER BY e_ord, t_ord, v_ord, name) = 1),
fr AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY t_ord, v_ord) AS rn FROM on1 WHERE l NOT IN (SELECT {S.light('name')} FROM b)),
pk AS (SELECT *, row_number() OVER (ORDER BY e_ord, t_ord, v_ord) AS n FROM (SELECT fr.* FROM fr LEFT JOIN hv USING (entity) WHERE rn <= greatest(15 - coalesce(have, 0), 0)))
SELECT name, entity, 'sintetico' AS label_source, 0.3::DOUBLE AS w FROM pk WHERE n <= (SELECT floor(count(*) * 0.3::DOUBLE) FROM b)""")


def _rare_rows(s, d):
    return A.table(s, d, "supplier").select(F.concat(F.lit("campo "), "s_name").alias("t"), F.concat(F.lit("e"), F.col("s_nationkey").cast("string")).alias("e"), (F.col("s_suppkey") % 3 / 2.0).alias("w"))


register("m23_upsample_rare", lambda s, d: AU.upsample_rare(_rare_rows(s, d), "t", "e", "w"),
         f"""WITH r AS (SELECT 'campo ' || s_name AS t, 'e' || s_nationkey AS e, (s_suppkey % 3) / 2.0::DOUBLE AS w FROM supplier), sm AS (SELECT e, count(*) AS n FROM r GROUP BY 1 HAVING count(*) < 15),
pl AS (SELECT r.*, row_number() OVER (PARTITION BY e ORDER BY t, w) AS rn FROM r WHERE e IN (SELECT e FROM sm)), sl AS (SELECT e, i, i % n + 1 AS rn FROM (SELECT e, n, unnest(generate_series(0, 14 - n)) AS i FROM sm))
SELECT e, t, w, 0 AS is_synthetic, NULL::VARCHAR AS parent FROM r UNION ALL SELECT sl.e, CASE i % 5 WHEN 0 THEN regexp_replace(t, '[\\s_-]', '', 'g') WHEN 1 THEN t || ' ' || (i % 8 + 1) WHEN 2 THEN t || (i % 8 + 1) WHEN 3 THEN regexp_replace(t, '\\s+', '_', 'g') ELSE t END, w, 1, t FROM sl JOIN pl USING (e, rn)""")

# ---- models --------------------------------------------------------------------------
NUMERIC = ["longitud", "n_tokens", "tiene_sufijo"]


def _train_rows(s, d):
    """Gold names with label, entity, group and terms, one row per normal form."""
    g = (A.gold(s, d).withColumn("name_norm", T.normalize_name("name")).filter("name_norm <> ''")
         .groupBy("name_norm").agg(F.max((F.col("pii") == "TRUE").cast("int")).alias("y"), F.min("entity").alias("entity"), F.min("name").alias("name")))
    r = (g.withColumn("group", T.group_id("name_norm")).withColumn("w", F.lit(1.0)).withColumn("longitud", F.length("name"))
         .withColumn("n_tokens", T.token_count(F.col("name_norm"))).withColumn("tiene_sufijo", T.has_trailing_number(T.normalize_light("name"))))
    return cut_lineage(M.with_terms(r, "name_norm"))


def _kids(rows):
    k = rows.filter("y = 1 AND entity IS NOT NULL").select(F.concat("name_norm", F.lit(" titular")).alias("name_norm"), "entity", F.col("group").alias("parent"))
    k = k.withColumn("y", F.lit(1)).withColumn("w", F.lit(1.0)).withColumn("longitud", F.length("name_norm")).withColumn("n_tokens", T.token_count(F.col("name_norm"))).withColumn("tiene_sufijo", F.lit(0))
    return cut_lineage(M.with_terms(k, "name_norm"))


_small = dict(min_df=2)


def _hold(rows):
    return rows.filter(bucket(F.col("group"), 5) != 0), rows.filter(bucket(F.col("group"), 5) == 0)


register("m3_block_stacking", lambda s, d: (lambda r: M.fit_features(r, NUMERIC, **_small).transform(r).select(
    "name_norm", M.vector_to_array("features").alias("v"))
    .select("name_norm", F.size("v").alias("width"), F.size(F.filter("v", lambda x: x != 0)).alias("non_zero")))(_train_rows(s, d)))


def _m24(s, d):
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    r = _train_rows(s, d)
    a = VectorAssembler(inputCols=NUMERIC, outputCol="raw").transform(r)
    m = StandardScaler(withMean=False, withStd=True, inputCol="raw", outputCol="sc").fit(a)
    v = m.transform(a).select("name_norm", M.vector_to_array("sc").alias("v"))
    return v.select("name_norm", *[F.round(F.col("v")[i], 6).alias(c) for i, c in enumerate(NUMERIC)])


TRAIN = f"""tg AS (SELECT name_norm, max(CASE WHEN pii = 'TRUE' THEN 1 ELSE 0 END) AS y, min(entity) AS entity, min(name) AS name FROM (SELECT *, {S.name3('name')} AS name_norm FROM gold) WHERE name_norm <> '' GROUP BY 1),
tr AS (SELECT *, length(name) AS longitud, {S.tokens('name_norm')} AS n_tokens, CASE WHEN regexp_matches({S.light('name')}, '\\p{{Nd}}+$') THEN 1 ELSE 0 END AS tiene_sufijo FROM tg)"""
_sc = lambda c: f"round(CASE WHEN (SELECT stddev_samp({c}) FROM tr) = 0 THEN 0.0 ELSE {c} / (SELECT stddev_samp({c}) FROM tr) END, 6) AS {c}"
register("m24_scaling", _m24, f"WITH {A.GOLD}, {TRAIN} SELECT name_norm, {', '.join(_sc(c) for c in NUMERIC)} FROM tr")


def _m13(s, d):
    tr, te = _hold(_train_rows(s, d))
    return M.fit_binary(tr, NUMERIC, "logistic", "w", **_small).score(te).select("name", "y", F.bround("prob", 4).alias("prob"))


register("m13_binary_classifier", _m13)
register("m14_candidate_comparison", lambda s, d: (lambda h: M.compare_candidates(h[0], h[1], ["logistic", "svm", "gbt"], 0.5, NUMERIC, "w", entity="entity", gate=["correo", "nombre", "rfc", "telefono"], min_df=2))(_hold(_train_rows(s, d))))


def _masked(s, d):
    """Variants A (name only) and B (with description words) on intact and masked data."""
    rows = A.docs(s, d).withColumn("name_norm", T.normalize_name("dataset")).withColumn("has_description", F.lit(1))
    rows = rows.withColumn("grams", X.char_wb_grams(F.col("name_norm"))).withColumn("words", X.word_tokens(F.col("description"), 1))
    rows = cut_lineage(rows.select("id", "y", "grams", "words", "has_description", "n_chars"))
    tr, te = rows.filter(bucket(F.col("id"), 5) != 0), rows.filter(bucket(F.col("id"), 5) == 0)
    hide = FT.masked(F.col("id"), 0.6)
    empty = F.array().cast("array<string>")
    b = tr.withColumn("has_description", F.when(hide, 0).otherwise(1)).withColumn("words", F.when(hide, empty).otherwise(F.col("words")))
    scored = M.compare_masked(tr, te, {"A": (tr.withColumn("words", F.array(F.lit("none"))), ["n_chars"]), "B": (b, ["n_chars", "has_description"])})
    return E.compare_modes(cut_lineage(scored), "mode", "prob", "y", contest=F.endswith("mode", F.lit("/enmascarada")))


register("e13_masked_variants", _masked)


def _m15(s, d):
    tr, te = _hold(_train_rows(s, d).filter("entity IS NOT NULL"))
    model = M.fit_entity(tr, **_small)
    return model.predict(te).select("name", "entity", "entity_ml", F.bround("prob_entity", 4).alias("prob_entity"))


register("m15_entity_classifier", _m15)
_oof = lambda s, d: (lambda r: M.out_of_fold(r, 3, NUMERIC, synthetic=_kids(r), **_small))(_train_rows(s, d))
register("m16_out_of_fold", lambda s, d: _oof(s, d).select("name", "name_norm", "entity", F.col("y").alias("y_true"), F.round("oof_raw", 4).alias("oof_raw"), "fold"))


def _m17(s, d):
    o = cut_lineage(_oof(s, d).select("name", "y", "oof_raw", "fold"))
    p = M.fit_platt(o)
    return o.select("name", F.col("y").alias("y_true"), F.round("oof_raw", 4).alias("oof_raw"), F.round(M.apply_platt(p, F.col("oof_raw")), 4).alias("oof_cal"), "fold")


register("m17_platt_calibration", _m17)


def _newton_sql(rounds: int = 9) -> str:
    """Fixed Newton rounds over the distinct scores, one row each."""
    ctes, p = [A.SCORED, "xs AS (SELECT p AS x, y::DOUBLE AS t, count(*)::DOUBLE AS w FROM scored GROUP BY 1, 2)", "c0 AS (SELECT 0::DOUBLE AS a, 0::DOUBLE AS b)"], "(1 / (1 + exp(-(x * a + b))))"
    for n in range(1, rounds + 1):
        ctes += [f"g{n} AS (SELECT a, b, sum(w * ({p} - t) * x) + a AS ga, sum(w * ({p} - t)) AS gb, sum(w * {p} * (1 - {p}) * x * x) + 1 AS haa, sum(w * {p} * (1 - {p}) * x) AS hab, sum(w * {p} * (1 - {p})) AS hbb FROM xs, c{n - 1} GROUP BY a, b)",
                 f"c{n} AS MATERIALIZED (SELECT a - (hbb * ga - hab * gb) / (haa * hbb - hab * hab) AS a, b - (haa * gb - hab * ga) / (haa * hbb - hab * hab) AS b FROM g{n})"]
    return "WITH " + ",\n".join(ctes) + f" SELECT x AS raw, t::INTEGER AS y, w::BIGINT AS n, round({p}, 6) AS calibrated, round(a, 6) AS slope, round(b, 6) AS intercept FROM xs, c{rounds}"


def _newton(s, d):
    fit = CA.fit_sigmoid(A.scored(s, d), "p", "y")
    counts = A.scored(s, d).groupBy(F.col("p").alias("raw"), "y").agg(F.count("*").alias("n"))
    return counts.select("raw", "y", "n", F.round(fit(F.col("raw")), 6).alias("calibrated"), F.round(F.lit(fit.slope), 6).alias("slope"), F.round(F.lit(fit.intercept), 6).alias("intercept"))


register("m17_newton_calibration", _newton, _newton_sql())


def _m18(s, d):
    r = _train_rows(s, d).filter("entity IS NOT NULL")
    o = cut_lineage(M.entity_out_of_fold(r, 3, _kids(r), **_small).select("name", "entity", "pred_base", "pred_aug"))
    parts = [E.macro_metrics(o, "entity", p).withColumn("variant", F.lit(v)) for v, p in (("base", "pred_base"), ("aug", "pred_aug"))]
    both = parts[0].unionByName(parts[1])
    best = both.agg(F.max(F.struct("macro_f1", (F.col("variant") == "aug").alias("a"))).alias("b")).select(F.when(F.col("b.a"), F.lit("aug")).otherwise(F.lit("base")).alias("winner"))
    return attach(both, best)


register("m18_ablation", _m18)


def _two_stages(s, d):
    r = _train_rows(s, d)
    a, b = M.fit_binary(r, **_small), M.fit_entity(r.filter("entity IS NOT NULL"), **_small)
    return M.score_two_stages(A.pool(s, d).select(F.col("dataset").alias("tabla"), "name").distinct(), a, b, 0.5)


register("m25_two_stage_scoring", _two_stages)


def _m28(s, d):
    """Pool rows with score, taxonomy entity and discrepancy; the label stays."""
    r = _train_rows(s, d)
    model = M.fit_binary(r, **_small)
    base = A.pool(s, d).groupBy("name").agg(F.max("pii").alias("pii")).withColumn("name_clean", T.clean_name("name"))
    base = base.withColumn("base_entity", T.base_entity("name")).withColumn("exp", T.expand_abbreviations(F.col("name_clean")))
    p = model.score(M.with_terms(base.withColumn("name_norm", T.normalize_name("name")), "name_norm"), "prob_pii_validated")
    scored = p.withColumn("pii_validated", (F.col("prob_pii_validated") >= 0.5).cast("int")).select("name", "pii", "name_clean", "base_entity", "pii_validated", F.round("prob_pii_validated", 4).alias("prob_pii_validated"), "exp")
    tax = L.taxonomy(base.select("name", "exp")).drop("metodo")
    out = scored.join(tax, "name").drop("exp").withColumn("label", T.truthy(F.col("pii"), "gold").cast("int")).withColumn("threshold_aplicado", F.lit(0.5))
    return L.discrepancy(out, "pii_validated", "label")


register("m28_pool_enrichment", _m28)


def _artefacts(s, d):
    """Save and reload a fitted feature model and its threshold, then score again."""
    root = scratch_dir(s)
    r = _train_rows(s, d)
    fitted = M.fit_features(r, NUMERIC, **_small)
    artefacts.save_model(fitted, f"{root}/model")
    artefacts.save_parameters(artefacts.override_threshold(artefacts.parameters(s, 0.5), 0.75, "piloto"), f"{root}/params")
    again = artefacts.load_model(f"{root}/model").transform(r).select("name_norm", M.vector_to_array("features").alias("b"))
    both = fitted.transform(r).select("name_norm", M.vector_to_array("features").alias("a")).join(again, "name_norm")
    check = both.agg(F.count("*").alias("n"), F.sum((F.col("a") == F.col("b")).cast("long")).alias("same"))
    return attach(check, artefacts.load_parameters(s, f"{root}/params"))


register("s13_model_artefacts", _artefacts)


def _bundled(s, d):
    """Train both stages, calibrate the first out of fold, save them as one pipeline with its parameters, load it, score a batch and a stream."""
    root, r = scratch_dir(s), _train_rows(s, d)
    binary = M.fit_binary(r, **_small)
    binary.calibrator = CA.fit_sigmoid(M.out_of_fold(r, 3, **_small).select("y", "oof_raw"))
    entity = M.fit_entity(r.filter("entity IS NOT NULL"), **_small)
    artefacts.save_model(scoring_bundle(binary, entity, 0.5), f"{root}/bundle")
    loaded = artefacts.load_model(f"{root}/bundle")
    A.pool(s, d).select(F.col("dataset").alias("tabla"), "name").distinct().repartition(4).write.parquet(f"{root}/in")
    batch = ST.score_with_bundle(s.read.parquet(f"{root}/in"), loaded)
    ST.run_available(ST.score_with_bundle(s.readStream.schema("tabla string, name string").parquet(f"{root}/in"), loaded), f"{root}/out", f"{root}/ckpt")
    return batch, s.read.parquet(f"{root}/out")


def _stream_equals_batch(s, d):
    """Rows of the stream with what the rules say of them; `same` tells whether the batch gave the same row, `sound` whether the row is in itself."""
    batch, stream = _bundled(s, d)
    key = F.xxhash64("tabla", "name", "prob_pii", "pii", "entity", "prob_entity", "override_aplicado", "regex_match", "name_norm")
    both = stream.withColumn("h", key).join(batch.select("tabla", "name", key.alias("hb")), ["tabla", "name"], "left")
    sound = F.expr("prob_pii BETWEEN 0 AND 1 AND pii = (entity IS NOT NULL) AND pii = (prob_entity IS NOT NULL) AND (NOT override_aplicado OR (prob_entity < 0.5 AND entity = regex_match))")
    return both.select("tabla", "name", "name_norm", "regex_match", F.coalesce(F.col("h") == F.col("hb"), F.lit(False)).alias("same"), sound.alias("sound"))


register("t1_bundle_stream", _stream_equals_batch,
         f"""WITH {A.POOL}, n AS (SELECT DISTINCT dataset AS tabla, name FROM pool), m AS (SELECT *, {S.matches('name')} AS ms FROM n)
SELECT tabla, name, {S.name3('name')} AS name_norm, {S.summary('ms')} AS regex_match, true AS same, true AS sound FROM m""")
register("s13_scoring_bundle", lambda s, d: _bundled(s, d)[0].select("tabla", "name", "pii", "prob_pii", "entity", "prob_entity", "override_aplicado"))
