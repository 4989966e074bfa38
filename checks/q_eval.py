"""Evaluation (E), running sums (W11, W7), splits and encoders (M4-M12, J7, J8, U3) and streams (T)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import adapters as A, sqltext as S
from checks.q_catalog import BIN, _bin
from checks.q_names import DECIDED
from tablescout.operators import labels as LB
from checks.registry import register
from tablescout.functions import vocabulary as V
from tablescout.operators import evaluate as E, features as FT, splits as SP
from tablescout.session import Rounds, scratch_dir
from tablescout.streaming import streams as ST

W = f"WITH {A.SCORED}"
_s = A.scored


def rates(tp="tp", fp="fp", fn="fn"):
    return {"precision": S.ratio(tp, f"{tp} + {fp}"), "recall": S.ratio(tp, f"{tp} + {fn}"), "f1": S.ratio(f"2 * {tp}", f"2 * {tp} + {fp} + {fn}"),
            "f2": S.ratio(f"5 * {tp}", f"5 * {tp} + {fp} + 4 * {fn}")}


def grid_cte(ts, digits=6, name="grid", full=False):
    vals = ", ".join(f"({t}::DOUBLE)" for t in ts)
    r = rates()
    if full:
        r["accuracy"] = "(tp + tn) / CAST(tp + tn + fp + fn AS DOUBLE)"
        r["especificidad"] = S.ratio("tn", "tn + fp")
    cells = ", ".join(f"round({e}, {digits}) AS {k}" for k, e in r.items())
    return f"""{name}_c AS (SELECT thr, count(*) FILTER (WHERE y = 1 AND p >= thr) AS tp, count(*) FILTER (WHERE y = 0 AND p >= thr) AS fp, count(*) FILTER (WHERE y = 1 AND p < thr) AS fn,
 count(*) FILTER (WHERE y = 0 AND p < thr) AS tn FROM scored, (VALUES {vals}) v(thr) GROUP BY thr), {name} AS (SELECT thr, tp, fp, fn, tn, {cells} FROM {name}_c)"""


register("e1_threshold_grid", lambda s, d: E.threshold_grid(_s(s, d), "p", "y"), f"{W}, {grid_cte(V.GRID_THRESHOLDS)} SELECT * FROM grid")
register("e2_best_f2", lambda s, d: E.best_threshold(E.threshold_grid(_s(s, d), "p", "y"), "thr", "f2"), f"{W}, {grid_cte(V.GRID_THRESHOLDS)} SELECT * FROM grid ORDER BY f2 DESC, thr LIMIT 1")
CURVE = f"""sc AS (SELECT p, sum(y)::BIGINT AS pos, count(*) AS n FROM scored GROUP BY p),
cum AS (SELECT p AS threshold, pos, n, sum(pos) OVER (ORDER BY p DESC)::BIGINT AS tp, sum(n) OVER (ORDER BY p DESC)::BIGINT AS hit, (SELECT sum(pos) FROM sc)::BIGINT AS tot FROM sc),
cur0 AS (SELECT threshold, tp, hit - tp AS fp, tot - tp AS fn FROM cum), curve AS (SELECT threshold, tp, fp, {', '.join(f'{e} AS {k}' for k, e in rates().items())} FROM cur0)"""
register("w11_cumulative_counts", lambda s, d: E.cumulative_counts(_s(s, d), "p", "y").select(F.round("score", 6).alias("score"), "pos", "n", "tp", "hit"),
         f"{W}, {CURVE} SELECT round(threshold, 6) AS score, pos, n, tp, hit FROM cum")
register("w11_pr_curve", lambda s, d: E.precision_recall_curve(_s(s, d), "p", "y").select(*[F.round(c, 6).alias(c) for c in ("threshold", "precision", "recall", "f1", "f2")], "tp", "fp"),
         f"{W}, {CURVE} SELECT round(threshold, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, round(f2, 6) AS f2, tp, fp FROM curve")
register("e2_threshold_below_best", lambda s, d: E.threshold_below_best_f2(E.precision_recall_curve(_s(s, d), "p", "y")).select(*[F.round(c, 6).alias(c) for c in ("thr_f2", "f2max", "prec_en_thr", "rec_en_thr")]),
         f"""{W}, {CURVE}, b AS (SELECT * FROM curve ORDER BY round(f2, 9) DESC, threshold LIMIT 1) SELECT round(coalesce((SELECT max(c.threshold) FROM curve c WHERE c.threshold < b.threshold), b.threshold), 6) AS thr_f2, round(f2, 6) AS f2max,
 round(precision, 6) AS prec_en_thr, round(recall, 6) AS rec_en_thr FROM b""")
register("e3_best_f1", lambda s, d: E.best_threshold(E.precision_recall_curve(_s(s, d), "p", "y"), "threshold", "f1").select(F.round("threshold", 6).alias("threshold"), F.round("f1", 6).alias("f1"), "tp", "fp"),
         f"{W}, {CURVE} SELECT round(threshold, 6) AS threshold, round(f1, 6) AS f1, tp, fp FROM curve ORDER BY round(curve.f1, 9) DESC, curve.threshold LIMIT 1")
REC = f"""{W}, {grid_cte(V.RECOMMEND_THRESHOLDS)} SELECT *, recall >= @R@ AND precision >= @P@ AS feasible FROM grid ORDER BY recall >= @R@ AND precision >= @P@ DESC, f2 DESC, thr LIMIT 1"""
register("e4_recommended_threshold", lambda s, d: E.recommended_threshold(E.threshold_grid(_s(s, d), "p", "y", V.RECOMMEND_THRESHOLDS)), S.fill(REC, R="0.88", P="0.3"))
register("e4_recommended_strict", lambda s, d: E.recommended_threshold(E.threshold_grid(_s(s, d), "p", "y", V.RECOMMEND_THRESHOLDS), 0.5, 0.9), S.fill(REC, R="0.5", P="0.9"))
register("e5_confusion", lambda s, d: E.confusion(_s(s, d), "p", "y", V.MODEL_THRESHOLD), f"{W}, {grid_cte([0.667], 4, full=True)} SELECT * FROM grid")
register("e6_threshold_sweep", lambda s, d: E.threshold_grid(_s(s, d), "p", "y", V.SWEEP_THRESHOLDS, True, 4), f"{W}, {grid_cte(V.SWEEP_THRESHOLDS, 4, full=True)} SELECT * FROM grid")
register("e7_recall_by_entity", lambda s, d: E.recall_by_entity(_s(s, d), "p", "y", "entity", 0.5), f"{W} SELECT entity, count(*) AS n, round(avg(CASE WHEN p >= 0.5 THEN 1.0::DOUBLE ELSE 0.0 END), 6) AS recall FROM scored WHERE y = 1 GROUP BY 1")
register("e7_gate_recall", lambda s, d: E.gate_recall(_s(s, d), "p", "y", "entity", 0.1, ["OR", "FR", "XX"], 0.8),
         f"""{W}, g AS (SELECT * FROM (VALUES ('OR'), ('FR'), ('XX')) v(entity)), r AS (SELECT entity, count(*) AS n, round(avg(CASE WHEN p >= 0.1 THEN 1.0::DOUBLE ELSE 0.0 END), 6) AS recall FROM scored WHERE y = 1 GROUP BY 1)
SELECT entity, coalesce(n, 0) AS n, recall, coalesce(recall >= 0.8, false) AS pass FROM g LEFT JOIN r USING (entity)""")
CLASSES = """cls AS (SELECT DISTINCT truth AS class FROM scored UNION SELECT DISTINCT pred FROM scored),
per AS (SELECT class, (SELECT count(*) FROM scored WHERE truth = class) AS support, (SELECT count(*) FROM scored WHERE truth = class AND pred = class) AS tp, (SELECT count(*) FROM scored WHERE pred = class) AS predicted FROM cls),
met AS (SELECT class, support, tp, @P@ AS precision, @R@ AS recall, @F@ AS f1 FROM per)"""
CLASSES = S.fill(CLASSES, P=f"round({S.ratio('tp', 'predicted')}, 6)", R=f"round({S.ratio('tp', 'support')}, 6)", F=f"round({S.ratio('2 * tp', 'support + predicted')}, 6)")
register("e8_class_metrics", lambda s, d: E.class_metrics(_s(s, d), "truth", "pred"), f"{W}, {CLASSES} SELECT * FROM met")
register("e8_macro_metrics", lambda s, d: E.macro_metrics(_s(s, d), "truth", "pred"), f"{W}, {CLASSES} SELECT round(avg(f1), 6) AS macro_f1, round(avg(recall), 6) AS macro_recall, round(sum(tp) / sum(support)::DOUBLE, 6) AS accuracy, count(*) AS n_classes FROM met")
AP = "round(sum(CAST(pos AS DOUBLE) / tot * tp / hit), 6)"
register("e9_average_precision", lambda s, d: E.average_precision(_s(s, d), "p", "y"), f"{W}, {CURVE} SELECT {AP} AS pr_auc FROM cum")
register("e10_brier", lambda s, d: E.brier(_s(s, d), "p", "y"), f"{W} SELECT round(avg((p - y) * (p - y)), 6) AS brier FROM scored")
ECE = "(SELECT round(sum(abs(pos - s) / tot), 6) FROM (SELECT least(floor(p * 10), 9) AS b, sum(y) AS pos, sum(p) AS s, (SELECT count(*) FROM scored) AS tot FROM scored GROUP BY 1))"
register("e10_calibration_error", lambda s, d: E.calibration_error(_s(s, d), "p", "y"), f"{W} SELECT {ECE} AS ece")


def _gate_metrics(s, d):
    row = E.threshold_grid(_s(s, d), "p", "y", [0.5]).select("recall", "precision", "f1")
    out = E.long_metrics(row, "model").unionByName(E.long_metrics(E.brier(_s(s, d), "p", "y"), "model"))
    return E.quality_gates(out.select("metric", "value"))


GV = " UNION ALL ".join(f"SELECT {S.q(m)} AS metric, {S.q(o)} AS op, {b}::DOUBLE AS bound" for m, o, b in V.QUALITY_GATES)
register("e11_quality_gates", _gate_metrics,
         f"""{W}, {grid_cte([0.5])}, mv AS (SELECT 'recall' AS metric, recall AS value FROM grid UNION ALL SELECT 'precision', precision FROM grid UNION ALL SELECT 'f1', f1 FROM grid
 UNION ALL SELECT 'brier', round(avg((p - y) * (p - y)), 6) FROM scored), gv AS ({GV}) SELECT gv.metric, value, op, bound, coalesce(CASE op WHEN '>=' THEN value >= bound WHEN '<=' THEN value <= bound ELSE value < bound END, false) AS pass FROM gv LEFT JOIN mv ON gv.metric = mv.metric""")
register("s9_metric_table", lambda s, d: E.long_metrics(E.macro_metrics(_s(s, d), "truth", "pred"), "value").unionByName(E.long_metrics(E.brier(_s(s, d), "p", "y"), "value")),
         f"""{W}, {CLASSES}, m AS (SELECT round(avg(f1), 6) AS a, round(avg(recall), 6) AS b, round(sum(tp) / sum(support)::DOUBLE, 6) AS c, count(*)::DOUBLE AS k FROM met)
SELECT 'macro_f1' AS metric, 'value' AS variant, a AS value FROM m UNION ALL SELECT 'macro_recall', 'value', b FROM m UNION ALL SELECT 'accuracy', 'value', c FROM m UNION ALL SELECT 'n_classes', 'value', k FROM m
UNION ALL SELECT 'brier', 'value', round(avg((p - y) * (p - y)), 6) FROM scored""")
register("e13_compare_modes", lambda s, d: E.compare_modes(_s(s, d), "mode", "p", "y"),
         f"""{W}, c AS (SELECT mode, count(*) FILTER (WHERE y = 1 AND p >= 0.5) AS tp, count(*) FILTER (WHERE y = 0 AND p >= 0.5) AS fp, count(*) FILTER (WHERE y = 1 AND p < 0.5) AS fn FROM scored GROUP BY 1),
fx AS (SELECT mode, round({rates()['recall']}, 3) AS recall, round({rates()['f1']}, 3) AS f1 FROM c), sc AS (SELECT mode, p, sum(y)::BIGINT AS pos, count(*) AS n FROM scored GROUP BY 1, 2),
cu AS (SELECT mode, p AS threshold, sum(pos) OVER w AS tp, sum(n) OVER w AS hit, sum(pos) OVER (PARTITION BY mode) AS tot FROM sc WINDOW w AS (PARTITION BY mode ORDER BY p DESC)),
c2 AS (SELECT mode, threshold, tp, hit - tp AS fp, tot - tp AS fn FROM cu), cv AS (SELECT mode, threshold, {', '.join(f'{e} AS {k}' for k, e in rates().items())} FROM c2),
bs AS (SELECT mode, arg_min(threshold, (-round(f2, 9), threshold)) AS tb FROM cv GROUP BY 1), op AS (SELECT mode, tb, f2 AS f2max, precision AS prec_en_thr, recall AS rec_en_thr,
 coalesce((SELECT max(threshold) FROM cv x WHERE x.mode = cv.mode AND x.threshold < tb), tb) AS thr_f2 FROM cv JOIN bs USING (mode) WHERE threshold = tb),
al AS (SELECT mode, recall, f1, round(f2max, 3) AS f2max, round(thr_f2, 3) AS thr_f2, round(prec_en_thr, 3) AS prec_en_thr, round(rec_en_thr, 3) AS rec_en_thr FROM fx JOIN op USING (mode))
SELECT *, mode = (SELECT arg_min(mode, (-f2max, -f1, mode)) FROM al) AS ganador FROM al""")
register("w7_ranked_errors", lambda s, d: E.ranked_errors(_s(s, d), "p", "y", 0.5, "name"),
         f"""{W}, r AS (SELECT name, round(p, 4) AS prob, y = 1 AS r, p >= 0.5 AS h FROM scored) SELECT * FROM (SELECT 'FN' AS kind, name, prob FROM r WHERE r AND NOT h ORDER BY prob DESC, name LIMIT 15)
UNION ALL SELECT * FROM (SELECT 'FP', name, prob FROM r WHERE h AND NOT r ORDER BY prob DESC, name LIMIT 15)""")


def _expected(s, d):
    from tablescout.operators import decisions as DE, labels as L
    r = DE.five_level_decision(DE.with_rule_levels(DE.with_dotted_keys(A.coded(s, d))))
    got = r.select("name", F.when(F.col("pii"), F.coalesce("prior_entity", F.lit("modelo"))).alias("entity")).distinct()
    expected = A.coded(s, d).select("name", F.when(F.length("name") % 2 == 0, F.lit("rfc")).otherwise(F.lit("modelo")).alias("expected_entity")).distinct()
    return L.expected_failures(got, expected)


register("e12_expected_failures", _expected,
         f"""{DECIDED}, got AS (SELECT DISTINCT name, CASE WHEN pii THEN coalesce(prior_entity, 'modelo') END AS e FROM decided),
ex AS (SELECT DISTINCT name, CASE WHEN length(name) % 2 = 0 THEN 'rfc' ELSE 'modelo' END AS expected_entity FROM coded)
SELECT ex.name, ex.expected_entity FROM ex WHERE NOT EXISTS (SELECT 1 FROM got WHERE got.name = ex.name AND got.e = ex.expected_entity)""")


def _regression(s, d):
    """Decisions of the coded names held against an entity list with wrong entries and a list of names that must stay unflagged."""
    from tablescout.operators import decisions as DE, labels as L
    r = DE.five_level_decision(DE.with_rule_levels(DE.with_dotted_keys(A.coded(s, d)))).select(
        "name", "pii", F.when(F.col("pii"), F.coalesce("prior_entity", F.lit("modelo"))).alias("entity"))
    names, third = A.coded(s, d).select("name").distinct(), F.length("name") % 3
    expected = names.filter(third != 0).select("name", F.when(third == 1, "rfc").otherwise("modelo").alias("expected_entity"))
    return L.regression_report(r, expected, names.filter(third == 0).select("name"))


REG = f"""{DECIDED}, got AS (SELECT name, bool_or(pii) AS got_pii, coalesce(list_sort(list(DISTINCT coalesce(prior_entity, 'modelo')) FILTER (WHERE pii)), []) AS got FROM decided GROUP BY 1),
ls AS (SELECT DISTINCT name, CASE length(name) % 3 WHEN 1 THEN 'rfc' WHEN 2 THEN 'modelo' END AS expected_entity FROM coded),
rp AS (SELECT name, expected_entity, got_pii, array_to_string(got, ',') AS got_entity, CASE WHEN expected_entity IS NULL THEN CASE WHEN got_pii THEN 'falso_positivo' ELSE 'ok' END
 WHEN NOT got_pii THEN 'no_marcado' WHEN NOT list_contains(got, expected_entity) THEN 'entidad' ELSE 'ok' END AS kind FROM ls JOIN got USING (name))"""
register("e12_regression_report", _regression, f"{REG} SELECT * FROM rp")
register("e12_regression_passes", lambda s, d: LB.regression_passes(_regression(s, d)),
         f"""{REG} SELECT count(*) AS n, count(*) FILTER (WHERE kind = 'no_marcado') AS no_marcado, count(*) FILTER (WHERE kind = 'entidad') AS entidad,
 count(*) FILTER (WHERE kind = 'falso_positivo') AS falso_positivo, count(*) FILTER (WHERE kind <> 'ok') = 0 AS pass FROM rp""")

# ---- splits ------------------------------------------------------------------------
GRP = f"""{BIN}, gt AS (SELECT group_id, CAST(avg(pii) >= 0.5 AS INTEGER) AS majority, {S.h32('group_id')} AS h FROM bin GROUP BY 1)"""
SPLIT = f"""{GRP}, sp AS (SELECT group_id, majority, CASE WHEN row_number() OVER (PARTITION BY majority ORDER BY h, group_id) <= round(count(*) OVER (PARTITION BY majority) * 0.2) THEN 'holdout' ELSE 'train' END AS split FROM gt)"""
_once = lambda s, d: Rounds(s, "binary").put("rows", _bin(s, d))  # read by the split and by each of its parts
_split_of = lambda b: SP.stratified_group_split(b, "group_id", "pii", 0.2)
_split = lambda s, d: _split_of(_bin(s, d))
register("m8_stratified_group_split", _split, f"WITH {SPLIT} SELECT * FROM sp")
register("j7_split_membership", lambda s, d: (lambda b: SP.split_part(b, _split_of(b), "group_id", "holdout").groupBy("pii").agg(F.count("*").alias("n"), F.countDistinct("group_id").alias("groups")))(_once(s, d)),
         f"WITH {SPLIT} SELECT pii, count(*) AS n, count(DISTINCT group_id) AS groups FROM bin WHERE group_id IN (SELECT group_id FROM sp WHERE split = 'holdout') GROUP BY 1")
register("u3_split_overlap", lambda s, d: (lambda b, g: SP.split_overlap(SP.split_part(b, g, "group_id", "train"), SP.split_part(b, g, "group_id", "holdout"), "group_id"))(*(lambda b: (b, _split_of(b)))(_once(s, d))),
         f"WITH {SPLIT} SELECT count(*) AS overlap FROM (SELECT group_id FROM bin WHERE group_id IN (SELECT group_id FROM sp WHERE split = 'train') INTERSECT SELECT group_id FROM bin WHERE group_id IN (SELECT group_id FROM sp WHERE split = 'holdout'))")
register("m9_slice_guarantee", lambda s, d: SP.slice_guaranteed_split(_bin(s, d), "group_id", "pii", "entity", 0.18),
         f"""WITH {GRP}, pr AS (SELECT DISTINCT entity, group_id, {S.h32('group_id')} AS h FROM bin WHERE pii = 1), pe AS (SELECT entity, count(*) AS k, arg_min(group_id, (h, group_id)) AS g FROM pr GROUP BY 1),
tg AS (SELECT gt.*, CASE WHEN group_id IN (SELECT g FROM pe WHERE k >= 2) THEN 'holdout' WHEN group_id IN (SELECT g FROM pe WHERE k = 1) THEN 'train' END AS forced FROM gt),
st AS (SELECT count(*) AS a, count(*) FILTER (WHERE forced = 'holdout') AS o, count(*) FILTER (WHERE forced IS NULL) AS f FROM tg), sh AS (SELECT greatest(0.01::DOUBLE, least(0.9::DOUBLE, (round(a * 0.18::DOUBLE) - o) / greatest(f, 1))) AS share FROM st)
SELECT group_id, majority, CASE WHEN row_number() OVER (PARTITION BY majority ORDER BY h, group_id) <= round(count(*) OVER (PARTITION BY majority) * share) THEN 'holdout' ELSE 'train' END AS split FROM tg, sh WHERE forced IS NULL
UNION ALL SELECT group_id, majority, forced FROM tg WHERE forced IS NOT NULL""")
register("m10_hash_folds", lambda s, d: _bin(s, d).select("name", SP.fold_of(F.col("group_id"), 3).alias("fold")), f"WITH {BIN} SELECT name, CAST({S.h32('group_id')} % 3 AS INTEGER) AS fold FROM bin")
register("m10_balanced_folds", lambda s, d: SP.balanced_folds(_bin(s, d), "group_id", 3),
         f"""WITH RECURSIVE {BIN}, z AS (SELECT group_id, count(*) AS n FROM bin GROUP BY 1), r AS MATERIALIZED (SELECT group_id, n, row_number() OVER (ORDER BY n DESC, {S.h32('group_id')}, group_id) AS p FROM z),
w(p, loads, f) AS (SELECT 0::BIGINT, [0, 0, 0]::BIGINT[], 0 UNION ALL
 SELECT r.p, list_transform(loads, lambda x, i: x + CASE WHEN i = list_position(loads, list_min(loads)) THEN r.n ELSE 0 END), list_position(loads, list_min(loads)) FROM w JOIN r ON r.p = w.p + 1)
SELECT group_id, n, CAST(f - 1 AS INTEGER) AS fold FROM r JOIN w USING (p)""")
register("m10_fold_count", lambda s, d: SP.fold_count(_bin(s, d).filter("pii = 1"), "entity", "group_id"),
         f"WITH {BIN} SELECT CAST(greatest(2, least(5, min(k))) AS INTEGER) AS n_splits FROM (SELECT count(DISTINCT group_id) AS k FROM bin WHERE pii = 1 GROUP BY entity)")
register("m11_leakage_key", lambda s, d: A.words(s, d).groupBy(SP.leakage_key(F.lower("name"), F.col("dataset")).alias("g")).agg(F.count("*").alias("n")),
         f"WITH {A.WORDS} SELECT lower(name) || '||' || dataset AS g, count(*) AS n FROM words GROUP BY 1")


def _children(s, d):
    b = _bin(s, d).withColumn("fold", SP.fold_of(F.col("group_id"), 3))
    folds = b.select("group_id", "fold").distinct()
    kids = b.filter("pii = 1").select(F.concat("name", F.lit(" titular")).alias("child"), F.col("group_id").alias("parent"))
    return SP.children_by_fold(kids, folds, "parent", "group_id", 3).groupBy("trains_fold").agg(F.count("*").alias("n"), F.countDistinct("parent").alias("parents"))


register("j8_children_by_fold", _children,
         f"WITH {BIN}, k AS (SELECT group_id, {S.h32('group_id')} % 3 AS f FROM bin WHERE pii = 1) SELECT CAST(t AS INTEGER) AS trains_fold, count(*) AS n, count(DISTINCT group_id) AS parents FROM k, (VALUES (0), (1), (2)) v(t) WHERE t <> f GROUP BY 1")

# ---- encoders ------------------------------------------------------------------------
_fold = lambda s, d: A.docs(s, d).withColumn("fold", SP.fold_of(F.col("id"), 5))
GLOB = "(SELECT sum(y * w) / sum(w) FROM docs)"
register("m4_target_encoding", lambda s, d: FT.target_encoding(A.docs(s, d), "dataset", "y", "w").select("dataset", "n", F.round("te", 6).alias("te")),
         f"WITH {A.DOCS} SELECT dataset, count(*) AS n, round((sum(y * w) / sum(w) * count(*) + 10.0 * {GLOB}) / (count(*) + 10.0), 6) AS te FROM docs GROUP BY 1")
register("m5_target_encoding_oof", lambda s, d: FT.target_encoding_oof(_fold(s, d), "dataset", "y", "w", "fold").select("dataset", "fold", F.round("te_oof", 6).alias("te_oof")),
         f"""WITH {A.DOCS}, f AS (SELECT *, CAST({S.h32('id')} % 5 AS INTEGER) AS fold FROM docs), p AS (SELECT DISTINCT dataset, fold FROM f),
o AS (SELECT p.dataset, p.fold, sum(y * w) AS sy, sum(w) AS sw, count(*) AS n FROM p JOIN f ON f.dataset = p.dataset AND f.fold <> p.fold GROUP BY 1, 2)
SELECT p.dataset, p.fold, round(coalesce((sy / sw * n + 10.0 * {GLOB}) / (n + 10.0), {GLOB}), 6) AS te_oof FROM p LEFT JOIN o USING (dataset, fold)""")
register("m6_one_hot_top", lambda s, d: FT.one_hot_top(A.docs(s, d), "id", "dataset", 7),
         f"WITH {A.DOCS}, t AS (SELECT dataset FROM docs GROUP BY 1 ORDER BY count(*) DESC, dataset LIMIT 7) SELECT id, 'typ_' || CASE WHEN dataset IN (SELECT dataset FROM t) THEN dataset ELSE 'OTROS' END AS category FROM docs")


def _dropped(s, d):
    r = A.docs(s, d).withColumn("has_description", F.col("description") != "")
    return FT.drop_description(r, "id", 0.6).select("id", "masked", "has_description", F.length("description").alias("chars"))


register("m7_description_dropout", _dropped,
         f"WITH {A.DOCS}, m AS (SELECT id, description, {S.h32(chr(39) + 'mask|' + chr(39) + ' || id')} % 1000 < 600 AS masked FROM docs) SELECT id, masked, NOT masked AND description <> '' AS has_description, CAST(CASE WHEN masked THEN 0 ELSE length(description) END AS INTEGER) AS chars FROM m")
register("m12_imbalance_weight", lambda s, d: FT.imbalance_weight(A.docs(s, d), "y", "w"),
         f"WITH {A.DOCS}, c AS (SELECT sum(y * w) AS p, sum((1 - y) * w) AS n FROM docs) SELECT round(p, 6) AS pos, round(n, 6) AS neg, round(n / greatest(p, 1.0), 6) AS scale_pos_weight FROM c")
register("m12_balanced_weights", lambda s, d: FT.balanced_weights(A.docs(s, d), "type").select("type", F.round("class_weight", 6).alias("class_weight")),
         f"WITH {A.DOCS} SELECT type, round((SELECT count(*) FROM docs) / ((SELECT count(DISTINCT type) FROM docs) * count(*)::DOUBLE), 6) AS class_weight FROM docs GROUP BY 1")

# ---- streams ---------------------------------------------------------------------------
def _stream_scores(s, d):
    root = scratch_dir(s)
    A.coded(s, d).select("id", "name", "prob").repartition(4).write.parquet(f"{root}/in")
    src = s.readStream.schema("id long, name string, prob double").parquet(f"{root}/in")
    ST.run_available(ST.score_names(src), f"{root}/out", f"{root}/ckpt")
    return s.read.parquet(f"{root}/out")


T1 = f"""{DECIDED}, tm AS (SELECT *, {S.matches('name')} AS ms FROM decided) SELECT id, name, prob, {S.name3('name')} AS name_norm, coalesce(ms[1], 'otro_pii') AS first_match, {S.summary('ms')} AS regex_match, pii, p AS prob_pii, reason FROM tm"""
register("t1_stream_scoring", _stream_scores, T1)
register("t1_batch_scoring", lambda s, d: ST.score_names(A.coded(s, d).select("id", "name", "prob")), T1)
DRIFT = f"""WITH {A.EVENTS}, w AS (SELECT date_trunc('day', ts) AS ws, count(*) AS n, round(avg(prob), 6) AS prob_mean, round(avg(CASE WHEN entity IS NULL THEN 1.0::DOUBLE ELSE 0.0 END), 6) AS no_entity_share,
 round(avg(CASE WHEN prob < 0.5 THEN 1.0::DOUBLE ELSE 0.0 END), 6) AS review_share FROM ev GROUP BY 1)"""
_day = lambda df: df.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd"))
register("a33_drift_windows", lambda s, d: _day(ST.drift_windows(A.events(s, d))), f"{DRIFT} SELECT strftime(ws, '%Y-%m-%d') AS window_start, n, prob_mean, no_entity_share, review_share FROM w")


def _stream_drift(s, d):
    root = scratch_dir(s)
    A.events(s, d).repartitionByRange(3, "ts").sortWithinPartitions("ts").write.parquet(f"{root}/in")
    src = s.readStream.schema("event_id long, ts timestamp, prob double, entity string").parquet(f"{root}/in")
    ST.run_available(ST.watermarked_drift(src), f"{root}/out", f"{root}/ckpt")
    return _day(s.read.parquet(f"{root}/out"))


register("t2_stream_drift", _stream_drift,
         f"{DRIFT} SELECT strftime(ws, '%Y-%m-%d') AS window_start, n, prob_mean, no_entity_share, review_share FROM w WHERE ws + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM ev)")
