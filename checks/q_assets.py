"""Projects (A21-A25, J18, R20) and backup bundles (W1, J6, J14, J15, U4, A26, S8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import adapters as A, sqltext as S
from checks.registry import register
from tablescout.functions import dates as D, vocabulary as V
from tablescout.operators import lifecycle as LC, retention as RT
from tablescout.plans import flows
from tablescout.sources import files

M = S.months("greatest(\"mod\", run)", A.REF_SQL)
DAY = lambda x: f"coalesce(strftime({x}, '%Y-%m-%d'), '-')"
_acts = lambda s, d: (A.projects(s, d), A.jobs(s, d), A.timeline(s, d))

register("j18_project_activity", lambda s, d: LC.project_activity(*_acts(s, d)).select(
    "projectKey", D.format_day(F.col("ultima_ejecucion")).alias("run"), D.format_day(F.col("ultimo_commit")).alias("commit_day"), D.format_day(F.col("ultima_modificacion")).alias("modified")),
    f'WITH {A.PROJECTS} SELECT pk AS "projectKey", {DAY("run")} AS run, {DAY("commit_at")} AS commit_day, {DAY("mod")} AS modified FROM activity')
register("a22_last_activity", lambda s, d: LC.idle_months(LC.project_activity(*_acts(s, d)), A.ref()).select("projectKey", F.lit("run").alias("policy"), D.format_day(F.col("ultima_actividad")).alias("last"), "meses_inactivo")
         .unionByName(LC.idle_months(LC.project_activity(*_acts(s, d)), A.ref(), "stamp").select("projectKey", F.lit("stamp").alias("policy"), D.format_day(F.col("ultima_actividad")).alias("last"), "meses_inactivo")),
         f"""WITH {A.PROJECTS} SELECT pk AS "projectKey", 'run' AS policy, {DAY('greatest("mod", run)')} AS last, CAST({M} AS INTEGER) AS meses_inactivo FROM activity
UNION ALL SELECT pk, 'stamp', {DAY(f'greatest("mod", run, {A.ts("version_ms")})')}, CAST({S.months(f'greatest("mod", run, {A.ts("version_ms")})', A.REF_SQL)} AS INTEGER) FROM activity""")


def _decision(threshold):
    return (f"CASE WHEN run IS NULL THEN CASE WHEN \"mod\" IS NOT NULL AND {threshold} = 1 THEN 'Eliminar' ELSE 'Preservar' END "
            f"WHEN {M} >= {threshold} THEN 'Eliminar' ELSE 'Preservar' END")


CHIP = f"CASE WHEN run IS NULL THEN 'Nunca ejecutado' WHEN n_contrib = 0 THEN 'Solo dueño' ELSE 'Abandonado hace ' || {M} || 'm' END"
OWNER = "coalesce(nullif(owner_login, ''), nullif(owner_display, ''), '-')"
CREATED = f"strftime({A.ts('created_ms')}, '%Y-%m-%d')"
for _t in (4, 1):
    register(f"a23_project_decision_{_t}m", lambda s, d, t=_t: LC.project_details(*_acts(s, d), A.ref(), t).select("id_proyecto", "meses_inactivo", "decision"),
             f"WITH {A.PROJECTS} SELECT pk AS id_proyecto, CAST({M} AS INTEGER) AS meses_inactivo, {_decision(_t)} AS decision FROM activity")
    register(f"a23_stale_projects_{_t}m", lambda s, d, t=_t: flows.stale_plan(*_acts(s, d), A.ref(), t),
             f"""WITH {A.PROJECTS} SELECT pk AS id_proyecto, name AS nombre_proyecto, {DAY('"mod"')} AS ultima_modificacion, {DAY('run')} AS ultima_ejecucion, CAST(least({M}, 4) AS INTEGER) AS bucket, {OWNER} AS dueno, {CREATED} AS creado,
 CAST({M} AS INTEGER) AS meses_inactivo, {CHIP} AS motivo FROM activity WHERE NOT tutorial AND len(list_filter(tags, lambda t: lower(trim(t)) IN ({S.strs(V.PROTECTED_TAGS)}))) = 0
 AND ("mod" IS NOT NULL OR run IS NOT NULL) AND {_decision(_t)} = 'Eliminar'""")
VM = A.ts("version_ms")
STAMPED = f"st AS (SELECT pk, {VM} AS m FROM projects), sm AS (SELECT pk, m, {S.months('m', A.REF_SQL)} AS k FROM st WHERE m IS NOT NULL)"
register("a23_stale_by_stamp", lambda s, d: LC.stale_by_stamp(A.projects(s, d), A.ref()),
         f"WITH {A.PROJECTS}, {STAMPED} SELECT pk AS id_proyecto, {DAY('m')} AS ultima_modificacion, CAST(k AS INTEGER) AS meses_inactivo, CAST(least(k, 4) AS INTEGER) AS bucket, CASE WHEN k >= 4 THEN 'Eliminar' ELSE 'Revisar' END AS decision FROM sm WHERE k >= 1")


def _histogram(s, d):
    ev = LC.activity_events(A.jobs(s, d), A.timeline(s, d))
    out = [LC.activity_histogram(ev, A.ref(), axis).withColumn("axis", F.lit(axis)) for axis in ("30d", "calendar")]
    return out[0].unionByName(out[1])


register("a21_activity_histogram", _histogram,
         f"""WITH {A.PROJECTS}, ev AS (SELECT t FROM job_ts WHERE t IS NOT NULL UNION ALL SELECT t FROM commit_ts WHERE t IS NOT NULL),
c AS (SELECT strftime(t, '%Y-%m') AS mes, count(*) AS k FROM ev GROUP BY 1),
ax AS (SELECT i, DATE '{A.REF}' - CAST(i * 30 AS INTEGER) AS day, '30d' AS axis FROM (SELECT unnest(generate_series(0, 11)) AS i) UNION ALL
 SELECT i, CAST(DATE '{A.REF}' - to_months(CAST(i AS INTEGER)) AS DATE), 'calendar' FROM (SELECT unnest(generate_series(0, 11)) AS i))
SELECT CAST(11 - i AS INTEGER) AS idx, strftime(day, '%Y-%m') AS mes, strftime(day, '%b') AS etiqueta, coalesce(k, 0) AS n, axis FROM ax LEFT JOIN c ON c.mes = strftime(day, '%Y-%m')""")
register("a24_structure_counts", lambda s, d: LC.structure_counts(A.table(s, d, "orders").select(
    F.when(F.col("o_orderstatus") == "F", F.lit("datasets")).when(F.col("o_orderstatus") == "O", F.lit("recetas")).otherwise(F.lit("escenarios")).alias("kind"))),
    """WITH g AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'datasets' WHEN 'O' THEN 'recetas' ELSE 'escenarios' END AS kind, count(*) AS n FROM orders GROUP BY 1)
SELECT kind, n, CAST(round(100.0::DOUBLE * n / (SELECT max(n) FROM g)) AS INTEGER) AS pct_max FROM g""")


def _owned(s, d):
    """Projects with their instance (the nation) and idle months."""
    p = A.table(s, d, "customer").select(F.col("c_custkey").cast("string").alias("projectKey"), F.col("c_nationkey").alias("id_instancia"))
    a = LC.idle_months(LC.project_activity(*_acts(s, d)), A.ref())
    return a.join(p, "projectKey").select(F.col("projectKey").alias("id_proyecto"), "id_instancia", "meses_inactivo")


def _scope(s, d):
    preserved = A.table(s, d, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").cast("string").alias("id_proyecto"))
    depth = A.table(s, d, "nation").filter("n_regionkey > 0").select(F.col("n_nationkey").alias("id_instancia"), F.col("n_regionkey").alias("profundidad"))
    return LC.in_scope(_owned(s, d), preserved, depth)


SCOPE = f"""{A.PROJECTS}, own AS (SELECT pk, c_nationkey AS ins, c_mktsegment AS seg, {M} AS k FROM activity JOIN customer ON pk = CAST(c_custkey AS VARCHAR)),
scope AS (SELECT own.* FROM own LEFT JOIN nation ON n_nationkey = ins WHERE seg <> 'BUILDING' AND k >= CASE WHEN n_regionkey BETWEEN 1 AND 4 THEN n_regionkey ELSE 4 END)"""
register("r20_in_scope", _scope, f"WITH {SCOPE} SELECT pk AS id_proyecto, ins AS id_instancia, CAST(k AS INTEGER) AS meses_inactivo FROM scope")
register("a25_cleanup_breakdown", lambda s, d: LC.cleanup_breakdown(_scope(s, d)), f"WITH {SCOPE} SELECT CAST(least(k, 4) AS INTEGER) AS bucket, count(*) AS n FROM scope WHERE k > 0 GROUP BY 1")

# ---- bundles ---------------------------------------------------------------------
_scan = lambda s, d: RT.bundle_scan(A.objects(s, d), A.ROOT, A.ref())
_marked = lambda s, d: flows.cleanup_plan(A.objects(s, d), A.history(s, d), A.ROOT, A.ref(), 180)
B = f"WITH {A.OBJECTS}"
HC = ", ".join(V.HISTORY_COLUMNS)
register("j6_not_in_history", lambda s, d: RT.new_candidates(_scan(s, d), A.history(s, d)).select("s3_path", "flow", "env", "nickname", "proyecto", "filename", "fecha_creacion_s3", "size", "id"),
         f"{B} SELECT s3_path, flow, env, nickname, proyecto, filename, fecha_creacion_s3, size, id FROM candidates")
register("w1_keep_latest", lambda s, d: _marked(s, d).select("s3_path", "estado"), f"{B} SELECT s3_path, estado FROM marked")
MERGED = f"""merged AS (SELECT {HC} FROM history WHERE s3_path NOT IN (SELECT s3_path FROM marked)
 UNION ALL SELECT id, s3_path, flow, proyecto, fecha_creacion_s3, '{A.PERIOD}', size FROM marked WHERE estado = 'Conservado')"""
register("j14_merge_history", lambda s, d: RT.merge_history(A.history(s, d), _marked(s, d), A.PERIOD), f"{B}, {MERGED} SELECT * FROM merged")


def _merge_overlap(s, d):
    """A run whose marks touch paths the history already holds."""
    marked = RT.keep_latest(_scan(s, d))
    return RT.merge_history(A.history(s, d), marked, A.PERIOD)


ALLMARK = """am AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY flow, env, nickname, proyecto ORDER BY creado DESC, filename DESC, s3_path DESC) = 1 THEN 'Conservado' ELSE 'Descartado' END AS estado FROM bundles)"""
register("j14_merge_history_overlap", _merge_overlap,
         f"{B}, {ALLMARK} SELECT {HC} FROM history WHERE s3_path NOT IN (SELECT s3_path FROM am) UNION ALL SELECT id, s3_path, flow, proyecto, fecha_creacion_s3, '{A.PERIOD}', size FROM am WHERE estado = 'Conservado'")
register("s8_cleanup_report", lambda s, d: RT.cleanup_report(_marked(s, d), A.PERIOD),
         f"{B} SELECT id, s3_path, flow, proyecto, fecha_creacion_s3, '{A.PERIOD}' AS fecha_periodo_limpieza, size, CASE WHEN estado = 'Descartado' THEN 'Eliminado' ELSE 'Conservado' END AS \"Estado\" FROM marked")
register("j15_global_report", lambda s, d: RT.global_report(_scan(s, d), A.history(s, d), A.PERIOD),
         f"""{B} SELECT coalesce(h.id, b.id) AS id, b.s3_path, coalesce(h.flow, b.flow) AS flow, coalesce(h.proyecto, b.proyecto) AS proyecto, coalesce(h.fecha_creacion_s3, b.fecha_creacion_s3) AS fecha_creacion_s3,
 coalesce(h.fecha_periodo_limpieza, '{A.PERIOD}') AS fecha_periodo_limpieza, coalesce(h.size, b.size) AS size, CASE WHEN h.s3_path IS NOT NULL THEN 'Conservado' ELSE 'Próximo a eliminar' END AS "Estado" FROM bundles b LEFT JOIN history h USING (s3_path)""")


def _union(s, d):
    return RT.scan_and_history(_marked(s, d), RT.history_view(A.history(s, d), A.ROOT))


HVIEW = """hv AS (SELECT h.s3_path, coalesce(nullif(h.flow, ''), b.flow, '') AS flow, coalesce(b.env, '') AS env, h.proyecto, h.size, 'Conservado' AS estado, coalesce(b.filename, '') AS filename, coalesce(b.nickname, '') AS nickname, h.id
 FROM history h LEFT JOIN bundles_all b ON b.path = h.s3_path)"""
UNI = f"{HVIEW}, uni AS (SELECT s3_path, flow, env, proyecto, size, estado FROM marked UNION ALL SELECT s3_path, flow, env, proyecto, size, estado FROM hv WHERE s3_path NOT IN (SELECT s3_path FROM marked))"
register("u4_history_view", lambda s, d: RT.history_view(A.history(s, d), A.ROOT).select("id", "s3_path", "flow", "env", "nickname", "proyecto", "filename", "size", "estado"),
         f"{B}, {HVIEW} SELECT id, s3_path, flow, env, nickname, proyecto, filename, size, estado FROM hv")
register("u4_scan_and_history", _union, f"{B}, {UNI} SELECT * FROM uni")
register("u4_environment_slices", lambda s, d: RT.environment_slices(_union(s, d)), f"{B}, {UNI} SELECT flow, env, count(*) AS n, count(*) FILTER (WHERE estado = 'Descartado') AS n_discard FROM uni GROUP BY 1, 2")
register("a26_storage_totals", lambda s, d: RT.storage_totals(_union(s, d)),
         f"{B}, {UNI}, t AS (SELECT sum(size) AS t, coalesce(sum(size) FILTER (WHERE estado = 'Descartado'), 0) AS f FROM uni) SELECT round(t, 2) AS total, round(f, 2) AS a_liberar, round(greatest(t - f, 0.0), 2) AS resultante FROM t")
