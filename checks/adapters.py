"""Input tables of the operators, derived from the driver's tables.

Each adapter exists twice: a Spark projection and the CTE text DuckDB reads.
Whole tables and whole texts go in; the literals map values, they never filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import sqltext as S
from tablescout.functions import vocabulary as V

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
REF = "2001-12-01"
PERIOD = "2001-12-01"
ROOT = "vault"

# column names as found in the field, one per nation key
TERMS = ["telCasa", "fechaNacim", "num_cliente", "NUMCTE", "direcion", "correo-personal",
         "assignment_group.manager", "sys_created_by", "u_support_head", "number",
         "apellidopaterno", "sdo promedio", "cta cheques", "crd acct nbr", "aper cte016",
         "fecha venc", "telefonocasa", "rfc", "curp titular", "nss imss", "tel casa ict1",
         "e-mail", "car dlr", "actacons", "numdepend"]


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def rounded(c, digits: int):
    """Half away from zero of the scaled double, as DuckDB rounds; Spark's `round` takes the printed decimal (0.28855 to 0.2886, not 0.2885)."""
    y = F.abs(c) * float(10 ** digits)
    down = F.floor(y)
    return F.signum(c) * (down + F.when(y - down >= 0.5, 1).otherwise(0)) / float(10 ** digits)


def ms(c: str):
    return F.unix_millis(F.col(c).cast("timestamp"))


# ---- names -------------------------------------------------------------------
def coded(spark, d) -> DataFrame:
    """Coded column names with a model score, one row per customer."""
    seg, key = F.col("c_mktsegment"), F.col("c_custkey").cast("string")
    tail = (F.when(seg == "HOUSEHOLD", F.lit("")).when(seg == "MACHINERY", F.concat(F.lit("_"), key))
            .when(seg == "FURNITURE", F.lit(" ICT1")).when(seg == "AUTOMOBILE", key).otherwise(F.lit(" Titular")))
    terms = F.array(*[F.lit(t) for t in TERMS])
    classes = F.array(*[F.lit(e) for e in V.ENTITY_CLASSES])
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), seg.alias("tabla"),
        F.explode(F.array(F.concat(F.element_at(terms, F.col("c_nationkey") + 1), tail))).alias("name"),
        rounded(F.least(F.greatest(F.col("c_acctbal") / 10000, F.lit(0.0)), F.lit(1.0)), 4).alias("prob"),
        F.element_at(classes, (F.pmod("c_custkey", F.lit(23)) + 1).cast("int")).alias("entity_ml"),
        (F.pmod("c_custkey", F.lit(1000)) / 1000).alias("prob_entity"),
        (F.col("c_acctbal") > 2000).alias("own_pii"))


CODED = f"""coded AS (SELECT c_custkey AS id, c_mktsegment AS tabla,
  ([{S.strs(TERMS)}])[c_nationkey + 1] || CASE c_mktsegment WHEN 'HOUSEHOLD' THEN '' WHEN 'MACHINERY' THEN '_' || c_custkey
    WHEN 'FURNITURE' THEN ' ICT1' WHEN 'AUTOMOBILE' THEN CAST(c_custkey AS VARCHAR) ELSE ' Titular' END AS name,
  round(least(greatest(c_acctbal / 10000, 0.0), 1.0), 4) AS prob,
  ([{S.strs(V.ENTITY_CLASSES)}])[c_custkey % 23 + 1] AS entity_ml,
  (c_custkey % 1000) / 1000.0 AS prob_entity, c_acctbal > 2000 AS own_pii FROM customer)"""


def names(spark, d) -> DataFrame:
    """Every distinct short string of the tables: words, labels, codes, addresses."""
    t = lambda n: table(spark, d, n)
    parts = [t("conversations").select(F.explode(F.split("text", r"\s+")).alias("name")),
             t("customer").select("c_name"), t("supplier").select("s_name"), t("part").select("p_name"),
             t("part").select("p_brand"), t("nation").select("n_name"), t("region").select("r_name"),
             t("events").select("event_type"), t("orders").select("o_orderpriority"),
             t("pages").select("url"), coded(spark, d).select("name")]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.distinct()


NAMES = f"""{CODED},
names AS (SELECT DISTINCT name FROM (
  SELECT unnest(regexp_split_to_array(text, '\\s+')) AS name FROM conversations
  UNION ALL SELECT c_name FROM customer UNION ALL SELECT s_name FROM supplier UNION ALL SELECT p_name FROM part
  UNION ALL SELECT p_brand FROM part UNION ALL SELECT n_name FROM nation UNION ALL SELECT r_name FROM region
  UNION ALL SELECT event_type FROM events UNION ALL SELECT o_orderpriority FROM orders UNION ALL SELECT url FROM pages
  UNION ALL SELECT name FROM coded))"""


# ---- validated table and pool --------------------------------------------------
def gold(spark, d) -> DataFrame:
    """Words of the benchmark items with an entity by syllable; whole items of some
    lengths are labelled negative, so the same word can carry both labels."""
    w = table(spark, d, "benchmark").select(F.length("text").alias("n"), F.explode(F.split("text", r"\s+")).alias("name"))
    low = F.lower("name")
    ent = (F.when(low.contains("th"), F.lit("telefono")).when(low.contains("er"), F.lit("rfc"))
           .when(low.contains("on"), F.lit("nombre")).when(low.contains("in"), F.lit("correo")))
    pii = ent.isNotNull() & (F.pmod("n", F.lit(4)) != 0)
    return w.select(F.concat(F.lit("d"), F.pmod("n", F.lit(3)).cast("string")).alias("dataset"), "name",
                    F.when(pii, F.lit("TRUE")).otherwise(F.lit("FALSE")).alias("pii"),
                    F.when(pii, ent).alias("entity"))


GOLD = """gold AS (SELECT 'd' || (n % 3) AS dataset, name, CASE WHEN p THEN 'TRUE' ELSE 'FALSE' END AS pii,
  CASE WHEN p THEN e END AS entity FROM (SELECT n, name, e, e IS NOT NULL AND n % 4 <> 0 AS p FROM (
    SELECT n, name, CASE WHEN contains(lower(name), 'th') THEN 'telefono' WHEN contains(lower(name), 'er') THEN 'rfc'
      WHEN contains(lower(name), 'on') THEN 'nombre' WHEN contains(lower(name), 'in') THEN 'correo' END AS e
    FROM (SELECT length(text) AS n, unnest(regexp_split_to_array(text, '\\s+')) AS name FROM benchmark))))"""


def pool(spark, d) -> DataFrame:
    """Words of the conversations: speaker as data set, turn as type, turn text as description."""
    w = table(spark, d, "conversations").select(
        F.col("role").alias("dataset"), F.concat(F.lit("t"), F.col("turn").cast("string")).alias("type"),
        F.col("text").alias("description"), F.explode(F.split("text", r"\s+")).alias("name"))
    return w.select("dataset", "type", "description", "name",
                    F.when(F.pmod(F.length("name"), F.lit(2)) == 0, F.lit("TRUE")).otherwise(F.lit("FALSE")).alias("pii"))


POOL = """pool AS (SELECT role AS dataset, 't' || turn AS type, description, name,
  CASE WHEN length(name) % 2 = 0 THEN 'TRUE' ELSE 'FALSE' END AS pii FROM
  (SELECT role, turn, text AS description, unnest(regexp_split_to_array(text, '\\s+')) AS name FROM conversations))"""


def words(spark, d) -> DataFrame:
    """Words of all documents: source, language and, where there is one, the document's label."""
    t = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return t.select(F.col("source").alias("dataset"), F.explode(F.split("text", r"\s+")).alias("name"),
                    F.when(F.col("toxic") == 1, F.lit("TRUE")).otherwise(F.lit("FALSE")).alias("pii"),
                    F.when(F.col("toxic") == 1, F.col("lang")).alias("entity"))


WORDS = """words AS (SELECT source AS dataset, unnest(regexp_split_to_array(text, '\\s+')) AS name,
  CASE WHEN toxic = 1 THEN 'TRUE' ELSE 'FALSE' END AS pii, CASE WHEN toxic = 1 THEN lang END AS entity
  FROM documents LEFT JOIN labels USING (doc_id))"""


def docs(spark, d) -> DataFrame:
    """Labelled documents as training rows."""
    return table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").select(
        F.col("doc_id").alias("id"), F.col("source").alias("dataset"), F.col("lang").alias("type"),
        F.col("text").alias("description"), F.col("toxic").cast("int").alias("y"),
        F.when(F.col("quality") == 1, F.lit(1.0)).otherwise(F.lit(0.5)).alias("w"),
        F.col("n_chars"))


DOCS = """docs AS (SELECT doc_id AS id, source AS dataset, lang AS type, text AS description, toxic AS y,
  CASE WHEN quality = 1 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS w, n_chars FROM documents JOIN labels USING (doc_id))"""


def sources(spark, d) -> dict[str, DataFrame]:
    """Four label sources with overlapping names and different opinions."""
    g, w = gold(spark, d), words(spark, d)
    up = g.select(F.concat(F.lit("X_"), "name").alias("name"), F.lit("cuenta").alias("entity"))
    return {"gold_validado": g, "match_validado": w.select("name", "entity"),
            "manual_pool": up.unionByName(g.select("name", F.lit(" Saldo ").alias("entity"))),
            "sintetico": w.select("name", F.when(F.col("entity") == "en", F.lit("curp")).alias("entity"))}


SOURCES = f"""{GOLD}, {WORDS},
labelled AS (SELECT trim(name) AS name, lower(trim(entity)) AS entity, label_source, w FROM (
  SELECT name, entity, 'gold_validado' AS label_source, 1.0::DOUBLE AS w FROM gold
  UNION ALL SELECT name, entity, 'match_validado', 1.0::DOUBLE FROM words
  UNION ALL SELECT 'X_' || name, 'cuenta', 'manual_pool', 0.5::DOUBLE FROM gold
  UNION ALL SELECT name, ' Saldo ', 'manual_pool', 0.5::DOUBLE FROM gold
  UNION ALL SELECT name, CASE WHEN entity = 'en' THEN 'curp' END, 'sintetico', 0.3::DOUBLE FROM words)
  WHERE entity IS NOT NULL AND trim(entity) <> '' AND trim(name) <> '')"""


# ---- scores --------------------------------------------------------------------
def scored(spark, d) -> DataFrame:
    """Line items as scored rows: 99 distinct scores, three classes, many ties."""
    li = table(spark, d, "lineitem")
    disc, tax = F.round(F.col("l_discount") * 100).cast("int"), F.round(F.col("l_tax") * 100).cast("int")
    return li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("name"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"), ((disc * 9 + tax) / F.lit(98.0)).alias("p"),
        F.concat("l_linestatus", "l_returnflag").alias("entity"), F.col("l_returnflag").alias("truth"),
        F.when(tax < 3, F.lit("A")).when(tax < 6, F.lit("N")).otherwise(F.lit("R")).alias("pred"),
        F.col("l_linestatus").alias("mode"))


SCORED = """scored AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS name,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
  (CAST(round(l_discount * 100) AS INTEGER) * 9 + CAST(round(l_tax * 100) AS INTEGER)) / 98.0::DOUBLE AS p,
  l_linestatus || l_returnflag AS entity, l_returnflag AS truth,
  CASE WHEN round(l_tax * 100) < 3 THEN 'A' WHEN round(l_tax * 100) < 6 THEN 'N' ELSE 'R' END AS pred,
  l_linestatus AS mode FROM lineitem)"""


# ---- projects ------------------------------------------------------------------
def projects(spark, d) -> DataFrame:
    k = F.col("c_nationkey")
    day = 86400000
    return table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("projectKey"), F.col("c_name").alias("name"),
        F.when(k % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("u"), k.cast("string"))).alias("ownerLogin"),
        F.when(k != 0, F.col("c_name")).alias("ownerDisplayName"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.array(F.lit(" Production ")))
         .when(F.col("c_mktsegment") == "BUILDING", F.array(F.lit("demo"), F.lit("x")))
         .otherwise(F.array().cast("array<string>")).alias("tags"),
        F.when(F.col("c_acctbal") < 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("a"))).alias("contributors"),
        ((F.col("c_mktsegment") == "HOUSEHOLD") & (k == 3)).alias("tutorialProject"),
        F.struct(F.when(k == 7, F.lit(0)).otherwise(F.lit(978307200000) + F.floor(F.col("c_acctbal") / 30) * day)
                 .cast("long").alias("lastModifiedOn")).alias("versionTag"),
        F.struct((F.lit(946684800000) + k.cast("long") * (30 * day)).alias("lastModifiedOn")).alias("creationTag"))


def jobs(spark, d) -> DataFrame:
    """Only even projects ever run; open orders carry the start in the second field."""
    return table(spark, d, "orders").select(
        (F.col("o_custkey") - F.col("o_custkey") % 2).cast("string").alias("projectKey"),
        F.struct(F.when(F.col("o_orderstatus") == "O", F.lit(0)).otherwise(ms("o_orderdate")).cast("long")
                 .alias("initiationTimestamp")).alias("def"),
        ms("o_orderdate").alias("startTime"))


def timeline(spark, d) -> DataFrame:
    """Commits for every third project, one dummy zero stamp per record."""
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate")
    j = li.join(table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_orderkey")
    return j.select((F.col("o_custkey") - F.col("o_custkey") % 3).cast("string").alias("projectKey"),
                    F.array(F.struct(ms("l_shipdate").alias("timestamp")),
                            F.struct(F.lit(0).cast("long").alias("timestamp"))).alias("items"))


def ref():
    return F.to_timestamp(F.lit(REF))


def ts(x):
    return f"CASE WHEN {x} > 0 THEN make_timestamp_ms({x}) END"


PROJECTS = f"""projects AS (SELECT CAST(c_custkey AS VARCHAR) AS pk, c_name AS name,
  CASE WHEN c_nationkey % 5 = 0 THEN '' ELSE 'u' || c_nationkey END AS owner_login,
  CASE WHEN c_nationkey <> 0 THEN c_name END AS owner_display,
  CASE c_mktsegment WHEN 'MACHINERY' THEN [' Production '] WHEN 'BUILDING' THEN ['demo', 'x'] ELSE [] END AS tags,
  CASE WHEN c_acctbal < 0 THEN 0 ELSE 1 END AS n_contrib,
  c_mktsegment = 'HOUSEHOLD' AND c_nationkey = 3 AS tutorial,
  CASE WHEN c_nationkey = 7 THEN 0 ELSE 978307200000 + CAST(floor(c_acctbal / 30) AS BIGINT) * 86400000 END AS version_ms,
  946684800000 + CAST(c_nationkey AS BIGINT) * 2592000000 AS created_ms FROM customer),
jobs AS (SELECT CAST(o_custkey - o_custkey % 2 AS VARCHAR) AS pk,
  CASE WHEN o_orderstatus = 'O' THEN 0 ELSE epoch_ms(o_orderdate) END AS init_ms, epoch_ms(o_orderdate) AS start_ms FROM orders),
job_ts AS (SELECT pk, {ts('coalesce(nullif(init_ms, 0), start_ms)')} AS t FROM jobs),
commit_ts AS (SELECT CAST(o_custkey - o_custkey % 3 AS VARCHAR) AS pk, {ts('epoch_ms(l_shipdate)')} AS t
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
activity AS (SELECT p.*, r.run, c.commit_at, coalesce(c.commit_at, {ts('version_ms')}) AS mod, coalesce(n_jobs, 0) AS n_jobs,
   coalesce(n_commits, 0) AS n_commits
  FROM projects p LEFT JOIN (SELECT pk, max(t) AS run, count(*) AS n_jobs FROM job_ts GROUP BY pk) r USING (pk)
  LEFT JOIN (SELECT pk, max(t) AS commit_at, 2 * count(*) AS n_commits FROM commit_ts GROUP BY pk) c USING (pk))"""
REF_SQL = f"TIMESTAMP '{REF}'"


# ---- bundles -------------------------------------------------------------------
def objects(spark, d) -> DataFrame:
    k, c = F.col("o_orderkey").cast("string"), F.col("o_custkey")
    proj = F.concat(F.lit("P"), (c % 50).cast("string"))
    form = F.col("o_orderkey") % 8
    cat = lambda *x: F.concat(*[F.lit(i) if isinstance(i, str) else i for i in x])
    path = (F.when(form == 0, cat("vault/UAT/N", (c % 7).cast("string"), "/", proj, "/", k, ".zip"))
            .when(form == 1, cat("/vault/PROD-1/N", (c % 7).cast("string"), "/", proj, "/sub/", k, ".ZIP"))
            .when(form == 2, cat(proj, "/project_bundles/", k, ".zip"))
            .when(form == 3, cat(proj, "/old/", k, ".bin"))
            .when(form == 4, cat("single", k)).when(form == 5, cat("vault/short/", k, ".zip"))
            .when(form == 6, cat("vault/UAT/N1/", proj, "/", k, ".txt")).otherwise(cat("/", proj, "/", k)))
    # the one-element explode makes the made-up path a stored column for the plans above it
    return table(spark, d, "orders").select(F.explode(F.array(path)).alias("path"), ms("o_orderdate").alias("lastModified"),
                                            (F.col("o_totalprice") * 1000).cast("long").alias("size"), "o_orderpriority")


def history(spark, d) -> DataFrame:
    """Bundles of urgent orders were preserved in an earlier period."""
    return objects(spark, d).filter("o_orderpriority = '1-URGENT'").select(
        F.md5("path").alias("id"), F.col("path").alias("s3_path"), F.lit("").alias("flow"), F.lit("H").alias("proyecto"),
        F.date_format(F.timestamp_millis("lastModified"), "yyyy-MM-dd HH:mm:ss").alias("fecha_creacion_s3"),
        F.lit("2001-06-01").alias("fecha_periodo_limpieza"), F.bround(F.col("size") / 1048576, 2).alias("size"))


PATH_FORMS = """CASE o_orderkey % 8 WHEN 0 THEN 'vault/UAT/N' || (o_custkey % 7) || '/P' || (o_custkey % 50) || '/' || o_orderkey || '.zip'
  WHEN 1 THEN '/vault/PROD-1/N' || (o_custkey % 7) || '/P' || (o_custkey % 50) || '/sub/' || o_orderkey || '.ZIP'
  WHEN 2 THEN 'P' || (o_custkey % 50) || '/project_bundles/' || o_orderkey || '.zip'
  WHEN 3 THEN 'P' || (o_custkey % 50) || '/old/' || o_orderkey || '.bin'
  WHEN 4 THEN 'single' || o_orderkey WHEN 5 THEN 'vault/short/' || o_orderkey || '.zip'
  WHEN 6 THEN 'vault/UAT/N1/P' || (o_custkey % 50) || '/' || o_orderkey || '.txt'
  ELSE '/P' || (o_custkey % 50) || '/' || o_orderkey END"""
CLEAN_PATH = "regexp_replace(path, '^/+', '')"
PP = f"string_split({CLEAN_PATH}, '/')"
MB = "round_even(size / 1048576.0, 2)"
OBJECTS = f"""objects AS (SELECT {PATH_FORMS} AS path, epoch_ms(o_orderdate) AS last_ms, CAST(trunc(o_totalprice * 1000) AS BIGINT) AS size,
  o_orderpriority FROM orders),
parsed AS (SELECT *, make_timestamp_ms(last_ms) AS creado,
  CASE WHEN len({PP}) >= 5 AND {PP}[1] = 'vault' THEN 'NEW' WHEN len({PP}) >= 2 AND {PP}[1] <> 'vault' THEN 'LEGACY'
       WHEN len({PP}) >= 3 AND {PP}[2] = 'project_bundles' THEN 'LEGACY' END AS flow, {PP} AS pp FROM objects),
bundles_all AS (SELECT path, flow, CASE flow WHEN 'NEW' THEN pp[2] ELSE 'PROD' END AS env,
  CASE flow WHEN 'NEW' THEN pp[3] ELSE 'LEGACY' END AS nickname, CASE flow WHEN 'NEW' THEN pp[4] ELSE pp[1] END AS proyecto,
  array_to_string(CASE WHEN flow = 'NEW' THEN pp[5:] WHEN len(pp) >= 3 AND pp[2] = 'project_bundles' THEN pp[3:] ELSE pp[2:] END, '/') AS filename,
  creado, last_ms, size FROM parsed WHERE flow IS NOT NULL),
bundles AS (SELECT md5(path) AS id, path AS s3_path, flow, env, nickname, proyecto, filename, creado,
  strftime(creado, '%Y-%m-%d %H:%M:%S') AS fecha_creacion_s3, {MB} AS size FROM bundles_all
  WHERE creado < {REF_SQL} - INTERVAL 180 DAY
    AND ((flow = 'NEW' AND lower(path) LIKE '%.zip') OR (flow = 'LEGACY' AND contains(regexp_replace({CLEAN_PATH}, '/+$', ''), '/')))),
history AS (SELECT md5(path) AS id, path AS s3_path, '' AS flow, 'H' AS proyecto,
  strftime(make_timestamp_ms(last_ms), '%Y-%m-%d %H:%M:%S') AS fecha_creacion_s3, '2001-06-01' AS fecha_periodo_limpieza, {MB} AS size
  FROM objects WHERE o_orderpriority = '1-URGENT'),
candidates AS (SELECT * FROM bundles WHERE s3_path NOT IN (SELECT s3_path FROM history)),
marked AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY flow, env, nickname, proyecto
  ORDER BY creado DESC, filename DESC, s3_path DESC) = 1 THEN 'Conservado' ELSE 'Descartado' END AS estado FROM candidates)"""


# ---- events ----------------------------------------------------------------------
def events(spark, d) -> DataFrame:
    return table(spark, d, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"),
        F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("value") / 600)).alias("prob"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("entity"))


EVENTS = """ev AS (SELECT event_id, ts, least(1.0, greatest(0.0, value / 600)) AS prob,
  CASE WHEN event_type <> 'error' THEN event_type END AS entity FROM events)"""
