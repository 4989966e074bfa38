"""Registered queries of the text operators and their DuckDB counterparts, whole tables in, whole results out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablescout.llm import decontaminate, license_scan, line_dedup, merkle, packing, pivots, prefix_trie, simhash, span_dedup, substring_dedup, topk, toxicity, url_filter
from tablescout.llm.common import LOWER, UPPER, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return wrap


OP2 = rf"""WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), E'\n')) AS line,
    generate_subscripts(string_split(coalesce(text, ''), E'\n'), 1) AS pos FROM documents),
  k AS (SELECT *, translate(trim(line, E' \t\n\x0b\x0c\r'), '{UPPER}', '{LOWER}') AS key FROM l),
  hot AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT k.doc_id, count(*)::BIGINT AS n_lines, count(hot.key)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(k.line, E'\n' ORDER BY k.pos) FILTER (WHERE hot.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN hot ON k.key = hot.key GROUP BY k.doc_id"""


@query("op2_line_dedup", OP2)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10)
    return d.select(F.col("_row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP3 = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20"""


@query("op3_exact_top_k", OP3)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64.0)


URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def _url_sql() -> str:
    """The template tree as one DuckDB statement, level by level."""
    u = url_filter
    rules = sorted(URL_RULES, key=lambda r: -len(r[1]))
    fits = lambda t: "((host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '/{1}'))".format(*t.split("/", 1))
    case = lambda f: "CASE " + " ".join(f"WHEN {fits(t)} THEN '{f(a, t)}'" for a, t in rules) + " END"
    ctes = [rf"""u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages)""",
            rf"""hp AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
              regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u)""",
            rf"""r AS (SELECT *, {case(lambda a, t: t)} AS rule, {case(lambda a, t: a)} AS action,
              list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda x:
                regexp_replace(regexp_replace(x, '[0-9a-f]{{12,}}', '*', 'g'), '[0-9]+', '*', 'g')) AS s FROM hp)""",
            rf"""p AS (SELECT *, CASE WHEN len(s) > {u.DEPTH} THEN list_append(s[1:{u.DEPTH}], '*') ELSE s END AS seg FROM r)""",
            """t0 AS (SELECT host, seg AS raw, seg, count(*) AS n, count(action) AS labelled, count(*) FILTER (WHERE action = 'block') AS bad
              FROM p GROUP BY host, seg)"""]
    for d in range(1, u.DEPTH + 1):
        ctes += [f"""n{d} AS (SELECT host, seg[1:{d - 1}] AS parent, seg[{d}] AS child, sum(n) AS n FROM t{d - 1} WHERE len(seg) >= {d} GROUP BY ALL)""",
                 f"""m{d} AS (SELECT host, parent, sum(n) AS total FROM n{d} GROUP BY ALL HAVING count(*) > {u.MAX_CHILDREN})""",
                 f"""v{d} AS (SELECT n{d}.* FROM n{d} JOIN m{d} USING (host, parent) WHERE n{d}.n * {u.MAX_CHILDREN} < total)""",
                 f"""t{d} AS (SELECT t.host, raw, CASE WHEN v.child IS NULL THEN seg
                   ELSE list_concat(seg[1:{d - 1}], ['*'], seg[{d + 1}:]) END AS seg, t.n, labelled, bad
                   FROM t{d - 1} t LEFT JOIN v{d} v ON t.host = v.host AND len(seg) >= {d} AND seg[1:{d - 1}] = v.parent AND seg[{d}] = v.child)"""]
    last, a, b = f"t{u.DEPTH}", u.STRENGTH, u.STRENGTH * u.PRIOR
    noise = lambda p, n: f"{p} * (1 - {p}) / ({n} + {a})"
    ctes += [f"leaf AS (SELECT host, seg, seg[1:greatest(len(seg) - 1, 0)] AS parent, sum(labelled) AS labelled, sum(bad) AS bad FROM {last} GROUP BY ALL HAVING sum(labelled) > 0)",
             f"rated AS (SELECT *, (bad + {b}::DOUBLE) / (labelled + {a}::DOUBLE) AS rate FROM leaf)",
             "was AS (SELECT *, lag(rate) OVER w AS was, lag(labelled) OVER w AS of_n FROM rated WINDOW w AS (PARTITION BY host, parent ORDER BY rate, array_to_string(seg, '/')))",
             f"stepped AS (SELECT *, CASE WHEN rate - was > {u.SIGNIFICANT} * sqrt({noise('rate', 'labelled')} + {noise('was', 'of_n')}) THEN 1 ELSE 0 END AS step FROM was)",
             "merged AS (SELECT *, sum(step) OVER (PARTITION BY host, parent ORDER BY rate, array_to_string(seg, '/')) AS branch FROM stepped)",
             f"pure AS (SELECT host, parent, branch FROM merged GROUP BY ALL HAVING (sum(bad) + {b}::DOUBLE) / (sum(labelled) + {a}::DOUBLE) >= {u.REJECT}::DOUBLE)",
             "gone AS (SELECT m.host, m.seg FROM merged m JOIN pure USING (host, parent, branch))",
             f"j AS (SELECT t.host, t.raw, t.seg, g.host IS NOT NULL AS rejected FROM {last} t LEFT JOIN gone g ON t.host = g.host AND t.seg = g.seg)"]
    return "WITH " + ",\n".join(ctes) + """
SELECT page_id, p.host, path, rule, coalesce(action, CASE WHEN rejected THEN 'block' ELSE 'allow' END) AS verdict,
  array_to_string(j.seg, '/') AS template FROM p JOIN j ON p.host = j.host AND p.seg = j.raw"""


@query("op10_url_filter", _url_sql())
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


@query("op7_pattern_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), size=4096, end_id=1)


@query("op4_simhash_near_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), width=4, radius=4)
    return d.select("doc_id", "fingerprint", "component_id")


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = toxicity.score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return d.select(F.col("_row.doc_id").alias("doc_id"), "held_out", "score", "predicted")


@query("op5_benchmark_decontamination")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = decontaminate.matches(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), similarity=0.8)
    return m.select("doc_id", "item_id", "edits", "n_words", "similarity")


@query("op9_span_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_dedup.removed_sentences(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _license_sql() -> str:
    """Exact containment in all windows; the templates are the only literals."""
    s = license_scan
    rows = [(n, name, s.size_class(len(s.words_of(t))), len(s.shingles_of(t)), x) for n, (name, t) in enumerate(s.NOTICES) for x in s.shingles_of(t)]
    values = ", ".join("({}, '{}', {}, {}, '{}')".format(*r) for r in rows)
    return rf"""WITH t(template, license, l, size, shingle) AS (VALUES {values}),
  w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
  p AS (SELECT doc_id, w, len(w) AS n, unnest(range(0, len(w) - {s.WIDTH - 1})) AS p FROM w),
  h AS (SELECT doc_id, n, p, template, license, l, size, shingle FROM p JOIN t ON array_to_string(w[p + 1:p + {s.WIDTH}], ' ') = shingle),
  k AS (SELECT *, unnest([p // l - 1, p // l]) AS k FROM h),
  c AS (SELECT doc_id, license, template, l, size, k, count(DISTINCT shingle) / size AS containment FROM k
    WHERE k >= 0 AND (k = 0 OR k * l < n - l) AND p <= k * l + 2 * l - {s.WIDTH} GROUP BY doc_id, license, template, l, size, k)
SELECT doc_id, license, max(containment) AS containment, count(DISTINCT (l, k)) AS n_windows FROM c WHERE containment >= 0.8 GROUP BY doc_id, license"""


@query("op8_license_scan", _license_sql())
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op6_substring_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = substring_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), length=400)
    return d.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


# Reflected CRC-32 of the ASCII digits of an integer, which DuckDB has no function for.
def _crc_sql(x: str) -> str:
    step = "list_reduce(list_prepend(xor(c, b), range(8)), lambda a, i: xor(a >> 1, (a & 1) * 3988292384))"
    digits = f"list_transform(string_split(({x})::BIGINT::VARCHAR, ''), lambda d: ord(d)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {digits}), lambda c, b: {step}), 4294967295)"


DOC_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def _merkle_sql() -> str:
    """Level by level with recursive queries."""
    leaf = lambda text: "sha256(" + " || ".join(
        f"coalesce(strlen(({text if c == 'text' else c})::VARCHAR)::VARCHAR || ':' || ({text if c == 'text' else c})::VARCHAR, '-')" for c in DOC_COLUMNS) + ")"

    def tree(t: str, nodes: str) -> str:
        """t: all nodes (g, lvl, i, n, h); t_run: the hashes of each run; t_path: (g, i, flanks) of each leaf."""
        return f"""{t}(g, lvl, i, n, h) AS (SELECT g, 0::BIGINT, i, n, h FROM {nodes} UNION ALL
    SELECT g, lvl + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM {t} WHERE n > 1 GROUP BY g, lvl, n, i // 3),
  {t}_run AS (SELECT g, lvl, i // 3 AS run, list(h ORDER BY i) AS hs FROM {t} WHERE n > 1 GROUP BY g, lvl, i // 3),
  {t}_path(g, leaf_i, lvl, i, ls, rs) AS (SELECT g, i, 0::BIGINT, i, []::VARCHAR[], []::VARCHAR[] FROM {nodes} UNION ALL
    SELECT p.g, leaf_i, p.lvl + 1, p.i // 3, list_append(ls, array_to_string(hs[1:p.i % 3], '')), list_append(rs, array_to_string(hs[p.i % 3 + 2:], ''))
    FROM {t}_path p JOIN {t}_run r ON p.g = r.g AND p.lvl = r.lvl AND p.i // 3 = r.run)"""

    return f"""WITH RECURSIVE d AS (SELECT doc_id, coalesce('s' || source, '') AS g, {leaf("text")} AS h,
    CASE WHEN {_crc_sql("doc_id")} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS found FROM documents),
  nodes AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM d),
  {tree("t", "nodes")},
  subs AS (SELECT g AS src, '' AS g, h, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM t WHERE n = 1),
  {tree("u", "subs")},
  deep AS (SELECT * FROM t_path p WHERE lvl = (SELECT max(lvl) FROM t WHERE t.g = p.g)),
  high AS (SELECT src, h AS subroot, ls, rs, (SELECT h FROM u WHERE n = 1) AS root FROM subs s JOIN u_path p ON s.i = p.leaf_i AND lvl = (SELECT max(lvl) FROM u)),
  paths AS (SELECT doc_id, nodes.h AS leaf, found, subroot, root, list_concat(deep.ls, high.ls) AS ls, list_concat(deep.rs, high.rs) AS rs
    FROM nodes JOIN deep ON nodes.g = deep.g AND nodes.i = deep.leaf_i JOIN high ON nodes.g = high.src),
  f AS (SELECT *, list_reduce(list_prepend(found, list_transform(range(1, len(ls) + 1), lambda k: ls[k] || '|' || rs[k])), lambda a, s:
    sha256(split_part(s, '|', 1) || a || split_part(s, '|', 2))) AS folded_root FROM paths)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(range(1, len(ls) + 1), lambda k: ls[k] || rs[k]), '')) AS proof_sha256,
  folded_root, folded_root = root AS verified FROM f"""


@query("op12_merkle_manifest", _merkle_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    shorn = {"text": F.regexp_replace("text", "\n", "")}
    return merkle.manifest(docs, DOC_COLUMNS, changed=shorn, tampered=F.crc32(F.col("doc_id").cast("string")) % 2 == 0)


OP13 = rf"""WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
    md5(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos FROM conversations WHERE conv_id IS NOT NULL),
  k AS (SELECT conv_id, pos, md5(strlen(role)::VARCHAR || ':' || role || text) AS key, len(regexp_extract_all(text, '[^ 	-
]+')) AS words FROM t),
  c AS (SELECT DISTINCT conv_id, {_crc_sql("conv_id")} % 4 AS h FROM k),
  r AS (SELECT c.conv_id, pos, key, words FROM c JOIN k ON k.conv_id = c.conv_id - c.conv_id % 20 WHERE pos < h UNION ALL
    SELECT conv_id, pos, key, words FROM c JOIN k USING (conv_id) WHERE pos >= h),
  s AS (SELECT c.conv_id, coalesce(list(key ORDER BY pos) FILTER (WHERE key IS NOT NULL), []) AS keys, coalesce(list(words ORDER BY pos) FILTER (WHERE key IS NOT NULL), []) AS words
    FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id),
  m AS (SELECT conv_id, len(keys) AS length, unnest(range(0, len(keys) + 1)) AS depth, keys, words FROM s),
  n AS (SELECT depth, array_to_string(keys[1:depth], '') AS path, any_value(keys[1:depth]) AS keys, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(coalesce(words[depth], 0)) AS words,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE length = depth), '')) AS ends_sha256 FROM m GROUP BY ALL),
  p AS (SELECT array_to_string(keys[1:depth - 1], '') AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
  e AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN p USING (path)),
  a AS (SELECT unnest(range(0, depth + 1)) AS up, keys, n_children, (n_convs - 1) * words AS saved FROM e),
  u AS (SELECT array_to_string(keys[1:up], '') AS path, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM a GROUP BY ALL)
SELECT e.conv_id, e.depth, up.conv_id AS parent_conv_id, e.n_convs, e.n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, e.ends_sha256
FROM e JOIN u USING (path) LEFT JOIN n up ON e.depth > 0 AND up.path = array_to_string(e.keys[1:e.depth - 1], '')"""


@query("op13_prefix_trie", OP13)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv")
    own = prefix_trie.turns(table(spark, sf_dir, "conversations"))
    sequences = prefix_trie.rebuilt(own, conv - conv % 20, F.crc32(conv.cast("string")) % 4)
    return prefix_trie.trie(sequences).drop("path")


@query("op11_embedding_near_dedup")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_duplicates(table(spark, sf_dir, "embeddings"), similarity=0.9)
