"""Clusterings of the name graph, with their rounds unrolled in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.q_ml import EDGE, _pos
from checks.registry import register
from tablescout.operators import graphs as G, textsim as X
from tablescout.session import cut_lineage

FLOOR, ROUNDS, MERGES = 0.3, 6, 6
_nodes = lambda s, d: _pos(s, d).select("light").distinct()
_edges = lambda s, d: cut_lineage(X.similar_pairs(_pos(s, d), "light", FLOOR))
_sweep = lambda s, d: G.affinity_propagation(_nodes(s, d), _edges(s, d), "light", rounds=ROUNDS, patience=None)
LINKS = f"{EDGE.replace('>= 0.6', f'>= {FLOOR}')}, ed AS MATERIALIZED (SELECT a, b, sim FROM edges)"


def _affinity_sql() -> str:
    noise = f"CAST(('0x' || substr(md5(i || '|' || k), 1, 8)) AS BIGINT) / 4294967296::DOUBLE * {G.JITTER}::DOUBLE"
    qs = ", ".join(f"({q}::DOUBLE)" for q in G.SWEEP)
    ctes = [LINKS, "di AS (SELECT a AS i, b AS k, sim FROM ed UNION ALL SELECT b, a, sim FROM ed)", f"qs(q) AS (VALUES {qs})",
            "pf AS (" + " UNION ALL ".join(f"SELECT {q}::DOUBLE AS q, quantile_cont(round(sim, 6), {q}) AS p FROM ed" for q in G.SWEEP) + ")",
            "al AS (SELECT q, i, k, sim FROM qs, di UNION ALL SELECT q, i, i, p FROM pf, (SELECT DISTINCT i FROM di))",
            f"m0 AS MATERIALIZED (SELECT q, i, k, sim + {noise} AS s, 0::DOUBLE AS r, 0::DOUBLE AS a FROM al)"]
    for n in range(1, ROUNDS + 1):
        ctes += [f"h{n} AS (SELECT *, a + s AS v, max(a + s) OVER (PARTITION BY q, i) AS hi FROM m{n - 1})",
                 f"t{n} AS (SELECT *, sum(CASE WHEN v = hi THEN 1 ELSE 0 END) OVER w AS ties, max(CASE WHEN v < hi THEN v END) OVER w AS nx FROM h{n} WINDOW w AS (PARTITION BY q, i))",
                 f"r{n} AS MATERIALIZED (SELECT q, i, k, s, 0.5::DOUBLE * r + 0.5::DOUBLE * (s - CASE WHEN v = hi AND ties = 1 THEN nx ELSE hi END) AS r, a FROM t{n})",
                 f"c{n} AS (SELECT *, round(sum(CASE WHEN i <> k THEN greatest(r, 0::DOUBLE) ELSE 0 END) OVER w, 12) AS su, max(CASE WHEN i = k THEN r END) OVER w AS own FROM r{n} WINDOW w AS (PARTITION BY q, k))",
                 f"m{n} AS MATERIALIZED (SELECT q, i, k, s, r, 0.5::DOUBLE * a + 0.5::DOUBLE * CASE WHEN i = k THEN su ELSE least(0::DOUBLE, own + su - greatest(r, 0::DOUBLE)) END AS a FROM c{n})"]
    deal = lambda ex: f"SELECT q, i, arg_min(k, (CASE WHEN i = k THEN -1e300::DOUBLE ELSE -s END, k)) AS k FROM mm JOIN {ex} USING (q, k) GROUP BY 1, 2"
    ctes += [f"mm AS (SELECT * FROM m{ROUNDS})", "x0 AS (SELECT q, k FROM mm WHERE i = k AND r + a > 0)", f"d0 AS ({deal('x0')})",
             "sm AS (SELECT mm.q, d.k AS c, mm.k, round(sum(s), 9) AS o FROM mm JOIN d0 d ON d.q = mm.q AND d.i = mm.i JOIN d0 e ON e.q = mm.q AND e.i = mm.k AND e.k = d.k GROUP BY ALL)",
             "x1 AS (SELECT DISTINCT q, arg_min(k, (-o, k)) AS k FROM sm GROUP BY q, c)", f"d1 AS ({deal('x1')})",
             "swept AS (SELECT qs.q, ps.light, coalesce(d1.k, ps.light) AS exemplar FROM ps CROSS JOIN qs LEFT JOIN d1 ON d1.q = qs.q AND d1.i = ps.light)"]
    return ",\n".join(ctes)


def _linkage_sql(threshold: float = 0.5) -> str:
    ctes = ["z0 AS (SELECT DISTINCT light AS c, 1 AS n FROM ps)", "l0 AS MATERIALIZED (SELECT a, b, sim AS w FROM ed)", "g0 AS (SELECT DISTINCT light, light AS cluster FROM ps)"]
    for n in range(1, MERGES + 1):
        p = n - 1
        ctes += [f"s{n} AS (SELECT a, b, -round(w / (x.n * y.n), 9) AS o FROM l{p} JOIN z{p} x ON x.c = a JOIN z{p} y ON y.c = b WHERE round(w / (x.n * y.n), 9) >= {threshold})",
                 f"b{n} AS (SELECT c, min((o, a, b)) AS p FROM (SELECT a AS c, * FROM s{n} UNION ALL SELECT b, * FROM s{n}) GROUP BY 1)",
                 f"j{n} AS MATERIALIZED (SELECT (p).a AS a, (p).b AS b FROM (SELECT {{'a': p[2], 'b': p[3]}} AS p FROM b{n}) GROUP BY ALL HAVING count(*) = 2)",
                 f"z{n} AS MATERIALIZED (SELECT coalesce(j.a, z.c) AS c, sum(n) AS n FROM z{p} z LEFT JOIN j{n} j ON j.b = z.c GROUP BY 1)",
                 f"g{n} AS MATERIALIZED (SELECT light, coalesce(j.a, g.cluster) AS cluster FROM g{p} g LEFT JOIN j{n} j ON j.b = g.cluster)",
                 f"k{n} AS (SELECT coalesce(x.a, l.a) AS a, coalesce(y.a, l.b) AS b, w FROM l{p} l LEFT JOIN j{n} x ON x.b = l.a LEFT JOIN j{n} y ON y.b = l.b)",
                 f"l{n} AS MATERIALIZED (SELECT least(a, b) AS a, greatest(a, b) AS b, sum(w) AS w FROM k{n} WHERE a <> b GROUP BY 1, 2)"]
    return ",\n".join(ctes)


register("m19_affinity_sweep", lambda s, d: _sweep(s, d), f"WITH {_affinity_sql()} SELECT q, light, exemplar FROM swept")
register("m19_average_linkage", lambda s, d: G.average_linkage(_nodes(s, d), _edges(s, d), "light"), f"WITH {LINKS}, {_linkage_sql()} SELECT light, cluster FROM g{MERGES}")
register("m19_chosen_clusters", lambda s, d: G.chosen_clusters(_nodes(s, d), _edges(s, d), "light", wanted=(5, 250), target=120, rounds=ROUNDS, patience=None),
         f"""WITH {_affinity_sql()}, {_linkage_sql()}, cn AS (SELECT q, count(DISTINCT exemplar) AS n FROM swept GROUP BY 1), ft AS (SELECT arg_min(q, (abs(n - 120), q)) AS q FROM cn WHERE n BETWEEN 5 AND 250),
ms AS (SELECT arg_min(q, (-n, q)) AS q, max(n) AS n FROM cn), ch AS (SELECT coalesce(ft.q, CASE WHEN ms.n BETWEEN 3 AND 50 THEN ms.q END) AS q FROM ft, ms)
SELECT light, exemplar AS cluster, 'affinity_' || q AS method FROM swept JOIN ch USING (q) UNION ALL SELECT light, cluster, 'average_linkage' FROM g{MERGES} WHERE (SELECT q FROM ch) IS NULL""")
