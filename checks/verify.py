"""Run registered queries against their DuckDB text and report differences.

python -m checks.verify [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import sys
import tempfile
import time

import duckdb

from checks import adapters as A


def _cell(v):
    if v is None or v != v:
        return None
    if isinstance(v, float):
        return repr(round(v, 9) + 0.0)
    return str(v)


def rows_of(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in data), key=lambda t: tuple((x is None, x or "") for x in t))


def oracle(con, sql):
    cur = con.execute(sql)
    return [c[0] for c in cur.description], cur.fetchall()


def connect(sf_dir):
    con = duckdb.connect()
    for t in A.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def main(argv):
    from checks import all_queries
    from tablescout.session import build_session
    sf = argv[0] if argv else "/root/testdata/sf0.01"
    queries, oracles = all_queries()
    picked = [n for n in queries if not argv[1:] or any(p in n for p in argv[1:])]
    shared = tempfile.mkdtemp(prefix="tablescout-verify-")
    spark = build_session("local[8]", **{"spark.checkpoint.dir": f"file://{shared}/checkpoints", "spark.sql.warehouse.dir": f"{shared}/warehouse", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for n in picked:
        t0 = time.time()
        try:
            df = queries[n](spark, sf)
            data = [tuple(r) for r in df.collect()]
        except Exception as e:
            print(f"ERR   {n}: {str(e)[:900]}", flush=True)
            bad += 1
            continue
        t1 = time.time()
        if n not in oracles:
            print(f"rows  {n}: {len(data)} rows {t1 - t0:.1f}s", flush=True)
            continue
        try:
            cols, want = oracle(con, oracles[n])
        except Exception as e:
            print(f"SQL   {n}: {str(e)[:700]}", flush=True)
            bad += 1
            continue
        t2 = time.time()
        a, b = rows_of(df.columns, data), rows_of(cols, want)
        if sorted(df.columns) != sorted(cols):
            print(f"COLS  {n}: {sorted(df.columns)} vs {sorted(cols)}", flush=True)
            bad += 1
        elif a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y]
            sa, sb = set(a), set(b)
            print(f"DIFF  {n}: {len(a)} vs {len(b)} rows, {len(sa - sb)} only spark e.g. {list(sa - sb)[:2]} | {len(sb - sa)} only sql e.g. {list(sb - sa)[:2]}", flush=True)
            bad += 1
        else:
            print(f"ok    {n}: {len(a)} rows spark {t1 - t0:.1f}s sql {t2 - t1:.1f}s", flush=True)
    print(f"{len(picked)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
