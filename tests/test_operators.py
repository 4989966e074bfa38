"""Invariants and brute-force comparisons on small inputs."""

import math
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tablescout.functions import vocabulary as V
from tablescout.operators import augment as AU, catalog as C, evaluate as E, labels as L, retention as RT, splits as SP, textsim as X
from tablescout.operators.grouping import first_values
from tablescout.sources import artefacts, files, schema_scan, tables


def grams(s, lo=2, hi=4):
    out = []
    for w in s.split():
        w = f" {w} "
        for n in range(lo, hi + 1):
            out.append(w[:n])
            i = 0
            while i + n < len(w):
                i += 1
                out.append(w[i:i + n])
            if i == 0:
                break
    return out


def vectors(docs):
    tf = {d: Counter(grams(d)) for d in docs}
    df = Counter(g for d in docs for g in tf[d])
    out = {}
    for d in docs:
        v = {g: c * (math.log((1 + len(docs)) / (1 + df[g])) + 1) for g, c in tf[d].items()}
        n = math.sqrt(sum(x * x for x in v.values()))
        out[d] = {g: x / n for g, x in v.items()}
    return out


def names(seed, n):
    r = random.Random(seed)
    syl = ["tel", "ca", "sa", "num", "cli", "en", "te", "rf", "c", "x"]
    return sorted({" ".join("".join(r.choice(syl) for _ in range(r.randint(1, 4))) for _ in range(r.randint(1, 3))) for _ in range(n)})


def test_char_grams(spark):
    words = ["a", "ab", "tel casa", "", "abcdef"]
    df = spark.createDataFrame([(w,) for w in words], "t string")
    got = {r.t: sorted(r.g) for r in df.select("t", X.char_wb_grams(F.col("t")).alias("g")).collect()}
    assert got == {w: sorted(grams(w)) for w in words}


def brute_best(qs, cs):
    v = {("q", d): x for d, x in {}.items()}
    docs = [("q", q) for q in qs] + [("c", c) for c in cs]
    tf = {d: Counter(grams(d[1])) for d in docs}
    df = Counter(g for d in docs for g in tf[d])
    for d in docs:
        w = {g: c * (math.log((1 + len(docs)) / (1 + df[g])) + 1) for g, c in tf[d].items()}
        n = math.sqrt(sum(x * x for x in w.values()))
        v[d] = {g: x / n for g, x in w.items()}
    best = {}
    for q in qs:
        if q in cs:
            best[q] = (q, 1.0)
            continue
        scores = [(-round(sum(w * v["c", c].get(g, 0.0) for g, w in v["q", q].items()), 9), c) for c in cs]
        s, c = min(scores)
        if -s > 0:
            best[q] = (c, -s)
    return best


def test_nearest_neighbours_match_brute_force(spark):
    qs, cs = names(1, 120), names(2, 80)
    q = spark.createDataFrame([(x,) for x in qs], "light string")
    c = spark.createDataFrame([(x,) for x in cs], "light string")
    want = brute_best(qs, set(cs))
    full = {r.q: (r.c, round(r.similarity / 100, 6)) for r in X.nearest_neighbours(q, c, "light", 0.5, True).collect()}
    assert full == {k: (n, round(s, 6)) for k, (n, s) in want.items()}
    at = {r.q: (r.c, round(r.similarity / 100, 6)) for r in X.nearest_neighbours(q, c, "light", 0.5).collect()}
    assert at == {k: (n, round(s, 6)) for k, (n, s) in want.items() if s >= 0.5}


def test_similar_pairs_and_components(spark):
    docs = names(3, 90)
    v = vectors(docs)
    want = {(a, b) for a in docs for b in docs if a < b and sum(w * v[b].get(g, 0.0) for g, w in v[a].items()) >= 0.6}
    df = spark.createDataFrame([(x,) for x in docs], "t string")
    assert {(r.a, r.b) for r in X.similar_pairs(df, "t", 0.6).collect()} == want
    parent = {d: d for d in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in want:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    got = {r.t: r.component for r in X.name_clusters(df, "t", 0.6).collect()}
    groups = defaultdict(set)
    for d in docs:
        groups[find(d)].add(d)
    assert got == {d: min(groups[find(d)]) for d in docs}


def test_components_on_a_long_chain(spark):
    n = 200
    nodes = spark.createDataFrame([(f"{i:04d}",) for i in range(n)], "t string")
    edges = spark.createDataFrame([(f"{i:04d}", f"{i + 1:04d}") for i in range(n - 1)], "a string, b string")
    assert {r.component for r in X.connected_components(nodes, edges, "t").collect()} == {"0000"}


def test_running_counts_match_brute_force(spark):
    r = random.Random(0)
    rows = [(r.random() ** 3, int(r.random() < 0.3)) for _ in range(3000)] + [(0.5, 1)] * 500
    df = spark.createDataFrame(rows, "p double, y int")
    got = {x.score: (x.tp, x.hit, x.p) for x in E.cumulative_counts(df, "p", "y").collect()}
    pos = sum(y for _, y in rows)
    for s in random.Random(1).sample(sorted({p for p, _ in rows}), 50) + [0.5]:
        assert got[s] == (sum(y for p, y in rows if p >= s), sum(1 for p, _ in rows if p >= s), pos)


def test_splits_are_disjoint_and_guarantee_slices(spark):
    rows = [(f"g{i % 60}", 1, ["a", "b", "solo"][0 if i % 60 < 40 else 1 if i % 60 < 59 else 2]) for i in range(600)] + [(f"n{i}", 0, "NO_PII") for i in range(300)]
    df = spark.createDataFrame(rows, "g string, y int, e string")
    sp = SP.slice_guaranteed_split(df, "g", "y", "e", 0.18)
    assert sp.groupBy("g").count().filter("count > 1").count() == 0
    hold = {r.e for r in SP.split_part(df, sp, "g", "holdout").select("e").distinct().collect()}
    assert {"a", "b"} <= hold and "solo" not in hold
    assert SP.split_overlap(SP.split_part(df, sp, "g", "train"), SP.split_part(df, sp, "g", "holdout"), "g").first().overlap == 0
    st = SP.stratified_group_split(df, "g", "y", 0.2).groupBy("majority", "split").count().collect()
    assert {(r.majority, r.split): r["count"] for r in st} == {(1, "train"): 48, (1, "holdout"): 12, (0, "train"): 240, (0, "holdout"): 60}


def test_balanced_folds_are_even(spark):
    rows = [(f"g{i}",) for i in range(50) for _ in range(1 + i % 7)]
    f = SP.balanced_folds(spark.createDataFrame(rows, "g string"), "g", 3)
    sizes = [r.s for r in f.groupBy("fold").agg(F.sum("n").alias("s")).collect()]
    assert len(sizes) == 3 and max(sizes) - min(sizes) <= 7 and f.count() == 50


def test_children_never_train_their_own_fold(spark):
    folds = spark.createDataFrame([("p1", 0), ("p2", 2)], "g string, fold int")
    kids = spark.createDataFrame([("c1", "p1"), ("c2", "p2")], "name string, parent string")
    got = {(r.name, r.trains_fold) for r in SP.children_by_fold(kids, folds, "parent", "g", 3).collect()}
    assert got == {("c1", 1), ("c1", 2), ("c2", 0), ("c2", 1)}


def test_keep_latest_keeps_one_per_group_and_merge_is_keyed(spark):
    rows = [("NEW", "e", "n", "p", f"f{i % 3}", f"path{i}", i % 4) for i in range(40)] + [("LEGACY", "e", "n", "q", "f", "solo", 1)]
    b = spark.createDataFrame(rows, "flow string, env string, nickname string, proyecto string, filename string, s3_path string, d int")
    b = b.withColumn("creado", F.timestamp_seconds("d")).withColumn("id", F.md5("s3_path")).withColumn("size", F.lit(1.5)).withColumn("fecha_creacion_s3", F.lit("x"))
    m = RT.keep_latest(b)
    assert m.count() == 41
    assert m.filter(F.col("estado") == V.STATUS_KEEP).count() == 2
    hist = m.select(*[F.lit("old").alias(c) if c not in ("s3_path", "size") else F.col(c) for c in V.HISTORY_COLUMNS])
    merged = RT.merge_history(hist, m, "2026-01-01")
    assert merged.count() == 2 and {r.fecha_periodo_limpieza for r in merged.collect()} == {"2026-01-01"}


def test_consolidate_one_row_per_name(spark):
    src = {"gold_validado": spark.createDataFrame([("a", "rfc")], "name string, entity string"),
           "sintetico": spark.createDataFrame([("a", "curp"), (" b ", " Curp "), ("c", None), ("", "x")], "name string, entity string"),
           "manual_pool": None}
    got = {r.name: (r.entity, r.label_source, r.w) for r in L.consolidate(L.union_sources(src)).collect()}
    assert got == {"a": ("rfc", "gold_validado", 1.0), "b": ("curp", "sintetico", 0.3)}


def test_variants_stay_in_training_rules(spark):
    rows = spark.createDataFrame([("tel casa", "telefono"), ("correo", "correo"), ("rfc titular", "rfc")], "name string, entity string").withColumn("name_norm", F.col("name"))
    out = AU.synthetic_variants(rows).collect()
    assert out and not any(r.entity == "telefono" for r in out)
    assert all(c <= V.VARIANT_CAP for c in Counter(r.entity for r in out).values())
    assert {r.parent_norm for r in out} <= {"correo", "rfc titular"}


def test_propagate_handles_empty_names(spark):
    rows = spark.createDataFrame([("", "TRUE"), ("a", "TRUE")], "key string, pii string")
    per = spark.createDataFrame([("a", "v", True, 95.0, True, "validado_21k", 1.0)],
                                "key string, vecino string, vecino_pii boolean, similarity double, pii_final boolean, label_source string, sample_weight double")
    got = {r.key: (r.has_name, r.pii_final, r.label_source, r.sample_weight) for r in L.propagate(rows, per).collect()}
    assert got == {"": (False, None, "nombre_vacio", 0.0), "a": (True, True, "validado_21k", 1.0)}


def test_first_values_bounds_hot_groups(spark):
    df = spark.range(5000).select(F.when(F.col("id") < 4990, "hot").otherwise("cold").alias("k"), F.format_string("%05d", "id").alias("v"))
    out = first_values(df, ["k"], "v", 3, "o")
    assert {r.k: r.o for r in out.collect()} == {"hot": "00000 | 00001 | 00002", "cold": "04990 | 04991 | 04992"}
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_csv_reader_and_report(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿ name ,tabla\r\nñandú,\"x, y\"\r\n".encode("utf-8"))
    (tmp_path / "b.csv").write_bytes(" name ,tabla\nñandú,z\n".encode("latin-1"))
    for f, second in (("a.csv", "x, y"), ("b.csv", "z")):
        df = files.read_csv(spark, str(tmp_path / f))
        assert df.columns == ["name", "tabla"] and df.first().name == "ñandú" and df.first().tabla.strip() == second
    files.write_report(spark.createDataFrame([('a"b', None), ("c,d", "e")], "x string, y string").coalesce(1), str(tmp_path / "out"), bom=True)
    text = b"".join(p.read_bytes() for p in sorted((tmp_path / "out").glob("part-*"))).decode("utf-8")
    assert text == "﻿x,y\r\na\"b,\r\n\"c,d\",e\r\n".replace('a"b', '"a""b"')


def test_sources_fall_back(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    assert tables.read_first(spark, [str(tmp_path / "no"), str(tmp_path / "t")]).count() == 3
    assert len(tables.read_present(spark, [str(tmp_path / "no"), str(tmp_path / "t")])) == 1
    scan, warnings = schema_scan.scan_paths(spark, {"t": str(tmp_path / "t"), "no": str(tmp_path / "no")})
    assert scan.count() == 1 and len(warnings) == 1
    assert tables.resolve_aliases(spark.createDataFrame([("c",)], "columna string")).first().asDict() == {"tabla": "piloto", "name": "c"}


def test_threshold_override_is_traceable(spark, tmp_path):
    p = artefacts.override_threshold(artefacts.parameters(spark, 0.5), 0.75, "why")
    artefacts.save_parameters(p, str(tmp_path / "p"))
    r = artefacts.load_parameters(spark, str(tmp_path / "p")).first()
    assert (r.threshold, r.threshold_previo, r.threshold_motivo) == (0.75, 0.5, "why")


def test_calibrated_candidates_give_probabilities(spark):
    from tablescout.operators import models as M
    rows = [(f"name{i}", ["^na", "x" if i % 3 else "y", f"g{i % 7}"], ["w"], 1.0, int(i % 3 == 0)) for i in range(90)]
    df = spark.createDataFrame(rows, "name string, grams array<string>, words array<string>, n double, y int").withColumn("e", F.lit("a"))
    out = M.compare_candidates(df, df, ["svm", "logistic"], 0.5, ["n"], key="name", entity="e", gate=["a", "zz"], min_df=1, char_features=50, word_features=5).collect()
    assert {r.modelo for r in out} == {"svm", "logistic"} and all(0 <= r.brier <= 1 and 0 <= r.f2max <= 1 for r in out)
    assert [r.ganador for r in out] == [True, False] and all(set(r.rec_gate) == {"a", "zz"} for r in out)


def test_a_gate_without_metric_fails(spark):
    from tablescout.operators import evaluate as E
    m = spark.createDataFrame([("recall", 0.9), ("other", 1.0)], "metric string, value double")
    got = {r.metric: r["pass"] for r in E.quality_gates(m, [("recall", ">=", 0.8), ("oov", "<=", 0.4)]).collect()}
    assert got == {"recall": True, "oov": False}


def test_a_large_dictionary_is_compared_whole(spark):
    from tablescout.operators import textsim as X
    words = spark.createDataFrame([(f"term{i:04d}x",) for i in range(500)], "d string")
    names = spark.createDataFrame([("term0499x",)], "name string")
    assert X.token_overlap(names, words, "name", "d").first().fuzzy_score == 100.0
