import zlib

import numpy as np

from tablescout.llm import toxicity
from tablescout.llm.queries import QUERIES


def test_gradient_by_differences():
    net = toxicity.Network(3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    f = np.array([[1, 2, 3, 1] + [0] * 20, [2, 2, 1, 3] * 6])
    gates = np.concatenate((np.zeros((1, 48)), np.random.default_rng(0).standard_normal((3, 48))))
    out, kept = net.forward(gates, f, keep=True)
    g, dg = net.backward(gates, f, kept, np.array([1.0, -0.5]))
    loss = lambda: float(net.forward(gates, f) @ np.array([1.0, -0.5]))
    for name, grad in [*g.items(), ("gates", dg)]:
        x = (gates if name == "gates" else net.p[name])
        at = tuple(n // 2 for n in x.shape)
        was = x[at]
        x[at] = was + 1e-2
        up = loss()
        x[at] = was - 1e-2
        down = loss()
        x[at] = was
        assert abs((up - down) / 2e-2 - grad[at]) < 5e-3 * max(1, abs(grad[at]))


def test_windows_overlap_and_cover():
    for n in (0, 1, 24, 25, 36, 37, 500):
        seen = {i for s in toxicity.windows(n) for i in range(s, s + toxicity.WINDOW)}
        assert set(range(n)) <= seen
    assert all(b - a < toxicity.WINDOW for a, b in zip(toxicity.windows(500), toxicity.windows(500)[1:]))


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    out = {r.doc_id: r for r in QUERIES["op1_toxicity"](spark, d).collect()}
    assert len(out) == spark.read.parquet(f"{d}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in out.items())
    y = [(r.toxic, out[r.doc_id].predicted) for r in spark.read.parquet(f"{d}/labels.parquet").collect() if out[r.doc_id].held_out]
    assert np.mean([a == b for a, b in y]) > 0.9  # 51 toxic rows in all to learn from


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (1, ""), (None, "x"), (4, "a " * 20000)], "doc_id long, text string").selectExpr("*", "3 AS score", "1 AS _t")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.score_texts(docs, none).collect()} == {0.0}
    some = spark.createDataFrame([(1, 1, 1), (4, 1, 0), (None, 1, 1), (4, 0, None)], "doc_id long, quality int, toxic int")
    out = toxicity.score_texts(docs, some, epochs=1).collect()
    assert len(out) == 4 and all(0 <= r.score <= 1 for r in out)
    assert toxicity.score_texts(docs.limit(0), none).count() == 0


def test_every_letter_counts():
    w, slot, ends = toxicity.pieces(["a" * 20 + "bcde", "a" * 20 + "bcdf", "\u4e2d" * 23 + "\u6587", "\u4e2d" * 24, "ab"])
    own = [sorted(slot[a:b]) for a, b in zip(ends, ends[1:])]
    assert w[0] != w[1] and own[0] != own[1] and w[2] != w[3] and own[2] != own[3]
    assert [len(x) for x in own] == [24 + 3, 24 + 3, 72 + 3, 72 + 3, 2]
    long = "\u4e2d" * 100
    assert "".join(toxicity.split_words(f"{long} x")) == f"{long}x" and max(map(len, toxicity.split_words(long))) <= toxicity.LETTERS
    score = toxicity.Scorer(toxicity.Network(2))
    calm, late = score([long, long[:60] + "\u6587" * 40])
    assert calm != late and len(score(["", "x" * 100_000])) == 2


def test_piece_gradients_reach_every_piece():
    texts = ["good day " * 5 + "fine" * 6, "bad day " * 5 + "vile" * 6] * 4
    net = toxicity.train(texts, [0, 1] * 4, epochs=6)
    low, high = toxicity.Scorer(net)(texts[:2])
    assert low < high


def test_idle_workers_hold_no_words(spark):
    docs = spark.createDataFrame([(i, f"{'good' if i % 2 else 'vile'} day {i}") for i in range(40)], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(40)], "doc_id long, toxic int")
    assert toxicity.score_texts(docs, labels, epochs=1).count() == 40

    def held_by_worker(batches):
        import sys
        import pyarrow as pa
        names = [n for n in vars(sys.modules.get("_tablescout_worker", sys)) if n.startswith("scorer_")]
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(names)])], names=["n"])
    assert docs.select("doc_id").mapInArrow(held_by_worker, "n long").groupBy().max("n").first()[0] == 0


def test_scores_do_not_depend_on_the_cache(monkeypatch):
    texts = [" ".join(f"word{(7 * k + j) % 90}" for j in range(40)) for k in range(12)] + ["", "a"]
    net = toxicity.Network(2)
    want = toxicity.Scorer(net)(texts)
    monkeypatch.setattr(toxicity, "CACHED_WORDS", 50)
    small = toxicity.Scorer(net)
    got = np.concatenate([small(texts[a:a + 1]) for a in range(len(texts))])
    assert np.abs(got - want).max() < 1e-6
