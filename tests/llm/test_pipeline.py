import os
import re
import shutil
import subprocess
import sys

import pytest

import corpus_pipeline
from tablescout.llm import toxicity
from tablescout.llm.line_dedup import drop_repeated_lines


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    d = "/root/testdata/sf0.001"
    home, docs = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{d}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], d).write.parquet(f"{home}/{k}")
        out.append(spark.read.parquet(f"{home}/{k}"))
    return out


def test_columns_and_decisions(spark, stages):
    docs, calm, lines, single, clean, packed = stages
    assert all(x.columns == docs.columns for x in (calm, lines, single, clean))
    ids = lambda x: {r.doc_id for r in x.select("doc_id").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    scored = toxicity.score_texts(docs, labels)
    assert ids(calm) == {r.i for r in scored.filter("predicted = 0").selectExpr("_row.doc_id AS i").collect()}
    assert ids(lines) == ids(calm)
    sets = {}
    text = {r.doc_id: r.text for r in calm.collect()}
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    for i, t in text.items():
        for x in set(map(key, t.split("\n"))):
            sets.setdefault(x, set()).add(i)
    want = {i: "\n".join(x for x in t.split("\n") if not key(x) or len(sets[key(x)]) < 10) for i, t in text.items()}
    assert {r.doc_id: r.text for r in lines.collect()} == want
    assert all(r.n_chars == len(r.text) for r in lines.collect())
    assert ids(single) < ids(lines) and len(ids(single)) == single.count()
    assert ids(clean) < ids(single)
    items = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    flat = lambda t: " ".join(re.findall(r"[^\W_]+", t.lower()))
    assert not any(flat(x) in flat(r.text) for x in items for r in clean.collect())
    assert {r.doc_id for r in packed.select("doc_id").collect()} == ids(clean)


def test_odd_rows_through_all_stages(spark):
    d = "/root/testdata/sf0.001"
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "a b c", None, "s", 5), (3, "word " * 20000, "en", None, 100000), (3, "word " * 20000, "en", None, 100000)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _row string, runs int, score int"
    for docs in (spark.createDataFrame([(*r, "x", 1, 2) for r in rows], schema), spark.createDataFrame([], schema)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, d)
            assert len(docs.columns) == 8
        assert corpus_pipeline.packed(spark, docs, d).count() >= 0


def test_keep_first_line(spark):
    rows = [(1, "Same\nown 1\nsame "), (2, " SAME\nown 2"), (3, "\n\n"), (3, "\n\n"), (None, "same")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS kept", "2 AS line")
    none = {(r._row.doc_id, r.n_lines, r.n_dropped, r.kept) for r in drop_repeated_lines(docs, min_docs=2).collect()}
    assert none == {(1, 3, 2, "own 1"), (2, 2, 1, "own 2"), (3, 3, 0, "\n\n"), (None, 1, 1, "")}
    first = {(r._row.doc_id, r.kept) for r in drop_repeated_lines(docs, min_docs=2, keep_first=True).collect()}
    assert first == {(1, "own 1"), (2, "own 2"), (3, "\n\n"), (None, "same")}  # a null id comes first
    assert drop_repeated_lines(docs.limit(0)).count() == 0


def test_rest_of_the_library_does_not_need_this(tmp_path):
    """A clone without both folders imports, with and without the pipeline's file."""
    repo, clone = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), tmp_path / "clone"
    shutil.copytree(repo, clone, ignore=lambda d, names: [n for n in names if n in (".git", "llm", "__pycache__")])
    look = "import __spark_entry__ as e, os; q = e.queries(); print(os.path.dirname(e.__file__), len(q), any(k.startswith('op') or k == 'pipeline' for k in q), set(e.oracle_sql()) <= set(q))"
    for _ in range(2):
        out = subprocess.run([sys.executable, "-c", look], cwd=clone, env={**os.environ, "PYTHONPATH": str(clone)}, capture_output=True, text=True, check=True).stdout.split()
        assert out[0] == str(clone) and int(out[1]) > 200 and out[2:] == ["False", "True"]
        (clone / "corpus_pipeline.py").unlink(missing_ok=True)
    import __spark_entry__
    assert "pipeline" in __spark_entry__.queries()
