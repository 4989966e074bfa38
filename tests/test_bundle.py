"""The saved pipeline of both stages: round trip, stream, odd rows, ties at the edge of a vocabulary."""

import pytest

from pyspark.sql import functions as F

from tablescout.operators import models as M
from tablescout.operators.calibration import Sigmoid
from tablescout.operators.stages import scoring_bundle
from tablescout.sources import artefacts
from tablescout.streaming import streams as ST

NAMES = [("rfc cliente", 1, "rfc"), ("rfc titular", 1, "rfc"), ("telefono casa", 1, "telefono"), ("telefono movil", 1, "telefono"),
         ("monto total", 0, None), ("monto pago", 0, None), ("sucursal alta", 0, None), ("sucursal baja", 0, None)]


@pytest.fixture(scope="module")
def fitted(spark):
    rows = M.with_terms(spark.createDataFrame(NAMES, "name_norm string, y int, entity string"), "name_norm")
    return M.fit_binary(rows, min_df=1), M.fit_entity(rows.filter("entity IS NOT NULL"), min_df=1)


COLUMNS = ["name", "extra", "prob_pii", "pii", "entity", "prob_entity", "override_aplicado", "regex_match", "name_norm"]


def _rows(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_saved_bundle_scores_batch_and_stream(spark, fitted, tmp_path):
    binary, entity = fitted
    binary.calibrator = Sigmoid(6.0, -3.0)
    bundle = scoring_bundle(binary, entity, 0.5)
    binary.calibrator = None
    artefacts.save_model(bundle, f"{tmp_path}/bundle")
    loaded = artefacts.load_model(f"{tmp_path}/bundle")
    names = spark.createDataFrame([("RFC_Cliente", 1), ("telefono_casa", 2), ("monto_total", 3), ("", 4), (None, 5), ("RFC_Cliente", 1)], "name string, extra int")
    names.write.parquet(f"{tmp_path}/in")
    want = _rows(bundle.transform(names))
    assert len(want) == 6 and _rows(loaded.transform(names)) == want
    ST.run_available(ST.score_with_bundle(spark.readStream.schema(names.schema).parquet(f"{tmp_path}/in"), loaded), f"{tmp_path}/out", f"{tmp_path}/ckpt")
    assert _rows(spark.read.parquet(f"{tmp_path}/out")) == want
    by = {r[0]: r for r in want}
    assert by["RFC_Cliente"][3] and by["RFC_Cliente"][4] == "rfc" and not by["monto_total"][3] and by["monto_total"][4] is None
    assert set(loaded.transform(names).columns) == set(COLUMNS)
    assert loaded.transform(names.limit(0)).count() == 0


def test_calibration_is_part_of_the_bundle(spark, fitted):
    binary, entity = fitted
    names = spark.createDataFrame([("rfc nuevo",), ("monto",)], "name string")
    plain = {r.name: r.prob_pii for r in scoring_bundle(binary, entity, 0.5).transform(names).collect()}
    binary.calibrator = Sigmoid(2.0, -1.0)
    moved = {r.name: r.prob_pii for r in scoring_bundle(binary, entity, 0.5).transform(names).collect()}
    binary.calibrator = None
    import math
    assert all(abs(moved[n] - 1 / (1 + math.exp(1 - 2 * p))) < 2e-4 for n, p in plain.items())


def test_one_scan(spark, fitted, tmp_path):
    spark.createDataFrame([("t", "rfc")], "tabla string, name string").write.parquet(f"{tmp_path}/n")
    plan = M.score_two_stages(spark.read.parquet(f"{tmp_path}/n"), *fitted, 0.5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "Exchange" not in plan


def test_edge_of_the_vocabulary_follows_the_names(spark):
    rows = spark.createDataFrame([([t],) for t in "gfedcba" * 2] + [(["z"] * 9,)], "words array<string>")
    for parts in (1, 5):
        counter = M.fit_text_block(rows.repartition(parts), "words", "f", 1, 4)[0]
        assert sorted(counter.vocabulary) == ["a", "b", "c", "z"]
