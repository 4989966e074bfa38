"""The regression harness, and the fixed list of names that must stay unflagged."""

from tablescout.functions import vocabulary as V
from tablescout.operators import decisions as DE, labels as L


def test_kinds_of_failure(spark):
    result = spark.createDataFrame([("a", True, "rfc"), ("a", False, None), ("b", False, None), ("c", True, "curp"), ("d", True, "rfc"),
                                    ("e", False, None), (None, True, "nss"), ("g", True, "rfc"), ("g", True, "curp")], "name string, pii boolean, entity string")
    expected = spark.createDataFrame([("a", "rfc"), ("b", "rfc"), ("c", "rfc"), ("absent", "rfc"), ("g", "curp"), ("a", "rfc")], "name string, expected_entity string")
    forbidden = spark.createDataFrame([("d",), ("e",), (None,), ("never seen",)], "name string")
    report = L.regression_report(result, expected, forbidden)
    assert {r.name: r.kind for r in report.collect()} == {"a": "ok", "b": "no_marcado", "c": "entidad", "absent": "no_marcado", "g": "ok",
                                                          "d": "falso_positivo", "e": "ok", "": "falso_positivo", "never seen": "ok"}
    assert tuple(L.regression_passes(report).first()) == (9, 2, 1, 2, False)
    assert tuple(L.regression_passes(L.regression_report(result.limit(0), expected.limit(0), forbidden)).first()) == (4, 0, 0, 0, True)


def test_names_that_must_stay_unflagged(spark):
    low = spark.createDataFrame([(n, V.MUST_NOT_FLAG_PROBABILITY) for n in V.MUST_NOT_FLAG], "name string, prob double")
    r = DE.five_level_decision(DE.with_rule_levels(DE.with_dotted_keys(low)))
    report = L.regression_report(r.withColumnRenamed("prior_entity", "entity"), low.selectExpr("name", "'' AS expected_entity").limit(0), low.select("name"))
    assert L.regression_passes(report).first()["pass"], report.filter("kind <> 'ok'").collect()
