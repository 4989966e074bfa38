"""Newton's method against numpy, and what the scoring plans read."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablescout.operators import calibration as C, evaluate as E, models as M


def newton(x, t, penalty=1.0):
    a = b = 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-(a * x + b)))
        g = np.array([((p - t) * x).sum() + penalty * a, (p - t).sum()])
        h = p * (1 - p)
        step = np.linalg.solve(np.array([[(h * x * x).sum() + penalty, (h * x).sum()], [(h * x).sum(), h.sum()]]), g)
        a, b = a - step[0], b - step[1]
    return a, b


@pytest.mark.parametrize("seed, shift", [(1, 0.0), (2, 3.0)])
def test_sigmoid_against_numpy(spark, seed, shift):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=300) * 2 + shift, 2)
    t = (x - shift + rng.normal(size=300) > 0.5).astype(int)
    df = spark.createDataFrame([(float(u), int(v)) for u, v in zip(x, t)], "oof_raw double, y int").repartition(3)
    fit = C.fit_sigmoid(df)
    assert np.allclose((fit.slope, fit.intercept), newton(x, t), atol=1e-6)


def test_sigmoid_of_separable_single_class_and_empty_scores(spark):
    apart = spark.createDataFrame([(-5.0, 0), (-4.0, 0), (4.0, 1), (5.0, 1), (None, 1), (float("nan"), 0), (1.0, None)], "oof_raw double, y int")
    fit = C.fit_sigmoid(apart)
    assert np.allclose((fit.slope, fit.intercept), newton(np.array([-5.0, -4, 4, 5]), np.array([0, 0, 1, 1])), atol=1e-6)
    one = C.fit_sigmoid(apart.filter("y = 1"))
    assert np.isfinite(one.slope) and np.isfinite(one.intercept)
    assert C.fit_sigmoid(apart.limit(0)) == C.Sigmoid(0.0, 0.0)


def rows_of(spark, n=60):
    rows = [(f"name{i}", ["^na", "x" if i % 3 else "y", f"g{i % 7}"], ["w"], int(i % 3 == 0), "a" if i % 2 else "b") for i in range(n)]
    return spark.createDataFrame(rows, "name string, grams array<string>, words array<string>, y int, entity string")


def test_folds_are_averaged(spark):
    rows = rows_of(spark)
    model = C.calibrated_over_folds(rows, lambda r: M.fit_binary(r, kind="svm", min_df=1, char_features=20, word_features=3), F.col("name"), 3)
    assert len(model.members) == 3
    out = model.score(rows, "p").collect()
    assert all(0 < r.p < 1 for r in out) and np.mean([r.p for r in out if r.y]) > np.mean([r.p for r in out if not r.y])


def test_two_stages_scan_their_input_once(spark, tmp_path):
    spark.createDataFrame([("t", f"telefono {i}") for i in range(20)] + [("t", f"saldo {i}") for i in range(20)], "tabla string, name string").write.parquet(str(tmp_path / "n"))
    rows = rows_of(spark)
    small = dict(min_df=1, char_features=20, word_features=3)
    a, b = M.fit_binary(rows, **small), M.fit_entity(rows, **small)
    out = M.score_two_stages(spark.read.parquet(str(tmp_path / "n")), a, b, 0.3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Exchange" not in plan and "Union" not in plan
    assert out.count() == 40 and out.filter("NOT pii AND (entity IS NOT NULL OR prob_entity IS NOT NULL)").count() == 0


def test_modes_have_one_winner(spark):
    rows = [("A/x", 0.9, 1), ("A/x", 0.2, 0), ("B/x", 0.3, 1), ("B/x", 0.8, 0), ("B/y", 0.9, 1), ("B/y", 0.1, 0), (None, 0.5, 1)]
    df = spark.createDataFrame(rows[:6], "mode string, p double, y int")
    out = {r["mode"]: r for r in E.compare_modes(df, "mode", "p", "y", contest=F.endswith("mode", F.lit("/x"))).collect()}
    assert [m for m, r in out.items() if r.ganador] == ["A/x"] and out["A/x"].f2max == 1.0 and out["A/x"].thr_f2 == 0.2
    assert E.compare_modes(df.limit(0), "mode", "p", "y").count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_fold_turns_follow_the_lightest_fold(seed):
    from tablescout.operators.splits import fold_turns
    rng = np.random.default_rng(seed)
    k = int(rng.integers(1, 8))
    sizes = sorted(rng.integers(1, [4, 30, 2000][seed % 3], rng.integers(1, 200)).tolist(), reverse=True)
    loads, want = [0] * k, []
    for n in sizes:
        f = loads.index(min(loads))
        loads[f] += n
        want.append((n, f))
    histogram = [(n, sizes.count(n)) for n in sorted(set(sizes), reverse=True)]
    got = [(n, order[t % len(order)]) for n, first, last, order in fold_turns(histogram, k) for t in range(last - first)]
    assert got == want
