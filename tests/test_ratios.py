import random

import pytest
from pyspark.sql import functions as F

from tablescout.functions import ratios as R, text as T
from tablescout.operators.textsim import best_weighted_ratio


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], diagonal + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def plain(a, b):
    return 200 * common(a, b) / (len(a) + len(b)) if a or b else 100.0


def part(a, b):
    if not a or not b:
        return 100.0 if a == b else 0.0
    if len(a) > len(b):
        a, b = b, a
    best = max(plain(a, b[max(0, e - len(a)):e]) for e in range(1, len(a) + len(b)))
    return max(best, max(plain(b, a[max(0, e - len(b)):e]) for e in range(1, len(a) + len(b)))) if len(a) == len(b) else best


def weighted(a, b):
    wa, wb = sorted(a.split()), sorted(b.split())
    if not wa or not wb:
        return 0.0
    both, left, right = (" ".join(sorted(s)) for s in (set(wa) & set(wb), set(wa) - set(wb), set(wb) - set(wa)))
    factor, ja, jb = max(len(a), len(b)) / min(len(a), len(b)), " ".join(wa), " ".join(wb)
    if factor < 1.5:
        glue = lambda x, y: f"{x} {y}" if x and y else x or y
        if both and not (left and right):
            tokens = 100.0
        else:
            # what both have lines up with itself, so only what is beyond can differ
            total = len(glue(both, left)) + len(glue(both, right))
            tokens = 100 * (1 - (len(left) + len(right) - 2 * common(left, right)) / total)
            if both:
                tokens = max(tokens, plain(both, glue(both, left)), plain(both, glue(both, right)))
        return max(plain(a, b), 0.95 * plain(ja, jb), 0.95 * tokens)
    scale = 0.9 if factor <= 8 else 0.6
    some = 100.0 if both else max(part(ja, jb), part(left, right))
    return max(plain(a, b), scale * part(a, b), 0.95 * scale * some)


def pairs():
    rng = random.Random(5)
    words = ["num", "numero", "doc", "documento", "cuenta", "cta", "ñandú", "id", "tel", "telefono", "𝒳y", "x"]
    name = lambda most: " ".join(rng.choice(words) for _ in range(rng.randint(1, most)))
    out = [(name(5), name(5)) for _ in range(120)] + [(name(1), name(12)) for _ in range(40)] + [(name(30), name(30)) for _ in range(8)]
    out += [("".join(rng.choices("abc ", k=rng.randint(1, 9))), "".join(rng.choices("abc ", k=rng.randint(1, 9)))) for _ in range(120)]
    return out + [("", ""), ("", "a"), (" ", "a"), ("a", "a"), ("ab", "ba"), ("a" * 62, "a" * 62), ("a" * 63, "ab" * 63), ("a" * 124 + "b", "b" + "a" * 125)]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(pairs(), "a string, b string").repartition(4)


@pytest.mark.parametrize("column,brute", [(R.ratio, plain), (R.partial_ratio, part), (R.weighted_ratio, weighted)], ids=["ratio", "partial", "weighted"])
def test_against_brute_force(table, column, brute):
    df = table.select("a", "b", column(F.col("a"), F.col("b")).alias("s"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    for r in df.collect():
        assert r.s == pytest.approx(brute(r.a, r.b), abs=1e-9), (r.a, r.b)


def test_known_values(spark):
    one = lambda a, b: spark.range(1).select(R.weighted_ratio(F.lit(a), F.lit(b)).alias("s")).first().s
    assert one("this is a test", "this is a test!") == pytest.approx(96.551724, abs=1e-6)
    assert one("fuzzy wuzzy was a bear", "wuzzy fuzzy was a bear") == pytest.approx(95.0)
    assert one("abcd", "xxabcdxxxx") == pytest.approx(90.0)
    assert spark.range(1).select(R.weighted_ratio(F.lit(None).cast("string"), F.lit("a")).alias("s")).first().s is None


def test_dictionary(spark):
    names = ["numero_documento", "DOC cliente", "telefono2", "xyz", "", None, "tel", "fecha de nacimiento", "tel"]
    entries = ["numero documento", "telefono", "nombre cliente", "fecha"]
    d = spark.createDataFrame([(n,) for n in names], "name string")
    base = {r.name: r.b for r in d.select("name", T.base_entity("name").alias("b")).collect()}
    got = best_weighted_ratio(d, spark.createDataFrame([(e,) for e in entries], "e string"), "name", "e").collect()
    assert len(got) == len(set(names))
    for r in got:
        assert r.fuzzy_score == pytest.approx(max(weighted(base[r.name] or "", e) for e in entries), abs=1e-6), r.name
    assert best_weighted_ratio(d, spark.createDataFrame([], "e string"), "name", "e").agg(F.max("fuzzy_score")).first()[0] == 0
