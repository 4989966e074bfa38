"""Neighbour search over several slices and blocks; what the training table carries through its join."""

import math
import random
from collections import Counter

import pytest

from checks import all_queries
from tablescout.operators import textsim as X

QUERIES, _ = all_queries()


def grams(name):
    out = []
    for w in name.lower().split():
        w = f" {w} "
        for n in (2, 3, 4):
            out += [w[i:i + n] for i in range(max(len(w) - n, 0) + 1)]
            if len(w) <= n:
                break
    return Counter(out)


def brute(asked, known):
    tf = {("q", x): grams(x) for x in asked} | {("c", x): grams(x) for x in known}
    df = Counter(g for c in tf.values() for g in c)
    vec = {k: {g: n * (math.log((1 + len(tf)) / (1 + df[g])) + 1) for g, n in c.items()} for k, c in tf.items()}
    vec = {k: {g: w / math.sqrt(sum(x * x for x in v.values())) for g, w in v.items()} for k, v in vec.items()}
    best = {}
    for x in asked:
        score = {y: sum(w * vec["c", y].get(g, 0) for g, w in vec["q", x].items()) for y in known}
        y = x if x in score else min(score, key=lambda y: (-round(score[y], 9), y))
        if score[y] > 0:
            best[x] = y, round(score[y], 6)
    return best


@pytest.mark.parametrize("products", [1, 1 << 20])
def test_slices_and_blocks(spark, monkeypatch, products):
    monkeypatch.setattr(X, "SLICE", 50)
    monkeypatch.setattr(X, "BLOCK", 20)
    monkeypatch.setattr(X, "PRODUCTS", products)
    rng = random.Random(7)
    word = lambda n: "".join(rng.choices("abcdeé", k=n))
    known = sorted({f"{word(4)} {word(3)}" for _ in range(90)} | {"ab cd", "cd ab"})  # the last two have equal vectors
    asked = sorted({word(rng.randint(1, 9)) for _ in range(120)} | set(known[::9]) | {"cd ab", "ab cd", "zzz", "ab  cd"})
    q, c = (spark.createDataFrame([(x,) for x in xs], "light string") for xs in (asked, known))
    want = brute(asked, known)
    got = {r.q: (r.c, round(r.similarity / 100, 6)) for r in X.nearest_neighbours(q, c, complete=True).collect()}
    assert got == want and "zzz" not in got
    at = {r.q: r.c for r in X.nearest_neighbours(q, c, floor=0.5).collect()}
    assert at == {k: v[0] for k, v in want.items() if v[1] >= 0.5}


def test_no_catalogue(spark):
    q, c = spark.createDataFrame([("ab",)], "light string"), spark.createDataFrame([], "light string")
    assert X.nearest_neighbours(q, c, complete=True).count() == 0


def test_descriptions_stay_out_of_the_join(spark, data):
    nodes = [QUERIES["m27_training_table"](spark, data)._jdf.queryExecution().optimizedPlan()]
    for n in nodes:
        nodes += [n.children().apply(i) for i in range(n.children().size())]
    joins = [n for n in nodes if n.nodeName() == "Join"]
    assert joins
    for n in joins:
        assert "description" not in [n.output().apply(i).name() for i in range(n.output().size())]
