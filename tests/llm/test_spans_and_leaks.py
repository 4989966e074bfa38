import random
import re
from collections import defaultdict

import numpy as np
import pytest

from tablescout.llm import decontaminate, span_dedup
from tablescout.llm.queries import QUERIES


def edit_infix(item, text):
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, v in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (v != w)))
        row = new
    return min(row)


def test_leaks_of_the_test_tables(spark, data):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id): r.edits for r in QUERIES["op5_benchmark_decontamination"](spark, data).collect()}
    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    want = {}
    for d, t in docs.items():
        w = words(t)
        own = set(w)
        for k, item in items.items():
            i = words(item)
            if sum(x in own for x in i) >= 0.8 * len(i):  # else no window can match
                e = edit_infix(i, w)
                if e <= int(0.2 * len(i)):
                    want[d, k] = e
    assert want and got == want


def test_recall_over_edits():
    rng = random.Random(5)
    vocab = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(3000)]
    items = [(k, " ".join(rng.choices(vocab, k=rng.randint(12, 70)))) for k in range(150)]
    match, hit, n = decontaminate.Matcher(items, 0.8), 0, 0
    for k, t in items:
        w = t.split()
        for _ in range(int(0.2 * len(w))):
            p = rng.randrange(len(w))
            w[p:p + 1] = rng.choice([[], [rng.choice(vocab)], [w[p], rng.choice(vocab)]])
        text = rng.choices(vocab, k=200) + w + rng.choices(vocab, k=200)
        found = {x: d for x, d, _ in match(" ".join(text))}
        n += 1
        hit += k in found
        if k in found:
            assert found[k] <= int(0.2 * len(t.split()))
    assert hit / n >= 0.9
    assert match(" ".join(rng.choices(vocab, k=3000))) == []


def test_odd_rows_of_leaks(spark):
    item = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, None), (1, ""), (None, f"x. {item.upper()}!"), (3, f"{'y ' * 50000}{item}"), (3, f"{'y ' * 50000}{item}")],
                                 "doc_id long, text string").selectExpr("*", "7 AS item_id", "1 AS _i")
    bench = spark.createDataFrame([(5, item), (6, None), (7, ""), (8, "!!")], "item_id long, text string")
    out = decontaminate.matches(docs, bench).collect()
    assert {(r.doc_id, r.item_id, r.edits) for r in out} == {(None, 5, 0), (3, 5, 0)} and len(out) == 2
    kept = decontaminate.without_contaminated(docs, bench)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [1, 1]
    assert decontaminate.matches(docs.limit(0), bench).count() == 0 == decontaminate.matches(docs, bench.limit(0)).count()


def brute_spans(rows):
    """Sentences covered by any run of two or more that stood before, over runs of every length."""
    place, gone = defaultdict(list), defaultdict(set)
    for i, t in rows:
        s = [y.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for y in re.split(r"(?<=[.!?])[\x20\x09-\x0d]+|\n+", t or "")]
        s = [x for x in (tuple(w for w in re.split(r"[\x20\x09-\x0d]+", y) if w) for y in s) if x]
        for a in range(len(s)):
            run = hash(s[a])
            for b in range(a + 1, len(s)):
                run = hash((run, s[b]))
                place[run].append((0 if i is None else i, a, b, i))
    for v in place.values():
        for _, a, b, i in sorted(v, key=lambda x: x[:3])[1:]:
            gone[i] |= set(range(a, b + 1))
    return {i: sorted(v) for i, v in gone.items()}


def test_spans_against_brute_force(spark, data):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    out = QUERIES["op9_span_dedup"](spark, data).collect()
    assert {r.doc_id: r.removed for r in out} == brute_spans(rows) and len(out) > 0


@pytest.mark.parametrize("empty", [True, False])
def test_odd_rows_of_spans(spark, empty):
    long = "Some words stand here. " * 8
    rows = [(1, None), (2, ""), (3, long), (3, long), (4, "X. " + long), (None, "Y? " + long)]
    d = spark.createDataFrame([] if empty else rows, "doc_id long, text string").selectExpr("*", "1 AS first", "2 AS removed")
    out = {r.doc_id: r.removed for r in span_dedup.removed_sentences(d).collect()}
    assert out == ({} if empty else brute_spans([(3, long), (4, "X. " + long), (None, "Y? " + long)]))


def test_tails_and_short_runs(spark):
    shared = f"{'aa ' * 14}end. {'bb ' * 9}end. Just three words."
    rows = [(1, f"{shared} Then one goes on with {'x ' * 30}."), (2, f"{shared} The other ends in {'y ' * 30}."),
            (3, "Own start. Yes we can. No we cannot. Own end."), (4, "Yes we can. No we cannot. Other end."), (5, "Yes we can. Alone.")]
    out = {r.doc_id: r.removed for r in span_dedup.removed_sentences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {2: [0, 1, 2], 4: [0, 1]} == brute_spans(rows)


def test_null_and_zero_ids_are_told_apart(spark):
    rows = [(0, "One of its own."), (None, "Here it is. And again."), (7, "Here it is. And again. More."), (9, "Here it is. And again. Less.")]
    out = {r.doc_id: r.first_doc_ids for r in span_dedup.removed_sentences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {7: [None], 9: [None]}
