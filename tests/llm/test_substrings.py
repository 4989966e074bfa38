import hashlib
import random
from collections import Counter

import pytest

from tablescout.llm import substring_dedup as S
from tablescout.llm.queries import QUERIES


def brute(rows, length):
    texts = [(i, (t or "").encode()) for i, t in dict.fromkeys(rows)]
    count = Counter(t[s:s + length] for _, t in texts for s in range(len(t) - length + 1))
    out = Counter()
    for i, t in rows:
        t = (t or "").encode()
        gone = bytearray(len(t))
        for s in range(len(t) - length + 1):
            if count[t[s:s + length]] > 1:
                gone[s:s + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def test_query_against_brute_force(spark, data):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    got = Counter(tuple(r) for r in QUERIES["op6_substring_dedup"](spark, data).collect())
    assert got == brute(rows, 400) and any(k[2] for k in got)


@pytest.mark.parametrize("hot, seed", [(20_000, 1), (20_000, 2), (2, 3), (0, 4)])
def test_random_texts(spark, monkeypatch, hot, seed):
    monkeypatch.setattr(S, "HOT", hot)
    monkeypatch.setattr(S, "RUN_ROWS", 50)
    rng = random.Random(seed)
    part = lambda: "".join(rng.choices("abé", k=rng.randint(1, 90)))
    pool = [part() for _ in range(25)]
    rows = [(n, "".join(rng.choice(pool) if rng.random() < 0.6 else part() for _ in range(rng.randint(0, 8)))) for n in range(60)]
    rows += [(100, "a" * 300), (101, None), (102, ""), (103, rows[5][1]), (103, rows[5][1]), (104, "x" * 31), (105, "x" * 31), (106, "xyz" * 50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS a", "2 AS _i").repartition(4)
    got = Counter(tuple(r) for r in S.remove_repeats(df, length=32).drop("removed").collect())
    assert got == brute(rows, 32)


def test_empty_and_null_id(spark):
    df = spark.createDataFrame([(None, "q" * 40), (1, "q" * 39 + "r")], "doc_id long, text string")
    assert S.remove_repeats(df.limit(0), 32).count() == 0
    assert {(r.doc_id, r.n_removed) for r in S.remove_repeats(df, 32).collect()} == {(None, 40), (1, 39)}


def test_merge_sorts_and_knows_prefixes():
    rng = random.Random(8)
    runs = []
    for _ in range(7):
        t = sorted("".join(rng.choices("ab", k=rng.randint(0, 12))).encode() for _ in range(rng.randint(0, 40)))
        runs.append((t, [S.common(x, y, 0) for x, y in zip([b"", *t], t)]))
    out = S.merge(runs)
    flat = [runs[r][0][k] for r, k, _ in out]
    assert flat == sorted(x for t, _ in runs for x in t)
    assert all(c == S.common(a, b, 0) for (_, _, c), a, b in zip(out[1:], flat, flat[1:]))


def test_planted_passages_of_over_50_words(spark):
    """A passage in two documents goes whole from 400 bytes on, however many words it has, and stays below; the others keep all."""
    rng, n = random.Random(12), iter(range(10**6))
    text = lambda k, size: " ".join(f"{next(n):x}".rjust(size, "w") for _ in range(k))
    rows, want = [], {}
    for k in range(60):
        words, size = rng.randint(51, 90), rng.choice([4, 5, 6, 9])
        passage = "{" + text(words, size) + "}"
        for side in range(2):
            rows.append((2 * k + side, f"{text(20, 7)}<{k}{'ab'[side]}{passage}{'ba'[side]}>{text(20, 7)}"))
            want[2 * k + side] = len(passage) if len(passage) >= 400 else 0
    rows += [(1000 + k, text(100, 7)) for k in range(40)]
    got = {r.doc_id: r.n_removed for r in S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want | {1000 + k: 0 for k in range(40)}
    assert 20 < sum(v == 0 for v in want.values()) < 100
