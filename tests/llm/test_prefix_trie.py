import hashlib
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tablescout.llm import prefix_trie
from tablescout.llm.queries import ORACLES, QUERIES
from checks.verify import connect, oracle, rows_of

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = {}
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own.setdefault(c, []).append(((t is not None, t or 0, hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()), (role, text)))
    own = {c: [x for _, x in sorted(v)] for c, v in own.items()}
    members, ends = {}, {}
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 4
        s = tuple(own.get(c - c % 20, [])[:h] + own[c][h:])
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
        ends.setdefault(s, []).append(c)
    kids = {}
    for s in members:
        if s:
            kids.setdefault(s[:-1], []).append(s)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for s, m in members.items():
        cost = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", s[-1][1])) if s else 0
        for d in range(len(s) + 1):
            leaves[s[:d]] += s not in kids
            saved[s[:d]] += cost
    return sorted((m[0], len(s), members[s[:-1]][0] if s else -1, len(m), len(kids.get(s, [])), leaves[s], saved[s],
                   hashlib.sha256(",".join(map(str, ends.get(s, []))).encode()).hexdigest()) for s, m in members.items())


def run(d):
    conv = F.col("conv")
    out = prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.turns(d), conv - conv % 20, F.crc32(conv.cast("string")) % 4)).drop("path")
    return sorted(tuple(-1 if x is None else x for x in r) for r in out.collect())


def test_query_against_brute_force_and_sql(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    df = QUERIES["op13_prefix_trie"](spark, data)
    got = [tuple(r) for r in df.collect()]
    assert sorted(tuple(-1 if x is None else x for x in r) for r in got) == brute(rows)
    cols, want = oracle(connect(data), ORACLES["op13_prefix_trie"])
    assert rows_of(df.columns, got) == rows_of(cols, want)


@pytest.mark.parametrize("conversations, turns", [(8192, 500_000), (7, 500_000), (1000, 20)])
def test_shards_join_to_the_trie_of_all(spark, monkeypatch, conversations, turns):
    """A third of the conversations are equal; other ones share beginnings; some end where others go on."""
    monkeypatch.setattr(prefix_trie, "CONVERSATIONS", conversations)
    monkeypatch.setattr(prefix_trie, "TURNS", turns)
    rows = []
    for c in range(0, 300, 2):
        n = 4 if c % 3 == 0 else c % 6
        rows += [(c, t if t % 5 else None, "user", f"w {t}" if c % 3 == 0 else f"w {t} {c % 4}" if t > 1 else f"w {t}") for t in range(n)]
    rows += [(7, t, "user", "w") for t in range(400)] + [(9, 1, None, None), (9, 1, "", ""), (9, 1, "user", "a  b\tc")]
    assert run(spark.createDataFrame(rows, SCHEMA).repartition(6)) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "x")], [(1, None, None, None), (1, None, None, None), (1, 0, "é", "x " * 40000), (None, 0, "a", "b"), (45, 0, "u", "t"), (41, 0, "u", "t")]])
def test_odd_rows(spark, rows):
    d = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS conv", "2 AS key", "3 AS pos", "4 AS n")
    assert run(d) == brute(rows)
