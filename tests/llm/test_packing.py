import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tablescout.llm import packing
from tablescout.llm.queries import QUERIES, tokenizer_path


def test_plan_uses_each_piece_once():
    rng = np.random.default_rng(1)
    sizes = np.minimum(4096, rng.lognormal(6.5, 1.2, 5000).astype(int) + 1)
    hist = dict(zip(*(x.tolist() for x in np.unique(sizes, return_counts=True))))
    plan = packing.plan_histogram(hist, 4096)
    used = {}
    for content, copies in plan:
        assert sum(n * m for n, m in content) <= 4096
        for n, m in content:
            used[n] = used.get(n, 0) + m * copies
    assert used == hist
    assert sum(c for _, c in plan) <= 1.01 * -(-sizes.sum() // 4096) + 1


def test_pieces_and_places(spark, data):
    out = QUERIES["op7_pattern_packing"](spark, data).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    tok = Tokenizer.from_file(tokenizer_path())
    want = {}
    for i, t in docs.items():
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4")
        for p, s in enumerate(range(0, len(ids), 4096)):
            want[i, p] = (s, len(ids[s:s + 4096]), zlib.crc32(ids[s:s + 4096].tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in out} == want and len(out) == len(want)
    by = {}
    for r in out:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for v in by.values():
        end = 0
        for o, n in sorted(v):
            assert o == end
            end += n
        assert end <= 4096


@pytest.mark.parametrize("rows", [[], [(1, None), (1, ""), (None, "a 'll <|endoftext|> B's x. ,, Été... Σ."), (2, "word " * 9000), (2, "word " * 9000)]])
def test_odd_rows(spark, rows):
    d = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS length", "2 AS piece")
    out = packing.pack(d, tokenizer_path()).collect()
    tok = Tokenizer.from_file(tokenizer_path())
    n = [len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows]
    assert sorted(r.length for r in out) == sorted(min(4096, x - s) for x in n for s in range(0, x, 4096))
    assert len({(r.sequence_id, r.offset) for r in out}) == len(out)


def test_words_equal_the_tokenizer_whatever_they_hold(monkeypatch):
    rng = np.random.default_rng(5)
    marks = list("abzAZ019éÉßøÆıİªºµŉǆΩжЯ中かกิ'’-_.,;:!?\"()/<|>$") + ["e\u0301", "'s", "'LL", "n't", "\u00a0", "\u200d", "\U0001f600"]
    texts = [" ".join("".join(rng.choice(marks, rng.integers(1, 7))) for _ in range(40)) for _ in range(60)]
    texts += ["", " ", "<|endoftext|> a", "a" * 5000, "rethly. Rethly.! gestungä. ...", "I'm it's dogs' y'all ''t"]
    tok = Tokenizer.from_file(tokenizer_path())
    want = [np.array(tok.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    monkeypatch.setattr(packing, "CACHED_WORDS", 500)  # both generations turn over
    encode = packing._encoder(tokenizer_path())
    for _ in range(2):
        got = [x for a in range(0, len(texts), 7) for x in encode([t.encode() for t in texts[a:a + 7]])]
        assert [i for i, (a, b) in enumerate(zip(got, want)) if a != b] == []
