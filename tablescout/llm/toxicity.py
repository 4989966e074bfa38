"""Toxicity of whole texts by a bidirectional gated recurrent network with attention pooling.

Inputs of each word: an embedding of the word and the mean of embeddings of its character pieces (prefixes and all trigrams), both hashed.
Longer runs than LETTERS letters and digits are split into successive words, so that the windows cover them whole.
A window of WINDOW words runs through a gated recurrent unit in both directions; attention pools its states into a score.
Windows overlap by half and cover the whole text; the highest window is the text's score. The network is trained in numpy on
the driver from at most `per_class` labelled rows of each class (texts up to TRAIN_CHARS characters), the windows of a text
sharing its label through their softmax weights first and through the highest window later. Scoring runs on the executors.

Cases: a null or empty text is one window of padding and gets a score; without labelled rows of both classes every score is the share of
toxic ones (0 without any); rows of equal id are scored one by one; a null id is never held out; id, source, lang and labels
are no inputs of a score; other columns play no part.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tablescout.llm.common import arrow_map

WINDOW, STRIDE = 24, 12
WORDS, PIECES = 2**14, 2**13  # hash buckets of words and of character pieces
DIM, HIDDEN, ATTEND = 12, 8, 8
TRAIN_CHARS = 50_000
CACHED_WORDS = 200_000  # of a task
LETTERS, PREFIXES = 24, (3, 4, 5)  # letters of a word at most, longer ones are split; ends of the prefixes
WORD = re.compile(r"[^\W_]+")


def split_words(text: str) -> list[str]:
    """Words of a text; a run of more than LETTERS letters and digits counts as successive words of LETTERS of them, the last one shorter."""
    found = WORD.findall(text.lower())
    if all(len(w) <= LETTERS for w in found):
        return found
    return [w[a:a + LETTERS] for w in found for a in range(0, len(w), LETTERS)]


def pieces(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of words, buckets of the character pieces of all words one after the other (trigrams with both ends marked, prefixes),
    and where the pieces of each word start. Of a word, all bytes take part."""
    raw = [w.encode() for w in words]
    mix = lambda x: (x ^ (x >> np.uint64(15))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    # each word as a mark, its bytes and a zero; its trigrams start at all places but the last two
    flat = np.frombuffer(b"".join([b"^" + w + b"\0" for w in raw]), np.uint8).astype(np.uint64)
    start = np.concatenate(([0], np.cumsum(size + 2)))[:-1]
    tri = flat[:-2] * np.uint64(2654435761) + flat[1:-1] * np.uint64(40503) + flat[2:] * np.uint64(2246822519)
    of = np.repeat(np.arange(len(raw)), size)
    at = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + start[of]
    parts, owner = [mix(tri[at])], [of]
    whole, live = np.zeros(len(raw), dtype=np.uint64), np.arange(len(raw))
    for i in range(int(size.max(initial=0)) + 1):
        live = live[size[live] >= i]
        whole[live] = whole[live] * np.uint64(31 if i else 1) + flat[start[live] + i]
        if i in PREFIXES:
            parts.append(mix(whole[live] + np.uint64(i)))
            owner.append(live)
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    count = np.bincount(owner, minlength=len(raw))
    slot = (np.concatenate(parts) % np.uint64(PIECES)).astype(np.int64)[order]
    return (mix(whole) % np.uint64(WORDS)).astype(np.int64), slot, np.concatenate(([0], np.cumsum(count)))


def windows(n: int) -> range:
    return range(0, max(1, n - (WINDOW - STRIDE)), STRIDE)


def frames(ids: np.ndarray) -> np.ndarray:
    """Word numbers (0: padding) of all windows of a text."""
    starts = np.fromiter(windows(len(ids)), np.int64)
    padded = np.zeros(starts[-1] + WINDOW, dtype=np.int64)
    padded[:len(ids)] = ids
    return padded[starts[:, None] + np.arange(WINDOW)]


def sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Weights in `p`; embeddings of words and pieces, two recurrent units, attention, output."""

    def __init__(self, seed: int = 1):
        g = np.random.default_rng(seed)
        n = lambda *s: (g.standard_normal(s) * 0.3).astype(np.float32)
        h = HIDDEN
        self.p = {"word": n(WORDS, DIM) * 0.3, "piece": n(PIECES, DIM), "va": n(ATTEND), "wa": n(2 * h, ATTEND), "ba": np.zeros(ATTEND, np.float32),
                  "wo": n(2 * h), "bo": np.zeros(1, np.float32)}
        for d in "fb":
            self.p |= {f"w{d}": n(2 * DIM, 3 * h), f"u{d}": n(h, 3 * h), f"c{d}": np.zeros(3 * h, np.float32)}
        self.m = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.t = 0

    def inputs(self, w: np.ndarray, slot: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Embeddings of words given by their buckets, next to the means of those of their pieces."""
        if not len(w):
            return np.zeros((0, 2 * DIM), np.float32)
        mean = np.add.reduceat(self.p["piece"][slot], ends[:-1]) / np.diff(ends)[:, None].astype(np.float32)
        return np.concatenate((self.p["word"][w], mean), axis=1)

    def gates(self, x: np.ndarray) -> np.ndarray:
        """What the words add to the gates of both directions; row 0 is the padding."""
        rows = np.concatenate((x @ self.p["wf"] + self.p["cf"], x @ self.p["wb"] + self.p["cb"]), axis=1)
        return np.concatenate((np.zeros((1, 6 * HIDDEN), np.float32), rows)).astype(np.float32)

    def forward(self, gates: np.ndarray, f: np.ndarray, keep: bool = False):
        """Score of each window (row of word numbers); with `keep` also what the gradient needs."""
        h3, h = 3 * HIDDEN, HIDDEN
        states = np.empty((WINDOW, len(f), 2 * h), dtype=np.float32)
        trail = {"f": [None] * WINDOW, "b": [None] * WINDOW}
        for d, u, lo, order in (("f", self.p["uf"], 0, range(WINDOW)), ("b", self.p["ub"], h3, range(WINDOW - 1, -1, -1))):
            s = np.zeros((len(f), h), dtype=np.float32)
            for t in order:
                x = gates[f[:, t], lo:lo + h3]
                y = s @ u
                zr = sigmoid(x[:, :2 * h] + y[:, :2 * h])
                z, r = zr[:, :h], zr[:, h:]
                n = np.tanh(x[:, 2 * h:] + r * y[:, 2 * h:])
                new = n + z * (s - n)
                if keep:
                    trail[d][t] = (s, z, r, n, y[:, 2 * h:])
                s = new
                states[t, :, (h if d == "b" else 0):(2 * h if d == "b" else h)] = s
        a = np.tanh(states @ self.p["wa"] + self.p["ba"])
        e = a @ self.p["va"] - 1e4 * (f.T == 0)
        alpha = np.exp(e - e.max(axis=0))
        alpha /= alpha.sum(axis=0)
        c = np.einsum("tn,tnk->nk", alpha, states)
        out = c @ self.p["wo"] + self.p["bo"][0]
        return (out, (states, trail, a, alpha, c)) if keep else out

    def backward(self, gates, f, kept, dout):
        """Gradients of the weights, and of the gate inputs of each word number."""
        states, trail, a, alpha, c = kept
        p, h, g = self.p, HIDDEN, {}
        g["wo"], g["bo"] = c.T @ dout, np.array([dout.sum()], np.float32)
        dc = dout[:, None] * p["wo"]
        dalpha = np.einsum("nk,tnk->tn", dc, states)
        ds = alpha[:, :, None] * dc
        de = alpha * (dalpha - (alpha * dalpha).sum(axis=0))
        g["va"] = np.einsum("tn,tna->a", de, a)
        da = de[:, :, None] * p["va"] * (1 - a * a)
        g["wa"], g["ba"] = np.einsum("tnk,tna->ka", states, da), da.sum(axis=(0, 1))
        ds = ds + da @ p["wa"].T
        dgates = np.zeros_like(gates)
        for d, lo, order in (("f", 0, range(WINDOW - 1, -1, -1)), ("b", 3 * h, range(WINDOW))):
            u = p[f"u{d}"]
            du, back = np.zeros_like(u), np.zeros((len(f), h), np.float32)
            for t in order:
                s, z, r, n, yn = trail[d][t]
                dh = ds[t, :, (h if d == "b" else 0):(2 * h if d == "b" else h)] + back
                dn = dh * (1 - z) * (1 - n * n)
                dz = dh * (s - n) * z * (1 - z)
                dr = dn * yn * r * (1 - r)
                dy = np.concatenate((dz, dr, dn * r), axis=1)
                du += s.T @ dy
                back = dh * z + dy @ u.T
                np.add.at(dgates, (f[:, t], slice(lo, lo + 3 * h)), np.concatenate((dz, dr, dn), axis=1))
            g[f"u{d}"] = du
        dgates[0] = 0
        return g, dgates

    def step(self, g: dict, rate: float) -> None:
        self.t += 1
        for k, x in g.items():
            self.m[k] += 0.1 * (x - self.m[k])
            self.v[k] += 0.01 * (x * x - self.v[k])
            self.p[k] -= (rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.99**self.t)) + 1e-6)).astype(np.float32)


def train(texts: list[str], labels: list[int], epochs: int = 6, rate: float = 0.01, seed: int = 1) -> Network:
    net, rng = Network(seed), np.random.default_rng(seed)
    number: dict[str, int] = {}
    docs = [frames(np.array([number.setdefault(w, len(number) + 1) for w in split_words(t)], dtype=np.int64)) for t in texts]
    all_w, all_slot, all_ends = pieces(list(number))
    y = np.array(labels, dtype=np.float32)
    for epoch in range(epochs):
        order = rng.permutation(len(docs))
        for lot in np.array_split(order, max(1, len(order) // 48)):
            f = np.concatenate([docs[i] for i in lot])
            used, f = np.unique(np.concatenate(([0], f.ravel())), return_inverse=True)
            f = f[1:].reshape(-1, WINDOW)
            w, lo, n = all_w[used[1:] - 1], all_ends[used[1:] - 1], np.diff(all_ends)[used[1:] - 1]
            ends = np.concatenate(([0], np.cumsum(n)))
            slot = all_slot[np.repeat(lo - ends[:-1], n) + np.arange(ends[-1])]
            x = net.inputs(w, slot, ends)
            gates = net.gates(x)
            s = np.concatenate([net.forward(gates, f[a:a + 4096]) for a in range(0, len(f), 4096)])
            at, pick, grad = 0, [], []
            for i in lot:
                own = s[at:at + len(docs[i])]
                if epoch < 2:
                    share = np.exp(own - own.max())
                    share /= share.sum()
                    best = np.argsort(-share, kind="stable")[:8]
                    error = sigmoid((share * own).sum()) - y[i]
                else:
                    best, share = np.array([int(own.argmax())]), np.ones(len(own))
                    error = sigmoid(own.max()) - y[i]
                pick.append(at + best)
                grad.append(error * share[best] / len(lot))
                at += len(own)
            f = f[np.concatenate(pick)]
            _, kept = net.forward(gates, f, keep=True)
            g, dg = net.backward(gates, f, kept, np.concatenate(grad).astype(np.float32))
            dg, h3 = dg[1:], 3 * HIDDEN
            g |= {"wf": x.T @ dg[:, :h3], "cf": dg[:, :h3].sum(axis=0), "wb": x.T @ dg[:, h3:], "cb": dg[:, h3:].sum(axis=0)}
            dx = dg[:, :h3] @ net.p["wf"].T + dg[:, h3:] @ net.p["wb"].T
            g["word"], g["piece"] = np.zeros_like(net.p["word"]), np.zeros_like(net.p["piece"])
            live = np.flatnonzero(np.abs(dg).max(axis=1, initial=0) > 0)
            np.add.at(g["word"], w[live], dx[live, :DIM])
            own = np.repeat(np.arange(len(n)), n)
            own, slot = (c[np.isin(own, live)] for c in (own, slot))
            np.add.at(g["piece"], slot, (dx[:, DIM:] / n[:, None].astype(np.float32))[own])
            net.step(g, rate * (0.3 if epoch >= epochs - 2 else 1))
    return net


class Scorer:
    """Scores texts; keeps the gate inputs of the words it has seen."""

    def __init__(self, net: Network):
        self.net, self.number, self.rows = net, {}, np.zeros((CACHED_WORDS + 1, 6 * HIDDEN), np.float32)  # row 0 is the padding

    def _numbers(self, words: list[list[str]]) -> None:
        new = list(set().union(*words).difference(self.number))
        if len(self.number) + len(new) > CACHED_WORDS:
            self.number = {}
            new = list(set().union(*words))
            if len(new) >= len(self.rows):
                self.rows = np.zeros((len(new) + 1, 6 * HIDDEN), np.float32)
        base = len(self.number) + 1
        self.number.update(zip(new, range(base, base + len(new))))
        for a in range(0, len(new), 10000):
            part = new[a:a + 10000]
            self.rows[base + a:base + a + len(part)] = self.net.gates(self.net.inputs(*pieces(part)))[1:]

    def __call__(self, texts: list[str]) -> np.ndarray:
        words = [split_words(t) for t in texts]
        self._numbers(words)
        f = [frames(np.fromiter(map(self.number.__getitem__, w), np.int64, len(w))) for w in words]
        ends = np.cumsum([len(x) for x in f])
        f = np.concatenate(f)
        s = np.concatenate([self.net.forward(self.rows, f[a:a + 2048]) for a in range(0, len(f), 2048)])
        return sigmoid(np.maximum.reduceat(s.astype(np.float64), np.concatenate(([0], ends[:-1]))))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int, id_col: str, text_col: str) -> tuple[list[str], list[int]]:
    known = labels.select(F.col("doc_id").alias("i"), F.col("toxic").cast("int").alias("y")).filter("y IN (0, 1)").groupBy("i").agg(F.max("y").alias("y")).filter(~held_out(F.col("i")))
    some = known.filter("y = 1").orderBy(F.xxhash64("i"), "i").limit(per_class).union(known.filter("y = 0").orderBy(F.xxhash64("i"), "i").limit(per_class))
    d = docs.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").alias("t")).filter(F.length("t") <= TRAIN_CHARS)
    rows = d.join(F.broadcast(some), "i").dropDuplicates(["i"]).select("i", "y", "t").collect()  # at most 2 * per_class
    rows.sort(key=lambda r: r["i"])
    return [r["t"] for r in rows], [r["y"] for r in rows]


def score_texts(docs: DataFrame, labels: DataFrame, per_class: int = 1200, id_col: str = "doc_id", text_col: str = "text", epochs: int = 6) -> DataFrame:
    """`_row` (all columns of `docs`), held_out, score, predicted."""
    texts, y = training_rows(docs, labels, per_class, id_col, text_col)
    net = train(texts, y, epochs) if len(set(y)) == 2 else None
    share = float(sum(y)) / max(1, len(y))
    schema = docs.schema

    def run(batches):
        scorer = Scorer(net) if net else None  # of this task: an idle worker holds no words while other stages need the memory
        for b in batches:
            rows = b.column("_row").field(text_col)
            for a in range(0, b.num_rows, 500):
                t = [x.as_py() or "" for x in rows[a:a + 500]]
                score = scorer(t) if scorer else np.full(len(t), share)
                part = b.slice(a, 500)
                yield pa.RecordBatch.from_arrays([part.column("_row"), pa.array(score, pa.float64())], names=["_row", "score"])

    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    out = d.mapInArrow(run, f"_row {schema.simpleString()}, score double")
    return out.select("_row", held_out(F.col(f"_row.`{id_col}`")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
