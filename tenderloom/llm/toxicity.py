"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

The input of each word is the sum of a word vector and of the vectors of its character n-grams
(2 to 5 characters, with marks for the word's ends), all found by hashing, so unseen words and
inflected forms have inputs too. A gated recurrent unit runs over a window of ``WINDOW`` words
forwards, another one backwards; attention pools their states, and a logistic unit scores the
pool. Windows overlap by half and cover every whole text; a document has the score of its worst
window.

The model is trained on the driver with the labelled rows of a bounded sample: at most ``SAMPLE``
documents of each label, of any length. One of over ``TRAIN_WORDS`` words teaches by ``STRETCHES``
stretches of that many words together, spread evenly from its first word to its last. A document
teaches through its windows in proportion to how toxic they look.
Scoring sees whole texts only. Each distinct word of a block is looked up once, and the network
runs over all windows of a block side by side.

Defined cases: a text without words is one window of padding and gets a score; null is empty;
without labels of both kinds every score is 0 (1 if all are toxic); repeated rows are judged alike; other columns
pass through, and those named like the outputs are replaced; null labels or ids teach nothing.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderloom.llm import frames
from tenderloom.llm.words import Words, mix, word_blocks

WINDOW = 24
STRIDE = 12
SAMPLE = 1000               # labelled documents of each label
TRAIN_WORDS = 768           # words that one document teaches by
STRETCHES = 8
EPOCHS = 4
STEPS = 60                  # at least; small samples are gone through more often
INPUTS = 16
STATES = 16
WORD_ROWS = 1 << 14
GRAM_ROWS = 1 << 15
GRAMS = (2, 3, 4, 5)
SEED = 11
_SIDE_BY_SIDE = 512         # windows that run together


@dataclass
class Inputs:
    """Words of texts as rows of the vector tables, and the windows over them."""

    word: np.ndarray        # row of the word table, per distinct word (row 0 is padding)
    gram: np.ndarray        # rows of the n-gram table, distinct word after distinct word
    gram_starts: np.ndarray
    windows: np.ndarray     # distinct words of each window, padded with 0
    first: np.ndarray       # first window of each text, one more than texts


def inputs_of(block: Words) -> Inputs:
    h = block.hashes() if len(block.starts) else np.zeros(0, np.uint64)
    _, sample, which = np.unique(h, return_index=True, return_inverse=True)
    # the bytes of every distinct word between two marks
    length = (block.ends - block.starts)[sample]
    at = np.concatenate(([0], np.cumsum(length + 2)))
    data = np.ones(at[-1], np.uint64)
    place = np.arange(at[-1]) - np.repeat(at[:-1], length + 2)
    inner = (place > 0) & (place <= np.repeat(length, length + 2))
    source = np.repeat(block.starts[sample], length + 2) + place - 1
    data[inner] = block.data[source[inner]]
    rest = np.repeat(length + 2, length + 2) - place
    grams, owners = [], []
    owner = np.repeat(np.arange(len(sample)), length + 2)
    for k in GRAMS:
        if len(data) < k:
            continue
        g = np.zeros(len(data) - k + 1, np.uint64)
        for i in range(k):
            g = g * np.uint64(0x100000001B3) + data[i:i + len(g)]
        inside = rest[:len(g)] >= k
        grams.append((mix(g[inside] + np.uint64(k << 56)) % np.uint64(GRAM_ROWS)).astype(np.int32))
        owners.append(owner[:len(g)][inside])
    gram, owner = (np.concatenate(grams), np.concatenate(owners)) if grams else (np.zeros(0, np.int32), np.zeros(0, np.int64))
    order = np.argsort(owner, kind="stable")
    starts = np.searchsorted(owner[order], np.arange(len(sample) + 1))
    word = np.concatenate(([0], 1 + (h[sample] % np.uint64(WORD_ROWS - 1)).astype(np.int64))) if len(sample) else np.zeros(1, np.int64)
    # overlapping windows; the last one of a text reaches beyond its end
    counts = block.counts
    n = np.maximum(1, -(-(counts - WINDOW) // STRIDE) + 1)
    first = np.concatenate(([0], np.cumsum(n)))
    begin = np.repeat(block.bounds[:-1], n) + (np.arange(first[-1]) - np.repeat(first[:-1], n)) * STRIDE
    index = begin[:, None] + np.arange(WINDOW)
    valid = index < np.repeat(block.bounds[1:], n)[:, None]
    padded = np.append(which + 1, 0)
    windows = np.where(valid, padded[np.minimum(index, len(which))], 0)
    return Inputs(word, gram[order], np.concatenate(([0], starts)), windows, first)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class Network:
    """Parameters by name; directions are stacked on the first axis."""

    p: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def fresh(seed: int = SEED) -> Network:
        rng = np.random.default_rng(seed)
        normal = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        d, s = INPUTS, STATES
        p = {"words": normal(WORD_ROWS, d, scale=0.05), "grams": normal(GRAM_ROWS, d, scale=0.05),
             "w": normal(2, d, 3 * s, scale=d ** -0.5), "u": normal(2, s, 3 * s, scale=s ** -0.5),
             "b": np.zeros((2, 3 * s), np.float32), "a": normal(2 * s, scale=0.5), "o": normal(2 * s, scale=0.5),
             "c": np.zeros(1, np.float32)}
        p["words"][0] = 0
        return Network(p)

    def vectors(self, x: Inputs) -> np.ndarray:
        """The input vector of every distinct word; row 0 is padding."""
        out = self.p["words"][x.word].copy()
        n = np.diff(x.gram_starts)
        for k in np.unique(n[n > 0]):                           # words of equally many n-grams together
            rows = np.flatnonzero(n == k)
            grams = x.gram[x.gram_starts[rows] + np.arange(k)[:, None]]
            out[rows] += self.p["grams"].take(grams, axis=0).sum(0) / np.float32(np.sqrt(k))
        return out

    def forward(self, projected: np.ndarray, windows: np.ndarray, trace: dict | None = None) -> np.ndarray:
        """Logits of windows. projected: (2, distinct words, 3 states)."""
        s = STATES
        there = windows > 0
        full = there.all(0)
        states = np.zeros((2, WINDOW, len(windows), s), np.float32)
        gates = np.zeros((2, WINDOW, len(windows), 3 * s), np.float32) if trace is not None else None
        for k in range(2):
            u = self.p["u"][k]
            open_reset, candidate = np.ascontiguousarray(u[:, :2 * s]), np.ascontiguousarray(u[:, 2 * s:])
            h = np.zeros((len(windows), s), np.float32)
            for t in range(WINDOW) if k == 0 else range(WINDOW - 1, -1, -1):
                x = projected[k].take(windows[:, t], axis=0)
                rz = h @ open_reset
                rz += x[:, :2 * s]
                rz = _sigmoid(rz)
                r, z = rz[:, :s], rz[:, s:]
                c = (r * h) @ candidate
                c += x[:, 2 * s:]
                np.tanh(c, out=c)
                if not full[t]:
                    z = z * there[:, t, None]                   # padding leaves the state as it is
                if gates is not None:
                    gates[k, t] = np.concatenate((r, z, c), axis=1)
                h = h + z * (c - h)
                states[k, t] = h
        both = np.concatenate((states[0], states[1]), axis=2)   # step, window, both states
        e = np.where(there.T, np.tanh(both) @ self.p["a"], -30.0)
        e = np.exp(e - e.max(0))
        attention = (e / e.sum(0)).astype(np.float32)
        pool = (attention[:, :, None] * both).sum(0)
        if trace is not None:
            trace.update(states=states, gates=gates, both=both, attention=attention, pool=pool, there=there)
        return pool @ self.p["o"] + self.p["c"][0]

    def project(self, vectors: np.ndarray) -> np.ndarray:
        return np.stack([vectors @ self.p["w"][k] + self.p["b"][k] for k in range(2)])

    def gradients(self, x: Inputs, vectors: np.ndarray, windows: np.ndarray, projected: np.ndarray,
                  trace: dict, d_logit: np.ndarray) -> dict:
        """Back-propagation of the logits' gradients to all parameters; of the vector tables, (rows, sums)."""
        p, s = self.p, STATES
        g: dict = {k: np.zeros_like(v) for k, v in p.items() if k not in ("words", "grams")}
        both, attention, pool, there = trace["both"], trace["attention"], trace["pool"], trace["there"]
        g["c"][0] = d_logit.sum()
        g["o"] = pool.T @ d_logit
        d_pool = d_logit[:, None] * p["o"]
        d_att = (both * d_pool).sum(2)
        d_e = attention * (d_att - (attention * d_att).sum(0)) * there.T
        squashed = np.tanh(both)
        g["a"] = np.einsum("tb,tbs->s", d_e, squashed)
        d_both = attention[:, :, None] * d_pool + d_e[:, :, None] * p["a"] * (1 - squashed ** 2)
        d_vectors = np.zeros_like(vectors)
        flat = windows.T.ravel()
        by_word = np.argsort(flat, kind="stable")
        heads = np.flatnonzero(np.append(True, flat[by_word][1:] != flat[by_word][:-1]))
        for k in range(2):
            u = p["u"][k]
            all_gates = np.zeros((WINDOW, len(windows), 3 * s), np.float32)
            d_h = np.zeros((len(windows), s), np.float32)
            steps = list(range(WINDOW)) if k == 0 else list(range(WINDOW - 1, -1, -1))
            for i in range(WINDOW - 1, -1, -1):
                t = steps[i]
                before = trace["states"][k, steps[i - 1]] if i else np.zeros_like(d_h)
                r, z, c = np.split(trace["gates"][k, t], 3, axis=1)
                d_h = d_h + d_both[t][:, k * s:(k + 1) * s]
                d_c = d_h * z * (1 - c * c)
                d_z = d_h * (c - before) * z * (1 - z) * there[:, t, None]
                d_rh = d_c @ u[:, 2 * s:].T
                d_r = d_rh * before * r * (1 - r)
                d_gates = np.concatenate((d_r, d_z, d_c), axis=1)
                all_gates[t] = d_gates
                g["u"][k][:, :2 * s] += before.T @ d_gates[:, :2 * s]
                g["u"][k][:, 2 * s:] += (r * before).T @ d_c
                d_h = d_h * (1 - z) + d_rh * r + d_gates[:, :2 * s] @ u[:, :2 * s].T
            d_projected = np.zeros_like(projected[k])
            d_projected[flat[by_word][heads]] = np.add.reduceat(all_gates.reshape(-1, 3 * s)[by_word], heads, axis=0)
            g["w"][k] = vectors.T @ d_projected
            g["b"][k] = d_projected.sum(0)
            d_vectors += d_projected @ p["w"][k].T
        d_vectors[0] = 0
        n = np.diff(x.gram_starts)
        g["words"] = _by_row(x.word, d_vectors)
        g["grams"] = _by_row(x.gram, np.repeat(d_vectors / np.sqrt(np.maximum(n, 1))[:, None], n, axis=0))
        return g


def _by_row(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and the sums of their values."""
    order = np.argsort(rows, kind="stable")
    heads = np.flatnonzero(np.append(True, rows[order][1:] != rows[order][:-1]))
    return rows[order][heads], np.add.reduceat(values[order], heads, axis=0)


@dataclass
class Model:
    network: Network | None
    unlearnt: float = 0.0       # every score, if nothing was learnt

    def scores(self, column: pa.Array) -> np.ndarray:
        """Score of the worst window of each text."""
        out = []
        for block in word_blocks(column, "space", lower=True):
            if self.network is None:
                out.append(np.full(len(block), self.unlearnt))
                continue
            x = inputs_of(block)
            projected = self.network.project(self.network.vectors(x))
            logits = np.concatenate([self.network.forward(projected, x.windows[i:i + _SIDE_BY_SIDE])
                                     for i in range(0, len(x.windows), _SIDE_BY_SIDE)])
            out.append(_sigmoid(np.maximum.reduceat(logits, x.first[:-1]).astype(np.float64)))
        return np.concatenate(out) if out else np.zeros(0)


def train(texts: list[str], toxic: np.ndarray, *, epochs: int | None = None, seed: int = SEED, batch: int = 64) -> Model:
    """The network, by Adam on the logistic loss of a document's soft maximum over windows."""
    if not toxic.any() or toxic.all():
        return Model(None, unlearnt=float(len(toxic) > 0 and toxic.all()))
    epochs = epochs or max(EPOCHS, -(-STEPS * batch // len(texts)))
    network = Network.fresh(seed)
    rng = np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in network.p.items()}
    second = {k: np.zeros_like(v) for k, v in network.p.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for i in range(0, len(order), batch):
            chosen = order[i:i + batch]
            x = inputs_of(next(word_blocks(pa.array([texts[j] for j in chosen], pa.large_string()), "space", size=1 << 62)))
            vectors = network.vectors(x)
            projected = network.project(vectors)
            trace: dict = {}
            logits = network.forward(projected, x.windows, trace)
            n = np.diff(x.first)
            sharp = np.exp(2 * (logits - np.repeat(np.maximum.reduceat(logits, x.first[:-1]), n)))
            share = sharp / np.repeat(np.add.reduceat(sharp, x.first[:-1]), n)
            soft = np.add.reduceat(share * logits, x.first[:-1])
            wrong = (_sigmoid(soft) - toxic[chosen]) / len(chosen)
            d = (np.repeat(wrong, n) * share * (1 + 2 * (logits - np.repeat(soft, n)))).astype(np.float32)
            g = network.gradients(x, vectors, x.windows, projected, trace, d)
            step += 1
            rate = 0.01 * min(1, 2 * (1 - epoch / epochs))
            for k, v in network.p.items():
                rows, d = g[k] if isinstance(g[k], tuple) else (slice(None), g[k])     # tables: touched rows only
                first[k][rows] = 0.9 * first[k][rows] + 0.1 * d
                second[k][rows] = 0.98 * second[k][rows] + 0.02 * d * d
                v[rows] -= rate * (first[k][rows] / (1 - 0.9 ** step)) / (np.sqrt(second[k][rows] / (1 - 0.98 ** step)) + 1e-6)
    return Model(network)


def excerpt(column: pa.Array, n_words: int = TRAIN_WORDS, stretches: int = STRETCHES) -> pa.Array:
    """Texts of up to ``n_words`` words as they are, of longer ones evenly spread stretches of words."""
    size = n_words // stretches
    out = []
    for block in word_blocks(column, "space", lower=False):
        for i in range(len(block)):
            a, b = int(block.bounds[i]), int(block.bounds[i + 1])
            if b - a <= n_words:
                spans = [(block.text_starts[i], block.text_starts[i + 1])]
            else:
                firsts = a + np.arange(stretches) * (b - a - size) // (stretches - 1)
                spans = [(block.starts[f], block.ends[f + size - 1]) for f in firsts]
            out.append(b" ".join(block.data[x:y].tobytes() for x, y in spans).decode())
    return pa.array(out, pa.string())


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        sample: int = SAMPLE, words: int = TRAIN_WORDS) -> Model:
    """A model from a bounded sample of the labelled rows, taken by the hash of the id."""
    known = labels.select(F.col(doc_id).alias("_id"), (F.col(label) > 0).alias("_toxic")).dropna().distinct()
    by_hash = [F.xxhash64("_id"), "_id"]
    # more ids than the sample, as some have no document
    chosen = known.where("_toxic").orderBy(*by_hash).limit(2 * sample).unionByName(
        known.where("NOT _toxic").orderBy(*by_hash).limit(2 * sample))
    whole = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_whole")).join(chosen, "_id")
    rows = frames.map_texts(whole, "_whole", [T.StructField("_text", T.StringType())],
                            lambda column: [excerpt(column, words)], keep=False)
    both = rows.where("_toxic").orderBy(*by_hash, "_text").limit(sample).unionByName(
        rows.where("NOT _toxic").orderBy(*by_hash, "_text").limit(sample)).select("_text", "_toxic").collect()
    return train([r["_text"] for r in both], np.array([r["_toxic"] for r in both], bool))


def score(docs: DataFrame, model: Model, *, text: str = "text", keep: bool = True) -> DataFrame:
    """The documents with score (0 to 1) and predicted (1 if score >= 0.5)."""
    def judge(column: pa.Array, network: Model) -> list[pa.Array]:
        s = network.scores(column)
        return [pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32), pa.int32())]

    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return frames.map_texts(docs, text, fields, judge, keep=keep, shared=(frames.Shared(docs.sparkSession, model),))
