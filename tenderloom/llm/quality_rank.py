"""Quality classifier: Bradley-Terry ranking of documents by pairwise preferences.

Of two labelled documents the better one is preferred; the probability of that is the logistic
function of the difference of their scores, and a score is linear in the features of the text.
Weights are fitted to random pairs of a bounded sample of labelled rows, on feature differences.
The threshold is the quantile of the scores of all labelled rows that leaves as many of them below
it as the labels call bad. ``score`` is the logistic function of the distance to it.

Features see nothing but the whole text. They are computed in the tasks; the driver sees only
the features of the sample (at most ``sample`` documents of each label) and counts of scores.

Defined cases: null, empty and blank texts have the features of zero words and get a score like
any other; without labels of both kinds every score is 0.5; repeated rows are judged alike; other
columns pass through, and those named like the outputs are replaced; null labels or ids teach nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderloom.llm import frames
from tenderloom.llm.words import Words, mix, window_mask, windows, word_blocks

SAMPLE = 3000               # labelled documents of each label
PAIRS = 40_000
STEPS = 400
BINS = 1024
SEED = 7

_SIGNS = {name: np.isin(np.arange(256), np.frombuffer(chars, np.uint8)) for name, chars in {
    "marks": b"#*$%&<>^~_=+@\\", "bar": b"|", "shout": b"!?", "stop": b".,;:", "digit": b"0123456789",
    "upper": bytes(range(0x41, 0x5B)), "letter": bytes([*range(0x41, 0x5B), *range(0x61, 0x7B)]),
}.items()}
N_FEATURES = 13


def _per_text(flags: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return np.diff(total[starts]).astype(np.float64)


def _repeats(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """How many values of each row equal another value of it that is counted already."""
    keys = mix(values + mix(rows.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys), bool)
    same[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    return np.bincount(rows[same], minlength=n).astype(np.float64)


def features(block: Words) -> np.ndarray:
    """A row of N_FEATURES numbers for each text of the block."""
    n = len(block)
    words = block.counts.astype(np.float64)
    rows = block.row_of_word
    h = block.hashes() if len(rows) else np.zeros(0, np.uint64)
    signs = {k: _per_text(v[block.data], block.text_starts) for k, v in _SIGNS.items()}
    per_word = lambda x: np.minimum(x / np.maximum(words, 1), 4)
    share = lambda x, of: x / np.maximum(of, 1)
    length = np.bincount(rows, weights=block.ends - block.starts, minlength=n)
    nearby = np.zeros(len(h), bool)
    for step in (1, 2, 3):
        if len(h) > step:
            nearby[step:] |= (h[step:] == h[:-step]) & (rows[step:] == rows[:-step])
    triples = np.zeros(n)
    if len(h) > 2:
        ok = window_mask(block, 3)
        triples = _repeats(windows(h, 3)[ok], rows[:-2][ok], n)
    breaks = block.data == 0x0A
    line_of = np.cumsum(breaks)                             # lines are told apart by their words
    lines = np.zeros(n)
    repeated_lines = np.zeros(n)
    if len(h):
        line = line_of[block.starts]
        first = np.flatnonzero(np.concatenate(([True], (line[1:] != line[:-1]) | (rows[1:] != rows[:-1]))))
        place = np.arange(len(h)) - np.repeat(first, np.diff(np.concatenate((first, [len(h)]))))
        sums = np.add.reduceat(mix(h + place.astype(np.uint64)), first)
        lines = np.bincount(rows[first], minlength=n).astype(np.float64)
        repeated_lines = _repeats(sums, rows[first], n)
    return np.column_stack([
        np.log1p(words), share(length, words) / 8, np.sqrt(per_word(signs["marks"])), np.sqrt(per_word(signs["bar"])),
        np.sqrt(per_word(signs["shout"])), share(signs["upper"], signs["letter"]), per_word(signs["stop"]),
        per_word(signs["digit"]), np.sqrt(share(_spread(nearby, rows, n), words)), np.sqrt(share(triples, words)),
        np.sqrt(share(repeated_lines, lines)), np.log1p(share(words, lines)), (words < 5).astype(np.float64),
    ])


def _spread(flags: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows[flags], minlength=n).astype(np.float64)


def _all_features(column: pa.Array) -> np.ndarray:
    parts = [features(b) for b in word_blocks(column, "space", lower=False)]
    return np.concatenate(parts) if parts else np.zeros((0, N_FEATURES))


@dataclass
class Model:
    """Standardised linear scores, the threshold on them, and the scale of the logistic function."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float
    scale: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip((self.raw(x) - self.threshold) / self.scale, -30, 30)))


def fit_pairs(x: np.ndarray, good: np.ndarray, share_bad: float, *, pairs: int = PAIRS, steps: int = STEPS,
              seed: int = SEED) -> Model:
    """Weights from preference pairs (a good document over a bad one), by logistic loss on feature
    differences; the threshold from the share of bad labels."""
    neutral = Model(np.zeros(x.shape[1]), np.ones(x.shape[1]), np.zeros(x.shape[1]), 0.0, 1.0)
    up, down = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(up) or not len(down):
        return neutral
    rng = np.random.default_rng(seed)
    model = Model(x.mean(0), x.std(0) + 1e-6, np.zeros(x.shape[1]), 0.0, 1.0)
    z = np.clip((x - model.mean) / model.spread, -8, 8)
    difference = z[rng.choice(up, pairs)] - z[rng.choice(down, pairs)]
    w, m, v = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for t in range(1, steps + 1):
        margin = np.clip(difference @ w, -30, 30)
        g = -(difference / (1 + np.exp(margin))[:, None]).mean(0) + 1e-4 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    model.weights = w
    raw = model.raw(x)
    # quantile of the scores of all labelled rows: the sample holds the two labels in other shares
    weight = np.where(good, (1 - share_bad) / len(up), share_bad / len(down))
    order = np.argsort(raw)
    below = np.cumsum(weight[order])
    k = min(int(np.searchsorted(below, share_bad - 1e-12)), len(raw) - 1)
    lower, upper = raw[order[k]], raw[order[min(k + 1, len(raw) - 1)]]
    model.threshold = float((lower + upper) / 2)
    model.scale = float(max(1e-3, np.std(raw) / 4))
    return model


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        sample: int = SAMPLE) -> Model:
    """Weights from a bounded sample of the labelled rows, taken by the hash of the id, and the
    threshold from all of them."""
    known = labels.select(F.col(doc_id).alias("_id"), (F.col(label) > 0).alias("_good")).dropna().distinct()
    shares = {r["_good"]: r["n"] for r in known.groupBy("_good").agg(F.count("*").alias("n")).collect()}
    empty = np.zeros((0, N_FEATURES))
    if len(shares) < 2:
        return fit_pairs(empty, np.zeros(0, bool), 0.5)
    by_hash = [F.xxhash64("_id"), "_id"]
    chosen = known.where("_good").orderBy(*by_hash).limit(sample).unionByName(
        known.where("NOT _good").orderBy(*by_hash).limit(sample))
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(chosen, "_id").select("_text", "_good")

    def numbers(column: pa.Array) -> list[pa.Array]:
        return [pa.array(_all_features(column).tolist(), pa.list_(pa.float64()))]

    made = frames.map_texts(rows, "_text", [T.StructField("x", T.ArrayType(T.DoubleType()))], numbers, keep=False).collect()
    x = np.array([r["x"] for r in made]).reshape(-1, N_FEATURES)
    good = np.array([r["_good"] for r in made], bool)
    order = np.lexsort((*x.T, good))                        # the same model whatever order the rows came in
    model = fit_pairs(x[order], good[order], shares[False] / (shares[True] + shares[False]))
    if good.all() or not good.any():
        return model

    def raw(column: pa.Array) -> list[pa.Array]:
        return [pa.array(model.raw(_all_features(column)), pa.float64())]

    # every document is scored, so that no text is shuffled
    every = frames.map_texts(docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")), "_text",
                             [T.StructField("raw", T.DoubleType())], raw, keep=False)
    scores = frames.stored(every.join(known, "_id").select("raw", "_good"), "scores")
    model.threshold = cut(scores, scores.where("NOT _good").count())
    return model


def cut(scores: DataFrame, below: int) -> float:
    """The middle between the raw scores of rank ``below`` and the next one, from the least up: counted
    in bins, and again in the bin that the rank falls in, until that bin is one value."""
    lowest, highest = scores.agg(F.min("raw"), F.max("raw")).first()
    rank = below - 1
    while lowest < highest:
        place = F.floor((F.col("raw") - lowest) / (highest - lowest) * BINS)
        bins = scores.where(F.col("raw").between(lowest, highest)).groupBy(place.alias("bin")).agg(
            F.count("*").alias("n"), F.min("raw").alias("lowest"), F.max("raw").alias("highest")).orderBy("bin").collect()
        for b in bins:
            if rank < b["n"]:
                lowest, highest = b["lowest"], b["highest"]
                break
            rank -= b["n"]
    upto, after = scores.agg(F.count_if(F.col("raw") <= lowest), F.min(F.when(F.col("raw") > lowest, F.col("raw")))).first()
    return lowest if upto > below or after is None else (lowest + after) / 2


def score(docs: DataFrame, model: Model, *, text: str = "text", keep: bool = True) -> DataFrame:
    """The documents with score (0 to 1) and predicted (1 if score >= 0.5)."""
    def judge(column: pa.Array) -> list[pa.Array]:
        s = model.score(_all_features(column))
        return [pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32), pa.int32())]

    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return frames.map_texts(docs, text, fields, judge, keep=keep)
