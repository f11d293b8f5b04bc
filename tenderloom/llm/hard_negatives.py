"""Hard negatives of anchor vectors: exact inner-product search by length buckets and coordinate lists.

Vectors are dealt into buckets of similar length, and each bucket into blocks of bounded size. A task
holds one block: the unit vectors' coordinates as sorted lists, with the order of the rows in each
list. For an anchor and a score to reach, a row of the block needs a cosine of at least that score
over both lengths. For each of the anchor's focus coordinates (the largest of its unit vector) this
leaves a range of feasible values; the rows in the ranges of all focus coordinates are verified by
their exact integer inner product. The score to reach rises with what was found: a first few rows
from the best end of a focus list give a lower bound of the k-th best.

Rows: those with a null id or label, a null vector, or any null or non-finite component take no part.
Of several rows under one id the least (label, components) counts. Components are held to +-2^27, so
that scores fit a long; missing components of shorter vectors are zero; zero vectors score 0. Equal
scores are ordered by id. Tables without rows or anchors give no rows.

At scale every anchor meets every block: rows are copied once per ``anchors_per_block`` anchors and
anchors once per ``rows_per_block`` rows, and a task holds one block of each, whatever the input.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tenderloom.llm import frames

RATIO = 1.25        # lengths of a bucket are within this factor
ROWS = 16_384
ANCHORS = 4_096
FOCUS = 3
SEEDS = 64
_LIMIT = float(1 << 27)


def quantise(rows: DataFrame, *, row_id: str, vector: str, label: Column, scale: int) -> DataFrame:
    """(id, label, v): the rows that take part, with floor(scale * x) of every component."""
    v = F.col(f"`{vector}`").cast("array<double>")
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    held = F.transform(v, lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(_LIMIT)), F.lit(-_LIMIT))).cast("int"))
    named = rows.where(F.col(f"`{row_id}`").isNotNull() & label.isNotNull() & v.isNotNull() & whole).select(
        F.col(f"`{row_id}`").cast("long").alias("id"), label.cast("long").alias("label"), held.alias("v"))
    return named.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.label", "r.v")


def _bucketed(rows: DataFrame, rows_per_block: int) -> tuple[DataFrame, int]:
    """The rows with the number of their block, and the number of blocks. Length classes are few (the
    powers of RATIO that a length can be), so their counts may reach the driver."""
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    length = F.when(square == 0, F.lit(-1)).otherwise(F.floor(F.log(square) / (2 * math.log(RATIO))).cast("int"))
    rows = frames.stored(rows.withColumn("class", length), "vectors")
    counts = sorted((r["class"], r["n"]) for r in rows.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect())
    first, entries = 0, []
    for name, n in counts:
        pieces = -(-n // rows_per_block)
        entries += [F.lit(name), F.struct(F.lit(first).alias("first"), F.lit(pieces).alias("pieces"))]
        first += pieces
    if not entries:
        return rows.withColumn("block", F.lit(0)).drop("class"), 0
    place = F.create_map(*entries)[F.col("class")]
    block = place["first"] + F.pmod(F.xxhash64("id"), place["pieces"]).cast("int")
    return rows.withColumn("block", block).drop("class"), first


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Lists of numbers as rows of a matrix; shorter ones end in zeros."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    at = lists.offsets.to_numpy()
    sizes = np.diff(at)
    out = np.zeros((len(sizes), int(sizes.max()) if len(sizes) else 0), np.int64)
    inside = np.arange(out.shape[1]) < sizes[:, None]
    out[inside] = lists.values.to_numpy()[at[0]:at[-1]]
    return out


class Block:
    """Rows of similar length with a sorted list of every coordinate of their unit vectors."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, v: np.ndarray, focus: int = FOCUS):
        self.ids, self.labels, self.focus = ids, labels, focus
        lengths = np.sqrt((v.astype(np.float64) ** 2).sum(1))
        self.longest, self.shortest = (lengths.max(), lengths.min()) if len(ids) else (0.0, 0.0)
        unit = v / np.where(lengths == 0, 1, lengths)[:, None]
        self.order = np.argsort(unit, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(unit, self.order.T, 0).T.copy()
        # sums of products stay exact in doubles below 2^53, else long arithmetic is used
        exact = float(np.abs(v).max(initial=0)) ** 2 * max(1, v.shape[1]) < 2 ** 50
        self.v = v.astype(np.float64) if exact else v

    def scores(self, q: np.ndarray, rows: np.ndarray) -> np.ndarray:
        n = min(len(q), self.v.shape[1])
        if self.v.dtype == np.float64 and np.abs(q).max(initial=0) < _LIMIT and \
                float(np.abs(q).max(initial=0)) * float(np.abs(self.v).max(initial=0)) * max(1, n) < 2 ** 53:
            return (self.v[rows, :n] @ q[:n].astype(np.float64)).astype(np.int64)
        return self.v[rows, :n].astype(np.int64) @ q[:n]

    def _focus(self, unit: np.ndarray) -> np.ndarray:
        return np.argsort(-np.abs(unit), kind="stable")[:self.focus]

    def feasible(self, q: np.ndarray, least: float) -> np.ndarray:
        """Rows that may reach the score: those in the feasible range of every focus coordinate."""
        n = min(len(q), len(self.sorted))
        q = q[:n].astype(np.float64)
        length = math.sqrt(float(q @ q))
        if least <= 0 and (length == 0 or self.shortest == 0):
            return np.arange(len(self.ids))
        if length * self.longest == 0:
            return np.zeros(0, np.int64)
        need = least / (length * (self.longest if least > 0 else self.shortest)) - 1e-9
        if need > 1:
            return np.zeros(0, np.int64)
        if need <= -1:
            return np.arange(len(self.ids))
        unit, reach = q / length, math.acos(need)
        focus = self._focus(unit)
        met = np.zeros(len(self.ids), np.int8)
        for f in focus:
            angle = math.acos(min(1.0, max(-1.0, unit[f])))
            low, high = math.cos(min(math.pi, angle + reach)) - 1e-9, math.cos(max(0.0, angle - reach)) + 1e-9
            a, b = np.searchsorted(self.sorted[f], [low, high])
            b = np.searchsorted(self.sorted[f], high, "right")
            met[self.order[f, a:b]] += 1
        return np.flatnonzero(met == len(focus))

    def seeds(self, q: np.ndarray, fits: np.ndarray, n: int) -> np.ndarray:
        """A few fitting rows from the end of a focus list at which products are largest."""
        width = min(len(q), len(self.sorted))
        if not width:
            return np.flatnonzero(fits)[:n]
        f = int(self._focus(q[:width].astype(np.float64))[0])
        rows = self.order[f] if q[f] < 0 else self.order[f, ::-1]
        return rows[fits[rows]][:n]

    def best(self, q: np.ndarray, fits: np.ndarray, spans: list[tuple[float, float]], k: int) -> list[np.ndarray]:
        """For each span of scores the k best fitting rows in it, as (row, score) pairs in order."""
        spans_in = [(low, high) for low, high in spans if low <= high]
        if not spans_in or not fits.any():
            return [np.zeros((0, 2), np.int64) for _ in spans]
        tried = np.sort(self.scores(q, self.seeds(q, fits, max(SEEDS, 4 * k))))[::-1]
        least = math.inf
        for low, high in spans_in:
            inside = tried[(tried >= low) & (tried <= high)]
            least = min(least, float(inside[k - 1]) if len(inside) >= k else low)
        rows = self.feasible(q, least)
        rows = rows[fits[rows]]
        scores = self.scores(q, rows)
        reached = scores >= least
        rows, scores = rows[reached], scores[reached]
        order = np.lexsort((self.ids[rows], -scores))
        rows, scores = rows[order], scores[order]
        out = []
        for low, high in spans:
            a = int(np.searchsorted(-scores, -high, "left")) if high < math.inf else 0
            found = slice(a, a + k if low <= high else a)
            inside = scores[found] >= low
            out.append(np.stack((rows[found][inside], scores[found][inside]), 1))
        return out


def _with_anchors(rows: DataFrame, n_blocks: int, anchors: DataFrame, anchor_blocks: int, run, schema: str) -> DataFrame:
    """Runs a function on every block of rows with every block of anchors."""
    spread = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1))))
    copies = anchors.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(anchor_blocks)).cast("int")) \
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(max(0, n_blocks - 1)))))

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        numbers = lambda t, c: t.column(c).to_numpy()
        block = Block(numbers(left, "id"), numbers(left, "label"), _matrix(left.column("v")))
        return run(block, right, numbers(right, "id"), numbers(right, "label"), _matrix(right.column("v")))

    return spread.groupBy("block", "part").cogroup(copies.groupBy("block", "part")).applyInArrow(work, schema)


def _table(columns: Iterator | list, names: list[str]) -> pa.Table:
    return pa.table([pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for c in columns], names=names)


def _near(block: Block, _: pa.Table, ids: np.ndarray, labels: np.ndarray, v: np.ndarray, k: int) -> pa.Table:
    """The k best rows of each anchor's own label, in this block."""
    out: list[list] = [[], [], []]
    for anchor, label, q in zip(ids, labels, v):
        found = block.best(q, (block.labels == label) & (block.ids != anchor), [(-math.inf, math.inf)], k)[0]
        for column, made in zip(out, (np.full(len(found), anchor), block.ids[found[:, 0]], found[:, 1])):
            column.append(made)
    return _table(out, ["anchor_id", "positive_id", "positive_score"])


def _far(block: Block, anchors: pa.Table, ids: np.ndarray, labels: np.ndarray, v: np.ndarray, k: int,
         low: int, high: int) -> pa.Table:
    """For each anchor and positive, the k best rows of other labels within its span, in this block."""
    positives = anchors.column("positives").to_pylist()
    out: list[list] = [[] for _ in range(5)]
    for anchor, label, q, known in zip(ids, labels, v, positives):
        spans = [(-(-low * p["positive_score"] // 100), high * p["positive_score"] // 100) for p in known]
        for p, found in zip(known, block.best(q, block.labels != label, spans, k)):
            for column, made in zip(out, (np.full(len(found), anchor), np.full(len(found), p["positive_id"]),
                                          np.full(len(found), p["positive_score"]), block.ids[found[:, 0]], found[:, 1])):
                column.append(made)
    return _table(out, ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])


def _first(df: DataFrame, keys: list[str], score: str, row_id: str, k: int) -> DataFrame:
    order = W.partitionBy(*keys).orderBy(F.desc(score), row_id)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, anchors: Column, *, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         rows_per_block: int = ROWS, anchors_per_block: int = ANCHORS) -> DataFrame:
    """Hard negatives of quantised rows (id, label, v).

    ``anchors`` is the condition on ``id`` that makes a row an anchor. Its positives are the first rows
    of its own label, by score; for each positive the first rows of other labels whose score is between
    ``low`` and ``high`` percent of the positive's are returned, ranked from 1 by score, then id.
    """
    dealt, n_blocks = _bucketed(rows, rows_per_block)
    asked = dealt.where(anchors).select("id", "label", "v")
    parts = max(1, -(-asked.count() // anchors_per_block))
    near = _with_anchors(dealt, n_blocks, asked, parts, lambda *a: _near(*a, positives),
                         "anchor_id long, positive_id long, positive_score long")
    own = _first(near, ["anchor_id"], "positive_score", "positive_id", positives).groupBy("anchor_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("positives"))
    known = frames.stored(asked.join(own, asked["id"] == own["anchor_id"]).drop("anchor_id"), "anchors")
    far = _with_anchors(dealt, n_blocks, known, parts, lambda *a: _far(*a, negatives, low, high),
                        "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    return _first(far, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
