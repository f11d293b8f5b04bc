"""Benchmark decontamination: a broadcast set of test n-grams, scanned over training texts.

Words are runs of a-z, 0-9 and non-ASCII characters after lower-casing A-Z. A window is ten
consecutive words of a test item; an item of fewer words is one window. A document word inside
any occurrence of a window is hit. Hashes only find candidates: every hit is verified word by
word.

The items are broadcast in parts of at most ``ITEM_BYTES`` of text, counted before anything is
collected; each part is one more pass over the batch in the same task, so any number of items
works and the scan never shuffles.

Defined cases: null and empty texts (documents or items) have no words and are never hit; an
item without id hits words but is not listed; repeated items count once; repeated documents are
judged alike; an empty item table hits nothing; other columns pass through, those named like the
outputs are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderloom.llm import frames
from tenderloom.llm.words import Words, window_mask, windows, without_spans, word_blocks

WINDOW = 10
#: most bytes of item text that one broadcast holds
ITEM_BYTES = 16 << 20
_FILTER_BITS = 20

_FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_spans", T.ArrayType(T.ArrayType(T.LongType()))),   # [first word, past the last word]
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
]


class Index:
    """Windows of test items: sorted hashes, and where each window's words are."""

    def __init__(self, ids: list, texts: list, window: int = WINDOW):
        self.ids = [None if i is None else str(i) for i in ids]
        column = pa.array(texts, pa.large_string())
        self.words = next(word_blocks(column, "alnum", size=1 << 62), None)
        self.tables: dict[int, tuple] = {}
        if self.words is None:
            return
        w, h = self.words, self.words.hashes()
        first, counts = w.bounds[:-1], w.counts
        for k in np.unique(np.minimum(counts[counts > 0], window)):
            k = int(k)
            if k == window:
                at = np.flatnonzero(window_mask(w, k))
            else:
                at = first[counts == k]
            hashes = windows(h, k)[at]
            order = np.argsort(hashes, kind="stable")
            hashes, at = hashes[order], at[order]
            rows = np.searchsorted(w.bounds, at, "right") - 1
            seen = np.zeros(1 << _FILTER_BITS, bool)
            seen[hashes & np.uint64((1 << _FILTER_BITS) - 1)] = True
            self.tables[k] = (hashes, at, rows, seen)

    def scan(self, block: Words) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """Hit flag of every word, and (first word, words, item row) of every occurrence."""
        hit = np.zeros(len(block.starts) + 1, np.int64)
        found = []
        h = block.hashes() if self.tables and len(block.starts) else None
        for k, (hashes, at, rows, seen) in self.tables.items() if h is not None else ():
            w = windows(h, k)
            near = np.flatnonzero(seen[w & np.uint64((1 << _FILTER_BITS) - 1)])
            if not len(near):
                continue
            near = near[window_mask(block, k)[near]]
            lo, hi = np.searchsorted(hashes, w[near]), np.searchsorted(hashes, w[near], "right")
            texts: dict[int, list[bytes]] = {}
            for i, a, b in zip(near[lo < hi], lo[lo < hi], hi[lo < hi]):
                said = [block.word(j) for j in range(i, i + k)]
                true = False
                for j in range(a, b):
                    if j not in texts:
                        texts[j] = [self.words.word(x) for x in range(at[j], at[j] + k)]
                    if texts[j] == said:
                        true = True
                        found.append((int(i), k, int(rows[j])))
                if true:
                    hit[i] += 1
                    hit[i + k] -= 1
        return np.cumsum(hit[:-1]) > 0, found


def _judge(column: pa.Array, parts: list[Index]) -> list[pa.Array]:
    n_words, spans, n_hit, items = [], [], [], []
    for block in word_blocks(column, "alnum"):
        hit = np.zeros(len(block.starts), bool)
        named: dict[int, set] = {}
        for index in parts:
            flags, found = index.scan(block)
            hit |= flags
            if found:
                rows = np.searchsorted(block.bounds, [f[0] for f in found], "right") - 1
                for row, (_, _, item) in zip(rows, found):
                    if index.ids[item] is not None:
                        named.setdefault(int(row), set()).add(index.ids[item])
        total = np.concatenate(([0], np.cumsum(hit)))[block.bounds]
        n_words.append(block.counts)
        n_hit.append(np.diff(total))
        for row in range(len(block)):
            if total[row + 1] == total[row]:
                spans.append([])
                items.append([])
                continue
            own = hit[block.bounds[row]:block.bounds[row + 1]].astype(np.int8)
            edges = np.flatnonzero(np.diff(np.concatenate(([0], own, [0]))))
            spans.append(edges.reshape(-1, 2).tolist())
            items.append(sorted(named.get(row, ())))
    flat = lambda parts: pa.array(np.concatenate(parts) if parts else [], pa.int64())
    return [flat(n_words), pa.array(spans, pa.list_(pa.list_(pa.int64()))), flat(n_hit),
            pa.array(items, pa.list_(pa.string()))]


def _parts(items: DataFrame, id_column: str, text_column: str, window: int, part_bytes: int) -> list[Index]:
    """The items in parts of bounded size. The number of parts follows their counted bytes."""
    known = items.select(F.col(id_column).cast("string").alias("id"), F.col(text_column).cast("string").alias("text")) \
        .where(F.col("text").isNotNull())
    size = known.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    n = max(1, -(-2 * size // part_bytes)) if size > part_bytes else 1
    out = []
    for k in range(n):
        rows = known.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k).distinct().orderBy("id", "text").collect()
        out.append(Index([r["id"] for r in rows], [r["text"] for r in rows], window))
    return out


def find_items(docs: DataFrame, items: DataFrame, *, text: str = "text", item_id: str = "item_id",
               item_text: str = "text", window: int = WINDOW, part_bytes: int = ITEM_BYTES) -> DataFrame:
    """The documents with n_words, hit_spans (word ranges), n_hit and items (sorted as strings)."""
    shared = tuple(frames.Shared(docs.sparkSession, p) for p in _parts(items, item_id, item_text, window, part_bytes))
    return frames.map_texts(docs, text, _FIELDS, lambda column, *parts: _judge(column, list(parts)), shared=shared)


def _cut(column: pa.Array, parts: list[Index]) -> list[pa.Array]:
    """Texts without hit words; joins are line ends and are scanned again until nothing is hit."""
    texts = column.to_pylist()
    todo = list(range(len(texts)))
    n_cut = [0] * len(texts)
    while todo:
        again = []
        asked = pa.array([texts[i] for i in todo], pa.large_string())
        for block in word_blocks(asked, "alnum", lower=True):
            hit = np.zeros(len(block.starts), bool)
            for index in parts:
                hit |= index.scan(block)[0]
            if not hit.any():
                continue
            for row in np.unique(np.searchsorted(block.bounds, np.flatnonzero(hit), "right") - 1):
                i = todo[block.first_row + row]
                a, b = block.bounds[row], block.bounds[row + 1]
                base = block.text_starts[row]
                edges = np.flatnonzero(np.diff(np.concatenate(([0], hit[a:b].astype(np.int8), [0])))).reshape(-1, 2)
                texts[i] = without_spans(texts[i].encode(), block.starts[a:b] - base, block.ends[a:b] - base, edges)
                n_cut[i] += int(hit[a:b].sum())
                again.append(i)
        todo = sorted(again)
    return [pa.array(texts, pa.string()), pa.array(n_cut, pa.int64())]


def remove_items(docs: DataFrame, items: DataFrame, *, text: str = "text", item_id: str = "item_id",
                 item_text: str = "text", window: int = WINDOW, part_bytes: int = ITEM_BYTES) -> DataFrame:
    """The documents with every hit span cut out of the text, and n_cut words. A document of which
    no word is left is removed; one that had no words before stays as it is."""
    shared = tuple(frames.Shared(docs.sparkSession, p) for p in _parts(items, item_id, item_text, window, part_bytes))
    fields = [T.StructField(text, T.StringType()), T.StructField("n_cut", T.LongType())]
    source = frames.without(docs, ["_before"]).withColumn("_before", F.col(text))
    cut = frames.map_texts(source, "_before", fields, lambda column, *parts: _cut(column, list(parts)), keep=False, shared=shared)
    # the word class of this operator, in the regular expressions of the JVM
    return cut.where((F.col("n_cut") == 0) | F.col(text).rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"))
