"""Line de-duplication by winnowing: repeated runs of text stay only where they come first.

A line here may be a whole paragraph, and repeated passages begin and end inside lines. So lines
are cut anew at every word: the line hashes are those of the stretches of ``STRETCH`` words that
begin at each word. Of every ``WINDOW`` consecutive hashes the least is a fingerprint, so that any
two equal runs of STRETCH + WINDOW - 1 = 50 words share one. Each fingerprint's earliest place in
the corpus is its source. Places that overlap at one distance from their source form one match,
which is a repeat as it is. The source of a fingerprint need not hold the whole run, so every window
of ``MIN_WORDS`` words that chose a fingerprint with several places and lies in no match is hashed
as a whole and joined with the earliest place of the same window. Thus every run of ``MIN_WORDS``
words or more that has an earlier copy is deleted, in whichever document that copy is.

Earlier means a smaller doc_id, and within a document an earlier place. A fingerprint or window is
joined only with its earliest place, never with its other places, so the rows of the joins grow
with the text and not with the square of a passage's copies. A text is read with at most one row
per fingerprint of its own.

Defined cases: null, empty and short texts stay as they are; equal texts under one id are one
document and are treated alike; of equal texts under several ids only the first stays; a
document of which no word is left is removed; documents with null ids come last; an empty table
gives an empty table; other columns pass through. ``min_words`` may not be under 50, since shorter
runs need not share a fingerprint.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderloom.llm import frames
from tenderloom.llm.words import Words, windows, windows_at, without_spans, word_blocks

STRETCH = 32
WINDOW = 19
MIN_WORDS = 50
_POSITION_BITS = 20


def chosen_positions(values: np.ndarray, valid: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows of ``width`` consecutive values that are marked valid, and the position of the
    least value of each (the last of equal ones)."""
    n = len(values) - width + 1
    if n <= 0 or not valid.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = np.uint64((1 << _POSITION_BITS) - 1)
    at = np.arange(len(values), dtype=np.uint64)
    keys = (values & ~low) | (low - (at & low))
    # least of a window = least of the rest of one block and the beginning of the next
    pad = -len(keys) % width
    grid = np.concatenate((keys, np.full(pad, ~np.uint64(0)))).reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = np.flatnonzero(valid)
    least = np.minimum(behind[starts], ahead[starts + width - 1])
    position = (low - (least & low)).astype(np.int64)
    return starts, starts + ((position - starts) & int(low))


def least_positions(values: np.ndarray, valid: np.ndarray, width: int) -> np.ndarray:
    """Positions of the least of each ``width`` consecutive values (the last of equal ones), over the
    windows marked valid."""
    return np.unique(chosen_positions(values, valid, width)[1])


def _fingerprints(batch: pa.RecordBatch, column: pa.Array) -> Iterator[tuple[pa.Array, list[pa.Array]]]:
    """Each fingerprint with its place, and the first and last window that chose it."""
    for block in word_blocks(column, "space", lower=False):
        h = block.hashes()
        hashes = windows(h, STRETCH)
        rows = block.row_of_word
        span = STRETCH + WINDOW - 1
        valid = rows[:len(rows) - span + 1] == rows[span - 1:] if len(rows) >= span else np.zeros(0, bool)
        starts, chosen = chosen_positions(hashes, valid, WINDOW)
        if not len(starts):
            continue
        order = np.lexsort((starts, chosen))
        at, first, count = np.unique(chosen[order], return_index=True, return_counts=True)
        row = rows[at]
        base = block.bounds[row]
        yield pa.array(row + block.first_row), [
            pa.array(hashes[at].view(np.int64)), pa.array(at - base),
            pa.array(starts[order[first]] - base), pa.array(starts[order[first + count - 1]] - base)]


def _covered(begins: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in one of the spans."""
    return np.cumsum(np.bincount(begins, minlength=n + 1) - np.bincount(ends, minlength=n + 1))[:n] > 0


def _part(lists: pa.ListArray, block: Words) -> tuple[pa.Array, np.ndarray]:
    """The list items of the block's rows, and the block row of each."""
    offsets = np.asarray(lists.offsets)
    offsets = offsets - offsets[0]
    rows = slice(block.first_row, block.first_row + len(block))
    lo, hi = offsets[block.first_row], offsets[block.first_row + len(block)]
    return lists.flatten().slice(lo, hi - lo), np.repeat(np.arange(len(block)), np.diff(offsets)[rows])


def _runs(part: pa.StructArray, row: np.ndarray, block: Words) -> tuple[np.ndarray, np.ndarray]:
    """First word and end of the matches: stretches that overlap or touch, at one distance from one source."""
    copied = ~part.field("own").to_numpy(zero_copy_only=False)
    row, at = row[copied], part.field("at").to_numpy()[copied]
    source, shift = part.field("s_key").to_numpy()[copied], at - part.field("s_at").to_numpy()[copied]
    order = np.lexsort((at, shift, source, row))
    row, at, source, shift = row[order], at[order], source[order], shift[order]
    new = np.ones(len(at), bool)
    new[1:] = (row[1:] != row[:-1]) | (source[1:] != source[:-1]) | (shift[1:] != shift[:-1]) | (at[1:] > at[:-1] + STRETCH)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1 if len(first) else first
    base = block.bounds[row[first]]
    return base + at[first], base + at[last] + STRETCH


def _open_windows(min_words: int) -> Callable[[pa.RecordBatch, pa.Array], Iterator[tuple[pa.Array, list[pa.Array]]]]:
    """The windows that chose a fingerprint with several places and lie in no match: hash and first word."""
    def read(batch: pa.RecordBatch, column: pa.Array) -> Iterator[tuple[pa.Array, list[pa.Array]]]:
        lists = batch.column(batch.schema.get_field_index("_places"))
        for block in word_blocks(column, "space", lower=False):
            part, row = _part(lists, block)
            if not len(part):
                continue
            h, base = block.hashes(), block.bounds[row]
            asked = _covered(base + part.field("low").to_numpy(), base + part.field("high").to_numpy() + 1, len(h))
            begins, ends = _runs(part, row, block)
            long = ends - begins >= min_words
            at = np.flatnonzero(asked & ~_covered(begins[long], ends[long] - min_words + 1, len(h)))
            of = block.row_of_word[at]
            fits = at + min_words <= block.bounds[of + 1]
            at, of = at[fits], of[fits]
            if len(at):
                yield pa.array(of + block.first_row), [
                    pa.array(windows_at(h, at, min_words).view(np.int64)), pa.array(at - block.bounds[of])]

    return read


def _repeated(column: pa.Array, places: pa.ListArray, again: pa.ListArray, min_words: int) -> Iterator[tuple]:
    """(row, words of it, block, first word, repeated spans) of every text."""
    for block in word_blocks(column, "space", lower=False):
        n, n_words = len(block), int(block.bounds[-1])
        edges = np.zeros((0, 2), np.int64)
        part, row = _part(places, block)
        if len(part):
            begins, ends = _runs(part, row, block)
            long = ends - begins >= min_words
            starts, of = _part(again, block)
            starts = block.bounds[of] + starts.to_numpy()
            on = _covered(np.append(begins[long], starts), np.append(ends[long], starts + min_words), n_words).astype(np.int8)
            # a run ends with its text
            cuts = np.append(on[1:] != on[:-1], True)
            cuts[block.bounds[1:-1][(block.bounds[1:-1] > 0) & (block.bounds[1:-1] < len(on))] - 1] = True
            ends = np.flatnonzero(cuts) + 1
            begins = np.append(0, ends[:-1])
            edges = np.column_stack((begins, ends))[on[begins] > 0]
        at = np.searchsorted(edges[:, 0], block.bounds)
        for i in range(n):
            yield block.first_row + i, int(block.bounds[i + 1] - block.bounds[i]), block, int(block.bounds[i]), edges[at[i]:at[i + 1]] - block.bounds[i]


def _earliest(places: DataFrame, of: str, name: str) -> DataFrame:
    """The earliest place of each value that has several, stored so that the rows of a frequent value
    can be split when they are joined."""
    return frames.stored(places.groupBy(of).agg(
        F.min(F.struct("_rank", "_key", "at")).alias("s"), F.count("*").alias("n"),
    ).where("n > 1").select(of, F.col("s._key").alias("s_key"), F.col("s.at").alias("s_at")), name)


def _matches(docs: DataFrame, min_words: int) -> tuple[DataFrame, DataFrame]:
    """Per document key: its places of fingerprints that have several (``_places``), and the first
    words of the further windows that have an earlier copy (``_again``)."""
    long = T.LongType()
    prints = frames.stored(frames.rows_of_texts(
        docs.select("_key", "_rank", "_text"), "_text", ["_key", "_rank"],
        [T.StructField(n, long) for n in ("print", "at", "low", "high")], _fingerprints), "prints")
    own = (F.col("_key") == F.col("s_key")) & (F.col("at") == F.col("s_at"))
    # a set: equal texts under one id have the same places
    places = frames.stored(prints.join(_earliest(prints, "print", "sources"), "print").groupBy("_key").agg(
        F.collect_set(F.struct("at", "low", "high", "s_key", "s_at", own.alias("own"))).alias("_places")), "places")
    known = docs.join(places, "_key").select("_key", "_rank", "_places", "_text").dropDuplicates(["_key"])
    found = frames.stored(frames.rows_of_texts(
        known, "_text", ["_key", "_rank"], [T.StructField("window", long), T.StructField("at", long)],
        _open_windows(min_words)), "windows")
    again = found.join(_earliest(found, "window", "earliest"), "window").where(~own) \
        .groupBy("_key").agg(F.collect_list("at").alias("_again"))
    return places, again


def _with_matches(docs: DataFrame, doc_id: str, text: str, min_words: int) -> DataFrame:
    if min_words < STRETCH + WINDOW - 1:
        raise ValueError(f"min_words must be {STRETCH + WINDOW - 1} at least")
    own = frames.keyed(frames.without(docs, ["_text", "_places", "_again"]), doc_id, text)
    slim = own.select("_key", "_rank", F.col(text).cast("string").alias("_text"))
    places, again = _matches(slim, min_words)
    return own.join(places, "_key", "left").join(again, "_key", "left").drop("_rank")


def _no_nulls(lists: pa.ListArray) -> pa.ListArray:
    """Null lists as empty ones."""
    counts = np.where(np.asarray(lists.is_valid()), np.diff(np.asarray(lists.offsets)), 0)
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), lists.drop_null().flatten())


def repeated_runs(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                  min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, n_repeated and the word ranges that have an earlier copy."""
    marked = _with_matches(docs.select(doc_id, text), doc_id, text, min_words)
    spans = T.ArrayType(T.ArrayType(T.LongType()))

    def judge(batch: pa.RecordBatch, column: pa.Array) -> Iterator[tuple[pa.Array, list[pa.Array]]]:
        places, again = (_no_nulls(batch.column(batch.schema.get_field_index(c))) for c in ("_places", "_again"))
        found = list(_repeated(column, places, again, min_words))
        yield pa.array([f[0] for f in found], pa.int64()), [
            pa.array([f[1] for f in found], pa.int64()), pa.array([int(np.diff(f[4]).sum()) for f in found], pa.int64()),
            pa.array([f[4].tolist() for f in found], pa.list_(pa.list_(pa.int64())))]

    return frames.rows_of_texts(marked, text, [doc_id], [
        T.StructField("n_words", T.LongType()), T.StructField("n_repeated", T.LongType()),
        T.StructField("repeated_spans", spans)], judge)


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                   min_words: int = MIN_WORDS) -> DataFrame:
    """The documents without the runs that have an earlier copy; one that loses all its words goes."""
    marked = _with_matches(docs, doc_id, text, min_words)
    columns = docs.columns
    frame = marked.select("_places", "_again", *[marked[f"`{c}`"] for c in columns])
    schema = T.StructType([*docs.schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            column, places, again = batch.column(at), batch.column(0), batch.column(1)
            hit = np.flatnonzero(np.asarray(places.is_valid()))
            if not len(hit):
                yield pa.RecordBatch.from_arrays(batch.columns[2:], names=columns)
                continue
            texts = column.to_pylist()
            keep = np.ones(len(texts), bool)
            of_hit = (_no_nulls(lists.take(pa.array(hit))) for lists in (places, again))
            for row, n, block, a, spans in _repeated(column.take(pa.array(hit)), *of_hit, min_words):
                if len(spans):
                    base = block.text_starts[row - block.first_row]
                    words = slice(a, a + n)
                    texts[hit[row]] = without_spans(texts[hit[row]].encode(), block.starts[words] - base, block.ends[words] - base, spans)
                    keep[hit[row]] = np.diff(spans).sum() < n
            arrays = [pa.array(texts, column.type) if i == at else batch.column(i) for i in range(2, batch.num_columns)]
            yield pa.RecordBatch.from_arrays(arrays, names=columns).filter(pa.array(keep))

    return frame.mapInArrow(run, schema)
