"""Best-fit packing into sequences of several permitted lengths.

Pieces are placed longest first into the open bin that they fill best. Where none fits, a bin is
opened whose length costs least per token that it can be expected to hold, given what is still to
be placed; so all permitted lengths are weighed together. At the end every bin is cut down to
the shortest permitted length that holds its contents. A document longer than the longest
permitted length is first cut into pieces of that length and a rest; nothing is dropped.

Rows are dealt out evenly, and each task packs blocks of at most ``block_pieces`` pieces: memory
is bounded, no bin spans two blocks, and only the last bins of a block can stay half full.

Defined cases: null and negative lengths count as 0, and a document of 0 tokens gets one piece of
0 tokens in a bin; repeated rows are packed as often as they occur; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderloom.llm import frames
from tenderloom.llm.words import word_blocks

LENGTHS = (512, 1024, 2048, 4096, 8192)
BLOCK_PIECES = 20_000


def sequence_cost(length: int) -> float:
    """Relative cost of one sequence: a fixed part, a linear and a quadratic (attention) part."""
    return 64 + length + length * length / 16384


def pack(sizes: Sequence[int], lengths: Sequence[int] = LENGTHS,
         cost: Callable[[int], float] = sequence_cost) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(bin of each piece, its offset in the bin, length of each bin). No piece may exceed the
    longest length."""
    lengths = sorted(lengths)
    costs = [cost(c) for c in lengths]
    sizes = np.asarray(sizes, np.int64)
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    if len(sizes) and (sizes.max() > lengths[-1] or sizes.min() < 0):
        raise ValueError("a piece exceeds the longest permitted length")
    room: list[list[int]] = [[] for _ in range(lengths[-1] + 1)]    # open bins by free tokens
    free = 0                                                        # bit r: some bin has r free tokens
    used: list[int] = []
    capacity: list[int] = []
    left = int(sizes.sum())
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        left -= size
        fits = free >> size
        if fits:
            r = size + (fits & -fits).bit_length() - 1              # least room that suffices
            b = room[r].pop()
            if not room[r]:
                free &= ~(1 << r)
        else:
            c = min((k for k in range(len(lengths)) if lengths[k] >= size),
                    key=lambda k: costs[k] / max(1, min(lengths[k], size + left)))
            b, r = len(used), lengths[c]
            used.append(0)
            capacity.append(r)
        bins[i], offsets[i] = b, used[b]
        used[b] += size
        r -= size
        room[r].append(b)
        free |= 1 << r
    return bins, offsets, [next(c for c in lengths if c >= u) for u in used]


def pack_documents(docs: DataFrame, length: Column, *, doc_id: str = "doc_id", lengths: Sequence[int] = LENGTHS,
                   block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """One row per piece: doc_id, piece (number in its document), start (token in the document),
    n_tokens, bin_id, bin_offset, bin_tokens, bin_length."""
    top = max(lengths)
    whole = docs.select(F.col(doc_id).alias("doc_id"), F.greatest(F.coalesce(length.cast("long"), F.lit(0)), F.lit(0)).alias("n"))
    pieces = whole.select(
        "doc_id", F.posexplode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("n") - 1, F.lit(0)), F.lit(top).cast("long")))
        .alias("piece", "start"), "n",
    ).select("doc_id", F.col("piece").cast("long").alias("piece"), "start",
             F.least(F.col("n") - F.col("start"), F.lit(top)).alias("n_tokens"))
    dealt = pieces.hint("rebalance")                          # evenly, in partitions of the advised size
    schema = T.StructType([*dealt.schema.fields, *(T.StructField(n, T.LongType()) for n in (
        "bin_id", "bin_offset", "bin_tokens", "bin_length"))])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40      # 2^40 bins a task
        for block in _regrouped(batches, block_pieces):
            sizes = block.column("n_tokens").to_numpy()
            bins, offsets, made = pack(sizes, lengths)
            tokens = np.bincount(bins, weights=sizes, minlength=len(made)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*block.columns, *map(pa.array, (bins + first, offsets, tokens[bins], np.asarray(made, np.int64)[bins]))],
                names=names)
            first += len(made)

    return dealt.mapInArrow(run, schema)


def _regrouped(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``rows`` rows, the last one shorter."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - n)
            batch = batch.slice(part.num_rows)
            held.append(part)
            n += part.num_rows
            if n == rows:
                yield _one(held)
                held, n = [], 0
    if n:
        yield _one(held)


def _one(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def count_words(docs: DataFrame, *, text: str = "text", name: str = "n_words") -> DataFrame:
    """The documents with the number of their words (runs without ASCII white space)."""
    def count(column: pa.Array) -> list[pa.Array]:
        parts = [b.counts for b in word_blocks(column, "space", lower=False)]
        return [pa.array(np.concatenate(parts) if parts else [], pa.int64())]

    return frames.map_texts(docs, text, [T.StructField(name, T.LongType())], count, keep=False)
