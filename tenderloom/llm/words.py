"""Words of whole Arrow text columns as numpy arrays.

A batch of texts is one run of UTF-8 bytes with offsets. The word classes used here are sets of
single bytes (every byte of a non-ASCII character counts alike), so words are found with byte
masks, and a word's 64-bit hash comes from prefix sums of its bytes. Work is cut into blocks of
whole texts, so memory follows the block and the longest single text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_WORD = 1 << 64
_MULTIPLIERS = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
                        dtype=np.uint64)

_SPACE = np.ones(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = False
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

#: word classes: runs of anything but ASCII white space; runs of a-z, 0-9 and non-ASCII
CLASSES = {"space": _SPACE, "alnum": _ALNUM}


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class _Cache(dict):
    """Kept by one process only: never travels with a pickled function."""

    def __reduce__(self):
        return _Cache, ()


_POWERS = _Cache()


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, kept between blocks."""
    if _POWERS.get("n", 0) < n:
        n = max(n, BLOCK_BYTES + 1)
        out = []
        for b in (_BASE, pow(_BASE, -1, _WORD)):
            p = np.full(n, b, dtype=np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _POWERS.update(n=n, up=out[0], down=out[1])
    return _POWERS["up"], _POWERS["down"]


@dataclass
class Words:
    """Words of consecutive texts: byte spans, hashes and the first word of each text."""

    first_row: int              # row of the batch that the block begins with
    data: np.ndarray            # bytes of the block, lower-cased if asked for
    text_starts: np.ndarray     # byte offsets of the texts, one more than texts
    starts: np.ndarray          # byte offset of each word
    ends: np.ndarray
    bounds: np.ndarray          # index of the first word of each text, one more than texts

    def __len__(self) -> int:
        return len(self.bounds) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), self.counts)

    def hashes(self) -> np.ndarray:
        n = len(self.data)
        up, down = _powers(n + 1)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        h = (sums[self.ends] - sums[self.starts]) * down[self.starts]
        return mix(h + (self.ends - self.starts).astype(np.uint64))

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def blocks(offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``size`` bytes, or of one text."""
    row, n = 0, len(offsets) - 1
    while row < n:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield row, min(stop, n)
        row = min(stop, n)


def word_blocks(column: pa.Array, kind: str, lower: bool = True, size: int = BLOCK_BYTES) -> Iterator[Words]:
    """All words of all texts of the column, block by block."""
    data, offsets = texts_of(column)
    table = CLASSES[kind]
    for row, stop in blocks(offsets, size):
        part = data[offsets[row]:offsets[stop]]
        at = offsets[row:stop + 1] - offsets[row]
        folded = _LOWER[part] if lower else part
        yield _split(row, folded, at, table)


def _split(row: int, data: np.ndarray, at: np.ndarray, table: np.ndarray) -> Words:
    inside = table[data]
    n = len(data)
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    before[at[:-1][at[:-1] < n]] = False            # a word ends with its text
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after[at[1:][at[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(row, data, at, starts, ends, np.searchsorted(starts, at))


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive values (no regard for text bounds)."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    n = len(h) - k + 1
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * _MULTIPLIERS[0] + (h[i:i + n] ^ _MULTIPLIERS[1])
    return mix(out + np.uint64(k))


def windows_at(h: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k consecutive values from each of these places on."""
    out = np.zeros(len(at), np.uint64)
    for i in range(k):
        out = out * _MULTIPLIERS[0] + (h[at + i] ^ _MULTIPLIERS[1])
    return mix(out + np.uint64(k))


def window_mask(words: Words, k: int) -> np.ndarray:
    """Which of the windows of k words lie inside one text."""
    rows = words.row_of_word
    return rows[:len(rows) - k + 1] == rows[k - 1:] if len(rows) >= k else np.zeros(0, bool)


def without_spans(text: bytes, starts: np.ndarray, ends: np.ndarray, spans: np.ndarray) -> str:
    """The text without the words of the spans; what is left on both sides meets at a line end."""
    kept, last = [], 0
    for x, y in spans:
        kept.append(text[last:starts[x]])
        last = ends[y - 1]
    kept.append(text[last:])
    kept = [k.strip(b" \t\r\n") if 0 < i < len(kept) - 1 else
            k.rstrip(b" \t\r\n") if i == 0 else k.lstrip(b" \t\r\n") for i, k in enumerate(kept)]
    return b"\n".join(k for k in kept if k).decode()
