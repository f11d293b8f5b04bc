"""How document filters interact: what each removes alone, after others, and over all orders.

``measure`` runs one table-driven finite-state pass over the UTF-8 bytes of every text. The machine
reads a byte, moves to its next state and emits events: a code point, a capital, a symbol, the begin
or the end of a word. Word spans go into a hash table in which equal hashes are compared byte by
byte, so distinct words are counted exactly. ``audit`` takes rows that carry the letters of the
filters they fail, and counts every order of the filters from one small table of counts.

Texts: null is empty; any length (work is cut into lanes of ``LANE`` bytes that run side by side).
Null parts are the empty string. Rows with a null id are no copies and have none. Repeated rows with
one id and text are all first copies. An empty table gives no rows.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderloom.llm import frames
from tenderloom.llm.words import Words, blocks, mix, texts_of

LANE = 256          # bytes that one lane reads
BLOCK = 1 << 20     # bytes of texts at a time
SYMBOLS = b"#$%&*|"

#: states: outside of words, inside, and inside a character of which 1 to 3 bytes are still due
GAP, WORD, DUE1, DUE2, DUE3 = range(5)
#: events
POINT, BEGIN, END, CAPITAL, SYMBOL = 1, 2, 4, 8, 16


def _tables(symbols: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Next state and events of every state and byte, as flat tables of 5 x 256."""
    goes = np.full((5, 256), WORD, np.uint16)
    says = np.full((5, 256), POINT, np.uint8)
    goes[:, 0xC2:0xE0], goes[:, 0xE0:0xF0], goes[:, 0xF0:0xF5] = DUE1, DUE2, DUE3
    for state, after in ((DUE1, WORD), (DUE2, DUE1), (DUE3, DUE2)):     # the rest of a character
        goes[state, 0x80:0xC0] = after
        says[state, 0x80:0xC0] = 0
    space = [0x20, *range(0x09, 0x0E)]
    says[GAP] |= BEGIN
    says[:, 0x41:0x5B] |= CAPITAL
    says[:, list(symbols)] |= SYMBOL
    goes[:, space] = GAP
    says[GAP, space] &= ~np.uint8(BEGIN)
    says[1:, space] |= END
    return goes.ravel(), says.ravel()


def _events(data: np.ndarray, at: np.ndarray, goes: np.ndarray, says: np.ndarray) -> np.ndarray:
    """The events of every byte. Texts are cut into lanes between characters; a lane that goes on
    within a text starts from the state that the byte before it leaves."""
    sizes = np.diff(at)
    pieces = -(-sizes // LANE)
    text = np.repeat(np.arange(len(sizes)), pieces)
    start = at[text] + LANE * (np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    stop = at[text + 1]
    for _ in range(3):      # not inside a character
        inside = start < stop
        inside[inside] = (data[start[inside]] & 0xC0) == 0x80
        inside &= start > at[text]
        start += inside
    later = start > at[text]
    state = np.full(len(start), GAP, np.uint16)
    seen = data[start[later] - 1]
    state[later] = np.where(goes[seen] == GAP, GAP, WORD)
    end = np.minimum(np.append(start[1:], len(data)), stop)
    lengths = end - start
    order = np.argsort(-lengths, kind="stable")
    start, state, lengths = start[order], state[order], lengths[order]
    out = np.zeros(len(data), np.uint8)
    for step in range(int(lengths[0]) if len(lengths) else 0):
        n = int(np.searchsorted(-lengths, -step, "left"))       # lanes that still have a byte
        place = start[:n] + step
        code = (state[:n] << np.uint16(8)) | data[place]
        state[:n] = goes[code]
        out[place] = says[code]
    return out


def _spans(data: np.ndarray, at: np.ndarray, out: np.ndarray, row: int) -> Words:
    starts = np.flatnonzero(out & BEGIN)
    ends = np.flatnonzero(out & END)
    filled = at[1:][at[1:] > at[:-1]]
    last = filled[~np.isin(data[filled - 1], [0x20, *range(0x09, 0x0E)])]    # words that end with their text
    return Words(row, data, at, starts, np.sort(np.concatenate((ends, last))), np.searchsorted(starts, at))


def _same(eights: np.ndarray, a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the spans of these sizes at a and b hold the same bytes, eight bytes at a time."""
    equal = np.ones(len(a), bool)
    todo = np.arange(len(a))
    done = 0
    while len(todo):
        left = np.minimum(sizes[todo] - done, 8).astype(np.uint64)
        unlike = (eights[a[todo] + done] ^ eights[b[todo] + done]) << (np.uint64(8) * (np.uint64(8) - left))
        equal[todo[unlike != 0]] = False
        done += 8
        todo = todo[(unlike == 0) & (sizes[todo] > done)]
    return equal


def _first_of_kind(words: Words) -> np.ndarray:
    """Which words are the first of their spelling in their text: each is put into an open hash table
    under its text and hash; a slot that is taken is its own only if text, size and bytes agree."""
    n = len(words.starts)
    first = np.zeros(n, bool)
    if not n:
        return first
    rows, sizes = words.row_of_word, words.ends - words.starts
    padded = np.concatenate((words.data, np.zeros(8, np.uint8)))
    eights = np.ndarray((len(padded) - 7,), np.dtype("<u8"), padded, 0, (1,))
    mask = np.uint64((1 << max(4, (2 * n - 1).bit_length())) - 1)
    table = np.full(int(mask) + 1, -1, np.int64)
    slot = mix(words.hashes() + mix(rows.astype(np.uint64) + np.uint64(1))) & mask
    todo = np.arange(n)
    while len(todo):
        free = table[slot[todo]] < 0
        claim = todo[free][::-1]
        table[slot[claim]] = claim                  # of several claims the first word's stays
        owner = table[slot[todo]]
        first[todo[owner == todo]] = True
        own = owner == todo
        alike = ~own & (rows[owner] == rows[todo]) & (sizes[owner] == sizes[todo])
        at = np.flatnonzero(alike)
        alike[at] = _same(eights, words.starts[owner[at]], words.starts[todo[at]], sizes[todo[at]])
        todo = todo[~own & ~alike]
        slot[todo] = (slot[todo] + np.uint64(1)) & mask
    return first


_FIELDS = [T.StructField(name, T.LongType()) for name in ("n_words", "n_distinct", "n_capitals", "n_points", "n_symbols")]


def _measured(column: pa.Array, goes: np.ndarray, says: np.ndarray) -> list[pa.Array]:
    data, offsets = texts_of(column)
    parts: list[list[np.ndarray]] = [[] for _ in _FIELDS]

    def per_text(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))[at])

    for row, stop in blocks(offsets, BLOCK):
        own, at = data[offsets[row]:offsets[stop]], offsets[row:stop + 1] - offsets[row]
        out = _events(own, at, goes, says)
        words = _spans(own, at, out, row)
        for part, found in zip(parts, (words.counts, per_text(_first_of_kind(words), words.bounds),
                                       per_text(out & CAPITAL != 0, at), per_text(out & POINT != 0, at),
                                       per_text(out & SYMBOL != 0, at))):
            part.append(found)
    return [pa.array(np.concatenate(p) if p else [], pa.int64()) for p in parts]


def measure(docs: DataFrame, *, text: str = "text", symbols: bytes = SYMBOLS, keep: bool = True) -> DataFrame:
    """The rows with n_words, n_distinct (spellings, case-sensitive), n_capitals (A-Z), n_points
    (code points) and n_symbols of their whole text; columns of these names are replaced."""
    goes, says = _tables(symbols)
    return frames.map_texts(docs, text, _FIELDS, lambda column: _measured(column, goes, says), keep=keep)


def digest(text: str) -> Column:
    """Identity of a text: 32 bytes of SHA-256; a null text is empty."""
    return F.unhex(F.sha2(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), 256))


def later_copies(rows: DataFrame, *, row_id: str, same: str, name: str) -> DataFrame:
    """The rows with a boolean: another row with equal ``same`` has a smaller id. A group of copies is
    reduced to its least id before the shuffle, and rows meet it by (same, id), so that no task gets
    a whole group."""
    least = rows.groupBy(F.col(same).alias("_same")).agg(F.min(row_id).alias("_least"))
    found = rows.join(least, (F.col(same) == F.col("_same")) & (F.col(row_id) == F.col("_least")), "left")
    return found.withColumn(name, F.col(row_id).isNotNull() & F.col("_least").isNull()).drop("_same", "_least")


def audit(rows: DataFrame, filters: dict[str, Column], *, part: str, losses: dict[str, Column]) -> DataFrame:
    """One row per part, order of the filters and step.

    ``filters`` names each filter by one letter and gives the condition under which a row fails (null:
    it does not); ``losses`` names conditions whose rows are counted where they are removed. Per step:
    kept (rows that no filter so far removes), removed (by this one), redundant (rows that fail this
    one, but an earlier one has removed), unique_fails (rows that fail this one only), the losses, and
    shapley (rows that this filter removes, summed over all orders). Rows are counted once by the set
    of filters they fail; all orders are read off that table of at most 2^filters rows a part.
    """
    letters = "".join(filters)
    n_orders = factorial(len(letters))
    fails = F.concat(*[F.when(failing, F.lit(letter)).otherwise(F.lit("")) for letter, failing in filters.items()])
    one = lambda condition: F.sum(F.when(condition, 1).otherwise(0))
    counts = rows.select(
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"), fails.alias("fails"),
        *[condition.alias(name) for name, condition in losses.items()],
    ).groupBy("part", "fails").agg(F.count(F.lit(1)).alias("n"), *[one(F.col(name)).alias(name) for name in losses])
    orders = F.lit(["".join(p) for p in permutations(letters)])
    steps = counts.withColumn("filter_order", F.explode(orders)) \
        .withColumn("step", F.explode(F.lit(list(range(1, len(letters) + 1))))) \
        .withColumn("letter", F.expr("substring(filter_order, step, 1)")) \
        .withColumn("here", F.expr("contains(fails, letter)")) \
        .withColumn("before", F.expr("substring(filter_order, 1, step - 1)")) \
        .withColumn("earlier", F.expr("translate(before, fails, '') != before"))
    here, earlier = F.col("here"), F.col("earlier")

    def total(condition: Column, amount: str | Column = "n") -> Column:
        return F.sum(F.when(condition, amount if isinstance(amount, Column) else F.col(amount)).otherwise(0)).cast("long")

    return steps.groupBy("part", "filter_order", "step").agg(
        total(~here & ~earlier).alias("kept"), total(here & ~earlier).alias("removed"),
        total(here & earlier).alias("redundant"), total(F.col("fails") == F.col("letter")).alias("unique_fails"),
        *[total(here & ~earlier, name).alias(name) for name in losses],
        total(here, F.expr(f"n * {n_orders} div length(fails)")).alias("shapley"),
    ).withColumn("step", F.col("step").cast("int"))
