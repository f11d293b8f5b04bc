"""Hierarchical Pitman-Yor language model of word pairs, trained and applied in one Spark plan.

Every previous word is a restaurant whose dishes are the words that follow it; all of them share one
parent, the restaurant of single words, whose own parent is uniform over the known words and one for
all unknown ones. Tables of the children are customers of the parent. Customers are seated by Gibbs
sampling of the Chinese restaurant process: each leaves its table and sits down again at a table of
its dish in proportion to that table's size less the discount, or at a new one in proportion to what
the parent predicts. Predictions are averaged over several seatings and give each text's probability.

How the corpus meets the model without either being whole anywhere:

1. ``_chunks``: texts are gathered into chunks of bounded size. A chunk is written as a stream row (the
   distinct pairs of each text, as small numbers) and, for every bucket of contexts, a row with the
   chunk's distinct pairs and their counts in training texts. All later steps read this one exchange.
2. ``_vocabulary``: a bucket merges its rows into restaurants and seats their customers, with its own
   tables in place of the parent (the state that sampling starts from). It tells the buckets of words
   how often each word was served and at how many tables.
3. ``_parents``: a bucket of words seats the parent's customers, one from each table of the children, and
   replies to the buckets of contexts.
4. ``_tables``: a bucket seats the customers of its restaurants, given the parent, and sends the tables
   of each word to the buckets of words, for ``_parents`` to seat anew. Parent and children take
   ``rounds`` turns; given the parent's predictions, its children are independent of each other.
5. ``_children``: a bucket seats the customers of its restaurants, given the last parent, and answers
   every chunk with the log probability of each of its pairs and the count of its word.
6. ``_texts``: a chunk's texts sum up the answers.

A context that makes up more than half a bucket's share of all words is served in several buckets, by
hash of the dish; its totals are summed over them (``_hot``), so no context gathers in one task. Which
contexts these are comes from counts over all texts and moves rows only; it is no part of the model.

Words are compared by 64-bit hashes, dishes of over ``UNITS`` customers seat that many one by one and
the rest by the number of tables they are expected to open. Null texts are empty: their only token is
the end. Texts of any length are whole; memory follows a chunk, or the longest text. Repeated rows are
scored each. Without training texts every word is unknown (scores are 0). Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W
from pyspark.sql.pandas.types import to_arrow_schema

from tenderloom.llm import frames
from tenderloom.llm.words import mix, word_blocks

UNITS = 1024                # customers of a dish that are seated one by one
FEW = 16                    # customers of a step that are seated without arrays
CHUNK = 2_000_000           # tokens of a chunk
BUCKET = 3_000_000          # tokens whose contexts share a bucket
HOT_SHARE = 1 / 20_000      # contexts of a smaller share of all words are never split
_END, _START = np.uint64(0x5EED0000000000E5), np.uint64(0x5EED000000000057)


@dataclass(frozen=True)
class Model:
    """Discounts and strengths of the restaurants of pairs and of their parent, and the sampler's course.

    The children start with ``first`` sweeps without the parent, and then parent and children are seated
    ``rounds`` times, each after ``burn_in`` sweeps. Predictions are averaged over ``samples``."""

    discount: float = 0.75
    strength: float = 1.0
    parent_discount: float = 0.6
    parent_strength: float = 10.0
    burn_in: int = 1
    samples: int = 2
    rounds: int = 2
    first: int = 4
    seed: int = 11


def _pack(numbers: np.ndarray) -> bytes:
    """Whole numbers in one or two bytes each, with those that are larger listed behind; in eight
    where that would be no shorter."""
    n = len(numbers)
    sizes = [n * width + 8 * int((numbers >= (1 << 8 * width) - 1).sum()) for width in (1, 2)] + [8 * n]
    width = (1, 2, 8)[int(np.argmin(sizes))]
    if width == 8:
        return b"8" + numbers.astype("<u8").tobytes()
    most = (1 << 8 * width) - 1
    large = numbers[numbers >= most]
    head = str(width).encode() + np.array([n], "<u8").tobytes()
    return head + np.minimum(numbers, most).astype(f"<u{width}").tobytes() + large.astype("<u8").tobytes()


def _unpack(data: bytes) -> np.ndarray:
    if data[:1] == b"8":
        return np.frombuffer(data, "<u8", offset=1).astype(np.int64)
    width = int(bytes(data[:1]))
    n = int(np.frombuffer(data, "<u8", 1, 1)[0])
    out = np.frombuffer(data, f"<u{width}", n, 9).astype(np.int64)
    out[out == (1 << 8 * width) - 1] = np.frombuffer(data, "<u8", offset=9 + n * width).astype(np.int64)
    return out


def _hashes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint64)


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and the number of each value's place."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    of = np.empty(len(keys), np.int32)
    of[order] = np.cumsum(new, dtype=np.int32) - 1
    return ordered[new], of


def _named(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same where most values come several times: found by hash, so that only the distinct are sorted."""
    found = pa.array(keys).dictionary_encode()
    names = found.dictionary.to_numpy()
    order = np.argsort(names)
    rank = np.empty(len(names), np.int32)
    rank[order] = np.arange(len(names), dtype=np.int32)
    return names[order], rank.take(found.indices.to_numpy())


def _in_order(places: np.ndarray, n: int) -> np.ndarray:
    """Stable order of numbers below n; numpy sorts short ones by their digits, which takes far less time."""
    return np.argsort(places.astype(np.uint16 if n <= 1 << 16 else np.int64), kind="stable")


def _pack_scores(scores: np.ndarray) -> bytes:
    """Logarithms of chances in 24 bits, to 2^-20; those under -15 are listed behind in full."""
    units = np.rint(np.minimum(-scores, 15.5) * (1 << 20)).astype(np.uint32)
    units[scores < -15] = (1 << 24) - 1
    low, high = (units & 0xFFFF).astype("<u2"), (units >> 16).astype("u1")
    return np.array([len(scores)], "<u8").tobytes() + low.tobytes() + high.tobytes() + scores[scores < -15].tobytes()


def _unpack_scores(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data, "<u8", 1)[0])
    units = np.frombuffer(data, "<u2", n, 8).astype(np.uint32) | np.frombuffer(data, "u1", n, 8 + 2 * n).astype(np.uint32) << 16
    out = units / -float(1 << 20)
    out[units == (1 << 24) - 1] = np.frombuffer(data, np.float64, offset=8 + 3 * n)
    return out


# -- seating -------------------------------------------------------------------------------------

def seat(customers: np.ndarray, house: np.ndarray, base: np.ndarray, discount: float, strength: float, *,
         others: np.ndarray, rng: np.random.Generator, burn_in: int, samples: int, shares: int | np.ndarray = 1,
         predict: Callable[[np.ndarray], np.ndarray] | None = None) -> np.ndarray:
    """Tables of every dish, averaged over the samples.

    ``customers`` of a dish sit in restaurant ``house``; ``base`` is what the parent predicts for the
    dish, ``others`` the tables of each restaurant that are seated elsewhere. All dishes take one
    customer at a time side by side; a restaurant's number of tables is that before this step. With
    ``shares`` the rows at hand are one of so many equal shares of the restaurant. After every sweep,
    ``predict`` makes the parent's predictions anew from the tables.
    """
    tables = np.minimum(customers, 1).astype(np.float64)
    busy = np.flatnonzero(customers > 1)
    if not len(busy):
        return tables
    busy = busy[np.argsort(-customers[busy], kind="stable")]
    units = np.minimum(customers[busy], UNITS)
    house_of, chance = house[busy], base[busy]
    total = np.bincount(house, tables, len(others)) - np.bincount(house_of, minlength=len(others))
    n_at = np.searchsorted(-units, -np.arange(int(units[0])), "left")       # dishes that have a customer i
    # customer i of dish d is at first[i] + d, so that a step's customers lie side by side; a table is
    # known by the place of a customer, and ``seats`` has each customer's table
    first = np.cumsum(n_at) - n_at
    seats, size = np.zeros(int(units.sum()), np.int64), np.zeros(int(units.sum()), np.int32)
    open_, extra = np.zeros(len(busy)), np.zeros(len(busy), np.int64)
    rests = units - 1.0
    large = np.flatnonzero(customers[busy] > units)
    alone = len(others) == 1        # a single restaurant: its total is one number
    shares = np.broadcast_to(shares, len(others))
    whole = bool((shares == 1).all() and not others.any())
    seat_of, size_of, first_of = memoryview(seats), memoryview(size), first.tolist()
    # views of each step's customers: tables, restaurant, chance, others of the dish, its tables
    steps = [(a, n, seats[a:a + n], house_of[:n], chance[:n], rests[:n], open_[:n]) for a, n in zip(first_of, n_at.tolist())]

    def weight(at: np.ndarray, share: np.ndarray) -> np.ndarray:
        if alone:
            return (strength + discount * (total[0] * shares[0] + others[0])) * share
        w = total.take(at)
        if not whole:
            w *= shares.take(at)
            w += others.take(at)
        w *= discount
        w += strength
        w *= share
        return w

    def add(at: np.ndarray, n: int) -> None:
        if alone:
            total[0] += n * len(at)
        else:
            np.add.at(total, at, n)

    def join(i: int, todo: np.ndarray, rest: np.ndarray | float, again: bool) -> None:
        """Customers sit down at the table of a random other one, with chance (size - discount) / size, or try again."""
        mine, one = seats[first_of[i]:], not isinstance(rest, np.ndarray)
        while (n := len(todo)) > FEW:
            draws = rng.random(2 * n)
            who = (draws[:n] * rest).astype(np.int64)
            if again:
                who += who >= i
            who = first.take(who)
            who += todo
            table = seats.take(who)
            there = size.take(table)
            taken = draws[n:] * there < there - discount
            mine[todo] = table      # for good where it is taken
            there += taken
            size[table] = there
            more = (~taken).nonzero()[0]
            todo = todo.take(more)
            rest = rest if one else rest.take(more)
        todo, rest = todo.tolist(), [rest] * n if one else rest.tolist()
        while todo:             # the same for few customers, for whom arrays are slow
            n, draws, more = len(todo), rng.random(2 * len(todo)).tolist(), []
            for k, d in enumerate(todo):
                who = int(draws[k] * rest[k])
                if again and who >= i:
                    who += 1
                table = seat_of[first_of[who] + d]
                there = size_of[table]
                if draws[n + k] * there < there - discount:
                    mine[d] = table
                    size_of[table] = there + 1
                else:
                    more.append(k)
            todo, rest = [todo[k] for k in more], [rest[k] for k in more]

    def place(i: int, todo: np.ndarray) -> None:
        """Customers open a table: in their own place, or a random one without a table."""
        a, mine = first_of[i], seats[first_of[i]:]
        slot = todo + a
        while len(todo) > FEW:
            free = size.take(slot) == 0
            mine[todo] = slot       # for good where it is free
            size[slot[free]] = 1
            todo = todo[~free]
            if len(todo):
                slot = first.take((rng.random(len(todo)) * units.take(todo)).astype(np.int64)) + todo
        todo, slots = todo.tolist(), slot.tolist()
        while todo:
            more = []
            for d, table in zip(todo, slots):
                if size_of[table]:
                    more.append(d)
                else:
                    seat_of[a + d] = table
                    size_of[table] = 1
            if more:
                slots = [first_of[int(x * units[d])] + d for d, x in zip(more, rng.random(len(more)).tolist())]
            todo = more

    def sweep(again: bool) -> None:
        for i, (a, n, mine, at, share, rest, tables_of) in enumerate(steps):
            if again:       # leave the table
                left = size.take(mine)
                left -= 1
                size[mine] = left
                closed = (left == 0).nonzero()[0]
                if len(closed):
                    tables_of[closed] -= 1
                    add(at.take(closed), -1)
            limit = tables_of * -discount
            new_weight = weight(at, share)
            limit += new_weight + (rest if again else i)
            limit *= rng.random(n)
            new = limit < new_weight
            if i == 0 and not again:
                new[:] = True
            todo = new.nonzero()[0]
            if len(todo) < n:
                stay = (~new).nonzero()[0]
                join(i, stay, rest.take(stay) if again else float(i), again)
            if len(todo):
                tables_of[todo] += 1
                add(at.take(todo), 1)
                place(i, todo)
        if len(large):          # customers beyond UNITS open tables at the rate of the same rule
            w = weight(house_of[large], chance[large])
            opened = rng.poisson(w * np.log((w + customers[busy[large]]) / (w + units[large])))
            np.add.at(total, house_of[large], opened - extra[large])
            extra[large] = np.minimum(opened, customers[busy[large]] - units[large])

    sweep(False)
    mean = np.zeros(len(busy))
    for i in range(burn_in + samples):
        if predict:
            tables[busy] = open_ + extra
            chance[:] = predict(tables)[busy]
        sweep(True)
        if i >= burn_in:
            mean += open_ + extra
    tables[busy] = mean / samples
    return tables


# -- chunks --------------------------------------------------------------------------------------

_ROW = T.StructType([T.StructField("key", T.IntegerType()), T.StructField("chunk", T.LongType())]
                    + [T.StructField(c, T.BinaryType()) for c in ("p0", "p1", "p2", "p3", "p4")])


def _row_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int64()] + [pa.binary()] * 5
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], _ROW.fieldNames())


def _bucket_of(names: np.ndarray, context: np.ndarray, word: np.ndarray, pieces: np.ndarray, n: int) -> np.ndarray:
    """Bucket of pairs of names: by the context, or for a split one (pieces > 1) by context and piece."""
    bucket = (mix(names) % np.uint64(n)).astype(np.int64)[context]
    split = np.flatnonzero((pieces > 1)[context])
    piece = mix(names[word[split]] ^ np.uint64(0xA5A5)) % pieces[context[split]].astype(np.uint64)
    shifted = names[context[split]] + (piece + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    bucket[split] = n + (mix(shifted) % np.uint64(n)).astype(np.int64)
    return bucket


def _stream_key(chunk: int, n: int) -> int:
    """Where the stream of a chunk, and the answers to it, are dealt."""
    return 2 * n + int(mix(np.array([chunk], np.int64).view(np.uint64))[0] % np.uint64(n))


def _chunk_rows(texts: list[tuple[np.ndarray, np.ndarray]], train: np.ndarray, carried: pa.Table, n_buckets: int,
                hot: dict[str, np.ndarray], number: int) -> list[tuple]:
    """The rows of one chunk: one per bucket, and the stream of its texts."""
    counts = np.concatenate([c for _, c in texts])
    ends = np.cumsum(counts + 1) - 1
    doc = np.repeat(np.arange(len(counts), dtype=np.int32), counts + 1)
    token = np.full(len(doc) + 1, _START, np.uint64)
    inner = np.ones(len(doc), bool)
    inner[ends] = False
    token[:-1][inner] = np.concatenate([h for h, _ in texts])
    token[ends] = _END
    texts.clear()
    names, ids = _named(token)
    del token, inner
    pair = np.empty(len(doc), np.int64)
    pair[1:] = ids[:-2]
    pair[np.append(0, ends[:-1] + 1)] = ids[-1]
    pair <<= 32
    pair |= ids[:-1]
    pair, of_token = _groups(pair)
    context, word = pair >> 32, pair & 0xFFFFFFFF
    pieces = np.ones(len(names), np.int64)
    place = np.searchsorted(names, hot["names"])
    there = place < len(names)
    there[there] = names[place[there]] == hot["names"][there]
    pieces[place[there]] = hot["pieces"][there]
    bucket = _bucket_of(names, context, word, pieces, n_buckets)
    order = _in_order(bucket, 2 * n_buckets)
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    seen = np.bincount(of_token[train[doc]], minlength=len(pair))[order]
    bucket, context, word = bucket[order], context[order], word[order]
    check = int(mix(np.array([number], np.uint64))[0] ^ np.bitwise_xor.reduce(mix(names[context] + (mix(names) * np.uint64(3))[word])))
    chunk = check - (1 << 64) if check >= 1 << 63 else check
    rows = []
    edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
    for a, b in zip(edges[:-1], edges[1:]):
        runs = np.flatnonzero(np.diff(context[a:b], prepend=-1))
        dishes, dish = _groups(word[a:b])
        rows.append((int(bucket[a]), chunk, names[context[a:b][runs]].tobytes(), _pack(np.diff(runs, append=b - a)),
                     names[dishes].tobytes(), _pack(dish), _pack(seen[a:b])))
    held = doc.astype(np.int64) << 32
    held |= rank[of_token]
    del of_token, doc
    held.sort()
    new = np.flatnonzero(np.diff(held, prepend=-1))
    often = np.diff(new, append=len(held))
    held = held[new]
    at = held & 0xFFFFFFFF
    starts = np.flatnonzero(np.diff(held >> 32, prepend=-1))
    step = np.diff(at, prepend=0)
    step[starts] = at[starts]
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, carried.schema) as out:
        out.write_table(carried)
    sizes = np.bincount(held >> 32, minlength=len(counts))
    rows.append((_stream_key(chunk, n_buckets), chunk, sink.getvalue().to_pybytes(), _pack(sizes), _pack(step), _pack(often), _pack(np.array([len(pair)]))))
    return rows


def _chunks(docs: DataFrame, text: str, train: str, carry: list[str], n_buckets: int, hot: dict[str, np.ndarray],
            chunk_tokens: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, flags, carried, n, made = [], [], [], 0, 0
        part = TaskContext.get().partitionId()

        def flush() -> pa.RecordBatch:
            nonlocal flags, carried, n, made
            learns, rest = np.concatenate(flags), pa.concat_tables(carried)
            flags, carried, n, made = [], [], 0, made + 1
            return _row_batch(_chunk_rows(texts, learns, rest, n_buckets, hot, (part << 24) + made))

        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            learns = batch.column(batch.schema.get_field_index(train)).fill_null(False).to_numpy(zero_copy_only=False)
            rest = pa.Table.from_batches([batch]).select(carry)
            for block in word_blocks(column, "space"):
                a, b = block.first_row, block.first_row + len(block)
                texts.append((block.hashes(), block.counts))
                flags.append(learns[a:b])
                carried.append(rest.slice(a, b - a))
                n += len(block.starts) + len(block)
                if n >= chunk_tokens:
                    yield flush()
        if texts:
            yield flush()

    return docs.mapInArrow(run, _ROW)


def _frequent(docs: DataFrame, text: str) -> tuple[int, dict[int, int]]:
    """Number of tokens, and the words of at least HOT_SHARE of them (counted where they have that
    share of an Arrow batch, so at most 1 / HOT_SHARE words)."""
    schema = "word long, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(block.hashes(), len(block)) for block in word_blocks(batch.column(0), "space")]
            names, often = np.unique(np.concatenate([h for h, _ in found] or [np.zeros(0, np.uint64)]), return_counts=True)
            n = int(often.sum()) + sum(rows for _, rows in found)
            some = often >= max(2, HOT_SHARE * n)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(names[some].view(np.int64), 0)), pa.array(np.append(often[some], 0))],
                                             ["word", "n"])
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([n], pa.int64())], ["word", "n"])

    counts = docs.select(F.col(f"`{text}`").alias("t")).mapInArrow(run, schema).groupBy("word").agg(F.sum("n").alias("n"))
    counts = frames.stored(counts, "frequent")
    total = counts.where("word IS NULL").agg(F.sum("n").alias("n")).first()["n"] or 0
    return total, {r["word"]: r["n"] for r in counts.where(F.col("word").isNotNull() & (F.col("n") >= HOT_SHARE * total)).collect()}


# -- buckets -------------------------------------------------------------------------------------

class _Bucket:
    """The restaurants of a bucket, merged from the rows of all chunks."""

    def __init__(self, rows: pa.Table):
        order = pc.sort_indices(rows, [("chunk", "ascending")]).to_pylist()
        self.chunks = [rows.column("chunk")[i].as_py() for i in order]
        columns = [[memoryview(rows.column(c)[i].as_buffer()) for i in order] for c in ("p0", "p1", "p2", "p3", "p4")]
        self.contexts, context = _groups(np.concatenate([_hashes(u) for u in columns[0]]))
        context = np.repeat(context, np.concatenate([_unpack(n) for n in columns[1]]))
        words = [_hashes(w) for w in columns[2]]
        dishes = [_unpack(i) for i in columns[3]]
        self.sizes = [len(i) for i in dishes]
        starts = np.cumsum([0] + [len(w) for w in words[:-1]])
        self.words, word = _groups(np.concatenate(words))
        word = word[np.concatenate([i + start for i, start in zip(dishes, starts)])]
        pairs = context.astype(np.int64) << 32
        pairs |= word
        del context, word, dishes, words
        pairs, self.pair = _groups(pairs)
        self.context, self.word = pairs >> 32, pairs & 0xFFFFFFFF
        self.customers = np.bincount(self.pair, np.concatenate([_unpack(c) for c in columns[4]]), len(pairs)).astype(np.int64)


_ASK = "place int, key int, words binary, served binary, houses binary, contexts binary, guests binary, dishes binary"
_REPLY = ("key int, place int, words binary, served binary, houses binary, tables binary, guests binary, dishes binary, "
          "n_served long, n_words long, n_houses long, n_tables double")


def _dealt(names: np.ndarray, n_buckets: int) -> list[np.ndarray]:
    """Which of the names have their place in each bucket, in their order."""
    place = (mix(names) % np.uint64(n_buckets)).astype(np.int64)
    return np.split(_in_order(place, n_buckets), np.cumsum(np.bincount(place, minlength=n_buckets))[:-1])


def _first_tables(b: _Bucket, model: Model, rng: np.random.Generator, shares: np.ndarray) -> np.ndarray:
    """Tables of the pairs of a bucket by itself: its tables of a word predict the word, as the parent will.
    A split context has but one share of the words here."""
    uniform = model.parent_strength / max(1, len(b.words))
    split = bool((shares > 1).any())

    def predict(tables: np.ndarray) -> np.ndarray:
        guests = np.bincount(b.word, tables, len(b.words))
        chance = ((guests + uniform) / (guests.sum() + model.parent_strength))[b.word]
        return chance / shares[b.context] if split else chance

    return seat(b.customers, b.context, predict(np.minimum(b.customers, 1)), model.discount, model.strength,
                others=np.zeros(len(b.contexts)), rng=rng, burn_in=model.first, samples=1, shares=shares, predict=predict)


def _vocabulary(key: tuple, rows: pa.Table, n_buckets: int, model: Model = Model(), hot: dict[str, np.ndarray] | None = None) -> pa.Table:
    names = [f.split()[0] for f in _ASK.split(", ")]
    own = key[0].as_py()
    out: list[tuple] = []
    if own < 2 * n_buckets:
        b = _Bucket(rows)
        served = np.bincount(b.word, b.customers, len(b.words)).astype(np.int64)
        split = own >= n_buckets
        shares = np.ones(len(b.contexts), np.int64)
        if split and hot:
            shares = hot["pieces"][np.searchsorted(hot["names"], b.contexts)]
        tables = _first_tables(b, model, np.random.default_rng([model.seed, 3, own]), shares)
        houses = np.bincount(b.word, tables, len(b.words)).astype(np.int64)
        guests = np.bincount(b.context, b.customers, len(b.contexts)).astype(np.int64)
        dishes = np.bincount(b.context, tables, len(b.contexts)).astype(np.int64)
        for p, (w, c) in enumerate(zip(_dealt(b.words, n_buckets), _dealt(b.contexts if split else b.contexts[:0], n_buckets))):
            out.append((p, own, b.words[w].tobytes(), _pack(served[w]), _pack(houses[w]), b.contexts[c].tobytes(),
                        _pack(guests[c]), _pack(dishes[c])))
    types = [pa.int32(), pa.int32()] + [pa.binary()] * 6
    return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=names)


def _parents(key: tuple, rows: pa.Table, n_buckets: int, model: Model, sent: pa.Table | None = None, turn: int = 0,
             last: bool = True) -> pa.Table:
    """Totals and tables of the words of one place, for every bucket that asked, in the order it asked.

    Customers are the tables that the buckets told of when they asked, or that they ``sent`` since.
    Only the ``last`` replies have the counts of the words.
    """
    rows = rows.take(pc.sort_indices(rows, [("key", "ascending")]))
    place = key[0].as_py()
    columns = {c: [x.as_py() for x in rows.column(c)] for c in rows.column_names}
    if sent is not None:
        sent = sent.take(pc.sort_indices(sent, [("key", "ascending")]))
        if sent.column("key").to_pylist() != columns["key"]:
            raise RuntimeError("tables do not belong to the buckets that asked")
        columns["houses"], columns["dishes"] = ([x.as_py() for x in sent.column(c)] for c in ("tables", "open"))
    asked = [_hashes(w) for w in columns["words"]]
    words, of = _groups(np.concatenate(asked))
    sums = lambda c, of, n: np.bincount(of, np.concatenate([_unpack(x) for x in columns[c]]), n).astype(np.int64)
    served, houses = sums("served", of, len(words)), sums("houses", of, len(words))
    known = int((served > 0).sum())
    zero = np.zeros(len(words), np.int64)
    tables = seat(houses, zero, np.full(len(words), 1 / (known * n_buckets + 1)), model.parent_discount, model.parent_strength,
                  others=np.zeros(1), rng=np.random.default_rng([model.seed, 1, place, turn]), burn_in=model.burn_in,
                  samples=model.samples, shares=n_buckets) if len(words) else np.zeros(0)
    split = [_hashes(c) for c in columns["contexts"]]
    contexts, at = _groups(np.concatenate(split))
    guests, dishes = sums("guests", at, len(contexts)), sums("dishes", at, len(contexts))
    totals = (int(served.sum()), known, int(houses.sum()), float(tables.sum()))
    out, a, c = [], 0, 0
    sums_of_tables = np.rint(tables * model.samples).astype(np.int64)       # whole numbers are shorter than their mean
    for own, w, s, here in zip(columns["key"], asked, split, columns["dishes"]):
        i, j = of[a:a + len(w)], at[c:c + len(s)]
        out.append((own, place, None, _pack(served[i]) if last else None, _pack(houses[i]), _pack(sums_of_tables[i]),
                    _pack(guests[j]), _pack(dishes[j] - _unpack(here)), *totals))
        a, c = a + len(w), c + len(s)
    types = [pa.int32(), pa.int32()] + [pa.binary()] * 6 + [pa.int64()] * 3 + [pa.float64()]
    return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=[f.split()[0] for f in _REPLY.split(", ")])


class _Seated:
    """A bucket whose customers are seated, given the replies of the parents: averaged over the samples,
    or for a ``turn`` before the last as one state of the sampler."""

    def __init__(self, own: int, rows: pa.Table, replies: pa.Table, model: Model, split: bool, turn: int | None = None):
        self.b = b = _Bucket(rows)
        replies = replies.filter(pc.greater_equal(replies.column("place"), 0))
        replies = replies.take(pc.sort_indices(replies, [("place", "ascending")]))
        n = replies.num_rows
        columns = {c: [x.as_py() for x in replies.column(c)] for c in replies.column_names}
        self.n_served, self.n_words, n_houses = (sum(columns[c]) for c in ("n_served", "n_words", "n_houses"))
        n_tables = sum(columns["n_tables"])

        def gather(names: np.ndarray, parts: list[np.ndarray]) -> np.ndarray:
            """Values by place, in the order of the names that were asked for."""
            values = np.concatenate(parts)
            if len(values) != len(names):
                raise RuntimeError("replies do not belong to this bucket: a chunk was made again from other rows")
            out = np.empty_like(values)
            out[_in_order(mix(names) % np.uint64(n), n)] = values
            return out

        of_words = lambda c: gather(b.words, [_unpack(x) for x in columns[c]])
        self.served = of_words("served") if turn is None else None
        houses, tables = of_words("houses"), of_words("tables") / model.samples
        uniform = (model.parent_strength + model.parent_discount * n_tables) / (self.n_words + 1)
        self.parent = (houses - model.parent_discount * tables + uniform) / (model.parent_strength + n_houses)
        self.guests = np.bincount(b.context, b.customers, len(b.contexts)).astype(np.int64)
        others = np.zeros(len(b.contexts))
        if split:
            self.guests = gather(b.contexts, [_unpack(x) for x in columns["guests"]])
            others = gather(b.contexts, [_unpack(x) for x in columns["dishes"]])
        self.tables = seat(b.customers, b.context, self.parent[b.word], model.discount, model.strength, others=others,
                           rng=np.random.default_rng([model.seed, 2, own, 0 if turn is None else turn + 1]), burn_in=model.burn_in,
                           samples=model.samples if turn is None else 1)
        self.open = np.bincount(b.context, self.tables, len(b.contexts))


_SENT = "place int, key int, tables binary, open binary"


def _tables(key: tuple, rows: pa.Table, replies: pa.Table, n_buckets: int, model: Model, turn: int) -> pa.Table:
    """Tables of every word in this bucket, the parent's next customers, and those of its split contexts."""
    own = key[0].as_py()
    out: list[tuple] = []
    if own < 2 * n_buckets and rows.num_rows:
        s = _Seated(own, rows, replies, model, own >= n_buckets, turn)
        b = s.b
        tables = np.bincount(b.word, s.tables, len(b.words)).astype(np.int64)
        opened = s.open.astype(np.int64)
        contexts = b.contexts if own >= n_buckets else b.contexts[:0]
        for p, (w, c) in enumerate(zip(_dealt(b.words, n_buckets), _dealt(contexts, n_buckets))):
            out.append((p, own, _pack(tables[w]), _pack(opened[c])))
    types = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=[f.split()[0] for f in _SENT.split(", ")])


_OPENED = T.StructType([T.StructField("key", T.IntegerType()), T.StructField("words", T.BinaryType()),
                        T.StructField("open", T.DoubleType())])


def _hot(key: tuple, rows: pa.Table, replies: pa.Table, n_buckets: int, model: Model) -> pa.Table:
    """Tables of the split contexts of this bucket."""
    own = key[0].as_py()
    if not n_buckets <= own < 2 * n_buckets or not rows.num_rows:
        return to_arrow_schema(_OPENED).empty_table()
    s = _Seated(own, rows, replies, model, True)
    return pa.table([pa.array([own] * len(s.open), pa.int32()), pa.array([c.tobytes() for c in s.b.contexts], pa.binary()),
                     pa.array(s.open)], names=_OPENED.fieldNames())


_ANSWER = "key int, chunk long, bucket int, score binary, served binary, n_served long, n_words long"


def _children(key: tuple, rows: pa.Table, replies: pa.Table, n_buckets: int, model: Model) -> pa.Table:
    """Log probabilities of the pairs of every chunk."""
    own = key[0].as_py()
    out: list[tuple] = []
    if own < 2 * n_buckets and rows.num_rows:
        split = own >= n_buckets
        s = _Seated(own, rows, replies, model, split)
        b, opened = s.b, s.open
        if split:       # over all buckets that serve the context
            sums = replies.filter(pc.less(replies.column("place"), 0))
            named = np.array([_hashes(x.as_py())[0] for x in sums.column("words")], np.uint64)
            opened = sums.column("n_tables").to_numpy()[np.argsort(named)]
        guests = s.guests[b.context] + model.strength
        chance = ((b.customers - model.discount * s.tables)
                  + (model.strength + model.discount * opened[b.context]) * s.parent[b.word]) / guests
        score, served = np.log10(chance)[b.pair], s.served[b.word][b.pair]
        a = 0
        for chunk, n in zip(b.chunks, b.sizes):
            out.append((_stream_key(chunk, n_buckets), chunk, own, _pack_scores(score[a:a + n]), _pack(served[a:a + n]), s.n_served, s.n_words))
            a += n
    types = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=[f.split()[0] for f in _ANSWER.split(", ")])


_FIELDS = [T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
           T.StructField("train_tokens", T.LongType()), T.StructField("base_score", T.DoubleType()),
           T.StructField("score", T.DoubleType()), T.StructField("perplexity", T.DoubleType())]


def _scored(stream: dict, answers: pa.Table) -> pa.Table:
    """The texts of one chunk with their scores."""
    answers = answers.take(pc.sort_indices(answers, [("bucket", "ascending")]))
    score = np.concatenate([_unpack_scores(x.as_py()) for x in answers.column("score")] or [np.zeros(0)])
    served = np.concatenate([_unpack(x.as_py()) for x in answers.column("served")] or [np.zeros(0, np.int64)])
    sizes, step, often, n_pairs = (_unpack(stream[c]) for c in ("p1", "p2", "p3", "p4"))
    if len(score) != n_pairs[0]:
        raise RuntimeError("answers do not belong to this chunk: it was made again from other rows")
    n_served, n_words = answers.column("n_served")[0].as_py(), answers.column("n_words")[0].as_py()
    carried = pa.ipc.open_stream(stream["p0"]).read_all()
    doc = np.repeat(np.arange(len(sizes)), sizes)
    at = np.cumsum(step)
    starts = np.cumsum(sizes) - sizes
    at -= np.repeat(at[starts] - step[starts], sizes)       # steps begin anew with every text
    total = lambda x: np.bincount(doc, x * often, len(sizes))
    tokens = total(np.ones(len(doc)))
    base = total(np.log10((served[at] + 1) / (n_served + n_words + 1)))
    found = total(score[at])
    made = [tokens.astype(np.int64), total(served[at] > 0).astype(np.int64), np.full(len(sizes), n_served), base, found,
            10 ** (-found / tokens)]
    for field, values in zip(_FIELDS, made):
        carried = carried.append_column(field.name, pa.array(values))
    return carried


def _next_round(rows: DataFrame, asked: DataFrame, replies: DataFrame, n: int, model: Model, turn: int) -> DataFrame:
    """Replies of the parents, with the tables that the children open under the last replies as customers."""
    last = turn == model.rounds - 1
    sent = rows.groupBy("key").cogroup(replies.groupBy("key")).applyInArrow(
        lambda k, a, b: _tables(k, a, b, n, model, turn - 1), _SENT)
    return asked.groupBy("place").cogroup(sent.groupBy("place")).applyInArrow(
        lambda k, a, b: _parents(k, a, n, model, b, turn, last), _REPLY)


def score_texts(docs: DataFrame, train: Column, *, text: str = "text", model: Model = Model(),
                chunk_tokens: int = CHUNK, bucket_tokens: int = BUCKET) -> DataFrame:
    """The rows (without the text) with n_tokens, n_known, train_tokens, base_score, score and perplexity.

    The model learns from the rows on which ``train`` is true and scores all. ``score`` is the log10
    probability of the words and the end of the text, ``base_score`` that of single words counted with
    one added; ``perplexity`` is per token. Columns of these names are replaced.
    """
    names = [f.name for f in _FIELDS]
    taken = {*names, text.lower()}
    carry = [c for c in docs.columns if c.lower() not in taken]
    columns = [docs[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(carry)]
    source = docs.select(*columns, docs[f"`{text}`"].cast("string").alias("_text"), train.alias("_train"))
    numbered = [f"c{i}" for i in range(len(carry))]
    total, often = _frequent(source, "_text")
    n = max(1, -(-total // bucket_tokens))
    pieces = {w: -(-2 * n * count // total) for w, count in often.items() if 2 * n * count > total}
    hot = {"names": np.array(sorted(np.uint64(w & 0xFFFFFFFFFFFFFFFF) for w in pieces), np.uint64)}
    by_name = {w & 0xFFFFFFFFFFFFFFFF: p for w, p in pieces.items()}
    hot["pieces"] = np.array([by_name[int(w)] for w in hot["names"]], np.int64)

    rows = _chunks(source, "_text", "_train", numbered, n, hot, chunk_tokens)
    asked = rows.groupBy("key").applyInArrow(lambda k, t: _vocabulary(k, t, n, model, hot), _ASK)
    replies = asked.groupBy("place").applyInArrow(lambda k, t: _parents(k, t, n, model, last=model.rounds < 2), _REPLY)
    for turn in range(1, model.rounds):
        replies = _next_round(rows, asked, replies, n, model, turn)
    if pieces:
        opened = rows.groupBy("key").cogroup(replies.where(F.col("key") >= n).groupBy("key")).applyInArrow(
            lambda k, a, b: _hot(k, a, b, n, model), _OPENED)
        # a row per bucket and split context; the negative place tells it from the parents' replies
        sums = opened.select("key", F.lit(-1).alias("place"), "words",
                             F.sum("open").over(W.partitionBy("words")).alias("n_tables"))
        replies = replies.unionByName(sums, allowMissingColumns=True)
    answers = rows.groupBy("key").cogroup(replies.groupBy("key")).applyInArrow(
        lambda k, a, b: _children(k, a, b, n, model), _ANSWER)
    schema = T.StructType([source.schema[c] for c in numbered] + _FIELDS)

    def texts(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        made = [_scored(stream, right.filter(pc.equal(right.column("chunk"), stream["chunk"])))
                for stream in (left.to_pylist() if key[0].as_py() >= 2 * n else [])]
        return pa.concat_tables(made) if made else to_arrow_schema(schema).empty_table()

    found = rows.groupBy("key").cogroup(answers.groupBy("key")).applyInArrow(texts, schema)
    return found.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], *[F.col(x) for x in names])
