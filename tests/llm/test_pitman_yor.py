"""The language model against enumeration, plain counts and the laws of probability."""

import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tenderloom.llm import pitman_yor as py
from tenderloom.llm.words import word_blocks


def partitions(n):
    if n == 0:
        yield []
        return
    for rest in partitions(n - 1):
        for i in range(len(rest)):
            yield [*rest[:i], rest[i] + 1, *rest[i + 1:]]
        yield [*rest, 1]


def exact_tables(n, base, discount, strength, others):
    """Expected tables of a dish's n customers, over all seatings."""
    total = mean = 0.0
    for tables in partitions(n):
        w = math.prod(strength + discount * (others + j) for j in range(len(tables))) * base ** len(tables)
        w *= math.prod(math.prod(i - discount for i in range(1, size)) for size in tables)
        total, mean = total + w, mean + w * len(tables)
    return mean / total


@pytest.mark.parametrize("n,base,discount,strength,others", [(2, 0.3, 0.5, 1.0, 0), (4, 0.2, 0.75, 1.0, 3), (6, 0.5, 0.4, 2.0, 1)])
def test_seating_samples_the_posterior(n, base, discount, strength, others):
    houses = 8000
    got = py.seat(np.full(houses, n), np.arange(houses), np.full(houses, base), discount, strength,
                  others=np.full(houses, others), rng=np.random.default_rng(1), burn_in=12, samples=6)
    assert abs(got.mean() - exact_tables(n, base, discount, strength, others)) < 0.03


def seated_plainly(customers, house, base, discount, strength, *, others, rng, burn_in, samples, shares=1, predict=None):
    """The same seating with each dish's customers side by side, and arrays for every step however few sit down."""
    shares = np.broadcast_to(shares, len(others))
    tables = np.minimum(customers, 1).astype(np.float64)
    busy = np.flatnonzero(customers > 1)
    if not len(busy):
        return tables
    busy = busy[np.argsort(-customers[busy], kind="stable")]
    units = np.minimum(customers[busy], py.UNITS)
    first = np.cumsum(units) - units
    house_of, chance = house[busy], base[busy]
    total = np.bincount(house, tables, len(others)) - np.bincount(house_of, minlength=len(others))
    seats, size = np.zeros(int(units.sum()), np.int32), np.zeros(int(units.sum()), np.int32)
    open_, extra = np.zeros(len(busy), np.int64), np.zeros(len(busy), np.int64)
    n_at = np.searchsorted(-units, -np.arange(int(units[0])), "left")       # dishes that have a customer i
    large = np.flatnonzero(customers[busy] > units)

    def weight(n: int | np.ndarray) -> np.ndarray:
        at = house_of[n] if isinstance(n, np.ndarray) else house_of[:n]
        share = chance[n] if isinstance(n, np.ndarray) else chance[:n]
        return (strength + discount * (total[at] * shares[at] + others[at])) * share

    def sweep(again: bool) -> None:
        for i, n in enumerate(n_at):
            me = first[:n] + i
            if again:       # leave the table
                left = first[:n] + seats[me]
                size[left] -= 1
                closed = size[left] == 0
                open_[:n] -= closed
                np.subtract.at(total, house_of[:n][closed], 1)
                rest = units[:n] - 1
            else:
                rest = np.full(n, i)
            new_weight = weight(n)
            new = rng.random(n) * (new_weight + rest - discount * open_[:n]) < new_weight
            if i == 0 and not again:
                new[:] = True
            todo = np.flatnonzero(~new)
            while len(todo):    # the table of a random other customer, with chance (size - discount) / size
                who = (rng.random(len(todo)) * rest[todo]).astype(np.int64)
                if again:
                    who += who >= i
                table = seats[first[todo] + who]
                there = size[first[todo] + table]
                taken = rng.random(len(todo)) * there < there - discount
                done, at = todo[taken], table[taken]
                seats[me[done]] = at
                size[first[done] + at] += 1
                todo = todo[~taken]
            todo = np.flatnonzero(new)
            open_[todo] += 1
            np.add.at(total, house_of[todo], 1)
            slot = np.full(len(todo), i, np.int64)
            while len(todo):    # a place without a table
                free = size[first[todo] + slot] == 0
                done = todo[free]
                seats[me[done]] = slot[free]
                size[first[done] + slot[free]] = 1
                todo = todo[~free]
                slot = (rng.random(len(todo)) * units[todo]).astype(np.int64)
        if len(large):          # customers beyond UNITS open tables at the rate of the same rule
            a = weight(large)
            opened = rng.poisson(a * np.log((a + customers[busy[large]]) / (a + units[large])))
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


def dishes(n, customers, houses, shares):
    rng = np.random.default_rng(4)
    n_houses = max(houses, 1)
    return dict(customers=customers(rng, n), house=rng.integers(0, n_houses, n), base=rng.random(n) / 50,
                others=rng.integers(0, 9, n_houses) * (houses > 5) * 1.0, shares=np.where(np.arange(n_houses) % 2, shares, 1))


@pytest.mark.parametrize("houses,shares", [(1, 1), (1, 7), (5, 1), (40, 3)])
@pytest.mark.parametrize("changes", [False, True])
def test_seating_uses_its_random_numbers_as_step_by_step(houses, shares, changes):
    """Frequent and rare dishes, one and many restaurants, whole and in shares, with a parent that moves."""
    many = lambda rng, n: np.minimum(rng.zipf(1.4, n), 4 * py.UNITS) * (rng.random(n) < 0.9)
    given = dishes(900, many, houses, shares)
    predict = (lambda tables: (tables + 1) / (60 * (tables.sum() + 1))) if changes else None
    got, want = (f(given["customers"], given["house"], given["base"].copy(), 0.75, 1.0, others=given["others"], shares=given["shares"],
                   rng=np.random.default_rng(5), burn_in=1, samples=2, predict=predict) for f in (py.seat, seated_plainly))
    assert (given["customers"] > py.UNITS).any() and got.tolist() == want.tolist()


def test_steps_of_few_customers_take_little_time():
    """A frequent dish has a step for each customer, in which only the few dishes that are as frequent take part."""
    given = dishes(8, lambda rng, n: rng.integers(900, 1000, n), 3, 1)

    def seconds(f):
        start = time.process_time()
        f(given["customers"], given["house"], given["base"].copy(), 0.75, 1.0, others=given["others"], shares=given["shares"],
          rng=np.random.default_rng(5), burn_in=1, samples=2)
        return time.process_time() - start

    took = [(seconds(py.seat), seconds(seated_plainly)) for _ in range(5)]
    assert min(a for a, _ in took) < 0.8 * min(b for _, b in took), took


def test_seating_of_many_customers():
    n = np.array([5 * py.UNITS, 1, 0, py.UNITS // 2])
    got = py.seat(n, np.zeros(4, int), np.array([0.1, 0.2, 0.3, 0.01]), 0.5, 1.0, others=np.zeros(1),
                  rng=np.random.default_rng(2), burn_in=1, samples=2)
    assert got[1] == 1 and got[2] == 0 and 1 <= got[0] <= n[0] and 1 <= got[3] <= n[3]


def test_numbers_are_packed_whole():
    for most in (0, 1, 254, 255, 256, 65534, 65535, 65536, (1 << 32) - 1, 1 << 40):
        x = np.array([0, most, most // 2, *range(40), most], np.int64)
        assert py._unpack(py._pack(x)).tolist() == x.tolist()
    assert py._unpack(py._pack(np.zeros(0, np.int64))).tolist() == []


def test_scores_are_packed_to_a_millionth():
    x = np.array([0.0, -0.3, -14.9999, -15.0, -15.0001, -400.0, -1e-9])
    assert np.abs(py._unpack_scores(py._pack_scores(x)) - x).max() < 1e-6
    assert len(py._unpack_scores(py._pack_scores(x[:0]))) == 0


def name(word):
    return int(next(word_blocks(pa.array([word]), "space")).hashes()[0])


def predictions(texts, train, n, split=()):
    """log10 P(word | context) of every pair of the texts, by the steps of the plan on one machine."""
    hot = {"names": np.array(sorted(name(w) for w in split), np.uint64), "pieces": np.full(len(split), 3)}
    block = next(word_blocks(pa.array(texts), "space"))
    rows = py._chunk_rows([(block.hashes(), block.counts)], np.array(train), pa.table({"i": range(len(texts))}), n, hot, 5)
    table = lambda rows, like: pa.Table.from_pylist([dict(zip(like, r)) for r in rows])
    by_key = {r[0]: pa.Table.from_batches([py._row_batch([r])]) for r in rows[:-1]}
    model = py.Model(burn_in=2, samples=3)
    scalar = lambda x: (pa.scalar(x, pa.int32()),)
    asked = pa.concat_tables([py._vocabulary(scalar(k), t, n) for k, t in by_key.items()])
    replies = pa.concat_tables([py._parents(scalar(p), asked.filter(py.pc.equal(asked["place"], p)), n, model) for p in range(n)])
    own = lambda k: replies.filter(py.pc.equal(replies["key"], k))
    opened = Counter()
    for k, t in by_key.items():
        for r in py._hot(scalar(k), t, own(k), n, model).to_pylist():
            opened[r["words"]] += r["open"]
    out = {}
    for k, t in by_key.items():
        b = py._Bucket(t)
        extra = [{"key": k, "place": -1, "words": c.tobytes(), "n_tables": opened[c.tobytes()]} for c in b.contexts] if k >= n else []
        with_sums = pa.concat_tables([own(k), pa.Table.from_pylist(extra, schema=own(k).schema)] if extra else [own(k)])
        answer = py._children(scalar(k), t, with_sums, n, model).to_pylist()[0]
        score = py._unpack_scores(answer["score"])
        for i, j in enumerate(b.pair):
            out[int(b.contexts[b.context[j]]), int(b.words[b.word[j]])] = float(score[i])
    return out


@pytest.mark.parametrize("n,split", [(1, ()), (3, ()), (3, ("a",)), (4, ("a", "b"))])
def test_predictions_add_up_to_one(n, split):
    rng = random.Random(8)
    words = ["a", "b", "c", "d", "e"]
    taught = [" ".join(rng.choices(words, [9, 5, 3, 2, 1], k=rng.randrange(1, 30))) for _ in range(60)]
    asked = [f"{u} {w}" for u in [*words, "new"] for w in [*words, "new"]]     # every pair, one unknown word
    found = predictions(taught + asked, [True] * len(taught) + [False] * len(asked), n, split)
    for context in [*map(name, words), name("new")]:
        total = sum(10 ** s for (u, _), s in found.items() if u == context)
        assert abs(total - 1) < 1e-5, context


def plain(rows, k=7, out=2):
    lowered = {i: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None] for i, t in rows}
    train = [zlib.crc32(str(i).encode()) % k != out for i, _ in rows]
    counts = Counter(w for (i, _), x in zip(rows, train) if x for w in lowered[i])
    n, v = sum(counts.values()), len(counts)
    return {i: (len(lowered[i]), sum(counts[w] > 0 for w in lowered[i]), n,
                sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in lowered[i])) for i, _ in rows}


def scored(spark, rows, **more):
    docs = spark.createDataFrame([(i, t, "x", 7) for i, t in rows], "doc_id long, text string, SCORE string, c0 int")
    return py.score_texts(docs, F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) != 2, **more)


def test_counts_and_scores_of_texts(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(w.upper() if rng.random() < 0.1 else w for w in rng.choices(words, [1 / (1 + j) for j in range(200)], k=rng.randrange(1, 40))))
            for i in range(300)]
    rows += [(300, None), (301, ""), (302, " \t\n"), (303, "É é É"), (304, "never seen at all"), (305, "w1 " * 30000), (306, "x" * 50000)]
    want = plain(rows)
    for chunk_tokens in (1 << 20, 700):     # 700: many chunks and buckets, w0 and w1 in several of them
        df = scored(spark, rows, chunk_tokens=chunk_tokens, bucket_tokens=2 * chunk_tokens)
        assert df.columns == ["doc_id", "c0", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"]
        got = {r.doc_id: r for r in df.collect()}
        assert set(got) == set(want)
        for i, (n_tokens, known, total, base) in want.items():
            r = got[i]
            assert (r.n_tokens, r.n_known, r.train_tokens, r.c0) == (n_tokens, known, total, 7)
            assert abs(r.base_score - base) < 1e-9 * max(1, abs(base)) and r.score <= 0
            assert abs(r.perplexity - 10 ** (-r.score / n_tokens)) < 1e-6 * r.perplexity
        assert sum(r.score for r in got.values()) > sum(r.base_score for r in got.values())


def test_repeated_rows_no_training_and_no_rows(spark):
    rows = [(1, "a b"), (1, "a b"), (None, "a b")]
    assert len({(r.n_tokens, round(r.score, 6)) for r in scored(spark, rows).collect()}) == 1
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for r in py.score_texts(docs, F.lit(False)).collect():
        assert (r.n_known, r.train_tokens, r.base_score, round(r.score, 6)) == (0, 0, 0.0, 0.0)
    assert py.score_texts(docs.limit(0), F.lit(True)).count() == 0


def after_rounds(texts, train, n, split, model):
    """Sum of P(word | context) over the pairs of the texts, by the steps of the plan with several rounds."""
    hot = {"names": np.array(sorted(name(w) for w in split), np.uint64), "pieces": np.full(len(split), 3)}
    block = next(word_blocks(pa.array(texts), "space"))
    rows = py._chunk_rows([(block.hashes(), block.counts)], np.array(train), pa.table({"i": range(len(texts))}), n, hot, 5)
    keys = {r[0]: pa.Table.from_batches([py._row_batch([r])]) for r in rows[:-1]}
    scalar = lambda x: (pa.scalar(x, pa.int32()),)
    of = lambda table, column, x: table.filter(py.pc.equal(table[column], x))
    asked = pa.concat_tables([py._vocabulary(scalar(k), t, n, model, hot) for k, t in keys.items()])
    replies = pa.concat_tables([py._parents(scalar(p), of(asked, "place", p), n, model) for p in range(n)])
    for turn in range(1, model.rounds):
        sent = pa.concat_tables([py._tables(scalar(k), t, of(replies, "key", k), n, model, turn - 1) for k, t in keys.items()])
        replies = pa.concat_tables([py._parents(scalar(p), of(asked, "place", p), n, model, of(sent, "place", p), turn) for p in range(n)])
        tables = sum(int(py._unpack(x.as_py()).sum()) for x in sent["tables"])
        assert tables == sum(of(replies, "key", min(keys))["n_houses"].to_pylist())      # one customer of the parent each
    seated = {k: py._Seated(k, t, of(replies, "key", k), model, k >= n) for k, t in keys.items()}
    opened, total = Counter(), Counter()
    for s in seated.values():
        opened.update(dict(zip(s.b.contexts.tolist(), s.open.tolist())))
    for s in seated.values():
        u = s.b.contexts[s.b.context].tolist()
        chance = (s.b.customers - model.discount * s.tables + (model.strength + model.discount * np.array([opened[x] for x in u]))
                  * s.parent[s.b.word]) / (s.guests[s.b.context] + model.strength)
        for x, c in zip(u, chance.tolist()):
            total[x] += c
    return total


@pytest.mark.parametrize("n,split", [(1, ()), (3, ()), (3, ("a",)), (4, ("a", "b"))])
def test_predictions_add_up_to_one_after_rounds(n, split):
    rng = random.Random(8)
    words = ["a", "b", "c", "d", "e"]
    taught = [" ".join(rng.choices(words, [9, 5, 3, 2, 1], k=rng.randrange(1, 30))) for _ in range(60)]
    asked = [f"{u} {w}" for u in [*words, "new"] for w in [*words, "new"]]
    total = after_rounds(taught + asked, [True] * len(taught) + [False] * len(asked), n, split, py.Model(rounds=3))
    for context in [*map(name, words), name("new")]:
        assert abs(total[context] - 1) < 1e-9


def sampled(pairs, asked, model, sweeps=30, burn_in=10):
    """P(word | context) by plain Gibbs sampling of the whole hierarchy: every table of a restaurant is a
    customer of the parent, which sits down when the table opens and leaves when it closes."""
    rng = random.Random(3)
    children, parent, guests, opened, top = {}, {}, Counter(), Counter(), Counter()
    uniform = 1 / (len({w for _, w in pairs}) + 1)

    def predicted(w):
        tables = parent.get(w, ())
        return (sum(tables) - model.parent_discount * len(tables)
                + (model.parent_strength + model.parent_discount * top["tables"]) * uniform) / (model.parent_strength + top["guests"])

    def sit(tables, discount, new):
        x = rng.random() * (sum(tables) - discount * len(tables) + new)
        for i, size in enumerate(tables):
            x -= size - discount
            if x < 0:
                tables[i] += 1
                return False
        tables.append(1)
        return True

    def leave(tables):
        i = rng.choices(range(len(tables)), tables)[0]
        tables[i] -= 1
        if not tables[i]:
            del tables[i]
            return True
        return False

    mean = Counter()
    for sweep in range(-1, sweeps):
        for u, w in pairs:
            if sweep >= 0:
                guests[u] -= 1
                if leave(children[u, w]):
                    opened[u] -= 1
                    top["guests"] -= 1
                    top["tables"] -= leave(parent[w])
            guests[u] += 1
            if sit(children.setdefault((u, w), []), model.discount, (model.strength + model.discount * opened[u]) * predicted(w)):
                opened[u] += 1
                new = (model.parent_strength + model.parent_discount * top["tables"]) * uniform
                top["tables"] += sit(parent.setdefault(w, []), model.parent_discount, new)
                top["guests"] += 1
        for u, w in asked if sweep >= burn_in else []:
            tables = children.get((u, w), ())
            mean[u, w] += (sum(tables) - model.discount * len(tables) + (model.strength + model.discount * opened[u]) * predicted(w)
                           ) / (model.strength + guests[u]) / (sweeps - burn_in)
    return mean


@pytest.mark.parametrize("bucket_tokens", [1 << 20, 3000])
def test_tables_of_restaurants_are_customers_of_the_parent(spark, bucket_tokens):
    """Pairs that are often repeated open many tables, so their words weigh more in the parent than by the
    number of restaurants that serve them."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(120)]
    weights = [1 / (1 + i) for i in range(120)]
    follows = {w: rng.choices(words, weights, k=4) for w in words}
    taught = []
    for _ in range(500):
        text = rng.choices(words, weights)
        for _ in range(14):
            text.append(rng.choice(follows[text[-1]]) if rng.random() < 0.6 else rng.choices(words, weights)[0])
        taught.append(text)
    asked = [["new", w] for w in words[:60]] + [[u, w] for u in words[60:70] for w in words[:10]]
    walk = lambda text: list(zip(["<", *text], [*text, ">"]))
    chance = sampled([p for t in taught for p in walk(t)], {p for t in asked for p in walk(t)}, py.Model())
    want = [sum(math.log10(chance[p]) for p in walk(t)) for t in asked]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(asked + taught)], "doc_id long, text string")
    rows = py.score_texts(docs, F.col("doc_id") >= len(asked), bucket_tokens=bucket_tokens).where(F.col("doc_id") < len(asked)).collect()
    off = np.array([r.score for r in sorted(rows)]) - want
    assert abs(off[:60].mean()) < 0.05 and np.sqrt((off ** 2).mean()) < 0.12
