"""Filter interactions and hard negatives against plain counterparts."""

import math
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tenderloom.llm import filter_audit, hard_negatives

TEXT = st.text(alphabet="aB1 é\t\n\x0b#|€\U0001F600-", max_size=60)
GOES, SAYS = filter_audit._tables(filter_audit.SYMBOLS)


def plain_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return [len(words), len(set(words)), len(re.findall("[A-Z]", text or "")), len(text or ""),
            len(re.findall("[#$%&*|]", text or ""))]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=6), st.sampled_from([5, 7, 256]), st.sampled_from([16, 1 << 20]))
def test_transducer_counts_as_regular_expressions_do(texts, lane, block):
    before = filter_audit.LANE, filter_audit.BLOCK
    filter_audit.LANE, filter_audit.BLOCK = lane, block
    try:
        got = [c.to_pylist() for c in filter_audit._measured(pa.array(texts, pa.string()), GOES, SAYS)]
    finally:
        filter_audit.LANE, filter_audit.BLOCK = before
    assert [list(x) for x in zip(*got)] == [plain_measures(t) for t in texts]


def test_long_texts_and_equal_hashes():
    rng = random.Random(5)
    long = " ".join(rng.choice(["é" * 9, "abcdefgh", "abcdefghi", "x", "€uro"]) + str(rng.randrange(50)) for _ in range(20000))
    one = "w" * 100_000
    got = [c.to_pylist() for c in filter_audit._measured(pa.array([long, one, "a a", one + " " + one]), GOES, SAYS)]
    assert [list(x) for x in zip(*got)] == [plain_measures(t) for t in (long, one, "a a", one + " " + one)]

    class Alike(filter_audit.Words):        # every hash collides: only the spellings tell words apart
        def hashes(self):
            return np.zeros(len(self.starts), np.uint64)

    data, at = filter_audit.texts_of(pa.array(["ab abcdefghij ab cd", "cd abcdefghiX abcdefghij cd"]))
    words = filter_audit._spans(data, at, filter_audit._events(data, at, GOES, SAYS), 0)
    alike = Alike(words.first_row, words.data, words.text_starts, words.starts, words.ends, words.bounds)
    assert filter_audit._first_of_kind(alike).tolist() == [True, True, False, True, True, True, True, False]


def plain_audit(rows, fails, part, good):
    out = []
    for name in sorted({r[part] or "" for r in rows}):
        own = [(fails(r), good(r)) for r in rows if (r[part] or "") == name]
        removed_by = Counter()
        for order in permutations("ABC"):
            for bad, _ in own:
                removed_by.update([next((f for f in order if f in bad), None)])
        for order in permutations("ABC"):
            for step, f in enumerate(order, 1):
                before = set(order[:step - 1])
                out.append((name, "".join(order), step, sum(not set(order[:step]) & b for b, _ in own),
                            sum(f in b and not before & b for b, _ in own), sum(f in b and bool(before & b) for b, _ in own),
                            sum(b == {f} for b, _ in own), sum(f in b and not before & b and g for b, g in own), removed_by[f]))
    return sorted(out)


def test_audit_of_all_orders(spark):
    rng = random.Random(3)
    rows = [{"lang": rng.choice(["en", "", None, "de"]), "bad": "".join(f for f in "ABC" if rng.random() < 0.4),
             "good": rng.random() < 0.5, "n": i} for i in range(200)]
    df = spark.createDataFrame([(r["lang"], r["bad"], r["good"], r["n"], "x") for r in rows],
                               "lang string, bad string, good boolean, n long, fails string")
    got = filter_audit.audit(df, {f: F.col("bad").contains(f) for f in "ABC"}, part="lang", losses={"good_lost": F.col("good")})
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "shapley"]
    assert sorted(tuple(r[c] for c in names) for r in got.collect()) == \
        plain_audit(rows, lambda r: set(r["bad"]), "lang", lambda r: r["good"])
    assert got.limit(0).schema == filter_audit.audit(df.limit(0), {f: F.col("bad").contains(f) for f in "ABC"}, part="lang",
                                                     losses={"good_lost": F.col("good")}).schema
    assert filter_audit.audit(df.limit(0), {"A": F.lit(True)}, part="lang", losses={}).count() == 0


def test_measure_and_copies_of_odd_rows(spark):
    docs = spark.createDataFrame([(3, "B a", 1), (1, "B a", 2), (1, "B a", 3), (None, "B a", 4), (5, None, 5), (4, "", 6), (9, "é #", 7)],
                                 "doc_id long, text string, N_WORDS long").withColumn("same", filter_audit.digest("text"))
    rows = filter_audit.later_copies(filter_audit.measure(docs), row_id="doc_id", same="same", name="copy")
    assert sorted(((r.doc_id, r.n_words, r.n_capitals, r.n_points, r.n_symbols, r["copy"]) for r in rows.collect()), key=repr) == \
        sorted([(3, 2, 1, 3, 0, True), (1, 2, 1, 3, 0, False), (1, 2, 1, 3, 0, False), (None, 2, 1, 3, 0, False),
                (5, 0, 0, 0, 0, True), (4, 0, 0, 0, 0, False), (9, 2, 0, 3, 1, False)], key=repr)
    assert rows.where("false").count() == 0


def plain_mine(rows, positives=5, negatives=10, low=30, high=90):
    taken = {}
    for i, v, label in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        new = (label, [math.floor(256 * x) for x in v])
        taken[i] = min(taken.get(i, new), new)
    out = []
    for a, (label, q) in taken.items():
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v)), i, own) for i, (own, v) in taken.items() if i != a)
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            fit = [x for x in scored if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s]
            out += [(a, p, rank, i, -s, -n) for rank, (n, i, _) in enumerate(fit[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("rank", F.lit("x"))
    taken = hard_negatives.quantise(df, row_id="vec_id", vector="embedding", label=F.col("label"), scale=256)
    got = hard_negatives.mine(taken, F.col("id") % 100 == 0, **more).collect()
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r[c] for c in names) for r in got)


def test_hard_negatives_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(420):
        base = rng.normal(size=8)
        base = base / np.linalg.norm(base) * rng.choice([0.2, 1.0, 1.01, 7.0])
        if i % 9 == 0:
            base = np.array([0.5] * 8)              # many equal vectors: ties
        rows.append((i, [float(np.float32(x)) for x in base], int(rng.integers(0, 3))))
    rows += [(500, [0.0] * 8, 1), (600, [-0.5] * 8, 1), (601, [float("nan")] * 8, 0), (602, [float("inf")] + [1.0] * 7, 0),
             (603, None, 0), (604, [None] + [1.0] * 7, 0), (605, [1.0] * 8, None), (None, [1.0] * 8, 0),
             (100, [0.25] * 8, 0), (700, [], 1), (800, [1.0, 2.0], 2), (7, rows[7][1], rows[7][2])]
    for more in ({}, {"rows_per_block": 50, "anchors_per_block": 2}):
        assert mined(spark, rows, **more) == plain_mine(rows), more


def test_hard_negatives_of_few_rows(spark):
    assert mined(spark, [(100, [1.0], 1)]) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    schema = "vec_id long, embedding array<float>, label int"
    empty = hard_negatives.quantise(spark.createDataFrame([], schema), row_id="vec_id", vector="embedding",
                                    label=F.col("label"), scale=256)
    assert hard_negatives.mine(empty, F.col("id") % 100 == 0).count() == 0
    big = [(100, [3e30, 1.0], 1), (1, [3e30, 1.0], 1), (2, [1e5, 0.0], 2)]      # held to +-2^27
    edge = 1 << 27
    assert mined(spark, big) == [] and mined(spark, [*big, (3, [edge / 512, 0.0], 2)]) == \
        [(100, 1, 1, 3, edge * edge + 256 * 256, edge * edge // 2)]
