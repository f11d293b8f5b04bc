"""Word kernel, decontamination, classifiers and packing against plain counterparts."""

import os
import random
import re
import subprocess
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tenderloom.llm import decontaminate, packing, quality_rank, toxicity
from tenderloom.llm.words import window_mask, windows, word_blocks

ALPHABET = st.text(alphabet="aB1 é\t\n\x0b.,-ß \U0001F600", max_size=40)
PATTERN = {"space": r"[^\x20\x09-\x0D]+", "alnum": r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"}
DOCS = "doc_id long, text string, lang string, n_words string"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), ALPHABET), max_size=6), st.sampled_from(["space", "alnum"]), st.integers(1, 60))
def test_words_are_those_of_the_pattern(texts, kind, size):
    got = []
    for block in word_blocks(pa.array(texts, pa.string()), kind, size=size):
        h = block.hashes() if len(block.starts) else []
        for i in range(len(block)):
            a, b = block.bounds[i], block.bounds[i + 1]
            got.append([(block.word(j).decode(), int(h[j])) for j in range(a, b)])
    want = [re.findall(PATTERN[kind], lowered(t)) for t in texts]
    assert [[w for w, _ in row] for row in got] == want
    names = {}
    for w, h in (x for row in got for x in row):        # one hash for a word, other words other hashes
        assert names.setdefault(w, h) == h
    assert len(set(names.values())) == len(names)


def test_windows_stay_in_their_text():
    block = next(word_blocks(pa.array(["a b c", "b c", "a b c"]), "space"))
    w, ok = windows(block.hashes(), 3), window_mask(block, 3)
    assert ok.tolist() == [True, False, False, False, False, True] and w[0] == w[5]


ITEMS = [(1, "one two three four five six seven eight nine ten eleven"), (2, "Short, item!"), (2, "Short, item!"),
         (3, None), (4, "  "), (None, "nameless little thing"), (30, "one two three four five six seven eight nine ten")]


def plain_hits(text, items, k=10):
    words = re.findall(PATTERN["alnum"], lowered(text))
    hit, named = set(), set()
    for item_id, said in items:
        item = re.findall(PATTERN["alnum"], lowered(said))
        n = min(k, len(item))
        grams = {tuple(item[i:i + n]) for i in range(len(item) - n + 1)} if n else set()
        for i in range(len(words) - n + 1) if n else ():
            if tuple(words[i:i + n]) in grams:
                hit.update(range(i, i + n))
                if item_id is not None:
                    named.add(str(item_id))
    return len(words), len(hit), sorted(named)


@pytest.mark.parametrize("part_bytes", [1 << 20, 30])
def test_items_are_found_whole(spark, part_bytes):
    one = "ONE two, three; four five six seven eight nine ten"
    texts = [one, f"x {one} eleven y short item", "short\nITEM short item", "a nameless little thing", "", None, " . ",
             "one two three four five six seven eight nine", one + " " + "w " * 3000 + one, one]
    docs = spark.createDataFrame([(i // 2, t, "en", "clash") for i, t in enumerate(texts)], DOCS)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.find_items(docs, items, part_bytes=part_bytes).collect()
    assert sorted(((r["text"] or "", r["n_words"], r["n_hit"], r["items"]) for r in got), key=repr) == sorted(
        ((t or "", *plain_hits(t, ITEMS)) for t in texts), key=repr)
    cut = {(r["doc_id"], r["text"]) for r in decontaminate.remove_items(docs, items, part_bytes=part_bytes).collect()}
    assert (0, "x\ny") in cut and (2, "") in cut and (2, None) in cut and (3, " . ") in cut
    assert not any(plain_hits(t, ITEMS)[1] for _, t in cut)
    assert (0, "") not in cut                           # nothing of the first text is left
    assert decontaminate.find_items(docs, items.limit(0)).where("n_hit > 0").count() == 0
    assert decontaminate.find_items(docs.limit(0), items).count() == 0


def junk_and_prose(seed, n):
    rng = random.Random(seed)
    vocabulary = ["river", "stone", "under", "quiet", "walks", "about", "seven", "light"]
    rows = []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(20, 80))]
        good = i % 4 != 0
        rows.append((i, " ".join(words if good else [w + rng.choice(["***", "%%%", "$$$"]) for w in words]) + ".", int(good)))
    return rows


def test_quality_ranking_separates_held_out_rows(spark):
    rows = junk_and_prose(1, 400)
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(500, None, "x"), (501, "", "x"), (502, " \n", "x")],
                                 "doc_id long, text string, score string")
    held = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    known = [(i, q) for i, _, q in rows if i not in held]
    labels = spark.createDataFrame(known + known[:5] + [(None, 1), (7, None)], "doc_id long, quality int")
    model = quality_rank.fit(docs, labels, sample=60)
    got = {r["doc_id"]: r for r in quality_rank.score(docs, model).collect()}
    assert len(got) == 403 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    right = [got[i]["predicted"] == q for i, _, q in rows if i in held]
    assert sum(right) >= 0.97 * len(right)
    assert got[500]["score"] == got[501]["score"]
    nothing = quality_rank.fit(docs, labels.where("quality = 1"))
    assert {r["score"] for r in quality_rank.score(docs, nothing).collect()} == {0.5}
    assert quality_rank.score(docs.limit(0), model).count() == 0


def test_quality_threshold_is_that_of_all_labelled_rows(spark):
    rng = random.Random(4)
    rows = [(i, t + " " + "".join(rng.choices("abcdefgh", k=20)), q if rng.random() < 0.8 else 1 - q)
            for i, t, q in junk_and_prose(3, 500)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(900 + i, "not labelled") for i in range(50)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    model = quality_rank.fit(docs, labels, sample=15)
    raw = np.sort([model.raw(quality_rank._all_features(pa.array([t])))[0] for _, t, _ in rows])
    bad = sum(q == 0 for _, _, q in rows)
    assert model.threshold == pytest.approx((raw[bad - 1] + raw[bad]) / 2, abs=1e-9)
    scores = spark.createDataFrame([(float(v),) for v in [2, 1, 1, 5, 1, 9]], "raw double")
    assert [quality_rank.cut(scores, k) for k in range(1, 7)] == [1, 1, 1.5, 3.5, 7, 9]


def test_pair_weights_lower_the_logistic_loss():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 4))
    good = x[:, 2] > 0
    model = quality_rank.fit_pairs(x, good, 0.5)
    assert np.argmax(np.abs(model.weights)) == 2 and ((model.score(x) >= 0.5) == good).mean() > 0.97


def toxic_texts(seed, n):
    rng = random.Random(seed)
    prose = ["ander", "then", "hered", "ation", "blend", "thor", "oned", "inst", "ther", "rean"]
    rows = []
    for i in range(n):
        words = [rng.choice(prose) + rng.choice(["", "s", "ed"]) for _ in range(rng.randint(5, 60))]
        bad = i % 3 == 0
        for _ in range(rng.randint(1, 3) if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["vilem", "grozz"]) + rng.choice(["", "e", "ing", "or"]))
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_toxicity_learns_word_stems(spark):
    rows = toxic_texts(2, 500)
    docs = spark.createDataFrame([(i, t, 1.5) for i, t, _ in rows] + [(900, None, 0.0), (901, "", 0.0), (902, "word " * 5000, 0.0)],
                                 "doc_id long, text string, predicted double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i < 380] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, sample=250)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    assert len(got) == 503 and all(0 <= r["score"] <= 1 for r in got.values())
    assert got[900]["score"] == got[901]["score"]
    right = [got[i]["predicted"] == y for i, _, y in rows[380:]]
    assert sum(right) >= 0.95 * len(right)
    assert toxicity.fit(docs, labels.where("toxic = 0")).network is None


def test_toxicity_learns_from_long_texts_only(spark):
    rng = random.Random(8)
    plain = ["river", "stone", "cloud", "paper", "garden", "window", "letter", "summer"]
    rows = []
    for i in range(30):
        words = [rng.choice(plain) for _ in range(1500)]
        if i % 2:
            words[::12] = ["vileword"] * len(words[::12])
        rows.append((i, " ".join(words), i % 2))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, model).collect()}
    assert got == {i: y for i, _, y in rows}
    nothing = toxicity.fit(docs, labels.where("toxic = 0"))
    assert {(r["score"], r["predicted"]) for r in toxicity.score(docs, nothing).collect()} == {(0.0, 0)}
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_excerpts_reach_from_the_first_to_the_last_word():
    texts = [None, "", "a  b\nc", " ".join(map(str, range(1000)))]
    null, empty, kept, spread = toxicity.excerpt(pa.array(texts, pa.string()), 80, 8).to_pylist()
    assert (null, empty, kept) == ("", "", "a  b\nc")
    words = [int(w) for w in spread.split()]
    assert len(words) == 80 and words[0] == 0 and words[-1] == 999 and words == sorted(set(words))
    assert max(b - a for a, b in zip(words, words[1:])) < 150


def test_workers_need_no_copy_of_the_package(tmp_path):
    """The driver finds the package, the workers start in another folder."""
    code = f"""
import sys
sys.path.insert(0, {os.getcwd()!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
from tenderloom.llm import decontaminate, toxicity
docs = spark.createDataFrame([(i, "one two three four " + ("vile" if i % 2 else "nice")) for i in range(8)], "doc_id long, text string")
labels = docs.selectExpr("doc_id", "int(doc_id % 2) AS toxic")
assert toxicity.score(docs, toxicity.fit(docs, labels)).count() == 8
items = spark.createDataFrame([("x", "three four vile")], "item_id string, text string")
assert decontaminate.find_items(docs, items).where("n_hit = 3").count() == 4
assert decontaminate.remove_items(docs, items).where("n_cut = 3").count() == 4
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]


def test_network_gradients_match_differences():
    network = toxicity.Network.fresh(3)
    block = next(word_blocks(pa.array(["one two three", "four " * 40, ""]), "space"))
    x = toxicity.inputs_of(block)
    vectors = network.vectors(x)
    weights = np.linspace(-1, 1, len(x.windows)).astype(np.float32)

    def loss():
        return float(network.forward(network.project(network.vectors(x)), x.windows).astype(np.float64) @ weights)

    trace = {}
    projected = network.project(vectors)
    network.forward(projected, x.windows, trace)
    g = network.gradients(x, vectors, x.windows, projected, trace, weights)
    for name, at in (("w", (0, 3, 5)), ("w", (1, 2, 20)), ("u", (0, 1, 9)), ("u", (1, 4, 18)), ("b", (0, 7)), ("a", (3,)), ("o", (9,))):
        p = network.p[name]
        kept = p[at]
        p[at] = kept + 1e-2
        up = loss()
        p[at] = kept - 1e-2
        down = loss()
        p[at] = kept
        assert (up - down) / 2e-2 == pytest.approx(float(g[name][at]), abs=2e-3)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 64), max_size=80), st.sampled_from([(64,), (16, 32, 64), (8, 64)]))
def test_packing_is_whole_and_tight(sizes, lengths):
    bins, offsets, made = packing.pack(sizes, lengths)
    assert all(c in lengths for c in made)
    for b, length in enumerate(made):
        spans = sorted((offsets[i], offsets[i] + sizes[i]) for i in range(len(sizes)) if bins[i] == b)
        assert spans[-1][1] <= length and all(x[1] == y[0] for x, y in zip(spans, spans[1:])) and spans[0][0] == 0
        assert not [c for c in lengths if spans[-1][1] <= c < length]
    if len(lengths) == 1:                               # never two bins that would fit into one
        used = np.bincount(bins, weights=sizes, minlength=len(made)) if sizes else []
        assert sum(u <= 32 for u in used) <= 1 or 0 in sizes


def test_documents_are_packed_once(spark):
    rows = [(1, 20), (1, 20), (2, None), (3, 0), (4, 150), (None, 64), (5, -3)]
    docs = spark.createDataFrame([(i, n, "x") for i, n in rows], "doc_id long, n long, bin_id string")
    got = packing.pack_documents(docs, docs["n"], lengths=(16, 64), block_pieces=3).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in got) == sorted(
        [("1", 20), ("1", 20), ("2", 0), ("3", 0), ("4", 64), ("4", 64), ("4", 22), ("None", 64), ("5", 0)])
    for r in got:
        assert r["bin_offset"] + r["n_tokens"] <= r["bin_tokens"] <= r["bin_length"]
    assert packing.pack_documents(docs.limit(0), docs["n"]).count() == 0
