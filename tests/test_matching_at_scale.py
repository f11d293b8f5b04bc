"""Rarest-word search, place names of any length and character references, against plain versions."""

import html
import html.entities
import random

from pyspark.sql import functions as F

from tenderloom.functions import text as tx
from tenderloom.operators import geo as ge
from tenderloom.operators import linking as ln
from tests.test_linking_at_scale import most_rows

SUBJECT = ("id string, url string, platny boolean, ico_zadavatel string, parties array<struct<ico:string,nazev:string>>, "
           "predmet string, datum string, hodnota double, parent string, ord long")
SPEC = "id string, buyer string, title_tokens array<string>, from_date string, to_date string"


def specs_frame(spark, rows):
    return spark.createDataFrame(rows, SPEC).withColumns({c: F.col(c).cast("date") for c in ("from_date", "to_date")})


def test_watched_contracts_equal_a_scan_of_the_dump(spark):
    rng = random.Random(7)
    words = [f"slovo{i}" for i in range(14)]
    weights = [40, 20, 10] + [2] * 11
    pick = lambda n: sorted(set(rng.choices(words, weights, k=n)))
    contracts = [(f"c{i}", "u", rng.random() < 0.9, rng.choice(["10", "11", None]), [("20", "F")], rng.choice([None, ""]) if i % 40 == 0 else " ".join(pick(6)),
                  rng.choice([f"2026-0{rng.randrange(1, 8)}-{rng.randrange(10, 28)}", "x"]) if i % 30 == 0 else f"2026-0{rng.randrange(1, 8)}-{rng.randrange(10, 28)}",
                  float(i), "p" if rng.random() < 0.05 else None, i) for i in range(400)]
    specs = [(f"s{i}", rng.choice(["10", "11", "12", None]), pick(rng.randrange(0, 7)), f"2026-0{m}-15", f"2026-0{m + 2}-15")
             for i in range(80) for m in [rng.randrange(1, 6)]]
    want = {}
    for key, buyer, tokens, start, end in specs:
        for c in contracts:
            common = len(set(tokens) & set((c[5] or "").split()))
            if tokens and buyer and c[2] and not c[8] and c[3] == buyer and start <= c[6] <= end and common * 2 >= len(tokens):
                want[key] = c[0]
                break
    shuffled = rng.sample(contracts, len(contracts))
    got = ln.watched_contract_match(specs_frame(spark, specs), spark.createDataFrame(shuffled, SUBJECT))
    assert {r.id: r.contract_id for r in got.collect()} == want and len(want) > 30


def test_a_word_of_all_contracts_makes_no_pairs(spark):
    """10,000 contracts of one buyer share a word; twenty titles of one to three words have it."""
    contracts = spark.range(10_000).select(
        F.concat(F.lit("c"), "id").alias("id"), F.lit("u").alias("url"), F.lit(True).alias("platny"), F.lit("10").alias("ico_zadavatel"),
        F.array(F.struct(F.lit("20").alias("ico"), F.lit("F").alias("nazev"))).alias("parties"),
        F.concat(F.lit("oprava zvlastni"), "id").alias("predmet"), F.lit("2026-02-01").alias("datum"), F.lit(1.0).alias("hodnota"),
        F.lit(None).cast("string").alias("parent"), (10_000 - F.col("id")).alias("ord"))
    titles = [["oprava"], ["oprava", "jine"], ["oprava", "zvlastni77", "jine"], ["oprava", "jine", "dalsi"]] * 5
    specs = specs_frame(spark, [(f"s{i}", "10", t, "2026-01-10", "2026-04-10") for i, t in enumerate(titles)])
    texts = ln._subjects(contracts, specs.select("buyer").distinct()).persist()
    assert texts.count() == 10_000
    got = ln._first_shared(specs, texts)
    assert {r.id: r.contract_id for r in got.collect()} == {
        f"s{i}": {0: "c9999", 1: "c9999", 2: "c77"}[i % 4] for i in range(20) if i % 4 < 3}
    assert 0 < most_rows(got) <= 3 * 10_000          # words of the contracts; all pairs would be 200,000
    texts.unpersist()


def test_long_place_names_equal_a_scan_of_the_text(spark):
    rng = random.Random(3)
    vocabulary = ["aba", "bcd", "cde", "dur", "ef"]
    names = sorted({" ".join(rng.choices(vocabulary, k=rng.randrange(1, 6))) for _ in range(60)})
    places = [(n, 49 + i / 100, 15 + i / 50) for i, n in enumerate(names)]
    texts = [(None if i == 5 else i // 2, rng.choice(["a", None]), " ".join(rng.choices(vocabulary + ["jinde"], k=rng.randrange(0, 12)))) for i in range(60)]
    gazetteer = spark.createDataFrame(places, "name string, lat double, lon double")
    index = [tuple(r) for r in ge.gazetteer_index(gazetteer).select("first", "nwords", "rest", "lat", "lon", "dist").collect()]
    want = {}
    for k, part, text in texts:
        w = text.split()
        for pos, word in enumerate(w):
            for first, n, rest, lat, lon, dist in index:
                if first == word and pos + n <= len(w) and all(x in forms for x, forms in zip(w[pos + 1:], rest)):
                    want[k, part] = max(want.get((k, part), (0,)), (n, -dist, -lat, -lon))
    frame = spark.createDataFrame(texts, "k int, part string, text string")
    got = {(r.k, r.part): (r.nwords, r.lat, r.lon) for r in ge.gazetteer_match(frame, gazetteer, ["k", "part"]).collect()}
    assert got == {k: (v[0], -v[2], -v[3]) for k, v in want.items()}
    assert {n for n, _, _ in got.values()} >= {1, 2, 3, 4}


def test_character_references_as_html_5_reads_them(spark):
    names = [f"a&{n}b &{n}; {n}" for n in html.entities.html5]
    odd = ["&", "&&amp;lt;", "&amp;&#38;lt;&amp", "&notit;", "&#0;&#13;&#128;&#159;&#x81;", "&#xD800;&#x110000;&#99999999999999999999;", "&#xFDD0;&#xFFFE;&#1;",
           "&#x1F600;&#128512", "&#;&#x;&#xg;", "&unknown;&amplitude;", "&" + "x" * 40 + ";", "&#0000000000065;&#x00000000000041;", "a&\tb& c&<d", "&lt&gt;&AMP&quot",
           "", "nothing"]
    rows = names + odd
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(rows)] + [(-1, None)], "i int, t string")
    got = {r.i: r.u for r in frame.select("i", tx.html_unescape("t").alias("u")).collect()}
    assert got.pop(-1) is None
    wrong = [(t, got[i], html.unescape(t)) for i, t in enumerate(rows) if got[i] != html.unescape(t)]
    assert not wrong, wrong[:5]
