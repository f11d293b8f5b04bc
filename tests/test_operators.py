"""Small hand-made cases for filters, geography, linking, history and documents."""

import pytest
from pyspark.sql import functions as F

from tenderloom import Settings
from tenderloom.functions import geo as gf
from tenderloom.functions import text as tx
from tenderloom.operators import changes as ch
from tenderloom.operators import competition as cp
from tenderloom.operators import documents as dc
from tenderloom.operators import filters as fl
from tenderloom.operators import geo as ge
from tenderloom.operators import linking as ln
from tenderloom.operators import relevance as rl
from tenderloom.operators import verdicts as vd
from tenderloom.schemas import LINK

TODAY = "2026-08-01"


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("title, hit", [
    ("Oprava střechy", True), ("Dopravní značení", False), ("(opravy) MŠ", True), ("Oprava silnice II/315", False),
    ("Zpracování PD na opravu", False), ("Zateplení ZŠ", True),
])
def test_stems_match_at_word_starts(spark, title, hit):
    assert one(spark, fl.kw_match(F.lit(title))) is hit


def test_sector_rules(spark):
    rows = [
        ("general", "Kanalizace obce", ["45000000"], "isvz"), ("special", "Kanalizace a škola", ["45214200"], "isvz"),
        ("excluded", "Silnice", ["45233100"], "isvz"), ("word", "Rekonstrukce ZŠ", ["33000000"], "isvz"),
        ("trusted", "Cokoli", [], "profil:trutnov"), ("feed", "Cokoli", [], "profil:pvu:1"), ("agency", "Cokoli", [], "profil:john-nell-baby"),
    ]
    df = spark.createDataFrame(rows, "id string, title string, cpv array<string>, source string")
    got = {r["id"]: r["kw_match"] for r in fl.sector_filter(df).collect()}
    assert got == {"special": False, "word": True, "trusted": False}


def test_expiry_by_state_prefix(spark):
    df = spark.createDataFrame([("a", None, "neukončen"), ("b", None, "Ukončen"), ("c", "2026-07-31T10:00", None), ("d", TODAY, None)],
                               "id string, deadline string, state string")
    assert {r.id for r in fl.mark_expired(df, TODAY).where("expired").collect()} == {"b", "c"}


def test_value_and_region(spark):
    df = spark.createDataFrame([("a", None, ["CZ0521"], "isvz"), ("b", 0.0, [], "isvz"), ("c", 2e6, ["CZ010"], "isvz"), ("d", 3e6, [], "profil:nachod")],
                               "id string, value double, nuts array<string>, source string")
    assert {r.id: r.no_value for r in fl.value_filter(df).collect()} == {"a": True, "c": False, "d": False}
    assert {r.id: r.no_nuts for r in fl.region_filter(df).collect()} == {"a": False, "b": True, "d": False}


@pytest.fixture(scope="module")
def gazetteer(spark):
    return spark.createDataFrame([
        ("Týnec nad Labem", 50.04, 15.36), ("Mostek", 50.47, 15.70), ("Lhota", 50.21, 15.80), ("Lhota", 49.0, 14.0),
        ("Labem", 49.5, 13.0), ("Praha", 50.08, 14.43), ("Dvůr Králové nad Labem", 50.43, 15.81),
    ], "name string, lat double, lon double")


def test_places_match_inflected_and_prefer_longer_then_nearer(spark, gazetteer):
    texts = spark.createDataFrame([(1, "Škola v Týnci nad Labem"), (2, "oprava mostu"), (3, "Lhota"), (4, "ve Dvoře Králové nad Labem"), (5, "")],
                                  "k int, text string")
    got = {r.k: (r.lat, r.nwords) for r in ge.gazetteer_match(texts, gazetteer, ["k"]).collect()}
    assert got == {1: (50.04, 3), 3: (50.21, 1), 4: (50.43, 4)}


def test_location_priority_and_radius(spark, gazetteer):
    rows = [
        ("place", "Lhota", "Praha", [], None, None, "isvz"), ("title", None, "škola Lhota", [], None, None, "isvz"),
        ("district", None, "škola", ["CZ0525"], "Praha", None, "isvz"), ("seat", None, "škola", [], "Mostek 5", "Město Praha", "isvz"),
        ("town", None, "škola", [], None, "Statutární město Praha", "isvz"), ("profile", None, "škola", [], None, None, "profil:nachod"),
        ("agency", None, "škola", [], None, None, "profil:john-nell-baby"), ("firm", None, "škola", [], None, "Praha stavby a.s.", "isvz"),
    ]
    df = spark.createDataFrame(rows, "id string, place string, title string, nuts array<string>, authority_seat string, authority string, source string")
    result = ge.radius_filter(df, ge.locate(df, gazetteer))
    kept = {r.id: (r.dist_km, r.loc_unknown) for r in result.kept.collect()}
    assert {r.id for r in result.dropped.collect()} == {"town"}
    assert kept["agency"] == (None, True) and kept["firm"] == (None, True)
    assert kept["place"][0] == kept["title"][0] == 2 and kept["district"][0] == 41 and kept["seat"][0] == 30 and kept["profile"][0] == 36


def test_short_words_are_not_inflected(spark):
    assert one(spark, gf.inflect_variants(F.lit("as"))) == ["as"]


# --- linking -----------------------------------------------------------------
def contracts(spark, *rows):
    base = dict(verze="1", platny=True, buyer="10", party="20", datum="2026-02-01", hodnota=100.0, parent=None, dump="2026-02")
    full = [{**base, **r} for r in rows]
    df = spark.createDataFrame([(r["id"], r["verze"], "u" + r["id"], r["platny"], r["buyer"], r["party"], r["datum"], r["hodnota"], r["parent"], r["dump"], i)
                                for i, r in enumerate(full)],
                               "id string, verze string, url string, platny boolean, ico_zadavatel string, party string, datum string, hodnota double, parent string, dump string, ord long")
    names = F.transform(F.split("party", ","), lambda p: F.struct(p.alias("ico"), F.concat(F.lit("Firma "), p).alias("nazev")))
    return df.withColumn("parties", names).withColumn("predmet", F.lit("Oprava střechy školy"))


def awards(spark, *rows):
    base = dict(authority_ico="10", winner_ico="20", awarded="2026-01-20", price_contracted=100.0)
    full = [{**base, **r} for r in rows]
    return spark.createDataFrame([(r["id"], r["authority_ico"], r["winner_ico"], r["awarded"], r["price_contracted"]) for r in full],
                                 "id string, authority_ico string, winner_ico string, awarded string, price_contracted double")


def best(spark, a, c):
    return {r.tender_id: (r.contract_id, r.confidence) for r in ln.contract_best_match(ln.contract_candidates(a, c)).collect()}


def test_best_match_confidence(spark):
    a = awards(spark, dict(id="t"))
    assert best(spark, a, contracts(spark, dict(id="x", hodnota=110.0), dict(id="y", hodnota=300.0))) == {"t": ("x", "high")}
    assert best(spark, a, contracts(spark, dict(id="x", hodnota=110.0), dict(id="y", hodnota=95.0))) == {"t": ("y", "low")}
    assert best(spark, a, contracts(spark, dict(id="x", hodnota=None), dict(id="y", hodnota=900.0))) == {"t": ("y", "low")}


def test_candidates_window_parties_and_validity(spark):
    a = awards(spark, dict(id="t", winner_ico="99; 20"))
    c = contracts(spark, dict(id="in", datum="2025-12-21"), dict(id="out", datum="2025-12-20"), dict(id="late", datum="2026-05-21"), dict(id="void", platny=False),
                  dict(id="amend", parent="in"), dict(id="other", party="77"), dict(id="two", party="20,99"), dict(id="bad", datum="někdy"))
    assert sorted(r.contract_id for r in ln.contract_candidates(a, c).collect()) == ["in", "two"]


def test_newest_version_decides_and_first_seen_breaks_ties(spark):
    a = awards(spark, dict(id="t"))
    c = contracts(spark, dict(id="x", verze="9", hodnota=100.0), dict(id="x", verze="10", hodnota=500.0), dict(id="y", hodnota=500.0))
    assert best(spark, a, c) == {"t": ("x", "low")}


def test_high_links_are_never_lowered(spark):
    old = spark.createDataFrame([("t", "x", "u", None, 100.0, "high"), ("s", "q", "u", None, 1.0, "low")], LINK)
    new = spark.createDataFrame([("t", "y", "u", None, 100.0, "high"), ("s", "r", "u", None, 2.0, "low"), ("n", "z", "u", None, 3.0, "low")], LINK)
    got = {r.tender_id: r.contract_id for r in ln.link_upsert(old, new).collect()}
    assert got == {"t": "x", "s": "r", "n": "z"}


def test_a_low_contract_serves_one_tender(spark):
    a = awards(spark, dict(id="near", price_contracted=130.0), dict(id="far", price_contracted=300.0))
    links = ln.link_month(a, contracts(spark, dict(id="x")), spark.createDataFrame([], LINK))
    assert [(r.tender_id, r.confidence) for r in links.collect()] == [("near", "low")]


def test_fold_over_dumps_keeps_the_first_exact_match(spark):
    a = awards(spark, dict(id="t"))
    c = contracts(spark, dict(id="x", dump="2026-01"), dict(id="y", dump="2026-02"))
    links = ln.link_dumps(a, c, spark.createDataFrame([], LINK))
    assert [(r.contract_id, r.confidence) for r in links.collect()] == [("x", "high")]
    again = ln.link_dumps(a, c, links)
    assert [(r.contract_id, r.confidence) for r in again.collect()] == [("x", "high")]


def test_amendments_attach_to_every_link_and_are_capped(spark):
    links = spark.createDataFrame([("t", "x", "u", None, 1.0, "high"), ("s", "x", "u", None, 1.0, "high")], LINK)
    rows = contracts(spark, *[dict(id=f"a{i}", parent="x", datum=f"2026-03-0{i}", hodnota=float(i)) for i in range(1, 5)], dict(id="a1", parent="x", datum="2026-03-09", hodnota=10.0))
    got = ln.amendment_attach(links, ln.amendment_rows(rows), Settings(max_amendments=3)).collect()
    assert {r.tender_id for r in got} == {"t", "s"}
    assert all([a["id"] for a in r.amendments] == ["a2", "a3", "a4"] and r.amendments_total == 9.0 for r in got)


def test_watched_contract(spark):
    tenders = spark.createDataFrame([("w", "10", "Oprava střechy", "2026-07-01T10:00"), ("e", "10", "a b", "2026-07-01"), ("old", "10", "Oprava", "2025-01-01")],
                                    "id string, authority_ico string, title string, deadline string")
    specs = ln.watch_specs(tenders, tenders, TODAY)
    got = ln.watched_contract_match(specs, contracts(spark, dict(id="x", datum="2026-07-15", party="10,20"), dict(id="y", datum="2026-07-02")))
    assert [(r.id, r.contract_id, r.supplier) for r in got.collect()] == [("w", "x", "Firma 20")]


# --- history -----------------------------------------------------------------
def test_change_rules(spark):
    schema = "id string, deadline string, value double, site_visit string, clarifications int, title string"
    old = spark.createDataFrame([("a", None, 0.0, None, 0, "T"), ("b", "2026-08-01T10:00:00", 1234567.0, None, 1, "T"), ("gone", None, None, None, 0, "T")], schema)
    new = spark.createDataFrame([("a", "", None, None, 0, "T"), ("b", None, None, None, 0, "U"), ("new", None, 5.0, None, 0, "T")], schema)
    got = sorted((r.id, r.field, r.old, r.new) for r in ch.snapshot_diff(old, new, TODAY).collect())
    assert got == [("b", "clarifications", "1", "0"), ("b", "deadline", "2026-08-01 10:00", "—"), ("b", "title", "T", "U"), ("b", "value", "1 234 567 Kč", "—")]


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_dead_link_counter_over_small_blocks(spark, bits):
    import random
    rng = random.Random(bits)
    rows, want = [], {}
    for i in range(60):
        n = 0
        for run in range(rng.randrange(1, 20)):
            code = rng.choice([404, 410, 200, 500, None, 404])
            rows.append((f"k{i}", run * 3, code))
            n = n + 1 if code in (404, 410) else n if code is None else 0
        want[f"k{i}"] = n
    got = ch.dead_link_counter(spark.createDataFrame(rows, "id string, run long, code int"), bits).collect()
    assert {r.id: r.url_dead for r in got} == want
    assert all(r.link_dead == (r.url_dead >= 2) for r in got)


def test_flapping_across_blocks(spark):
    rows = [("a", "2026-01-01", "value", "1", "2", 0), ("a", "2026-01-05", "value", "2", "1", 0), ("a", "2026-03-01", "value", "1", "3", 0)]
    log = spark.createDataFrame(rows, "id string, date string, field string, old string, new string, seq int").withColumn("date", F.to_date("date"))
    got = {str(r.date): r.reverts for r in ch.change_flapping(log, F.month("date")).collect()}
    assert got == {"2026-01-05": True, "2026-03-01": False}


def test_stub_check(spark):
    schema = "id string, source string, deadline string, state string, value double, url string, expired boolean, auto_expired string"
    rows = [("none", "isvz", None, None, None, "http://a", False, None), ("live", "isvz", None, None, None, "http://a", True, "2026-07-20"),
            ("dead", "isvz", None, None, None, "http://a", False, None), ("nolink", "isvz", None, None, None, None, False, None),
            ("old", "isvz", None, None, None, "http://a", True, "2026-07-01"), ("profile", "profil:a", None, None, None, None, False, None)]
    df = spark.createDataFrame(rows, schema).withColumn("auto_expired", F.to_date("auto_expired"))
    answers = spark.createDataFrame([("live", "live", "2026-09-01T10:00:00", None, 5.0), ("dead", "dead", None, "zrušeno", None), ("old", "live", "2026-09-01", None, None)],
                                    "id string, verdict string, deadline string, state string, value double")
    got = {r.id: r for r in ch.verify_stub_merge(df, answers, TODAY).collect()}
    assert not got["none"].expired and not got["profile"].expired
    assert not got["live"].expired and got["live"].value == 5.0 and got["live"].auto_expired is None
    assert got["dead"].expired and got["dead"].state == "zrušeno" and str(got["dead"].auto_expired) == TODAY
    assert got["nolink"].expired and got["old"].expired and got["old"].deadline is None


# --- relevance, ranking, verdicts, documents ---------------------------------
def test_guesses_spare_watched_and_construction(spark):
    fp = "fp struct<cpv:array<string>,ico:string,toks:array<string>,title:string>"
    disliked = spark.createDataFrame([("d1", (["3314"], "9", ["aaaa", "bbbb"], "x")), ("d2", (["3314"], "9", ["aaaa", "bbbb"], "x")), ("d3", ([], "9", [], "x"))], f"id string, {fp}")
    tenders = spark.createDataFrame([("code", ["33140000"], "1", "zzzz"), ("buyer", [], "9", "zzzz"), ("words", ["45000000"], "9", "aaaa bbbb"),
                                     ("star", ["33140000"], "9", "aaaa"), ("d1", [], "1", "q"), ("fine", ["45000000", "33140000"], "9", "cccc")],
                                    "id string, cpv array<string>, authority_ico string, title string")
    common = F.array().cast("array<string>")
    watched = spark.createDataFrame([("star",)], "id string")
    got = {r.id: r.reason for r in rl.irrelevance_reason(tenders, rl.fingerprint(tenders, common), rl.dislike_model(disliked), disliked, watched).collect()}
    assert set(got) == {"code", "buyer", "words", "d1"}
    assert got["code"] == "odhad: CPV 3314* odmítnuto 2×" and got["buyer"] == "odhad: zadavatel odmítnut 3×" and "(aaaa, bbbb)" in got["words"]


def test_same_named_firms_stay_apart(spark):
    df = spark.createDataFrame([("1", "Firma", "10", "2026-01-01", 5.0), ("2", "Firma", "11; 10", "2026-01-01", 100.0), ("3", "Bez", "", "2026-01-01", None)],
                               "id string, winner string, winner_ico string, awarded string, eff_price double")
    got = [(r.firm, r.n, r.volume, r.bar_pct, r.grand_total) for r in cp.top_firms(df).collect()]
    assert got == [("11", 1, 100.0, 100, 105.0), ("10", 1, 5.0, 5, 105.0), ("Bez", 1, 0.0, 2, 105.0)]


def test_last_writer_wins_and_local_wins_ties(spark):
    schema = "kind string, id string, ts long, on boolean"
    local = spark.createDataFrame([("watch", "a", 5, True), ("watch", "b", 1, True)], schema)
    remote = spark.createDataFrame([("watch", "a", 5, False), ("watch", "b", 2, False)], schema)
    got = {r.id: r.on for r in rl.lww_preference_merge(local, remote).collect()}
    assert got == {"a": True, "b": False}


def test_verdict_selection_keeps_tidied_watched(spark):
    t = spark.createDataFrame([("w", True, TODAY, None), ("x", True, None, None), ("y", False, None, None), ("z", False, None, "2026-09-01")],
                              "id string, expired boolean, auto string, deadline string").withColumn("auto_expired", F.to_date("auto"))
    verdicts = spark.createDataFrame([("y", "ano"), ("z", "ano")], "id string, verdikt string")
    ids = spark.createDataFrame([("w",), ("x",)], "id string")
    none = ids.where("false")
    assert {r.id for r in vd.verdict_selection(t, verdicts, ids, none).collect()} == {"w", "z"}


def test_document_links_and_claims(spark):
    pages = spark.createDataFrame([
        ("http://h.cz/a/x", '<A class="k" href="/zd?i=1&amp;j=2"><b>Zadávací dokumentace</b></a><a href="v">Vysvětlení zadávací dokumentace</a>'),
        ("http://h.cz/b", '<a href="/b/dokumenty">Dokumenty</a>'), ("http://h.cz/b/dokumenty", '<a href="zd.pdf">zadavaci dokumentace</a>'),
        ("http://h.cz/c", '<a href="v">Vysvětlení zadávací dokumentace</a>'),
    ], "url string, html string")
    got = {r.url: r.doc_url for r in dc.find_doc_link(pages, ("zadavaci dokumentace",)).collect()}
    assert got == {"http://h.cz/a/x": "http://h.cz/zd?i=1&j=2", "http://h.cz/b": "http://h.cz/b/zd.pdf", "http://h.cz/b/dokumenty": "http://h.cz/b/zd.pdf"}
    found = spark.createDataFrame([("a", 1, "u1"), ("b", 2, "u1"), ("c", 3, None), ("d", 4, "u2"), ("e", 5, "u3"), ("s", 0, "u9")], "id string, ord long, doc_url string")
    store = spark.createDataFrame([("s", "u9")], "id string, doc_url string")
    done = {r.id: r.doc_url for r in dc.doc_claim_unique(found, store, Settings(max_documents=2)).collect()}
    assert done == {"a": "u1", "b": None, "c": None, "d": "u2"}


def test_mining(spark):
    df = spark.createDataFrame([("Předpokládaná hodnota: 9 999 Kč\nMísto plnění: ZŠ  Hořice; x",), ("Celková cena 12.345.678,50 Kč; vybraným dodavatelem je: nikdo",)], "text string")
    a, b = dc.mine_award_report(dc.mine_tender_doc(df)).collect()
    assert a.hodnota is None and a.misto == "zs horice" and b.cena == 12345678.5 and b.vitez is None


def test_text_corner_cases(spark):
    assert one(spark, tx.fold_text(F.lit("ŽLUŤOUČKÝ ﬁ ½ №"))) == "zlutoucky fi 1⁄2 no"
    assert one(spark, tx.html_unescape(F.lit("&amp;lt; &#x10C; &#268; &nezname; &eacute;"))) == "&lt; Č Č &nezname; é"
    assert one(spark, tx.parse_cz_datetime(F.lit("někdy"))) is None
    assert one(spark, tx.parse_cz_number(F.lit("9999"))) is None
