"""Sources read from files, snapshots, streams over several batches, whole jobs."""

import json

import pytest
from pyspark.sql import functions as F

from tenderloom.operators import documents as dc
from tenderloom.plans.contracts import link_contracts
from tenderloom.plans.daily import conform, daily_build
from tenderloom.plans.dashboard import dashboard
from tenderloom.plans.documents import document_run
from tenderloom.schemas import AMENDMENT, CHANGE, LINK, PREFERENCE, TENDER, VERDICT
from tenderloom.sources import contracts as sc
from tenderloom.sources import feed as sf
from tenderloom.sources import gazetteer as gz
from tenderloom.sources import profiles as sp
from tenderloom.sources import registry as sr
from tenderloom.sources import snapshots as ss
from tenderloom.streaming import jobs
from tenderloom.streaming.tables import ArrivalTable, ChangeTable

TODAY = "2026-08-01"


def record(nipez, title, deadline="2026-09-01T10:00:00.000", **over):
    lot = {"zadavaci_postup_pro_cast": {
        "stav": None, "datum_zahajeni_zadavaciho_postupu": "2026-07-01T00:00:00", "odkaz_na_profil": over.get("link", "https://x.cz/" + nipez),
        "lhuty": [{"druh_lhuty": "Lhůta pro podání nabídky", "aktivni": True, "datum_a_cas_konce_lhuty": deadline}] if deadline else [],
        "vysledek": over.get("result")}, "predpokladana_hodnota_casti_bez_DPH_v_CZK": None}
    return {"verejna_zakazka": {
        "identifikator_NIPEZ": nipez, "nazev_verejne_zakazky": title, "predpokladana_hodnota_bez_DPH_v_CZK": over.get("value", 5e6),
        "predmet": {"hlavni_kod_CPV": over.get("cpv", "45214200"), "mista_plneni": [{"nuts": "CZ052", "misto_plneni_jine": over.get("place", "Lhota")}]},
        "casti_verejne_zakazky": [lot],
        "zadavaci_postupy": [{"zadavatel_zadavaciho_postupu": {"zadavatele": [{"zadava_zadavaci_postup": True, "subjekt": {"nazev_subjektu": "Obec Lhota", "ico": over.get("ico", "00000010")}}]}}]}}


@pytest.fixture
def registry(spark, tmp_path):
    for month, rows in (("2026-06", [record("A", "Stará škola", value=4e6), record("", "bez id")]),
                        ("2026-07", [record("A", "Škola"), record("B", "Střecha", place="Praha"), record("C", "Kanalizace", cpv="45232000"), record("D", "Fasáda", deadline=None, link=None)])):
        folder = tmp_path / f"month={month}"
        folder.mkdir()
        (folder / "vz.json").write_text(json.dumps({"verze": "1", "data": rows}), "utf-8")
    return str(tmp_path)


@pytest.fixture(scope="module")
def gazetteer(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("gaz") / "g.csv"
    path.write_text("Lhota;50.21;15.80\nPraha;50.08;14.43\nbad;x;1\nshort;1\n", "utf-8")
    return gz.read_gazetteer(spark, str(path))


def test_registry_files(spark, registry):
    t = sr.normalize_registry(sr.read_registry(spark, registry, ["2026-06", "2026-07"]))
    rows = sorted(t.collect(), key=lambda r: r.ord)
    assert [r.title for r in rows][0] == "Stará škola" and len(rows) == 5
    assert rows[1].deadline == "2026-09-01T10:00:00" and rows[1].published == "2026-07-01" and rows[1].authority == "Obec Lhota"
    only = sr.read_registry(spark, registry, ["2026-07"])
    assert sr.normalize_registry(only).count() == 4


def test_profile_and_contract_files(spark, tmp_path):
    folder = tmp_path / "key=trutnov"
    folder.mkdir()
    (folder / "p.xml").write_text("""<ns:profil xmlns="urn:x" xmlns:ns="urn:y"><Zakazka_vz/><zakazka><id_objektu>N006/26/V1</id_objektu><nazev_vz> Oprava </nazev_vz>
      <casti_vz><cast_zakazky><zadavaci_postup_casti><datum_uverejneni>2026-07-02T08:00</datum_uverejneni>
      <lhuty_zadavaciho_postupu><lhuta><druh_lhuty>lhůta podání nabídky</druh_lhuty><datum_konce_lhuty>2026-08-09T10:00:00+02:00</datum_konce_lhuty></lhuta></lhuty_zadavaciho_postupu>
      <ucastnici><ucastnik><nazev_subjektu>F</nazev_subjektu><nabidkova_cena_bez_dph>12.5</nabidkova_cena_bez_dph><ucastnik_vyloucen>1</ucastnik_vyloucen></ucastnik></ucastnici>
      <dokumenty><dokument><typ_dokumentu>Zadávací dokumentace</typ_dokumentu><url>http://d</url></dokument></dokumenty>
      </zadavaci_postup_casti></cast_zakazky></casti_vz></zakazka><zakazka><nazev_vz>bez id</nazev_vz></zakazka></ns:profil>""", "utf-8")
    profiles = sr.profiles_frame(spark)
    raw = sp.read_profile_xml(spark, str(tmp_path))
    t = sp.normalize_profiles(raw, profiles).collect()
    assert len(t) == 1 and t[0].id == "profil:trutnov:N006/26/V1" and t[0].deadline == "2026-08-09T10:00:00" and t[0].kind == "VZMR"
    assert t[0].url.endswith("/N006-26-V1") and t[0].bidders[0].vyloucen and t[0].bidders[0].cena == 12.5 and t[0].award is None
    docs = sp.profile_documents(raw, profiles)
    wanted = spark.createDataFrame([("i", "N006/26/V1", None, "https://zakazky.trutnov.cz/profile_display_2.html")], "id string, native_id string, registry_id string, base string")
    assert dc.profile_doc_lookup(wanted, docs, ("zadavaci dokumentace",)).first().doc_url == "http://d"
    dump = tmp_path / "dump.xml"
    dump.write_text("""<dump xmlns="http://portal/1.2/"><zaznam><identifikator><idSmlouvy>7</idSmlouvy><idVerze>2</idVerze></identifikator><odkaz>u</odkaz><platnyZaznam>0</platnyZaznam>
      <smlouva><subjekt><ico>10</ico></subjekt><smluvniStrana><nazev>N</nazev></smluvniStrana><smluvniStrana><ico>20</ico><nazev>M</nazev></smluvniStrana>
      <hodnotaBezDph>abc</hodnotaBezDph></smlouva></zaznam><zaznam><odkaz>bez</odkaz></zaznam></dump>""", "utf-8")
    rows = sc.normalize_contracts(sc.read_contract_xml(spark, str(dump))).collect()
    assert len(rows) == 1 and rows[0].id == "7" and not rows[0].platny and rows[0].hodnota is None and [p.ico for p in rows[0].parties] == [None, "20"]


def test_feed_file(spark, tmp_path):
    (tmp_path / "rss.xml").write_text("<rss><channel><item><link> http://a </link></item><item><title>x</title></item></channel></rss>", "utf-8")
    pages = spark.createDataFrame([("http://a", '<th>IČ</th><td>123 45</td><th>IČO</th> <td>123 45 678</td><a href="https://www.vhodne-uverejneni.cz/profil/x" title="Obec">')], "url string, html string")
    got = sf.feed_buyers(sf.read_feed(spark, str(tmp_path / "rss.xml")), pages, sr.profiles_frame(spark)).collect()
    assert [(r.ico, r.buyer) for r in got] == [("12345678", "Obec")]


def test_guard_and_versions(spark, tmp_path):
    root, schema = str(tmp_path / "t"), "id long"
    assert ss.load_snapshot_or_default(spark, root, schema).count() == 0
    big = spark.range(100)
    ss.guarded_publish(big, big.where("false"), root, "2026-07-31")
    with pytest.raises(ss.PublishRefused):
        ss.guarded_publish(spark.range(10), big, root, TODAY)
    assert ss.load_snapshot_or_default(spark, root, schema).count() == 100
    ss.guarded_publish(spark.range(20), big, root, TODAY)
    assert ss.load_snapshot_or_default(spark, root, schema).count() == 20
    assert ss.load_snapshot_or_default(spark, root, schema, before=TODAY).count() == 100
    ss.guarded_publish(spark.range(30), big, root, TODAY)       # the same day again
    assert ss.load_snapshot_or_default(spark, root, schema).count() == 30
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["run_date=2026-07-31", f"run_date={TODAY}"]
    half = tmp_path / "t" / "run_date=2027-01-01"               # a write that never ended
    half.mkdir()
    (half / "part-0.parquet").write_text("no parquet")
    assert ss.load_snapshot_or_default(spark, root, schema).count() == 30
    (half / "_SUCCESS").write_text("")                          # a broken version is no empty history
    with pytest.raises(Exception, match="(?i)parquet"):
        ss.load_snapshot_or_default(spark, root, schema).count()


def test_streams_over_several_batches(spark, tmp_path):
    source, out = str(tmp_path / "in"), ChangeTable(spark, str(tmp_path / "out"), "id string, url_dead long, link_dead boolean", ["id"])
    schema = "id string, run long, code int"
    for batch in ([("a", 1, 404), ("b", 1, 404)], [("a", 2, None), ("b", 2, 200)], [("a", 3, 410), ("b", 3, 404), ("c", 3, None)]):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(source)
        jobs.dead_link_counter_stream(spark.readStream.schema(schema).parquet(source), out, str(tmp_path / "cp")).awaitTermination()
    assert {r.id: (r.url_dead, r.link_dead) for r in out.latest().collect()} == {"a": (2, True), "b": (1, False), "c": (0, False)}


def test_a_dump_split_over_two_batches_is_judged_whole(spark, tmp_path):
    """Two contracts within the tolerance make a match 'low', though the batches see one each."""
    competition = spark.createDataFrame([("t", "1", "9", "2026-01-10", 100.0)],
                                        "id string, authority_ico string, winner_ico string, awarded string, price_contracted double")
    schema = ("id string, verze string, url string, platny boolean, ico_zadavatel string, parties array<struct<ico:string,nazev:string>>, "
              "predmet string, datum string, hodnota double, parent string, ord long, dump int")
    row = lambda i, price, n, dump: (i, "1", "u", True, "1", [("9", "F")], "p", "2026-01-15", price, None, n, dump)
    source = str(tmp_path / "in")
    links = ChangeTable(spark, str(tmp_path / "links"), LINK, ["tender_id"])
    waiting = ArrivalTable(spark, str(tmp_path / "waiting"), schema, "dump")
    for batch in ([row("a", 100.0, 1, 1)], [row("b", 101.0, 2, 1)], [row("c", 500.0, 1, 2)]):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(source)
        jobs.contract_link_stream(spark.readStream.schema(schema).parquet(source), competition, links, waiting, str(tmp_path / "cp")).awaitTermination()
    one, = links.latest().collect()
    assert (one["contract_id"], one["confidence"]) == ("a", "low")
    assert [r["id"] for r in waiting.read(waiting.groups()[-1:]).collect()] == ["c"]
    assert jobs.finish_links(competition, links, waiting).count() == 1


def run_daily(spark, sources, previous, gazetteer, log=None, archive=None, today=TODAY, **lookups):
    empty = spark.createDataFrame([], CHANGE)
    return daily_build(sources, previous, empty if log is None else log, archive, gazetteer, sr.profiles_frame(spark), today, **lookups)


def test_daily_job_runs_twice_with_the_same_result(spark, registry, gazetteer):
    t = sr.normalize_registry(sr.read_registry(spark, registry, ["2026-06", "2026-07"]))
    first = run_daily(spark, [t], spark.createDataFrame([], TENDER), gazetteer)
    rows = {r.id: r for r in first.tenders.collect()}
    # the excluded code and the place beyond the radius are gone, the later month won
    assert set(rows) == {"rvz:A", "rvz:D"} and rows["rvz:A"].title == "Škola" and rows["rvz:A"].dist_km == 2
    assert first.changes.count() == 0 and first.metrics.first().total == 2
    again = run_daily(spark, [t], conform(first.tenders), gazetteer)
    assert {r.id for r in again.tenders.collect()} == set(rows) and again.changes.count() == 0
    # nothing fetched: history is carried, the stub without deadline and state closes
    nothing = run_daily(spark, [t.where("false")], conform(first.tenders), gazetteer)
    assert {r.id: r.expired for r in nothing.tenders.collect()} == {"rvz:A": False, "rvz:D": True}
    moved = t.withColumn("deadline", F.when(F.col("id") == "rvz:A", "2026-09-09T10:00:00").otherwise(F.col("deadline")))
    changed = run_daily(spark, [moved], conform(first.tenders), gazetteer)
    assert [(r.id, r.field, r.new) for r in changed.changes.collect()] == [("rvz:A", "deadline", "2026-09-09 10:00")]


def test_link_document_and_dashboard_jobs(spark):
    competition = spark.createDataFrame([("t", "T", "10", "B", "20", "W", "2026-01-20", 100.0, None, ["45210000"], 5, False)],
        "id string, title string, authority_ico string, authority string, winner_ico string, winner string, awarded string, price_contracted double, price_paid double, cpv array<string>, dist_km int, loc_unknown boolean")
    party = "parties array<struct<ico:string,nazev:string>>"
    dumps = spark.createDataFrame([("x", "1", "u", True, "10", [("20", "F")], "p", "2026-02-01", 101.0, None, "2026-02", 1), ("a", "1", "u", True, "10", [("20", "F")], "p", "2026-03-01", 7.0, "x", "2026-03", 2)],
        f"id string, verze string, url string, platny boolean, ico_zadavatel string, {party}, predmet string, datum string, hodnota double, parent string, dump string, ord long")
    tenders = conform(spark.createDataFrame([("w", "isvz", 1, "Oprava školy", "10", "B", "2026-09-01T10:00", False, "VZ", 5, False, [])],
        "id string, source string, ord long, title string, authority_ico string, authority string, deadline string, expired boolean, kind string, dist_km int, loc_unknown boolean, cpv array<string>"))
    ids = tenders.select("id")
    result = link_contracts(competition, dumps, spark.createDataFrame([], LINK), spark.createDataFrame([], AMENDMENT), tenders, ids, None, TODAY)
    link = result.links.collect()
    assert [(r.contract_id, r.confidence, r.amendments_total) for r in link] == [("x", "high", 7.0)] and result.counts.first().high == 1
    board = dashboard(tenders, competition, result.links, spark.createDataFrame([], CHANGE), spark.createDataFrame([("w", "ano", "")], VERDICT),
                      spark.createDataFrame([("watch", "w", 1, True, None)], PREFERENCE), TODAY, competition_options=dict(low_m=0))
    assert [r.id for r in board.tenders.collect()] == ["w"] and board.cards.first().watched == 1 and board.selection.count() == 1
    assert board.competition.first().eff_price == 107.0 and board.firms.first().grand_total == 107.0

    docs = spark.createDataFrame([("w", 1, "http://p", "b", "1", "2")], "id string, ord long, url string, base string, native_id string, registry_id string")
    pages = spark.createDataFrame([("http://p", '<a href="/zd">Zadávací dokumentace</a>')], "url string, html string")
    exports = spark.createDataFrame([], "base string, ids array<string>, docs array<struct<typ:string,url:string>>, ord long")
    texts = spark.createDataFrame([("http://p/zd", "Místo plnění: Lhota")], "doc_url string, text string")
    store = spark.createDataFrame([], "id string, doc_url string, nenalezeno boolean, hodnota double, misto string, termin string")
    mined = document_run(docs, store, pages, exports, texts, ("zadavaci dokumentace",), ("zadavaci dokumentace",), dc.mine_tender_doc).collect()
    assert [(r.doc_url, r.misto) for r in mined] == [("http://p/zd", "lhota")]
