"""Whole runs: from files to published versions, day after day."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from tenderloom.materialize import materialize
from tenderloom.operators import documents as dc
from tenderloom.plans import runs
from tenderloom.plans.documents import document_run
from tenderloom.sources import detail_pages as dp
from tenderloom.sources import feed as sf
from tenderloom.sources import gazetteer as gz
from tenderloom.sources import profiles as sp
from tenderloom.sources import registry as sr
from tenderloom.sources import snapshots as ss
from tests.test_jobs import record

AWARD = {"smlouva": [{"hodnota_smluvni_ceny_mena": "CZK", "hodnota_smluvni_ceny_bez_DPH": 5e6, "datum_uzavreni_smlouvy": "2026-07-10T00:00:00",
                      "skutecne_uhrazene_ceny": [], "dodavatele_se_kterymi_byla_uzavrena_smlouva": [{"subjekt": {"nazev_subjektu": "Firma", "ico": "00000020"}}]}],
         "vybrani_dodavatele_zadavaciho_postupu": []}


def export(folder, month, rows):
    target = folder / f"month={month}"
    target.mkdir(parents=True, exist_ok=True)
    (target / "vz.json").write_text(json.dumps({"verze": "1", "data": rows}), "utf-8")


def dump(folder, month, *contracts):
    target = folder / f"month={month}"
    target.mkdir(parents=True)
    body = "".join(
        f"<zaznam><identifikator><idSmlouvy>{i}</idSmlouvy><idVerze>1</idVerze></identifikator><odkaz>u{i}</odkaz><platnyZaznam>1</platnyZaznam>"
        f"<smlouva><subjekt><ico>00000010</ico></subjekt><smluvniStrana><ico>00000020</ico><nazev>Firma</nazev></smluvniStrana><predmet>Škola nová</predmet>"
        f"<datumUzavreni>{day}</datumUzavreni><hodnotaBezDph>{price}</hodnotaBezDph>{f'<navazanyZaznam>{parent}</navazanyZaznam>' if parent else ''}</smlouva></zaznam>"
        for i, day, price, parent in contracts)
    (target / "dump.xml").write_text(f"<dump>{body}</dump>", "utf-8")


def names(folder):
    return sorted(p.name for p in folder.iterdir())


def test_days_in_a_row(spark, tmp_path):
    """Files to versions: a first day, the same day again, an outage, and a result that shrank."""
    months, root = tmp_path / "registry", tmp_path / "store"
    export(months, "2026-06", [record("A", "Stará škola")])
    export(months, "2026-07", [record("A", "Škola"), record("B", "Střecha", result=AWARD), *[record(f"X{i}", f"Oprava domu {i}") for i in range(5)]])
    path = tmp_path / "g.csv"
    path.write_text("Lhota;50.21;15.80\n", "utf-8")
    gazetteer, profiles = gz.read_gazetteer(spark, str(path)), sr.profiles_frame(spark)

    def day(today, registry=None):
        found, warnings = runs.registry_source(spark, str(months), today) if registry is None else (registry, [])
        runs.daily_run(spark, str(root), {"registry": found, "profiles": found.where("false")}, gazetteer, profiles, today, warnings)
        return found

    found = day("2026-08-01")
    first = {r.id: r.title for r in ss.newest_version(spark, f"{root}/tenders").collect()}
    assert first["rvz:A"] == "Škola" and len(first) == 7
    assert [r.id for r in ss.newest_version(spark, f"{root}/competition").collect()] == ["rvz:B"]
    kept = ss.newest_version(spark, f"{root}/runs").first()
    assert (kept.total, kept.previous, json.loads(kept.source_rows)) == (7, 0, {"registry": 8, "profiles": 0})
    assert kept.warnings == ["registry 2026-05: export is missing", "profiles: no records, earlier ones are kept"]

    day("2026-08-01")                   # again: the same versions from the same history
    assert {r.id: r.title for r in ss.newest_version(spark, f"{root}/tenders").collect()} == first
    assert ss.newest_version(spark, f"{root}/runs").first().previous == 0
    assert all(names(root / t) == ["run_date=2026-08-01"] for t in ("tenders", "changes", "competition", "runs"))

    moved = found.withColumn("deadline", F.when(F.col("id") == "rvz:A", "2026-09-09T10:00:00").otherwise(F.col("deadline")))
    day("2026-08-02", moved.where("id = 'rvz:A'"))          # the rest is carried, the award stays
    assert ss.newest_version(spark, f"{root}/tenders").count() == 7
    assert [(r.id, r.field) for r in ss.newest_version(spark, f"{root}/changes").collect()] == [("rvz:A", "deadline")]
    assert ss.newest_version(spark, f"{root}/competition").count() == 1

    # a guard against half the result: history that no source of this run can explain
    big = ss.newest_version(spark, f"{root}/tenders")
    many = big.where("id = 'rvz:A'").crossJoin(spark.range(100).select(F.col("id").alias("n"))).withColumn("id", F.concat("id", "n")) \
        .withColumn("cpv", F.array(F.lit("99000000"))).withColumn("title", F.lit("něco jiného")).drop("n")
    many.write.parquet(f"{root}/tenders/run_date=2026-08-03")
    with pytest.raises(ss.PublishRefused, match="tenders"):
        day("2026-08-04", moved.where("id = 'rvz:A'"))
    assert names(root / "runs")[-1] == "run_date=2026-08-02" and names(root / "tenders")[-1] == "run_date=2026-08-03"


def test_linking_runs(spark, tmp_path):
    root, dumps = tmp_path / "store", tmp_path / "dumps"
    watch = spark.createDataFrame([("w",)], "id string")
    assert runs.link_run(spark, str(root), str(dumps), watch, "2026-08-01") is False and not root.exists()
    spark.createDataFrame([("t", "00000010", "00000020", "2026-02-01", 100.0)], "id string, authority_ico string, winner_ico string, awarded string, price_contracted double") \
        .write.parquet(f"{root}/competition/run_date=2026-08-01")
    spark.createDataFrame([("w", "00000010", "Škola nová", "2026-06-20T10:00")], "id string, authority_ico string, title string, deadline string") \
        .write.parquet(f"{root}/tenders/run_date=2026-08-01")
    broken = dumps / "month=2026-08"
    broken.mkdir(parents=True)
    (broken / "dump.xml.gz").write_bytes(gzip.compress(b"<dump>" + bytes(range(256)) * 50)[:40])
    with pytest.raises(runs.NothingRead, match="2026-08"):
        runs.link_run(spark, str(root), str(dumps), watch, "2026-08-01")
    assert names(root) == ["competition", "tenders"]

    dump(dumps, "2026-02", ("c", "2026-02-10", "101", None))            # of the 13 months, five back
    dump(dumps, "2026-07", ("d", "2026-07-05", "7", "c"), ("e", "2026-07-06", "9", None))
    assert runs.link_run(spark, str(root), str(dumps), watch, "2026-08-01")
    link, = ss.newest_version(spark, f"{root}/links").collect()
    assert (link.tender_id, link.contract_id, link.confidence, link.amendments_total) == ("t", "c", "high", 7.0)
    assert [(r.id, r.contract_id, r.supplier) for r in ss.newest_version(spark, f"{root}/watched").collect()] == [("w", "e", "Firma")]
    told = ss.newest_version(spark, f"{root}/link_runs").first()
    assert told.months == ["2026-02", "2026-07"] and told.backfill and len(told.warnings) == 1 and told.warnings[0].startswith("contracts 2026-08")

    # linked before: two months only, links of older dumps stay, and amendments are not written twice
    assert runs.link_run(spark, str(root), str(dumps), watch, "2026-08-02")
    again, = ss.newest_version(spark, f"{root}/links").collect()
    assert (again.contract_id, again.amendments_total) == ("c", 7.0)
    told = ss.newest_version(spark, f"{root}/link_runs").first()
    assert told.months == ["2026-07"] and not told.backfill
    assert ss.newest_version(spark, f"{root}/amendments").count() == 1


def test_buyers_of_the_feed_become_tenders(spark, tmp_path):
    """Item, detail page, profile export, tender; its place is found by the buyer's seat."""
    (tmp_path / "rss.xml").write_text("<rss><channel><item><link>http://a</link></item></channel></rss>", "utf-8")
    pages = spark.createDataFrame([("http://a", '<th>IČO</th><td>123 45 678</td><th>Adresa sídla</th><td>Dolní 1, Lhota</td><a href="https://www.vhodne-uverejneni.cz/profil/x" title="Obec">')], "url string, html string")
    buyers = sf.feed_buyers(sf.read_feed(spark, str(tmp_path / "rss.xml")), pages, sr.profiles_frame(spark))
    folder = tmp_path / "exports" / "key=pvu%3A12345678"
    folder.mkdir(parents=True)
    (folder / "p.xml").write_text("<profil><zakazka><id_objektu>Z1</id_objektu><nazev_vz>Oprava</nazev_vz><casti_vz><cast_zakazky><zadavaci_postup_casti>"
                                  "<datum_uverejneni>2026-07-02T08:00</datum_uverejneni></zadavaci_postup_casti></cast_zakazky></casti_vz></zakazka></profil>", "utf-8")
    tenders = sf.feed_tenders(sp.read_profile_xml(spark, str(tmp_path / "exports")), buyers)
    one, = tenders.collect()
    assert (one.id, one.source, one.authority, one.authority_ico) == ("profil:pvu:12345678:Z1", "profil:pvu:12345678", "Obec", "12345678")
    assert one.authority_seat == "Dolní 1, Lhota"
    from tenderloom.operators.geo import locate
    from tenderloom.plans.daily import conform
    gazetteer = spark.createDataFrame([("Lhota", 50.21, 15.80)], "name string, lat double, lon double")
    assert [r.id for r in locate(conform(tenders), gazetteer).collect()] == ["profil:pvu:12345678:Z1"]


def test_details_that_a_listing_names(spark):
    listing = '<a href="/contract_display_2.html">x</a> <a href="contract_display_1.html">y</a> <a href="contract_display_2.html">x</a> <a href="contract_display_x.html">'
    listings = spark.createDataFrame([("k", "https://b.cz/", listing, "Obec", "00000010"), ("e", "https://e.cz", None, "E", "1")],
                                     "key string, profile_url string, html string, buyer string, ico string")
    found = dp.listed_details(listings).orderBy("pos").collect()
    assert [(r.key, r.path, r.url) for r in found] == [("k", f"contract_display_{i}.html", f"https://b.cz/contract_display_{i}.html") for i in (2, 1)]
    pages = spark.createDataFrame([("https://b.cz/contract_display_1.html", '<a href="contract_display_1.html">Oprava mostu</a> Datum zahájení: <b>30.06.2026</b>')], "url string, html string")
    one, = dp.details_of_listings(listings, pages).collect()
    assert (one.id, one.title, one.authority, one.published) == ("profil:k:contract_display_1.html", "Oprava mostu", "Obec", "2026-06-30")


def test_documents_without_text_are_stored_as_errors(spark):
    tenders = spark.createDataFrame([(i, n, f"http://p{i}", "b", "1", "2") for n, i in enumerate("abcd")],
                                    "id string, ord long, url string, base string, native_id string, registry_id string")
    pages = spark.createDataFrame([(f"http://p{i}", '<a href="/zd">Zadávací dokumentace</a>') for i in "abc"], "url string, html string")
    exports = spark.createDataFrame([], "base string, ids array<string>, docs array<struct<typ:string,url:string>>, ord long")
    texts = spark.createDataFrame([("http://pa/zd", "Místo plnění: Lhota", None), ("http://pb/zd", None, "e" * 200)], "doc_url string, text string, error string")
    store = spark.createDataFrame([], "id string, doc_url string, nenalezeno boolean, chyba string, hodnota double, misto string, termin string")
    words = ("zadavaci dokumentace",)
    done = materialize(document_run(tenders, store, pages, exports, texts, words, words, dc.mine_tender_doc))
    assert {r.id: (r.doc_url, r.nenalezeno, r.chyba, r.misto) for r in done.collect()} == {
        "a": ("http://pa/zd", False, None, "lhota"), "b": ("http://pb/zd", False, "e" * 120, None),
        "c": ("http://pc/zd", False, "dokument bez textu", None), "d": (None, True, None, None)}
    again = document_run(tenders, done, pages, exports, texts.limit(0), words, words, dc.mine_tender_doc)
    assert {r.id: r.chyba for r in again.collect()} == {"a": None, "b": "e" * 120, "c": "dokument bez textu", "d": None}
    plain = document_run(tenders.limit(1), store, pages, exports, texts.drop("error"), words, words, dc.mine_tender_doc)
    assert [r.misto for r in plain.collect()] == ["lhota"]
