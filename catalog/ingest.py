"""Reading nested JSON and XML, pages and documents; snapshots.

Every line item becomes one nested record (its lots are built from its own columns), is
written out as JSON or XML text and read back through the source's schema.
"""

from __future__ import annotations

import re
from dataclasses import replace

from pyspark.sql import functions as F

from catalog.filters import EXPIRED_SQL, LIST_SQL
from catalog.views import TODAY, query, table, view
from tenderloom import Settings
from tenderloom import fixed_values as fv
from tenderloom.functions import records as rec
from tenderloom.functions import text as tx
from tenderloom.materialize import new_path
from tenderloom.operators import dashboard as db
from tenderloom.operators import documents as dc
from tenderloom.operators import filters as fl
from tenderloom.schemas import PROFILE_RECORD, REGISTRY_RECORD, part_of
from tenderloom.sources import contracts as sc
from tenderloom.sources import detail_pages as sd
from tenderloom.sources import feed as sf_
from tenderloom.sources import profiles as sp
from tenderloom.sources import registry as sr
from tenderloom.sources import snapshots as ss

RECORDS_PER_FILE = 100_000      # exports come as files of bounded size
FAST_PACKING = ("zlib.compress.level", "BEST_SPEED")    # their text repeats itself: gzip's least effort packs it well
K1, K2, K3 = fv.DEADLINE_KINDS
# columns of _lines
_DAY, _LATER = "l_day", "l_later"
_SUPPLIER = "named_struct('nazev_subjektu', 'Supplier ' || l_suppkey, 'ico', CAST(l_suppkey AS STRING), 'sidlo', CAST(NULL AS STRING))"
_TERMS = f"""CASE WHEN l_quantity > 40 THEN NULL ELSE array(
  named_struct('druh_lhuty', CASE l_returnflag WHEN 'A' THEN '{K1}' WHEN 'N' THEN '{K2}' ELSE '{K3}' END,
    'aktivni', l_linestatus = 'O', 'datum_a_cas_konce_lhuty', {_DAY} || 'T10:00:00.000'),
  named_struct('druh_lhuty', CASE l_returnflag WHEN 'A' THEN '{K1}' WHEN 'N' THEN '{K2}' ELSE '{K3}' END,
    'aktivni', false, 'datum_a_cas_konce_lhuty', {_LATER} || 'T09:00:00.000')) END"""
_ZP_A = f"""named_struct('stav', CASE WHEN l_linestatus = 'O' THEN '' ELSE 'Zadán' END,
  'odkaz_na_profil', CASE WHEN l_linenumber = 1 THEN 'https://example.org/d/' || l_orderkey END,
  'datum_zahajeni_zadavaciho_postupu', {_DAY} || 'T00:00:00',
  'pocet_zaslanych_zaevidovanych_vysvetleni_zadavaci_dokumentace', CAST(l_quantity AS INT), 'lhuty', {_TERMS},
  'vysledek', named_struct('smlouva', array(named_struct(
      'hodnota_smluvni_ceny_mena', CASE l_returnflag WHEN 'R' THEN 'EUR' WHEN 'A' THEN 'CZK' END,
      'hodnota_smluvni_ceny_bez_DPH', l_extendedprice,
      'skutecne_uhrazene_ceny', array(named_struct('mena', 'CZK', 'hodnota_skutecne_uhrazene_ceny_bez_DPH', l_extendedprice * 2),
         named_struct('mena', 'EUR', 'hodnota_skutecne_uhrazene_ceny_bez_DPH', 1D)),
      'datum_uzavreni_smlouvy', {_DAY} || 'T00:00:00',
      'dodavatele_se_kterymi_byla_uzavrena_smlouva', CASE WHEN l_linenumber = 1 THEN NULL ELSE array(named_struct('subjekt', {_SUPPLIER})) END)),
    'vybrani_dodavatele_zadavaciho_postupu', array(named_struct('subjekt',
       named_struct('nazev_subjektu', 'Vybraný', 'ico', '1', 'sidlo', CAST(NULL AS STRING))))))"""
_ZP_B = f"""CASE WHEN l_linenumber = 6 THEN NULL ELSE named_struct('stav', 'Ukončen', 'odkaz_na_profil', CAST(NULL AS STRING),
  'datum_zahajeni_zadavaciho_postupu', CAST(CAST(l_shipdate AS DATE) - l_linenumber AS STRING),
  'pocet_zaslanych_zaevidovanych_vysvetleni_zadavaci_dokumentace', l_linenumber, 'lhuty', NULL,
  'vysledek', CASE WHEN l_returnflag = 'N' THEN NULL ELSE named_struct('smlouva', array(named_struct(
      'hodnota_smluvni_ceny_mena', 'CZK', 'hodnota_smluvni_ceny_bez_DPH', CASE WHEN l_linenumber = 3 THEN NULL ELSE 100D END,
      'skutecne_uhrazene_ceny', NULL, 'datum_uzavreni_smlouvy', CAST(CAST(l_shipdate AS DATE) + 1 AS STRING),
      'dodavatele_se_kterymi_byla_uzavrena_smlouva', CASE WHEN l_linenumber <= 2 THEN NULL ELSE array(named_struct('subjekt', {_SUPPLIER}),
          named_struct('subjekt', named_struct('nazev_subjektu', 'B' || l_linenumber, 'ico', CAST(NULL AS STRING), 'sidlo', CAST(NULL AS STRING)))) END)),
    'vybrani_dodavatele_zadavaciho_postupu', NULL) END) END"""
_RECORD = f"""named_struct('verejna_zakazka', named_struct(
  'identifikator_NIPEZ', CASE WHEN l_linenumber = 7 THEN NULL ELSE l_orderkey || '-' || l_linenumber END,
  'nazev_verejne_zakazky', ' Order ' || l_orderkey, 'rezim_verejne_zakazky', CASE WHEN l_linestatus = 'F' THEN '{fv.SMALL_SCALE_REGIME}' ELSE 'Nadlimitní' END,
  'predpokladana_hodnota_bez_DPH_v_CZK', CASE WHEN l_returnflag = 'A' THEN l_extendedprice END,
  'predpokladana_hodnota_bez_DPH', CASE WHEN l_returnflag = 'N' THEN l_extendedprice * 2 END,
  'predpokladana_hodnota_bez_DPH_mena', CASE l_linenumber WHEN 1 THEN 'EUR' WHEN 2 THEN NULL ELSE 'CZK' END,
  'identifikatory_v_elektronickem_nastroji', array(named_struct('identifikator', 'x', 'kod_nastroje', 'X'),
     named_struct('identifikator', CASE WHEN l_linenumber <= 3 THEN 'N006/26/V' || l_orderkey END, 'kod_nastroje', 'NEN')),
  'predmet', named_struct('hlavni_kod_CPV', '45' || l_partkey, 'vedlejsi_kod_CPV', array(l_returnflag, l_linestatus, l_returnflag),
     'mista_plneni', array(named_struct('nuts', 'CZ05' || l_linenumber, 'misto_plneni_jine', 'místo ' || l_suppkey,
        'dalsi_informace_o_miste_plneni', CASE WHEN l_quantity > 25 THEN 'u školy' END))),
  'casti_verejne_zakazky', CASE WHEN l_linenumber = 4 THEN NULL ELSE array(
     named_struct('predmet', named_struct('hlavni_kod_CPV', '33' || l_linenumber, 'vedlejsi_kod_CPV', NULL, 'mista_plneni', NULL),
        'predpokladana_hodnota_casti_bez_DPH_v_CZK', l_extendedprice, 'zadavaci_postup_pro_cast', l_lot_a),
     named_struct('predmet', NULL, 'predpokladana_hodnota_casti_bez_DPH_v_CZK', CASE WHEN l_linenumber = 5 THEN NULL ELSE l_quantity END,
        'zadavaci_postup_pro_cast', l_lot_b)) END,
  'zadavaci_postupy', array(
     named_struct('zadavatel_zadavaciho_postupu', named_struct('zadavatele', NULL), 'zadavaci_postupy_pro_casti', NULL),
     named_struct('zadavatel_zadavaciho_postupu', named_struct('zadavatele', array(
        named_struct('zadava_zadavaci_postup', false, 'adresa_profilu', 'https://example.org/first', 'subjekt',
           named_struct('nazev_subjektu', 'First', 'ico', '1', 'sidlo', CAST(NULL AS STRING))),
        named_struct('zadava_zadavaci_postup', l_linenumber % 2 = 0, 'adresa_profilu', CAST(NULL AS STRING), 'subjekt',
           named_struct('nazev_subjektu', ' Second ', 'ico', CAST(l_suppkey AS STRING), 'sidlo', 'Sídlo 5')))),
       'zadavaci_postupy_pro_casti', CASE WHEN l_linenumber = 4 THEN array(l_lot_a, l_lot_b) END))),
 'historie_lhut', array(named_struct('zaznamy', array(named_struct('druh_lhuty', '{K2}', 'datum_a_cas_konce_lhuty', {_LATER} || 'T08:00:00')))))"""


def _lines(spark, sf):
    """The columns of lineitem that records are made of, with the ship date and the day ``l_linenumber``
    days later as text."""
    return table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus",
        "l_shipdate", "CAST(CAST(l_shipdate AS DATE) AS STRING) AS l_day",
        "CAST(CAST(l_shipdate AS DATE) + l_linenumber AS STRING) AS l_later")


def _dealt(lines):
    """Lines dealt out over as many tasks as a shuffle has, whatever the row groups of the table: each
    becomes a text of some hundred times its size, so their own bytes do not tell the work."""
    return lines.repartition(int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")), *lines.columns)


def _of_line(sql):
    """Record text over the columns of lines, as text over a line ``l`` of an array."""
    return re.sub(r"\bl_(?=[a-z])", "l.l_", sql)


def _records(spark, sf, schema):
    """(l_orderkey, l_linenumber, nested registry record), read back from JSON text by the given part of
    the source's schema."""
    lines = _lines(spark, sf)
    lots = _dealt(lines).selectExpr("*", f"{_ZP_A} AS l_lot_a", f"{_ZP_B} AS l_lot_b")
    texts = lots.selectExpr("l_orderkey", "l_linenumber", f"to_json({_RECORD}) AS js")
    return texts.select("l_orderkey", "l_linenumber", F.from_json("js", schema).alias("r"))


_LOT_PLACES = ("verejna_zakazka.casti_verejne_zakazky.zadavaci_postup_pro_cast",
               "verejna_zakazka.zadavaci_postupy.zadavaci_postupy_pro_casti")


def _derived(spark, sf, fields=(), lot_fields=(), history=False, **columns):
    """Derivations of the records, parsed by the fields that they read: of the tender (``vz``), of its
    lots (``zps``), and the history."""
    paths = [f"verejna_zakazka.{f}" for f in fields] + [f"{p}.{f}" for p in _LOT_PLACES for f in lot_fields]
    schema = part_of(REGISTRY_RECORD, *paths, *(["historie_lhut"] if history else []))
    vz = F.col("r.verejna_zakazka")
    parts = [vz.alias("vz")] + ([F.col("r.historie_lhut").alias("history")] if history else []) \
        + ([rec.derive_lots(vz).alias("zps")] if lot_fields else [])
    base = _records(spark, sf, schema).select("l_orderkey", "l_linenumber", *parts)
    return base.select("l_orderkey", "l_linenumber", *[c.alias(n) for n, c in columns.items()])


# what the nested records say, straight from the flat columns
_D = "CAST(l_shipdate AS DATE)"
FLAT = {
    "authority": "CASE WHEN l_linenumber % 2 = 0 THEN 'Second' ELSE 'First' END",
    "authority_ico": "CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_suppkey AS STRING) ELSE '1' END",
    "authority_seat": "CASE WHEN l_linenumber % 2 = 0 THEN 'Sídlo 5' END",
    "authority_profile": "CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE 'https://example.org/first' END",
    "cpv": "'45' || l_partkey || '|' || l_returnflag || '|' || l_linestatus || CASE WHEN l_linenumber = 4 THEN '' ELSE '|33' || l_linenumber END",
    "nuts": "'CZ05' || l_linenumber",
    "place": "'místo ' || l_suppkey || CASE WHEN l_quantity > 25 THEN '; u školy' ELSE '' END",
    "value": """CASE WHEN l_returnflag = 'A' THEN l_extendedprice WHEN l_returnflag = 'N' AND l_linenumber <> 1 THEN l_extendedprice * 2
        WHEN l_linenumber IN (4, 5) THEN NULL ELSE l_extendedprice + l_quantity END""",
    "lots": "CAST(CASE WHEN l_linenumber = 6 THEN 1 ELSE 2 END AS INT)",
    "deadline": f"""CASE WHEN l_quantity > 40 THEN strftime({_D} + l_linenumber, '%Y-%m-%d') || 'T08:00:00'
        WHEN l_linestatus = 'O' THEN strftime({_D}, '%Y-%m-%d') || 'T10:00:00'
        ELSE strftime({_D} + l_linenumber, '%Y-%m-%d') || 'T09:00:00' END""",
    "published": f"strftime(CASE WHEN l_linenumber = 6 THEN {_D} ELSE {_D} - l_linenumber END, '%Y-%m-%d')",
    "state": "CASE WHEN l_linestatus <> 'O' THEN 'Zadán' WHEN l_linenumber = 6 THEN NULL ELSE 'Ukončen' END",
    "clarifications": "CAST(l_quantity AS INT) + CASE WHEN l_linenumber = 6 THEN 0 ELSE l_linenumber END",
    "award_date": f"strftime(CASE WHEN l_linenumber = 6 OR l_returnflag = 'N' THEN {_D} ELSE {_D} + 1 END, '%Y-%m-%d')",
    "winner": """CASE WHEN l_linenumber = 1 THEN 'Vybraný'
        WHEN l_linenumber <= 2 OR l_linenumber = 6 OR l_returnflag = 'N' THEN 'Supplier ' || l_suppkey
        ELSE 'Supplier ' || l_suppkey || '; B' || l_linenumber END""",
    "winner_ico": "CASE WHEN l_linenumber = 1 THEN '1' ELSE CAST(l_suppkey AS STRING) END",
    "price_contracted": """CASE WHEN l_returnflag = 'N' THEN l_extendedprice
        ELSE CASE WHEN l_returnflag = 'A' THEN l_extendedprice WHEN l_linenumber IN (3, 6) THEN NULL ELSE 0 END
           + CASE WHEN l_linenumber IN (3, 6) THEN 0 ELSE 100 END END""",
    "price_paid": "l_extendedprice * 2",
    "kind": "CASE WHEN l_linestatus = 'F' THEN 'VZMR' ELSE 'VZ' END",
    "url": f"""CASE WHEN l_linenumber = 1 THEN 'https://example.org/d/' || l_orderkey
        WHEN l_linenumber <= 3 THEN '{fv.PLATFORM_DETAIL_URL}N006-26-V' || l_orderkey
        WHEN l_linenumber % 2 = 0 THEN NULL ELSE 'https://example.org/first' END""",
}


def flat(*names: str) -> str:
    return "SELECT l_orderkey, l_linenumber, " + ", ".join(f"{FLAT[n]} AS {n}" for n in names) + " FROM lineitem"


@query(flat("authority", "authority_ico", "authority_seat", "authority_profile"))
def derive_authority(spark, sf):
    return _derived(spark, sf, ["zadavaci_postupy.zadavatel_zadavaciho_postupu"], a=rec.derive_authority(F.col("vz"))).select("l_orderkey", "l_linenumber", "a.*")


@query(flat("cpv", "nuts", "place"))
def derive_subject(spark, sf):
    d = _derived(spark, sf, ["predmet", "casti_verejne_zakazky.predmet"], s=rec.derive_subject(F.col("vz")))
    return d.select("l_orderkey", "l_linenumber", F.array_join("s.cpv", "|").alias("cpv"), F.array_join("s.nuts", "|").alias("nuts"), "s.place")


@query(flat("value"))
def derive_value(spark, sf):
    fields = ["predpokladana_hodnota_bez_DPH_v_CZK", "predpokladana_hodnota_bez_DPH", "predpokladana_hodnota_bez_DPH_mena",
              "casti_verejne_zakazky.predpokladana_hodnota_casti_bez_DPH_v_CZK"]
    return _derived(spark, sf, fields, value=rec.derive_value(F.col("vz")))


@query(flat("lots"))
def derive_lots(spark, sf):
    return _derived(spark, sf, lot_fields=["stav"], lots=F.size("zps"))


@query(flat("award_date", "winner", "winner_ico", "price_contracted", "price_paid"))
def derive_award(spark, sf):
    return _derived(spark, sf, lot_fields=["vysledek"], a=rec.derive_award(F.col("zps"))).select(
        "l_orderkey", "l_linenumber", F.col("a.date").alias("award_date"), "a.winner", "a.winner_ico", "a.price_contracted", "a.price_paid"
    )


@query(flat("deadline"))
def derive_deadline(spark, sf):
    return _derived(spark, sf, lot_fields=["lhuty"], history=True, deadline=rec.derive_deadline(F.col("zps"), F.col("history")))


@query(flat("published", "state", "clarifications"))
def derive_published_state_clar(spark, sf):
    fields = ["stav", "datum_zahajeni_zadavaciho_postupu", "pocet_zaslanych_zaevidovanych_vysvetleni_zadavaci_dokumentace"]
    return _derived(spark, sf, lot_fields=fields, p=rec.derive_published_state_clar(F.col("zps"))).select("l_orderkey", "l_linenumber", "p.*")


@query("SELECT l_orderkey, l_linenumber, " + FLAT["kind"] + """ AS kind,
  CASE WHEN l_linestatus = 'F' OR l_linenumber = 7 THEN 'VZMR' ELSE 'VZ' END AS profile_kind FROM lineitem""")
def derive_kind(spark, sf):
    regime = F.when(F.col("l_linenumber") == 7, None).otherwise(F.col("vz.rezim_verejne_zakazky"))
    return _derived(spark, sf, ["rezim_verejne_zakazky"], kind=rec.derive_kind(F.col("vz.rezim_verejne_zakazky")), profile_kind=rec.derive_kind_profile(tx.fold_text(regime)))


_ALL = ("authority", "authority_ico", "value", "published", "deadline", "url", "place", "state", "clarifications", "kind", "winner")


@query("SELECT 'rvz:' || l_orderkey || '-' || l_linenumber AS id, 'Order ' || l_orderkey AS title, "
       + ", ".join(f"{FLAT[n]} AS {n}" for n in _ALL) + " FROM lineitem WHERE l_linenumber <> 7")
def scan_registry_json(spark, sf):
    # an envelope per order, written to files of two months and read through the reader. Lines are gathered
    # as they are and become records in their order's envelope; a month is written by itself, unsorted.
    own = ", ".join(f"l.{c} AS {c}" for c in _lines(spark, sf).columns)
    lots = f"transform(ls, l -> struct({own}, {_of_line(_ZP_A)} AS l_lot_a, {_of_line(_ZP_B)} AS l_lot_b))"
    root = new_path(spark, "registry")
    even = F.coalesce(F.col("l_orderkey") % 2 == 0, F.lit(False))
    for month, chosen in (("2026-06", even), ("2026-07", ~even)):
        lines = _lines(spark, sf).where(chosen)
        orders = lines.groupBy("l_orderkey").agg(F.collect_list(F.struct(*lines.columns)).alias("ls"))
        data = orders.selectExpr(f"{lots} AS ls").selectExpr(f"transform(ls, l -> {_of_line(_RECORD)}) AS data")
        envelopes = data.select(F.to_json(F.struct(F.lit("1").alias("verze"), "data")).alias("value"))
        envelopes.write.option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE // 4).text(f"{root}/month={month}")
    read = sr.read_registry(spark, root, ["2026-06", "2026-07"])
    return sr.normalize_registry(read).select("id", "title", *_ALL[:-1], "award.winner")


@query("""
, seen AS (SELECT authority_ico, arg_min(authority_profile, ord) AS p FROM tender_v WHERE authority_profile IS NOT NULL GROUP BY authority_ico)
SELECT id, coalesce(url, 'https://' || p) AS url FROM tender_v LEFT JOIN seen USING (authority_ico)""", "tender_v")
def url_fallback_chain(spark, sf):
    t = view(spark, sf, "tender_v")
    return sr.fill_urls(t, t, sr.profiles_frame(spark)).select("id", "url")


# --- XML ---------------------------------------------------------------------
_NATIVE = "CASE WHEN l_linenumber <= 2 THEN 'N006/26/V' || (l_orderkey * 10 + l_linenumber) ELSE l_orderkey || '-' || l_linenumber END"
_PROFILE = f"""named_struct('id_objektu', {_NATIVE}, 'id_nipez', CASE WHEN l_linestatus = 'O' THEN 'R' || l_orderkey END, 'nazev_vz', 'Oprava ' || l_partkey,
  'rezim_vz', CASE l_returnflag WHEN 'A' THEN 'VZ malého rozsahu' WHEN 'N' THEN 'podlimitní' END, 'hlavni_cpv', '45' || l_partkey,
  'casti_vz', named_struct('cast_zakazky', array(named_struct('hlavni_cpv_casti_vz', '00000000', 'zadavaci_postup_casti', named_struct(
    'stav_zadavaciho_postupu', CASE WHEN l_linestatus = 'F' THEN 'Zadáno' END, 'datum_uverejneni', {_DAY} || 'T00:00:00',
    'lhuty_zadavaciho_postupu', named_struct('lhuta', array(
       named_struct('druh_lhuty', 'Lhůta pro podání nabídek', 'datum_konce_lhuty', {_LATER} || 'T10:00:00'),
       named_struct('druh_lhuty', 'Zadávací lhůta', 'datum_konce_lhuty', '2099-01-01'))),
    'ucastnici', named_struct('ucastnik', CASE WHEN l_linenumber = 3 THEN NULL ELSE array(
       named_struct('nazev_subjektu', 'Supplier ' || l_suppkey, 'ico', CAST(l_suppkey AS STRING), 'nabidkova_cena_bez_dph', CAST(l_extendedprice AS STRING), 'ucastnik_vyloucen', '0'),
       named_struct('nazev_subjektu', 'Other', 'ico', '', 'nabidkova_cena_bez_dph', CASE WHEN l_linenumber = 5 THEN NULL ELSE CAST(l_quantity AS STRING) END, 'ucastnik_vyloucen', '1')) END),
    'vybrany_dodavatel', CASE WHEN l_returnflag = 'R' THEN NULL ELSE named_struct('nazev_subjektu', 'Supplier ' || l_suppkey, 'ico', CAST(l_suppkey AS STRING), 'smluvni_cena_bez_dph', CAST(l_extendedprice AS STRING)) END,
    'datum_uzavreni_smlouvy', CASE WHEN l_linenumber = 6 THEN NULL ELSE {_DAY} END, 'url_v_registru_smluv', 'https://example.org/s/' || l_orderkey)))))"""


def _xml(records, row_tag, root_tag):
    """A writer of XML exports, packed and in files of bounded size (a packed file is read by one task).
    Without indentation there is half as much to write, pack and parse."""
    return records.write.format("xml").option("rowTag", row_tag).option("rootTag", root_tag).option("indent", "").option(
        "compression", "gzip").option(*FAST_PACKING).option("maxRecordsPerFile", RECORDS_PER_FILE)


def _profile_records(spark, sf, *fields):
    """Profile exports written as XML files per profile and read back, by the fields that are named (without
    any, all of them)."""
    root = new_path(spark, "profiles")
    open_ = F.coalesce(F.col("l_linestatus") == "O", F.lit(False))
    lines = _lines(spark, sf)
    for key, chosen in (("trutnov", open_), ("nachod", ~open_)):       # a key by itself: nothing is sorted by it
        records = _dealt(lines.where(chosen)).select(F.expr(_PROFILE).alias("r")).select("r.*")
        _xml(records, fv.PROFILE_ROW_TAG, "profil").save(f"{root}/key={key}")
    return sp.read_profile_xml(spark, root, part_of(PROFILE_RECORD, *fields) if fields else PROFILE_RECORD)


_PROFILE_LOT = "casti_vz.cast_zakazky.zadavaci_postup_casti"
_P_AWARD = "l_returnflag <> 'R' AND l_linenumber <> 6"


@query(f"""
SELECT CASE WHEN l_linestatus = 'O' THEN 'rvz:R' || l_orderkey ELSE 'profil:nachod:' || {_NATIVE} END AS id,
  CASE WHEN l_linestatus = 'O' THEN 'Město Trutnov' ELSE 'Město Náchod' END AS authority, 'Oprava ' || l_partkey AS title, '45' || l_partkey AS cpv,
  strftime({_D}, '%Y-%m-%d') AS published, strftime({_D} + l_linenumber, '%Y-%m-%d') || 'T10:00:00' AS deadline,
  CASE WHEN l_linenumber <= 2 THEN '{fv.PLATFORM_DETAIL_URL}N006-26-V' || (l_orderkey * 10 + l_linenumber)
    WHEN l_linestatus = 'O' THEN 'https://zakazky.trutnov.cz/profile_display_2.html' ELSE 'https://nen.nipez.cz/profil/mestonachod' END AS url,
  CASE WHEN l_linestatus = 'F' THEN 'Zadáno' END AS state, CASE WHEN l_returnflag = 'N' THEN 'VZ' ELSE 'VZMR' END AS kind,
  CASE WHEN l_linenumber = 3 THEN NULL ELSE 2 END AS bids, CASE WHEN {_P_AWARD} THEN l_extendedprice END AS price_contracted
FROM lineitem""")
def scan_profile_xml(spark, sf):
    t = sp.normalize_profiles(_profile_records(spark, sf), sr.profiles_frame(spark))
    return t.select("id", "authority", "title", F.array_join("cpv", "|").alias("cpv"), "published", "deadline", "url", "state", "kind",
                    F.when(F.col("bidders").isNotNull(), F.size("bidders")).alias("bids"), "award.price_contracted")


@query(f"SELECT {_NATIVE} AS native, strftime({_D} + l_linenumber, '%Y-%m-%d') || 'T10:00:00' AS deadline FROM lineitem")
def derive_deadline_profile(spark, sf):
    terms = rec._flat(F.transform(F.col("casti_vz.cast_zakazky"), lambda c: c["zadavaci_postup_casti"]["lhuty_zadavaciho_postupu"]["lhuta"]))
    records = _profile_records(spark, sf, "id_objektu", f"{_PROFILE_LOT}.lhuty_zadavaciho_postupu")
    return records.select(F.col("id_objektu").alias("native"), rec.derive_deadline_profile(terms).alias("deadline"))


def _bidders():
    people = F.flatten(F.filter(
        F.transform(F.col("casti_vz.cast_zakazky"), lambda c: c["zadavaci_postup_casti"]["ucastnici"]["ucastnik"]), lambda a: a.isNotNull()))
    return rec.derive_bidders(people)


@query(f"""
SELECT {_NATIVE} AS native, 'Supplier ' || l_suppkey AS nazev, CAST(l_suppkey AS STRING) AS ico, l_extendedprice AS cena, false AS vyloucen
FROM lineitem WHERE l_linenumber <> 3
UNION ALL SELECT {_NATIVE}, 'Other', '', CASE WHEN l_linenumber = 5 THEN NULL ELSE l_quantity END, true FROM lineitem WHERE l_linenumber <> 3""")
def derive_bidders(spark, sf):
    return _profile_records(spark, sf).select(F.col("id_objektu").alias("native"), F.inline(_bidders()))


@query(f"""
SELECT id, count(*) * 2 AS bids, count(*) AS excluded, least(min(l_extendedprice), min(CASE WHEN l_linenumber <> 5 THEN l_quantity END)) AS min_price,
  greatest(max(l_extendedprice), max(CASE WHEN l_linenumber <> 5 THEN l_quantity END)) AS max_price
FROM (SELECT *, {_NATIVE} AS id FROM lineitem WHERE l_linenumber <> 3) GROUP BY id""")
def bidder_stats(spark, sf):
    records = _profile_records(spark, sf).select(F.col("id_objektu").alias("id"), _bidders().alias("bidders"))
    return db.bidder_stats(records)


@query(f"""
SELECT {_NATIVE} AS native, CASE WHEN {_P_AWARD} THEN strftime({_D}, '%Y-%m-%d') END AS date, CASE WHEN {_P_AWARD} THEN 'Supplier ' || l_suppkey END AS winner,
  CASE WHEN {_P_AWARD} THEN l_extendedprice END AS price, CASE WHEN {_P_AWARD} THEN 'https://example.org/s/' || l_orderkey END AS registr_url FROM lineitem""")
def derive_profile_award(spark, sf):
    zp = F.get(F.col("casti_vz.cast_zakazky"), F.lit(0))["zadavaci_postup_casti"]
    award = rec.derive_profile_award(zp["vybrany_dodavatel"], zp["datum_uzavreni_smlouvy"], zp["url_v_registru_smluv"])
    return _profile_records(spark, sf).select(F.col("id_objektu").alias("native"), award.alias("a")).select(
        "native", "a.date", "a.winner", F.col("a.price_contracted").alias("price"), "a.registr_url"
    )


@query("""
SELECT l_orderkey || '' AS id, l_linenumber || '' AS verze, l_linenumber <> 7 AS platny, l_suppkey || '' AS ico_zadavatel, 2 AS n_parties, 'Party' AS first_name,
  CASE WHEN l_linenumber = 2 THEN NULL ELSE l_extendedprice END AS hodnota, strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') AS datum,
  CASE WHEN l_returnflag = 'R' THEN l_orderkey || '' END AS parent FROM lineitem WHERE l_linenumber <> 6""")
def scan_contract_xml(spark, sf):
    lines = _lines(spark, sf)
    raw = _dealt(lines).selectExpr(f"""named_struct(
      'identifikator', named_struct('idSmlouvy', l_orderkey, 'idVerze', l_linenumber), 'odkaz', 'https://example.org/c/' || l_orderkey,
      'platnyZaznam', CASE WHEN l_linenumber = 7 THEN 0 ELSE 1 END,
      'smlouva', CASE WHEN l_linenumber = 6 THEN NULL ELSE named_struct('subjekt', named_struct('ico', l_suppkey),
        'smluvniStrana', array(named_struct('ico', '', 'nazev', 'Party'), named_struct('ico', CAST(l_partkey AS STRING), 'nazev', 'B & <C>')),
        'predmet', 'věc ' || l_partkey, 'datumUzavreni', {_DAY},
        'hodnotaBezDph', CASE WHEN l_linenumber = 2 THEN 'neuvedeno' ELSE CAST(l_extendedprice AS STRING) END,
        'navazanyZaznam', CASE WHEN l_returnflag = 'R' THEN l_orderkey END) END) AS r""")
    path = new_path(spark, "dump")
    _xml(raw.select("r.*"), fv.CONTRACT_ROW_TAG, "dump").save(path)
    read = sc.read_contract_xml(spark, path)
    return sc.normalize_contracts(read).select(
        "id", "verze", "platny", "ico_zadavatel", F.size("parties").alias("n_parties"), F.get("parties", F.lit(0))["nazev"].alias("first_name"),
        "hodnota", "datum", "parent",
    )


@query("""
SELECT lpad(o_custkey || '', 8, '0') AS ico, 'https://www.vhodne-uverejneni.cz/profil/' || arg_min(o_orderkey, o_orderkey) AS profile_url,
  'Město & obec ' || o_custkey AS buyer, 'Ulice ' || arg_min(o_orderpriority, o_orderkey) AS seat
FROM orders WHERE o_orderpriority <> '3-MEDIUM' GROUP BY o_custkey""")
def scan_feed_items(spark, sf):
    o = table(spark, sf, "orders")
    link = "'https://example.org/z/' || o_orderkey"
    pages = o.selectExpr(f"{link} AS url", """'<table><tr><th> IČO </th><td class="x">' || CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'neuvedeno'
        ELSE concat_ws(' ', substring(lpad(o_custkey, 8, '0'), 1, 3), substring(lpad(o_custkey, 8, '0'), 4, 5)) END || '</td></tr>'
        || '<tr><th>Adresa sídla</th><td>Ulice ' || o_orderpriority || ' </td></tr></table><a href="https://www.vhodne-uverejneni.cz/profil/' || o_orderkey
        || '" class="c" title="Město &amp; obec ' || o_custkey || '">p</a>' AS html""")
    path = new_path(spark, "feed")      # in the order of the keys, which the reader has to keep
    o.select("o_orderkey", F.concat(F.lit(" https://example.org/z/"), "o_orderkey").alias("link")).orderBy("o_orderkey").select(
        "link").write.format("xml").option("rowTag", fv.FEED_ROW_TAG).option("rootTag", "channel").save(path)
    items = sf_.read_feed(spark, path)
    known = sr.profiles_frame(spark)
    return sf_.feed_buyers(items, pages, known)


@query(f"""
SELECT 'profil:x:' || CASE WHEN o_orderstatus = 'P' THEN 'c' || o_orderkey || '.html' ELSE 'P' || o_orderkey END AS id, 'Zakázka ' || o_orderkey AS title,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'Profil' ELSE 'Úřad ' || o_custkey END AS authority,
  CASE WHEN o_orderpriority = '1-URGENT' THEN '99' ELSE lpad(o_custkey || '', 8, '0') END AS authority_ico,
  CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE floor(o_totalprice) END AS value, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS published,
  strftime(CAST(o_orderdate AS DATE) + 30, '%Y-%m-%d') || 'T10:30:00' AS deadline, 'Obec A, Obec ' || o_custkey AS place,
  CASE WHEN o_orderstatus = 'F' THEN 'VZMR' ELSE 'VZ' END AS kind
FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'""")
def mine_detail_html(spark, sf):
    pages = table(spark, sf, "orders").selectExpr(
        "'x' AS key", "'https://example.org/c' || o_orderkey || '.html' AS url", "'c' || o_orderkey || '.html' AS path", "'Profil' AS profile_buyer", "'99' AS profile_ico",
        """'<div>' || CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE '<a href="c' || o_orderkey || '.html"><img></a><a href="/c' || o_orderkey || '.html">Zakázka ' || o_orderkey || '</a>' END
        || CASE WHEN o_orderstatus = 'P' THEN '' ELSE 'Systémové číslo: <b>P' || o_orderkey || '</b>' END
        || CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE '<th>Předpokládaná hodnota</th> <td class="v"> <b>' || replace(format_number(floor(o_totalprice), 0), ',', ' ') || ' Kč bez DPH</b></td>' END
        || 'Datum zahájení: <b>' || date_format(o_orderdate, 'dd.MM.yyyy') || '</b> Nabídku podat do: <b><i>' || date_format(date_add(CAST(o_orderdate AS DATE), 30), 'dd.MM.yyyy') || ' 10:30</i></b>'
        || CASE WHEN o_orderpriority = '1-URGENT' THEN '' ELSE 'Úřední název: <b>Úřad  ' || o_custkey || '</b><p>IČO: <b>' || lpad(o_custkey, 8, '0') || '</b>' END
        || '<h4>Místo plnění</h4> <ul><li>Obec  A</li><li>Obec ' || o_custkey || '</li></ul>' || CASE WHEN o_orderstatus = 'F' THEN 'zakázka malého rozsahu' ELSE '' END AS html""")
    return sd.mine_detail_html(pages).select("id", "title", "authority", "authority_ico", "value", "published", "deadline", "place", "kind")


# --- pages and documents -----------------------------------------------------
@query("""
SELECT key, 'contract_display_' || n || '.html' AS path, 'https://b.example.org/' || key || '/contract_display_' || n || '.html' AS url,
  CAST(row_number() OVER (PARTITION BY key ORDER BY first) - 1 AS INT) AS pos
FROM (SELECT CAST(o_custkey AS VARCHAR) AS key, CAST(o_orderkey % 7 AS VARCHAR) AS n, min(o_orderkey) AS first FROM orders GROUP BY ALL)""")
def listed_details(spark, sf):
    # a listing per customer, with a link for every order; several lead to the same page
    anchor = F.concat(F.lit('<li><a class="x" href="'), F.when(F.col("o_orderkey") % 2 == 0, "/").otherwise(""),
                      F.lit("contract_display_"), (F.col("o_orderkey") % 7).cast("string"), F.lit('.html">Oprava</a> <a href="/other.html">'))
    listings = table(spark, sf, "orders").groupBy(F.col("o_custkey").cast("string").alias("key")).agg(
        F.sort_array(F.collect_list(F.struct("o_orderkey", anchor.alias("a")))).alias("links"))
    return sd.listed_details(listings.select(
        "key", F.concat(F.lit("https://b.example.org/"), "key", F.lit("/")).alias("profile_url"),
        F.array_join(F.transform("links", lambda x: x["a"]), "\n").alias("html")))


LINKS_SQL = r"""
links AS (SELECT url, unnest(list_transform(h, lambda x, i: {'pos': i - 1, 'href': x, 'anchor': lower(strip_accents(
     replace(regexp_replace(a[i], '<[^>]+>', ' ', 'g'), '&amp;', '&')))}), recursive := true)
  FROM (SELECT url, regexp_extract_all(html, '(?is)<a\s[^>]*href="([^"]+)"[^>]*>(.*?)</a>', 1) AS h,
               regexp_extract_all(html, '(?is)<a\s[^>]*href="([^"]+)"[^>]*>(.*?)</a>', 2) AS a FROM pages))"""
_JOIN_URL = """CASE WHEN starts_with(href, '/') THEN regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) || href ELSE href END"""


@query(f"WITH {LINKS_SQL} SELECT url, pos, href, anchor FROM links")
def page_links(spark, sf):
    return dc.page_links(table(spark, sf, "pages"))


@query(f"""WITH {LINKS_SQL}
SELECT url, {_JOIN_URL} AS doc_url FROM (
  SELECT * FROM links WHERE (contains(anchor, 'th') OR contains(anchor, 'auli')) AND NOT contains(anchor, 'vysvetleni'))
QUALIFY row_number() OVER (PARTITION BY url ORDER BY pos) = 1""")
def html_strip_links(spark, sf):
    return dc.html_strip_links(table(spark, sf, "pages"), ("th", "auli"))


@query(f"""WITH {LINKS_SQL},
hit AS (SELECT url, {_JOIN_URL} AS doc_url FROM (
  SELECT * FROM links WHERE contains(anchor, 'auli') AND NOT contains(anchor, 'vysvetleni'))
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY pos) = 1),
sub AS (SELECT url, pos, {_JOIN_URL} AS sub_url FROM links WHERE url NOT IN (SELECT url FROM hit)
  AND (contains(anchor, 'dokument') OR contains(lower(href), 'dokument')))
SELECT url, doc_url FROM hit UNION ALL
SELECT s.url, arg_min(h.doc_url, s.pos) FROM sub s JOIN hit h ON h.url = s.sub_url GROUP BY s.url""")
def find_doc_link(spark, sf):
    return dc.find_doc_link(table(spark, sf, "pages"), ("auli",))


_DOC_TEXT = """text || '\n\nPředpokládaná hodnota zakázky činí ' || replace(format_number(n_chars * 100, 0), ',', ' ') || ',50 Kč bez DPH\nMísto plnění stavby: ' || source || '  v obci ' || lang || '; dále\nDoba plnění: do ' || n_chars || ' dnů\n'"""


@query("""
SELECT doc_id, CASE WHEN n_chars * 100 + 0.5 >= 10000 THEN n_chars * 100 + 0.5 END AS hodnota, source || ' v obci ' || lang AS misto, 'do ' || n_chars || ' dnu' AS termin
FROM documents""")
def mine_tender_doc(spark, sf):
    docs = table(spark, sf, "documents").selectExpr("doc_id", f"{_DOC_TEXT} AS text")
    return dc.mine_tender_doc(docs).select("doc_id", "hodnota", "misto", "termin")


@query("""
SELECT doc_id, CASE WHEN lang = 'en' THEN 'stavby ' || source || ' s.r.o.' END AS vitez, CASE WHEN n_chars * 100 >= 10000 THEN CAST(n_chars * 100 AS DOUBLE) END AS cena
FROM documents""")
def mine_award_report(spark, sf):
    report = """text || '\n\nVybraný dodavatel: ' || CASE WHEN lang = 'en' THEN 'Stavby ' || source || ' s.r.o.' ELSE 'nikdo' END || ', se sídlem\nNabídková cena činí ' || n_chars * 100 || ',- Kč\n'"""
    docs = table(spark, sf, "documents").selectExpr("doc_id", f"{report} AS text")
    return dc.mine_award_report(docs).select("doc_id", "vitez", "cena")


_EXPORT_KEYS = """
offers AS (SELECT 'b' || l_linestatus AS base, l_orderkey * 8 + l_linenumber AS ord, 'u' || l_orderkey || '-' || l_linenumber AS u,
  l_orderkey || '' AS k1, 'r' || l_partkey AS k2 FROM lineitem WHERE l_returnflag = 'R')"""


@query(f"""WITH {_EXPORT_KEYS},
wanted AS (SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'O' THEN 'bO' ELSE 'bF' END AS base, o_orderkey || '' AS a, 'r' || o_orderkey AS b FROM orders),
hits AS (SELECT id, u, ord, 0 AS prio FROM wanted w JOIN offers f ON w.base = f.base AND (w.a = f.k1)
  UNION ALL SELECT id, u, ord, 1 FROM wanted w JOIN offers f ON w.base = f.base AND w.b = f.k2)
SELECT id, u AS doc_url FROM hits QUALIFY row_number() OVER (PARTITION BY id ORDER BY prio, ord, u) = 1""")
def profile_doc_lookup(spark, sf):
    tenders = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS id", "CASE WHEN o_orderstatus = 'O' THEN 'bO' ELSE 'bF' END AS base", "CAST(o_orderkey AS STRING) AS native_id", "'r' || o_orderkey AS registry_id")
    exports = table(spark, sf, "lineitem").selectExpr(
        "'b' || l_linestatus AS base", "l_orderkey * 8 + l_linenumber AS ord", "array(CAST(l_orderkey AS STRING), 'r' || l_partkey) AS ids",
        """array(named_struct('typ', CASE l_returnflag WHEN 'R' THEN 'Zadávací dokumentace' WHEN 'A' THEN 'Vysvětlení zadávací dokumentace' ELSE 'Příloha' END,
           'url', 'u' || l_orderkey || '-' || l_linenumber), named_struct('typ', 'Zadávací dokumentace', 'url', '')) AS docs""")
    return dc.profile_doc_lookup(tenders, exports, ("zadavaci dokumentace",))


@query("""
, todo AS (SELECT doc_id, CASE WHEN n_chars > 500 THEN source || lang END AS u FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)),
claims AS (SELECT u, min(doc_id) AS doc_id FROM todo WHERE u IS NOT NULL AND u NOT IN (SELECT source || lang FROM documents JOIN labels USING (doc_id) WHERE toxic = 1) GROUP BY u),
cut AS (SELECT CASE WHEN count(*) = 30 THEN max(doc_id) END AS c FROM (SELECT doc_id FROM claims ORDER BY doc_id LIMIT 30))
SELECT t.doc_id AS id, c.u AS doc_url, c.u IS NULL AS nenalezeno FROM todo t LEFT JOIN claims c ON c.u = t.u AND c.doc_id = t.doc_id, cut
WHERE cut.c IS NULL OR t.doc_id <= cut.c""", "title_v")
def doc_claim_unique(spark, sf):
    docs = table(spark, sf, "documents")
    done = table(spark, sf, "labels").where("toxic = 1").select("doc_id")
    found = docs.selectExpr("doc_id AS id", "doc_id AS ord", "CASE WHEN n_chars > 500 THEN source || lang END AS doc_url")
    store = docs.join(done, "doc_id").selectExpr("doc_id AS id", "source || lang AS doc_url")
    return dc.doc_claim_unique(found, store)


@query(f""", work AS (SELECT id, ord FROM tender_v WHERE source = 'isvz' AND NOT {EXPIRED_SQL} ORDER BY {LIST_SQL} LIMIT 50)
SELECT t.id, CASE WHEN w.id IS NOT NULL AND t.clarifications > 1 THEN t.published END AS site_visit,
  CASE WHEN w.id IS NOT NULL THEN 9 ELSE t.clarifications END AS clarifications FROM tender_v t LEFT JOIN work w USING (id)""", "tender_v")
def detail_enrich(spark, sf):
    t = fl.mark_expired(view(spark, sf, "tender_v"), TODAY).withColumn("nen_id", F.concat(F.lit("N"), "ord"))
    details = t.select("nen_id", F.when(F.col("clarifications") > 1, F.col("published")).alias("site_visit"), F.lit(9).alias("clarifications"))
    return dc.detail_enrich(t, details).select("id", "site_visit", "clarifications")


# --- months and snapshots ----------------------------------------------------
@query("""
WITH expected AS (SELECT strftime(m, '%Y-%m') AS month, m FROM (SELECT unnest(generate_series(DATE '2000-09-01', DATE '2001-09-01', INTERVAL 1 MONTH)) AS m))
SELECT month, CASE WHEN month IN (SELECT strftime(o_orderdate, '%Y-%m') FROM orders) THEN 'read' WHEN m >= DATE '2001-08-01' THEN 'pending' ELSE 'missing' END AS status FROM expected""")
def select_month_partitions(spark, sf):
    available = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    expected = ss.expected_months(spark, "2001-09-15", fv.BACKFILL_MONTHS)
    return ss.select_month_partitions(available, expected, "2001-09-15")


_SNAPSHOT = "id string, title string, value double, kind string"


@query("SELECT id, title, value, kind FROM prev_v", "prev_v")
def load_snapshot_or_default(spark, sf):
    root = new_path(spark, "snapshot")
    absent = ss.load_snapshot_or_default(spark, root, _SNAPSHOT)
    view(spark, sf, "prev_v").select("id", "title", "value", "kind").write.parquet(f"{root}/run_date=1998-05-31")
    return ss.load_snapshot_or_default(spark, root, _SNAPSHOT).unionByName(absent)


@query("SELECT (SELECT count(*) FROM tender_v) AS new_rows, (SELECT count(*) FROM prev_v) AS previous_rows", "tender_v", "prev_v")
def guarded_publish(spark, sf):
    root = new_path(spark, "tenders")
    new = view(spark, sf, "tender_v").select("id", "title", "value", "kind")
    return ss.guarded_publish(new, view(spark, sf, "prev_v"), root, TODAY, replace(Settings(), min_result_ratio=0.2))
