"""Readers: files cut into splits, records numbered in the order of the input."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from catalog import ingest
from tenderloom.functions import records as rec
from tenderloom.schemas import PROFILE_RECORD, part_of
from tenderloom.sources import contracts as sc
from tenderloom.sources import feed as sf
from tenderloom.sources import profiles as sp
from tenderloom.sources import registry as sr
from tenderloom.sources.order import file_starts, in_file_order


@pytest.fixture
def small_splits(spark):
    """Splits of 4 KB, packed up to 4 KB a task."""
    names = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "16", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def ordered(df, column):
    rows = df.select(column, "ord").collect()
    numbers = [r.ord for r in rows]
    assert len(set(numbers)) == len(numbers)
    return [r[0] for r in sorted(rows, key=lambda r: r.ord)]


def export(names, **style):
    data = [{"verejna_zakazka": {"identifikator_NIPEZ": n, "nazev_verejne_zakazky": f'T {n} "verejna_zakazka": {{,'}, "historie_lhut": []} for n in names]
    return json.dumps({"verze": "1", "data": data, "konec": [1, {"a": "}"}]}, ensure_ascii=False, **style)


@pytest.mark.parametrize("style", [{}, {"indent": 2}, {"separators": (",", ":")}])
def test_one_export_is_read_by_many_tasks_in_order(spark, tmp_path, small_splits, style):
    """A small first file and large later ones: Spark reads the large ones first, their records come last."""
    files = {"2026-06/b.json": ["b1", "b2"], "2026-06/a.json": ["a1"], "2026-07/x.json": [f"x{i}" for i in range(300)], "2026-08/y.json": []}
    for name, records in files.items():
        path = tmp_path / f"month={name}"
        path.parent.mkdir(exist_ok=True)
        path.write_text(export(records, **style), "utf-8")
    read = sr.read_registry(spark, str(tmp_path), ["2026-06", "2026-07", "2026-08"])
    assert ordered(sr.normalize_registry(read), "id") == [f"rvz:{n}" for n in ["a1", "b1", "b2", *files["2026-07/x.json"]]]
    assert read.where("month = '2026-07'").select(F.spark_partition_id()).distinct().count() > 3
    title = sr.normalize_registry(read).where("id = 'rvz:x7'").first().title
    assert title == 'T x7 "verejna_zakazka": {,'
    late = sr.read_registry(spark, str(tmp_path), ["2026-07", "2026-06"])       # the order asked for counts
    assert ordered(sr.normalize_registry(late), "id")[-3:] == ["rvz:a1", "rvz:b1", "rvz:b2"]


def test_fields_before_the_first_are_an_error_not_a_loss(spark, tmp_path):
    folder = tmp_path / "month=2026-06"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps({"data": [
        {"verejna_zakazka": {"identifikator_NIPEZ": "1", "nazev_verejne_zakazky": "a"}},
        {"historie_lhut": [], "verejna_zakazka": {"identifikator_NIPEZ": "2", "nazev_verejne_zakazky": "b"}}]}), "utf-8")
    with pytest.raises(Exception, match="fields before"):
        sr.normalize_registry(sr.read_registry(spark, str(tmp_path), ["2026-06"])).collect()


def test_xml_records_keep_the_order_of_files_and_bytes(spark, tmp_path, small_splits):
    one = "<zaznam><identifikator><idSmlouvy>{0}</idSmlouvy></identifikator><smlouva><predmet>" + "x" * 40 + "</predmet></smlouva></zaznam>"
    (tmp_path / "1.xml").write_text("<dump>" + one.format("first") + "</dump>")
    (tmp_path / "2.xml").write_text("<dump>" + "".join(one.format(i) for i in range(400)) + "</dump>")
    (tmp_path / "3.xml").write_text("<dump>" + one.format("last") + one.format("end") + "</dump>")
    rows = sc.normalize_contracts(sc.read_contract_xml(spark, str(tmp_path)))
    assert ordered(rows, "id") == ["first", *map(str, range(400)), "last", "end"]

    links = tmp_path / "feed.xml"
    links.write_text("<rss>" + "".join(f"<item><link>http://{i}</link><d>{'y' * 30}</d></item>" for i in range(300)) + "</rss>")
    assert ordered(sf.read_feed(spark, str(links)), "link") == [f"http://{i}" for i in range(300)]

    for key, n in (("nachod", 2), ("trutnov", 150)):
        folder = tmp_path / "p" / f"key={key}"
        folder.mkdir(parents=True)
        (folder / "p.xml").write_text("<profil>" + "".join(
            f"<zakazka><id_objektu>{key}{i}</id_objektu><nazev_vz>{'z' * 30}</nazev_vz></zakazka>" for i in range(n)) + "</profil>")
    tenders = sp.normalize_profiles(sp.read_profile_xml(spark, str(tmp_path / "p")), sr.profiles_frame(spark))
    assert ordered(tenders, "id") == [f"profil:{k}:{k}{i}" for k, n in (("nachod", 2), ("trutnov", 150)) for i in range(n)]


def test_compressed_and_many_small_files(spark, tmp_path, small_splits):
    for i in range(30):
        (tmp_path / f"{i:02d}.txt").write_text("".join(f"{i:02d}-{j:03d}\n" for j in range(i % 4)))
    (tmp_path / "05.txt.gz").write_bytes(gzip.compress("".join(f"zip-{j:05d}\n" for j in range(3000)).encode()))
    scan = spark.read.text(str(tmp_path))
    want = [f"{i:02d}-{j:03d}" for i in range(6) for j in range(i % 4)] + [f"zip-{j:05d}" for j in range(3000)] + \
        [f"{i:02d}-{j:03d}" for i in range(6, 30) for j in range(i % 4)]
    assert ordered(in_file_order(scan, [str(tmp_path)]), "value") == want
    assert file_starts(spark, [str(tmp_path)]).count() == 23      # those that are not empty


def test_records_are_numbered_without_an_exchange(spark, tmp_path, monkeypatch):
    # Spark takes the listing of large files for a large table; the records must not be shuffled to meet it
    spark.createDataFrame([("a",), ("b",)], "v string").coalesce(1).write.text(str(tmp_path / "x"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        read = in_file_order(spark.read.text(str(tmp_path / "x")), [str(tmp_path / "x")])
        plan = read._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert [r["value"] for r in read.orderBy("ord").collect()] == ["a", "b"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_registry_record_is_parsed_once(spark, tmp_path):
    # conditions on parsed fields, put below the parse, would parse each text again for every condition
    (tmp_path / "month=2026-06").mkdir()
    (tmp_path / "month=2026-06" / "a.json").write_text(export(["a", "", "b"]).replace('}, {', '}\n\t ,\n {'), "utf-8")
    rows = sr.normalize_registry(sr.read_registry(spark, str(tmp_path), ["2026-06"])).select("id", "title", "award", "deadline")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
    assert sorted(r.id for r in rows.collect()) == ["rvz:a", "rvz:b"]


PROFILE = """<profil><zakazka><id_objektu>1</id_objektu><nazev_vz>A</nazev_vz><casti_vz><cast_zakazky>
  <zadavaci_postup_casti><stav_zadavaciho_postupu>x</stav_zadavaciho_postupu><lhuty_zadavaciho_postupu>
  <lhuta><druh_lhuty>Lhůta pro podání nabídek</druh_lhuty><datum_konce_lhuty>2026-01-02T10:00:00</datum_konce_lhuty></lhuta>
  </lhuty_zadavaciho_postupu></zadavaci_postup_casti></cast_zakazky></casti_vz></zakazka>
  <zakazka><id_objektu>2</id_objektu></zakazka></profil>"""


def test_a_profile_export_is_read_by_the_fields_that_are_named(spark, tmp_path):
    (tmp_path / "key=nachod").mkdir()
    (tmp_path / "key=nachod" / "p.xml").write_text(PROFILE, "utf-8")
    lot = "casti_vz.cast_zakazky.zadavaci_postup_casti"
    part = sp.read_profile_xml(spark, str(tmp_path), part_of(PROFILE_RECORD, "id_objektu", f"{lot}.lhuty_zadavaciho_postupu"))
    assert part.columns == ["id_objektu", "casti_vz", "key", "ord"]
    assert "stav_zadavaciho_postupu" not in part._jdf.queryExecution().optimizedPlan().schema().simpleString()

    def deadlines(records):
        terms = rec._flat(F.transform("casti_vz.cast_zakazky", lambda c: c["zadavaci_postup_casti"]["lhuty_zadavaciho_postupu"]["lhuta"]))
        return [tuple(r) for r in records.select("id_objektu", rec.derive_deadline_profile(terms), "ord").orderBy("id_objektu").collect()]

    assert deadlines(part) == deadlines(sp.read_profile_xml(spark, str(tmp_path)))
    assert [d[:2] for d in deadlines(part)] == [("1", "2026-01-02T10:00:00"), ("2", None)]


def test_xml_exports_are_written_without_indentation(spark, tmp_path):
    rows = spark.createDataFrame([("1", "á & <b>", ["x", None])], "id_objektu string, nazev_vz string, l array<string>").coalesce(1)
    ingest._xml(rows, "zakazka", "profil").save(str(tmp_path / "out"))
    text = gzip.decompress(next((tmp_path / "out").glob("*.gz")).read_bytes()).decode()
    assert "<zakazka><id_objektu>1</id_objektu><nazev_vz>á &amp; &lt;b" in text
    (tmp_path / "out").rename(tmp_path / "key=nachod")
    assert sp.read_profile_xml(spark, str(tmp_path)).select("id_objektu", "nazev_vz").collect() == [("1", "á & <b>")]
