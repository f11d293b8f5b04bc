"""Contract matching of large (buyer, supplier) pairs against the join of all candidates."""

import random
from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from catalog import views
from tenderloom import Settings
from tenderloom.operators import linking as ln
from tenderloom.schemas import LINK

AWARD = "id string, authority_ico string, winner_ico string, awarded string, price_contracted double"
CONTRACT = ("id string, verze string, url string, platny boolean, ico_zadavatel string, parties array<struct<ico:string,nazev:string>>, "
            "datum string, hodnota double, parent string, ord long")


def day(rng, days=400):
    return f"{2024 + (n := rng.randrange(days)) // 360}-{n % 360 // 30 + 1:02d}-{n % 30 % 28 + 1:02d}"


def price(rng):
    return rng.choice([None, 0.0, -50.0, float(rng.randrange(1, 40) * 10), rng.randrange(100, 400) / 1.0, 1e9])


def tables(spark, seed, n=120):
    rng = random.Random(seed)
    winners = ["20", "20", "20", "21", "20; 21", "21; 22; 20", "", None]
    awards = [(f"t{i}", rng.choice(["10", "10", "11", " 10 "]), rng.choice(winners), rng.choice([day(rng), day(rng), None, "bad"]) if i % 9 == 0 else day(rng),
               price(rng)) for i in range(n)]
    contracts = []
    for i in range(n):
        parties = rng.sample(["20", "21", "22", ""], rng.randrange(1, 4))
        for version in range(rng.choice([1, 1, 1, 2, 3])):
            own = parties if rng.random() < 0.8 else rng.sample(["20", "21", "22"], rng.randrange(1, 3))
            contracts.append((f"c{i}", str(rng.choice([version, 9 + version])), f"u{i}-{version}", rng.random() < 0.95, rng.choice(["10", "10", "11"]),
                              [(p, "Firma " + p) for p in own], day(rng), price(rng), "p" if rng.random() < 0.05 else None, len(contracts)))
    rng.shuffle(contracts)
    return spark.createDataFrame(awards, AWARD), spark.createDataFrame(contracts, CONTRACT)


def rows(df):
    return sorted((tuple(r) for r in df.select("tender_id", "contract_id", "url", "date", "price", "confidence").collect()), key=repr)


@pytest.mark.parametrize("seed", [1])
def test_search_by_price_equals_the_join(spark, seed):
    awards, contracts = tables(spark, seed)
    want = rows(ln.contract_best_match(ln.contract_candidates(awards, contracts)))
    assert len(want) > 50 and {w[-1] for w in want} == {"high", "low"}
    for limit in (0, 40):
        assert rows(ln.contract_matches(awards, contracts, replace(Settings(), paired_contracts=limit))) == want, limit


def test_two_thousand_by_two_thousand(spark):
    """One buyer, one supplier, one window: rows follow 4,000, not 4,000,000."""
    n = 2000
    awards = spark.range(n).select(
        F.concat(F.lit("t"), "id").alias("id"), F.lit("10").alias("authority_ico"), F.lit("20").alias("winner_ico"),
        F.lit("2026-01-20").alias("awarded"), (F.col("id") * 10 + 1000.0).alias("price_contracted"))
    contracts = spark.range(n).select(
        F.concat(F.lit("c"), "id").alias("id"), F.lit("1").alias("verze"), F.lit("u").alias("url"), F.lit(True).alias("platny"),
        F.lit("10").alias("ico_zadavatel"), F.array(F.struct(F.lit("20").alias("ico"), F.lit("F").alias("nazev"))).alias("parties"),
        F.lit("2026-02-01").alias("datum"), (F.col("id") * 10 + 1003.0).alias("hodnota"), F.lit(None).cast("string").alias("parent"),
        F.col("id").alias("ord"))
    got = ln.contract_matches(awards, contracts)
    assert {(r.tender_id, r.contract_id) for r in got.collect()} == {(f"t{i}", f"c{i}") for i in range(n)}
    made = most_rows(got)
    assert 0 < made < 40 * 2 * n, made


def most_rows(df):
    """The most rows that one operator of the plan made."""
    most = [0]

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if hasattr(node, "plan") and name.endswith("QueryStageExec"):
            return walk(node.plan())
        metric = node.metrics().get("numOutputRows")
        if metric.isDefined():
            most[0] = max(most[0], metric.get().value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return most[0]


def test_nothing_to_match(spark):
    awards, contracts = tables(spark, 4, 10)
    assert ln.contract_matches(awards.limit(0), contracts).count() == 0
    assert ln.contract_matches(awards, contracts.limit(0), replace(Settings(), paired_contracts=0)).count() == 0


def test_pairs_found_in_parts_are_those_found_at_once(spark, monkeypatch):
    """Also awards of several winners and contracts of several parties, which meet once only."""
    rng = random.Random(7)
    day = lambda: f"1997-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"
    awards = [(f"t{i}", f"b{i % 9}", "; ".join(rng.sample(["s1", "s2", "s3"], rng.randint(1, 3))), day(), 100.0 + i) for i in range(60)]
    rows = [(f"c{i}", "1", "u", True, f"b{i % 9}", [(s, s) for s in rng.sample(["s1", "s2", "s3"], rng.randint(1, 3))],
             day(), 100.0 + rng.randint(0, 60), None, i) for i in range(120)]
    a = spark.createDataFrame(awards, "id string, authority_ico string, winner_ico string, awarded string, price_contracted double")
    c = spark.createDataFrame(rows, CONTRACT)
    pairs = ln.contract_candidates(a, c).select("tender_id", "contract_id").collect()
    both = lambda w, p: [x for x in w.split("; ") if x in [i for i, _ in p]]
    gap = lambda x, y: (date.fromisoformat(y) - date.fromisoformat(x)).days
    want = [(t[0], r[0]) for t in awards for r in rows if t[1] == r[4] and both(t[2], r[5]) and -30 <= gap(t[3], r[6]) <= 120]
    assert sorted(map(tuple, pairs)) == sorted(want)
    once = sorted(map(tuple, ln.contract_matches(a, c).collect()))
    monkeypatch.setattr(ln, "PASS_ROWS", 50)
    written = []
    real = ln.materialize
    monkeypatch.setattr(ln, "materialize", lambda df, name="step": written.append(name) or real(df, name))
    assert sorted(map(tuple, ln.contract_matches(a, ln.signed_contracts(c), stored=True).collect())) == once
    assert written.count("pairs") == 4


def test_views_are_stored_a_part_of_the_orders_at_a_time(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(i, i % 3, i % 2, 1, 1.0, 10.0, 0.1, 0.1, "R" if i % 4 else "N", "F", "1997-01-01") for i in range(40)] + [(None, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, "N", "O", None)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber long, l_quantity double, l_extendedprice double, l_discount double,"
        " l_tax double, l_returnflag string, l_linestatus string, l_shipdate string").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(i, i % 5, "O", 1.0, "1997-01-01", "1-URGENT") for i in range(35)],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate string, o_orderpriority string").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(i, "n", "b", "t", 3) for i in range(3)], "p_partkey long, p_name string, p_brand string, p_type string, p_size long").write.parquet(str(tmp_path / "part.parquet"))
    for name, n in (("competition_v", 35), ("contract_v", 35)):
        monkeypatch.setattr(views, "PASS_LINES", 1 << 40)
        whole = views.stored(spark, str(tmp_path), name, lambda v: v.select("id"), "v")
        monkeypatch.setattr(views, "PASS_LINES", 10)
        made = []
        real = views.materialize
        monkeypatch.setattr(views, "materialize", lambda df, label: made.append(label) or real(df, label))
        parts = views.stored(spark, str(tmp_path), name, lambda v: v.select("id"), "v")
        assert len(made) == 5 and sorted(r.id for r in parts.collect()) == sorted(r.id for r in whole.collect()) and parts.count() == n
        monkeypatch.setattr(views, "materialize", real)


def test_a_dump_meets_the_awards_of_its_days_only(spark):
    a = spark.createDataFrame([("old", "b", "s", "1990-01-01", 1.0), ("t", "b", "s", "1997-01-31", 1.0), ("early", "b", "s", "1997-05-03", 1.0),
                               ("no", "b", "s", None, 1.0)],
                              "id string, authority_ico string, winner_ico string, awarded string, price_contracted double")
    c = spark.createDataFrame([("c", "1", "u", True, "b", [("s", "s")], "1997-04-03", 1.0, None, 1)], CONTRACT)
    assert sorted(r.id for r in ln._awarded_near(a, c, Settings()).collect()) == ["early", "t"]
    assert ln._awarded_near(a, c.where("false"), Settings()).count() == 0
    # links of tenders that are gone leave with the first dump
    gone = spark.createDataFrame([("gone", "x", "u", None, 1.0, "high")], LINK)
    dumps = c.withColumn("dump", F.lit(1)).unionByName(c.withColumns({"dump": F.lit(2), "id": F.lit("d")}))
    assert [r.tender_id for r in ln.link_dumps(a, dumps, gone).collect()] and "gone" not in [r.tender_id for r in ln.link_dumps(a, dumps, gone).collect()]
