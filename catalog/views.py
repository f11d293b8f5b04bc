"""Adapter views: the test tables seen as tenders, awards, contracts, probes and logs.

The texts are plain SQL that Spark and DuckDB both read; table names stand in braces.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderloom.materialize import materialize

PASS_LINES = 40_000_000         # lines whose views are stored at a time
TODAY = "1998-06-01"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

SQL = {
    # cpv and nuts are '|'-joined here and become arrays on either side
    "tender_v": """
SELECT 'rvz:' || CAST(o.o_orderkey AS STRING) AS id, o.o_orderkey AS ord, o.o_custkey AS custkey,
  CASE o.o_orderstatus WHEN 'O' THEN 'isvz' WHEN 'F' THEN 'profil:trutnov'
       ELSE 'profil:pvu:' || lpad(CAST(o.o_custkey AS STRING), 8, '0') END AS source,
  CASE WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE lpad(CAST(o.o_custkey AS STRING), 8, '0') END AS authority_ico,
  CASE WHEN o.o_orderpriority = '2-HIGH' THEN 'Statutární město ' || p.p_name
       ELSE 'Customer ' || CAST(o.o_custkey AS STRING) END AS authority,
  p.p_name AS title,
  CASE WHEN p.p_type = 'PROMO' OR p.p_size IS NULL THEN ''
       WHEN p.p_brand = 'Brand#1' THEN '45000000'
       WHEN p.p_size % 3 = 0 THEN '452' || lpad(CAST(p.p_size AS STRING), 2, '0') || '000|33' || lpad(CAST(p.p_size AS STRING), 3, '0') || '000'
       ELSE '33' || lpad(CAST(p.p_size AS STRING), 3, '0') || '000' END AS cpv_text,
  CASE o.o_orderpriority WHEN '1-URGENT' THEN '' WHEN '2-HIGH' THEN 'CZ010|CZ0521' WHEN '3-MEDIUM' THEN 'CZ053'
       WHEN '4-NOT SPECIFIED' THEN 'CZ010' ELSE 'CZ0209|CZ064' END AS nuts_text,
  CASE WHEN day(o.o_orderdate) <= 3 THEN NULL ELSE o.o_totalprice * 20 END AS value,
  CAST(CAST(o.o_orderdate AS DATE) AS STRING) AS published,
  CASE WHEN day(o.o_orderdate) BETWEEN 10 AND 13 THEN NULL
       ELSE CAST(CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 90 AS INT) AS STRING) || 'T10:00:00' END AS deadline,
  CASE WHEN month(o.o_orderdate) IN (2, 3) THEN NULL ELSE 'https://example.org/t/' || CAST(o.o_orderkey AS STRING) END AS url,
  CASE WHEN o.o_orderstatus = 'F' THEN 'www.example.org/profile/' || CAST(o.o_custkey AS STRING) ELSE NULL END AS authority_profile,
  CASE WHEN o.o_orderpriority = '5-LOW' THEN p.p_brand || ', ' || p.p_name ELSE NULL END AS place,
  CASE WHEN o.o_orderpriority = '3-MEDIUM' THEN 'sídlo: ' || p.p_name ELSE NULL END AS authority_seat,
  CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Zadáno' WHEN '3-MEDIUM' THEN 'neukončen' ELSE NULL END AS state,
  CAST(NULL AS STRING) AS site_visit,
  CAST(month(o.o_orderdate) % 4 AS INT) AS clarifications,
  CASE WHEN o.o_orderstatus = 'O' THEN 'VZ' ELSE 'VZMR' END AS kind
FROM {orders} o
LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS pk FROM {lineitem} GROUP BY l_orderkey) f ON f.l_orderkey = o.o_orderkey
LEFT JOIN {part} p ON p.p_partkey = f.pk""",
    "competition_v": """
SELECT CAST(o.o_orderkey AS STRING) || '-' || CAST(g.l_suppkey AS STRING) AS id, o.o_orderkey AS ord,
  'isvz' AS source, p.p_name AS title, 'Customer ' || CAST(o.o_custkey AS STRING) AS authority,
  lpad(CAST(o.o_custkey AS STRING), 8, '0') AS authority_ico,
  CASE WHEN o.o_orderpriority = '1-URGENT' AND g.l_suppkey < 10 THEN '' ELSE 'Supplier ' || p.p_type END AS winner,
  CASE WHEN o.o_orderpriority = '5-LOW' AND g.l_suppkey < 20 THEN '' ELSE lpad(CAST(g.l_suppkey AS STRING), 8, '0') END AS winner_ico,
  CAST(CAST(o.o_orderdate AS DATE) AS STRING) AS awarded, g.price_contracted, g.price_paid,
  CASE WHEN p.p_size % 3 = 0 THEN '45210000' ELSE '33' || lpad(CAST(p.p_size AS STRING), 3, '0') || '000' END AS cpv_text,
  CASE WHEN o.o_orderpriority = '2-HIGH' THEN NULL ELSE CAST(p.p_size AS INT) END AS dist_km,
  o.o_orderpriority = '2-HIGH' AS loc_unknown
FROM (SELECT l_orderkey, l_suppkey, min(l_partkey) AS pk,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) AS price_contracted,
        CASE WHEN min(l_linestatus) = 'F' THEN
          CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) * (1 + CAST(l_tax AS DECIMAL(4,2)))) AS DOUBLE)
        END AS price_paid
      FROM {lineitem} GROUP BY l_orderkey, l_suppkey) g
JOIN {orders} o ON o.o_orderkey = g.l_orderkey
JOIN {part} p ON p.p_partkey = g.pk""",
    # one row per contract version; returned lines are amendments of the order's contract
    "contract_v": """
SELECT CASE WHEN g.flag = 'R' THEN 'a' || CAST(g.l_orderkey AS STRING) || '-' || CAST(g.l_linenumber AS STRING)
            ELSE CAST(g.l_orderkey AS STRING) END AS id,
  CAST(g.l_linenumber AS STRING) AS verze, 'https://example.org/c/' || CAST(g.l_orderkey AS STRING) AS url,
  g.status = 'O' OR g.l_linenumber < 7 AS platny, lpad(CAST(o.o_custkey AS STRING), 8, '0') AS ico_zadavatel,
  lpad(CAST(g.supp AS STRING), 8, '0') AS party_ico, 'Supplier ' || CAST(g.supp AS STRING) AS party_name,
  p.p_name || ' ' || p.p_type AS predmet, CAST(g.shipped AS STRING) AS datum, g.price AS hodnota,
  CASE WHEN g.flag = 'R' THEN CAST(g.l_orderkey AS STRING) END AS parent,
  g.l_orderkey * 8 + g.l_linenumber AS ord, CAST(year(g.shipped) AS INT) AS dump
FROM (SELECT l_orderkey, l_linenumber, min(l_suppkey) AS supp, min(l_partkey) AS pk, min(l_returnflag) AS flag,
        min(l_linestatus) AS status, min(CAST(l_shipdate AS DATE)) AS shipped, max(l_extendedprice) AS price
      FROM {lineitem} GROUP BY l_orderkey, l_linenumber) g
JOIN {orders} o ON o.o_orderkey = g.l_orderkey
JOIN {part} p ON p.p_partkey = g.pk""",
    "probe_v": """
SELECT 'u' || CAST(user_id AS STRING) AS id, event_id AS run,
  CASE event_type WHEN 'error' THEN 404 WHEN 'view' THEN NULL ELSE 200 END AS code
FROM {events}""",
    "pref_v": """
SELECT CASE event_type WHEN 'click' THEN 'watch' WHEN 'view' THEN 'hidden' ELSE 'dislikes' END AS kind,
  'rvz:' || CAST(user_id AS STRING) AS id, event_id AS ts, value > 30 AS switched_on
FROM {events} WHERE event_type IN ('click', 'view', 'purchase')""",
    "verdict_v": """
SELECT 'rvz:' || CAST(doc_id AS STRING) AS id,
  CASE WHEN toxic = 1 THEN 'nejisto' WHEN quality = 1 THEN 'ano' ELSE 'ne' END AS verdikt
FROM {labels}""",
    "title_v": "SELECT doc_id AS id, text AS title FROM {documents}",
    "gazetteer_v": """
SELECT * FROM (VALUES ('Red', 50.30, 15.90), ('Red Ring', 50.10, 15.10), ('Blue Bolt', 49.20, 16.60),
  ('Anvil', 50.21, 15.83), ('Cold', 48.90, 14.50), ('Old Rod', 50.60, 15.60), ('Gizmo', 50.05, 16.20),
  ('New Plate', 50.44, 15.35), ('Plate', 49.95, 15.27), ('The', 50.00, 15.00), ('Of the', 50.50, 15.50),
  ('Queon', 49.80, 16.40), ('Leaux', 50.25, 15.70), ('Aux', 50.22, 15.79), ('On', 50.2, 15.7)) AS t(name, lat, lon)""",
}
# the same tenders one run earlier: fewer of them, some fields different
SQL["prev_v"] = """
SELECT id, ord, title || CASE WHEN kind = 'VZMR' AND state IS NULL AND value IS NULL THEN ' II' ELSE '' END AS title,
  CASE WHEN state = 'neukončen' THEN value * 1.1 ELSE value END AS value,
  CASE WHEN source = 'isvz' THEN NULL ELSE deadline END AS deadline,
  site_visit, CASE WHEN month(CAST(published AS DATE)) <= 6 THEN 0 ELSE clarifications END AS clarifications,
  state, source, cpv_text, url, kind, authority_ico, published
FROM tender_v WHERE published < '2000-09-01'"""


def oracle(body: str, *names: str) -> str:
    """DuckDB text: the named views as CTEs in front of the query."""
    needed = []
    for n in names:
        if n == "prev_v" and "tender_v" not in names:
            needed.append("tender_v")
        needed.append(n)
    ctes = [f"{n} AS ({SQL[n]})" for n in dict.fromkeys(needed)]
    recursive = "WITH RECURSIVE " if "UNION ALL" in body and "FROM fold" in body else "WITH "
    text = (recursive + ",\n".join(ctes) + "\n" if ctes else "") + body.strip()
    for t in TABLES:
        text = text.replace("{" + t + "}", t)
    return text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str, part: int = 0, parts: int = 1) -> DataFrame:
    """The view as a DataFrame, with arrays and structs in place of joined text; of the views over the lines
    of orders also the rows of one part of the orders only."""
    text = SQL[name]
    frames = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    if parts > 1:
        for t, key in (("lineitem", "l_orderkey"), ("orders", "o_orderkey")):
            frames[t] = frames[t].where(F.pmod(F.xxhash64(key), F.lit(parts)) == part)
    if name in ("competition_v", "contract_v"):
        # lines are grouped by order and more, then joined with their order: one exchange serves both
        frames["lineitem"] = frames["lineitem"].repartition("l_orderkey")
    if name == "prev_v":
        base = spark.sql(SQL["tender_v"], **{t: table(spark, sf_dir, t) for t in ("orders", "lineitem", "part")})
        df = spark.sql(text.replace("FROM tender_v", "FROM {base}"), base=base)
    else:
        df = spark.sql(text, **frames)
    for joined, name_ in (("cpv_text", "cpv"), ("nuts_text", "nuts")):
        if joined in df.columns:
            parts = F.filter(F.split(joined, r"\|"), lambda x: x != "")
            df = df.withColumn(name_, parts).drop(joined)
    if "party_ico" in df.columns:
        df = df.withColumn("parties", F.array(F.struct(
            F.col("party_ico").alias("ico"), F.col("party_name").alias("nazev")
        ))).drop("party_ico", "party_name")
    if "switched_on" in df.columns:
        df = df.withColumnRenamed("switched_on", "on")
    return df


def stored(spark: SparkSession, sf_dir: str, name: str, of, label: str) -> DataFrame:
    """What ``of`` takes from a view over the lines of orders, written once. Many lines are taken a part of the
    orders at a time, so the shuffle files of one part at a time are on disk."""
    parts = max(1, math.ceil(table(spark, sf_dir, "lineitem").count() / PASS_LINES))
    return reduce(DataFrame.unionByName, [materialize(of(view(spark, sf_dir, name, i, parts)), label) for i in range(parts)])


QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, *names: str, key: str | None = None):
    """Register a query and, where SQL can say the same, its counterpart."""

    def register(fn):
        k = key or fn.__name__
        QUERIES[k] = fn
        if sql is not None:
            ORACLES[k] = oracle(sql, *names)
        return fn

    return register
