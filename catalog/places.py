"""Gazetteer, location, radius and the award table built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.filters import EXPIRED_SQL, REGION_SQL, SECTOR_SQL, WORDS
from catalog.scalars import _KM, inflect_sql
from catalog.views import TODAY, query, table, view
from tenderloom.materialize import new_path
from tenderloom.operators import competition as cp
from tenderloom.operators import filters as fl
from tenderloom.operators import geo as ge
from tenderloom.sources import gazetteer as gz

_TOKENS = r"list_filter(string_split(regexp_replace(lower(strip_accents({})), '[^\p{{L}}\p{{N}}]', ' ', 'g'), ' '), lambda x: x <> '')"
# places with up to two words; second stays NULL for one-word places
GAZ_SQL = f"""
gaz AS (SELECT name, lat, lon, {_KM} AS dist, string_split(lower(name), ' ') AS w FROM gazetteer_v),
gaz_index AS (SELECT unnest({inflect_sql('w[1]')}) AS first, len(w) AS nwords,
   CASE WHEN len(w) > 1 THEN {inflect_sql('w[2]')} END AS second, lat, lon, dist FROM gaz WHERE len(w) > 1 OR length(w[1]) >= 3)"""


def match_sql(source: str, text: str, keys: str) -> str:
    return f"""
tok AS (SELECT {keys}, {_TOKENS.format(text)} AS w FROM {source}),
pos AS (SELECT DISTINCT {keys}, unnest(w) AS t, unnest(list_concat(w[2:], [''])) AS nxt FROM tok),
hit AS (SELECT {keys}, nwords, lat, lon, dist FROM pos JOIN gaz_index ON first = t
  WHERE nwords = 1 OR list_contains(second, nxt)),
matched AS (SELECT * FROM hit QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY nwords DESC, dist, lat, lon) = 1)"""


@query(f", {GAZ_SQL}, {match_sql('documents', 'text', 'doc_id')} SELECT doc_id, lat, lon, nwords FROM matched", "gazetteer_v")
def gazetteer_match(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return ge.gazetteer_match(docs, view(spark, sf, "gazetteer_v").selectExpr("name", "double(lat) lat", "double(lon) lon"), ["doc_id"])


LOCATE_SQL = f"""
texts AS (SELECT id, 0 AS prio, place AS text FROM tender_v UNION ALL SELECT id, 1, title FROM tender_v
  UNION ALL SELECT id, 3, authority_seat FROM tender_v
  UNION ALL SELECT id, 4, regexp_extract(lower(strip_accents(authority)), '^(?:statutarni )?(?:mesto|mestys|obec) (.+)$', 1) FROM tender_v),
{match_sql('(SELECT * FROM texts WHERE text IS NOT NULL)', 'text', 'id, prio')},
found AS (SELECT id, prio, dist FROM matched
  UNION ALL SELECT id, 2, {_KM} FROM (SELECT id, 50.209 AS lat, 15.833 AS lon FROM tender_v WHERE contains(nuts_text, 'CZ0521'))
  UNION ALL SELECT id, 5, {_KM} FROM (SELECT id, 50.561 AS lat, 15.913 AS lon FROM tender_v WHERE source = 'profil:trutnov')),
located AS (SELECT id, arg_min(dist, prio) AS dist FROM found GROUP BY id)"""


def _gaz(spark, sf):
    return view(spark, sf, "gazetteer_v").selectExpr("name", "double(lat) lat", "double(lon) lon")


@query(f", {GAZ_SQL}, {LOCATE_SQL} SELECT id, round(dist, 6) AS dist FROM located", "tender_v", "gazetteer_v")
def locate(spark, sf):
    return ge.locate(view(spark, sf, "tender_v"), _gaz(spark, sf)).select("id", F.round("dist_exact", 6).alias("dist"))


@query(f""", {GAZ_SQL}, {LOCATE_SQL}
SELECT t.id, CAST(round_even(dist, 0) AS INT) AS dist_km, dist IS NULL AS loc_unknown, coalesce(dist > 50, false) AS dropped
FROM tender_v t LEFT JOIN located USING (id)""", "tender_v", "gazetteer_v")
def radius_filter(spark, sf):
    t = view(spark, sf, "tender_v")
    distances = ge.locate(t, _gaz(spark, sf))
    result = ge.radius_filter(t.select("id"), distances)
    far = result.dropped.join(distances, "id").select(
        "id", F.bround("dist_exact", 0).cast("int").alias("dist_km"), F.lit(False).alias("loc_unknown"), F.lit(True).alias("dropped")
    )
    return result.kept.withColumn("dropped", F.lit(False)).unionByName(far)


@query(f""", {GAZ_SQL}, {LOCATE_SQL}
SELECT t.id, CASE WHEN state IS NULL THEN 7 ELSE CAST(round_even(dist, 0) AS INT) END AS dist_km,
  CASE WHEN state IS NULL THEN false ELSE dist IS NULL END AS loc_unknown
FROM tender_v t LEFT JOIN located USING (id) WHERE state IS NULL OR dist IS NULL OR dist <= 50""", "tender_v", "gazetteer_v")
def relocate_unknown(spark, sf):
    known = F.col("state").isNull()
    archive = view(spark, sf, "tender_v").withColumns({
        "dist_km": F.when(known, 7).cast("int"), "loc_unknown": ~known,
    })
    return ge.relocate_unknown(archive, _gaz(spark, sf)).select("id", "dist_km", "loc_unknown")


@query("""
SELECT p_name AS name, CAST(p_size AS DOUBLE) AS lat, p_retailprice AS lon FROM part WHERE p_type <> 'PROMO'""")
def scan_gazetteer_csv(spark, sf):
    raw = table(spark, sf, "part").select(
        F.col("p_name").alias("name"),
        F.when(F.col("p_type") == "PROMO", "n/a").otherwise(F.col("p_size").cast("string")).alias("lat"),
        F.col("p_retailprice").cast("string").alias("lon"),
    )
    path = new_path(spark, "gazetteer")
    raw.select(F.concat_ws(";", "name", "lat", "lon")).write.text(path)
    return gz.read_gazetteer(spark, path)


@query(f""", {GAZ_SQL}, {LOCATE_SQL}, {SECTOR_SQL}, {REGION_SQL.format(src='(SELECT * FROM sector)')},
fresh AS (SELECT r.id, r.kw_match, r.published AS awarded,
    CASE WHEN kind = 'VZ' THEN o.o_totalprice ELSE value END AS price_contracted,
    kind <> 'VZ' AND value IS NOT NULL AS estimated,
    CASE WHEN o.o_orderpriority = '5-LOW' THEN o.o_totalprice * 1.1 END AS price_paid,
    CAST(round_even(dist, 0) AS INT) AS dist_km
  FROM region_ok r JOIN orders o ON o.o_orderkey = r.ord LEFT JOIN located USING (id)
  WHERE CAST(r.published AS DATE) >= DATE '{TODAY}' - 365 AND (dist IS NULL OR dist <= 50)),
archive AS (SELECT id, kw_match, published AS awarded, value AS price_contracted, false AS estimated, CAST(NULL AS DOUBLE) AS price_paid, CAST(NULL AS INT) AS dist_km
  FROM sector WHERE published < '1998-01-01' AND id NOT IN (SELECT id FROM fresh))
SELECT id, kw_match, awarded, price_contracted, estimated, price_paid, dist_km,
  round_even((price_paid / price_contracted - 1) * 100, 1) + 0.0 AS growth_pct FROM (SELECT * FROM fresh UNION ALL SELECT * FROM archive)""",
       "tender_v", "gazetteer_v")
def build_competition(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    t = view(spark, sf, "tender_v").join(orders, F.col("ord") == F.col("o_orderkey"))
    price = F.when(F.col("kind") == "VZ", F.col("o_totalprice"))
    paid = F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_totalprice") * 1.1)
    awarded = t.withColumn("award", F.struct(
        F.col("published").alias("date"), F.lit("w").alias("winner"), F.lit("1").alias("winner_ico"),
        price.alias("price_contracted"), paid.alias("price_paid"),
    ))
    archive = t.where("published < '1998-01-01'").select(
        "id", "source", "title", "cpv", F.col("published").alias("awarded"), F.col("value").alias("price_contracted"),
        F.lit(False).alias("estimated"), F.lit(None).cast("double").alias("price_paid"), F.lit(None).cast("double").alias("growth_pct"),
    )
    built = cp.build_competition(awarded, archive, _gaz(spark, sf), TODAY, WORDS)
    return built.select(
        "id", "kw_match", "awarded", "price_contracted", "estimated", "price_paid", "dist_km",
        (F.col("growth_pct") + F.lit(0.0)).alias("growth_pct"),
    )


@query(f""", {SECTOR_SQL}, {REGION_SQL.format(src='(SELECT * FROM sector)')}
SELECT id, {EXPIRED_SQL} AS expired, value IS NULL AS no_value, kw_match, no_nuts FROM region_ok
WHERE value IS NULL OR value >= 2000000""", "tender_v")
def passes_filters(spark, sf):
    kept = fl.mark_expired(fl.passes_filters(view(spark, sf, "tender_v"), WORDS), TODAY)
    return kept.select("id", "expired", "no_value", "kw_match", "no_nuts")
