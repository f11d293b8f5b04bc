"""Text, number and record scalars."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.views import query, table, view
from tenderloom import fixed_values as fv
from tenderloom.functions import numbers as nm
from tenderloom.functions import text as tx
from tenderloom.functions.geo import haversine_km, inflect_variants
from tenderloom.operators import relevance as rl

_FOLD = "lower(strip_accents({}))"
_NORM = r"trim(regexp_replace(lower(strip_accents({})), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
_ASCII = "trim(regexp_replace(lower(strip_accents({})), '[^a-z0-9]+', ' ', 'g'))"


@query(f"SELECT doc_id, {_FOLD.format('text')} AS folded FROM documents")
def fold_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.fold_text("text").alias("folded"))


@query(f"SELECT doc_id, {_NORM.format('text')} AS norm FROM documents")
def norm_title(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.norm_title("text").alias("norm"))


@query(r"SELECT doc_id, regexp_replace(lower(strip_accents(text)), '[^\p{L}\p{N}]', ' ', 'g') AS norm FROM documents")
def norm_geo(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.norm_geo("text").alias("norm"))


@query(f"SELECT doc_id, {_ASCII.format('text')} AS norm FROM documents")
def norm_ascii(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.norm_ascii("text").alias("norm"))


@query(f"""
SELECT doc_id, len(t) AS n, array_to_string(list_sort(t), ' ') AS tokens FROM (
  SELECT doc_id, list_distinct(list_filter(string_split({_NORM.format('text')}, ' '), lambda w: length(w) > 3)) AS t
  FROM documents)""")
def sig_tokens(spark, sf):
    t = table(spark, sf, "documents").select("doc_id", F.array_sort(tx.sig_tokens("text")).alias("t"))
    return t.select("doc_id", F.size("t").cast("bigint").alias("n"), F.array_join("t", " ").alias("tokens"))


_LONG = f"list_distinct(list_filter(string_split({_ASCII.format('title')}, ' '), lambda w: length(w) >= 4))"
_DF = f"""
words AS (SELECT id, unnest({_LONG}) AS token FROM title_v),
df AS (SELECT token, count(*) AS df FROM words GROUP BY token),
lim AS (SELECT greatest(4, floor(count(*) * 0.01 + 0.5)) AS l FROM title_v)"""
_STOP = ", ".join(f"'{w}'" for w in fv.STOP_WORDS)


@query(f", {_DF} SELECT token, df FROM df", "title_v")
def document_frequency(spark, sf):
    return rl.document_frequency(view(spark, sf, "title_v"))


@query(f""", {_DF}
SELECT t.id, coalesce(string_agg(w.token, ' ' ORDER BY w.token), '') AS tokens
FROM title_v t LEFT JOIN (
  SELECT w.id, w.token FROM words w JOIN df USING (token), lim WHERE df.df <= lim.l AND w.token NOT IN ({_STOP})) w
ON w.id = t.id GROUP BY t.id""", "title_v")
def title_tokens(spark, sf):
    titles = view(spark, sf, "title_v")
    tokens = rl.title_tokens("title", rl.common_words(titles))
    return titles.select("id", F.array_join(F.sort_array(tokens), " ").alias("tokens"))


@query(r"""
, words AS (SELECT id, unnest(list_filter(string_split(title, ' '), lambda w: length(w) >= 4)) AS token FROM tender_v),
common AS (SELECT list(token) AS tokens FROM (SELECT token FROM words GROUP BY token
  HAVING count(*) > (SELECT greatest(4, floor(count(*) * 0.01 + 0.5)) FROM tender_v)))
SELECT id, coalesce(authority_ico, '') AS ico, title,
  array_to_string(list_sort(list_distinct(list_transform(list_filter(string_split(cpv_text, '|'), lambda x: x <> ''), lambda x: substr(x, 1, 4)))), '|') AS cpv4,
  coalesce(array_to_string(list_sort(list_filter(string_split(title, ' '), lambda w: length(w) >= 4
     AND NOT list_contains(common.tokens, w))), ' '), '') AS toks
FROM tender_v, common""", "tender_v")
def fingerprint(spark, sf):
    t = view(spark, sf, "tender_v")
    fp = rl.fingerprint(t, rl.common_words(t))
    return fp.select(
        "id", "fp.ico", "fp.title", F.array_join(F.array_sort("fp.cpv"), "|").alias("cpv4"),
        F.coalesce(F.array_join(F.array_sort("fp.toks"), " "), F.lit("")).alias("toks"),
    )


@query("""
SELECT l_orderkey, l_linenumber, l_extendedprice,
  CASE WHEN l_extendedprice >= 10000 THEN l_extendedprice END AS parsed FROM lineitem""")
def parse_cz_number(spark, sf):
    # the price is first written the Czech way: '68 423,46' with a no-break space
    text = F.translate(F.format_number("l_extendedprice", 2), ",.", " ,")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", tx.parse_cz_number(text).alias("parsed")
    )


@query("""
SELECT event_id, strftime(ts, '%Y-%m-%d') || CASE WHEN value > 10 THEN strftime(ts, 'T%H:%M:00') ELSE '' END AS iso
FROM events""")
def parse_cz_datetime(spark, sf):
    written = F.when(F.col("value") > 10, F.date_format("ts", "dd.MM.yyyy HH:mm")).otherwise(F.date_format("ts", "dd.MM.yyyy"))
    return table(spark, sf, "events").select("event_id", tx.parse_cz_datetime(written).alias("iso"))


@query("""
SELECT id, CASE WHEN value IS NULL OR value = 0 THEN '—'
    ELSE replace(format('{:,}', CAST(round_even(value, 0) AS BIGINT)), ',', ' ') || ' Kč' END AS value_text,
  CASE WHEN deadline IS NULL THEN '—' ELSE replace(substr(deadline, 1, 16), 'T', ' ') END AS deadline_text,
  CAST(clarifications AS STRING) AS clar_text, coalesce(title, '—') AS title_text
FROM tender_v""", "tender_v")
def format_change_value(spark, sf):
    t = view(spark, sf, "tender_v")
    return t.select(
        "id", tx.format_change_value("value", "value").alias("value_text"),
        tx.format_change_value("deadline", "deadline").alias("deadline_text"),
        tx.format_change_value("clarifications", "clarifications").alias("clar_text"),
        tx.format_change_value("title", "title").alias("title_text"),
    )


@query(r"""
SELECT id, array_to_string(list_sort(list_distinct(list_transform(c, lambda x: substr(x, 1, 4)))), '|') AS cpv4,
  array_to_string(list_sort(list_distinct(list_transform(n, lambda x: substr(x, 1, 5)))), '|') AS nuts5,
  len(list_filter(c, lambda x: starts_with(x, '45'))) > 0 AS core
FROM (SELECT id, list_filter(string_split(cpv_text, '|'), lambda x: x <> '') AS c,
             list_filter(string_split(nuts_text, '|'), lambda x: x <> '') AS n FROM tender_v)""", "tender_v")
def code_prefixes(spark, sf):
    return view(spark, sf, "tender_v").select(
        "id", F.array_join(F.array_sort(tx.code_prefixes("cpv", 4)), "|").alias("cpv4"),
        F.array_join(F.array_sort(tx.code_prefixes("nuts", 5)), "|").alias("nuts5"),
        F.exists("cpv", lambda c: c.startswith("45")).alias("core"),
    )


@query("""
SELECT id, round_even((price_paid / price_contracted - 1) * 100, 1) + 0.0 AS growth_pct FROM competition_v""", "competition_v")
def growth_pct(spark, sf):
    return view(spark, sf, "competition_v").select("id", nm.growth_pct("price_paid", "price_contracted").alias("growth_pct"))


@query("""
SELECT id, date_diff('day', DATE '1998-06-01', CAST(substr(deadline, 1, 10) AS DATE)) + 1 AS days_left,
  date_diff('day', DATE '1998-06-01', CAST(substr(deadline, 1, 10) AS DATE)) AS plain_days FROM tender_v""", "tender_v")
def days_to(spark, sf):
    today = F.lit("1998-06-01").cast("date")
    return view(spark, sf, "tender_v").select(
        "id", nm.days_to("deadline", today).cast("bigint").alias("days_left"),
        F.date_diff(nm.deadline_date("deadline"), today).cast("bigint").alias("plain_days"),
    )


_SITE = "CAST(n_nationkey % 5 AS DOUBLE) * 0.7 + 48.5 AS lat, CAST(n_nationkey AS DOUBLE) * 0.25 + 12 AS lon"
_KM = """2 * 6371.0 * asin(sqrt(power(sin((radians(lat) - radians(50.201829)) / 2), 2)
  + cos(radians(50.201829)) * cos(radians(lat)) * power(sin((radians(lon) - radians(15.780675)) / 2), 2)))"""


@query(f"SELECT n_nationkey, round({_KM}, 6) AS km FROM (SELECT n_nationkey, {_SITE} FROM nation)", key="haversine_km")
def haversine_km_query(spark, sf):
    sites = table(spark, sf, "nation").selectExpr("n_nationkey", *_SITE.split(", "))
    km = haversine_km(F.lit(fv.CENTER_LAT), F.lit(fv.CENTER_LON), "lat", "lon")
    return sites.select("n_nationkey", F.round(km, 6).alias("km"))


# the inflection rules written once more, as CASE arms
INFLECT_SQL = r"""CASE WHEN length({w}) < 3 THEN [{w}] ELSE list_distinct(list_concat([{w}],
 CASE WHEN {w} LIKE '%ec' THEN [{w}[:-3] || 'ci', {w}[:-3] || 'ce', {w}[:-3] || 'cem'] ELSE [] END,
 CASE WHEN {w} LIKE '%ek' THEN [{w}[:-3] || 'ku', {w}[:-3] || 'ka', {w}[:-3] || 'kem'] ELSE [] END,
 CASE WHEN {w} LIKE '%ce' THEN [{w} || 'mi', {w}[:-2] || 'ich', {w}[:-2] || 'im'] ELSE [] END,
 CASE WHEN {w} LIKE '%ka' THEN [{w}[:-3] || 'ce', {w}[:-2] || 'u', {w}[:-2] || 'ou'] ELSE [] END,
 CASE WHEN {w} LIKE '%a' THEN [{w}[:-2] || 'e', {w}[:-2] || 'y', {w}[:-2] || 'u', {w}[:-2] || 'ou'] ELSE [] END,
 CASE WHEN {w} LIKE '%ha' THEN [{w}[:-3] || 'ze'] ELSE [] END,
 CASE WHEN {w} LIKE '%o' THEN [{w}[:-2] || 'u', {w}[:-2] || 'a', {w}[:-2] || 'em'] ELSE [] END,
 CASE WHEN {w} LIKE '%ko' THEN [{w}[:-3] || 'ce'] ELSE [] END,
 CASE WHEN {w} LIKE '%y' THEN [{w}[:-2] || 'ach', {w}[:-2] || 'am', {w}[:-2], {w}[:-2] || 'ami'] ELSE [] END,
 CASE WHEN {w} LIKE '%i' OR {w} LIKE '%e' THEN [{w} || 'ch', {w} || 'm'] ELSE [] END,
 CASE WHEN {w} LIKE '%uv' THEN [{w}[:-3] || 'ove', {w}[:-3] || 'ova', {w}[:-3] || 'ovu'] ELSE [] END,
 CASE WHEN {w} = 'dvur' THEN ['dvore', 'dvora', 'dvorem'] ELSE [] END,
 CASE WHEN NOT regexp_matches({w}, '[aeiouy]$') THEN [{w} || 'e', {w} || 'u', {w} || 'a', {w} || 'em'] ELSE [] END)) END"""


def inflect_sql(w: str) -> str:
    return INFLECT_SQL.replace("{w}", w)


@query(f"""
SELECT word, array_to_string(list_sort({inflect_sql('word')}), ' ') AS forms FROM (
  SELECT DISTINCT unnest(string_split({_NORM.format('text')}, ' ')) AS word FROM documents) WHERE word <> ''""", key="inflect_variants")
def inflect_variants_query(spark, sf):
    words = table(spark, sf, "documents").select(F.explode(tx.tokens(tx.norm_title("text"))).alias("word")).distinct()
    return words.select("word", F.array_join(F.array_sort(inflect_variants("word")), " ").alias("forms"))
