"""Awards, contracts, amendments and rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.views import TODAY, query, stored, view
from tenderloom import Settings
from tenderloom.functions import numbers as nm
from tenderloom.functions import text as tx
from tenderloom.materialize import materialize
from tenderloom.operators import competition as cp
from tenderloom.operators import filters as fl
from tenderloom.operators import linking as ln
from tenderloom.schemas import LINK

CAND_SQL = """
cand AS (SELECT t.id AS tender_id, CAST(t.awarded AS DATE) AS awarded, t.price_contracted, c.id AS contract_id, c.verze, c.url,
   CAST(c.datum AS DATE) AS signed, c.hodnota, c.ord, c.dump
 FROM competition_v t JOIN contract_v c ON c.ico_zadavatel = t.authority_ico AND c.party_ico = t.winner_ico
  AND CAST(c.datum AS DATE) BETWEEN CAST(t.awarded AS DATE) - 30 AND CAST(t.awarded AS DATE) + 120
 WHERE c.platny AND c.parent IS NULL AND t.authority_ico <> '' AND t.winner_ico <> '')"""
_BEST_STEP = """
{n}newest AS (SELECT tender_id, contract_id, min(ord) AS ord, arg_max(price_contracted, CAST(verze AS INT)) AS pc,
   arg_max(hodnota, CAST(verze AS INT)) AS hodnota, arg_max(signed, CAST(verze AS INT)) AS signed, arg_max(url, CAST(verze AS INT)) AS url
  FROM cand {where} GROUP BY tender_id, contract_id),
{n}scored AS (SELECT *, CASE WHEN pc <> 0 AND hodnota <> 0 THEN abs(hodnota - pc) / pc END AS diff FROM {n}newest),
{n}best AS (SELECT *, CASE WHEN count(*) FILTER (diff <= 0.15) OVER (PARTITION BY tender_id) = 1 THEN 'high' ELSE 'low' END AS confidence
  FROM {n}scored QUALIFY row_number() OVER (PARTITION BY tender_id ORDER BY diff IS NULL, coalesce(diff, 0), ord, contract_id) = 1)"""
BEST_SQL = _BEST_STEP.format(n="", where="")


@query(f", {CAND_SQL} SELECT tender_id, contract_id, verze, signed, hodnota FROM cand", "competition_v", "contract_v")
def contract_candidates(spark, sf):
    pairs = ln.contract_candidates(view(spark, sf, "competition_v"), view(spark, sf, "contract_v"))
    return pairs.select("tender_id", "contract_id", "verze", "signed", "hodnota")


@query(f""", {CAND_SQL}, {BEST_SQL}
SELECT tender_id, contract_id, url, signed AS date, hodnota AS price, confidence FROM best""", "competition_v", "contract_v")
def contract_best_match(spark, sf):
    return ln.contract_matches(view(spark, sf, "competition_v"), view(spark, sf, "contract_v"))


def _matches(spark, sf, condition):
    contracts = view(spark, sf, "contract_v").where(condition)
    return ln.contract_matches(view(spark, sf, "competition_v"), contracts)


_TWO = (_BEST_STEP.format(n="a_", where="WHERE dump < 1998") + "," + _BEST_STEP.format(n="b_", where="WHERE dump >= 1998") + """,
upserted AS (SELECT coalesce(a.tender_id, b.tender_id) AS tender_id,
   CASE WHEN b.tender_id IS NULL OR coalesce(a.confidence = 'high' AND (a.contract_id <> b.contract_id OR b.confidence = 'low'), false)
     THEN {'contract_id': a.contract_id, 'url': a.url, 'date': a.signed, 'price': a.hodnota, 'confidence': a.confidence}
     ELSE {'contract_id': b.contract_id, 'url': b.url, 'date': b.signed, 'price': b.hodnota, 'confidence': b.confidence} END AS l
  FROM a_best a FULL JOIN b_best b ON a.tender_id = b.tender_id),
links AS (SELECT tender_id, l.contract_id AS contract_id, l.url AS url, l.date AS date, l.price AS price, l.confidence AS confidence FROM upserted)""")
_UNIQUE = """
lows AS (SELECT l.tender_id, l.contract_id,
   row_number() OVER (PARTITION BY l.contract_id ORDER BY
     CASE WHEN c.price_contracted <> 0 AND l.price <> 0 THEN abs(l.price - c.price_contracted) / c.price_contracted ELSE 9e9 END,
     abs(date_diff('day', CAST(c.awarded AS DATE), l.date)), l.tender_id) AS rn
  FROM {src} l JOIN competition_v c ON c.id = l.tender_id WHERE l.confidence = 'low'),
{out} AS (SELECT * FROM {src} WHERE confidence = 'high' UNION ALL
  SELECT l.* FROM {src} l JOIN lows USING (tender_id, contract_id) WHERE l.confidence = 'low' AND rn = 1)"""


@query(f", {CAND_SQL}, {_TWO} SELECT * FROM links", "competition_v", "contract_v")
def link_upsert(spark, sf):
    return ln.link_upsert(_matches(spark, sf, "dump < 1998"), _matches(spark, sf, "dump >= 1998"))


@query(f", {CAND_SQL}, {BEST_SQL}, links AS (SELECT tender_id, contract_id, url, signed AS date, hodnota AS price, confidence FROM best), "
       f"{_UNIQUE.format(src='links', out='kept')} SELECT * FROM kept", "competition_v", "contract_v")
def one_contract_per_low_link(spark, sf):
    links = _matches(spark, sf, "true")
    return ln.one_contract_per_low_link(links, view(spark, sf, "competition_v"))


@query(f", {CAND_SQL}, {BEST_SQL} SELECT count(*) AS linked, count(*) FILTER (confidence = 'high') AS high, "
       "count(*) FILTER (confidence = 'low') AS low FROM best", "competition_v", "contract_v")
def link_confidence_counts(spark, sf):
    return ln.link_confidence_counts(_matches(spark, sf, "true"))


AMEND_SQL = """
amend AS (SELECT parent AS contract_id, id AS amendment_id, arg_max(datum, ord) AS date, arg_max(hodnota, ord) AS value
  FROM contract_v WHERE platny AND parent IS NOT NULL GROUP BY parent, id),
kept AS (SELECT *, row_number() OVER (PARTITION BY contract_id ORDER BY coalesce(date, ''), amendment_id) AS n FROM amend QUALIFY n <= 2),
totals AS (SELECT contract_id, count(*) AS amendments_count, round(sum(value), 2) AS amendments_total,
  string_agg(amendment_id, ' ' ORDER BY n) AS ids FROM kept GROUP BY contract_id)"""


@query("""
SELECT parent AS contract_id, id AS amendment_id, substr(datum, 1, 10) AS date,
  CASE WHEN ord % 3 = 0 THEN hodnota + 1 ELSE hodnota END AS value, url
FROM contract_v WHERE platny AND parent IS NOT NULL QUALIFY row_number() OVER (PARTITION BY parent, id ORDER BY ord DESC) = 1""", "contract_v")
def latest_amendments(spark, sf):
    # a third of the amendments come again, in a later dump and with another value
    rows = ln.amendment_rows(view(spark, sf, "contract_v"))
    later = rows.where("ord % 3 = 0").withColumns({"ord": F.col("ord") + (1 << 53), "value": F.col("value") + 1})
    return ln.latest_amendments(rows.unionByName(later)).drop("ord")


@query(f""", {CAND_SQL}, {BEST_SQL}, {AMEND_SQL}
SELECT b.tender_id, b.contract_id, coalesce(t.amendments_count, 0) AS amendments_count,
  coalesce(t.amendments_total, 0) AS amendments_total, coalesce(t.ids, '') AS ids
FROM best b LEFT JOIN totals t USING (contract_id)""", "competition_v", "contract_v")
def amendment_attach(spark, sf):
    contracts = view(spark, sf, "contract_v")
    attached = ln.amendment_attach(_matches(spark, sf, "true"), ln.amendment_rows(contracts), Settings(max_amendments=2))
    ids = F.array_join(F.transform("amendments", lambda a: a["id"]), " ")
    return attached.select("tender_id", "contract_id", "amendments_count", "amendments_total", F.coalesce(ids, F.lit("")).alias("ids"))


def _fold_sql(first: int, last: int) -> str:
    """The dump-by-dump fold, unrolled."""
    parts, prev = [], None
    for y in range(first, last + 1):
        p = f"y{y}_"
        parts.append(_BEST_STEP.format(n=p, where=f"WHERE dump = {y}"))
        fresh = f"(SELECT tender_id, contract_id, url, signed AS date, hodnota AS price, confidence FROM {p}best)"
        if prev is None:
            parts.append(f"{p}up AS (SELECT * FROM {fresh})")
        else:
            cols = ("contract_id", "url", "date", "price", "confidence")
            old = ("b.tender_id IS NULL OR coalesce(a.confidence = 'high' AND (a.contract_id <> b.contract_id OR b.confidence = 'low'), false)")
            sel = ", ".join(f"CASE WHEN {old} THEN a.{c} ELSE b.{c} END AS {c}" for c in cols)
            parts.append(f"{p}up AS (SELECT coalesce(a.tender_id, b.tender_id) AS tender_id, {sel} FROM {prev} a FULL JOIN {fresh} b ON a.tender_id = b.tender_id)")
        parts.append(_UNIQUE.format(src=p + "up", out=p + "kept").replace("lows", p + "lows"))
        prev = p + "kept"
    return ",".join(parts), prev


_FOLD, _LAST = _fold_sql(1995, 2001)


@query(f", {CAND_SQL}, {_FOLD} SELECT tender_id, contract_id, date, price, confidence FROM {_LAST}", "competition_v", "contract_v")
def contract_link_fold(spark, sf):
    contracts = view(spark, sf, "contract_v")
    links = ln.link_dumps(view(spark, sf, "competition_v"), contracts, spark.createDataFrame([], LINK))
    return links.select("tender_id", "contract_id", "date", "price", "confidence")


_SIG = r"list_filter(string_split(regexp_replace({}, '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '), lambda w: length(w) > 3)"


@query(f""",
specs AS (SELECT id, authority_ico AS buyer, CAST(substr(deadline, 1, 10) AS DATE) AS d, list_distinct({_SIG.format('title')}) AS toks
  FROM tender_v WHERE deadline IS NOT NULL AND url IS NOT NULL AND date_diff('day', CAST(substr(deadline, 1, 10) AS DATE), DATE '{TODAY}') BETWEEN 0 AND 120),
hits AS (SELECT s.id, c.* EXCLUDE (id), c.id AS contract_id FROM specs s JOIN contract_v c ON c.ico_zadavatel = s.buyer
   AND CAST(c.datum AS DATE) BETWEEN s.d AND s.d + 90
  WHERE c.platny AND c.parent IS NULL AND len(s.toks) > 0
    AND len(list_intersect(s.toks, {_SIG.format('lower(c.predmet)')})) * 2 >= len(s.toks))
SELECT id, contract_id, CAST(datum AS DATE) AS date, hodnota AS price, party_name AS supplier FROM hits
QUALIFY row_number() OVER (PARTITION BY id ORDER BY ord, contract_id) = 1""", "tender_v", "contract_v")
def watched_contract_match(spark, sf):
    t = view(spark, sf, "tender_v")
    specs = ln.watch_specs(t, t.where("url IS NOT NULL"), TODAY)
    return ln.watched_contract_match(specs, view(spark, sf, "contract_v")).drop("url")


# --- prices and rankings -----------------------------------------------------
_EFF = f"""{CAND_SQL}, {BEST_SQL}, {AMEND_SQL.replace('n <= 2', 'n <= 30')},
eff AS (SELECT c.*, coalesce(t.amendments_total, 0) AS am, (b.tender_id IS NOT NULL) AS linked FROM competition_v c
  LEFT JOIN best b ON b.tender_id = c.id LEFT JOIN totals t ON t.contract_id = b.contract_id),
priced AS (SELECT *, price_contracted + am AS eff_price,
   CASE WHEN price_contracted <> 0 THEN floor((coalesce(price_paid, CASE WHEN am <> 0 THEN price_contracted + am END) / price_contracted - 1) * 1000 + 0.5) / 10 END AS eff_growth
  FROM eff)"""


def _priced(spark, sf, *columns):
    """The awards (these columns of them, or all) with amendments. Awards, contracts, links and totals are stored
    one after the other: the awards are made once for both of their uses, and a step's shuffle files are freed
    before the next step writes its own."""
    wanted = [F.col(c) for c in dict.fromkeys((*_AWARD, *columns))] if columns else ["*"]
    competition = stored(spark, sf, "competition_v", lambda v: v.select(*wanted), "competition")
    contracts = stored(spark, sf, "contract_v", ln.signed_contracts, "contracts")
    links = materialize(ln.contract_matches(competition, contracts, stored=True), "links")
    amendments = stored(spark, sf, "contract_v", lambda v: ln.amendment_rows(v).drop("url").withColumn(
        "url", F.lit(None).cast("string")), "amendments")
    attached = ln.amendment_attach(links, amendments)
    return cp.with_amendments(competition, materialize(attached.select("tender_id", "amendments_total"), "totals"))


_AWARD = ("id", "authority_ico", "winner_ico", "awarded", "price_contracted", "price_paid")


@query(f", {_EFF} SELECT id, round(eff_price, 2) AS eff_price, eff_growth + 0.0 AS eff_growth FROM priced", "competition_v", "contract_v")
def effective_price(spark, sf):
    return _priced(spark, sf, "id").select("id", F.round("eff_price", 2).alias("eff_price"), (F.col("eff_growth") + F.lit(0.0)).alias("eff_growth"))


@query("""
SELECT id, CASE WHEN price_contracted <> 0 THEN floor((price_paid / price_contracted - 1) * 1000 + 0.5) / 10 END + 0.0 AS growth FROM competition_v""",
       "competition_v")
def effective_growth(spark, sf):
    growth = nm.effective_growth("price_contracted", "price_paid", F.lit(0.0))
    return view(spark, sf, "competition_v").select("id", (growth + F.lit(0.0)).alias("growth"))


@query(f""", {_EFF}
SELECT id, awarded, round(eff_price, 2) AS eff_price FROM priced
WHERE contains(lower(title || ' ' || winner || ' ' || authority || ' ' || winner_ico), 'ring')
  AND awarded >= '1996-01-01' AND awarded <= '2000-12-31' AND cpv_text <> '45210000'
  AND (loc_unknown OR coalesce(dist_km <= 25, false)) AND eff_price / 1e6 >= 0.02 AND eff_price / 1e6 <= 0.2""",
       "competition_v", "contract_v")
def competition_filter(spark, sf):
    awards = _priced(spark, sf)
    # records of one CPV group stand for the rejected ones
    rejected = F.when(F.exists("cpv", lambda c: c == "45210000"), F.lit("x"))
    return cp.competition_filter(
        awards.withColumn("reason", rejected), query="RING", date_from="1996-01-01", date_to="2000-12-31",
        max_km=25, low_m=0.02, high_m=0.2,
    ).select("id", "awarded", F.round("eff_price", 2).alias("eff_price"))


@query(f""", {_EFF},
firms AS (SELECT coalesce(nullif(winner_ico, ''), winner) AS firm, arg_min(winner, awarded || lpad(id, 30, ' ')) AS name,
   nullif(min(winner_ico), '') AS ico, count(*) AS n, sum(CAST(eff_price AS DECIMAL(18,2))) AS v FROM priced WHERE winner <> '' GROUP BY 1)
SELECT firm, ico, n, round(CAST(v AS DOUBLE), 2) AS volume,
  CAST(greatest(2, floor(CAST(v AS DOUBLE) / (SELECT CAST(max(v) AS DOUBLE) FROM firms) * 100 + 0.5)) AS INT) AS bar_pct,
  (SELECT round(CAST(sum(v) AS DOUBLE), 0) FROM firms) AS grand_total
FROM firms ORDER BY v DESC, firm LIMIT 10""", "competition_v", "contract_v")
def top_firms(spark, sf):
    top = cp.top_firms(_priced(spark, sf, "winner"))
    return top.select("firm", "ico", "n", F.round("volume", 2).alias("volume"), "bar_pct", F.round("grand_total", 0).alias("grand_total"))


@query(f""",
{CAND_SQL}
SELECT 'firms' AS list, id FROM (SELECT id FROM competition_v ORDER BY price_contracted DESC, id LIMIT 10)
UNION ALL SELECT 'details', id FROM (SELECT id FROM tender_v WHERE source = 'isvz' ORDER BY ord LIMIT 50)
UNION ALL SELECT 'changes', id FROM (SELECT id FROM tender_v QUALIFY row_number() OVER (PARTITION BY authority_ico ORDER BY published DESC, ord) <= 2)""",
       "competition_v", "contract_v", "tender_v")
def top_k(spark, sf):
    c, t = view(spark, sf, "competition_v"), view(spark, sf, "tender_v")
    firms = fl.top_k(c, [F.desc("price_contracted"), F.col("id")], 10).select(F.lit("firms").alias("list"), "id")
    details = fl.top_k(t.where("source = 'isvz'"), [F.col("ord")], 50).select(F.lit("details").alias("list"), "id")
    newest = [F.desc("published"), F.col("ord")]
    changes = fl.top_k(t, newest, 2, ["authority_ico"]).select(F.lit("changes").alias("list"), "id")
    return firms.unionByName(details).unionByName(changes)


@query(f"""
SELECT t.id, c.id AS contract_id, len(list_intersect({_SIG.format('t.title')}, {_SIG.format('lower(c.predmet)')})) AS common_words
FROM competition_v t JOIN contract_v c ON c.id = CAST(t.ord AS STRING) AND c.party_ico = t.winner_ico""", "competition_v", "contract_v")
def set_overlap(spark, sf):
    t, c = view(spark, sf, "competition_v"), view(spark, sf, "contract_v")
    pairs = t.select("id", "title", "winner_ico", F.col("ord").cast("string").alias("key")).join(
        c.select(F.col("id").alias("contract_id"), "parties", "predmet"), F.col("key") == F.col("contract_id")
    ).where(F.arrays_overlap(F.array("winner_ico"), F.transform("parties", lambda p: p["ico"])))
    common = tx.set_overlap(tx.sig_tokens("title"), tx.sig_tokens("predmet")).cast("bigint")
    return pairs.select("id", "contract_id", common.alias("common_words"))
