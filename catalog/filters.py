"""Predicates, flags, orderings and list filters."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from catalog.views import TODAY, query, table, view
from tenderloom import Settings
from tenderloom.materialize import materialize
from tenderloom.operators import competition as cp
from tenderloom.operators import dashboard as db
from tenderloom.operators import dedup as dd
from tenderloom.operators import filters as fl
from tenderloom.operators import relevance as rl
from tenderloom.operators import verdicts as vd

# stems that occur in the test texts; the shipped lists are Czech
POSITIVE, NEGATIVE = ("ring", "blue wid", "gea", "thed", "queon"), ("old ", "new r", "onthe")
WORDS = replace(Settings(), keywords_positive=POSITIVE, keywords_negative=NEGATIVE)
_PADDED = r"' ' || regexp_replace(lower(strip_accents({})), '[^\p{{L}}\p{{N}}]', ' ', 'g') || ' '"


def _kw_sql(text: str) -> tuple[str, str]:
    padded = _PADDED.format(text)
    pos = "regexp_matches(" + padded + ", ' (ring|blue wid|gea|thed|queon)')"
    neg = "regexp_matches(" + padded + ", ' (old |new r|onthe)')"
    return pos, neg


_POS, _NEG = _kw_sql("text")


@query(f"SELECT doc_id, {_POS} AND NOT {_NEG} AS hit FROM documents")
def kw_match(spark, sf):
    return table(spark, sf, "documents").select("doc_id", fl.kw_match("text", WORDS).alias("hit"))


@query(f"SELECT doc_id, {_NEG} AS veto FROM documents")
def kw_negative(spark, sf):
    return table(spark, sf, "documents").select("doc_id", fl.kw_negative("text", WORDS).alias("veto"))


_TPOS, _TNEG = _kw_sql("coalesce(title, '')")
_CODES = "list_filter(string_split(cpv_text, '|'), lambda x: x <> '')"
_SECTOR_CODE = ("len(list_filter(codes, lambda c: starts_with(c, '45') AND NOT regexp_matches(c, "
                "'^(45221|45231|45232|45233|45234)'){}))>0")
_TRUSTED = "(starts_with(source, 'profil:') AND NOT starts_with(source, 'profil:pvu:') AND source <> 'profil:john-nell-baby')"
SECTOR_SQL = f"""
coded AS (SELECT *, {_CODES} AS codes, list_filter(string_split(nuts_text, '|'), lambda x: x <> '') AS regions FROM tender_v),
judged AS (SELECT *,
  {_SECTOR_CODE.format('')} AND (NOT {_TNEG} OR {_SECTOR_CODE.format(" AND NOT starts_with(c, '450000')")}) AS by_code,
  {_TPOS} AND NOT {_TNEG} AS by_word, {_TRUSTED} AS trusted FROM coded),
sector AS (SELECT *, by_word AND NOT by_code AS kw_match FROM judged WHERE by_code OR by_word OR (trusted AND len(codes) = 0))"""
REGION_SQL = """
region_ok AS (SELECT *, len(regions) = 0 AND NOT trusted AS no_nuts FROM {src}
  WHERE len(regions) = 0 OR len(list_filter(regions, lambda n: substr(n, 1, 5) IN ('CZ052','CZ053','CZ020','CZ051','CZ063'))) > 0)"""
DONE_SQL = "coalesce(regexp_matches(lower(strip_accents(state)), '^(dokoncen|zrusen|ukoncen|zadan)'), false)"
LIST_SQL = "coalesce(nullif(deadline, ''), '9999'), coalesce(published, ''), ord"
EXPIRED_SQL = f"(coalesce(substr(deadline, 1, 10) < '{TODAY}', false) OR {DONE_SQL})"


@query(f", {SECTOR_SQL} SELECT id, kw_match FROM sector", "tender_v")
def sector_filter(spark, sf):
    return fl.sector_filter(view(spark, sf, "tender_v"), WORDS).select("id", "kw_match")


@query(f", {SECTOR_SQL}, {REGION_SQL.format(src='judged')} SELECT id, no_nuts FROM region_ok", "tender_v")
def region_filter(spark, sf):
    return fl.region_filter(view(spark, sf, "tender_v"), WORDS).select("id", "no_nuts")


@query("SELECT id, value IS NULL AS no_value FROM tender_v WHERE value IS NULL OR value >= 2000000", "tender_v")
def value_filter(spark, sf):
    return fl.value_filter(view(spark, sf, "tender_v")).select("id", "no_value")


@query(f"SELECT id, {EXPIRED_SQL} AS expired FROM tender_v", "tender_v")
def mark_expired(spark, sf):
    return fl.mark_expired(view(spark, sf, "tender_v"), TODAY).select("id", "expired")


SCORE_SQL = """2 * (deadline IS NOT NULL)::INT + 2 * (value IS NOT NULL)::INT + (cpv_text <> '')::INT + (place IS NOT NULL)::INT
 + (state IS NOT NULL)::INT + 1 + (url IS NOT NULL)::INT + (nuts_text <> '')::INT"""


@query(f"SELECT id, {SCORE_SQL} AS score FROM tender_v", "tender_v")
def info_score(spark, sf):
    t = view(spark, sf, "tender_v")
    return t.select("id", dd.info_score(t).alias("score"))


@query("SELECT id, coalesce(published > '1998-05-25', false) AS new FROM tender_v", "tender_v")
def is_new(spark, sf):
    return view(spark, sf, "tender_v").select("id", db.is_new("1998-05-25").alias("new"))


@query("SELECT id, deadline, published FROM tender_v", "tender_v")
def tender_order(spark, sf):
    return db.tender_order(view(spark, sf, "tender_v")).select("id", "deadline", "published")


@query("SELECT id, awarded FROM competition_v", "competition_v")
def competition_order(spark, sf):
    return cp.competition_order(view(spark, sf, "competition_v")).select("id", "awarded")


# --- preferences, verdicts and the dashboard ---------------------------------
PREF_SQL = """
merged AS (SELECT kind, id, max(ts) AS ts, arg_max(switched_on, ts) AS switched_on FROM pref_v GROUP BY kind, id),
watched AS (SELECT id FROM merged WHERE kind = 'watch' AND switched_on),
hidden AS (SELECT id FROM merged WHERE kind = 'hidden' AND switched_on),
disliked AS (SELECT id FROM merged WHERE kind = 'dislikes' AND switched_on)"""


@query(f", {PREF_SQL} SELECT kind, id, ts, switched_on AS is_on FROM merged", "pref_v")
def lww_preference_merge(spark, sf):
    merged = rl.lww_preference_merge(view(spark, sf, "pref_v"))
    return merged.select("kind", "id", "ts", F.col("on").alias("is_on"))


MODEL_SQL = f"""
base AS (SELECT id, coalesce(authority_ico, '') AS ico, title, {_CODES} AS codes FROM tender_v),
words AS (SELECT id, unnest(list_distinct(list_filter(string_split(title, ' '), lambda w: length(w) >= 4))) AS token FROM tender_v),
common AS (SELECT token FROM words GROUP BY token HAVING count(*) > (SELECT greatest(4, floor(count(*) * 0.01 + 0.5)) FROM tender_v)),
toks AS (SELECT id, token FROM words WHERE token NOT IN (SELECT token FROM common)),
groups AS (SELECT DISTINCT id, substr(c, 1, 4) AS g FROM (SELECT id, unnest(codes) AS c FROM base)),
model AS (SELECT kind, key, count(*) AS n FROM (
  SELECT 'cpv' AS kind, g AS key FROM groups WHERE id IN (SELECT id FROM disliked)
  UNION ALL SELECT 'ico', ico FROM base WHERE id IN (SELECT id FROM disliked)
  UNION ALL SELECT 'tok', token FROM toks WHERE id IN (SELECT id FROM disliked)) WHERE key <> '' GROUP BY kind, key)"""
REASON_SQL = """
core AS (SELECT id, len(list_filter(codes, lambda c: starts_with(c, '45'))) > 0 AS core FROM base),
reasons AS (SELECT b.id, CASE
   WHEN b.id IN (SELECT id FROM disliked) THEN 'odmítnuto 👎'
   WHEN b.id IN (SELECT id FROM watched) THEN NULL
   WHEN NOT k.core AND c.g IS NOT NULL THEN 'odhad: CPV ' || c.g || '* odmítnuto ' || c.n || '×'
   WHEN NOT k.core AND i.n >= 3 THEN 'odhad: zadavatel odmítnut ' || i.n || '×'
   WHEN t.n >= 2 THEN 'odhad: název podobný odmítnutým (' || t.words || ')' END AS reason
 FROM base b JOIN core k USING (id)
 LEFT JOIN (SELECT id, arg_min(g, g) AS g, arg_min(n, g) AS n FROM groups JOIN model m ON m.kind = 'cpv' AND m.key = g AND m.n >= 2 GROUP BY id) c ON c.id = b.id
 LEFT JOIN model i ON i.kind = 'ico' AND i.key = b.ico
 LEFT JOIN (SELECT id, count(*) AS n, string_agg(token, ', ' ORDER BY token) AS words FROM toks JOIN model m ON m.kind = 'tok' AND m.key = token AND m.n >= 2 GROUP BY id) t ON t.id = b.id)"""


def _prefs(spark, sf):
    merged = rl.lww_preference_merge(view(spark, sf, "pref_v"))
    return {k: rl.active_preferences(merged, k) for k in rl.PREFERENCE_KINDS}


def _reasons(spark, sf, tenders, rows=None):
    prefs = _prefs(spark, sf)
    common = rl.common_words(tenders)
    fp = rl.fingerprint(tenders, common)
    disliked = fp.join(prefs["dislikes"].select("id"), "id", "left_semi")
    model = rl.dislike_model(disliked)
    rows = tenders if rows is None else rows
    return rl.irrelevance_reason(rows, rl.fingerprint(rows, common), model, prefs["dislikes"], prefs["watch"]), prefs


@query(f", {PREF_SQL}, {MODEL_SQL} SELECT kind, key, n FROM model", "tender_v", "pref_v")
def dislike_model(spark, sf):
    t = view(spark, sf, "tender_v")
    fp = rl.fingerprint(t, rl.common_words(t)).join(_prefs(spark, sf)["dislikes"].select("id"), "id", "left_semi")
    return rl.dislike_model(fp)


@query(f", {PREF_SQL}, {MODEL_SQL}, {REASON_SQL} SELECT id, reason FROM reasons WHERE reason IS NOT NULL", "tender_v", "pref_v")
def irrelevance_reason(spark, sf):
    # stored once; the rows are read for words, fingerprints and flags
    return _reasons(spark, sf, materialize(view(spark, sf, "tender_v"), "tenders"))[0]


@query("""
SELECT count(*) FILTER (verdikt = 'ano') AS ano, count(*) FILTER (verdikt = 'ne') AS ne,
  count(*) FILTER (verdikt = 'nejisto') AS nejisto FROM verdict_v""", "verdict_v")
def verdict_counts(spark, sf):
    return vd.verdict_counts(view(spark, sf, "verdict_v"))


@query(f""", todo AS (
  SELECT * FROM tender_v WHERE NOT {EXPIRED_SQL} AND id NOT IN (SELECT id FROM verdict_v) ORDER BY {LIST_SQL} LIMIT 300)
SELECT id, CAST(floor((row_number() OVER (ORDER BY {LIST_SQL}) - 1) / 25) AS INT) AS batch FROM todo""", "tender_v", "verdict_v")
def verdict_worklist(spark, sf):
    t = fl.mark_expired(view(spark, sf, "tender_v"), TODAY)
    return vd.verdict_worklist(t, view(spark, sf, "verdict_v")).select("id", "batch")


@query(f""", todo AS (
  SELECT id, ord, row_number() OVER (ORDER BY ord) AS rn FROM (
   SELECT id, ord FROM tender_v WHERE NOT {EXPIRED_SQL} AND id NOT IN (SELECT id FROM verdict_v) ORDER BY {LIST_SQL} LIMIT 300)),
accepted AS (SELECT t.id, CASE WHEN o.o_totalprice > 250000 THEN 'ano' ELSE 'ne' END AS verdikt, substr(repeat(o.o_orderpriority || ' ', 20), 1, 120) AS duvod
  FROM todo t JOIN orders o ON o.o_orderkey = t.ord WHERE o.o_orderpriority <> '1-URGENT')
SELECT * FROM accepted UNION ALL
SELECT id, verdikt, NULL FROM verdict_v WHERE id IN (SELECT id FROM tender_v) AND id NOT IN (SELECT id FROM accepted)""",
       "tender_v", "verdict_v")
def verdict_merge(spark, sf):
    tenders = fl.mark_expired(view(spark, sf, "tender_v"), TODAY)
    stored = view(spark, sf, "verdict_v").withColumn("duvod", F.lit(None).cast("string"))
    work = vd.verdict_worklist(tenders, stored)
    orders = table(spark, sf, "orders")
    verdict = F.when(F.col("o_orderpriority") == "1-URGENT", "mozna").when(F.col("o_totalprice") > 250000, "ano").otherwise("ne")
    answers = work.join(orders, work["ord"] == orders["o_orderkey"]).select(
        "id", "batch", verdict.alias("verdikt"), F.repeat(F.concat("o_orderpriority", F.lit(" ")), 20).alias("duvod")
    )
    return vd.verdict_merge(stored, answers, work, tenders)


@query(f""", {PREF_SQL}
SELECT id, verdikt FROM tender_v LEFT JOIN verdict_v USING (id)
WHERE (id IN (SELECT id FROM watched) AND NOT {EXPIRED_SQL})
   OR (NOT {EXPIRED_SQL} AND id NOT IN (SELECT id FROM hidden) AND verdikt IN ('ano', 'nejisto') AND deadline IS NOT NULL)""",
       "tender_v", "pref_v", "verdict_v")
def verdict_selection(spark, sf):
    t, p = fl.mark_expired(view(spark, sf, "tender_v"), TODAY), _prefs(spark, sf)
    return vd.verdict_selection(t, view(spark, sf, "verdict_v"), p["watch"], p["hidden"], with_unsure=True).select("id", "verdikt")


def _marked(spark, sf):
    t = materialize(fl.mark_expired(view(spark, sf, "tender_v"), TODAY), "tenders")
    reasons, prefs = _reasons(spark, sf, t)
    # distance stands for itself in the geo queries; here the number of clarifications
    located = t.withColumns({"dist_km": F.col("clarifications"), "loc_unknown": F.col("state").isNull()})
    changed = t.where(F.col("published") >= "1998-05-25").select("id")
    return db.with_marks(
        located, verdicts=view(spark, sf, "verdict_v"), watched=prefs["watch"], hidden=prefs["hidden"],
        changed=changed, reasons=reasons,
    )


_MARKED = f"""{PREF_SQL}, {MODEL_SQL}, {REASON_SQL},
marked AS (SELECT t.*, {EXPIRED_SQL} AS expired, v.verdikt, r.reason, t.id IN (SELECT id FROM watched) AS is_watched,
   t.id IN (SELECT id FROM hidden) AS is_hidden, published >= '1998-05-25' AS is_changed
 FROM tender_v t LEFT JOIN verdict_v v USING (id) LEFT JOIN reasons r USING (id))"""


@query(f""", {_MARKED}
SELECT id, kind, reason FROM marked
WHERE contains(lower(concat_ws(' ', coalesce(title, ''), authority)), 'ring') AND kind = 'VZMR'
  AND NOT (coalesce(verdikt = 'ne', false) AND NOT is_watched)
  AND (state IS NULL OR clarifications <= 2)
  AND (value IS NULL OR (value / 1e6 >= 2 AND value / 1e6 <= 9))
  AND NOT expired AND reason IS NULL AND NOT is_hidden""", "tender_v", "pref_v", "verdict_v")
def tender_list_filter(spark, sf):
    return db.tender_list_filter(
        _marked(spark, sf), query=" Ring ", kind="VZMR", max_km=2, low_m=2, high_m=9
    ).select("id", "kind", "reason")


@query(f""", {_MARKED}
SELECT count(*) FILTER (NOT expired) AS active, count(*) FILTER (NOT expired AND published > '1998-05-01') AS new,
  count(*) FILTER (is_watched) AS watched,
  count(*) FILTER (NOT expired AND date_diff('day', DATE '{TODAY}', CAST(substr(deadline, 1, 10) AS DATE)) + 1 BETWEEN 0 AND 7) AS due_week,
  count(*) FILTER (is_changed) AS changed, count(*) FILTER (reason IS NOT NULL OR is_hidden) AS hidden
FROM marked""", "tender_v", "pref_v", "verdict_v")
def stat_cards(spark, sf):
    return db.stat_cards(_marked(spark, sf), TODAY, "1998-05-01")


@query(f"""
SELECT count(*) AS total, count(*) FILTER (kind = 'VZ') AS vz, count(*) FILTER (kind = 'VZMR') AS vzmr,
  count(*) FILTER (NOT {EXPIRED_SQL}) AS active, (SELECT count(DISTINCT id) FROM probe_v) AS changed,
  (SELECT count(*) FROM competition_v) AS competition, (SELECT count(*) FROM prev_v) AS previous
FROM tender_v""", "tender_v", "probe_v", "competition_v", "prev_v")
def run_metrics(spark, sf):
    t = fl.mark_expired(view(spark, sf, "tender_v"), TODAY)
    return db.run_metrics(t, view(spark, sf, "probe_v"), view(spark, sf, "competition_v"), view(spark, sf, "prev_v"))
