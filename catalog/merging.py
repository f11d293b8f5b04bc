"""De-duplication, unions, history and change tracking."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.filters import EXPIRED_SQL
from catalog.views import TODAY, query, table, view
from tenderloom.operators import changes as ch
from tenderloom.operators import dedup as dd
from tenderloom.operators import filters as fl


def _by_customer(spark, sf):
    """Tenders that share an id per customer, some fields removed to be filled."""
    return view(spark, sf, "tender_v").withColumn("id", F.concat(F.lit("c"), "custkey")).drop("custkey")


# The fold written as the sequence it is: one recursive step per record of an id.
BY_ID_SQL = f""",
r AS (SELECT 'c' || custkey AS id, row_number() OVER (PARTITION BY custkey ORDER BY ord) AS n, ord, source, state, title,
        deadline, url, published, place, starts_with(source, 'profil:') AS prof, source = 'isvz' AS reg FROM tender_v),
fold AS (
  SELECT id, n, ord, source, state, title, deadline, url, published, place, prof, reg, CAST(NULL AS STRING) AS profile_url FROM r WHERE n = 1
  UNION ALL
  SELECT f.id, r.n,
    f.ord, CASE WHEN r.reg >= f.reg THEN r.source ELSE f.source END,
    CASE WHEN r.reg >= f.reg THEN r.state ELSE f.state END, CASE WHEN r.reg >= f.reg THEN r.title ELSE f.title END,
    CASE WHEN r.reg >= f.reg THEN coalesce(r.deadline, f.deadline) ELSE coalesce(f.deadline, r.deadline) END,
    CASE WHEN r.reg >= f.reg THEN coalesce(r.url, f.url) ELSE coalesce(f.url, r.url) END,
    CASE WHEN r.reg >= f.reg THEN coalesce(r.published, f.published) ELSE coalesce(f.published, r.published) END,
    CASE WHEN r.reg >= f.reg THEN coalesce(r.place, f.place) ELSE coalesce(f.place, r.place) END,
    CASE WHEN r.reg >= f.reg THEN r.prof ELSE f.prof END, r.reg OR f.reg,
    CASE WHEN r.reg >= f.reg THEN CASE WHEN f.prof THEN f.url END
         ELSE coalesce(f.profile_url, CASE WHEN r.prof THEN r.url END) END
  FROM (SELECT *, n + 1 AS next FROM fold) f JOIN r ON r.id = f.id AND r.n = f.next)
SELECT id, ord, source, title, deadline, url, published, place, profile_url, {EXPIRED_SQL} AS expired
FROM fold QUALIFY row_number() OVER (PARTITION BY id ORDER BY n DESC) = 1"""


@query(BY_ID_SQL, "tender_v")
def dedup_by_id(spark, sf):
    return dd.dedup_by_id(_by_customer(spark, sf), TODAY).select(
        "id", "ord", "source", "title", "deadline", "url", "published", "place", "profile_url", "expired"
    )


_RECORD_FIELDS = ("id", "ord", "source", "title", "authority_ico", "deadline", "value", "url", "published", "place", "state",
                  "site_visit", "cpv_text", "nuts_text", "authority_seat", "profile_url", "expired")
_FILLED = ("url", "published", "place", "state", "site_visit", "cpv_text", "nuts_text", "authority_seat")


def _rank_sql(x: str) -> str:
    points = [f"2 * CAST({x}.deadline IS NOT NULL AS INT)", f"2 * CAST({x}.value IS NOT NULL AS INT)"] + [
        f"CAST({x}.{f} IS NOT NULL AS INT)" for f in ("cpv_text", "place", "state", "published", "url", "nuts_text", "site_visit")]
    return f"2 * ({' + '.join(points)}) + CAST({x}.source = 'isvz' AS INT)"


def _agree_sql(a: str, b: str) -> str:
    return f"((NOT {a}.expired AND NOT {b}.expired) OR coalesce(substr({a}.deadline, 1, 10) = substr({b}.deadline, 1, 10), false))"


def _pack_sql(**values: str) -> str:
    return "{" + ", ".join(f"'{f}': {values[f]}" for f in _RECORD_FIELDS) + "}"


# The records of a buyer and title in arrival order; the state of the fold is a list of records.
CROSS_SQL = f""",
rec AS (SELECT *, trim(regexp_replace(lower(strip_accents(title)), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) AS nt,
  {_pack_sql(**{f: f for f in _RECORD_FIELDS} | {'cpv_text': "nullif(cpv_text, '')", 'nuts_text': "nullif(nuts_text, '')",
     'profile_url': 'CAST(NULL AS STRING)', 'expired': EXPIRED_SQL})} AS e FROM tender_v),
r AS (SELECT authority_ico AS ico, nt, e, row_number() OVER (PARTITION BY authority_ico, nt ORDER BY ord) AS n
  FROM rec WHERE trim(authority_ico) <> '' AND nt <> ''),
fold AS (
  SELECT ico, nt, n, [e] AS st FROM r WHERE n = 1
  UNION ALL
  SELECT ico, nt, n, CASE WHEN k IS NULL THEN list_append(st, e) ELSE list_concat(list_append(st[:k - 1], m), st[k + 1:]) END
  FROM (SELECT *, {{deadline}} AS m FROM (
    SELECT *, CASE WHEN wins THEN e ELSE c END AS w, CASE WHEN wins THEN c ELSE e END AS l FROM (
      SELECT *, st[k] AS c, {_rank_sql('e')} > {_rank_sql('st[k]')} AS wins FROM (
        SELECT f.ico, f.nt, r.n, f.st, r.e, list_position(list_transform(f.st, lambda c: {_agree_sql('c', 'r.e')}), true) AS k
        FROM (SELECT *, n + 1 AS next FROM fold) f JOIN r ON r.ico = f.ico AND r.nt = f.nt AND r.n = f.next))))),
done AS (SELECT unnest(st) AS x FROM fold QUALIFY row_number() OVER (PARTITION BY ico, nt ORDER BY n DESC) = 1
  UNION ALL SELECT e FROM rec WHERE coalesce(trim(authority_ico), '') = '' OR coalesce(nt, '') = '')
SELECT x.id, x.ord, x.source, x.title, x.authority_ico, x.deadline, x.value, x.url, x.profile_url, x.expired FROM done"""
_MERGED = {f: f"w.{f}" for f in _RECORD_FIELDS} | {f: f"coalesce(w.{f}, l.{f})" for f in _FILLED} | {
    "ord": "c.ord", "deadline": "greatest(w.deadline, l.deadline)", "value": "coalesce(nullif(w.value, 0), nullif(l.value, 0), w.value)",
    "profile_url": "coalesce(w.profile_url, CASE WHEN starts_with(l.source, 'profil:') THEN l.url END)",
    "expired": EXPIRED_SQL.replace("deadline", "greatest(w.deadline, l.deadline)").replace("state", "coalesce(w.state, l.state)"),
}
CROSS_SQL = CROSS_SQL.replace("{deadline}", _pack_sql(**_MERGED))


@query(CROSS_SQL, "tender_v")
def dedup_cross_source(spark, sf):
    t = fl.mark_expired(view(spark, sf, "tender_v"), TODAY)
    kept = dd.dedup_cross_source(t, TODAY).kept
    return kept.select("id", "ord", "source", "title", "authority_ico", "deadline", "value", "url", "profile_url", "expired")


@query("""
SELECT id, arg_max(verze, ord) AS verze, arg_max(hodnota, ord) AS hodnota, arg_max(datum, ord) AS datum
FROM contract_v GROUP BY id""", "contract_v")
def latest_version(spark, sf):
    return dd.latest_version(view(spark, sf, "contract_v")).select("id", "verze", "hodnota", "datum")


@query("""
SELECT id, title, CAST(NULL AS STRING) AS winner FROM tender_v
UNION ALL SELECT id, title, winner FROM competition_v""", "tender_v", "competition_v")
def union_sources(spark, sf):
    a, b = view(spark, sf, "tender_v").select("id", "title"), view(spark, sf, "competition_v").select("id", "title", "winner")
    return dd.union_sources(a, b)


@query("""
SELECT id, title, value FROM tender_v WHERE published >= '1999-01-01'
UNION ALL SELECT id, title, value FROM prev_v WHERE id NOT IN (SELECT id FROM tender_v WHERE published >= '1999-01-01')""",
       "tender_v", "prev_v")
def union_fresh_over_archive(spark, sf):
    fresh = view(spark, sf, "tender_v").where("published >= '1999-01-01'").select("id", "title", "value")
    return dd.union_fresh_over_archive(fresh, view(spark, sf, "prev_v").select("id", "title", "value"))


@query("SELECT id, verdikt FROM verdict_v WHERE id IN (SELECT id FROM tender_v WHERE kind = 'VZ')", "verdict_v", "tender_v")
def prune_orphans(spark, sf):
    return dd.prune_orphans(view(spark, sf, "verdict_v"), view(spark, sf, "tender_v").where("kind = 'VZ'")).select("id", "verdikt")


@query(f"""
SELECT id, {EXPIRED_SQL} OR (deadline IS NULL AND state IS NULL) AS expired FROM prev_v
WHERE id NOT IN (SELECT id FROM tender_v WHERE published >= '1999-01-01')
  AND id NOT IN (SELECT id FROM tender_v WHERE clarifications = 3)
  AND id NOT IN (SELECT id FROM tender_v WHERE authority_ico IS NULL)""", "tender_v", "prev_v")
def carry_forward(spark, sf):
    t = view(spark, sf, "tender_v")
    prev = fl.mark_expired(view(spark, sf, "prev_v"), TODAY)
    return ch.carry_forward(
        prev, t.where("published >= '1999-01-01'"), t.where("clarifications = 3"), t.where("authority_ico IS NULL")
    ).select("id", "expired")


_MONEY = "replace(format('{{:,}}', CAST(round_even({0}, 0) AS BIGINT)), ',', ' ') || ' Kč'"
_VALUE = "CASE WHEN {0} IS NULL OR {0} = 0 THEN '—' ELSE " + _MONEY + " END"
_TIME = "CASE WHEN {0} IS NULL THEN '—' ELSE replace(substr({0}, 1, 16), 'T', ' ') END"
DIFF_SQL = f"""
pairs AS (SELECT t.id, t.published, p.deadline AS od, t.deadline AS nd, p.value AS ov, t.value AS nv, p.clarifications AS oc, t.clarifications AS nc,
   p.title AS ot, t.title AS nt FROM tender_v t JOIN prev_v p USING (id)),
diff AS (
  SELECT id, 'deadline' AS field, 'lhůta' AS label, {_TIME.format('od')} AS old, {_TIME.format('nd')} AS new, 0 AS seq FROM pairs WHERE od IS DISTINCT FROM nd
  UNION ALL SELECT id, 'value', 'hodnota', {_VALUE.format('ov')}, {_VALUE.format('nv')}, 1 FROM pairs
    WHERE ov IS DISTINCT FROM nv AND NOT (coalesce(ov, 0) = 0 AND coalesce(nv, 0) = 0)
  UNION ALL SELECT id, 'clarifications', 'vysvětlení ZD', CAST(oc AS STRING), CAST(nc AS STRING), 3 FROM pairs WHERE oc <> nc
  UNION ALL SELECT id, 'title', 'název', coalesce(ot, '—'), coalesce(nt, '—'), 4 FROM pairs WHERE ot IS DISTINCT FROM nt)"""


@query(f", {DIFF_SQL} SELECT id, DATE '{TODAY}' AS date, field, label, old, new FROM diff", "tender_v", "prev_v")
def snapshot_diff(spark, sf):
    return ch.snapshot_diff(view(spark, sf, "prev_v"), view(spark, sf, "tender_v"), TODAY).drop("seq")


# a change log with many entries per id: every event of a user is an entry
_LOG = """log AS (SELECT 'rvz:' || CAST(user_id AS STRING) AS id, CAST(ts AS DATE) AS date,
  CASE WHEN event_type IN ('click', 'view') THEN 'deadline' ELSE 'value' END AS field, 'x' AS label,
  CAST(CAST(round_even(value, 0) AS INT) % 3 AS STRING) AS old,
  CAST(CAST(round_even(value * 10, 0) AS INT) % 3 AS STRING) AS new, event_id AS seq FROM events)"""


def _log(spark, sf):
    e = table(spark, sf, "events")
    return e.select(
        F.concat(F.lit("rvz:"), F.col("user_id").cast("string")).alias("id"), F.to_date("ts").alias("date"),
        F.when(F.col("event_type").isin("click", "view"), "deadline").otherwise("value").alias("field"), F.lit("x").alias("label"),
        (F.bround("value", 0).cast("int") % 3).cast("string").alias("old"),
        (F.bround(F.col("value") * 10, 0).cast("int") % 3).cast("string").alias("new"), F.col("event_id").alias("seq"),
    )


@query(f""", {_LOG}, {DIFF_SQL},
everything AS (
  SELECT * FROM log WHERE id IN (SELECT id FROM tender_v) AND date >= DATE '2024-06-30' - 180
  UNION ALL SELECT id, DATE '2024-06-30', field, label, old, new, seq FROM diff)
SELECT id, date, field, label, old, new FROM everything
QUALIFY row_number() OVER (PARTITION BY id ORDER BY date DESC, seq DESC) <= 20""", "tender_v", "prev_v")
def change_log_maintain(spark, sf):
    t = view(spark, sf, "tender_v")
    fresh = ch.snapshot_diff(view(spark, sf, "prev_v"), t, "2024-06-30")
    return ch.change_log_maintain(_log(spark, sf), fresh, t, "2024-06-30").drop("seq")


@query(f"WITH {_LOG} SELECT id, max(date) AS last_change FROM log WHERE date >= DATE '2024-01-30' - 7 GROUP BY id")
def changed_recently(spark, sf):
    return ch.changed_recently(_log(spark, sf), "2024-01-30")


@query(f"""WITH {_LOG}, seen AS (
  SELECT *, lag(old) OVER w AS po, lag(new) OVER w AS pn, row_number() OVER w AS rn FROM log
  WINDOW w AS (PARTITION BY id, field ORDER BY date, seq))
SELECT id, field, date, old, new, po = new AND pn = old AS reverts FROM seen WHERE rn > 1""")
def change_flapping(spark, sf):
    return ch.change_flapping(_log(spark, sf))


_DEAD = """last AS (SELECT id, max(run) FILTER (code = 200) AS r FROM probe_v GROUP BY id),
counts AS (SELECT l.id, count(*) FILTER (p.code = 404 AND (l.r IS NULL OR p.run > l.r)) AS url_dead
  FROM last l JOIN probe_v p USING (id) GROUP BY l.id)"""
DEAD_SQL = f", {_DEAD} SELECT id, url_dead, url_dead >= 2 AS link_dead FROM counts"


@query(DEAD_SQL, "probe_v")
def dead_link_counter(spark, sf):
    return ch.dead_link_counter(view(spark, sf, "probe_v"))


_PROBE = """CASE WHEN value IS NULL THEN 404 WHEN clarifications = 0 THEN 410 WHEN clarifications = 1 THEN NULL ELSE 200 END"""


@query(f""",
t AS (SELECT *, {EXPIRED_SQL} AS e0, {_PROBE} AS code, CASE WHEN kind = 'VZ' THEN 'https://nen.nipez.cz/x' ELSE url END AS link,
   CASE WHEN kind = 'VZ' AND state IS NULL THEN true END AS ld,
   CASE WHEN published < '2000-09-01' THEN CAST(month(CAST(published AS DATE)) % 3 AS INT) ELSE 0 END AS pd FROM tender_v),
h AS (SELECT *, e0 OR coalesce(ld, false) AS e1 FROM t),
j AS (SELECT *, CASE WHEN ld THEN e0 ELSE e1 END AS e2,
   NOT (CASE WHEN ld THEN e0 ELSE e1 END) AND link IS NOT NULL AND kind <> 'VZ' AS checked FROM h)
SELECT id, CASE WHEN NOT checked THEN NULL WHEN code IN (404, 410) THEN pd + 1 WHEN code IS NULL AND pd > 0 THEN pd END AS url_dead,
  CASE WHEN checked AND code IN (404, 410) AND pd >= 1 THEN true END AS link_dead,
  e2 OR (checked AND coalesce(code IN (404, 410), false) AND pd >= 1) AS expired FROM j""", "tender_v")
def apply_probe_results(spark, sf):
    t = fl.mark_expired(view(spark, sf, "tender_v"), TODAY)
    registry = F.col("kind") == "VZ"
    probes = t.selectExpr("id", f"{_PROBE} AS code")
    flagged = F.when(registry & F.col("state").isNull(), F.lit(True))
    now = t.withColumns({
        "url": F.when(registry, "https://nen.nipez.cz/x").otherwise(F.col("url")),
        "link_dead": flagged, "url_dead": F.when(flagged, 2),
        "expired": F.col("expired") | F.coalesce(flagged, F.lit(False)),
    })
    prev = view(spark, sf, "prev_v").select("id", F.expr("month(CAST(published AS DATE)) % 3").cast("int").alias("url_dead"))
    return ch.apply_probe_results(now, prev, probes, TODAY).select("id", "url_dead", "link_dead", "expired")


_VERDICT = """CASE WHEN clarifications = 0 THEN NULL WHEN clarifications = 1 THEN 'dead' ELSE 'live' END"""


@query(f""",
t AS (SELECT *, {EXPIRED_SQL} AS e0, {_VERDICT} AS answer,
   deadline IS NULL AND state IS NULL AND source = 'isvz' AND NOT {EXPIRED_SQL} AS candidate FROM tender_v),
d AS (SELECT *, CASE WHEN NOT candidate THEN NULL WHEN url IS NULL THEN 'dead' ELSE answer END AS verdict FROM t)
SELECT id, CASE WHEN verdict = 'live' THEN published || 'T12:00:00' ELSE deadline END AS deadline,
  CASE WHEN verdict = 'live' AND value IS NULL THEN 5e6 ELSE value END AS value,
  CASE WHEN verdict = 'live' THEN published < '{TODAY}' WHEN verdict = 'dead' THEN true ELSE e0 END AS expired,
  CASE WHEN verdict = 'dead' THEN DATE '{TODAY}' END AS auto_expired FROM d""", "tender_v")
def verify_stub_merge(spark, sf):
    t = fl.mark_expired(view(spark, sf, "tender_v"), TODAY)
    answers = t.selectExpr(
        "id", f"{_VERDICT} AS verdict", "published || 'T12:00:00' AS deadline", "CAST(NULL AS STRING) AS state", "5e6D AS value"
    )
    return ch.verify_stub_merge(t, answers, TODAY).select("id", "deadline", "value", "expired", "auto_expired")

