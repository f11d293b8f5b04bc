"""One query per operator over its whole table, with its SQL counterpart where SQL has one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderloom.llm import (
    decontaminate, filter_audit, frames, hard_negatives, licence_digest, line_dedup, line_quality, main_text, ngram_join,
    packing, pitman_yor, quality_rank, toxicity, url_rules,
)

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _query(fn=None, *, sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql.strip()
        return f

    return register(fn) if fn else register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query(sql=r"""
WITH word AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
item AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k,
    unnest(list_transform(range(1, len(w) - least(10, len(w)) + 2), lambda i: list_aggregate(w[i:i + least(10, len(w)) - 1], 'string_agg', ' '))) AS gram
  FROM item WHERE len(w) > 0),
spot AS (
  SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS i,
    unnest(list_transform(range(1, len(w) - k + 2), lambda i: list_aggregate(w[i:i + k - 1], 'string_agg', ' '))) AS gram
  FROM word, (SELECT DISTINCT k FROM win) WHERE len(w) >= k),
occ AS (SELECT s.doc_id, s.i, s.k, n.item_id FROM spot s JOIN win n ON n.k = s.k AND n.gram = s.gram),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM occ) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM occ GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(m.n, 0) AS BIGINT) AS n_items, sha256(coalesce(m.ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM word w LEFT JOIN hit h ON h.doc_id = w.doc_id LEFT JOIN named m ON m.doc_id = w.doc_id""")
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of the benchmark's ten-word windows in every whole document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_items(docs, _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@_query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document packed by its words; a row per piece."""
    counted = packing.count_words(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return packing.pack_documents(counted, F.col("n_words"))


def _fold(doc_id: str, n: int):
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(n))


@_query
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of every whole document, learnt from the rows that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").where(_fold("doc_id", 3) != 1)
    model = quality_rank.fit(docs, labels)
    scored = quality_rank.score(docs, model, keep=False)
    return scored.select("doc_id", (_fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


@_query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of 50 words and more of every whole document that stand earlier in the corpus."""
    return line_dedup.repeated_runs(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@_query(sql=r"""
WITH RECURSIVE word AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
shingle AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM word),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
pair AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingle a JOIN shingle b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM pair JOIN size nx ON nx.doc_id = x JOIN size ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
edge AS (SELECT x, y FROM link UNION SELECT y, x FROM link),
reach AS (SELECT x AS doc_id, x AS m FROM edge UNION SELECT edge.y, reach.m FROM reach JOIN edge ON edge.x = reach.doc_id),
least AS (SELECT doc_id, min(m) AS m FROM reach GROUP BY doc_id)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(least.m, w.doc_id) AS component_id
FROM word w LEFT JOIN size ON size.doc_id = w.doc_id LEFT JOIN least ON least.doc_id = w.doc_id""")
def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all whole documents that share 85 % of their four-word shingles."""
    found = ngram_join.similar_components(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id")


@_query(sql=r"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS p FROM dup) GROUP BY doc_id),
line AS (SELECT doc_id, l, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n,
  length(regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g')) AS c, lower(l) AS low
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM w) WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
judged AS (SELECT *, len(regexp_extract_all(l, '[#*$%&|<>~^]')) > 0.3 * n OR len(regexp_extract_all(l, '[!?]{2,}')) > 0.3 * n
  OR (len(regexp_extract_all(l, '[|»›•]')) >= 3 AND len(regexp_extract_all(l, '[|»›•]')) > 0.2 * n)
  OR %s AS bad FROM line),
per AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup, count(*) FILTER (bad) AS n_bad,
  coalesce(sum(c) FILTER (bad), 0) AS c_bad FROM judged GROUP BY doc_id),
base AS (SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(coalesce(per.n_dup, 0) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(per.n_lines, 0) AS BIGINT) AS n_lines,
  CAST(coalesce(per.n_bad, 0) AS BIGINT) AS n_removed_lines, CAST(coalesce(per.c_bad, 0) AS BIGINT) AS removed_chars
  FROM w LEFT JOIN per ON per.doc_id = w.doc_id LEFT JOIN rep ON rep.doc_id = w.doc_id)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * removed_chars <= 50 * word_chars AS kept FROM base
""".replace("%s", " OR ".join(f"contains(low, '{p}')" for p in line_quality.BOILERPLATE)))
def op3_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-first quality rules over every whole document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_quality.judge_lines(docs, keep_clean=False).drop("text")


#: host, path, verdict
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


@_query
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on every page's URL, with the blocks of its aliases."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    rules = spark.sql("SELECT * FROM VALUES " + ", ".join(map(str, URL_RULES)) + " AS t(host, path, verdict)")
    return url_rules.judge_urls(pages.drop("html"), rules, url_rules.page_links(pages)).select(
        "page_id", "host", "path", "rule", "verdict")


@_query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of every whole document, learnt from the rows that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").where(_fold("doc_id", 5) != 0)
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, model, keep=False)
    return scored.select("doc_id", (_fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@_query
def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every whole page."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_text.extract_text(pages).select("page_id", "url", "text", "n_chars")


@_query
def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document, and each line of it, that is a known licence text or notice."""
    return licence_digest.scan_licences(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@_query
def op11_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every whole document, learnt from the rows that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = pitman_yor.score_texts(docs, _fold("doc_id", 7) != 2)
    return scored.select("doc_id", (_fold("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score", "perplexity")


@_query(sql=r"""
WITH doc AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
word AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS least FROM doc),
marked AS (SELECT doc_id, part, (CASE WHEN len(w) < 100 THEN 'A' ELSE '' END)
  || (CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END)
  || (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END)
  || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
  || (CASE WHEN doc_id > least THEN 'E' ELSE '' END) AS fails FROM word),
known AS (SELECT doc_id, coalesce(max(quality), 0) = 1 AS good, coalesce(max(toxic), 0) = 1 AS toxic FROM labels GROUP BY doc_id),
tally AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic
  FROM marked LEFT JOIN known USING (doc_id) GROUP BY part, fails),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
ordered AS (SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
step AS (SELECT part, fails, n, n_good, n_toxic, filter_order, step, filter_order[step] AS f, contains(fails, filter_order[step]) AS here,
    regexp_matches(filter_order[1:step - 1], '[' || fails || '0]') AS earlier
  FROM tally, ordered, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
counted AS (SELECT part, filter_order, step, any_value(f) AS f,
  sum(CASE WHEN NOT here AND NOT earlier THEN n ELSE 0 END) AS kept, sum(CASE WHEN here AND NOT earlier THEN n ELSE 0 END) AS removed,
  sum(CASE WHEN here AND earlier THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails = f THEN n ELSE 0 END) AS unique_fails,
  sum(CASE WHEN here AND NOT earlier THEN n_good ELSE 0 END) AS good_lost,
  sum(CASE WHEN here AND NOT earlier THEN n_toxic ELSE 0 END) AS toxic_lost
  FROM step GROUP BY part, filter_order, step)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM counted""")
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters over every whole document, in all orders."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("same", filter_audit.digest("text"))
    rows = frames.stored(filter_audit.measure(docs, keep=False), "measured")
    rows = filter_audit.later_copies(rows, row_id="doc_id", same="same", name="copy")
    known = _table(spark, sf_dir, "labels").groupBy("doc_id").agg(
        (F.max("quality") == 1).alias("good"), (F.max("toxic") == 1).alias("toxic"))
    return filter_audit.audit(rows.join(known, "doc_id", "left"), {
        "A": F.col("n_words") < 100,
        "B": 100 * F.col("n_distinct") < 80 * F.col("n_words"),
        "C": 100 * F.col("n_capitals") > 10 * F.col("n_points"),
        "D": F.col("n_symbols") > 0,
        "E": F.col("copy"),
    }, part="lang", losses={"good_lost": F.coalesce("good", F.lit(False)), "toxic_lost": F.coalesce("toxic", F.lit(False))})


@_query(sql=r"""
WITH taken AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id AS other,
    CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
  FROM taken a JOIN taken r ON a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id),
positive AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other) AS INTEGER) AS rank,
  n.other AS negative_id, p.positive_score, n.score AS negative_score
FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other) <= 10""")
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, against all vectors."""
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    taken = hard_negatives.quantise(rows, row_id="vec_id", vector="embedding", label=label, scale=256)
    return hard_negatives.mine(taken, F.col("id") % 100 == 0).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
