"""Finding documents on pages and in profile exports, and mining their text."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderloom import fixed_values as fv
from tenderloom.functions import text as tx
from tenderloom.materialize import materialize
from tenderloom.operators.filters import list_order, top_k
from tenderloom.settings import Settings


def page_links(pages: DataFrame) -> DataFrame:
    """(url, pos, href, anchor): every link of a page with its folded text."""
    pattern = F.lit(fv.ANCHOR_PATTERN)
    found = F.arrays_zip(
        F.regexp_extract_all("html", pattern, F.lit(1)).alias("href"),
        F.regexp_extract_all("html", pattern, F.lit(2)).alias("anchor"),
    )
    links = pages.select("url", F.posexplode(found).alias("pos", "a"))
    # decoded in a step of its own, because folding names its text several times
    decoded = links.select(
        "url", "pos", tx.html_unescape("a.href").alias("href"), tx.html_unescape(tx.strip_tags("a.anchor")).alias("anchor"))
    return decoded.select("url", "pos", "href", tx.fold_text("anchor").alias("anchor"))


def _names_document(text: Column, words) -> Column:
    hit = reduce(or_, [text.contains(w) for w in words])
    return hit & ~text.contains(fv.DOC_LINK_VETO)


def html_strip_links(pages: DataFrame, words) -> DataFrame:
    """(url, doc_url): the first link of each page whose text names the document."""
    return _first_named(page_links(pages), words)


def _first_named(links: DataFrame, words) -> DataFrame:
    first = links.where(_names_document(F.col("anchor"), words)).groupBy("url").agg(F.min_by("href", "pos").alias("href"))
    return first.select("url", tx.url_join("url", "href").alias("doc_url"))


def find_doc_link(pages: DataFrame, words) -> DataFrame:
    """Like ``html_strip_links``, but a page without a hit may use one of its linked
    document sub-pages (stored in the same table), taken in link order."""
    links = materialize(page_links(pages), "links")         # decoded and folded once, read three times
    direct = _first_named(links, words)
    sub = links.join(direct.select("url"), "url", "left_anti").where(
        F.col("anchor").contains(fv.DOC_SUBPAGE_WORD) | tx.fold_text("href").contains(fv.DOC_SUBPAGE_WORD)
    ).select("url", "pos", tx.url_join("url", "href").alias("sub_url"))
    via = (
        sub.join(direct.select(F.col("url").alias("sub_url"), "doc_url"), "sub_url")
        .groupBy("url").agg(F.min_by("doc_url", "pos").alias("doc_url"))
    )
    return direct.unionByName(via)


def _found(text: Column, pattern: str, length: int) -> Column:
    return F.substring(tx.squeeze(tx.first_group(text, pattern)), 1, length)


def mine_tender_doc(docs: DataFrame, text: str = "text") -> DataFrame:
    """Value, place and term named in a tender document."""
    t = F.col("_folded")
    return docs.withColumn("_folded", tx.fold_text(text)).withColumns({
        "hodnota": tx.parse_cz_number(tx.first_group(t, fv.DOC_VALUE_PATTERN)),
        "misto": _found(t, fv.DOC_PLACE_PATTERN, 140),
        "termin": _found(t, fv.DOC_TERM_PATTERN, 140),
    }).drop("_folded")


def mine_award_report(docs: DataFrame, text: str = "text") -> DataFrame:
    """Winner (only when it looks like a company) and final price of an award report."""
    t, winner = F.col("_folded"), F.col("_winner")
    folded = docs.withColumn("_folded", tx.fold_text(text))
    return folded.withColumn("_winner", tx.first_group(t, fv.DOC_WINNER_PATTERN)).withColumns({
        "vitez": F.when(winner.rlike(fv.DOC_COMPANY_PATTERN), F.substring(tx.squeeze(winner), 1, 100)),
        "cena": tx.parse_cz_number(tx.first_group(t, fv.DOC_PRICE_PATTERN)),
    }).drop("_folded", "_winner")


def profile_doc_lookup(tenders: DataFrame, exports: DataFrame, words) -> DataFrame:
    """(id, doc_url) from profile exports.

    tenders: id, native_id, registry_id, base (profile address). exports: base,
    ids array, docs array<struct<typ,url>> per exported record, ord. The native id is
    tried before the registry id, documents in export order.
    """
    wanted = tenders.select(
        "id", "base", F.posexplode(F.array("native_id", "registry_id")).alias("prio", "key")
    ).where(F.coalesce("key", F.lit("")) != "")
    # documents are judged once, before each is offered under every id of its record
    offered = exports.select("base", "ord", "ids", F.posexplode("docs").alias("pos", "doc")).where(
        F.col("doc.url") != "").where(_names_document(tx.fold_text("doc.typ"), words)).select(
        "base", "ord", F.explode(F.array_distinct("ids")).alias("key"), "pos", F.col("doc.url").alias("url"))
    return wanted.join(offered, ["base", "key"]).groupBy("id").agg(
        F.min_by("url", F.struct("prio", "ord", "pos")).alias("doc_url")
    )


def doc_claim_unique(found: DataFrame, store: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Work of one run: (id, doc_url, nenalezeno).

    found: id, ord, doc_url. A document belongs to its first claimant; ids in the store
    are done; the run ends after a fixed number of claimed documents, and records behind
    that point wait for the next run.
    """
    todo = found.join(store.select("id"), "id", "left_anti")
    fresh_urls = todo.where(F.coalesce("doc_url", F.lit("")) != "").join(
        store.where("doc_url IS NOT NULL").select("doc_url"), "doc_url", "left_anti"
    )
    claims = fresh_urls.groupBy("doc_url").agg(F.min("ord").alias("ord"))
    last = claims.orderBy("ord").limit(settings.max_documents).agg(
        F.max("ord").alias("last"), F.count("*").alias("n")
    )
    cut = last.select(F.when(F.col("n") == settings.max_documents, F.col("last"))).scalar()
    done = todo.where(F.coalesce(F.col("ord") <= cut, F.lit(True)))
    claimed = claims.select(F.col("doc_url"), "ord", F.lit(True).alias("mine"))
    return done.join(claimed, ["doc_url", "ord"], "left").select(
        "id", F.when(F.col("mine"), F.col("doc_url")).alias("doc_url"), F.col("mine").isNull().alias("nenalezeno")
    )


def detail_enrich(tenders: DataFrame, details: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Site visit and clarification count for the first active registry records of the list
    that have a platform id. details: nen_id, site_visit, clarifications."""
    worklist = tenders.where(
        (F.col("source") == fv.REGISTRY_SOURCE) & ~F.col("expired") & (F.coalesce("nen_id", F.lit("")) != "")
    )
    worklist = top_k(worklist, list_order(), settings.max_details)
    new = worklist.select("id", "nen_id").join(details, "nen_id").select(
        "id", F.col("site_visit").alias("_visit"), F.col("clarifications").alias("_clar")
    )
    return tenders.join(new, "id", "left").withColumns({
        "site_visit": F.coalesce("_visit", "site_visit"),
        "clarifications": F.coalesce("_clar", "clarifications"),
    }).drop("_visit", "_clar")
