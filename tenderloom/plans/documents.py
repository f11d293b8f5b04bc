"""Document job: find a document per tender, claim it once, mine its text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderloom.operators import documents as dc
from tenderloom.operators.dedup import prune_orphans, union_fresh_over_archive
from tenderloom.settings import Settings

NO_TEXT = "dokument bez textu"
ERROR_LENGTH = 120


def document_run(
    tenders: DataFrame, store: DataFrame, pages: DataFrame, exports: DataFrame, texts: DataFrame,
    kinds, link_words, miner: Callable[[DataFrame], DataFrame], settings: Settings = Settings(),
) -> DataFrame:
    """New state of the document store.

    tenders: id, ord, url, base, native_id, registry_id. texts: doc_url, text (already
    extracted) and, if known, error. A document from the profile export comes before one linked on the
    page. A claimed document without text is stored with an error in ``chyba``, so no later run claims it.
    """
    from_export = dc.profile_doc_lookup(tenders, exports, kinds).select("id", F.col("doc_url").alias("a"))
    from_page = dc.find_doc_link(pages, link_words).select("url", F.col("doc_url").alias("b"))
    found = tenders.select("id", "ord", "url").join(from_export, "id", "left").join(from_page, "url", "left")
    work = dc.doc_claim_unique(
        found.select("id", "ord", F.coalesce("a", "b").alias("doc_url")), store, settings
    )
    error = F.col("error") if "error" in texts.columns else F.lit(None).cast("string")
    read = work.join(texts.select("doc_url", "text", error.alias("_error")), "doc_url", "left")
    failed = F.col("doc_url").isNotNull() & F.col("text").isNull()
    mined = miner(read.withColumn(
        "chyba", F.when(failed, F.substring(F.coalesce("_error", F.lit(NO_TEXT)), 1, ERROR_LENGTH)))).drop("text", "_error")
    return prune_orphans(union_fresh_over_archive(mined, store), tenders)
