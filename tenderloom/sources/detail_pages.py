"""Detail pages of a buyer platform (used where the XML export is broken)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderloom import fixed_values as fv
from tenderloom.functions import text as tx


def _label(name: str) -> Column:
    # a label that comes again replaces the earlier one
    found = F.regexp_extract_all("html", F.lit(fv.DETAIL_LABEL_PATTERN % name), F.lit(1))
    return tx.blank_to_null(tx.strip_tags(F.try_element_at(found, F.lit(-1)), ""))


def _clean(pattern: str) -> Column:
    return tx.blank_to_null(tx.squeeze(tx.strip_tags(tx.first_group("html", pattern))))


def listed_details(listings: DataFrame) -> DataFrame:
    """(key, path, url, pos) of the detail pages that a listing (key, profile_url, html) names, each
    once, in the order of the listing."""
    paths = F.array_distinct(F.regexp_extract_all("html", F.lit(fv.DETAIL_LINK_PATTERN), F.lit(1)))
    return listings.select("key", "profile_url", F.posexplode(paths).alias("pos", "path")).select(
        "key", "path", F.concat(F.rtrim(F.col("profile_url"), F.lit("/")), F.lit("/"), "path").alias("url"), "pos")


def details_of_listings(listings: DataFrame, pages: DataFrame) -> DataFrame:
    """Tenders of all pages (url, html) that the listings (key, profile_url, html, buyer, ico) name; a
    page that was not fetched is left out."""
    buyers = listings.select("key", F.col("buyer").alias("profile_buyer"), F.col("ico").alias("profile_ico"))
    wanted = listed_details(listings).join(buyers, "key")
    return mine_detail_html(wanted.join(pages.select("url", "html"), "url"))


def mine_detail_html(pages: DataFrame) -> DataFrame:
    """Pages (key, url, path, html, profile_buyer, profile_ico) to the tender model.

    The title is the link of the page to itself; a page without one is skipped. When the
    buyer block is missing the profile's own buyer is used.
    """
    # what stands behind each link of the page to itself, in page order; the first that is a title
    parts = F.split(F.replace("html", F.concat(F.lit('<a href="/'), F.col("path"), F.lit('">')),
                              F.concat(F.lit('<a href="'), F.col("path"), F.lit('">'))),
                    F.concat(F.lit('<a href="\\Q'), F.col("path"), F.lit('\\E">')))
    titles = F.filter(
        F.transform(F.slice(parts, F.lit(2), F.size(parts)), lambda p: F.regexp_extract(p, "^([^<]{3,160})</a>", 1)),
        lambda t: t != "",
    )

    digits = F.regexp_replace(F.substring_index(_label(fv.DETAIL_VALUE_LABEL), "Kč", 1), r"\D", "")
    places = F.regexp_extract_all(
        F.regexp_extract("html", fv.DETAIL_PLACES_PATTERN, 1), F.lit("(?s)<li>(.*?)</li>"), F.lit(1)
    )
    buyer = _clean(fv.DETAIL_BUYER_PATTERN)
    source = F.concat(F.lit(fv.PROFILE_PREFIX), F.col("key"))
    return pages.select(
        F.concat(source, F.lit(":"), F.coalesce(_label(fv.DETAIL_NUMBER_LABEL), F.col("path"))).alias("id"),
        source.alias("source"),
        F.get(titles, F.lit(0)).alias("title"),
        F.coalesce(buyer, F.col("profile_buyer")).alias("authority"),
        F.when(buyer.isNotNull(), _clean(fv.DETAIL_BUYER_ID_PATTERN)).otherwise(F.col("profile_ico")).alias("authority_ico"),
        F.array().cast("array<string>").alias("cpv"), F.array().cast("array<string>").alias("nuts"),
        F.nullif(digits, F.lit("")).try_cast("double").alias("value"),
        F.substring(tx.parse_cz_datetime(_label(fv.DETAIL_START_LABEL)), 1, 10).alias("published"),
        tx.parse_cz_datetime(_label(fv.DETAIL_DEADLINE_LABEL)).alias("deadline"),
        "url",
        F.nullif(F.array_join(F.transform(places, lambda p: tx.squeeze(p)), ", "), F.lit("")).alias("place"),
        _clean(fv.DETAIL_ADDRESS_PATTERN).alias("authority_seat"),
        F.when(F.col("html").rlike(fv.DETAIL_SMALL_SCALE_PATTERN), "VZMR").otherwise("VZ").alias("kind"),
    ).where("title IS NOT NULL")
