"""Feed of fresh tenders: items to buyers that are not configured yet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderloom import fixed_values as fv
from tenderloom.functions import text as tx
from tenderloom.schemas import FEED_ITEM
from tenderloom.sources.order import in_file_order
from tenderloom.sources.profiles import normalize_profiles


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Links of the items, in the order of the file."""
    items = spark.read.format("xml").schema(FEED_ITEM).option("rowTag", fv.FEED_ROW_TAG).load(path)
    return in_file_order(items, [path]).select(tx.blank_to_null("link").alias("link"), "ord").where("link IS NOT NULL")


def feed_page_fields(pages: DataFrame) -> DataFrame:
    """(url, ico, profile_url, buyer, seat) of detail pages that show buyer id and profile."""
    found = pages.select(
        "url",
        F.lpad(F.replace(F.regexp_extract("html", fv.FEED_BUYER_ID_PATTERN, 1), F.lit(" "), F.lit("")), 8, "0").alias("ico"),
        tx.first_group("html", fv.FEED_BUYER_ID_PATTERN).alias("_id"),
        tx.first_group("html", fv.FEED_PROFILE_PATTERN, 1).alias("profile_url"),
        F.trim(tx.html_unescape(F.regexp_extract("html", fv.FEED_PROFILE_PATTERN, 2))).alias("buyer"),
        F.trim(tx.html_unescape(F.regexp_extract("html", fv.FEED_ADDRESS_PATTERN, 1))).alias("seat"),
    )
    return found.where("_id IS NOT NULL AND profile_url IS NOT NULL").drop("_id")


def feed_buyers(items: DataFrame, pages: DataFrame, known: DataFrame) -> DataFrame:
    """New buyers of the feed, first item per buyer id; ``known`` has column ico."""
    fields = feed_page_fields(pages)
    found = items.join(fields, items["link"] == fields["url"]).join(known.select("ico"), "ico", "left_anti")
    return found.groupBy("ico").agg(
        F.min_by(F.struct("profile_url", "buyer", "seat"), "ord").alias("f")
    ).select("ico", "f.*")


def feed_key(ico: Column) -> Column:
    """The profile key of a buyer that the feed has brought."""
    return F.concat(F.lit(fv.FEED_PREFIX.removeprefix(fv.PROFILE_PREFIX)), ico)


def feed_tenders(records: DataFrame, buyers: DataFrame) -> DataFrame:
    """Exported records (with the ``feed_key`` in ``key``) of the feed's buyers to the tender model.
    The buyer's seat goes along, which locates tenders that name no place."""
    profiles = buyers.select(feed_key(F.col("ico")).alias("key"), "buyer", "ico", "profile_url")
    seats = buyers.select(F.concat(F.lit(fv.FEED_PREFIX), "ico").alias("source"), F.col("seat").alias("authority_seat"))
    return normalize_profiles(records, profiles).join(seats, "source")
