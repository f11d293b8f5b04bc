"""Awarded tenders: building the table, filtering it and ranking the winners."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderloom.functions import text as tx
from tenderloom.functions.numbers import effective_growth, effective_price, growth_pct
from tenderloom.materialize import materialize
from tenderloom.operators.dedup import union_fresh_over_archive
from tenderloom.operators.filters import as_date, region_filter, sector_filter
from tenderloom.operators.geo import locate, radius_filter
from tenderloom.settings import Settings


def awarded_recently(tenders: DataFrame, today, settings: Settings = Settings()) -> DataFrame:
    """Awards of the last year in sector and region; the last record of an id counts."""
    cutoff = F.date_sub(as_date(today), settings.competition_window_days)
    recent = tenders.where(F.substring("award.date", 1, 10).try_cast("date") >= cutoff)
    relevant = region_filter(sector_filter(recent, settings), settings)
    last = relevant.groupBy("id").agg(F.max_by(F.struct(*relevant.columns), "ord").alias("row"))
    return last.select("row.*")


def competition_row(tenders: DataFrame) -> DataFrame:
    """Flat award record; a missing contracted price falls back to the estimate."""
    contracted = F.coalesce("award.price_contracted", "value")
    optional = [c for c in ("dist_km", "loc_unknown", "bidders") if c in tenders.columns]
    return tenders.select(
        "id", "source", "title", "authority", "authority_ico",
        F.coalesce("award.winner", F.lit("")).alias("winner"),
        F.coalesce("award.winner_ico", F.lit("")).alias("winner_ico"),
        F.col("award.date").alias("awarded"),
        contracted.alias("price_contracted"),
        (F.col("award.price_contracted").isNull() & F.col("value").isNotNull()).alias("estimated"),
        F.col("award.price_paid").alias("price_paid"),
        growth_pct("award.price_paid", contracted).alias("growth_pct"),
        "cpv", "kind", "kw_match", F.coalesce("url", F.lit("")).alias("url"), *optional,
    )


def build_competition(
    tenders: DataFrame, archive: DataFrame | None, gazetteer: DataFrame, today, settings: Settings = Settings()
) -> DataFrame:
    """Fresh awards within the radius over the re-filtered archive."""
    recent = materialize(awarded_recently(tenders, today, settings), "recent")
    located = radius_filter(recent, locate(recent, gazetteer, settings), settings).kept
    fresh = competition_row(located)
    if archive is None:
        return fresh
    return union_fresh_over_archive(fresh, sector_filter(archive, settings))


def with_amendments(competition: DataFrame, links: DataFrame) -> DataFrame:
    """Add amendment totals, the price including them and the growth."""
    totals = links.select(F.col("tender_id").alias("id"), "amendments_total")
    return competition.join(totals, "id", "left").withColumns({
        "eff_price": effective_price("price_contracted", "amendments_total"),
        "eff_growth": effective_growth("price_contracted", "price_paid", "amendments_total"),
    })


def text_contains(query: str | None, *columns: str) -> Column:
    if not query or not query.strip():
        return F.lit(True)
    haystack = F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in columns])
    return F.contains(F.lower(haystack), F.lit(query.strip().lower()))


def price_between(price: str, low_m: float, high_m: float | None) -> Column:
    """Millions; unknown prices pass and no upper bound means unlimited."""
    millions = F.col(price) / 1e6
    ok = millions >= low_m
    if high_m is not None:
        ok = ok & (millions <= high_m)
    return F.coalesce(ok, F.lit(True))


def within_distance(max_km: float, unknown: bool) -> Column:
    lost = F.coalesce("loc_unknown", F.lit(False))
    return F.when(lost, F.lit(unknown)).otherwise(F.coalesce(F.col("dist_km") <= max_km, F.lit(False)))


def competition_filter(
    competition: DataFrame, *, query: str | None = None, date_from: str | None = None,
    date_to: str | None = None, max_km: float = 15, unknown: bool = True, low_m: float = 5,
    high_m: float | None = 100, only_disliked: bool = False,
) -> DataFrame:
    """Dashboard filter over awards. Expects ``eff_price`` and ``reason`` (why a record is
    hidden, NULL when it is not)."""
    searched = text_contains(query, "title", "winner", "authority", "winner_ico")
    awarded = F.coalesce("awarded", F.lit(""))
    if date_from:
        searched = searched & (awarded >= date_from)
    if date_to:
        searched = searched & (awarded <= date_to)
    if only_disliked:
        return competition.where(searched & F.col("reason").isNotNull())
    return competition.where(
        searched & F.col("reason").isNull() & within_distance(max_km, unknown)
        & price_between("eff_price", low_m, high_m)
    )


def competition_order(competition: DataFrame) -> DataFrame:
    return competition.orderBy(F.desc("awarded"), "id")


def top_firms(competition: DataFrame, k: int = 10, price: str = "eff_price") -> DataFrame:
    """Biggest winners by won volume; firms are told apart by the first winner id, by name
    only where the id is missing."""
    won = competition.where(F.coalesce("winner", F.lit("")) != "")
    first_id = tx.blank_to_null(F.get(F.split(F.coalesce("winner_ico", F.lit("")), ";"), F.lit(0)))
    priced = won.select(
        F.coalesce(first_id, F.col("winner")).alias("firm"), "winner", first_id.alias("ico"), "awarded", "id",
        F.coalesce(price, F.lit(0.0)).alias("price"),
    )
    # the rollup adds the grand total as one more row of the same aggregation
    firms = priced.rollup("firm").agg(
        F.grouping("firm").alias("is_total"),
        F.min_by(F.struct("winner", "ico"), F.struct("awarded", "id")).alias("head"),
        F.count("*").alias("n"), F.sum("price").alias("volume"),
    )
    top = firms.orderBy(F.desc("is_total"), F.desc("volume"), "firm").limit(k + 1)
    listed = Window.partitionBy()       # over the k + 1 rows only
    is_total = F.col("is_total") == 1
    largest = F.max(F.when(~is_total, F.col("volume"))).over(listed)
    share = F.floor(F.col("volume") / F.nullif(largest, F.lit(0.0)) * 100 + 0.5)
    return top.select(
        "firm", F.col("head.winner").alias("name"), F.col("head.ico").alias("ico"), "n", "volume",
        F.greatest(F.lit(2), share.cast("int")).alias("bar_pct"),
        F.max(F.when(is_total, F.col("volume"))).over(listed).alias("grand_total"), "is_total",
    ).where("is_total = 0").drop("is_total")
