"""Sector, region and value filters and the expiry flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderloom import fixed_values as fv
from tenderloom.functions import text as tx
from tenderloom.functions.numbers import deadline_date
from tenderloom.settings import Settings


def list_order() -> list[Column]:
    """The order of the published list: nearest deadline, then publication, then arrival."""
    return [F.coalesce(F.nullif("deadline", F.lit("")), F.lit("9999")), F.coalesce("published", F.lit("")), F.col("ord")]


def as_date(today) -> Column:
    return today if isinstance(today, Column) else F.lit(str(today)).cast("date")


def kw_negative(title: Column | str, settings: Settings = Settings()) -> Column:
    return tx.has_stem(title, settings.keywords_negative)


def kw_match(title: Column | str, settings: Settings = Settings()) -> Column:
    """A positive stem at a word start and no negative one."""
    return tx.has_stem(title, settings.keywords_positive) & ~kw_negative(title, settings)


def from_configured_profile(source: Column | str, settings: Settings = Settings()) -> Column:
    """Records of configured single-buyer profiles, not of the feed or of agencies."""
    s = tx.col(source)
    own = s.startswith(fv.PROFILE_PREFIX) & ~s.startswith(fv.FEED_PREFIX)
    return own & ~s.isin(settings.agency_sources) if settings.agency_sources else own


def _has_sector_code(cpv: Column, settings: Settings, general_too: bool) -> Column:
    def is_sector(code: Column) -> Column:
        hit = code.startswith(settings.cpv_prefix)
        for excluded in settings.cpv_excluded:
            hit = hit & ~code.startswith(excluded)
        return hit if general_too else hit & ~code.startswith(settings.cpv_general)

    return F.exists(cpv, is_sector)


def sector_columns(settings: Settings = Settings()) -> tuple[Column, Column]:
    """(passes, kw_match): CPV first, then keywords, then trusted profiles without CPV."""
    cpv = F.coalesce(F.col("cpv"), F.array().cast("array<string>"))
    by_code = _has_sector_code(cpv, settings, True) & (
        ~kw_negative("title", settings) | _has_sector_code(cpv, settings, False)
    )
    by_word = ~by_code & kw_match("title", settings)
    trusted = from_configured_profile("source", settings) & (F.size(cpv) == 0)
    return by_code | by_word | trusted, by_word


def sector_filter(tenders: DataFrame, settings: Settings = Settings()) -> DataFrame:
    passes, by_word = sector_columns(settings)
    return (
        tenders.withColumns({"_passes": passes, "kw_match": F.coalesce(by_word, F.lit(False))})
        .where("_passes").drop("_passes")
    )


def region_filter(tenders: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Any allowed region passes; records without a region stay and carry ``no_nuts``."""
    trusted = from_configured_profile("source", settings)
    nuts = F.coalesce(F.col("nuts"), F.array().cast("array<string>"))
    missing = F.size(nuts) == 0
    allowed = F.arrays_overlap(tx.code_prefixes(nuts, 5), F.array(*map(F.lit, settings.nuts_allowed)))
    keep_missing = F.lit(True) if settings.keep_missing_nuts else trusted
    return (
        tenders.where((missing & keep_missing) | (~missing & allowed))
        .withColumn("no_nuts", missing & ~trusted)
    )


def value_filter(tenders: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Unknown value stays and carries ``no_value``; known value must reach the minimum."""
    value = F.col("value")
    keep_missing = F.lit(settings.keep_missing_value)
    return (
        tenders.where((value.isNull() & keep_missing) | (value >= settings.min_value))
        .withColumn("no_value", value.isNull())
    )


def state_is_done(state: Column | str) -> Column:
    done = tx.fold_text(state).rlike("^(?:" + "|".join(fv.DONE_STATE_PREFIXES) + ")")
    return F.coalesce(done, F.lit(False))


def expired_column(today) -> Column:
    past = F.coalesce(deadline_date("deadline") < as_date(today), F.lit(False))
    return past | state_is_done("state")


def mark_expired(tenders: DataFrame, today) -> DataFrame:
    """Past deadline, or a state that starts with a finished word."""
    return tenders.withColumn("expired", expired_column(today))


def passes_filters(tenders: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Cheap predicates first; text matching runs on what they leave."""
    return sector_filter(value_filter(region_filter(tenders, settings), settings), settings)


def top_k(df: DataFrame, order: list[Column], k: int, per: list[str] | None = None) -> DataFrame:
    """The first k rows in an order, of the whole table or per key."""
    if not per:
        return df.orderBy(*order).limit(k)
    place = F.row_number().over(Window.partitionBy(*per).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= k).drop("_place")
