"""Lists, statistics and run figures shown on the dashboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderloom.functions.numbers import days_to
from tenderloom.operators.competition import price_between, text_contains, within_distance
from tenderloom.operators.filters import as_date, list_order


def is_new(last_visit: str | None) -> Column:
    if not last_visit:
        return F.lit(False)
    return F.coalesce(F.col("published") > last_visit, F.lit(False))


def with_marks(
    tenders: DataFrame, *, verdicts: DataFrame, watched: DataFrame, hidden: DataFrame,
    changed: DataFrame, reasons: DataFrame,
) -> DataFrame:
    """Tenders with everything the dashboard knows about them by id: the marks of all tables are
    gathered to one row per id, which is joined once."""
    def row(df: DataFrame, mark: str, value: str | None = None) -> DataFrame:
        text = F.lit(None).cast("string") if value is None else F.col(value)
        return df.select("id", F.lit(mark).alias("mark"), text.alias("value"))

    marks = row(verdicts, "verdict", "verdikt").unionByName(row(watched, "watched")).unionByName(row(hidden, "hidden")) \
        .unionByName(row(changed, "changed")).unionByName(row(reasons, "reason", "reason")).where("id IS NOT NULL")
    value = lambda mark: F.max(F.when(F.col("mark") == mark, F.col("value")))
    has = ("watched", "hidden", "changed")
    by_id = marks.groupBy("id").agg(
        value("verdict").alias("verdikt"), value("reason").alias("reason"),
        *[F.max(F.col("mark") == m).alias(m) for m in has])
    return tenders.join(by_id, "id", "left").withColumns({m: F.coalesce(m, F.lit(False)) for m in has})


def tender_list_filter(
    marked: DataFrame, *, query: str | None = None, kind: str | None = None,
    new_since: str | None = None, include_rejected_by_verdict: bool = False,
    max_km: float = 50, unknown: bool = True, low_m: float = 0, high_m: float | None = None,
    only_active: bool = True, only_watched: bool = False, only_changed: bool = False,
    only_disliked: bool = False,
) -> DataFrame:
    """All list conditions as one predicate over ``with_marks`` rows."""
    keep = text_contains(query, "title", "authority")
    if kind:
        keep = keep & (F.col("kind") == kind)
    if new_since:
        keep = keep & is_new(new_since)
    if not include_rejected_by_verdict:
        keep = keep & ~(F.coalesce(F.col("verdikt") == "ne", F.lit(False)) & ~F.col("watched"))
    keep = keep & within_distance(max_km, unknown) & price_between("value", low_m, high_m)
    if only_active:
        keep = keep & ~F.col("expired")
    if only_watched:
        keep = keep & F.col("watched")
    if only_changed:
        keep = keep & F.col("changed")
    rejected = F.col("reason").isNotNull() | F.col("hidden")
    return marked.where(keep & (rejected if only_disliked else ~rejected))


def stat_cards(marked: DataFrame, today, last_visit: str | None) -> DataFrame:
    """All card figures in one pass."""
    active = ~F.col("expired")
    left = days_to("deadline", as_date(today))
    return marked.agg(
        F.count_if(active).alias("active"),
        F.count_if(active & is_new(last_visit)).alias("new"),
        F.count_if("watched").alias("watched"),
        F.count_if(active & F.coalesce(left.between(0, 7), F.lit(False))).alias("due_week"),
        F.count_if("changed").alias("changed"),
        F.count_if(F.col("reason").isNotNull() | F.col("hidden")).alias("hidden"),
    )


def run_metrics(tenders: DataFrame, changes: DataFrame, competition: DataFrame, previous: DataFrame) -> DataFrame:
    """Counts stored with a run."""
    counts = tenders.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("kind") == "VZ").alias("vz"),
        F.count_if(F.col("kind") == "VZMR").alias("vzmr"),
        F.count_if(~F.col("expired")).alias("active"),
    )
    return counts.select(
        "*",
        changes.agg(F.count_distinct("id").alias("c")).scalar().alias("changed"),
        competition.agg(F.count("*").alias("c")).scalar().alias("competition"),
        previous.agg(F.count("*").alias("c")).scalar().alias("previous"),
    )


def tender_order(tenders: DataFrame) -> DataFrame:
    """Nearest deadline first, then by publication; records without a deadline last."""
    return tenders.orderBy(*list_order())


def bidder_stats(tenders: DataFrame) -> DataFrame:
    """Bids per tender: how many, how many excluded, price range."""
    bids = tenders.select("id", F.explode("bidders").alias("b"))
    return bids.groupBy("id").agg(
        F.count("*").alias("bids"),
        F.count_if(F.coalesce("b.vyloucen", F.lit(False))).alias("excluded"),
        F.min("b.cena").alias("min_price"), F.max("b.cena").alias("max_price"),
    )
