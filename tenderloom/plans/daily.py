"""The daily tender build: sources in, snapshot, change log and awards out."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderloom.materialize import materialize
from tenderloom.operators import changes as ch
from tenderloom.operators.competition import build_competition
from tenderloom.operators.dashboard import run_metrics, tender_order
from tenderloom.operators.dedup import dedup_by_id, dedup_cross_source, union_sources
from tenderloom.operators.documents import detail_enrich
from tenderloom.operators.filters import mark_expired, passes_filters, sector_filter
from tenderloom.operators.geo import locate, radius_filter, relocate_unknown
from tenderloom.schemas import TENDER
from tenderloom.settings import Settings
from tenderloom.sources.order import MAX_SOURCES, SOURCE_SHIFT, frame_order
from tenderloom.sources.registry import fill_urls


class DailyResult(NamedTuple):
    tenders: DataFrame
    changes: DataFrame
    competition: DataFrame
    metrics: DataFrame
    source_rows: DataFrame      # (number, rows) of each source that has records, in the order given


def conform(tenders: DataFrame) -> DataFrame:
    """All columns of the tender model, absent ones NULL."""
    model = tenders.sparkSession.createDataFrame([], TENDER)
    return model.unionByName(tenders, allowMissingColumns=True).select(*model.columns)


def ordered_sources(*sources: DataFrame) -> DataFrame:
    """Union with ``ord`` made unique across sources, earlier sources first."""
    if len(sources) >= MAX_SOURCES:
        raise ValueError(f"at most {MAX_SOURCES - 1} sources, each a reader's whole input")
    return union_sources(*[
        s.withColumn("ord", F.lit(i).cast("bigint") * (1 << SOURCE_SHIFT) + F.col("ord")) for i, s in enumerate(sources)
    ])


def daily_build(
    sources: list[DataFrame], previous: DataFrame, change_log: DataFrame, archive: DataFrame | None,
    gazetteer: DataFrame, profiles: DataFrame, today, settings: Settings = Settings(),
    verification: DataFrame | None = None, probes: DataFrame | None = None, details: DataFrame | None = None,
) -> DailyResult:
    """Filter, merge, locate, carry history forward, check and diff.

    Source order is registry, profiles, feed. The optional tables hold answers of live
    lookups (stubs, links, details); without them those steps change nothing.
    """
    everything = materialize(conform(ordered_sources(*sources)), "sources")      # parsed once, read three times
    filtered = mark_expired(passes_filters(everything, settings), today)
    unique = materialize(fill_urls(dedup_by_id(filtered, today), everything, profiles))
    first = dedup_cross_source(unique, today)
    merged = materialize(first.kept)
    placed = radius_filter(merged.drop("dist_km", "loc_unknown"), locate(merged, gazetteer, settings), settings)
    fresh = placed.kept

    # records of earlier runs come after all fresh ones, in the order of their snapshot
    earlier = previous.withColumn("ord", F.lit(len(sources)).cast("bigint") * (1 << SOURCE_SHIFT) + frame_order())
    carried = sector_filter(ch.carry_forward(earlier, fresh, placed.dropped, first.merged_away), settings)
    carried = relocate_unknown(carried, gazetteer, settings)
    both = materialize(union_sources(conform(fresh), conform(carried)))
    result = dedup_cross_source(both, today).kept
    if verification is not None:
        result = ch.verify_stub_merge(result, verification, today)
    if probes is not None:
        result = ch.apply_probe_results(result, previous, probes, today)
    if details is not None:
        result = detail_enrich(result, details, settings)
    result = materialize(conform(result).drop("award"))

    news = ch.snapshot_diff(previous, result, today)
    log = ch.change_log_maintain(change_log, news, result, today, settings)
    competition = build_competition(everything, archive, gazetteer, today, settings)
    metrics = run_metrics(result, log, competition, previous)
    source_rows = everything.groupBy(F.shiftright("ord", SOURCE_SHIFT).alias("number")).agg(F.count("*").alias("rows"))
    return DailyResult(tender_order(result), log, competition, metrics, source_rows)
