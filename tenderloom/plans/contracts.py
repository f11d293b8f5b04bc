"""Linking job: dumps folded into links month by month, amendments and watched tenders."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderloom.operators import linking as ln
from tenderloom.settings import Settings
from tenderloom.sources.order import PERIOD_SHIFT, month_number


class LinkResult(NamedTuple):
    links: DataFrame
    amendments: DataFrame
    watched: DataFrame
    counts: DataFrame


def link_contracts(
    competition: DataFrame, dumps: DataFrame, previous: DataFrame, amendments: DataFrame,
    tenders: DataFrame, watched: DataFrame, found: DataFrame | None, today, settings: Settings = Settings(),
) -> LinkResult:
    """``dumps`` are contract rows with a ``dump`` column (the month). Amendments are kept in
    a table of their own, so one that precedes its link is attached later."""
    links = ln.link_dumps(competition, dumps, previous, settings)
    # later dumps overwrite an amendment of the same id
    by_dump = dumps.withColumn("ord", month_number(F.col("dump")) * (1 << PERIOD_SHIFT) + F.col("ord"))
    all_amendments = amendments.unionByName(ln.amendment_rows(by_dump))
    attached = ln.amendment_attach(links, all_amendments, settings)
    specs = ln.watch_specs(tenders, watched, today)
    matches = ln.watched_contract_match(specs, by_dump, found)
    return LinkResult(attached, all_amendments, matches, ln.link_confidence_counts(attached))
