"""Whole runs over stored versions: the newest versions in, new ones out together, with a run record.

Tables lie under one root, each with versions ``run_date=``. A run reads versions older than its own
day, so that running a day again replaces that day's versions by the same result. What a run could
not read is named in ``warnings`` of its record.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderloom import files
from tenderloom import fixed_values as fv
from tenderloom.materialize import materialize
from tenderloom.operators.linking import latest_amendments
from tenderloom.plans.contracts import link_contracts
from tenderloom.plans.daily import DailyResult, daily_build
from tenderloom.schemas import AMENDMENT, CHANGE, CONTRACT, LINK, TENDER, WATCHED
from tenderloom.settings import Settings
from tenderloom.sources.contracts import normalize_contracts, read_contract_xml
from tenderloom.sources.registry import normalize_registry, read_registry
from tenderloom.sources.snapshots import (
    expected_months, load_snapshot_or_default, months_to_link, newest_version, publish_together, select_month_partitions,
)


class NothingRead(RuntimeError):
    """Every input failed; nothing was written."""


def month_status(spark: SparkSession, root: str, today, count: int) -> dict[str, str]:
    """'read', 'pending' or 'missing' of each of the last ``count`` months under ``root/month=``."""
    found = [(n.removeprefix("month="),) for n in files.names(spark, root) if n.startswith("month=")]
    status = select_month_partitions(
        spark.createDataFrame(found, "month string"), expected_months(spark, today, count), today)
    return {r["month"]: r["status"] for r in status.orderBy("month").take(count)}


def registry_source(spark: SparkSession, root: str, today, count: int = fv.REGISTRY_MONTHS) -> tuple[DataFrame, list[str]]:
    """Tenders of the months that are there, and a warning for each older month that is not."""
    status = month_status(spark, root, today, count)
    present = [m for m, s in status.items() if s == "read"]
    warnings = [f"registry {m}: export is missing" for m, s in status.items() if s == "missing"]
    tenders = normalize_registry(read_registry(spark, root, present)) if present else spark.createDataFrame([], TENDER)
    return tenders, warnings


def daily_run(
    spark: SparkSession, root: str, sources: dict[str, DataFrame], gazetteer: DataFrame, profiles: DataFrame, today,
    warnings: list[str] = (), settings: Settings = Settings(), **lookups: DataFrame,
) -> DailyResult:
    """One day: history from the stored versions, the build, and the new versions of tenders, changes,
    competition and runs, published together unless the tenders shrank too much (PublishRefused).

    ``sources`` are named frames in the order registry, profiles, feed; one without records keeps its
    earlier tenders and is named in the record's warnings, behind those of the readers.
    """
    day = str(today)
    previous = load_snapshot_or_default(spark, f"{root}/tenders", TENDER, before=day)
    log = load_snapshot_or_default(spark, f"{root}/changes", CHANGE, before=day)
    archive = newest_version(spark, f"{root}/competition", before=day)
    result = daily_build(list(sources.values()), previous, log, archive, gazetteer, profiles, today, settings, **lookups)
    counted = {r["number"]: r["rows"] for r in result.source_rows.take(len(sources))}
    rows = {name: counted.get(i, 0) for i, name in enumerate(sources)}
    told = [*warnings, *[f"{name}: no records, earlier ones are kept" for name, n in rows.items() if not n]]
    record = result.metrics.select(
        "*", F.lit(day).alias("run_date"), F.lit(json.dumps(rows)).alias("source_rows"),
        F.lit(told).cast("array<string>").alias("warnings"))
    publish_together(
        {"tenders": result.tenders, "changes": result.changes, "competition": result.competition, "runs": record},
        root, day, guarded={"tenders": previous}, settings=settings)
    return result


def link_run(
    spark: SparkSession, root: str, dumps_root: str, watched: DataFrame, today, settings: Settings = Settings(),
    read: Callable[[SparkSession, str], DataFrame] = lambda spark, path: normalize_contracts(read_contract_xml(spark, path)),
) -> bool:
    """One linking of the stored awards: all 13 months while nothing was ever linked, else two.

    Dumps lie under ``dumps_root/month=``. A month without one is passed over; one that cannot be read
    is named in the record's warnings. If dumps failed and none was read, NothingRead is raised and all
    versions stay. Without awards there is nothing to do (False).
    """
    day = str(today)
    competition = newest_version(spark, f"{root}/competition")
    if competition is None or competition.isEmpty():
        return False
    links = load_snapshot_or_default(spark, f"{root}/links", LINK, before=day)
    amendments = load_snapshot_or_default(spark, f"{root}/amendments", AMENDMENT, before=day)
    found = load_snapshot_or_default(spark, f"{root}/watched", WATCHED, before=day)
    tenders = load_snapshot_or_default(spark, f"{root}/tenders", TENDER)
    count = months_to_link(links, newest_version(spark, f"{root}/link_runs", before=day) is not None)
    dumps, done, errors = spark.createDataFrame([], CONTRACT).withColumn("dump", F.lit(None).cast("string")), [], []
    for month, status in month_status(spark, dumps_root, today, count).items():     # 13 at most
        if status != "read":
            continue
        try:
            rows = materialize(read(spark, f"{dumps_root}/month={month}").withColumn("dump", F.lit(month)), "dump")
        except (PySparkException, Py4JError) as error:
            errors.append(f"contracts {month}: {str(error).splitlines()[0][:200]}")
            continue
        dumps = dumps.unionByName(rows, allowMissingColumns=True)
        done.append(month)
    if errors and not done:
        raise NothingRead("; ".join(errors))
    result = link_contracts(competition, dumps, links, amendments, tenders, watched, found, today, settings)
    record = result.counts.select(
        "*", F.lit(day).alias("run_date"), F.lit(done).cast("array<string>").alias("months"),
        F.lit(count == fv.BACKFILL_MONTHS).alias("backfill"), F.lit(errors).cast("array<string>").alias("warnings"))
    # a dump that is read again brings its amendments again; one record of each is kept
    publish_together({"links": result.links, "amendments": latest_amendments(result.amendments),
                      "watched": result.watched, "link_runs": record}, root, day)
    return True
