"""Months to read, versioned snapshots and the guarded publication of a new one."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderloom import files
from tenderloom import fixed_values as fv
from tenderloom.operators.filters import as_date
from tenderloom.settings import Settings


class PublishRefused(RuntimeError):
    """The new result is suspiciously small; nothing was written."""


def expected_months(spark: SparkSession, today, count: int) -> DataFrame:
    """The last ``count`` months up to today's, oldest first."""
    first = F.add_months(F.trunc(as_date(today), "month"), -(count - 1))
    months = F.sequence(first, F.trunc(as_date(today), "month"), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(months).alias("first_day")).select(
        F.date_format("first_day", "yyyy-MM").alias("month"), "first_day"
    )


def select_month_partitions(available: DataFrame, expected: DataFrame, today) -> DataFrame:
    """(month, status): 'read' when present, 'pending' for the current and last month,
    'missing' (an error) for older ones."""
    present = available.select("month", F.lit(True).alias("_p")).distinct()
    age = F.months_between(F.trunc(as_date(today), "month"), "first_day")
    return expected.join(present, "month", "left").select(
        "month", F.when(F.col("_p"), "read").when(age <= 1, "pending").otherwise("missing").alias("status")
    )


def months_to_link(links: DataFrame, has_meta: bool) -> int:
    """Full backfill while nothing was ever linked, else the current and last month."""
    return fv.INCREMENTAL_MONTHS if has_meta or not links.isEmpty() else fv.BACKFILL_MONTHS


def newest_version(spark: SparkSession, root: str, before: str | None = None) -> DataFrame | None:
    """Newest complete version (``run_date=``) under ``root``, older than ``before``; None if there is
    none. Only that one is read."""
    dates = [d for d in files.versions(spark, root, "run_date") if not before or d < str(before)]
    return spark.read.parquet(f"{root}/run_date={dates[-1]}") if dates else None


def load_snapshot_or_default(
    spark: SparkSession, root: str, schema: str, before: str | None = None
) -> DataFrame:
    """The newest complete version with the columns of the schema; empty when there is none. A
    version that cannot be read is an error, not an empty history."""
    empty = spark.createDataFrame([], schema)
    found = newest_version(spark, root, before)
    if found is None:
        return empty
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in empty.schema if f.name not in found.columns]
    return found.select("*", *missing).select(*empty.columns)


def _stage(new: DataFrame, root: str) -> str:
    staging = f"{root}/_staging-{uuid.uuid4().hex}"
    new.write.parquet(staging)
    return staging


def _take_name(spark: SparkSession, staging: str, root: str, run_date: str) -> None:
    """The staged version takes its ``run_date=`` name by renaming; a version of the same day steps
    aside first and is deleted last, so no moment leaves a half written version."""
    target, aside = f"{root}/run_date={run_date}", None
    if files.exists(spark, target):
        aside = f"{root}/_replaced-{uuid.uuid4().hex}"
        files.move(spark, target, aside)
    files.move(spark, staging, target)
    if aside:
        files.delete(spark, aside)


def guarded_publish(
    new: DataFrame, previous: DataFrame, root: str, run_date: str, settings: Settings = Settings()
) -> DataFrame:
    """Write a new version unless it has under a fifth of the previous rows.

    The result is computed once, into a staging folder beside the versions, and counted
    there. Returns (new_rows, previous_rows).
    """
    spark = new.sparkSession
    staging = _stage(new, root)
    new_rows, previous_rows = spark.read.schema(new.schema).parquet(staging).count(), previous.count()
    if previous_rows and new_rows < settings.min_result_ratio * previous_rows:
        files.delete(spark, staging)
        raise PublishRefused(f"{new_rows} rows against {previous_rows} before")
    _take_name(spark, staging, root, run_date)
    return spark.createDataFrame([(new_rows, previous_rows)], "new_rows long, previous_rows long")


def publish_together(
    tables: dict[str, DataFrame], root: str, run_date: str, guarded: dict[str, DataFrame] | None = None,
    settings: Settings = Settings(),
) -> None:
    """Write a version of several tables, each under ``root/<name>``.

    All are computed into staging folders before the first takes its name, so they may read the
    versions that they replace, and a failure leaves every table as it was. ``guarded`` holds the
    previous rows of the tables that ``guarded_publish`` judges; one refusal refuses all.
    """
    spark = next(iter(tables.values())).sparkSession
    staged: dict[str, str] = {}
    try:
        for name, new in tables.items():
            staged[name] = _stage(new, f"{root}/{name}")
        for name, previous in (guarded or {}).items():
            new_rows = spark.read.schema(tables[name].schema).parquet(staged[name]).count()
            previous_rows = previous.count()
            if previous_rows and new_rows < settings.min_result_ratio * previous_rows:
                raise PublishRefused(f"{name}: {new_rows} rows against {previous_rows} before")
    except Exception:
        for folder in staged.values():
            files.delete(spark, folder)
        raise
    for name, folder in staged.items():
        _take_name(spark, folder, f"{root}/{name}", run_date)
