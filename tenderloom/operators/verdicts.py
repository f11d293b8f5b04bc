"""Relevance verdicts: what to judge next, storing answers, selecting by them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenderloom import fixed_values as fv
from tenderloom.operators.dedup import prune_orphans
from tenderloom.operators.filters import list_order, top_k
from tenderloom.settings import Settings


def verdict_worklist(tenders: DataFrame, verdicts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Active tenders without a verdict: the first few hundred of the list, in batches."""
    todo = tenders.where(~F.col("expired")).join(verdicts.select("id"), "id", "left_anti")
    first = top_k(todo, list_order(), settings.max_verdicts)
    # at most max_verdicts rows are numbered
    place = F.row_number().over(Window.orderBy(*list_order()))
    return first.withColumn("batch", F.floor((place - 1) / settings.verdict_batch).cast("int"))


def verdict_merge(stored: DataFrame, answers: DataFrame, worklist: DataFrame, tenders: DataFrame) -> DataFrame:
    """Accept answers for asked ids only, shorten the reason, drop vanished ids."""
    accepted = answers.where(F.col("verdikt").isin(*fv.VERDICTS)).join(
        worklist.select("id", "batch"), ["id", "batch"], "left_semi"
    ).select("id", "verdikt", F.substring("duvod", 1, 120).alias("duvod"))
    unique = accepted.groupBy("id").agg(F.max(F.struct("verdikt", "duvod")).alias("a")).select("id", "a.*")
    merged = stored.select("id", "verdikt", "duvod").join(unique.select("id"), "id", "left_anti").unionByName(unique)
    return prune_orphans(merged, tenders)


def verdict_counts(verdicts: DataFrame) -> DataFrame:
    """One row with a count per verdict; absent ones count zero."""
    return verdicts.agg(*[F.count_if(F.col("verdikt") == v).alias(v) for v in fv.VERDICTS])


def verdict_selection(
    tenders: DataFrame, verdicts: DataFrame, watched: DataFrame, hidden: DataFrame,
    with_unsure: bool = False, without_deadline: bool = False,
) -> DataFrame:
    """Watched tenders that are live or only tidied away, plus live ones judged relevant."""
    wanted = ["ano", "nejisto"] if with_unsure else ["ano"]
    joined = (
        tenders.join(verdicts.select("id", "verdikt"), "id", "left")
        .join(watched.select("id", F.lit(True).alias("_w")), "id", "left")
        .join(hidden.select("id", F.lit(True).alias("_h")), "id", "left")
    )
    tidied = F.col("auto_expired").isNotNull() if "auto_expired" in tenders.columns else F.lit(False)
    starred = F.col("_w").isNotNull() & (~F.col("expired") | tidied)
    judged = ~F.col("expired") & F.col("_h").isNull() & F.coalesce(F.col("verdikt").isin(wanted), F.lit(False))
    if not without_deadline:
        judged = judged & (F.coalesce("deadline", F.lit("")) != "")
    return joined.where(starred | judged).drop("_w", "_h")
