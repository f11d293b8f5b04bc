"""Snapshot differences, the change log and link health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderloom import fixed_values as fv
from tenderloom.functions import text as tx
from tenderloom.functions.numbers import deadline_date
from tenderloom.operators.blocks import block_of, blocked_lag
from tenderloom.operators.filters import as_date, expired_column
from tenderloom.settings import Settings


def _missing(df: DataFrame, field: str, c: Column) -> Column:
    kind = df.schema[field].dataType.typeName()
    empty = c == "" if kind == "string" else c == 0
    return c.isNull() | F.coalesce(empty, F.lit(False))


def snapshot_diff(previous: DataFrame, current: DataFrame, today) -> DataFrame:
    """One row per tracked field that differs between two snapshots of the same id."""
    fields = [f for f in fv.TRACKED_FIELDS if f in current.columns and f in previous.columns]
    old = previous.select("id", F.struct(*fields).alias("o"))
    both = current.select("id", F.struct(*fields).alias("n")).join(old, "id")
    entries = []
    for f in fields:
        o, n = F.col(f"o.{f}"), F.col(f"n.{f}")
        changed = ~o.eqNullSafe(n) & ~(_missing(previous, f, o) & _missing(current, f, n))
        entries.append(F.when(changed, F.struct(
            F.lit(f).alias("field"), F.lit(fv.TRACKED_FIELDS[f]).alias("label"),
            tx.format_change_value(f, o).alias("old"), tx.format_change_value(f, n).alias("new"),
            F.lit(list(fv.TRACKED_FIELDS).index(f)).alias("seq"),
        )))
    return both.select("id", F.inline(F.array_compact(F.array(*entries)))).select(
        "id", as_date(today).alias("date"), "field", "label", "old", "new", "seq"
    )


def change_log_maintain(
    log: DataFrame, fresh: DataFrame, current: DataFrame, today, settings: Settings = Settings()
) -> DataFrame:
    """Old entries of live ids within the age limit plus the new ones, the last few per id."""
    cutoff = F.date_sub(as_date(today), settings.changes_max_age_days)
    kept = log.join(current.select("id"), "id", "left_semi").where(F.col("date") >= cutoff)
    newest = Window.partitionBy("id").orderBy(F.desc("date"), F.desc("seq"))
    return (
        kept.unionByName(fresh)
        .withColumn("n", F.row_number().over(newest))
        .where(F.col("n") <= settings.changes_kept).drop("n")
    )


def changed_recently(log: DataFrame, today, days: int = fv.CHANGED_RECENTLY_DAYS) -> DataFrame:
    """Ids with an entry in the last days."""
    return log.where(F.col("date") >= F.date_sub(as_date(today), days)).groupBy("id").agg(
        F.max("date").alias("last_change")
    )


def change_flapping(log: DataFrame, block: Column | None = None) -> DataFrame:
    """Entries that undo the previous entry of the same id and field, in (date, seq) order."""
    block = F.struct("date", block_of("seq")) if block is None else block
    packed = log.withColumn("entry", F.struct("old", "new"))
    seen = blocked_lag(packed, ["id", "field"], ["date", "seq"], block, "entry", "before")
    return seen.where("before IS NOT NULL").select(
        "id", "field", "date", "old", "new",
        ((F.col("before.old") == F.col("new")) & (F.col("before.new") == F.col("old"))).alias("reverts"),
    )


def is_dead(code: Column | str) -> Column:
    return F.coalesce(tx.col(code).isin(*fv.DEAD_HTTP_CODES), F.lit(False))


def dead_link_summary(probes: DataFrame, bits: int = 16) -> DataFrame:
    """(id, reset, dead): was any answer a live one, and how many dead ones came after it.

    ``run`` orders the probes of an id. Bounded blocks of runs are summed up first, then
    put together from one row per block.
    """
    code = F.col("code")
    in_block = Window.partitionBy("id", "_block")
    rows = probes.withColumn("_block", block_of("run", bits)).withColumns({
        "_dead": is_dead(code), "_reset": code.isNotNull() & ~is_dead(code),
    })
    rows = rows.withColumn("_last_reset", F.max(F.when(F.col("_reset"), F.col("run"))).over(in_block))
    after_reset = F.col("_last_reset").isNull() | (F.col("run") > F.col("_last_reset"))
    blocks = rows.groupBy("id", "_block").agg(
        F.max("_last_reset").alias("reset"), F.count_if(F.col("_dead") & after_reset).alias("dead")
    )
    per_id = Window.partitionBy("id")
    last = blocks.withColumn(
        "_reset_block", F.max(F.when(F.col("reset").isNotNull(), F.col("_block"))).over(per_id)
    ).where("_reset_block IS NULL OR _block >= _reset_block")
    return last.groupBy("id").agg(
        F.max("_reset_block").isNotNull().alias("reset"), F.sum("dead").alias("dead")
    )


def dead_link_counter(probes: DataFrame, bits: int = 16) -> DataFrame:
    """(id, url_dead, link_dead) after all runs: dead adds one, any other answer resets,
    no verdict holds."""
    return dead_link_summary(probes, bits).select(
        "id", F.col("dead").alias("url_dead"), (F.col("dead") >= fv.DEAD_RUNS).alias("link_dead")
    )


def apply_probe_results(tenders: DataFrame, previous: DataFrame, probes: DataFrame, today) -> DataFrame:
    """One run of the link check: hosts whose status code means nothing are healed and
    skipped, only active records with a link are judged."""
    unreliable = tx.url_host("url").isin(*fv.UNRELIABLE_LINK_HOSTS)
    base = tenders
    for name, kind in (("url_dead", "int"), ("link_dead", "boolean"), ("auto_expired", "date")):
        if name not in base.columns:
            base = base.withColumn(name, F.lit(None).cast(kind))
    flagged = F.coalesce(unreliable & ((F.col("url_dead") > 0) | F.col("link_dead")), F.lit(False))
    revive = flagged & F.coalesce(F.col("link_dead"), F.lit(False)) & F.col("auto_expired").isNull()
    healed = base.withColumns({
        "expired": F.when(revive, expired_column(today)).otherwise(F.col("expired")),
        "url_dead": F.when(~flagged, F.col("url_dead")),
        "link_dead": F.when(~flagged, F.col("link_dead")),
    })
    checked = ~F.col("expired") & F.coalesce((F.col("url") != "") & ~unreliable, F.lit(False))
    joined = (
        healed.join(previous.select("id", F.coalesce("url_dead", F.lit(0)).alias("_prev_dead")), "id", "left")
        .join(probes.select("id", "code"), "id", "left")
    )
    before = F.coalesce("_prev_dead", F.lit(0))
    counter = (
        F.when(~checked, F.col("url_dead"))
        .when(is_dead("code"), before + 1)
        .when(F.col("code").isNull() & (before > 0), before)
        .otherwise(F.col("url_dead"))
    )
    dies = checked & is_dead("code") & (before + 1 >= fv.DEAD_RUNS)
    return joined.withColumns({
        "url_dead": counter,
        "link_dead": F.when(dies, F.lit(True)).otherwise(F.col("link_dead")),
        "expired": F.col("expired") | dies,
    }).drop("_prev_dead", "code")


def verify_stub_merge(tenders: DataFrame, verification: DataFrame, today) -> DataFrame:
    """Check registry stubs (no deadline, no state) against a table of source answers.

    verification: id, verdict ('live', 'dead' or NULL for no answer), deadline, state,
    value. Live answers enrich and revive, dead ones expire, no answer changes nothing;
    a stub without any link is dead.
    """
    base = tenders
    for name, kind in (("auto_expired", "date"), ("no_activity", "boolean"), ("no_value", "boolean")):
        if name not in base.columns:
            base = base.withColumn(name, F.lit(None).cast(kind))
    day = as_date(today)
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    due = F.col("auto_expired").isNull() | (F.date_diff(day, "auto_expired") <= fv.STUB_RECHECK_DAYS)
    candidate = (
        blank("deadline") & blank("state") & (F.col("source") == fv.REGISTRY_SOURCE)
        & (~F.col("expired") | F.col("auto_expired").isNotNull()) & due
    )
    v = verification.select("id", *[F.col(c).alias("v_" + c) for c in ("verdict", "deadline", "state", "value")])
    joined = base.join(v, "id", "left")
    has_link = F.coalesce(F.col("url").startswith("http"), F.lit(False))
    verdict = F.when(candidate, F.when(has_link, F.col("v_verdict")).otherwise("dead"))
    joined = joined.withColumn("_verdict", F.coalesce(verdict, F.lit("none")))
    live, dead = F.col("_verdict") == "live", F.col("_verdict") == "dead"
    takes_value = live & F.col("value").isNull() & F.col("v_value").isNotNull()
    step = joined.withColumns({
        "deadline": F.when(live, F.coalesce("v_deadline", "deadline")).otherwise(F.col("deadline")),
        "state": F.when(live | dead, F.coalesce("v_state", "state")).otherwise(F.col("state")),
        "value": F.when(takes_value, F.col("v_value")).otherwise(F.col("value")),
        "no_value": F.when(takes_value, F.lit(False)).otherwise(F.col("no_value")),
        "auto_expired": F.when(live, F.lit(None)).when(dead, F.coalesce("auto_expired", day)).otherwise(F.col("auto_expired")),
        "no_activity": F.when(live, F.lit(None)).when(dead, F.lit(True)).otherwise(F.col("no_activity")),
    })
    return step.withColumn(
        "expired", F.when(live, expired_column(today)).when(dead, F.lit(True)).otherwise(F.col("expired"))
    ).drop("_verdict", "v_verdict", "v_deadline", "v_state", "v_value")


def carry_forward(
    previous: DataFrame, fresh: DataFrame, geo_dropped: DataFrame, merged_away: DataFrame
) -> DataFrame:
    """Earlier records not seen now, not dropped by distance and not merged into another;
    one without deadline and state counts as closed."""
    gone = previous
    for ids in (fresh, geo_dropped, merged_away):
        gone = gone.join(ids.select("id"), "id", "left_anti")
    bare = (F.coalesce("deadline", F.lit("")) == "") & (F.coalesce("state", F.lit("")) == "")
    return gone.withColumn("expired", F.col("expired") | bare)


def days_past(deadline: str, today) -> Column:
    return F.date_diff(as_date(today), deadline_date(deadline))
