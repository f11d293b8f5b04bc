"""Preferences and the relevance model learned from rejected tenders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderloom import fixed_values as fv
from tenderloom.functions import text as tx

PREFERENCE_KINDS = ("watch", "dislikes", "hidden")


def lww_preference_merge(*logs: DataFrame) -> DataFrame:
    """Last writer wins per (kind, id); on equal time the earlier listed log stays."""
    tagged = [log.withColumn("_local", F.lit(-i)) for i, log in enumerate(logs)]
    merged = tagged[0]
    for t in tagged[1:]:
        merged = merged.unionByName(t, allowMissingColumns=True)
    columns = [c for c in merged.columns if c not in ("kind", "id", "_local")]
    return merged.groupBy("kind", "id").agg(
        F.max_by(F.struct(*columns), F.struct("ts", "_local")).alias("e")
    ).select("kind", "id", "e.*")


def active_preferences(merged: DataFrame, kind: str) -> DataFrame:
    """Entries still switched on; switched-off ones remain as history in the log."""
    return merged.where((F.col("kind") == kind) & F.col("on")).drop("kind", "on", "ts")


def document_frequency(titles: DataFrame, title: str = "title") -> DataFrame:
    """Number of titles that contain each word of four or more characters."""
    words = titles.select(F.explode(tx.long_tokens(title)).alias("token"))
    return words.groupBy("token").agg(F.count("*").alias("df"))


def common_words(titles: DataFrame, title: str = "title") -> Column:
    """Words found in more than max(4, 1 % of rows) titles, as one scalar array.

    At most (100 x mean words per title) words can be that common, whatever the number
    of titles, so the array has a bounded size.
    """
    rows = titles.agg(F.count("*").alias("n"))
    limit = rows.select(F.greatest(F.lit(4), F.floor(F.col("n") * 0.01 + 0.5))).scalar()
    frequent = document_frequency(titles, title).where(F.col("df") > limit)
    return frequent.agg(F.collect_list("token").alias("tokens")).scalar()


def title_tokens(title: Column | str, common: Column) -> Column:
    """Distinctive words: long enough, no stop word, not common across the data."""
    stop = F.array(*map(F.lit, fv.STOP_WORDS))
    words = F.coalesce(tx.long_tokens(title), F.array().cast("array<string>"))
    return F.array_except(F.array_except(words, stop), common)


def fingerprint(tenders: DataFrame, common: Column) -> DataFrame:
    """Frozen description of a tender at the moment it is rejected."""
    cpv = F.coalesce(F.col("cpv"), F.array().cast("array<string>"))
    return tenders.select(
        "id",
        F.struct(
            tx.code_prefixes(cpv, 4).alias("cpv"),
            F.coalesce("authority_ico", F.lit("")).alias("ico"),
            title_tokens("title", common).alias("toks"),
            "title",
        ).alias("fp"),
    )


def dislike_model(disliked: DataFrame) -> DataFrame:
    """(kind, key, n): how often each CPV group, buyer and word was rejected."""
    keys = disliked.select(F.explode(F.concat(
        F.transform("fp.cpv", lambda g: F.struct(F.lit("cpv").alias("kind"), g.alias("key"))),
        F.array(F.struct(F.lit("ico").alias("kind"), F.col("fp.ico").alias("key"))),
        F.transform("fp.toks", lambda w: F.struct(F.lit("tok").alias("kind"), w.alias("key"))),
    )).alias("k")).select("k.*")
    return keys.where(F.col("key") != "").groupBy("kind", "key").agg(F.count("*").alias("n"))


def irrelevance_reason(
    tenders: DataFrame, fingerprints: DataFrame, model: DataFrame, disliked: DataFrame, watched: DataFrame
) -> DataFrame:
    """(id, reason): rejected directly, or guessed from repeated rejections; one row per id.

    Watched tenders are never hidden by a guess; construction codes switch the guesses by
    code and buyer off.
    """
    core = F.exists(F.coalesce(F.col("cpv"), F.array().cast("array<string>")), lambda c: c.startswith("45"))
    base = tenders.select("id", core.alias("core")).join(fingerprints, "id")
    # only keys that reach a threshold can matter, and they are few
    strong = model.where(
        ((F.col("kind") == "cpv") & (F.col("n") >= fv.DISLIKES_PER_GROUP))
        | ((F.col("kind") == "ico") & (F.col("n") >= fv.DISLIKES_PER_BUYER))
        | ((F.col("kind") == "tok") & (F.col("n") >= fv.DISLIKES_PER_TOKEN))
    )
    coded = F.when(F.col("core"), F.array().cast("array<string>"))
    keys = base.select("id", F.posexplode(F.concat(
        F.transform(F.coalesce(coded, F.col("fp.cpv")), lambda g: F.struct(F.lit("cpv").alias("kind"), g.alias("key"))),
        F.transform(F.coalesce(coded, F.array("fp.ico")), lambda i: F.struct(F.lit("ico").alias("kind"), i.alias("key"))),
        F.transform("fp.toks", lambda w: F.struct(F.lit("tok").alias("kind"), w.alias("key"))),
    )).alias("pos", "k")).select("id", "pos", "k.*")
    kind = F.col("kind")
    hits = keys.join(strong, ["kind", "key"]).groupBy("id").agg(
        F.min_by(F.struct("key", "n"), F.when(kind == "cpv", F.col("pos"))).alias("cpv"),
        F.max(F.when(kind == "ico", F.col("n"))).alias("ico_n"),
        F.sort_array(F.collect_list(F.when(kind == "tok", F.struct("pos", "key")))).alias("toks"),
    )
    words = F.array_join(F.transform("toks", lambda t: t["key"]), ", ")
    guess = (
        F.when(F.col("cpv").isNotNull(), F.concat(
            F.lit("odhad: CPV "), F.col("cpv.key"), F.lit("* odmítnuto "), F.col("cpv.n").cast("string"), F.lit("×")))
        .when(F.col("ico_n").isNotNull(), F.concat(
            F.lit("odhad: zadavatel odmítnut "), F.col("ico_n").cast("string"), F.lit("×")))
        .when(F.size("toks") >= fv.MATCHING_TOKENS, F.concat(
            F.lit("odhad: název podobný odmítnutým ("), words, F.lit(")")))
    )
    mark = lambda df, name, value=F.lit(None).cast("string"): df.select(
        "id", F.lit(name).alias("mark"), value.alias("guess"))
    marks = mark(tenders, "row").unionByName(mark(disliked, "direct")).unionByName(mark(watched, "starred")) \
        .unionByName(mark(hits, "guess", guess)).where("id IS NOT NULL")
    has = lambda name: F.bool_or(F.col("mark") == name).alias(name)
    by_id = marks.groupBy("id").agg(has("row"), has("direct"), has("starred"), F.max("guess").alias("guess")).where("row")
    reason = F.when(F.col("direct"), F.lit("odmítnuto 👎")).when(~F.col("starred"), F.col("guess"))
    return by_id.select("id", reason.alias("reason")).where("reason IS NOT NULL")
