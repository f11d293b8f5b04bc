"""Linking awarded tenders to signed contracts and their amendments.

Contracts: id, verze, url, platny, ico_zadavatel, parties array<struct<ico,nazev>>,
predmet, datum, hodnota, parent, ord (position in the dump).
Competition: id, authority_ico, winner_ico ('; '-joined), awarded, price_contracted.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderloom.functions import text as tx
from tenderloom.materialize import materialize
from tenderloom.operators.dedup import prune_orphans
from tenderloom.operators.filters import as_date
from tenderloom.operators.nearest import nearest_contracts
from tenderloom.settings import Settings

# Dates are matched through bins as wide as the longest window, so an interval touches
# two bins at most and the join has an equality on (buyer, supplier, bin).
_EPOCH = "1970-01-01"
PASS_ROWS = 60_000_000          # awards and contracts that are paired at a time


def _bin(date: Column, days: int) -> Column:
    return F.floor(F.date_diff(date, F.lit(_EPOCH).cast("date")) / days)


def _day(c: str) -> Column:
    """The date in the first ten characters; NULL for anything shorter or unreadable."""
    text = F.substring(c, 1, 10)
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))


def _present(c: str) -> Column:
    return F.coalesce(F.trim(c) != "", F.lit(False))


def contract_candidates(
    competition: DataFrame, contracts: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """(tender_id, contract row) for equal buyer, a common supplier and a close date.

    Joined on (buyer, supplier, date bin), never on the buyer alone. A pair with several
    common suppliers is kept once, at the first winner both sides share.
    """
    return _pairs(_awarded(competition), _usable(contracts), settings)


def _awarded(competition: DataFrame) -> DataFrame:
    """Tenders with a buyer, winners and an award date."""
    return competition.where(_present("authority_ico") & _present("winner_ico")).select(
        F.col("id").alias("tender_id"),
        F.trim("authority_ico").alias("buyer"),
        F.array_distinct(F.filter(F.split("winner_ico", "; "), lambda w: w != "")).alias("winners"),
        _day("awarded").alias("awarded"),
        "price_contracted",
    ).where("awarded IS NOT NULL")


def signed_contracts(contracts: DataFrame) -> DataFrame:
    """The rows and columns that ``contract_matches`` looks at, for whoever stores them beforehand."""
    return contracts.where(F.col("platny") & ~_present("parent") & _day("datum").isNotNull()).select(
        "id", "verze", "url", "platny", "ico_zadavatel", "parties", "datum", "hodnota", "parent", "ord")


def _usable(contracts: DataFrame) -> DataFrame:
    """Valid signed contracts that are no amendments."""
    return contracts.where(F.col("platny") & ~_present("parent")).select(
        F.col("id").alias("contract_id"), "verze", "url", _day("datum").alias("signed"), "hodnota", "ord",
        F.col("ico_zadavatel").alias("buyer"),
        F.array_distinct(F.filter(F.transform("parties", lambda p: p["ico"]), lambda i: i != "")).alias("parties"),
    ).where("signed IS NOT NULL")


def _pairs(tenders: DataFrame, usable: DataFrame, settings: Settings) -> DataFrame:
    before, after = settings.contract_days_before, settings.contract_days_after
    width = before + after + 1
    # only where both sides have several can a pair meet at another than its first common supplier
    several = lambda c: F.when(F.size(c) > 1, F.col(c)).alias(c)
    tenders = tenders.select("*", F.explode("winners").alias("supplier")).select(
        "tender_id", "buyer", several("winners"), "awarded", "price_contracted", "supplier",
        F.explode(F.sequence(
            _bin(F.date_sub("awarded", before), width), _bin(F.date_add("awarded", after), width)
        )).alias("bin"),
    )
    usable = usable.select("*", F.explode("parties").alias("supplier"), _bin(F.col("signed"), width).alias("bin")) \
        .withColumn("parties", several("parties"))
    first = F.coalesce(F.get(F.array_intersect("winners", "parties"), F.lit(0)) == F.col("supplier"), F.lit(False))
    pairs = tenders.join(usable, ["buyer", "supplier", "bin"]).where(
        F.col("signed").between(F.date_sub("awarded", before), F.date_add("awarded", after))
        & (F.col("winners").isNull() | F.col("parties").isNull() | first)
    )
    return pairs.select(
        "tender_id", "awarded", "price_contracted", "contract_id", "verze", "url", "signed", "hodnota", "ord"
    )


def _version_rank() -> Column:
    """Versions compare as numbers, then as text; of equal ones the first in the dump is newer."""
    return F.struct(F.col("verze").try_cast("bigint").alias("n"), F.col("verze").alias("text"), (-F.col("ord")).alias("place"))


def _newest(candidates: DataFrame) -> DataFrame:
    """One row per tender and contract: its newest version, at the place where it was first seen."""
    return candidates.groupBy("tender_id", "contract_id").agg(
        F.max_by(F.struct("price_contracted", "url", "signed", "hodnota"), _version_rank()).alias("c"),
        F.min("ord").alias("ord"),
    ).select("tender_id", "contract_id", "c.*", "ord")


def _best(newest: DataFrame, settings: Settings) -> DataFrame:
    price = F.col("price_contracted")
    diff = F.when(
        (price != 0) & (F.col("hodnota") != 0),
        F.abs(F.col("hodnota") - price) / F.nullif(price, F.lit(0.0)),
    )
    scored = newest.withColumn("diff", diff)
    exact = F.when(F.col("diff") <= settings.price_tolerance, F.col("contract_id"))
    # an exact match sorts before the rest because its difference is the smallest
    quality = F.struct(F.col("diff").isNull(), F.coalesce("diff", F.lit(0.0)), "ord", "contract_id")
    best = scored.groupBy("tender_id").agg(
        F.min(exact).alias("least"), F.max(exact).alias("most"),
        F.min_by(F.struct("contract_id", "url", F.col("signed").alias("date"),
                          F.col("hodnota").alias("price")), quality).alias("best"),
    )
    return best.select(
        "tender_id", "best.*",
        F.when(F.col("least") == F.col("most"), F.lit("high")).otherwise(F.lit("low")).alias("confidence"),
    )


def contract_best_match(candidates: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One contract per tender: the only price match is 'high', anything else 'low'."""
    return _best(_newest(candidates), settings)


def _pairs_by_parts(tenders: DataFrame, usable: DataFrame, rows: int, settings: Settings) -> DataFrame:
    """``_pairs`` of stored frames, a part of the buyers at a time if there are many rows: pairs are few, and
    the shuffle files of one part at a time are on disk."""
    parts = max(1, math.ceil(rows / PASS_ROWS))
    if parts == 1:
        return _pairs(tenders, usable, settings)
    of = lambda df, i: df.where(F.pmod(F.xxhash64("buyer"), F.lit(parts)) == i)
    return reduce(DataFrame.unionByName, [
        materialize(_pairs(of(tenders, i), of(usable, i), settings), "pairs") for i in range(parts)])


def contract_matches(
    competition: DataFrame, contracts: DataFrame, settings: Settings = Settings(), stored: bool = False
) -> DataFrame:
    """``contract_best_match`` of all candidates, also where one buyer and supplier have very many.

    A tender of a pair with at most ``settings.paired_contracts`` contract versions meets them in the
    join of ``contract_candidates``. Tenders of larger pairs search their contracts by price
    (``nearest_contracts``). Two kinds of rows of those stay with the join, because nearness does not
    decide them: tenders with a negative price, and contracts whose versions name different parties,
    for tenders with several winners. ``stored`` says that both frames are read from files as they are.
    """
    # read for the count and for the match
    usable = _usable(contracts) if stored else materialize(_usable(contracts), "contracts")
    one_each = usable.select("*", F.explode("parties").alias("supplier"))
    large = one_each.groupBy("buyer", "supplier").agg(F.count("*").alias("n")).where(
        F.col("n") > settings.paired_contracts).select("buyer", "supplier")
    if large.isEmpty():
        awards = _awarded(competition)
        rows = awards.count() + usable.count() if stored else 0
        return _best(_newest(_pairs_by_parts(awards, usable, rows, settings)), settings)
    tenders = materialize(_awarded(competition), "awards")
    asking = tenders.select("tender_id", "buyer", F.explode("winners").alias("supplier")).join(
        large, ["buyer", "supplier"], "left_semi").select("tender_id").distinct()
    few = tenders.join(asking, "tender_id", "left_anti")
    many = tenders.join(asking, "tender_id", "left_semi").select("*", F.explode("winners").alias("supplier"))
    # contracts of the buyers and suppliers that these tenders name
    near = one_each.join(many.select("buyer", "supplier").distinct(), ["buyer", "supplier"], "left_semi")
    parties = F.array_sort("parties")
    uneven = near.groupBy("buyer", "contract_id").agg(
        F.min(parties).alias("a"), F.max(parties).alias("b")).where("a != b").select("buyer", "contract_id")
    negative = F.col("price_contracted") < 0
    several = F.size("winners") > 1
    steady = near.join(uneven, ["buyer", "contract_id"], "left_anti")
    epoch = F.lit(_EPOCH).cast("date")
    by_price = lambda rows, versions: nearest_contracts(
        rows.select("tender_id", "buyer", "supplier", F.date_diff("awarded", epoch).alias("day"), "price_contracted"),
        versions.select("buyer", "supplier", "contract_id", _version_rank().alias("rank"), "url", "signed",
                        F.date_diff("signed", epoch).alias("day"), "hodnota", "ord"), settings)
    plain = ~F.coalesce(negative, F.lit(False))
    found = by_price(many.where(plain & ~several), near).unionByName(by_price(many.where(plain & several), steady))
    whole = [c for c in usable.columns]
    left = _pairs(many.where(negative).drop("supplier").distinct(), usable, settings).unionByName(
        _pairs(many.where(plain & several).drop("supplier").distinct(),
               usable.join(uneven, ["buyer", "contract_id"], "left_semi").select(*whole), settings))
    newest = _newest(_pairs(few, usable, settings).unionByName(left))
    return _best(newest.unionByName(found.select(*newest.columns)), settings)


def link_upsert(previous: DataFrame, fresh: DataFrame) -> DataFrame:
    """New links over old ones; a 'high' link is never lowered nor moved to another contract."""
    fields = ("contract_id", "url", "date", "price", "confidence")
    old = previous.select("tender_id", F.struct(*fields).alias("old"))
    new = fresh.select("tender_id", F.struct(*fields).alias("new"))
    locked = (F.col("old.confidence") == "high") & (
        (F.col("old.contract_id") != F.col("new.contract_id")) | (F.col("new.confidence") == "low")
    )
    keep_old = F.col("new").isNull() | F.coalesce(locked, F.lit(False))
    both = old.join(new, "tender_id", "full")
    return both.select("tender_id", F.when(keep_old, F.col("old")).otherwise(F.col("new")).alias("l")).select(
        "tender_id", "l.*"
    )


def one_contract_per_low_link(links: DataFrame, competition: DataFrame) -> DataFrame:
    """Among 'low' links to one contract keep the closest in price, then in date."""
    tenders = competition.select(
        F.col("id").alias("tender_id"), "price_contracted", _day("awarded").alias("awarded")
    )
    low = links.where("confidence = 'low'").select("tender_id", "contract_id", "date", "price").join(
        tenders, "tender_id", "left"
    )
    price = F.col("price_contracted")
    price_gap = F.when(
        (price != 0) & (F.col("price") != 0), F.abs(F.col("price") - price) / F.nullif(price, F.lit(0.0))
    ).otherwise(9e9)
    date_gap = F.coalesce(F.abs(F.date_diff("date", "awarded")), F.lit(2**30))
    keepers = low.groupBy("contract_id").agg(
        F.min_by("tender_id", F.struct(price_gap, date_gap, "tender_id")).alias("tender_id")
    )
    kept_low = links.where("confidence = 'low'").join(keepers, ["contract_id", "tender_id"], "left_semi")
    return links.where("confidence <> 'low'").unionByName(kept_low.select(*links.columns))


def amendment_rows(contracts: DataFrame) -> DataFrame:
    """Valid records that name a parent contract."""
    return contracts.where(F.col("platny") & _present("parent")).select(
        F.col("parent").alias("contract_id"), F.col("id").alias("amendment_id"),
        F.substring("datum", 1, 10).alias("date"), F.col("hodnota").alias("value"), "url", "ord",
    )


def latest_amendments(amendments: DataFrame) -> DataFrame:
    """The last record of each amendment, which is all that ``amendment_attach`` looks at."""
    return amendments.groupBy("contract_id", "amendment_id").agg(
        F.max_by(F.struct("date", "value", "url", "ord"), "ord").alias("a")
    ).select("contract_id", "amendment_id", "a.*")


def amendment_attach(links: DataFrame, amendments: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Amendments of each link: last record per amendment id, the earliest ones kept.

    Amendments come from a table of all dumps so far, so one published before its parent
    was linked is not lost, and every surviving link of the contract receives it.
    """
    latest = amendments.groupBy("contract_id", "amendment_id").agg(
        F.max_by(F.struct("date", "value", "url"), "ord").alias("a")
    ).select("contract_id", "amendment_id", "a.*")
    first = Window.partitionBy("contract_id").orderBy(F.coalesce("date", F.lit("")), "amendment_id")
    kept = latest.withColumn("n", F.row_number().over(first)).where(F.col("n") <= settings.max_amendments)
    per_contract = kept.groupBy("contract_id").agg(
        F.sort_array(F.collect_list(
            F.struct("n", F.col("amendment_id").alias("id"), "date", "value", "url")
        )).alias("list"),
        F.count("*").alias("amendments_count"),
        F.round(F.coalesce(F.sum("value"), F.lit(0.0)), 2).alias("amendments_total"),
    ).withColumn("amendments", F.transform("list", lambda a: a.dropFields("n"))).drop("list")
    return links.drop("amendments", "amendments_count", "amendments_total").join(
        per_contract, "contract_id", "left"
    ).withColumns({
        "amendments_count": F.coalesce("amendments_count", F.lit(0)),
        "amendments_total": F.coalesce("amendments_total", F.lit(0.0)),
    })


def _awarded_near(competition: DataFrame, contracts: DataFrame, settings: Settings) -> DataFrame:
    """The awards whose window some contract's day can lie in; no other award has a match."""
    signed = contracts.agg(F.min(_day("datum")).alias("first"), F.max(_day("datum")).alias("last")).first()
    if signed["first"] is None:
        return competition.limit(0)
    return competition.where(_day("awarded").between(
        F.date_sub(F.lit(signed["first"]), settings.contract_days_after),
        F.date_add(F.lit(signed["last"]), settings.contract_days_before)))


def link_month(
    competition: DataFrame, contracts: DataFrame, previous: DataFrame, settings: Settings = Settings(), pruned: bool = False
) -> DataFrame:
    """Fold one month's dump into the links (exact matches and versions are judged per dump). ``pruned``
    says that no link of before is of a tender that is gone; links of this dump never are."""
    fresh = contract_matches(_awarded_near(competition, contracts, settings), contracts, settings, stored=True)
    unique = one_contract_per_low_link(link_upsert(previous, fresh), competition)
    return unique if pruned else prune_orphans(
        unique, competition.select(F.col("id").alias("tender_id")), "tender_id"
    )


def link_dumps(
    competition: DataFrame, contracts: DataFrame, previous: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Apply every dump (column ``dump``) to the links, oldest first."""
    # read again for every dump, so stored once
    competition = materialize(competition.select("id", "authority_ico", "winner_ico", "awarded", "price_contracted"), "competition")
    contracts = materialize(contracts.select(
        "dump", "id", "verze", "url", "platny", "ico_zadavatel", "parties", "datum", "hodnota", "parent", "ord")
        .sortWithinPartitions("dump"), "dumps")       # a dump's rows lie together, and the others are passed over
    links = previous
    # one value per dump, a handful per run
    dumps = [r["dump"] for r in contracts.select("dump").distinct().orderBy("dump").toLocalIterator()]
    for i, dump in enumerate(dumps):
        links = materialize(link_month(competition, contracts.where(F.col("dump") == dump), links, settings, pruned=i > 0))
    return links


def link_confidence_counts(links: DataFrame) -> DataFrame:
    return links.agg(
        F.count("*").alias("linked"),
        F.count_if(F.col("confidence") == "high").alias("high"),
        F.count_if(F.col("confidence") == "low").alias("low"),
    )


def watch_specs(tenders: DataFrame, watched: DataFrame, today, spec_days: int = 120, window_days: int = 90) -> DataFrame:
    """Watched tenders whose deadline passed at most ``spec_days`` ago, with their search window."""
    due = _day("deadline")
    return tenders.join(watched.select("id"), "id", "left_semi").select(
        "id", F.col("authority_ico").alias("buyer"), tx.sig_tokens("title").alias("title_tokens"), due.alias("from_date")
    ).where(
        F.date_diff(as_date(today), "from_date").between(0, spec_days)
    ).withColumn("to_date", F.date_add("from_date", window_days))


def watched_contract_match(specs: DataFrame, contracts: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """First contract in dump order that shares at least half of the title words.

    Contracts of one buyer, day and set of words are first reduced to the earliest. Then the words of
    a title are ordered by how many contracts of its buyer have them: half of n words are shared only
    if one of the n // 2 + 1 rarest is, so contracts meet a title by those and are compared once met.
    Where any word decides (titles of one or two), the earliest contract of each word and day stands
    for all others. A word that most contracts of a buyer have thus brings none of them to a title
    that has rarer ones.
    """
    if found is not None:
        specs = specs.join(found.select("id"), "id", "left_anti")
    wanted = specs.where((F.size("title_tokens") > 0) & F.col("buyer").isNotNull()).select(
        "id", "buyer", "title_tokens", "from_date", "to_date").distinct()
    texts = materialize(_subjects(contracts, wanted.select("buyer").distinct()), "subjects")
    best = _first_shared(wanted, texts)
    return best if found is None else found.unionByName(best)


def _subjects(contracts: DataFrame, buyers: DataFrame) -> DataFrame:
    """(buyer, signed, words, contract, place): the earliest contract of each set of subject words."""
    signed = _day("datum")
    supplier = F.coalesce(
        F.get(F.filter(
            "parties", lambda p: (F.coalesce(p["ico"], F.lit("")) != F.col("ico_zadavatel")) & (p["nazev"] != "")
        ), F.lit(0))["nazev"],
        F.get(F.filter(F.reverse("parties"), lambda p: p["nazev"] != ""), F.lit(0))["nazev"],
    )
    usable = contracts.where(F.col("platny") & ~_present("parent")).select(
        F.col("ico_zadavatel").alias("buyer"), signed.alias("signed"), F.sort_array(tx.sig_tokens("predmet")).alias("words"),
        F.struct(F.col("id").alias("contract_id"), "url", signed.alias("date"), F.col("hodnota").alias("price"),
                 supplier.alias("supplier")).alias("contract"),
        F.struct("ord", F.col("id").alias("contract_id")).alias("place"),
    ).where("signed IS NOT NULL AND size(words) > 0").join(buyers, "buyer", "left_semi")
    return usable.groupBy("buyer", "signed", "words").agg(
        F.min_by("contract", "place").alias("contract"), F.min("place").alias("place"))


def _first_shared(wanted: DataFrame, texts: DataFrame) -> DataFrame:
    """The earliest contract of ``texts`` for each title that shares half of its words with one."""
    width = 91
    words = texts.select("*", F.explode("words").alias("word"))
    by_day = words.groupBy("buyer", "word", "signed").agg(
        F.min_by("contract", "place").alias("contract"), F.min("place").alias("place"))
    frequency = words.groupBy("buyer", "word").agg(F.count("*").alias("n"))
    rarest = F.sort_array(F.collect_list(F.struct("n", "word")))
    n_words = F.size("title_tokens")
    # words that no contract has are the rarest of all, and meet none
    asked = wanted.select("*", F.explode("title_tokens").alias("word")).join(frequency, ["buyer", "word"], "left") \
        .withColumn("n", F.coalesce("n", F.lit(0))).groupBy(*wanted.columns).agg(rarest.alias("rarest")) \
        .select(*wanted.columns, F.explode(F.slice("rarest", F.lit(1), F.floor(n_words / 2).cast("int") + 1)).alias("w")) \
        .where("w.n > 0").select(*wanted.columns, "w.word", F.explode(F.sequence(
            _bin(F.col("from_date"), width), _bin(F.col("to_date"), width))).alias("bin"))
    near = F.col("signed").between(F.col("from_date"), F.col("to_date"))
    half = F.size(F.array_intersect("title_tokens", "words")) * 2 >= n_words
    met = lambda titles, rows: titles.join(
        rows.withColumn("bin", _bin(F.col("signed"), width)), ["buyer", "bin", "word"]).where(near)
    hits = met(asked.where(n_words <= 2), by_day).select("id", "contract", "place").unionByName(
        met(asked.where(n_words > 2), words).where(half).select("id", "contract", "place"))
    return hits.groupBy("id").agg(F.min_by("contract", "place").alias("c")).select("id", "c.*")
