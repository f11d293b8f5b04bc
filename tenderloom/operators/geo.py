"""Gazetteer matching, location of records and the radius filter."""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderloom import fixed_values as fv
from tenderloom.functions import text as tx
from tenderloom.functions.geo import haversine_km, inflect_variants
from tenderloom.materialize import materialize
from tenderloom.settings import Settings


def distance_from_center(lat, lon, settings: Settings = Settings()) -> Column:
    return haversine_km(F.lit(settings.center[0]), F.lit(settings.center[1]), lat, lon)


def gazetteer_index(gazetteer: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per place and inflected form of its first word."""
    words = tx.tokens(tx.norm_geo("name"))
    named = gazetteer.select("name", "lat", "lon", words.alias("words")).where(F.size("words") > 0)
    usable = named.where((F.size("words") > 1) | (F.length(F.get("words", F.lit(0))) >= 3))
    return usable.select(
        F.explode(inflect_variants(F.get("words", F.lit(0)))).alias("first"),
        F.size("words").alias("nwords"),
        F.transform(F.slice("words", F.lit(2), F.size("words")), inflect_variants).alias("rest"),
        "lat", "lon",
        distance_from_center("lat", "lon", settings).alias("dist"),
    )


def gazetteer_match(
    texts: DataFrame, gazetteer: DataFrame, keys: list[str], text: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """Best place named in each text: more words first, then nearest to the centre.

    Every token position becomes a short row, the token and the next one, joined to the place index
    on the token; that decides names of up to two words. Where longer names agree so far, and only
    there, the text of the position is read again and the rest of the name compared. So no row is
    longer than two tokens, whatever the longest name, and texts without such a position stay put.
    """
    index = gazetteer_index(gazetteer, settings)
    split = texts.select(*keys, tx.tokens(tx.norm_geo(text)).alias("w"))
    positions = split.select(*keys, "w", F.posexplode("w").alias("pos", "first")).select(
        *keys, "pos", "first", F.get("w", F.col("pos") + 1).alias("second"))
    second = F.coalesce(F.array_contains(F.get("rest", F.lit(0)), F.col("second")), F.lit(False))
    hits = materialize(positions.join(index, "first").where((F.col("nwords") == 1) | second).select(
        *keys, "pos", "nwords", F.when(F.col("nwords") > 2, F.col("rest")).alias("rest"), "lat", "lon", "dist"), "places")
    longer = hits.where("nwords > 2").alias("h")
    same = reduce(and_, [F.col(f"h.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys])
    agrees = F.forall(
        F.arrays_zip(F.slice("w", F.col("pos") + 2, F.col("nwords") - 1).alias("word"), F.col("rest").alias("forms")),
        lambda p: F.coalesce(F.array_contains(p["forms"], p["word"]), F.lit(False)),
    )
    whole = longer.join(split.alias("t"), same).where(agrees).select(*[f"h.{c}" for c in hits.columns])
    best = F.struct("nwords", -F.col("dist"), -F.col("lat"), -F.col("lon"))
    return hits.where("nwords <= 2").unionByName(whole).groupBy(*keys).agg(
        F.max_by(F.struct("lat", "lon", "nwords"), best).alias("place")
    ).select(*keys, "place.lat", "place.lon", "place.nwords")


def profile_coordinates(source: Column, settings: Settings) -> tuple[Column, Column]:
    pairs = [(fv.PROFILE_PREFIX + p[0], p[1], p[2]) for p in settings.profiles if not p[6]]
    lat = F.create_map(*[F.lit(x) for k, la, _ in pairs for x in (k, la)])
    lon = F.create_map(*[F.lit(x) for k, _, lo in pairs for x in (k, lo)])
    return F.try_element_at(lat, source), F.try_element_at(lon, source)


def locate(tenders: DataFrame, gazetteer: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(id, dist_exact): place text, title, district seat, buyer seat, town in the buyer's
    name, configured profile - the first that yields a place."""
    municipal = tx.first_group(tx.norm_title("authority"), fv.MUNICIPAL_PATTERN)
    texts = tenders.select(
        "id",
        F.posexplode(F.array("place", "title", F.lit(None).cast("string"), "authority_seat", municipal))
        .alias("prio", "text"),
    ).where(F.col("text").isNotNull())
    from_text = gazetteer_match(texts, gazetteer, ["id", "prio"], settings=settings).select(
        "id", "prio", distance_from_center("lat", "lon", settings).alias("d")
    )
    seats = F.create_map(*[
        x for k, (la, lo) in fv.DISTRICT_SEATS.items()
        for x in (F.lit(k), F.struct(F.lit(la).alias("lat"), F.lit(lo).alias("lon")))
    ])
    seat = F.get(
        F.filter(
            F.transform("nuts", lambda n: F.try_element_at(seats, F.substring(n, 1, 6))),
            lambda s: s.isNotNull(),
        ),
        F.lit(0),
    )
    lat, lon = profile_coordinates(F.col("source"), settings)
    # two of the steps are plain columns of the record; the texts come back once
    before, after = F.col("prio") < 2, F.col("prio") > 2
    named = from_text.groupBy("id").agg(
        F.min_by(F.when(before, F.col("d")), F.when(before, F.col("prio"))).alias("_first"),
        F.min_by(F.when(after, F.col("d")), F.when(after, F.col("prio"))).alias("_later"),
    )
    own = tenders.select("id", seat.alias("s"), lat.alias("lat"), lon.alias("lon")).select(
        "id", distance_from_center("s.lat", "s.lon", settings).alias("_district"),
        distance_from_center("lat", "lon", settings).alias("_profile"),
    )
    return own.join(named, "id", "left").select(
        "id", F.coalesce("_first", "_district", "_later", "_profile").alias("dist_exact")
    ).where("dist_exact IS NOT NULL").groupBy("id").agg(F.min("dist_exact").alias("dist_exact"))


class RadiusResult(NamedTuple):
    kept: DataFrame
    dropped: DataFrame          # ids located beyond the radius


def _split_by_radius(located: DataFrame, settings: Settings) -> RadiusResult:
    located = materialize(located, "located")          # kept and dropped are parts of one stored frame
    far = F.coalesce(F.col("dist_exact") > settings.radius_km, F.lit(False))
    kept = located.where(~far)
    if not settings.keep_unknown_location:
        kept = kept.where("dist_exact IS NOT NULL")
    kept = kept.withColumns({
        "dist_km": F.bround("dist_exact", 0).cast("int"),
        "loc_unknown": F.col("dist_exact").isNull(),
    })
    return RadiusResult(kept.drop("dist_exact"), located.where(far).select("id"))


def radius_filter(tenders: DataFrame, distances: DataFrame, settings: Settings = Settings()) -> RadiusResult:
    """Unknown position is kept and flagged, up to the radius kept with rounded km."""
    return _split_by_radius(tenders.join(distances, "id", "left"), settings)


def relocate_unknown(tenders: DataFrame, gazetteer: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Locate again only what was unknown; known positions are not touched."""
    unknown = tenders.where("coalesce(loc_unknown, false)")
    again = radius_filter(unknown.drop("dist_km", "loc_unknown"), locate(unknown, gazetteer, settings), settings)
    return tenders.where("NOT coalesce(loc_unknown, false)").unionByName(again.kept, allowMissingColumns=True)
