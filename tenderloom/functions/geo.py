"""Distances and inflected place names as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tenderloom import fixed_values as fv
from tenderloom.functions.text import col


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    a1, o1, a2, o2 = (F.radians(col(x)) for x in (lat1, lon1, lat2, lon2))
    h = F.pow(F.sin((a2 - a1) / 2), 2) + F.cos(a1) * F.cos(a2) * F.pow(F.sin((o2 - o1) / 2), 2)
    return 2 * fv.EARTH_RADIUS_KM * F.asin(F.sqrt(h))


def inflect_variants(word: Column | str) -> Column:
    """All inflected forms of a folded word; words under three letters stay alone."""
    w = col(word)
    none = F.array().cast("array<string>")

    def forms(cut: int, endings) -> Column:
        stem = F.left(w, F.length(w) - cut)
        return F.array(*[F.concat(stem, F.lit(e)) for e in endings])

    parts = []
    for ending, cut, endings in fv.INFLECTION_RULES:
        applies = w == ending if ending in fv.WHOLE_WORD_RULES else F.endswith(w, F.lit(ending))
        parts.append(F.when(applies, forms(cut, endings)).otherwise(none))
    parts.append(F.when(~w.rlike("[aeiouy]$"), forms(0, fv.CONSONANT_ENDINGS)).otherwise(none))
    inflected = F.array_distinct(F.concat(F.array(w), *parts))
    return F.when(F.length(w) >= 3, inflected).otherwise(F.array(w))
