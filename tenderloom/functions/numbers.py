"""Rounding, dates and price arithmetic shared by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tenderloom.functions.text import col


def growth_pct(paid: Column | str, contracted: Column | str) -> Column:
    """Per cent over the contracted price, half-even to one decimal; NULL without both."""
    p, c = col(paid), col(contracted)
    return F.when((p != 0) & (c != 0), F.bround((p / F.nullif(c, F.lit(0.0)) - 1) * 100, 1))


def effective_price(contracted: Column | str, amendments: Column | str) -> Column:
    """Contracted price plus the sum of amendments."""
    return col(contracted) + F.coalesce(col(amendments), F.lit(0.0))


def effective_growth(contracted: Column | str, paid: Column | str, amendments: Column | str) -> Column:
    """Growth of the paid price, else of contracted plus amendments; rounded half-up."""
    c, p, a = col(contracted), col(paid), col(amendments)
    current = F.coalesce(p, F.when(a != 0, c + a))
    return F.when(c != 0, F.floor((current / F.nullif(c, F.lit(0.0)) - 1) * 1000 + 0.5) / 10)


def days_to(deadline: Column | str, today: Column) -> Column:
    """Days left counted to the end of the deadline's day (a deadline today gives 1)."""
    return F.date_diff(deadline_date(deadline), today) + 1


def deadline_date(deadline: Column | str) -> Column:
    return F.substring(col(deadline), 1, 10).try_cast("date")
