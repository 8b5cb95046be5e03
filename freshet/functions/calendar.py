"""Months, seasons, decades and unit changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Season labels, cool months, decade spans.
WARM, COOL = "warm_season", "cool_season"
SEASONS = (WARM, COOL)
COOL_MONTHS = (4, 9)
DECADES = ((1, 1990, 1999), (2, 2005, 2014))

SECONDS_PER_DAY = 60 * 60 * 24


def season_of(month: Column) -> Column:
    """Cool: April to September. Warm: the other months of the same calendar year."""
    return F.when(month.between(*COOL_MONTHS), F.lit(COOL)).when(month.between(1, 12), F.lit(WARM))


def season_rank(season: Column) -> Column:
    """Warm comes before cool within a year."""
    return F.when(season == WARM, F.lit(0)).when(season == COOL, F.lit(1))


def decade_of(year: Column, spans: Sequence[tuple[int, int, int]] = DECADES) -> Column:
    """Label of the span ``(label, first, last)`` that holds ``year``, else NULL."""
    tag = F.lit(None).cast("int")
    for label, first, last in spans:
        tag = F.when(year.between(first, last), F.lit(label)).otherwise(tag)
    return tag


def range_origin(date_range: Column) -> Column:
    """First day of the earliest month in ``yyyyMM-yyyyMM``."""
    months = F.transform(F.split(date_range, "-"), lambda m: F.to_date(F.concat(m, F.lit("01")), "yyyyMMdd"))
    return F.array_min(months)


def offset_date(origin: Column, days: Column) -> Column:
    return F.date_add(origin, F.floor(days).cast("int"))


def days_in_month(date: Column) -> Column:
    return F.dayofmonth(F.last_day(date))


def mm_per_month(flux: Column, date: Column) -> Column:
    """kg m-2 s-1 to mm in the month of ``date``."""
    return flux * F.lit(SECONDS_PER_DAY) * days_in_month(date)


def compact_today() -> Column:
    return F.date_format(F.current_date(), "yyyyMMdd")
