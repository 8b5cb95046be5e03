"""Missing-value and division rules of a statistics language, as Spark columns.

Spark aggregates skip nulls and ANSI division by zero fails. The analyses here need the
opposite: one missing input makes the result missing, and ``x / 0`` is an infinity or NaN.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

INF = float("inf")
NAN = float("nan")


def strict(agg: Callable[[Column], Column], value: Column, window: WindowSpec | None = None) -> Column:
    """``agg(value)``, but NULL as soon as one input of the group (or window) is NULL."""
    rows, present, result = F.count(F.lit(1)), F.count(value), agg(value)
    if window is not None:
        rows, present, result = rows.over(window), present.over(window), result.over(window)
    return F.when(rows == present, result)


def strict_sum(value: Column) -> Column:
    return strict(F.sum, value)


def strict_sum_where(condition: Column, value: Column) -> Column:
    """Strict sum over the rows that satisfy ``condition``; NULL when there is none."""
    return F.when(F.count_if(condition & value.isNull()) == 0, F.sum(F.when(condition, value)))


def strict_mean(value: Column) -> Column:
    return strict(F.avg, value)


def strict_median(value: Column) -> Column:
    """Exact median. The groups it is used on hold one row per ensemble member or model."""
    return strict(F.median, value)


def iqr(value: Column) -> Column:
    """Interquartile range with linear interpolation; NULL when any value is missing."""
    present = nan_to_null(value)
    quartiles = F.percentile(present, F.array(F.lit(0.25), F.lit(0.75)))
    return F.when(F.count(F.lit(1)) == F.count(present), quartiles[1] - quartiles[0])


def ratio(numerator: Column, denominator: Column) -> Column:
    """Floating-point division: ``x/0`` is signed infinity, ``0/0`` is NaN."""
    by_zero = (
        F.when(numerator > 0, F.lit(INF)).when(numerator < 0, F.lit(-INF)).when(numerator.isNotNull(), F.lit(NAN))
    )
    return F.when(denominator == 0, by_zero).otherwise(F.try_divide(numerator, denominator))


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def missing(value: Column) -> Column:
    return value.isNull() | F.isnan(value)
