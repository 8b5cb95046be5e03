"""Small scalar functions that Spark lacks or evaluates with less precision."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from freshet.functions.nulls import INF, NAN, ratio

# Fixed value: square root of the double-precision machine epsilon.
SQRT_EPSILON = 1.4901161193847656e-08


def log_real(x: Column) -> Column:
    """Natural log with ``log(0) = -inf`` and ``log(negative) = NaN`` (Spark gives NULL for both)."""
    return F.when(x > 0, F.ln(x)).when(x == 0, F.lit(-INF)).when(x.isNotNull(), F.lit(NAN))


def asinh_stable(x: Column) -> Column:
    """Inverse hyperbolic sine that keeps full precision near zero."""
    size = F.abs(x)
    return F.signum(x) * F.log1p(size + size * size / (1 + F.sqrt(size * size + 1)))


def order_of_magnitude(x: Column) -> Column:
    """Power of ten at or below ``|x|``, with the sign of ``x``; 0 stays 0."""
    return F.when(x == 0, F.lit(0.0)).otherwise(F.signum(x) * F.pow(F.lit(10.0), F.floor(F.log10(F.abs(x)))))


def round_any(x: Column, accuracy: float, how: Callable[[Column], Column] = F.bround) -> Column:
    """Round to a multiple of ``accuracy``; the default rounds halves to even."""
    return how(x / F.lit(accuracy)) * F.lit(accuracy)


def is_near(x: Column, y: Column, tolerance: float) -> Column:
    return F.abs(x - y) < F.lit(tolerance)


def clamp_below_zero(x: Column) -> Column:
    """``max(0, x)`` that keeps NULL (``greatest`` would skip it)."""
    return F.when(x > 0, x).when(x.isNotNull(), F.lit(0.0))


def rescale(x: Column, low: Column, high: Column) -> Column:
    """Map ``[low, high]`` linearly onto ``[0, 1]``."""
    return ratio(x - low, high - low)


def bin_width(value: Column, bins: int) -> Column:
    """Aggregate: width of ``bins`` equal bins over the range of ``value``."""
    return (F.max(value) - F.min(value)) / F.lit(float(bins))


def smaller_over_larger(part: Column, whole: Column) -> Column:
    """Ratio of two non-negative numbers with the larger one below the line."""
    return F.when(whole > part, ratio(part, whole)).when(whole <= part, ratio(whole, part))


def label_offset(y: Column, share: float) -> Column:
    """Move a label away from zero by ``share`` of its own value."""
    shift = y * F.lit(share)
    return F.when(y > 0, y + shift).otherwise(y - shift)


def label_height(top: Column, bottom: Column) -> Column:
    """Labels within 10 of zero go to -10 or -1, depending on the range of their panel."""
    spread = F.abs(top - bottom)
    close = is_near(top, F.lit(0.0), 10.0)
    return F.when((spread > 100) & close, F.lit(-10.0)).when((spread < 100) & close, F.lit(-1.0)).otherwise(top)
