"""Box-Cox and log-sinh transforms with per-row parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions.maths import SQRT_EPSILON, asinh_stable, log_real

# The names by which a transform is chosen.
BOX_COX, BOX_COX_INVERSE = "boxcox_transform", "inverse_boxcox_transform"
LOG_SINH, LOG_SINH_INVERSE = "log_sinh_transform", "inverse_log_sinh_transform"
FORWARD_TRANSFORMS = (LOG_SINH, BOX_COX)
TRANSFORMS = (LOG_SINH, BOX_COX, LOG_SINH_INVERSE, BOX_COX_INVERSE)

# Beyond this exponent exp() nears overflow; asinh(exp(x)) is taken from x itself.
LARGE_EXPONENT = 300.0


def _uses_log(lam: Column) -> Column:
    """Near-zero and all negative lambdas use the log form."""
    return lam <= F.lit(SQRT_EPSILON)


def boxcox(y: Column, lam: Column, offset: Column) -> Column:
    power = F.try_divide(F.pow(y + offset, lam) - 1, lam)
    return F.when(_uses_log(lam), log_real(y + offset)).otherwise(power)


def boxcox_inverse(z: Column, lam: Column, offset: Column) -> Column:
    power = F.pow(z * lam + 1, F.try_divide(F.lit(1.0), lam)) - offset
    return F.when(_uses_log(lam), F.exp(z) - offset).otherwise(power)


def log_sinh(y: Column, b: Column, offset: Column) -> Column:
    """``log(sinh(x)) / b`` with ``x = b (y + offset)``, written so that a large x cannot overflow."""
    x = b * (y + offset)
    large = x - F.lit(0.6931471805599453) + F.log1p(-F.exp(-2 * x))
    return F.try_divide(F.when(x > 1, large).otherwise(log_real(F.sinh(x))), b)


def log_sinh_inverse(z: Column, b: Column, offset: Column) -> Column:
    """``asinh(exp(x)) / b - offset`` with ``x = b z``; ``x + ln 2`` and its small correction when large."""
    x = b * z
    large = x + F.ln(1 + F.sqrt(1 + F.exp(-2 * x)))
    return F.try_divide(F.when(x > LARGE_EXPONENT, large).otherwise(asinh_stable(F.exp(x))), b) - offset


def transform_by_name(method: Column, value: Column, parameter: Column, offset: Column) -> Column:
    """The transform named in each row; the parameter is ``b`` or ``lambda`` accordingly. An unknown name is an error."""
    return (
        F.when(method == LOG_SINH, log_sinh(value, parameter, offset))
        .when(method == BOX_COX, boxcox(value, parameter, offset))
        .when(method == LOG_SINH_INVERSE, log_sinh_inverse(value, parameter, offset))
        .when(method == BOX_COX_INVERSE, boxcox_inverse(value, parameter, offset))
        .when(method.isNotNull(), F.raise_error(F.concat(F.lit("unknown transform "), method)))
    )


def transform_parameters(parameters: DataFrame, keys: list[str]) -> DataFrame:
    """The second-last parameter of each set belongs to the transform."""
    ordered = F.array_sort(F.collect_list(F.struct("parameter_index", "parameter_value")))
    return parameters.groupBy(*keys).agg(F.element_at(ordered, -2)["parameter_value"].alias("transform_parameter"))
