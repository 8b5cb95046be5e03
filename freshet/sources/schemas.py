"""Declared schemas of the tables that are read. Gauge ids stay strings: leading zeros matter."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)


def _schema(fields: dict[str, DataType], required: tuple[str, ...] = ()) -> StructType:
    return StructType([StructField(n, t, n not in required) for n, t in fields.items()])


OBSERVED_YEARLY = _schema(
    {
        "year": IntegerType(),
        "gauge": StringType(),
        "p_mm": DoubleType(),
        "q_mm": DoubleType(),
        "drought": BooleanType(),
        "CO2": DoubleType(),
        "standardised_warm_season_to_annual_rainfall_ratio": DoubleType(),
    },
    required=("year", "gauge"),
)

MODEL_PARAMETERS = _schema(
    {
        "gauge": StringType(),
        "streamflow_model": StringType(),
        "parameter": StringType(),
        "parameter_value": DoubleType(),
        "AIC": DoubleType(),
        "contains_CO2": BooleanType(),
    },
    required=("gauge", "streamflow_model", "parameter"),
)

GAUGE_INFORMATION = _schema(
    {"gauge": StringType(), "lat": DoubleType(), "lon": DoubleType(), "state": StringType()},
    required=("gauge",),
)

FITTED_FLOW = _schema(
    {
        "gauge": StringType(),
        "streamflow_model": StringType(),
        "year": IntegerType(),
        "realspace_modelled_streamflow": DoubleType(),
    },
    required=("gauge", "streamflow_model", "year"),
)

RUN_INDEX = _schema(
    {"gauge": StringType(), "start_index": IntegerType(), "end_index": IntegerType(), "length": IntegerType()},
    required=("gauge",),
)

SERIES = _schema(
    {
        "gauge": StringType(),
        "year": IntegerType(),
        "precipitation": DoubleType(),
        "observed_streamflow": DoubleType(),
        "is_drought_year": BooleanType(),
        "CO2": DoubleType(),
        "seasonal_ratio": DoubleType(),
    },
    required=("gauge", "year"),
)


def wide_daily(gauges: list[str]) -> StructType:
    """Date parts and one value column per gauge."""
    parts: dict[str, DataType] = {n: IntegerType() for n in ("year", "month", "day")}
    return _schema({**parts, **{g: DoubleType() for g in gauges}})


def wide_run(width: int) -> StructType:
    """Day offset and value columns ``V1..Vwidth``."""
    return _schema({"time_sum": DoubleType(), **{f"V{i}": DoubleType() for i in range(1, width + 1)}})
