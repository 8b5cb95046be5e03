"""Align model and observed series, cut them into segments and regenerate flow.

All tables here hold one row per series and year.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.functions.maths import SQRT_EPSILON
from freshet.operators.flow_models import bind_parameters, score, without_carbon
from freshet.operators.series import Series, assign_segments, positions, valid_runs
from freshet.operators.transforms import log_sinh_inverse
from freshet.plans.rain import RATIO

OBSERVED = "observed"
MODEL_KEYS = ("gauge", "GCM", "ensemble_id")

# Fixed values: (year, gauge) pairs left out of every series.
EXCLUDED_YEARS = (
    (1961, "216002"),
    (1963, "216002"),
    (1978, "235205"),
    (1963, "227213"),
    (1981, "415223"),
    (1986, "415223"),
)

OUTPUT_COLUMNS = (
    "gauge",
    "GCM",
    "ensemble_id",
    "year",
    "precipitation",
    "observed_streamflow",
    "is_drought_year",
    "CO2",
    "seasonal_ratio",
    "transformed_streamflow",
    "realspace_streamflow",
)


def lift_zero_flow(observed: DataFrame) -> DataFrame:
    """Add a tiny amount to flow so that zero flow can be transformed."""
    return observed.withColumn("q_mm", F.col("q_mm") + F.lit(SQRT_EPSILON))


def excluded_years(spark: SparkSession, pairs: Sequence[tuple[int, str]] = EXCLUDED_YEARS) -> DataFrame:
    return spark.createDataFrame(list(pairs), "year int, gauge string")


def as_model_series(observed: DataFrame) -> DataFrame:
    """Observed rain in the layout of the model series, under the name ``observed``."""
    return observed.select(
        "year",
        "gauge",
        F.col("p_mm").alias("annual_scaled_hist_nat_rainfall"),
        RATIO,
        F.lit(OBSERVED).alias("GCM"),
        F.lit(OBSERVED).alias("ensemble_id"),
    )


def attach_observed(series: DataFrame, observed: DataFrame) -> DataFrame:
    """Observed flow, drought and CO2 on every series of the gauge, by year."""
    return series.join(observed.drop("p_mm", RATIO), ["gauge", "year"], "left")


def aligned_series(
    prepared: DataFrame,
    observed: DataFrame,
    excluded: DataFrame,
    start: int = 1959,
    end: int = 2014,
    short_below: int = 50,
) -> DataFrame:
    """Model and observed series of one common period.

    Kept are the model series that start by ``start``, end in ``end`` and reach into the observed
    period, unless their row count differs from the observed one and is below ``short_below``.
    The listed (year, gauge) pairs are left out of every series. The facts of a series come from
    windows over it, so the prepared rain is read once.
    """
    observed = observed.where(F.col("year") <= end)
    is_observed, by_series = F.col("GCM") == OBSERVED, Window.partitionBy(*MODEL_KEYS)
    facts = observed.groupBy("gauge").agg(
        F.min("year").alias("__obs_start"),
        F.nullif(F.count_if(F.col("year") >= start), F.lit(0)).alias("__obs_count"),
    )
    stacked = prepared.drop("warm_season", "cool_season").unionByName(as_model_series(observed))
    spans = stacked.withColumns({"__first": F.min("year").over(by_series), "__last": F.max("year").over(by_series)})
    spans = spans.where(is_observed | ((F.col("__first") <= start) & (F.col("__last") == end)))
    common = spans.where(F.col("year") >= start).withColumn("__count", F.count(F.lit(1)).over(by_series))
    known = common.join(facts, "gauge")
    reaches = F.col("__last") > F.col("__obs_start")
    short = (F.col("__count") != F.col("__obs_count")) & (F.col("__count") < short_below)
    kept = known.where(is_observed | (reaches & ~F.coalesce(short, F.lit(False))))
    clean = kept.join(excluded, ["year", "gauge"], "left_anti")
    dated = attach_observed(clean, observed).withColumnRenamed("annual_scaled_hist_nat_rainfall", "p_mm")
    return dated.select("year", *MODEL_KEYS, "p_mm", RATIO, "q_mm", "drought", "CO2")


def observed_runs(aligned: DataFrame, minimum: int = 2) -> DataFrame:
    """Stretches of observed flow per gauge, as row positions of the observed series."""
    rows = aligned.where(F.col("GCM") == OBSERVED)
    return valid_runs(rows, Series(("gauge",), (F.col("year"),)), "q_mm", minimum)


def segmented_series(aligned: DataFrame, runs: DataFrame) -> DataFrame:
    """Cut every series of a gauge at the positions found on its observed series."""
    numbered = positions(aligned, Series(MODEL_KEYS, (F.col("year"),)))
    segments = assign_segments(numbered, runs, ["gauge"])
    return segments.select(
        *MODEL_KEYS,
        "segment_id",
        "year",
        F.col("p_mm").alias("precipitation"),
        F.col("q_mm").alias("observed_streamflow"),
        F.col("drought").alias("is_drought_year"),
        "CO2",
        F.col(RATIO).alias("seasonal_ratio"),
    )


def regenerated_flow(segments: DataFrame, parameters: DataFrame) -> DataFrame:
    """Flow of every series with the carbon terms switched off, back in real units."""
    bound = bind_parameters(without_carbon(parameters), ["gauge"])
    carry = ["precipitation", "observed_streamflow", "is_drought_year", "CO2", "seasonal_ratio"]
    scored = score(segments, bound, ["gauge"], [*MODEL_KEYS, "segment_id"], "year", carry)
    real = log_sinh_inverse(F.col("transformed_streamflow"), F.col("transform_parameter"), F.lit(0.0))
    return scored.withColumn("realspace_streamflow", real).select(*OUTPUT_COLUMNS)
