"""Model runs to seasonal rain, and observed rain scaled by the ratio of two experiments.

Raw rows (days, months, files) are reduced to seasons first, with partial sums in every task.
All later steps work on at most one row per series, year and season, whatever the input size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.functions.calendar import COOL, WARM, mm_per_month, offset_date, range_origin, season_of, season_rank
from freshet.functions.nulls import nan_to_null, ratio, strict_median, strict_sum
from freshet.operators.reshape import name_positions, sum_to_wide, to_long, to_wide
from freshet.operators.series import Series, centred, rolling

# Experiment labels of the model runs, and the models that cover the whole period.
EXPERIMENTS = {"historical": "historical", "hist-nat": "hist_nat"}
FINAL_MODELS = (
    "ACCESS-CM2",
    "ACCESS-ESM1-5",
    "BCC-CSM2-MR",
    "CNRM-CM6-1",
    "CanESM5",
    "IPSL-CM6A-LR",
    "MRI-ESM2-0",
)
SMOOTHING_ROWS = 20  # ten years of two seasons

SERIES_KEYS = ("GCM", "ensemble_id", "realisation", "gauge")
RATIO = "standardised_warm_season_to_annual_rainfall_ratio"


def dated_runs(runs: DataFrame) -> DataFrame:
    """Wide run rows to one row per run, date and position, in mm per month; ``gauge`` is the position.

    The values ``V1..Vn`` become one array, so a row's ids are not copied once per column before the values are.
    """
    ids = ["GCM", "ensemble_id", "experiment", "realisation", "date"]
    date = offset_date(range_origin(F.col("date_range")), F.col("time_sum"))
    width = sum(c.startswith("V") and c[1:].isdigit() for c in runs.columns)
    values = F.array(*[F.col(f"V{i}") for i in range(1, width + 1)])
    dated = runs.withColumn("date", date).select(*ids, values.alias("values"))
    long = dated.select(*ids, F.posexplode("values").alias("place", "flux"))
    return long.select(
        *ids, (F.col("place") + 1).alias("gauge"), mm_per_month(F.col("flux"), F.col("date")).alias("precipitation_mm")
    )


def tidy_runs(runs: DataFrame, gauges: DataFrame) -> DataFrame:
    """Wide model runs to seasonal rain per gauge.

    ``gauges`` maps ``position`` (the number in ``V1..Vn``) to ``gauge``. The names are joined to
    the seasonal sums, not to the far more numerous monthly values.
    """
    seasonal = seasonal_model_rain(dated_runs(runs)).withColumnRenamed("gauge", "__position")
    seasonal = seasonal.withColumn("__position", F.concat(F.lit("V"), F.col("__position").cast("string")))
    named = name_positions(seasonal, gauges, "__position", "gauge")
    return named.select("year", *SERIES_KEYS, "season", *EXPERIMENTS.values())


def seasonal_model_rain(dated: DataFrame) -> DataFrame:
    """Seasonal sums with one column per experiment; one shuffle of partial sums."""
    tagged = dated.withColumns({"year": F.year("date"), "season": season_of(F.month("date"))})
    return sum_to_wide(
        tagged, ["year", *SERIES_KEYS, "season"], F.col("experiment"), EXPERIMENTS, F.col("precipitation_mm")
    )


def monthly_observed_rain(daily: DataFrame) -> DataFrame:
    return daily.groupBy("year", "month", "gauge").agg(
        strict_sum(F.col("precipitation_mm")).alias("monthly_precipitation_mm")
    )


def seasonal_observed_rain(daily: DataFrame) -> DataFrame:
    """Daily rain summed to seasons.

    A strict sum of monthly strict sums is the strict sum of the days, so one shuffle is enough.
    """
    tagged = daily.withColumn("season", season_of(F.col("month")))
    return tagged.groupBy("year", "gauge", "season").agg(
        strict_sum(F.col("precipitation_mm")).alias("season_obs_precipitation")
    )


def evidence_ratios(fits: DataFrame) -> DataFrame:
    """Evidence for the model with carbon against the one without, per gauge.

    Positive when the carbon model is better, negative when it is worse, NULL when equal or
    when one of the two is missing.
    """
    facts = fits.select("gauge", "contains_CO2", "AIC").distinct()
    wide = to_wide(facts, ["gauge"], F.col("contains_CO2"), {True: "CO2_model", False: "non_CO2_model"}, F.col("AIC"))
    gap = F.col("CO2_model") - F.col("non_CO2_model")
    size = F.exp(F.abs(gap) / 2)
    return wide.select(
        "gauge",
        "CO2_model",
        "non_CO2_model",
        gap.alias("AIC_difference"),
        F.when(gap < 0, size).when(gap > 0, -size).alias("evidence_ratio"),
    )


def gauges_with_evidence(fits: DataFrame, above: float) -> DataFrame:
    return evidence_ratios(fits).where(F.col("evidence_ratio") > above).select("gauge")


def scale_terms(seasonal: DataFrame) -> DataFrame:
    """Ratio of the two experiments where both exist."""
    complete = seasonal.na.drop("any")
    return complete.withColumn("naive_scale_term", ratio(F.col("hist_nat"), F.col("historical")))


def series_in_order(keys: Sequence[str] = SERIES_KEYS) -> Series:
    return Series(tuple(keys), (F.col("year"), season_rank(F.col("season"))))


def smoothed_terms(terms: DataFrame, lengths: Mapping[str, int] | None = None) -> DataFrame:
    """Trailing means over rows (not years) of each series; ``lengths`` maps a name to its rows.

    All lengths share one sort of the series.
    """
    lengths = lengths or {"smooth_scale_term": SMOOTHING_ROWS}
    clean = terms.withColumn("naive_scale_term", nan_to_null(F.col("naive_scale_term")))
    means = {name: (F.avg, "naive_scale_term", rows) for name, rows in lengths.items()}
    return rolling(clean, series_in_order(), means)


def scale_observed(terms: DataFrame, observed: DataFrame, term: str) -> DataFrame:
    """Observed seasonal rain times a scale term, where both exist."""
    joined = terms.join(observed, ["year", "gauge", "season"]).na.drop("any")
    return joined.withColumn("scaled_hist_nat", F.col(term) * F.col("season_obs_precipitation"))


def scaled_rain(seasonal: DataFrame, observed: DataFrame, rows: int = SMOOTHING_ROWS) -> DataFrame:
    smooth = smoothed_terms(scale_terms(seasonal), {"smooth_scale_term": rows})
    scaled = scale_observed(smooth, observed, "smooth_scale_term")
    return scaled.drop("naive_scale_term")


def annual_rain(scaled: DataFrame) -> DataFrame:
    return scaled.groupBy("year", "gauge", "GCM", "ensemble_id").agg(
        strict_sum(F.col("scaled_hist_nat")).alias("annual_rainfall_hist_nat"),
        strict_sum(F.col("season_obs_precipitation")).alias("annual_rainfall_obs"),
    )


def median_annual_rain(scaled: DataFrame, models: Sequence[str] | None = None) -> DataFrame:
    """Median over the ensemble members of each of ``models``, such as ``FINAL_MODELS``; of all by default."""
    kept = scaled if models is None else scaled.where(F.col("GCM").isin(*models))
    return annual_rain(kept).groupBy("year", "gauge", "GCM").agg(
        strict_median(F.col("annual_rainfall_obs")).alias("annual_rainfall_obs"),
        strict_median(F.col("annual_rainfall_hist_nat")).alias("median_GCM_hist_nat"),
    )


def prepared_rain(scaled: DataFrame) -> DataFrame:
    """Annual rain and the centred share of the warm season, per model series."""
    ids = ["year", "GCM", "ensemble_id", "gauge"]
    wide = to_wide(scaled, ids, F.col("season"), {WARM: "warm_season", COOL: "cool_season"}, F.col("scaled_hist_nat"))
    annual = wide.withColumn("annual_scaled_hist_nat_rainfall", F.col("warm_season") + F.col("cool_season"))
    share = nan_to_null(ratio(F.col("warm_season"), F.col("annual_scaled_hist_nat_rainfall")))
    return centred(annual, ["GCM", "ensemble_id", "gauge"], share, RATIO)


def window_sensitivity(terms: DataFrame, observed: DataFrame, lengths: Sequence[int] = (5, 10, 20)) -> DataFrame:
    """Scaled rain for several window lengths, in one pass over the series.

    Median and 90th percentile over the members of a model, then the median over models.
    """
    smooth = smoothed_terms(terms, {f"{n}": n for n in lengths})
    long = to_long(smooth, ["GCM", "gauge", "year", "season"], [f"{n}" for n in lengths], "window_rows", "term")
    per_model = long.groupBy("window_rows", "GCM", "gauge", "year", "season").agg(
        strict_median(F.col("term")).alias("middle"), F.percentile("term", F.lit(0.9)).alias("high")
    )
    over_models = per_model.groupBy("window_rows", "gauge", "year", "season").agg(
        strict_median(F.col("middle")).alias("median_GCM_smooth_scale_term"),
        strict_median(F.col("high")).alias("median_p90_GCM_smooth_scale_term"),
    )
    joined = over_models.join(observed, ["year", "gauge", "season"]).na.drop("any")
    scaled = F.col("median_p90_GCM_smooth_scale_term") * F.col("season_obs_precipitation")
    return joined.withColumns(
        {"window_rows": F.col("window_rows").cast("int"), "median_p90_smooth_scaled_hist_nat": scaled}
    )
