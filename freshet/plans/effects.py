"""Split the change in flow into a rain part and a rain-partitioning part.

Medians are exact. The groups under them hold one value per ensemble member or per model.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions.calendar import DECADES, decade_of
from freshet.functions.maths import smaller_over_larger
from freshet.functions.nulls import iqr, ratio, strict, strict_mean, strict_median, strict_sum
from freshet.operators.reshape import columns_ending, to_long, to_wide
from freshet.operators.series import chunks

# Scenario labels in plot order, effect labels, comparison period.
CO2_ON = "CO2 Model - Observed Precipitation"
CO2_OFF = "Counterfactual - Observed Precipitation"
HIST_NAT = "Counterfactual - Hist Nat Precipitation"
SCENARIOS = (CO2_ON, CO2_OFF, HIST_NAT)
EFFECT_LABELS = {
    "partitioning_effect": "Rainfall-Partitioning Effect",
    "rainfall_effect": "Rainfall Effect",
    "total_effect": "Total Effect",
}
COMPARISON_PERIOD = (1982, 2010)
# Gauges of the main panels, and gauges per supplementary panel.
HANDPICKED = ("606195", "227210", "405240", "319204", "138004B")
PANEL_SIZE = 7
LAST_YEAR = 2014

FLOW = "median_GCM_realspace_streamflow"
SUMS = ("sum_counterfactual_hist_nat", "sum_counterfactual_obs", "sum_CO2_obs")


def ensemble_medians(flow: DataFrame) -> DataFrame:
    """Median over the members of each model, observed series left out."""
    models = flow.where(F.col("GCM") != "observed")
    return models.groupBy("year", "GCM", "gauge").agg(
        strict_median(F.col("realspace_streamflow")).alias("median_ensemble_realspace_streamflow")
    )


def envelope(flow: DataFrame) -> DataFrame:
    """Median, maximum and minimum of the model medians."""
    value = F.col("median_ensemble_realspace_streamflow")
    return ensemble_medians(flow).groupBy("year", "gauge").agg(
        strict_median(value).alias(FLOW),
        strict(F.max, value).alias("max_GCM_realspace_streamflow"),
        strict(F.min, value).alias("min_GCM_realspace_streamflow"),
    )


def stacked_scenarios(flow: DataFrame, fitted: DataFrame, best: DataFrame, last_year: int = LAST_YEAR) -> DataFrame:
    """The three scenarios as one long table.

    ``fitted`` is kept for the best model of each gauge only (``best``: gauge, streamflow_model).
    """
    empty = F.lit(None).cast("double")

    def layout(df: DataFrame, value: str, scenario: str) -> DataFrame:
        return df.select(
            "year",
            "gauge",
            F.col(value).alias(FLOW),
            empty.alias("max_GCM_realspace_streamflow"),
            empty.alias("min_GCM_realspace_streamflow"),
            F.lit(scenario).alias("type"),
        )

    off = layout(flow.where(F.col("GCM") == "observed"), "realspace_streamflow", CO2_OFF)
    chosen = fitted.where(F.col("year") <= last_year).join(best, ["gauge", "streamflow_model"], "left_semi")
    on = layout(chosen, "realspace_modelled_streamflow", CO2_ON)
    return envelope(flow).withColumn("type", F.lit(HIST_NAT)).unionByName(off).unionByName(on)


def supplementary_panels(
    stacked: DataFrame, handpicked: Sequence[str] = HANDPICKED, size: int = PANEL_SIZE
) -> DataFrame:
    """Rows of the gauges outside the main panels, with the number of their panel (``split``)."""
    others = stacked.where((F.col("type") == HIST_NAT) & ~F.col("gauge").isin(*handpicked)).select("gauge")
    return stacked.join(chunks(others, "gauge", size), "gauge", "right")


def scenario_table(stacked: DataFrame) -> DataFrame:
    """One row per year and gauge with all three scenarios; incomplete rows are dropped."""
    labels = {HIST_NAT: "hist_nat", CO2_OFF: "co2_off", CO2_ON: "co2_on"}
    return to_wide(stacked, ["year", "gauge"], F.col("type"), labels, F.col(FLOW)).na.drop("any")


def _sums(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    columns = zip(SUMS, ("hist_nat", "co2_off", "co2_on"), strict=True)
    return table.groupBy(*keys).agg(*[strict_sum(F.col(c)).alias(n) for n, c in columns])


def decompose(sums: DataFrame) -> DataFrame:
    """Absolute total, rain and partitioning effects and the parts relative to the total.

    Where a part exceeds the total, the inverse ratio is taken.
    """
    hist_nat, co2_off, co2_on = (F.col(c) for c in SUMS)
    effects = sums.withColumns(
        {
            "total_effect": F.abs(hist_nat - co2_on),
            "rainfall_effect": F.abs(hist_nat - co2_off),
            "partitioning_effect": F.abs(co2_off - co2_on),
        }
    )
    total = F.col("total_effect")
    return effects.withColumns(
        {
            "relative_rainfall_effect": smaller_over_larger(F.col("rainfall_effect"), total),
            "relative_partitioning_effect": smaller_over_larger(F.col("partitioning_effect"), total),
        }
    )


def decade_effects(table: DataFrame, gauges: DataFrame, spans: Sequence[tuple[int, int, int]] = DECADES) -> DataFrame:
    tagged = table.withColumn("decade", decade_of(F.col("year"), spans)).where(F.col("decade").isNotNull())
    return decompose(_sums(tagged, ["gauge", "decade"])).join(gauges, "gauge", "left")


def period_effects(table: DataFrame, gauges: DataFrame, period: tuple[int, int] = COMPARISON_PERIOD) -> DataFrame:
    within = table.where(F.col("year").between(*period))
    return decompose(_sums(within, ["gauge"])).join(gauges, "gauge", "left")


def signed_share(total: Column, partitioning: Column, hist_nat: Column) -> Column:
    """Total effect over the counterfactual flow; negative for a loss of flow."""
    share = ratio(total, hist_nat)
    return F.when(total < partitioning, share).when(total >= partitioning, -share)


def with_uncertainty(
    flow: DataFrame, effects: DataFrame, spans: Sequence[tuple[int, int, int]] = DECADES
) -> DataFrame:
    """Interquartile range over models of the relative effect and of the signed percentage.

    Every model year of the decade counts here, also years without the other two scenarios. The
    effects meet the few models of their gauge and decade once and are folded back in the same
    aggregate, so neither table is read twice.
    """
    decade = decade_of(F.col("year"), spans)
    per_model = (
        ensemble_medians(flow.where(decade.isNotNull()))
        .groupBy(decade.alias("decade"), "gauge", "GCM")
        .agg(strict_sum(F.col("median_ensemble_realspace_streamflow")).alias("__hist_nat"))
        .drop("GCM")
    )
    joined = effects.join(per_model, ["gauge", "decade"], "left")
    total = F.abs(F.col("__hist_nat") - F.col("sum_CO2_obs"))
    part = F.abs(F.col("sum_counterfactual_obs") - F.col("sum_CO2_obs"))
    percent = signed_share(total, part, F.col("__hist_nat")) * 100
    rest = [c for c in effects.columns if c not in ("gauge", "decade")]
    return joined.groupBy("gauge", "decade").agg(
        *[F.first(c).alias(c) for c in rest],
        iqr(smaller_over_larger(part, total)).alias("range_relative_rainfall_effect"),
        iqr(percent).alias("range_total_CC_percentage_effect"),
    )


def effect_series(table: DataFrame) -> DataFrame:
    """Yearly signed effects, long; a loss of flow is negative."""
    effects = table.select(
        "year",
        "gauge",
        (F.col("hist_nat") - F.col("co2_on")).alias("total_effect"),
        (F.col("hist_nat") - F.col("co2_off")).alias("rainfall_effect"),
        (F.col("co2_off") - F.col("co2_on")).alias("partitioning_effect"),
    )
    long = to_long(effects, ["year", "gauge"], columns_ending(effects, "effect"), "effect", "streamflow")
    label = F.lit(None).cast("string")
    for name, text in EFFECT_LABELS.items():
        label = F.when(F.col("effect") == name, F.lit(text)).otherwise(label)
    return long.withColumns({"streamflow": -F.col("streamflow"), "effect": label})


def total_percent(effects: DataFrame) -> DataFrame:
    """Signed share of the total change and its rain and partitioning parts."""
    share = F.col("total_effect_CC_percent")
    relative = F.col("relative_rainfall_effect")
    signed = signed_share(F.col("total_effect"), F.col("partitioning_effect"), F.col("sum_counterfactual_hist_nat"))
    return effects.withColumn("total_effect_CC_percent", signed).withColumns(
        {"rainfall_effect_CC_percent": relative * share, "partitioning_effect_CC_percent": (1 - relative) * share}
    )


def effect_statistics(total: DataFrame, keys: Sequence[str]) -> DataFrame:
    percent = F.col("total_effect_CC_percent") * 100
    return total.groupBy(*keys).agg(
        strict_mean(percent).alias("mean"),
        strict(F.stddev_samp, percent).alias("sd"),
        strict_mean(F.col("range_total_CC_percentage_effect")).alias("mean_uncertainty"),
        F.count(F.lit(1)).alias("n"),
    )


def effect_statistics_by(total: DataFrame, keys: Sequence[str], over: str, label: str) -> DataFrame:
    """``effect_statistics`` by ``keys`` and ``over``, and by ``keys`` alone with ``label`` in place of ``over``.

    One aggregate over one reading of the rows.
    """
    percent = F.col("total_effect_CC_percent") * 100
    found = total.groupingSets([list(keys), [*keys, over]], *keys, over).agg(
        strict_mean(percent).alias("mean"),
        strict(F.stddev_samp, percent).alias("sd"),
        strict_mean(F.col("range_total_CC_percentage_effect")).alias("mean_uncertainty"),
        F.count(F.lit(1)).alias("n"),
        F.grouping(over).alias("__all"),
    )
    return found.withColumn(over, F.when(F.col("__all") == 1, F.lit(label)).otherwise(F.col(over))).drop("__all")


def contributions(effects: DataFrame) -> DataFrame:
    """Sums over all gauges and the percentage each part contributes to the total."""
    sums = effects.agg(
        *[strict_sum(F.col(c)).alias(f"sum_{c}") for c in ("total_effect", "rainfall_effect", "partitioning_effect")]
    )
    total = F.col("sum_total_effect")
    return sums.withColumns(
        {
            "percent_partitioning_effect": ratio(F.col("sum_partitioning_effect"), total) * 100,
            "percent_rainfall_effect": ratio(F.col("sum_rainfall_effect"), total) * 100,
        }
    )
