"""Aridity classes and the partitioning effect per class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions.nulls import ratio, strict, strict_mean, strict_sum


def annual_evaporation(daily: DataFrame) -> DataFrame:
    """Yearly sums with the number of values behind them, to notice missing days."""
    return daily.groupBy("year", "gauge").agg(
        strict_sum(F.col("APET_mm")).alias("annual_APET_mm"), F.count(F.lit(1)).alias("n")
    )


def aridity_class(aridity: Column) -> Column:
    """Inclusive bounds, first match wins: 0.2 and 0.5 are semi-arid, 1 is sub-humid."""
    return (
        F.when(aridity.between(0.2, 0.5), F.lit("semi-arid"))
        .when(aridity.between(0.5, 1), F.lit("sub-humid"))
        .when(aridity.between(0.05, 0.2), F.lit("arid"))
        .when(aridity > 1, F.lit("wet"))
    )


def aridity_by_gauge(daily_evaporation: DataFrame, yearly_rain: DataFrame) -> DataFrame:
    """Mean annual rain over mean annual evaporation."""
    evaporation = annual_evaporation(daily_evaporation).groupBy("gauge").agg(
        strict_mean(F.col("annual_APET_mm")).alias("mean_annual_PET")
    )
    rain = yearly_rain.groupBy("gauge").agg(strict_mean(F.col("p_mm")).alias("mean_annual_precip"))
    joined = evaporation.join(rain, "gauge", "left")
    aridity = ratio(F.col("mean_annual_precip"), F.col("mean_annual_PET"))
    return joined.withColumn("aridity", aridity).withColumn("aridity_classification", aridity_class(F.col("aridity")))


def effects_by_aridity(total: DataFrame, aridity: DataFrame) -> DataFrame:
    """Mean, number and spread of the partitioning share per class; no class is a class too."""
    share = F.col("partitioning_effect_CC_percent")
    return total.join(aridity, "gauge", "left").groupBy("aridity_classification").agg(
        strict_mean(share).alias("mean_partitioning_percentage_impact"),
        F.count(F.lit(1)).alias("n"),
        strict(F.stddev_samp, share).alias("sd_partitioning_percentage_impact"),
    )
