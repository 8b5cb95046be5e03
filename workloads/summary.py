"""Queries on grouped aggregates and distribution summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.functions.calendar import season_of
from freshet.functions.maths import bin_width, rescale
from freshet.functions.nulls import iqr, strict_sum
from freshet.operators import summaries
from freshet.operators.quality import extents
from freshet.operators.series import chunks, global_positions
from freshet.plans import effects, rain
from freshet.session import stored
from workloads.registry import query
from workloads.standin import PERIOD, ROLL, SPANS, Tables
from workloads.tidy import rounded


def scenario_rows(t: Tables) -> DataFrame:
    return effects.scenario_table(effects.stacked_scenarios(t.regenerated, t.fitted, t.best))


def decade_rows(t: Tables) -> DataFrame:
    return effects.decade_effects(scenario_rows(t), t.gauges, SPANS)


def uncertain_rows(t: Tables) -> DataFrame:
    """Two branches read the flow table, so it is written first."""
    table = effects.scenario_table(effects.stacked_scenarios(t.flow_table, t.fitted, t.best))
    return effects.with_uncertainty(t.flow_table, effects.decade_effects(table, t.gauges, SPANS), SPANS)


def period_rows(t: Tables) -> DataFrame:
    return effects.total_percent(effects.period_effects(scenario_rows(t), t.gauges, PERIOD))


def smoothed_rows(t: Tables) -> DataFrame:
    return rain.scaled_rain(t.seasonal_model, t.seasonal_obs, ROLL)


@query(
    "a_monthly",
    """
    SELECT year, month, gauge, round(sum(precipitation_mm), 6) AS monthly_precipitation_mm
    FROM rain_obs GROUP BY 1, 2, 3""",
    "rain_obs",
)
def a_monthly(t: Tables) -> DataFrame:
    return rounded(rain.monthly_observed_rain(t.rain_obs))


@query(
    "a_seasonal",
    "SELECT year, gauge, season, round(season_obs_precipitation, 6) AS season_obs_precipitation FROM seasonal_obs",
    "seasonal_obs",
)
def a_seasonal(t: Tables) -> DataFrame:
    return rounded(t.seasonal_obs)


@query(
    "a_annual",
    """
    SELECT year, gauge, "GCM", ensemble_id, round(sum(scaled_hist_nat), 4) AS annual_rainfall_hist_nat,
           round(sum(season_obs_precipitation), 4) AS annual_rainfall_obs
    FROM scaled GROUP BY 1, 2, 3, 4""",
    "scaled",
)
def a_annual(t: Tables) -> DataFrame:
    """Two measures summed over the seasons of a year."""
    return rounded(rain.annual_rain(smoothed_rows(t)), 4)


@query(
    "a_ensemble_median",
    """
    SELECT year, gauge, "GCM", round(median(o), 4) AS annual_rainfall_obs, round(median(h), 4) AS median_GCM_hist_nat
    FROM (SELECT year, gauge, "GCM", ensemble_id, sum(scaled_hist_nat) AS h, sum(season_obs_precipitation) AS o
          FROM scaled GROUP BY 1, 2, 3, 4)
    WHERE "GCM" IN ('A', 'N', 'R') GROUP BY 1, 2, 3""",
    "scaled",
)
def a_ensemble_median(t: Tables) -> DataFrame:
    """Exact median over ensemble members, for a list of models."""
    return rounded(rain.median_annual_rain(smoothed_rows(t), ("A", "N", "R")), 4)


@query(
    "a_envelope",
    """
    SELECT year, gauge, round(med, 6) AS median_GCM_realspace_streamflow,
           round(top, 6) AS max_GCM_realspace_streamflow, round(low, 6) AS min_GCM_realspace_streamflow
    FROM envelope""",
    "envelope",
)
def a_envelope(t: Tables) -> DataFrame:
    """Median, maximum and minimum over models of the member medians."""
    return rounded(effects.envelope(t.regenerated))


@query(
    "a_p90",
    """
    SELECT gauge, year, season, round(median(m), 6) AS middle, round(median(p), 6) AS high FROM (
        SELECT "GCM", gauge, year, season, median(naive_scale_term) AS m, quantile_cont(naive_scale_term, 0.9) AS p
        FROM terms GROUP BY 1, 2, 3, 4)
    GROUP BY 1, 2, 3""",
    "terms",
)
def a_p90(t: Tables) -> DataFrame:
    """Median and 90th percentile per model, then the median over models."""
    term = F.col("naive_scale_term")
    per_model = rain.scale_terms(t.seasonal_model).groupBy("GCM", "gauge", "year", "season").agg(
        F.median(term).alias("m"), F.percentile(term, F.lit(0.9)).alias("p")
    )
    return rounded(
        per_model.groupBy("gauge", "year", "season").agg(F.median("m").alias("middle"), F.median("p").alias("high"))
    )


@query(
    "a_extent",
    """
    SELECT gauge, "GCM", ensemble_id, min(year) AS first_year, max(year) AS last_year
    FROM regenerated GROUP BY 1, 2, 3""",
    "regenerated",
)
def a_extent(t: Tables) -> DataFrame:
    return extents(t.regenerated, ["gauge", "GCM", "ensemble_id"], "year", "first_year", "last_year")


@query(
    "a_count",
    'SELECT "GCM", ensemble_id, gauge, count(*) AS n FROM rain_model GROUP BY 1, 2, 3',
    "rain_model",
)
def a_count(t: Tables) -> DataFrame:
    return t.rain_model.groupBy("GCM", "ensemble_id", "gauge").agg(F.count(F.lit(1)).alias("n"))


@query("a_distinct", 'SELECT DISTINCT "GCM", ensemble_id, gauge FROM rain_model', "rain_model")
def a_distinct(t: Tables) -> DataFrame:
    return t.rain_model.select("GCM", "ensemble_id", "gauge").distinct()


@query(
    "a_members",
    """SELECT "GCM", count(*) AS n FROM (SELECT DISTINCT "GCM", ensemble_id FROM rain_model) GROUP BY 1""",
    "rain_model",
)
def a_members(t: Tables) -> DataFrame:
    """Ensemble members per model."""
    return t.rain_model.select("GCM", "ensemble_id").distinct().groupBy("GCM").agg(F.count(F.lit(1)).alias("n"))


@query(
    "a_iqr",
    """
    SELECT gauge, year, round(quantile_cont(m, 0.75) - quantile_cont(m, 0.25), 6) AS spread
    FROM medians GROUP BY 1, 2""",
    "medians",
)
def a_iqr(t: Tables) -> DataFrame:
    """Interquartile range over the models."""
    spread = iqr(F.col("median_ensemble_realspace_streamflow"))
    return rounded(effects.ensemble_medians(t.regenerated).groupBy("gauge", "year").agg(spread.alias("spread")))


_STATISTICS = """
    round(avg(share * 100), 6) AS mean, round(stddev_samp(share * 100), 6) AS sd,
    round(avg(range_total_CC_percentage_effect), 6) AS mean_uncertainty, count(*) AS n FROM total"""


@query(
    "a_mean_sd",
    f"""
    SELECT decade, state, {_STATISTICS} GROUP BY decade, state
    UNION ALL SELECT decade, 'all' AS state, {_STATISTICS} GROUP BY decade""",
    "total",
)
def a_mean_sd(t: Tables) -> DataFrame:
    """Mean, spread and number by decade, and by decade and state."""
    total = effects.total_percent(uncertain_rows(t))
    return rounded(effects.effect_statistics_by(total, ["decade"], "state", "all"))


@query(
    "a_count_if",
    "SELECT count(*) AS n FROM effects WHERE decade = 2 AND relative_partitioning_effect >= 0.5",
    "effects",
)
def a_count_if(t: Tables) -> DataFrame:
    """Gauges where partitioning is at least half of the change."""
    return decade_rows(t).where(F.col("decade") == 2).agg(
        F.count_if(F.col("relative_partitioning_effect") >= 0.5).alias("n")
    )


@query(
    "a_mean",
    "SELECT round(avg(relative_partitioning_effect), 6) AS mean FROM effects WHERE decade = 1",
    "effects",
)
def a_mean(t: Tables) -> DataFrame:
    return rounded(decade_rows(t).where(F.col("decade") == 1).agg(F.avg("relative_partitioning_effect").alias("mean")))


@query(
    "a_contribution",
    """
    SELECT round(sum(total_effect), 4) AS sum_total_effect, round(sum(rainfall_effect), 4) AS sum_rainfall_effect,
           round(sum(partitioning_effect), 4) AS sum_partitioning_effect,
           round(sum(partitioning_effect) / sum(total_effect) * 100, 4) AS percent_partitioning_effect,
           round(sum(rainfall_effect) / sum(total_effect) * 100, 4) AS percent_rainfall_effect
    FROM effects WHERE decade = 2""",
    "effects",
)
def a_contribution(t: Tables) -> DataFrame:
    return rounded(effects.contributions(decade_rows(t).where(F.col("decade") == 2)), 4)


@query(
    "a_exceedance",
    """
    SELECT round(avg(CASE WHEN smooth_scale_term > 2 THEN 1.0 ELSE 0.0 END) * 100, 6) AS percent_above,
           count(*) AS n FROM scaled""",
    "scaled",
)
def a_exceedance(t: Tables) -> DataFrame:
    """Percentage of scale terms above 2."""
    return rounded(
        smoothed_rows(t).agg(
            summaries.share_above(F.col("smooth_scale_term"), 2.0).alias("percent_above"),
            F.count(F.lit(1)).alias("n"),
        )
    )


@query(
    "a_ecdf",
    """
    SELECT round(x, 6) AS x, round((SELECT count(*) FROM scaled WHERE smooth_scale_term <= x)
                                   / (SELECT count(*) FROM scaled), 9) AS y
    FROM (SELECT CAST(i AS DOUBLE) * (8.3 / 99) AS x FROM range(100) r(i))""",
    "scaled",
)
def a_ecdf(t: Tables) -> DataFrame:
    """Share of scale terms up to each of 100 grid points from 0 to 8.3."""
    curve = summaries.ecdf_on_grid(smoothed_rows(t), "smooth_scale_term", 0.0, 8.3, 100)
    return curve.select(F.round("x", 6).alias("x"), F.round("y", 9).alias("y"))


@query(
    "a_histogram",
    """
    SELECT CAST(least(30, floor((smooth_scale_term - low) / w) + 1) AS INTEGER) AS bin, round(any_value(w), 6) AS width,
           count(*) AS n
    FROM scaled, (SELECT min(smooth_scale_term) AS low, (max(smooth_scale_term) - min(smooth_scale_term)) / 30 AS w
                  FROM scaled) GROUP BY 1""",
    "scaled",
)
def a_histogram(t: Tables) -> DataFrame:
    """Counts in 30 equal bins."""
    bins = summaries.histogram(stored(smoothed_rows(t), "smoothed"), "smooth_scale_term", 30)
    return bins.select("bin", F.round("width", 6).alias("width"), "n")


@query(
    "a_facet_extent",
    """
    SELECT row_number() OVER (ORDER BY "GCM") AS row_number, "GCM", round(left_x + left_x * 0.1::DOUBLE, 6) AS xlab,
           round(CASE WHEN h > 0 THEN h + h * 0.05 ELSE h - h * 0.05 END, 6) AS ylab, round(low, 6) AS min_ylab,
           round(top - low, 6) AS range_ylab, chr(CAST(64 + row_number() OVER (ORDER BY "GCM") AS INTEGER)) AS label_name
    FROM (SELECT *, CASE WHEN abs(top - low) > 100 AND abs(top) < 10 THEN -10
                         WHEN abs(top - low) < 100 AND abs(top) < 10 THEN -1 ELSE top END AS h
          FROM (SELECT "GCM", max(realspace_streamflow) AS top, min(realspace_streamflow) AS low
                FROM regenerated GROUP BY 1), (SELECT min(year) AS left_x FROM regenerated))""",
    "regenerated",
)
def a_facet_extent(t: Tables) -> DataFrame:
    """Letter positions per panel: one panel per model."""
    order = global_positions(t.flow_table.select("GCM").distinct(), ["GCM"], "row_number")
    return rounded(summaries.facet_labels(t.flow_table, "GCM", "year", "realspace_streamflow", order, 0.1, 0.05))


@query(
    "a_range",
    """
    SELECT round(min(range_relative_rainfall_effect), 6) AS low, round(max(range_relative_rainfall_effect), 6) AS high,
           round(min(share), 6) AS low_share, round(max(share), 6) AS high_share,
           round((max(share) - min(share)) / 30, 6) AS width FROM total""",
    "total",
)
def a_range(t: Tables) -> DataFrame:
    """Ranges over all gauges, and the bin width they give."""
    share, spread = F.col("total_effect_CC_percent"), F.col("range_relative_rainfall_effect")
    return rounded(
        effects.total_percent(uncertain_rows(t)).agg(
            F.min(spread).alias("low"),
            F.max(spread).alias("high"),
            F.min(share).alias("low_share"),
            F.max(share).alias("high_share"),
            bin_width(share, 30).alias("width"),
        )
    )


@query(
    "a_any_drought",
    """
    SELECT gauge, bool_or(drought) AS contains_drought, round(sum(p_mm), 4) AS total FROM obs_yearly GROUP BY 1""",
    "obs_yearly",
)
def a_any_drought(t: Tables) -> DataFrame:
    return t.obs_yearly.groupBy("gauge").agg(
        F.bool_or("drought").alias("contains_drought"), F.round(F.sum("p_mm"), 4).alias("total")
    )


@query(
    "a_label_list",
    """
    SELECT split, coalesce(string_agg(labelled, ', ' ORDER BY i) FILTER (i < n) || ' and ', '')
                  || max(labelled) FILTER (i = n) || '.' AS caption
    FROM (SELECT split, gauge || ' (' || chr(CAST(64 + i AS INTEGER)) || ')' AS labelled, i, max(i) OVER (PARTITION BY split) AS n
          FROM (SELECT gauge, CAST(ceil(p / 7) AS INTEGER) AS split, (p - 1) % 7 + 1 AS i
                FROM (SELECT gauge, row_number() OVER (ORDER BY gauge) AS p
                      FROM (SELECT DISTINCT gauge FROM rain_model)))) GROUP BY split""",
    "rain_model",
)
def a_label_list(t: Tables) -> DataFrame:
    """Sorted gauges in sevens, each group as one lettered sentence."""
    return summaries.label_lists(chunks(t.rain_model, "gauge", 7), "split", "gauge")


@query(
    "a_nest",
    """
    SELECT gauge, count(*) AS n_years, array_to_string(list(
        CAST(year AS VARCHAR) || ':' || CAST(n AS VARCHAR) ORDER BY year), ' ') AS years
    FROM (SELECT gauge, CAST(year(date) AS INTEGER) AS year, CAST(sum(precipitation_mm) AS BIGINT) AS n
          FROM rain_model GROUP BY 1, 2) GROUP BY gauge""",
    "rain_model",
)
def a_nest(t: Tables) -> DataFrame:
    """Yearly records of a gauge as one ordered list."""
    yearly = t.rain_model.groupBy("gauge", F.year("date").alias("year")).agg(
        F.sum("precipitation_mm").cast("long").alias("n")
    )
    lists = summaries.nested(yearly, ["gauge"], "year", ["n"], "records")
    text = F.transform("records", lambda r: F.concat_ws(":", r["year"].cast("string"), r["n"].cast("string")))
    return lists.select("gauge", F.size("records").cast("long").alias("n_years"), F.array_join(text, " ").alias("years"))


@query(
    "a_rescale",
    """
    SELECT year, gauge, season, round((s - min(s) OVER w) / (max(s) OVER w - min(s) OVER w), 6) AS unit
    FROM (SELECT year, gauge, season, season_obs_precipitation AS s FROM seasonal_obs)
    WINDOW w AS (PARTITION BY gauge)""",
    "seasonal_obs",
)
def a_rescale(t: Tables) -> DataFrame:
    """Seasonal rain of each gauge mapped onto [0, 1]; the ranges are summed up first and joined."""
    value = F.col("season_obs_precipitation")
    ranges = t.seasonal_obs.groupBy("gauge").agg(F.min(value).alias("low"), F.max(value).alias("high"))
    unit = rescale(value, F.col("low"), F.col("high"))
    return rounded(t.seasonal_obs.join(ranges, "gauge").select("year", "gauge", "season", unit.alias("unit")))


@query(
    "a_strict_sum",
    """
    SELECT gauge, season, CASE WHEN count(*) = count(q) THEN round(sum(q), 4) END AS total, count(*) AS n_rows, count(q) AS n_values
    FROM (SELECT gauge, CASE WHEN t % 12 BETWEEN 3 AND 8 THEN 'cool_season' ELSE 'warm_season' END AS season, q
          FROM flow_monthly) GROUP BY 1, 2""",
    "flow_monthly",
)
def a_strict_sum(t: Tables) -> DataFrame:
    """Sums that are missing as soon as one value is missing."""
    season = season_of(F.col("t") % 12 + 1)
    return t.flow_monthly.groupBy("gauge", season.alias("season")).agg(
        F.round(strict_sum(F.col("q")), 4).alias("total"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count("q").alias("n_values"),
    )
