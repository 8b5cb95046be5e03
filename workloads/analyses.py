"""Queries on data checks and whole analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.operators.quality import covered_series, empty_segments, missing_series, row_mismatches, schema_report
from freshet.operators.series import Series, valid_runs
from freshet.plans import aridity, effects, flow, rain
from freshet.plans.drought import drought_flags
from freshet.session import new_table_path, stored
from freshet.sources.readers import read_model_runs
from freshet.sources.schemas import OBSERVED_YEARLY
from freshet.sources.writers import write_named_csv
from workloads.registry import query
from workloads.standin import END_YEAR, START_YEAR, Tables, model_scores, model_terms
from workloads.summary import decade_rows, period_rows, scenario_rows, smoothed_rows, uncertain_rows
from workloads.tidy import _wide_run_rows, _wide_runs_sql, rounded

# Checks


@query(
    "k_schema",
    """
    SELECT column_name, found_type, true AS type_ok, n_rows, n_missing, may_be_missing,
           may_be_missing OR n_missing = 0 AS ok
    FROM (SELECT count(*) AS n_rows, count(*) - count(q_mm) AS q, count(*) - count(p_mm) AS p FROM obs_yearly),
         LATERAL (VALUES ('year', 'int', 0, false), ('gauge', 'string', 0, false), ('p_mm', 'double', p, true),
                 ('q_mm', 'double', q, true), ('drought', 'boolean', 0, true), ('CO2', 'double', 0, true),
                 ('standardised_warm_season_to_annual_rainfall_ratio', 'double', 0, true))
         v(column_name, found_type, n_missing, may_be_missing)""",
    "obs_yearly",
)
def k_schema(t: Tables) -> DataFrame:
    """Declared against found types, and missing values, per column."""
    return schema_report(t.obs_yearly, OBSERVED_YEARLY)


@query(
    "q_missing_series",
    """
    SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS gauge FROM customer
    EXCEPT SELECT gauge FROM rain_model""",
    "rain_model",
)
def q_missing_series(t: Tables) -> DataFrame:
    """Wanted gauges without a single row of model rain; every customer number is wanted."""
    wanted = t.raw("customer").select(F.col("c_custkey").cast("string").alias("gauge"))
    return missing_series(wanted, t.rain_model, ["gauge"])


@query(
    "q_empty_segments",
    """
    SELECT r.gauge, s."GCM", s.ensemble_id, r.start_index, s.n_rows
    FROM obs_runs r JOIN (SELECT gauge, "GCM", ensemble_id, count(*) AS n_rows FROM
        (SELECT gauge, "GCM", ensemble_id, year FROM rain_model_short) GROUP BY 1, 2, 3) s USING (gauge)
    WHERE NOT EXISTS (SELECT 1 FROM range(1, 8) p(i) WHERE i BETWEEN r.start_index AND r.end_index AND i <= s.n_rows)
    """.replace(
        "rain_model_short",
        """(SELECT DISTINCT gauge, "GCM", ensemble_id, year(date) AS year FROM rain_model
            WHERE precipitation_mm > 46 AND year(date) <= 1999)""",
    ),
    "obs_runs",
    "rain_model",
)
def q_empty_segments(t: Tables) -> DataFrame:
    """Runs of a gauge that start after the last row of one of its series."""
    runs = valid_runs(t.obs_yearly, Series(("gauge",), ("year",)), "q_mm", 2)
    wet = t.rain_model.where((F.col("precipitation_mm") > 46) & (F.year("date") <= 1999))
    rows = wet.select("gauge", "GCM", "ensemble_id", F.year("date").alias("year")).distinct()
    return empty_segments(runs, rows, ["gauge"], ["gauge", "GCM", "ensemble_id"]).select(
        "gauge", "GCM", "ensemble_id", "start_index", "n_rows"
    )


@query(
    "q_coverage",
    f"""
    SELECT p.gauge, p."GCM", p.ensemble_id, min(p.year) AS "GCM_start_year", max(p.year) AS "GCM_end_year"
    FROM prepared p JOIN (SELECT gauge, min(year) AS obs_start FROM obs_yearly GROUP BY 1) o USING (gauge)
    GROUP BY p.gauge, p."GCM", p.ensemble_id
    HAVING max(p.year) > any_value(obs_start) AND min(p.year) <= {START_YEAR + 1} AND max(p.year) = {END_YEAR}""",
    "prepared",
    "obs_yearly",
)
def q_coverage(t: Tables) -> DataFrame:
    """Model series that span the required years."""
    return covered_series(rain.prepared_rain(smoothed_rows(t)), t.obs_yearly, START_YEAR + 1, END_YEAR)


@query(
    "q_row_parity",
    """
    SELECT m.gauge, m."GCM", m.ensemble_id, m.n AS "count", o.n AS obs_count
    FROM (SELECT gauge, "GCM", ensemble_id, count(*) AS n FROM prepared GROUP BY 1, 2, 3) m
    JOIN (SELECT gauge, count(*) AS n FROM obs_yearly GROUP BY 1) o USING (gauge)
    WHERE m.n <> o.n AND m.n < 6""",
    "prepared",
    "obs_yearly",
)
def q_row_parity(t: Tables) -> DataFrame:
    """Short model series with another row count than the observed series."""
    prepared = rain.prepared_rain(smoothed_rows(t)).select("gauge", "GCM", "ensemble_id", "year")
    observed = flow.as_model_series(t.obs_yearly).select("gauge", "GCM", "ensemble_id", "year")
    return row_mismatches(prepared.unionByName(observed), F.col("GCM") == flow.OBSERVED, 6)


# Rain


@query(
    "q_tidy",
    f"""
    SELECT CAST(year(date) AS INTEGER) AS year, "GCM", ensemble_id, realisation, gauge,
           CASE WHEN month(date) BETWEEN 4 AND 9 THEN 'cool_season' ELSE 'warm_season' END AS season,
           CASE WHEN count(*) FILTER (experiment = 'historical' AND mm IS NULL) = 0
                THEN round(sum(mm) FILTER (experiment = 'historical'), 6) END AS historical,
           CASE WHEN count(*) FILTER (experiment = 'hist-nat' AND mm IS NULL) = 0
                THEN round(sum(mm) FILTER (experiment = 'hist-nat'), 6) END AS hist_nat
    FROM (SELECT *, flux * 86400 * day(last_day(date)) AS mm FROM (
              SELECT *, unnest([V1, V2, V3, V4, V5, V6, V7]) AS flux,
                     unnest(['g1', 'g2', 'g3', 'g4', 'g5', 'g6', 'g7']) AS gauge
              FROM ({_wide_runs_sql(", ".join(f"sum(CASE WHEN l_linenumber = {i} THEN l_quantity END) / 1e6 AS V{i}" for i in range(1, 8)))})))
    GROUP BY 1, 2, 3, 4, 5, 6""",
)
def q_tidy(t: Tables) -> DataFrame:
    """Wide model runs, read from files under their names, to seasonal rain with one column per experiment."""
    path = new_table_path(t.spark, "runs")
    write_named_csv(_wide_run_rows(t), path, "run")
    runs = read_model_runs(t.spark, [path], 7)
    gauges = t.spark.range(1, 8).select(
        F.col("id").alias("position"), F.concat(F.lit("g"), F.col("id").cast("string")).alias("gauge")
    )
    return rounded(rain.tidy_runs(runs, gauges))


@query(
    "q_evidence",
    "SELECT gauge, round(d, 6) AS \"AIC_difference\", round(evidence_ratio, 4) AS evidence_ratio FROM evidence WHERE evidence_ratio > 10",
    "evidence",
)
def q_evidence(t: Tables) -> DataFrame:
    """Gauges with at least moderate evidence for the carbon model."""
    found = rain.evidence_ratios(t.fits).where(F.col("evidence_ratio") > 10)
    return found.select(
        "gauge",
        F.round("AIC_difference", 6).alias("AIC_difference"),
        F.round("evidence_ratio", 4).alias("evidence_ratio"),
    )


@query(
    "q_scale_naive",
    """
    SELECT year, gauge, season, "GCM", ensemble_id, round(naive_scale_term, 6) AS naive_scale_term,
           round(naive_scale_term * season_obs_precipitation, 4) AS scaled_hist_nat
    FROM terms JOIN seasonal_obs USING (year, gauge, season)""",
    "terms",
    "seasonal_obs",
)
def q_scale_naive(t: Tables) -> DataFrame:
    """Observed rain times the unsmoothed ratio."""
    scaled = rain.scale_observed(rain.scale_terms(t.seasonal_model), t.seasonal_obs, "naive_scale_term")
    return scaled.select(
        "year",
        "gauge",
        "season",
        "GCM",
        "ensemble_id",
        F.round("naive_scale_term", 6).alias("naive_scale_term"),
        F.round("scaled_hist_nat", 4).alias("scaled_hist_nat"),
    )


@query(
    "q_scale_smooth",
    """
    SELECT year, gauge, season, "GCM", ensemble_id, realisation, historical, hist_nat,
           round(smooth_scale_term, 6) AS smooth_scale_term,
           round(season_obs_precipitation, 6) AS season_obs_precipitation,
           round(scaled_hist_nat, 4) AS scaled_hist_nat
    FROM scaled""",
    "scaled",
)
def q_scale_smooth(t: Tables) -> DataFrame:
    """Observed rain times the smoothed ratio: the flagship."""
    return smoothed_rows(t).withColumns(
        {
            "smooth_scale_term": F.round("smooth_scale_term", 6),
            "season_obs_precipitation": F.round("season_obs_precipitation", 6),
            "scaled_hist_nat": F.round("scaled_hist_nat", 4),
        }
    )


@query(
    "q_prepare_rain",
    """
    SELECT year, "GCM", ensemble_id, gauge, round(warm_season, 4) AS warm_season, round(cool_season, 4) AS cool_season,
           round(annual_scaled_hist_nat_rainfall, 4) AS annual_scaled_hist_nat_rainfall,
           round(standardised_warm_season_to_annual_rainfall_ratio, 4) AS standardised_warm_season_to_annual_rainfall_ratio
    FROM prepared""",
    "prepared",
)
def q_prepare_rain(t: Tables) -> DataFrame:
    return rounded(rain.prepared_rain(smoothed_rows(t)), 4)


# Flow

# One more year than the first: the moving window leaves the first rows of a series empty.
_SHORT = 5


def _aligned(t: Tables) -> DataFrame:
    """Gauges with strong evidence, aligned over the years of the driver's tables."""
    strong = rain.gauges_with_evidence(t.fits, 3.0)
    prepared = rain.prepared_rain(smoothed_rows(t).join(strong, "gauge", "left_semi"))
    observed = t.obs_table.join(strong, "gauge", "left_semi")
    excluded = flow.excluded_years(t.spark, [(1997, "1"), (1999, "12"), (2000, "25")])
    return flow.aligned_series(prepared, observed, excluded, START_YEAR + 1, END_YEAR, _SHORT)


_ALIGNED_SQL = f"""
    , strong AS (SELECT gauge FROM evidence WHERE evidence_ratio > 3),
    stacked AS (
        SELECT year, "GCM", ensemble_id, gauge, annual_scaled_hist_nat_rainfall AS p_mm,
               standardised_warm_season_to_annual_rainfall_ratio AS ratio
        FROM prepared WHERE gauge IN (SELECT gauge FROM strong) AND year >= {START_YEAR + 1}
        UNION ALL
        SELECT year, 'observed', 'observed', gauge, p_mm, standardised_warm_season_to_annual_rainfall_ratio
        FROM obs_yearly WHERE gauge IN (SELECT gauge FROM strong) AND year BETWEEN {START_YEAR + 1} AND {END_YEAR}),
    kept AS (
        SELECT p.gauge, p."GCM", p.ensemble_id FROM prepared p
        JOIN (SELECT gauge, min(year) AS s FROM obs_yearly WHERE year <= {END_YEAR} GROUP BY 1) o USING (gauge)
        GROUP BY p.gauge, p."GCM", p.ensemble_id
        HAVING min(p.year) <= {START_YEAR + 1} AND max(p.year) = {END_YEAR} AND max(p.year) > any_value(s)
        UNION ALL SELECT DISTINCT gauge, 'observed', 'observed' FROM obs_yearly),
    within AS (
        SELECT s.*, o.q_mm, o.drought, o."CO2"
        FROM stacked s SEMI JOIN kept USING (gauge, "GCM", ensemble_id)
        LEFT JOIN obs_yearly o ON o.gauge = s.gauge AND o.year = s.year),
    short AS (
        SELECT m.gauge, m."GCM", m.ensemble_id
        FROM (SELECT gauge, "GCM", ensemble_id, count(*) AS n FROM within WHERE "GCM" <> 'observed' GROUP BY 1, 2, 3) m
        JOIN (SELECT gauge, count(*) AS n FROM within WHERE "GCM" = 'observed' GROUP BY 1) o USING (gauge)
        WHERE m.n <> o.n AND m.n < {_SHORT}),
    aligned AS (
        SELECT * FROM within w ANTI JOIN short USING (gauge, "GCM", ensemble_id)
        WHERE (year, gauge) NOT IN ((1997, '1'), (1999, '12'), (2000, '25')))"""


@query(
    "q_align",
    f"""
    {_ALIGNED_SQL}
    SELECT year, "GCM", ensemble_id, gauge, round(p_mm, 4) AS p_mm, round(q_mm, 6) AS q_mm, drought, "CO2",
           round(ratio, 6) AS ratio FROM aligned""",
    "prepared",
    "obs_yearly",
    "evidence",
)
def q_align(t: Tables) -> DataFrame:
    """Model and observed series over one period, checked and cleaned."""
    return _aligned(t).select(
        "year",
        "GCM",
        "ensemble_id",
        "gauge",
        F.round("p_mm", 4).alias("p_mm"),
        F.round("q_mm", 6).alias("q_mm"),
        "drought",
        "CO2",
        F.round(rain.RATIO, 6).alias("ratio"),
    )


_REGENERATED_KEYS = 'gauge, "GCM", ensemble_id, segment_id'


@query(
    "q_regenerate",
    f"""
    {_ALIGNED_SQL},
    runs AS (
        SELECT gauge, min(position) AS start_index, max(position) AS end_index
        FROM (SELECT gauge, position, position - row_number() OVER (PARTITION BY gauge ORDER BY position) AS island
              FROM (SELECT *, row_number() OVER (PARTITION BY gauge ORDER BY year) AS position
                    FROM aligned WHERE "GCM" = 'observed') WHERE q_mm IS NOT NULL)
        GROUP BY gauge, island HAVING count(*) >= 2),
    segments AS (
        SELECT a.*, r.start_index AS segment_id, a.p_mm AS precipitation, a.drought AS is_drought_year,
               a.ratio AS seasonal_ratio
        FROM (SELECT *, row_number() OVER (PARTITION BY gauge, "GCM", ensemble_id ORDER BY year) AS position FROM aligned) a
        JOIN runs r ON r.gauge = a.gauge AND a.position BETWEEN r.start_index AND r.end_index),
    with_terms AS ({model_terms("segments", "models_carbon", _REGENERATED_KEYS, "year", "precipitation", 0.0)}),
    scores AS ({model_scores("with_terms", _REGENERATED_KEYS)})
    SELECT s.gauge, s."GCM", s.ensemble_id, s.t AS year, round(g.precipitation, 4) AS precipitation,
           round(g.q_mm, 6) AS observed_streamflow, g.is_drought_year, g."CO2", round(g.seasonal_ratio, 6) AS seasonal_ratio,
           round(s.transformed_streamflow, 4) AS transformed_streamflow,
           round(asinh(exp(m.b * s.transformed_streamflow)) / m.b, 4) AS realspace_streamflow
    FROM scores s JOIN segments g ON s.gauge = g.gauge AND s."GCM" = g."GCM" AND s.ensemble_id = g.ensemble_id
         AND s.segment_id = g.segment_id AND s.t = g.year
    JOIN models_carbon m ON m.gauge = s.gauge""",
    "prepared",
    "obs_yearly",
    "evidence",
    "models_carbon",
)
def q_regenerate(t: Tables) -> DataFrame:
    """From raw rain to flow with the carbon terms switched off, end to end.

    The aligned series feed both the runs and the segments, so they are written first.
    """
    aligned = stored(_aligned(t), "aligned")
    segments = flow.segmented_series(aligned, flow.observed_runs(aligned, 2))
    result = flow.regenerated_flow(segments, t.carbon_parameters)
    six = ("observed_streamflow", "seasonal_ratio")
    four = ("precipitation", "transformed_streamflow", "realspace_streamflow")
    return result.withColumns({**{c: F.round(c, 6) for c in six}, **{c: F.round(c, 4) for c in four}})


@query(
    "q_drought",
    """
    , a AS (SELECT *, (rain - avg(rain) OVER (PARTITION BY gauge)) / avg(rain) OVER (PARTITION BY gauge) AS an,
                   row_number() OVER (PARTITION BY gauge ORDER BY t) AS n FROM flow_monthly),
    s AS (SELECT *, n >= 3 AND avg(an) OVER (PARTITION BY gauge ORDER BY n ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) < -0.05 AS dry
          FROM a),
    runs AS (SELECT gauge, min(n) AS lo, max(n) AS hi FROM (
                 SELECT gauge, n, n - row_number() OVER (PARTITION BY gauge ORDER BY n) AS island FROM s WHERE dry)
             GROUP BY gauge, island HAVING count(*) >= 7),
    ends AS (SELECT r.*, e0.an AS a0, e1.an AS a1, e2.an AS a2 FROM runs r
             JOIN a e0 ON e0.gauge = r.gauge AND e0.n = r.hi JOIN a e1 ON e1.gauge = r.gauge AND e1.n = r.hi - 1
             JOIN a e2 ON e2.gauge = r.gauge AND e2.n = r.hi - 2),
    trimmed AS (SELECT gauge, lo, CASE WHEN a2 > 0.15 THEN hi - 3 WHEN a1 > 0.15 THEN hi - 2 WHEN a0 > 0.15 THEN hi - 1
                                       WHEN a1 > 0 AND a1 < 0.15 AND a0 > 0 AND a0 < 0.15 THEN hi - 1 ELSE hi END AS hi FROM ends)
    SELECT a.gauge, a.t, a.rain, EXISTS (SELECT 1 FROM trimmed d WHERE d.gauge = a.gauge AND a.n BETWEEN d.lo AND d.hi) AS drought
    FROM a""",
    "flow_monthly",
)
def q_drought(t: Tables) -> DataFrame:
    """Drought flag of each rain series."""
    return drought_flags(t.flow_monthly.select("gauge", "t", "rain"), ["gauge"], "t", "rain")


# Effects

_SUMS_SQL = "round(hn, 4) AS sum_counterfactual_hist_nat, round(coff, 4) AS sum_counterfactual_obs, round(con, 4) AS sum_CO2_obs"
_EFFECTS_SQL = """round(total_effect, 4) AS total_effect, round(rainfall_effect, 4) AS rainfall_effect,
    round(partitioning_effect, 4) AS partitioning_effect"""


@query(
    "q_decade_effects",
    f"""
    SELECT gauge, decade, {_SUMS_SQL}, {_EFFECTS_SQL}, round(relative_rainfall_effect, 4) AS relative_rainfall_effect,
           round(relative_partitioning_effect, 4) AS relative_partitioning_effect, lat, lon, state FROM effects""",
    "effects",
)
def q_decade_effects(t: Tables) -> DataFrame:
    """Rain and partitioning effects per gauge and decade."""
    return rounded(decade_rows(t), 4)


@query(
    "q_uncertainty",
    f"""
    SELECT gauge, decade, {_SUMS_SQL}, {_EFFECTS_SQL}, round(relative_rainfall_effect, 4) AS relative_rainfall_effect,
           round(relative_partitioning_effect, 4) AS relative_partitioning_effect, lat, lon, state,
           round(range_relative_rainfall_effect, 4) AS range_relative_rainfall_effect,
           round(range_total_CC_percentage_effect, 4) AS range_total_CC_percentage_effect FROM uncertain
    ORDER BY range_relative_rainfall_effect DESC NULLS LAST""",
    "uncertain",
)
def q_uncertainty(t: Tables) -> DataFrame:
    """Decade effects with their spread over the models, most uncertain first."""
    return rounded(uncertain_rows(t), 4).orderBy(F.desc_nulls_last("range_relative_rainfall_effect"))


@query(
    "q_effect_series",
    """
    SELECT year, gauge, unnest(['Total Effect', 'Rainfall Effect', 'Rainfall-Partitioning Effect']) AS effect,
           round(unnest([co2_on - hist_nat, co2_off - hist_nat, co2_on - co2_off]), 4) AS streamflow FROM scenarios""",
    "scenarios",
)
def q_effect_series(t: Tables) -> DataFrame:
    """Yearly signed effects, long."""
    return rounded(effects.effect_series(scenario_rows(t)), 4)


@query(
    "q_total_percent",
    """
    SELECT gauge, decade, state, round(share, 6) AS total_effect_CC_percent, round(rain_share, 6) AS rainfall_effect_CC_percent,
           round(part_share, 6) AS partitioning_effect_CC_percent FROM total""",
    "total",
)
def q_total_percent(t: Tables) -> DataFrame:
    """Signed share of the total change and its two parts."""
    return rounded(
        effects.total_percent(uncertain_rows(t)).select(
            "gauge",
            "decade",
            "state",
            "total_effect_CC_percent",
            "rainfall_effect_CC_percent",
            "partitioning_effect_CC_percent",
        )
    )


@query(
    "q_period_effects",
    f"""
    SELECT gauge, {_SUMS_SQL}, {_EFFECTS_SQL}, round(rel, 4) AS relative_rainfall_effect,
           round(rel_part, 4) AS relative_partitioning_effect, lat, lon, state,
           round(share, 4) AS total_effect_CC_percent, round(rain_share, 4) AS rainfall_effect_CC_percent,
           round(part_share, 4) AS partitioning_effect_CC_percent FROM period""",
    "period",
)
def q_period_effects(t: Tables) -> DataFrame:
    """The same split over one comparison period."""
    return rounded(period_rows(t), 4)


@query(
    "q_aridity",
    """
    SELECT gauge, round(mean_annual_PET, 4) AS "mean_annual_PET", round(mean_annual_precip, 4) AS mean_annual_precip,
           round(aridity, 6) AS aridity, aridity_classification FROM aridity""",
    "aridity",
)
def q_aridity(t: Tables) -> DataFrame:
    """Mean rain over mean evaporation and its class, per gauge."""
    rows = aridity.aridity_by_gauge(t.evaporation, t.obs_yearly)
    return rows.select(
        "gauge",
        F.round("mean_annual_PET", 4).alias("mean_annual_PET"),
        F.round("mean_annual_precip", 4).alias("mean_annual_precip"),
        F.round("aridity", 6).alias("aridity"),
        "aridity_classification",
    )


@query(
    "q_value_counts",
    """
    SELECT year, gauge, count(*) AS n, round(sum("APET_mm"), 4) AS "annual_APET_mm" FROM evaporation GROUP BY 1, 2""",
    "evaporation",
)
def q_value_counts(t: Tables) -> DataFrame:
    """Yearly sums beside the number of values, to notice missing days."""
    return rounded(aridity.annual_evaporation(t.evaporation), 4)


@query(
    "q_aridity_stats",
    """
    SELECT aridity_classification, round(avg(part_share), 6) AS mean_partitioning_percentage_impact, count(*) AS n,
           round(stddev_samp(part_share), 6) AS sd_partitioning_percentage_impact
    FROM period LEFT JOIN aridity USING (gauge) GROUP BY 1""",
    "period",
    "aridity",
)
def q_aridity_stats(t: Tables) -> DataFrame:
    """Partitioning share by aridity class."""
    classes = aridity.aridity_by_gauge(t.evaporation, t.obs_yearly).select("gauge", "aridity_classification")
    return rounded(aridity.effects_by_aridity(period_rows(t), classes))


@query(
    "q_naive_annual",
    """
    SELECT year, gauge, "GCM", round(median(o), 4) AS annual_rainfall_obs, round(median(h), 4) AS median_GCM_hist_nat
    FROM (SELECT year, gauge, "GCM", ensemble_id, sum(naive_scale_term * season_obs_precipitation) AS h,
                 sum(season_obs_precipitation) AS o
          FROM terms JOIN seasonal_obs USING (year, gauge, season) GROUP BY 1, 2, 3, 4)
    GROUP BY 1, 2, 3""",
    "terms",
    "seasonal_obs",
)
def q_naive_annual(t: Tables) -> DataFrame:
    """Member median of the unsmoothed scaled rain, per model and year."""
    naive = rain.scale_observed(rain.scale_terms(t.seasonal_model), t.seasonal_obs, "naive_scale_term")
    return rounded(rain.median_annual_rain(naive, None), 4)
