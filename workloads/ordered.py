"""Queries on ordered series. Raw events run in blocks found from the rows; monthly and yearly
series are short by construction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.operators.series import (
    Series,
    chunks,
    differences,
    expand_runs,
    in_blocks,
    longest_runs,
    positions,
    rolling,
    run_lengths,
    valid_runs,
)
from freshet.plans import rain
from workloads.registry import query
from workloads.standin import ROLL, Tables
from workloads.tidy import rounded

EVENTS = Series(("gauge",), ("ts", "event_id"))


def _events(t: Tables, *columns: str) -> tuple[DataFrame, Series]:
    """Events with what a query needs, long series cut."""
    return in_blocks(t.flow_events.select("gauge", "ts", "event_id", *columns), EVENTS)


@query(
    "w_rolling",
    """
    SELECT gauge, event_id, CASE WHEN count(q) OVER w = 3 THEN round(avg(q) OVER w, 6) END AS mean3,
           CASE WHEN count(q) OVER w = 3 THEN max(q) OVER w END AS max3
    FROM flow_events
    WINDOW w AS (PARTITION BY gauge ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
    "flow_events",
)
def w_rolling(t: Tables) -> DataFrame:
    """Trailing windows of three events, full windows only."""
    rows = rolling(*_events(t, "q"), {"mean3": (F.avg, "q", 3), "max3": (F.max, "q", 3)})
    return rows.select("gauge", "event_id", F.round("mean3", 6).alias("mean3"), "max3")


@query(
    "w_smooth_scale",
    """
    SELECT year, "GCM", ensemble_id, gauge, season, round(naive_scale_term, 6) AS naive_scale_term,
           round(smooth_scale_term, 6) AS smooth_scale_term FROM smoothed""",
    "smoothed",
)
def w_smooth_scale(t: Tables) -> DataFrame:
    """Moving mean of the scale term over interleaved seasons."""
    rows = rain.smoothed_terms(rain.scale_terms(t.seasonal_model), {"smooth_scale_term": ROLL})
    return rounded(rows.drop("realisation", "historical", "hist_nat"))


@query(
    "w_center",
    """
    SELECT year, "GCM", ensemble_id, gauge,
           round(standardised_warm_season_to_annual_rainfall_ratio, 6)
               AS standardised_warm_season_to_annual_rainfall_ratio
    FROM prepared""",
    "prepared",
)
def w_center(t: Tables) -> DataFrame:
    """Warm share minus the mean of its series; years without both seasons stay missing."""
    prepared = rain.prepared_rain(rain.scaled_rain(t.seasonal_model, t.seasonal_obs, ROLL))
    return rounded(prepared.select("year", "GCM", "ensemble_id", "gauge", rain.RATIO))


@query(
    "w_row_number",
    "SELECT gauge, event_id, position FROM flow_numbered",
    "flow_numbered",
)
def w_row_number(t: Tables) -> DataFrame:
    return positions(*_events(t)).select("gauge", "event_id", "position")


@query("w_runs", "SELECT * FROM flow_runs", "flow_runs")
def w_runs(t: Tables) -> DataFrame:
    """Stretches of events with a value, as row positions."""
    return valid_runs(*_events(t, "q"), "q")


@query("w_runs_min", "SELECT * FROM flow_runs WHERE length >= 4", "flow_runs")
def w_runs_min(t: Tables) -> DataFrame:
    """Stretches of at least four events."""
    return valid_runs(*_events(t, "q"), "q", 4)


@query(
    "w_longest_run",
    """
    SELECT gauge, start_index, end_index, length FROM (
        SELECT *, row_number() OVER (PARTITION BY gauge ORDER BY length DESC, start_index) AS n FROM flow_runs)
    WHERE n = 1""",
    "flow_runs",
)
def w_longest_run(t: Tables) -> DataFrame:
    """Longest stretch per gauge, the earliest on a tie."""
    return longest_runs(valid_runs(*_events(t, "q"), "q"), ["gauge"])


_RLE = """
    SELECT gauge, run, any_value(kind) AS value, min(position) AS start_index, max(position) AS end_index,
           count(*) AS length
    FROM (SELECT *, sum(CASE WHEN position > 1 AND kind IS NOT DISTINCT FROM before THEN 0 ELSE 1 END)
                    OVER (PARTITION BY gauge ORDER BY position) AS run
          FROM (SELECT *, lag(kind) OVER (PARTITION BY gauge ORDER BY position) AS before
                FROM (SELECT *, CASE WHEN event_type IN ('click', 'view') THEN 'seen'
                                     WHEN event_type <> 'error' THEN 'done' END AS kind FROM flow_numbered)))
    GROUP BY gauge, run"""


def _kinds(t: Tables) -> tuple[DataFrame, Series]:
    seen = F.col("event_type").isin("click", "view")
    kind = F.when(seen, F.lit("seen")).when(F.col("event_type") != "error", F.lit("done"))
    return in_blocks(t.flow_events.select("gauge", "ts", "event_id", kind.alias("kind")), EVENTS)


@query(
    "w_rle",
    f"SELECT gauge, CAST(run AS BIGINT) AS run, value, start_index, end_index, length FROM ({_RLE})",
    "flow_numbered",
)
def w_rle(t: Tables) -> DataFrame:
    """Run-length encoding in which missing equals missing, with the end position of each run."""
    return run_lengths(*_kinds(t), "kind")


@query(
    "w_rle_decode",
    """
    SELECT gauge, position, CASE WHEN event_type IN ('click', 'view') THEN 'seen'
                                 WHEN event_type <> 'error' THEN 'done' END AS value FROM flow_numbered""",
    "flow_numbered",
)
def w_rle_decode(t: Tables) -> DataFrame:
    """The rows back from their runs."""
    rows = expand_runs(run_lengths(*_kinds(t), "kind"), ["gauge"], ["value"], spread=True)
    return rows.select("gauge", "position", "value")


@query(
    "w_chunk",
    """
    SELECT gauge, CAST(ceil(row_number() OVER (ORDER BY gauge) / 7) AS INTEGER) AS split
    FROM (SELECT DISTINCT gauge FROM flow_events)""",
    "flow_events",
)
def w_chunk(t: Tables) -> DataFrame:
    """Sorted gauges in groups of seven."""
    return chunks(t.flow_events, "gauge", 7)


@query(
    "w_diff",
    """
    SELECT gauge, event_id, round(value - lag(value) OVER (PARTITION BY gauge ORDER BY ts, event_id), 6) AS change
    FROM (SELECT CAST(user_id AS VARCHAR) AS gauge, ts, event_id, value FROM events)""",
)
def w_diff(t: Tables) -> DataFrame:
    """First differences along each series."""
    rows = t.raw("events").select(
        F.col("user_id").cast("string").alias("gauge"),
        "ts",
        "event_id",
        "value",
    )
    return rounded(differences(*in_blocks(rows, EVENTS), "value", "change").select("gauge", "event_id", "change"))


@query(
    "w_sensitivity",
    """
    SELECT n.n AS window_rows, year, gauge, season, round(a, 6) AS median_GCM_smooth_scale_term,
           round(b, 6) AS median_p90_GCM_smooth_scale_term, round(season_obs_precipitation, 6) AS season_obs_precipitation,
           round(b * season_obs_precipitation, 4) AS median_p90_smooth_scaled_hist_nat
    FROM (SELECT n, gauge, year, season, CASE WHEN count(*) = count(m) THEN median(m) END AS a,
                 CASE WHEN count(*) = count(p) THEN median(p) END AS b
          FROM (SELECT n, "GCM", gauge, year, season, CASE WHEN count(*) = count(s) THEN median(s) END AS m,
                       quantile_cont(s, 0.9) AS p
                FROM (SELECT *, unnest([2, 4, 6]) AS n, unnest([s2, s4, s6]) AS s FROM (
                    SELECT *, CASE WHEN count(*) OVER w2 = 2 THEN avg(naive_scale_term) OVER w2 END AS s2,
                           CASE WHEN count(*) OVER w4 = 4 THEN avg(naive_scale_term) OVER w4 END AS s4,
                           CASE WHEN count(*) OVER w6 = 6 THEN avg(naive_scale_term) OVER w6 END AS s6
                    FROM terms
                    WINDOW w2 AS (PARTITION BY "GCM", ensemble_id, realisation, gauge ORDER BY year, season DESC
                                  ROWS BETWEEN 1 PRECEDING AND CURRENT ROW),
                           w4 AS (PARTITION BY "GCM", ensemble_id, realisation, gauge ORDER BY year, season DESC
                                  ROWS BETWEEN 3 PRECEDING AND CURRENT ROW),
                           w6 AS (PARTITION BY "GCM", ensemble_id, realisation, gauge ORDER BY year, season DESC
                                  ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)))
                GROUP BY 1, 2, 3, 4, 5) GROUP BY 1, 2, 3, 4) n
    JOIN seasonal_obs USING (year, gauge, season) WHERE a IS NOT NULL AND b IS NOT NULL""",
    "terms",
    "seasonal_obs",
)
def w_sensitivity(t: Tables) -> DataFrame:
    """Scaled rain for three window lengths in one job."""
    rows = rain.window_sensitivity(rain.scale_terms(t.seasonal_model), t.seasonal_obs, (2, 4, 6))
    return rows.select(
        "window_rows",
        "year",
        "gauge",
        "season",
        *[
            F.round(c, 6).alias(c)
            for c in (
                "median_GCM_smooth_scale_term",
                "median_p90_GCM_smooth_scale_term",
                "season_obs_precipitation",
            )
        ],
        F.round("median_p90_smooth_scaled_hist_nat", 4).alias("median_p90_smooth_scaled_hist_nat"),
    )
