"""Queries that read whole tables, all columns and all rows, and files under their own names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions.text import run_fields
from freshet.operators.interval_scan import assign_segments_by_scan
from freshet.operators.long_windows import rolling_any
from freshet.operators.quality import empty_segments
from freshet.operators.selection import exact_quantiles
from freshet.operators.series import Series, in_blocks, positions, valid_runs
from freshet.plans import rain
from freshet.session import new_table_path
from freshet.sources.readers import read_csv, read_csv_and_bad_rows, read_model_runs, read_parquet
from freshet.sources.schemas import GAUGE_INFORMATION, wide_run
from freshet.sources.writers import write_named_csv, write_parquet
from workloads.registry import query
from workloads.standin import PARAMETER_SQL, Tables
from workloads.tidy import _V, _wide_run_rows, _wide_runs_sql, rounded

WIDTH = 533  # gauges of a model-run file

_ALL_V = " + ".join(f"coalesce(V{i}, 0)" for i in range(1, 8))


def _total() -> Column:
    return F.round(F.sum(sum((F.coalesce(f"V{i}", F.lit(0.0)) for i in range(1, 8)), F.lit(0.0))) * 1e6, 4)


@query(
    "s_file_names",
    f"""
    SELECT "GCM", ensemble_id, experiment, realisation, '199501-200112' AS date_range, count(*) AS months,
           round(sum({_ALL_V}) * 1e6, 4) AS total
    FROM ({_wide_runs_sql(_V)}) GROUP BY 1, 2, 3, 4""",
)
def s_file_names(t: Tables) -> DataFrame:
    """Every column of every run file, tagged with the fields of the file's name."""
    path = new_table_path(t.spark, "runs")
    write_named_csv(_wide_run_rows(t), path, "run")
    runs = read_model_runs(t.spark, [path], 7)
    return runs.groupBy("GCM", "ensemble_id", "experiment", "realisation", "date_range").agg(
        F.count(F.lit(1)).alias("months"), _total().alias("total")
    )


@query(
    "s_multi_dir_all",
    f"""
    SELECT experiment, count(*) AS n_rows, round(sum({_ALL_V}) * 1e6, 4) AS total
    FROM ({_wide_runs_sql(_V)}) GROUP BY experiment""",
)
def s_multi_dir_all(t: Tables) -> DataFrame:
    """Every column of two directories of files in one scan; the rows are aggregated and written once."""
    path = new_table_path(t.spark, "by-experiment")
    columns = ["time_sum", *[f"V{i}" for i in range(1, 8)]]
    wide = _wide_run_rows(t).select(run_fields(F.col("run"))["experiment"].alias("experiment"), *columns)
    wide.write.partitionBy("experiment").csv(path, header=True, nullValue="NA")
    both = read_csv(t.spark, [f"{path}/experiment=historical", f"{path}/experiment=hist-nat"], wide_run(7))
    experiment = F.split_part(F.element_at(F.split("_metadata.file_path", "/"), -2), F.lit("="), F.lit(2))
    return both.groupBy(experiment.alias("experiment")).agg(F.count(F.lit(1)).alias("n_rows"), _total().alias("total"))


def _full_width_rows(t: Tables) -> DataFrame:
    """Model runs as wide as the published ones: a supplier stands at a place from 1 to 533."""
    month = F.trunc("l_shipdate", "month")
    experiment = F.when(F.col("l_orderkey") % 2 == 0, F.lit("historical")).otherwise(F.lit("hist-nat"))
    name = F.concat_ws(
        "_", F.lit("pr"), F.lit("Amon"), "l_returnflag", experiment, "l_linestatus", F.lit("gn"), F.lit("199501-200112")
    )
    place = ((F.col("l_suppkey") - 1) % WIDTH + 1).cast("int")
    cells = t.raw("lineitem").groupBy(name.alias("run"), month.alias("month"), place.alias("place")).agg(
        (F.sum("l_quantity") / 1e6).alias("flux")
    )
    rows = cells.groupBy("run", "month").agg(F.map_from_entries(F.collect_list(F.struct("place", "flux"))).alias("values"))
    offset = F.date_diff("month", F.to_date(F.lit("1995-01-01"))).cast("double")
    return rows.select("run", offset.alias("time_sum"), *[F.col("values")[i].alias(f"V{i}") for i in range(1, WIDTH + 1)])


@query(
    "q_tidy_width",
    f"""
    WITH c AS (
        SELECT l_returnflag AS "GCM", l_linestatus AS ensemble_id,
               CASE WHEN l_orderkey % 2 = 0 THEN 'historical' ELSE 'hist-nat' END AS experiment,
               CAST(date_trunc('month', l_shipdate) AS DATE) AS date, (l_suppkey - 1) % {WIDTH} + 1 AS p,
               sum(l_quantity) / 1e6 AS flux
        FROM lineitem GROUP BY ALL
    ), cells AS (
        SELECT r."GCM", r.ensemble_id, r.experiment, r.date, p.p, c.flux * 86400 * day(last_day(r.date)) AS mm
        FROM (SELECT DISTINCT "GCM", ensemble_id, experiment, date FROM c) r CROSS JOIN range(1, {WIDTH + 1}) p(p)
        LEFT JOIN c ON c."GCM" = r."GCM" AND c.ensemble_id = r.ensemble_id AND c.experiment = r.experiment
                   AND c.date = r.date AND c.p = p.p
    )
    SELECT CAST(year(date) AS INTEGER) AS year, "GCM", ensemble_id, 'gn' AS realisation, 'g' || p AS gauge,
           CASE WHEN month(date) BETWEEN 4 AND 9 THEN 'cool_season' ELSE 'warm_season' END AS season,
           CASE WHEN count(*) FILTER (experiment = 'historical' AND mm IS NULL) = 0
                THEN round(sum(mm) FILTER (experiment = 'historical'), 6) END AS historical,
           CASE WHEN count(*) FILTER (experiment = 'hist-nat' AND mm IS NULL) = 0
                THEN round(sum(mm) FILTER (experiment = 'hist-nat'), 6) END AS hist_nat
    FROM cells GROUP BY 1, 2, 3, 4, 5, 6""",
)
def q_tidy_width(t: Tables) -> DataFrame:
    """Run files of the published width, tagged by their names, to seasonal rain with one column per experiment."""
    path = new_table_path(t.spark, "wide-runs")
    write_named_csv(_full_width_rows(t), path, "run")
    gauges = t.spark.range(1, WIDTH + 1).select(
        F.col("id").alias("position"), F.concat(F.lit("g"), F.col("id").cast("string")).alias("gauge")
    )
    return rounded(rain.tidy_runs(read_model_runs(t.spark, [path], WIDTH), gauges))


@query(
    "k_partitions",
    """
    SELECT "GCM", season, count(*) AS n_rows, round(sum(historical * CASE "GCM" WHEN 'A' THEN 2 ELSE 1 END), 4) AS historical
    FROM seasonal_model GROUP BY 1, 2""",
    "seasonal_model",
)
def k_partitions(t: Tables) -> DataFrame:
    """One model run again: its partition is replaced, the others stay."""
    path = new_table_path(t.spark, "by-model")
    write_parquet(t.seasonal_model, path, partition_by=["GCM"], sort_by=["gauge", "year"])
    again = t.seasonal_model.where(F.col("GCM") == "A").withColumn("historical", F.col("historical") * 2)
    write_parquet(again, path, partition_by=["GCM"], sort_by=["gauge", "year"], only_present=True)
    return read_parquet(t.spark, path).groupBy("GCM", "season").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("historical"), 4).alias("historical")
    )


@query(
    "k_bad_rows",
    """
    SELECT gauge, CASE WHEN CAST(gauge AS BIGINT) % 10 <> 3 THEN lat END AS lat, CAST(gauge AS BIGINT) % 10 = 3 AS bad
    FROM gauges""",
    "gauges",
)
def k_bad_rows(t: Tables) -> DataFrame:
    """Rows whose latitude is no number come back as text, all others as rows."""
    path = new_table_path(t.spark, "gauges")
    lat = F.when(F.col("gauge").cast("long") % 10 == 3, F.lit("north")).otherwise(F.col("lat").cast("string"))
    t.gauges.select("gauge", lat.alias("lat"), "lon", "state").write.csv(path, header=True, nullValue="NA")
    good, bad = read_csv_and_bad_rows(t.spark, path, GAUGE_INFORMATION)
    named = bad.select(
        F.split_part("record", F.lit(","), F.lit(1)).alias("gauge"), F.lit(None).cast("double").alias("lat"), F.lit(True).alias("bad")
    )
    return good.select("gauge", "lat", F.lit(False).alias("bad")).unionByName(named)


@query(
    "j_right_all",
    """
    SELECT g.gauge, g.state, s.streamflow_model, s.n, round(s.total, 4) AS total
    FROM (SELECT gauge, streamflow_model, count(*) AS n, sum(realspace_modelled_streamflow) AS total FROM fitted
          GROUP BY 1, 2) s
    RIGHT JOIN gauges g ON s.gauge = g.gauge""",
    "fitted",
    "gauges",
)
def j_right_all(t: Tables) -> DataFrame:
    """Right join over all years and totals: every gauge stays, with or without flow."""
    sums = t.fitted.groupBy("gauge", "streamflow_model").agg(
        F.count(F.lit(1)).alias("n"), F.sum("realspace_modelled_streamflow").alias("total")
    )
    return sums.join(t.gauges.select("gauge", "state"), "gauge", "right").withColumn("total", F.round("total", 4))


_NAMES = list(PARAMETER_SQL)
_USED = {
    "a0": "NOT has_drought",
    "a0_d": "has_drought",
    "a0_n": "has_drought",
    "a2": "has_auto",
    "a3_intercept": "co2_kind = 1",
    "a3_slope": "co2_kind = 2",
    "a4": "has_ratio",
    "a5": "co2_kind > 0",
}


@query(
    "j_many_many_all",
    f"""
    SELECT s.gauge, s."GCM", s.ensemble_id, p.parameter, round(p.value, 6) AS parameter_value
    FROM (SELECT DISTINCT gauge, "GCM", ensemble_id FROM rain_model) s
    LEFT JOIN (SELECT gauge, parameter, value FROM (
                   SELECT gauge, unnest({_NAMES}) AS parameter, unnest([{", ".join(_NAMES)}]) AS value,
                          unnest([{", ".join(_USED.get(n, "true") for n in _NAMES)}]) AS used
                   FROM models_all) WHERE used) p
    ON p.gauge = s.gauge""",
    "rain_model",
    "models_all",
)
def j_many_many_all(t: Tables) -> DataFrame:
    """Every series with every parameter of its gauge's model."""
    series = t.rain_model.select("gauge", "GCM", "ensemble_id").distinct()
    return rounded(series.join(t.parameters.select("gauge", "parameter", "parameter_value"), "gauge", "left"))


@query(
    "o_sort_all",
    """
    SELECT gauge, state, list_extract(years, 1) AS first_year, array_to_string(list_reverse(list_sort(years)), ' ') AS newest_first,
           n_missing
    FROM (SELECT gauge, list(DISTINCT CAST(year AS VARCHAR) ORDER BY CAST(year AS VARCHAR)) AS years,
                 count(*) FILTER (q_mm IS NULL) AS n_missing
          FROM obs_yearly GROUP BY gauge)
    LEFT JOIN gauges USING (gauge)
    ORDER BY state DESC NULLS LAST, gauge""",
    "obs_yearly",
    "gauges",
)
def o_sort_all(t: Tables) -> DataFrame:
    """Sorted lists of all years, also those with a gap; ascending and descending order with missing values last."""
    years = F.array_sort(F.collect_set(F.col("year").cast("string")))
    listed = t.obs_yearly.groupBy("gauge").agg(years.alias("years"), F.count_if(F.col("q_mm").isNull()).alias("n_missing"))
    joined = listed.join(t.gauges.select("gauge", "state"), "gauge", "left")
    return joined.select(
        "gauge",
        "state",
        F.element_at("years", 1).alias("first_year"),
        F.array_join(F.reverse("years"), " ").alias("newest_first"),
        "n_missing",
    ).orderBy(F.desc_nulls_last("state"), "gauge")


@query(
    "q_empty_segments_all",
    """
    SELECT r.gauge, s."GCM", s.ensemble_id, r.start_index, s.n_rows
    FROM flow_runs r JOIN (
        SELECT gauge, "GCM", ensemble_id, count(DISTINCT date_trunc('month', date)) AS n_rows FROM rain_model
        GROUP BY 1, 2, 3) s USING (gauge)
    WHERE NOT EXISTS (SELECT 1 FROM range(1, 100) p(i) WHERE i BETWEEN r.start_index AND r.end_index AND i <= s.n_rows)""",
    "flow_runs",
    "rain_model",
)
def q_empty_segments_all(t: Tables) -> DataFrame:
    """Stretches of events that start after the last month of one of their gauge's rain series, over all rows."""
    runs = valid_runs(*in_blocks(t.flow_events.select("gauge", "ts", "event_id", "q"), Series(("gauge",), ("ts", "event_id"))), "q")
    months = t.rain_model.select("gauge", "GCM", "ensemble_id", F.trunc("date", "month").alias("month")).distinct()
    return empty_segments(runs, months, ["gauge"], ["gauge", "GCM", "ensemble_id"]).select(
        "gauge", "GCM", "ensemble_id", "start_index", "n_rows"
    )


@query(
    "a_quantiles_large",
    """
    SELECT l_returnflag, round(quantile_cont(CAST(l_extendedprice AS DOUBLE), 0.05), 6) AS low,
           round(quantile_cont(CAST(l_extendedprice AS DOUBLE), 0.5), 6) AS middle,
           round(quantile_cont(CAST(l_extendedprice AS DOUBLE), 0.95), 6) AS high
    FROM lineitem GROUP BY l_returnflag""",
)
def a_quantiles_large(t: Tables) -> DataFrame:
    """Exact quantiles of three groups that share out all line items; none is held by one task."""
    shares = {"low": 0.05, "middle": 0.5, "high": 0.95}
    prices = t.raw("lineitem").select("l_returnflag", "l_extendedprice")
    found = exact_quantiles(prices, ["l_returnflag"], "l_extendedprice", shares, room=8_192)
    return found.select("l_returnflag", *[F.round(c, 6).alias(c) for c in shares])


@query(
    "w_rolling_any",
    """
    SELECT network, event_id, CASE WHEN count(q) OVER a = 20 THEN min(q) OVER a END AS low20,
           CASE WHEN count(q) OVER a = 20 THEN max(q) OVER a END AS high20,
           CASE WHEN count(q) OVER a = 20 THEN round(avg(q) OVER a, 5) END AS mean20,
           CASE WHEN count(*) OVER b = 2000 THEN max(coalesce(q, 0)) OVER b END AS high2000,
           CASE WHEN count(*) OVER b = 2000 THEN bool_or(q IS NULL) OVER b END AS gap2000
    FROM (SELECT CAST(gauge AS BIGINT) % 2 AS network, ts, event_id, q FROM flow_events)
    WINDOW a AS (PARTITION BY network ORDER BY ts, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
           b AS (PARTITION BY network ORDER BY ts, event_id ROWS BETWEEN 1999 PRECEDING AND CURRENT ROW)""",
    "flow_events",
)
def w_rolling_any(t: Tables) -> DataFrame:
    """Trailing windows of 20 and of 2,000 events at the same cost a row, over two series that share out all events."""
    network = (F.col("gauge").cast("long") % 2).alias("network")
    events = t.flow_events.select(network, "ts", "event_id", "q")
    filled = events.withColumns({"filled": F.coalesce("q", F.lit(0).cast("double")), "gap": F.col("q").isNull()})
    rows, series = in_blocks(filled, Series(("network",), ("ts", "event_id")))
    short = rolling_any(rows, series, 20, {"low20": ("min", "q"), "high20": ("max", "q"), "mean20": ("mean", "q")})
    both = rolling_any(short, series, 2_000, {"high2000": ("max", "filled"), "gap2000": ("any", "gap")})
    return both.select("network", "event_id", "low20", "high20", F.round("mean20", 5).alias("mean20"), "high2000", "gap2000")


@query(
    "j_interval_scan",
    """
    SELECT m.gauge, m."GCM", m.ensemble_id, m.year, m.position, r.start_index AS segment_id
    FROM (SELECT *, row_number() OVER (PARTITION BY gauge, "GCM", ensemble_id ORDER BY year) AS position
          FROM regenerated) m
    JOIN obs_runs r ON m.gauge = r.gauge AND m.position BETWEEN r.start_index AND r.end_index""",
    "regenerated",
    "obs_runs",
)
def j_interval_scan(t: Tables) -> DataFrame:
    """Positions of the observed runs applied to every series of the gauge, without writing the runs out."""
    runs = valid_runs(t.obs_yearly, Series(("gauge",), ("year",)), "q_mm", 2)
    rows = positions(t.regenerated, Series(("gauge", "GCM", "ensemble_id"), ("year",)))
    found = assign_segments_by_scan(rows, runs, ["gauge"])
    return found.select("gauge", "GCM", "ensemble_id", "year", "position", "segment_id")
