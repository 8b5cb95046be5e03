"""Queries on sources, sinks, projection, reshape, joins, sets and scalar functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from freshet.functions.calendar import (
    days_in_month,
    decade_of,
    mm_per_month,
    offset_date,
    range_origin,
    season_of,
)
from freshet.functions.maths import (
    SQRT_EPSILON,
    asinh_stable,
    clamp_below_zero,
    is_near,
    label_height,
    label_offset,
    log_real,
    order_of_magnitude,
    rescale,
    round_any,
)
from freshet.functions.nulls import ratio
from freshet.functions.text import letter, run_fields, state_code
from freshet.operators.reshape import columns_ending, sum_to_wide, to_long, to_wide, with_rank
from freshet.operators.series import Series, assign_segments, positions, valid_runs
from freshet.plans import effects, flow, rain
from freshet.session import new_table_path, stored
from freshet.sources.readers import csv_header, read_csv, read_model_runs, read_parquet
from freshet.sources.schemas import GAUGE_INFORMATION, wide_run
from freshet.sources.writers import write_parquet
from workloads.registry import query
from workloads.standin import PARAMETER_SQL, Tables


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column, so that the order of a sum does not show."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType)]
    return df.withColumns({c: F.round(c, digits) for c in doubles})


def _wide_run_rows(t: Tables) -> DataFrame:
    """Model runs in their file layout: a day offset and seven value columns per run name."""
    month = F.trunc("l_shipdate", "month")
    experiment = F.when(F.col("l_orderkey") % 2 == 0, F.lit("historical")).otherwise(F.lit("hist-nat"))
    name = F.concat_ws(
        "_", F.lit("pr"), F.lit("Amon"), "l_returnflag", experiment, "l_linestatus", F.lit("gn"), F.lit("199501-200112")
    )
    values = [
        F.sum(F.when(F.col("l_linenumber") == i, F.col("l_quantity"))).alias(f"V{i}") for i in range(1, 8)
    ]
    rows = t.raw("lineitem").groupBy(name.alias("run"), month.alias("month")).agg(*values)
    offset = F.date_diff("month", F.to_date(F.lit("1995-01-01"))).cast("double")
    flux = {f"V{i}": F.col(f"V{i}") / 1e6 for i in range(1, 8)}
    return rows.select("run", offset.alias("time_sum"), *[c.alias(n) for n, c in flux.items()])


_WIDE_RUNS_SQL = """
    SELECT l_returnflag AS "GCM", l_linestatus AS ensemble_id,
           CASE WHEN l_orderkey % 2 = 0 THEN 'historical' ELSE 'hist-nat' END AS experiment,
           'gn' AS realisation, CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
           {columns}
    FROM lineitem GROUP BY 1, 2, 3, 4, 5"""


def _wide_runs_sql(columns: str) -> str:
    return _WIDE_RUNS_SQL.replace("{columns}", columns)


_V = ", ".join(f"sum(CASE WHEN l_linenumber = {i} THEN l_quantity END) / 1e6 AS V{i}" for i in range(1, 8))


# Sources and sinks


@query(
    "s_multi_dir",
    f"""
    SELECT experiment, count(*) AS n_rows, CAST(sum(days) AS BIGINT) AS days, round(sum(v) * 1e6, 4) AS total
    FROM (SELECT experiment, date_diff('day', DATE '1995-01-01', date) AS days,
                 coalesce(V1, 0) + coalesce(V7, 0) AS v FROM ({_wide_runs_sql(_V)}))
    GROUP BY experiment""",
)
def s_multi_dir(t: Tables) -> DataFrame:
    """Two directories of wide CSV files read as one scan."""
    wide = _wide_run_rows(t)
    columns = ["time_sum", *[f"V{i}" for i in range(1, 8)]]
    paths = []
    for experiment in ("historical", "hist-nat"):
        path = new_table_path(t.spark, experiment)
        part = wide.where(run_fields(F.col("run"))["experiment"] == experiment).select(*columns)
        part.write.csv(path, header=True, nullValue="NA")
        paths.append(path)
    both = read_csv(t.spark, paths, wide_run(7))
    directory = F.element_at(F.split("_metadata.file_path", "/"), -2)
    experiment = F.when(directory.startswith("historical"), F.lit("historical")).otherwise(F.lit("hist-nat"))
    value = F.coalesce("V1", F.lit(0.0)) + F.coalesce("V7", F.lit(0.0))
    return both.groupBy(experiment.alias("experiment")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("time_sum").cast("long").alias("days"),
        F.round(F.sum(value) * 1e6, 4).alias("total"),
    )


@query(
    "s_csv",
    "SELECT gauge, lat, lon, state FROM gauges",
    "gauges",
)
def s_csv(t: Tables) -> DataFrame:
    """CSV with a header, declared types and ``NA`` for missing values; gauge ids stay text."""
    path = new_table_path(t.spark, "gauges")
    t.gauges.write.csv(path, header=True, nullValue="NA")
    return read_csv(t.spark, path, GAUGE_INFORMATION).select(*csv_header(t.spark, path))


@query(
    "s_file_tags",
    f"""
    SELECT "GCM", ensemble_id, experiment, realisation, '199501-200112' AS date_range, count(*) AS months,
           round(sum(V3) * 1e6, 4) AS v3
    FROM ({_wide_runs_sql(_V)}) GROUP BY 1, 2, 3, 4""",
)
def s_file_tags(t: Tables) -> DataFrame:
    """Rows tagged with the fields of the run name they are stored under."""
    path = new_table_path(t.spark, "runs")
    _wide_run_rows(t).write.partitionBy("run").csv(path, header=True, nullValue="NA")
    runs = read_model_runs(t.spark, [path], 7, run_name=F.col("run"))
    return runs.groupBy("GCM", "ensemble_id", "experiment", "realisation", "date_range").agg(
        F.count(F.lit(1)).alias("months"), F.round(F.sum("V3") * 1e6, 4).alias("v3")
    )


@query(
    "s_parquet",
    """
    SELECT CAST(s_suppkey AS VARCHAR) AS gauge, round(sum(l_quantity), 4) AS total
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_shipdate >= TIMESTAMP '1998-01-01' GROUP BY 1""",
)
def s_parquet(t: Tables) -> DataFrame:
    """Lazy parquet scan: the date filter and the three columns reach the reader."""
    lines = read_parquet(t.spark, f"{t.sf_dir}/lineitem.parquet").where(
        F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    )
    sums = lines.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("total"))
    known = sums.join(t.raw("supplier").select(F.col("s_suppkey").alias("l_suppkey")), "l_suppkey")
    return known.select(F.col("l_suppkey").cast("string").alias("gauge"), F.round("total", 4).alias("total"))


@query(
    "k_parquet",
    """
    SELECT "GCM", season, count(*) AS n_rows, round(sum(historical), 4) AS historical, round(sum(hist_nat), 4) AS hist_nat
    FROM seasonal_model GROUP BY 1, 2""",
    "seasonal_model",
)
def k_parquet(t: Tables) -> DataFrame:
    """Seasonal rain written once, partitioned by model and sorted by gauge, and read back."""
    path = new_table_path(t.spark, "seasonal")
    write_parquet(t.seasonal_model, path, partition_by=["GCM"], sort_by=["gauge", "year"])
    stored = read_parquet(t.spark, path)
    return stored.groupBy("GCM", "season").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(F.sum("historical"), 4).alias("historical"),
        F.round(F.sum("hist_nat"), 4).alias("hist_nat"),
    )


@query(
    "s_inline",
    """
    SELECT l.season, l.label, count(*) AS n_rows, round(sum(r.precipitation_mm), 4) AS total
    FROM (SELECT *, CASE WHEN month BETWEEN 4 AND 9 THEN 'cool_season' ELSE 'warm_season' END AS season FROM rain_obs) r
    JOIN (VALUES ('warm_season', 'October to March'), ('cool_season', 'April to September')) l(season, label)
    USING (season) GROUP BY 1, 2""",
    "rain_obs",
)
def s_inline(t: Tables) -> DataFrame:
    """A literal table of two rows joined to summed rain."""
    labels = t.spark.createDataFrame(
        [("warm_season", "October to March"), ("cool_season", "April to September")], "season string, label string"
    )
    sums = t.rain_obs.groupBy(season_of(F.col("month")).alias("season")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("precipitation_mm"), 4).alias("total")
    )
    return sums.join(F.broadcast(labels), "season")


# Projection and filters


@query(
    "p_project",
    """
    SELECT CAST(l_suppkey AS VARCHAR) AS gauge, CAST(year(l_shipdate) AS INTEGER) AS year, 'observed' AS "GCM",
           l_quantity AS p_mm, CAST(NULL AS DOUBLE) AS max_mm, round(l_quantity * (1 - l_discount), 6) AS net_mm
    FROM lineitem""",
)
def p_project(t: Tables) -> DataFrame:
    """Keep, rename, compute, add constants and order columns."""
    return t.raw("lineitem").select(
        F.col("l_suppkey").cast("string").alias("gauge"),
        F.year("l_shipdate").alias("year"),
        F.lit("observed").alias("GCM"),
        F.col("l_quantity").alias("p_mm"),
        F.lit(None).cast("double").alias("max_mm"),
        F.round(F.col("l_quantity") * (1 - F.col("l_discount")), 6).alias("net_mm"),
    )


@query(
    "p_filter",
    """
    SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, l_discount FROM lineitem
    WHERE l_returnflag IN ('A', 'R') AND l_quantity BETWEEN 10 AND 20 AND abs(l_discount - 0.05) < 0.015
      AND l_shipdate >= TIMESTAMP '1996-01-01'
      AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)""",
)
def p_filter(t: Tables) -> DataFrame:
    """Comparison, list, range, tolerance and key-set filters; the simple ones reach the scan."""
    wanted = t.raw("supplier").where(F.col("s_acctbal") > 0).select(F.col("s_suppkey").alias("l_suppkey"))
    kept = t.raw("lineitem").where(
        F.col("l_returnflag").isin("A", "R")
        & F.col("l_quantity").between(10, 20)
        & is_near(F.col("l_discount"), F.lit(0.05), 0.015)
        & (F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
    )
    return kept.join(wanted, "l_suppkey", "left_semi").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_discount"
    )


@query(
    "p_filename",
    """
    SELECT 'pr' AS variable, 'Amon' AS time_step, l_returnflag AS "GCM", 'historical' AS experiment,
           l_linestatus AS ensemble_id, 'gn' AS realisation, '199501-200112' AS date_range, count(*) AS n_rows
    FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def p_filename(t: Tables) -> DataFrame:
    """Seven fields from the part of a file name before the first dot."""
    name = F.concat_ws(
        "_", F.lit("pr_Amon"), "l_returnflag", F.lit("historical"), "l_linestatus", F.lit("gn_199501-200112.v1.csv")
    )
    fields = run_fields(F.col("name"))
    sums = t.raw("lineitem").groupBy(name.alias("name")).agg(F.count(F.lit(1)).alias("n_rows"))
    return sums.select(*[c.alias(n) for n, c in fields.items()], "n_rows")


@query(
    "p_case",
    """
    SELECT year, gauge, drought, CASE WHEN drought THEN 'dry' WHEN NOT drought THEN 'other' END AS state,
           CASE WHEN year BETWEEN 1995 AND 1997 THEN 1 WHEN year BETWEEN 1999 AND 2001 THEN 2 END AS decade,
           CASE WHEN p_mm > 90 THEN 'high' WHEN p_mm > 60 THEN 'middle' END AS class
    FROM obs_yearly WHERE q_mm IS NOT NULL""",
    "obs_yearly",
)
def p_case(t: Tables) -> DataFrame:
    """Conditional values with and without a default, after dropping incomplete rows."""
    rows = t.obs_yearly.na.drop("any")
    return rows.select(
        "year",
        "gauge",
        "drought",
        F.when(F.col("drought"), F.lit("dry")).otherwise(F.lit("other")).alias("state"),
        decade_of(F.col("year"), ((1, 1995, 1997), (2, 1999, 2001))).alias("decade"),
        F.when(F.col("p_mm") > 90, F.lit("high")).when(F.col("p_mm") > 60, F.lit("middle")).alias("class"),
    )


# Reshape


@query(
    "r_unpivot",
    """
    SELECT month, measure, count(*) AS n_rows, round(sum(value), 2) AS total FROM (
        SELECT CAST(month(l_shipdate) AS INTEGER) AS month, unnest(['l_quantity', 'l_discount', 'l_tax']) AS measure,
               unnest([l_quantity, l_discount, l_tax]) AS value FROM lineitem)
    GROUP BY 1, 2""",
)
def r_unpivot(t: Tables) -> DataFrame:
    """Wide to long, then sums per month; the long rows never leave their task unsummed."""
    lines = t.raw("lineitem").select(F.month("l_shipdate").alias("month"), "l_quantity", "l_discount", "l_tax")
    long = to_long(lines, ["month"], None, "measure", "value")
    return long.groupBy("month", "measure").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("value"), 2).alias("total")
    )


@query(
    "r_unpivot_suffix",
    """
    SELECT year, gauge, unnest(['first_effect', 'second_effect']) AS effect,
           round(unnest([hist_nat - co2_off, co2_off - co2_on]), 6) AS streamflow FROM scenarios""",
    "scenarios",
)
def r_unpivot_suffix(t: Tables) -> DataFrame:
    """Wide to long over the columns that share a suffix."""
    table = effects.scenario_table(effects.stacked_scenarios(t.regenerated, t.fitted, t.best)).select(
        "year",
        "gauge",
        (F.col("hist_nat") - F.col("co2_off")).alias("first_effect"),
        (F.col("co2_off") - F.col("co2_on")).alias("second_effect"),
    )
    return rounded(to_long(table, ["year", "gauge"], columns_ending(table, "effect"), "effect", "streamflow"))


@query(
    "r_pivot_flag",
    "SELECT gauge, round(with_co2, 6) AS CO2_model, round(without, 6) AS non_CO2_model FROM evidence",
    "evidence",
)
def r_pivot_flag(t: Tables) -> DataFrame:
    """Long to wide by a boolean, over distinct rows."""
    facts = t.fits.select("gauge", "contains_CO2", "AIC").distinct()
    labels = {True: "CO2_model", False: "non_CO2_model"}
    return rounded(to_wide(facts, ["gauge"], F.col("contains_CO2"), labels, F.col("AIC")))


@query(
    "r_pivot_experiment",
    """
    SELECT year, "GCM", gauge, season, sum(historical) AS historical, sum(hist_nat) AS hist_nat
    FROM seasonal_model GROUP BY 1, 2, 3, 4""",
    "seasonal_model",
)
def r_pivot_experiment(t: Tables) -> DataFrame:
    """Sums laid out by experiment in one shuffle."""
    tagged = t.rain_model.withColumns({"year": F.year("date"), "season": season_of(F.month("date"))})
    return sum_to_wide(
        tagged, ["year", "GCM", "gauge", "season"], F.col("experiment"), rain.EXPERIMENTS, F.col("precipitation_mm")
    )


@query(
    "r_pivot_season",
    """
    SELECT year, gauge, round(max(season_obs_precipitation) FILTER (season = 'warm_season'), 6) AS warm_season,
           round(max(season_obs_precipitation) FILTER (season = 'cool_season'), 6) AS cool_season
    FROM seasonal_obs GROUP BY 1, 2""",
    "seasonal_obs",
)
def r_pivot_season(t: Tables) -> DataFrame:
    labels = {"warm_season": "warm_season", "cool_season": "cool_season"}
    return rounded(
        to_wide(t.seasonal_obs, ["year", "gauge"], F.col("season"), labels, F.col("season_obs_precipitation"))
    )


@query(
    "r_pivot_type",
    """
    SELECT year, gauge, round(hist_nat, 6) AS hist_nat, round(co2_off, 6) AS co2_off, round(co2_on, 6) AS co2_on
    FROM scenarios""",
    "scenarios",
)
def r_pivot_type(t: Tables) -> DataFrame:
    """Three stacked scenarios side by side, complete rows only."""
    return rounded(effects.scenario_table(effects.stacked_scenarios(t.regenerated, t.fitted, t.best)))


# Joins and set operations


@query(
    "j_obs_scale",
    """
    SELECT year, gauge, season, "GCM", ensemble_id, historical, hist_nat,
           round(season_obs_precipitation, 6) AS season_obs_precipitation
    FROM terms JOIN seasonal_obs USING (year, gauge, season)""",
    "terms",
    "seasonal_obs",
)
def j_obs_scale(t: Tables) -> DataFrame:
    """Join on three keys, complete rows only."""
    joined = t.seasonal_model.join(t.seasonal_obs, ["year", "gauge", "season"]).na.drop("any")
    return rounded(joined.drop("realisation"))


@query(
    "j_left_dim",
    """
    SELECT gauge, count(*) AS n_rows, any_value(state) AS state, any_value(lat) AS lat
    FROM rain_model LEFT JOIN gauges USING (gauge) GROUP BY gauge""",
    "rain_model",
    "gauges",
)
def j_left_dim(t: Tables) -> DataFrame:
    """Gauge facts on counted rows: counted first, joined after."""
    counts = t.rain_model.groupBy("gauge").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.join(t.gauges.select("gauge", "state", "lat"), "gauge", "left")


@query(
    "j_attach_obs",
    """
    SELECT p.year, p."GCM", p.ensemble_id, p.gauge, round(p.annual_scaled_hist_nat_rainfall, 4) AS rain,
           round(o.q_mm, 6) AS q_mm, o.drought, o."CO2"
    FROM prepared p LEFT JOIN obs_yearly o ON p.gauge = o.gauge AND p.year = o.year""",
    "prepared",
    "obs_yearly",
)
def j_attach_obs(t: Tables) -> DataFrame:
    """Observed flow, drought and CO2 on every model series."""
    prepared = rain.prepared_rain(rain.scaled_rain(t.seasonal_model, t.seasonal_obs, 4))
    joined = flow.attach_observed(prepared, t.obs_yearly)
    return joined.select(
        "year",
        "GCM",
        "ensemble_id",
        "gauge",
        F.round("annual_scaled_hist_nat_rainfall", 4).alias("rain"),
        F.round("q_mm", 6).alias("q_mm"),
        "drought",
        "CO2",
    )


@query(
    "j_many_many",
    """
    SELECT s.gauge, s."GCM", s.ensemble_id, p.parameter, round(p.value, 6) AS parameter_value
    FROM (SELECT DISTINCT gauge, "GCM", ensemble_id FROM rain_model) s
    LEFT JOIN (SELECT gauge, unnest(['a0', 'a1', 'b']) AS parameter, unnest([a0, a1, b]) AS value FROM models_all) p
    ON p.gauge = s.gauge""",
    "rain_model",
    "models_all",
)
def j_many_many(t: Tables) -> DataFrame:
    """Every series with every parameter of its gauge."""
    series = t.rain_model.select("gauge", "GCM", "ensemble_id").distinct()
    listed = [F.lit(n) for n in ("a0", "a1", "b")]
    values = F.create_map(
        *[c for n in ("a0", "a1", "b") for c in (F.lit(n), F.expr(PARAMETER_SQL[n]).cast("double"))]
    )
    parameters = (
        t.raw("supplier")
        .select(F.col("s_suppkey").alias("k"))
        .select(F.col("k").cast("string").alias("gauge"), F.explode(F.array(*listed)).alias("parameter"), values.alias("v"))
        .select("gauge", "parameter", F.col("v")[F.col("parameter")].alias("parameter_value"))
    )
    return rounded(series.join(parameters, "gauge", "left"))


@query(
    "j_right",
    """
    SELECT g.gauge, g.state, s.streamflow_model, round(s.total, 4) AS total
    FROM (SELECT gauge, streamflow_model, sum(realspace_modelled_streamflow) AS total FROM fitted
          WHERE year <= 1999 GROUP BY 1, 2 HAVING sum(realspace_modelled_streamflow) > 1700) s
    RIGHT JOIN gauges g ON s.gauge = g.gauge""",
    "fitted",
    "gauges",
)
def j_right(t: Tables) -> DataFrame:
    """Right join: every gauge stays, with or without flow."""
    sums = (
        t.fitted.where(F.col("year") <= 1999)
        .groupBy("gauge", "streamflow_model")
        .agg(F.sum("realspace_modelled_streamflow").alias("total"))
        .where(F.col("total") > 1700)
    )
    return sums.join(t.gauges.select("gauge", "state"), "gauge", "right").withColumn("total", F.round("total", 4))


@query(
    "j_semi",
    """
    SELECT gauge, streamflow_model, year, round(realspace_modelled_streamflow, 6) AS realspace_modelled_streamflow
    FROM fitted SEMI JOIN best USING (gauge, streamflow_model) WHERE year <= 2000""",
    "fitted",
    "best",
)
def j_semi(t: Tables) -> DataFrame:
    """Fitted flow of the best model of each gauge."""
    return rounded(t.fitted.where(F.col("year") <= 2000).join(t.best, ["gauge", "streamflow_model"], "left_semi"))


@query(
    "j_anti",
    """
    SELECT r.year, r.gauge, r."GCM", r.ensemble_id, round(r.realspace_streamflow, 4) AS realspace_streamflow
    FROM regenerated r
    WHERE NOT EXISTS (SELECT 1 FROM obs_yearly o WHERE o.gauge = r.gauge AND o.year = r.year AND o.q_mm IS NULL)
      AND NOT EXISTS (SELECT 1 FROM (VALUES (1996, '2'), (1998, '3')) x(year, gauge)
                      WHERE x.gauge = r.gauge AND x.year = r.year)""",
    "regenerated",
    "obs_yearly",
)
def j_anti(t: Tables) -> DataFrame:
    """Drop the (year, gauge) pairs of a table and of a literal list."""
    gaps = t.obs_yearly.where(F.col("q_mm").isNull()).select("year", "gauge")
    listed = flow.excluded_years(t.spark, [(1996, "2"), (1998, "3")])
    kept = t.regenerated.join(gaps, ["year", "gauge"], "left_anti").join(
        F.broadcast(listed), ["year", "gauge"], "left_anti"
    )
    return rounded(kept, 4)


@query(
    "j_range_segment",
    """
    SELECT m.gauge, m."GCM", m.ensemble_id, m.year, m.position, r.start_index AS segment_id
    FROM (SELECT *, row_number() OVER (PARTITION BY gauge, "GCM", ensemble_id ORDER BY year) AS position
          FROM regenerated) m
    JOIN obs_runs r ON m.gauge = r.gauge AND m.position BETWEEN r.start_index AND r.end_index""",
    "regenerated",
    "obs_runs",
)
def j_range_segment(t: Tables) -> DataFrame:
    """Positions of the observed runs applied to every series of the gauge."""
    runs = valid_runs(t.obs_yearly, Series(("gauge",), ("year",)), "q_mm", 2)
    rows = positions(t.regenerated, Series(("gauge", "GCM", "ensemble_id"), ("year",)))
    return assign_segments(rows, runs, ["gauge"]).select(
        "gauge", "GCM", "ensemble_id", "year", "position", "segment_id"
    )


@query(
    "u_union",
    """
    SELECT year, gauge, "GCM", ensemble_id, round(p, 4) AS p_mm FROM (
        SELECT year, gauge, "GCM", ensemble_id, annual_scaled_hist_nat_rainfall AS p FROM prepared
        UNION ALL SELECT year, gauge, 'observed', 'observed', p_mm FROM obs_yearly)""",
    "prepared",
    "obs_yearly",
)
def u_union(t: Tables) -> DataFrame:
    """Model series and observed rain in one table, matched by column name."""
    prepared = rain.prepared_rain(rain.scaled_rain(t.seasonal_model, t.seasonal_obs, 4))
    both = prepared.drop("warm_season", "cool_season").unionByName(flow.as_model_series(t.obs_yearly))
    return both.select(
        "year", "gauge", "GCM", "ensemble_id", F.round("annual_scaled_hist_nat_rainfall", 4).alias("p_mm")
    )


_STACKED_SQL = f"""
    SELECT year, gauge, med AS flow, top, low, '{effects.HIST_NAT}' AS type FROM envelope
    UNION ALL SELECT year, gauge, realspace_streamflow, NULL, NULL, '{effects.CO2_OFF}'
              FROM regenerated WHERE "GCM" = 'observed'
    UNION ALL SELECT year, gauge, realspace_modelled_streamflow, NULL, NULL, '{effects.CO2_ON}'
              FROM fitted SEMI JOIN best USING (gauge, streamflow_model)"""


def _stacked(t: Tables) -> DataFrame:
    return effects.stacked_scenarios(t.flow_table, t.fitted, t.best)


@query(
    "u_scenarios",
    f"""
    SELECT type, CAST(CASE type WHEN '{effects.CO2_ON}' THEN 1 WHEN '{effects.CO2_OFF}' THEN 2 ELSE 3 END AS INTEGER) AS rank,
           count(*) AS n_rows, round(sum(flow), 4) AS flow, round(max(top), 4) AS top, round(min(low), 4) AS low
    FROM ({_STACKED_SQL}) GROUP BY type""",
    "envelope",
    "regenerated",
    "fitted",
    "best",
)
def u_scenarios(t: Tables) -> DataFrame:
    """Three stacked scenarios in their fixed order of labels."""
    sums = _stacked(t).groupBy("type").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(effects.FLOW).alias("flow"),
        F.max("max_GCM_realspace_streamflow").alias("top"),
        F.min("min_GCM_realspace_streamflow").alias("low"),
    )
    return rounded(with_rank(sums, "type", effects.SCENARIOS, "rank"), 4)


@query(
    "j_panels",
    f"""
    SELECT s.gauge, s.year, s.type, round(s.flow, 4) AS flow, p.split
    FROM ({_STACKED_SQL}) s
    JOIN (SELECT gauge, CAST(ceil(row_number() OVER (ORDER BY gauge) / 7) AS INTEGER) AS split
          FROM (SELECT DISTINCT gauge FROM envelope WHERE gauge NOT IN ('1', '4', '7'))) p USING (gauge)""",
    "envelope",
    "regenerated",
    "fitted",
    "best",
)
def j_panels(t: Tables) -> DataFrame:
    """Rows of the gauges outside a hand-picked list, in panels of seven gauges."""
    panels = effects.supplementary_panels(stored(_stacked(t), "stacked"), ("1", "4", "7"))
    return panels.select("gauge", "year", "type", F.round(effects.FLOW, 4).alias("flow"), "split")


# Sorts


@query(
    "o_sort",
    """
    SELECT gauge, state, list_extract(years, 1) AS first_year, array_to_string(list_reverse(list_sort(years)), ' ') AS newest_first
    FROM (SELECT gauge, list(DISTINCT CAST(year AS VARCHAR) ORDER BY CAST(year AS VARCHAR)) AS years
          FROM obs_yearly WHERE q_mm IS NOT NULL GROUP BY gauge)
    LEFT JOIN gauges USING (gauge)
    ORDER BY state DESC NULLS LAST, gauge""",
    "obs_yearly",
    "gauges",
)
def o_sort(t: Tables) -> DataFrame:
    """Ascending and descending order with missing values last, sorted and reversed lists."""
    years = F.array_sort(F.collect_set(F.col("year").cast("string")))
    listed = t.obs_yearly.where(F.col("q_mm").isNotNull()).groupBy("gauge").agg(years.alias("years"))
    joined = listed.join(t.gauges.select("gauge", "state"), "gauge", "left")
    return joined.select(
        "gauge",
        "state",
        F.element_at("years", 1).alias("first_year"),
        F.array_join(F.reverse("years"), " ").alias("newest_first"),
    ).orderBy(F.desc_nulls_last("state"), "gauge")


# Scalar functions


@query(
    "e_math",
    """
    SELECT l_orderkey, l_linenumber, round(exp(l_discount), 8) AS e, round(abs(l_discount - 0.05), 8) AS a,
           round(ln(l_extendedprice), 8) AS l, round(sqrt(l_quantity), 8) AS s, round(sinh(l_tax), 8) AS sh,
           round(asinh(l_discount), 8) AS ash, round(power(l_quantity, 1.5), 6) AS pw,
           CASE WHEN l_discount = 0.05 THEN 0 ELSE sign(l_discount - 0.05) * power(10.0, floor(log10(abs(l_discount - 0.05)))) END AS om,
           round_even(l_quantity / 4, 0) * 4 AS near4, floor(l_quantity / 4) * 4 AS low4, ceil(l_quantity / 4) * 4 AS up4,
           CASE WHEN l_quantity > 25 THEN l_quantity - 25 ELSE 0 END AS above25,
           CASE WHEN l_discount = 0 THEN 'Infinity'::DOUBLE ELSE round(l_quantity / l_discount, 4) END AS q_over_d,
           CASE WHEN l_discount = 0 THEN '-Infinity'::DOUBLE ELSE round(ln(l_discount), 8) END AS log_d,
           round((l_quantity - 1) / 49, 8) AS unit, CAST(trunc(l_quantity / 7) AS INTEGER) AS whole,
           round(l_tax + 1.4901161193847656e-08, 12) AS lifted,
           round(CASE WHEN l_quantity > 30 THEN (l_quantity - 30) * 1.1 ELSE (l_quantity - 30) * 0.9 END, 6) AS label_y,
           CASE WHEN l_quantity < 10 THEN -1 ELSE l_quantity END AS label_top
    FROM lineitem""",
)
def e_math(t: Tables) -> DataFrame:
    q, d, p = F.col("l_quantity"), F.col("l_discount"), F.col("l_extendedprice")
    shifted = d - F.lit(0.05)
    return t.raw("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.round(F.exp(d), 8).alias("e"),
        F.round(F.abs(shifted), 8).alias("a"),
        F.round(log_real(p), 8).alias("l"),
        F.round(F.sqrt(q), 8).alias("s"),
        F.round(F.sinh("l_tax"), 8).alias("sh"),
        F.round(asinh_stable(d), 8).alias("ash"),
        F.round(F.pow(q, F.lit(1.5)), 6).alias("pw"),
        order_of_magnitude(shifted).alias("om"),
        round_any(q, 4.0).alias("near4"),
        round_any(q, 4.0, F.floor).alias("low4"),
        round_any(q, 4.0, F.ceil).alias("up4"),
        clamp_below_zero(q - 25).alias("above25"),
        F.round(ratio(q, d), 4).alias("q_over_d"),
        F.round(log_real(d), 8).alias("log_d"),
        F.round(rescale(q, F.lit(1.0), F.lit(50.0)), 8).alias("unit"),
        (q / 7).cast("int").alias("whole"),
        F.round(F.col("l_tax") + F.lit(SQRT_EPSILON), 12).alias("lifted"),
        F.round(label_offset(q - 30, 0.1), 6).alias("label_y"),
        label_height(q, F.lit(0.0)).alias("label_top"),
    )


@query(
    "e_string",
    """
    SELECT s_suppkey, split_part(s_name, '#', 2) AS number, contains(s_name, '0009') AS has_0009,
           replace(CAST(CAST('1998-12-01' AS DATE) AS VARCHAR), '-', '') AS compact,
           s_name || ' (' || chr(CAST(65 + s_nationkey AS INTEGER)) || ')' AS labelled,
           chr(CAST(65 + s_nationkey AS INTEGER)) AS letter,
           CASE s_suppkey % 4 WHEN 0 THEN 'NSW' WHEN 1 THEN 'VIC' WHEN 2 THEN 'TAS' END AS code
    FROM supplier""",
)
def e_string(t: Tables) -> DataFrame:
    k = F.col("s_suppkey") % 4
    state = (
        F.when(k == 0, F.lit("New South Wales"))
        .when(k == 1, F.lit("Victoria"))
        .when(k == 2, F.lit("Tasmania"))
        .otherwise(F.lit("elsewhere"))
    )
    return t.raw("supplier").select(
        "s_suppkey",
        F.split_part("s_name", F.lit("#"), F.lit(2)).alias("number"),
        F.col("s_name").contains("0009").alias("has_0009"),
        F.replace(F.lit("1998-12-01"), F.lit("-"), F.lit("")).alias("compact"),
        F.concat("s_name", F.lit(" ("), letter(F.col("s_nationkey") + 1), F.lit(")")).alias("labelled"),
        letter(F.col("s_nationkey") + 1).alias("letter"),
        state_code(state).alias("code"),
    )


@query(
    "e_date",
    """
    SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
           CAST(day(last_day(date)) AS INTEGER) AS days, CAST(date + 31 AS DATE) AS later,
           round(0.00001::DOUBLE * 86400 * day(last_day(date)), 6) AS mm, DATE '1995-01-01' AS origin,
           CAST(CASE WHEN year(date) BETWEEN 1990 AND 1999 THEN 1 WHEN year(date) BETWEEN 2005 AND 2014 THEN 2 END AS INTEGER) AS decade,
           count(*) AS n_rows
    FROM rain_model GROUP BY date""",
    "rain_model",
)
def e_date(t: Tables) -> DataFrame:
    date = F.col("date")
    per_day = t.rain_model.groupBy("date").agg(F.count(F.lit(1)).alias("n_rows"))
    return per_day.select(
        "date",
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        days_in_month(date).alias("days"),
        offset_date(date, F.lit(31.5)).alias("later"),
        F.round(mm_per_month(F.lit(0.00001), date), 6).alias("mm"),
        range_origin(F.lit("200112-199501")).alias("origin"),
        decade_of(F.year(date)).alias("decade"),
        "n_rows",
    )


@query(
    "e_season",
    """
    SELECT CAST(month(date) AS INTEGER) AS month,
           CASE WHEN month(date) IN (4, 5, 6, 7, 8, 9) THEN 'cool_season' ELSE 'warm_season' END AS season,
           count(*) AS n_rows, sum(precipitation_mm) AS total
    FROM rain_model GROUP BY 1, 2""",
    "rain_model",
)
def e_season(t: Tables) -> DataFrame:
    month: Column = F.month("date")
    return t.rain_model.groupBy(month.alias("month"), season_of(month).alias("season")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("precipitation_mm").alias("total")
    )
