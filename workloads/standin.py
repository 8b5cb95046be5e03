"""Stand-in tables: the driver's tables in the shape of rain, flow and gauge tables.

Each stand-in is written twice, as a Spark DataFrame and as a SQL view for the oracle. No row of
the source table is left out.

    rain_model   lineitem   gauge = supplier, GCM = return flag, member = line status
    rain_obs     orders     gauge = customer modulo the number of suppliers
    flow_events  events     gauge = user, flow missing on errors
    flow_monthly lineitem   one value per gauge and month, missing in months without open lines
    obs_yearly   orders     yearly rain, flow with gaps, drought, CO2
    regenerated  both       flow of model series and of the observed series
    fitted       orders     fitted flow of two models per gauge
    gauges, fits, parameters, evaporation   supplier and lineitem
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions.nulls import strict_sum
from freshet.operators.flow_models import ALL_MODELS, registry
from freshet.plans.flow import lift_zero_flow
from freshet.plans.rain import RATIO, seasonal_model_rain, seasonal_observed_rain
from freshet.session import stored

# Windows and spans that fit the seven calendar years of the driver's tables.
ROLL = 4
START_YEAR, END_YEAR = 1995, 2001
SPANS = ((1, 1995, 1997), (2, 1999, 2001))
PERIOD = (1996, 2000)

# (supplier number k) -> parameter value, as Spark and SQL text alike.
PARAMETER_SQL = {
    "a0": "1 + 0.01 * (k % 7)",
    "a0_d": "0.5 + 0.01 * (k % 5)",
    "a0_n": "1.5 + 0.01 * (k % 3)",
    "a1": "0.2 + 0.05 * (k % 5)",
    "a2": "0.1 + 0.1 * (k % 6)",
    "a3_intercept": "0.01 * (1 + k % 3)",
    "a3_slope": "0.0005 * (1 + k % 4)",
    "a4": "0.3 * (k % 3)",
    "a5": "300.0 + k % 9",
    "b": "0.02 + 0.01 * (k % 8)",
    "sd": "1.0",
}


RAW_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


class Tables:
    """Lazily built stand-ins for one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        """A driver table under its declared schema, so that no job is spent on inferring it."""
        return self.spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def rain_model(self) -> DataFrame:
        experiment = F.when(F.col("l_linenumber") % 2 == 0, F.lit("historical")).otherwise(F.lit("hist-nat"))
        return self.raw("lineitem").select(
            F.col("l_suppkey").cast("string").alias("gauge"),
            F.col("l_returnflag").alias("GCM"),
            F.col("l_linestatus").alias("ensemble_id"),
            F.lit("gn").alias("realisation"),
            experiment.alias("experiment"),
            F.to_date("l_shipdate").alias("date"),
            F.col("l_quantity").alias("precipitation_mm"),
        )

    @cached_property
    def rain_obs(self) -> DataFrame:
        suppliers = self.raw("supplier").agg(F.count(F.lit(1))).scalar()
        date = F.to_date("o_orderdate")
        return self.raw("orders").select(
            (F.col("o_custkey") % suppliers).cast("string").alias("gauge"),
            F.year(date).alias("year"),
            F.month(date).alias("month"),
            F.dayofmonth(date).alias("day"),
            (F.col("o_totalprice") / 6543.21).alias("precipitation_mm"),
            F.col("o_orderstatus").alias("status"),
        )

    @cached_property
    def flow_events(self) -> DataFrame:
        flow = F.when(F.col("event_type") != "error", F.col("value"))
        return self.raw("events").select(
            F.col("user_id").cast("string").alias("gauge"),
            "ts",
            "event_id",
            flow.alias("q"),
            "event_type",
        )

    @cached_property
    def flow_monthly(self) -> DataFrame:
        """Month number ``t`` from 0, rain, and a flow that is missing without open lines."""
        month = (F.year("l_shipdate") - 1995) * 12 + F.month("l_shipdate") - 1
        return (
            self.raw("lineitem")
            .groupBy(F.col("l_suppkey").cast("string").alias("gauge"), month.alias("t"))
            .agg(
                F.sum("l_quantity").alias("rain"),
                F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_quantity"))).alias("q"),
            )
        )

    @cached_property
    def seasonal_model(self) -> DataFrame:
        return seasonal_model_rain(self.rain_model)

    @cached_property
    def seasonal_obs(self) -> DataFrame:
        return seasonal_observed_rain(self.rain_obs)

    @cached_property
    def obs_yearly(self) -> DataFrame:
        warm = ~F.col("month").between(4, 9)
        rain = F.col("precipitation_mm")
        total = F.sum(rain)
        yearly = self.rain_obs.groupBy("gauge", "year").agg(
            (total / 10).alias("p_mm"),
            F.when(
                F.avg((F.col("status") == "P").cast("double")) <= 0.42,
                F.sum(F.when(F.col("status") == "F", rain).otherwise(F.lit(0.0))) / 10,
            ).alias("q_mm"),
            (F.count(F.lit(1)) < 20).alias("drought"),
            (F.sum(F.when(warm, rain).otherwise(F.lit(0.0))) / total - 0.5).alias(RATIO),
        )
        lifted = lift_zero_flow(yearly.withColumn("CO2", (F.lit(290.0) + 4 * (F.col("year") - 1995))))
        return lifted.select("year", "gauge", "p_mm", "q_mm", "drought", "CO2", RATIO)

    @cached_property
    def regenerated(self) -> DataFrame:
        models = self.rain_model.groupBy("gauge", "GCM", "ensemble_id", F.year("date").alias("year")).agg(
            F.sum("precipitation_mm").alias("realspace_streamflow")
        )
        observed = self.rain_obs.groupBy("gauge", "year").agg(
            (F.sum("precipitation_mm") / 2).alias("realspace_streamflow")
        )
        return models.unionByName(
            observed.withColumns({"GCM": F.lit("observed"), "ensemble_id": F.lit("observed")})
        )

    @cached_property
    def flow_table(self) -> DataFrame:
        """``regenerated`` as a written table, for queries that read it in several branches."""
        return stored(self.regenerated, "regenerated")

    @cached_property
    def obs_table(self) -> DataFrame:
        """``obs_yearly`` as a written table, for queries that read it in several branches."""
        return stored(self.obs_yearly, "obs_yearly")

    @cached_property
    def fitted(self) -> DataFrame:
        """Two models per gauge and year; the best one of a gauge is in ``best``."""
        yearly = self.rain_obs.groupBy("gauge", "year").agg(F.sum("precipitation_mm").alias("s"))
        models = F.array(
            F.struct(F.lit("first").alias("streamflow_model"), F.lit(0.8).alias("f")),
            F.struct(F.lit("second").alias("streamflow_model"), F.lit(0.9).alias("f")),
        )
        flow = F.col("s") / 2 * (F.col("f") + F.lit(0.05) * (F.col("year") % 3))
        return yearly.select("gauge", "year", "s", F.inline(models)).select(
            "gauge", "streamflow_model", "year", flow.alias("realspace_modelled_streamflow")
        )

    @cached_property
    def best(self) -> DataFrame:
        name = F.when(F.col("s_suppkey") % 2 == 0, F.lit("first")).otherwise(F.lit("second"))
        return self.raw("supplier").select(
            F.col("s_suppkey").cast("string").alias("gauge"), name.alias("streamflow_model")
        )

    @cached_property
    def gauges(self) -> DataFrame:
        k = F.col("s_suppkey")
        suppliers = self.raw("supplier").select(
            k.cast("string").alias("gauge"),
            (F.lit(-10.0) - k % 30).alias("lat"),
            (F.lit(115.0) + k % 38).alias("lon"),
            "s_nationkey",
        )
        nations = self.raw("nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("state"))
        return suppliers.join(nations, "s_nationkey", "left").select("gauge", "lat", "lon", "state")

    @cached_property
    def fits(self) -> DataFrame:
        """Fit quality with and without carbon; every parameter repeats it, as fit tables do."""
        k = F.col("s_suppkey")
        base = F.col("s_acctbal") / 1000
        kinds = F.array(
            F.struct(F.lit(True).alias("contains_CO2"), (base + k % 11).alias("AIC")),
            F.struct(F.lit(False).alias("contains_CO2"), (base + 2 * (k % 13)).alias("AIC")),
        )
        rows = self.raw("supplier").select(k.cast("string").alias("gauge"), F.inline(kinds))
        return rows.withColumn("parameter", F.explode(F.array(F.lit("a0"), F.lit("a1"), F.lit("b"))))

    def _parameters(self, models: DataFrame) -> DataFrame:
        names = F.concat(F.col("parameters"), F.array(F.lit("b"), F.lit("sd")))
        listed = models.join(F.broadcast(registry(self.spark)), "streamflow_model").select(
            "k", "streamflow_model", F.posexplode(names).alias("parameter_index", "parameter")
        )
        cases = " ".join(f"WHEN '{name}' THEN CAST({text} AS DOUBLE)" for name, text in PARAMETER_SQL.items())
        value = F.expr(f"CASE parameter {cases} END")
        return listed.select(
            F.col("k").cast("string").alias("gauge"),
            "streamflow_model",
            "parameter_index",
            "parameter",
            value.alias("parameter_value"),
        )

    def _models(self, index: Column) -> DataFrame:
        names = F.split(F.lit(" ".join(m.name for m in ALL_MODELS)), " ")
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("k"), F.element_at(names, (index + 1).cast("int")).alias("streamflow_model")
        )

    @cached_property
    def parameters(self) -> DataFrame:
        """One of the 24 models per gauge."""
        return self._parameters(self._models(F.col("s_suppkey") % 24))

    @cached_property
    def auto_parameters(self) -> DataFrame:
        """One of the 12 autoregressive models per gauge."""
        return self._parameters(self._models(2 * (F.col("s_suppkey") % 12) + 1))

    @cached_property
    def plain_parameters(self) -> DataFrame:
        """One of the 12 models without autoregression per gauge."""
        return self._parameters(self._models(2 * (F.col("s_suppkey") % 12)))

    @cached_property
    def carbon_parameters(self) -> DataFrame:
        """One of the 16 models with carbon terms per gauge."""
        k = F.col("s_suppkey") % 16
        return self._parameters(self._models(4 + k % 8 + F.when(k >= 8, 12).otherwise(0)))

    @cached_property
    def evaporation(self) -> DataFrame:
        date = F.to_date("l_shipdate")
        size = F.col("l_extendedprice") / 60000 * (1 + F.col("l_suppkey") % 10)
        return self.raw("lineitem").select(
            F.year(date).alias("year"),
            F.month(date).alias("month"),
            F.dayofmonth(date).alias("day"),
            F.col("l_suppkey").cast("string").alias("gauge"),
            size.alias("APET_mm"),
        )

    @cached_property
    def evaporation_daily(self) -> DataFrame:
        return self.evaporation.groupBy("year", "month", "day", "gauge").agg(
            strict_sum(F.col("APET_mm")).alias("APET_mm")
        )


def _parameter_columns() -> str:
    return ", ".join(f"CAST({text} AS DOUBLE) AS {name}" for name, text in PARAMETER_SQL.items())


_PARTS_SQL = """
SELECT k, gauge, idx, (idx // 12) = 1 AS has_drought, (idx // 4) % 3 AS co2_kind, (idx // 2) % 2 = 1 AS has_ratio,
       idx % 2 = 1 AS has_auto, %s
FROM (SELECT s_suppkey AS k, CAST(s_suppkey AS VARCHAR) AS gauge, %s AS idx FROM supplier)
"""


def _parts(index: str) -> str:
    return _PARTS_SQL.replace("%s", _parameter_columns(), 1).replace("%s", index, 1)


# name -> (views it needs, SQL)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "rain_model": (
        (),
        """
        SELECT CAST(l_suppkey AS VARCHAR) AS gauge, l_returnflag AS "GCM", l_linestatus AS ensemble_id,
               'gn' AS realisation,
               CASE WHEN l_linenumber % 2 = 0 THEN 'historical' ELSE 'hist-nat' END AS experiment,
               CAST(l_shipdate AS DATE) AS date, l_quantity AS precipitation_mm
        FROM lineitem""",
    ),
    "rain_obs": (
        (),
        """
        SELECT CAST(o_custkey % (SELECT count(*) FROM supplier) AS VARCHAR) AS gauge,
               CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
               CAST(day(o_orderdate) AS INTEGER) AS day, o_totalprice / 6543.21 AS precipitation_mm,
               o_orderstatus AS status
        FROM orders""",
    ),
    "flow_events": (
        (),
        """
        SELECT CAST(user_id AS VARCHAR) AS gauge, ts, event_id,
               CASE WHEN event_type <> 'error' THEN value END AS q, event_type
        FROM events""",
    ),
    "flow_numbered": (
        ("flow_events",),
        """
        SELECT *, row_number() OVER (PARTITION BY gauge ORDER BY ts, event_id) AS position
        FROM flow_events""",
    ),
    "flow_runs": (
        ("flow_numbered",),
        """
        SELECT gauge, min(position) AS start_index, max(position) AS end_index, count(*) AS length
        FROM (SELECT gauge, position,
                     position - row_number() OVER (PARTITION BY gauge ORDER BY position) AS island
              FROM flow_numbered WHERE q IS NOT NULL)
        GROUP BY gauge, island""",
    ),
    "flow_monthly": (
        (),
        """
        SELECT CAST(l_suppkey AS VARCHAR) AS gauge,
               CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) - 1 AS INTEGER) AS t,
               sum(l_quantity) AS rain, sum(CASE WHEN l_linestatus = 'O' THEN l_quantity END) AS q
        FROM lineitem GROUP BY 1, 2""",
    ),
    "seasonal_model": (
        ("rain_model",),
        """
        SELECT CAST(year(date) AS INTEGER) AS year, "GCM", ensemble_id, realisation, gauge,
               CASE WHEN month(date) BETWEEN 4 AND 9 THEN 'cool_season' ELSE 'warm_season' END AS season,
               sum(precipitation_mm) FILTER (experiment = 'historical') AS historical,
               sum(precipitation_mm) FILTER (experiment = 'hist-nat') AS hist_nat
        FROM rain_model GROUP BY 1, 2, 3, 4, 5, 6""",
    ),
    "seasonal_obs": (
        ("rain_obs",),
        """
        SELECT year, gauge,
               CASE WHEN month BETWEEN 4 AND 9 THEN 'cool_season' ELSE 'warm_season' END AS season,
               sum(precipitation_mm) AS season_obs_precipitation
        FROM rain_obs GROUP BY 1, 2, 3""",
    ),
    "terms": (
        ("seasonal_model",),
        """
        SELECT *, hist_nat / historical AS naive_scale_term FROM seasonal_model
        WHERE historical IS NOT NULL AND hist_nat IS NOT NULL""",
    ),
    "smoothed": (
        ("terms",),
        f"""
        SELECT *, CASE WHEN count(*) OVER w = {ROLL} THEN avg(naive_scale_term) OVER w END AS smooth_scale_term
        FROM terms
        WINDOW w AS (PARTITION BY "GCM", ensemble_id, realisation, gauge ORDER BY year, season DESC
                     ROWS BETWEEN {ROLL - 1} PRECEDING AND CURRENT ROW)""",
    ),
    "scaled": (
        ("smoothed", "seasonal_obs"),
        """
        SELECT s.*, o.season_obs_precipitation,
               s.smooth_scale_term * o.season_obs_precipitation AS scaled_hist_nat
        FROM smoothed s JOIN seasonal_obs o USING (year, gauge, season)
        WHERE s.smooth_scale_term IS NOT NULL""",
    ),
    "prepared": (
        ("scaled",),
        """
        SELECT *, warm_season / annual_scaled_hist_nat_rainfall
                  - avg(warm_season / annual_scaled_hist_nat_rainfall)
                    OVER (PARTITION BY "GCM", ensemble_id, gauge)
                  AS standardised_warm_season_to_annual_rainfall_ratio
        FROM (SELECT *, warm_season + cool_season AS annual_scaled_hist_nat_rainfall
              FROM (SELECT year, "GCM", ensemble_id, gauge,
                           max(scaled_hist_nat) FILTER (season = 'warm_season') AS warm_season,
                           max(scaled_hist_nat) FILTER (season = 'cool_season') AS cool_season
                    FROM scaled GROUP BY 1, 2, 3, 4))""",
    ),
    "obs_yearly": (
        ("rain_obs",),
        """
        SELECT year, gauge, sum(precipitation_mm) / 10 AS p_mm,
               CASE WHEN avg(CASE WHEN status = 'P' THEN 1.0 ELSE 0.0 END) <= 0.42
                    THEN sum(CASE WHEN status = 'F' THEN precipitation_mm ELSE 0 END) / 10
                         + 1.4901161193847656e-08 END AS q_mm,
               count(*) < 20 AS drought,
               CAST(290.0 + 4 * (year - 1995) AS DOUBLE) AS "CO2",
               sum(CASE WHEN month BETWEEN 4 AND 9 THEN 0 ELSE precipitation_mm END) / sum(precipitation_mm) - 0.5
                   AS standardised_warm_season_to_annual_rainfall_ratio
        FROM rain_obs GROUP BY year, gauge""",
    ),
    "regenerated": (
        ("rain_model", "rain_obs"),
        """
        SELECT gauge, "GCM", ensemble_id, CAST(year(date) AS INTEGER) AS year,
               sum(precipitation_mm) AS realspace_streamflow
        FROM rain_model GROUP BY 1, 2, 3, 4
        UNION ALL
        SELECT gauge, 'observed', 'observed', year, sum(precipitation_mm) / 2 FROM rain_obs GROUP BY gauge, year""",
    ),
    "fitted": (
        ("rain_obs",),
        """
        SELECT gauge, streamflow_model, year, s / 2 * (f + 0.05 * (year % 3)) AS realspace_modelled_streamflow
        FROM (SELECT gauge, year, sum(precipitation_mm) AS s FROM rain_obs GROUP BY gauge, year),
             (VALUES ('first', 0.8::DOUBLE), ('second', 0.9::DOUBLE)) v(streamflow_model, f)""",
    ),
    "best": (
        (),
        """
        SELECT CAST(s_suppkey AS VARCHAR) AS gauge,
               CASE WHEN s_suppkey % 2 = 0 THEN 'first' ELSE 'second' END AS streamflow_model
        FROM supplier""",
    ),
    "medians": (
        ("regenerated",),
        """
        SELECT year, "GCM", gauge, median(realspace_streamflow) AS m
        FROM regenerated WHERE "GCM" <> 'observed' GROUP BY 1, 2, 3""",
    ),
    "envelope": (
        ("medians",),
        """
        SELECT year, gauge, median(m) AS med, max(m) AS top, min(m) AS low FROM medians GROUP BY year, gauge""",
    ),
    "scenarios": (
        ("envelope", "regenerated", "fitted", "best"),
        """
        SELECT e.year, e.gauge, e.med AS hist_nat, o.realspace_streamflow AS co2_off,
               f.realspace_modelled_streamflow AS co2_on
        FROM envelope e
        JOIN regenerated o ON o."GCM" = 'observed' AND o.gauge = e.gauge AND o.year = e.year
        JOIN (SELECT * FROM fitted JOIN best USING (gauge, streamflow_model)) f
             ON f.gauge = e.gauge AND f.year = e.year""",
    ),
    "gauges": (
        (),
        """
        SELECT CAST(s_suppkey AS VARCHAR) AS gauge, CAST(-10.0 - s_suppkey % 30 AS DOUBLE) AS lat,
               CAST(115.0 + s_suppkey % 38 AS DOUBLE) AS lon, n_name AS state
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    ),
    "effects": (
        ("scenarios", "gauges"),
        """
        SELECT *, CASE WHEN total_effect > rainfall_effect THEN rainfall_effect / total_effect
                       ELSE total_effect / rainfall_effect END AS relative_rainfall_effect,
               CASE WHEN total_effect > partitioning_effect THEN partitioning_effect / total_effect
                    ELSE total_effect / partitioning_effect END AS relative_partitioning_effect
        FROM (SELECT *, abs(hn - con) AS total_effect, abs(hn - coff) AS rainfall_effect,
                     abs(coff - con) AS partitioning_effect
              FROM (SELECT gauge, CAST(CASE WHEN year <= 1997 THEN 1 ELSE 2 END AS INTEGER) AS decade,
                           sum(hist_nat) AS hn, sum(co2_off) AS coff, sum(co2_on) AS con
                    FROM scenarios WHERE year BETWEEN 1995 AND 1997 OR year BETWEEN 1999 AND 2001
                    GROUP BY 1, 2))
        LEFT JOIN gauges USING (gauge)""",
    ),
    "uncertain": (
        ("effects", "medians"),
        """
        SELECT e.*, u.range_relative_rainfall_effect, u.range_total_CC_percentage_effect
        FROM effects e LEFT JOIN (
            SELECT gauge, decade, quantile_cont(rel, 0.75) - quantile_cont(rel, 0.25) AS range_relative_rainfall_effect,
                   quantile_cont(pct, 0.75) - quantile_cont(pct, 0.25) AS range_total_CC_percentage_effect
            FROM (SELECT gauge, decade,
                         CASE WHEN t > p THEN p / t ELSE t / p END AS rel,
                         CASE WHEN t < p THEN t / hn ELSE -t / hn END * 100 AS pct
                  FROM (SELECT g.gauge, g.decade, g.hn, abs(g.hn - e.con) AS t, abs(e.coff - e.con) AS p
                        FROM (SELECT gauge, CAST(CASE WHEN year <= 1997 THEN 1 ELSE 2 END AS INTEGER) AS decade,
                                     "GCM", sum(m) AS hn
                              FROM medians WHERE year BETWEEN 1995 AND 1997 OR year BETWEEN 1999 AND 2001
                              GROUP BY 1, 2, 3) g
                        LEFT JOIN effects e ON e.gauge = g.gauge AND e.decade = g.decade))
            GROUP BY gauge, decade) u ON u.gauge = e.gauge AND u.decade = e.decade""",
    ),
    "total": (
        ("uncertain",),
        """
        SELECT *, relative_rainfall_effect * share AS rain_share, (1 - relative_rainfall_effect) * share AS part_share
        FROM (SELECT *, CASE WHEN total_effect < partitioning_effect THEN total_effect / hn
                             ELSE -total_effect / hn END AS share FROM uncertain)""",
    ),
    "period": (
        ("scenarios", "gauges"),
        """
        SELECT *, rel * share AS rain_share, (1 - rel) * share AS part_share
        FROM (SELECT *, CASE WHEN total_effect > rainfall_effect THEN rainfall_effect / total_effect
                             ELSE total_effect / rainfall_effect END AS rel,
                     CASE WHEN total_effect > partitioning_effect THEN partitioning_effect / total_effect
                          ELSE total_effect / partitioning_effect END AS rel_part,
                     CASE WHEN total_effect < partitioning_effect THEN total_effect / hn
                          ELSE -total_effect / hn END AS share
              FROM (SELECT *, abs(hn - con) AS total_effect, abs(hn - coff) AS rainfall_effect,
                           abs(coff - con) AS partitioning_effect
                    FROM (SELECT gauge, sum(hist_nat) AS hn, sum(co2_off) AS coff, sum(co2_on) AS con
                          FROM scenarios WHERE year BETWEEN 1996 AND 2000 GROUP BY 1)))
        LEFT JOIN gauges USING (gauge)""",
    ),
    "evaporation": (
        (),
        """
        SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
               CAST(day(l_shipdate) AS INTEGER) AS day, CAST(l_suppkey AS VARCHAR) AS gauge,
               l_extendedprice / 60000 * (1 + l_suppkey % 10) AS "APET_mm"
        FROM lineitem""",
    ),
    "aridity": (
        ("evaporation", "obs_yearly"),
        """
        SELECT *, CASE WHEN aridity BETWEEN 0.2 AND 0.5 THEN 'semi-arid' WHEN aridity BETWEEN 0.5 AND 1 THEN 'sub-humid'
                       WHEN aridity BETWEEN 0.05 AND 0.2 THEN 'arid' WHEN aridity > 1 THEN 'wet' END
                  AS aridity_classification
        FROM (SELECT gauge, mean_annual_PET, mean_annual_precip, mean_annual_precip / mean_annual_PET AS aridity
              FROM (SELECT gauge, avg(s) AS mean_annual_PET
                    FROM (SELECT year, gauge, sum("APET_mm") AS s FROM evaporation GROUP BY 1, 2) GROUP BY 1)
              LEFT JOIN (SELECT gauge, avg(p_mm) AS mean_annual_precip FROM obs_yearly GROUP BY 1) USING (gauge))""",
    ),
    "fits": (
        (),
        """
        SELECT CAST(s_suppkey AS VARCHAR) AS gauge, contains_CO2,
               CASE WHEN contains_CO2 THEN s_acctbal / 1000 + s_suppkey % 11
                    ELSE s_acctbal / 1000 + 2 * (s_suppkey % 13) END AS aic, parameter
        FROM supplier, (VALUES (true), (false)) c(contains_CO2), (VALUES ('a0'), ('a1'), ('b')) p(parameter)""",
    ),
    "evidence": (
        ("fits",),
        """
        SELECT *, CASE WHEN d < 0 THEN exp(0.5 * abs(d)) WHEN d > 0 THEN -exp(0.5 * abs(d)) END AS evidence_ratio
        FROM (SELECT gauge, max(aic) FILTER (contains_CO2) AS with_co2, max(aic) FILTER (NOT contains_CO2) AS without,
                     max(aic) FILTER (contains_CO2) - max(aic) FILTER (NOT contains_CO2) AS d
              FROM fits GROUP BY gauge)""",
    ),
    "models_all": ((), _parts("s_suppkey % 24")),
    "models_auto": ((), _parts("2 * (s_suppkey % 12) + 1")),
    "models_plain": ((), _parts("2 * (s_suppkey % 12)")),
    "models_carbon": ((), _parts("4 + s_suppkey % 8 + CASE WHEN s_suppkey % 16 >= 8 THEN 12 ELSE 0 END")),
    "obs_runs": (
        ("obs_yearly",),
        """
        SELECT gauge, min(position) AS start_index, max(position) AS end_index, count(*) AS length
        FROM (SELECT gauge, position,
                     position - row_number() OVER (PARTITION BY gauge ORDER BY position) AS island
              FROM (SELECT *, row_number() OVER (PARTITION BY gauge ORDER BY year) AS position FROM obs_yearly)
              WHERE q_mm IS NOT NULL)
        GROUP BY gauge, island HAVING count(*) >= 2""",
    ),
}


def model_terms(source: str, models: str, keys: str, t: str, carry: str, carbon: float = 1.0) -> str:
    """SQL text: base and full terms of each row of ``source`` under the model of its gauge."""
    base = "CASE WHEN has_drought THEN CASE WHEN is_drought_year THEN a0_d WHEN NOT is_drought_year THEN a0_n END ELSE a0 END + a1 * precipitation"
    excess = 'greatest(0.0, "CO2" - a5)'
    return f"""
        SELECT {keys}, {t} AS t, {carry}, a2, b, has_auto, {base} AS base,
               {base}
               + CASE co2_kind WHEN 1 THEN {carbon} * a3_intercept * {excess}
                          WHEN 2 THEN {carbon} * a3_slope * precipitation * {excess} ELSE 0 END
               + CASE WHEN has_ratio THEN a4 * seasonal_ratio ELSE 0 END AS c
        FROM {source} JOIN {models} USING (gauge)"""


def model_scores(terms: str, keys: str) -> str:
    """SQL text: closed form of the recursion, by a self-join inside each segment."""
    on = " AND ".join(f"x.{k.strip()} = y.{k.strip()}" for k in keys.split(","))
    group = ", ".join(f"x.{k.strip()}" for k in keys.split(","))
    same = f"OVER (PARTITION BY {keys})"
    mu = f"CASE WHEN count(*) {same} = count(base) {same} THEN avg(base) {same} END"
    return f"""
        SELECT {group}, x.t,
               CASE WHEN any_value(x.has_auto)
                    THEN any_value(x.mu) + sum(power(x.a2, x.n - y.n) * (y.c - y.mu))
                    ELSE any_value(x.c) END AS transformed_streamflow
        FROM (SELECT *, {mu} AS mu,
                     row_number() OVER (PARTITION BY {keys} ORDER BY t) AS n FROM {terms}) x
        JOIN (SELECT *, {mu} AS mu,
                     row_number() OVER (PARTITION BY {keys} ORDER BY t) AS n FROM {terms}) y
          ON {on} AND y.n <= x.n
        GROUP BY {group}, x.t"""
