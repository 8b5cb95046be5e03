"""Queries on value transforms and flow models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.operators.flow_models import (
    ALL_MODELS,
    bind_parameters,
    registry,
    score,
    score_sets,
    without_carbon,
)
from freshet.operators.series import Series, own_segments
from freshet.operators.transforms import (
    TRANSFORMS,
    boxcox,
    boxcox_inverse,
    log_sinh,
    log_sinh_inverse,
    transform_by_name,
    transform_parameters,
)
from freshet.plans.rain import RATIO
from workloads.registry import query
from workloads.standin import Tables, model_scores, model_terms
from workloads.tidy import rounded

def _transform_rows(t: Tables) -> DataFrame:
    """Monthly rain with a Box-Cox lambda (negative to 1.5) and a log-sinh b per gauge."""
    k = F.col("gauge").cast("long")
    lam = (k % 9) * F.lit(0.25) - F.lit(0.5)
    b = F.lit(0.02) + (k % 8) * F.lit(0.01)
    return t.flow_monthly.select("gauge", "t", (F.col("rain") / 100).alias("y"), lam.alias("lam"), b.alias("b"))


_ROWS_SQL = """
    (SELECT gauge, t, rain / 100 AS y, (CAST(gauge AS BIGINT) % 9) * 0.25::DOUBLE - 0.5::DOUBLE AS lam,
            0.02::DOUBLE + (CAST(gauge AS BIGINT) % 8) * 0.01::DOUBLE AS b FROM flow_monthly)"""


def _applied(t: Tables, value: Column) -> DataFrame:
    return rounded(_transform_rows(t).select("gauge", "t", value.alias("value")), 8)


@query(
    "t_boxcox",
    f"""
    SELECT gauge, t, round(CASE WHEN lam <= 1.4901161193847656e-08 THEN ln(y + 0.5)
                                ELSE (power(y + 0.5, lam) - 1) / lam END, 8) AS value FROM {_ROWS_SQL}""",
    "flow_monthly",
)
def t_boxcox(t: Tables) -> DataFrame:
    return _applied(t, boxcox(F.col("y"), F.col("lam"), F.lit(0.5)))


@query(
    "t_boxcox_inv",
    f"""
    SELECT gauge, t, round(CASE WHEN lam <= 1.4901161193847656e-08 THEN exp(y) - 0.5
                                ELSE power(y * lam + 1, 1 / lam) - 0.5 END, 4) AS value FROM {_ROWS_SQL}""",
    "flow_monthly",
)
def t_boxcox_inv(t: Tables) -> DataFrame:
    value = boxcox_inverse(F.col("y"), F.col("lam"), F.lit(0.5))
    return rounded(_transform_rows(t).select("gauge", "t", value.alias("value")), 4)


@query(
    "t_logsinh",
    f"SELECT gauge, t, round(ln(sinh(b * (y * 100 + 0.5))) / b, 6) AS value FROM {_ROWS_SQL}",
    "flow_monthly",
)
def t_logsinh(t: Tables) -> DataFrame:
    value = log_sinh(F.col("y") * 100, F.col("b"), F.lit(0.5))
    return rounded(_transform_rows(t).select("gauge", "t", value.alias("value")), 6)


@query(
    "t_logsinh_inv",
    f"""
    SELECT gauge, t, round(CASE WHEN b * z > 700 THEN b * z + ln(1 + sqrt(1 + exp(-2 * b * z))) ELSE asinh(exp(b * z)) END
                           / b - 0.5, 6) AS value
    FROM (SELECT *, y * 2000 - 1000 AS z FROM {_ROWS_SQL})""",
    "flow_monthly",
)
def t_logsinh_inv(t: Tables) -> DataFrame:
    """Covers exponents from far below zero to beyond the overflow of ``exp``."""
    value = log_sinh_inverse(F.col("y") * 2000 - 1000, F.col("b"), F.lit(0.5))
    return rounded(_transform_rows(t).select("gauge", "t", value.alias("value")), 6)


@query(
    "t_by_name",
    """
    SELECT gauge, t, method, round(CASE method
        WHEN 'log_sinh_transform' THEN ln(sinh(b * (y + 0.5))) / b
        WHEN 'boxcox_transform' THEN (power(y + 0.5, b) - 1) / b
        WHEN 'inverse_log_sinh_transform' THEN asinh(exp(b * y)) / b - 0.5
        ELSE power(y * b + 1, 1 / b) - 0.5 END, 3) AS value
    FROM (SELECT gauge, t, rain / 100 AS y, unnest(['log_sinh_transform', 'boxcox_transform',
                 'inverse_log_sinh_transform', 'inverse_boxcox_transform']) AS method FROM flow_monthly)
    JOIN models_all USING (gauge)""",
    "flow_monthly",
    "models_all",
)
def t_by_name(t: Tables) -> DataFrame:
    """All four transforms by name; the parameter is the second-last of the gauge's set."""
    rows = t.flow_monthly.select(
        "gauge",
        "t",
        (F.col("rain") / 100).alias("y"),
        F.explode(F.array(*[F.lit(n) for n in TRANSFORMS])).alias("method"),
    )
    joined = rows.join(transform_parameters(t.parameters, ["gauge"]), "gauge")
    value = transform_by_name(F.col("method"), F.col("y"), F.col("transform_parameter"), F.lit(0.5))
    return rounded(joined.select("gauge", "t", "method", value.alias("value")), 3)


def _monthly_rows(t: Tables) -> DataFrame:
    """Monthly series as one segment per gauge, with drought, CO2 and seasonal ratio columns."""
    return t.flow_monthly.select(
        "gauge",
        "t",
        (F.col("rain") / 100).alias("precipitation"),
        (F.col("t") % 5 == 0).alias("is_drought_year"),
        (F.lit(290.0) + F.col("t") / 4).alias("CO2"),
        ((F.col("t") % 12) / 12 - F.lit(0.5)).alias("seasonal_ratio"),
    )


_MONTHLY_SQL = """
    (SELECT gauge, t, rain / 100 AS precipitation, t % 5 = 0 AS is_drought_year, 290.0 + t / 4 AS "CO2",
            (t % 12) / 12 - 0.5 AS seasonal_ratio FROM flow_monthly)"""


@query(
    "m_auto",
    f"""
    , with_terms AS ({model_terms(_MONTHLY_SQL, "models_auto", "gauge", "t", "precipitation")}),
    scores AS ({model_scores("with_terms", "gauge")})
    SELECT gauge, t, round(transformed_streamflow, 6) AS transformed_streamflow FROM scores""",
    "flow_monthly",
    "models_auto",
)
def m_auto(t: Tables) -> DataFrame:
    """Autoregressive models over series of up to 83 months."""
    auto = [m for m in ALL_MODELS if m.has_auto]
    scored = score(_monthly_rows(t), bind_parameters(t.auto_parameters), ["gauge"], ["gauge"], "t", models=auto)
    return rounded(scored.select("gauge", "t", "transformed_streamflow"))


@query(
    "m_plain",
    f"""
    , with_terms AS ({model_terms(_MONTHLY_SQL, "models_plain", "gauge", "t", "precipitation")})
    SELECT gauge, t, round(c, 9) AS transformed_streamflow FROM with_terms""",
    "flow_monthly",
    "models_plain",
)
def m_plain(t: Tables) -> DataFrame:
    """The models without autoregression: a column of each row, no segment is gathered."""
    plain = [m for m in ALL_MODELS if not m.has_auto]
    scored = score(_monthly_rows(t), bind_parameters(t.plain_parameters), ["gauge"], ["gauge"], "t", models=plain)
    return rounded(scored.select("gauge", "t", "transformed_streamflow"), 9)


def yearly_segments(t: Tables) -> DataFrame:
    """Observed yearly rows of each contiguous stretch of flow."""
    return own_segments(t.obs_yearly, Series(("gauge",), ("year",)), "q_mm", 2).select(
        "gauge",
        "segment_id",
        "year",
        F.col("p_mm").alias("precipitation"),
        F.col("q_mm").alias("observed_streamflow"),
        F.col("drought").alias("is_drought_year"),
        "CO2",
        F.col(RATIO).alias("seasonal_ratio"),
    )


_SEGMENTS_SQL = """
    (SELECT o.gauge, o.year, r.start_index AS segment_id, o.p_mm AS precipitation, o.q_mm AS observed_streamflow,
            o.drought AS is_drought_year, o."CO2", o.standardised_warm_season_to_annual_rainfall_ratio AS seasonal_ratio
     FROM (SELECT *, row_number() OVER (PARTITION BY gauge ORDER BY year) AS position FROM obs_yearly) o
     JOIN obs_runs r ON r.gauge = o.gauge AND o.position BETWEEN r.start_index AND r.end_index)"""


def _score_sql(models: str, carbon: float = 1.0) -> str:
    terms = model_terms(_SEGMENTS_SQL, models, "gauge, segment_id", "year", "precipitation", carbon)
    return f"""
    , with_terms AS ({terms}),
    scores AS ({model_scores("with_terms", "gauge, segment_id")})
    SELECT gauge, segment_id, t AS year, round(transformed_streamflow, 6) AS transformed_streamflow FROM scores"""


@query("m_score", _score_sql("models_all"), "obs_yearly", "obs_runs", "models_all")
def m_score(t: Tables) -> DataFrame:
    """Each gauge scored by its own one of the 24 models, segment by segment."""
    scored = score(yearly_segments(t), bind_parameters(t.parameters), ["gauge"], ["gauge", "segment_id"])
    return rounded(scored.select("gauge", "segment_id", "year", "transformed_streamflow"))


@query("m_counterfactual", _score_sql("models_carbon", 0.0), "obs_yearly", "obs_runs", "models_carbon")
def m_counterfactual(t: Tables) -> DataFrame:
    """The carbon models with every carbon parameter set to zero."""
    bound = bind_parameters(without_carbon(t.carbon_parameters))
    scored = score(yearly_segments(t), bound, ["gauge"], ["gauge", "segment_id"])
    return rounded(scored.select("gauge", "segment_id", "year", "transformed_streamflow"))


@query(
    "m_param_sets",
    f"""
    , sets AS (SELECT * REPLACE (a1 * f AS a1), s AS param_set_id
               FROM models_all, (VALUES (1, 1.0::DOUBLE), (2, 1.5::DOUBLE), (3, 2.0::DOUBLE)) v(s, f)),
    with_terms AS ({model_terms(_SEGMENTS_SQL, "sets", "gauge, segment_id, param_set_id", "year", "precipitation")}),
    scores AS ({model_scores("with_terms", "gauge, segment_id, param_set_id")})
    SELECT gauge, segment_id, param_set_id, t AS year, round(transformed_streamflow, 6) AS transformed_streamflow
    FROM scores""",
    "obs_yearly",
    "obs_runs",
    "models_all",
)
def m_param_sets(t: Tables) -> DataFrame:
    """Three parameter sets per gauge, scored together from one copy of the rows."""
    factors = F.array(
        *[F.struct(F.lit(s).alias("param_set_id"), F.lit(f).alias("f")) for s, f in ((1, 1.0), (2, 1.5), (3, 2.0))]
    )
    changed = F.when(F.col("parameter") == "a1", F.col("parameter_value") * F.col("f")).otherwise(F.col("parameter_value"))
    sets = t.parameters.select("*", F.inline(factors)).withColumn("parameter_value", changed)
    bound = bind_parameters(sets, ["gauge", "param_set_id"])
    scored = score_sets(yearly_segments(t), bound, ["gauge"], ["param_set_id"], ["gauge", "segment_id"])
    return rounded(scored.select("gauge", "segment_id", "param_set_id", "year", "transformed_streamflow"))


@query(
    "m_registry",
    """
    SELECT 'streamflow_model_' || CASE WHEN has_drought THEN 'drought_' ELSE '' END
           || CASE co2_kind WHEN 0 THEN 'precip' WHEN 1 THEN 'intercept_shifted_CO2' ELSE 'slope_shifted_CO2' END
           || CASE WHEN has_ratio THEN '_seasonal_ratio' ELSE '' END || CASE WHEN has_auto THEN '_auto' ELSE '' END
           || CASE WHEN co2_kind = 0 AND NOT has_ratio AND NOT has_auto THEN '_only' ELSE '' END AS streamflow_model,
           has_drought, has_ratio, has_auto,
           CASE WHEN has_drought THEN 'a0_d a0_n' ELSE 'a0' END || ' a1' || CASE WHEN has_auto THEN ' a2' ELSE '' END
           || CASE co2_kind WHEN 0 THEN '' WHEN 1 THEN ' a3_intercept' ELSE ' a3_slope' END
           || CASE WHEN has_ratio THEN ' a4' ELSE '' END || CASE WHEN co2_kind > 0 THEN ' a5' ELSE '' END AS parameters,
           count(*) AS n_gauges
    FROM models_all GROUP BY ALL""",
    "models_all",
)
def m_registry(t: Tables) -> DataFrame:
    """Features and parameters of the models in use, with the number of gauges that use them."""
    used = t.parameters.select("gauge", "streamflow_model").distinct().groupBy("streamflow_model").agg(
        F.count(F.lit(1)).alias("n_gauges")
    )
    return used.join(F.broadcast(registry(t.spark)), "streamflow_model").select(
        "streamflow_model",
        "has_drought",
        "has_ratio",
        "has_auto",
        F.array_join("parameters", " ").alias("parameters"),
        "n_gauges",
    )
