"""Exact quantiles of large groups against ``percentile`` and numpy."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from freshet.operators.selection import exact_median, exact_quantiles

SHARES = {"p05": 0.05, "median": 0.5, "p90": 0.9, "most": 1.0}


def _rows(found, keys=("k",)):
    return {tuple(r[k] for k in keys): [r[n] for n in SHARES] for r in found.collect()}


def _by_percentile(df, keys=("k",)):
    return _rows(df.groupBy(*keys).agg(*[F.percentile("v", p).alias(n) for n, p in SHARES.items()]), keys)


def test_equal_to_percentile_for_a_group_of_a_third_of_the_rows(spark):
    draw = random.Random(5)
    rows = [("hot", draw.lognormvariate(0, 3)) for _ in range(9_000)]
    rows += [(f"k{i % 400}", draw.random()) for i in range(16_000)] + [("few", float(i % 3)) for i in range(3_000)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    assert _rows(exact_quantiles(df, ["k"], "v", SHARES, room=50)) == _by_percentile(df)


def test_repeated_values_nulls_and_infinities(spark):
    inf = float("inf")
    rows = [("same", 4.0)] * 500 + [("two", 1.0)] * 251 + [("two", 2.0)] * 250
    rows += [("ends", -inf)] * 200 + [("ends", inf)] * 200 + [("ends", float(i)) for i in range(200)]
    rows += [(None, float(i)) for i in range(300)] + [("gap", float(i)) for i in range(300)] + [("gap", None)] * 9
    rows += [("none", None)] * 3 + [("signs", -0.0)] * 100 + [("signs", 0.0)] * 101
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    assert _rows(exact_quantiles(df, ["k"], "v", SHARES, room=20)) == _by_percentile(df)
    strict = {r["k"]: r["m"] for r in exact_median(df, ["k"], "v", "m", room=20).collect()}
    assert strict["gap"] is None and strict["none"] is None and strict[None] == 149.5 and strict["two"] == 1.0


def test_nan_is_left_out_and_strict_gives_null(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)] + [(float("nan"),)], "v double")
    assert exact_quantiles(df, [], "v", {"m": 0.5}, room=10).collect()[0]["m"] == 49.5
    assert exact_median(df, [], "v", "m", room=10).collect()[0]["m"] is None


def test_no_rows_no_keys_and_clashing_names(spark):
    empty = spark.createDataFrame([], "k string, v double")
    assert exact_quantiles(empty, ["k"], "v", SHARES).count() == 0
    df = spark.range(1000).select(
        F.col("id").cast("double").alias("v"), F.lit(1).alias("__v"), F.lit("a").alias("__key"), F.lit(2).alias("__n")
    )
    assert [r["m"] for r in exact_quantiles(df, [], "v", {"m": 0.25}, room=7).collect()] == [249.75]
    assert exact_quantiles(df, ["__key", "__n"], "v", {"m": 0.5}, room=7).collect() == [("a", 2, 499.5)]


def test_shares_outside_zero_to_one_fail(spark):
    df = spark.createDataFrame([(1.0,)], "v double")
    for results in ({}, {"x": 1.5}, {"x": -0.1}):
        with pytest.raises(ValueError):
            exact_quantiles(df, [], "v", results)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=120), st.floats(0, 1))
def test_property_against_numpy(spark, values, share):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = exact_quantiles(df, [], "v", {"q": share}, room=5).collect()[0]["q"]
    assert np.isclose(found, np.quantile(values, share), rtol=1e-9, atol=1e-6)


def test_a_large_group_is_not_moved_by_its_key(spark, tmp_path):
    """No exchange of the large group's rows by key alone: what is shuffled is counts and the last interval."""
    spark.range(200_000).select(F.col("id").cast("double").alias("v"), F.lit("hot").alias("k")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    found = exact_quantiles(df, ["k"], "v", {"m": 0.5}, room=1_000)
    assert found.collect() == [("hot", 99_999.5)]
    assert "CartesianProduct" not in found._jdf.queryExecution().toString()
