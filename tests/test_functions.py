import datetime
import math

import pytest
from pyspark.sql import functions as F

from freshet.functions import calendar, maths, nulls, text


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def num(x):
    return F.lit(x).cast("double")


@pytest.mark.parametrize("x, expected", [(0.02, 0.01), (-350.0, -100.0), (0.0, 0.0), (1000.0, 1000.0)])
def test_order_of_magnitude(spark, x, expected):
    assert one(spark, maths.order_of_magnitude(num(x))) == pytest.approx(expected)


@pytest.mark.parametrize(
    "how, x, expected", [(F.bround, 2.5, 2.0), (F.bround, 3.5, 4.0), (F.floor, 2.9, 2.0), (F.ceil, 2.1, 3.0)]
)
def test_round_any(spark, how, x, expected):
    assert one(spark, maths.round_any(num(x), 1.0, how)) == expected
    assert one(spark, maths.round_any(num(x * 10), 10.0, how)) == expected * 10


@pytest.mark.parametrize(
    "n, d, expected", [(1.0, 0.0, math.inf), (-1.0, 0.0, -math.inf), (6.0, 3.0, 2.0), (None, 0.0, None), (1.0, None, None)]
)
def test_ratio(spark, n, d, expected):
    assert one(spark, nulls.ratio(num(n), num(d))) == expected


def test_zero_over_zero_is_nan_and_becomes_missing(spark):
    assert math.isnan(one(spark, nulls.ratio(num(0.0), num(0.0))))
    assert one(spark, nulls.nan_to_null(nulls.ratio(num(0.0), num(0.0)))) is None


@pytest.mark.parametrize("x", [1e-20, 1e-9, -1e-9, 0.5, -3.0, 1e6])
def test_asinh_keeps_precision(spark, x):
    assert one(spark, maths.asinh_stable(num(x))) == pytest.approx(math.asinh(x), rel=1e-14)


def test_log_real(spark):
    assert one(spark, maths.log_real(num(0.0))) == -math.inf
    assert math.isnan(one(spark, maths.log_real(num(-1.0))))
    assert one(spark, maths.log_real(num(math.e))) == pytest.approx(1.0)


def test_clamp_keeps_null(spark):
    assert one(spark, maths.clamp_below_zero(num(None))) is None
    assert one(spark, maths.clamp_below_zero(num(-2.0))) == 0.0
    assert one(spark, maths.clamp_below_zero(num(2.0))) == 2.0


def test_strict_aggregates(spark):
    df = spark.createDataFrame([(1, 1.0), (1, None), (2, 1.0), (2, 4.0)], "k int, x double")
    rows = df.groupBy("k").agg(
        nulls.strict_sum(F.col("x")).alias("s"),
        nulls.strict_median(F.col("x")).alias("m"),
        nulls.strict_sum_where(F.col("x") > 100, F.col("x")).alias("w"),
    )
    assert {r["k"]: (r["s"], r["m"], r["w"]) for r in rows.collect()} == {1: (None, None, None), 2: (5.0, 2.5, None)}


def test_percentile_and_iqr(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (8.0,)], "x double")
    row = df.agg(F.percentile("x", F.lit(0.9)).alias("p"), nulls.iqr(F.col("x")).alias("q"), F.median("x").alias("m")).first()
    assert (row["p"], row["q"], row["m"]) == (pytest.approx(6.8), pytest.approx(3.25), pytest.approx(3.0))
    with_gap = df.union(spark.createDataFrame([(None,)], "x double"))
    assert with_gap.agg(nulls.iqr(F.col("x")).alias("q")).first()["q"] is None


def test_seasons(spark):
    rows = spark.range(1, 13).select(calendar.season_of(F.col("id")).alias("s")).collect()
    assert [r["s"] for r in rows] == ["warm_season"] * 3 + ["cool_season"] * 6 + ["warm_season"] * 3


def test_dates_and_units(spark):
    date = F.lit(datetime.date(2004, 2, 15))
    assert one(spark, calendar.mm_per_month(num(1e-5), date)) == pytest.approx(25.056)
    origin = calendar.range_origin(F.lit("185001-201412"))
    assert one(spark, calendar.offset_date(origin, num(31.0))) == datetime.date(1850, 2, 1)
    assert one(spark, calendar.range_origin(F.lit("201412-185001"))) == datetime.date(1850, 1, 1)


def test_decades(spark):
    rows = spark.createDataFrame([(1989,), (1990,), (1999,), (2004,), (2005,), (2014,), (2015,)], "y int")
    tags = [r["d"] for r in rows.select(calendar.decade_of(F.col("y")).alias("d")).collect()]
    assert tags == [None, 1, 1, None, 2, 2, None]


def test_run_fields_use_the_text_before_the_first_dot(spark):
    name = F.lit("pr_Amon_CanESM5_hist-nat_r1i1p1f1_gn_185001-202012.v2.csv")
    values = [one(spark, c) for c in text.run_fields(name).values()]
    assert values == ["pr", "Amon", "CanESM5", "hist-nat", "r1i1p1f1", "gn", "185001-202012"]


@pytest.mark.parametrize(
    "labels, expected",
    [
        (["g1"], "g1 (A)."),
        (["g1", "g2"], "g1 (A) and g2 (B)."),
        (["g1", "g2", "g3"], "g1 (A), g2 (B) and g3 (C)."),
        (
            ["204036", "208004", "208005", "210017", "210022", "215002", "216002"],
            "204036 (A), 208004 (B), 208005 (C), 210017 (D), 210022 (E), 215002 (F) and 216002 (G).",
        ),
    ],
)
def test_lettered_list(spark, labels, expected):
    assert one(spark, text.lettered_list(F.array(*[F.lit(x) for x in labels]))) == expected


def test_state_codes(spark):
    assert one(spark, text.state_code(F.lit("Tasmania"))) == "TAS"
    assert one(spark, text.state_code(F.lit("Other Territories"))) is None


def test_compact_today(spark):
    assert len(one(spark, calendar.compact_today())) == 8


def test_labels(spark):
    assert one(spark, maths.label_height(num(3.0), num(-200.0))) == -10.0
    assert one(spark, maths.label_height(num(3.0), num(1.0))) == -1.0
    assert one(spark, maths.label_height(num(50.0), num(1.0))) == 50.0
    assert one(spark, maths.label_offset(num(-10.0), 0.1)) == pytest.approx(-9.0)
