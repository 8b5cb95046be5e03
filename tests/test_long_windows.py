"""Windows put together from two running aggregates, against sliding frames and plain Python."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from freshet.operators import long_windows
from freshet.operators.long_windows import rolling_any
from freshet.operators.series import Series, in_blocks

RESULTS = {"low": ("min", "v"), "high": ("max", "v"), "total": ("sum", "n"), "mean": ("mean", "v"), "wet": ("any", "b"), "dry": ("every", "b")}


def _series(spark, count=700):
    draw = random.Random(3)
    rows = [("hot", i, draw.gauss(0, 9), draw.randrange(50), draw.random() < 0.02) for i in range(count)]
    rows += [(f"k{i % 9}", i, draw.gauss(0, 9), draw.randrange(50), draw.random() < 0.5) for i in range(200)]
    rows += [("gaps", i, None if i % 40 == 7 else float(i), i, i % 3 == 0) for i in range(150)]
    rows += [("nan", i, float("nan") if i == 30 else float(i), i, None if i == 50 else True) for i in range(90)]
    return spark.createDataFrame(rows, "k string, at long, v double, n long, b boolean").repartition(5)


def _plain(rows, length):
    """Each row's results, from its own slice of the series."""
    found = {}
    for key in {r["k"] for r in rows}:
        own = sorted((r for r in rows if r["k"] == key), key=lambda r: r["at"])
        for i, r in enumerate(own):
            part = own[i - length + 1 : i + 1] if i >= length - 1 else []

            def of(column, f):
                values = [x[column] for x in part]
                return f(values) if values and not any(x is None or x != x for x in values) else None

            found[key, r["at"]] = [
                of("v", min), of("v", max), of("n", sum), of("v", lambda x: sum(x) / length), of("b", any), of("b", all)
            ]
    return found


@pytest.mark.parametrize("length", [1, 2, 7, 64, 400])
@pytest.mark.parametrize("blocked", [False, True])
def test_against_plain_python(spark, monkeypatch, length, blocked):
    monkeypatch.setattr(long_windows, "SPAN", 50)
    df, series = _series(spark), Series(("k",), ("at",))
    wanted = _plain(df.collect(), length)
    if blocked:
        df, series = in_blocks(df, series, block_rows=100)
    got = rolling_any(df, series, length, RESULTS).collect()
    assert len(got) == len(wanted)
    for r in got:
        for name, value in zip(RESULTS, wanted[r["k"], r["at"]]):
            assert r[name] == (pytest.approx(value, abs=1e-9) if isinstance(value, float) else value), (r, name)


def test_no_frame_as_long_as_the_window(spark):
    """Only running frames and one lag: the plan is the same for 20 and for 2,000 rows but for the numbers."""
    plans = []
    for length in (20, 2_000):
        found = rolling_any(_series(spark, 50), Series(("k",), ("at",)), length, {"low": ("min", "v")})
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert f"RowFrame, -{length - 1}, currentrow" not in plan
        plans.append((plan.count("Window ["), plan.count("specifiedwindowframe(RowFrame, unboundedpreceding")))
    assert plans[0] == plans[1]


def test_empty_clashing_names_and_wrong_requests(spark):
    series = Series(("k",), ("at",))
    assert rolling_any(_series(spark).limit(0), series, 5, RESULTS).count() == 0
    df = spark.range(6).select(F.lit("a").alias("k"), F.col("id").alias("at"), F.lit(2.0).alias("v"), F.lit(9).alias("low"))
    got = rolling_any(df, series, 3, {"low": ("min", "v")}).orderBy("at").collect()
    assert [r["low"] for r in got] == [None, None, 2.0, 2.0, 2.0, 2.0]
    with pytest.raises(ValueError):
        rolling_any(df, series, 0, {"x": ("min", "v")})
    with pytest.raises(ValueError):
        rolling_any(df, series, 3, {"x": ("median", "v")})


def test_equal_to_a_sliding_frame_over_a_written_table(spark, tmp_path):
    spark.range(6_000).select(
        (F.col("id") % 2).alias("k"), F.col("id").alias("at"), F.abs(F.xxhash64("id") % 1000).cast("double").alias("v")
    ).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    w = Window.partitionBy("k").orderBy("at").rowsBetween(-999, 0)
    slid = df.withColumn("low", F.when(F.count("v").over(w) == 1000, F.min("v").over(w)))
    own = rolling_any(df, Series(("k",), ("at",)), 1000, {"low": ("min", "v")})
    assert own.exceptAll(slid).count() == 0 and slid.exceptAll(own).count() == 0
