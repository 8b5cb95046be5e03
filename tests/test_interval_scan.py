"""Rows assigned to runs by a scan, against the join on written-out positions and plain Python."""

from __future__ import annotations

import random

import pytest
from pyspark.errors import PySparkException

from freshet.operators.interval_scan import assign_segments_by_scan
from freshet.operators.series import assign_segments

RUN = "k string, start_index int, end_index int"


def _runs(draw, key, most=400):
    found, at = [], 0
    while at < most:
        start = at + draw.randrange(1, 9)
        at = start + draw.choice([0, 1, 5, 120])
        found.append((key, start, at))
        at += 1
    return found


@pytest.mark.parametrize("width", [3, 50, 1 << 16])
def test_equal_to_the_join_on_positions(spark, width):
    draw = random.Random(width)
    runs = spark.createDataFrame([r for k in ("a", "b", "c") for r in _runs(draw, k)], RUN)
    rows = [(draw.choice("abcd"), draw.randrange(-3, 460), draw.choice("xyz"), i) for i in range(3_000)]
    df = spark.createDataFrame(rows + rows[:40], "k string, position int, model string, at int")
    wanted = assign_segments(df, runs, ["k"])
    got = assign_segments_by_scan(df, runs, ["k"], width=width)
    assert got.columns == wanted.columns and dict(got.dtypes) == dict(wanted.dtypes)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wanted.collect()))


def test_long_runs_move_no_more_rows(spark):
    """Runs of ten and of 60,000 positions: as many rows go through the one exchange."""
    df = spark.createDataFrame([("a", i * 7_000, i) for i in range(9)], "k string, position long, v int")
    for end in (9, 59_999):
        runs = spark.createDataFrame([("a", 0, end)], RUN)
        found = assign_segments_by_scan(df, runs, ["k"])
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
        assert found.count() == sum(i * 7_000 <= end for i in range(9))


def test_missing_keys_empty_and_backward_runs(spark):
    df = spark.createDataFrame([(None, 1, 1), ("a", None, 2), ("a", 4, 3), ("a", 4, 3)], "k string, position int, run int")
    runs = spark.createDataFrame([(None, 1, 9), ("a", 4, 4), ("a", 9, 8), ("a", 20, None)], RUN)
    assert assign_segments_by_scan(df, runs, ["k"]).collect() == [("a", 4, 3, 4)] * 2
    assert assign_segments_by_scan(df, runs.limit(0), ["k"]).count() == 0
    assert assign_segments_by_scan(df.limit(0), runs, ["k"]).count() == 0


def test_overlapping_runs_fail(spark):
    df = spark.createDataFrame([("a", 5)], "k string, position int")
    with pytest.raises(PySparkException, match="overlap"):
        assign_segments_by_scan(df, spark.createDataFrame([("a", 1, 6), ("a", 6, 9)], RUN), ["k"]).collect()
