"""Every registered query against its SQL twin, on the smallest scale."""

import pytest

import __spark_entry__ as entry
from freshet.operators import series
from tests.compare import compare, connect
from workloads.registry import ORACLES, QUERIES
from workloads.standin import Tables
from workloads.summary import uncertain_rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(ORACLES) == set(QUERIES)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


# Plan nodes that pair all rows with all rows, or leave the JVM.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "InPandas", "InArrow")


@pytest.mark.parametrize("key", list(QUERIES))
def test_query_agrees_with_sql(spark, con, key):
    df = entry.queries()[key](spark, SF_DIR)
    assert compare(df, con, entry.oracle_sql()[key]) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [node for node in UNWANTED if node in plan] == []


RAW_SERIES = ["w_rolling", "w_row_number", "w_runs", "w_runs_min", "w_longest_run", "w_rle", "w_rle_decode", "w_diff"]


@pytest.mark.parametrize("key", RAW_SERIES)
def test_raw_series_are_windowed_by_block(spark, con, key, monkeypatch):
    """Where series are longer than a block, no window over the raw events is partitioned by the gauge alone."""
    monkeypatch.setattr(series, "BLOCK_ROWS", 4)
    df = entry.queries()[key](spark, SF_DIR)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    raw = [w for w in windows if "ts#" in w or "event_id#" in w]
    assert windows and all("__block#" in w or "__chunk#" in w for w in raw)
    assert "events.parquet" not in df._jdf.queryExecution().executedPlan().toString()
    assert compare(df, con, entry.oracle_sql()[key]) == []


PIVOTS = ["q_tidy", "r_pivot_flag", "r_pivot_experiment", "r_pivot_season", "r_pivot_type", "q_align", "q_prepare_rain"]


@pytest.mark.parametrize("key", PIVOTS)
def test_pivots_do_not_sort_their_rows(spark, key):
    plan = entry.queries()[key](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_rows_and_summaries_share_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(series, "BLOCK_ROWS", 4)
    df = entry.queries()["w_rle"](spark, SF_DIR)
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = entry.queries()["p_filter"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "lineitem" in line)
    assert "GreaterThanOrEqual(l_quantity" in scan and "In(l_returnflag" in scan
    assert "GreaterThanOrEqual(l_shipdate" in scan and "l_extendedprice" not in scan


def test_statistics_read_their_rows_once(spark):
    """One aggregate for both levels: the plan has as many scans as that of the rows alone."""
    plan = entry.queries()["a_mean_sd"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    rows = uncertain_rows(Tables(spark, SF_DIR))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= rows.count("Relation [") and "Expand" in plan


def test_wide_files_are_not_copied_per_column(spark):
    plan = entry.queries()["q_tidy_width"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "posexplode" in plan and "Expand" not in plan and "SortAggregate" not in plan
