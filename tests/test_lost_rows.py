"""Rows are kept or refused, never lost; summaries of non-finite values."""

from unittest.mock import MagicMock

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from freshet.functions.text import letter, lettered_list
from freshet.operators import flow_models, reshape, summaries, transforms
from freshet.session import shared_folder, use_folder_if_unset


def test_an_unlisted_label_is_refused_or_left_out(spark):
    df = spark.createDataFrame([("g", "a", 1.0), ("g", "z", 2.0)], "gauge string, label string, v double")
    for wide in (reshape.to_wide, reshape.sum_to_wide):
        with pytest.raises(PySparkException, match="not listed: z"):
            wide(df, ["gauge"], F.col("label"), {"a": "x"}, F.col("v")).collect()
        assert wide(df, ["gauge"], F.col("label"), {"a": "x"}, F.col("v"), others="drop").collect() == [("g", 1.0)]


def test_letters_go_on_behind_z(spark):
    got = spark.createDataFrame([(n,) for n in (0, 1, 26, 27, 52, 53, 702, 703, 18278)], "n int").select(letter(F.col("n"))).collect()
    assert [r[0] for r in got] == [None, "A", "Z", "AA", "AZ", "BA", "ZZ", "AAA", "ZZZ"]
    names = spark.range(1).select(lettered_list(F.array(*[F.lit(f"g{i}") for i in range(28)]))).first()[0]
    assert names.endswith("g26 (AA) and g27 (AB).")


def test_unknown_positions_and_transforms_are_errors(spark):
    df = spark.createDataFrame([("V1", 1.0), ("V9", 2.0)], "position string, v double")
    names = spark.createDataFrame([(1, "g1")], "position int, gauge string")
    with pytest.raises(PySparkException, match="V9"):
        reshape.name_positions(df, names, "position", "gauge").collect()
    with pytest.raises(PySparkException, match="unknown transform cube"):
        spark.range(1).select(transforms.transform_by_name(F.lit("cube"), F.lit(1.0), F.lit(1.0), F.lit(0.0))).collect()


def test_a_series_without_parameters_is_refused_or_kept(spark):
    kinds = "gauge string, has_auto boolean, a0 double, a0_d double, a0_n double, a1 double, a2 double, a3_intercept double, a3_slope double, a4 double, a5 double, co2_term string, has_drought boolean, has_ratio boolean, transform_parameter double"
    bound = spark.createDataFrame([("g1", False, 1.0, None, None, 2.0, None, None, None, None, None, None, False, False, 1.0)], kinds)
    rows = spark.createDataFrame(
        [("g1", 2000, 3.0, False, 300.0, 0.0), ("g2", 2000, 3.0, False, 300.0, 0.0)],
        "gauge string, year int, precipitation double, is_drought_year boolean, CO2 double, seasonal_ratio double",
    )
    with pytest.raises(PySparkException, match="no parameters for g2"):
        flow_models.score(rows, bound, ["gauge"], ["gauge"]).collect()
    kept = flow_models.score(rows, bound, ["gauge"], ["gauge"], missing="keep").collect()
    assert sorted((r["gauge"], r["transformed_streamflow"]) for r in kept) == [("g1", 7.0), ("g2", None)]


def test_summaries_of_values_that_are_not_finite(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(x,) for x in (0.5, 1.0, inf, -inf, nan, None)], "v double")
    got = [tuple(r) for r in summaries.ecdf_on_grid(df, "v", 0.0, 1.0, 3).orderBy("x").collect()]
    assert got == [(0.0, 0.25), (0.5, 0.5), (1.0, 0.75)]
    bins = summaries.histogram(df, "v", bins=2).orderBy("bin").collect()
    assert [(r["bin"], r["n"]) for r in bins] == [(1, 1), (2, 1)] and bins[0]["width"] == 0.25
    assert df.agg(summaries.share_above(F.col("v"), 0.7)).first()[0] is None
    assert df.filter("not isnan(v)").agg(summaries.share_above(F.col("v"), 0.7)).first()[0] == 50.0


def test_a_missing_folder_is_an_error():
    class Bare:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Bare)


@pytest.mark.parametrize(("master", "times"), [("local", 1), ("local[8]", 1), ("spark://host:7077", 0), ("yarn", 0)])
def test_a_cluster_gets_no_folder_of_one_machine(master, times):
    session = MagicMock()
    session.conf.get.return_value = None
    session.sparkContext.getCheckpointDir.return_value = None
    session.sparkContext.master = master
    use_folder_if_unset(session, "/tmp/here")
    assert session.sparkContext.setCheckpointDir.call_count == times
