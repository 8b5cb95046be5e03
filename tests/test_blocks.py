"""Series cut at sampled places: the same results as uncut ones, and no task with a whole long series."""

import random

import pytest
from pyspark.sql import functions as F

from freshet.operators import series as S

SCHEMA = "k string, j int, t long, u string, x double, s string"
KEYS, ORDER = ("k", "j"), ("t", "u")


def rows(seed=4):
    """A third of the rows in one series, ties in the first column of the order, missing values."""
    rng, out = random.Random(seed), []
    for k in range(14):
        t = 0
        for i in range(700 if k == 3 else rng.randint(1, 110)):
            t += rng.choice([0, 0, 1, 3, 50])
            x = None if rng.random() < 0.3 else float(rng.randint(0, 4))
            out.append((f"k{k}", k % 2, t, f"u{i:05d}", x, rng.choice(["a", "a", None])))
    rng.shuffle(out)
    return out


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(7).persist()


@pytest.fixture(params=[1, 10, 100, 100_000])
def cut(request, table):
    return S.in_blocks(table, S.Series(KEYS, ORDER), request.param)


def same(got, want):
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_results_do_not_depend_on_blocks(table, cut):
    whole = (table, S.Series(KEYS, ORDER))
    columns = ["k", "t", "u"]
    same(S.positions(*cut).select(*columns, "position"), S.positions(*whole).select(*columns, "position"))
    same(S.differences(*cut, "x", "d").select(*columns, "d"), S.differences(*whole, "x", "d").select(*columns, "d"))
    same(S.run_lengths(*cut, "s"), S.run_lengths(*whole, "s"))
    same(S.valid_runs(*cut, "x", 2), S.valid_runs(*whole, "x", 2))
    results = {"m": (F.avg, "x", 3), "top": (F.max, "x", 2)}
    same(S.rolling(*cut, results).select(*columns, "m", "top"), S.rolling(*whole, results).select(*columns, "m", "top"))


@pytest.mark.parametrize("block_rows", [10, 100])
def test_no_block_is_much_longer_than_asked(table, block_rows):
    found, series = S.in_blocks(table, S.Series(KEYS, ORDER), block_rows)
    sizes = found.groupBy("k", "j", series.block).agg(F.count("*").alias("n"), F.min(F.struct(*ORDER)).alias("a"), F.max(F.struct(*ORDER)).alias("b"))
    assert sizes.agg(F.max("n")).first()[0] <= 3 * block_rows
    hot = sizes.where("k = 'k3'").orderBy(series.block).collect()
    assert len(hot) >= 700 // (3 * block_rows) and all(x.b < y.a for x, y in zip(hot, hot[1:]))
    assert [c for c in found.columns if c != series.block] == table.columns


def test_one_order_for_all_rows_stays_one_block(spark):
    df = spark.createDataFrame([("k", 0, 1, "u", 1.0, "a")] * 90, SCHEMA)
    found, series = S.in_blocks(df, S.Series(KEYS, ORDER), 10)
    assert found.select(series.block).distinct().count() == 1 and S.positions(found, series).count() == 90


def test_empty_and_short_tables_have_no_blocks(table):
    for df in (table.limit(0), table.limit(5)):
        found, series = S.in_blocks(df, S.Series(KEYS, ORDER))
        assert series.block is None and found.count() == df.count()


def test_a_clashing_column_is_an_error(table):
    with pytest.raises(ValueError, match="__block"):
        S.in_blocks(table.withColumn("__block", F.lit(1)), S.Series(KEYS, ORDER))


@pytest.mark.parametrize("block_rows", [5, 500])
def test_missing_keys_are_an_error(spark, block_rows):
    df = spark.createDataFrame([(None, 0, i, "u", 1.0, "a") for i in range(50)], SCHEMA)
    with pytest.raises(Exception, match="must not be missing"):
        S.positions(*S.in_blocks(df, S.Series(KEYS, ORDER), block_rows)).collect()
