import math
import random

import pytest
from pyspark.sql import functions as F

from freshet.operators import flow_models as M
from freshet.operators import transforms as T

ROW_SCHEMA = (
    "gauge string, segment int, year int, precipitation double, is_drought_year boolean, CO2 double, seasonal_ratio double"
)
VALUES = {
    "a0": 1.0,
    "a0_d": 1.0,
    "a0_n": 5.0,
    "a1": 1.0,
    "a2": 0.5,
    "a3_intercept": 2.0,
    "a3_slope": 2.0,
    "a4": 3.0,
    "a5": 300.0,
}


def parameters(spark, names, values=VALUES, gauge="g", extra=(("b", 0.02), ("sd", 1.0)), skip=()):
    by_name = {m.name: m for m in M.ALL_MODELS}
    rows = []
    for i, name in enumerate(names):
        listed = [(p, values[p]) for p in by_name[name].parameters if p not in skip] + list(extra)
        rows += [(f"{gauge}{i}", name, j, p, v) for j, (p, v) in enumerate(listed)]
    return spark.createDataFrame(
        rows, "gauge string, streamflow_model string, parameter_index int, parameter string, parameter_value double"
    )


def series(spark, count, rain, drought=None, co2=None, ratio=None, segment=None):
    n = len(rain)
    drought, co2 = drought or [False] * n, co2 or [310.0] * n
    ratio, segment = ratio or [0.0] * n, segment or [1] * n
    rows = [
        (f"g{g}", segment[i], 2000 + i, rain[i], drought[i], co2[i], ratio[i]) for g in range(count) for i in range(n)
    ]
    random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, ROW_SCHEMA).repartition(3)


def scores(spark, df, params):
    result = M.score(df, M.bind_parameters(params), ["gauge"], ["gauge", "segment"])
    out = {}
    for r in sorted(result.collect(), key=lambda r: (r.gauge, r.year)):
        out.setdefault(r.gauge, []).append(r.transformed_streamflow)
    return out


def by_hand(model, rain, drought, co2, ratio, segment):
    """The recursion written out, for one series."""
    v, out = VALUES, []
    for seg in sorted(set(segment)):
        at = [i for i, s in enumerate(segment) if s == seg]
        icpt = [(v["a0_d"] if drought[i] else v["a0_n"]) if model.has_drought else v["a0"] for i in at]
        base = [c + v["a1"] * rain[i] for c, i in zip(icpt, at)]
        mu = sum(base) / len(base)
        last = mu
        for b, i in zip(base, at):
            y, excess = b, max(0.0, co2[i] - v["a5"])
            if model.co2 == "intercept":
                y += v["a3_intercept"] * excess
            elif model.co2 == "slope":
                y += v["a3_slope"] * rain[i] * excess
            if model.has_ratio:
                y += v["a4"] * ratio[i]
            if model.has_auto:
                y += v["a2"] * (last - mu)
            last = y
            out.append(y)
    return out


def test_registry_has_24_models():
    names = [m.name for m in M.ALL_MODELS]
    assert len(names) == len(set(names)) == 24
    assert len(M.DROUGHT_MODELS) == len(M.NON_DROUGHT_MODELS) == 12
    by_name = {m.name: m.parameters for m in M.ALL_MODELS}
    assert by_name["streamflow_model_precip_only"] == ["a0", "a1"]
    assert by_name["streamflow_model_precip_seasonal_ratio_auto"] == ["a0", "a1", "a2", "a4"]
    assert by_name["streamflow_model_drought_precip_auto"] == ["a0_d", "a0_n", "a1", "a2"]
    assert by_name["streamflow_model_intercept_shifted_CO2"] == ["a0", "a1", "a3_intercept", "a5"]
    assert by_name["streamflow_model_drought_slope_shifted_CO2_seasonal_ratio_auto"] == [
        "a0_d", "a0_n", "a1", "a2", "a3_slope", "a4", "a5",
    ]


def test_every_model_against_the_written_out_recursion(spark):
    rng = random.Random(5)
    rain = [rng.uniform(1, 9) for _ in range(9)]
    drought = [rng.random() < 0.4 for _ in rain]
    co2 = [290.0 + 3 * i for i in range(9)]
    ratio = [rng.uniform(-0.5, 0.5) for _ in rain]
    segment = [1] * 4 + [2] * 5
    names = [m.name for m in M.ALL_MODELS]
    got = scores(spark, series(spark, 24, rain, drought, co2, ratio, segment), parameters(spark, names))
    for i, model in enumerate(M.ALL_MODELS):
        assert got[f"g{i}"] == pytest.approx(by_hand(model, rain, drought, co2, ratio, segment)), model.name


def test_a_segment_longer_than_a_block(spark):
    rng = random.Random(6)
    n = 3 * M.BLOCK + 5
    for rain in ([rng.uniform(1, 9) for _ in range(n)], [rng.uniform(1, 9) for _ in range(M.BLOCK)]):
        got = scores(spark, series(spark, 1, rain), parameters(spark, ["streamflow_model_precip_auto"]))
        model = next(m for m in M.ALL_MODELS if m.name == "streamflow_model_precip_auto")
        no = [0.0] * len(rain)
        assert got["g0"] == pytest.approx(by_hand(model, rain, no, [310.0] * len(rain), no, [1] * len(rain)))


@pytest.mark.parametrize("piece", [1, 7, 24, 1000])
def test_a_segment_in_pieces_equals_the_written_out_recursion(spark, piece):
    rng = random.Random(9)
    n = 8 * 24
    rain = [rng.uniform(1, 9) for _ in range(n)]
    drought = [rng.random() < 0.3 for _ in rain]
    co2 = [270.0 + i for i in range(n)]
    ratio = [rng.uniform(-0.5, 0.5) for _ in rain]
    segment = [1] * 100 + [2] * (n - 100)
    models = [m for m in M.ALL_MODELS if m.has_auto]
    bound = M.bind_parameters(parameters(spark, [m.name for m in models]))
    df = series(spark, len(models), rain, drought, co2, ratio, segment)
    for found in (
        M.score(df, bound, ["gauge"], ["gauge", "segment"], piece=piece, models=models),
        M.score(df, bound, ["gauge"], ["gauge", "segment"], piece=piece),
    ):
        got = {}
        for r in sorted(found.collect(), key=lambda r: (r.gauge, r.year)):
            got.setdefault(r.gauge, []).append(r.transformed_streamflow)
        for i, model in enumerate(models):
            assert got[f"g{i}"] == pytest.approx(by_hand(model, rain, drought, co2, ratio, segment), rel=1e-9), model.name


def test_a_missing_term_ends_the_pieces_after_it(spark):
    name = "streamflow_model_precip_seasonal_ratio_auto"
    df = series(spark, 1, [1.0] * 9, ratio=[0.0, 0.0, 0.0, 0.0, None, 0.0, 0.0, 0.0, 0.0])
    found = M.score(df, M.bind_parameters(parameters(spark, [name])), ["gauge"], ["gauge", "segment"], piece=2)
    got = [r.transformed_streamflow for r in sorted(found.collect(), key=lambda r: r.year)]
    assert all(x is not None for x in got[:4]) and got[4:] == [None] * 5


def test_plain_models_gather_no_segment(spark):
    names = [m.name for m in M.ALL_MODELS if not m.has_auto]
    plain = [m for m in M.ALL_MODELS if not m.has_auto]
    df = series(spark, 12, [1.0, 2.0, 3.0])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    found = M.score(df, M.bind_parameters(parameters(spark, names)), ["gauge"], ["gauge", "segment"], models=plain)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "collect_list(struct(year" not in plan and "segment#" in plan
    assert not [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "segment" in x]
    assert found.count() == 36
    with pytest.raises(Exception, match="not one of the models"):
        auto = parameters(spark, ["streamflow_model_precip_auto"])
        M.score(series(spark, 1, [1.0]), M.bind_parameters(auto), ["gauge"], ["gauge", "segment"], models=plain).collect()


def test_many_sets_are_scored_from_one_copy_of_the_rows(spark):
    rng = random.Random(2)
    names = [m.name for m in M.ALL_MODELS]
    df = series(spark, 24, [rng.uniform(1, 9) for _ in range(9)], segment=[1] * 4 + [2] * 5, ratio=[0.1 * i for i in range(9)])
    factors = F.explode(F.array(*[F.lit(float(f)) for f in range(1, 51)])).alias("set")
    sets = parameters(spark, names).select("*", factors)
    changed = F.when(F.col("parameter") == "a1", F.col("parameter_value") * F.col("set")).otherwise(F.col("parameter_value"))
    bound = M.bind_parameters(sets.withColumn("parameter_value", changed), ["gauge", "set"])
    one = M.score(df, bound, ["gauge"], ["gauge", "segment", "set"])
    many = M.score_sets(df, bound, ["gauge"], ["set"], ["gauge", "segment"], piece=2)
    key = lambda r: (r.gauge, r.segment, r.set, r.year)
    a, b = (sorted(((*key(r), r.transformed_streamflow) for r in x.collect())) for x in (one, many))
    assert len(a) == 24 * 9 * 50 and [x[:4] for x in a] == [x[:4] for x in b]
    assert [x[4] for x in b] == pytest.approx([x[4] for x in a], rel=1e-9)


def test_sets_of_an_unknown_key_are_an_error(spark):
    bound = M.bind_parameters(parameters(spark, ["streamflow_model_precip_only"]).withColumn("set", F.lit(1)), ["gauge", "set"])
    with pytest.raises(Exception, match="no parameters for g1"):
        M.score_sets(series(spark, 2, [1.0]), bound, ["gauge"], ["set"], ["gauge", "segment"]).collect()


def test_worked_values(spark):
    p = "streamflow_model_"
    auto = scores(spark, series(spark, 1, [1.0, 2.0, 3.0]), parameters(spark, [p + "precip_auto"]))
    assert auto["g0"] == [2.0, 2.5, 3.75]
    shifted = parameters(spark, [p + "intercept_shifted_CO2"])
    assert scores(spark, series(spark, 1, [1.0, 1.0], co2=[290.0, 310.0]), shifted)["g0"] == [2.0, 22.0]
    slope = parameters(spark, [p + "slope_shifted_CO2"])
    assert scores(spark, series(spark, 1, [3.0], co2=[310.0]), slope)["g0"] == [64.0]
    dry = parameters(spark, [p + "drought_precip_only"])
    assert scores(spark, series(spark, 1, [1.0, 1.0], drought=[True, False]), dry)["g0"] == [2.0, 6.0]


def test_no_memory_equals_the_plain_model(spark):
    rain = [3.0, 1.0, 4.0, 1.0, 5.0]
    plain = [m.name for m in M.ALL_MODELS if not m.has_auto]
    auto = [n.replace("_only", "") + "_auto" for n in plain]
    a = scores(spark, series(spark, 12, rain), parameters(spark, plain))
    b = scores(spark, series(spark, 12, rain), parameters(spark, auto, {**VALUES, "a2": 0.0}))
    assert a == b


def test_no_carbon_equals_the_rain_model(spark):
    rain = [3.0, 1.0, 4.0]
    p = "streamflow_model_"
    names = [p + "intercept_shifted_CO2_auto", p + "slope_shifted_CO2_auto"]
    off = M.without_carbon(parameters(spark, names))
    got = scores(spark, series(spark, 2, rain), off)
    rain_only = scores(spark, series(spark, 1, rain), parameters(spark, [p + "precip_auto"]))["g0"]
    assert got == {"g0": rain_only, "g1": rain_only}


def test_one_missing_rain_makes_an_autoregressive_segment_missing(spark):
    p = "streamflow_model_"
    df = series(spark, 2, [1.0, None, 3.0, 1.0, 2.0], segment=[1, 1, 1, 2, 2])
    got = scores(spark, df, parameters(spark, [p + "precip_auto", p + "precip_only"]))
    assert got["g0"] == [None, None, None, 2.0, 2.75]
    assert got["g1"] == [2.0, None, 4.0, 2.0, 3.0]


@pytest.mark.parametrize("skip, names, word", [(("a1",), ["streamflow_model_precip_only"], "no value of a1")])
def test_a_missing_parameter_fails(spark, skip, names, word):
    with pytest.raises(Exception, match=word):
        scores(spark, series(spark, 1, [1.0]), parameters(spark, names, skip=skip))


def test_a_repeated_parameter_fails(spark):
    params = parameters(spark, ["streamflow_model_precip_only"])
    with pytest.raises(Exception, match="more than one value for a1"):
        scores(spark, series(spark, 1, [1.0]), params.union(params.where("parameter = 'a1'")))


def test_an_unknown_model_fails(spark):
    params = parameters(spark, ["streamflow_model_precip_only"]).withColumn("streamflow_model", F.lit("other"))
    with pytest.raises(Exception, match="unknown model"):
        scores(spark, series(spark, 1, [1.0]), params)


def test_the_transform_parameter_is_the_second_last(spark):
    params = parameters(spark, ["streamflow_model_precip_only"], extra=(("anything", 0.07), ("last", 9.0)))
    assert T.transform_parameters(params, ["gauge"]).first()["transform_parameter"] == 0.07
    assert M.bind_parameters(params).first()["transform_parameter"] == 0.07


def num(x):
    return F.lit(x).cast("double")


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_transform_values(spark):
    assert value(spark, T.log_sinh_inverse(num(800.0), num(1.0), num(0.0))) == pytest.approx(800.6931472)
    assert value(spark, T.boxcox(num(3.0), num(-0.5), num(0.0))) == pytest.approx(math.log(3))
    assert value(spark, T.boxcox(num(3.0), num(1.49e-8), num(0.0))) == pytest.approx(math.log(3))
    assert value(spark, T.boxcox(num(3.0), num(0.5), num(1.0))) == pytest.approx(2.0)
    assert value(spark, T.boxcox(num(0.0), num(0.0), num(0.0))) == -math.inf
    assert value(spark, T.log_sinh(num(1000.0), num(2.0), num(0.0))) == pytest.approx(1000 - math.log(2) / 2)


@pytest.mark.parametrize("name", T.FORWARD_TRANSFORMS)
@pytest.mark.parametrize("parameter", [0.01, 0.2, 0.9])
def test_inverse_undoes_the_transform(spark, name, parameter):
    ys = [1e-8, 1e-3, 0.4, 7.0, 120.0, 3000.0]
    df = spark.createDataFrame([(y,) for y in ys], "y double")
    there = T.transform_by_name(F.lit(name), F.col("y"), num(parameter), num(0.25))
    back = T.transform_by_name(F.lit("inverse_" + name), F.col("z"), num(parameter), num(0.25))
    rows = df.withColumn("z", there).withColumn("back", back).collect()
    assert [r.back for r in rows] == [pytest.approx(y, rel=1e-7, abs=1e-7) for y in ys]
