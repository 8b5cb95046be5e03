import random

import pytest
from pyspark.sql import functions as F

from freshet.operators import quality, summaries
from freshet.operators.reshape import name_positions, sum_to_wide, to_long, to_wide, with_rank
from freshet.plans import aridity, effects, flow, rain
from freshet.plans.drought import drought_flags

# Drought


def flags_by_hand(x):
    if len(x) < 2:
        return [None] * len(x)
    mean = sum(x) / len(x)
    a = [(v - mean) / mean for v in x]
    dry = [i >= 2 and (a[i] + a[i - 1] + a[i - 2]) / 3 < -0.05 for i in range(len(a))]
    flag, i = [False] * len(a), 0
    while i < len(a):
        j = i
        while j < len(a) and dry[j] == dry[i]:
            j += 1
        if dry[i] and j - i >= 7:
            end = j - 1
            flag[i:j] = [True] * (j - i)
            wet = [k for k in (end - 2, end - 1, end) if a[k] > 0.15]
            if wet:
                flag[wet[0] : end + 1] = [False] * (end + 1 - wet[0])
            elif all(0 < a[k] < 0.15 for k in (end - 1, end)):
                flag[end] = False
        i = j
    return flag


def drought(spark, series):
    rows = [(str(k), i, v) for k, x in enumerate(series) for i, v in enumerate(x)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "gauge string, year int, rain double").repartition(4)
    out = {}
    for r in sorted(drought_flags(df, ["gauge"], "year", "rain").collect(), key=lambda r: (r.gauge, r.year)):
        out.setdefault(r.gauge, []).append(r.drought)
    return [out[str(k)] for k in range(len(series))]


def test_drought_fixtures(spark):
    cases = [
        ([120.0] * 4 + [60.0] * 9 + [125.0] + [120.0] * 6, "FFFFFTTTTTTTTFFFFFFF"),
        ([130.0] * 5 + [70.0] * 9 + [104.0] * 2 + [130.0] * 5, "FFFFFFTTTTTTTTTFFFFFF"),
        ([120.0] * 4 + [80.0] * 8 + [95.0] * 2 + [120.0] * 6, "FFFFFTTTTTTTTTFFFFFF"),
    ]
    got = drought(spark, [c[0] for c in cases])
    assert ["".join("T" if v else "F" for v in g) for g in got] == [c[1] for c in cases]


def test_drought_against_the_written_out_rule(spark):
    rng, series = random.Random(11), []
    for _ in range(150):
        level, x = 100.0, []
        for _ in range(60):
            level = rng.choice([level, level, level, 70.0, 100.0, 130.0])
            x.append(max(1.0, rng.gauss(level, 22)))
        series.append(x)
    got = drought(spark, series)
    want = [flags_by_hand(x) for x in series]
    assert got == want and sum(map(sum, want)) > 500
    assert drought(spark, [[5.0]]) == [[None]]


# Rain


def test_evidence(spark):
    rows = [("a", True, 100.0), ("a", False, 110.0), ("b", True, 110.0), ("b", False, 100.0), ("c", True, 5.0)]
    rows += [("d", True, 5.0), ("d", False, 5.0)] + [("a", True, 100.0)]
    fits = spark.createDataFrame(rows, "gauge string, contains_CO2 boolean, AIC double")
    got = {r.gauge: r.evidence_ratio for r in rain.evidence_ratios(fits).collect()}
    assert got == {"a": pytest.approx(148.4131591), "b": pytest.approx(-148.4131591), "c": None, "d": None}
    assert [r.gauge for r in rain.gauges_with_evidence(fits, 100).collect()] == ["a"]


def test_tidy_from_wide_runs(spark):
    schema = "GCM string, ensemble_id string, experiment string, realisation string, date_range string, time_sum double, V1 double, V2 double"
    rows = [("m", "r1", "historical", "gn", "200401-200412", 45.0, 1e-5, None), ("m", "r1", "hist-nat", "gn", "200401-200412", 45.0, 2e-5, 1e-5)]
    keys = spark.createDataFrame([(1, "003303A"), (2, "102101A")], "position int, gauge string")
    got = rain.tidy_runs(spark.createDataFrame(rows, schema), keys)
    found = {r.gauge: (r.year, r.season, r.historical, r.hist_nat) for r in got.collect()}
    assert found["003303A"] == (2004, "warm_season", pytest.approx(25.056), pytest.approx(50.112))
    assert found["102101A"] == (2004, "warm_season", None, pytest.approx(25.056))


def test_a_year_split_over_files_gives_one_row(spark):
    rows = [("m", "e", "r", "g", 2000, m, "historical", 1.0) for m in (1, 2, 3, 10, 11, 12)]
    df = spark.createDataFrame(rows, "GCM string, ensemble_id string, realisation string, gauge string, y int, m int, experiment string, precipitation_mm double")
    dated = df.withColumn("date", F.make_date("y", "m", F.lit(1))).drop("y", "m").repartition(6)
    assert [r.historical for r in rain.seasonal_model_rain(dated).collect()] == [6.0]


def seasonal(spark, years=6):
    rows = [(y, "m", "e", "r", "g", s, 1.0, float(y % 3 + i)) for y in range(2000, 2000 + years) for i, s in enumerate(("warm_season", "cool_season"))]
    schema = "year int, GCM string, ensemble_id string, realisation string, gauge string, season string, historical double, hist_nat double"
    return spark.createDataFrame(rows, schema).repartition(3)


def test_smoothing_runs_over_interleaved_seasons(spark):
    rows = rain.smoothed_terms(rain.scale_terms(seasonal(spark)), {"smooth_scale_term": 4}).collect()
    ordered = sorted(rows, key=lambda r: (r.year, r.season == "cool_season"))
    terms = [r.naive_scale_term for r in ordered]
    want = [None] * 3 + [sum(terms[i - 3 : i + 1]) / 4 for i in range(3, len(terms))]
    assert [r.smooth_scale_term for r in ordered] == want


def test_first_year_with_one_season_stays_incomplete(spark):
    observed = seasonal(spark).select("year", "gauge", "season", F.lit(2.0).alias("season_obs_precipitation"))
    scaled = rain.scaled_rain(seasonal(spark), observed, 4)
    prepared = {r.year: r for r in rain.prepared_rain(scaled).collect()}
    assert sorted(prepared) == [2001, 2002, 2003, 2004, 2005]
    assert prepared[2001].warm_season is None and prepared[2001].annual_scaled_hist_nat_rainfall is None
    assert sum(r[rain.RATIO] for y, r in prepared.items() if y > 2001) == pytest.approx(0.0, abs=1e-12)


# Reshape


def test_wide_needs_unique_cells(spark):
    df = spark.createDataFrame([("g", "a", 1.0), ("g", "a", 2.0)], "gauge string, n string, v double")
    with pytest.raises(Exception, match="more than one value"):
        to_wide(df, ["gauge"], F.col("n"), {"a": "a", "b": "b"}, F.col("v")).collect()
    assert tuple(sum_to_wide(df, ["gauge"], F.col("n"), {"a": "a", "b": "b"}, F.col("v")).first()) == ("g", 3.0, None)


def test_long_keeps_missing_cells_and_names_positions(spark):
    df = spark.createDataFrame([(1, 5.0, None)], "t int, V1 double, V2 double")
    long = to_long(df, ["t"], None, "position", "v")
    keys = spark.createDataFrame([(1, "0a"), (2, "0b")], "position int, gauge string")
    assert set(map(tuple, name_positions(long, keys, "position", "gauge").collect())) == {(1, 5.0, "0a"), (1, None, "0b")}


def test_rank_of_labels(spark):
    df = spark.createDataFrame([(effects.HIST_NAT,), (effects.CO2_ON,), ("?",)], "type string")
    assert [r.rank for r in with_rank(df, "type", effects.SCENARIOS, "rank").collect()] == [3, 1, None]


# Flow


def yearly(spark):
    """Observed flow 1958-2016 with a gap, one model that fits, one that starts late, one short."""
    obs = [(y, "g", 10.0 + y % 5, None if y in (1970, 1971) else 3.0, False, 300.0, 0.1) for y in range(1958, 2017)]
    observed = spark.createDataFrame(obs, "year int, gauge string, p_mm double, q_mm double, drought boolean, CO2 double, %s double" % rain.RATIO)
    runs = {"fits": range(1950, 2015), "late": range(1960, 2015), "ends": range(1950, 2014)}
    rows = [(y, m, "e", "g", 1.0, 2.0, 3.0, 0.0) for m, years in runs.items() for y in years]
    rows += [(y, "short", "e", "g", 1.0, 2.0, 3.0, 0.0) for y in [1959, *range(1975, 2015)]]
    rows += [(y, "gappy", "e", "g", 1.0, 2.0, 3.0, 0.0) for y in [1959, *range(1963, 2015)]]
    schema = "year int, GCM string, ensemble_id string, gauge string, warm_season double, cool_season double, annual_scaled_hist_nat_rainfall double, %s double" % rain.RATIO
    return spark.createDataFrame(rows, schema), observed


def test_alignment_keeps_covering_series_only(spark):
    prepared, observed = yearly(spark)
    excluded = flow.excluded_years(spark, [(1980, "g")])
    aligned = flow.aligned_series(prepared, observed, excluded)
    years = {}
    for r in aligned.collect():
        years.setdefault(r.GCM, []).append(r.year)
    # 41 rows against 56 is short; 53 against 56 is a mismatch that stays.
    assert sorted(years) == ["fits", "gappy", "observed"]
    assert sorted(years["fits"]) == [y for y in range(1959, 2015) if y != 1980]
    assert sorted(years["observed"]) == sorted(years["fits"])


def test_alignment_agrees_with_the_separate_checks(spark):
    prepared, observed = yearly(spark)
    covered = quality.covered_series(prepared, observed)
    assert sorted(r.GCM for r in covered.collect()) == ["fits", "gappy", "short"]
    rows = prepared.where("year >= 1959").select("gauge", "GCM", "ensemble_id", "year")
    short_obs = flow.as_model_series(observed).where("year BETWEEN 1959 AND 2014").select("gauge", "GCM", "ensemble_id", "year")
    found = quality.row_mismatches(rows.unionByName(short_obs), F.col("GCM") == "observed").collect()
    assert [(r.GCM, r["count"], r.obs_count) for r in found] == [("short", 41, 56)]


def test_segments_go_by_position(spark):
    prepared, observed = yearly(spark)
    aligned = flow.aligned_series(prepared, observed, flow.excluded_years(spark))
    runs = flow.observed_runs(aligned, 2)
    assert sorted(tuple(r) for r in runs.collect()) == [("g", 1, 11, 11), ("g", 14, 56, 43)]
    segments = flow.segmented_series(aligned, runs)
    gappy = sorted((r.segment_id, r.year) for r in segments.where("GCM = 'gappy'").collect())
    # The series lacks 1960-1962, so its 12th and 13th rows are 1973 and 1974.
    assert [y for s, y in gappy if s == 1] == [1959, *range(1963, 1973)]
    assert [y for s, y in gappy if s == 14] == list(range(1975, 2015))


def test_missing_and_empty(spark):
    rows = spark.createDataFrame([("a", "m", y) for y in (1, 2, 3)], "gauge string, GCM string, year int")
    wanted = spark.createDataFrame([("a", "m"), ("b", "m")], "gauge string, GCM string")
    assert [tuple(r) for r in quality.missing_series(wanted, rows, ["gauge", "GCM"]).collect()] == [("b", "m")]
    runs = spark.createDataFrame([("a", 1, 3), ("a", 3, 9), ("a", 5, 9)], "gauge string, start_index int, end_index int")
    empty = quality.empty_segments(runs, rows, ["gauge"], ["gauge", "GCM"]).collect()
    assert [r.start_index for r in empty] == [5]


def test_schema_is_checked(spark):
    from freshet.sources.schemas import GAUGE_INFORMATION

    good = spark.createDataFrame([("01", 1.0, 2.0, "VIC")], GAUGE_INFORMATION)
    assert quality.require_schema(good, GAUGE_INFORMATION) is good
    with pytest.raises(TypeError, match="gauge: expected string, found int"):
        quality.require_schema(good.withColumn("gauge", F.col("gauge").cast("int")), GAUGE_INFORMATION)
    bad = good.unionByName(good.withColumn("gauge", F.lit(None).cast("string")))
    report = {r.column_name: r for r in quality.schema_report(bad, GAUGE_INFORMATION).collect()}
    assert not report["gauge"].ok and report["gauge"].n_missing == 1 and report["lat"].ok


# Effects


def test_relative_effects(spark):
    sums = spark.createDataFrame([("a", 10.0, 14.0, 0.0), ("b", 10.0, -10.0, 0.0)], "gauge string, sum_counterfactual_hist_nat double, sum_counterfactual_obs double, sum_CO2_obs double")
    got = {r.gauge: r for r in effects.decompose(sums).collect()}
    assert (got["a"].total_effect, got["a"].rainfall_effect) == (10.0, 4.0)
    assert got["a"].relative_rainfall_effect == pytest.approx(0.4)
    assert got["b"].rainfall_effect == 20.0 and got["b"].relative_rainfall_effect == pytest.approx(0.5)


@pytest.mark.parametrize("part, expected", [(4.0, -0.1), (20.0, 0.1)])
def test_signed_share(spark, part, expected):
    lit = lambda x: F.lit(x).cast("double")
    row = spark.range(1).select(effects.signed_share(lit(10.0), lit(part), lit(100.0)).alias("v")).first()
    assert row.v == pytest.approx(expected)


def test_ensembles_are_reduced_in_two_steps(spark):
    rows = [("g", "a", str(i), 2000, float(v)) for i, v in enumerate((1, 2, 9))]
    rows += [("g", "b", "0", 2000, 10.0), ("g", "c", "0", 2000, 30.0), ("g", "observed", "observed", 2000, 99.0)]
    df = spark.createDataFrame(rows, "gauge string, GCM string, ensemble_id string, year int, realspace_streamflow double")
    r = effects.envelope(df).first()
    assert (r[effects.FLOW], r.max_GCM_realspace_streamflow, r.min_GCM_realspace_streamflow) == (10.0, 30.0, 2.0)


# Aridity and summaries


@pytest.mark.parametrize(
    "x, expected", [(0.03, None), (0.05, "arid"), (0.2, "semi-arid"), (0.5, "semi-arid"), (1.0, "sub-humid"), (1.2, "wet")]
)
def test_aridity_classes(spark, x, expected):
    row = spark.range(1).select(aridity.aridity_class(F.lit(x).cast("double")).alias("c")).first()
    assert row.c == expected


def test_ecdf_counts_values_on_the_grid_point(spark):
    values = [0.0, 0.1, 0.25, 0.5, 0.5000001, 0.75, 2.0, -1.0, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [(r.x, r.y) for r in summaries.ecdf_on_grid(df, "v", 0.0, 1.0, 5).orderBy("x").collect()]
    present = [v for v in values if v is not None]
    assert got == [(x, sum(v <= x for v in present) / 8) for x in (0.0, 0.25, 0.5, 0.75, 1.0)]


def test_histogram(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 3, 10)], "v double")
    got = {r.bin: r.n for r in summaries.histogram(df, "v", 5).collect()}
    assert got == {1: 2, 2: 2, 5: 1}
    flat = spark.createDataFrame([(1.0,), (1.0,)], "v double")
    assert [(r.bin, r.n) for r in summaries.histogram(flat, "v", 5).collect()] == [(1, 2)]
