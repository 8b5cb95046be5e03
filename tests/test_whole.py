"""From CSV files to effects, with the published periods, on data whose answer is known.

The counterfactual runs bring twice the rain of the historical ones, so the scale term is 2 and
the counterfactual rain is twice the observed rain.
"""

import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from freshet.functions.maths import SQRT_EPSILON
from freshet.operators.flow_models import bind_parameters, score
from freshet.operators.series import Series, own_segments
from freshet.operators.transforms import log_sinh_inverse
from freshet.plans import effects, flow, rain
from freshet.session import stored
from freshet.sources.readers import csv_header, read_csv, read_model_runs, read_parquet
from freshet.sources.schemas import MODEL_PARAMETERS, OBSERVED_YEARLY, wide_daily
from freshet.sources.writers import write_parquet

GAUGES = ("003303A", "102101A")
A0, A1, A3, A5, B = 0.5, 0.01, 0.02, 300.0, 0.05
MONTHS = [(y, m) for y in range(1940, 2015) for m in range(1, 13)]


def observed_rain(gauge, year, month):
    return 20.0 + (year * 7 + month * 3 + gauge) % 11


def yearly_rain(gauge, year):
    return sum(observed_rain(gauge, year, m) for m in range(1, 13))


def co2(year):
    return 290.0 + (year - 1959)


def real(z):
    return math.asinh(math.exp(B * z)) / B


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    root = tmp_path_factory.mktemp("whole")
    for experiment, factor in (("historical", 1.0), ("hist-nat", 2.0)):
        (root / experiment).mkdir()
        for gcm in ("ModelA", "ModelB"):
            lines = ["time_sum,V1,V2"]
            start = date(1940, 1, 1)
            for i, (y, m) in enumerate(MONTHS):
                offset = (date(y, m, 1) - start).days
                lines.append(f"{offset},{factor * (1 + i % 5) * 1e-5},{factor * (2 + i % 3) * 1e-5}")
            name = f"pr_Amon_{gcm}_{experiment}_r1i1p1f1_gn_194001-201412.csv"
            (root / experiment / name).write_text("\n".join(lines) + "\n")
    daily = ["year,month,day," + ",".join(GAUGES)]
    yearly = ["year,gauge,p_mm,q_mm,drought,CO2,standardised_warm_season_to_annual_rainfall_ratio"]
    for y in range(1955, 2017):
        for m in range(1, 13):
            daily.append(f"{y},{m},1," + ",".join(str(observed_rain(g, y, m)) for g in range(2)))
        for g, gauge in enumerate(GAUGES):
            q = "NA" if y == 1980 else "5.0"
            if y >= 1959:
                yearly.append(f"{y},{gauge},{yearly_rain(g, y)},{q},FALSE,{co2(y)},0.0")
    (root / "daily.csv").write_text("\n".join(daily) + "\n")
    (root / "yearly.csv").write_text("\n".join(yearly) + "\n")
    fits = ["gauge,streamflow_model,parameter,parameter_value,AIC,contains_CO2"]
    values = {"a0": A0, "a1": A1, "a3_intercept": A3, "a5": A5, "b": B, "sd": 1.0}
    for gauge in GAUGES:
        fits += [f"{gauge},streamflow_model_intercept_shifted_CO2,{p},{v},100,TRUE" for p, v in values.items()]
        fits += [f"{gauge},streamflow_model_precip_only,{p},{values[p]},120,FALSE" for p in ("a0", "a1", "b", "sd")]
    (root / "fits.csv").write_text("\n".join(fits) + "\n")
    return root


def test_files_to_effects(spark, files):
    at = lambda name: str(files / name)
    runs = read_model_runs(spark, [at("historical"), at("hist-nat")], 2)
    keys = spark.createDataFrame([(1, GAUGES[0]), (2, GAUGES[1])], "position int, gauge string")
    write_parquet(rain.tidy_runs(runs, keys), at("tidy"), partition_by=["GCM"], sort_by=["gauge"])

    fits = read_csv(spark, at("fits.csv"), MODEL_PARAMETERS)
    strong = rain.gauges_with_evidence(fits, 100)
    days = read_csv(spark, at("daily.csv"), wide_daily(csv_header(spark, at("daily.csv"))[3:]))
    daily = days.unpivot(["year", "month", "day"], list(GAUGES), "gauge", "precipitation_mm")
    tidy = read_parquet(spark, at("tidy")).join(strong, "gauge", "left_semi")
    scaled = rain.scaled_rain(tidy, rain.seasonal_observed_rain(daily))
    prepared = rain.prepared_rain(scaled)

    observed = flow.lift_zero_flow(read_csv(spark, at("yearly.csv"), OBSERVED_YEARLY))
    assert observed.agg(F.min("q_mm")).first()[0] == 5.0 + SQRT_EPSILON
    aligned = stored(flow.aligned_series(prepared, observed, flow.excluded_years(spark, [(1970, GAUGES[0])])), "aligned")
    rows = {(r.gauge, r.GCM, r.year): r for r in aligned.collect()}
    assert len(rows) == 3 * (56 + 55)
    for (gauge, gcm, year), r in rows.items():
        factor = 1 if gcm == "observed" else 2
        assert r.p_mm == pytest.approx(factor * yearly_rain(GAUGES.index(gauge), year))

    order = {p: i for i, p in enumerate(("a0", "a1", "a3_intercept", "a5", "b", "sd"))}
    index = F.create_map(*[c for p, i in order.items() for c in (F.lit(p), F.lit(i))])[F.col("parameter")]
    parameters = fits.where("contains_CO2").withColumn("parameter_index", index)
    runs_of = flow.observed_runs(aligned)
    assert sorted(tuple(r) for r in runs_of.collect()) == [
        (GAUGES[0], 1, 20, 20), (GAUGES[0], 22, 55, 34), (GAUGES[1], 1, 21, 21), (GAUGES[1], 23, 56, 34),
    ]
    regenerated = stored(flow.regenerated_flow(flow.segmented_series(aligned, runs_of), parameters), "regenerated")
    assert regenerated.columns == list(flow.OUTPUT_COLUMNS)
    flows = {(r.gauge, r.GCM, r.year): r.realspace_streamflow for r in regenerated.collect()}
    assert len(flows) == 3 * (55 + 54)
    for (gauge, gcm, year), value in flows.items():
        factor = 1 if gcm == "observed" else 2
        assert value == pytest.approx(real(A0 + A1 * factor * yearly_rain(GAUGES.index(gauge), year)))

    # Fitted flow of two models; only the best one counts.
    rows = own_segments(observed, Series(("gauge",), (F.col("year"),)), "q_mm", 2).select(
        "gauge", "segment_id", "year", F.col("p_mm").alias("precipitation"),
        F.col("drought").alias("is_drought_year"), "CO2", F.col(rain.RATIO).alias("seasonal_ratio"),
    )
    on = score(rows, bind_parameters(parameters), ["gauge"], ["gauge", "segment_id"])
    z = log_sinh_inverse(F.col("transformed_streamflow"), F.col("transform_parameter"), F.lit(0.0))
    best = fits.where("contains_CO2").select("gauge", "streamflow_model").distinct()
    fitted = on.select(
        "gauge", "year", z.alias("realspace_modelled_streamflow"),
        F.explode(F.array(F.lit("streamflow_model_intercept_shifted_CO2"), F.lit("other"))).alias("streamflow_model"),
    )
    table = effects.scenario_table(effects.stacked_scenarios(regenerated, fitted, best))
    info = spark.createDataFrame([(g, -30.0, 140.0, "VIC") for g in GAUGES], "gauge string, lat double, lon double, state string")
    by_decade = effects.with_uncertainty(regenerated, effects.decade_effects(table, info))
    found = {(r.gauge, r.decade): r for r in effects.total_percent(by_decade).collect()}
    assert set(found) == {(g, d) for g in GAUGES for d in (1, 2)}
    for (gauge, decade), r in found.items():
        g, years = GAUGES.index(gauge), range(1990, 2000) if decade == 1 else range(2005, 2015)
        hn = sum(real(A0 + A1 * 2 * yearly_rain(g, y)) for y in years)
        off = sum(real(A0 + A1 * yearly_rain(g, y)) for y in years)
        with_co2 = sum(real(A0 + A1 * yearly_rain(g, y) + A3 * max(0.0, co2(y) - A5)) for y in years)
        assert r.total_effect == pytest.approx(abs(hn - with_co2))
        assert r.rainfall_effect == pytest.approx(abs(hn - off))
        assert r.partitioning_effect == pytest.approx(abs(off - with_co2))
        # Both models are alike, so there is no spread between them.
        assert r.range_relative_rainfall_effect == pytest.approx(0.0)
        sign = 1 if abs(hn - with_co2) < abs(off - with_co2) else -1
        assert r.total_effect_CC_percent == pytest.approx(sign * abs(hn - with_co2) / hn)


def test_captions_of_panels(spark):
    gauges = [f"{100000 + i}" for i in range(81)]
    rows = [(2000, g, 1.0, t) for g in gauges for t in effects.SCENARIOS]
    stacked = spark.createDataFrame(rows, f"year int, gauge string, {effects.FLOW} double, type string")
    panels = effects.supplementary_panels(stacked, ("100003", "100010", "100020", "100030", "100080"))
    sizes = {r.split: r.n for r in panels.groupBy("split").agg(F.countDistinct("gauge").alias("n")).collect()}
    assert sizes == {**{i: 7 for i in range(1, 11)}, 11: 6}
    assert panels.where("split = 1 AND gauge = '100004'").count() == 3
