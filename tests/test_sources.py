import pytest

from freshet.sources.readers import csv_header, read_csv, read_csv_and_bad_rows, read_model_runs, read_parquet
from freshet.sources.schemas import GAUGE_INFORMATION, wide_daily
from freshet.sources.writers import write_named_csv, write_parquet


def test_csv_keeps_leading_zeros_and_missing_values(spark, tmp_path):
    (tmp_path / "g.csv").write_text("gauge,lat,lon,state\n003303,-1.5,NA,QLD\n102101A,NA,2,NA\n")
    path = str(tmp_path / "g.csv")
    assert csv_header(spark, path) == ["gauge", "lat", "lon", "state"]
    rows = sorted(tuple(r) for r in read_csv(spark, path, GAUGE_INFORMATION).collect())
    assert rows == [("003303", -1.5, None, "QLD"), ("102101A", None, 2.0, None)]


def test_csv_with_columns_in_another_order_fails(spark, tmp_path):
    (tmp_path / "g.csv").write_text("gauge,lon,lat,state\na,1,2,QLD\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path / "g.csv"), GAUGE_INFORMATION).collect()


def test_wide_daily_schema(spark, tmp_path):
    (tmp_path / "p.csv").write_text("year,month,day,001,002\n1990,1,2,0.5,NA\n")
    path = str(tmp_path / "p.csv")
    df = read_csv(spark, path, wide_daily(csv_header(spark, path)[3:]))
    assert tuple(df.first()) == (1990, 1, 2, 0.5, None)


def test_two_directories_of_runs_are_tagged_by_file_name(spark, tmp_path):
    for folder, experiment in (("one", "historical"), ("two", "hist-nat")):
        (tmp_path / folder).mkdir()
        for member in ("r1i1p1f1", "r2i1p1f1"):
            name = f"pr_Amon_CanESM5_{experiment}_{member}_gn_185001-201412.csv"
            (tmp_path / folder / name).write_text("time_sum,V1,V2\n0,1e-5,NA\n31,2e-5,3e-5\n")
    runs = read_model_runs(spark, [str(tmp_path / "one"), str(tmp_path / "two")], 2)
    assert runs.count() == 8
    tags = {tuple(r) for r in runs.select("GCM", "ensemble_id", "experiment", "realisation", "date_range").distinct().collect()}
    assert ("CanESM5", "r2i1p1f1", "hist-nat", "gn", "185001-201412") in tags and len(tags) == 4


def test_parquet_round_trip(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("01", 1.0, 2.0, "VIC"), ("02", 3.0, 4.0, "TAS")], GAUGE_INFORMATION)
    write_parquet(df, path, partition_by=["state"], sort_by=["gauge"])
    back = read_parquet(spark, path, GAUGE_INFORMATION)
    assert sorted(tuple(r) for r in back.select("gauge", "state").collect()) == [("01", "VIC"), ("02", "TAS")]
    with pytest.raises(TypeError):
        read_parquet(spark, path, wide_daily(["01"]))


def test_a_rerun_model_replaces_its_partition_only(spark, tmp_path):
    path = str(tmp_path / "flow")
    schema = "gauge string, GCM string, flow double"
    runs = {m: spark.createDataFrame([(f"g{i}", m, float(i)) for i in range(4)], schema) for m in ("A", "B", "C")}
    write_parquet(runs["A"].union(runs["B"]).union(runs["C"]), path, partition_by=["GCM"], sort_by=["gauge"])
    again = spark.createDataFrame([("g9", "B", 9.0)], schema)
    write_parquet(again, path, partition_by=["GCM"], only_present=True)
    got = {(r.GCM, r.gauge) for r in read_parquet(spark, path).collect()}
    assert got == {(m, f"g{i}") for m in "AC" for i in range(4)} | {("B", "g9")}
    write_parquet(again, path, partition_by=["GCM"])
    assert read_parquet(spark, path).count() == 1
    with pytest.raises(ValueError, match="only_present"):
        write_parquet(again, path, only_present=True)


def test_bad_rows_come_back_beside_the_good_ones(spark, tmp_path):
    lines = ["gauge,lat,lon,state", "01,1.5,2,VIC", "02,north,2,VIC", "03,1", "04,NA,NA,NA", "05,1,2,QLD,more"]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "b.csv").write_text("gauge,lat,lon,state\n06,1,x,TAS\n")
    good, bad = read_csv_and_bad_rows(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], GAUGE_INFORMATION)
    assert sorted(tuple(r) for r in good.collect()) == [("01", 1.5, 2.0, "VIC"), ("04", None, None, None)]
    want = [("a.csv", "02,north,2,VIC"), ("a.csv", "03,1"), ("a.csv", "05,1,2,QLD,more"), ("b.csv", "06,1,x,TAS")]
    assert sorted(tuple(r) for r in bad.collect()) == want
    # Whether a row is bad does not hang on the columns asked for.
    assert good.select("gauge").count() == 2 and good.count() == 2 and bad.select("file_name").count() == 4


def test_files_are_called_by_their_run(spark, tmp_path):
    names = [f"pr_Amon_M_{e}_r{i}_gn_199501-200112" for e in ("historical", "hist-nat") for i in range(3)]
    rows = [(n, float(d), None if d else 1.0) for n in names for d in range(40)]
    path = str(tmp_path / "runs")
    write_named_csv(spark.createDataFrame(rows, "run string, time_sum double, V1 double").repartition(5), path, "run")
    assert sorted(p.name for p in (tmp_path / "runs").glob("*.csv")) == sorted(f"{n}.csv" for n in names)
    got = read_model_runs(spark, [path], 1).groupBy("experiment", "ensemble_id").count().collect()
    assert len(got) == 6 and {r["count"] for r in got} == {40}
    with pytest.raises(Exception, match="without run"):
        write_named_csv(spark.createDataFrame([(None, 1.0)], "run string, V1 double"), str(tmp_path / "x"), "run")
