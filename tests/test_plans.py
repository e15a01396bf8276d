"""Collection runs, files and streams end to end on small landed data."""

from __future__ import annotations

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gaugeloom.operators import periods
from gaugeloom.operators.gaps import MODEL_BLOCK_MINUTES
from gaugeloom.plans import harvests as H
from gaugeloom.plans import windows as W
from gaugeloom.plans.series import harvest_series, ordered_series
from gaugeloom.session import scratch, stage
from gaugeloom.sinks.files import write_landed, write_model_runs, write_series, write_xml
from gaugeloom.sources import gauge, lists, model, tide
from gaugeloom.sources.registry import SourceRegistry, standard_sources
from gaugeloom.streaming.series import append_to, merge_stream, merged, stream_resample
from helpers import at, by_key, obs_frame
from test_runs import NODES, SERIES, START, URL, asked

DAY = ("2021-09-01 00:00:00", "2021-09-02 00:00:00")


def land_text(path, name, text):
    from pathlib import Path

    folder = Path(path)
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


@pytest.fixture()
def tides(spark):
    path = scratch(spark, "tide")
    obs_frame(spark, [("A", 0, 1.0), ("A", 6, None), ("A", 12, 3.0), ("A", 24, 5.0), ("B", 20, 7.0), ("Z", 0, 1.0)]).select(
        "station", F.col("time").alias("date_time"), F.col("value").alias("water_level"),
        (F.col("value") * 10).alias("predicted_wl"), "seq").write.json(path)
    meta = scratch(spark, "meta")
    spark.createDataFrame([("A", "1.0", "", "Bay", "NC"), ("Z", "1", "1", "z", "")],
                          "station string, lat string, lng string, name string, state string").write.json(meta)
    return path, meta


def test_tide_run(spark, tides):
    run = H.tide_harvest(
        tide.read_tide_obs(spark, tides[0]), tide.read_tide_meta(spark, tides[1]),
        asked(spark, "B", "A", "C"), *DAY)
    assert by_key(run.data) == {
        ("A", at(0)): 1.0, ("A", at(15)): 5.0, ("B", at(0)): -99999.0, ("B", at(15)): 7.0}
    meta = run.meta.collect()
    assert [(m["STATION"], m["LON"], m["OWNER"]) for m in meta] == [("A", None, "NOAA/NOS")]
    assert {r["station"] for r in run.excluded.collect()} == {"B", "C"}
    data, metafile = run.write(scratch(spark, "out"))
    assert data.endswith("noaa_stationdata_2021-09-02T00:00:00")
    assert metafile.endswith("noaa_stationdata_meta_2021-09-02T00:00:00")
    head = "TIME,STATION,WATER_LEVEL"
    files = sorted(Path(data).glob("part-*.csv"))  # read in order they are the file
    lines = [line for f in files for line in f.read_text().splitlines() if line != head]
    assert all(f.read_text().startswith(head) for f in files if f.read_text())
    assert lines == ["2021-09-01T00:00:00,B,-99999.0", "2021-09-01T00:15:00,B,7.0",
                         "2021-09-01T00:00:00,A,1.0", "2021-09-01T00:15:00,A,5.0"]


def test_other_tide_products(spark, tides):
    run = H.tide_harvest(tide.read_tide_obs(spark, tides[0], "predictions"),
                         tide.read_tide_meta(spark, tides[1]), asked(spark, "A"), *DAY, "predictions", 60)
    assert by_key(run.data) == {("A", at(0)): 10.0}
    with pytest.raises(ValueError):
        H.tide_harvest(run.data, run.meta, run.requested, *DAY, "wind")


def test_registry_of_sources(spark, tides):
    registry = SourceRegistry()
    registry.register("tide", tide.read_tide_obs, tide.read_tide_meta)
    assert by_key(registry.series(spark, "Tide", tides[0], product="water_level", minutes=0))["A", at(6)] == 2.0
    assert registry.metadata(spark, "TIDE", tides[1]).count() == 2
    with pytest.raises(ValueError):
        registry.observations(spark, "moon", tides[0])


def test_standard_sources(spark, tides):
    found = standard_sources()
    assert found.names() == ["NOAA", "CONTRAILS", "ASGS"]
    assert by_key(found.series(spark, "noaa", tides[0], product="water_level", minutes=0))["A", at(6)] == 2.0
    root = scratch(spark, "gauge")
    land_text(f"{root}/obs/class=20/station=S", "a.xml", gauge_xml([("2022-01-15 22:45:00", "10")]))
    land_text(f"{root}/obs/class=94/station=S", "a.xml", gauge_xml([("2022-01-15 22:45:00", "9")]))
    land_text(f"{root}/sensors", "s.xml", "<general><row><site_id>S</site_id><or_site_id>7</or_site_id>"
              "<sensor_class>20</sensor_class><or_sensor_id>1</or_sensor_id><location>Creek</location></row></general>")
    land_text(f"{root}/sites", "s.xml", "<general><row><or_site_id>7</or_site_id><latitude_dec>35.1</latitude_dec>"
              "<longitude_dec>-78</longitude_dec><location>x</location></row></general>")
    rows = found.observations(spark, "Contrails", f"{root}/obs").collect()
    assert [r["value"] for r in rows] == [pytest.approx(3.048)]
    meta = found.metadata(spark, "Contrails", root).collect()
    assert [(r["STATION"], r["LAT"], r["NAME"]) for r in meta] == [("S", 35.1, "Creek")]


def test_back_from():
    assert H.back_from("2022-01-16 00:00:00", -2) == (datetime(2022, 1, 14), datetime(2022, 1, 16))
    assert H.back_from(datetime(2022, 1, 14), 2) == (datetime(2022, 1, 14), datetime(2022, 1, 16))


def gauge_xml(rows):
    body = "".join(f"<row><data_time>{t}</data_time><data_value>{v}</data_value></row>" for t, v in rows)
    return f"<onerain><response><general>{body}</general></response></onerain>"


def test_gauge_run(spark):
    root = scratch(spark, "gauge")
    level = [(f"2022-01-15 {t}:00", "1.11") for t in ("22:45", "23:00", "23:15")] + [("2022-01-15 23:30:00", "")]
    land_text(f"{root}/class=20/station=30033", "a.xml", gauge_xml(level))
    land_text(f"{root}/class=94/station=30033", "a.xml", gauge_xml([("2022-01-15 22:45:00", "9")]))
    land_text(f"{root}/class=20/station=35370047744601", "a.xml", gauge_xml([("2022-01-15 22:50:00", "10")]))
    sensors, sites = scratch(spark, "sensors"), scratch(spark, "sites")
    land_text(sensors, "s.xml", "<general><row><site_id>30033</site_id><or_site_id>7</or_site_id>"
              "<sensor_class>20</sensor_class><or_sensor_id>1</or_sensor_id><location>Creek</location></row></general>")
    land_text(sites, "s.xml", "<general><row><or_site_id>7</or_site_id><latitude_dec>35.1</latitude_dec>"
              "<longitude_dec></longitude_dec><location>Creek</location></row></general>")
    run = H.gauge_harvest(
        gauge.read_gauge_obs(spark, root, "river_water_level"), gauge.read_gauge_sensor_meta(spark, sensors),
        gauge.read_gauge_site_meta(spark, sites), asked(spark, "30033", "35370047744601"),
        "2022-01-14 00:00:00", "2022-01-16 00:00:00")
    got = by_key(run.data)
    quarter = datetime(2022, 1, 15, 22, 45)
    times = [quarter + timedelta(minutes=15 * i) for i in range(4)]
    assert [round(got["30033", t], 6) for t in times] == [0.338328] * 3 + [-99999.0]
    assert round(got["35370047744601", quarter], 6) == 3.048 and len(got) == 8
    meta = run.meta.collect()[0]
    assert run.tag().startswith("RIVERS_20")
    assert (meta["STATION"], meta["LAT"], meta["LON"], meta["NAME"], meta["OWNER"]) == (
        "30033", 35.1, None, "Creek", "NCEM")


def model_tables(spark, *ensembles, last=2, token="2022011600"):
    urls = [URL.format(token, e) for e in ensembles]
    runs = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "position int, url string")
    nodes = spark.createDataFrame(
        [(u, i, 10.0 + i, 30.0, f"  {n} name", "model") for u in urls for i, n in enumerate("CA")], NODES)
    series = spark.createDataFrame(
        [(u, n, START + timedelta(hours=h), -99999.0 if h == 1 else h + 10.0 * n + 100 * k)
         for k, u in enumerate(urls) for n in (0, 1) for h in range(-1, last + 1)], SERIES)
    return runs, nodes, series


def test_model_run_by_station_name(spark):
    runs, nodes, series = model_tables(spark, "namforecast", "again")
    more = runs.unionByName(spark.createDataFrame([(9, "http://gone/a/b/2022011600/hsofs/m/i/e/f")], "position int, url string"))
    run = H.model_harvest(more, nodes, series, asked(spark, "A", "X", "C"))
    got = by_key(run.data)
    assert [got["A", START + timedelta(hours=h)] for h in (-1, 0, 1, 2)] == [9.0, 10.0, 11.0, 12.0]
    assert len(got) == 8
    assert {r["station"] for r in run.unmatched.collect()} == {"X"}
    assert {r["NAME"] for r in run.meta.collect()} == {"HSOFS_NAMFORECAST"}
    assert {(r["STATION"], r["LON"], r["OWNER"]) for r in run.meta.collect()} == {("A", 11.0, "model"), ("C", 10.0, "model")}
    assert {r["cast"] for r in run.casts.collect()} == {"FORECAST"}
    assert tuple(run.counts.first()) == (2, 1, 2, 1)
    assert run.tag() == "namforecast_HSOFS_2022-01-16T00:00:00"


def test_model_run_by_node_table(spark):
    runs, nodes, series = model_tables(spark, "nowcast", last=0)
    curated = spark.createDataFrame([(1, "S1", 1), (2, "S2", 99)], "serial_nr int, stationid string, Node int")
    run = H.model_harvest(runs, nodes, series, station_nodes=curated)
    assert set(by_key(run.data)) == {("S1", START + timedelta(hours=h)) for h in (-1, 0)}
    assert [r["station"] for r in run.unmatched.collect()] == ["S2"]
    assert [r["reason"] for r in run.excluded.collect()] == ["no data"]


def test_mixed_batch_fails(spark):
    runs, nodes, series = model_tables(spark, "a", last=2)
    runs2, nodes2, series2 = model_tables(spark, "b", last=0)
    both = H.model_harvest(
        runs.unionByName(runs2.withColumn("position", F.lit(1))), nodes.unionByName(nodes2),
        series.unionByName(series2), asked(spark, "A"))
    with pytest.raises(Exception, match="mixed casts"):
        both.data.collect()


def test_pair_with_a_missing_nowcast(spark):
    runs, nodes, series = model_tables(spark, "nhcOfcl", token="06")
    pair = H.forecast_nowcast_pair(runs, nodes, series, asked(spark, "A"))
    status = {r["kind"]: r["failed"] for r in pair.status.collect()}
    assert status == {"forecast": False, "nowcast": True}
    assert pair.forecast.data.count() == 4 and pair.nowcast.data.count() == 0


def test_unknown_stations_give_an_empty_run(spark):
    runs, nodes, series = model_tables(spark, "nhcOfcl", token="4")
    assert H.model_harvest(runs, nodes, series, asked(spark, "Q")).data.count() == 0


def test_backfill_keeps_the_earlier_window(spark, tides):
    obs, meta = tide.read_tide_obs(spark, tides[0]), tide.read_tide_meta(spark, tides[1])
    windows = [("2021-09-01 00:00:00", "2021-09-01 00:20:00"), ("2021-09-01 00:10:00", "2021-09-01 01:00:00")]
    got = by_key(W.backfill(windows, lambda a, b: H.tide_harvest(obs, meta, asked(spark, "A", "B"), a, b)))
    assert got == {("A", at(0)): 1.0, ("A", at(15)): 5.0, ("B", at(0)): -99999.0, ("B", at(15)): 7.0}


def landed_days(spark):
    rows = [(s, 60 * h, float(h)) for s in "AB" for h in range(0, 24 * 6)]
    frame = obs_frame(spark, rows)
    tides = frame.select("station", F.col("time").alias("date_time"), F.col("value").alias("water_level"), "seq")
    gauges = frame.select(
        F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("data_time"), F.col("value").alias("data_value"), "seq", "station", F.lit(20).alias("class"))
    return (
        write_landed(tides, scratch(spark, "tide")),
        write_landed(gauges, scratch(spark, "gauge"), "xml", "data_time", ("class", "station"), rootTag="general", rowTag="row"),
    )


def test_only_the_days_of_the_range_are_opened(spark):
    tide_path, gauge_path = landed_days(spark)
    start, end = "2021-09-02 06:00:00", "2021-09-03 05:00:00"
    none = spark.createDataFrame([], "site_id string, or_site_id string, sensor_class string, or_sensor_id string, location string")
    sites = spark.createDataFrame([], "or_site_id string, latitude_dec string, longitude_dec string, location string")
    runs = (
        H.tide_harvest(tide.read_tide_obs(spark, tide_path), spark.createDataFrame([], "STATION string"), asked(spark, "A", "B"), start, end),
        H.gauge_harvest(gauge.read_gauge_obs(spark, gauge_path), none, sites, asked(spark, "A", "B"), start, end),
    )
    for run in runs:
        assert run.rows.count() == 48
        files = {r[0] for r in run.rows.select(F.input_file_name()).distinct().collect() if r[0]}
        plan = run.rows._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: []" not in plan and "day#" in plan.split("PartitionFilters: [")[1].split("]")[0]
        days = [scan.split("day=")[1][:10] for scan in files if "day=" in scan]
        assert set(days) <= {"2021-09-02", "2021-09-03"}
    # folders outside the range may hold what no reader understands
    bad = Path(tide_path) / "day=2021-09-05"
    for file in bad.glob("*.json"):
        file.unlink()
    (bad / "part-0.json").mkdir()
    assert runs[0].rows.count() == 48


def model_days(spark):
    """Three runs a day on five days and one of a storm, with two nodes each."""
    base = "https://x/dodsC/2021/nam/{}/hsofs/machine/inst/{}/fort.63.nc"
    urls = [base.format(f"202109{d:02d}{h:02d}", "namforecast") for d in range(1, 6) for h in (0, 6, 12)] + [base.format("4", "nhcOfcl")]
    rows = [(u, n, at(30 * 24 * 60) + timedelta(hours=6 * k + t), float(n + t)) for k, u in enumerate(urls) for n in (1, 2) for t in range(4)]
    series = spark.createDataFrame(rows, SERIES)
    runs = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "position int, url string")
    nodes = spark.createDataFrame([(u, n, 1.0, 2.0, f" S{n} name ", "src") for u in urls for n in (1, 2)], NODES)
    return runs, nodes, series


def test_only_folders_of_listed_runs_are_opened(spark):
    runs, nodes, series = model_days(spark)
    path = write_model_runs(series, scratch(spark, "model"))
    folders = {p.name for p in Path(path).glob("run_day=*")}
    assert folders == {f"run_day=2021-09-{d:02d}" for d in range(1, 6)} | {"run_day=advisory-4"}
    listed = runs.where(F.col("url").contains("/2021090306/") | F.col("url").contains("/4/"))
    landed = model.read_model_runs(spark, path)
    want = by_key(H.model_harvest(listed, nodes, series, asked(spark, "S1", "S2", "S3")).data)
    for folder in folders - {"run_day=2021-09-03", "run_day=advisory-4"}:
        for file in (Path(path) / folder).glob("*.parquet"):
            file.write_bytes(b"no parquet at all")
    run = H.model_harvest(listed, nodes, landed, asked(spark, "S1", "S2", "S3"))
    assert want and by_key(run.data) == want
    assert "dynamicpruning" in run.rows._jdf.queryExecution().executedPlan().toString().lower()
    assert model.read_model_runs(spark, path, listed, nodes.where("node_idx = 2")).count() == 8
    assert {r["CAST"] for r in run.meta_with_cast.collect()} == {"FORECAST"}


def test_a_pair_plans_its_runs_when_asked(spark):
    runs, nodes, series = model_days(spark)
    spark.sparkContext.setJobGroup("pair", "building a pair")
    pair = H.forecast_nowcast_pair(runs, nodes, series, asked(spark, "S1"))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("pair")
    spark.sparkContext.setJobGroup("rest", "")
    assert len(jobs) == 0
    assert {r["kind"]: r["runs_present"] for r in pair.status.collect()} == {"forecast": 16, "nowcast": 0}


def test_ledger_rounds_end(spark):
    """A capped provider is asked again in halves until every period is below the cap; every row lands once in the series."""
    rows = [("A", m / 60, float(m)) for m in range(0, 3000)] + [("B", 1, 1.0)] + [("D", 5, float(k)) for k in range(9)]
    truth = spark.createDataFrame(
        [(s, at(0) + timedelta(seconds=60 * m), v, k) for k, (s, m, v) in enumerate(rows)], "station string, time timestamp_ntz, value double, seq long")
    plan = periods.harvest_manifest(asked(spark, "A", "B", "C", "D"), "2021-09-01 00:00:00", "2021-09-01 02:00:00")
    cap, done = 8, {}
    for _ in range(20):
        ledger = periods.request_ledger(plan, truth, cap).collect()
        for r in ledger:
            if r["status"] in ("done", "stuck"):
                done[r["station"], r["period_start"], r["period_end"]] = r["status"]
        rows = spark.createDataFrame(ledger, periods.request_ledger(plan, truth, cap).schema)
        assert periods.next_requests(rows).where("station = 'C'").count() == (len(done) > 0 and plan.where("station = 'C'").count())
        plan = stage(periods.next_requests(rows, missing=False), "plan")
        if plan.isEmpty():
            break
    assert plan.isEmpty()
    assert {s for (s, _, _), v in done.items() if v == "stuck"} == {"D"}
    spans = spark.createDataFrame([k for k in done], "station string, period_start timestamp_ntz, period_end timestamp_ntz")
    got = periods.range_bucket_join(truth, spans, on=["station"]).select("station", "time", "seq").distinct()
    assert got.count() == truth.where("time <= timestamp_ntz'2021-09-01 02:00:00'").count()


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_backfill_of_many_windows_has_the_plan_of_few(spark, tides):
    obs, meta = tide.read_tide_obs(spark, tides[0]), tide.read_tide_meta(spark, tides[1])
    day = "2021-09-01 %02d:%02d:00"
    few, many = ([(day % (k // 4, 15 * (k % 4)), day % (k // 4 + 1, 0)) for k in range(n)] for n in (2, 40))
    found = [W.backfill(w, lambda a, b: H.tide_harvest(obs, meta, asked(spark, "A", "B"), a, b)) for w in (few, many)]
    assert exchanges(found[0]) == exchanges(found[1])
    scans = found[1]._jdf.queryExecution().optimizedPlan().toString()
    assert "json" not in scans.lower()  # the landed text is read once, when it is staged
    whole = by_key(found[1])
    for (station, time), value in by_key(found[0]).items():
        assert whole[station, time] == value


def test_rows_and_windows(spark):
    rows = obs_frame(spark, [("A", 0, 1.0), ("A", 30, 2.0), ("A", 24 * 60, 3.0), ("A", 60 * 24 * 9, 4.0)])
    windows = periods.windows_table(spark, [
        ("2021-09-01 00:00:00", "2021-09-01 00:30:00"), ("2021-09-03 00:00:00", "2021-09-01 00:30:00"), ("2020-01-01", "2020-01-02"),
    ])
    got = {(r["window_no"], r["value"]) for r in periods.rows_in_windows(rows, windows).collect()}
    assert got == {(0, 1.0), (0, 2.0), (1, 2.0), (1, 3.0)}


def test_files_are_sorted_as_cells(spark):
    """Part files read in order are the output in order, and nothing is exchanged above the unfolding."""
    rows = [(s, m, float(m) if m % 7 else None) for s in ("B", "A", "C", "D") for m in range(0, 60 * 24 * 6, 20) if (m // 20 + ord(s)) % 5]
    requested = asked(spark, "D", "B", "A")
    obs = obs_frame(spark, rows)
    ordered = ordered_series(obs, requested)
    got = [(r["station"], r["time"], r["value"]) for r in ordered.collect()]
    want = {(r["station"], r["time"]): r["value"] for r in harvest_series(obs).collect()}
    place = {"D": 0, "B": 1, "A": 2, "C": 3}
    assert [g[:2] for g in got] == sorted(want, key=lambda k: (place[k[0]], k[1])) and all(want[g[:2]] == g[2] for g in got)
    plan = ordered._jdf.queryExecution().optimizedPlan().toString().splitlines()
    unfolds = [k for k, line in enumerate(plan) if "Generate inline" in line]
    assert not any("Sort" in line or "Repartition" in line for line in plan[: unfolds[0]])
    assert any("Sort [" in line for line in plan[unfolds[0] :])
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 300)
    path = write_series(obs, scratch(spark, "out"), "NOAA", "x", requested=requested)
    spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    files = sorted(Path(path).glob("part-*.csv"))
    lines = [line.split(",") for f in files for line in f.read_text().splitlines() if not line.startswith("TIME")]
    assert len(files) > 3 and [(x[1], x[0]) for x in lines] == [(g[0], g[1].strftime("%Y-%m-%dT%H:%M:%S")) for g in got]


def test_lists_and_node_table(spark):
    path = scratch(spark, "lists")
    land_text(path, "stations.txt", "# from somewhere\n8410140  \nWNRN7\n35370047744601\n")
    rows = lists.read_station_list(spark, path).orderBy("position").collect()
    assert [tuple(r) for r in rows] == [(0, "8410140"), (1, "WNRN7"), (2, "35370047744601")]
    head = ",".join(lists.STATION_NODE_TYPES)
    land_text(path, "nodes.csv", head + "\n-,-,-,-,-,,deg,deg,ft,m,-,deg,deg,m MSL,-,-\n"
              "1,0269,Pier,BM,X,MSL,-64.7,32.3,NaN,NaN,gage,-64.7,32.3,459.26,2934241,1491932\n")
    row = lists.read_station_nodes(spark, f"{path}/nodes.csv").collect()
    assert len(row) == 1 and row[0]["stationid"] == "0269" and row[0]["Node"] == 1491932
    assert row[0]["navd_to_msl [ft]"] is None and row[0]["bathy"] == 459.26


def test_lists_in_splits_and_files(spark):
    """Splits of a few bytes: positions follow the lines of all files, blank lines keep their number."""
    path = scratch(spark, "lists")
    bodies = {"b.txt": ["# two", "B1", "", "B2  "], "a.txt": ["# one"] + [f"A{k}" for k in range(400)], "c.txt": ["# none"], "d.txt": []}
    for name, body in bodies.items():
        land_text(path, name, "".join(line + "\n" for line in body))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 256)
    spark.conf.set("spark.sql.files.openCostInBytes", 64)
    rows = lists.read_station_list(spark, path)
    got = sorted(tuple(r) for r in rows.collect())
    tasks = spark.read.text(path).rdd.getNumPartitions()
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")
    assert tasks > 4
    assert got == [(k, f"A{k}") for k in range(400)] + [(400, "B1"), (402, "B2")]


def test_grid_lists(spark):
    registry = spark.createDataFrame(
        [("hsofs", "tide", 0, "A"), ("ec95d", "tide", 0, "B"), ("", "gauge", 0, "G")], schema="grid string, kind string, position int, id string")
    found = [[r["station"] for r in lists.stations_for_grid(registry, g, k).collect()]
             for g, k in (("HSOFS", "tide"), ("none", "tide"), ("none", "gauge"))]
    assert found == [["A"], [], ["G"]]


def test_node_filter_reaches_the_scan(spark):
    path = scratch(spark, "series")
    model_tables(spark, "e")[2].write.parquet(path)
    df = model.read_model_series(spark, path, [1])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(node_idx), EqualTo(node_idx,1)]" in plan
    assert {r["node_idx"] for r in df.collect()} == {1}


def test_stream_bins_equal_batch_bins(spark):
    path, out, state = (scratch(spark, n) for n in ("obs", "bins", "state"))
    rows = obs_frame(spark, [("A", 6 * i, float(i)) for i in range(2000)])
    rows.write.parquet(path)
    stream = spark.readStream.schema(rows.schema).parquet(path)
    append_to(stream_resample(stream), out, state).awaitTermination()
    from gaugeloom.operators.resample import resample_first

    got, want = by_key(spark.read.parquet(out)), by_key(resample_first(rows))
    edge = at(6 * 1999) - timedelta(days=2)
    assert got == {k: v for k, v in want.items() if k[1] + timedelta(minutes=15) <= edge} and len(got) > 500


def test_stream_merge_over_three_collections(spark):
    landing, out, state = (scratch(spark, n) for n in ("landing", "merged", "state"))
    for k in range(3):
        rows = obs_frame(spark, [("A", 700 * i, float(100 * k + i)) for i in range(k, k + 4)])
        rows.write.mode("append").parquet(landing)
        merge_stream(spark.readStream.schema(rows.schema).parquet(landing), out, state).awaitTermination()
    assert by_key(merged(spark, out)) == {
        ("A", at(700 * i)): v for i, v in enumerate([0.0, 1.0, 2.0, 3.0, 104.0, 205.0])}


def test_merge_batch_can_be_repeated(spark):
    from gaugeloom.streaming.series import merge_batch

    out = scratch(spark, "merged")
    first, second = obs_frame(spark, [("A", 0, 1.0)]), obs_frame(spark, [("A", 0, 2.0), ("A", 6, 3.0)])
    for batch, number in ((first, 0), (second, 1), (second, 1)):
        merge_batch(batch, number, out)
    assert by_key(merged(spark, out)) == {("A", at(0)): 1.0, ("A", at(6)): 3.0}


def test_merge_over_a_new_checkpoint(spark):
    out = scratch(spark, "merged")
    batches = [[("A", 0, 1.0), ("A", 6, 2.0)], [("A", 6, 9.0), ("A", 12, 3.0)], [("A", 0, 8.0), ("B", 3000, 4.0)]]
    for rows in batches:
        landing, state = scratch(spark, "landing"), scratch(spark, "state")
        frame = obs_frame(spark, rows)
        frame.write.parquet(landing)
        merge_stream(spark.readStream.schema(frame.schema).parquet(landing), out, state).awaitTermination()
    assert by_key(merged(spark, out)) == {("A", at(0)): 1.0, ("A", at(6)): 2.0, ("A", at(12)): 3.0, ("B", at(3000)): 4.0}
    assert merged(spark, out).count() == 4


def test_landed_xml_files_are_bounded(spark, tmp_path):
    rows = spark.range(0, 950, 1, 1).select(
        *[F.concat(F.lit(c), F.col("id").cast("string")).alias(c) for c in ("site_id", "or_site_id", "sensor_class", "or_sensor_id", "location")]
    )
    path = write_xml(rows, f"{tmp_path}/sensors", rows=100)
    files = [p.read_text() for p in (tmp_path / "sensors").glob("part-*")]
    assert len(files) == 10 and max(f.count("<row>") for f in files) == 100
    found = gauge.read_gauge_sensor_meta(spark, path).select(*rows.columns)
    assert sorted(found.collect()) == sorted(rows.collect())


def test_a_source_is_read_once_for_its_series(spark, tmp_path):
    obs = obs_frame(spark, [("A", 1, 1.0), ("B", 20, 2.0)])
    obs.write.parquet(f"{tmp_path}/landed")
    registry = SourceRegistry()
    registry.register("own", lambda session, path: session.read.schema(obs.schema).parquet(path), None)
    found = registry.series(spark, "own", f"{tmp_path}/landed")
    assert all("/own-" in f for f in found.inputFiles())
    assert by_key(found) == by_key(harvest_series(obs))


def test_model_metadata_come_from_one_aggregate(spark, tmp_path):
    url = "https://x/{}/HSOFS/m/i/nowcast/f".format
    rows = [(url("2021090100"), 7, 1.0, 2.0, " A x ", "late"), (url("2021083100"), 9, 3.0, 4.0, " A x ", "second node"),
            (url("2021083100"), 8, 5.0, 6.0, " A x ", "first node"), (url("2021090100"), 9, 7.0, 8.0, " B ", "b")]
    schema = "url string, node_idx int, x double, y double, station_name string, source string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/nodes")
    meta = model.read_meta(spark, str(tmp_path))
    assert "Join" not in meta._jdf.queryExecution().executedPlan().toString()
    got = sorted((r["STATION"], r["LAT"], r["LON"], r["NAME"], r["OWNER"]) for r in meta.collect())
    assert got == [("A", 6.0, 5.0, "HSOFS_NOWCAST", "first node"), ("B", 8.0, 7.0, "HSOFS_NOWCAST", "b")]


def test_stations_of_one_small_file_are_dealt_before_they_unfold(spark):
    asked_ = spark.createDataFrame([(i, f"S{i}") for i in range(40)], "position int, station string").coalesce(1)
    manifest = periods.harvest_manifest(asked_, "2021-09-01 00:00:00", "2021-09-04 12:00:00")
    held = [r["n"] for r in manifest.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(held) > 1 and sum(held) == 160


def test_model_rows_are_repaired_in_long_blocks(spark):
    rows = [(s, 1440 * d, None if (d + len(s)) % 5 == 0 else float(d)) for s in ("A", "BB") for d in range(200)]
    obs = obs_frame(spark, rows)
    assert by_key(harvest_series(obs, 0, block_minutes=MODEL_BLOCK_MINUTES)) == by_key(harvest_series(obs, 0))


def test_periods_of_a_plan_are_not_broadcast(spark):
    plan = H.gauge_plan(asked(spark, "A", "B"), "2021-09-01 00:00:00", "2021-09-04 12:00:00")
    found = H.capped_requests(obs_frame(spark, [("A", 1, 1.0), ("A", 2, 1.0), ("B", 1500, 2.0)]), plan, cap=2)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["station"], r["rows"], r["at_cap"]) for r in found.collect()) == [("A", 2, True), ("B", 1, False)]
