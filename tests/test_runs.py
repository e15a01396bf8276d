"""Station matching, run classification, metadata and quality reports."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from checks.standins import model_nodes, model_series
from gaugeloom.operators import matching as M
from gaugeloom.operators import metadata as D
from gaugeloom.operators import quality as Q
from gaugeloom.operators import runs as R
from helpers import at, obs_frame

URL = "http://x/2022/nam/{}/hsofs/machine/inst/{}/fort.61.nc"
START = datetime(2022, 1, 16)
NODES = "url string, node_idx int, x double, y double, station_name string, source string"
SERIES = "url string, node_idx int, time timestamp_ntz, zeta double"


def asked(spark, *ids):
    return spark.createDataFrame([(i, s) for i, s in enumerate(ids)], "position int, station string")


def nodes(spark, *names, url="u"):
    return spark.createDataFrame(
        [(url, i, 10.0 + i, 30.0 + i, f" {n} ", "model") for i, n in enumerate(names)], NODES)


def test_match_takes_first_node_and_keeps_request_order(spark):
    run = nodes(spark, "C cove", "A bay", "C dup")
    want = asked(spark, "A", "C", "X")
    rows = M.match_stations(want, run).orderBy("position").collect()
    assert [(r["station"], r["node_idx"]) for r in rows] == [("A", 1), ("C", 0)]
    assert [r["station"] for r in M.unmatched_stations(want, run).collect()] == ["X"]
    two = run.unionByName(nodes(spark, "C cove", "A bay", "C dup", url="v"))
    assert M.match_stations(want, two).count() == 4
    assert M.distinct_pairs(M.match_stations(want, two)).count() == 2


def test_lists_keep_order_and_duplicates(spark):
    both = M.union_station_lists(asked(spark, "A", "B"), asked(spark, "B", "C"), asked(spark, "D"))
    assert [r["station"] for r in both.orderBy("position").collect()] == ["A", "B", "B", "C", "D"]
    assert [r["position"] for r in both.orderBy("position").collect()] == [0, 1, 2, 3, 4]
    left = M.station_difference(both, asked(spark, "B")).collect()
    assert sorted(r["station"] for r in left) == ["A", "C", "D"]
    assert [r[0] for r in M.station_intersection(both, asked(spark, "B", "Z")).collect()] == ["B"]


def series(spark, url, last_hours):
    steps = [(url, 0, START + timedelta(hours=h), 1.0) for h in range(-3, last_hours + 1)]
    return spark.createDataFrame(steps, SERIES)


@pytest.mark.parametrize("token, last, cast", [
    ("2022011600", 0, "NOWCAST"), ("2022011600", 1, "FORECAST"), ("11", -1, "FORECAST")])
def test_cast(spark, token, last, cast):
    url = URL.format(token, "e")
    runs = spark.createDataFrame([(0, url)], "position int, url string")
    assert [r["cast"] for r in R.run_cast(series(spark, url, last), runs).collect()] == [cast]


def test_mixed_casts_fail(spark):
    casts = spark.createDataFrame([("a", "FORECAST"), ("a", "NOWCAST"), ("b", "NOWCAST")], "batch string, cast string")
    report = {r["batch"]: r["single_cast"] for r in R.cast_report(casts).collect()}
    assert report == {"a": False, "b": True}
    assert R.assert_single_cast(casts.where("batch = 'b'")).collect()[0]["cast"] == "NOWCAST"
    with pytest.raises(Exception, match="mixed casts in batch a"):
        R.assert_single_cast(casts).collect()


def test_first_url_and_first_valid_meta(spark):
    runs = spark.createDataFrame([(0, ""), (1, "u"), (2, "v")], "position int, url string")
    assert R.first_nonempty(runs).collect()[0]["url"] == "u"
    both = nodes(spark, "A", url="v").unionByName(nodes(spark, "A", "B", url="u"))
    pairs = spark.createDataFrame([("A", 0), ("B", 1)], "station string, node_idx int")
    rows = R.first_valid_meta(pairs, both, runs).collect()
    assert {(r["station"], r["url"]) for r in rows} == {("A", "u"), ("B", "u")}


def test_present_runs_and_node_numbers(spark):
    url = URL.format("2022011600", "e")
    runs = spark.createDataFrame([(0, url), (1, "gone")], "position int, url string")
    assert [r["url"] for r in M.present_runs(runs, series(spark, url, 1)).collect()] == [url]
    curated = spark.createDataFrame([("8410140", 1), ("X", 9)], "stationid string, Node int")
    found = M.node_lookup(curated, series(spark, url, 1))
    assert {r["station"] for r in found.collect()} == {"8410140"} and found.count() == 5


def test_sensor_choice(spark):
    sensors = spark.createDataFrame(
        [("30033", "or1", "94", "s1", "coast"), ("30033", "or2", "20", "s2", "river")],
        "site_id string, or_site_id string, sensor_class string, or_sensor_id string, location string")
    sites = spark.createDataFrame(
        [("or1", "1", "2", "a"), ("or2", "35.5", "", "b")],
        "or_site_id string, latitude_dec string, longitude_dec string, location string")
    row = D.resolve_site(sensors, sites, "Stage").collect()[0]
    assert (row["or_site_id"], row["LAT"], row["LON"], row["NAME"]) == ("or2", "35.5", None, "river")


def test_metadata_forms(spark):
    raw = spark.createDataFrame([("A", "1.5", "bad", "Bay")], "station string, LAT string, LON string, NAME string")
    meta = D.standard_meta(raw, "NOAA/NOS")
    row = meta.collect()[0]
    assert (row["STATION"], row["LAT"], row["LON"], row["UNITS"], row["TZ"], row["COUNTY"]) == (
        "A", 1.5, None, "meters", "gmt", None)
    back = D.meta_from_kv(D.meta_to_kv(meta)).collect()[0]
    assert (back["LAT"], back["NAME"], back["STATE"]) == ("1.5", "Bay", None)
    assert D.filled_meta(meta).collect()[0]["COUNTY"] == "-99999"


def test_data_and_meta_in_step(spark):
    data = obs_frame(spark, [("A", 0, 1.0), ("B", 0, 1.0)])
    meta = D.standard_meta(spark.createDataFrame([("B",), ("C",)], "station string"), "x")
    assert [r[0] for r in D.data_without_meta(data, meta).collect()] == ["A"]
    assert [r[0] for r in D.meta_without_data(data, meta).collect()] == ["C"]
    joined = {r["station"]: r["OWNER"] for r in D.attach_meta(data, meta).collect()}
    assert joined == {"A": None, "B": "x"}
    counts = Q.harvest_counts(asked(spark, "A", "B", "C", "D"), data, meta).collect()[0]
    assert tuple(counts) == (2, 2, 2, 2)


def test_exclusion_reasons(spark):
    data = obs_frame(spark, [("A", 0, 1.0), ("A", 1, 2.0), ("B", 0, None), ("C", 0, 1.0)])
    got = {r["station"]: r["reason"] for r in Q.excluded_stations(asked(spark, "A", "B", "C", "D"), data).collect()}
    assert got == {"B": "no valid values", "C": "too few points to repair gaps", "D": "no data"}


def test_missing_cap_and_empty(spark):
    data = obs_frame(spark, [("A", 0, 1.0), ("A", 1, -99999.0), ("B", 0, None)])
    got = {r["station"]: r["missing"] for r in Q.missing_report(data).collect()}
    assert got == {"A": 1, "B": 1}
    assert {r["station"] for r in Q.drop_empty_stations(data).collect()} == {"A"}
    day = data.withColumn("day", F.to_date("time"))
    assert {r["station"]: r["at_cap"] for r in Q.row_cap_check(day, ["day"], cap=2).collect()} == {
        "A": True, "B": False}


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_requested_pairs_are_the_matches_without_runs(spark):
    rows = [("u1", 5, " A x "), ("u1", 3, " A y "), ("u2", 4, " A z "), ("u2", 9, " B x "), ("u3", 9, " B x "), ("u3", 1, " C ")]
    nodes = spark.createDataFrame(rows, "url string, node_idx int, station_name string")
    wanted = spark.createDataFrame([(0, "A"), (1, "B"), (2, "A"), (3, "Q")], "position int, station string")
    want = M.distinct_pairs(M.match_stations(wanted, nodes)).select("station", "node_idx").collect()
    assert sorted(M.requested_pairs(wanted, nodes).collect()) == sorted(want) == [("A", 3), ("A", 4), ("B", 9)]


def test_lines_of_the_runs_are_shuffled_by_order_once(spark, small):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert executed(model_series(spark, small)).count("Exchange hashpartitioning") == 2
        # Lines, orders, then their rows and the suppliers.
        assert executed(model_nodes(spark, small)).count("Exchange hashpartitioning") == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
