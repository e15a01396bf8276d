"""Times, run URLs, names, values and request planning."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gaugeloom import schema
from gaugeloom.functions import runs as R
from gaugeloom.functions import times as T
from gaugeloom.functions import values as V
from gaugeloom.operators import periods as P
from gaugeloom.operators.runs import with_run_parts

HEAD = "https://data.example/dodsC"
CYCLE = f"{HEAD}/2022/nam/2022011600/hsofs/machine/instance-1/namforecast/fort.61.nc"
STORM = f"{HEAD}/2021/ida/11/hsofs/machine/instance-2/nhcOfcl/fort.61.nc"


def one(spark, *columns):
    return spark.range(1).select(*columns).collect()[0]


def stamp(text):
    return datetime.fromisoformat(text)


def ranged(spark, start, end):
    return spark.createDataFrame(
        [(stamp(start), stamp(end))], "start timestamp_ntz, end timestamp_ntz")


def periods_of(spark, start, end, as_of=None):
    rows = P.daily_periods(ranged(spark, start, end), as_of=as_of).orderBy("period_start").collect()
    return [(str(r["period_start"]), str(r["period_end"])) for r in rows]


def test_day_periods(spark):
    assert periods_of(spark, "2021-09-01 03:00:30", "2021-09-04 00:30:00") == [
        ("2021-09-01 03:00:30", "2021-09-01 23:59:59"),
        ("2021-09-02 00:00:00", "2021-09-02 23:59:59"),
        ("2021-09-03 00:00:00", "2021-09-03 23:59:59"),
        ("2021-09-04 00:00:00", "2021-09-04 00:30:00"),
    ]


def test_day_periods_end_at_midnight(spark):
    assert len(periods_of(spark, "2022-01-14 00:00:00", "2022-01-16 00:00:00")) == 2


def test_day_periods_swap_and_clamp(spark):
    assert periods_of(spark, "2022-01-15 06:00:00", "2022-01-14 12:00:00", "2022-01-15 01:00:00") == [
        ("2022-01-14 12:00:00", "2022-01-14 23:59:59"),
        ("2022-01-15 00:00:00", "2022-01-15 01:00:00"),
    ]
    assert periods_of(spark, "2022-01-14 00:00:00", "2022-01-14 00:00:00") == []


@pytest.mark.parametrize("hour, floor, nearest", [
    (0, 0, 0), (2, 0, 0), (3, 0, 6), (5, 0, 6), (6, 6, 6), (7, 6, 6), (9, 6, 12), (21, 18, 24), (23, 18, 24)])
def test_cycle_hours(spark, hour, floor, nearest):
    t = F.lit(datetime(2021, 6, 13, hour, 50)).cast("timestamp_ntz")
    day = datetime(2021, 6, 13)
    row = one(spark, T.cycle_floor(t), T.cycle_nearest(t))
    assert [(x - day).total_seconds() / 3600 for x in row] == [floor, nearest]


def test_cycle_times_and_legacy_start(spark):
    df = ranged(spark, "2021-06-13 07:30:00", "2021-06-13 19:00:00")
    hours = [r["cycle"].hour for r in P.cycles(df).orderBy("cycle").collect()]
    assert hours == [6, 12, 18]
    legacy = P.cycles(df, legacy_start=True).orderBy("cycle").collect()
    assert legacy[0]["cycle"] == stamp("2021-06-12 18:00:00") and len(legacy) == 5


def test_overlapping_windows(spark):
    df = ranged(spark, "2021-06-13", "2021-06-13")
    rows = P.overlapping_windows(df, "start", 4, 3, 5).orderBy("window_no").collect()
    assert len(rows) == 5
    assert (rows[1]["window_start"], rows[1]["window_end"]) == (stamp("2021-06-16"), stamp("2021-06-20"))


def test_run_url_of_a_cycle(spark):
    row = with_run_parts(spark.createDataFrame([(CYCLE,)], "url string")).collect()[0]
    assert (row["start"], row["grid"], row["instance"], row["ensemble"], row["advisory"], row["label"]) == (
        stamp("2022-01-16"), "HSOFS", "instance-1", "namforecast", False, "2022-01-16T00:00:00")


def test_run_url_of_a_storm(spark):
    row = with_run_parts(spark.createDataFrame([(STORM,)], "url string")).collect()[0]
    assert (row["start_token"], row["start"], row["advisory"], row["label"]) == ("11", None, True, "11")


def test_short_or_odd_urls_do_not_fail(spark):
    rows = with_run_parts(spark.createDataFrame(
        [("x",), ("/a/b/c/oops/g/m/i/e/f",), (None,)], "url string")).collect()
    assert [r["start"] for r in rows] == [None] * 3
    assert [r["advisory"] for r in rows] == [None] * 3


def test_nowcast_url_changes_one_token(spark):
    row = one(spark, R.to_nowcast_url(F.lit(CYCLE)), R.to_nowcast_url(F.lit(STORM)))
    assert row[0] == CYCLE.replace("/namforecast/", "/nowcast/")
    assert row[1] == STORM.replace("/nhcOfcl/", "/nowcast/")


def test_names(spark):
    row = one(
        spark,
        R.artifact_name("noaa_stationdata", F.lit("2022-01-16T00:00:00")),
        R.artifact_name("contrails_stationdata", F.lit("RIVERS"), F.lit("2022-01-16T00:00:00"), meta=True),
        R.artifact_name("adcirc_stationdata", F.lit("nhcOfcl"), F.lit("HSOFS"), F.lit("11")),
        R.grid_cast_name(F.lit("hsofs"), F.lit("namforecast ")),
        R.station_token(F.lit("\t 8410140  Eastport \n")),
        R.run_urls(F.lit(stamp("2021-06-13 06:00:00")).cast("timestamp_ntz"), "x/%s/nam/%s/y"),
    )
    assert list(row) == [
        "noaa_stationdata_2022-01-16T00:00:00",
        "contrails_stationdata_meta_RIVERS_2022-01-16T00:00:00",
        "adcirc_stationdata_nhcOfcl_HSOFS_11",
        "HSOFS_NAMFORECAST",
        "8410140",
        "x/2021/nam/2021061306/y",
    ]


def test_values(spark):
    df = spark.createDataFrame([(-99999.0,), (-1000.0,), (-1000.1,), (float("nan"),), (None,)], "v double")
    assert [r[0] for r in df.select(V.mask_below("v")).collect()] == [None, -1000.0, None, None, None]
    assert [r[0] for r in df.select(V.fill_missing("v")).collect()][3:] == [-99999.0, -99999.0]
    row = one(spark, V.convert_units(F.lit(1.11)), V.empty_to_null(F.lit("")),
              V.valid_source(F.lit("noaa")), V.valid_source(F.lit("usgs")),
              V.sensor_class(F.lit("Water Elevation")), V.sensor_class(F.lit("none")), V.sensor_name(F.lit(20)))
    assert abs(row[0] - 0.338328) < 1e-12
    assert list(row)[1:] == [None, True, False, 94, None, "Stage"]


def test_lookback_and_clamp(spark):
    stop = F.lit(stamp("2022-01-16 00:00:00")).cast("timestamp_ntz")
    lo, hi = T.lookback(stop, -2)
    assert list(one(spark, lo, hi, T.clamp_end(stop, "2022-01-15 00:00:00"))) == [
        stamp("2022-01-14"), stamp("2022-01-16"), stamp("2022-01-15")]


def test_products_are_checked(spark):
    assert schema.provider_field("noaa", "predictions") == "predicted_wl"
    assert schema.harvest_product("CONTRAILS", "river_water_level") == "Stage"
    for source, product in (("NOAA", "sea_ice"), ("USGS", "water_level")):
        with pytest.raises(ValueError):
            schema.provider_field(source, product)
    with pytest.raises(ValueError):
        schema.harvest_product("NOAA", "wind")
    assert schema.product_table(spark).count() == 8
    assert len(schema.SENSOR_CLASSES) == 23


def test_manifest_and_requests(spark):
    stations = spark.createDataFrame([("30033",), ("WNRN7",)], "station string")
    manifest = P.harvest_manifest(stations, "2022-01-14 00:00:00", "2022-01-16 00:00:00")
    assert manifest.count() == 4
    queries = {r["query"] for r in P.gauge_requests(manifest, "Stage").collect()}
    assert ("method=GetSensorData&class=20&site_id=30033&tz=gmt"
            "&data_start=2022-01-14+00%3A00%3A00&data_end=2022-01-14+23%3A59%3A59") in queries


def test_rows_fall_in_one_period_each(spark):
    periods = P.daily_periods(ranged(spark, "2022-01-14 06:00:00", "2022-01-16 00:00:00"))
    obs = spark.createDataFrame(
        [(stamp(t),) for t in ("2022-01-14 05:59:59", "2022-01-14 06:00:00", "2022-01-14 23:59:59.7", "2022-01-15 23:59:59")],
        "time timestamp_ntz")
    found = P.range_bucket_join(obs, periods.select("period_start", "period_end")).collect()
    assert sorted(str(r["time"]) for r in found) == [
        "2022-01-14 06:00:00", "2022-01-14 23:59:59.700000", "2022-01-15 23:59:59"]
