"""Filters, projections and scalar functions (C, J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import pieces as P
from checks.registry import check
from checks.standins import customer_meta, observations, runs, table, user_ranges
from gaugeloom import schema
from gaugeloom.functions import runs as R
from gaugeloom.functions import times as T
from gaugeloom.functions import values as V
from gaugeloom.operators.metadata import clean_fields, standard_meta
from gaugeloom.operators.periods import (
    cycles, daily_periods, gauge_requests, harvest_manifest, overlapping_windows, range_bucket_join,
    sliding_windows,
)
from gaugeloom.operators import products
from gaugeloom.operators.quality import row_cap_check
from gaugeloom.operators.runs import with_run_parts

AS_OF = "2024-01-25 12:00:00"


@check("select_product", """
SELECT CAST(user_id AS VARCHAR) AS station, ts AS time, value / 2 AS value FROM events""")
def select_product(spark, sf):
    answers = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("station"), F.col("ts").alias("date_time"),
        F.col("value").alias("water_level"), (F.col("value") / 2).alias("predicted_wl"),
    )
    return products.select_product(answers, "NOAA", "predictions", time="date_time")


@check("product_registry", """
WITH products AS (SELECT * FROM (VALUES
  ('NOAA', 'water_level', 'water_level', NULL), ('NOAA', 'predictions', 'predicted_wl', NULL),
  ('NOAA', 'air_pressure', 'air_press', NULL), ('NOAA', 'hourly_height', 'water_level', NULL),
  ('NOAA', 'wind', 'spd', NULL), ('CONTRAILS', 'river_water_level', 'Stage', 20),
  ('CONTRAILS', 'coastal_water_level', 'Water Elevation', 94),
  ('ASGS', 'water_level', 'water_level', NULL)) t(source, product, provider_column, class_code)),
asked AS (SELECT event_id, CASE event_type WHEN 'signup' THEN 'predictions' WHEN 'view' THEN 'wind'
  WHEN 'click' THEN 'water_level' WHEN 'error' THEN 'river_water_level' ELSE 'sea_ice' END AS product
  FROM events)
SELECT event_id, product, source, provider_column, coalesce(class_code, -1) AS class_code
FROM asked JOIN products USING (product)""")
def product_registry(spark, sf):
    asked = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "signup", "predictions")
        .when(F.col("event_type") == "view", "wind")
        .when(F.col("event_type") == "click", "water_level")
        .when(F.col("event_type") == "error", "river_water_level")
        .otherwise("sea_ice").alias("product"),
    )
    return products.with_provider_column(asked).select(
        "event_id", "product", "source", "provider_column",
        F.coalesce("class_code", F.lit(-1)).alias("class_code"),
    )


@check("sensor_class", """
SELECT event_id, sensor, CASE sensor WHEN 'Stage' THEN 20 WHEN 'Water Elevation' THEN 94
  WHEN 'Battery' THEN 199 WHEN 'Wind Velocity, maximum' THEN 41 ELSE -1 END AS class_code
FROM (SELECT event_id, CASE event_type WHEN 'signup' THEN 'Stage' WHEN 'view' THEN 'Water Elevation'
  WHEN 'click' THEN 'Battery' WHEN 'error' THEN 'Wind Velocity, maximum' ELSE event_type END AS sensor
  FROM events)""")
def sensor_class(spark, sf):
    names = {"signup": "Stage", "view": "Water Elevation", "click": "Battery",
             "error": "Wind Velocity, maximum"}
    sensor = F.col("event_type")
    for kind, name in names.items():
        sensor = F.when(F.col("event_type") == kind, name).otherwise(sensor)
    return table(spark, sf, "events").select(
        "event_id", sensor.alias("sensor")
    ).withColumn("class_code", F.coalesce(V.sensor_class("sensor"), F.lit(-1)))


@check("time_slice", P.with_(P.obs(), select="""
SELECT * FROM obs WHERE time BETWEEN TIMESTAMP '2024-01-05 03:00:00' AND TIMESTAMP '2024-01-19 21:00:00'"""))
def time_slice(spark, sf):
    obs = observations(spark, sf)
    return obs.where(T.time_slice("time", "2024-01-05 03:00:00", "2024-01-19 21:00:00"))


@check("lookback", """
SELECT event_id, least(ts - INTERVAL 2 DAY, ts) AS range_start, greatest(ts - INTERVAL 2 DAY, ts) AS range_end,
  least(ts + INTERVAL 3 DAY, ts) AS ahead_start, greatest(ts + INTERVAL 3 DAY, ts) AS ahead_end FROM events""")
def lookback(spark, sf):
    back, ahead = T.lookback("ts", -2), T.lookback("ts", 3)
    return table(spark, sf, "events").select(
        "event_id", back[0].alias("range_start"), back[1].alias("range_end"),
        ahead[0].alias("ahead_start"), ahead[1].alias("ahead_end"),
    )


@check("clamp_end", f"SELECT event_id, least(ts, TIMESTAMP '{AS_OF}') AS range_end FROM events")
def clamp_end(spark, sf):
    return table(spark, sf, "events").select("event_id", T.clamp_end("ts", AS_OF).alias("range_end"))


@check("mask_below", "SELECT event_id, CASE WHEN value >= 20 THEN value END AS value FROM events")
def mask_below(spark, sf):
    return table(spark, sf, "events").select("event_id", V.mask_below("value", 20).alias("value"))


@check("convert_units", "SELECT event_id, value * 0.3048::DOUBLE AS value FROM events")
def convert_units(spark, sf):
    return table(spark, sf, "events").select("event_id", V.convert_units("value").alias("value"))


@check("fill_missing", P.with_(P.obs(), select="""
SELECT station, time, seq, coalesce(value, -99999.0) AS value FROM obs"""))
def fill_missing(spark, sf):
    return observations(spark, sf).withColumn("value", V.fill_missing("value"))


@check("empty_to_null", """
SELECT CAST(c_custkey AS VARCHAR) AS station,
  CASE WHEN c_acctbal >= 0 THEN CAST(c_nationkey AS VARCHAR) END AS lat,
  CASE WHEN c_acctbal >= 0 THEN CAST(n_regionkey AS VARCHAR) END AS lng,
  CASE WHEN c_acctbal >= 0 THEN c_name END AS name, CASE WHEN c_acctbal >= 0 THEN n_name END AS state
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def empty_to_null(spark, sf):
    return clean_fields(customer_meta(spark, sf), ["lat", "lng", "name", "state"])


@check("valid_source", """
WITH s AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'noaa' WHEN 'O' THEN 'Contrails'
  ELSE o_orderpriority END AS source FROM orders)
SELECT * FROM s WHERE upper(source) IN ('NOAA', 'CONTRAILS', 'ASGS')""")
def valid_source(spark, sf):
    source = (
        F.when(F.col("o_orderstatus") == "F", "noaa")
        .when(F.col("o_orderstatus") == "O", "Contrails")
        .otherwise(F.col("o_orderpriority"))
    )
    rows = table(spark, sf, "orders").select("o_orderkey", source.alias("source"))
    return rows.where(V.valid_source("source"))


@check("standard_meta", P.with_(P.META, select="SELECT * FROM meta"))
def standard_meta_(spark, sf):
    raw = clean_fields(customer_meta(spark, sf), ["lat", "lng", "name", "state"])
    named = raw.select("station", "name", "state", F.col("lat").alias("LAT"), F.col("lng").alias("LON"))
    return standard_meta(named, schema.OWNERS["NOAA"])


# --- run URLs -------------------------------------------------------------------------------

@check("parse_run_url", P.with_(P.runs(), P.PARTS, select="""
SELECT url, start_token, grid, instance, ensemble FROM parts"""))
def parse_run_url(spark, sf):
    rows = runs(spark, sf)
    return rows.withColumns(R.parse_run_url("url")).drop("position")


@check("run_start", P.with_(P.runs(), P.PARTS, select="SELECT url, start FROM parts"))
def run_start(spark, sf):
    token = R.parse_run_url("url")["start_token"]
    return runs(spark, sf).select("url", R.run_start(token).alias("start"))


@check("is_advisory", P.with_(P.runs(), P.PARTS, select="""
SELECT url, CASE WHEN start IS NOT NULL THEN false WHEN try_cast(start_token AS BIGINT) IS NOT NULL
  THEN true END AS advisory FROM parts"""))
def is_advisory(spark, sf):
    token = R.parse_run_url("url")["start_token"]
    return runs(spark, sf).select("url", R.is_advisory(token).alias("advisory"))


@check("run_label", P.with_(P.runs(), P.PARTS, select="""
SELECT url, coalesce(strftime(start, '%Y-%m-%dT%H:%M:%S'), start_token) AS label FROM parts"""))
def run_label(spark, sf):
    return with_run_parts(runs(spark, sf)).select("url", "label")


@check("to_nowcast_url", P.with_(P.runs(), P.PARTS, select="""
SELECT url, replace(url, '/' || ensemble || '/', '/nowcast/') AS nowcast_url FROM parts"""))
def to_nowcast_url(spark, sf):
    return runs(spark, sf).select("url", R.to_nowcast_url("url").alias("nowcast_url"))


@check("station_token", P.with_(P.runs(), P.model_nodes(), select="""
SELECT url, node_idx, split_part(trim(station_name), ' ', 1) AS station FROM nodes"""))
def station_token(spark, sf):
    from checks.standins import model_nodes
    return model_nodes(spark, sf).select(
        "url", "node_idx", R.station_token("station_name").alias("station")
    )


@check("grid_cast_name", P.with_(P.runs(), P.PARTS, select="""
SELECT url, upper(grid) || '_' || upper(ensemble) AS name FROM parts"""))
def grid_cast_name(spark, sf):
    return with_run_parts(runs(spark, sf)).select(
        "url", R.grid_cast_name("grid", "ensemble").alias("name")
    )


TEMPLATE = "https://data.example/dodsC/%s/nam/%s/hsofs/machine/run/namforecast/fort.61.nc"


@check("run_urls", """
SELECT o_orderkey, 'https://data.example/dodsC/' || strftime(o_orderdate, '%Y') || '/nam/'
  || strftime(o_orderdate, '%Y%m%d%H') || '/hsofs/machine/run/namforecast/fort.61.nc' AS url FROM orders""")
def run_urls(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", R.run_urls("o_orderdate", TEMPLATE).alias("url")
    )


@check("artifact_name", P.with_(P.runs(), P.PARTS, select="""
SELECT url, 'adcirc_stationdata_' || ensemble || '_' || grid || '_'
    || coalesce(strftime(start, '%Y-%m-%dT%H:%M:%S'), start_token) AS data_name,
  'contrails_stationdata_meta_RIVERS' || coalesce('_' || strftime(start, '%Y-%m-%dT%H:%M:%S'), '') AS meta_name
FROM parts"""))
def artifact_name(spark, sf):
    parts = with_run_parts(runs(spark, sf))
    return parts.select(
        "url",
        R.artifact_name(schema.FILE_ROOTS["ASGS"], "ensemble", "grid", "label").alias("data_name"),
        R.artifact_name(
            schema.FILE_ROOTS["CONTRAILS"], F.lit(schema.GAUGE_GROUPS["river_water_level"]),
            T.iso_time("start"), meta=True,
        ).alias("meta_name"),
    )


# --- times and periods ------------------------------------------------------------------------

@check("iso_time", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso FROM events")
def iso_time(spark, sf):
    return table(spark, sf, "events").select("event_id", T.iso_time("ts").alias("iso"))


@check("cycle_floor", """
SELECT event_id, time_bucket(INTERVAL 6 HOUR, ts) AS cycle FROM events""")
def cycle_floor(spark, sf):
    return table(spark, sf, "events").select("event_id", T.cycle_floor("ts").alias("cycle"))


@check("cycle_nearest", """
SELECT event_id, date_trunc('day', ts) + ((hour(ts) + 3) // 6 * 6) * INTERVAL 1 HOUR AS cycle FROM events""")
def cycle_nearest(spark, sf):
    return table(spark, sf, "events").select("event_id", T.cycle_nearest("ts").alias("cycle"))


RANGES = """ranges AS (
  SELECT CAST(user_id AS VARCHAR) AS station, min(ts) AS start, max(ts) AS "end" FROM events GROUP BY 1)"""


@check("cycle_times", P.with_(RANGES, select=f"""
SELECT station, unnest(generate_series(time_bucket(INTERVAL 6 HOUR, start),
  time_bucket(INTERVAL 6 HOUR, least("end", TIMESTAMP '{AS_OF}')), INTERVAL 6 HOUR)) AS cycle FROM ranges"""))
def cycle_times(spark, sf):
    return cycles(user_ranges(spark, sf), as_of=AS_OF).select("station", "cycle")


PERIODS = f"""periods AS (
  SELECT station, greatest(day, lo) AS period_start,
    least(day + INTERVAL 86399 SECOND, hi) AS period_end
  FROM (SELECT station, lo, hi, unnest(generate_series(date_trunc('day', lo), hi, INTERVAL 1 DAY)) AS day
        FROM (SELECT station, date_trunc('second', start) AS lo,
                date_trunc('second', least("end", TIMESTAMP '{AS_OF}')) AS hi FROM ranges)
        WHERE lo < hi)
  WHERE day < hi)"""


@check("daily_periods", P.with_(RANGES, PERIODS, select="SELECT * FROM periods"))
def daily_periods_(spark, sf):
    return daily_periods(user_ranges(spark, sf), as_of=AS_OF).select(
        "station", "period_start", "period_end"
    )


@check("range_bucket_join", P.with_(RANGES, PERIODS, P.obs(station="user_id"), select="""
SELECT o.station, o.time, o.value, o.seq, p.period_start, p.period_end
FROM obs o JOIN periods p ON o.station = p.station AND o.time >= p.period_start AND (o.time <= p.period_end
  OR (p.period_end = date_trunc('day', p.period_end) + INTERVAL 86399 SECOND
    AND o.time < date_trunc('day', p.period_end) + INTERVAL 1 DAY))"""))
def range_bucket_join_(spark, sf):
    periods = daily_periods(user_ranges(spark, sf), as_of=AS_OF)
    return range_bucket_join(
        observations(spark, sf, "user_id"),
        periods.select("station", "period_start", "period_end"),
        on=["station"],
    )


@check("rows_in_periods", """
SELECT CAST(user_id AS VARCHAR) AS station, count(*) AS rows_in, count(*) AS rows_out
FROM events WHERE ts < TIMESTAMP '2024-02-01' GROUP BY 1""")
def rows_in_periods(spark, sf):
    """Rows moved into the last second of their day: every row of the range finds its period."""
    end = F.to_timestamp_ntz(F.lit("2024-02-01 00:00:00"))
    obs = observations(spark, sf, "user_id").where(F.col("time") < end)
    late = F.date_trunc("day", "time").cast("timestamp_ntz") + F.make_dt_interval(secs=F.lit(86_399.5))
    obs = obs.withColumn("time", F.when(F.col("seq") % 3 == 0, late).otherwise(F.col("time")))
    stations = obs.select("station").distinct()
    placed = range_bucket_join(obs, harvest_manifest(stations, "2024-01-01 00:00:00", end), on=["station"])
    came = obs.groupBy("station").agg(F.count("*").alias("rows_in"))
    return came.join(placed.groupBy("station").agg(F.count("*").alias("rows_out")), "station")


@check("row_cap_check", P.with_(P.obs(), select="""
SELECT station, date_trunc('day', time) AS day, count(*) AS rows, count(*) >= 70 AS at_cap FROM obs GROUP BY 1, 2"""))
def row_cap_check_(spark, sf):
    obs = observations(spark, sf).withColumn("day", T.truncate("day", "time"))
    return row_cap_check(obs, ["day"], cap=70)


@check("harvest_manifest", """
WITH days AS (SELECT unnest(generate_series(TIMESTAMP '2021-09-01', TIMESTAMP '2021-09-04', INTERVAL 1 DAY)) AS day)
SELECT CAST(s_suppkey AS VARCHAR) AS station, s_name,
  greatest(day, TIMESTAMP '2021-09-01 03:00:30') AS period_start,
  least(day + INTERVAL 86399 SECOND, TIMESTAMP '2021-09-04 00:30:00') AS period_end
FROM supplier CROSS JOIN days""")
def harvest_manifest_(spark, sf):
    stations = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("station"), "s_name"
    )
    return harvest_manifest(stations, "2021-09-01 03:00:30", "2021-09-04 00:30:00")


@check("request_query", P.with_(RANGES, PERIODS, select="""
SELECT station, period_start, 'method=GetSensorData&class=20&site_id=' || url_encode(station)
  || '&tz=gmt&data_start=' || replace(url_encode(strftime(period_start, '%Y-%m-%d %H:%M:%S')), '%20', '+')
  || '&data_end=' || replace(url_encode(strftime(period_end, '%Y-%m-%d %H:%M:%S')), '%20', '+') AS query
FROM periods"""))
def request_query(spark, sf):
    manifest = daily_periods(user_ranges(spark, sf), as_of=AS_OF)
    return gauge_requests(manifest, "Stage").select("station", "period_start", "query")


@check("overlapping_windows", P.with_(RANGES, select="""
SELECT station, CAST(i AS INTEGER) AS window_no, start + i * INTERVAL 3 DAY AS window_start,
  start + i * INTERVAL 3 DAY + INTERVAL 4 DAY AS window_end
FROM ranges CROSS JOIN range(5) t(i)"""))
def overlapping_windows_(spark, sf):
    return overlapping_windows(user_ranges(spark, sf), "start", 4, 3, 5).drop("start", "end")


@check("sliding_windows", P.with_(P.obs(), select="""
SELECT station, time, value, seq, w AS window_start, w + INTERVAL 4 DAY AS window_end
FROM (SELECT *, unnest(generate_series(
        time_bucket(INTERVAL 3 DAY, time, TIMESTAMP '1970-01-03') - INTERVAL 3 DAY,
        time_bucket(INTERVAL 3 DAY, time, TIMESTAMP '1970-01-03'), INTERVAL 3 DAY)) AS w FROM obs)
WHERE time < w + INTERVAL 4 DAY"""))
def sliding_windows_(spark, sf):
    return sliding_windows(observations(spark, sf), 4, 3, 2)
