"""Complete collection runs (P2 to P8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import pieces as P
from checks.q_files import (
    land_gauge, land_gauge_days, land_tide, land_tide_days, land_tide_meta, land_xml,
)
from checks.q_runs import MATCHED, part_nodes
from checks.registry import check
from checks.standins import (
    model_nodes, model_series, observations, requested, runs, table, user_request,
)
from gaugeloom.functions.runs import parse_run_url, run_start
from gaugeloom.functions.times import time_slice
from gaugeloom.operators import periods
from gaugeloom.plans import harvests as H
from gaugeloom.plans import windows as W
from gaugeloom.plans.series import ordered_series
from gaugeloom.session import scratch
from gaugeloom.sinks.files import write_model_runs
from gaugeloom.sources import gauge, model, tide
from gaugeloom.streaming.series import merge_batch, merged

START, END = "2024-01-05 03:00:00", "2024-01-12 21:00:00"
SLICE = f"time BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'"


def sliced(value="value", unit="minute", station="user_id"):
    return P.obs("every", station, unit) + f""",
obs AS (SELECT station, time, {value} AS value, seq FROM every WHERE {SLICE})"""


def tide_run(spark, sf, product="water_level", minutes=15):
    obs = tide.read_tide_obs(spark, land_tide(spark, sf), product)
    meta = tide.read_tide_meta(spark, land_tide_meta(spark, sf))
    return H.tide_harvest(obs, meta, user_request(spark, sf), START, END, product, minutes)


@check("tide_harvest", P.with_(sliced(), P.series(), select="SELECT * FROM grid"))
def tide_harvest(spark, sf):
    return tide_run(spark, sf).data


@check("tide_harvest_by_day", P.with_(sliced(), P.series(), select="SELECT * FROM grid"))
def tide_harvest_by_day(spark, sf):
    """Landed in folders by day, of which the run opens those of its range."""
    obs = tide.read_tide_obs(spark, land_tide_days(spark, sf))
    meta = tide.read_tide_meta(spark, land_tide_meta(spark, sf))
    return H.tide_harvest(obs, meta, user_request(spark, sf), START, END).data


@check("tide_harvest_files", P.with_(sliced(), P.series(), select="""
SELECT strftime(time, '%Y-%m-%dT%H:%M:%S') AS "TIME", station AS "STATION", value AS "WATER_LEVEL" FROM grid"""))
def tide_harvest_files(spark, sf):
    """A whole run written and read back."""
    path, _ = tide_run(spark, sf).write(scratch(spark, "run"))
    return spark.read.csv(path, header=True, schema="TIME string, STATION string, WATER_LEVEL double")


@check("ordered_native_series", P.with_(P.obs(), P.dedupe(), P.interpolate(), "axis AS (SELECT DISTINCT time FROM ded)",
    P.aligned("filled", stations="ded"), select="SELECT * FROM grid"))
def ordered_native_series(spark, sf):
    """Native times, unfolded in order."""
    return ordered_series(observations(spark, sf), minutes=0)


@check("tide_harvest_meta", P.with_(P.META, select="SELECT * FROM meta"))
def tide_harvest_meta(spark, sf):
    return tide_run(spark, sf).meta


@check("tide_harvest_excluded", P.with_(sliced(), P.USER_REQUEST, select="""
SELECT station, coalesce(n, 0) AS rows, coalesce(valid, 0) AS valid,
  CASE WHEN coalesce(n, 0) = 0 THEN 'no data' WHEN valid = 0 THEN 'no valid values'
       ELSE 'too few points to repair gaps' END AS reason
FROM requested LEFT JOIN (SELECT station, count(*) AS n, count(value) AS valid FROM obs GROUP BY 1) USING (station)
WHERE coalesce(valid, 0) < 2"""))
def tide_harvest_excluded(spark, sf):
    return tide_run(spark, sf).excluded


@check("alternate_product_harvest", P.with_(sliced("value / 2"), P.series(60), select="SELECT * FROM grid"))
def alternate_product_harvest(spark, sf):
    return tide_run(spark, sf, "predictions", 60).data


# --- river and coastal gauges -----------------------------------------------------------------

def gauge_sensors(spark, sf):
    code = F.when(F.col("value") >= 50, "20").otherwise("94")
    return table(spark, sf, "events").groupBy(
        F.col("event_type").alias("site_id"), code.alias("sensor_class")
    ).agg(F.min("user_id").alias("u")).select(
        "site_id", F.concat(F.lit("or-"), F.col("site_id")).alias("or_site_id"), "sensor_class",
        F.col("sensor_class").alias("or_sensor_id"),
        F.concat(F.lit("at "), F.col("site_id"), F.lit(" "), F.col("sensor_class")).alias("location"),
    )


def gauge_sites(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(
        F.min("user_id").cast("string").alias("latitude_dec"),
        F.max("user_id").cast("string").alias("longitude_dec"),
    ).select(
        F.concat(F.lit("or-"), F.col("event_type")).alias("or_site_id"), "latitude_dec",
        "longitude_dec", F.col("event_type").alias("location"),
    )


def gauge_run(spark, sf, product, land=land_gauge, **how):
    """All landed classes are read; the plan takes the product's own."""
    kinds = table(spark, sf, "events").select(
        F.lit(0).alias("position"), F.col("event_type").alias("station")
    ).distinct()
    return H.gauge_harvest(
        gauge.read_gauge_obs(spark, land(spark, sf)),
        gauge.read_gauge_sensor_meta(spark, land_xml(spark, gauge_sensors(spark, sf), "sensors")),
        gauge.read_gauge_site_meta(spark, land_xml(spark, gauge_sites(spark, sf), "sites")),
        kinds, START, END, product, **how,
    )


def gauge_obs(test):
    return f"""obs AS (
  SELECT event_type AS station, ts AS time, CASE WHEN value >= 20 THEN value END * 0.3048::DOUBLE AS value,
    0 AS seq FROM events WHERE ts BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}' AND value {test} 50)"""


@check("gauge_harvest_river", P.with_(gauge_obs(">="), P.series(), select="SELECT * FROM grid"))
def gauge_harvest_river(spark, sf):
    return gauge_run(spark, sf, "river_water_level").data


@check("gauge_harvest_coastal", P.with_(gauge_obs("<"), P.series(), select="SELECT * FROM grid"))
def gauge_harvest_coastal(spark, sf):
    return gauge_run(spark, sf, "coastal_water_level").data


@check("gauge_harvest_meta", """
SELECT event_type AS "STATION", CAST(min(user_id) AS DOUBLE) AS "LAT", CAST(max(user_id) AS DOUBLE) AS "LON",
  'at ' || event_type || ' 20' AS "NAME", 'meters' AS "UNITS", 'gmt' AS "TZ", 'NCEM' AS "OWNER",
  CAST(NULL AS VARCHAR) AS "STATE", CAST(NULL AS VARCHAR) AS "COUNTY"
FROM events GROUP BY event_type HAVING max(value) >= 50""")
def gauge_harvest_meta(spark, sf):
    return gauge_run(spark, sf, "river_water_level").meta


@check("gauge_plan", """
WITH days AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-05', TIMESTAMP '2024-01-12', INTERVAL 1 DAY)) AS day),
periods AS (SELECT greatest(day, TIMESTAMP '2024-01-05 03:00:00') AS period_start,
  least(day + INTERVAL 86399 SECOND, TIMESTAMP '2024-01-12 21:00:00') AS period_end FROM days)
SELECT CAST(c_custkey AS INTEGER) AS position, CAST(c_custkey AS VARCHAR) AS station, period_start, period_end,
  'method=GetSensorData&class=94&site_id=' || c_custkey || '&tz=gmt&data_start='
  || replace(url_encode(strftime(period_start, '%Y-%m-%d %H:%M:%S')), '%20', '+') || '&data_end='
  || replace(url_encode(strftime(period_end, '%Y-%m-%d %H:%M:%S')), '%20', '+') AS query
FROM customer CROSS JOIN periods""")
def gauge_plan(spark, sf):
    return H.gauge_plan(user_request(spark, sf), START, END, "coastal_water_level")


@check("capped_requests", """
SELECT CAST(user_id AS VARCHAR) AS station, greatest(date_trunc('day', ts), TIMESTAMP '2024-01-05 03:00:00') AS period_start,
  least(date_trunc('day', ts) + INTERVAL 86399 SECOND, TIMESTAMP '2024-01-12 21:00:00') AS period_end,
  count(*) AS rows, count(*) >= 4 AS at_cap
FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05 03:00:00' AND TIMESTAMP '2024-01-12 21:00:00' GROUP BY 1, 2, 3""")
def capped_requests(spark, sf):
    plan = H.gauge_plan(user_request(spark, sf), START, END)
    return H.capped_requests(observations(spark, sf, "user_id"), plan, cap=4)


@check("gauge_harvest_by_day", P.with_(gauge_obs(">="), P.series(), select="SELECT * FROM grid"))
def gauge_harvest_by_day(spark, sf):
    return gauge_run(spark, sf, "river_water_level", land_gauge_days).data


CAP = 5


def gauge_round(spark, sf):
    """A round of requests for all kinds of events and one more station, with a low cap."""
    kinds = table(spark, sf, "events").select(F.lit(0).alias("position"), F.col("event_type").alias("station")).distinct()
    asked = kinds.unionByName(spark.createDataFrame([(1, "nowhere")], kinds.schema))
    plan = H.gauge_plan(asked, START, END)
    return plan, gauge_run(spark, sf, "river_water_level", plan=plan, cap=CAP)


LEDGER = (f"""days AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-05', TIMESTAMP '2024-01-12', INTERVAL 1 DAY)) AS day),
periods AS (SELECT greatest(day, TIMESTAMP '{START}') AS period_start,
  least(day + INTERVAL 86399 SECOND, TIMESTAMP '{END}') AS period_end, day FROM days),
kinds AS (SELECT DISTINCT event_type AS station FROM events UNION ALL SELECT 'nowhere'),
ledger AS (SELECT k.station, period_start, period_end, count(e.ts) AS rows,
  CASE WHEN count(e.ts) = 0 THEN 'missing' WHEN count(e.ts) >= {CAP} THEN 'full' ELSE 'done' END AS status
  FROM kinds k CROSS JOIN periods p LEFT JOIN events e ON e.event_type = k.station AND e.value >= 50
    AND e.ts BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}' AND date_trunc('day', e.ts) = p.day
  GROUP BY ALL)""",)


@check("request_ledger", P.with_(*LEDGER, select="SELECT * FROM ledger"))
def request_ledger(spark, sf):
    """Missing, full and done requests of a round."""
    ledger = gauge_round(spark, sf)[1].ledger
    return ledger.select("station", "period_start", "period_end", "rows", "status")


@check("next_requests", P.with_(*LEDGER, """half AS (
  SELECT *, make_timestamp(CAST(floor((epoch(period_start) + epoch(period_end)) / 2) AS BIGINT) * 1000000) AS middle
  FROM ledger)""", select="""
SELECT station, period_start, period_end FROM half WHERE status = 'missing'
UNION ALL SELECT station, period_start, middle FROM half WHERE status = 'full'
UNION ALL SELECT station, middle, period_end FROM half WHERE status = 'full'"""))
def next_requests(spark, sf):
    return periods.next_requests(gauge_round(spark, sf)[1].ledger).select("station", "period_start", "period_end")


@check("gauge_harvest_planned", P.with_(gauge_obs(">="), P.series(), select="SELECT * FROM grid"))
def gauge_harvest_planned(spark, sf):
    """Read by the second round's plan beside the first one's: halves overlap in a second, and nothing is lost."""
    plan, first = gauge_round(spark, sf)
    again = H.gauge_requests(periods.next_requests(first.ledger), "Stage")
    both = plan.where(F.col("station") != "nowhere").unionByName(again.select(*plan.columns))
    return gauge_run(spark, sf, "river_water_level", plan=both).data


# --- ocean model ------------------------------------------------------------------------------

SHIFT = 10  # years by which the run starts precede the series, so that the batch is all forecast
RUN_SET = (P.runs(shift_years=SHIFT), P.model_series(), P.model_nodes(), P.REQUESTED, MATCHED)


def model_rows(pairs, run_filter="true"):
    return f"""pairs AS ({pairs}),
obs AS (
  SELECT p.station, s.time, CASE WHEN s.zeta >= -1000 THEN s.zeta END AS value, (r.position, s.node_idx) AS seq
  FROM series s JOIN runs r USING (url) JOIN pairs p ON p.node_idx = s.node_idx WHERE {run_filter})"""


NATIVE = ",\n".join([
    P.dedupe(), P.interpolate(), "axis AS (SELECT DISTINCT time FROM ded)",
    P.aligned("filled", stations="ded"),
])
PAIRS = "SELECT DISTINCT station, node_idx FROM matched"


def model_inputs(spark, sf):
    return runs(spark, sf, SHIFT), model_nodes(spark, sf, SHIFT), model_series(spark, sf, SHIFT)


@check("model_harvest", P.with_(*RUN_SET, model_rows(PAIRS), NATIVE, select="SELECT * FROM grid"))
def model_harvest(spark, sf):
    return H.model_harvest(*model_inputs(spark, sf), requested(spark, sf)).data


@check("model_harvest_by_run", P.with_(*RUN_SET, P.PARTS, """listed AS (
  SELECT * FROM parts WHERE start BETWEEN TIMESTAMP '1985-01-01' AND TIMESTAMP '1985-12-31'),
pairs AS (SELECT DISTINCT station, node_idx FROM matched WHERE url IN (SELECT url FROM listed)),
obs AS (
  SELECT p.station, s.time, CASE WHEN s.zeta >= -1000 THEN s.zeta END AS value, (r.position, s.node_idx) AS seq
  FROM series s JOIN listed r USING (url) JOIN pairs p ON p.node_idx = s.node_idx)""", NATIVE, select="SELECT * FROM grid"))
def model_harvest_by_run(spark, sf):
    """Runs landed in folders by day; a list of one year's runs opens its days only."""
    batch, nodes, series = model_inputs(spark, sf)
    landed = model.read_model_runs(spark, write_model_runs(series, scratch(spark, "model")))
    start = run_start(parse_run_url("url")["start_token"])
    year = batch.where(time_slice(start, "1985-01-01 00:00:00", "1985-12-31 00:00:00"))
    return H.model_harvest(year, nodes, landed, requested(spark, sf)).data


@check("model_meta_with_cast", P.with_(*RUN_SET, P.PARTS, P.CASTS, select="""
SELECT p.station AS "STATION", (SELECT arg_min(grid || '_' || upper(ensemble), position) FROM parts) AS "NAME",
  (SELECT min("cast") FROM casts) AS "CAST"
FROM (SELECT DISTINCT station, node_idx FROM matched) p"""))
def model_meta_with_cast(spark, sf):
    """The cast that the series show, beside the ensemble that the URL names."""
    return H.model_harvest(*model_inputs(spark, sf), requested(spark, sf)).meta_with_cast.select("STATION", "NAME", "CAST")


@check("model_harvest_meta", P.with_(*RUN_SET, P.PARTS, select="""
SELECT p.station AS "STATION", f.y AS "LAT", f.x AS "LON",
  (SELECT arg_min(grid || '_' || upper(ensemble), position) FROM parts) AS "NAME",
  'meters' AS "UNITS", 'gmt' AS "TZ", f.source AS "OWNER", CAST(NULL AS VARCHAR) AS "STATE", CAST(NULL AS VARCHAR) AS "COUNTY"
FROM (SELECT DISTINCT station, node_idx FROM matched) p JOIN (
  SELECT n.*, row_number() OVER (PARTITION BY n.node_idx ORDER BY r.position) AS rn
  FROM nodes n JOIN runs r USING (url)) f USING (node_idx) WHERE rn = 1"""))
def model_harvest_meta(spark, sf):
    return H.model_harvest(*model_inputs(spark, sf), requested(spark, sf)).meta


@check("model_harvest_mesh", P.with_(*RUN_SET, model_rows(
    "SELECT 'P' || p_partkey AS station, p_partkey AS node_idx FROM part"), NATIVE, select="SELECT * FROM grid"))
def model_harvest_mesh(spark, sf):
    return H.model_harvest(
        *model_inputs(spark, sf), station_nodes=part_nodes(spark, sf)
    ).data


@check("unmatched_nodes", P.with_(P.runs(shift_years=SHIFT), P.model_series(), select="""
SELECT 'P' || p_partkey AS station FROM part WHERE p_partkey NOT IN (
  SELECT node_idx FROM series JOIN (SELECT url FROM runs WHERE o_orderstatus = 'O') USING (url))"""))
def unmatched_nodes(spark, sf):
    """Nodes that only runs outside the list have count as missing."""
    batch, nodes, series = model_inputs(spark, sf)
    listed = batch.where(F.col("url").contains("/nowcast/"))
    return H.model_harvest(listed, nodes, series, station_nodes=part_nodes(spark, sf)).unmatched


@check("forecast_nowcast_pair", P.with_(P.runs(shift_years=SHIFT), P.model_series(), """asked AS (
  SELECT 'forecast' AS kind, url FROM runs UNION ALL
  SELECT 'nowcast', replace(url, '/' || split_part(url, '/', -2) || '/', '/nowcast/') FROM runs)""", select="""
SELECT kind, count(*) AS runs_asked, count(*) FILTER (url IN (SELECT url FROM series)) AS runs_present,
  count(*) FILTER (url IN (SELECT url FROM series)) = 0 AS failed FROM asked GROUP BY 1"""))
def forecast_nowcast_pair(spark, sf):
    return H.forecast_nowcast_pair(*model_inputs(spark, sf), requested(spark, sf)).status


@check("forecast_nowcast_pair_nowcast", P.with_(
    *RUN_SET, model_rows(PAIRS, "r.o_orderstatus = 'O'"), NATIVE, select="SELECT * FROM grid"))
def forecast_nowcast_pair_nowcast(spark, sf):
    return H.forecast_nowcast_pair(*model_inputs(spark, sf), requested(spark, sf)).nowcast.data


# --- backfill ---------------------------------------------------------------------------------

WINDOWS = [(f"2024-01-{1 + 3 * i:02d} 00:00:00", f"2024-01-{5 + 3 * i:02d} 00:00:00") for i in range(5)]


def window_sql(i, start, end):
    """One window's whole recipe, its names marked with the window's number."""
    slice_ = f"time BETWEEN TIMESTAMP '{start}' AND TIMESTAMP '{end}'"
    return ",\n".join([
        f"w{i} AS (SELECT * FROM every WHERE {slice_})",
        P.dedupe(f"w{i}", f"d{i}"), P.interpolate(f"d{i}", f"f{i}"), P.resample(f"f{i}", f"b{i}", 60),
        P.axis(f"w{i}", f"x{i}", 60), P.aligned(f"b{i}", f"x{i}", f"x{i}_spans", f"g{i}"),
    ])


MERGED_WINDOWS = """
SELECT station, time, arg_min(value, (value = -99999.0, k)) AS value FROM (""" + " UNION ALL ".join(
    f"SELECT *, {i} AS k FROM g{i}" for i in range(len(WINDOWS))) + ") GROUP BY 1, 2"


@check("backfill", P.with_(
    P.obs("every", "user_id", "minute"), *[window_sql(i, *w) for i, w in enumerate(WINDOWS)], select=MERGED_WINDOWS))
def backfill(spark, sf):
    obs = tide.read_tide_obs(spark, land_tide(spark, sf))
    meta = tide.read_tide_meta(spark, land_tide_meta(spark, sf))
    asked = user_request(spark, sf)
    return W.backfill(
        WINDOWS, lambda start, end: H.tide_harvest(obs, meta, asked, start, end, minutes=60)
    )


@check("backfill_gauges", P.with_("""every AS (
  SELECT event_type AS station, ts AS time, CASE WHEN value >= 20 THEN value END * 0.3048::DOUBLE AS value, 0 AS seq
  FROM events WHERE value >= 50)""", *[window_sql(i, *w) for i, w in enumerate(WINDOWS)], select=MERGED_WINDOWS))
def backfill_gauges(spark, sf):
    """River gauges in overlapping windows, by the hour."""
    obs = gauge.read_gauge_obs(spark, land_gauge(spark, sf), "river_water_level")
    sensors = gauge.read_gauge_sensor_meta(spark, land_xml(spark, gauge_sensors(spark, sf), "sensors"))
    sites = gauge.read_gauge_site_meta(spark, land_xml(spark, gauge_sites(spark, sf), "sites"))
    kinds = table(spark, sf, "events").select(F.lit(0).alias("position"), F.col("event_type").alias("station")).distinct()
    return W.backfill(WINDOWS, lambda start, end: H.gauge_harvest(obs, sensors, sites, kinds, start, end, minutes=60))


RUN_WINDOWS = [(f"{1983 + 2 * i}-01-01 00:00:00", f"{1985 + 2 * i}-12-31 00:00:00") for i in range(2)]


def run_window_sql(i, start, end):
    """The recipe over the runs that start in one window, at their own times."""
    return f"""o{i} AS (
  SELECT p.station, s.time, CASE WHEN s.zeta >= -1000 THEN s.zeta END AS value, (r.position, s.node_idx) AS seq
  FROM series s JOIN parts r USING (url) JOIN pairs p ON p.node_idx = s.node_idx
  WHERE r.start BETWEEN TIMESTAMP '{start}' AND TIMESTAMP '{end}'),
""" + ",\n".join([
        P.dedupe(f"o{i}", f"d{i}"), P.interpolate(f"d{i}", f"f{i}"), f"x{i} AS (SELECT DISTINCT time FROM d{i})",
        P.aligned(f"f{i}", f"x{i}", f"d{i}", f"g{i}"),
    ])


@check("backfill_runs", P.with_(
    *RUN_SET, P.PARTS, f"pairs AS ({PAIRS})", *[run_window_sql(i, *w) for i, w in enumerate(RUN_WINDOWS)], select="""
SELECT station, time, arg_min(value, (value = -99999.0, k)) AS value FROM (
  SELECT *, 0 AS k FROM g0 UNION ALL SELECT *, 1 AS k FROM g1) GROUP BY 1, 2"""))
def backfill_runs(spark, sf):
    """Model runs of two windows that share a year, merged."""
    return W.backfill_runs(RUN_WINDOWS, *model_inputs(spark, sf), requested(spark, sf))


def merged_part(name, numbers):
    return f"{name} AS (SELECT station, time, arg_min(value, (value = -99999.0, k)) AS value FROM (" + " UNION ALL ".join(
        f"SELECT *, {i} AS k FROM g{i}" for i in numbers) + ") GROUP BY 1, 2)"


@check("backfill_into_table", P.with_(
    P.obs("every", "user_id", "minute"), *[window_sql(i, *w) for i, w in enumerate(WINDOWS)],
    merged_part("old", range(3)), merged_part("new", range(3, 5)), select="""
SELECT * FROM old UNION ALL SELECT * FROM new ANTI JOIN old USING (station, time)"""))
def backfill_into_table(spark, sf):
    """Two backfills merged into one table: rows that it has stay, new ones are added."""
    table_path = scratch(spark, "backfilled")
    obs = tide.read_tide_obs(spark, land_tide(spark, sf))
    meta = tide.read_tide_meta(spark, land_tide_meta(spark, sf))
    asked = user_request(spark, sf)
    for n, part in enumerate((WINDOWS[:3], WINDOWS[3:])):
        found = W.backfill(part, lambda start, end: H.tide_harvest(obs, meta, asked, start, end, minutes=60))
        merge_batch(found, n, table_path)
    return merged(spark, table_path)
