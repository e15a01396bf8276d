"""SQL text shared by the oracles: the stand-ins and the steps of the series recipe."""

from __future__ import annotations

BASE = "https://data.example/dodsC"


def obs(name="obs", station="event_type", unit=None) -> str:
    time = "ts" if unit is None else f"date_trunc('{unit}', ts)"
    return f"""{name} AS (
  SELECT CAST({station} AS VARCHAR) AS station, {time} AS time,
         CASE WHEN value >= 20 THEN value END AS value, event_id AS seq FROM events)"""


def dedupe(src="obs", name="ded") -> str:
    return f"""{name} AS (
  SELECT station, time, value, seq FROM (
    SELECT *, row_number() OVER (PARTITION BY station, time ORDER BY seq) AS rn FROM {src})
  WHERE rn = 1)"""


LINE = "p + (n - p) * (epoch_us(time) - epoch_us(pt)) / (epoch_us(nt) - epoch_us(pt))"


def interpolate(src="ded", name="filled", limit=1) -> str:
    return f"""{name}_rn AS (
  SELECT *, row_number() OVER (PARTITION BY station ORDER BY time) AS rn FROM {src}),
{name}_nb AS (
  SELECT station, time, value, rn,
    last_value(value IGNORE NULLS) OVER back AS p,
    last_value(CASE WHEN value IS NOT NULL THEN time END IGNORE NULLS) OVER back AS pt,
    max(CASE WHEN value IS NOT NULL THEN rn END) OVER back AS prn,
    lead(value IGNORE NULLS) OVER w AS n,
    lead(CASE WHEN value IS NOT NULL THEN time END IGNORE NULLS) OVER w AS nt
  FROM {name}_rn
  WINDOW w AS (PARTITION BY station ORDER BY time),
    back AS (PARTITION BY station ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
{name} AS (
  SELECT station, time,
    CASE WHEN value IS NULL AND p IS NOT NULL AND n IS NOT NULL AND rn - prn <= {limit}
         THEN {LINE} ELSE value END AS value
  FROM {name}_nb)"""


def bucket(minutes=15, time="time") -> str:
    return f"time_bucket(INTERVAL {minutes} MINUTE, {time})"


def resample(src="filled", name="bins", minutes=15) -> str:
    return f"""{name} AS (
  SELECT station, {bucket(minutes)} AS time, arg_min(value, time) AS value
  FROM {src} WHERE value IS NOT NULL GROUP BY 1, 2)"""


def axis(src="obs", name="axis", minutes=15) -> str:
    return f"""{name}_spans AS (
  SELECT station, min({bucket(minutes)}) AS lo, max({bucket(minutes)}) AS hi FROM {src} GROUP BY 1),
{name} AS (
  SELECT DISTINCT unnest(generate_series(lo, hi, INTERVAL {minutes} MINUTE)) AS time
  FROM {name}_spans)"""


def aligned(src="bins", axis_name="axis", stations="axis_spans", name="grid") -> str:
    return f"""{name} AS (
  SELECT s.station, a.time, coalesce(b.value, -99999.0) AS value
  FROM {axis_name} a CROSS JOIN (SELECT DISTINCT station FROM {stations}) s
  LEFT JOIN {src} b ON b.station = s.station AND b.time = a.time)"""


def series(minutes=15) -> str:
    """The whole recipe over an `obs` defined before it, ending in `grid`."""
    return ",\n".join([
        dedupe(), interpolate(), resample(minutes=minutes), axis(minutes=minutes), aligned(),
    ])


def runs(name="runs", shift_years=0) -> str:
    return f"""{name} AS (
  SELECT o_orderkey, CAST(o_orderkey AS INTEGER) AS position, o_orderstatus,
    concat_ws('/', '{BASE}', strftime(o_orderdate, '%Y'), 'nam',
      CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(month(o_orderdate) AS VARCHAR)
           ELSE strftime(o_orderdate - INTERVAL {shift_years} YEAR, '%Y%m%d%H') END,
      lower(replace(substr(o_orderpriority, 3), ' ', '')), 'machine', 'run-' || o_orderkey,
      CASE o_orderstatus WHEN 'F' THEN 'namforecast' WHEN 'O' THEN 'nowcast' ELSE 'nhcOfcl' END,
      'fort.61.nc') AS url
  FROM orders)"""


def model_series(name="series") -> str:
    return f"""{name} AS (
  SELECT url, CAST(l_suppkey AS INTEGER) AS node_idx, l_shipdate AS time,
         max(20000.0 - l_extendedprice) AS zeta
  FROM lineitem JOIN runs ON l_orderkey = o_orderkey GROUP BY 1, 2, 3)"""


def model_nodes(name="nodes") -> str:
    return f"""{name} AS (
  SELECT DISTINCT url, CAST(s_suppkey AS INTEGER) AS node_idx, s_acctbal AS x,
    CAST(s_nationkey AS DOUBLE) AS y, '  S' || s_suppkey || ' ' || s_name || '  ' AS station_name,
    'model-' || s_nationkey AS source
  FROM lineitem JOIN runs ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey)"""


PARTS = """parts AS (
  SELECT *, split_part(url, '/', -6) AS start_token, upper(split_part(url, '/', -5)) AS grid,
    split_part(url, '/', -3) AS instance, split_part(url, '/', -2) AS ensemble,
    CASE WHEN regexp_full_match(split_part(url, '/', -6), '\\d{10}')
         THEN try_strptime(split_part(url, '/', -6), '%Y%m%d%H') END AS start
  FROM runs)"""

CASTS = """casts AS (
  SELECT url, any_value(p.start) AS start, max(s.time) AS last_time,
    CASE WHEN any_value(p.start) IS NULL OR max(s.time) > any_value(p.start)
         THEN 'FORECAST' ELSE 'NOWCAST' END AS "cast"
  FROM parts p JOIN series s USING (url) GROUP BY url)"""

REQUESTED = """requested AS (
  SELECT CAST(c_custkey AS INTEGER) AS position, 'S' || c_custkey AS station FROM customer)"""

USER_REQUEST = """requested AS (
  SELECT CAST(c_custkey AS INTEGER) AS position, CAST(c_custkey AS VARCHAR) AS station
  FROM customer)"""

META = """meta AS (
  SELECT CAST(c_custkey AS VARCHAR) AS STATION,
    CASE WHEN c_acctbal >= 0 THEN CAST(c_nationkey AS DOUBLE) END AS LAT,
    CASE WHEN c_acctbal >= 0 THEN CAST(n_regionkey AS DOUBLE) END AS LON,
    CASE WHEN c_acctbal >= 0 THEN c_name END AS NAME,
    'meters' AS UNITS, 'gmt' AS TZ, 'NOAA/NOS' AS OWNER,
    CASE WHEN c_acctbal >= 0 THEN n_name END AS STATE, CAST(NULL AS VARCHAR) AS COUNTY
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

SENSORS = """sensors AS (
  SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS site_id, 'or-' || l_suppkey AS or_site_id,
    CASE WHEN l_linestatus = 'O' THEN '20' ELSE '94' END AS sensor_class,
    lpad(CAST(l_partkey AS VARCHAR), 12, '0') AS or_sensor_id, 'sensor ' || l_partkey AS location
  FROM lineitem)"""

SITES = """sites AS (
  SELECT 'or-' || s_suppkey AS or_site_id,
    CASE WHEN s_acctbal < 0 THEN '' ELSE CAST(s_nationkey AS VARCHAR) END AS latitude_dec,
    s_acctbal, CASE WHEN s_acctbal < 0 THEN '' ELSE s_name END AS location
  FROM supplier)"""


def with_(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select
