"""Sources, sinks and streams (A, B, K, L): tables are landed in the scratch folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import pieces as P
from checks.registry import check
from checks.standins import (
    customer_meta, model_nodes, model_series, observations, runs, sensors, sites, table,
    user_request,
)
from gaugeloom.operators.dedupe import dedupe_keep_first
from gaugeloom.plans.series import harvest_series
from gaugeloom.schema import META_KEYS, STATION_NODE_TYPES, TIDE_OBS_SCHEMA
from gaugeloom.session import scratch
from gaugeloom.sinks import files as W
from gaugeloom.sources import gauge, lists, model, tide
from gaugeloom.sources.registry import SourceRegistry, standard_sources
from gaugeloom.streaming import table as live_table
from gaugeloom.streaming.series import append_to, merge_stream, merged, stream_resample


# --- lists ------------------------------------------------------------------------------------

@check("read_station_list", """
SELECT CAST(row_number() OVER (ORDER BY c_custkey) - 1 AS INTEGER) AS position, 'S' || c_custkey AS station FROM customer""")
def read_station_list(spark, sf):
    """Customers as a folder of lists in order, each file with its comment line, blanks behind the ids."""
    path = scratch(spark, "lists")
    line = F.concat(F.lit("S"), F.col("c_custkey"), F.lit("  ")).alias("# stations of one list")
    rows = table(spark, sf, "customer").repartitionByRange(7, "c_custkey").sortWithinPartitions("c_custkey")
    rows.select(line).write.option("ignoreTrailingWhiteSpace", False).csv(path, header=True)
    return lists.read_station_list(spark, path)


@check("read_station_nodes", """
SELECT CAST(p_partkey + 1 AS INTEGER) AS serial_nr, 'P' || p_partkey AS stationid, p_name AS stationname,
  p_type AS state, p_brand AS source, 'MSL' AS vertical_datum, p_retailprice AS "NOAA lon",
  CAST(p_size AS DOUBLE) AS "NOAA lat", CASE WHEN p_size >= 10 THEN CAST(p_size AS DOUBLE) END AS "navd_to_msl [ft]",
  CASE WHEN p_size >= 10 THEN CAST(p_size AS DOUBLE) END AS "navd_to_msl [m]", 'gage' AS "Datum Source",
  p_retailprice AS lon, CAST(p_size AS DOUBLE) AS lat, p_retailprice AS bathy,
  CAST(p_partkey AS INTEGER) AS "Element", CAST(p_partkey + 1 AS INTEGER) AS "Node" FROM part""")
def read_station_nodes(spark, sf):
    path = scratch(spark, "nodes")
    size = F.col("p_size").cast("double")
    shift = F.when(F.col("p_size") >= 10, size)
    values = [
        F.col("p_partkey") + 1, F.concat(F.lit("P"), F.col("p_partkey")), F.col("p_name"),
        F.col("p_type"), F.col("p_brand"), F.lit("MSL"), F.col("p_retailprice"), size, shift, shift,
        F.lit("gage"), F.col("p_retailprice"), size, F.col("p_retailprice"), F.col("p_partkey"),
        F.col("p_partkey") + 1,
    ]
    rows = table(spark, sf, "part").select(
        *[v.cast("string").alias(c) for v, c in zip(values, STATION_NODE_TYPES)]
    )
    units = spark.range(1).select(*[F.lit("-").alias(c) for c in STATION_NODE_TYPES])
    units.unionByName(rows).write.csv(path, header=True, nullValue="NaN")
    return lists.read_station_nodes(spark, path)


@check("stations_for_grid", """
SELECT 'tide' AS kind, CAST(s_suppkey AS INTEGER) AS position, CAST(s_suppkey AS VARCHAR) AS station
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'
UNION ALL SELECT 'gauge', CAST(c_custkey AS INTEGER), CAST(c_custkey AS VARCHAR) FROM customer""")
def stations_for_grid(spark, sf):
    path = scratch(spark, "registry")
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    grids = nation.join(region, nation.n_regionkey == region.r_regionkey)
    supplier = table(spark, sf, "supplier")
    tides = supplier.join(grids, supplier.s_nationkey == grids.n_nationkey).select(
        F.col("r_name").alias("grid"), F.lit("tide").alias("kind"),
        F.col("s_suppkey").alias("position"), F.col("s_suppkey").alias("id"),
    )
    gauges = table(spark, sf, "customer").select(
        F.lit("").alias("grid"), F.lit("gauge").alias("kind"),
        F.col("c_custkey").alias("position"), F.col("c_custkey").alias("id"),
    )
    tides.unionByName(gauges).write.csv(path, header=True)
    registry = lists.read_registry(spark, path)
    found = [
        lists.stations_for_grid(registry, grid, kind).withColumn("kind", F.lit(kind))
        for grid, kind in (("asia", "tide"), ("asia", "gauge"), ("nowhere", "tide"))
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


# --- tide gauges ------------------------------------------------------------------------------

def land_tide(spark, sf) -> str:
    """Events as tide answers: one column per product, times to the minute."""
    path = scratch(spark, "tide")
    observations(spark, sf, "user_id", "minute").select(
        "station", F.col("time").alias("date_time"), F.col("value").alias("water_level"),
        (F.col("value") / 2).alias("predicted_wl"), F.lit(1013.0).alias("air_press"),
        F.lit(0.0).alias("spd"), "seq",
    ).write.json(path)
    return path


def land_tide_days(spark, sf) -> str:
    """The same answers in folders by day."""
    rows = spark.read.schema(TIDE_OBS_SCHEMA).json(land_tide(spark, sf))
    return W.write_landed(rows, scratch(spark, "tide-days"))


def land_tide_meta(spark, sf) -> str:
    path = scratch(spark, "tide-meta")
    customer_meta(spark, sf).write.json(path)
    return path


@check("read_tide_obs", P.with_(P.obs(station="user_id", unit="minute"), select="SELECT * FROM obs"))
def read_tide_obs(spark, sf):
    return tide.read_tide_obs(spark, land_tide(spark, sf))


@check("read_tide_meta", P.with_(P.META, select="SELECT * FROM meta"))
def read_tide_meta(spark, sf):
    return tide.read_tide_meta(spark, land_tide_meta(spark, sf))


@check("source_registry", P.with_(
    P.obs(station="user_id", unit="minute"), P.series(60), select="SELECT * FROM grid"))
def source_registry(spark, sf):
    registry = SourceRegistry()
    registry.register("tide", tide.read_tide_obs, tide.read_tide_meta)
    return registry.series(spark, "TIDE", land_tide(spark, sf), minutes=60)


@check("standard_source_tide", P.with_(
    P.obs(station="user_id", unit="minute"), P.series(60), select="SELECT * FROM grid"))
def standard_source_tide(spark, sf):
    return standard_sources().series(spark, "noaa", land_tide(spark, sf), minutes=60)


NAMED = """named AS (
  SELECT url, split_part(trim(station_name), ' ', 1) AS station, min(node_idx) AS node_idx FROM nodes GROUP BY 1, 2)"""


def land_model(spark, sf) -> str:
    path = scratch(spark, "model")
    model_series(spark, sf).write.parquet(f"{path}/series")
    model_nodes(spark, sf).write.parquet(f"{path}/nodes")
    return path


@check("standard_source_model", P.with_(P.runs(), P.model_series(), P.model_nodes(), P.PARTS, NAMED, """obs AS (
  SELECT station, time, CASE WHEN zeta >= -1000 THEN zeta END AS value,
    (coalesce(p.start, TIMESTAMP '1970-01-01'), s.url, s.node_idx) AS seq
  FROM series s JOIN named n ON n.url = s.url AND n.node_idx = s.node_idx JOIN parts p ON p.url = s.url)""",
    P.series(1440), select="SELECT * FROM grid"))
def standard_source_model(spark, sf):
    """All landed runs as one source, by the day."""
    return standard_sources().series(spark, "asgs", land_model(spark, sf), minutes=1440)


@check("standard_source_model_meta", P.with_(P.runs(), P.model_nodes(), P.PARTS, NAMED, """first AS (
  SELECT n.station, min(n.url) AS url FROM named n GROUP BY 1)""", select="""
SELECT f.station AS "STATION", d.y AS "LAT", d.x AS "LON", p.grid || '_' || upper(p.ensemble) AS "NAME",
  'meters' AS "UNITS", 'gmt' AS "TZ", d.source AS "OWNER", CAST(NULL AS VARCHAR) AS "STATE", CAST(NULL AS VARCHAR) AS "COUNTY"
FROM first f JOIN named n USING (station, url) JOIN nodes d ON d.url = f.url AND d.node_idx = n.node_idx JOIN parts p ON p.url = f.url"""))
def standard_source_model_meta(spark, sf):
    return standard_sources().metadata(spark, "asgs", land_model(spark, sf))


# --- river and coastal gauges -----------------------------------------------------------------

def land_gauge(spark, sf) -> str:
    """Events as gauge answers: two sensor classes by value, a folder per class and station."""
    code = F.when(F.col("value") >= 50, 20).otherwise(94)
    rows = table(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("data_time"),
        F.when(F.col("value") >= 20, F.col("value")).alias("data_value"),
        code.alias("class"),
        F.col("event_type").alias("station"),
    )
    return W.write_xml(rows, scratch(spark, "gauge"), ("class", "station"))


def land_gauge_days(spark, sf) -> str:
    """Gauge answers with a folder for each class, station and day."""
    code = F.when(F.col("value") >= 50, 20).otherwise(94)
    rows = table(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("data_time"),
        F.when(F.col("value") >= 20, F.col("value")).alias("data_value"), code.alias("class"), F.col("event_type").alias("station"),
    )
    return W.write_landed(
        rows, scratch(spark, "gauge-days"), "xml", "data_time", ("class", "station"), rootTag="general", rowTag="row"
    )


def land_xml(spark, rows, name) -> str:
    return W.write_xml(rows, scratch(spark, name))


@check("read_gauge_obs", """
SELECT event_type AS station, CASE WHEN value >= 50 THEN 20 ELSE 94 END AS class, ts AS time,
  CASE WHEN value >= 20 THEN value END AS value FROM events""")
def read_gauge_obs(spark, sf):
    return gauge.read_gauge_obs(spark, land_gauge(spark, sf)).drop("seq")


@check("gauge_first_of_repeats", P.with_(P.obs(unit="hour"), P.dedupe(), select="SELECT station, time, value FROM ded"))
def gauge_first_of_repeats(spark, sf):
    """Gauge answers that repeat times: the provider's first row stays."""
    answers = observations(spark, sf, unit="hour").select(
        F.date_format("time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("data_time"), F.col("value").alias("data_value"), "seq",
        F.lit(20).alias("class"), "station",
    )
    path = W.write_xml(answers, scratch(spark, "gauge"), ("class", "station"))
    rows = gauge.read_gauge_obs(spark, path, "river_water_level").drop("class")
    return dedupe_keep_first(rows).drop("seq")


@check("read_gauge_sensor_meta", P.with_(P.SENSORS, select="SELECT * FROM sensors"))
def read_gauge_sensor_meta(spark, sf):
    return gauge.read_gauge_sensor_meta(spark, land_xml(spark, sensors(spark, sf), "sensors"))


@check("read_gauge_site_meta", P.with_(P.SITES, select="""
SELECT or_site_id, nullif(latitude_dec, '') AS latitude_dec, CAST(s_acctbal AS VARCHAR) AS longitude_dec,
  nullif(location, '') AS location FROM sites"""))
def read_gauge_site_meta(spark, sf):
    return gauge.read_gauge_site_meta(spark, land_xml(spark, sites(spark, sf), "sites"))


# --- ocean model ------------------------------------------------------------------------------

def land_series(spark, sf) -> str:
    path = scratch(spark, "series")
    model_series(spark, sf).repartitionByRange("node_idx", "url", "time").write.parquet(path)
    return path


@check("read_model_series", P.with_(P.runs(), P.model_series(), select="""
SELECT * FROM series WHERE node_idx IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)"""))
def read_model_series(spark, sf):
    solvent = table(spark, sf, "supplier").where("s_acctbal >= 0")
    nodes = solvent.select(F.col("s_suppkey").cast("int").alias("node_idx"))
    return model.read_model_series(spark, land_series(spark, sf), nodes)


@check("read_model_nodes", P.with_(P.runs(), P.model_nodes(), select="SELECT * FROM nodes"))
def read_model_nodes(spark, sf):
    path = scratch(spark, "model-nodes")
    model_nodes(spark, sf).write.parquet(path)
    return model.read_model_nodes(spark, path)


@check("model_array_to_rows", P.with_(P.runs(), P.model_series(), select="SELECT * FROM series"))
def model_array_to_rows(spark, sf):
    steps = F.array_sort(F.collect_list(F.struct("time", "zeta")))
    arrays = model_series(spark, sf).groupBy("url", "node_idx").agg(steps.alias("steps"))
    return model.model_array_to_rows(
        arrays.select("url", "node_idx", F.col("steps.time").alias("time"), F.col("steps.zeta").alias("zeta"))
    )


@check("scan_if_present", P.with_(P.runs(), P.model_series(), select="""
SELECT position, url FROM runs WHERE url IN (SELECT url FROM series)"""))
def scan_if_present(spark, sf):
    landed = model.read_model_series(spark, land_series(spark, sf))
    return model.scan_if_present(runs(spark, sf), landed)


# --- sinks ------------------------------------------------------------------------------------

@check("write_long", P.with_(P.obs(station="user_id", unit="minute"), P.series(60), select="""
SELECT strftime(time, '%Y-%m-%dT%H:%M:%S') AS "TIME", station AS "STATION", value AS "WATER_LEVEL" FROM grid"""))
def write_long(spark, sf):
    data = harvest_series(observations(spark, sf, "user_id", "minute"), 60)
    path = W.write_long(
        data, scratch(spark, "out"), "NOAA", "2024-01-31T00:00:00", requested=user_request(spark, sf)
    )
    return spark.read.csv(path, schema="TIME string, STATION string, WATER_LEVEL double", header=True)


@check("write_meta", P.with_(P.META, select="""
SELECT STATION, """ + ", ".join(f"coalesce(CAST({k} AS VARCHAR), '-99999') AS {k}" for k in META_KEYS)
    + " FROM meta"))
def write_meta(spark, sf):
    meta = tide.read_tide_meta(spark, land_tide_meta(spark, sf))
    path = W.write_meta(meta, scratch(spark, "out"), "NOAA", "2024-01-31T00:00:00")
    schema = ", ".join(f"{c} string" for c in ["STATION", *META_KEYS])
    return spark.read.csv(path, schema=schema, header=True)


@check("write_partitioned", """
SELECT CAST(user_id AS VARCHAR) AS station, ts AS time, value, event_type AS source,
  strftime(ts, '%Y-%m-%d') AS run_date FROM events""")
def write_partitioned(spark, sf):
    rows = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("station"), F.col("ts").alias("time"), "value",
        F.col("event_type").alias("source"), F.to_date("ts").alias("run_date"),
    )
    written = spark.read.parquet(W.write_partitioned(rows, scratch(spark, "parts")))
    return written.withColumn("run_date", F.date_format("run_date", "yyyy-MM-dd"))


# --- streams ----------------------------------------------------------------------------------

@check("stream_resample", P.with_(P.obs(), P.resample("obs"), select="""
SELECT * FROM bins
WHERE time + INTERVAL 15 MINUTE <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 2 DAY FROM events)"""))
def stream_resample_(spark, sf):
    events = table(spark, sf, "events")
    stream = (
        spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    )
    obs = stream.select(
        F.col("event_type").alias("station"), F.col("ts").alias("time"),
        F.when(F.col("value") >= 20, F.col("value")).alias("value"),
    )
    out = scratch(spark, "bins")
    append_to(stream_resample(obs), out, scratch(spark, "bins-state")).awaitTermination()
    return spark.read.schema("station string, time timestamp_ntz, value double").parquet(out)


@check("stream_resample_repeats", P.with_(P.obs(unit="minute"), P.dedupe(), P.resample("ded"), select="""
SELECT * FROM bins
WHERE time + INTERVAL 15 MINUTE <= (SELECT max(time) - INTERVAL 2 DAY FROM obs)"""))
def stream_resample_repeats(spark, sf):
    """Times cut to the minute repeat; the landed files hold later rows before earlier ones."""
    landing, out = scratch(spark, "landing"), scratch(spark, "bins")
    rows = observations(spark, sf, unit="minute")
    rows.repartitionByRange(F.desc("seq")).sortWithinPartitions(F.desc("seq")).write.parquet(landing)
    stream = spark.readStream.schema(rows.schema).parquet(landing)
    append_to(stream_resample(stream), out, scratch(spark, "bins-state")).awaitTermination()
    return spark.read.schema("station string, time timestamp_ntz, value double").parquet(out)


@check("stream_merge", P.with_(P.obs("old", unit="hour"), P.obs("new", unit="minute"),
    P.dedupe("old", "a"), P.dedupe("new", "b"), select="""
SELECT station, time, value FROM a UNION ALL
SELECT station, time, value FROM b WHERE (station, time) NOT IN (SELECT (station, time) FROM a)"""))
def stream_merge(spark, sf):
    landing, out, state = (scratch(spark, n) for n in ("landing", "merged", "merged-state"))
    for unit in ("hour", "minute"):
        rows = observations(spark, sf, unit=unit)
        rows.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(rows.schema).parquet(landing)
        merge_stream(stream, out, state).awaitTermination()
    return merged(spark, out)


@check("stream_merge_restart", P.with_(P.obs("old", unit="hour"), P.obs("new", unit="minute"),
    P.dedupe("old", "a"), P.dedupe("new", "b"), select="""
SELECT station, time, value FROM a UNION ALL
SELECT station, time, value FROM b WHERE (station, time) NOT IN (SELECT (station, time) FROM a)"""))
def stream_merge_restart(spark, sf):
    """A second checkpoint on the same table: the first one's rows stay and none comes twice."""
    out = scratch(spark, "merged")
    for unit in ("hour", "minute", "hour"):
        landing, state = scratch(spark, "landing"), scratch(spark, "merged-state")
        rows = observations(spark, sf, unit=unit)
        rows.write.parquet(landing)
        merge_stream(spark.readStream.schema(rows.schema).parquet(landing), out, state).awaitTermination()
    return merged(spark, out)


FIRST_SEEN = """
SELECT station, time, value FROM a UNION ALL
SELECT station, time, value FROM b WHERE (station, time) NOT IN (SELECT (station, time) FROM a)"""


@check("merge_with_compaction", P.with_(P.obs("old", unit="hour"), P.obs("new", unit="minute"),
    P.dedupe("old", "a"), P.dedupe("new", "b"), select=FIRST_SEEN))
def merge_with_compaction(spark, sf):
    """Three merges, every day rewritten as one folder between them; the last merge brings nothing new."""
    out = scratch(spark, "merged")
    for n, unit in enumerate(("hour", "minute", "hour")):
        live_table.merge_into(observations(spark, sf, unit=unit), out, "run", n)
        live_table.compact(spark, out, many=2)
    return live_table.read_merged(spark, out)


@check("merge_after_failure", P.with_(P.obs("old", unit="hour"), P.obs("new", unit="minute"),
    P.dedupe("old", "a"), P.dedupe("new", "b"), select=FIRST_SEEN))
def merge_after_failure(spark, sf):
    """A writer that failed before its folder was named leaves nothing; the batch is repeated, then repeated again."""
    out = scratch(spark, "merged")
    live_table.merge_into(observations(spark, sf, unit="hour"), out, "run", 0)
    late = observations(spark, sf, unit="minute")
    live_table._write(late.limit(50), out)
    for _ in range(2):
        live_table.merge_into(late, out, "run", 1)
    return live_table.read_merged(spark, out)


@check("stream_merge_compacted", P.with_(P.obs("old", unit="hour"), P.obs("new", unit="minute"),
    P.dedupe("old", "a"), P.dedupe("new", "b"), select=FIRST_SEEN))
def stream_merge_compacted(spark, sf):
    landing, out, state = (scratch(spark, n) for n in ("landing", "merged", "merged-state"))
    for unit in ("hour", "minute"):
        rows = observations(spark, sf, unit=unit)
        rows.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(rows.schema).parquet(landing)
        live_table.merge_stream_into(stream, out, state, many=2).awaitTermination()
    return live_table.read_merged(spark, out)
