"""Model runs, station matching, lists and metadata (D, E4-E8, G, H, I3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import pieces as P
from checks.registry import check
from checks.standins import (
    customer_meta, model_nodes, model_series, observations, requested, runs, sensors, sites, table,
    user_request,
)
from gaugeloom import schema
from gaugeloom.operators import matching as M
from gaugeloom.operators import metadata as D
from gaugeloom.operators import quality as Q
from gaugeloom.operators import runs as R

MATCHED = """matched AS (
  SELECT n.url, r.position, n.station, n.node_idx
  FROM (SELECT url, split_part(trim(station_name), ' ', 1) AS station, min(node_idx) AS node_idx
        FROM nodes GROUP BY 1, 2) n JOIN requested r USING (station))"""
RUN_SET = (P.runs(), P.model_nodes(), P.REQUESTED)


@check("match_stations", P.with_(*RUN_SET, MATCHED, select="SELECT * FROM matched"))
def match_stations(spark, sf):
    return M.match_stations(requested(spark, sf), model_nodes(spark, sf))


@check("unmatched_stations", P.with_(*RUN_SET, select="""
SELECT * FROM requested WHERE station NOT IN (SELECT split_part(trim(station_name), ' ', 1) FROM nodes)"""))
def unmatched_stations(spark, sf):
    return M.unmatched_stations(requested(spark, sf), model_nodes(spark, sf))


@check("distinct_pairs", P.with_(*RUN_SET, MATCHED, select="""
SELECT min(position) AS position, station, node_idx FROM matched GROUP BY 2, 3"""))
def distinct_pairs(spark, sf):
    return M.distinct_pairs(M.match_stations(requested(spark, sf), model_nodes(spark, sf)))


@check("present_runs", P.with_(P.runs(), P.model_series(), select="""
SELECT position, url FROM runs WHERE url IN (SELECT url FROM series)"""))
def present_runs(spark, sf):
    return M.present_runs(runs(spark, sf), model_series(spark, sf))


def part_nodes(spark, sf):
    """Parts as the curated table: node numbers start at 1."""
    return table(spark, sf, "part").select(
        F.concat(F.lit("P"), F.col("p_partkey")).alias("stationid"),
        (F.col("p_partkey") + 1).cast("int").alias("Node"),
        (F.col("p_partkey") + 1).cast("int").alias("serial_nr"),
    )


@check("node_lookup", P.with_(P.runs(), P.model_series(), select="""
SELECT url, 'P' || p_partkey AS station, node_idx, time, zeta
FROM series JOIN part ON p_partkey = node_idx"""))
def node_lookup(spark, sf):
    return M.node_lookup(part_nodes(spark, sf), model_series(spark, sf))


@check("station_intersection", P.with_(*RUN_SET, select="""
SELECT station FROM requested INTERSECT SELECT split_part(trim(station_name), ' ', 1) FROM nodes"""))
def station_intersection(spark, sf):
    return M.station_intersection(requested(spark, sf), M.run_stations(model_nodes(spark, sf)))


@check("station_difference", P.with_(*RUN_SET, select="""
SELECT station FROM requested WHERE station NOT IN (SELECT split_part(trim(station_name), ' ', 1) FROM nodes)"""))
def station_difference(spark, sf):
    return M.station_difference(requested(spark, sf), M.run_stations(model_nodes(spark, sf)))


@check("union_station_lists", """
WITH a AS (SELECT c_custkey AS position, 'S' || c_custkey AS station FROM customer),
b AS (SELECT s_suppkey AS position, 'S' || s_suppkey AS station FROM supplier),
c AS (SELECT p_partkey AS position, 'P' || p_partkey AS station FROM part)
SELECT CAST(position AS INTEGER) AS position, station FROM a UNION ALL
SELECT CAST(position + (SELECT max(position) + 1 FROM a) AS INTEGER), station FROM b UNION ALL
SELECT CAST(position + (SELECT max(position) + 1 FROM a) + (SELECT max(position) + 1 FROM b) AS INTEGER), station FROM c""")
def union_station_lists(spark, sf):
    def listed(name, key, letter):
        return table(spark, sf, name).select(
            F.col(key).alias("position"), F.concat(F.lit(letter), F.col(key)).alias("station")
        )
    return M.union_station_lists(
        listed("customer", "c_custkey", "S"), listed("supplier", "s_suppkey", "S"),
        listed("part", "p_partkey", "P"),
    )


@check("run_cast", P.with_(P.runs(), P.PARTS, P.model_series(), P.CASTS, select="SELECT * FROM casts"))
def run_cast(spark, sf):
    return R.run_cast(model_series(spark, sf), runs(spark, sf))


@check("last_per_run", P.with_(P.runs(), P.model_series(), select="""
SELECT url, max(time) AS last_time FROM series GROUP BY 1"""))
def last_per_run(spark, sf):
    return R.last_per_run(model_series(spark, sf))


def batched_casts(spark, sf):
    """The batch of a run is its customer."""
    customers = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("int").alias("position"), F.col("o_custkey").alias("batch")
    )
    all_runs = runs(spark, sf)
    return R.run_cast(model_series(spark, sf), all_runs).join(
        all_runs.join(customers, "position"), "url"
    )


@check("cast_report", P.with_(P.runs(), P.PARTS, P.model_series(), P.CASTS, select="""
SELECT o_custkey AS batch, count(*) AS runs, count(*) FILTER ("cast" = 'FORECAST') AS forecasts,
  count(*) FILTER ("cast" = 'NOWCAST') AS nowcasts, min("cast") = max("cast") AS single_cast
FROM casts JOIN runs USING (url) JOIN orders USING (o_orderkey) GROUP BY 1"""))
def cast_report(spark, sf):
    return R.cast_report(batched_casts(spark, sf))


@check("assert_single_cast", P.with_(P.runs(shift_years=10), P.PARTS, P.model_series(), P.CASTS, select="""
SELECT o_custkey AS batch, min("cast") AS "cast" FROM casts JOIN runs USING (url) JOIN orders USING (o_orderkey) GROUP BY 1"""))
def assert_single_cast(spark, sf):
    customers = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("int").alias("position"), F.col("o_custkey").alias("batch")
    )
    shifted = runs(spark, sf, 10)
    casts = R.run_cast(model_series(spark, sf, 10), shifted)
    return R.assert_single_cast(casts.join(shifted.join(customers, "position"), "url"))


@check("first_nonempty", """
SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS url FROM (
  SELECT o_custkey, o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END AS o_orderpriority
  FROM orders) WHERE o_orderpriority <> '' GROUP BY 1""")
def first_nonempty(spark, sf):
    url = F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderpriority"))
    listed = table(spark, sf, "orders").select(
        "o_custkey", F.col("o_orderkey").alias("position"), url.alias("url")
    )
    return R.first_nonempty(listed, ["o_custkey"])


@check("first_valid_meta", P.with_(*RUN_SET, MATCHED, select="""
SELECT p.station, p.node_idx, f.url, f.x, f.y, f.source
FROM (SELECT DISTINCT station, node_idx FROM matched) p JOIN (
  SELECT n.*, row_number() OVER (PARTITION BY n.node_idx ORDER BY r.position) AS rn
  FROM nodes n JOIN runs r USING (url)) f USING (node_idx) WHERE rn = 1"""))
def first_valid_meta(spark, sf):
    nodes = model_nodes(spark, sf)
    pairs = M.distinct_pairs(M.match_stations(requested(spark, sf), nodes))
    return R.first_valid_meta(pairs, nodes, runs(spark, sf))


# --- metadata ---------------------------------------------------------------------------------

@check("resolve_site", P.with_(P.SENSORS, P.SITES, select="""
SELECT f.site_id AS station, f.or_site_id, f.or_sensor_id, nullif(latitude_dec, '') AS "LAT",
  CAST(s_acctbal AS VARCHAR) AS "LON", CASE WHEN s.location <> '' THEN f.location END AS "NAME"
FROM (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY or_sensor_id) AS rn
      FROM sensors WHERE sensor_class = '20') f JOIN sites s USING (or_site_id) WHERE rn = 1"""))
def resolve_site(spark, sf):
    return D.resolve_site(sensors(spark, sf), sites(spark, sf), "Stage")


def tide_meta(spark, sf):
    raw = D.clean_fields(customer_meta(spark, sf), ["lat", "lng", "name", "state"])
    named = raw.select("station", "name", "state", F.col("lat").alias("LAT"), F.col("lng").alias("LON"))
    return D.standard_meta(named, schema.OWNERS["NOAA"])


@check("attach_meta", P.with_(P.obs(station="user_id"), P.META, select="""
SELECT o.*, m.* EXCLUDE (STATION) FROM obs o LEFT JOIN meta m ON m.STATION = o.station"""))
def attach_meta(spark, sf):
    return D.attach_meta(observations(spark, sf, "user_id"), tide_meta(spark, sf))


@check("data_without_meta", P.with_(P.obs(), P.obs("users", "user_id"), P.META, select="""
SELECT DISTINCT station FROM (SELECT station FROM obs UNION ALL SELECT station FROM users) d
WHERE NOT EXISTS (SELECT 1 FROM meta m WHERE m.STATION = d.station)"""))
def data_without_meta(spark, sf):
    both = observations(spark, sf).unionByName(observations(spark, sf, "user_id"))
    return D.data_without_meta(both, tide_meta(spark, sf))


@check("meta_without_data", P.with_(P.obs("users", "user_id"), P.META, select="""
SELECT m.STATION AS station FROM meta m WHERE m.STATION NOT IN (SELECT station FROM users)"""))
def meta_without_data(spark, sf):
    return D.meta_without_data(observations(spark, sf, "user_id"), tide_meta(spark, sf))


@check("meta_from_kv", P.with_(P.META, select="""
SELECT STATION, CAST(LAT AS VARCHAR) AS LAT, CAST(LON AS VARCHAR) AS LON, NAME, UNITS, TZ, OWNER, STATE, COUNTY
FROM meta"""))
def meta_from_kv(spark, sf):
    return D.meta_from_kv(D.meta_to_kv(tide_meta(spark, sf)))


@check("harvest_counts", P.with_(P.obs("users", "user_id"), P.USER_REQUEST, P.META, select="""
SELECT count(*) FILTER (station IN (SELECT station FROM users)) AS data_included,
  count(*) FILTER (station NOT IN (SELECT station FROM users)) AS data_excluded,
  count(*) FILTER (station IN (SELECT STATION FROM meta WHERE LAT IS NOT NULL)) AS meta_included,
  count(*) FILTER (station NOT IN (SELECT STATION FROM meta WHERE LAT IS NOT NULL)) AS meta_excluded
FROM requested"""))
def harvest_counts(spark, sf):
    located = tide_meta(spark, sf).where(F.col("LAT").isNotNull())
    return Q.harvest_counts(user_request(spark, sf), observations(spark, sf, "user_id"), located)
