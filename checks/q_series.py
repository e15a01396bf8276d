"""Series operators: gaps, bins, alignment, repeated times, quality (D4, E, F, I, K2, P1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import pieces as P
from checks.registry import check
from checks.standins import observations, table, user_request
from gaugeloom.operators import align as A
from gaugeloom.operators import dedupe as D
from gaugeloom.operators import gaps as G
from gaugeloom.operators import quality as Q
from gaugeloom.operators import resample as S
from gaugeloom.plans.series import harvest_series

KINDS = ["click", "error", "purchase", "signup", "view"]


def clean(spark, sf, **options):
    return D.dedupe_keep_first(observations(spark, sf, **options)).drop("seq")


@check("dedupe_keep_first", P.with_(P.obs(unit="minute"), P.dedupe(), select="SELECT * FROM ded"))
def dedupe_keep_first(spark, sf):
    return D.dedupe_keep_first(observations(spark, sf, unit="minute"))


@check("duplicate_report", P.with_(P.obs(unit="minute"), select="""
SELECT station, CAST(sum(n) AS BIGINT) AS rows_before, count(*) AS rows_after,
  count(*) FILTER (n > 1) AS repeated_times, max(n) > 1 AS multivalue
FROM (SELECT station, time, count(*) AS n FROM obs GROUP BY 1, 2) GROUP BY 1"""))
def duplicate_report(spark, sf):
    return D.duplicate_report(observations(spark, sf, unit="minute"))


@check("concat_order", P.with_(P.obs("late", unit="hour"), P.obs("early", "user_id", "hour"), select="""
SELECT station, time, value FROM (
  SELECT *, row_number() OVER (PARTITION BY station, time ORDER BY part, seq) AS rn
  FROM (SELECT *, 0 AS part FROM early UNION ALL SELECT *, 1 AS part FROM late)) WHERE rn = 1"""))
def concat_order(spark, sf):
    stacked = D.concat_order(
        observations(spark, sf, "user_id", "hour"), observations(spark, sf, unit="hour")
    )
    return D.dedupe_keep_first(stacked).drop("seq")


@check("union_periods", P.with_(P.obs("a"), P.obs("b", "user_id"), select="""
SELECT * FROM a UNION ALL SELECT * FROM b"""))
def union_periods(spark, sf):
    return D.union_all(observations(spark, sf), observations(spark, sf, "user_id"))


@check("interpolate_linear", P.with_(P.obs(unit="minute"), P.dedupe(), P.interpolate(), select="""
SELECT * FROM filled"""))
def interpolate_linear(spark, sf):
    return G.interpolate_linear(clean(spark, sf, unit="minute"))


@check("interpolate_linear_limit", P.with_(P.obs(station="user_id"), P.dedupe(), P.interpolate(limit=3), select="""
SELECT * FROM filled"""))
def interpolate_linear_limit(spark, sf):
    return G.interpolate_linear(clean(spark, sf, station="user_id"), limit=3)


@check("gap_runs", P.with_(P.obs(), select="""
SELECT station, time, value, coalesce(CASE WHEN value IS NULL THEN gap END, -1) AS gap_id,
  CASE WHEN value IS NOT NULL THEN 0 ELSE row_number() OVER (PARTITION BY station, gap, value IS NULL ORDER BY time) END AS gap_pos
FROM (SELECT *, count(value) OVER (PARTITION BY station ORDER BY time) AS gap FROM obs)"""))
def gap_runs(spark, sf):
    return G.gap_runs(observations(spark, sf)).fillna(-1, "gap_id").fillna(0, "gap_pos")


@check("resample_first", P.with_(P.obs(), P.resample("obs"), select="SELECT * FROM bins"))
def resample_first(spark, sf):
    return S.resample_first(observations(spark, sf))


DENSE = """dense AS (
  SELECT g.station, g.time, b.value
  FROM (SELECT station, unnest(generate_series(lo, hi, INTERVAL 15 MINUTE)) AS time FROM axis_spans) g
  LEFT JOIN bins b USING (station, time))"""


@check("dense_bins", P.with_(
    P.obs(station="user_id"), P.resample("obs"), P.axis(), DENSE, select="SELECT * FROM dense"))
def dense_bins(spark, sf):
    return S.dense_bins(observations(spark, sf, "user_id"))


@check("bin_origin", P.with_(P.obs(station="user_id"), select="""
SELECT o.station, o.time, o.value, o.seq, time_bucket(INTERVAL 7 MINUTE, o.time, d.origin) AS bin
FROM obs o JOIN (SELECT station, date_trunc('day', min(time)) AS origin FROM obs GROUP BY 1) d USING (station)"""))
def bin_origin(spark, sf):
    return S.bin_origin(observations(spark, sf, "user_id"), 7)


@check("repair_resample", P.with_(
    P.obs(unit="minute"), P.dedupe(), P.interpolate(), P.resample(), select=f"""
SELECT s.station, s.time, b.value FROM (SELECT DISTINCT station, {P.bucket()} AS time FROM obs) s
LEFT JOIN bins b USING (station, time)"""))
def repair_resample(spark, sf):
    return S.repair_resample(clean(spark, sf, unit="minute"))


@check("align_stations", P.with_(P.obs(station="user_id", unit="hour"), P.dedupe(), select="""
SELECT s.station, a.time, d.value FROM (SELECT DISTINCT time FROM ded) a
CROSS JOIN (SELECT DISTINCT station FROM ded) s LEFT JOIN ded d ON d.station = s.station AND d.time = a.time"""))
def align_stations(spark, sf):
    return A.align_stations(clean(spark, sf, station="user_id", unit="hour"))


@check("harvest_series", P.with_(P.obs(unit="minute"), P.series(), select="SELECT * FROM grid"))
def harvest_series_(spark, sf):
    return harvest_series(observations(spark, sf, unit="minute"))


@check("harvest_series_users", P.with_(P.obs(station="user_id"), P.series(), select="SELECT * FROM grid"))
def harvest_series_users(spark, sf):
    return harvest_series(observations(spark, sf, "user_id"))


@check("harvest_series_native", P.with_(
    P.obs(unit="hour"), P.dedupe(), P.interpolate(), "axis AS (SELECT DISTINCT time FROM ded)",
    P.aligned("filled", stations="ded"), select="SELECT * FROM grid"))
def harvest_series_native(spark, sf):
    return harvest_series(observations(spark, sf, unit="hour"), minutes=0)


@check("missing_report", P.with_(P.obs(station="user_id"), select="""
SELECT station, count(*) AS rows, count(*) FILTER (value IS NULL) AS missing,
  count(*) FILTER (value IS NULL) / count(*) AS missing_share, min(time) AS first_time, max(time) AS last_time
FROM obs GROUP BY 1"""))
def missing_report(spark, sf):
    return Q.missing_report(observations(spark, sf, "user_id"))


@check("drop_empty_stations", """
WITH obs AS (SELECT event_type || '-' || user_id AS station, ts AS time,
  CASE WHEN value >= 60 THEN value END AS value FROM events)
SELECT * FROM obs WHERE station IN (SELECT station FROM obs WHERE value IS NOT NULL)""")
def drop_empty_stations(spark, sf):
    obs = table(spark, sf, "events").select(
        F.concat_ws("-", "event_type", "user_id").alias("station"),
        F.col("ts").alias("time"),
        F.when(F.col("value") >= 60, F.col("value")).alias("value"),
    )
    return Q.drop_empty_stations(obs)


@check("excluded_stations", P.with_(P.obs(station="user_id"), P.USER_REQUEST, select="""
SELECT station, coalesce(n, 0) AS rows, coalesce(valid, 0) AS valid,
  CASE WHEN coalesce(n, 0) = 0 THEN 'no data' WHEN valid = 0 THEN 'no valid values'
       ELSE 'too few points to repair gaps' END AS reason
FROM (SELECT DISTINCT station FROM requested)
LEFT JOIN (SELECT station, count(*) AS n, count(value) AS valid FROM obs GROUP BY 1) USING (station)
WHERE coalesce(valid, 0) < 2"""))
def excluded_stations(spark, sf):
    return Q.excluded_stations(user_request(spark, sf), observations(spark, sf, "user_id"))


@check("to_wide", P.with_(P.obs(), P.resample("obs"), select="""
SELECT time AS "TIME", """ + ", ".join(f"max(value) FILTER (station = '{k}') AS {k}" for k in KINDS)
    + " FROM bins GROUP BY 1"))
def to_wide(spark, sf):
    return A.to_wide(S.resample_first(observations(spark, sf)), KINDS)


@check("to_long", P.with_(P.obs(), P.resample("obs"), select="""
SELECT a.time AS "TIME", s.station AS "STATION", b.value AS "WATER_LEVEL"
FROM (SELECT DISTINCT time FROM bins) a CROSS JOIN (SELECT DISTINCT station FROM bins) s
LEFT JOIN bins b ON b.time = a.time AND b.station = s.station"""))
def to_long(spark, sf):
    return A.to_long(A.to_wide(S.resample_first(observations(spark, sf)), KINDS))


@check("merge_harvests", P.with_(P.obs("old", unit="hour"), P.obs("new", unit="minute"), P.dedupe("old", "a"),
    P.dedupe("new", "b"), select="""
SELECT station, time, value FROM a UNION ALL
SELECT station, time, value FROM b WHERE (station, time) NOT IN (SELECT (station, time) FROM a)"""))
def merge_harvests(spark, sf):
    return D.merge_harvests(clean(spark, sf, unit="hour"), clean(spark, sf, unit="minute"))


@check("order_output", P.with_(P.obs(station="user_id"), P.USER_REQUEST, select="""
SELECT o.station, o.time, o.value, o.seq, r.position
FROM obs o LEFT JOIN requested r USING (station) ORDER BY r.position, o.time"""))
def order_output(spark, sf):
    return A.order_output(observations(spark, sf, "user_id"), user_request(spark, sf))
