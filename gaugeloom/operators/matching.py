"""Which requested stations a model run holds, and where."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloom.functions.runs import run_day, station_token
from gaugeloom.schema import RUN_DAY, STATION


def named_nodes(nodes: DataFrame) -> DataFrame:
    """Nodes under the station id that leads their name."""
    return nodes.select("url", station_token("station_name").alias(STATION), "node_idx")


def run_stations(nodes: DataFrame) -> DataFrame:
    """First node of each station id in each run: `(url, station, node_idx)`."""
    return named_nodes(nodes).groupBy("url", STATION).agg(F.min("node_idx").alias("node_idx"))


def match_stations(requested: DataFrame, nodes: DataFrame) -> DataFrame:
    """Requested stations a run has, with their first node: `(url, position, station, node_idx)`.

    The request is joined before the first node is picked, so nodes nobody asked for do not
    reach the aggregate.
    """
    wanted = named_nodes(nodes).join(requested, [STATION], "inner")
    return wanted.groupBy("url", "position", STATION).agg(F.min("node_idx").alias("node_idx"))


def requested_pairs(requested: DataFrame, nodes: DataFrame) -> DataFrame:
    """`distinct_pairs(match_stations(requested, nodes))` without positions: each run's first nodes collapse to
    distinct pairs before they meet the request, so no row of a run is shuffled by station."""
    pairs = run_stations(nodes).select(STATION, "node_idx").distinct()
    return pairs.join(requested.select(STATION).distinct(), [STATION], "left_semi")


def unmatched_stations(requested: DataFrame, nodes: DataFrame) -> DataFrame:
    """Requested stations that no run has."""
    known = nodes.select(station_token("station_name").alias(STATION)).distinct()
    return requested.join(known, STATION, "left_anti").select("position", STATION)


def distinct_pairs(matches: DataFrame) -> DataFrame:
    """Each `(station, node_idx)` once, however many runs it was found in."""
    return matches.groupBy(STATION, "node_idx").agg(F.min("position").alias("position")).select(
        "position", STATION, "node_idx"
    )


def node_pairs(station_nodes: DataFrame) -> DataFrame:
    """`(station, node_idx)` from the curated table, whose node numbers start at 1."""
    return station_nodes.select(
        F.col("stationid").alias(STATION), (F.col("Node") - 1).cast("int").alias("node_idx")
    )


def node_lookup(station_nodes: DataFrame, series: DataFrame) -> DataFrame:
    """Model rows of the curated stations, with the station id attached."""
    rest = [c for c in series.columns if c not in ("node_idx", "url")]
    joined = series.join(node_pairs(station_nodes), ["node_idx"], "inner")
    return joined.select("url", STATION, "node_idx", *rest)


def of_listed_days(series: DataFrame, runs: DataFrame) -> DataFrame:
    """A table landed by run day (`write_model_runs`) cut to the days of the listed runs: a broadcast of one short
    row a day, by which the scan leaves other days' folders unopened. Other tables stay as they are."""
    if RUN_DAY not in series.columns:
        return series
    days = runs.where(F.col("url") != "").select(run_day("url").alias(RUN_DAY)).distinct()
    return series.join(F.broadcast(days), RUN_DAY, "left_semi")


def of_listed_runs(series: DataFrame, runs: DataFrame) -> DataFrame:
    """Rows of the listed runs; of a table landed by run day only the days of the list are opened."""
    listed = runs.where(F.col("url") != "").select("url")
    return of_listed_days(series, runs).join(listed.distinct(), "url", "left_semi")


def present_runs(runs: DataFrame, landed: DataFrame) -> DataFrame:
    """Runs of the manifest that have landed data; the others are dropped."""
    return runs.join(landed.select("url").distinct(), "url", "left_semi").select(*runs.columns)


def station_intersection(requested: DataFrame, available: DataFrame) -> DataFrame:
    return requested.select(STATION).intersect(available.select(STATION))


def station_difference(requested: DataFrame, available: DataFrame) -> DataFrame:
    """Requested ids that are not available, each as often as it was requested."""
    return requested.select(STATION).join(
        available.select(STATION).distinct(), STATION, "left_anti"
    )


def union_station_lists(*lists: DataFrame) -> DataFrame:
    """Lists one after another, duplicates kept, with one running position.

    Each list is shifted past the ends of those before it (a scalar subquery per list).
    """
    stacked, shift = None, F.lit(0)
    for part in lists:
        placed = part.select((F.col("position") + shift).cast("int").alias("position"), STATION)
        stacked = placed if stacked is None else stacked.unionByName(placed)
        shift = shift + F.coalesce(part.agg(F.max("position") + 1).scalar(), F.lit(0))
    return stacked
