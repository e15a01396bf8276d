"""Landed ocean-model output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeloom.functions.runs import grid_cast_name, parse_run_url, run_start, station_token
from gaugeloom.functions.values import mask_below
from gaugeloom.operators.matching import of_listed_runs, present_runs, run_stations
from gaugeloom.operators.metadata import standard_meta
from gaugeloom.schema import (
    MODEL_NODE_SCHEMA, MODEL_SERIES_SCHEMA, RUN_DAY, SEQ, STATION, TIME, VALUE, harvest_product,
)


def read_model_series(
    spark: SparkSession, path: str, nodes: list[int] | DataFrame | None = None
) -> DataFrame:
    """`(url, node_idx, time, zeta)`; a list of nodes becomes a filter of the parquet scan."""
    series = spark.read.schema(MODEL_SERIES_SCHEMA).parquet(path)
    if nodes is None:
        return series
    if isinstance(nodes, DataFrame):
        wanted = nodes.select("node_idx").distinct()
        return series.join(wanted, ["node_idx"], "left_semi")
    return series.where(F.col("node_idx").isin([int(n) for n in nodes]))


def read_model_runs(
    spark: SparkSession, path: str, runs: DataFrame | None = None, nodes: DataFrame | None = None
) -> DataFrame:
    """`(url, node_idx, time, zeta, run_day)` of a table landed by `write_model_runs`.

    With a list of runs only the folders of their days are opened; rows of a file lie by node, so a few nodes
    are a few of its row groups.
    """
    folders = T.StructType([*MODEL_SERIES_SCHEMA.fields, T.StructField(RUN_DAY, T.StringType())])
    series = spark.read.schema(folders).parquet(path)
    if runs is not None:
        series = of_listed_runs(series, runs)
    if nodes is not None:
        series = series.join(nodes.select("node_idx").distinct(), "node_idx", "left_semi")
    return series


def read_model_nodes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MODEL_NODE_SCHEMA).parquet(path)


def model_array_to_rows(arrays: DataFrame) -> DataFrame:
    """One row per time step from rows that hold a node's whole series as arrays."""
    return arrays.select("url", "node_idx", F.inline(F.arrays_zip("time", "zeta")))


def scan_if_present(runs: DataFrame, landed: DataFrame) -> DataFrame:
    """Runs that can be read, judged from the landed table without opening any file."""
    return present_runs(runs, landed)


def read_product(spark: SparkSession, path: str, product: str = "water_level") -> DataFrame:
    """`(station, time, value, seq)` of all runs landed under `series` and `nodes` of `path`, in metres.

    A run's stations are the first nodes of their names. Of runs that share a station's time the one that starts
    first counts, advisories before all; `seq` says so.
    """
    harvest_product("ASGS", product)
    named = run_stations(read_model_nodes(spark, f"{path}/nodes"))
    found = read_model_series(spark, f"{path}/series").join(named, ["url", "node_idx"])
    start = F.coalesce(run_start(parse_run_url("url")["start_token"]), F.lit("1970-01-01").cast("timestamp_ntz"))
    return found.select(
        STATION, TIME, mask_below("zeta").alias(VALUE), F.struct(start.alias("start"), "url", "node_idx").alias(SEQ)
    )


def read_meta(spark: SparkSession, path: str) -> DataFrame:
    """Standard metadata of all named nodes: place and owner from the first run by URL that has the station."""
    nodes = read_model_nodes(spark, f"{path}/nodes").where(F.col("url").isNotNull() & F.col("node_idx").isNotNull())
    # The first node of the first run is the least (url, node): one aggregate, of which a task sends a row a station.
    first = F.min_by(F.struct("url", "x", "y", "source"), F.struct("url", "node_idx")).alias("_n")
    found = nodes.groupBy(station_token("station_name").alias(STATION)).agg(first)
    parts = parse_run_url("_n.url")
    named = found.select(
        STATION, F.col("_n.y").alias("LAT"), F.col("_n.x").alias("LON"),
        grid_cast_name(parts["grid"], parts["ensemble"]).alias("NAME"), F.col("_n.source"),
    )
    return standard_meta(named, F.col("source"))
