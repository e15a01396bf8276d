"""Station lists, the station-to-node table and the per-grid registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeloom.schema import STATION, STATION_NODE_TYPES


def read_station_list(spark: SparkSession, path: str, skip: int = 1) -> DataFrame:
    """`(position, station)` of text lists, the first `skip` lines of each file dropped, the order kept.

    A folder is one long list: its files follow each other by path, and positions count on from file to file.
    Files are read in splits. A line's place is its place in its split behind the lines of earlier splits and
    files, which come from one count for each split. A folder of lists gives the partition columns of the
    folder beside.
    """
    text = spark.read.text(path)
    keep = [c for c in text.columns if c != "value"]
    split = ["_file", "_begin"]
    lines = text.select(
        *keep, "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_begin"),
        F.monotonically_increasing_id().alias("_id"),
    )
    counts = lines.groupBy(*split).agg(F.count("*").alias("_n"))
    files = counts.groupBy("_file").agg(F.greatest(F.sum("_n") - skip, F.lit(0)).alias("_kept"))
    earlier = files.select("_file", (F.sum("_kept").over(Window.orderBy("_file")) - F.col("_kept")).alias("_past"))
    above = F.sum("_n").over(Window.partitionBy("_file").orderBy("_begin")) - F.col("_n")
    starts = counts.select(*split, above.alias("_above")).join(earlier, "_file")
    inside = F.row_number().over(Window.partitionBy(*split).orderBy("_id")) - 1
    placed = lines.withColumn("_line", inside).join(starts, split).withColumn("_line", F.col("_line") + F.col("_above"))
    cleaned = placed.where(F.col("_line") >= skip).select(
        *keep,
        (F.col("_past") + F.col("_line") - skip).cast("int").alias("position"),
        F.regexp_replace("value", r"\s+$", "").alias(STATION),
    )
    return cleaned.where(F.col(STATION) != "")


def read_station_nodes(spark: SparkSession, path: str) -> DataFrame:
    """The curated table; the units line under its header is dropped, `NaN` reads as NULL."""
    text = spark.read.csv(
        path,
        schema=", ".join(f"`{c}` string" for c in STATION_NODE_TYPES),
        header=True,
        nullValue="NaN",
    )
    rows = text.where(F.col("stationid") != "-")
    return rows.select(*[F.col(f"`{c}`").try_cast(t).alias(c) for c, t in STATION_NODE_TYPES.items()])


def stations_for_grid(registry: DataFrame, grid: str, kind: str) -> DataFrame:
    """The list of one kind for one grid; gauges are the same for all, an unknown grid has none."""
    wanted = F.col("kind") == kind
    if kind != "gauge":
        wanted = wanted & (F.lower("grid") == grid.lower())
    return registry.where(wanted).select("position", F.col("id").alias(STATION))


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The registry from CSV: `grid,kind,position,id`."""
    return spark.read.csv(path, schema="grid string, kind string, position int, id string", header=True)
