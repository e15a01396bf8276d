"""Classifying and ordering model runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeloom.functions.runs import is_advisory, parse_run_url, run_label, run_start
from gaugeloom.schema import STATION, TIME


def with_run_parts(runs: DataFrame, url: str = "url") -> DataFrame:
    """Add everything the URL says: start_token, grid, instance, ensemble, start, advisory, label."""
    parts = runs.withColumns(parse_run_url(url))
    return parts.withColumns({
        "start": run_start("start_token"),
        "advisory": is_advisory("start_token"),
        "label": run_label("start_token"),
    })


def last_per_run(series: DataFrame) -> DataFrame:
    """Last time of each run; a maximum, so the rows need no order."""
    return series.groupBy("url").agg(F.max(TIME).alias("last_time"))


def cast_of(last: Column, start: Column) -> Column:
    """FORECAST where the series runs past the start, or the start is a storm advisory."""
    late = start.isNull() | (last > start)
    return F.when(late, F.lit("FORECAST")).otherwise(F.lit("NOWCAST"))


def run_cast(series: DataFrame, runs: DataFrame) -> DataFrame:
    """`(url, start, last_time, cast)` of every run with data."""
    last = last_per_run(series)
    return runs.join(last, "url").select(
        "url",
        run_start(parse_run_url("url")["start_token"]).alias("start"),
        "last_time",
        cast_of(F.col("last_time"), run_start(parse_run_url("url")["start_token"])).alias("cast"),
    )


def cast_report(casts: DataFrame, batch: str = "batch") -> DataFrame:
    """Per batch: how many runs of each cast, and whether they agree."""
    return casts.groupBy(batch).agg(
        F.count("*").alias("runs"),
        F.count_if(F.col("cast") == "FORECAST").alias("forecasts"),
        F.count_if(F.col("cast") == "NOWCAST").alias("nowcasts"),
        (F.min("cast") == F.max("cast")).alias("single_cast"),
    )


def assert_single_cast(casts: DataFrame, batch: str = "batch") -> DataFrame:
    """`(batch, cast)`; the job fails when a batch mixes forecasts and nowcasts."""
    agreed = casts.groupBy(batch).agg(F.min("cast").alias("cast"), F.max("cast").alias("_other"))
    message = F.concat(F.lit("mixed casts in batch "), F.col(batch).cast("string"))
    checked = F.when(F.col("cast") == F.col("_other"), F.col("cast")).otherwise(F.raise_error(message))
    return agreed.select(batch, checked.alias("cast"))


def first_nonempty(runs: DataFrame, batch: list[str] | None = None) -> DataFrame:
    """The first usable URL of each batch; it names the batch."""
    usable = runs.where(F.col("url") != "")
    return usable.groupBy(*(batch or [])).agg(F.min_by("url", "position").alias("url"))


def first_valid_meta(pairs: DataFrame, nodes: DataFrame, runs: DataFrame) -> DataFrame:
    """Node position and owner of each pair, from the first run that has the node.

    Nodes are cut down to the pairs first. The pick is an aggregate rather than a ranked window,
    so only one row per node and task is shuffled.
    """
    found = nodes.join(pairs, ["node_idx"], "inner")
    placed = found.join(runs.select("url", F.col("position").alias("_run")), ["url"], "inner")
    first = F.min_by(F.struct("url", "x", "y", "source"), "_run").alias("_first")
    return placed.groupBy(STATION, "node_idx").agg(first).select(
        STATION, "node_idx", "_first.url", "_first.x", "_first.y", "_first.source"
    )
