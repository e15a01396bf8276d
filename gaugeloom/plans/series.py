"""From raw observations to repaired, regular, aligned and filled series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloom.functions.values import fill_missing
from gaugeloom.operators.align import align_stations, unfold_in_order
from gaugeloom.operators.dedupe import dedupe_keep_first
from gaugeloom.operators.gaps import BLOCK_MINUTES, interpolate_linear
from gaugeloom.operators.resample import (
    bin_axis, bin_counts, first_heads, repair_bins, repair_resample, station_spans,
)
from gaugeloom.schema import DEFAULT_MINUTES, FILL_VALUE, SEQ, STATION, TIME, VALUE


def native_series(obs: DataFrame, unique: bool = False, block_minutes: int = BLOCK_MINUTES) -> DataFrame:
    """De-duplicated and repaired rows at their own times."""
    rows = obs if unique else dedupe_keep_first(obs.select(STATION, TIME, VALUE, SEQ))
    return interpolate_linear(rows, block_minutes=block_minutes)


def regular_series(obs: DataFrame, minutes: int, unique: bool = False) -> DataFrame:
    """De-duplicated, repaired and resampled; occupied bins only."""
    if unique:
        return repair_resample(obs, minutes)
    return repair_bins(first_heads(obs, minutes))


def series_parts(
    obs: DataFrame, minutes: int | None = DEFAULT_MINUTES, unique: bool = False, block_minutes: int = BLOCK_MINUTES
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What the aligned series is unfolded from: values found, times of the common axis, stations."""
    obs = obs.where(F.col(STATION).isNotNull() & F.col(TIME).isNotNull())
    if minutes == 0:
        return native_series(obs, unique, block_minutes), obs, obs
    width = minutes or DEFAULT_MINUTES
    spans = station_spans(bin_counts(obs, width))
    # The comparison keeps both bounds in the plan, so axis and roster share one exchange.
    roster = spans.where(F.col("lo") <= F.col("hi"))
    return regular_series(obs, width, unique), bin_axis(spans, width), roster


def harvest_series(
    obs: DataFrame,
    minutes: int | None = DEFAULT_MINUTES,
    fill: float = FILL_VALUE,
    unique: bool = False,
    block_minutes: int = BLOCK_MINUTES,
) -> DataFrame:
    """`(station, time, value)` with a row for every station at every time of the common axis.

    Order of work: first of repeated times, one-sample gap repair, first value per bin, common
    axis, sentinel for what is missing. `minutes=0` keeps the native times. `unique` says that no
    station repeats a time, which saves the shuffle of raw rows. At native times gaps are repaired in blocks of
    `block_minutes`; the rows are the same for any. The axis comes from one count per
    bin, over two columns of the scan.
    """
    found, axis, stations = series_parts(obs, minutes, unique, block_minutes)
    return align_stations(found, axis=axis, stations=stations).withColumn(VALUE, fill_missing(VALUE, fill))


def ordered_series(
    obs: DataFrame, requested: DataFrame | None = None, minutes: int | None = DEFAULT_MINUTES,
    block_minutes: int = BLOCK_MINUTES,
) -> DataFrame:
    """The rows of `harvest_series` in output order, sorted as cells of many times before they are unfolded."""
    width = DEFAULT_MINUTES if minutes is None else minutes
    return unfold_in_order(*series_parts(obs, minutes, block_minutes=block_minutes), requested, width)
