"""Overlapping windows collected in one go: the window is part of every key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeloom.functions.values import fill_missing
from gaugeloom.operators.align import align_in_groups
from gaugeloom.operators.gaps import BLOCK_MINUTES
from gaugeloom.operators.periods import rows_in_windows, windows_table
from gaugeloom.operators.resample import bin_axis, bin_counts, station_spans
from gaugeloom.operators.runs import assert_single_cast, with_run_parts
from gaugeloom.plans.harvests import Harvest, ModelHarvest, model_harvest
from gaugeloom.plans.series import native_series, regular_series
from gaugeloom.schema import DEFAULT_MINUTES, FILL_VALUE, SEQ, STATION, TIME, VALUE
from gaugeloom.session import stage

WINDOW = "window_no"


def windowed_series(
    rows: DataFrame, minutes: int | None = DEFAULT_MINUTES, fill: float = FILL_VALUE, block_minutes: int = BLOCK_MINUTES
) -> DataFrame:
    """The series recipe in each window, and the windows merged: `(station, time, value)`.

    `rows` are observations with the number of their window. Within a window the recipe is that of
    `harvest_series`: every station of the window at every time of the window's axis. Of windows that share a
    station's time the lowest number with a value counts; NULL and the sentinel are none.

    A series is known by window and station together, so one plan serves any number of windows. What
    they found is merged as occupied bins, and the merged grid is unfolded once: times that the same
    windows cover share a roster of stations.
    """
    rows = rows.where(F.col(STATION).isNotNull() & F.col(TIME).isNotNull())
    keyed = rows.select(F.struct(WINDOW, STATION).alias(STATION), TIME, VALUE, SEQ)
    parts = [F.col(STATION)[WINDOW].alias(WINDOW), F.col(STATION)[STATION].alias(STATION)]
    if minutes == 0:
        found = native_series(keyed, block_minutes=block_minutes)
        axis = rows.select(WINDOW, TIME).distinct()
        members = rows.select(WINDOW, STATION).distinct()
    else:
        width = minutes or DEFAULT_MINUTES
        found = regular_series(keyed, width)
        spans = station_spans(bin_counts(keyed, width)).select(*parts, "lo", "hi")
        # The comparison keeps both bounds in the plan, so axis and members share one exchange.
        members = spans.where(F.col("lo") <= F.col("hi")).select(WINDOW, STATION)
        axis = bin_axis(spans, width, (WINDOW,))
    valued = found.select(*parts, TIME, VALUE).where(F.col(VALUE).isNotNull() & (F.col(VALUE) != F.lit(fill)))
    merged = valued.groupBy(STATION, TIME).agg(F.min_by(VALUE, WINDOW).alias(VALUE))

    covered = axis.groupBy(TIME).agg(F.sort_array(F.collect_set(WINDOW)).alias("cover"))
    covers = covered.select("cover").distinct().select("cover", F.explode("cover").alias(WINDOW))
    stations = covers.join(members, WINDOW).select("cover", STATION).distinct()
    return align_in_groups(merged, covered, stations, "cover").withColumn(VALUE, fill_missing(VALUE, fill))


def backfill(windows: list[tuple], harvest: Callable[..., Harvest]) -> DataFrame:
    """Collect all `(start, end)` windows at once and merge; the earlier window of the list stays.

    `harvest` is asked once, for the range from the first start to the last end, so landed data are read in
    one scan that carries this range. Its rows are staged and then dealt to the windows they fall in. A
    sentinel is not a value: where the earlier window had none, the later one's counts.
    """
    whole = harvest(min(min(w) for w in windows), max(max(w) for w in windows))
    spark = whole.rows.sparkSession
    return windowed_series(rows_in_windows(whole.staged, windows_table(spark, windows)), whole.minutes, block_minutes=whole.block_minutes)


def backfill_runs(
    windows: list[tuple], runs: DataFrame, nodes: DataFrame, series: DataFrame, requested: DataFrame | None = None,
    station_nodes: DataFrame | None = None, start: Column | None = None,
) -> DataFrame:
    """Model runs of all windows at once, each window's runs being a batch; merged as in `backfill`.

    A run belongs to every window that its start lies in (`start`, by default what its URL says); runs
    without a start, such as advisories, belong to none. Runs of a batch must agree on their cast, else the
    job fails. Within a window the earlier run's value of a repeated time counts, between windows the
    earlier window's.
    """
    spark = runs.sparkSession
    timed = with_run_parts(runs).withColumn("_start", start if start is not None else F.col("start"))
    placed = rows_in_windows(timed, windows_table(spark, windows), "_start").select(*runs.columns, WINDOW)
    placed = stage(placed, "placed")
    listed = placed.select(*runs.columns).distinct()
    whole: ModelHarvest = model_harvest(listed, nodes, series, requested, station_nodes, single_cast=False)
    batches = assert_single_cast(whole.casts.join(placed.select("url", WINDOW), "url"), WINDOW)
    met = stage(whole.rows, "model").join(placed.select("url", WINDOW), "url")
    checked = met.join(batches.where(F.col("cast").isNotNull()).select(WINDOW), WINDOW)
    return windowed_series(checked.select(WINDOW, STATION, TIME, VALUE, SEQ), 0, block_minutes=whole.block_minutes)
