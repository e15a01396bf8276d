"""Complete collection runs over landed data."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloom.functions.runs import grid_cast_name, to_nowcast_url
from gaugeloom.functions.times import day_slice, time_slice
from gaugeloom.functions.values import convert_units, mask_below
from gaugeloom.operators.gaps import BLOCK_MINUTES, MODEL_BLOCK_MINUTES
from gaugeloom.operators.matching import (
    node_pairs, of_listed_days, of_listed_runs, requested_pairs, unmatched_stations,
)
from gaugeloom.operators.metadata import resolve_site, standard_meta
from gaugeloom.operators.periods import (
    gauge_requests, harvest_manifest, plan_periods, range_bucket_join, request_ledger,
)
from gaugeloom.operators.products import select_sensor_class
from gaugeloom.operators.quality import excluded_stations, harvest_counts, row_cap_check
from gaugeloom.operators.runs import (
    assert_single_cast, first_nonempty, first_valid_meta, run_cast, with_run_parts,
)
from gaugeloom.plans.series import harvest_series
from gaugeloom.schema import (
    DAY, DEFAULT_MINUTES, GAUGE_GROUPS, OWNERS, REQUEST_ROW_CAP, SEQ, STATION, TIME, VALUE, harvest_product,
)
from gaugeloom.session import stage
from gaugeloom.sinks.files import write_meta, write_series


@dataclass
class Harvest:
    """One run. `rows` are its observations, not yet repaired; the rest is made when asked for."""

    source: str
    product: str
    requested: DataFrame
    rows: DataFrame
    meta: DataFrame
    minutes: int | None = DEFAULT_MINUTES
    stop: str | datetime | None = None
    ledger: DataFrame | None = None
    block_minutes: int = BLOCK_MINUTES

    @cached_property
    def staged(self) -> DataFrame:
        """The rows as a table in the shared folder: landed text is parsed and joined once."""
        return stage(self.rows.select(STATION, TIME, VALUE, SEQ), self.source.lower())

    @cached_property
    def data(self) -> DataFrame:
        """Repaired, resampled, aligned and filled series."""
        return harvest_series(self.staged, self.minutes, block_minutes=self.block_minutes)

    @cached_property
    def excluded(self) -> DataFrame:
        """Requested stations without a usable series, and why."""
        return excluded_stations(self.requested, self.staged)

    @cached_property
    def counts(self) -> DataFrame:
        """Stations with and without data, and with and without metadata, in one row."""
        return harvest_counts(self.requested, self.staged, self.meta)

    def tag(self) -> str:
        """The part of the file names that tells this run from others."""
        if self.stop is None:
            raise ValueError("this run has no stop time to be named by")
        return "_".join(p for p in (GAUGE_GROUPS.get(self.product), iso_text(self.stop)) if p)

    def write(self, root: str, tag: str | None = None) -> tuple[str, str]:
        """Write data and metadata; the names follow from the run unless a tag is given."""
        tag = tag or self.tag()
        data = write_series(self.staged, root, self.source, tag, self.product, self.requested, self.minutes, self.block_minutes)
        return data, write_meta(self.meta, root, self.source, tag)


def iso_text(time: str | datetime) -> str:
    """A time as file names have it."""
    parsed = time if isinstance(time, datetime) else datetime.fromisoformat(time)
    return parsed.strftime("%Y-%m-%dT%H:%M:%S")


def back_from(stop: str | datetime, ndays: int) -> tuple[datetime, datetime]:
    """Start and end of a run given its stop time and a number of days, negative to look back."""
    end = stop if isinstance(stop, datetime) else datetime.fromisoformat(stop)
    other = end + timedelta(days=ndays)
    return min(end, other), max(end, other)


def _of_range(obs: DataFrame, start, end) -> DataFrame:
    """Rows of a range; landed in folders by day, only the range's folders are read."""
    days = obs.where(day_slice(DAY, start, end)) if DAY in obs.columns else obs
    return days.where(time_slice(TIME, start, end))


def _of_stations(obs: DataFrame, requested: DataFrame) -> DataFrame:
    wanted = requested.select(STATION).distinct()
    return obs.join(wanted, [STATION], "left_semi")


def tide_harvest(
    obs: DataFrame,
    meta: DataFrame,
    requested: DataFrame,
    start,
    end,
    product: str = "water_level",
    minutes: int | None = DEFAULT_MINUTES,
) -> Harvest:
    """Tide gauges: one inclusive range, values already in metres.

    `obs` comes from `read_tide_obs` for the same product. An hourly product on the default grid
    leaves three of four bins at the sentinel; give `minutes=60` for it.
    """
    harvest_product("NOAA", product)
    sliced = _of_stations(_of_range(obs, start, end), requested)
    known = meta.join(
        requested.select(F.col(STATION).alias("STATION")).distinct(), "STATION", "left_semi"
    )
    return Harvest("NOAA", product, requested, sliced, known, minutes, end)


def gauge_harvest(
    obs: DataFrame,
    sensors: DataFrame,
    sites: DataFrame,
    requested: DataFrame,
    start,
    end,
    product: str = "river_water_level",
    minutes: int | None = DEFAULT_MINUTES,
    plan: DataFrame | None = None,
    cap: int = REQUEST_ROW_CAP,
) -> Harvest:
    """River or coastal gauges: values in feet, metadata from the sensor and site tables.

    Of the observations only those of the product's sensor class count. With a `plan` (`gauge_plan`, or what
    `next_requests` left of it) only rows in its stations' periods are read, and the run's `ledger` says
    what each request brought, so that the next round is `next_requests(run.ledger)`.
    """
    sensor = harvest_product("CONTRAILS", product)
    own = select_sensor_class(obs, product)
    sliced, ledger = _of_stations(_of_range(own, start, end), requested), None
    if plan is not None:
        ledger = request_ledger(plan, sliced, cap)
        sliced = range_bucket_join(sliced, plan_periods(plan), on=[STATION]).drop("period_start", "period_end")
    metric = sliced.withColumn(VALUE, convert_units(VALUE))
    located = resolve_site(sensors, sites, sensor).join(
        requested.select(STATION).distinct(), STATION, "left_semi"
    )
    meta = standard_meta(located, OWNERS["CONTRAILS"])
    return Harvest("CONTRAILS", product, requested, metric, meta, minutes, end, ledger)


def gauge_plan(
    requested: DataFrame, start, end, product: str = "river_water_level", as_of=None
) -> DataFrame:
    """What a gauge collection has to ask for: one query per station and day period."""
    sensor = harvest_product("CONTRAILS", product)
    return gauge_requests(harvest_manifest(requested, start, end, as_of), sensor)


def capped_requests(obs: DataFrame, plan: DataFrame, cap: int = REQUEST_ROW_CAP) -> DataFrame:
    """Rows each planned request brought, and whether it may have been cut at the provider's cap."""
    placed = range_bucket_join(obs, plan_periods(plan), on=[STATION])
    return row_cap_check(placed, ["period_start", "period_end"], cap)


@dataclass
class ModelHarvest(Harvest):
    """A model run. The ensemble of the first URL names its metadata; `meta_with_cast` tells the computed cast
    of the batch beside it."""

    casts: DataFrame | None = None
    unmatched: DataFrame | None = None
    runs: DataFrame | None = None
    meta_with_cast: DataFrame | None = None

    def tag(self) -> str:
        """Ensemble, grid and start (or advisory) of the first run: one row comes to the driver."""
        first = with_run_parts(first_nonempty(self.runs)).select("ensemble", F.upper("grid"), "label").first()
        return "_".join(first)


def model_harvest(
    runs: DataFrame,
    nodes: DataFrame,
    series: DataFrame,
    requested: DataFrame | None = None,
    station_nodes: DataFrame | None = None,
    single_cast: bool = True,
) -> ModelHarvest:
    """Ocean model: all runs of a batch in one scan, native time steps.

    Stations are found by name in the runs (`requested`), or by the curated node table
    (`station_nodes`). Runs without landed data add nothing. Repeated times of overlapping runs
    keep the earlier run's value. A batch that mixes forecasts and nowcasts fails when the result
    is read, unless `single_cast` is off.

    The `(station, node)` pairs are staged first: they are few, and with their true size known
    Spark cuts the model output down to them in the scan's own tasks.
    """
    listed = runs.where(F.col("url") != "")
    # Folders outside the list stay closed; other runs go where the list is joined for what it says of a run.
    series = of_listed_days(series, listed)
    if station_nodes is not None:
        pairs = stage(node_pairs(station_nodes), "pairs")
        requested = station_nodes.select(
            (F.col("serial_nr") - 1).alias("position"), F.col("stationid").alias(STATION)
        )
        unmatched = unmatched_nodes(pairs, of_listed_runs(series, listed))
    else:
        landed = nodes.join(listed.select("url"), ["url"], "left_semi")
        pairs = stage(requested_pairs(requested, landed), "pairs")
        unmatched = unmatched_stations(requested, landed)

    casts = run_cast(series, listed)
    whole = casts.withColumn("batch", F.lit("of this request"))
    cast = assert_single_cast(whole).select("cast").scalar() if single_cast else F.lit(None).cast("string")

    wanted = series.join(pairs, ["node_idx"], "inner")
    placed = wanted.join(listed.select("url", F.col("position").alias("_run")), ["url"], "inner")
    rows = (placed.where(cast.isNotNull()) if single_cast else placed).select(
        "url", STATION, TIME, mask_below("zeta").alias(VALUE),
        (F.col("_run").cast("bigint") * F.lit(1 << 32) + F.col("node_idx")).alias(SEQ),
    )

    name = with_run_parts(first_nonempty(runs)).select(grid_cast_name("grid", "ensemble")).scalar()
    found = first_valid_meta(pairs, nodes, listed)
    meta = standard_meta(
        found.select(
            STATION, F.col("y").alias("LAT"), F.col("x").alias("LON"), name.alias("NAME"), "source"
        ),
        F.col("source"),
    )
    return ModelHarvest(
        "ASGS", "water_level", requested, rows, meta, 0, casts=casts, unmatched=unmatched, runs=runs,
        meta_with_cast=meta.withColumn("CAST", cast), block_minutes=MODEL_BLOCK_MINUTES,
    )


def unmatched_nodes(pairs: DataFrame, series: DataFrame) -> DataFrame:
    """Curated stations whose node none of the given series has."""
    return pairs.join(series.select("node_idx").distinct(), "node_idx", "left_anti").select(STATION)


@dataclass
class Pair:
    """A forecast and its nowcast. Each run is planned when it is asked for; `status` needs neither."""

    runs: DataFrame
    nodes: DataFrame
    series: DataFrame
    requested: DataFrame
    status: DataFrame

    @cached_property
    def forecast(self) -> ModelHarvest:
        return model_harvest(self.runs, self.nodes, self.series, self.requested)

    @cached_property
    def nowcast(self) -> ModelHarvest:
        return model_harvest(twins_of(self.runs), self.nodes, self.series, self.requested)


def twins_of(runs: DataFrame) -> DataFrame:
    """The nowcast run of each run."""
    return runs.withColumn("url", to_nowcast_url("url"))


def forecast_nowcast_pair(
    runs: DataFrame, nodes: DataFrame, series: DataFrame, requested: DataFrame
) -> Pair:
    """The given runs, then their nowcast twins; a missing nowcast is reported, not fatal."""
    asked = runs.select("url", F.lit("forecast").alias("kind")).unionByName(
        twins_of(runs).select("url", F.lit("nowcast").alias("kind"))
    )
    landed = of_listed_runs(series, asked).select("url").distinct().withColumn("_has", F.lit(1))
    status = asked.join(landed, "url", "left").groupBy("kind").agg(
        F.count("*").alias("runs_asked"),
        F.count("_has").alias("runs_present"),
        (F.count("_has") == 0).alias("failed"),
    )
    return Pair(runs, nodes, series, requested, status)
