"""Planning requests: day periods, windows, manifests and row-to-period joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeloom.functions.runs import request_query
from gaugeloom.functions.times import _col, clamp_end, cycle_times, ntz, ordered, truncate
from gaugeloom.schema import REQUEST_ROW_CAP, SENSOR_CLASSES, STATION, TIME, TIME_ZONE

DAY_END = 86_399  # seconds into a day at 23:59:59


def time_literal(value) -> Column:
    return value if isinstance(value, Column) else ntz(F.lit(value))


def daily_periods(df: DataFrame, start="start", end="end", as_of=None) -> DataFrame:
    """Cut each row's range at midnights, adding `period_start` and `period_end`.

    Ends given in reverse are swapped and no end passes `as_of`. All but the last period end at
    23:59:59; an end exactly at midnight makes no period of its own. `start` and `end` are column
    names or Columns. A row unfolds in place: no shuffle.
    """
    lo, hi = ordered(_col(start), _col(end))
    if as_of is not None:
        hi = clamp_end(hi, time_literal(as_of))
    lo, hi = truncate("second", lo), truncate("second", hi)
    ranged = df.withColumns({"_lo": lo, "_hi": hi}).where(F.col("_lo") < F.col("_hi"))
    days = F.sequence(
        truncate("day", "_lo"), F.col("_hi"), F.make_dt_interval(days=F.lit(1))
    )
    cut = ranged.withColumn("_day", F.explode(days)).where(F.col("_day") < F.col("_hi"))
    day_end = F.col("_day") + F.make_dt_interval(secs=F.lit(DAY_END))
    return cut.withColumns({
        "period_start": F.greatest("_day", "_lo"),
        "period_end": F.least(day_end, F.col("_hi")),
    }).drop("_lo", "_hi", "_day")


def harvest_manifest(stations: DataFrame, start, end, as_of=None) -> DataFrame:
    """One request per station and day period. Each station row unfolds its own periods.

    A list of stations is a small file of few tasks, and unfolds to many times its rows: stations are dealt out
    first, to a fixed number of partitions that the adaptive plan does not pack by their size.
    """
    tasks = int(stations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stations.repartition(tasks, STATION).withColumns({"_from": time_literal(start), "_to": time_literal(end)})
    return daily_periods(ranged, "_from", "_to", as_of).drop("_from", "_to")


def gauge_requests(manifest: DataFrame, product_class: str) -> DataFrame:
    """The query text of each manifest row; credentials are the caller's to add."""
    stamp = "yyyy-MM-dd HH:mm:ss"
    query = request_query({
        "method": F.lit("GetSensorData"),
        "class": F.lit(SENSOR_CLASSES[product_class]),
        "site_id": F.col(STATION),
        "tz": F.lit(TIME_ZONE),
        "data_start": F.date_format("period_start", stamp),
        "data_end": F.date_format("period_end", stamp),
    })
    return manifest.withColumn("query", query)


def cycles(df: DataFrame, start="start", end="end", as_of=None, legacy_start=False) -> DataFrame:
    """One row per model cycle in each row's range, as `cycle`."""
    limit = None if as_of is None else time_literal(as_of)
    stamps = cycle_times(start, end, limit, legacy_start=legacy_start)
    return df.withColumn("cycle", F.explode(stamps))


def overlapping_windows(df: DataFrame, anchor, length_days: int, step_days: int, n: int) -> DataFrame:
    """`n` windows of `length_days`, each starting `step_days` after the one before."""
    numbered = df.withColumn("window_no", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    start = _col(anchor) + F.make_dt_interval(days=F.col("window_no") * step_days)
    return numbered.withColumn("window_start", start).withColumn(
        "window_end", F.col("window_start") + F.make_dt_interval(days=F.lit(length_days))
    )


def sliding_windows(
    df: DataFrame, length_days: int, step_days: int, offset_days: int = 0, time: str = TIME
) -> DataFrame:
    """Each row once per window it falls in; `offset_days` moves the grid off the epoch."""
    w = F.window(time, f"{length_days} days", f"{step_days} days", f"{offset_days} days")
    return df.withColumn("_w", w).withColumns(
        {"window_start": F.col("_w.start"), "window_end": F.col("_w.end")}
    ).drop("_w")


def windows_table(spark: SparkSession, windows: list[tuple]) -> DataFrame:
    """`(window_no, window_start, window_end)` of a list of ranges, numbered in its order."""
    rows = [(n, str(start), str(end)) for n, (start, end) in enumerate(windows)]
    table = spark.createDataFrame(rows, "window_no int, a string, b string")
    lo, hi = ordered(ntz("a"), ntz("b"))
    return table.select("window_no", lo.alias("window_start"), hi.alias("window_end"))


def rows_in_windows(df: DataFrame, windows: DataFrame, time: str = TIME) -> DataFrame:
    """Each row once for every window it falls in, both ends included, as `window_no`.

    Windows may overlap and leave gaps. A window is listed under the days it touches, so rows find theirs by
    day, and a row only meets windows of its own day.
    """
    days = F.sequence(F.to_date("window_start"), F.to_date("window_end"), F.make_dt_interval(days=F.lit(1)))
    listed = windows.select("window_no", "window_start", "window_end", F.explode(days).alias("_day"))
    met = df.withColumn("_day", F.to_date(time)).join(listed, "_day")
    return met.where(F.col(time).between(F.col("window_start"), F.col("window_end"))).drop(
        "_day", "window_start", "window_end"
    )


def in_period(time: str = TIME) -> Column:
    """Whether a row lies in its period. A period that ends at 23:59:59 runs up to midnight: that end is
    how a request is written, and the next period begins a second later."""
    t, end = F.col(time), F.col("period_end")
    midnight = truncate("day", "period_end") + F.make_dt_interval(days=F.lit(1))
    last_second = end + F.make_dt_interval(secs=F.lit(1)) == midnight
    return (t >= F.col("period_start")) & ((t <= end) | (last_second & (t < midnight)))


def range_bucket_join(
    obs: DataFrame, periods: DataFrame, on: list[str] | None = None, time: str = TIME
) -> DataFrame:
    """Rows with the period they fall in. A period lies within one day, so the day is an equi key.

    Every row inside the range that was cut into periods gets one, those of a day's last second too.
    How the periods travel is Spark's choice from their true size.
    """
    on = on or []
    days = periods.withColumn("_day", F.to_date("period_start"))
    rows = obs.withColumn("_day", F.to_date(time))
    return rows.join(days, [*on, "_day"], "inner").where(in_period(time)).drop("_day")


def plan_periods(plan: DataFrame) -> DataFrame:
    """The distinct periods of a plan, joined by shuffles. Spark takes a plan to be as small as the list of stations
    it unfolds from, and would broadcast all periods of a long one to every task."""
    return plan.select(STATION, "period_start", "period_end").distinct().hint("merge")


def request_ledger(manifest: DataFrame, obs: DataFrame, cap: int = REQUEST_ROW_CAP) -> DataFrame:
    """The manifest with what each request brought: `rows` landed in its period, and `status`.

    `missing`: nothing landed. `full`: `cap` rows or more, so the provider may have cut them. `stuck`: full, and
    the period is too short to be cut. `done`: all others. Rows are counted where they landed, one day's
    periods against that day's rows.
    """
    periods = plan_periods(manifest)
    found = range_bucket_join(obs, periods, on=[STATION]).groupBy(*periods.columns).agg(F.count("*").alias("rows"))
    counted = manifest.join(found, periods.columns, "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    short = F.col("period_end") < F.col("period_start") + F.make_dt_interval(secs=F.lit(2))
    status = (
        F.when(F.col("rows") == 0, "missing").when((F.col("rows") >= cap) & short, "stuck")
        .when(F.col("rows") >= cap, "full").otherwise("done")
    )
    return counted.withColumn("status", status).select(*manifest.columns, "rows", "status")


def next_requests(ledger: DataFrame, missing: bool = True) -> DataFrame:
    """What the next round has to ask for: missing periods again (unless told otherwise), and full ones as two
    halves.

    Halves meet in one second, which both hold: requests are told in whole seconds, so nothing between them is
    lost, and repeated times go with the recipe's first step.
    """
    open_ = ledger.where(F.col("status").isin("full", *(["missing"] if missing else [])))
    half = F.floor(F.unix_seconds(F.col("period_end").cast("timestamp")) / 2 + F.unix_seconds(F.col("period_start").cast("timestamp")) / 2)
    middle = F.timestamp_seconds(half).cast("timestamp_ntz")
    whole = F.array(F.struct(F.col("period_start").alias("a"), F.col("period_end").alias("b")))
    halves = F.array(
        F.struct(F.col("period_start").alias("a"), middle.alias("b")), F.struct(middle.alias("a"), F.col("period_end").alias("b"))
    )
    cut = open_.withColumn("_p", F.explode(F.when(F.col("status") == "full", halves).otherwise(whole)))
    return cut.withColumns({"period_start": F.col("_p.a"), "period_end": F.col("_p.b")}).drop("_p", "rows", "status", "query")
