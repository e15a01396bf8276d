"""Regular time bins: first value per bin, empty bins, and repair + resample in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeloom.functions.times import epoch_us, from_epoch_us, truncate
from gaugeloom.operators.dedupe import dedupe_keep_first
from gaugeloom.operators.gaps import linear
from gaugeloom.schema import DEFAULT_MINUTES, SEQ, STATION, TIME, VALUE

DAY_MINUTES = 1440
AXIS_RUN = 128


def step(minutes: int) -> Column:
    return F.make_dt_interval(mins=F.lit(minutes))


def bin_origin(df: DataFrame, minutes: int = DEFAULT_MINUTES) -> DataFrame:
    """Add `bin`: the start of the row's bin, counted from midnight of the station's first day.

    Where the bin length divides a day that is the same as counting from any midnight and needs
    no look at the rest of the station. Otherwise the first day is one aggregate per station,
    joined back.
    """
    if DAY_MINUTES % minutes == 0:
        return df.withColumn("bin", F.window(TIME, f"{minutes} minutes")["start"])
    first_day = df.groupBy(STATION).agg(truncate("day", F.min(TIME)).alias("_origin"))
    width = F.lit(minutes * 60_000_000)
    origin = epoch_us("_origin")
    start = origin + F.floor((epoch_us(TIME) - origin) / width) * width
    joined = df.join(first_day, [STATION], "left")
    return joined.withColumn("bin", from_epoch_us(start)).drop("_origin")


def resample_first(df: DataFrame, minutes: int | None = DEFAULT_MINUTES) -> DataFrame:
    """First valid value of each bin, as `(station, time, value)`; bins without one are absent.

    0 returns the rows as they are, None means the default. Times must be unique per station.
    The aggregate is partial before the shuffle, so raw rows do not travel.
    """
    if minutes == 0:
        return df
    binned = bin_origin(df, minutes or DEFAULT_MINUTES)
    return (
        binned.where(F.col(VALUE).isNotNull())
        .groupBy(STATION, "bin")
        .agg(F.min_by(VALUE, TIME).alias(VALUE))
        .select(STATION, F.col("bin").alias(TIME), VALUE)
    )


def dense_bins(df: DataFrame, minutes: int = DEFAULT_MINUTES) -> DataFrame:
    """As `resample_first`, plus a NULL row for each empty bin between a station's ends.

    Each occupied bin unfolds itself up to the next occupied one, so no skeleton is joined. The
    window sees one row per occupied bin, not raw rows.
    """
    bins = (
        bin_origin(df, minutes)
        .groupBy(STATION, "bin")
        .agg(F.min_by(VALUE, F.when(F.col(VALUE).isNotNull(), F.col(TIME))).alias(VALUE))
    )
    following = F.lead("bin").over(Window.partitionBy(STATION).orderBy("bin"))
    last = F.coalesce(following - step(minutes), F.col("bin"))
    return (
        bins.withColumn("_last", last)
        .withColumn(TIME, F.explode(F.sequence("bin", "_last", step(minutes))))
        .select(STATION, TIME, F.when(F.col(TIME) == F.col("bin"), F.col(VALUE)).alias(VALUE))
    )


def bin_heads(binned: DataFrame) -> DataFrame:
    """What gap repair needs to know of each bin: its first, last and first valid row.

    Six mergeable aggregates on rows that carry `bin`. Times must be unique per station.
    """
    v, t = F.col(VALUE), F.col(TIME)
    valid_t = F.when(v.isNotNull(), t)
    return binned.groupBy(STATION, "bin").agg(
        F.min(t).alias("head_t"),
        F.min_by(v, t).alias("head_v"),
        F.max(t).alias("tail_t"),
        F.max_by(v, t).alias("tail_v"),
        F.min(valid_t).alias("valid_t"),
        F.min_by(v, valid_t).alias("valid_v"),
    )


def repair_bins(heads: DataFrame) -> DataFrame:
    """First value of each bin after one-sample gap repair, from `bin_heads`.

    With a limit of one sample only the first row of a bin can turn the bin's answer: if it is
    NULL it is repaired from the last row of the bin before and the next valid point, and any
    later NULL of the bin either follows a valid row (which then is the answer) or a NULL (and
    stays NULL). So the neighbours are looked up among bins, and no window sees raw rows.
    """
    along = Window.partitionBy(STATION).orderBy("bin")
    near = heads.select(
        STATION, "bin", "head_t", "head_v", "valid_v",
        F.lag("tail_t").over(along).alias("_pt"),
        F.lag("tail_v").over(along).alias("_p"),
        F.coalesce("valid_t", F.expr("lead(valid_t) ignore nulls").over(along)).alias("_ntime"),
        F.coalesce("valid_v", F.expr("lead(valid_v) ignore nulls").over(along)).alias("_n"),
    )
    p, n = F.col("_p"), F.col("_n")
    value = (
        F.when(F.col("head_v").isNotNull(), F.col("head_v"))
        .when(
            p.isNotNull() & n.isNotNull(),
            linear(p, F.col("_pt"), n, F.col("_ntime"), F.col("head_t")),
        )
        .otherwise(F.col("valid_v"))
    )
    return near.select(STATION, F.col("bin").alias(TIME), value.alias(VALUE))


def repair_resample(df: DataFrame, minutes: int = DEFAULT_MINUTES) -> DataFrame:
    """One-sample gap repair followed by first-per-bin, on rows with unique times.

    Occupied bins only; the value is NULL where a bin has no valid point. Bins are summed up
    before the shuffle, so raw rows do not travel.
    """
    return repair_bins(bin_heads(bin_origin(df, minutes)))


def bin_counts(df: DataFrame, minutes: int) -> DataFrame:
    """Rows per occupied bin, from two columns of the scan."""
    binned = bin_origin(df.select(STATION, TIME), minutes)
    return binned.groupBy(STATION, "bin").agg(F.count("*").alias("_n"))


def first_heads(obs: DataFrame, minutes: int) -> DataFrame:
    """`bin_heads` of rows that may repeat times; the first by `seq` counts.

    Two mergeable aggregates for all bins alike: copies collapse by `(station, bin, time)` before they
    are shuffled, and a bin is summed up from partial sums of its times. So neither a hot station nor
    one row copied without end makes a task larger than others.
    """
    binned = bin_origin(obs.select(STATION, TIME, VALUE, SEQ), minutes)
    return bin_heads(dedupe_keep_first(binned, [STATION, "bin", TIME]))


def station_spans(counts: DataFrame) -> DataFrame:
    """First and last occupied bin of each station, from `bin_counts`."""
    # The test keeps the count in the plan, so every reader of the counts shares one exchange.
    return counts.where(F.col("_n") > 0).groupBy(STATION).agg(
        F.min("bin").alias("lo"), F.max("bin").alias("hi")
    )


def bin_axis(spans: DataFrame, minutes: int, by: tuple[str, ...] = ()) -> DataFrame:
    """Every bin between the ends of any station: the common axis after `dense_bins`, for each value of `by`.

    Spans are cut into runs of `AXIS_RUN` bins first. Stations share nearly all of their runs, so
    these collapse to few before any bin is unfolded. The fixed number of partitions keeps the
    adaptive plan from packing the (small) spans into one task that would cut them all.
    """
    width = minutes * 60_000_000
    tasks = int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    phase = F.pmod(epoch_us("lo"), F.lit(width))
    numbered = spans.select(*by, "lo", "hi").distinct().repartition(tasks, *by, "lo", "hi").select(
        *by,
        phase.alias("_phase"),
        F.floor(epoch_us("lo") / F.lit(width)).alias("_first"),
        F.floor(epoch_us("hi") / F.lit(width)).alias("_last"),
    )
    first_run, last_run = (F.floor(F.col(c) / F.lit(AXIS_RUN)) for c in ("_first", "_last"))
    runs = numbered.withColumn("_run", F.explode(F.sequence(first_run, last_run))).select(
        *by, "_phase",
        F.greatest("_first", F.col("_run") * AXIS_RUN).alias("_a"),
        F.least("_last", F.col("_run") * AXIS_RUN + (AXIS_RUN - 1)).alias("_b"),
    ).distinct()
    bins = runs.select(*by, "_phase", F.explode(F.sequence("_a", "_b")).alias("_k")).distinct()
    return bins.select(*by, from_epoch_us(F.col("_k") * F.lit(width) + F.col("_phase")).alias(TIME))
