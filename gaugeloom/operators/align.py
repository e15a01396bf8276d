"""A common time axis for all stations, and the long / wide forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeloom.functions.times import epoch_us, iso_time
from gaugeloom.functions.values import fill_missing
from gaugeloom.operators.spread import bucket_count
from gaugeloom.schema import DEFAULT_MINUTES, FILL_VALUE, STATION, TIME, VALUE

ROSTER_SIZE = 64
#: Bins of one cell of the ordered output.
CELL_BINS = 128


def align_stations(
    df: DataFrame,
    axis: DataFrame | None = None,
    stations: DataFrame | None = None,
    roster_size: int = ROSTER_SIZE,
) -> DataFrame:
    """Give every station a row (value NULL) for every time any station has.

    The answer has times x stations rows by definition; what is avoided is shuffling them.
    Stations are hashed into rosters of about `roster_size`. Present values are grouped per
    (time, roster), joined to the (time, roster) skeleton, and only then unfolded to one row per
    station of the roster, as the last and narrow step.
    """
    columns = df.select(STATION, TIME, VALUE)
    axis = (axis if axis is not None else columns).select(TIME).distinct()
    stations = (stations if stations is not None else columns).select(STATION).distinct()
    rosters_n = bucket_count(stations, roster_size)
    # Never NULL, so that no null test is pushed into one of two branches that share an exchange.
    roster_of = F.coalesce(F.pmod(F.xxhash64(STATION), rosters_n), F.lit(0))

    rosters = stations.groupBy(roster_of.alias("_roster")).agg(
        F.collect_list(STATION).alias("_members")
    )
    # A skeleton row is small but unfolds to a whole roster; the fixed number of partitions keeps
    # the adaptive plan from packing them by their size before that.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    skeleton = axis.withColumn(
        "_roster", F.explode(F.sequence(F.lit(0).cast("bigint"), rosters_n - F.lit(1)))
    ).repartition(tasks, TIME, "_roster")
    present = columns.groupBy(TIME, roster_of.alias("_roster")).agg(
        F.collect_list(F.struct(STATION, VALUE)).alias("_present")
    )
    cells = skeleton.join(present, [TIME, "_roster"], "left").join(rosters, "_roster")
    here = F.coalesce("_present", F.array().cast("array<struct<station:string,value:double>>"))
    absent = F.transform(
        F.array_except("_members", here[STATION]),
        lambda s: F.struct(s.alias(STATION), F.lit(None).cast("double").alias(VALUE)),
    )
    return cells.select(TIME, F.inline(F.concat(here, absent))).select(STATION, TIME, VALUE)


def align_in_groups(
    df: DataFrame, axis: DataFrame, stations: DataFrame, group: str, roster_size: int = ROSTER_SIZE
) -> DataFrame:
    """As `align_stations`, where each time belongs to a group and a group has stations of its own.

    `axis` has each time once with its group, `stations` the stations of each group. Rosters are of a
    group; the rest is one plan for all groups, so its exchanges do not grow with their number.
    """
    rosters_n = bucket_count(stations.select(STATION).distinct(), roster_size)
    roster_of = F.coalesce(F.pmod(F.xxhash64(STATION), rosters_n), F.lit(0))
    rosters = stations.groupBy(group, roster_of.alias("_roster")).agg(F.collect_list(STATION).alias("_members"))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    skeleton = axis.select(
        TIME, group, F.explode(F.sequence(F.lit(0).cast("bigint"), rosters_n - F.lit(1))).alias("_roster")
    ).repartition(tasks, TIME, "_roster")
    present = df.groupBy(TIME, roster_of.alias("_roster")).agg(F.collect_list(F.struct(STATION, VALUE)).alias("_present"))
    cells = skeleton.join(present, [TIME, "_roster"], "left").join(rosters, [group, "_roster"])
    here = F.coalesce("_present", F.array().cast("array<struct<station:string,value:double>>"))
    absent = F.transform(
        F.array_except("_members", here[STATION]),
        lambda s: F.struct(s.alias(STATION), F.lit(None).cast("double").alias(VALUE)),
    )
    return cells.select(TIME, F.inline(F.concat(here, absent))).select(STATION, TIME, VALUE)


def time_cells(times: DataFrame) -> DataFrame:
    """`(time, _cell)`: distinct times counted along the axis, `CELL_BINS` to a cell, however dense they lie.

    Times are numbered within their hour of the clock; the window over hours sees one row for each.
    """
    placed = times.withColumn("_hour", F.floor(epoch_us(TIME) / F.lit(3_600_000_000)))
    ahead = Window.orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    hours = placed.groupBy("_hour").agg(F.count("*").alias("_n")).select(
        "_hour", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("_hour").orderBy(TIME)
    numbered = placed.withColumn("_rn", F.row_number().over(inside)).join(hours, "_hour")
    place = F.col("_before") + F.col("_rn") - F.lit(1)
    return numbered.select(TIME, F.floor(place / F.lit(CELL_BINS)).alias("_cell"))


def unfold_in_order(
    found: DataFrame, axis: DataFrame, stations: DataFrame, requested: DataFrame | None = None,
    minutes: int = DEFAULT_MINUTES, fill: float = FILL_VALUE,
) -> DataFrame:
    """`align_stations`, filled and in the order of `order_output`, without a sort of the dense grid.

    A cell is a station's stretch of `CELL_BINS` bins of the clock, in native time (`minutes=0`) of as many times
    of the axis: the times in it, and the values found there. Cells are sorted by range over (position, station,
    stretch), and the sorted task unfolds them, so what is shuffled for the order is one row for a hundred or so
    of the output. `found` must have unique (station, time).
    """
    placed, valued = axis.select(TIME).distinct(), found.where(F.col(VALUE).isNotNull())
    if minutes == 0:
        placed = time_cells(placed)
        valued = valued.join(placed, TIME)
    else:
        cell = F.floor(epoch_us(TIME) / F.lit(minutes * 60_000_000 * CELL_BINS))
        placed, valued = (df.withColumn("_cell", cell) for df in (placed, valued))
    times = placed.groupBy("_cell").agg(F.sort_array(F.collect_list(TIME)).alias("_times"))
    members = stations.select(STATION).distinct()
    if requested is None:
        members = members.withColumn("position", F.lit(None).cast("int"))
    else:
        members = with_position(members, requested)
    rosters_n = bucket_count(stations.select(STATION).distinct(), ROSTER_SIZE)
    roster_of = F.coalesce(F.pmod(F.xxhash64(STATION), rosters_n), F.lit(0))
    rosters = members.groupBy(roster_of.alias("_roster")).agg(F.collect_list(F.struct("position", STATION)).alias("_members"))
    tasks = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = times.withColumn("_roster", F.explode(F.sequence(F.lit(0).cast("bigint"), rosters_n - F.lit(1))))
    cells = each.repartition(tasks, "_cell", "_roster").join(rosters, "_roster")
    cells = cells.select("_cell", "_times", F.inline("_members"))
    values = valued.groupBy(STATION, "_cell").agg(
        F.map_from_entries(F.collect_list(F.struct(TIME, VALUE))).alias("_values")
    )
    ordered = cells.join(values, [STATION, "_cell"], "left").orderBy(
        F.col("position").asc_nulls_last(), STATION, "_cell"
    )
    told = F.transform("_times", lambda t: F.struct(t.alias(TIME), F.try_element_at("_values", t).alias(VALUE)))
    return ordered.select(STATION, F.inline(told)).select(STATION, TIME, fill_missing(VALUE, fill).alias(VALUE))


def to_long(wide: DataFrame, id_column: str = "TIME", product: str = "WATER_LEVEL") -> DataFrame:
    """Un-pivot station columns to `TIME, STATION, <PRODUCT>`."""
    stations = [c for c in wide.columns if c != id_column]
    return wide.unpivot(id_column, stations, "STATION", product.upper())


def to_wide(df: DataFrame, stations: list[str]) -> DataFrame:
    """One column per named station. The names are given, so no job has to look for them."""
    return (
        df.groupBy(F.col(TIME).alias("TIME"))
        .pivot(STATION, stations)
        .agg(F.first(VALUE))
    )


def output_form(df: DataFrame, product: str, fill: float = FILL_VALUE) -> DataFrame:
    """The file layout: ISO time text, station, and the value under its product's name."""
    return df.select(
        iso_time(TIME).alias("TIME"),
        F.col(STATION).alias("STATION"),
        fill_missing(VALUE, fill).alias(product.upper()),
    )


def with_position(df: DataFrame, requested: DataFrame) -> DataFrame:
    """Attach the place of each station in the request (its first, if it is listed twice)."""
    places = requested.groupBy(STATION).agg(F.min("position").alias("position"))
    return df.join(places, [STATION], "left")


def order_output(df: DataFrame, requested: DataFrame | None = None) -> DataFrame:
    """Station by station in request order, then by time.

    The sort is a range partitioning on (position, station, time), so a long station is cut over
    several tasks and files instead of filling one.
    """
    if requested is None:
        return df.orderBy(STATION, TIME)
    placed = with_position(df, requested)
    return placed.orderBy(F.col("position").asc_nulls_last(), STATION, TIME)
