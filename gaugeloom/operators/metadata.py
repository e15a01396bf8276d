"""Station metadata: standard columns, key/value form, site lookup, and data in step with it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeloom.functions.values import empty_to_null, fill_missing_text
from gaugeloom.schema import META_KEYS, SENSOR_CLASSES, STATION, TIME_ZONE, UNITS


def standard_meta(df: DataFrame, owner: str | Column) -> DataFrame:
    """`STATION` and the eight metadata columns; what the input lacks becomes NULL."""
    have = {c.upper(): c for c in df.columns}
    fixed = {
        "UNITS": F.lit(UNITS),
        "TZ": F.lit(TIME_ZONE),
        "OWNER": F.lit(owner) if isinstance(owner, str) else owner,
    }
    columns = []
    for key in META_KEYS:
        kind = "double" if key in ("LAT", "LON") else "string"
        if key in fixed:
            column = fixed[key]
        elif key in have:
            column = F.col(have[key])
        else:
            column = F.lit(None)
        column = column.try_cast(kind) if kind == "double" else column.cast(kind)
        columns.append(column.alias(key))
    return df.select(F.col(have["STATION"]).alias("STATION"), *columns)


def clean_fields(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: empty_to_null(c) for c in columns})


def meta_from_kv(kv: DataFrame) -> DataFrame:
    """`(station, key, value)` rows turned into one row per station."""
    return kv.groupBy(F.col(STATION).alias("STATION")).pivot("key", META_KEYS).agg(F.first("value"))


def meta_to_kv(meta: DataFrame) -> DataFrame:
    """One row per station turned into `(station, key, value)` rows."""
    text = meta.select("STATION", *[F.col(c).cast("string").alias(c) for c in META_KEYS])
    return text.unpivot("STATION", META_KEYS, "key", "value").withColumnRenamed("STATION", STATION)


def filled_meta(meta: DataFrame) -> DataFrame:
    """Text form for the file, the sentinel in every empty field."""
    return meta.select(
        "STATION", *[fill_missing_text(F.col(c).cast("string")).alias(c) for c in META_KEYS]
    )


def resolve_site(sensors: DataFrame, sites: DataFrame, sensor: str) -> DataFrame:
    """Site position of each station's first sensor of a class, in two hops.

    `sensors` may carry `position` (row order in the provider's answer); ties go to the lowest
    sensor id.
    """
    code = str(SENSOR_CLASSES[sensor])
    rank = [F.col(c) for c in ("position", "or_sensor_id") if c in sensors.columns]
    first = (
        sensors.where(F.col("sensor_class").cast("string") == code)
        .groupBy("site_id")
        .agg(F.min_by(F.struct("or_site_id", "or_sensor_id", "location"), F.struct(*rank)).alias("_s"))
        .select(F.col("site_id").alias(STATION), "_s.*")
    )
    located = sites.select("or_site_id", "latitude_dec", "longitude_dec",
                           F.col("location").alias("site_location"))
    name = F.when(F.col("site_location") != "", F.col("location"))
    return first.join(located, "or_site_id").select(
        STATION, "or_site_id", "or_sensor_id",
        empty_to_null("latitude_dec").alias("LAT"),
        empty_to_null("longitude_dec").alias("LON"),
        name.alias("NAME"),
    )


def attach_meta(data: DataFrame, meta: DataFrame) -> DataFrame:
    """Data rows with their station's metadata; rows without any stay."""
    keyed = meta.withColumnRenamed("STATION", STATION)
    return data.join(keyed, [STATION], "left")


def data_without_meta(data: DataFrame, meta: DataFrame) -> DataFrame:
    """Stations that have data but no metadata."""
    return data.select(STATION).distinct().join(
        meta.select(F.col("STATION").alias(STATION)), STATION, "left_anti"
    )


def meta_without_data(data: DataFrame, meta: DataFrame) -> DataFrame:
    """Stations that have metadata but no data."""
    return meta.select(F.col("STATION").alias(STATION)).distinct().join(
        data.select(STATION).distinct(), STATION, "left_anti"
    )
