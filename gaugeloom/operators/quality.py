"""What was kept, what was left out and why."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloom.schema import FILL_VALUE, REQUEST_ROW_CAP, STATION, TIME, VALUE


def station_counts(series: DataFrame) -> DataFrame:
    """Rows and valid rows per station."""
    return series.groupBy(STATION).agg(F.count("*").alias("rows"), F.count(VALUE).alias("valid"))


def excluded_stations(requested: DataFrame, series: DataFrame, few: int = 2) -> DataFrame:
    """Requested stations without a usable series, or with fewer than `few` points, and the reason."""
    counts = station_counts(series)
    rows = F.coalesce("rows", F.lit(0))
    valid = F.coalesce("valid", F.lit(0))
    reason = (
        F.when(rows == 0, F.lit("no data"))
        .when(valid == 0, F.lit("no valid values"))
        .when(valid < few, F.lit("too few points to repair gaps"))
    )
    return (
        requested.select(STATION).distinct()
        .join(counts, STATION, "left")
        .select(STATION, rows.alias("rows"), valid.alias("valid"), reason.alias("reason"))
        .where(F.col("reason").isNotNull())
    )


def harvest_counts(requested: DataFrame, data: DataFrame, meta: DataFrame) -> DataFrame:
    """Included and excluded stations, for data and for metadata, in one row."""
    asked = requested.select(STATION).distinct()
    has_data = data.select(STATION).distinct().withColumn("_data", F.lit(1))
    has_meta = meta.select(F.col("STATION").alias(STATION)).distinct().withColumn("_meta", F.lit(1))
    joined = asked.join(has_data, STATION, "left").join(has_meta, STATION, "left")
    return joined.agg(
        F.count("_data").alias("data_included"),
        F.count_if(F.col("_data").isNull()).alias("data_excluded"),
        F.count("_meta").alias("meta_included"),
        F.count_if(F.col("_meta").isNull()).alias("meta_excluded"),
    )


def missing_report(df: DataFrame, fill: float = FILL_VALUE) -> DataFrame:
    """Rows, missing rows (NULL or sentinel), their share, and the time span, per station."""
    missing = F.col(VALUE).isNull() | (F.col(VALUE) == F.lit(fill))
    return df.groupBy(STATION).agg(
        F.count("*").alias("rows"),
        F.count_if(missing).alias("missing"),
        (F.count_if(missing) / F.count("*")).alias("missing_share"),
        F.min(TIME).alias("first_time"),
        F.max(TIME).alias("last_time"),
    )


def drop_empty_stations(df: DataFrame) -> DataFrame:
    """Remove stations whose every value is NULL."""
    alive = df.where(F.col(VALUE).isNotNull()).select(STATION).distinct()
    return df.join(alive, [STATION], "left_semi")


def row_cap_check(df: DataFrame, period: list[str], cap: int = REQUEST_ROW_CAP) -> DataFrame:
    """Requests that came back full, so that the provider may have cut them."""
    counted = df.groupBy(STATION, *period).agg(F.count("*").alias("rows"))
    return counted.withColumn("at_cap", F.col("rows") >= cap)
