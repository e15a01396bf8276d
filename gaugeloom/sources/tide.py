"""Landed tide-gauge answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeloom.functions.values import empty_to_null, stable_order
from gaugeloom.operators.metadata import standard_meta
from gaugeloom.operators.products import product_value
from gaugeloom.schema import DAY, OWNERS, SEQ, STATION, TIDE_META_SCHEMA, TIDE_OBS_SCHEMA, TIME, VALUE


def read_tide_obs(
    spark: SparkSession, path: str, product: str = "water_level", fmt: str = "json"
) -> DataFrame:
    """One product as `(station, time, value, seq)`; only its column is read.

    Where files lie in folders `day=<date>` (`write_landed`), the day is given too, and a run's range then
    keeps other days' files from being opened. `seq` is the row's place in the provider's answer where the landed files carry it. Else a
    repeated time keeps one of its values, always the same one.
    """
    reader = spark.read.schema(TIDE_OBS_SCHEMA)
    if fmt == "csv":
        reader = reader.option("header", True)
    rows = reader.format(fmt).load(path)
    value = product_value("NOAA", product)
    days = [DAY] if DAY in rows.columns else []
    return rows.select(STATION, F.col("date_time").alias(TIME), value, SEQ, *days).withColumn(
        SEQ, F.coalesce(SEQ, stable_order(VALUE))
    )


def read_tide_meta(spark: SparkSession, path: str) -> DataFrame:
    """Station metadata in the standard nine columns; `''` is missing, COUNTY is not given."""
    raw = spark.read.schema(TIDE_META_SCHEMA).json(path)
    named = raw.select(
        STATION,
        empty_to_null("lat").alias("LAT"),
        empty_to_null("lng").alias("LON"),
        empty_to_null("name").alias("NAME"),
        empty_to_null("state").alias("STATE"),
    )
    return standard_meta(named, OWNERS["NOAA"])
