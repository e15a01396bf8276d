"""Landed river and coastal gauge answers (XML)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeloom.functions.values import convert_units, nan_to_null, stable_order
from gaugeloom.operators.metadata import resolve_site, standard_meta
from gaugeloom.operators.products import select_sensor_class
from gaugeloom.schema import (
    DAY, GAUGE_OBS_SCHEMA, GAUGE_SENSOR_SCHEMA, GAUGE_SITE_SCHEMA, OWNERS, SEQ, STATION, TIME, VALUE, harvest_product,
)

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def _xml(spark: SparkSession, path: str, schema) -> DataFrame:
    return (
        spark.read.format("xml")
        .option("rowTag", "row")
        .option("nullValue", "")
        .option("timestampNTZFormat", TIME_FORMAT)
        .schema(schema)
        .load(path)
    )


def read_gauge_obs(spark: SparkSession, path: str, product: str | None = None) -> DataFrame:
    """`(station, class, time, value, seq)` in the provider's unit (feet).

    Files lie under `class=<code>/station=<id>/`, so naming a product prunes the folders read; with a
    further level `day=<date>` the day is given too, and a run's range prunes by it. `seq` is the row's place in the provider's answer where the landed rows carry it; else a repeated time keeps
    one of its values, always the same one.
    """
    folders = [T.StructField("class", T.IntegerType()), T.StructField(STATION, T.StringType())]
    raw = _xml(spark, path, T.StructType([*GAUGE_OBS_SCHEMA.fields, *folders]))
    if product is not None:
        raw = select_sensor_class(raw, product)
    return raw.select(
        STATION,
        "class",
        F.col("data_time").alias(TIME),
        nan_to_null("data_value").alias(VALUE),
        F.coalesce(SEQ, stable_order("data_value")).alias(SEQ),
        *([DAY] if DAY in raw.columns else []),
    )


def read_product(spark: SparkSession, path: str, product: str = "river_water_level") -> DataFrame:
    """`(station, time, value, seq)` of one product in metres."""
    return read_gauge_obs(spark, path, product).select(STATION, TIME, convert_units(VALUE).alias(VALUE), SEQ)


def read_meta(spark: SparkSession, path: str, product: str = "river_water_level") -> DataFrame:
    """Standard metadata of one product's gauges, from the folders `sensors` and `sites` of `path`."""
    sensors, sites = read_gauge_sensor_meta(spark, f"{path}/sensors"), read_gauge_site_meta(spark, f"{path}/sites")
    return standard_meta(resolve_site(sensors, sites, harvest_product("CONTRAILS", product)), OWNERS["CONTRAILS"])


def read_gauge_sensor_meta(spark: SparkSession, path: str) -> DataFrame:
    return _xml(spark, path, GAUGE_SENSOR_SCHEMA)


def read_gauge_site_meta(spark: SparkSession, path: str) -> DataFrame:
    return _xml(spark, path, GAUGE_SITE_SCHEMA)
