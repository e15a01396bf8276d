"""From generic product names to what a provider calls them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeloom.functions.values import nan_to_null, sensor_name
from gaugeloom.schema import (
    SENSOR_CLASSES, STATION, TIME, VALUE, product_table, provider_field,
)


def product_value(source: str, product: str) -> Column:
    """The provider column of a product, as `value`; an unknown source or product is refused."""
    return nan_to_null(F.col(provider_field(source, product))).alias(VALUE)


def select_product(df: DataFrame, source: str, product: str, time: str = TIME) -> DataFrame:
    """A product of a table with one column per product, as `(station, time, value)`.

    Only the product's own column is read.
    """
    return df.select(STATION, F.col(time).alias(TIME), product_value(source, product))


def select_sensor_class(df: DataFrame, product: str, column: str = "class") -> DataFrame:
    """Rows of a gauge product, by sensor class."""
    return df.where(F.col(column) == SENSOR_CLASSES[provider_field("CONTRAILS", product)])


def with_provider_column(df: DataFrame) -> DataFrame:
    """Rows that name a `product`, with every source that offers it and its column or class."""
    # A dozen rows, fixed in the code: safe to broadcast.
    return df.join(F.broadcast(product_table(df.sparkSession)), "product")


def with_sensor_name(df: DataFrame, column: str = "class") -> DataFrame:
    """Add the sensor name of each class code."""
    return df.withColumn("sensor", sensor_name(column))
