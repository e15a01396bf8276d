"""Repeated times: keep the first row, report the rest, merge overlapping collections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloom.schema import SEQ, STATION, TIME, VALUE


def dedupe_keep_first(
    df: DataFrame, keys: list[str] | None = None, order: list[str] | None = None
) -> DataFrame:
    """One row per key: the first in `order`, even where its value is NULL.

    `order` must rank the rows of a key without ties. It is an aggregate, not a ranked window:
    copies of a key collapse before the shuffle, so a key repeated a billion times costs one row
    per map task.
    """
    keys = keys or [STATION, TIME]
    order = order or [SEQ]
    rest = [c for c in df.columns if c not in keys]
    others = [c for c in rest if c not in order]
    if len(order) == 1 and len(others) <= 1:
        picks = [F.min_by(c, order[0]).alias(c) for c in others]
        first = df.groupBy(*keys).agg(*picks, F.min(order[0]).alias(order[0]))
    else:
        row = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
        first = df.groupBy(*keys).agg(row).select(*keys, "_row.*")
    return first.select(*df.columns)


def duplicate_report(df: DataFrame, station: str = STATION, time: str = TIME) -> DataFrame:
    """Rows before and after removal of repeated times, per station."""
    per_time = df.groupBy(station, time).agg(F.count("*").alias("_n"))
    return per_time.groupBy(station).agg(
        F.sum("_n").alias("rows_before"),
        F.count("*").alias("rows_after"),
        F.count_if(F.col("_n") > 1).alias("repeated_times"),
        (F.max("_n") > 1).alias("multivalue"),
    )


def concat_order(*parts: DataFrame) -> DataFrame:
    """Stack parts; rows of later parts rank after rows of earlier ones.

    Adds `seq = (part, seq within the part)`, or `(part, time)` where the part has none.
    """
    ranked = []
    for place, part in enumerate(parts):
        inner = F.col(SEQ).cast("bigint") if SEQ in part.columns else F.unix_micros(
            F.col(TIME).cast("timestamp")
        )
        ranked.append(part.withColumn(SEQ, F.struct(F.lit(place).alias("part"), inner.alias("row"))))
    return union_all(*ranked)


def union_all(*parts: DataFrame) -> DataFrame:
    """Stack series of several periods, runs or sources by column name."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def merge_harvests(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Combine overlapping collections; the value seen first stays."""
    columns = [STATION, TIME, VALUE]
    stacked = existing.select(*columns, F.lit(0).alias("_age")).unionByName(
        new.select(*columns, F.lit(1).alias("_age"))
    )
    return dedupe_keep_first(stacked, order=["_age"]).select(*columns)
