"""Column functions on measured values and registry names."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeloom.functions.times import _col
from gaugeloom.schema import DRY_NODE_LIMIT, FEET_TO_METRES, FILL_VALUE, SENSOR_CLASSES, SOURCES


def nan_to_null(c: Column | str) -> Column:
    c = _col(c)
    return F.when(~F.isnan(c), c)


def mask_below(c: Column | str, limit: float = DRY_NODE_LIMIT) -> Column:
    """NULL for anything under `limit` (a dry model node) and for NaN."""
    c = _col(c)
    return F.when(~F.isnan(c) & (c >= F.lit(float(limit))), c)


def convert_units(c: Column | str, factor: float = FEET_TO_METRES) -> Column:
    return _col(c) * F.lit(factor)


def stable_order(value: Column | str) -> Column:
    """A rank for rows whose arrival order is unknown: the same in every run and every retry."""
    return F.xxhash64(_col(value))


def fill_missing(c: Column | str, fill: float = FILL_VALUE) -> Column:
    return F.coalesce(nan_to_null(c), F.lit(fill))


def fill_missing_text(c: Column | str, fill: float = FILL_VALUE) -> Column:
    return F.coalesce(_col(c), F.lit(f"{fill:.0f}"))


def empty_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def valid_source(c: Column | str, known: tuple[str, ...] = SOURCES) -> Column:
    return F.upper(_col(c)).isin(*known)


def sensor_class(name: Column | str) -> Column:
    """Class code of a sensor name, NULL when the name is not registered."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(SENSOR_CLASSES.items())])
    return F.try_element_at(table, _col(name))


def sensor_name(code: Column | str) -> Column:
    """Sensor name of a class code, NULL when the code is not registered."""
    pairs = ((code_, name) for name, code_ in SENSOR_CLASSES.items())
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs)])
    return F.try_element_at(table, _col(code).cast("int"))
