"""Column functions on naive (GMT) timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO = "yyyy-MM-dd'T'HH:mm:ss"
STAMP = "yyyyMMddHH"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(c: Column | str) -> Column:
    return _col(c).cast("timestamp_ntz")


def epoch_us(c: Column | str) -> Column:
    return F.unix_micros(_col(c).cast("timestamp"))


def from_epoch_us(c: Column | str) -> Column:
    return F.timestamp_micros(_col(c)).cast("timestamp_ntz")


def truncate(unit: str, c: Column | str) -> Column:
    return F.date_trunc(unit, _col(c)).cast("timestamp_ntz")


def iso_time(c: Column | str) -> Column:
    """`2022-01-16T00:00:00` text, the form every output file uses."""
    return F.date_format(_col(c), ISO)


def time_slice(c: Column | str, start, end) -> Column:
    """Inclusive range test; a plain comparison, so it reaches the parquet scan."""
    return _col(c).between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"))


def day_slice(c: Column | str, start, end) -> Column:
    """The days that `time_slice` of the same range touches: a test on constants, so it prunes folders by day."""
    return _col(c).between(*[F.lit(x).cast("timestamp_ntz").cast("date") for x in (start, end)])


def ordered(start: Column | str, end: Column | str) -> tuple[Column, Column]:
    """The two ends of a range, swapped where they were given in reverse."""
    a, b = _col(start), _col(end)
    return F.least(a, b), F.greatest(a, b)


def lookback(stop: Column | str, ndays: int | Column | str) -> tuple[Column, Column]:
    """The range `ndays` away from `stop`; a negative number looks back."""
    days = F.lit(ndays) if isinstance(ndays, int) else _col(ndays)
    return ordered(_col(stop) + F.make_dt_interval(days=days), stop)


def clamp_end(end: Column | str, as_of) -> Column:
    """An end may not lie after `as_of`."""
    return F.least(_col(end), as_of if isinstance(as_of, Column) else ntz(F.lit(as_of)))


def _at_hour(c: Column, hours: Column) -> Column:
    day = truncate("day", c)
    return day + F.make_dt_interval(hours=hours.cast("int"))


def cycle_floor(c: Column | str, every: int = 6) -> Column:
    """The model cycle that had started by this hour; minutes are ignored."""
    c = _col(c)
    return _at_hour(c, F.floor(F.hour(c) / every) * every)


def cycle_nearest(c: Column | str, every: int = 6) -> Column:
    """The cycle nearest to this hour; a tie goes up and may reach the next day."""
    c = _col(c)
    return _at_hour(c, F.floor((F.hour(c) + every / 2) / every) * every)


def cycle_times(start, end, as_of=None, every: int = 6, legacy_start: bool = False) -> Column:
    """All cycle stamps from the start's cycle to the end's, as an array.

    `legacy_start` puts the first stamp at midnight minus the floored hour instead.
    """
    lo, hi = ordered(start, end)
    if as_of is not None:
        hi = clamp_end(hi, as_of)
    first = cycle_floor(lo, every)
    if legacy_start:
        first = _at_hour(lo, -(F.floor(F.hour(lo) / every) * every))
    last = cycle_floor(hi, every)
    stamps = F.sequence(first, last, F.make_dt_interval(hours=F.lit(every)))
    return F.when(first <= last, stamps).otherwise(F.array().cast("array<timestamp_ntz>"))
