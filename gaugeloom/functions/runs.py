"""Column functions on model-run URLs, station names and output names.

A run URL is read from its end: `.../<start>/<grid>/<machine>/<instance>/<ensemble>/<file>`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeloom.functions.times import STAMP, _col, iso_time

BLANKS = " \t\r\n\f\v"


def url_token(url: Column | str, place: int) -> Column:
    """The token at a (negative) place, NULL where the URL is too short."""
    return F.try_element_at(F.split(_col(url), "/"), F.lit(place))


def parse_run_url(url: Column | str) -> dict[str, Column]:
    return {
        "start_token": url_token(url, -6),
        "grid": F.upper(url_token(url, -5)),
        "instance": url_token(url, -3),
        "ensemble": url_token(url, -2),
    }


def run_start(token: Column | str) -> Column:
    """`yyyyMMddHH` as a time; NULL for a storm advisory number."""
    token = _col(token)
    parsed = F.try_to_timestamp(token, F.lit(STAMP)).cast("timestamp_ntz")
    return F.when(token.rlike(r"^\d{10}$"), parsed)


def is_advisory(token: Column | str) -> Column:
    """True for an advisory number, NULL for a token that is neither time nor number."""
    token = _col(token)
    start = run_start(token)
    return F.when(start.isNotNull(), F.lit(False)).when(token.rlike(r"^[+-]?\d+$"), F.lit(True))


def run_label(token: Column | str) -> Column:
    """ISO time for a cycle, the raw number for a storm advisory."""
    return F.coalesce(iso_time(run_start(token)), _col(token))


def run_day(url: Column | str) -> Column:
    """The landed folder of a run: the day it starts, `advisory-<number>` for a storm, else `other`."""
    token = url_token(url, -6)
    day = F.date_format(run_start(token), "yyyy-MM-dd")
    storm = F.when(is_advisory(token), F.concat(F.lit("advisory-"), token))
    return F.coalesce(day, storm, F.lit("other"))


def to_nowcast_url(url: Column | str) -> Column:
    return F.regexp_replace(_col(url), r"/[^/]*/([^/]*)$", "/nowcast/$1")


def run_urls(stamp: Column | str, template: str) -> Column:
    """Put a cycle's year and stamp into a `printf`-style template with two `%s`."""
    stamp = _col(stamp)
    return F.format_string(template, F.date_format(stamp, "yyyy"), F.date_format(stamp, STAMP))


def station_token(name: Column | str) -> Column:
    """The leading id of a padded station name."""
    return F.element_at(F.split(F.btrim(_col(name), F.lit(BLANKS)), " "), 1)


def grid_cast_name(grid: Column | str, cast: Column | str) -> Column:
    return F.concat_ws("_", F.upper(_col(grid)), F.upper(F.rtrim(_col(cast))))


def artifact_name(root: str | Column, *parts: Column | str | None, meta: bool = False) -> Column:
    """`{root}[_meta]_{part}_{part}...`; missing parts drop out."""
    pieces = [F.lit(root) if isinstance(root, str) else root]
    if meta:
        pieces.append(F.lit("meta"))
    pieces += [_col(p) for p in parts if p is not None]
    return F.concat_ws("_", *pieces)


def request_query(params: dict[str, Column | str | int]) -> Column:
    """URL-encoded `key=value&...` text; columns by name are values of that column."""
    pairs = []
    for key, value in params.items():
        value = value if isinstance(value, Column) else F.lit(value)
        pairs.append(F.concat(F.lit(f"{key}="), F.url_encode(value.cast("string"))))
    return F.concat_ws("&", *pairs)
