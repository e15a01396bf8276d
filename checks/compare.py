"""Compare a Spark result with DuckDB's on the same tables, as unordered rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pandas as pd


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, pd.Timestamp):
        return value.value
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float) and value.is_integer():
        return int(value)  # pandas holds integers with NULLs as floats
    return value


def rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    columns = [[_cell(v) for v in frame[c].tolist()] for c in frame.columns]
    found = list(zip(*columns)) if columns else []
    return sorted(found, key=lambda row: tuple((v is not None, v if v is not None else 0) for v in row))


def differ(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    """None when both hold the same rows, else what is wrong."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} != {len(sql_frame)}"
    for mine, theirs in zip(rows(spark_frame), rows(sql_frame)):
        if mine != theirs:
            return f"{mine} != {theirs}"
    return None
