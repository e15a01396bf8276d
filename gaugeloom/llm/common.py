"""Column expressions and registries shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and the SQL that gives the same rows where there is one."""

    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(name: str) -> Column:
    """The text as UTF-8 bytes; a NULL text is empty."""
    return F.coalesce(F.col(name).cast("string").cast("binary"), F.lit(b""))


def n_bytes(name: str) -> Column:
    """UTF-8 bytes of the text; 0 for NULL."""
    return F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0)).cast("long")


def row_of(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """The carried columns as one struct, so that no helper column can clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in (df.columns if columns is None else columns)])


def held_out(doc_id: str, parts: int) -> Column:
    """Is crc32 of the id's text divisible by `parts`? A NULL id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % parts == 0
