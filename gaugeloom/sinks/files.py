"""Data and metadata files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloom.functions.runs import run_day
from gaugeloom.operators.align import order_output, output_form
from gaugeloom.operators.gaps import BLOCK_MINUTES
from gaugeloom.operators.metadata import filled_meta
from gaugeloom.plans.series import ordered_series
from gaugeloom.schema import DAY, DEFAULT_MINUTES, FILE_ROOTS, RUN_DAY

#: An XML file is read whole by one task, so landed files are bounded: some 20 MB of short rows.
XML_ROWS = 100_000


def artifact_path(root: str, source: str, *parts: str | None, meta: bool = False) -> str:
    """`{root}/{source root}[_meta]_{part}_...`; missing parts drop out."""
    pieces = [FILE_ROOTS[source.upper()], "meta" if meta else None, *parts]
    return f"{root.rstrip('/')}/{'_'.join(p for p in pieces if p)}"


def write_long(
    df: DataFrame,
    root: str,
    source: str,
    tag: str,
    product: str = "water_level",
    requested: DataFrame | None = None,
) -> str:
    """Write `TIME,STATION,<PRODUCT>` in request order and return the folder.

    The global sort is a range partitioning, so the part files, read in order, are the file; a
    long station spans several of them. For observations that are yet to be aligned, `write_series`
    sorts far less.
    """
    return _write_ordered(order_output(df, requested), root, source, tag, product)


def _write_ordered(df: DataFrame, root: str, source: str, tag: str, product: str) -> str:
    path = artifact_path(root, source, tag)
    output_form(df, product).write.mode("overwrite").csv(path, header=True)
    return path


def write_series(
    obs: DataFrame,
    root: str,
    source: str,
    tag: str,
    product: str = "water_level",
    requested: DataFrame | None = None,
    minutes: int | None = DEFAULT_MINUTES,
    block_minutes: int = BLOCK_MINUTES,
) -> str:
    """Write the aligned series of raw observations as `write_long` does, with the same lines in the same order.

    What is sorted are cells of many times; the sorted tasks unfold them into the files.
    """
    return _write_ordered(ordered_series(obs, requested, minutes, block_minutes), root, source, tag, product)


def write_meta(meta: DataFrame, root: str, source: str, tag: str) -> str:
    """Write one line per station, STATION first."""
    path = artifact_path(root, source, tag, meta=True)
    filled_meta(meta).write.mode("overwrite").csv(path, header=True)
    return path


def write_partitioned(df: DataFrame, path: str, by: tuple[str, ...] = ("source", "run_date")) -> str:
    """Write parquet under `source=.../run_date=.../`; the writer makes the folders.

    Rows are range-partitioned on the folder columns and then on what else tells them apart, so
    each task writes few folders and a folder that holds a third of the rows has many writers.
    """
    rest = [c for c in ("station", "time") if c in df.columns]
    df.repartitionByRange(*by, *rest).write.mode("overwrite").partitionBy(*by).parquet(path)
    return path


def write_landed(
    df: DataFrame, path: str, fmt: str = "json", time: str = "date_time", folders: tuple[str, ...] = (), **options
) -> str:
    """Add landed rows under `<folders>/day=<date of time>/`, the layout whose days readers can prune.

    Rows without a time lie under the default folder of the writer, which no range reads.
    """
    by = [*folders, DAY]
    dated = df.withColumn(DAY, F.to_date(F.col(time).cast("timestamp_ntz")))
    rows = dated.repartitionByRange(*by, time)
    bound = {"maxRecordsPerFile": XML_ROWS} if fmt == "xml" else {}
    rows.write.mode("append").format(fmt).options(**{**bound, **options}).partitionBy(*by).save(path)
    return path


def write_xml(df: DataFrame, path: str, by: tuple[str, ...] = (), rows: int = XML_ROWS) -> str:
    """Write rows as the gauge provider's XML, at most `rows` to a file, under folders of `by` where it is given."""
    out = df.write.format("xml").options(rootTag="general", rowTag="row", maxRecordsPerFile=rows)
    (out.partitionBy(*by) if by else out).save(path)
    return path


def write_model_runs(series: DataFrame, path: str) -> str:
    """Add model output under `run_day=.../`, the rows of a file by node and time.

    Rows are dealt by ranges of day, run and node, so a large run has several writers.
    """
    rows = series.withColumn(RUN_DAY, run_day("url")).repartitionByRange(RUN_DAY, "url", "node_idx")
    ordered = rows.sortWithinPartitions(RUN_DAY, "node_idx", "url", "time")
    ordered.write.mode("append").partitionBy(RUN_DAY).parquet(path)
    return path
