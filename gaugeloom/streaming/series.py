"""Incremental collection: resampling a stream, and merging late re-reads into a table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeloom.functions.values import stable_order
from gaugeloom.operators.dedupe import dedupe_keep_first
from gaugeloom.schema import DEFAULT_MINUTES, SEQ, STATION, TIME, VALUE

LATE = "2 days"


def stream_resample(
    stream: DataFrame, minutes: int = DEFAULT_MINUTES, late: str = LATE
) -> DataFrame:
    """First valid value per station and bin; rows may come up to `late` behind.

    Of repeated times the first by `seq` stays, even if NULL, whatever order they arrive in; without
    that column one of the values, always the same one. A bin is given out once it is `late` behind
    the newest row.
    """
    ranked = stream if SEQ in stream.columns else stream.withColumn(SEQ, stable_order(VALUE))
    return (
        ranked.select(STATION, F.col(TIME).cast("timestamp").alias(TIME), VALUE, SEQ)
        .withWatermark(TIME, late)
        .groupBy(STATION, TIME)
        .agg(F.min_by(VALUE, SEQ).alias(VALUE))
        .where(F.col(VALUE).isNotNull())
        .groupBy(F.window(TIME, f"{minutes} minutes").alias("_bin"), STATION)
        .agg(F.min_by(VALUE, TIME).alias(VALUE))
        .select(STATION, F.col("_bin.start").cast("timestamp_ntz").alias(TIME), VALUE)
    )


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Run what is available into a parquet table and stop."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


MERGED = f"{STATION} string, {TIME} timestamp_ntz, {VALUE} double, day date, run string, batch bigint"


def _earlier(spark: SparkSession, table: str, days: list[str], run: str, batch_id: int) -> DataFrame:
    """Keys that the table has on these days, but for what this very batch wrote before."""
    paths = f"{table}/day={{{','.join(days)}}}"
    try:
        found = spark.read.schema(MERGED).option("basePath", table).parquet(paths)
    except AnalysisException as error:  # no folder of these days yet
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], MERGED)
    own = (F.col("run") == run) & (F.col("batch") == batch_id)
    return found.where(~own).select(STATION, TIME)


def merge_batch(batch: DataFrame, batch_id: int, table: str, run: str = "0") -> None:
    """Add the rows of one batch whose (station, time) the table does not have yet.

    The table is laid out by day, run and batch; `run` names the checkpoint the batch numbers count for,
    so a new checkpoint never writes into folders of an older one. A batch only replaces its own
    folders, so a repeated attempt gives the same table, and rows seen first are never rewritten. Only
    folders of days that the batch touches are listed; those days are counted out on the driver,
    a text of ten signs each. One writer at a time.
    """
    spark = batch.sparkSession
    ranked = batch if SEQ in batch.columns else batch.withColumn(SEQ, stable_order(VALUE))
    rows = dedupe_keep_first(ranked.select(STATION, TIME, VALUE, SEQ)).drop(SEQ)
    rows = rows.where(F.col(TIME).isNotNull()).withColumn("day", F.to_date(TIME))
    days = [r[0] for r in rows.select(F.col("day").cast("string")).distinct().collect()]
    if not days:
        return
    rows = rows.join(_earlier(spark, table, days, run, batch_id), [STATION, TIME], "left_anti")
    (
        rows.withColumns({"run": F.lit(run), "batch": F.lit(batch_id).cast("bigint")})
        .repartitionByRange("day", STATION, TIME)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day", "run", "batch")
        .parquet(table)
    )


def merge_stream(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Merge every available micro-batch into `table`, first-seen value kept.

    The query's id is kept with its checkpoint: it stays over restarts and is new with a new one.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        merge_batch(batch, batch_id, table, run)

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def merged(spark, table: str) -> DataFrame:
    """The merged table as `(station, time, value)`."""
    return spark.read.parquet(table).select(STATION, TIME, VALUE)
