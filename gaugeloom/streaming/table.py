"""A merged table whose readers follow a manifest of live folders.

Each merge writes one folder and then names it in the next version of the manifest; compaction writes the rows
of days that have many folders into one and names that instead. A version's file appears as a whole and
only if nobody has made it yet, so of two writers one is first and the other starts over from what the first left.
A folder that no manifest names, such as that of a writer that failed half-way, is never read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeloom.functions.values import stable_order
from gaugeloom.operators.dedupe import dedupe_keep_first
from gaugeloom.schema import OBS_SCHEMA, SEQ, STATION, TIME, VALUE

#: Folders of a day from which on compaction rewrites it.
MANY = 8
ATTEMPTS = 20


def _files(spark: SparkSession, path: str):
    """The path, and the file system it lies in."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    where, files = _files(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []


def live(spark: SparkSession, table: str) -> tuple[int, dict]:
    """Version and content of the newest manifest: folders of each day, and the last batch of each run."""
    versions = [n for n in _names(spark, f"{table}/_live") if n.endswith(".json")]
    if not versions:
        return 0, {"days": {}, "batches": {}}
    text = spark.read.text(f"{table}/_live/{versions[-1]}", wholetext=True).first()[0]
    return int(versions[-1].removesuffix(".json")), json.loads(text)


def _commit(spark: SparkSession, table: str, version: int, content: dict) -> bool:
    """Make this version of the manifest; False if another writer has made it."""
    draft, files = _files(spark, f"{table}/_drafts/{uuid.uuid4().hex}")
    out = files.create(draft, False)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    target, _ = _files(spark, f"{table}/_live/{version:010d}.json")
    files.mkdirs(target.getParent())
    hadoop = spark._jvm.org.apache.hadoop.fs
    plain = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context = hadoop.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
        context.rename(context.makeQualified(draft), context.makeQualified(target), plain)
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in str(error.java_exception.getClass().getName()):
            raise
        return False
    return True


def _read(spark: SparkSession, table: str, days: dict[str, list[str]]) -> DataFrame:
    paths = [f"{table}/data/{name}/day={day}" for day, names in sorted(days.items()) for name in names]
    return spark.read.schema(OBS_SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], OBS_SCHEMA)


def read_merged(spark: SparkSession, table: str, days: Iterable[str] | None = None) -> DataFrame:
    """The table as `(station, time, value)`, or these days of it; only live folders are listed."""
    found = live(spark, table)[1]["days"]
    return _read(spark, table, found if days is None else {d: found[d] for d in days if d in found})


def _change(spark: SparkSession, table: str, step: Callable[[dict], dict | None]) -> None:
    """Apply `step` to the newest manifest until nobody else was first; None leaves it as it is."""
    for _ in range(ATTEMPTS):
        version, content = live(spark, table)
        changed = step(content)
        if changed is None or _commit(spark, table, version + 1, changed):
            return
    raise RuntimeError(f"{ATTEMPTS} other writers were first in {table}")


def _write(rows: DataFrame, table: str) -> tuple[str, list[str]]:
    """Write rows by day into a new folder; its name, and the days it has."""
    name = uuid.uuid4().hex
    path = f"{table}/data/{name}"
    dated = rows.select(STATION, TIME, VALUE).withColumn("day", F.to_date(TIME))
    dated.repartitionByRange("day", STATION, TIME).write.partitionBy("day").parquet(path)
    return name, [d.removeprefix("day=") for d in _names(rows.sparkSession, path) if d.startswith("day=")]


def merge_into(batch: DataFrame, table: str, run: str, batch_id: int) -> None:
    """Add the rows of a batch whose (station, time) the table does not have yet; the first value stays.

    A batch that the manifest has of this run, or a later one, is left out, so a repeated attempt changes
    nothing. Rows without a time or station belong to no series and are left out. The days of a batch come to the
    driver, a short text each.
    """
    spark = batch.sparkSession
    ranked = batch if SEQ in batch.columns else batch.withColumn(SEQ, stable_order(VALUE))
    known = ranked.where(F.col(TIME).isNotNull() & F.col(STATION).isNotNull())
    rows = dedupe_keep_first(known.select(STATION, TIME, VALUE, SEQ)).drop(SEQ)
    days = [r[0] for r in rows.select(F.to_date(TIME).cast("string")).distinct().collect()]

    def step(content: dict) -> dict | None:
        if content["batches"].get(run, -1) >= batch_id:
            return None
        have = _read(spark, table, {d: content["days"][d] for d in days if d in content["days"]})
        name, written = _write(rows.join(have, [STATION, TIME], "left_anti"), table)
        added = {d: [*content["days"].get(d, []), name] for d in written}
        return {"days": {**content["days"], **added}, "batches": {**content["batches"], run: batch_id}}

    _change(spark, table, step)


def compact(spark: SparkSession, table: str, many: int = MANY) -> None:
    """Rewrite the days that have `many` folders or more as one folder; readers switch with the manifest."""

    def step(content: dict) -> dict | None:
        full = {d: names for d, names in content["days"].items() if len(names) >= many}
        if not full:
            return None
        name, written = _write(_read(spark, table, full), table)
        return {**content, "days": {**content["days"], **{d: [name] for d in written}}}

    _change(spark, table, step)


def merge_stream_into(stream: DataFrame, table: str, checkpoint: str, many: int = MANY) -> StreamingQuery:
    """Merge every available micro-batch into `table`, and compact it after each."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        merge_into(batch, table, spark.sparkContext.getLocalProperty("sql.streaming.queryId"), batch_id)
        compact(spark, table, many)

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
