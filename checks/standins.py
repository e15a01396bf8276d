"""Series, runs, lists and metadata derived from the given tables.

`events` gives observations, `orders` x `lineitem` give model runs and their series, and
`customer`, `supplier`, `part`, `nation` give station lists and metadata.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gaugeloom.session import prepare

BASE = "https://data.example/dodsC"


SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table; its schema is looked up once."""
    path = f"{sf}/{name}.parquet"
    if path not in SCHEMAS:
        SCHEMAS[path] = prepare(spark).read.parquet(path).schema
    return prepare(spark).read.schema(SCHEMAS[path]).parquet(path)


def observations(spark, sf, station="event_type", unit=None) -> DataFrame:
    """Events as `(station, time, value, seq)`; values under 20 are gaps.

    `unit` truncates the times, which makes repeated ones.
    """
    time = F.col("ts") if unit is None else F.date_trunc(unit, "ts").cast("timestamp_ntz")
    return table(spark, sf, "events").select(
        F.col(station).cast("string").alias("station"),
        time.alias("time"),
        F.when(F.col("value") >= 20, F.col("value")).alias("value"),
        F.col("event_id").alias("seq"),
    )


def user_ranges(spark, sf) -> DataFrame:
    """First and last event of each user as a request range."""
    return table(spark, sf, "events").groupBy(F.col("user_id").cast("string").alias("station")).agg(
        F.min("ts").alias("start"), F.max("ts").alias("end")
    )


#: What the URL of an order is made of. Lines are dealt by order once, and the URL is made after they are joined.
RUN_FIELDS = ("o_orderdate", "o_orderpriority", "o_orderstatus")


def run_columns(shift_years: int = 0) -> list:
    """Run URL parts of an order. Urgent orders are storms, numbered instead of timed."""
    start = F.col("o_orderdate") - F.make_ym_interval(F.lit(shift_years))
    token = F.when(
        F.col("o_orderpriority") == "1-URGENT", F.month("o_orderdate").cast("string")
    ).otherwise(F.date_format(start, "yyyyMMddHH"))
    ensemble = (
        F.when(F.col("o_orderstatus") == "F", "namforecast")
        .when(F.col("o_orderstatus") == "O", "nowcast")
        .otherwise("nhcOfcl")
    )
    grid = F.lower(F.replace(F.substring("o_orderpriority", 3, 20), F.lit(" "), F.lit("")))
    url = F.concat_ws(
        "/", F.lit(BASE), F.date_format("o_orderdate", "yyyy"), F.lit("nam"), token, grid,
        F.lit("machine"), F.concat(F.lit("run-"), F.col("o_orderkey")), ensemble, F.lit("fort.61.nc"),
    )
    return [F.col("o_orderkey").cast("int").alias("position"), url.alias("url")]


def runs(spark, sf, shift_years: int = 0) -> DataFrame:
    return table(spark, sf, "orders").select(*run_columns(shift_years))


def model_series(spark, sf, shift_years: int = 0) -> DataFrame:
    """Line items as model output: node = supplier, time = ship date."""
    orders = table(spark, sf, "orders").select("o_orderkey", *RUN_FIELDS)
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_shipdate", "l_extendedprice"
    ).repartition("l_orderkey")
    steps = lines.groupBy("l_orderkey", "l_suppkey", "l_shipdate").agg(
        F.max(F.lit(20000.0) - F.col("l_extendedprice")).alias("zeta")
    )
    return steps.join(orders, steps.l_orderkey == orders.o_orderkey).select(
        run_columns(shift_years)[1], F.col("l_suppkey").cast("int").alias("node_idx"),
        F.col("l_shipdate").alias("time"), "zeta",
    )


def model_nodes(spark, sf, shift_years: int = 0) -> DataFrame:
    """The nodes of each run, with a padded station name led by the station id."""
    orders = table(spark, sf, "orders").select("o_orderkey", *RUN_FIELDS)
    found = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey").repartition("l_orderkey").distinct()
    placed = found.join(orders, found.l_orderkey == orders.o_orderkey)
    supplier = table(spark, sf, "supplier")
    return placed.join(supplier, placed.l_suppkey == supplier.s_suppkey).select(
        run_columns(shift_years)[1],
        F.col("s_suppkey").cast("int").alias("node_idx"),
        F.col("s_acctbal").alias("x"),
        F.col("s_nationkey").cast("double").alias("y"),
        F.concat(F.lit("  "), F.lit("S"), F.col("s_suppkey"), F.lit(" "), F.col("s_name"), F.lit("  "))
        .alias("station_name"),
        F.concat(F.lit("model-"), F.col("s_nationkey")).alias("source"),
    )


def requested(spark, sf) -> DataFrame:
    """Customers as requested stations; those whose number is a supplier's exist in the runs."""
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("int").alias("position"),
        F.concat(F.lit("S"), F.col("c_custkey")).alias("station"),
    )


def user_request(spark, sf) -> DataFrame:
    """Customers as requested observation stations, by number."""
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("int").alias("position"),
        F.col("c_custkey").cast("string").alias("station"),
    )


def customer_meta(spark, sf) -> DataFrame:
    """Raw tide-style metadata, `''` where a customer's balance is negative."""
    nation = table(spark, sf, "nation")
    customer = table(spark, sf, "customer")
    joined = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    owed = F.col("c_acctbal") < 0
    return joined.select(
        F.col("c_custkey").cast("string").alias("station"),
        F.when(owed, "").otherwise(F.col("c_nationkey").cast("string")).alias("lat"),
        F.when(owed, "").otherwise(F.col("n_regionkey").cast("string")).alias("lng"),
        F.when(owed, "").otherwise(F.col("c_name")).alias("name"),
        F.when(owed, "").otherwise(F.col("n_name")).alias("state"),
    )


def sensors(spark, sf) -> DataFrame:
    """Line items as sensor rows: site = supplier, class by ship status."""
    code = F.when(F.col("l_linestatus") == "O", "20").otherwise("94")
    return table(spark, sf, "lineitem").groupBy("l_suppkey", "l_partkey", "l_linestatus").agg(
        F.min("l_orderkey").alias("first_order")
    ).select(
        F.col("l_suppkey").cast("string").alias("site_id"),
        F.concat(F.lit("or-"), F.col("l_suppkey")).alias("or_site_id"),
        code.alias("sensor_class"),
        F.lpad(F.col("l_partkey").cast("string"), 12, "0").alias("or_sensor_id"),
        F.concat(F.lit("sensor "), F.col("l_partkey")).alias("location"),
    )


def sites(spark, sf) -> DataFrame:
    """Suppliers as sites; no location where the balance is negative."""
    owed = F.col("s_acctbal") < 0
    return table(spark, sf, "supplier").select(
        F.concat(F.lit("or-"), F.col("s_suppkey")).alias("or_site_id"),
        F.when(owed, "").otherwise(F.col("s_nationkey").cast("string")).alias("latitude_dec"),
        F.col("s_acctbal").cast("string").alias("longitude_dec"),
        F.when(owed, "").otherwise(F.col("s_name")).alias("location"),
    )
