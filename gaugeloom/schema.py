"""Canonical column names, table schemas and the fixed registries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

STATION, TIME, VALUE, SEQ = "station", "time", "value", "seq"
#: Folder level of landed observations: the day of their time.
DAY = "day"
#: Folder level of landed model runs (`run_day`).
RUN_DAY = "run_day"

OBS_SCHEMA = T.StructType([
    T.StructField(STATION, T.StringType()),
    T.StructField(TIME, T.TimestampNTZType()),
    T.StructField(VALUE, T.DoubleType()),
])

STATION_LIST_SCHEMA = T.StructType([
    T.StructField("position", T.IntegerType()),
    T.StructField(STATION, T.StringType()),
])

REGISTRY_SCHEMA = T.StructType([
    T.StructField("grid", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("position", T.IntegerType()),
    T.StructField("id", T.StringType()),
])

TIDE_OBS_SCHEMA = T.StructType([
    T.StructField(STATION, T.StringType()),
    T.StructField("date_time", T.TimestampNTZType()),
    T.StructField("water_level", T.DoubleType()),
    T.StructField("predicted_wl", T.DoubleType()),
    T.StructField("air_press", T.DoubleType()),
    T.StructField("spd", T.DoubleType()),
    T.StructField(SEQ, T.LongType()),
])

TIDE_META_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in (STATION, "lat", "lng", "name", "state")]
)

GAUGE_OBS_SCHEMA = T.StructType([
    T.StructField("data_time", T.TimestampNTZType()),
    T.StructField("data_value", T.DoubleType()),
    T.StructField(SEQ, T.LongType()),
])

GAUGE_SENSOR_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType())
     for c in ("site_id", "or_site_id", "sensor_class", "or_sensor_id", "location")]
)

GAUGE_SITE_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType())
     for c in ("or_site_id", "latitude_dec", "longitude_dec", "location")]
)

MODEL_SERIES_SCHEMA = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("node_idx", T.IntegerType()),
    T.StructField(TIME, T.TimestampNTZType()),
    T.StructField("zeta", T.DoubleType()),
])

MODEL_NODE_SCHEMA = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("node_idx", T.IntegerType()),
    T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()),
    T.StructField("station_name", T.StringType()),
    T.StructField("source", T.StringType()),
])

# Column order of the curated station-to-node table, with the type each column takes.
STATION_NODE_TYPES = {
    "serial_nr": "int",
    "stationid": "string",
    "stationname": "string",
    "state": "string",
    "source": "string",
    "vertical_datum": "string",
    "NOAA lon": "double",
    "NOAA lat": "double",
    "navd_to_msl [ft]": "double",
    "navd_to_msl [m]": "double",
    "Datum Source": "string",
    "lon": "double",
    "lat": "double",
    "bathy": "double",
    "Element": "int",
    "Node": "int",
}

META_KEYS = ["LAT", "LON", "NAME", "UNITS", "TZ", "OWNER", "STATE", "COUNTY"]

# --- Fixed values: these must equal the data providers' own names and codes. ---

FILL_VALUE = -99999.0
DRY_NODE_LIMIT = -1000.0
FEET_TO_METRES = 0.3048
REQUEST_ROW_CAP = 5000
DEFAULT_MINUTES = 15
UNITS = "meters"
TIME_ZONE = "gmt"

SOURCES = ("NOAA", "CONTRAILS", "ASGS")
OWNERS = {"NOAA": "NOAA/NOS", "CONTRAILS": "NCEM"}
FILE_ROOTS = {
    "NOAA": "noaa_stationdata",
    "CONTRAILS": "contrails_stationdata",
    "ASGS": "adcirc_stationdata",
}

# source -> generic product name -> provider field (tide, model) or sensor name (gauge)
PRODUCT_FIELDS = {
    "NOAA": {
        "water_level": "water_level",
        "predictions": "predicted_wl",
        "air_pressure": "air_press",
        "hourly_height": "water_level",
        "wind": "spd",
    },
    "CONTRAILS": {
        "river_water_level": "Stage",
        "coastal_water_level": "Water Elevation",
    },
    "ASGS": {"water_level": "water_level"},
}

# Products that a collection run of the source accepts.
HARVEST_PRODUCTS = {
    "NOAA": ("water_level", "predictions", "hourly_height"),
    "CONTRAILS": ("river_water_level", "coastal_water_level"),
    "ASGS": ("water_level",),
}

GAUGE_GROUPS = {"river_water_level": "RIVERS", "coastal_water_level": "COASTAL"}

SENSOR_CLASSES = {
    "Rain Increment": 10,
    "Rain Accumulation": 11,
    "Stage": 20,
    "Water Elevation": 94,
    "Flow Volume": 25,
    "Air Temperature": 30,
    "Fuel Temperature": 38,
    "Wind Velocity": 40,
    "Wind Velocity, maximum": 41,
    "Wind Direction": 44,
    "ALERT Wind": 47,
    "Relative Humidity": 50,
    "Soil Moisture": 51,
    "Fuel Moisture": 52,
    "Barometric Pressure": 53,
    "Net Solar Radiation": 60,
    "Evapotranspiration Rate": 84,
    "Binary Status": 197,
    "Repeater Status": 198,
    "Battery": 199,
    "Average Voltage": 200,
    "Repeater Pass List": 240,
    "Msg Count": 246,
}

# --- End of fixed values. ---


def provider_field(source: str, product: str) -> str:
    """The provider's own name for a generic product; unknown names are refused."""
    fields = PRODUCT_FIELDS.get(source.upper())
    if fields is None:
        raise ValueError(f"unknown source {source!r}; known: {', '.join(SOURCES)}")
    if product not in fields:
        raise ValueError(f"{source} has no product {product!r}; known: {', '.join(fields)}")
    return fields[product]


def harvest_product(source: str, product: str) -> str:
    """As `provider_field`, but only for products a collection run accepts."""
    field = provider_field(source, product)
    allowed = HARVEST_PRODUCTS[source.upper()]
    if product not in allowed:
        raise ValueError(f"{source} collects {', '.join(allowed)}; not {product!r}")
    return field


def product_table(spark: SparkSession) -> DataFrame:
    """The product registry as a dimension table (a dozen rows)."""
    rows = [
        (source, product, field, SENSOR_CLASSES.get(field) if source == "CONTRAILS" else None)
        for source, fields in PRODUCT_FIELDS.items()
        for product, field in fields.items()
    ]
    return spark.createDataFrame(
        rows, "source string, product string, provider_column string, class_code int"
    )
