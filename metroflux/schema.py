"""Record schemas and the fixed reference tables every operator shares.

The constants in the "fixed values" blocks must equal the platform's
contract exactly (metric bounds, units, labels); they are data, not logic.
Small dimension tables are built from them with ``createDataFrame`` and
joined with ``broadcast`` (their size is bounded by these literals).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SCHEMA_VERSION = 1
QUALITY_VALID, QUALITY_SUSPECT, QUALITY_INVALID = 1, 0, -1

# Canonical reading record; column order is part of the contract.
READING_SCHEMA = T.StructType([
    T.StructField("time", T.TimestampType(), False),
    T.StructField("sensor_id", T.StringType(), False),
    T.StructField("metric", T.StringType(), False),
    T.StructField("value", T.DoubleType(), False),
    T.StructField("unit", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("latitude", T.DoubleType(), False),
    T.StructField("longitude", T.DoubleType(), False),
    T.StructField("quality_flag", T.ShortType(), False),
    T.StructField("ingested_at", T.TimestampType(), False),
    T.StructField("schema_version", T.IntegerType(), False),
])
READING_COLUMNS = [f.name for f in READING_SCHEMA.fields]
READING_KEY = ["time", "sensor_id", "metric"]

INGESTION_METRICS_SCHEMA = T.StructType([
    T.StructField("recorded_at", T.TimestampType(), False),
    T.StructField("readings_per_second", T.DoubleType(), False),
    T.StructField("channel_fill_pct", T.ShortType(), False),
    T.StructField("pubsub_lag_ms", T.IntegerType(), True),
    T.StructField("gcs_write_latency_ms", T.IntegerType(), True),
    T.StructField("dropped_readings_total", T.LongType(), False),
])

# --- fixed values: reading sources -------------------------------------------
SOURCES = ["simulator", "openaq", "openmeteo", "gbfs", "usgs"]

# --- fixed values: metric -> (min, max, contract unit); bounds inclusive -----
METRIC_RULES = {
    "PM2.5": (0.0, 1000.0, "ug/m3"),
    "O3": (0.0, 1.0, "ppm"),
    "NO2": (0.0, 1000.0, "ppb"),
    "temperature": (-80.0, 60.0, "C"),
    "humidity": (0.0, 100.0, "%"),
    "wind_speed": (0.0, 400.0, "km/h"),
    "precipitation": (0.0, 1000.0, "mm"),
    "bike_available_count": (0.0, 1000.0, "count"),
    "dock_available_count": (0.0, 1000.0, "count"),
    "station_capacity": (0.0, 1000.0, "count"),
    "water_gage_height": (-100.0, 100.0, "ft"),
}
SUPPORTED_METRICS = list(METRIC_RULES)
TIME_SKEW_SECONDS = 5 * 60

# --- fixed values: display dimensions ----------------------------------------
SOURCE_LABELS = {
    "simulator": "City Sensor Network",
    "openaq": "Air Quality Network",
    "openmeteo": "Chicago Weather Station",
    "gbfs": "Divvy Bike Share",
    "usgs": "Chicago River Gauge",
}
METRIC_LABELS = {
    "PM2.5": "PM2.5",
    "O3": "Ozone",
    "NO2": "Nitrogen Dioxide",
    "temperature": "Temperature",
    "humidity": "Humidity",
    "wind_speed": "Wind Speed",
    "precipitation": "Precipitation",
    "bike_available_count": "Available Bikes",
    "dock_available_count": "Open Docks",
    "station_capacity": "Station Capacity",
    "water_gage_height": "River Gage Height",
}
METRIC_DISPLAY_UNITS = {
    "PM2.5": "µg/m³",
    "O3": "ppm",
    "NO2": "ppm",
    "temperature": "°C",
    "humidity": "%",
    "wind_speed": "km/h",
    "precipitation": "mm",
    "bike_available_count": "bikes",
    "dock_available_count": "docks",
    "station_capacity": "spaces",
    "water_gage_height": "ft",
}
METRIC_DOMAINS = {
    "Air Quality": ["PM2.5", "O3", "NO2"],
    "Weather & Water": ["temperature", "humidity", "wind_speed", "precipitation", "water_gage_height"],
    "Mobility": ["bike_available_count", "dock_available_count", "station_capacity"],
}
QUALITY_LABELS = {1: "Valid", 0: "Suspect", -1: "Invalid"}

# --- fixed values: media labels ----------------------------------------------
SUSPICIOUS_LABELS = [
    "abuse", "arrest", "arson", "assault", "burglary", "explosion", "fighting",
    "road accident", "roadaccidents", "robbery", "shooting", "shoplifting",
    "stealing", "vandalism",
]
DISPLAY_LABELS = {
    "abuse": "abuse_like_activity",
    "arrest": "arrest_like_activity",
    "arson": "arson_like_activity",
    "assault": "assault_like_activity",
    "burglary": "burglary_like_activity",
    "explosion": "explosion_like_activity",
    "fighting": "fighting",
    "normal videos": "normal",
    "normalvideos": "normal",
    "normal": "normal",
    "road accident": "road_accident_like_activity",
    "roadaccidents": "road_accident_like_activity",
    "robbery": "robbery_like_activity",
    "shooting": "shooting_like_activity",
    "shoplifting": "shoplifting_like_activity",
    "stealing": "stealing_like_activity",
    "vandalism": "vandalism_like_activity",
}
SEVERITY = {
    "abuse": "high",
    "arrest": "medium",
    "arson": "critical",
    "assault": "high",
    "burglary": "high",
    "explosion": "critical",
    "fighting": "high",
    "road accident": "critical",
    "roadaccidents": "critical",
    "robbery": "critical",
    "shooting": "critical",
    "shoplifting": "medium",
    "stealing": "medium",
    "vandalism": "medium",
}
LABEL_ALIASES = {  # raw normalised spelling -> canonical label
    "roadaccidents": "road accident",
    "road accidents": "road accident",
    "road accident": "road accident",
    "theft": "stealing",
    "steal": "stealing",
    "stealing": "stealing",
}
VIDEO_EXTENSIONS = [".mp4", ".mov", ".avi", ".mkv", ".webm", ".m4v"]
IMAGE_EXTENSIONS = [".jpg", ".jpeg", ".png", ".webp"]
MEDIA_EXTENSIONS = VIDEO_EXTENSIONS + IMAGE_EXTENSIONS


def metric_rules_frame(spark: SparkSession) -> DataFrame:
    """Metric rule dimension (11 rows) for broadcast joins."""
    rows = [(m, lo, hi, u) for m, (lo, hi, u) in METRIC_RULES.items()]
    return spark.createDataFrame(rows, "metric string, min_value double, max_value double, rule_unit string")
