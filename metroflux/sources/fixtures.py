"""Views that carry the platform's record shapes onto the driver's tables.

The driver's test data has no sensor tables, so readings, ingestion metrics
and media predictions are derived row-for-row from ``events`` with pure
projections (narrow, no shuffle) and one hourly aggregate.  Each view exists
twice: as a Spark DataFrame and as DuckDB SQL for the oracles; both follow
the same rules, written once per engine.

Values are exact decimals so that sums and averages agree across engines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

AS_OF = "2024-01-31 00:00:00"     # fixed evaluation clock for the test tables
WINDOW_HOURS = 168                # report window used by the query catalogue

# --- fixed values: metric by event_id % 11, with source -----------------------
FIXTURE_METRICS = [
    ("PM2.5", "openaq"), ("O3", "openaq"), ("NO2", "simulator"),
    ("temperature", "openmeteo"), ("humidity", "openmeteo"),
    ("wind_speed", "openmeteo"), ("precipitation", "openmeteo"),
    ("bike_available_count", "gbfs"), ("dock_available_count", "gbfs"),
    ("station_capacity", "gbfs"), ("water_gage_height", "usgs"),
]
# --- fixed values: raw media label by event_id % 9 ---------------------------
FIXTURE_RAW_LABELS = ["Robbery", "assault", "RoadAccidents", "theft", "Normal_Videos",
                      "NormalVideos", "fighting", "vandalism", "loitering"]

_UNITS = {"PM2.5": "ug/m3", "O3": "ppm", "NO2": "ppb", "temperature": "C", "humidity": "%",
          "wind_speed": "km/h", "precipitation": "mm", "bike_available_count": "count",
          "dock_available_count": "count", "station_capacity": "count", "water_gage_height": "ft"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(key: Column, values: list[str]) -> Column:
    from ..functions.text import pick
    return pick(key, values)


def sensor_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical readings (11 columns); ``time`` is ``events.ts`` itself so
    time predicates are pushed into the Parquet scan."""
    return _readings_from(table(spark, sf_dir, "events")).drop("event_id")


def readings_with_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings plus ``event_id`` as the arrival number (for upsert batches)."""
    return _readings_from(table(spark, sf_dir, "events"))


def _readings_from(ev: DataFrame) -> DataFrame:
    k = (F.col("event_id") % 11).cast("int")
    v = F.col("value").cast("decimal(10,2)")
    h = F.lit(0.5).cast("decimal(4,3)")
    value = (F.when(k == 1, v * F.lit(0.005).cast("decimal(4,3)"))
             .when(k == 3, v * h - 20).when(k == 4, v * h).when(k == 10, v * h - 10)
             .otherwise(v)).cast("decimal(18,6)")
    err = F.col("event_type") == "error"
    return ev.select(
        "event_id",
        F.col("ts").alias("time"),
        F.concat(F.lit("S-"), F.lpad(F.col("user_id").cast("string"), 4, "0")).alias("sensor_id"),
        _case(k, [m for m, _ in FIXTURE_METRICS]).alias("metric"),
        value.alias("value"),
        _case(k, [_UNITS[m] for m, _ in FIXTURE_METRICS]).alias("unit"),
        _case(k, [s for _, s in FIXTURE_METRICS]).alias("source"),
        (F.lit(41.6) + (F.col("user_id") % 40) * F.lit(0.01)).cast("decimal(9,6)").alias("latitude"),
        (F.lit(-87.9) + (F.col("user_id") % 30) * F.lit(0.01)).cast("decimal(9,6)").alias("longitude"),
        (F.when(err & (F.col("event_id") % 2 == 0), -1).when(err, 0).otherwise(1)).cast("smallint").alias("quality_flag"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                          (F.col("event_id") % 900).cast("decimal(8,0)"))).alias("ingested_at"),
        F.lit(1).cast("int").alias("schema_version"),
    )


def ingestion_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly operational metrics; the running dropped counter is a window over
    the hourly rows only (one row per hour, bounded by the time span)."""
    ev = table(spark, sf_dir, "events")
    hourly = (ev.groupBy(F.window("ts", "1 hour").start.alias("recorded_at"))
              .agg(F.count(F.lit(1)).alias("n"),
                   F.max("event_id").alias("max_id"), F.min("event_id").alias("min_id"),
                   F.sum(F.when(F.col("event_type") == "error", 1).otherwise(0)).alias("errs")))
    w = Window.orderBy("recorded_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return hourly.select(
        "recorded_at",
        (F.col("n").cast("decimal(10,2)") * F.lit(0.25).cast("decimal(3,2)")).alias("readings_per_second"),
        (F.col("n") * 5 % 101).cast("smallint").alias("channel_fill_pct"),
        F.when(F.col("n") % 4 == 0, None).otherwise((F.col("max_id") % 900).cast("int")).alias("pubsub_lag_ms"),
        F.when(F.col("n") % 3 == 0, None).otherwise((F.col("min_id") % 500).cast("int")).alias("gcs_write_latency_ms"),
        F.sum("errs").over(w).cast("bigint").alias("dropped_readings_total"),
    )


def media_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw model output per media object (pre-label-mapping)."""
    ev = table(spark, sf_dir, "events")
    k = (F.col("event_id") % 9).cast("int")
    raw = _case(k, FIXTURE_RAW_LABELS)
    cam = (F.col("user_id") % 12).cast("string")
    ext = (F.when(F.col("event_id") % 13 == 0, ".txt")
           .when(F.col("event_id") % 5 == 0, ".mp4").otherwise(".PNG"))
    pct = F.col("value").cast("decimal(10,2)") % 100
    return ev.select(
        "event_id",
        F.col("ts").alias("event_time"),
        F.lit("chicago").alias("city"),
        F.concat(F.lit("cam-"), cam).alias("camera_id"),
        F.concat(F.lit("gs://bucket/video_inbox/city=chicago/camera=cam-"), cam,
                 F.lit("/source_video=clip-"), F.col("user_id").cast("string"), F.lit("/"),
                 raw, F.lit("_frame"), F.lpad(F.col("event_id").cast("string"), 6, "0"), ext).alias("media_uri"),
        raw.alias("raw_label"),
        (pct * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(6,4)").alias("confidence"),
        (F.col("event_type") != "view").alias("is_suspicious"),
    )


def cameras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Camera dimension: one row per camera that filed media."""
    n = F.col("n")
    return (table(spark, sf_dir, "events").select((F.col("user_id") % 12).alias("n")).distinct()
            .select(F.concat(F.lit("cam-"), n.cast("string")).alias("camera_id"), F.concat(F.lit("Camera site "), n.cast("string")).alias("location_name"),
                    (F.lit(41.6) + n * F.lit(0.01)).alias("latitude"), (F.lit(-87.9) + n * F.lit(0.01)).alias("longitude")))


# ---------------------------------------------------------------------------
# DuckDB text of the same views (used only by the oracles)
# ---------------------------------------------------------------------------

def _sql_case(key: str, values: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE CAST({key} AS INTEGER) {whens} END"


_V = "CAST(value AS DECIMAL(10,2))"
_H = "CAST(0.5 AS DECIMAL(4,3))"

READINGS_SELECT = f"""
SELECT event_id,
  ts AS time,
  concat('S-', lpad(CAST(user_id AS VARCHAR), 4, '0')) AS sensor_id,
  {_sql_case('event_id % 11', [m for m, _ in FIXTURE_METRICS])} AS metric,
  CAST(CASE CAST(event_id % 11 AS INTEGER)
    WHEN 1 THEN {_V} * CAST(0.005 AS DECIMAL(4,3))
    WHEN 3 THEN {_V} * {_H} - 20
    WHEN 4 THEN {_V} * {_H}
    WHEN 10 THEN {_V} * {_H} - 10
    ELSE {_V} END AS DECIMAL(18,6)) AS value,
  {_sql_case('event_id % 11', [_UNITS[m] for m, _ in FIXTURE_METRICS])} AS unit,
  {_sql_case('event_id % 11', [s for _, s in FIXTURE_METRICS])} AS source,
  CAST(41.6 + (user_id % 40) * 0.01 AS DECIMAL(9,6)) AS latitude,
  CAST(-87.9 + (user_id % 30) * 0.01 AS DECIMAL(9,6)) AS longitude,
  CAST(CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN -1
            WHEN event_type = 'error' THEN 0 ELSE 1 END AS SMALLINT) AS quality_flag,
  ts + to_seconds(event_id % 900) AS ingested_at,
  CAST(1 AS INTEGER) AS schema_version
FROM events"""

SENSOR_READINGS_SQL = ("SELECT time, sensor_id, metric, value, unit, source, latitude, longitude, "
                       f"quality_flag, ingested_at, schema_version FROM ({READINGS_SELECT})")

INGESTION_METRICS_SQL = """
SELECT date_trunc('hour', ts) AS recorded_at,
 CAST(count(*) AS DECIMAL(10,2)) * CAST(0.25 AS DECIMAL(3,2)) AS readings_per_second,
 CAST(count(*) * 5 % 101 AS SMALLINT) AS channel_fill_pct,
 CASE WHEN count(*) % 4 = 0 THEN NULL ELSE CAST(max(event_id) % 900 AS INT) END AS pubsub_lag_ms,
 CASE WHEN count(*) % 3 = 0 THEN NULL ELSE CAST(min(event_id) % 500 AS INT) END AS gcs_write_latency_ms,
 CAST(sum(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END))
      OVER (ORDER BY date_trunc('hour', ts)) AS BIGINT) AS dropped_readings_total
FROM events GROUP BY date_trunc('hour', ts)"""

MEDIA_RAW_SQL = f"""
SELECT event_id, ts AS event_time, 'chicago' AS city,
 concat('cam-', CAST(user_id % 12 AS VARCHAR)) AS camera_id,
 concat('gs://bucket/video_inbox/city=chicago/camera=cam-', CAST(user_id % 12 AS VARCHAR),
        '/source_video=clip-', CAST(user_id AS VARCHAR), '/', raw_label, '_frame',
        lpad(CAST(event_id AS VARCHAR), 6, '0'),
        CASE WHEN event_id % 13 = 0 THEN '.txt' WHEN event_id % 5 = 0 THEN '.mp4' ELSE '.PNG' END) AS media_uri,
 raw_label, CAST(pct * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(6,4)) AS confidence,
 CASE WHEN event_type = 'view' THEN FALSE ELSE TRUE END AS is_suspicious
FROM (SELECT *, {_sql_case('event_id % 9', FIXTURE_RAW_LABELS)} AS raw_label,
             CAST(value AS DECIMAL(10,2)) % 100 AS pct FROM events)"""

FIXTURE_SQL = {
    "readings_arrival": READINGS_SELECT,
    "sensor_readings": SENSOR_READINGS_SQL,
    "ingestion_metrics": INGESTION_METRICS_SQL,
    "media_raw": MEDIA_RAW_SQL,
}


def with_views(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with CTEs for the named fixture views (and extra CTEs)."""
    ctes = [f"{n} AS ({FIXTURE_SQL[n]})" for n in names]
    ctes += [f"{n} AS ({q})" for n, q in (extra or {}).items()]
    if not ctes:
        return body
    stripped = body.lstrip()
    if stripped[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(ctes) + ",\n" + stripped[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body
