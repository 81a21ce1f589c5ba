"""Report queries."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from .. import schema as S
from ..functions.timefn import ts_lit
from ..operators import daily as DY
from ..operators import latest as LT
from ..operators import reports as RP
from ..session import shared_dir
from ..sources.fixtures import with_views
from . import sqlkit as Q
from .catalog import ALL_METRICS, AS_OF, CUT, HOURS, IM, R, STALE_CUT, STALE_HOURS, register

AVG_V = Q.avg_exact("value", 6)
VP = Q.valid_pct()
SCOPE = f"SELECT * FROM sensor_readings WHERE time >= {CUT}"
VALID_SCOPE = f"{SCOPE} AND metric IN {Q.in_list(ALL_METRICS)} AND quality_flag = 1"

# ------------------------------------------------------------------ A5
register("metric_summary", with_views(f"""
SELECT s.metric, CAST(l.value AS DOUBLE) AS latest_value, l.unit, s.avg_value, s.min_value, s.max_value,
       s.readings, s.sensors, l.time AS latest_reading_at
FROM (SELECT metric, {AVG_V} AS avg_value, CAST(MIN(value) AS DOUBLE) AS min_value,
             CAST(MAX(value) AS DOUBLE) AS max_value, COUNT(*) AS readings,
             COUNT(DISTINCT sensor_id) AS sensors
      FROM ({VALID_SCOPE}) GROUP BY metric) s
JOIN (SELECT DISTINCT ON (metric) metric, value, unit, time FROM ({VALID_SCOPE})
      ORDER BY metric, time DESC, sensor_id DESC) l USING (metric)""", "sensor_readings"))(
    lambda spark, sf: RP.metric_summary(R(spark, sf), ALL_METRICS, AS_OF, HOURS))

# ------------------------------------------------------------------ A1
register("overview", with_views(f"""
SELECT * FROM
 (SELECT COUNT(*) AS total_readings, COUNT(DISTINCT sensor_id) AS active_sensors,
         COUNT(DISTINCT metric) AS metrics, COUNT(DISTINCT source) AS sources, {VP} AS valid_pct
  FROM ({SCOPE})) q,
 (SELECT MAX(time) AS latest_reading_at, MAX(ingested_at) AS latest_ingested_at FROM sensor_readings) a,
 (SELECT CAST(COALESCE(MAX(dropped_readings_total), 0) AS BIGINT) AS dropped_readings_total,
         CAST(COALESCE(MAX(channel_fill_pct), 0) AS INTEGER) AS channel_fill_pct,
         COALESCE({Q.avg_exact('readings_per_second', 4)}, 0.0) AS avg_readings_per_second
  FROM ingestion_metrics WHERE recorded_at >= {CUT}
  HAVING EXISTS (SELECT 1 FROM ingestion_metrics WHERE recorded_at >= {CUT})
  UNION ALL
  SELECT CAST(0 AS BIGINT), CAST(0 AS INTEGER),
         COALESCE(CAST(COUNT(*) AS DOUBLE) / NULLIF({Q.seconds_between('MAX(COALESCE(ingested_at, time))', 'MIN(COALESCE(ingested_at, time))')}, 0.0), 0.0)
  FROM sensor_readings WHERE COALESCE(ingested_at, time) >= {CUT}
  HAVING NOT EXISTS (SELECT 1 FROM ingestion_metrics WHERE recorded_at >= {CUT})) m""",
                             "sensor_readings", "ingestion_metrics"))(
    lambda spark, sf: RP.overview(R(spark, sf), IM(spark, sf), AS_OF, HOURS))

# ------------------------------------------------------------------ A2
register("source_options", with_views("SELECT DISTINCT source FROM sensor_readings", "sensor_readings"))(
    lambda spark, sf: RP.source_options(R(spark, sf)))
register("metric_options", with_views("SELECT DISTINCT metric FROM sensor_readings", "sensor_readings"))(
    lambda spark, sf: RP.metric_options(R(spark, sf)))

# ------------------------------------------------------------------ A3 / A27
SOURCE_SUMMARY_SQL = f"""SELECT source, COUNT(*) AS readings, COUNT(DISTINCT sensor_id) AS sensors,
  COUNT(DISTINCT metric) AS metrics, MAX(time) AS latest_reading_at, MAX(ingested_at) AS latest_ingested_at,
  {VP} AS valid_pct FROM ({SCOPE}) GROUP BY source"""
register("source_summary", with_views(SOURCE_SUMMARY_SQL, "sensor_readings"))(
    lambda spark, sf: RP.source_summary(R(spark, sf), AS_OF, HOURS))
register("valid_rate_by_source", with_views(
    f"SELECT source, readings, valid_pct FROM ({SOURCE_SUMMARY_SQL})", "sensor_readings"))(
    lambda spark, sf: RP.valid_rate_by_source(R(spark, sf), AS_OF, HOURS))

# ------------------------------------------------------------------ A4 / A28
TREND_SQL = f"""SELECT time_bucket(INTERVAL '5 minutes', time) AS bucket, source, metric,
  {AVG_V} AS avg_value, CAST(MIN(value) AS DOUBLE) AS min_value, CAST(MAX(value) AS DOUBLE) AS max_value,
  COUNT(*) AS readings FROM ({{scope}}) GROUP BY ALL"""
register("trend", with_views(TREND_SQL.format(scope=VALID_SCOPE), "sensor_readings"))(
    lambda spark, sf: RP.trend(R(spark, sf), ALL_METRICS, AS_OF, HOURS))
_DOMAIN = "Weather & Water"
register("domain_trend", with_views(
    f"SELECT *, '{_DOMAIN}' AS domain FROM (" + TREND_SQL.format(
        scope=f"{SCOPE} AND metric IN {Q.in_list(S.METRIC_DOMAINS[_DOMAIN])} AND quality_flag = 1") + ")",
    "sensor_readings"))(
    lambda spark, sf: RP.domain_trend(R(spark, sf), _DOMAIN, AS_OF, HOURS))

# ------------------------------------------------------------------ A6 / A22 / A30
NETWORK_SQL = f"""SELECT sensor_id, source, COUNT(*) AS readings, COUNT(DISTINCT metric) AS metric_count,
  STRING_AGG(DISTINCT metric, ', ' ORDER BY metric) AS metrics, MAX(time) AS latest_reading_at,
  MAX(ingested_at) AS latest_ingested_at, {Q.avg_exact('latitude', 6)} AS latitude,
  {Q.avg_exact('longitude', 6)} AS longitude, {VP} AS valid_pct,
  CASE WHEN MAX(time) >= {STALE_CUT} THEN 'fresh' ELSE 'stale' END AS status
  FROM ({SCOPE}) GROUP BY sensor_id, source"""
register("sensor_network", with_views(NETWORK_SQL, "sensor_readings"))(
    lambda spark, sf: RP.sensor_network(R(spark, sf), AS_OF, HOURS, STALE_HOURS))
register("network_rollup", with_views(f"""SELECT COUNT(CASE WHEN status = 'fresh' THEN 1 END) AS fresh_sensors,
  COUNT(*) AS total_sensors, CAST(COALESCE(SUM(metric_count), 0) AS BIGINT) AS metric_streams
  FROM ({NETWORK_SQL})""", "sensor_readings"))(
    lambda spark, sf: RP.network_rollup(RP.sensor_network(R(spark, sf), AS_OF, HOURS, STALE_HOURS)))
register("map_points", with_views(f"""SELECT sensor_id, source, latitude, longitude, readings,
  CAST(GREATEST(LEAST(readings, 42), 6) AS BIGINT) AS marker_size FROM ({NETWORK_SQL})
  WHERE latitude IS NOT NULL AND longitude IS NOT NULL""", "sensor_readings"))(
    lambda spark, sf: RP.map_points(RP.sensor_network(R(spark, sf), AS_OF, HOURS, STALE_HOURS)))

# ------------------------------------------------------------------ A7-A9, A21, L6
register("source_metric_counts", with_views(f"""SELECT source, metric, COUNT(*) AS readings,
  COUNT(DISTINCT sensor_id) AS sensors, MAX(time) AS latest_reading_at FROM ({SCOPE}) GROUP BY ALL""",
                                             "sensor_readings"))(
    lambda spark, sf: RP.source_metric_counts(R(spark, sf), AS_OF, HOURS))
QUALITY_SQL = f"""SELECT CASE quality_flag WHEN 1 THEN 'Valid' WHEN 0 THEN 'Suspect' ELSE 'Invalid' END AS quality,
  COUNT(*) AS readings FROM ({SCOPE}) GROUP BY quality_flag"""
register("quality_distribution", with_views(QUALITY_SQL, "sensor_readings"))(
    lambda spark, sf: RP.quality_distribution(R(spark, sf), AS_OF, HOURS))
register("readiness_score", with_views(f"""SELECT
  COALESCE(CAST(100.0 * SUM(CASE WHEN quality = 'Valid' THEN readings ELSE 0 END) AS DOUBLE)
           / NULLIF(SUM(readings), 0), 0.0) AS readiness_score,
  CAST(COALESCE(SUM(readings), 0) AS BIGINT) AS readings FROM ({QUALITY_SQL})""", "sensor_readings"))(
    lambda spark, sf: RP.readiness_score(RP.quality_distribution(R(spark, sf), AS_OF, HOURS)))
COVERAGE_SQL = f"""SELECT metric, COUNT(DISTINCT source) AS sources, COUNT(DISTINCT sensor_id) AS sensors,
  COUNT(*) AS readings, MIN(time) AS first_reading_at, MAX(time) AS latest_reading_at
  FROM ({SCOPE}) GROUP BY metric"""
register("metric_coverage", with_views(COVERAGE_SQL, "sensor_readings"))(
    lambda spark, sf: RP.metric_coverage(R(spark, sf), AS_OF, HOURS))
register("coverage_top", with_views(f"SELECT * FROM ({COVERAGE_SQL}) ORDER BY readings DESC, metric LIMIT 14",
                                     "sensor_readings"))(
    lambda spark, sf: RP.coverage_top(RP.metric_coverage(R(spark, sf), AS_OF, HOURS), 14))

# ------------------------------------------------------------------ A10 / A11
register("ingestion_trend", with_views(f"""
SELECT time_bucket(INTERVAL '1 minute', recorded_at) AS bucket,
  {Q.avg_exact('readings_per_second', 4)} AS readings_per_second,
  CAST(MAX(channel_fill_pct) AS INTEGER) AS channel_fill_pct,
  CAST(MAX(dropped_readings_total) AS BIGINT) AS dropped_readings_total,
  CAST(AVG(pubsub_lag_ms) AS DOUBLE) AS pubsub_lag_ms,
  CAST(AVG(gcs_write_latency_ms) AS DOUBLE) AS gcs_write_latency_ms
FROM ingestion_metrics WHERE recorded_at >= {CUT} GROUP BY 1
UNION ALL
SELECT time_bucket(INTERVAL '1 minute', COALESCE(ingested_at, time)), CAST(COUNT(*) AS DOUBLE) / 60.0,
  CAST(0 AS INTEGER), CAST(0 AS BIGINT), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)
FROM sensor_readings WHERE COALESCE(ingested_at, time) >= {CUT}
  AND NOT EXISTS (SELECT 1 FROM ingestion_metrics WHERE recorded_at >= {CUT}) GROUP BY 1""",
                                        "sensor_readings", "ingestion_metrics"))(
    lambda spark, sf: RP.ingestion_trend(IM(spark, sf), R(spark, sf), AS_OF, HOURS))
register("latest_ingestion", with_views(f"""
SELECT * FROM (SELECT recorded_at, CAST(readings_per_second AS DOUBLE) AS readings_per_second,
  CAST(channel_fill_pct AS INTEGER) AS channel_fill_pct, CAST(dropped_readings_total AS BIGINT) AS dropped_readings_total,
  CAST(pubsub_lag_ms AS DOUBLE) AS pubsub_lag_ms, CAST(gcs_write_latency_ms AS DOUBLE) AS gcs_write_latency_ms
  FROM ingestion_metrics WHERE recorded_at >= {CUT} ORDER BY recorded_at DESC LIMIT 1)""",
                                         "ingestion_metrics"))(
    lambda spark, sf: RP.latest_ingestion(IM(spark, sf), R(spark, sf), AS_OF, HOURS))

# the same reports while no ingestion metrics have been written: derived from the readings
def _no_metrics(spark, sf):
    return IM(spark, sf).filter(F.lit(False))


_DERIVED = f"""FROM sensor_readings WHERE coalesce(ingested_at, time) >= {CUT}"""
_RATE = "coalesce(CAST(count(*) AS DOUBLE) / nullif(%s, 0.0), 0.0)" % Q.seconds_between("max(coalesce(ingested_at, time))", "min(coalesce(ingested_at, time))")
register("overview_derived", with_views(f"""
SELECT q.*, a.*, CAST(0 AS BIGINT) AS dropped_readings_total, CAST(0 AS INTEGER) AS channel_fill_pct, d.rate AS avg_readings_per_second FROM
 (SELECT count(*) AS total_readings, count(DISTINCT sensor_id) AS active_sensors, count(DISTINCT metric) AS metrics,
         count(DISTINCT source) AS sources, {VP} AS valid_pct FROM ({SCOPE})) q,
 (SELECT max(time) AS latest_reading_at, max(ingested_at) AS latest_ingested_at FROM sensor_readings) a,
 (SELECT {_RATE} AS rate {_DERIVED}) d""", "sensor_readings"))(
    lambda spark, sf: RP.overview(R(spark, sf), _no_metrics(spark, sf), AS_OF, HOURS))
register("ingestion_trend_derived", with_views(f"""
SELECT time_bucket(INTERVAL '1 minute', coalesce(ingested_at, time)) AS bucket, CAST(count(*) AS DOUBLE) / 60.0 AS readings_per_second,
  CAST(0 AS INTEGER) AS channel_fill_pct, CAST(0 AS BIGINT) AS dropped_readings_total, CAST(NULL AS DOUBLE) AS pubsub_lag_ms,
  CAST(NULL AS DOUBLE) AS gcs_write_latency_ms {_DERIVED} GROUP BY 1""", "sensor_readings"))(
    lambda spark, sf: RP.ingestion_trend(_no_metrics(spark, sf), R(spark, sf), AS_OF, HOURS))
register("latest_ingestion_derived", with_views(f"""
SELECT max(coalesce(ingested_at, time)) AS recorded_at, {_RATE} AS readings_per_second, CAST(0 AS INTEGER) AS channel_fill_pct,
  CAST(0 AS BIGINT) AS dropped_readings_total, CAST(NULL AS DOUBLE) AS pubsub_lag_ms, CAST(NULL AS DOUBLE) AS gcs_write_latency_ms
  {_DERIVED}""", "sensor_readings"))(
    lambda spark, sf: RP.latest_ingestion(_no_metrics(spark, sf), R(spark, sf), AS_OF, HOURS))

# ------------------------------------------------------------------ A12-A14
register("hourly_aggregates", with_views(f"""SELECT time_bucket(INTERVAL '1 hour', time) AS bucket, sensor_id, metric,
  {AVG_V} AS avg_value, CAST(MIN(value) AS DOUBLE) AS min_value, CAST(MAX(value) AS DOUBLE) AS max_value,
  CAST(COUNT(*) AS INTEGER) AS reading_count FROM sensor_readings WHERE quality_flag = 1 GROUP BY ALL""",
                                          "sensor_readings"))(
    lambda spark, sf: RP.hourly_aggregates(R(spark, sf)))
register("source_counts", with_views("SELECT source, COUNT(*) AS readings FROM sensor_readings GROUP BY source",
                                      "sensor_readings"))(
    lambda spark, sf: RP.source_counts(R(spark, sf)))

# ------------------------------------------------------------------ W2 / W3 / P5 / L4 / P6 / P12 / A26
LATEST_SQL_T = f"""SELECT DISTINCT ON (sensor_id, metric) time, sensor_id, source, metric,
  CAST(value AS DOUBLE) AS value, unit, CAST(latitude AS DOUBLE) AS latitude,
  CAST(longitude AS DOUBLE) AS longitude, quality_flag, ingested_at
  FROM ({SCOPE}{{extra}}) ORDER BY sensor_id, metric, time DESC, ingested_at DESC, source DESC"""
LATEST_SQL = LATEST_SQL_T.format(extra="")
register("latest_readings", with_views(LATEST_SQL, "sensor_readings"))(
    lambda spark, sf: LT.latest_readings(R(spark, sf), AS_OF, HOURS))
_AIR = S.METRIC_DOMAINS["Air Quality"]
register("domain_latest", with_views(LATEST_SQL_T.format(extra=f" AND metric IN {Q.in_list(_AIR)}"),
                                      "sensor_readings"))(
    lambda spark, sf: LT.domain_latest(R(spark, sf), _AIR, AS_OF, HOURS))
register("top_latest", with_views(f"SELECT * FROM ({LATEST_SQL}) ORDER BY value DESC, sensor_id, metric LIMIT 12",
                                   "sensor_readings"))(
    lambda spark, sf: LT.top_latest(LT.latest_readings(R(spark, sf), AS_OF, HOURS), 12))
register("quality_exceptions", with_views(f"{SCOPE} AND quality_flag <> 1", "sensor_readings"))(
    lambda spark, sf: LT.quality_exceptions(R(spark, sf), AS_OF, HOURS))


# ------------------------------------------------------- A1, A3, A7, A9 from the states of days
SPAN = HOURS + 7.5      # a window that starts inside a day


def _windows(spark, sf, hours):
    """The states of a window, from sensors numbered and days written in two
    parts (the second adds its sensors and replaces only its own days)."""
    r, base = R(spark, sf), shared_dir(spark, f"days-{uuid.uuid4().hex[:8]}")
    old = r.filter(F.col("time") < ts_lit(DAYS_CUT, r.schema["time"].dataType))
    for part, days in ((old, None), (r, [dt.date.fromisoformat(DAYS_CUT[:10]) + dt.timedelta(days=i) for i in range(31)])):
        numbers = DY.number_sensors(spark, part, base + "/numbers")
        DY.write_days(spark, part, numbers, base + "/days", days)
    return DY.window_states(spark.read.parquet(base + "/days"), r, numbers, AS_OF, hours)


DAYS_CUT = "2024-01-20 00:00:00"
_SPAN = f"SELECT * FROM sensor_readings WHERE time >= {Q.cutoff(SPAN)}"
register("source_summary_by_day", with_views(SOURCE_SUMMARY_SQL, "sensor_readings"))(
    lambda spark, sf: DY.source_summary(_windows(spark, sf, HOURS)))
register("source_metric_counts_by_day", with_views(f"""SELECT source, metric, COUNT(*) AS readings, COUNT(DISTINCT sensor_id) AS sensors,
  MAX(time) AS latest_reading_at FROM ({_SPAN}) GROUP BY source, metric""", "sensor_readings"))(
    lambda spark, sf: DY.source_metric_counts(_windows(spark, sf, SPAN)))
register("metric_coverage_by_day", with_views(f"""SELECT metric, COUNT(DISTINCT source) AS sources, COUNT(DISTINCT sensor_id) AS sensors, COUNT(*) AS readings,
  MIN(time) AS first_reading_at, MAX(time) AS latest_reading_at FROM ({_SPAN}) GROUP BY metric""", "sensor_readings"))(
    lambda spark, sf: DY.metric_coverage(_windows(spark, sf, SPAN)))
register("window_totals_by_day", with_views(f"""SELECT COUNT(*) AS total_readings, COUNT(DISTINCT sensor_id) AS active_sensors, COUNT(DISTINCT metric) AS metrics,
  COUNT(DISTINCT source) AS sources, {VP} AS valid_pct FROM ({_SPAN})""", "sensor_readings"))(
    lambda spark, sf: DY.window_totals(_windows(spark, sf, SPAN)))
