"""Validation, keys and display queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..functions.keys import dedup_key, partition_path
from ..functions.timefn import freshness_label, ts_lit
from ..operators import latest as LT
from ..operators import reports as RP
from ..operators import validate as V
from ..sources.fixtures import with_views
from . import sqlkit as Q
from .catalog import ALL_METRICS, AS_OF, ASOF, HOURS, R, STALE_HOURS, register
from .q_reports import LATEST_SQL, NETWORK_SQL

DEDUP_SQL = ("sensor_id || '|' || strftime(time, '%Y-%m-%dT%H:%M:%S') || "
             "regexp_replace(strftime(time, '.%f'), '\\.?0+$', '') || 'Z' || '|' || metric")


def _case_metric(pick) -> str:
    whens = " ".join(f"WHEN '{m}' THEN {pick(m, r)}" for m, r in S.METRIC_RULES.items())
    return f"CASE metric {whens} END"


RANGE_MSG = _case_metric(lambda m, r: f"'{m} value must be between {r[0]:.2f} and {r[1]:.2f}'")
RULE_LO = _case_metric(lambda m, r: repr(r[0]))
RULE_HI = _case_metric(lambda m, r: repr(r[1]))
RULE_UNIT = _case_metric(lambda m, r: f"'{r[2]}'")
KNOWN = f"metric IN {Q.in_list(ALL_METRICS)}"
REASON_SQL = f"""concat_ws('; ',
  CASE WHEN time IS NULL THEN 'time is required' END,
  CASE WHEN coalesce(trim(sensor_id), '') = '' THEN 'sensor_id is required' END,
  CASE WHEN coalesce(trim(metric), '') = '' THEN 'metric is required' END,
  CASE WHEN coalesce(trim(unit), '') = '' THEN 'unit is required' END,
  CASE WHEN coalesce(trim(source), '') = '' THEN 'source is required' END,
  CASE WHEN value IS NULL OR NOT isfinite(CAST(value AS DOUBLE)) THEN 'value must be finite' END,
  CASE WHEN latitude < -90 OR latitude > 90 THEN 'latitude must be between -90 and 90' END,
  CASE WHEN longitude < -180 OR longitude > 180 THEN 'longitude must be between -180 and 180' END,
  CASE WHEN coalesce(schema_version, 0) <= 0 THEN 'schema_version must be positive' END,
  CASE WHEN {KNOWN} AND (value < {RULE_LO} OR value > {RULE_HI}) THEN {RANGE_MSG} END,
  CASE WHEN {KNOWN} AND coalesce(unit, '') <> {RULE_UNIT} THEN metric || ' unit must be "' || {RULE_UNIT} || '"' END)"""


def _validated(spark, sf):
    return V.validate_readings(R(spark, sf))


register("validate_readings", with_views(f"""SELECT time, sensor_id, metric, reason, reason = '' AS is_valid
  FROM (SELECT *, {REASON_SQL} AS reason FROM sensor_readings)""", "sensor_readings"))(
    lambda spark, sf: _validated(spark, sf).select(
        "time", "sensor_id", "metric", F.array_join("errors", "; ").alias("reason"), "is_valid"))

register("quarantine_readings", with_views(f"""SELECT time, sensor_id, metric, CAST(value AS DOUBLE) AS value,
  {DEDUP_SQL} AS dedup_key, reason FROM (SELECT *, {REASON_SQL} AS reason FROM sensor_readings) WHERE reason <> ''""",
                                            "sensor_readings"))(
    lambda spark, sf: V.split_valid(R(spark, sf))[1].select(
        "time", "sensor_id", "metric", F.col("value").cast("double").alias("value"), "dedup_key", "reason"))

register("supported_metrics", with_views(f"""SELECT metric, COUNT(*) AS readings FROM sensor_readings
  WHERE {KNOWN} GROUP BY metric""", "sensor_readings"))(
    lambda spark, sf: V.supported_metrics(R(spark, sf)).groupBy("metric")
    .agg(F.count(F.lit(1)).cast("bigint").alias("readings")))

register("dedup_key", with_views(f"SELECT sensor_id, time, metric, {DEDUP_SQL} AS dedup_key FROM sensor_readings",
                                  "sensor_readings"))(
    lambda spark, sf: R(spark, sf).select("sensor_id", "time", "metric", dedup_key().alias("dedup_key")))

_CHECKS_SQL = {
    "quality_flag_domain": "quality_flag IN (-1, 0, 1)",
    "latitude_range": "latitude BETWEEN -90 AND 90",
    "longitude_range": "longitude BETWEEN -180 AND 180",
    "sensor_id_length": "length(sensor_id) <= 64",
    "metric_length": "length(metric) <= 32",
    "unit_length": "length(unit) <= 16",
    "source_length": "length(source) <= 32",
}
register("check_constraints", with_views(" UNION ALL ".join(
    f"SELECT '{n}' AS rule, COUNT(CASE WHEN NOT coalesce({c}, FALSE) THEN 1 END) AS violations, "
    f"COUNT(*) AS checked_rows FROM sensor_readings" for n, c in _CHECKS_SQL.items()), "sensor_readings"))(
    lambda spark, sf: V.check_constraints(R(spark, sf), V.reading_checks()))

# partition path + freshness label (scalar functions with their own keys)
_PP = ("'source=' || CASE WHEN regexp_replace(source, '[^A-Za-z0-9._-]+', '_', 'g') = '' THEN 'unknown' "
       "ELSE regexp_replace(source, '[^A-Za-z0-9._-]+', '_', 'g') END || '/metric=' || "
       "CASE WHEN regexp_replace(metric, '[^A-Za-z0-9._-]+', '_', 'g') = '' THEN 'unknown' "
       "ELSE regexp_replace(metric, '[^A-Za-z0-9._-]+', '_', 'g') END || "
       "strftime(time, '/year=%Y/month=%m/day=%d')")
register("partition_path", with_views(f"""SELECT partition_path, COUNT(*) AS readings FROM
  (SELECT {_PP} AS partition_path FROM sensor_readings) GROUP BY 1""", "sensor_readings"))(
    lambda spark, sf: R(spark, sf).groupBy(partition_path().alias("partition_path"))
    .agg(F.count(F.lit(1)).cast("bigint").alias("readings")))

_AGE = f"greatest(0.0, {Q.seconds_between(ASOF, 'latest_reading_at')})"
FRESH_SQL = f"""CASE WHEN latest_reading_at IS NULL THEN 'No data'
  WHEN {_AGE} < 90 THEN 'Live'
  WHEN {_AGE} < 3600 THEN CAST(CAST(floor({_AGE} / 60) AS BIGINT) AS VARCHAR) || ' min ago'
  WHEN {_AGE} < 86400 THEN CAST(CAST(floor({_AGE} / 3600) AS BIGINT) AS VARCHAR) || ' hr ago'
  ELSE CAST(CAST(floor({_AGE} / 86400) AS BIGINT) AS VARCHAR) || ' days ago' END"""
register("freshness", with_views(f"""SELECT sensor_id, source, latest_reading_at, {FRESH_SQL} AS freshness
  FROM ({NETWORK_SQL})""", "sensor_readings"))(
    lambda spark, sf: RP.sensor_network(R(spark, sf), AS_OF, HOURS, STALE_HOURS).select(
        "sensor_id", "source", "latest_reading_at",
        freshness_label("latest_reading_at", ts_lit(AS_OF, R(spark, sf).schema["time"].dataType)).alias("freshness")))


# ---------------------------------------------------------------- display
def _sql_lookup(col, mapping, fallback):
    whens = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {whens} ELSE {fallback} END"


_TITLE = ("array_to_string(list_transform(string_split(replace({c}, '_', ' '), ' '), "
          "lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ')")
SOURCE_NAME = (f"CASE WHEN coalesce(source, '') = '' THEN 'Unknown Source' ELSE "
               f"{_sql_lookup('source', S.SOURCE_LABELS, _TITLE.format(c='source'))} END")
METRIC_NAME = (f"CASE WHEN coalesce(metric, '') = '' THEN 'Unknown Metric' ELSE "
               f"{_sql_lookup('metric', S.METRIC_LABELS, _TITLE.format(c='metric'))} END")
METRIC_GROUP = ("CASE " + " ".join(f"WHEN metric IN {Q.in_list(ms)} THEN '{g}'"
                                   for g, ms in S.METRIC_DOMAINS.items()) + " ELSE 'Other' END")
QUALITY = "CASE quality_flag WHEN 1 THEN 'Valid' WHEN 0 THEN 'Suspect' WHEN -1 THEN 'Invalid' ELSE 'Unknown' END"
SENSOR_NAME = """CASE WHEN lower(coalesce(source, '')) = 'openmeteo' THEN 'Chicago Weather Station'
  WHEN lower(coalesce(source, '')) = 'usgs' OR starts_with(sensor_id, 'USGS-') THEN 'Chicago River at Columbus Drive'
  WHEN lower(coalesce(source, '')) = 'gbfs' OR starts_with(sensor_id, 'GBFS-') THEN 'Divvy Bike Station ' || regexp_replace(sensor_id, '^GBFS-', '')
  WHEN lower(coalesce(source, '')) = 'openaq' OR starts_with(sensor_id, 'OPENAQ-') THEN 'OpenAQ Air Sensor ' || regexp_replace(sensor_id, '^OPENAQ-', '')
  WHEN lower(coalesce(source, '')) = 'simulator' THEN 'City Sensor ' || sensor_id
  ELSE coalesce(sensor_id, 'unknown') END"""
DISPLAY_SQL = (f"SELECT *, {SOURCE_NAME} AS source_name, {METRIC_NAME} AS metric_name, {METRIC_GROUP} AS metric_group, "
               f"{QUALITY} AS quality, {SENSOR_NAME} AS sensor_name FROM ({LATEST_SQL})")
register("display_columns", with_views(DISPLAY_SQL, "sensor_readings"))(
    lambda spark, sf: LT.display_columns(LT.latest_readings(R(spark, sf), AS_OF, HOURS)))
register("filtered_latest", with_views(f"SELECT * FROM ({DISPLAY_SQL}) WHERE quality = 'Valid' AND source = 'openmeteo'",
                                        "sensor_readings"))(
    lambda spark, sf: LT.filtered_latest(LT.latest_readings(R(spark, sf), AS_OF, HOURS), "Valid", "openmeteo"))

# ---------------------------------------------------------------- P12 radius
_LAT, _LON, _RAD = 41.80, -87.75, 9000.0
import math as _m
_DLAT = _m.degrees(_RAD / LT.EARTH_RADIUS_M)
_DLON = _DLAT / _m.cos(_m.radians(_LAT))
_HAV = (f"2 * {LT.EARTH_RADIUS_M!r} * asin(sqrt(pow(sin((radians(latitude) - radians({_LAT!r})) / 2), 2) + "
        f"cos(radians({_LAT!r})) * cos(radians(latitude)) * pow(sin((radians(longitude) - radians({_LON!r})) / 2), 2)))")
register("within_radius", with_views(f"""SELECT *, round({_HAV}, 3) AS distance_m FROM ({LATEST_SQL})
  WHERE latitude BETWEEN {_LAT - _DLAT!r} AND {_LAT + _DLAT!r} AND longitude BETWEEN {_LON - _DLON!r} AND {_LON + _DLON!r}
    AND round({_HAV}, 3) <= {_RAD!r}
  ORDER BY distance_m, sensor_id, metric LIMIT 50""", "sensor_readings"))(
    lambda spark, sf: LT.within_radius(LT.latest_readings(R(spark, sf), AS_OF, HOURS), _LAT, _LON, _RAD, 50))

# ---------------------------------------------------------------- A26 mobility
register("mobility_utilization", with_views(f"""SELECT sensor_name, bike_available_count, dock_available_count, station_capacity,
  coalesce(100.0 * bike_available_count / nullif(station_capacity, 0.0), 0.0) AS utilization_pct FROM (
  SELECT sensor_name,
    max(CASE WHEN metric = 'bike_available_count' THEN value END) AS bike_available_count,
    max(CASE WHEN metric = 'dock_available_count' THEN value END) AS dock_available_count,
    max(CASE WHEN metric = 'station_capacity' THEN value END) AS station_capacity
  FROM ({DISPLAY_SQL}) WHERE metric IN ('bike_available_count', 'dock_available_count', 'station_capacity')
  GROUP BY sensor_name) ORDER BY utilization_pct DESC, sensor_name LIMIT 15""", "sensor_readings"))(
    lambda spark, sf: RP.mobility_utilization(LT.display_columns(LT.latest_readings(R(spark, sf), AS_OF, HOURS)), 15))
