"""Normalisation queries (N1-N7, S3) over the landed-payload fixtures.

The oracles restate each normaliser's rules directly on the flat ``events``
columns the payloads were built from."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..operators import latest as LT
from ..operators import normalize as N
from ..sources import payloads as P
from .catalog import AS_OF, ASOF, register

READING_COLS = ["time", "sensor_id", "metric", "value", "unit", "source", "latitude", "longitude",
                "quality_flag", "ingested_at", "schema_version"]


def _pub(df):
    return N.published(df).select(
        F.col("time").cast("timestamp_ntz").alias("time"), *READING_COLS[1:9],
        F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"), "schema_version")


def aq(spark, sf):
    return N.normalize_air_quality(P.aq_latest_fixture(spark, sf), P.aq_sensors_fixture(spark, sf), AS_OF)


def wx(spark, sf):
    return N.normalize_weather(P.weather_fixture(spark, sf), AS_OF)


def bike(spark, sf):
    return N.normalize_bike_share(P.gbfs_info_fixture(spark, sf), P.gbfs_status_fixture(spark, sf), AS_OF)


def river(spark, sf):
    return N.normalize_river(P.usgs_fixture(spark, sf), AS_OF)


LAT = "(41.6::DOUBLE + CAST(user_id % 40 AS DOUBLE) * 0.01::DOUBLE)"
LON = "(-87.9::DOUBLE + CAST(user_id % 30 AS DOUBLE) * 0.01::DOUBLE)"


def _sql_pick(key, values):
    return "CASE " + " ".join(f"WHEN {key} = {i} THEN " + (f"'{v}'" if v is not None else "NULL")
                              for i, v in enumerate(values)) + " END"


def _reading_sql(time, sensor, metric, value, unit, source, lat, lon):
    return (f"SELECT {time} AS time, {sensor} AS sensor_id, {metric} AS metric, CAST({value} AS DOUBLE) AS value, "
            f"{unit} AS unit, '{source}' AS source, CAST({lat} AS DOUBLE) AS latitude, CAST({lon} AS DOUBLE) AS longitude, "
            f"CAST(1 AS SMALLINT) AS quality_flag, {ASOF} AS ingested_at, 1 AS schema_version")


# ---------------------------------------------------------------- N1
AQ_SQL = f"""
WITH b AS (
  SELECT event_id AS e, user_id, value, ts,
    {_sql_pick('event_id % 7', P.AQ_PARAMS)} AS pname,
    {_sql_pick('event_id % 7', P.AQ_PARAM_UNITS)} AS punits,
    CASE WHEN event_id % 20 = 1 THEN 'ppb' ELSE {_sql_pick('event_id % 5', P.AQ_UNITS)} END AS sunits,
    event_id % 10 <> 0 AS has_sensor,
    CASE WHEN event_id % 4 <> 0 THEN {LAT} WHEN event_id % 8 <> 0 THEN {LAT} + 0.001::DOUBLE END AS lat,
    CASE WHEN event_id % 4 <> 0 THEN {LON} WHEN event_id % 8 <> 0 THEN {LON} - 0.001::DOUBLE END AS lon,
    CASE WHEN event_id % 23 <> 0 THEN date_trunc('second', ts) END AS t
  FROM events),
k AS (SELECT *, replace(replace(replace(lower(trim(pname)), ' ', ''), '_', ''), '-', '') AS key,
             CASE WHEN trim(coalesce(sunits, '')) = '' THEN punits ELSE sunits END AS src_unit FROM b),
m AS (SELECT *, CASE WHEN key IN ('pm25', 'pm2.5') THEN 'PM2.5' WHEN key IN ('o3', 'ozone') THEN 'O3'
                     WHEN key IN ('no2', 'nitrogendioxide') THEN 'NO2' END AS metric,
             translate(replace(lower(trim(src_unit)), ' ', ''), 'µμ³', 'uu3') AS cleaned FROM k),
u AS (SELECT *, CASE WHEN metric = 'PM2.5' AND cleaned IN ('ug/m3', 'ugm-3', 'ugm3') THEN 'ug/m3'
                     WHEN metric = 'O3' AND cleaned = 'ppm' THEN 'ppm'
                     WHEN metric = 'NO2' AND cleaned = 'ppb' THEN 'ppb' END AS unit FROM m)
{_reading_sql('t', "'OPENAQ-' || CAST(e AS VARCHAR)", 'metric', 'value', 'unit', 'openaq', 'lat', 'lon')}
FROM u WHERE has_sensor AND metric IS NOT NULL AND unit IS NOT NULL AND lat IS NOT NULL AND t IS NOT NULL
  AND value BETWEEN (CASE metric WHEN 'O3' THEN 0 ELSE 0 END) AND (CASE metric WHEN 'O3' THEN 1 ELSE 1000 END)"""
register("normalize_air_quality", AQ_SQL)(lambda spark, sf: _pub(aq(spark, sf)))

# ---------------------------------------------------------------- N2
_WX_T = ("CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 4 = 0 THEN date_trunc('second', ts) "
         "ELSE date_trunc('minute', ts) END")
WX_SQL = " UNION ALL ".join(
    _reading_sql(_WX_T, f"printf('OPENMETEO-%.4f-%.4f', {LAT}, {LON})", f"'{m}'", expr, f"'{u}'", "openmeteo",
                 f"{LAT} + 0.002::DOUBLE", f"{LON} + 0.002::DOUBLE")
    + f" FROM events WHERE event_id % 17 <> 0{cond}"
    for m, expr, u, cond in [("temperature", "value * 0.1::DOUBLE - 20", "C", " AND event_id % 6 <> 0"),
                             ("humidity", "fmod(value, 100)", "%", ""),
                             ("wind_speed", "value * 0.2::DOUBLE", "km/h", ""),
                             ("precipitation", "CASE WHEN event_id % 19 <> 0 THEN value * 0.01::DOUBLE ELSE 0 END", "mm", "")])
register("normalize_weather", WX_SQL)(lambda spark, sf: _pub(wx(spark, sf)))

# ---------------------------------------------------------------- N3
_EPOCH = "epoch(date_trunc('second', ts))"
_BIKE_T = (f"CASE WHEN event_id % 5 <> 0 THEN date_trunc('second', ts) "
           f"WHEN event_id % 10 <> 0 THEN date_trunc('hour', ts) ELSE {ASOF} END")
_BIKES = "CASE WHEN event_id % 9 <> 0 THEN event_id % 20 ELSE 0 END"
_DOCKS = "CAST(trunc(value) AS BIGINT) % 25"
BIKE_SQL = " UNION ALL ".join(
    _reading_sql(_BIKE_T, "'GBFS-' || lpad(CAST(user_id AS VARCHAR), 4, '0')", f"'{m}'", expr, "'count'", "gbfs",
                 LAT, LON) + " FROM events WHERE user_id % 8 <> 0"
    for m, expr in [("bike_available_count", _BIKES), ("dock_available_count", _DOCKS),
                    ("station_capacity", "CASE WHEN user_id % 20 = 0 THEN 25 ELSE 20 END + user_id % 15 + CAST(floor(epoch(ts) / 3600) AS BIGINT) % 2")])
register("normalize_bike_share", BIKE_SQL)(lambda spark, sf: _pub(bike(spark, sf)))
# the poller's station limit: the first stations of every poll
_FIRST = f"""(SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY floor(epoch(ts) / 3600) ORDER BY lpad(CAST(user_id AS VARCHAR), 4, '0'),
  CASE WHEN event_id % 5 = 0 THEN 0 ELSE floor(epoch(ts)) END, {_BIKES}, {_DOCKS}) AS k FROM events) WHERE k <= 5)"""
register("bike_share_station_limit", BIKE_SQL.replace("FROM events", f"FROM {_FIRST}"))(lambda spark, sf: _pub(
    N.normalize_bike_share(P.gbfs_info_fixture(spark, sf), P.gbfs_status_fixture(spark, sf), AS_OF, limit=5)))

# ---------------------------------------------------------------- N4
_V1 = ("CASE WHEN event_id % 9 = 0 THEN 'Ice' WHEN event_id % 50 = 0 THEN '1e400' WHEN event_id % 60 = 0 THEN 'NaN' "
       "ELSE CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) END")
_V2 = "CAST(CAST(value AS DECIMAL(10,2)) * 2 AS VARCHAR)"
RIVER_SQL = f"""
WITH m AS (
  SELECT user_id, event_id, 1 AS n, {_V1} AS txt, date_trunc('millisecond', ts) AS t FROM events WHERE event_id % 6 <> 0
  UNION ALL
  SELECT user_id, event_id, 2, {_V2}, CASE WHEN event_id % 31 <> 0 THEN date_trunc('millisecond', ts + INTERVAL 15 MINUTE) END
  FROM events WHERE event_id % 6 <> 0),
p AS (SELECT *, TRY_CAST(txt AS DOUBLE) AS v FROM m
      WHERE t IS NOT NULL AND txt NOT IN ('Ice', '1e400'))
{_reading_sql('t', "'USGS-0553' || lpad(CAST(user_id AS VARCHAR), 4, '0')", "'water_gage_height'", 'v', "'ft'", 'usgs',
              LAT, LON)}
FROM p WHERE isfinite(v) AND v BETWEEN -100 AND 100"""
register("normalize_river", RIVER_SQL)(lambda spark, sf: _pub(river(spark, sf)))

# ---------------------------------------------------------------- N6 / N7
ALL_SQL = " UNION ALL ".join(f"SELECT * FROM ({q})" for q in (AQ_SQL, WX_SQL, BIKE_SQL, RIVER_SQL))
register("all_sources", ALL_SQL)(
    lambda spark, sf: _pub(N.all_sources(aq(spark, sf), wx(spark, sf), bike(spark, sf), river(spark, sf))))
STATS_SQL = f"""
WITH pub AS (SELECT source, COUNT(*) AS published FROM ({ALL_SQL}) GROUP BY source),
el AS (SELECT 'openaq' AS source, COUNT(*) AS elements FROM events
       UNION ALL SELECT 'openmeteo', SUM(CASE WHEN event_id % 17 = 0 THEN 1 ELSE 4 END) FROM events
       UNION ALL SELECT 'gbfs', SUM(CASE WHEN user_id % 8 = 0 THEN 1 ELSE 3 END) FROM events
       UNION ALL SELECT 'usgs', SUM(CASE WHEN event_id % 6 = 0 THEN 1 ELSE 2 END) FROM events)
SELECT el.source, CAST(coalesce(published, 0) AS BIGINT) AS published,
       CAST(elements - coalesce(published, 0) AS BIGINT) AS skipped
FROM el LEFT JOIN pub USING (source)"""
register("normalize_stats", STATS_SQL)(
    lambda spark, sf: N.normalize_stats(N.all_sources(aq(spark, sf), wx(spark, sf), bike(spark, sf), river(spark, sf))))


# ---------------------------------------------------------------- S19 station names
register("station_names", """SELECT DISTINCT lpad(CAST(user_id AS VARCHAR), 4, '0') AS station_id,
  'Station ' || CAST(user_id AS VARCHAR) AS name FROM events WHERE user_id % 8 <> 0""")(
    lambda spark, sf: N.station_names(P.gbfs_info_fixture(spark, sf)))
_POLL = "CAST(floor(epoch(ts) / 3600) AS BIGINT)"
register("air_quality_poll_counts", f"""SELECT {_POLL} AS poll_id, count(DISTINCT user_id) AS locations, count(*) AS measurements
  FROM events GROUP BY 1""")(lambda spark, sf: N.air_quality_poll_counts(P.aq_latest_fixture(spark, sf)))
register("bike_share_poll_counts", f"SELECT {_POLL} AS poll_id, count(*) AS stations FROM events GROUP BY 1")(
    lambda spark, sf: N.bike_share_poll_counts(P.gbfs_status_fixture(spark, sf)))


# Bike stations shown by the name in the station dimension
def _station_display(spark, sf):
    readings = N.published(bike(spark, sf)).select("sensor_id", "source").distinct()
    return LT.display_columns(readings, N.station_names(P.gbfs_info_fixture(spark, sf)))


register("station_display_names", f"""SELECT DISTINCT 'GBFS-' || lpad(CAST(user_id AS VARCHAR), 4, '0') AS sensor_id, 'gbfs' AS source,
  '{S.SOURCE_LABELS['gbfs']}' AS source_name, 'Station ' || CAST(user_id AS VARCHAR) AS sensor_name FROM events WHERE user_id % 8 <> 0""")(_station_display)
