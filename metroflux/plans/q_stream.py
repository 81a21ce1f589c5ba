"""Streaming queries (T1-T10, S5, S6, S15): the fixture messages are landed
as JSON-lines files (one part replayed) in the shared folder, then the
streaming jobs run with ``availableNow`` and their sink tables are read back."""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid

from pyspark.sql import functions as F

from ..functions.timefn import ts_lit
from ..operators import alerts as AL
from ..operators import normalize as N
from ..operators.reports import with_row
from ..session import shared_dir
from ..sources import fixtures as FX
from ..sources import payloads as P
from ..sources.batches import read_batches
from ..sources.fixtures import with_views
from ..streaming import alerting as AT
from ..streaming import jobs as J
from . import sqlkit as Q
from .catalog import AS_OF, ASOF, IM, ORACLES, R, register
from .q_alerts import EARLY, START, STATES_SQL
from .q_messages import MISMATCH_SQL, accepted_sql, messages
from .q_normalize import AQ_SQL, BIKE_SQL, READING_COLS, STATS_SQL, WX_SQL
from .q_quality import REASON_SQL
from .q_tables import LAST_WEEK, MID, OLDEST

_LANDED: dict[str, str] = {}


def landing_dir(spark, sf) -> str:
    """Messages as JSON-lines files; every 4th message is landed twice (a
    redelivery in a separate file)."""
    tag = hashlib.sha1((sf + spark.conf.get("spark.checkpoint.dir", "")).encode()).hexdigest()[:10]
    if tag in _LANDED:
        return _LANDED[tag]
    path = shared_dir(spark, f"landing-{tag}-{uuid.uuid4().hex[:6]}") + "/messages"
    m = messages(spark, sf)
    cols = ["body", "attributes", F.col("publish_time").cast("timestamp").alias("publish_time")]
    m.select(*cols).write.mode("append").json(path)
    m.filter(F.col("event_id") % 4 == 0).select(*cols).write.mode("append").json(path)
    _LANDED[tag] = path
    return path


def _ingest(spark, sf, max_files=None):
    base = shared_dir(spark, f"ingest-{uuid.uuid4().hex[:8]}")
    q = J.stream_ingest(spark, landing_dir(spark, sf), base + "/hot", base + "/dead_letter", base + "/metrics",
                        checkpoint=base + "/_checkpoint", max_files_per_trigger=max_files, now=AS_OF)
    q.awaitTermination()
    return base, q


def stream_ingest(spark, sf):
    base, _ = _ingest(spark, sf)
    return J.hot_table(spark, base + "/hot").select(F.col("time").cast("timestamp_ntz").alias("time"), "sensor_id", "metric", "value", "unit",
                                                      "source", "latitude", "longitude", "quality_flag",
                                                      F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"), "schema_version")


register("stream_ingest", ORACLES["decode_validate"])(stream_ingest)


RUNS = (4000, 4000, 10**9)


def bounded_consume(spark, sf):
    """Three runs over one landing folder: 4,000 accepted messages, 4,000
    more, and the rest; how many each run accepted, and the keys of the table
    after all of them."""
    base = shared_dir(spark, f"bounded-{uuid.uuid4().hex[:8]}")
    for limit in RUNS:
        J.bounded_consume(spark, landing_dir(spark, sf), base + "/hot", base + "/dead_letter", base + "/metrics", limit, base + "/_checkpoint", now=AS_OF)
    keys = J.hot_table(spark, base + "/hot").agg(F.count(F.lit(1)).alias("n")).scalar()
    rejected = J.dead_letters(spark, base + "/dead_letter").agg(F.count(F.lit(1)).alias("n")).scalar()
    return J.batch_metrics(spark, base + "/metrics").select(F.col("batch_id").alias("run"), "accepted", keys.alias("table_keys"), rejected.alias("all_rejected"))


# every 4th message is landed twice
_LANDED_SQL = "(SELECT * FROM readings_arrival UNION ALL SELECT * FROM readings_arrival WHERE event_id % 4 = 0)"
_GOOD_SQL = f"""(SELECT count(*) FROM (SELECT event_id, {REASON_SQL} AS reason FROM (SELECT * REPLACE (
  CASE WHEN event_id % 40 = 0 THEN '  ' ELSE sensor_id END AS sensor_id, CASE WHEN event_id % 30 = 0 THEN CAST(0 AS SMALLINT) ELSE quality_flag END AS quality_flag)
  FROM {_LANDED_SQL})) WHERE event_id % 50 <> 0 AND NOT {MISMATCH_SQL} AND reason = '')"""
register("bounded_consume", with_views(f"""
SELECT run, CAST(greatest(0, least(lim, good - used)) AS BIGINT) AS accepted, keys AS table_keys, landed - good AS all_rejected
FROM (SELECT {_GOOD_SQL} AS good, (SELECT count(*) FROM {_LANDED_SQL}) AS landed, (SELECT count(*) FROM ({accepted_sql()})) AS keys),
     (VALUES (0::BIGINT, 4000, 0), (1, 4000, 4000), (2, 1000000000, 8000)) r(run, lim, used)""", "readings_arrival"))(bounded_consume)


def throughput(spark, sf):
    base, _ = _ingest(spark, sf)
    rows = J.throughput_metrics(J.batch_metrics(spark, base + "/metrics"))
    return rows.select("batch_id", "input_rows", "accepted", "rejected", "channel_fill_pct", "dropped_readings_total")


register("throughput_metrics", with_views(f"""SELECT 0::BIGINT AS batch_id, n AS input_rows, ok AS accepted, n - ok AS rejected,
  CAST(least(100, 100 * n // 10000) AS SMALLINT) AS channel_fill_pct, n - ok AS dropped_readings_total
  FROM (SELECT count(*) AS n, {_GOOD_SQL} AS ok FROM {_LANDED_SQL})""", "readings_arrival"))(throughput)


def _accepted_stream(spark, sf):
    from ..operators import messages as M
    s = J.message_stream(spark, landing_dir(spark, sf))
    return M.accepted(M.decode_validate(s))


def stream_dedup(spark, sf):
    path = shared_dir(spark, f"dedup-{uuid.uuid4().hex[:8]}") + "/out"
    readings = _accepted_stream(spark, sf)
    J.drive(readings, J.dedup_batch_sink(spark, path, readings.schema))
    return (read_batches(spark, path, readings.schema, by_day=True).drop("batch_id", "p_date").withColumn("time", F.col("time").cast("timestamp_ntz"))
            .withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz")))


register("stream_dedup", ORACLES["decode_validate"])(stream_dedup)


def _weeks(spark, sf):
    """The readings as a stream that delivers them week by week of the time of
    ingestion, the oldest week last (two to four weeks late)."""
    readings = R(spark, sf)
    path = shared_dir(spark, f"weeks-{uuid.uuid4().hex[:8]}") + "/in"
    order = [MID, LAST_WEEK, OLDEST, "2024-01-01 00:00:00"]
    cuts = sorted([*order, AS_OF])
    for i, start in enumerate(order):
        end = cuts[cuts.index(start) + 1]
        at = readings.schema["time"].dataType
        (readings.filter((F.col("time") >= ts_lit(start, at)) & (F.col("time") < ts_lit(end, at))).coalesce(1)
         .write.mode("append").parquet(f"{path}/part={i}"))
    return spark.readStream.schema(readings.schema).option("maxFilesPerTrigger", 1).parquet(path + "/part=*"), readings.schema


def stream_hourly(spark, sf):
    stream, schema = _weeks(spark, sf)
    base = shared_dir(spark, f"hourly-{uuid.uuid4().hex[:8]}")
    J.drive(stream, J.hourly_batch(spark, base + "/states", base + "/hours"))
    return J.hourly_table(spark, base + "/hours", schema["value"].dataType, schema["time"].dataType)


register("stream_hourly", ORACLES["hourly_aggregates"])(stream_hourly)


def latest_state(spark, sf):
    """The latest reading of every sensor and metric, kept by a stream."""
    stream, _ = _weeks(spark, sf)
    base = shared_dir(spark, f"state-{uuid.uuid4().hex[:8]}")
    J.drive(stream, J.state_batch(spark, base + "/latest", base + "/sources"))
    return J.latest_state(spark, base + "/latest").select(
        F.col("time").cast("timestamp_ntz").alias("time"), "sensor_id", "source", "metric", "value", "unit", "latitude", "longitude", "quality_flag",
        F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"))


register("latest_state", with_views("""
SELECT time, sensor_id, source, metric, CAST(value AS DOUBLE) AS value, unit, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
       quality_flag, ingested_at FROM sensor_readings
QUALIFY row_number() OVER (PARTITION BY sensor_id, metric ORDER BY time DESC, ingested_at DESC, source DESC) = 1""", "sensor_readings"))(latest_state)


def alerts_from_state(spark, sf):
    """E1, E2 and the times of the overview from the kept source times."""
    stream, _ = _weeks(spark, sf)
    base = shared_dir(spark, f"state-{uuid.uuid4().hex[:8]}")
    J.drive(stream, J.state_batch(spark, base + "/latest", base + "/sources"))
    seen = J.source_state(spark, base + "/sources")
    row = with_row(AL.alert_no_ingestion(seen, AS_OF).withColumnRenamed("value", "no_ingestion"),
                   AL.alert_source_freshness(seen, AS_OF).withColumnRenamed("value", "source_freshness"))
    return with_row(row, seen.agg(F.max("time").cast("timestamp_ntz").alias("latest_reading_at"), F.max("ingested_at").cast("timestamp_ntz").alias("latest_ingested_at")))


_MINUTES = f"(epoch_us({ASOF}) - epoch_us(%s)) / 60000000.0"
register("alerts_from_state", with_views(f"""
SELECT round({_MINUTES % 'max(i)'}, 6) AS no_ingestion, round(max({_MINUTES % 'i'}), 6) AS source_freshness, max(t) AS latest_reading_at, max(i) AS latest_ingested_at
FROM (SELECT source, max(time) AS t, max(ingested_at) AS i FROM sensor_readings GROUP BY source)""", "sensor_readings"))(
    lambda spark, sf: alerts_from_state(spark, sf).withColumn("no_ingestion", F.round("no_ingestion", 6)).withColumn("source_freshness", F.round("source_freshness", 6)))


def redelivery(spark, sf):
    """Messages whose sensor number says how often they fail before they are
    taken (by % 8): attempts, outcome and the seconds until it."""
    base = shared_dir(spark, f"redelivery-{uuid.uuid4().hex[:8]}")
    failures = F.substring("attributes.sensor_id", 3, 9).cast("int") % 8
    step = J.redelivery(spark, base + "/ledger", base + "/settled", lambda attempt: failures >= attempt)
    landed = spark.read.schema(J.MESSAGE_FILE_SCHEMA).json(landing_dir(spark, sf))
    start = dt.datetime.fromisoformat(AS_OF)
    for number, seconds in enumerate((0, 5, 10, 30, 60, 70, 150, 3600)):  # a clock that ticks, also when nothing is due
        step(landed if number == 0 else None, number, start + dt.timedelta(seconds=seconds))
    settled = J.settled_messages(spark, base + "/settled")
    waited = F.unix_seconds("settled_at") - F.unix_seconds(F.lit(AS_OF).cast("timestamp"))
    return settled.groupBy(F.col("attributes.sensor_id").alias("sensor_id"), "attempts", "outcome", waited.alias("after_seconds")).agg(F.count(F.lit(1)).alias("messages"))


register("redelivery", with_views(f"""
SELECT sensor_id, CAST(least(k + 1, 5) AS INTEGER) AS attempts, CASE WHEN k < 5 THEN 'accepted' ELSE 'dead_letter' END AS outcome,
       CAST(10 * (power(2, least(k, 4)) - 1) AS BIGINT) AS after_seconds, count(*) AS messages
FROM (SELECT sensor_id, CAST(substr(sensor_id, 3) AS INTEGER) % 8 AS k FROM {_LANDED_SQL}) GROUP BY ALL""", "readings_arrival"))(redelivery)


def media_notifications(spark, sf):
    raw = FX.media_raw(spark, sf)
    name = F.regexp_replace("media_uri", r"^gs://[^/]+/", "")
    body = (F.when(F.col("event_id") % 97 == 0, F.lit("{not json"))
            .otherwise(F.to_json(F.struct(F.lit("bucket").alias("bucket"), name.alias("name")))))
    path = shared_dir(spark, f"notify-{uuid.uuid4().hex[:8]}")
    raw.select(body.alias("body")).write.json(path + "/in")
    J.run_to_table(J.notification_stream(spark, path + "/in", AS_OF), path + "/out")
    return spark.read.parquet(path + "/out").drop("batch_id")


def _notifications_sql():
    from .q_safety import EVENTS_SQL, NAME
    ok = EVENTS_SQL.replace("SELECT event_id, raw_label, confidence, is_suspicious AS raw_suspicious, event_time AS observed_at,",
                            "SELECT event_id,")
    return with_views(f"""
SELECT uri, city, camera_id, {ASOF} AS event_time, CAST(NULL AS VARCHAR) AS location_name, CAST(NULL AS DOUBLE) AS latitude,
       CAST(NULL AS DOUBLE) AS longitude, source_video_uri, frame_index, CAST(NULL AS VARCHAR) AS error FROM ({ok}) WHERE event_id % 97 <> 0
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
       CASE WHEN event_id % 97 = 0 THEN 'invalid notification JSON'
            ELSE 'not a supported media object: ' || {NAME} END
FROM media_raw WHERE event_id % 97 = 0 OR event_id % 13 = 0""", "media_raw")


register("media_notifications", _notifications_sql())(media_notifications)


# ---------------------------------------------------------------- N6 / N7: a stream a source
def _polled(spark, sf, broken=()):
    """The payloads of the four sources landed as JSON lines, in a ``broken``
    source every 50th or so cut off, and polled each by its own stream.  Station
    and sensor listings are read beside their streams.  (base, failures)"""
    base = shared_dir(spark, f"sources-{uuid.uuid4().hex[:8]}")

    def landed(name, kind, payload):
        at = f"{base}/landing/{name}"
        body = F.to_json(F.struct(*payload.columns))
        if name in broken:
            body = F.when(F.xxhash64(body) % 50 == 0, F.lit("{cut off")).otherwise(body)
        payload.select(body.alias("value")).write.text(at)
        return lambda: spark.readStream.schema(P.SCHEMAS[kind]).option("mode", "FAILFAST").json(at)

    sensors, stations = P.aq_sensors_fixture(spark, sf), P.gbfs_info_fixture(spark, sf)
    sources = {
        "openaq": J.Source(landed("openaq", "aq_latest", P.aq_latest_fixture(spark, sf)), lambda b: N.normalize_air_quality(b, sensors, AS_OF), F.size("results")),
        "openmeteo": J.Source(landed("openmeteo", "weather", P.weather_fixture(spark, sf)), lambda b: N.normalize_weather(b, AS_OF), F.lit(1)),
        "gbfs": J.Source(landed("gbfs", "gbfs_status", P.gbfs_status_fixture(spark, sf)), lambda b: N.normalize_bike_share(stations, b, AS_OF), F.size("data.stations")),
        "usgs": J.Source(landed("usgs", "usgs", P.usgs_fixture(spark, sf)), lambda b: N.normalize_river(b, AS_OF), F.size("value.timeSeries")),
    }
    return base, sources, J.poll_sources(spark, sources, base)


def polled_sources(spark, sf):
    """Received (time series, stations, measurements, requests), published
    and skipped by source, observed while the readings were written."""
    base, sources, _ = _polled(spark, sf)
    return J.poll_counts(spark, base, sources).groupBy("source").agg(*[F.sum(c).alias(c) for c in ("received", "published", "skipped")])


register("polled_sources", f"SELECT s.*, (SELECT count(*) FROM events) AS received FROM ({STATS_SQL}) s")(polled_sources)


def sources_apart(spark, sf):
    """N6 with river payloads that cannot be read: the others' readings, and
    whether the source failed."""
    base, sources, failures = _polled(spark, sf, broken=("usgs",))
    readings = J.polled_readings(spark, base, [s for s in sources if s != "usgs"], N.published(N.normalize_river(P.usgs_fixture(spark, sf), AS_OF)).schema)
    rows = _pub_columns(readings).withColumn("failed", F.lit(False))
    return rows.unionByName(failures.select(F.col("source"), F.lit(True).alias("failed")), allowMissingColumns=True)


def _pub_columns(readings):
    return readings.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in ("time", "ingested_at") else F.col(c) for c in READING_COLS])


register("sources_apart", " UNION ALL BY NAME ".join([f"SELECT *, false AS failed FROM ({q})" for q in (AQ_SQL, WX_SQL, BIKE_SQL)]
                                                     + ["SELECT 'usgs' AS source, true AS failed"]))(sources_apart)


# ---------------------------------------------------------------- E5 as a running evaluation
TICKS = 10


def alert_ticks(spark, sf):
    """The rules evaluated at every minute of the last ten, each tick from the
    state of the one before and the rows ingested since."""
    path = shared_dir(spark, f"alerts-{uuid.uuid4().hex[:8]}") + "/state"
    readings = R(spark, sf).select("source", "ingested_at", "quality_flag")
    metrics = IM(spark, sf).select("recorded_at", "dropped_readings_total")
    step, end = AT.alert_tick(spark, path, lambda: readings, lambda: metrics), dt.datetime.fromisoformat(AS_OF)
    for number in range(TICKS):
        step(number, end - dt.timedelta(minutes=TICKS - 1 - number))
    return AT.alert_history(spark, path).withColumn("eval_time", F.col("eval_time").cast("timestamp_ntz"))


_FIRST = dt.datetime.fromisoformat(AS_OF) - dt.timedelta(minutes=TICKS - 1)
register("alert_ticks", with_views(STATES_SQL.replace(EARLY, Q.ts(_FIRST - dt.timedelta(minutes=15))).replace(START, Q.ts(_FIRST)),
                                   "sensor_readings", "ingestion_metrics"))(alert_ticks)
