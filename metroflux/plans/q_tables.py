"""Keyed merges and archive-maintenance queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.timefn import ts_lit
from ..operators import safety as SF
from ..operators import tables as TB
from ..session import shared_dir
from ..sources import fixtures as FX
from ..sources.fixtures import with_views
from . import sqlkit as Q
from .catalog import AS_OF, ASOF, IM, R, register
from .q_safety import FLAGS_SQL, PRED_SQL, preds

# batches are cut by time (a natural delivery boundary), never by id subsets
MID = "2024-01-16 00:00:00"          # second half of the month is re-delivered / new
LAST_WEEK = "2024-01-24 00:00:00"    # ...and its last week is delivered twice
OLDEST = "2024-01-08 00:00:00"       # rows an export run without progress marker re-selects

RCOLS = "time, sensor_id, metric, value, unit, source, latitude, longitude, quality_flag, ingested_at, schema_version"
KEY = ["time", "sensor_id", "metric"]


# ---------------------------------------------------------------- S8 upsert_readings
def _at(df, value):
    return ts_lit(value, df.schema["time"].dataType)


def reading_batch(spark, sf):
    """Batch 2: every reading of the second half of the month re-sent with
    value + 1 an hour later; the last week's readings sent twice, the later
    arrival with value + 2 (last writer wins)."""
    base = FX.readings_with_arrival(spark, sf)
    hour = F.expr("INTERVAL 1 HOUR")
    a = base.filter(F.col("time") >= _at(base, MID)).withColumn("value", (F.col("value") + 1).cast("decimal(18,6)")) \
        .withColumn("ingested_at", F.col("ingested_at") + hour).withColumn("arrival", F.col("event_id") * 2)
    b = base.filter(F.col("time") >= _at(base, LAST_WEEK)).withColumn("value", (F.col("value") + 2).cast("decimal(18,6)")) \
        .withColumn("ingested_at", F.col("ingested_at") + hour).withColumn("arrival", F.col("event_id") * 2 + 1)
    return a.unionByName(b).drop("event_id")


BATCH_SQL = f"""SELECT {RCOLS.replace('value,', 'CAST(value + 1 AS DECIMAL(18,6)) AS value,').replace('ingested_at,', 'ingested_at + INTERVAL 1 HOUR AS ingested_at,')}, event_id * 2 AS arrival
  FROM readings_arrival WHERE time >= {Q.ts(MID)}
  UNION ALL
  SELECT {RCOLS.replace('value,', 'CAST(value + 2 AS DECIMAL(18,6)) AS value,').replace('ingested_at,', 'ingested_at + INTERVAL 1 HOUR AS ingested_at,')}, event_id * 2 + 1
  FROM readings_arrival WHERE time >= {Q.ts(LAST_WEEK)}"""
register("upsert_readings", with_views(f"""
WITH batch AS ({BATCH_SQL}),
latest AS (SELECT DISTINCT ON (time, sensor_id, metric) * FROM batch ORDER BY time, sensor_id, metric, arrival DESC)
SELECT {RCOLS} FROM sensor_readings r WHERE NOT EXISTS
  (SELECT 1 FROM latest l WHERE l.time = r.time AND l.sensor_id = r.sensor_id AND l.metric = r.metric)
UNION ALL SELECT {RCOLS} FROM latest""", "readings_arrival", "sensor_readings"))(
    lambda spark, sf: TB.upsert(R(spark, sf), reading_batch(spark, sf), KEY, "arrival"))


# ---------------------------------------------------------------- S10 upsert_metrics
def metrics_batch(spark, sf):
    im = IM(spark, sf)
    return (im.filter(F.col("recorded_at") >= ts_lit(MID, im.schema["recorded_at"].dataType))
            .withColumn("readings_per_second", F.col("readings_per_second") + 1)
            .withColumn("arrival", F.unix_seconds(F.col("recorded_at").cast("timestamp"))))


register("upsert_metrics", with_views(f"""
WITH batch AS (SELECT * REPLACE (readings_per_second + 1 AS readings_per_second) FROM ingestion_metrics
               WHERE recorded_at >= {Q.ts(MID)})
SELECT * FROM ingestion_metrics m WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.recorded_at = m.recorded_at)
UNION ALL SELECT * FROM batch""", "ingestion_metrics"))(
    lambda spark, sf: TB.upsert(IM(spark, sf), metrics_batch(spark, sf), ["recorded_at"], "arrival"))


# ---------------------------------------------------------------- S16 insert_predictions
PKEY = ["media_uri", "frame_key", "predicted_label"]


def _pred_keyed(df):
    return df.withColumn("frame_key", F.coalesce(F.col("frame_index"), F.lit(-1)))


def insert_predictions(spark, sf):
    p = _pred_keyed(preds(spark, sf, keep=["event_id"]))
    table = p.filter(F.col("event_time") < ts_lit(MID, p.schema["event_time"].dataType)).drop("event_id")
    # the whole listing is scored again (v2) and delivered twice (v3 later): first writer wins
    batch = p.withColumn("model_version", F.lit("v2")).withColumn("arrival", F.col("event_id"))
    dup = p.withColumn("model_version", F.lit("v3")).withColumn("arrival", F.col("event_id") + 100000000)
    out = TB.insert_absent(table, batch.unionByName(dup).drop("event_id"), PKEY, "arrival")
    return out.drop("frame_key")


_P = f"SELECT *, coalesce(frame_index, -1) AS frame_key FROM ({PRED_SQL})"
register("insert_predictions", with_views(f"""
WITH p AS ({_P}),
t AS (SELECT * FROM p WHERE event_time < {Q.ts(MID)}),
b AS (SELECT * REPLACE ('v2' AS model_version), event_id AS arrival FROM p
      UNION ALL SELECT * REPLACE ('v3' AS model_version), event_id + 100000000 FROM p),
f AS (SELECT DISTINCT ON (media_uri, frame_key, predicted_label) * FROM b ORDER BY media_uri, frame_key, predicted_label, arrival)
SELECT * EXCLUDE (event_id, frame_key) FROM t
UNION ALL SELECT * EXCLUDE (event_id, frame_key, arrival) FROM f
  WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.media_uri = f.media_uri AND t.frame_key = f.frame_key
                    AND t.predicted_label = f.predicted_label)""", "media_raw"))(insert_predictions)


# ---------------------------------------------------------------- S17 merge_flags
FKEY = ["video_uri", "clip_start_seconds", "predicted_label"]
FLAG_REPLACE = ["event_time", "clip_end_seconds", "display_label", "confidence", "severity", "model_name",
                "model_version", "created_at"]


def merge_flags(spark, sf):
    f = SF.flags(preds(spark, sf, keep=["event_id"]), keep=["event_id"])
    table = f.filter(F.col("event_time") < ts_lit(MID, f.schema["event_time"].dataType)).drop("event_id")
    batch = (f.withColumn("city", F.lit("evanston")).withColumn("review_status", F.lit("reviewed"))
             .withColumn("model_version", F.lit("v2"))
             .withColumn("created_at", F.col("created_at") + F.expr("INTERVAL 1 DAY"))
             .withColumn("arrival", F.col("event_id")).drop("event_id"))
    return TB.merge_columns(table, batch, FKEY, FLAG_REPLACE, "arrival")


_FCOLS = ("event_time, city, camera_id, video_uri, clip_start_seconds, clip_end_seconds, predicted_label, "
          "display_label, confidence, severity, model_name, model_version, review_status, created_at")
register("merge_flags", with_views(f"""
WITH f AS ({FLAGS_SQL}),
t AS (SELECT * FROM f WHERE event_time < {Q.ts(MID)}),
b0 AS (SELECT * REPLACE ('evanston' AS city, 'reviewed' AS review_status, 'v2' AS model_version,
                         created_at + INTERVAL 1 DAY AS created_at) FROM f),
b AS (SELECT DISTINCT ON (video_uri, clip_start_seconds, predicted_label) * FROM b0
      ORDER BY video_uri, clip_start_seconds, predicted_label, event_id DESC)
SELECT b.event_time, t.city, t.camera_id, t.video_uri, t.clip_start_seconds, b.clip_end_seconds, t.predicted_label,
       b.display_label, b.confidence, b.severity, b.model_name, b.model_version, t.review_status, b.created_at
  FROM t JOIN b USING (video_uri, clip_start_seconds, predicted_label)
UNION ALL SELECT {_FCOLS} FROM t WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.video_uri = t.video_uri
  AND b.clip_start_seconds = t.clip_start_seconds AND b.predicted_label = t.predicted_label)
UNION ALL SELECT {_FCOLS} FROM b WHERE NOT EXISTS (SELECT 1 FROM t WHERE b.video_uri = t.video_uri
  AND b.clip_start_seconds = t.clip_start_seconds AND b.predicted_label = t.predicted_label)""", "media_raw"))(merge_flags)


# ---------------------------------------------------------------- C2 archive_dedup / C6 reconcile
RETENTION_HOURS = 72


def archive_rows(spark, sf):
    """Two export runs: run 1 exported every row older than the retention
    cut; run 2 (no progress marker) re-selected the oldest rows again, one
    hour later in ingested_at."""
    base = FX.readings_with_arrival(spark, sf)
    cut = ts_lit(Q._dt.datetime.fromisoformat(AS_OF) - Q._dt.timedelta(hours=RETENTION_HOURS),
                 base.schema["time"].dataType)
    old = base.filter(F.col("time") < cut)
    again = old.filter(F.col("time") < ts_lit(OLDEST, old.schema["time"].dataType)).withColumn("ingested_at", F.col("ingested_at") + F.expr("INTERVAL 1 HOUR"))
    return old.unionByName(again).drop("event_id")


ARCH_CUT = Q.cutoff(RETENTION_HOURS)
ARCHIVE_SQL = f"""SELECT {RCOLS} FROM readings_arrival WHERE time < {ARCH_CUT}
  UNION ALL SELECT {RCOLS.replace('ingested_at,', 'ingested_at + INTERVAL 1 HOUR AS ingested_at,')}
  FROM readings_arrival WHERE time < {ARCH_CUT} AND time < {Q.ts(OLDEST)}"""
DEDUP_ARCHIVE_SQL = f"""SELECT DISTINCT ON (time, sensor_id, metric) {RCOLS} FROM ({ARCHIVE_SQL})
  ORDER BY time, sensor_id, metric, ingested_at DESC"""
register("archive_dedup", with_views(DEDUP_ARCHIVE_SQL, "readings_arrival"))(
    lambda spark, sf: TB.archive_dedup(archive_rows(spark, sf)))

register("reconcile_archive", with_views(f"""
WITH h AS (SELECT source, metric, CAST(time AS DATE) AS day, COUNT(*) AS hot_rows FROM sensor_readings GROUP BY ALL),
a AS (SELECT source, metric, CAST(time AS DATE) AS day, COUNT(*) AS archive_rows FROM ({DEDUP_ARCHIVE_SQL}) GROUP BY ALL)
SELECT source, metric, day, CAST(coalesce(hot_rows, 0) AS BIGINT) AS hot_rows,
  CAST(coalesce(archive_rows, 0) AS BIGINT) AS archive_rows,
  CASE WHEN coalesce(archive_rows, 0) < 1 THEN 'missing_in_archive' WHEN coalesce(hot_rows, 0) < 1 THEN 'missing_in_hot'
       WHEN hot_rows <> archive_rows THEN 'count_mismatch' ELSE 'ok' END AS status
FROM h FULL OUTER JOIN a USING (source, metric, day)""", "readings_arrival", "sensor_readings"))(
    lambda spark, sf: TB.reconcile(R(spark, sf), TB.archive_dedup(archive_rows(spark, sf))))

# the archive's first days were exported twice: as many keys, another ingestion time
register("reconcile_content", with_views(f"""
WITH h AS (SELECT source, metric, CAST(time AS DATE) AS day, count(*) AS hot_rows, sum(epoch_us(ingested_at)) AS hot_sum FROM sensor_readings GROUP BY ALL),
a AS (SELECT source, metric, CAST(time AS DATE) AS day, count(*) AS archive_rows, sum(epoch_us(ingested_at)) AS archive_sum FROM ({DEDUP_ARCHIVE_SQL}) GROUP BY ALL)
SELECT * EXCLUDE (hot_sum, archive_sum) FROM (SELECT source, metric, day, coalesce(hot_rows, 0) AS hot_rows, coalesce(archive_rows, 0) AS archive_rows, hot_sum, archive_sum,
  CASE WHEN archive_rows IS NULL THEN 'missing_in_archive' WHEN hot_rows IS NULL THEN 'missing_in_hot' WHEN hot_rows <> archive_rows THEN 'count_mismatch'
       WHEN hot_sum <> archive_sum THEN 'content_mismatch' END AS status FROM h FULL OUTER JOIN a USING (source, metric, day)) WHERE status IS NOT NULL""",
                                         "readings_arrival", "sensor_readings"))(
    lambda spark, sf: TB.differing_partitions(TB.partition_digests(R(spark, sf)), TB.partition_digests(TB.archive_dedup(archive_rows(spark, sf)))))


# ---------------------------------------------------------------- C3 retention_prune
def _pruned_in_place(spark, sf):
    """The readings as a table by day, after its rows due for deletion went."""
    path = shared_dir(spark, f"prune-{uuid.uuid4().hex[:8]}") + "/readings"
    R(spark, sf).withColumn("p_date", F.to_date("time")).hint("rebalance", "p_date").write.partitionBy("p_date").parquet(path)
    TB.prune_in_place(spark, path, AS_OF, 7)
    return spark.read.parquet(path).drop("p_date")


register("retention_prune_in_place", with_views(f"""SELECT * FROM sensor_readings
  WHERE NOT (source = 'simulator' AND metric = 'NO2' AND time < {Q.cutoff(7 * 24)})""", "sensor_readings"))(_pruned_in_place)
register("retention_prune", with_views(f"""SELECT * FROM sensor_readings
  WHERE NOT (source = 'simulator' AND metric = 'NO2' AND time < {Q.cutoff(7 * 24)})""", "sensor_readings"))(
    lambda spark, sf: TB.retention_prune(R(spark, sf), AS_OF, 7))


# ---------------------------------------------------------------- C4 grid_backfill
def _no2_sensors(readings):
    return (readings.filter(F.col("metric") == "NO2").groupBy("sensor_id")
            .agg(F.max("latitude").alias("latitude"), F.max("longitude").alias("longitude"),
                 F.max_by("value", F.struct("time", "value")).alias("last_value")))


register("grid_backfill", with_views(f"""
WITH s AS (SELECT sensor_id, max(latitude) AS latitude, max(longitude) AS longitude,
           max(struct_pack(t := time, v := value)).v AS last_value FROM sensor_readings WHERE metric = 'NO2' GROUP BY sensor_id),
g AS (SELECT * FROM s, generate_series(time_bucket(INTERVAL '10 minutes', {Q.cutoff(24)}),
                                       time_bucket(INTERVAL '10 minutes', {ASOF}), INTERVAL '10 minutes') AS t(time))
SELECT time, sensor_id, 'NO2' AS metric,
  CAST(last_value AS DOUBLE) AS value,
  'ppb' AS unit, 'simulator' AS source, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
  CAST(1 AS SMALLINT) AS quality_flag, {ASOF} AS ingested_at, 1 AS schema_version
FROM g WHERE NOT EXISTS (SELECT 1 FROM sensor_readings r WHERE r.metric = 'NO2' AND r.time = g.time
                         AND r.sensor_id = g.sensor_id)""", "sensor_readings"))(
    lambda spark, sf: TB.grid_backfill(R(spark, sf), _no2_sensors(R(spark, sf)), AS_OF, F.col("last_value")))
