"""Archive queries.

The archive is written once per application into the shared checkpoint folder
(two export runs over the readings view, the second re-selecting the
oldest rows as the platform's export job does) and then read back."""

from __future__ import annotations

import datetime as _dt
import hashlib
import uuid

from pyspark.sql import functions as F

from ..operators import reports as RP
from ..operators import tables as TB
from ..session import shared_dir
from ..sources import archive as AR
from ..sources.fixtures import with_views
from . import sqlkit as Q
from .catalog import AS_OF, HOURS, IM, R, register
from .q_quality import FRESH_SQL, SOURCE_NAME
from .q_reports import SOURCE_SUMMARY_SQL
from .q_safety import PRED_SQL, preds
from .q_tables import ARCH_CUT, ARCHIVE_SQL, DEDUP_ARCHIVE_SQL, RETENTION_HOURS, archive_rows

_ROOTS: dict = {}
ARCHIVE_LAYOUT = "two-runs-oldest-rows-v2"   # changes when the export runs change


def archive_root(spark, sf) -> str:
    """Write the archive once per application into a fresh folder under the
    shared checkpoint location (never appended to an earlier, possibly
    half-written run)."""
    key = (spark.sparkContext.applicationId, sf, ARCHIVE_LAYOUT)
    if key not in _ROOTS:
        tag = hashlib.sha1((sf + ARCHIVE_LAYOUT).encode()).hexdigest()[:8]
        root = shared_dir(spark, f"archive-{tag}-{uuid.uuid4().hex[:8]}") + "/sensor_readings"
        AR.write_archive(archive_rows(spark, sf), root)
        _ROOTS[key] = root
    return _ROOTS[key]


def files(spark, sf):
    return AR.archive_files(spark, archive_root(spark, sf))


def _rows_per_partition(spark, sf):
    """Rows and files by partition folder, from the files' own metadata."""
    m = AR.archive_manifest(files(spark, sf))
    return m.groupBy(F.regexp_extract("object_name", r"^(.*)/[^/]*$", 1).alias("partition")).agg(
        F.sum("rows").cast("bigint").alias("rows"), (F.count(F.lit(1)) > 0).alias("has_files"), (F.min("file_size") > 0).alias("has_bytes"))


def _fresh_write(spark, sf):
    """Writes the archive anew and counts what a reader finds by partition."""
    root = shared_dir(spark, f"archive-write-{uuid.uuid4().hex[:8]}") + "/sensor_readings"
    AR.write_archive(archive_rows(spark, sf), root)
    back = AR.archive_frame(AR.read_archive(spark, root))
    return back.groupBy(*AR.PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("rows"), F.min("time").alias("first_time"), F.max("time").alias("last_time"))


def _bucketed(spark, sf):
    """The two export runs in a bucketed archive of their own."""
    tag = uuid.uuid4().hex[:8]
    table = f"archive_{tag}"
    AR.bucketed_archive(spark, table, shared_dir(spark, f"archive-bucketed-{tag}"))
    AR.append_bucketed(archive_rows(spark, sf), table)
    return spark.table(table)


def _part(c):
    return f"coalesce(nullif(regexp_replace({c}, '[^A-Za-z0-9._-]', '_', 'g'), ''), 'unknown')"


_PARTS = (f"SELECT *, {_part('source')} AS p_source, {_part('metric')} AS p_metric, strftime(time, '%Y') AS year, strftime(time, '%m') AS month, "
          f"strftime(time, '%d') AS day FROM ({ARCHIVE_SQL})")
_FOLDER = "'p_source=' || p_source || '/p_metric=' || p_metric || '/year=' || year || '/month=' || month || '/day=' || day"
EXPIRE_AS_OF = "2025-01-15 00:00:00"      # a year after the first half of the month
register("archive_write", with_views(f"""SELECT p_source, p_metric, year, month, day, count(*) AS rows, min(time) AS first_time, max(time) AS last_time
  FROM ({_PARTS}) GROUP BY ALL""", "readings_arrival"))(_fresh_write)
register("archive_manifest", with_views(f"""SELECT {_FOLDER} AS partition, count(*) AS rows, true AS has_files, true AS has_bytes
  FROM ({_PARTS}) GROUP BY 1""", "readings_arrival"))(_rows_per_partition)
register("archive_summary", with_views(f"""SELECT p_source AS source, p_metric AS metric, year || '-' || month || '-' || day AS date, count(*) AS rows
  FROM ({_PARTS}) GROUP BY ALL""", "readings_arrival"))(
    lambda spark, sf: AR.archive_summary(files(spark, sf)).select("source", "metric", "date", "rows"))
register("archive_totals", with_views(f"""SELECT count(DISTINCT {_FOLDER}) AS partitions, count(*) AS rows FROM ({_PARTS})""", "readings_arrival"))(
    lambda spark, sf: AR.archive_totals(AR.archive_summary(files(spark, sf))).select("partitions", "rows"))
register("archive_snapshot", with_views(f"""SELECT count(*) AS row_count, strftime(max(time), '%Y-%m-%d %H:%M:%S') AS latest_time,
  CASE WHEN count(*) > 0 THEN 'Cloud archive active' ELSE 'Cloud archive ready' END AS status FROM ({_PARTS})""", "readings_arrival"))(
    lambda spark, sf: AR.archive_snapshot(AR.read_archive(spark, archive_root(spark, sf)), files(spark, sf)).select("row_count", "latest_time", "status"))
register("archive_expire", with_views(f"""SELECT {_FOLDER} AS partition, CAST(time AS DATE) AS date, count(*) AS rows FROM ({_PARTS})
  WHERE CAST(time AS DATE) < DATE '2024-01-16' GROUP BY ALL""", "readings_arrival"))(
    lambda spark, sf: AR.expired_partitions(files(spark, sf), EXPIRE_AS_OF, 365).select("partition", "date", "rows"))
# the age of files just written has no SQL answer: no oracle, unit test only
register("archive_age", None)(lambda spark, sf: AR.archive_age(files(spark, sf), _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)))

_ARCH_COLS = ("time, sensor_id, metric, CAST(value AS DOUBLE) AS value, unit, source, CAST(latitude AS DOUBLE) AS latitude, "
              "CAST(longitude AS DOUBLE) AS longitude, quality_flag, ingested_at, schema_version")
register("archive_table", with_views(f"SELECT {_ARCH_COLS} FROM ({ARCHIVE_SQL})", "readings_arrival"))(
    lambda spark, sf: AR.read_archive(spark, archive_root(spark, sf)))
register("archive_export", with_views(f"SELECT * FROM sensor_readings WHERE time >= {ARCH_CUT}", "sensor_readings"))(
    lambda spark, sf: AR.archive_export(R(spark, sf), AR.read_archive(spark, archive_root(spark, sf)), AS_OF,
                                        RETENTION_HOURS, mode="all"))


register("archive_dedup_bucketed", with_views(f"SELECT {_ARCH_COLS} FROM ({DEDUP_ARCHIVE_SQL})", "readings_arrival"))(
    lambda spark, sf: TB.archive_dedup(_bucketed(spark, sf)))
register("archive_export_bucketed", with_views(f"SELECT * FROM sensor_readings WHERE time >= {ARCH_CUT}", "sensor_readings"))(
    lambda spark, sf: AR.archive_export(R(spark, sf), _bucketed(spark, sf), AS_OF, RETENTION_HOURS, mode="all"))


def _export_by_digest(spark, sf):
    root = archive_root(spark, sf)
    manifest = TB.partition_digests(TB.archive_dedup(AR.read_archive(spark, root)))
    return AR.export_by_digest(spark, R(spark, sf), manifest, root)


register("export_by_digest", with_views(f"SELECT * FROM sensor_readings WHERE time >= {ARCH_CUT}", "sensor_readings"))(_export_by_digest)
register("archive_candidates", with_views(f"""SELECT * FROM sensor_readings WHERE time < {ARCH_CUT}
  ORDER BY time, source, metric, sensor_id LIMIT 1000""", "sensor_readings"))(
    lambda spark, sf: AR.export_candidates(R(spark, sf), AS_OF, RETENTION_HOURS, limit=1000))


def _second_batch(spark, sf):
    first = AR.export_candidates(R(spark, sf), AS_OF, RETENTION_HOURS, limit=1000)
    order = ["time", "source", "metric", "sensor_id"]
    last = first.agg(F.max(F.struct(*order)).alias("k")).first()["k"]      # one key
    return AR.export_candidates(R(spark, sf), AS_OF, RETENTION_HOURS, limit=1000, after=tuple(last))


register("archive_candidates_next", with_views(f"""SELECT * FROM sensor_readings WHERE time < {ARCH_CUT}
  ORDER BY time, source, metric, sensor_id LIMIT 1000 OFFSET 1000""", "sensor_readings"))(_second_batch)

# ---------------------------------------------------------------- A14 table counts
register("table_counts", with_views(f"""SELECT 'sensor_readings' AS table_name, COUNT(*) AS row_count FROM sensor_readings
  UNION ALL SELECT 'ingestion_metrics', COUNT(*) FROM ingestion_metrics
  UNION ALL SELECT 'archive', COUNT(*) FROM ({ARCHIVE_SQL})
  UNION ALL SELECT 'video_activity_predictions', COUNT(*) FROM ({PRED_SQL})""",
                                     "sensor_readings", "ingestion_metrics", "media_raw", "readings_arrival"))(
    lambda spark, sf: RP.table_counts({"sensor_readings": R(spark, sf), "ingestion_metrics": IM(spark, sf),
                                       "archive": AR.read_archive(spark, archive_root(spark, sf)),
                                       "video_activity_predictions": preds(spark, sf)}))


# ---------------------------------------------------------------- A23 operations rollup
def _ops(spark, sf):
    summary = RP.source_summary(R(spark, sf), AS_OF, HOURS)
    return RP.operations_rollup(summary, RP.latest_ingestion(IM(spark, sf), R(spark, sf), AS_OF, HOURS))


register("operations_rollup", with_views(f"""
SELECT CAST(coalesce(sum(readings), 0) AS BIGINT) AS total_readings, max(latest_reading_at) AS latest_reading_at,
  COUNT(*) AS source_count, d.dropped_readings_total,
  CASE WHEN d.dropped_readings_total > 0 THEN 'Degraded' ELSE 'Healthy' END AS service_health
FROM ({SOURCE_SUMMARY_SQL}) s,
 (SELECT CAST(coalesce(max(dropped_readings_total), 0) AS BIGINT) AS dropped_readings_total FROM
   (SELECT dropped_readings_total FROM ingestion_metrics WHERE recorded_at >= {Q.cutoff(HOURS)}
    ORDER BY recorded_at DESC LIMIT 1)) d
GROUP BY d.dropped_readings_total""", "sensor_readings", "ingestion_metrics"))(_ops)


# ---------------------------------------------------------------- A29 executive report
def _exec(spark, sf):
    r = R(spark, sf)
    return RP.executive_report(RP.overview(r, IM(spark, sf), AS_OF, HOURS), RP.source_summary(r, AS_OF, HOURS),
                               AR.read_archive(spark, archive_root(spark, sf)), AS_OF, HOURS)


_EXEC_SQL = f"""
WITH o AS (SELECT COUNT(*) AS total_readings, COUNT(DISTINCT sensor_id) AS active_sensors,
                  COUNT(DISTINCT source) AS sources, {Q.valid_pct()} AS valid_pct
           FROM sensor_readings WHERE time >= {Q.cutoff(HOURS)}),
l AS (SELECT max(time) AS latest_reading_at FROM sensor_readings),
s AS (SELECT string_agg(source_name, ', ' ORDER BY readings DESC, source) AS names FROM
      (SELECT *, {SOURCE_NAME} AS source_name FROM ({SOURCE_SUMMARY_SQL}) ORDER BY readings DESC, source LIMIT 5)),
a AS (SELECT COUNT(*) AS archive_rows FROM ({ARCHIVE_SQL}))
SELECT 'Chicago has ' || format('{{:,}}', active_sensors) || ' monitored locations across ' || format('{{:,}}', sources)
         || CASE WHEN sources = 1 THEN ' source group' ELSE ' source groups' END || '.' AS statement_1,
  'The selected {int(HOURS)}-hour view includes ' || format('{{:,}}', total_readings) || ' readings with '
         || printf('%.1f', valid_pct) || '% ready for reporting.' AS statement_2,
  'The latest city update is ' || ({FRESH_SQL}) || '; most recent timestamp: '
         || coalesce(strftime(latest_reading_at, '%Y-%m-%d %H:%M UTC'), 'n/a') || '.' AS statement_3,
  'Active source groups: ' || CASE WHEN coalesce(names, '') = '' THEN 'No active source groups in this window'
         ELSE names END || '.' AS statement_4,
  'Historical archive status: ' || CASE WHEN archive_rows > 0 THEN 'Cloud archive active'
         ELSE 'Cloud archive ready' END || '.' AS statement_5
FROM o, l, s, a"""
register("executive_report", with_views(_EXEC_SQL, "sensor_readings", "readings_arrival"))(_exec)
