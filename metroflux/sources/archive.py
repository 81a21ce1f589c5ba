"""Partitioned Parquet archive.

Layout: ``<root>/p_source=<s>/p_metric=<m>/year=YYYY/month=MM/day=DD/part-*.parquet``
with the 11 canonical columns inside every file.  The partition columns
carry the sanitised source/metric under their own names so the original
``source`` / ``metric`` values stay in the files; readers use an explicit
schema with ``recursiveFileLookup`` and therefore always see file values.

File-level reports read only Parquet footers/metadata: ``_metadata``
columns (path, size, modification time) plus a row count per file.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import partition_value
from ..functions.timefn import seconds_between, ts_lit
from ..operators import tables as TB

ARCHIVE_SCHEMA = T.StructType([
    T.StructField("time", T.TimestampNTZType()), T.StructField("sensor_id", T.StringType()),
    T.StructField("metric", T.StringType()), T.StructField("value", T.DoubleType()),
    T.StructField("unit", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType()),
    T.StructField("quality_flag", T.ShortType()), T.StructField("ingested_at", T.TimestampNTZType()),
    T.StructField("schema_version", T.IntegerType()),
])
ARCHIVE_COLUMNS = [f.name for f in ARCHIVE_SCHEMA.fields]
READING_KEY = ["time", "sensor_id", "metric"]
PARTITION_COLUMNS = ["p_source", "p_metric", "year", "month", "day"]


def archive_frame(readings: DataFrame) -> DataFrame:
    """Canonical archive columns (value/coords as double) + partition keys."""
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in ARCHIVE_SCHEMA.fields]
    t = F.col("time")
    return readings.select(*cols, partition_value("source").alias("p_source"), partition_value("metric").alias("p_metric"),
                           F.date_format(t, "yyyy").alias("year"), F.date_format(t, "MM").alias("month"),
                           F.date_format(t, "dd").alias("day"))


def write_archive(readings: DataFrame, root: str, max_records_per_file: int = 5_000_000) -> bool:
    """Append one export run.  Empty input writes nothing (a LIMIT 1
    probe, not a count).  One shuffle groups rows by partition keys; the
    REBALANCE hint lets AQE split a hot partition (one source-day holding a
    third of the rows) over several writer tasks and merge tiny ones, and
    ``maxRecordsPerFile`` bounds file size."""
    if readings.isEmpty():
        return False
    (archive_frame(readings).hint("rebalance", *PARTITION_COLUMNS)
     .write.mode("append").option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(*PARTITION_COLUMNS).parquet(root))
    return True


def read_archive(spark: SparkSession, root: str) -> DataFrame:
    """The archive as an external table with a fixed schema; file values
    only (no partition discovery)."""
    return spark.read.schema(ARCHIVE_SCHEMA).option("recursiveFileLookup", "true").parquet(root)


def archive_files(spark: SparkSession, root: str) -> DataFrame:
    """One row per archive file: path, object name, size, mtime, rows."""
    df = read_archive(spark, root).select(F.col("_metadata.file_path").alias("file_path"),
                                          F.col("_metadata.file_size").alias("file_size"),
                                          F.col("_metadata.file_modification_time").alias("modified_at"))
    base = root.rstrip("/")
    return (df.groupBy("file_path", "file_size", "modified_at").agg(F.count(F.lit(1)).cast("bigint").alias("rows"))
            .withColumn("object_name", F.regexp_replace(
                F.regexp_replace("file_path", r"^file:(//)?", "/"), "^.*?" + _re_escape(base.split("://")[-1]) + "/", "")))


def _re_escape(s: str) -> str:
    import re
    return re.escape(s)


def archive_manifest(files: DataFrame) -> DataFrame:
    """Object name (relative to the root) and rows; an object outside
    the root is an error."""
    outside = F.col("object_name").startswith("..") | F.col("object_name").startswith("/")
    name = F.when(outside, F.raise_error(F.concat(F.lit("object outside the archive: "), F.col("object_name")))).otherwise(F.col("object_name"))
    return files.select(name.alias("object_name"), "rows", "file_size")


def _key(path_col: str, key: str):
    v = F.regexp_extract(F.col(path_col), f"(?:^|/){key}=([^/]*)", 1)
    return F.when(v == "", F.lit("unknown")).otherwise(v)


def archive_summary(files: DataFrame) -> DataFrame:
    """Per source x metric x date: files, rows, latest file; absent
    partition keys become ``unknown``."""
    date = F.concat_ws("-", _key("object_name", "year"), _key("object_name", "month"), _key("object_name", "day"))
    return (files.groupBy(_key("object_name", "p_source").alias("source"), _key("object_name", "p_metric").alias("metric"),
                          date.alias("date"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("files"), F.sum("rows").cast("bigint").alias("rows"),
                 F.max_by("object_name", F.struct("modified_at", "object_name")).alias("latest_object"),
                 F.max("modified_at").alias("latest_modified_at")))


def archive_totals(summary: DataFrame) -> DataFrame:
    """Totals over the summary: partitions, files, rows, latest object."""
    return summary.agg(F.count(F.lit(1)).cast("bigint").alias("partitions"), F.coalesce(F.sum("files"), F.lit(0)).cast("bigint").alias("files"),
                       F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows"),
                       F.max_by("latest_object", F.struct("latest_modified_at", "latest_object")).alias("latest_object"))


def archive_snapshot(archive: DataFrame, files: DataFrame) -> DataFrame:
    """Row count, max(time) as text, object count, latest object.  Rows
    come from the manifest; the latest time is in the newest day folders, so
    only those are scanned."""
    day = F.concat_ws("-", _key("object_name", "year"), _key("object_name", "month"), _key("object_name", "day"))
    newest = files.agg(F.max(day).alias("d")).scalar()
    in_newest = F.concat_ws("-", *[F.regexp_extract(F.col("_metadata.file_path"), f"/{k}=([^/]*)/", 1) for k in ("year", "month", "day")]) == newest
    a = archive.filter(in_newest).agg(F.date_format(F.max("time"), "yyyy-MM-dd HH:mm:ss").alias("latest_time"))
    f = files.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("row_count"), F.count(F.lit(1)).cast("bigint").alias("object_count"),
                  F.max_by("object_name", F.struct("modified_at", "object_name")).alias("latest_object"))
    from ..operators.reports import with_row
    return with_row(f, a).withColumn(
        "status", F.when((F.col("object_count") > 0) | (F.col("row_count") > 0), "Cloud archive active")
        .otherwise("Cloud archive ready"))


def export_candidates(readings: DataFrame, as_of, retention_hours: float = 72, mode: str = "retention",
                      limit: int | None = None, after: tuple | None = None) -> DataFrame:
    """Hot rows to export (time < as_of - retention in ``retention``
    mode, all in ``all`` mode) in (time, source, metric, sensor_id) order;
    ``limit`` is the export batch size (a TakeOrdered when set), and
    ``after`` the last exported (time, source, metric, sensor_id), from which
    the next batch goes on."""
    out = readings
    if after is not None:
        order = ["time", "source", "metric", "sensor_id"]
        key = F.struct(*[F.lit(v).cast(readings.schema[c].dataType).alias(c) for c, v in zip(order, after, strict=True)])
        out = out.filter((F.col("time") >= key["time"]) & (F.struct(*order) > key))
    if mode == "retention":
        end = (as_of if isinstance(as_of, _dt.datetime) else _dt.datetime.fromisoformat(str(as_of)))
        out = out.filter(F.col("time") < ts_lit(end - _dt.timedelta(hours=retention_hours), readings.schema["time"].dataType))
    out = out.orderBy("time", "source", "metric", "sensor_id")
    return out.limit(limit) if limit else out


def archive_export(readings: DataFrame, archived: DataFrame | None, as_of, retention_hours: float = 72,
                   mode: str = "retention") -> DataFrame:
    """Rows due for export that the archive does not hold yet (anti join
    on the reading key) - re-running an export adds nothing, and there is no
    per-run row cap."""
    due = export_candidates(readings, as_of, retention_hours, mode)
    if archived is None:
        return due
    keys = archived.select("time", "sensor_id", "metric")
    if mode == "retention":     # the due days bound what has to be read of the archive
        end = as_of if isinstance(as_of, _dt.datetime) else _dt.datetime.fromisoformat(str(as_of))
        keys = keys.filter(F.col("time") < ts_lit(end - _dt.timedelta(hours=retention_hours), archived.schema["time"].dataType))
    kind = keys.schema["time"].dataType
    if kind == due.schema["time"].dataType:
        return due.join(keys, READING_KEY, "left_anti")
    # the cast is on the side of the readings: one on the archive's would undo its buckets
    held = keys.select(*[F.col(c).alias(f"_{c}") for c in READING_KEY])
    return due.join(held, (F.col("time").cast(kind) == F.col("_time")) & (F.col("sensor_id") == F.col("_sensor_id")) & (F.col("metric") == F.col("_metric")), "left_anti")


def export_by_digest(spark: SparkSession, readings: DataFrame, manifest: DataFrame, root: str) -> DataFrame:
    """C1 by partition digest: rows of the days on which the readings differ
    from the archive's ``manifest`` (``tables.partition_digests`` of what was
    archived), without those the archive holds.  Of the archive only the
    folders of these days are read; their list (source, metric, day) is what
    reaches the driver."""
    differing = TB.differing_partitions(TB.partition_digests(readings), manifest).filter(F.col("hot_rows") > 0)
    days = differing.select(*TB.PARTITION, "archive_rows", partition_value("source").alias("p_source"), partition_value("metric").alias("p_metric")).collect()
    if not days:
        return readings.limit(0)
    listed = spark.createDataFrame([tuple(d)[:3] for d in days], "source string, metric string, day date")
    due = readings.withColumn("day", F.to_date("time")).join(listed, TB.PARTITION, "left_semi").drop("day")
    folders = [f"{root}/p_source={d['p_source']}/p_metric={d['p_metric']}/year={d['day']:%Y}/month={d['day']:%m}/day={d['day']:%d}" for d in days if d["archive_rows"]]
    if not folders:
        return due
    held = spark.read.schema(ARCHIVE_SCHEMA).parquet(*folders).select("time", "sensor_id", "metric")
    return due.join(held, ["time", "sensor_id", "metric"], "left_anti")


def bucketed_archive(spark: SparkSession, table: str, path: str, buckets: int | None = None) -> DataFrame:
    """An archive whose files are bucketed and sorted by the reading key,
    declared as ``table`` over ``path`` (in every session that uses it).
    ``archive_dedup`` of it stays inside a bucket, and an anti join moves the
    other side only.  ``buckets`` is fixed for the table's life; it defaults
    to the session's shuffle partitions, and fewer than those would make
    Spark shuffle the archive again.  A key that is exported very often stays
    in one bucket; exports that leave out what is held do not repeat keys."""
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = ", ".join(READING_KEY)
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ARCHIVE_SCHEMA.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def append_bucketed(readings: DataFrame, table: str) -> None:
    """Append an export run to a bucketed archive: one shuffle by the key with
    the table's own number of buckets, so a run adds one file a bucket."""
    spark = readings.sparkSession
    spec = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    (archive_frame(readings).select(*ARCHIVE_COLUMNS).repartition(int(spec["Num Buckets"]), *READING_KEY).write.insertInto(table))
    spark.catalog.refreshTable(table)


def expired_partitions(files: DataFrame, as_of, days: int = 365) -> DataFrame:
    """Day partitions older than ``days`` (by partition date)."""
    d = F.try_to_date(F.concat_ws("-", _key("object_name", "year"), _key("object_name", "month"),
                                  _key("object_name", "day")), "yyyy-MM-dd")
    end = as_of if isinstance(as_of, _dt.datetime) else _dt.datetime.fromisoformat(str(as_of))
    cut = F.lit((end - _dt.timedelta(days=days)).date())
    part = F.regexp_extract("object_name", r"^(.*)/[^/]*$", 1)
    return (files.filter(d < cut).groupBy(part.alias("partition"), d.alias("date"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("files"), F.sum("rows").cast("bigint").alias("rows")))


def expire_archive(spark: SparkSession, root: str, as_of, days: int = 365) -> int:
    """C5 as a job: delete the expired day partitions (a list bounded by the
    archive's days, sources and metrics); the number deleted."""
    expired = expired_partitions(archive_files(spark, root), as_of, days).select("partition").collect()
    return delete_partitions(spark, root, [r.partition for r in expired])


def delete_partitions(spark: SparkSession, root: str, partitions: list[str]) -> int:
    """Remove expired partition directories (a metadata operation over the
    partition list, which is bounded by the number of days, not rows)."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path
    n = 0
    for p in partitions:
        path = hpath(root.rstrip("/") + "/" + p)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(path) and fs.delete(path, True):
            n += 1
    return n


def archive_age(files: DataFrame, as_of) -> DataFrame:
    """Age in hours of the newest archive object."""
    now = ts_lit(as_of, T.TimestampType())
    return files.agg(F.max("modified_at").alias("latest_modified_at")).select(
        "latest_modified_at", (seconds_between(now, F.col("latest_modified_at")) / 3600.0).alias("age_hours"))
