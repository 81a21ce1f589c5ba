"""Keyed table maintenance as set-based Spark jobs.

The platform upserts row by row inside a transaction; here every batch is
merged at once:

* dedup inside the batch by key with ``max_by``/``min_by`` over the arrival
  order (a partial aggregate, no sort; last- or first-writer wins),
* anti / outer join to the table on the key (hash-partitioned on the full
  key, so one hot sensor does not concentrate a partition: the key includes
  the timestamp),
* union.  Streams keep such tables as batch folders (``sources.batches``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefn import ts_lit
from ..schema import READING_COLUMNS


def dedup_batch(batch: DataFrame, key: list[str], arrival: str, keep: str = "last") -> DataFrame:
    """One row per key: the last (or first) by ``arrival``."""
    cols = [c for c in batch.columns if c not in key]
    pick = F.max_by if keep == "last" else F.min_by
    return (batch.groupBy(*key).agg(pick(F.struct(*cols), F.col(arrival)).alias("_r"))
            .select(*key, *[F.col("_r." + c).alias(c) for c in cols]))


def upsert(table: DataFrame, batch: DataFrame, key: list[str], arrival: str = "arrival") -> DataFrame:
    """ON CONFLICT DO UPDATE of every non-key column (last writer wins)."""
    latest = dedup_batch(batch, key, arrival, "last").drop(arrival)
    kept = table.join(latest.select(*key), key, "left_anti")
    return kept.unionByName(latest.select(*table.columns))


def insert_absent(table: DataFrame, batch: DataFrame, key: list[str], arrival: str = "arrival") -> DataFrame:
    """ON CONFLICT DO NOTHING: the first batch row of a new key is inserted,
    existing keys keep their row.

    The batch is aggregated once and joined once, to the table's keys alone;
    the table's rows themselves are not shuffled."""
    first = dedup_batch(batch, key, arrival, "first").drop(arrival)
    new = first.join(table.select(*key), key, "left_anti")
    return table.unionByName(new.select(*table.columns))


def merge_columns(table: DataFrame, batch: DataFrame, key: list[str], replace: list[str],
                  arrival: str = "arrival") -> DataFrame:
    """Column-selective upsert: on a key match only ``replace`` columns take
    the (last) batch value, all others keep the table's first-written value;
    unmatched batch rows are inserted whole.

    One full outer join: the table and the batch are each read once."""
    latest = dedup_batch(batch, key, arrival, "last").drop(arrival)
    rest = [c for c in table.columns if c not in key]
    t = table.select(*key, F.struct(*rest).alias("_t"))
    b = latest.select(*key, F.struct(*rest).alias("_b"))
    new, old = F.col("_b").isNotNull(), F.col("_t").isNotNull()

    def value(c: str) -> Column:
        batch_wins = new if c in replace else new & ~old
        return F.when(batch_wins, F.col("_b")[c]).otherwise(F.col("_t")[c]).alias(c)

    return t.join(b, key, "full_outer").select(*[F.col(c) if c in key else value(c) for c in table.columns])


# ------------------------------------------------------------------ archive / retention
def archive_dedup(archive: DataFrame, key: list[str] = ("time", "sensor_id", "metric"),
                  order: str = "ingested_at") -> DataFrame:
    """Repeated exports put the same key in several files; keep the most
    recently ingested copy (ties: any identical copy)."""
    key = list(key)
    cols = [c for c in archive.columns if c not in key]
    return (archive.groupBy(*key).agg(F.max_by(F.struct(*cols), F.col(order)).alias("_r"))
            .select(*key, *[F.col("_r." + c).alias(c) for c in cols]).select(*archive.columns))


def retention_prune(readings: DataFrame, as_of, days: float = 7, source: str = "simulator",
                    metric: str = "NO2") -> DataFrame:
    """The one bounded DELETE: rows of one source/metric older than n days."""
    cut = ts_lit(_shift(as_of, -days * 24), readings.schema["time"].dataType)
    drop = (F.col("source") == source) & (F.col("metric") == metric) & (F.col("time") < cut)
    return readings.filter(~drop)


def prune_in_place(spark: SparkSession, path: str, as_of, days: float = 7, source: str = "simulator", metric: str = "NO2",
                   day: str = "p_date") -> int:
    """C3 on a stored table partitioned by the day of ``time``: rewrites the
    days that hold rows to delete, by dynamic partition overwrite, and removes
    those of which nothing is left; other days' files are not touched.  What
    reaches the driver is one row a touched day.  Returns the rows deleted;
    running it again deletes nothing."""
    table = spark.read.parquet(path)
    cut = ts_lit(_shift(as_of, -days * 24), table.schema["time"].dataType)
    drop = (F.col("source") == source) & (F.col("metric") == metric) & (F.col("time") < cut)
    old = table.filter(F.col(day) <= F.to_date(cut))
    touched = old.groupBy(day).agg(F.count_if(drop).alias("gone"), F.count_if(~drop).alias("left")).filter("gone > 0").collect()
    some = [r[day] for r in touched if r["left"]]
    if some:
        (old.filter(F.col(day).isin(some) & ~drop).hint("rebalance", day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(day).parquet(path))
    for r in touched:
        if not r["left"]:
            jpath = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{day}={r[day]}")
            jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)
    return sum(r["gone"] for r in touched)


def _shift(as_of, hours: float):
    base = as_of if isinstance(as_of, _dt.datetime) else _dt.datetime.fromisoformat(str(as_of))
    return base + _dt.timedelta(hours=hours)


def grid_backfill(readings: DataFrame, sensors: DataFrame, as_of, value: Column, metric: str = "NO2",
                  unit: str = "ppb", source: str = "simulator", hours: float = 24, step_minutes: int = 10) -> DataFrame:
    """An aligned ``step`` grid over the last ``hours`` for each sensor
    (sensor_id, latitude, longitude); only points missing from the table are
    produced.  The grid is generated per sensor row with ``sequence`` +
    ``explode`` (narrow; no cross join), then anti-joined on the key.
    ``value`` is the caller's expression over ``time`` and the sensor row,
    such as the sensor's last observed value."""
    like = readings.schema["time"].dataType
    step = step_minutes * 60
    end = _dt.datetime.fromisoformat(str(as_of)) if not isinstance(as_of, _dt.datetime) else as_of
    start = end - _dt.timedelta(hours=hours)
    epoch = _dt.datetime(1970, 1, 1)

    def align(t):
        s = int((t - epoch).total_seconds())
        return epoch + _dt.timedelta(seconds=s - s % step)
    t0, t1 = ts_lit(align(start), like), ts_lit(align(end), like)
    grid = sensors.select("*", F.explode(F.sequence(t0, t1, F.expr(f"INTERVAL {step_minutes} MINUTES"))).alias("time"))
    points = grid.select(
        "time", "sensor_id", F.lit(metric).alias("metric"), value.cast("double").alias("value"),
        F.lit(unit).alias("unit"), F.lit(source).alias("source"),
        F.col("latitude").cast("double").alias("latitude"), F.col("longitude").cast("double").alias("longitude"),
        F.lit(1).cast("smallint").alias("quality_flag"), ts_lit(end, like).alias("ingested_at"),
        F.lit(1).cast("int").alias("schema_version"))
    existing = readings.filter(F.col("metric") == metric).select("time", "sensor_id", "metric")
    return points.join(existing, ["time", "sensor_id", "metric"], "left_anti")


def reconcile(hot: DataFrame, archive: DataFrame, minimum: int = 1) -> DataFrame:
    """Per (source, metric, date) row counts in hot vs archive, full outer
    joined; status ok / missing_in_archive / missing_in_hot / count_mismatch."""
    def counts(df, name):
        return (df.groupBy("source", "metric", F.to_date("time").alias("day"))
                .agg(F.count(F.lit(1)).cast("bigint").alias(name)))
    j = counts(hot, "hot_rows").join(counts(archive, "archive_rows"), ["source", "metric", "day"], "full_outer")
    h, a = F.coalesce(F.col("hot_rows"), F.lit(0)), F.coalesce(F.col("archive_rows"), F.lit(0))
    status = (F.when(a < minimum, "missing_in_archive").when(h < minimum, "missing_in_hot")
              .when(h != a, "count_mismatch").otherwise("ok"))
    return j.select("source", "metric", "day", h.cast("bigint").alias("hot_rows"), a.cast("bigint").alias("archive_rows"),
                    status.alias("status"))


PARTITION = ["source", "metric", "day"]


def partition_digests(readings: DataFrame) -> DataFrame:
    """source, metric, day, rows, checksum: an order-free checksum of the rows'
    reading columns.  Kept as a manifest beside an archive, it says which days
    differ without reading them."""
    def plain(c: str) -> Column:
        return F.col(c).cast("double") if c in ("value", "latitude", "longitude") else F.unix_micros(F.col(c).cast("timestamp")) if c in ("time", "ingested_at") else F.col(c)

    row = F.xxhash64(*[plain(c) for c in READING_COLUMNS])
    return (readings.groupBy("source", "metric", F.to_date("time").alias("day"))
            .agg(F.count(F.lit(1)).alias("rows"), F.sum(row.cast("decimal(20,0)")).alias("checksum")))


def differing_partitions(hot: DataFrame, archived: DataFrame) -> DataFrame:
    """Digests of both sides that are not equal: source, metric, day and a
    status (missing_in_archive, missing_in_hot, count_mismatch,
    content_mismatch)."""
    h = hot.select(*PARTITION, F.col("rows").alias("hot_rows"), F.col("checksum").alias("hot_sum"))
    a = archived.select(*PARTITION, F.col("rows").alias("archive_rows"), F.col("checksum").alias("archive_sum"))
    j = h.join(a, PARTITION, "full_outer")
    status = (F.when(F.col("archive_rows").isNull(), "missing_in_archive").when(F.col("hot_rows").isNull(), "missing_in_hot")
              .when(F.col("hot_rows") != F.col("archive_rows"), "count_mismatch").when(F.col("hot_sum") != F.col("archive_sum"), "content_mismatch"))
    return j.select(*PARTITION, F.coalesce("hot_rows", F.lit(0)).alias("hot_rows"), F.coalesce("archive_rows", F.lit(0)).alias("archive_rows"),
                    status.alias("status")).filter(F.col("status").isNotNull())
