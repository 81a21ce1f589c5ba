"""Day states: reports over any window from one small table a day.

A day's state has a row per source, metric, quality flag and bitmap bucket:
counts, first and last times, and the bitmap of the sensors seen.  Counts add
up, times merge by min / max and bitmaps by or, so an exact distinct count
over a window is the number of bits of the or-ed bitmaps; readings are read
only of the day in which the window starts, if it does not start at midnight.

Bits are sensor numbers, kept in a table that only grows: a number once given
stays.  A bucket holds 32,768 sensors and 4 KB, so a state row has a bounded
size whatever the number of sensors.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.timefn import hours_before
from ..sources.batches import DAY, batch_ids, read_batches, write_batch

NUMBERS = T.StructType([T.StructField("sensor_id", T.StringType()), T.StructField("number", T.LongType())])


def number_sensors(spark: SparkSession, readings: DataFrame, path: str) -> DataFrame:
    """(sensor_id, number) of every sensor, numbered from 1; sensors without a
    number get the next ones.  New sensors are range-partitioned and numbered
    inside their range; what reaches the driver is the size of each range.
    The batch's folder is written once per call, so a call that died is
    simply made again."""
    known = read_batches(spark, path, NUMBERS).drop("batch_id")
    batch = max(batch_ids(spark, path), default=-1) + 1
    new = readings.select("sensor_id").where("sensor_id IS NOT NULL").distinct().join(known, "sensor_id", "left_anti")
    ranged = new.repartitionByRange("sensor_id").sortWithinPartitions("sensor_id").select(
        "sensor_id", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("place"))
    write_batch(ranged, path + "-ranges", batch)      # fixed before it is counted
    ranged = read_batches(spark, path + "-ranges", ranged.schema, only=batch)
    first, offsets = known.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0] + 1, {}
    for r in ranged.groupBy("range").count().orderBy("range").collect():
        offsets[r["range"]] = first
        first += r["count"]
    if offsets:
        at = F.create_map(*[F.lit(x) for pair in offsets.items() for x in pair])
        write_batch(ranged.select("sensor_id", (at[F.col("range")] + F.col("place")).cast("long").alias("number")), path, batch)
    return read_batches(spark, path, NUMBERS).drop("batch_id")


def _states(readings: DataFrame, numbers: DataFrame) -> DataFrame:
    n = F.col("number")
    return (readings.withColumn(DAY, F.to_date("time")).join(numbers, "sensor_id", "left")
            .groupBy(DAY, "source", "metric", "quality_flag", F.bitmap_bucket_number(n).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(n)).alias("sensors"), F.count(F.lit(1)).alias("readings"),
                 F.min("time").alias("first_time"), F.max("time").alias("last_time"), F.max("ingested_at").alias("last_ingested")))


def write_days(spark: SparkSession, readings: DataFrame, numbers: DataFrame, path: str, days: list | None = None) -> None:
    """Write the states of ``days`` (those that rows were added to; None: of
    all), replacing these days and no other.  Every reading's sensor has to
    have its number."""
    if days is not None:
        readings = readings.filter(F.to_date("time").isin(days))
    (_states(readings, numbers).hint("rebalance", DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(DAY).parquet(path))


def window_states(days: DataFrame, readings: DataFrame, numbers: DataFrame, as_of, hours: float) -> DataFrame:
    """The states of the window of ``reports.scoped``: stored whole days after
    the one in which the window starts, and that day's rows of the window from
    the readings.  A window that starts at midnight reads no readings."""
    end = as_of if isinstance(as_of, _dt.datetime) else _dt.datetime.fromisoformat(str(as_of))
    start = end - _dt.timedelta(hours=hours)
    if start == _dt.datetime.combine(start.date(), _dt.time()):
        return days.filter(F.col(DAY) >= F.lit(start.date()))
    cut, midnight = (hours_before(x, 0, readings.schema["time"].dataType) for x in (start, _dt.datetime.combine(start.date() + _dt.timedelta(days=1), _dt.time())))
    edge = readings.filter((F.col("time") >= cut) & (F.col("time") < midnight))
    if DAY in edge.columns:       # a table by day: only this day's folder
        edge = edge.filter(F.col(DAY) == F.lit(start.date())).drop(DAY)
    return days.filter(F.col(DAY) > F.lit(start.date())).unionByName(_states(edge, numbers))


def _merged(states: DataFrame, keys: list[str]) -> DataFrame:
    """States merged to ``keys`` with the exact number of sensors.  The first
    aggregate leaves a row per key and bucket, partially or-ed before the
    shuffle."""
    valid = F.when(F.col("quality_flag") == S.QUALITY_VALID, F.col("readings")).otherwise(0)
    by_bucket = states.groupBy(*keys, "bucket").agg(
        F.bitmap_or_agg("sensors").alias("sensors"), F.sum("readings").alias("readings"), F.sum(valid).alias("valid"),
        F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time"), F.max("last_ingested").alias("last_ingested"))
    return by_bucket.groupBy(*keys).agg(
        F.sum(F.bitmap_count("sensors")).cast("bigint").alias("sensors"), F.sum("readings").cast("bigint").alias("readings"), F.sum("valid").alias("valid"),
        F.min("first_time").alias("first_reading_at"), F.max("last_time").alias("latest_reading_at"), F.max("last_ingested").alias("latest_ingested_at"))


def _distinct(states: DataFrame, keys: list[str], column: str, name: str) -> DataFrame:
    return states.select(*keys, column).distinct().groupBy(*keys).agg(F.count(column).cast("bigint").alias(name))


def _valid_pct() -> Column:
    return F.coalesce(F.lit(100.0) * F.col("valid").cast("double") / F.nullif(F.col("readings"), F.lit(0)), F.lit(0.0)).alias("valid_pct")


def _with(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right.withColumnRenamed(key, "_k"), F.col(key).eqNullSafe(F.col("_k")), "left").drop("_k")


def source_summary(states: DataFrame) -> DataFrame:
    """A3 from the states of a window."""
    out = _with(_merged(states, ["source"]), _distinct(states, ["source"], "metric", "metrics"), "source")
    return out.select("source", "readings", "sensors", "metrics", "latest_reading_at", "latest_ingested_at", _valid_pct()).orderBy(F.desc("readings"), "source")


def source_metric_counts(states: DataFrame) -> DataFrame:
    """A7 from the states of a window."""
    return _merged(states, ["source", "metric"]).select("source", "metric", "readings", "sensors", "latest_reading_at").orderBy("source", "metric")


def metric_coverage(states: DataFrame) -> DataFrame:
    """A9 from the states of a window."""
    out = _with(_merged(states, ["metric"]), _distinct(states, ["metric"], "source", "sources"), "metric")
    return out.select("metric", "sources", "sensors", "readings", "first_reading_at", "latest_reading_at").orderBy(F.desc("readings"), "metric")


def window_totals(states: DataFrame) -> DataFrame:
    """The counts of A1 over the window: one row, zeros when it is empty."""
    kinds = states.agg(F.countDistinct("metric").cast("bigint").alias("metrics"), F.countDistinct("source").cast("bigint").alias("sources"))
    from .reports import with_row
    valid = F.when(F.col("quality_flag") == S.QUALITY_VALID, F.col("readings")).otherwise(0)
    counts = states.agg(F.coalesce(F.sum("readings"), F.lit(0)).cast("bigint").alias("readings"), F.sum(valid).alias("valid"))
    sensors = (states.groupBy("bucket").agg(F.bitmap_or_agg("sensors").alias("sensors"))
               .agg(F.coalesce(F.sum(F.bitmap_count("sensors")), F.lit(0)).cast("bigint").alias("active_sensors")))
    return with_row(counts, sensors, kinds).select(F.col("readings").alias("total_readings"), "active_sensors", "metrics", "sources", _valid_pct())
