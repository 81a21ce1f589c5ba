"""Tables of ``batch_id=<n>`` folders, ordinary Parquet written by sinks.

A sink that runs a batch again writes the batch's folder again, so nothing
is doubled; readers take what is newest of a key by an order that the rows
themselves carry.  No commit protocol is needed: a folder is only ever
written by its own batch, from tables of earlier batches and the batch's
input.  Rows may be partitioned by the day below the batch, so that a day
predicate prunes folders of every batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH, DAY = "batch_id", "p_date"


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def write_batch(df: DataFrame, path: str, batch_id: int, by_day: bool = False, by: str | None = None) -> None:
    """Write ``df`` as the whole of the batch's folder, by the day or by a
    column of few values."""
    if by_day:
        df, by = df.hint("rebalance", DAY), DAY  # AQE splits hot days
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (w.partitionBy(by) if by else w).parquet(f"{path}/{BATCH}={batch_id}")


def drop_part(spark: SparkSession, path: str, batch_id: int, part: str) -> None:
    """Delete the folder ``part`` of the batch, if it is there."""
    fs, jpath = _fs(spark, f"{path}/{BATCH}={batch_id}/{part}")
    fs.delete(jpath, True)


def batch_ids(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches whose folder was written to its end."""
    fs, folder = _fs(spark, path)
    if not fs.exists(folder):
        return []
    done = []
    for s in fs.listStatus(folder):
        name = s.getPath().getName()
        if name.startswith(f"{BATCH}=") and fs.exists(_fs(spark, f"{path}/{name}/_SUCCESS")[1]):
            done.append(int(name[len(BATCH) + 1:]))
    return sorted(done)


def last_before(spark: SparkSession, path: str, batch_id: int) -> int | None:
    """The newest batch before ``batch_id``: the one before it, as a rule."""
    fs, jpath = _fs(spark, f"{path}/{BATCH}={batch_id - 1}/_SUCCESS")
    if fs.exists(jpath):
        return batch_id - 1
    return max((b for b in batch_ids(spark, path) if b < batch_id), default=None)


def read_batches(spark: SparkSession, path: str, schema: T.StructType, by_day: bool = False, only: int | None = None) -> DataFrame:
    """All batches (or only one), with ``batch_id`` and, of tables by day,
    ``p_date``; an empty frame before the first write."""
    full = T.StructType([f for f in schema.fields if f.name not in (BATCH, DAY)] + ([T.StructField(DAY, T.DateType())] if by_day else [])
                        + [T.StructField(BATCH, T.LongType())])
    fs, jpath = _fs(spark, path if only is None else f"{path}/{BATCH}={only}")
    if not fs.exists(jpath):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", path).parquet(path if only is None else f"{path}/{BATCH}={only}")


def newest(df: DataFrame, key: list[str], order: str) -> DataFrame:
    """One row a key: that of the greatest ``order``.  A partial aggregate;
    predicates on key columns reach the scan."""
    rest = [c for c in df.columns if c not in key]
    return (df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r"))
            .select(*key, *[F.col("_r")[c].alias(c) for c in rest]).select(*df.columns))
