"""CSV report export (S18) and CSV dataset listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def export_csv(report: DataFrame, path: str, single_file: bool = False) -> bool:
    """Write a report frame as CSV files with a header; an empty frame
    exports nothing.  ``single_file`` puts a small aggregate in one file."""
    if report.isEmpty():
        return False
    out = report.coalesce(1) if single_file else report
    out.write.mode("overwrite").option("header", True).csv(path)
    return True


def read_listing_csv(spark: SparkSession, path: str) -> DataFrame:
    """A remote dataset listing (name, size): size parsed leniently, 0 when
    missing or not a number."""
    raw = spark.read.option("header", True).schema("name string, size string").csv(path)
    return raw.select(F.col("name").alias("path"),
                      F.coalesce(F.trim(F.col("size")).try_cast("bigint"), F.lit(0)).alias("size"))
