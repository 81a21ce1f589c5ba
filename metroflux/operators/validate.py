"""Reading validation (V1-V5) and the valid / quarantine split.

All rules are evaluated per row as one ``array_remove(array(...), '')`` of
error strings, so every error is reported (not just the first) and the
whole check is a single projection inside whole-stage codegen.  The rule
table is the 11-entry metric catalogue, inlined as CASE literals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.keys import dedup_key
from ..functions.text import is_blank, lookup
from ..functions.timefn import epoch_seconds


def _rule(metric: Column, pick: int) -> Column:
    return lookup(metric, {m: rule[pick] for m, rule in S.METRIC_RULES.items()})


def _fmt2(x: float) -> str:
    return f"{x:.2f}"


def validation_errors(reference: Column | None = None) -> Column:
    """Array of error messages; empty when the row is valid.

    ``reference`` is the comparison clock for the 5-minute skew rule; when
    omitted the reading's own time is used (the rule then never fires,
    matching the ingest paths)."""
    t = F.col("time")
    v = F.col("value").cast("double")
    lat, lon = F.col("latitude").cast("double"), F.col("longitude").cast("double")
    metric = F.col("metric")
    known = metric.isin(S.SUPPORTED_METRICS)
    lo, hi, unit = _rule(metric, 0), _rule(metric, 1), _rule(metric, 2)
    skew = (F.abs(epoch_seconds(t) - epoch_seconds(reference)) > S.TIME_SKEW_SECONDS
            if reference is not None else F.lit(False))
    nan_v = F.isnan(v)
    range_msg = F.concat(metric, F.lit(" value must be between "),
                         F.format_string("%.2f", lo), F.lit(" and "), F.format_string("%.2f", hi))
    checks = [
        F.when(t.isNull(), F.lit("time is required")),
        F.when(t.isNotNull() & skew, F.lit("time must be within 5m0s of reference time")),
        F.when(is_blank("sensor_id"), F.lit("sensor_id is required")),
        F.when(is_blank("metric"), F.lit("metric is required")),
        F.when(is_blank("unit"), F.lit("unit is required")),
        F.when(is_blank("source"), F.lit("source is required")),
        F.when(v.isNull() | nan_v | (F.abs(v) == float("inf")), F.lit("value must be finite")),
        F.when(~F.isnan(lat) & ((lat < -90) | (lat > 90)), F.lit("latitude must be between -90 and 90")),
        F.when(~F.isnan(lon) & ((lon < -180) | (lon > 180)), F.lit("longitude must be between -180 and 180")),
        F.when(F.coalesce(F.col("schema_version"), F.lit(0)) <= 0, F.lit("schema_version must be positive")),
        F.when(known & ~nan_v & ((v < lo) | (v > hi)), range_msg),
        F.when(known & (F.coalesce(F.col("unit"), F.lit("")) != unit),
               F.concat(metric, F.lit(' unit must be "'), unit, F.lit('"'))),
    ]
    # array_remove of "" (not array_compact, which is a lambda filter and
    # would take the whole stage out of generated code)
    return F.array_remove(F.array(*[F.coalesce(c, F.lit("")) for c in checks]), "")


def fence(df: DataFrame) -> DataFrame:
    """The same rows, as the output of a one-row generator: the optimizer
    does not push a filter below it, which would copy the expressions of the
    columns that the filter names."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def validate_readings(readings: DataFrame, reference: Column | None = None) -> DataFrame:
    """V1: readings plus ``errors`` (array<string>) and ``is_valid``."""
    return (readings.withColumn("errors", validation_errors(reference))
            .withColumn("is_valid", F.size("errors") == 0))


def split_valid(readings: DataFrame, reference: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """V2: (valid rows in the canonical shape, quarantine rows with key + reasons)."""
    checked = fence(validate_readings(readings, reference))
    valid = checked.filter("is_valid").drop("errors", "is_valid")
    quarantine = (checked.filter(~F.col("is_valid"))
                  .withColumn("dedup_key", dedup_key())
                  .withColumn("reason", F.array_join("errors", "; "))
                  .drop("is_valid"))
    return valid, quarantine


def supported_metrics(readings: DataFrame) -> DataFrame:
    """V3: rows whose metric is in the rule catalogue."""
    return readings.filter(F.col("metric").isin(S.SUPPORTED_METRICS))


def reading_checks() -> dict[str, Column]:
    return {
        "quality_flag_domain": F.col("quality_flag").isin(-1, 0, 1),
        "latitude_range": F.col("latitude").between(-90, 90),
        "longitude_range": F.col("longitude").between(-180, 180),
        "sensor_id_length": F.length("sensor_id") <= 64,
        "metric_length": F.length("metric") <= 32,
        "unit_length": F.length("unit") <= 16,
        "source_length": F.length("source") <= 32,
    }

def prediction_checks() -> dict[str, Column]:
    return {
        "crime_score_range": F.col("crime_score").between(0, 1),
        "type_score_range": F.col("type_score").isNull() | F.col("type_score").between(0, 1),
        "confidence_range": F.col("confidence").between(0, 1),
        "severity_domain": F.col("severity").isin("low", "medium", "high", "critical"),
        "review_status_domain": F.col("review_status").isin("pending", "reviewed", "dismissed"),
    }



def flag_checks() -> dict[str, Column]:
    return {
        "confidence_range": F.col("confidence").between(0, 1),
        "severity_domain": F.col("severity").isin("low", "medium", "high", "critical"),
        "review_status_domain": F.col("review_status").isin("pending", "reviewed", "dismissed"),
    }


def metric_checks() -> dict[str, Column]:
    return {"channel_fill_range": F.col("channel_fill_pct").between(0, 100)}


def check_constraints(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """V5: table CHECK rules as data-quality counts, one row per rule, all
    rules computed in one aggregate pass."""
    agg = df.agg(*[F.count(F.when(~F.coalesce(c, F.lit(False)), 1)).cast("bigint").alias(n)
                   for n, c in checks.items()], F.count(F.lit(1)).cast("bigint").alias("_rows"))
    stack = ", ".join(f"'{n}', `{n}`" for n in checks)
    return agg.selectExpr(f"stack({len(checks)}, {stack}) AS (rule, violations)", "_rows AS checked_rows")
