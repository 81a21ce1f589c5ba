"""Dashboard and operations reports over the readings table.

Every report is a lazy DataFrame: the window predicate on ``time`` is a
literal comparison against the raw column so it reaches the Parquet scan
(``PushedFilters``) and prunes date partitions; grouping keys are low
cardinality (source, metric, sensor, time bucket) so partial aggregation
collapses rows before the shuffle.  Exact distinct counts follow the
reference; scalar "guards" (EXISTS / fallbacks) are Spark scalar subqueries,
never driver-side branches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefn import hours_before, seconds_between, time_bucket, ts_lit
from .. import schema as S


DAY = "p_date"      # partition column of the hot table, when it is read as stored


def _since(df: DataFrame, column: str, as_of, hours: float) -> Column:
    """The recency predicate; on a table partitioned by the day of ``time``
    also the day predicate, so that older days are not even listed."""
    cut = hours_before(as_of, hours, df.schema[column].dataType)
    since = F.col(column) >= cut
    return since & (F.col(DAY) >= F.to_date(cut)) if column == "time" and DAY in df.columns else since


def _unless(rows: DataFrame, cut: Column) -> Column:
    """``cut``, or the end of time when ``rows`` has a row - one scalar
    subquery, known before the scan it filters."""
    never = F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")
    return rows.limit(1).agg(F.when(F.count(F.lit(1)) > 0, never).otherwise(cut.cast("timestamp_ntz")).alias("cut")).scalar()


def _visible_since(readings: DataFrame, cut: Column) -> DataFrame:
    """Readings whose ingestion time (else their time) is at or after
    ``cut``, as predicates on the plain columns."""
    kind = readings.schema["time"].dataType
    at = cut.cast(kind)
    out = readings.filter((F.col("ingested_at") >= at) | (F.col("ingested_at").isNull() & (F.col("time") >= at)))
    return out


def scoped(readings: DataFrame, as_of, hours: float = 24, source: str | None = None,
           metrics: list[str] | None = None, valid_only: bool = False) -> DataFrame:
    """Recency window, optional source / metric list, valid rows."""
    out = readings.filter(_since(readings, "time", as_of, hours))
    if source:
        out = out.filter(F.col("source") == source)
    if metrics is not None:
        out = out.filter(F.col("metric").isin(list(metrics)) if metrics else F.lit(False))
    if valid_only:
        out = out.filter(F.col("quality_flag") == S.QUALITY_VALID)
    return out


def valid_pct() -> Column:
    """100 * valid / total as double, 0 when empty."""
    valid = F.sum(F.when(F.col("quality_flag") == S.QUALITY_VALID, 1).otherwise(0))
    return F.coalesce(F.lit(100.0) * valid.cast("double") / F.nullif(F.count(F.lit(1)), F.lit(0)),
                      F.lit(0.0))


def _dbl(c: Column) -> Column:
    return c.cast("double")


def with_row(base: DataFrame, *others: DataFrame) -> DataFrame:
    """Append the columns of one-row frames (global aggregates) to ``base``
    as scalar subqueries: each is computed once and broadcast as a value,
    no join between frames."""
    out = base
    for other in others:
        s = other.select(F.struct(*other.columns).alias("r")).scalar()
        out = out.select("*", *[s[c].alias(c) for c in other.columns])
    return out


# ---------------------------------------------------------------- A1 overview
def _derived_ops(readings: DataFrame, present: DataFrame, as_of, hours: float) -> DataFrame:
    t = F.coalesce(F.col("ingested_at"), F.col("time"))
    cut = hours_before(as_of, hours, readings.schema["time"].dataType)
    span = seconds_between(F.max(t), F.min(t))
    return (_visible_since(readings, _unless(present, cut))
            .agg(F.lit(0).cast("bigint").alias("dropped_readings_total"),
                 F.lit(0).cast("int").alias("channel_fill_pct"),
                 F.coalesce(F.count(F.lit(1)).cast("double") / F.nullif(span, F.lit(0.0)),
                            F.lit(0.0)).alias("avg_readings_per_second")))


def overview(readings: DataFrame, metrics_table: DataFrame, as_of, hours: float = 24) -> DataFrame:
    scope = scoped(readings, as_of, hours)
    quality = scope.agg(
        F.count(F.lit(1)).cast("bigint").alias("total_readings"),
        F.countDistinct("sensor_id").cast("bigint").alias("active_sensors"),
        F.countDistinct("metric").cast("bigint").alias("metrics"),
        F.countDistinct("source").cast("bigint").alias("sources"),
        valid_pct().alias("valid_pct"))
    all_rows = readings.agg(F.max("time").alias("latest_reading_at"),
                            F.max("ingested_at").alias("latest_ingested_at"))
    in_window = metrics_table.filter(_since(metrics_table, "recorded_at", as_of, hours))
    ops = in_window.agg(
        F.coalesce(F.max("dropped_readings_total"), F.lit(0)).cast("bigint").alias("dropped_readings_total"),
        F.coalesce(F.max("channel_fill_pct"), F.lit(0)).cast("int").alias("channel_fill_pct"),
        F.coalesce(_dbl(F.avg("readings_per_second")), F.lit(0.0)).alias("avg_readings_per_second"))
    has_metrics = in_window.exists()
    latest = (ops.filter(has_metrics)
              .unionByName(_derived_ops(readings, in_window, as_of, hours).filter(~has_metrics)))
    # three one-row frames: the products are single rows
    return with_row(quality, all_rows, latest)


# ------------------------------------------------------------ A2 options
def source_options(readings: DataFrame) -> DataFrame:
    return readings.select("source").distinct().orderBy("source")


def metric_options(readings: DataFrame) -> DataFrame:
    return readings.select("metric").distinct().orderBy("metric")


# ------------------------------------------------------------ A3 source summary
def source_summary(readings: DataFrame, as_of, hours: float = 24) -> DataFrame:
    return (scoped(readings, as_of, hours).groupBy("source")
            .agg(F.count(F.lit(1)).cast("bigint").alias("readings"),
                 F.countDistinct("sensor_id").cast("bigint").alias("sensors"),
                 F.countDistinct("metric").cast("bigint").alias("metrics"),
                 F.max("time").alias("latest_reading_at"),
                 F.max("ingested_at").alias("latest_ingested_at"),
                 valid_pct().alias("valid_pct"))
            .orderBy(F.desc("readings"), "source"))


def valid_rate_by_source(readings: DataFrame, as_of, hours: float = 24) -> DataFrame:
    """Valid-reading rate by source (dashboard panel)."""
    return source_summary(readings, as_of, hours).select("source", "readings", "valid_pct")


# ------------------------------------------------------------ A4 trend
def _value_stats() -> list[Column]:
    return [_dbl(F.avg("value")).alias("avg_value"),
            _dbl(F.min("value")).alias("min_value"),
            _dbl(F.max("value")).alias("max_value"),
            F.count(F.lit(1)).cast("bigint").alias("readings")]


def trend(readings: DataFrame, metrics: list[str], as_of, hours: float = 24,
          source: str | None = None, every: str = "5 minutes") -> DataFrame:
    return (scoped(readings, as_of, hours, source, metrics, valid_only=True)
            .groupBy(time_bucket("time", every).alias("bucket"), "source", "metric")
            .agg(*_value_stats())
            .orderBy("bucket", "source", "metric"))


def domain_trend(readings: DataFrame, domain: str, as_of, hours: float = 24) -> DataFrame:
    """Trend restricted to one display domain (one unit family per panel)."""
    return trend(readings, S.METRIC_DOMAINS[domain], as_of, hours).withColumn("domain", F.lit(domain))


# ------------------------------------------------------------ A5 metric summary
def metric_summary(readings: DataFrame, metrics: list[str], as_of, hours: float = 24,
                   source: str | None = None) -> DataFrame:
    """Stats and latest value per metric in ONE aggregate (J3 fused):
    ``max_by`` on (time, sensor_id) is a partial aggregate, so no sort and no
    self-join of the scoped rows."""
    latest = F.max_by(F.struct("value", "unit", "time"), F.struct("time", "sensor_id"))
    return (scoped(readings, as_of, hours, source, metrics, valid_only=True)
            .groupBy("metric")
            .agg(latest.alias("l"),
                 _dbl(F.avg("value")).alias("avg_value"),
                 _dbl(F.min("value")).alias("min_value"),
                 _dbl(F.max("value")).alias("max_value"),
                 F.count(F.lit(1)).cast("bigint").alias("readings"),
                 F.countDistinct("sensor_id").cast("bigint").alias("sensors"))
            .select("metric", _dbl(F.col("l.value")).alias("latest_value"), F.col("l.unit").alias("unit"),
                    "avg_value", "min_value", "max_value", "readings", "sensors",
                    F.col("l.time").alias("latest_reading_at"))
            .orderBy("metric"))


# ------------------------------------------------------------ A6 sensor network
def sensor_network(readings: DataFrame, as_of, hours: float = 24, stale_after_hours: float = 2) -> DataFrame:
    fresh_cut = hours_before(as_of, stale_after_hours, readings.schema["time"].dataType)
    # distinct metrics per sensor are bounded by the metric catalogue, so one
    # collect_set gives both the list and the count in a single-phase
    # aggregate (no distinct-aggregation expand / extra shuffle)
    return (scoped(readings, as_of, hours).groupBy("sensor_id", "source")
            .agg(F.count(F.lit(1)).cast("bigint").alias("readings"),
                 F.array_sort(F.collect_set("metric")).alias("_metrics"),
                 F.max("time").alias("latest_reading_at"),
                 F.max("ingested_at").alias("latest_ingested_at"),
                 _dbl(F.avg("latitude")).alias("latitude"),
                 _dbl(F.avg("longitude")).alias("longitude"),
                 valid_pct().alias("valid_pct"))
            .select("sensor_id", "source", "readings", F.size("_metrics").cast("bigint").alias("metric_count"),
                    F.array_join("_metrics", ", ").alias("metrics"), "latest_reading_at", "latest_ingested_at",
                    "latitude", "longitude", "valid_pct")
            .withColumn("status", F.when(F.col("latest_reading_at") >= fresh_cut, "fresh").otherwise("stale"))
            .orderBy(F.desc("latest_reading_at"), "source", "sensor_id"))


def network_rollup(network: DataFrame) -> DataFrame:
    """Fresh sensors, total sensors, total metric streams."""
    return network.agg(
        F.count(F.when(F.col("status") == "fresh", 1)).cast("bigint").alias("fresh_sensors"),
        F.count(F.lit(1)).cast("bigint").alias("total_sensors"),
        F.coalesce(F.sum("metric_count"), F.lit(0)).cast("bigint").alias("metric_streams"))


# ------------------------------------------------------------ A7-A9
def source_metric_counts(readings: DataFrame, as_of, hours: float = 24) -> DataFrame:
    return (scoped(readings, as_of, hours).groupBy("source", "metric")
            .agg(F.count(F.lit(1)).cast("bigint").alias("readings"),
                 F.countDistinct("sensor_id").cast("bigint").alias("sensors"),
                 F.max("time").alias("latest_reading_at"))
            .orderBy("source", "metric"))


def quality_label(flag: Column) -> Column:
    return F.when(flag == 1, "Valid").when(flag == 0, "Suspect").otherwise("Invalid")


def quality_distribution(readings: DataFrame, as_of, hours: float = 24) -> DataFrame:
    return (scoped(readings, as_of, hours).groupBy("quality_flag")
            .agg(F.count(F.lit(1)).cast("bigint").alias("readings"))
            .select(quality_label(F.col("quality_flag")).alias("quality"), "readings")
            .orderBy("quality"))


def readiness_score(distribution: DataFrame) -> DataFrame:
    """Valid / total * 100 from the quality distribution (0 when empty)."""
    return distribution.agg(
        F.coalesce(F.lit(100.0) * F.sum(F.when(F.col("quality") == "Valid", F.col("readings")).otherwise(0)).cast("double")
                   / F.nullif(F.sum("readings"), F.lit(0)), F.lit(0.0)).alias("readiness_score"),
        F.coalesce(F.sum("readings"), F.lit(0)).cast("bigint").alias("readings"))


def metric_coverage(readings: DataFrame, as_of, hours: float = 24) -> DataFrame:
    return (scoped(readings, as_of, hours).groupBy("metric")
            .agg(F.countDistinct("source").cast("bigint").alias("sources"),
                 F.countDistinct("sensor_id").cast("bigint").alias("sensors"),
                 F.count(F.lit(1)).cast("bigint").alias("readings"),
                 F.min("time").alias("first_reading_at"),
                 F.max("time").alias("latest_reading_at"))
            .orderBy(F.desc("readings"), "metric"))


def coverage_top(coverage: DataFrame, n: int = 14) -> DataFrame:
    """First n rows of the coverage report (a top-k display)."""
    return coverage.orderBy(F.desc("readings"), "metric").limit(n)


# ------------------------------------------------------------ A10 / A11 ingestion
def ingestion_trend(metrics_table: DataFrame, readings: DataFrame, as_of, hours: float = 24) -> DataFrame:
    """Per-minute ingestion metrics; when the window holds no metric rows the
    same shape is derived from readings (P8, decided by an EXISTS subquery)."""
    primary = (metrics_table.filter(_since(metrics_table, "recorded_at", as_of, hours))
               .groupBy(time_bucket("recorded_at", "1 minute").alias("bucket"))
               .agg(_dbl(F.avg("readings_per_second")).alias("readings_per_second"),
                    F.max("channel_fill_pct").cast("int").alias("channel_fill_pct"),
                    F.max("dropped_readings_total").cast("bigint").alias("dropped_readings_total"),
                    _dbl(F.avg("pubsub_lag_ms")).alias("pubsub_lag_ms"),
                    _dbl(F.avg("gcs_write_latency_ms")).alias("gcs_write_latency_ms")))
    t = F.coalesce(F.col("ingested_at"), F.col("time"))
    cut = hours_before(as_of, hours, readings.schema["time"].dataType)
    in_window = metrics_table.filter(_since(metrics_table, "recorded_at", as_of, hours))
    fallback = (_visible_since(readings, _unless(in_window, cut))
                .groupBy(time_bucket(t, "1 minute").alias("bucket"))
                .agg((F.count(F.lit(1)).cast("double") / F.lit(60.0)).alias("readings_per_second"),
                     F.lit(0).cast("int").alias("channel_fill_pct"),
                     F.lit(0).cast("bigint").alias("dropped_readings_total"),
                     F.lit(None).cast("double").alias("pubsub_lag_ms"),
                     F.lit(None).cast("double").alias("gcs_write_latency_ms")))
    has_primary = in_window.exists()
    return primary.filter(has_primary).unionByName(fallback.filter(~has_primary)).orderBy("bucket")


def _metric_row(df: DataFrame) -> DataFrame:
    return df.select("recorded_at",
                     _dbl(F.col("readings_per_second")).alias("readings_per_second"),
                     F.col("channel_fill_pct").cast("int").alias("channel_fill_pct"),
                     F.col("dropped_readings_total").cast("bigint").alias("dropped_readings_total"),
                     _dbl(F.col("pubsub_lag_ms")).alias("pubsub_lag_ms"),
                     _dbl(F.col("gcs_write_latency_ms")).alias("gcs_write_latency_ms"))


def latest_ingestion(metrics_table: DataFrame, readings: DataFrame, as_of, hours: float = 24) -> DataFrame:
    """Latest metrics row in the window, else the latest at all, else a row
    derived from readings. Top-1 is a TakeOrdered (no global sort)."""
    in_window = metrics_table.filter(_since(metrics_table, "recorded_at", as_of, hours))
    first = _metric_row(in_window.orderBy(F.desc("recorded_at")).limit(1))
    second = _metric_row(metrics_table.orderBy(F.desc("recorded_at")).limit(1))
    t = F.coalesce(F.col("ingested_at"), F.col("time"))
    cut = hours_before(as_of, hours, readings.schema["time"].dataType)
    third = (_visible_since(readings, _unless(metrics_table, cut))
             .agg(F.max(t).alias("recorded_at"),
                  F.coalesce(F.count(F.lit(1)).cast("double") / F.nullif(seconds_between(F.max(t), F.min(t)), F.lit(0.0)),
                             F.lit(0.0)).alias("readings_per_second"),
                  F.lit(0).cast("int").alias("channel_fill_pct"),
                  F.lit(0).cast("bigint").alias("dropped_readings_total"),
                  F.lit(None).cast("double").alias("pubsub_lag_ms"),
                  F.lit(None).cast("double").alias("gcs_write_latency_ms")))
    has_window = in_window.exists()
    has_any = metrics_table.exists()
    return (first.filter(has_window)
            .unionByName(second.filter(~has_window & has_any))
            .unionByName(third.filter(~has_any)))


# ------------------------------------------------------------ A12-A14
def hourly_aggregates(readings: DataFrame) -> DataFrame:
    """Continuous-aggregate equivalent: hour x sensor x metric over valid rows."""
    return (readings.filter(F.col("quality_flag") == S.QUALITY_VALID)
            .groupBy(time_bucket("time", "1 hour").alias("bucket"), "sensor_id", "metric")
            .agg(_dbl(F.avg("value")).alias("avg_value"),
                 _dbl(F.min("value")).alias("min_value"),
                 _dbl(F.max("value")).alias("max_value"),
                 F.count(F.lit(1)).cast("int").alias("reading_count")))


def source_counts(readings: DataFrame) -> DataFrame:
    return readings.groupBy("source").agg(F.count(F.lit(1)).cast("bigint").alias("readings"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row counts of named tables as (table_name, row_count)."""
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ------------------------------------------------------------ A23, A26, A29, A30
def operations_rollup(summary: DataFrame, latest_metrics: DataFrame) -> DataFrame:
    """Totals over the source summary plus service health from the latest
    ingestion row (dropped > 0 -> Degraded)."""
    s = summary.agg(F.coalesce(F.sum("readings"), F.lit(0)).cast("bigint").alias("total_readings"),
                    F.max("latest_reading_at").alias("latest_reading_at"),
                    F.count(F.lit(1)).cast("bigint").alias("source_count"))
    m = latest_metrics.agg(F.coalesce(F.max("dropped_readings_total"), F.lit(0)).cast("bigint").alias("dropped_readings_total"))
    return with_row(s, m).withColumn(
        "service_health", F.when(F.col("dropped_readings_total") > 0, "Degraded").otherwise("Healthy"))


MOBILITY_METRICS = ["bike_available_count", "dock_available_count", "station_capacity"]


def mobility_utilization(latest: DataFrame, top: int = 15) -> DataFrame:
    """Per station (display name) the max of each mobility metric, with
    a fixed pivot list so no extra pass discovers pivot values; utilisation =
    100 * bikes / capacity (capacity 0 or absent -> 0); the ``top`` stations
    by utilisation (a top-k display)."""
    pv = (latest.filter(F.col("metric").isin(MOBILITY_METRICS))
          .groupBy("sensor_name").pivot("metric", MOBILITY_METRICS).agg(F.max("value")))
    bikes, cap = F.col("bike_available_count").cast("double"), F.col("station_capacity").cast("double")
    return (pv.select("sensor_name",
                      *[F.col(m).cast("double").alias(m) for m in MOBILITY_METRICS],
                      F.coalesce(F.lit(100.0) * bikes / F.nullif(cap, F.lit(0.0)), F.lit(0.0)).alias("utilization_pct"))
            .orderBy(F.desc("utilization_pct"), "sensor_name").limit(top))


def map_points(network: DataFrame) -> DataFrame:
    """Sensors with coordinates; marker size = readings clipped 6..42."""
    return (network.dropna(subset=["latitude", "longitude"])
            .select("sensor_id", "source", "latitude", "longitude", "readings",
                    F.greatest(F.least(F.col("readings"), F.lit(42)), F.lit(6)).cast("bigint").alias("marker_size")))


def executive_report(overview_df: DataFrame, summary: DataFrame, archive_rows: DataFrame,
                     as_of, hours: float = 24, city: str = "Chicago") -> DataFrame:
    """The five executive statements as one row.  Top-5 source names come
    from a top-k over the per-source summary (one row per source)."""
    from ..functions.labels import source_label
    from ..functions.timefn import freshness_label
    names = (summary.orderBy(F.desc("readings"), "source").limit(5)
             .agg(F.array_join(F.transform(F.sort_array(F.collect_list(
                 F.struct((-F.col("readings")).alias("k"), F.col("source").alias("s")))),
                 lambda x: x["s"]), "\u0001").alias("srcs")))
    has_archive = archive_rows.exists()
    o = overview_df.select("total_readings", "active_sensors", "sources", "valid_pct", "latest_reading_at")
    as_of_c = ts_lit(as_of, overview_df.schema["latest_reading_at"].dataType)
    src_list = F.transform(F.split(F.col("srcs"), "\u0001"), lambda s: source_label(s))
    n_src = F.col("sources")
    return (with_row(o, names).select(
        F.concat(F.lit(f"{city} has "), F.format_number(F.col("active_sensors"), 0),
                 F.lit(" monitored locations across "), F.format_number(n_src, 0), F.lit(" "),
                 F.when(n_src == 1, F.lit("source group")).otherwise(F.lit("source groups")),
                 F.lit(".")).alias("statement_1"),
        F.concat(F.lit(f"The selected {int(hours)}-hour view includes "), F.format_number(F.col("total_readings"), 0),
                 F.lit(" readings with "), F.format_string("%.1f", F.col("valid_pct")),
                 F.lit("% ready for reporting.")).alias("statement_2"),
        F.concat(F.lit("The latest city update is "), freshness_label("latest_reading_at", as_of_c),
                 F.lit("; most recent timestamp: "),
                 F.coalesce(F.date_format("latest_reading_at", "yyyy-MM-dd HH:mm 'UTC'"), F.lit("n/a")),
                 F.lit(".")).alias("statement_3"),
        F.concat(F.lit("Active source groups: "),
                 F.when(F.col("srcs").isNull() | (F.col("srcs") == ""),
                        F.lit("No active source groups in this window"))
                 .otherwise(F.array_join(src_list, ", ")), F.lit(".")).alias("statement_4"),
        F.concat(F.lit("Historical archive status: "),
                 F.when(has_archive, F.lit("Cloud archive active"))
                 .otherwise(F.lit("Cloud archive ready")), F.lit(".")).alias("statement_5")))
