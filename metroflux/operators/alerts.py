"""Operational alerts.

E1-E4 are one-row values at a clock ``as_of``.  E5 evaluates the four rules
on a 1-minute evaluation grid and derives normal / pending / firing with a
gaps-and-islands window (a breach must hold for the rule's ``for`` period).

Scale: the readings are touched once per rule by a per-minute aggregate
(partial aggregation, then a shuffle keyed by minute); everything after
that runs on the evaluation grid, whose size is span / 1 minute, not the
data size.  Grid windows are partitioned by rule (and source for E2).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefn import seconds_between, time_bucket, ts_lit

NO_DATA = 9999.0
# --- fixed values: rule name, threshold (>), hold minutes, no-data state, severity
RULES = [
    ("no_recent_ingestion", 20.0, 5, "Alerting", "critical"),
    ("source_freshness", 20.0, 5, "Alerting", "warning"),
    ("quality_exceptions", 0.0, 1, "OK", "warning"),
    ("dropped_readings", 0.0, 1, "OK", "warning"),
]


def _clock(df: DataFrame, col: str, as_of) -> Column:
    return ts_lit(as_of, df.schema[col].dataType)


def alert_no_ingestion(readings: DataFrame, as_of) -> DataFrame:
    """Minutes since the last ingestion, 9999 when there is none."""
    now = _clock(readings, "ingested_at", as_of)
    return (readings.filter(F.col("ingested_at") <= now)
            .agg(F.coalesce(seconds_between(now, F.max("ingested_at")) / 60.0, F.lit(NO_DATA)).alias("value")))


def alert_source_freshness(readings: DataFrame, as_of) -> DataFrame:
    """The worst per-source staleness in minutes (two-level aggregate)."""
    now = _clock(readings, "ingested_at", as_of)
    per = (readings.filter(F.col("ingested_at") <= now).groupBy("source")
           .agg((seconds_between(now, F.max("ingested_at")) / 60.0).alias("age_minutes")))
    return per.agg(F.coalesce(F.max("age_minutes"), F.lit(NO_DATA)).alias("value"))


def alert_quality(readings: DataFrame, as_of, minutes: int = 15) -> DataFrame:
    """Non-valid rows ingested in the last ``minutes``."""
    now = _clock(readings, "ingested_at", as_of)
    lo = now - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    return (readings.filter((F.col("ingested_at") >= lo) & (F.col("ingested_at") <= now)
                            & (F.col("quality_flag") != 1))
            .agg(F.count(F.lit(1)).cast("double").alias("value")))


def alert_dropped(metrics: DataFrame, as_of, minutes: int = 15) -> DataFrame:
    """Increase of the dropped counter in the last ``minutes``."""
    now = _clock(metrics, "recorded_at", as_of)
    lo = now - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    return (metrics.filter((F.col("recorded_at") >= lo) & (F.col("recorded_at") <= now))
            .agg(F.coalesce(F.max("dropped_readings_total") - F.min("dropped_readings_total"), F.lit(0))
                 .cast("double").alias("value")))


# ------------------------------------------------------------------ E5
def _grid(spark, start: _dt.datetime, end: _dt.datetime, like) -> DataFrame:
    n = int((end - start).total_seconds() // 60)
    return spark.range(0, n + 1).select(
        (ts_lit(start, like) + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id").cast("int"))).alias("t"))


def _states(values: DataFrame) -> DataFrame:
    """values(rule, t, value, threshold, hold, on_no_data, severity) -> + breach
    start and state.  A null value is no data: the rule's policy says whether
    that counts as a breach."""
    values = values.withColumn("no_data", F.col("value").isNull())
    w = Window.partitionBy("rule").orderBy("t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    breach = F.coalesce(F.col("value") > F.col("threshold"), F.col("on_no_data") == "Alerting")
    x = values.withColumn("breach", breach).withColumn("island", F.sum(F.when(~breach, 1).otherwise(0)).over(w))
    wi = Window.partitionBy("rule", "island")
    x = x.withColumn("breach_start", F.min(F.when(F.col("breach"), F.col("t"))).over(wi))
    held = seconds_between(F.col("t"), F.col("breach_start")) / 60.0
    state = (F.when(~F.col("breach"), F.lit("normal"))
             .when(held >= F.col("hold"), F.lit("firing")).otherwise(F.lit("pending")))
    return x.select("rule", F.col("t").alias("eval_time"), "value", state.alias("state"), "severity", "no_data")


def alert_states(readings: DataFrame, metrics: DataFrame, as_of, span_hours: float = 24,
                 window_minutes: int = 15) -> DataFrame:
    """E5 over a 1-minute grid of ``span_hours`` ending at ``as_of``.

    Readings are scanned ONCE: a single aggregate keyed by (source, minute
    of visibility) yields the last ingestion time and the non-valid count;
    rows older than the grid collapse into one 'prior' row per source.  E1,
    E2 and E3 are then derived from that small frame."""
    spark = readings.sparkSession
    like = readings.schema["ingested_at"].dataType
    end = as_of if isinstance(as_of, _dt.datetime) else _dt.datetime.fromisoformat(str(as_of))
    start = end - _dt.timedelta(hours=span_hours)
    early = start - _dt.timedelta(minutes=window_minutes)
    one_min = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(1))
    ing = F.col("ingested_at")
    start_l, end_l, early_l = ts_lit(start, like), ts_lit(end, like), ts_lit(early, like)
    grid = _grid(spark, start, end, like)
    egrid = _grid(spark, early, end, like)

    # one pass: rows visible at t are those ingested strictly before t; a row
    # ingested in minute b becomes visible at t = b + 1 minute
    visible_at = F.when(ing >= early_l, time_bucket("ingested_at", "1 minute") + one_min)
    per = (readings.filter(ing < end_l)
           .groupBy("source", visible_at.alias("t"))
           .agg(F.max("ingested_at").alias("m"), F.count(F.when(F.col("quality_flag") != 1, 1)).alias("bad")))
    before = F.col("t").isNull() | (F.col("t") <= start_l)
    prior_src = per.filter(before).groupBy("source").agg(F.max("m").alias("prior"))
    in_grid = per.filter(~before)

    # Running max of per-minute maxima, seeded with the last ingestion before the grid
    prior = prior_src.agg(F.max("prior")).scalar()
    m1 = in_grid.groupBy("t").agg(F.max("m").alias("m"))
    wg = Window.orderBy("t").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # grid-sized
    e1 = (grid.join(m1, "t", "left")
          .withColumn("last", F.greatest(F.max("m").over(wg), prior))
          .select(F.lit(RULES[0][0]).alias("rule"), "t",
                  F.coalesce(seconds_between(F.col("t"), F.col("last")) / 60.0, F.lit(NO_DATA)).alias("value")))

    # The same per source (grid generated per source row), worst source per t
    n = int((end - start).total_seconds() // 60)
    sources = per.select("source").distinct()
    sgrid = sources.select("source", F.explode(F.sequence(F.lit(0), F.lit(n))).alias("i")).select(
        "source", (start_l + F.make_dt_interval(F.lit(0), F.lit(0), F.col("i"))).alias("t"))
    ws = Window.partitionBy("source").orderBy("t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    e2 = (sgrid.join(in_grid.select("source", "t", "m"), ["source", "t"], "left").join(prior_src, "source", "left")
          .withColumn("last", F.greatest(F.max("m").over(ws), F.col("prior")))
          .groupBy("t").agg(F.max(seconds_between(F.col("t"), F.col("last")) / 60.0).alias("age"))
          .select(F.lit(RULES[1][0]).alias("rule"), "t", F.coalesce("age", F.lit(NO_DATA)).alias("value")))

    # Rolling 15-minute count of non-valid rows (grid starts early so the
    # first evaluations see their whole window)
    m3 = per.filter(F.col("t").isNotNull()).groupBy("t").agg(F.sum("bad").alias("c"))
    wr = Window.orderBy("t").rowsBetween(-(window_minutes - 1), Window.currentRow)
    e3 = (egrid.join(m3, "t", "left").withColumn("v", F.sum(F.coalesce("c", F.lit(0))).over(wr).cast("double"))
          .filter(F.col("t") >= start_l).select(F.lit(RULES[2][0]).alias("rule"), "t", F.col("v").alias("value")))

    # Rolling max - min of the dropped counter
    rec = F.col("recorded_at")
    like_m = metrics.schema["recorded_at"].dataType
    m4 = (metrics.filter((rec >= ts_lit(early, like_m)) & (rec < ts_lit(end, like_m)))
          .groupBy((time_bucket("recorded_at", "1 minute") + one_min).cast(like).alias("t"))
          .agg(F.max("dropped_readings_total").alias("hi"), F.min("dropped_readings_total").alias("lo")))
    e4 = (egrid.join(m4, "t", "left")
          .withColumn("v", F.coalesce(F.max("hi").over(wr) - F.min("lo").over(wr), F.lit(0)).cast("double"))
          .filter(F.col("t") >= start_l).select(F.lit(RULES[3][0]).alias("rule"), "t", F.col("v").alias("value")))

    rules = spark.createDataFrame(RULES, "rule string, threshold double, hold int, on_no_data string, severity string")
    values = e1.unionByName(e2).unionByName(e3).unionByName(e4).join(F.broadcast(rules), "rule")
    return _states(values)
