"""E5 as a running evaluation: the alert rules are evaluated at every tick of
a clock, so a rule about missing data fires when nothing arrives.

A tick reads only the rows ingested since the tick before; what it needs of
the past is a small state: the last ingestion of every source, counts of the
last quarter of an hour by minute, and since when each rule is breached.  A
tick writes its state as its own folder, from that of the tick before, so it
can run again.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timefn import seconds_between, time_bucket, ts_lit
from ..operators.alerts import NO_DATA, RULES
from ..sources.batches import last_before, read_batches, write_batch

#: kind source: name, at = last ingestion; minute: at = when it is visible, bad, hi, lo; rule: name, at = time of the tick, value, state, since
STATE = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("name", T.StringType()), T.StructField("at", T.TimestampType()), T.StructField("bad", T.LongType()),
    T.StructField("hi", T.LongType()), T.StructField("lo", T.LongType()), T.StructField("value", T.DoubleType()), T.StructField("state", T.StringType()),
    T.StructField("since", T.TimestampType())])


def _shaped(df: DataFrame) -> DataFrame:
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in STATE.fields])


def alert_tick(spark: SparkSession, path: str, readings: Callable[[], DataFrame], metrics: Callable[[], DataFrame], window_minutes: int = 15):
    """step(number, now): evaluates the rules at ``now`` (a whole minute) over
    the rows ingested before it.  ``readings`` and ``metrics`` give the tables
    as they are at that time.  Values and states are those of
    ``alerts.alert_states`` for a span that starts at the first tick."""
    minute = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(1))

    def step(number: int, now) -> None:
        now = now if isinstance(now, _dt.datetime) else _dt.datetime.fromisoformat(str(now))
        before = last_before(spark, path, number)
        state = read_batches(spark, path, STATE, only=-1 if before is None else before).drop("batch_id")
        done = None if before is None else state.filter("kind = 'rule'").agg(F.max(F.date_format("at", "yyyy-MM-dd HH:mm:ss"))).first()[0]
        early = now - _dt.timedelta(minutes=window_minutes)
        clock = ts_lit(now, T.TimestampType())

        def new(df: DataFrame, column: str, first: _dt.datetime | None) -> DataFrame:
            like, at = df.schema[column].dataType, F.col(column)
            out = df.filter(at < ts_lit(now, like))
            since = first if done is None else _dt.datetime.fromisoformat(done)
            return out if since is None else out.filter(at >= ts_lit(since, like))

        rows, counter = readings(), metrics()
        visible = (time_bucket("ingested_at", "1 minute") + minute).cast("timestamp")
        per = new(rows, "ingested_at", None).groupBy(F.col("source").alias("name"), F.when(visible > ts_lit(early, T.TimestampType()), visible).alias("t")).agg(
            F.max("ingested_at").cast("timestamp").alias("last"), F.count(F.when(F.col("quality_flag") != 1, 1)).alias("bad"))
        seen = per.select(F.lit("source").alias("kind"), "name", F.col("last").alias("at"), F.lit(None).alias("bad"))
        bad = per.filter("t IS NOT NULL").select(F.lit("minute").alias("kind"), F.lit(None).cast("string").alias("name"), F.col("t").alias("at"), "bad")
        fresh = _shaped(seen).unionByName(_shaped(bad)).unionByName(_shaped(
            new(counter, "recorded_at", early).select(F.lit("minute").alias("kind"), (time_bucket("recorded_at", "1 minute") + minute).alias("at"),
                                                      F.col("dropped_readings_total").alias("hi"), F.col("dropped_readings_total").alias("lo"))))
        kept = state.filter("kind <> 'rule'").unionByName(fresh)
        last = kept.filter("kind = 'source'").groupBy("kind", "name").agg(F.max("at").alias("at"))
        minutes = (kept.filter((F.col("kind") == "minute") & (F.col("at") > ts_lit(early, T.TimestampType()))).groupBy("kind", "at")
                   .agg(F.sum("bad").alias("bad"), F.max("hi").alias("hi"), F.min("lo").alias("lo")))
        merged = _shaped(last).unionByName(_shaped(minutes)).persist()
        try:
            age = seconds_between(clock, F.col("at")) / 60.0
            source, of_minute = F.col("kind") == "source", F.col("kind") == "minute"
            values = merged.agg(
                F.coalesce(F.min(F.when(source, age)), F.lit(NO_DATA)).alias(RULES[0][0]), F.coalesce(F.max(F.when(source, age)), F.lit(NO_DATA)).alias(RULES[1][0]),
                F.coalesce(F.sum(F.when(of_minute, F.col("bad"))), F.lit(0)).cast("double").alias(RULES[2][0]),
                F.coalesce(F.max("hi") - F.min("lo"), F.lit(0)).cast("double").alias(RULES[3][0]))
            rules = spark.createDataFrame(RULES, "name string, threshold double, hold int, on_no_data string, severity string")
            value = F.create_map(*[x for r in RULES for x in (F.lit(r[0]), F.col(r[0]))])
            open_since = state.filter("kind = 'rule'").select("name", F.col("since").alias("_since"))
            judged = (values.select(F.explode(value).alias("name", "value")).join(F.broadcast(rules), "name").join(F.broadcast(open_since), "name", "left")
                      .withColumn("since", F.when(F.col("value") > F.col("threshold"), F.coalesce("_since", clock))))
            held = seconds_between(clock, F.col("since")) / 60.0
            judged = judged.select(F.lit("rule").alias("kind"), "name", clock.alias("at"), "value", "since",
                                   F.when(F.col("since").isNull(), "normal").when(held >= F.col("hold"), "firing").otherwise("pending").alias("state"))
            write_batch(merged.unionByName(_shaped(judged)).coalesce(1), path, number)
        finally:
            merged.unpersist()
    return step


def run_alerts(spark: SparkSession, step: Callable[[int, _dt.datetime], None], checkpoint: str, every: str = "1 minute", now: Callable[[], _dt.datetime] | None = None):
    """Evaluate at every trigger, driven by a clock and not by arrivals:
    returns the running query.  The state's folders are numbered by tick."""
    now = now or (lambda: _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None, second=0, microsecond=0))
    return (spark.readStream.format("rate").option("rowsPerSecond", 1).load().writeStream.foreachBatch(lambda _, number: step(number, now()))
            .option("checkpointLocation", checkpoint).trigger(processingTime=every).start())


def alert_history(spark: SparkSession, path: str) -> DataFrame:
    """rule, eval_time, value, state, severity, no_data of every tick."""
    rules = spark.createDataFrame(RULES, "rule string, threshold double, hold int, on_no_data string, severity string").select("rule", "severity")
    ticks = read_batches(spark, path, STATE).filter("kind = 'rule'")
    return ticks.withColumnRenamed("name", "rule").join(F.broadcast(rules), "rule").select(
        "rule", F.col("at").alias("eval_time"), "value", "state", "severity", F.col("value").isNull().alias("no_data"))
