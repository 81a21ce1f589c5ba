"""Streaming jobs over landed JSON-lines directories.

Sources are file directories (``readStream.schema(S).json(dir)``); in a
deployment the same jobs read ``format("kafka")`` and only the source line
changes.  Sinks are ``foreachBatch`` functions, so every micro-batch is an
ordinary batch DataFrame: decode + validate, accepted readings, dead letters
and one metric row, each written as the batch id's own folder (replaying a
batch overwrites it), of which readers take the newest of a key.  The checkpoint
location replaces message acknowledgement: a batch is "acked" when its
offsets commit after the sink succeeded, so a lost executor or a restart
replays it.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import messages as M
from ..operators import normalize as N
from ..operators import safety as SF
from ..operators.messages import fill_pct
from ..session import shared_dir
from ..sources.batches import DAY, batch_ids, drop_part, last_before, newest, read_batches, write_batch

MESSAGE_FILE_SCHEMA = T.StructType([
    T.StructField("body", T.StringType()),
    T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
    T.StructField("publish_time", T.TimestampType()),
])
READING_KEY = ["time", "sensor_id", "metric"]


def message_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(MESSAGE_FILE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(landing_dir)


HOT_SCHEMA = T.StructType([
    T.StructField("time", T.TimestampType()), T.StructField("sensor_id", T.StringType()), T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("unit", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType()), T.StructField("quality_flag", T.ShortType()),
    T.StructField("ingested_at", T.TimestampType()), T.StructField("schema_version", T.IntegerType()),
])
#: one row per micro-batch: the columns of ``ingestion_metrics``, then the batch's counts
METRICS_SCHEMA = T.StructType([
    T.StructField("recorded_at", T.TimestampType()), T.StructField("readings_per_second", T.DoubleType()),
    T.StructField("channel_fill_pct", T.ShortType()), T.StructField("pubsub_lag_ms", T.IntegerType()),
    T.StructField("gcs_write_latency_ms", T.IntegerType()), T.StructField("dropped_readings_total", T.LongType()),
    T.StructField("accepted", T.LongType()), T.StructField("rejected", T.LongType()), T.StructField("batch_id", T.LongType()),
])
DEAD_LETTER_SCHEMA = T.StructType([
    T.StructField("dedup_key", T.StringType()), T.StructField("reason", T.StringType()), T.StructField("body", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])


ARRIVAL = T.StructType([T.StructField("published", T.TimestampType()), T.StructField("ingested", T.TimestampType()), T.StructField("body", T.LongType())])


def hot_table(spark: SparkSession, path: str) -> DataFrame:
    """The readings in force: of every key the row that arrived last, in
    whatever batch it came."""
    stored = T.StructType([*HOT_SCHEMA.fields, T.StructField("arrival", ARRIVAL)])
    rows = read_batches(spark, path, stored, by_day=True)
    return newest(rows, [DAY, *READING_KEY], "arrival").select(*HOT_SCHEMA.fieldNames(), DAY)


def dead_letters(spark: SparkSession, path: str) -> DataFrame:
    return read_batches(spark, path, DEAD_LETTER_SCHEMA)


def batch_metrics(spark: SparkSession, path: str) -> DataFrame:
    return read_batches(spark, path, METRICS_SCHEMA)


def arrival_order() -> Column:
    """Arrival of a message: publish time, then the producer's time, then
    the body (files and partitions are in no order)."""
    return F.struct(F.col("publish_time").alias("published"), F.col("ingested_at").alias("ingested"), F.xxhash64("body").alias("body"))


def ingest_batch(spark: SparkSession, table_path: str, dead_letter_path: str, metrics_path: str, now=None, capacity: int = 10_000):
    """The foreachBatch sink of ``stream_ingest``.

    Running a batch id again changes nothing: accepted readings, dead letters
    and the metric row overwrite their batch_id folder.  Of two messages of
    one key the one that arrived later counts, in whatever batches they come
    (the arrival is stored, and compared on read)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        store_checked(M.decode_validate(batch), batch_id, table_path, dead_letter_path, metrics_path, now, capacity)
    return run


def store_checked(checked: DataFrame, batch_id: int, table_path: str, dead_letter_path: str, metrics_path: str, now=None,
                  capacity: int = 10_000) -> None:
    """Write decoded messages as batch ``batch_id``; the metric row, which
    says that the batch is done, last."""
    spark, started = checked.sparkSession, time.monotonic()
    before = last_before(spark, metrics_path, batch_id)
    total = 0 if before is None else read_batches(spark, metrics_path, METRICS_SCHEMA, only=before).first()["dropped_readings_total"]
    clock = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    checked = checked.persist()
    try:
        good = checked.filter(F.col("reason").isNull()).select(*HOT_SCHEMA.fieldNames(), arrival_order().alias("arrival"), F.to_date("time").alias(DAY))
        write_batch(newest(good, [DAY, *READING_KEY], "arrival"), table_path, batch_id, by_day=True)
        write_batch(M.dead_letter(checked).drop("batch_id"), dead_letter_path, batch_id)
        accepted, rejected = F.count(F.when(F.col("reason").isNull(), 1)), F.count(F.col("reason"))
        lag = F.avg(M.delivery_lag_ms("publish_time", clock))
        seconds = max(time.monotonic() - started, 1e-3)
        write_batch(checked.agg(accepted.alias("accepted"), rejected.alias("rejected"), lag.alias("lag"))
                    .select(clock.alias("recorded_at"), (F.col("accepted") / F.lit(seconds)).alias("readings_per_second"),
                            F.least(F.lit(100), fill_pct(F.col("accepted") + F.col("rejected"), F.lit(capacity))).cast("smallint").alias("channel_fill_pct"),
                            F.least(F.col("lag"), F.lit(2147483647.0)).cast("int").alias("pubsub_lag_ms"), F.lit(None).cast("int").alias("gcs_write_latency_ms"),
                            (F.col("rejected") + F.lit(total)).cast("long").alias("dropped_readings_total"),
                            F.col("accepted").cast("long").alias("accepted"), F.col("rejected").cast("long").alias("rejected")), metrics_path, batch_id)
    finally:
        checked.unpersist()


def stream_ingest(spark: SparkSession, landing_dir: str, table_path: str, dead_letter_path: str,
                  metrics_path: str, checkpoint: str | None = None, available_now: bool = True,
                  processing_time: str = "1 second", max_files_per_trigger: int | None = None, now=None,
                  capacity: int = 10_000):
    """Start the continuous ingest query (returns the StreamingQuery)."""
    checkpoint = checkpoint or shared_dir(spark, f"stream-ingest-{uuid.uuid4().hex[:8]}")
    w = (message_stream(spark, landing_dir, max_files_per_trigger).writeStream
         .foreachBatch(ingest_batch(spark, table_path, dead_letter_path, metrics_path, now, capacity))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


# --- S6 bounded consumption ----------------------------------------------------

def _take(checked: DataFrame, n: int, scratch: str, run: int) -> tuple[DataFrame, DataFrame]:
    """(messages up to the n-th accepted one in arrival order, the others).
    Messages are numbered as they land, so equal ones count one by one.  The
    arrivals of accepted messages are range-partitioned; the sizes of the
    ranges (one number a partition) say in which the n-th lies, and only that
    range is sorted."""
    spark = checked.sparkSession
    at = checked.withColumn("_at", F.struct(arrival_order(), "landed", "message"))
    ranges = at.filter(F.col("reason").isNull()).select("_at").repartitionByRange("_at").withColumn("range", F.spark_partition_id())
    write_batch(ranges, scratch, run)
    ranges = read_batches(spark, scratch, ranges.schema, only=run)
    before = 0
    for size in ranges.groupBy("range").count().orderBy("range").collect():
        if before + size["count"] >= n:
            break
        before += size["count"]
    else:
        return at.drop("_at"), at.filter(F.lit(False)).drop("_at")
    last = ranges.filter(F.col("range") == size["range"]).orderBy("_at").limit(n - before).agg(F.max("_at").alias("cut")).scalar()
    return at.filter(F.col("_at") <= last).drop("_at"), at.filter(F.col("_at") > last).drop("_at")


def bounded_consume(spark: SparkSession, landing_dir: str, table_path: str, dead_letter_path: str, metrics_path: str, limit: int,
                    checkpoint: str, max_files_per_trigger: int | None = None, now=None) -> int:
    """Consume what is available until ``limit`` messages were accepted in
    this run; returns how many were.  What lies past the limit comes first in
    the next run with the same checkpoint.

    A stream takes new messages over into ``pending`` (a batch's folder, so a
    replay doubles nothing).  The run itself is a batch: its input is the
    remainder of the run before and the pending batches since; it writes its
    own folders and the remainder, and its metric row last.  A run that dies
    is done again from the same input, and messages that came meanwhile."""
    if limit <= 0:
        raise ValueError(f"limit must be positive, not {limit}")
    pending, carry, progress, arrivals = (f"{checkpoint}/{x}" for x in ("pending", "carry", "progress", "arrivals"))
    message = T.StructType([*MESSAGE_FILE_SCHEMA.fields, T.StructField("landed", T.LongType()), T.StructField("message", T.LongType())])

    def land(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch.withColumn("landed", F.lit(batch_id).cast("long")).withColumn("message", F.monotonically_increasing_id()), pending, batch_id)

    (message_stream(spark, landing_dir, max_files_per_trigger).writeStream.foreachBatch(land)
     .option("checkpointLocation", f"{checkpoint}/offsets").trigger(availableNow=True).start().awaitTermination())
    run = max(batch_ids(spark, metrics_path), default=-1) + 1
    upto = -1
    if run:
        upto = read_batches(spark, progress, _PROGRESS, only=run - 1).first()["upto"]
    landed = max(batch_ids(spark, pending), default=-1)
    fresh = read_batches(spark, pending, message).filter((F.col("batch_id") > upto) & (F.col("batch_id") <= landed))
    names = message.fieldNames()
    rest = read_batches(spark, carry, message, only=run)
    available = rest.select(*names).unionByName(fresh.select(*names))
    checked = M.decode_validate(available).persist()
    try:
        taken, left = _take(checked, limit, arrivals, run)
        write_batch(left.select(*names), carry, run + 1)
        write_batch(spark.range(1).select(F.lit(landed).cast("long").alias("upto")), progress, run)
        store_checked(taken, run, table_path, dead_letter_path, metrics_path, now)
    finally:
        checked.unpersist()
    return read_batches(spark, metrics_path, METRICS_SCHEMA, only=run).first()["accepted"]


_PROGRESS = T.StructType([T.StructField("upto", T.LongType())])


# --- T3 redelivery --------------------------------------------------------------

#: fixed values: attempts before dead letter, first and longest delay in seconds
MAX_ATTEMPTS, MIN_BACKOFF_S, MAX_BACKOFF_S = 5, 10, 600
WAITING = "waiting"
LEDGER_SCHEMA = T.StructType([*MESSAGE_FILE_SCHEMA.fields, T.StructField("attempts", T.IntegerType()), T.StructField("next_attempt_at", T.TimestampType())])
SETTLED_SCHEMA = T.StructType([*MESSAGE_FILE_SCHEMA.fields, T.StructField("attempts", T.IntegerType()), T.StructField("outcome", T.StringType()),
                               T.StructField("settled_at", T.TimestampType())])


def backoff_seconds(attempts: Column) -> Column:
    """Delay after the given number of failed attempts: doubled each time."""
    doubled = F.least(attempts - 1, F.lit(16)).cast("int")
    return F.least(F.lit(MIN_BACKOFF_S) * F.pow(F.lit(2.0), doubled), F.lit(float(MAX_BACKOFF_S)))


def redelivery(spark: SparkSession, ledger_path: str, settled_path: str, failing):
    """A sink step(messages, step number, clock): new messages and those of
    the ledger whose time has come are attempted; ``failing`` (a function of
    the attempt's number to a boolean column) says which fail for now.  A
    failed message waits in the ledger, after ``MAX_ATTEMPTS`` it is a dead
    letter.  The ledger holds open messages only; a step reads that of the
    step before and writes its own, so it can run again.  A step without new
    messages is how waiting ones come due.  What a step attempts is decided
    once and stored by outcome, not held in memory; the ledger is written from
    the part that failed, which then goes."""
    names = MESSAGE_FILE_SCHEMA.fieldNames()

    def step(messages: DataFrame | None, number: int, now) -> None:
        clock = F.lit(str(now)).cast("timestamp")
        before = last_before(spark, ledger_path, number)
        ledger = read_batches(spark, ledger_path, LEDGER_SCHEMA, only=-1 if before is None else before).drop("batch_id")
        due = ledger.filter(F.col("next_attempt_at") <= clock)
        if messages is not None:
            due = due.unionByName(messages.select(*names, F.lit(0).alias("attempts"), clock.alias("next_attempt_at")))
        tried = due.withColumn("attempts", F.col("attempts") + 1)
        outcome = (F.when(~F.coalesce(failing(F.col("attempts")), F.lit(False)), "accepted")
                   .when(F.col("attempts") >= MAX_ATTEMPTS, "dead_letter").otherwise(WAITING))
        write_batch(tried.select(*names, "attempts", outcome.alias("outcome"), clock.alias("settled_at")), settled_path, number, by="outcome")
        again = F.timestamp_micros(F.unix_micros(clock) + (backoff_seconds(F.col("attempts")) * 1_000_000).cast("bigint"))
        waiting = (read_batches(spark, settled_path, SETTLED_SCHEMA, only=number).filter(F.col("outcome") == WAITING)
                   .select(*names, "attempts", again.alias("next_attempt_at")))
        write_batch(ledger.filter(F.col("next_attempt_at") > clock).unionByName(waiting), ledger_path, number)
        drop_part(spark, settled_path, number, f"outcome={WAITING}")
    return step


def settled_messages(spark: SparkSession, path: str) -> DataFrame:
    return read_batches(spark, path, SETTLED_SCHEMA).filter(F.col("outcome") != WAITING).select(*SETTLED_SCHEMA.fieldNames(), "batch_id")


# --- T8 hourly aggregate, T9 dedup, T7 late data -----------------------------------

HOUR_KEY = ["bucket", "sensor_id", "metric"]


def hour_states(readings: DataFrame) -> DataFrame:
    """Mergeable states of valid readings per hour, sensor and metric."""
    return (readings.filter(F.col("quality_flag") == 1).groupBy(F.date_trunc("hour", "time").alias("bucket"), "sensor_id", "metric")
            .agg(F.sum("value").alias("total"), F.min("value").alias("low"), F.max("value").alias("high"), F.count(F.lit(1)).alias("n"))
            .withColumn(DAY, F.to_date("bucket")))


def hourly_batch(spark: SparkSession, states_path: str, hours_path: str):
    """The foreachBatch sink of the continuous aggregate.  A batch writes
    the states of its own rows, and then the merged states of the hours it
    touched and of no other, from the states of all batches up to its own (of
    the touched days: their number is bounded by the batch's span, they prune
    the folders).  Rows of any age change their hour; there is no watermark."""
    def run(batch: DataFrame, batch_id: int) -> None:
        own = hour_states(batch)
        write_batch(own, states_path, batch_id, by_day=True)
        schema = own.drop(DAY).schema
        stored = read_batches(spark, states_path, schema, by_day=True)
        mine = stored.filter(F.col("batch_id") == batch_id)
        days = [r[0] for r in mine.select(DAY).distinct().collect()]
        earlier = stored.filter((F.col("batch_id") <= batch_id) & F.col(DAY).isin(days))
        touched = mine.select(*HOUR_KEY)
        merged = (earlier.join(touched, HOUR_KEY, "left_semi").groupBy(*HOUR_KEY, DAY)
                  .agg(F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")))
        write_batch(merged, hours_path, batch_id, by_day=True)
    return run


def hourly_table(spark: SparkSession, hours_path: str, value_type: T.DataType, time_type: T.DataType) -> DataFrame:
    """The aggregate in force: the newest merged state of every hour."""
    exact = isinstance(value_type, T.DecimalType)
    total = T.DecimalType(min(38, value_type.precision + 20), value_type.scale) if exact else T.DoubleType()
    schema = T.StructType([T.StructField("bucket", time_type), T.StructField("sensor_id", T.StringType()), T.StructField("metric", T.StringType()),
                           T.StructField("total", total),
                           T.StructField("low", value_type), T.StructField("high", value_type), T.StructField("n", T.LongType())])
    rows = newest(read_batches(spark, hours_path, schema, by_day=True), [DAY, *HOUR_KEY], "batch_id")
    mean = F.col("total") / F.col("n")
    if exact:  # rounded like an average of such decimals
        mean = F.col("total").cast(T.DecimalType(min(38, value_type.precision + 10), value_type.scale)) / F.col("n").cast("decimal(10,0)")
        mean = mean.cast(T.DecimalType(min(38, value_type.precision + 4), value_type.scale + 4))
    return rows.select(*HOUR_KEY, mean.cast("double").alias("avg_value"), F.col("low").cast("double").alias("min_value"),
                       F.col("high").cast("double").alias("max_value"), F.col("n").cast("int").alias("reading_count"))


def dedup_batch_sink(spark: SparkSession, path: str, schema: T.StructType):
    """The foreachBatch sink that keeps the first delivery of every key,
    however late a later one comes: keys of earlier batches are looked up in
    the days that the batch touches."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumn(DAY, F.to_date("time")).persist()
        try:
            days = [r[0] for r in batch.select(DAY).distinct().collect()]
            known = read_batches(spark, path, schema, by_day=True).filter((F.col("batch_id") < batch_id) & F.col(DAY).isin(days))
            fresh = batch.dropDuplicates([DAY, *READING_KEY]).join(known.select(DAY, *READING_KEY), [DAY, *READING_KEY], "left_anti")
            write_batch(fresh, path, batch_id, by_day=True)
        finally:
            batch.unpersist()
    return run


# --- N6 one stream a source, N7 / T5 observed counts ---------------------------------

POLL_SCHEMA = T.StructType([T.StructField("received", T.LongType()), T.StructField("published", T.LongType()), T.StructField("skipped", T.LongType())])
ERROR_SCHEMA = T.StructType([T.StructField("source", T.StringType()), T.StructField("error", T.StringType())])


@dataclass(frozen=True)
class Source:
    """A source that is polled on its own: ``open`` makes its stream,
    ``normalise`` turns a batch of payloads into readings with skip reasons,
    ``received`` counts what a payload holds (time series, stations, ...)."""
    open: Callable[[], DataFrame]
    normalise: Callable[[DataFrame], DataFrame]
    received: Column


def source_batch(source: Source, readings_path: str, polls_path: str):
    """The foreachBatch sink of one source: the readings' batch folder, and
    the poll's counts, observed while that folder is written - the payloads
    are read and normalised once."""
    def run(batch: DataFrame, batch_id: int) -> None:
        taken, made = Observation(f"received-{uuid.uuid4().hex}"), Observation(f"made-{uuid.uuid4().hex}")
        checked = source.normalise(batch.observe(taken, F.sum(source.received).alias("received")))
        checked = checked.observe(made, F.count(F.lit(1)).alias("rows"), F.count("skip_reason").alias("skipped"))
        write_batch(N.published(checked), readings_path, batch_id)
        row = (taken.get["received"] or 0, made.get["rows"] - made.get["skipped"], made.get["skipped"])
        write_batch(batch.sparkSession.createDataFrame([row], POLL_SCHEMA), polls_path, batch_id)
    return run


def poll_sources(spark: SparkSession, sources: dict[str, Source], base: str) -> DataFrame:
    """Every source as a running query of its own, with its own
    checkpoint, to the end of what is available.  A source that fails keeps
    what its earlier batches wrote, stops no other, and goes on from its
    checkpoint at the next call.  Returns the failures (source, error): at
    most one row a source."""
    running, errors = {}, []
    for name, source in sources.items():
        try:
            running[name] = (source.open().writeStream.foreachBatch(source_batch(source, f"{base}/readings/source={name}", f"{base}/polls/source={name}"))
                             .option("checkpointLocation", f"{base}/offsets/{name}").trigger(availableNow=True).start())
        except AnalysisException as e:      # a source that cannot even be opened
            errors.append((name, str(e)))
    for name, query in running.items():
        try:
            query.awaitTermination()
        except StreamingQueryException as e:
            errors.append((name, str(e)))
    return spark.createDataFrame(errors, ERROR_SCHEMA)


def polled_readings(spark: SparkSession, base: str, sources: Iterable[str], schema: T.StructType) -> DataFrame:
    """The readings of all sources."""
    parts = [read_batches(spark, f"{base}/readings/source={name}", schema).drop("batch_id") for name in sources]
    return reduce(DataFrame.unionByName, parts)


def poll_counts(spark: SparkSession, base: str, sources: Iterable[str]) -> DataFrame:
    """source, batch_id, received, published, skipped of every poll."""
    parts = [read_batches(spark, f"{base}/polls/source={name}", POLL_SCHEMA).select(F.lit(name).alias("source"), "batch_id", *POLL_SCHEMA.fieldNames()) for name in sources]
    return reduce(DataFrame.unionByName, parts)


def drive(df: DataFrame, sink, checkpoint: str | None = None) -> None:
    """Run a streaming frame to the end of what is available into ``sink``."""
    checkpoint = checkpoint or shared_dir(df.sparkSession, f"stream-{uuid.uuid4().hex[:8]}")
    df.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


# --- latest-state tables (W2, A1, E1, E2) ----------------------------------------

STATE_KEY = ["sensor_id", "metric"]
SOURCE_STATE = T.StructType([f for f in HOT_SCHEMA.fields if f.name in ("source", "time", "ingested_at")])


def state_batch(spark: SparkSession, latest_path: str, sources_path: str):
    """The foreachBatch sink that keeps the latest row of every (sensor,
    metric) and the latest times of every source.  A batch's snapshot merges
    that of the batch before with its own rows by greatest (time, ingestion,
    source): merging is monotone, so neither cuts of the input into batches
    nor replays change it.  A snapshot has a row a sensor and metric."""
    def run(batch: DataFrame, batch_id: int) -> None:
        def earlier(path: str, schema: T.StructType) -> DataFrame:
            before = last_before(spark, path, batch_id)
            return read_batches(spark, path, schema, only=-1 if before is None else before).drop("batch_id")

        own = batch.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in HOT_SCHEMA.fields])
        rows = own.unionByName(earlier(latest_path, HOT_SCHEMA)).withColumn("at", F.struct("time", "ingested_at", "source"))
        write_batch(newest(rows, STATE_KEY, "at").drop("at"), latest_path, batch_id)
        seen = own.select(*SOURCE_STATE.fieldNames()).unionByName(earlier(sources_path, SOURCE_STATE))
        write_batch(seen.groupBy("source").agg(F.max("time").alias("time"), F.max("ingested_at").alias("ingested_at")), sources_path, batch_id)
    return run


def _snapshot(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return read_batches(spark, path, schema, only=max(batch_ids(spark, path), default=-1)).drop("batch_id")


def latest_state(spark: SparkSession, path: str) -> DataFrame:
    """The latest row of every (sensor, metric)."""
    return _snapshot(spark, path, HOT_SCHEMA)


def source_state(spark: SparkSession, path: str) -> DataFrame:
    """source, time, ingested_at: the latest of every source, which stands for
    the readings in the alerts of missing data and in the overview."""
    return _snapshot(spark, path, SOURCE_STATE)


def notification_stream(spark: SparkSession, landing_dir: str, as_of=None) -> DataFrame:
    """Object-created notifications -> events with an error column
    (malformed messages are quarantined row by row instead of failing the
    whole pull)."""
    raw = spark.readStream.schema("body string").json(landing_dir)
    clock = F.current_timestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp")
    return SF.parse_notifications(raw, clock)


def run_to_table(df: DataFrame, path: str, checkpoint: str | None = None) -> str:
    """Drive an append stream to the end of what is available into a table of
    batch folders, returning the path; a batch that runs again overwrites its
    own folder."""
    drive(df, lambda batch, batch_id: write_batch(batch, path, batch_id), checkpoint)
    return path


def throughput_metrics(metrics: DataFrame) -> DataFrame:
    """T5: per micro-batch counts, fill percentage and dropped total, from
    the table the sink maintains (complete for a stream of any length)."""
    return metrics.select("batch_id", (F.col("accepted") + F.col("rejected")).alias("input_rows"), "accepted", "rejected",
                          "channel_fill_pct", "dropped_readings_total", "readings_per_second")
