"""Message queries (S7, N5, T3, T4) over messages built from the readings view."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timefn import ts_lit
from ..session import shared_dir
from ..operators import messages as M
from ..sources import fixtures as FX
from ..sources.fixtures import with_views
from .catalog import AS_OF, ASOF, R, register
from .q_quality import DEDUP_SQL, REASON_SQL


_CHECKPOINTED: dict = {}
# by event_id % 101: what a body has in place of what; 5 and 6 are accepted
ODD_BODIES = {
    1: ('"sensor_id":"[^"]*"', '"sensor_id":5'), 2: ('"sensor_id":"[^"]*"', '"sensor_id":{"id":"x"}'),
    3: ('"ingested_at":"[^"]*"', '"ingested_at":"abc"'), 4: ('"ingested_at":"[^"]*"', '"ingested_at":123'),
    5: (',"ingested_at":"[^"]*"', ''), 6: ('"sensor_id"', '"SENSOR_ID"'), 7: ('"value":[^,}]+', '"value":"NaN"'),
    8: ('"time":"[^"]*"', '"time":"yesterday"'), 9: ("^.*$", "[1, 2]"),
}
MISMATCH_SQL = "(event_id % 60 = 0 OR event_id % 101 IN (1, 2, 3, 4, 7, 8, 9))"


def messages(spark, sf):
    """FIXTURES 3.5: JSON bodies of the readings; '{' on every 50th, blank
    sensor_id on every 40th, value as a string on every 60th, no
    quality_flag on every 30th, and by event_id % 101 the bodies of
    ``ODD_BODIES``; publish_time = ingested_at.  One ``to_json`` per row,
    variations patched into the text."""
    r = FX.readings_with_arrival(spark, sf)
    e = F.col("event_id")
    sent = F.when(e % 40 == 0, F.lit("  ")).otherwise(F.col("sensor_id"))
    body = F.to_json(M.reading_struct().withField("sensor_id", sent))
    body = F.when(e % 60 == 0, F.regexp_replace(body, '"value":([^,}]+)', '"value":"$1"')).otherwise(body)
    body = F.when(e % 30 == 0, F.regexp_replace(body, ',"quality_flag":[^,}]+', "")).otherwise(body)
    pattern, by = F.lit("$^"), F.lit("")        # matches nothing
    for k, (p, b) in ODD_BODIES.items():
        pattern, by = F.when(e % 101 == k, F.lit(p)).otherwise(pattern), F.when(e % 101 == k, F.lit(b)).otherwise(by)
    body = F.regexp_replace(body, pattern, by)
    body = F.when(e % 50 == 0, F.lit("{")).otherwise(body)
    landed = r.select("event_id", body.alias("body"), M.attributes().alias("attributes"),
                      F.col("ingested_at").alias("publish_time"))
    # The messages stand for landed data: checkpoint them (to the shared
    # checkpoint dir) so the decoder sees a plain column, as it would in
    # deployment, instead of re-inlining the generator expressions.
    key = (spark.sparkContext.applicationId, sf, spark.conf.get("spark.checkpoint.dir", ""))
    if key not in _CHECKPOINTED:
        shared_dir(spark, "fixtures")
        _CHECKPOINTED[key] = landed.checkpoint(eager=True)
    return _CHECKPOINTED[key]


def checked(spark, sf):
    return M.decode_validate(messages(spark, sf))


_ACC = f"""SELECT * REPLACE (CASE WHEN event_id % 40 = 0 THEN '  ' ELSE sensor_id END AS sensor_id,
    CASE WHEN event_id % 30 = 0 THEN CAST(0 AS SMALLINT) ELSE quality_flag END AS quality_flag,
    CASE WHEN event_id % 101 = 5 THEN TIMESTAMP '0001-01-01' ELSE ingested_at END AS ingested_at)
  FROM readings_arrival WHERE event_id % 50 <> 0 AND NOT {MISMATCH_SQL}"""


def accepted_sql() -> str:
    """The accepted readings, from the view readings_arrival."""
    return f"""SELECT time, sensor_id, metric, CAST(value AS DOUBLE) AS value, unit, source,
  CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude, quality_flag, ingested_at, schema_version
  FROM ({_ACC}) WHERE {REASON_SQL} = ''"""


register("decode_validate", with_views(accepted_sql(), "readings_arrival"))(
    lambda spark, sf: M.accepted(checked(spark, sf)).withColumn("time", F.col("time").cast("timestamp_ntz"))
    .withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz")))

register("dead_letter", with_views(f"""
SELECT dedup_key, CASE WHEN event_id % 50 = 0 THEN 'decode sensor reading: malformed JSON'
                       WHEN {MISMATCH_SQL} THEN 'decode sensor reading: field type mismatch'
                       ELSE 'validate pubsub reading ' || {DEDUP_SQL.replace('sensor_id ||', 'sent_id ||')} || ': ' || reason END AS reason
FROM (SELECT *, {DEDUP_SQL} AS dedup_key, {REASON_SQL.replace('trim(sensor_id)', 'trim(sent_id)')} AS reason
      FROM (SELECT *, CASE WHEN event_id % 40 = 0 THEN '  ' ELSE sensor_id END AS sent_id FROM readings_arrival))
WHERE event_id % 50 = 0 OR {MISMATCH_SQL} OR reason <> ''""", "readings_arrival"))(
    lambda spark, sf: M.dead_letter(checked(spark, sf)).select("dedup_key", "reason"))

register("message_encode", with_views(f"""SELECT CAST(schema_version AS VARCHAR) AS attr_schema_version,
  source AS attr_source, metric AS attr_metric, sensor_id AS attr_sensor_id, {DEDUP_SQL} AS attr_dedup_key,
  CAST(value AS DOUBLE) AS decoded_value, unit AS decoded_unit, sensor_id AS decoded_sensor_id
  FROM sensor_readings""", "sensor_readings"))(
    lambda spark, sf: M.decode(M.encode(R(spark, sf))).select(
        *[F.col("attributes")[a].alias("attr_" + a) for a in M.ATTRIBUTES],
        F.col("value").alias("decoded_value"), F.col("unit").alias("decoded_unit"),
        F.col("sensor_id").alias("decoded_sensor_id")))


def _lag(spark, sf):
    c = checked(spark, sf).filter(F.col("reason").isNull())
    now = ts_lit(AS_OF, c.schema["publish_time"].dataType)
    return (c.groupBy(F.to_date("publish_time").alias("day"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("messages"),
                 F.avg(M.delivery_lag_ms("publish_time", now)).alias("avg_lag_ms"),
                 F.max(M.delivery_lag_ms("publish_time", now)).alias("max_lag_ms")))


_LAGX = f"CAST(greatest(0, (epoch_us({ASOF}) - epoch_us(published)) // 1000) AS BIGINT)"
register("delivery_lag", with_views(f"""SELECT CAST(published AS DATE) AS day, COUNT(*) AS messages,
  AVG({_LAGX}) AS avg_lag_ms, MAX({_LAGX}) AS max_lag_ms
  FROM ({_ACC.replace("FROM readings_arrival", "FROM (SELECT *, ingested_at AS published FROM readings_arrival)")}) WHERE {REASON_SQL} = '' GROUP BY 1""", "readings_arrival"))(_lag)
