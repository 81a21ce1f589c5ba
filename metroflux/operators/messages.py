"""Reading messages (S7, N5, T3, T4): encode, strict decode, validate,
dead-letter, delivery lag.

A message is (body JSON text, attributes map, publish_time).  The body is
parsed once to a map of variants, and every field's JSON type is checked:
text fields must be strings, numbers numbers (not quoted, in range),
integers integers, times RFC 3339 strings; anything else rejects the body.
Field names match in any case, the last of several wins, unknown fields are
ignored.  Missing and null fields take the zero values the producer's
decoder gives them (0 / "" / zero time), so a missing quality flag becomes 0
(Suspect), a missing schema version fails validation, and a missing
``ingested_at`` is the zero time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.keys import dedup_key
from ..functions.timefn import rfc3339_nano
from .normalize import RFC3339
from .validate import fence, validation_errors

TEXT_FIELDS = ["sensor_id", "metric", "unit", "source"]
NUMBER_FIELDS = ["value", "latitude", "longitude"]
INTEGER_FIELDS = {"quality_flag": "smallint", "schema_version": "int"}
TIME_FIELDS = ["time", "ingested_at"]
ZERO_TIME = "0001-01-01 00:00:00"
ATTRIBUTES = ["schema_version", "source", "metric", "sensor_id", "dedup_key"]


def reading_struct(value: Column | None = None, drop: tuple = ()) -> Column:
    """The JSON object of a reading (times as RFC3339Nano text)."""
    fields = {"time": rfc3339_nano("time"), "sensor_id": F.col("sensor_id"), "metric": F.col("metric"),
              "value": F.col("value") if value is None else value, "unit": F.col("unit"),
              "source": F.col("source"), "latitude": F.col("latitude"), "longitude": F.col("longitude"),
              "quality_flag": F.col("quality_flag"), "ingested_at": rfc3339_nano("ingested_at"),
              "schema_version": F.col("schema_version")}
    return F.struct(*[c.alias(n) for n, c in fields.items() if n not in drop])


def attributes() -> Column:
    return F.create_map(F.lit("schema_version"), F.col("schema_version").cast("string"),
                        F.lit("source"), F.col("source"), F.lit("metric"), F.col("metric"),
                        F.lit("sensor_id"), F.col("sensor_id"), F.lit("dedup_key"), dedup_key())


def encode(readings: DataFrame) -> DataFrame:
    """Reading rows -> (body, attributes, publish_time=null)."""
    return readings.select(F.to_json(reading_struct()).alias("body"), attributes().alias("attributes"))


def _field(name: str) -> Column:
    """The variant of a field: by its name, or - where a body has names in
    other cases or several times - the last entry that matches."""
    matching = F.filter(F.map_entries("_m"), lambda e: F.lower(e["key"]) == name)
    return F.when(F.col("_odd"), F.try_element_at(matching, F.lit(-1))["value"]).otherwise(F.try_element_at(F.col("_m"), F.lit(name)))


def decode(messages: DataFrame, body_col: str = "body") -> DataFrame:
    """N5 step 1: body text -> reading columns + ``decode_error``."""
    body = F.col(body_col)
    options = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
    parsed = messages.select("*", F.from_json(body, "map<string,variant>", options).alias("_m"), F.try_parse_json(body).alias("_j"))
    keys = F.map_keys("_m")
    odd = F.exists(keys, lambda k: k != F.lower(k)) | (F.size(F.array_distinct(keys)) < F.size(keys))
    names = [*TEXT_FIELDS, *NUMBER_FIELDS, *INTEGER_FIELDS, *TIME_FIELDS]
    fields = parsed.select("*", F.coalesce(odd, F.lit(False)).alias("_odd")).select("*", *[_field(n).alias(f"_v_{n}") for n in names])
    fields = fields.select("*", *[F.schema_of_variant(f"_v_{n}").alias(f"_t_{n}") for n in names],
                           *[F.try_variant_get(f"_v_{n}", "$", "string").alias(f"_s_{n}") for n in [*TEXT_FIELDS, *TIME_FIELDS]],
                           *[F.try_variant_get(f"_v_{n}", "$", "double").alias(f"_n_{n}") for n in NUMBER_FIELDS],
                           *[F.try_variant_get(f"_v_{n}", "$", t).alias(f"_n_{n}") for n, t in INTEGER_FIELDS.items()])
    whole = F.coalesce(F.btrim(body), F.lit(""))
    malformed = (F.col("_m").isNull() & F.col("_j").isNull()) | (F.col("_m").isNotNull() & ~F.endswith(F.rtrim(body), F.lit("}")))
    # past a closing brace only white space, a comma or another closing bracket may
    # follow; only bodies with a brace before their last one are looked at
    inner = F.instr(body, "}") < F.length(F.rtrim(body))
    bare = F.regexp_replace(body, r'"(?:[^"\\]|\\.)*"', "0")
    malformed = malformed | F.coalesce(inner & F.when(inner, bare.rlike(r"\}\s*[^\s,}\]]")), F.lit(False))
    other = F.col("_m").isNull() & (whole != "null")      # a JSON null sets no field
    # fenced: what follows uses the parsed fields as columns, never their expressions
    fields = fence(fields.select("*", malformed.alias("_malformed"), other.alias("_other"),
                                 *[F.try_to_timestamp(f"_s_{n}", F.lit(RFC3339)).alias(f"_d_{n}") for n in TIME_FIELDS])
                   .drop("_m", "_j", "_odd", *[f"_v_{n}" for n in names]))

    def wrong(name: str, ok: Column) -> Column:
        """The field is there and not null, and not ``ok``."""
        return F.coalesce((F.col(f"_t_{name}") != "VOID") & ~ok, F.lit(False))

    bad = F.lit(False)
    for n in TEXT_FIELDS:
        bad = bad | wrong(n, F.col(f"_t_{n}") == "STRING")
    for n in NUMBER_FIELDS:
        bad = bad | wrong(n, F.col(f"_t_{n}").rlike("^(BIGINT|DOUBLE|DECIMAL)") & F.coalesce(F.abs(f"_n_{n}") < float("inf"), F.lit(False)))
    for n in INTEGER_FIELDS:
        bad = bad | wrong(n, (F.col(f"_t_{n}") == "BIGINT") & F.col(f"_n_{n}").isNotNull())
    for n in TIME_FIELDS:
        bad = bad | wrong(n, (F.col(f"_t_{n}") == "STRING") & F.col(f"_d_{n}").isNotNull())
    error = (F.when(F.col("_malformed"), F.lit("decode sensor reading: malformed JSON"))
             .when(F.col("_other") | bad, F.lit("decode sensor reading: field type mismatch")))
    return fence(fields.select(
        *messages.columns, F.col("_d_time").alias("time"), *[F.coalesce(f"_s_{n}", F.lit("")).alias(n) for n in ("sensor_id", "metric")],
        F.coalesce("_n_value", F.lit(0.0)).alias("value"), *[F.coalesce(f"_s_{n}", F.lit("")).alias(n) for n in ("unit", "source")],
        *[F.coalesce(f"_n_{n}", F.lit(0.0)).alias(n) for n in ("latitude", "longitude")],
        F.coalesce("_n_quality_flag", F.lit(0).cast("smallint")).alias("quality_flag"),
        F.when(error.isNull(), F.coalesce("_d_ingested_at", F.lit(ZERO_TIME).cast("timestamp"))).alias("ingested_at"),
        F.coalesce("_n_schema_version", F.lit(0)).alias("schema_version"), error.alias("decode_error")))


def decode_validate(messages: DataFrame, body_col: str = "body") -> DataFrame:
    """Decode, then validate against the reading's own time; ``reason``
    is null for accepted messages."""
    d = decode(messages, body_col)
    errs = F.array_join(validation_errors(), "; ")
    reason = F.when(F.col("decode_error").isNotNull(), F.col("decode_error")).when(
        errs != "", F.concat(F.lit("validate pubsub reading "), dedup_key(), F.lit(": "), errs))
    return fence(d.withColumn("reason", reason))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("reason").isNull()).select(*S.READING_COLUMNS)


def dead_letter(checked: DataFrame, batch_id: Column | None = None) -> DataFrame:
    """Rejected messages with reason, body and batch id (permanent errors
    are not retried)."""
    key = F.try_element_at(F.col("attributes"), F.lit("dedup_key")) if "attributes" in checked.columns \
        else F.lit(None).cast("string")
    return checked.filter(F.col("reason").isNotNull()).select(
        key.alias("dedup_key"), "reason", "body",
        (batch_id if batch_id is not None else F.lit(None).cast("long")).alias("batch_id"))


def delivery_lag_ms(publish_time: str | Column, now: Column) -> Column:
    """T4: max(0, now - publish_time) in whole ms; null when unknown."""
    pt = F.col(publish_time) if isinstance(publish_time, str) else publish_time
    diff = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(pt.cast("timestamp")))
    lag = F.when(diff >= 0, F.floor(diff / 1000)).otherwise(-F.floor(-diff / 1000))
    return F.when(pt.isNotNull(), F.greatest(F.lit(0), lag).cast("bigint"))


def fill_pct(queued: Column, capacity: Column) -> Column:
    """T5: floor(100 * queued / capacity), 0 when capacity is 0; a long, since
    a batch may hold any number of times the capacity."""
    return F.when(capacity > 0, F.floor(F.lit(100) * queued / capacity)).otherwise(F.lit(0)).cast("bigint")
