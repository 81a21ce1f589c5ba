"""Payload normalisation jobs (N1-N7): landed API payloads -> canonical
reading rows, with a skip reason for every payload element that does not
become a reading.

Every normaliser returns ONE frame: the canonical reading columns plus
``skip_reason`` (null for published rows) and ``source``.  Explodes and
rule checks are narrow projections; the only shuffles are the joins to
station / sensor metadata, which AQE turns into broadcast joins at runtime
when the metadata side is measured small (``autoBroadcastJoinThreshold``),
and falls back to a sort-merge join when it is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.keys import dedup_key
from ..functions.text import go_trim, is_blank, lookup, normalize_unit
from .validate import fence, validation_errors

RFC3339 = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]XXX"
MINUTE_UTC = "yyyy-MM-dd'T'HH:mm"
# --- fixed values: Go ParseFloat decimal / special syntax ---------------------
GO_FLOAT = r"^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity)|(?i:nan))$"
GO_INF = r"^[+-]?(?i:inf|infinity)$"


def go_quote(c: Column) -> Column:
    """Go ``%q`` for printable text: double quotes, escaped quote/backslash."""
    inner = F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"\\", r"\\\\"), '"', '\\\\"')
    return F.concat(F.lit('"'), inner, F.lit('"'))


def parse_rfc3339(c: Column) -> Column:
    return F.try_to_timestamp(go_trim(c), F.lit(RFC3339))


def _reading(time, sensor_id, metric, value, unit, source, lat, lon, ingested_at, skip) -> list[Column]:
    return [time.cast("timestamp").alias("time"), sensor_id.alias("sensor_id"), metric.alias("metric"),
            value.cast("double").alias("value"), unit.alias("unit"), F.lit(source).alias("source"),
            lat.cast("double").alias("latitude"), lon.cast("double").alias("longitude"),
            F.lit(S.QUALITY_VALID).cast("smallint").alias("quality_flag"),
            ingested_at.cast("timestamp").alias("ingested_at"),
            F.lit(S.SCHEMA_VERSION).cast("int").alias("schema_version"), skip.alias("skip_reason")]


def _validated(df: DataFrame) -> DataFrame:
    """Pollers validate against the reading's own time; failures are skips."""
    errs = F.array_join(validation_errors(), "; ")
    reason = F.when(F.col("skip_reason").isNull() & (errs != ""),
                    F.concat(F.lit("invalid reading "), dedup_key(), F.lit(": "), errs)).otherwise(F.col("skip_reason"))
    out = df.withColumn("skip_reason", reason)
    # callers filter on ``skip_reason``; unfenced, that would double the
    # generated code (past the 64 KB method limit for air quality)
    return fence(out)


def published(df: DataFrame) -> DataFrame:
    return df.filter(F.col("skip_reason").isNull()).select(*S.READING_COLUMNS)


def skipped(df: DataFrame) -> DataFrame:
    return df.filter(F.col("skip_reason").isNotNull()).select("source", "skip_reason")


def _ingest_lit(ingested_at) -> Column:
    return ingested_at if isinstance(ingested_at, Column) else F.lit(str(ingested_at)).cast("timestamp")


# ------------------------------------------------------------------ N1 air quality
_AQ_METRIC = {"pm25": ("PM2.5", "ug/m3"), "pm2.5": ("PM2.5", "ug/m3"), "o3": ("O3", "ppm"),
              "ozone": ("O3", "ppm"), "no2": ("NO2", "ppb"), "nitrogendioxide": ("NO2", "ppb")}
_PM_UNITS = ["ug/m3", "ugm-3", "ugm3"]


def normalize_air_quality(latest: DataFrame, sensors: DataFrame, ingested_at) -> DataFrame:
    """Latest measurements joined to sensor metadata of the same poll and
    location (duplicate sensor ids: the last listed wins); a missing number
    is 0."""
    meas = (latest.select("poll_id", "location_id", F.explode("results").alias("r"))
            .select("poll_id", "location_id", F.col("r.sensorsId").alias("sensor_key"), F.coalesce(F.col("r.value"), F.lit(0.0)).alias("value"),
                    F.col("r.coordinates.latitude").alias("m_lat"), F.col("r.coordinates.longitude").alias("m_lon"),
                    F.col("r.datetime.utc").alias("utc")))
    meta = (sensors.select("poll_id", "location_id", "seq", F.posexplode("results").alias("pos", "r"))
            .groupBy(F.col("poll_id").alias("_poll"), F.col("location_id").alias("_loc"), F.col("r.id").alias("_key"))
            .agg(F.max_by("r", F.struct("seq", "pos")).alias("s")))
    j = meas.join(meta, F.col("poll_id").eqNullSafe(F.col("_poll")) & (F.col("location_id") == F.col("_loc"))
                  & (F.col("sensor_key") == F.col("_key")), "left")
    key = F.translate(F.lower(go_trim(F.col("s.parameter.name"))), " _-", "")
    metric = lookup(key, {k: m for k, (m, _) in _AQ_METRIC.items()})
    want = lookup(key, {k: u for k, (_, u) in _AQ_METRIC.items()})
    src_unit = F.when(is_blank(F.col("s.units")), F.col("s.parameter.units")).otherwise(F.col("s.units"))
    cleaned = normalize_unit(src_unit)
    unit = (F.when((metric == "PM2.5") & cleaned.isin(_PM_UNITS), F.lit("ug/m3"))
            .when((metric == "O3") & (cleaned == "ppm"), F.lit("ppm"))
            .when((metric == "NO2") & (cleaned == "ppb"), F.lit("ppb")))
    m_ok = F.col("m_lat").isNotNull() & F.col("m_lon").isNotNull()
    s_ok = F.col("s.coordinates.latitude").isNotNull() & F.col("s.coordinates.longitude").isNotNull()
    lat = F.when(m_ok, F.col("m_lat")).otherwise(F.col("s.coordinates.latitude"))
    lon = F.when(m_ok, F.col("m_lon")).otherwise(F.col("s.coordinates.longitude"))
    t = parse_rfc3339(F.col("utc"))
    sid = F.col("sensor_key").cast("string")
    reason = (F.when(F.col("s").isNull(), F.concat(F.lit("unknown OpenAQ sensor "), sid))
              .when(metric.isNull(), F.concat(F.lit("unsupported OpenAQ parameter "), go_quote(F.col("s.parameter.name"))))
              .when(unit.isNull() | (unit != want),
                    F.concat(F.lit("unsupported OpenAQ unit "), go_quote(src_unit), F.lit(" for "), metric))
              .when(~m_ok & ~s_ok, F.concat(F.lit("missing coordinates for OpenAQ sensor "), sid))
              .when(t.isNull(), F.concat(F.lit("missing timestamp for OpenAQ sensor "), sid)))
    out = j.select(*_reading(t, F.concat(F.lit("OPENAQ-"), sid), metric, F.col("value"), unit, "openaq",
                             lat, lon, _ingest_lit(ingested_at), reason))
    return _validated(out)


# ------------------------------------------------------------------ N2 weather
_WX = [("temperature", "temperature_2m"), ("humidity", "relative_humidity_2m"),
       ("wind_speed", "wind_speed_10m"), ("precipitation", "precipitation")]
_WX_UNITS = {"°C": "C", "%": "%", "km/h": "km/h", "mm": "mm"}


def _wx_unit(c: Column) -> Column:
    return lookup(go_trim(c), _WX_UNITS)


def normalize_weather(current: DataFrame, ingested_at) -> DataFrame:
    """Unpivot the 4 current-weather metrics (a missing number is 0); a bad
    timestamp drops the whole payload with one reason.  ``sensor_id`` names the requested point."""
    raw_t = F.col("current.time")
    txt = go_trim(raw_t)
    # pick the layout by shape (a failed parse is an exception per row)
    t = (F.when(F.length(txt) == 16, F.try_to_timestamp(F.concat(txt, F.lit("Z")), F.lit("yyyy-MM-dd'T'HH:mmX")))
         .when(F.length(txt) > 16, F.try_to_timestamp(txt, F.lit(RFC3339))))
    bad = F.concat(F.lit("invalid Open-Meteo timestamp "), go_quote(raw_t), F.lit(": "),
                   F.when(F.coalesce(txt, F.lit("")) == "", F.lit("time is required"))
                   .otherwise(F.lit("cannot parse as RFC3339 or 2006-01-02T15:04")))
    items = F.array(*[F.struct(F.lit(m).alias("metric"), F.coalesce(F.col(f"current.{f}"), F.lit(0.0)).alias("value"),
                               _wx_unit(F.col(f"current_units.{f}")).alias("unit"),
                               F.lit(None).cast("string").alias("fail")) for m, f in _WX])
    fail = F.array(F.struct(F.lit(None).cast("string").alias("metric"), F.lit(None).cast("double").alias("value"),
                            F.lit(None).cast("string").alias("unit"), bad.alias("fail")))
    sid = F.format_string("OPENMETEO-%.4f-%.4f", F.col("request_latitude"), F.col("request_longitude"))
    x = (current.select("*", t.alias("_t"), sid.alias("_sid"))      # once per payload, before the unpivot
         .select("*", F.explode(F.when(F.col("_t").isNotNull(), items).otherwise(fail)).alias("i")))
    sid = F.col("_sid")
    reason = (F.when(F.col("i.fail").isNotNull(), F.col("i.fail"))
              .when(F.col("i.unit").isNull(), F.concat(F.lit("unsupported Open-Meteo unit for "), F.col("i.metric"))))
    out = x.select(*_reading(F.col("_t"), sid, F.col("i.metric"), F.col("i.value"), F.col("i.unit"), "openmeteo",
                             F.coalesce("latitude", F.lit(0.0)), F.coalesce("longitude", F.lit(0.0)), _ingest_lit(ingested_at), reason))
    return _validated(out)


# ------------------------------------------------------------------ N3 bike share
def station_information(info: DataFrame) -> DataFrame:
    """Station dimension, one row per poll and station_id: the last listing
    of the poll wins; a missing number is 0."""
    return (info.select("poll_id", "seq", F.posexplode("data.stations").alias("pos", "st"))
            .groupBy("poll_id", F.col("st.station_id").alias("station_id"))
            .agg(F.max_by("st", F.struct("seq", "pos")).alias("st"))
            .select("poll_id", "station_id", "st.name", *[F.coalesce(f"st.{c}", F.lit(0)).alias(c) for c in ("lat", "lon", "capacity")]))


def station_names(info: DataFrame) -> DataFrame:
    """(station_id, name): the name in the latest poll that lists it."""
    return station_information(info).groupBy("station_id").agg(F.max_by("name", "poll_id").alias("name"))


def normalize_bike_share(info: DataFrame, status: DataFrame, ingested_at, limit: int = 0) -> DataFrame:
    """Station states left joined to the station information of the same
    poll; 3 readings per station.  ``limit`` keeps the first stations of
    every poll by station_id, before the join; a missing number is 0."""
    st = status.select("poll_id", F.col("last_updated").alias("feed_updated"), F.explode("data.stations").alias("s")).select(
        "poll_id", "feed_updated", "s.station_id", *[F.coalesce(f"s.{c}", F.lit(0)).alias(c)
                                                     for c in ("num_bikes_available", "num_docks_available", "last_reported")])
    if limit and limit > 0:
        # one poll's stations are one feed response; equal ids fall back to the other columns
        first = Window.partitionBy("poll_id").orderBy("station_id", "last_reported", "num_bikes_available", "num_docks_available")
        st = st.withColumn("_k", F.row_number().over(first)).filter(F.col("_k") <= limit).drop("_k")
    j = st.join(station_information(info).withColumnsRenamed({"station_id": "_sid", "poll_id": "_poll"}),
                (F.col("station_id") == F.col("_sid")) & F.col("poll_id").eqNullSafe(F.col("_poll")), "left")
    ing = _ingest_lit(ingested_at)
    t = (F.when(F.col("last_reported") > 0, F.timestamp_seconds("last_reported"))
         .when(F.col("feed_updated") > 0, F.timestamp_seconds("feed_updated")).otherwise(ing))
    items = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(c).cast("double").alias("value")) for m, c in
                      [("bike_available_count", "num_bikes_available"), ("dock_available_count", "num_docks_available"),
                       ("station_capacity", "capacity")]])
    missing = F.col("_sid").isNull()
    x = j.select("*", F.explode(F.when(missing, F.array(F.struct(F.lit(None).cast("string").alias("metric"),
                                                                     F.lit(None).cast("double").alias("value"))))
                                .otherwise(items)).alias("i"))
    reason = F.when(missing, F.concat(F.lit("missing station_information for station "), F.col("station_id")))
    out = x.select(*_reading(t, F.concat(F.lit("GBFS-"), F.col("station_id")), F.col("i.metric"), F.col("i.value"),
                             F.lit("count"), "gbfs", F.col("lat"), F.col("lon"), ing, reason))
    return _validated(out)


REQUIRED_FEEDS = ("station_information", "station_status")


def feed_discovery(discovery: DataFrame, language: str = "en", required: tuple = REQUIRED_FEEDS) -> DataFrame:
    """S3: feeds of one language from the discovery map (entries without a
    name or URL do not count); a missing language, or the first required
    feed that is missing, yields one error row instead of feeds."""
    listed = F.try_element_at(F.col("data"), F.lit(language)).getField("feeds")
    known = F.filter(listed, lambda f: (F.coalesce(f["name"], F.lit("")) != "") & (F.coalesce(f["url"], F.lit("")) != ""))
    x = discovery.select(F.map_contains_key("data", F.lit(language)).alias("_there"), F.coalesce(known, F.array().cast("array<struct<name:string,url:string>>")).alias("_feeds"))
    names = F.transform("_feeds", lambda f: f["name"])
    error = F.when(~F.coalesce("_there", F.lit(False)), F.concat(F.lit("GBFS language "), go_quote(F.lit(language)), F.lit(" not found")))
    for feed in required:
        error = error.when(~F.array_contains(names, feed), F.lit(f"GBFS feed {feed} not found"))
    none = F.array(F.struct(F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("url")))
    return (x.select("_feeds", error.alias("error")).select("error", F.explode(F.when(F.col("error").isNull(), F.col("_feeds")).otherwise(none)).alias("f"))
            .select(F.lit(language).alias("language"), "f.name", "f.url", "error"))


# ------------------------------------------------------------------ N4 river gauge
def go_parse_float(text: Column) -> tuple[Column, Column]:
    """(value, ok) with Go ``strconv.ParseFloat(trim(text))`` acceptance:
    decimal syntax or inf/infinity/nan; overflow (e.g. 1e400) is an error."""
    t = go_trim(text)
    syntax = F.coalesce(t.rlike(GO_FLOAT), F.lit(False))
    v = t.try_cast("double")
    overflow = F.isnotnull(v) & (F.abs(v) == float("inf")) & ~t.rlike(GO_INF)
    ok = syntax & v.isNotNull() & ~overflow
    return v, ok


def normalize_river(payload: DataFrame, ingested_at) -> DataFrame:
    ser = payload.select(F.explode("value.timeSeries").alias("ts"))
    site = go_trim(F.try_element_at(F.col("ts.sourceInfo.siteCode"), F.lit(1)).getField("value"))
    code = go_trim(F.try_element_at(F.col("ts.variable.variableCode"), F.lit(1)).getField("value"))
    unit_code = F.col("ts.variable.unit.unitCode")
    param_ok = (F.coalesce(code, F.lit("")) == "00065") & (F.lower(go_trim(unit_code)) == "ft")
    series_fail = (F.when(~param_ok, F.concat(F.lit("unsupported USGS parameter/unit "), F.coalesce(code, F.lit("")),
                                               F.lit("/"), F.coalesce(unit_code, F.lit(""))))
                   .when(F.coalesce(site, F.lit("")) == "", F.lit("missing USGS site code")))
    # values[].value[] by two explodes (missing lists count as empty); a failed
    # series yields exactly one placeholder row that carries its reason
    dummy_m = F.struct(F.lit(None).cast("string").alias("value"), F.lit(None).cast("string").alias("dateTime"))
    groups = F.when(series_fail.isNotNull(), F.array(F.struct(F.array(dummy_m).alias("value")))).otherwise(
        F.coalesce(F.col("ts.values"), F.array().cast("array<struct<value:array<struct<value:string,dateTime:string>>>>")))
    g = ser.select(site.alias("site"), series_fail.alias("series_fail"),
                   *[F.coalesce(f"ts.sourceInfo.geoLocation.geogLocation.{c}", F.lit(0.0)).alias(c[:3]) for c in ("latitude", "longitude")],
                   F.explode(groups).alias("g"))
    x = g.select("site", "series_fail", "lat", "lon",
                 F.explode(F.coalesce(F.col("g.value"), F.array().cast("array<struct<value:string,dateTime:string>>")))
                 .alias("m"))
    t = parse_rfc3339(F.col("m.dateTime"))
    v, ok = go_parse_float(F.col("m.value"))
    reason = (F.when(F.col("series_fail").isNotNull(), F.col("series_fail"))
              .when(t.isNull(), F.concat(F.lit("missing USGS timestamp for site "), F.col("site")))
              .when(~ok, F.concat(F.lit("invalid USGS value "), go_quote(F.col("m.value")),
                                  F.lit(" for site "), F.col("site"))))
    out = x.select(*_reading(t, F.concat(F.lit("USGS-"), F.col("site")), F.lit("water_gage_height"), v, F.lit("ft"),
                             "usgs", F.col("lat"), F.col("lon"), _ingest_lit(ingested_at), reason))
    return _validated(out)


# ------------------------------------------------------------------ N6 / N7
def all_sources(*normalized: DataFrame) -> DataFrame:
    """Union of every source's output (same contract, by name)."""
    out = normalized[0]
    for df in normalized[1:]:
        out = out.unionByName(df)
    return out


def normalize_stats(normalized: DataFrame) -> DataFrame:
    """Per source, published and skipped counts in one aggregate."""
    return (normalized.groupBy("source")
            .agg(F.count(F.when(F.col("skip_reason").isNull(), 1)).cast("bigint").alias("published"),
                 F.count(F.col("skip_reason")).cast("bigint").alias("skipped")))


def air_quality_poll_counts(latest: DataFrame) -> DataFrame:
    """Locations asked and measurements received, per poll."""
    return latest.groupBy("poll_id").agg(F.countDistinct("location_id").cast("bigint").alias("locations"),
                                         F.sum(F.size("results")).cast("bigint").alias("measurements"))


def bike_share_poll_counts(status: DataFrame) -> DataFrame:
    """Stations received, per poll."""
    return status.groupBy("poll_id").agg(F.sum(F.size("data.stations")).cast("bigint").alias("stations"))
