"""Media safety pipeline (M1-M8) and its reports.

Media objects are rows (uri, ...); all path inference, label mapping,
keyword classification and flag decisions are column expressions, so a
listing of any size is processed as one narrow projection.  A learned
model plugs in through ``score_with`` (``mapInPandas`` over Arrow batches).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.text import col_, go_trim, lookup

# --- fixed values: keyword classifier candidates, in match order ---------------
KEYWORD_CANDIDATES = ["robbery", "assault", "fighting", "burglary", "shooting", "shoplifting", "stealing",
                      "theft", "vandalism", "roadaccidents", "road accident", "accident", "crash"]
ROAD_WORDS = ["roadaccidents", "road accident", "accident", "crash"]
DEFAULT_CITY, DEFAULT_CAMERA = "chicago", "camera-1"
FLAG_THRESHOLD = 0.65
MODEL_NAME, MODEL_VERSION = "mock-keyword", "mvp"


# ------------------------------------------------------------------ path helpers
def object_name(uri) -> Column:
    """Object path without the ``scheme://bucket/`` prefix."""
    return F.regexp_replace(col_(uri), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*/", "")


def file_name(path) -> Column:
    """Last path segment (``/`` or ``\\`` separated) - plain string functions, no regex."""
    return F.substring_index(F.translate(col_(path), "\\", "/"), "/", -1)


def extension(path) -> Column:
    """``Path(name).suffix.lower()``: text from the last dot, '' when the only
    dot leads the name or the name ends with a dot."""
    n = file_name(path)
    has = (F.locate(".", n, 2) > 0) & ~n.endswith(".")
    return F.lower(F.when(has, F.concat(F.lit("."), F.substring_index(n, ".", -1))).otherwise(F.lit("")))


def file_stem(path) -> Column:
    n = file_name(path)
    has = (F.locate(".", n, 2) > 0) & ~n.endswith(".")
    cut = F.length(n) - F.length(F.substring_index(n, ".", -1)) - 1
    return F.when(has, n.substr(F.lit(1), cut)).otherwise(n)


def is_media(path) -> Column:
    """Video or image extension (case-insensitive)."""
    return extension(path).isin(S.MEDIA_EXTENSIONS)


def _last_part_value(path, key: str, skip_empty: bool = True) -> Column:
    """Value of the last ``key=value`` path part (the last non-empty one when
    ``skip_empty``).  A greedy prefix makes one regex find the last match,
    which stays inside generated code (no lambda)."""
    value = "[^/]+" if skip_empty else "[^/]*"
    v = F.regexp_extract(F.regexp_replace(col_(path), r"\\", "/"), f"^.*(?:^|/){key}=({value})", 1)
    return F.nullif(v, F.lit(""))


def infer_city_camera(path, default_city: str = DEFAULT_CITY, default_camera: str = DEFAULT_CAMERA):
    """M1: ``city=`` / ``camera=`` path parts, last non-empty wins."""
    return (F.coalesce(_last_part_value(path, "city"), F.lit(default_city)),
            F.coalesce(_last_part_value(path, "camera"), F.lit(default_camera)))


def path_metadata(path) -> dict[str, Column]:
    """M2: what a path says of a frame: the last ``source_video=`` part and
    the number of the last ``frameNNN`` token of the file name."""
    stem = F.regexp_replace(file_stem(path), "-", "_")
    # last "_"-separated token that is "frame" + digits
    frame = F.nullif(F.regexp_extract(stem, r"^.*(?:^|_)(?i:frame)([0-9]+)(?:_|$)", 1), F.lit("")).try_cast("int")
    src = F.when(col_(path).contains("source_video="), _last_part_value(path, "source_video", skip_empty=False))
    return {"source_video_uri": src, "frame_index": frame}


PLACE = {"location_name": "string", "latitude": "double", "longitude": "double"}


def media_events(listing: DataFrame, event_time: Column, uri_col: str = "media_uri",
                 default_city: str = DEFAULT_CITY, default_camera: str = DEFAULT_CAMERA,
                 keep: list[str] | tuple = (), cameras: DataFrame | None = None) -> DataFrame:
    """Media objects -> events (non-media files dropped);
    ``event_time`` is the object's own time, the place comes from the camera
    dimension ``cameras`` (camera_id, location_name, latitude, longitude; null
    without it), and ``keep`` passes listing columns through."""
    name = object_name(uri_col)
    city, cam = infer_city_camera(name, default_city, default_camera)
    events = (listing.filter(is_media(uri_col))
              .select(*keep, F.col(uri_col).alias("uri"), city.alias("city"), cam.alias("camera_id"), event_time.alias("event_time"),
                      *[c.alias(k) for k, c in path_metadata(name).items()]))
    if cameras is None:
        events = events.withColumns({k: F.lit(None).cast(t) for k, t in PLACE.items()})
    else:
        events = events.join(cameras.select("camera_id", *PLACE), "camera_id", "left")
    kept = [c for c in events.columns if c not in ("uri", "city", "camera_id", "event_time", *PLACE, "source_video_uri", "frame_index")]
    return events.select(*kept, "uri", "city", "camera_id", "event_time", *PLACE, "source_video_uri", "frame_index")


def read_media_listing(spark, path: str) -> DataFrame:
    """The media objects below ``path`` (media_uri, size, modified_at):
    names, sizes and times only; no file is opened (the content column of the
    listing is never selected)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .select(F.col("path").alias("media_uri"), F.col("length").alias("size"), F.col("modificationTime").alias("modified_at"))
            .filter(is_media("media_uri")))


def parse_notifications(raw: DataFrame, as_of: Column, body_col: str = "body",
                        default_city: str = DEFAULT_CITY, default_camera: str = DEFAULT_CAMERA) -> DataFrame:
    """Object-created notifications -> events, or an ``error``.

    The name is percent-decoded with ``+`` kept (``url_decode`` would turn it
    into a space)."""
    j = F.from_json(col_(body_col), "bucket string, name string")
    bucket = j["bucket"]
    name = F.try_url_decode(F.replace(F.coalesce(j["name"], F.lit("")), F.lit("+"), F.lit("%2B")))
    err = (F.when(F.try_parse_json(col_(body_col)).isNull(), F.lit("invalid notification JSON"))
           .when((F.coalesce(bucket, F.lit("")) == "") | (F.coalesce(name, F.lit("")) == ""),
                 F.lit("GCS notification must include bucket and name"))
           .when(~is_media(name), F.concat(F.lit("not a supported media object: "), name)))
    city, cam = infer_city_camera(name, default_city, default_camera)
    md = {"event_time": as_of, **{k: F.lit(None).cast(t) for k, t in PLACE.items()}, **path_metadata(name)}
    ok = err.isNull()
    return raw.select(F.when(ok, F.concat(F.lit("gs://"), bucket, F.lit("/"), name)).alias("uri"),
                      F.when(ok, city).alias("city"), F.when(ok, cam).alias("camera_id"),
                      *[F.when(ok, c).alias(k) for k, c in md.items()], err.alias("error"))


# ------------------------------------------------------------------ M3 labels
def normalize_label(label) -> Column:
    n = F.replace(F.replace(F.lower(go_trim(F.coalesce(col_(label), F.lit("")))),
                            F.lit("_"), F.lit(" ")), F.lit("-"), F.lit(" "))
    return lookup(n, S.LABEL_ALIASES, n)


def _map(n: Column, mapping: dict, fallback: Column) -> Column:
    return lookup(n, mapping, fallback)


def display_label(label) -> Column:
    n = normalize_label(label)
    fb = F.regexp_replace(n, " ", "_")
    return _map(n, S.DISPLAY_LABELS, F.when(fb == "", F.lit("unknown")).otherwise(fb))


def severity(label) -> Column:
    return _map(normalize_label(label), S.SEVERITY, F.lit("low"))


def is_suspicious_label(label) -> Column:
    return normalize_label(label).isin(S.SUSPICIOUS_LABELS)


def label_mapping(labels: DataFrame, column: str = "raw_label") -> DataFrame:
    return labels.select(F.col(column).alias("raw_label"), normalize_label(column).alias("normalized_label"),
                         display_label(column).alias("display_label"), severity(column).alias("severity"),
                         is_suspicious_label(column).alias("is_suspicious"))


# ------------------------------------------------------------------ M4 / M5 scoring
def keyword_predict(uri, clip_seconds: int = 10) -> Column:
    """M4: file-name keyword classifier, first matching candidate wins."""
    name = F.lower(file_name(uri))
    label = None
    for cand in KEYWORD_CANDIDATES:
        out = "road accident" if cand in ROAD_WORDS else ("stealing" if cand == "theft" else cand)
        label = F.when(name.contains(cand), F.lit(out)) if label is None else label.when(name.contains(cand), F.lit(out))
    label = label.otherwise(F.lit(None).cast("string"))
    sus = label.isNotNull()
    conf = F.when(sus, F.lit(0.91)).otherwise(F.lit(0.92))
    return F.struct(F.coalesce(label, F.lit("normal")).alias("label"), conf.alias("confidence"),
                    F.lit(0.0).alias("clip_start_seconds"), F.lit(float(clip_seconds)).alias("clip_end_seconds"),
                    sus.alias("is_suspicious"),
                    F.when(sus, conf).otherwise(F.lit(1.0) - conf).alias("crime_score"),
                    F.when(sus, conf).alias("type_score"))


def _normalized(results: Column) -> Column:
    """Score list with labels normalised once (not in every later lambda)."""
    return F.transform(results, lambda x: F.struct(
        F.replace(normalize_label(x["label"]), F.lit("-"), F.lit(" ")).alias("label"),
        F.coalesce(x["score"], F.lit(0.0)).alias("score")))


def _best(results: Column, fallback: str):
    """(label, score) of the highest score, first on ties; (fallback, 0.0)
    for an empty list.  ``results`` has normalised labels."""
    best = F.array_max(F.transform(results, lambda x, i: F.struct(
        x["score"].alias("score"), (-i).alias("neg_pos"), x["label"].alias("label"))))
    empty = F.coalesce(F.size(results), F.lit(0)) == 0
    return (F.when(empty, F.lit(fallback)).otherwise(best["label"]),
            F.when(empty, F.lit(0.0)).otherwise(best["score"]))


def _score_for(results: Column, wanted: list[str]) -> Column:
    return F.array_max(F.transform(F.filter(results, lambda x: x["label"].isin(wanted)), lambda x: x["score"]))


def two_stage_decision(binary: Column, types: Column, threshold: float = 0.5, clip_seconds: int = 10) -> Column:
    """M5 on score lists (array<struct<label,score>>) from a binary
    crime/normal classifier and an activity-type classifier.  Null when the
    binary list is empty (no prediction)."""
    nb, nt = _normalized(binary), _normalized(types)
    normal = _score_for(nb, ["normal", "normal videos"])
    crime = _score_for(nb, ["crime", "abnormal", "suspicious"])
    b_label, b_score = _best(nb, "normal")
    is_normal = b_label.contains("normal")
    crime_score = F.coalesce(crime, F.when(is_normal, F.lit(1.0) - b_score).otherwise(b_score))
    normal_score = F.when(crime.isNull() & is_normal, b_score).otherwise(normal)
    sus = crime_score >= threshold
    t_label, t_score = _best(nt, "suspicious activity")
    conf = F.when(sus, crime_score).otherwise(F.coalesce(normal_score, F.greatest(F.lit(0.0), F.lit(1.0) - crime_score)))
    decision = F.struct(F.when(sus, t_label).otherwise(F.lit("normal")).alias("label"), conf.alias("confidence"),
                        F.lit(0.0).alias("clip_start_seconds"), F.lit(float(clip_seconds)).alias("clip_end_seconds"),
                        sus.alias("is_suspicious"), crime_score.alias("crime_score"),
                        F.when(sus, t_score).alias("type_score"))
    return F.when(F.coalesce(F.size(binary), F.lit(0)) > 0, decision)


def score_with(events: DataFrame, predict: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Pluggable model hook: ``predict`` maps an Arrow batch (pandas frame of
    events) to prediction columns; Spark partitions the listing."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield predict(b)
    return events.mapInPandas(run, schema)


# ------------------------------------------------------------------ M6 / M7
def predictions(events: DataFrame, scored: Column, model_name: str = MODEL_NAME,
                model_version: str = MODEL_VERSION, created_at: Column | None = None,
                keep: list[str] | tuple = ()) -> DataFrame:
    """Prediction rows: severity is the label severity when suspicious else low."""
    p = events.withColumn("_p", scored)
    lab = F.col("_p.label")
    return p.select(*keep, "event_time", "city", "camera_id", "location_name",
                    F.col("latitude").cast("double").alias("latitude"), F.col("longitude").cast("double").alias("longitude"),
                    F.col("uri").alias("media_uri"), "source_video_uri", "frame_index",
                    F.col("_p.is_suspicious").alias("is_suspicious"), lab.alias("predicted_label"),
                    display_label(lab).alias("display_label"),
                    F.col("_p.crime_score").cast("double").alias("crime_score"),
                    F.col("_p.type_score").cast("double").alias("type_score"),
                    F.col("_p.confidence").cast("double").alias("confidence"),
                    F.when(F.col("_p.is_suspicious"), severity(lab)).otherwise(F.lit("low")).alias("severity"),
                    F.lit(model_name).alias("model_name"), F.lit(model_version).alias("model_version"),
                    F.lit("pending").alias("review_status"),
                    (created_at if created_at is not None else F.col("event_time")).alias("created_at"),
                    F.coalesce(F.col("_p.clip_start_seconds").cast("double"), F.lit(0.0)).alias("clip_start_seconds"),
                    F.coalesce(F.col("_p.clip_end_seconds").cast("double"), F.lit(0.0)).alias("clip_end_seconds"))


def flags(preds: DataFrame, threshold: float = FLAG_THRESHOLD, keep: list[str] | tuple = ()) -> DataFrame:
    """P10/M7: confident, suspicious predictions of a suspicious label."""
    cond = ((F.col("confidence") >= threshold) & F.col("is_suspicious")
            & is_suspicious_label(F.col("predicted_label")))
    return preds.filter(cond).select(
        *keep, "event_time", "city", "camera_id", F.col("media_uri").alias("video_uri"), "clip_start_seconds",
        "clip_end_seconds", "predicted_label", "display_label", "confidence",
        severity(F.col("predicted_label")).alias("severity"), "model_name", "model_version",
        F.lit("pending").alias("review_status"), "created_at")


# ------------------------------------------------------------------ A15-A19
def safety_summary(preds: DataFrame) -> DataFrame:
    sus = F.col("is_suspicious")
    return preds.agg(
        F.count(F.lit(1)).cast("bigint").alias("total_predictions"),
        F.coalesce(F.sum(F.when(sus, 1).otherwise(0)), F.lit(0)).cast("bigint").alias("suspicious_predictions"),
        F.coalesce(F.sum(F.when(~sus, 1).otherwise(0)), F.lit(0)).cast("bigint").alias("normal_predictions"),
        F.coalesce(F.sum(F.when(F.col("severity").isin("high", "critical") & sus, 1).otherwise(0)), F.lit(0))
        .cast("bigint").alias("high_severity_predictions"),
        F.coalesce(F.avg(F.col("confidence").cast("decimal(20,10)")).cast("double"), F.lit(0.0)).alias("avg_confidence"),
        F.max("event_time").alias("latest_prediction_at")).withColumn(
        "flag_rate", F.coalesce(F.col("suspicious_predictions").cast("double")
                                / F.nullif(F.col("total_predictions"), F.lit(0)), F.lit(0.0)))


def safety_timeline(preds: DataFrame) -> DataFrame:
    from ..functions.timefn import time_bucket
    kind = F.when(F.col("is_suspicious"), F.lit("AI-flagged possible activity")).otherwise(F.lit("Normal review frame"))
    return (preds.groupBy(time_bucket("event_time", "15 minutes").alias("bucket"), kind.alias("prediction_type"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("predictions")).orderBy("bucket", "prediction_type"))


def safety_recent(preds: DataFrame, limit: int = 100) -> DataFrame:
    """L2: most recent predictions (top-k report), ties broken by uri."""
    return (preds.orderBy(F.desc("event_time"), F.desc("media_uri"), "predicted_label").limit(limit)
            .select("event_time", "city", "camera_id", "location_name", "latitude", "longitude", "is_suspicious",
                    "display_label", "confidence", "crime_score", "type_score", "severity", "review_status",
                    "media_uri"))


def latest_flag(preds: DataFrame) -> DataFrame:
    """L3: the most recent suspicious prediction."""
    return safety_recent(preds.filter("is_suspicious"), 1)


def safety_by_camera(preds: DataFrame) -> DataFrame:
    sus = F.col("is_suspicious")
    return (preds.groupBy("location_name", "camera_id")
            .agg(F.count_if(sus).cast("bigint").alias("flagged"), F.count_if(~sus).cast("bigint").alias("normal"),
                 F.count(F.lit(1)).cast("bigint").alias("total"),
                 # exact decimal average: the same result however rows are partitioned
                 F.round(F.avg(F.col("confidence").cast("decimal(20,10)")), 3).cast("double").alias("avg_confidence"))
            .orderBy(F.desc("flagged"), "location_name", "camera_id"))


def safety_by_label(preds: DataFrame) -> DataFrame:
    return (preds.filter(F.col("is_suspicious")).groupBy("display_label", "severity")
            .agg(F.count(F.lit(1)).cast("bigint").alias("count")).orderBy(F.desc("count"), "display_label"))


def safety_day_type(preds: DataFrame) -> DataFrame:
    sus = F.col("is_suspicious")
    day = F.when(F.dayofweek("event_time").isin(1, 7), F.lit("Weekend")).otherwise(F.lit("Weekday"))
    return (preds.groupBy(day.alias("day_type"))
            .agg(F.count_if(sus).cast("bigint").alias("flagged"), F.count_if(~sus).cast("bigint").alias("normal"),
                 F.count(F.lit(1)).cast("bigint").alias("total")).orderBy("day_type"))
