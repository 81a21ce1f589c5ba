"""Media safety queries (M1-M7, A15-A19, L2, L3) over ``media_raw``."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..functions.timefn import ts_lit
from ..operators import safety as SF
from ..operators import validate as VL
from ..sources import fixtures as FX
from ..sources.fixtures import with_views
from . import sqlkit as Q
from .catalog import AS_OF, ASOF, register


def _asof(df, col="event_time"):
    return ts_lit(AS_OF, df.schema[col].dataType)


def events(spark, sf):
    raw = FX.media_raw(spark, sf)
    return SF.media_events(raw, F.col("event_time"), cameras=FX.cameras(spark, sf),
                           keep=["event_id", "raw_label", "confidence", F.col("is_suspicious").alias("raw_suspicious"),
                                 F.col("event_time").alias("observed_at")])


def _raw_score():
    c = F.col("confidence").cast("double")
    sus = F.col("raw_suspicious")
    return F.struct(F.col("raw_label").alias("label"), c.alias("confidence"), sus.alias("is_suspicious"),
                    F.when(sus, c).otherwise(F.lit(1.0) - c).alias("crime_score"), F.when(sus, c).alias("type_score"),
                    F.lit(0.0).alias("clip_start_seconds"), F.lit(0.0).alias("clip_end_seconds"))


def preds(spark, sf, keep=()):
    ev = events(spark, sf).withColumn("event_time", F.col("observed_at"))
    return SF.predictions(ev, _raw_score(), model_name="fixture-scores", keep=keep)


# ---------------------------------------------------------------- SQL side
NAME = "regexp_replace(media_uri, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*/', '')"
FNAME = f"regexp_extract(replace({NAME}, '\\\\', '/'), '([^/]*)$', 1)"


def _stem(f):
    return f"CASE WHEN regexp_matches({f}, '^.+\\.[^.]*$') THEN regexp_extract({f}, '^(.+)\\.[^.]*$', 1) ELSE {f} END"


def _ext(f):
    return f"lower(CASE WHEN regexp_matches({f}, '^.+\\.[^.]*$') THEN regexp_extract({f}, '(\\.[^.]*)$', 1) ELSE '' END)"


def _part(key, skip_empty=True):
    vals = f"regexp_extract_all({NAME}, '(?:^|/){key}=([^/]*)', 1)"
    return f"list_filter({vals}, lambda v: v <> '')[-1]" if skip_empty else f"nullif({vals}[-1], '')"


_FRAMES = (f"list_filter(string_split(replace({_stem(FNAME)}, '-', '_'), '_'), "
           "lambda t: starts_with(lower(t), 'frame') AND regexp_matches(substr(t, 6), '^[0-9]+$'))")
EVENTS_SQL = f"""SELECT event_id, raw_label, confidence, is_suspicious AS raw_suspicious, event_time AS observed_at,
  media_uri AS uri, coalesce({_part('city')}, 'chicago') AS city, coalesce({_part('camera')}, 'camera-1') AS camera_id,
  event_time, 'Camera site ' || substr({_part('camera')}, 5) AS location_name,
  41.6::DOUBLE + CAST(substr({_part('camera')}, 5) AS DOUBLE) * 0.01::DOUBLE AS latitude,
  -87.9::DOUBLE + CAST(substr({_part('camera')}, 5) AS DOUBLE) * 0.01::DOUBLE AS longitude,
  CASE WHEN contains({NAME}, 'source_video=') THEN {_part('source_video', False)} END AS source_video_uri,
  TRY_CAST(substr({_FRAMES}[-1], 6) AS INTEGER) AS frame_index
FROM media_raw WHERE {_ext(FNAME)} IN {Q.in_list(S.MEDIA_EXTENSIONS)}"""

_NORM = "replace(replace(lower(trim(coalesce({l}, ''))), '_', ' '), '-', ' ')"


def norm_label(l):
    n = _NORM.format(l=l)
    return "CASE " + " ".join(f"WHEN {n} = '{k}' THEN '{v}'" for k, v in S.LABEL_ALIASES.items()) + f" ELSE {n} END"


def display_label(l):
    n = norm_label(l)
    return ("CASE " + " ".join(f"WHEN {n} = '{k}' THEN '{v}'" for k, v in S.DISPLAY_LABELS.items())
            + f" WHEN replace({n}, ' ', '_') = '' THEN 'unknown' ELSE replace({n}, ' ', '_') END")


def severity(l):
    n = norm_label(l)
    return "CASE " + " ".join(f"WHEN {n} = '{k}' THEN '{v}'" for k, v in S.SEVERITY.items()) + " ELSE 'low' END"


def suspicious(l):
    return f"({norm_label(l)} IN {Q.in_list(S.SUSPICIOUS_LABELS)})"


PRED_SQL = f"""SELECT event_id, observed_at AS event_time, city, camera_id, location_name, CAST(latitude AS DOUBLE) AS latitude,
  CAST(longitude AS DOUBLE) AS longitude, uri AS media_uri, source_video_uri, frame_index, raw_suspicious AS is_suspicious,
  raw_label AS predicted_label, {display_label('raw_label')} AS display_label,
  CASE WHEN raw_suspicious THEN CAST(confidence AS DOUBLE) ELSE 1.0 - CAST(confidence AS DOUBLE) END AS crime_score,
  CASE WHEN raw_suspicious THEN CAST(confidence AS DOUBLE) END AS type_score, CAST(confidence AS DOUBLE) AS confidence,
  CASE WHEN raw_suspicious THEN {severity('raw_label')} ELSE 'low' END AS severity,
  'fixture-scores' AS model_name, 'mvp' AS model_version, 'pending' AS review_status, observed_at AS created_at,
  0.0::DOUBLE AS clip_start_seconds, 0.0::DOUBLE AS clip_end_seconds
FROM ({EVENTS_SQL})"""


def V(body, **extra):
    return with_views(body, "media_raw", extra=extra)


register("media_events", V(f"SELECT uri, city, camera_id, event_time, location_name, latitude, longitude, "
                           f"source_video_uri, frame_index FROM ({EVENTS_SQL})"))(
    lambda spark, sf: events(spark, sf).select("uri", "city", "camera_id", "event_time", "location_name", "latitude",
                                               "longitude", "source_video_uri", "frame_index"))
register("label_mapping", V(f"""SELECT raw_label, {norm_label('raw_label')} AS normalized_label,
  {display_label('raw_label')} AS display_label, {severity('raw_label')} AS severity, {suspicious('raw_label')} AS is_suspicious
  FROM (SELECT DISTINCT raw_label FROM media_raw)"""))(
    lambda spark, sf: SF.label_mapping(FX.media_raw(spark, sf).select("raw_label").distinct()))

_KW = "lower(" + FNAME + ")"
_KW_LABEL = "CASE " + " ".join(
    f"WHEN contains({_KW}, '{c}') THEN '{'road accident' if c in SF.ROAD_WORDS else ('stealing' if c == 'theft' else c)}'"
    for c in SF.KEYWORD_CANDIDATES) + " END"
register("keyword_predictions", V(f"""SELECT media_uri AS uri, coalesce(lbl, 'normal') AS label,
  CASE WHEN lbl IS NOT NULL THEN 0.91 ELSE 0.92 END::DOUBLE AS confidence, lbl IS NOT NULL AS is_suspicious,
  CASE WHEN lbl IS NOT NULL THEN 0.91::DOUBLE ELSE 1.0::DOUBLE - 0.92::DOUBLE END AS crime_score,
  CASE WHEN lbl IS NOT NULL THEN 0.91::DOUBLE END AS type_score
  FROM (SELECT media_uri, {_KW_LABEL} AS lbl FROM media_raw WHERE {_ext(FNAME)} IN {Q.in_list(S.MEDIA_EXTENSIONS)})"""))(
    lambda spark, sf: events(spark, sf).select(F.col("uri"), SF.keyword_predict("uri").alias("p")).select(
        "uri", "p.label", "p.confidence", "p.is_suspicious", "p.crime_score", "p.type_score"))

register("media_predictions", V(f"SELECT * EXCLUDE (event_id) FROM ({PRED_SQL})"))(lambda spark, sf: preds(spark, sf))
FLAGS_SQL = f"""SELECT event_id, event_time, city, camera_id, media_uri AS video_uri, clip_start_seconds, clip_end_seconds,
  predicted_label, display_label, confidence, {severity('predicted_label')} AS severity, model_name, model_version,
  'pending' AS review_status, created_at
  FROM ({PRED_SQL}) WHERE confidence >= {SF.FLAG_THRESHOLD} AND is_suspicious AND {suspicious('predicted_label')}"""
register("media_flags", V(f"SELECT * EXCLUDE (event_id) FROM ({FLAGS_SQL})"))(lambda spark, sf: SF.flags(preds(spark, sf)))

_AVGC = Q.avg_exact("CAST(confidence AS DECIMAL(20,10))", 10)
register("safety_summary", V(f"""SELECT COUNT(*) AS total_predictions,
  CAST(COALESCE(SUM(CASE WHEN is_suspicious THEN 1 ELSE 0 END), 0) AS BIGINT) AS suspicious_predictions,
  CAST(COALESCE(SUM(CASE WHEN NOT is_suspicious THEN 1 ELSE 0 END), 0) AS BIGINT) AS normal_predictions,
  CAST(COALESCE(SUM(CASE WHEN severity IN ('high', 'critical') AND is_suspicious THEN 1 ELSE 0 END), 0) AS BIGINT)
    AS high_severity_predictions,
  COALESCE({_AVGC}, 0.0) AS avg_confidence, MAX(event_time) AS latest_prediction_at,
  COALESCE(CAST(SUM(CASE WHEN is_suspicious THEN 1 ELSE 0 END) AS DOUBLE) / NULLIF(COUNT(*), 0), 0.0) AS flag_rate
  FROM ({PRED_SQL})"""))(lambda spark, sf: SF.safety_summary(preds(spark, sf)))
register("safety_timeline", V(f"""SELECT time_bucket(INTERVAL '15 minutes', event_time) AS bucket,
  CASE WHEN is_suspicious THEN 'AI-flagged possible activity' ELSE 'Normal review frame' END AS prediction_type,
  COUNT(*) AS predictions FROM ({PRED_SQL}) GROUP BY ALL"""))(lambda spark, sf: SF.safety_timeline(preds(spark, sf)))
RECENT_COLS = ("event_time, city, camera_id, location_name, latitude, longitude, is_suspicious, display_label, "
               "confidence, crime_score, type_score, severity, review_status, media_uri")
register("safety_recent", V(f"""SELECT {RECENT_COLS} FROM ({PRED_SQL})
  ORDER BY event_time DESC, media_uri DESC, predicted_label LIMIT 100"""))(lambda spark, sf: SF.safety_recent(preds(spark, sf)))
register("latest_flag", V(f"""SELECT {RECENT_COLS} FROM ({PRED_SQL}) WHERE is_suspicious
  ORDER BY event_time DESC, media_uri DESC, predicted_label LIMIT 1"""))(lambda spark, sf: SF.latest_flag(preds(spark, sf)))
register("safety_by_camera", V(f"""SELECT location_name, camera_id,
  COUNT(*) FILTER (WHERE is_suspicious) AS flagged, COUNT(*) FILTER (WHERE NOT is_suspicious) AS normal,
  COUNT(*) AS total, {Q.avg_exact('CAST(confidence AS DECIMAL(20,10))', 10, 3)} AS avg_confidence
  FROM ({PRED_SQL}) GROUP BY ALL"""))(lambda spark, sf: SF.safety_by_camera(preds(spark, sf)))
register("safety_by_label", V(f"""SELECT display_label, severity, COUNT(*) AS count FROM ({PRED_SQL})
  WHERE is_suspicious GROUP BY ALL"""))(lambda spark, sf: SF.safety_by_label(preds(spark, sf)))
register("safety_day_type", V(f"""SELECT CASE WHEN dayofweek(event_time) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS day_type,
  COUNT(*) FILTER (WHERE is_suspicious) AS flagged, COUNT(*) FILTER (WHERE NOT is_suspicious) AS normal,
  COUNT(*) AS total FROM ({PRED_SQL}) GROUP BY ALL"""))(lambda spark, sf: SF.safety_day_type(preds(spark, sf)))


# ---------------------------------------------------------------- V5 CHECK rules of the other tables
_SCORE = "{c} BETWEEN 0 AND 1"
_SEVERITY = "severity IN ('low', 'medium', 'high', 'critical')"
_REVIEW = "review_status IN ('pending', 'reviewed', 'dismissed')"


def _rules_sql(frm, rules):
    return " UNION ALL ".join(f"SELECT '{n}' AS rule, count(CASE WHEN NOT coalesce({c}, false) THEN 1 END) AS violations, count(*) AS checked_rows FROM ({frm})"
                              for n, c in rules.items())


register("prediction_constraints", V(_rules_sql(PRED_SQL, {
    "crime_score_range": _SCORE.format(c="crime_score"), "type_score_range": "type_score IS NULL OR type_score BETWEEN 0 AND 1",
    "confidence_range": _SCORE.format(c="confidence"), "severity_domain": _SEVERITY, "review_status_domain": _REVIEW})))(
    lambda spark, sf: VL.check_constraints(preds(spark, sf), VL.prediction_checks()))
register("flag_constraints", V(_rules_sql(FLAGS_SQL, {
    "confidence_range": _SCORE.format(c="confidence"), "severity_domain": _SEVERITY, "review_status_domain": _REVIEW})))(
    lambda spark, sf: VL.check_constraints(SF.flags(preds(spark, sf)), VL.flag_checks()))
register("metric_constraints", with_views(_rules_sql("SELECT * FROM ingestion_metrics", {"channel_fill_range": "channel_fill_pct BETWEEN 0 AND 100"}),
                                          "ingestion_metrics"))(
    lambda spark, sf: VL.check_constraints(FX.ingestion_metrics(spark, sf), VL.metric_checks()))
