"""Media extras: class inference, sampler, two-stage decision, metadata,
bike-share feed discovery (M2, M5, M8, W6, S3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import normalize as N
from ..operators import safety as SF
from ..operators import sampler as SM
from ..sources import fixtures as FX
from ..sources.fixtures import with_views
from . import sqlkit as Q
from .catalog import register
from .q_safety import EVENTS_SQL, events, norm_label


def listing(spark, sf):
    """Dataset listing (path, size): one image per media object, filed under
    a class folder named by the raw label."""
    raw = FX.media_raw(spark, sf)
    fname = F.regexp_extract("media_uri", r"([^/]*)$", 1)
    return raw.select(F.concat(F.lit("kaggle/"), F.col("raw_label"), F.lit("/"), fname).alias("path"),
                      (F.col("value_bytes") if "value_bytes" in raw.columns else
                       (F.col("confidence") * 100000).cast("long")).alias("size"))


def _norm_class(x: str) -> str:
    n = f"replace(replace(lower(trim({x})), '_', ' '), '-', ' ')"
    return (f"CASE WHEN {n} IN {Q.in_list(SM.NORMAL_ALIASES)} THEN 'normal' "
            f"WHEN {n} IN {Q.in_list(SM.ROAD_ALIASES)} THEN 'roadaccidents' "
            f"WHEN {n} IN {Q.in_list(SM.STEAL_ALIASES)} THEN 'stealing' ELSE replace({n}, ' ', '') END")


_WANTED = "[" + ", ".join(_norm_class(f"'{c}'") for c in SM.DEFAULT_CLASSES) + "]"
_LISTING_SQL = f"""SELECT 'kaggle/' || raw_label || '/' || regexp_extract(media_uri, '([^/]*)$', 1) AS path,
  CAST(confidence * 100000 AS BIGINT) AS size FROM media_raw"""
register("class_from_path", with_views(f"""SELECT path,
  list_filter(list_transform(string_split(path, '/'), lambda p: {_norm_class('p')}), lambda c: list_contains({_WANTED}, c))[1] AS class_name
  FROM ({_LISTING_SQL})""", "media_raw"))(
    lambda spark, sf: listing(spark, sf).select("path", SM.class_from_path(F.col("path"), SM.DEFAULT_CLASSES)
                                               .alias("class_name")))

# every candidate in (turn, class) order, taken or blocking its class
_SAMPLE_SQL = f"""
WITH RECURSIVE media_raw AS ({FX.MEDIA_RAW_SQL}),
f AS (SELECT path, size, list_filter(list_transform(string_split(path, '/'), lambda p: {_norm_class('p')}), lambda c: list_contains({_WANTED}, c))[1] AS class_name
      FROM ({_LISTING_SQL}) WHERE lower(regexp_extract(path, '(\\.[^./]*)$', 1)) IN {Q.in_list(SM.IMAGE_EXTENSIONS)}),
r AS (SELECT *, row_number() OVER (PARTITION BY class_name ORDER BY path) AS k FROM f WHERE class_name IS NOT NULL),
c AS (SELECT *, row_number() OVER (ORDER BY k, class_name) AS n FROM r WHERE k <= CASE WHEN class_name = 'normal' THEN 70 ELSE 15 END),
s AS (SELECT 0::BIGINT AS n, 0::BIGINT AS total, []::VARCHAR[] AS blocked, false AS taken
      UNION ALL
      SELECT c.n, CASE WHEN ok THEN total + size ELSE total END, CASE WHEN ok THEN blocked ELSE list_append(blocked, class_name) END, ok
      FROM (SELECT c.n, c.size, c.class_name, s.total, s.blocked, NOT list_contains(s.blocked, c.class_name) AND s.total + c.size <= 2000000 AS ok
            FROM s JOIN c ON c.n = s.n + 1) c)
SELECT class_name, path, size, k - 1 AS class_index, total AS total_bytes,
       'city=chicago/camera=demo-' || class_name || '/' || CASE class_name WHEN 'normal' THEN 'Normal' WHEN 'roadaccidents' THEN 'RoadAccidents'
         ELSE upper(class_name[1]) || class_name[2:] END || '_' || printf('%04d', k - 1) || lower(regexp_extract(path, '(\\.[^./]*)$', 1)) AS target
FROM s JOIN c USING (n) WHERE taken"""
register("capped_sample", _SAMPLE_SQL)(
    lambda spark, sf: SM.capped_sample(listing(spark, sf), limit_bytes=2_000_000, max_normal=70, max_anomaly=15))

register("media_metadata", with_views(f"""SELECT uri, location_name, latitude, longitude, event_time, source_video_uri,
  frame_index FROM ({EVENTS_SQL})""", "media_raw"))(
    lambda spark, sf: events(spark, sf).select("uri", "location_name", "latitude", "longitude", "event_time",
                                               "source_video_uri", "frame_index"))


# ---------------------------------------------------------------- M5 two-stage decision
def scores(spark, sf):
    """Score lists per image: the binary list varies its label spelling by
    event_id % 3 (empty on every 7th of the third kind); the type list is
    the raw label plus 'fighting' at half score (empty on every 11th)."""
    raw = FX.media_raw(spark, sf).filter(SF.extension("media_uri").isin(".png", ".jpg", ".jpeg", ".webp"))
    e, c = F.col("event_id"), F.col("confidence").cast("double")

    def item(label, score):
        return F.struct(F.lit(label).alias("label") if isinstance(label, str) else label.alias("label"),
                        score.alias("score"))
    binary = (F.when(e % 3 == 0, F.array(item("Normal", F.lit(1.0) - c), item("Crime", c)))
              .when(e % 3 == 1, F.array(item("NormalVideos", F.lit(1.0) - c), item("Other", c)))
              .when(e % 7 == 0, F.array().cast("array<struct<label:string,score:double>>"))
              .otherwise(F.array(item("Abnormal", c))))
    types = F.when(e % 11 == 0, F.array().cast("array<struct<label:string,score:double>>")).otherwise(
        F.array(item(F.col("raw_label"), c), item("fighting", c / 2)))
    return raw.select("media_uri", binary.alias("binary"), types.alias("types"))


def two_stage(spark, sf):
    d = scores(spark, sf).select("media_uri", SF.two_stage_decision(F.col("binary"), F.col("types")).alias("p"))
    return d.filter(F.col("p").isNotNull()).select("media_uri", "p.label", "p.confidence", "p.is_suspicious",
                                                   "p.crime_score", "p.type_score")


_C = "CAST(confidence AS DOUBLE)"
_TWO_SQL = f"""
WITH s AS (SELECT media_uri, event_id, raw_label, {_C} AS c FROM media_raw
           WHERE lower(regexp_extract(media_uri, '(\\.[^./]*)$', 1)) IN ('.png', '.jpg', '.jpeg', '.webp')),
k AS (SELECT *,
  CASE WHEN event_id % 3 = 0 THEN 1.0 - c WHEN event_id % 3 = 1 THEN NULL
       ELSE NULL END AS normal_found,
  CASE WHEN event_id % 3 = 0 THEN c WHEN event_id % 3 = 1 THEN NULL WHEN event_id % 7 = 0 THEN NULL ELSE c END AS crime_found,
  (event_id % 3 = 2 AND event_id % 7 = 0) AS empty_binary,
  CASE WHEN event_id % 3 = 1 THEN (CASE WHEN 1.0 - c >= c THEN 'normalvideos' ELSE 'other' END) END AS best_label,
  CASE WHEN event_id % 3 = 1 THEN greatest(1.0 - c, c) END AS best_score FROM s),
d AS (SELECT *, coalesce(crime_found, CASE WHEN contains(best_label, 'normal') THEN 1.0 - best_score ELSE best_score END) AS crime,
             CASE WHEN crime_found IS NULL AND contains(best_label, 'normal') THEN best_score ELSE normal_found END AS normal_s
      FROM k WHERE NOT empty_binary),
t AS (SELECT *, crime >= 0.5 AS sus,
   CASE WHEN event_id % 11 = 0 THEN 'suspicious activity'
        WHEN c >= c / 2 THEN {norm_label('raw_label')} ELSE 'fighting' END AS t_label,
   CASE WHEN event_id % 11 = 0 THEN 0.0 ELSE greatest(c, c / 2) END AS t_score FROM d)
SELECT media_uri, CASE WHEN sus THEN t_label ELSE 'normal' END AS label,
  CASE WHEN sus THEN crime ELSE coalesce(normal_s, greatest(0.0, 1.0 - crime)) END AS confidence,
  sus AS is_suspicious, crime AS crime_score, CASE WHEN sus THEN t_score END AS type_score FROM t"""
register("two_stage_decision", with_views(_TWO_SQL, "media_raw"))(two_stage)


# ---------------------------------------------------------------- S3 feed discovery
def discovery(spark, sf):
    ev = FX.table(spark, sf, "events")
    e, u = F.col("event_id"), F.col("user_id").cast("string")
    feeds = F.array(F.struct(F.lit("station_information").alias("name"),
                             F.concat(F.lit("https://feeds.example/"), u, F.lit("/station_information.json")).alias("url")),
                    F.struct(F.lit("station_status").alias("name"),
                             F.concat(F.lit("https://feeds.example/"), u, F.lit("/station_status.json")).alias("url")))
    info, status = feeds[0], feeds[1]
    nameless = F.struct(F.lit("").alias("name"), F.lit("https://feeds.example/x").alias("url"))
    feeds = (F.when(e % 11 == 0, F.array(info, nameless)).when(e % 13 == 0, F.slice(feeds, 1, 0))
             .when(e % 17 == 0, F.array(status, nameless)).otherwise(feeds))
    lang = F.when(e % 7 == 0, F.lit("fr")).otherwise(F.lit("en"))
    return ev.select(F.create_map(lang, F.struct(feeds.alias("feeds"))).alias("data"))


register("feed_discovery", with_views("""
SELECT 'en' AS language, f.name AS name, f.url AS url, NULL::VARCHAR AS error FROM (
  SELECT unnest([{'name': 'station_information', 'url': 'https://feeds.example/' || CAST(user_id AS VARCHAR) || '/station_information.json'},
                 {'name': 'station_status', 'url': 'https://feeds.example/' || CAST(user_id AS VARCHAR) || '/station_status.json'}]) AS f
  FROM events WHERE event_id % 7 <> 0 AND event_id % 11 <> 0 AND event_id % 13 <> 0 AND event_id % 17 <> 0)
UNION ALL SELECT 'en', NULL, NULL, CASE WHEN event_id % 7 = 0 THEN 'GBFS language "en" not found' WHEN event_id % 11 = 0 THEN 'GBFS feed station_status not found'
  ELSE 'GBFS feed station_information not found' END
FROM events WHERE event_id % 7 = 0 OR event_id % 11 = 0 OR event_id % 13 = 0 OR event_id % 17 = 0"""))(
    lambda spark, sf: N.feed_discovery(discovery(spark, sf), "en"))
