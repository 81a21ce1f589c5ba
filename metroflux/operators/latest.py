"""Latest-value operators (W1-W3), display projection (P13) and small
top-k / filter views over them (P5, L4, P12).

Latest-per-key uses ``max_by`` over a (time, tie-break) struct: it is an
ordinary partial aggregate, so each task keeps one row per key before the
shuffle instead of sorting every reading of a key (which a
``row_number`` window would do, and which a hot key would turn into one
huge sorted partition).
"""

from __future__ import annotations

import math
from decimal import ROUND_CEILING, ROUND_FLOOR, Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import labels as L
from .reports import scoped

LATEST_COLUMNS = ["time", "sensor_id", "source", "metric", "value", "unit",
                  "latitude", "longitude", "quality_flag", "ingested_at"]


def latest_by_key(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """One row per ``keys``: the row with the greatest ``order`` struct."""
    payload = [c for c in columns if c not in keys]
    pick = F.max_by(F.struct(*payload), F.struct(*order)).alias("_l")
    return df.groupBy(*keys).agg(pick).select(*keys, *[F.col("_l." + c).alias(c) for c in payload])


def latest_readings(readings: DataFrame, as_of, hours: float = 24, source: str | None = None,
                    metrics: list[str] | None = None) -> DataFrame:
    """Latest row per (sensor_id, metric) in the window; ties on time are
    broken by ingested_at then source (total order)."""
    scope = scoped(readings, as_of, hours, source, metrics if metrics else None)
    out = latest_by_key(scope, ["sensor_id", "metric"], ["time", "ingested_at", "source"], LATEST_COLUMNS)
    return out.select("time", "sensor_id", "source", "metric", F.col("value").cast("double").alias("value"),
                      "unit", F.col("latitude").cast("double").alias("latitude"),
                      F.col("longitude").cast("double").alias("longitude"), "quality_flag", "ingested_at")


def domain_latest(readings: DataFrame, domain_metrics: list[str], as_of, hours: float = 24) -> DataFrame:
    """Latest readings for one domain's metric list (empty list -> empty)."""
    if not domain_metrics:
        return latest_readings(readings, as_of, hours).limit(0)
    return latest_readings(readings, as_of, hours, metrics=domain_metrics)


def display_columns(df: DataFrame, station_names: DataFrame | None = None) -> DataFrame:
    """source_name, metric_name, metric_group, quality, sensor_name.

    ``station_names`` (station_id, name) is the bike-share dimension (S19);
    its size is not bounded by contract, so the join is left to AQE, which
    broadcasts it at runtime only when it is measured small."""
    out = df
    cols = set(df.columns)
    if "source" in cols:
        out = out.withColumn("source_name", L.source_label(F.col("source")))
    if "metric" in cols:
        out = out.withColumn("metric_name", L.metric_label(F.col("metric")))
        out = out.withColumn("metric_group", L.metric_group(F.col("metric")))
    if "quality_flag" in cols:
        out = out.withColumn("quality", L.quality_label(F.col("quality_flag")))
    if {"sensor_id", "source"} <= cols:
        name = L.sensor_display_name(F.col("sensor_id"), F.col("source"))
        if station_names is not None:
            st = station_names.select(F.col("station_id").alias("_sid"), F.col("name").alias("_sname"))
            is_bike = (F.lower(F.col("source")) == "gbfs") | F.col("sensor_id").startswith("GBFS-")
            out = out.join(st, F.regexp_replace(F.col("sensor_id"), "^GBFS-", "") == F.col("_sid"), "left")
            name = F.when(is_bike & F.col("_sname").isNotNull(), F.col("_sname")).otherwise(name)
            out = out.withColumn("sensor_name", name).drop("_sid", "_sname")
        else:
            out = out.withColumn("sensor_name", name)
    return out


def filtered_latest(latest: DataFrame, quality: str | None = None, source: str | None = None) -> DataFrame:
    """P5: frame filter by quality label and source."""
    out = display_columns(latest)
    if quality:
        out = out.filter(F.col("quality") == quality)
    if source:
        out = out.filter(F.col("source") == source)
    return out


def top_latest(latest: DataFrame, n: int = 12) -> DataFrame:
    """L4: the n largest latest values (top-k report; TakeOrdered)."""
    return latest.orderBy(F.desc("value"), "sensor_id", "metric").limit(n)


def quality_exceptions(readings: DataFrame, as_of, hours: float = 24) -> DataFrame:
    """Readings whose quality flag is not Valid."""
    return scoped(readings, as_of, hours).filter(F.col("quality_flag") != 1)


EARTH_RADIUS_M = 6_371_000.0
MAX_RADIUS_M = 25_000


def circle_cover(lat: float, lon: float, radius_m: float) -> tuple[tuple[float, float], list[tuple[float, float]]]:
    """(latitude range, longitude ranges) that hold every point of a circle,
    a little wider than it: two ranges where it crosses 180 degrees, none
    where it holds a pole (every longitude is near)."""
    slack = 1e-6
    angle = radius_m / EARTH_RADIUS_M
    dlat = math.degrees(angle) + slack
    south, north = lat - dlat, lat + dlat
    if south <= -90 or north >= 90:
        return (max(south, -90.0), min(north, 90.0)), []
    # the widest longitude of a circle is reached a little towards the pole
    dlon = math.degrees(math.asin(min(1.0, math.sin(angle) / math.cos(math.radians(lat))))) + slack
    west, east = lon - dlon, lon + dlon
    if west < -180:
        return (south, north), [(west + 360, 180.0), (-180.0, east)]
    if east > 180:
        return (south, north), [(west, 180.0), (-180.0, east - 360)]
    return (south, north), [(west, east)]


def _between(df: DataFrame, column: str, low: float, high: float) -> Column:
    """low <= column <= high by literals of the column's type (decimals are
    rounded outwards)."""
    kind = df.schema[column].dataType
    if not isinstance(kind, T.DecimalType):
        return (F.col(column) >= F.lit(low)) & (F.col(column) <= F.lit(high))
    step = Decimal(1).scaleb(-kind.scale)
    bounds = [Decimal(repr(x)).quantize(step, rounding=r) for x, r in ((low, ROUND_FLOOR), (high, ROUND_CEILING))]
    return (F.col(column) >= F.lit(bounds[0]).cast(kind)) & (F.col(column) <= F.lit(bounds[1]).cast(kind))


def within_radius(points: DataFrame, lat: float, lon: float, radius_m: float, limit: int | None = None) -> DataFrame:
    """Points within ``radius_m`` of (lat, lon), nearest first.

    The ranges of ``circle_cover`` are compared with the plain columns, as
    literals of the columns' own type, so that they reach the scan; the exact
    haversine distance is then a codegen expression."""
    if not 1 <= radius_m <= MAX_RADIUS_M:
        raise ValueError(f"radius must be between 1 and {MAX_RADIUS_M} m, not {radius_m}")
    (south, north), longitudes = circle_cover(lat, lon, radius_m)
    la, lo = F.col("latitude").cast("double"), F.col("longitude").cast("double")
    box = _between(points, "latitude", south, north)
    if longitudes:
        box = box & reduce(lambda a, b: a | b, [_between(points, "longitude", west, east) for west, east in longitudes])
    p1, p2 = F.radians(F.lit(lat)), F.radians(la)
    a = (F.pow(F.sin((p2 - p1) / 2), 2)
         + F.cos(p1) * F.cos(p2) * F.pow(F.sin((F.radians(lo) - F.radians(F.lit(lon))) / 2), 2))
    dist = F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(a))
    out = (points.filter(box).withColumn("distance_m", F.round(dist, 3))
           .filter(F.col("distance_m") <= radius_m))
    out = out.orderBy("distance_m", *[c for c in ("sensor_id", "metric") if c in points.columns])
    return out.limit(limit) if limit else out
