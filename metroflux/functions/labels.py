"""Display labels for sources, metrics, quality flags and sensors.

The lookups are literal ``CASE`` expressions over the fixed catalogues in
``schema`` (a dozen entries each), so they run inside codegen with no join.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema as S
from .text import lookup


def _lookup(c: Column, mapping: dict, fallback: Column) -> Column:
    return lookup(c, mapping, fallback)


def title_fallback(c: Column) -> Column:
    """Title case with spaces for underscores: every run of letters starts
    with a capital, also after a digit, dot or hyphen."""
    runs = F.regexp_extract_all(F.replace(c, F.lit("_"), F.lit(" ")), F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def source_label(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit("Unknown Source")).otherwise(
        _lookup(c, S.SOURCE_LABELS, title_fallback(c)))


def metric_label(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit("Unknown Metric")).otherwise(
        _lookup(c, S.METRIC_LABELS, title_fallback(c)))


def metric_group(c: Column) -> Column:
    return lookup(c, {m: g for g, ms in S.METRIC_DOMAINS.items() for m in ms}, F.lit("Other"))


def quality_label(c: Column) -> Column:
    return _lookup(c, S.QUALITY_LABELS, F.lit("Unknown"))


def sensor_display_name(sensor_id: Column, source: Column) -> Column:
    """Human name of a sensor by source (weather station, river gauge, bike
    station, air sensor, simulator), else the id itself."""
    sensor = F.coalesce(sensor_id, F.lit("unknown"))
    src = F.lower(F.coalesce(source, F.lit("")))
    return (F.when(src == "openmeteo", F.lit("Chicago Weather Station"))
            .when((src == "usgs") | sensor.startswith("USGS-"), F.lit("Chicago River at Columbus Drive"))
            .when((src == "gbfs") | sensor.startswith("GBFS-"),
                  F.concat(F.lit("Divvy Bike Station "), F.regexp_replace(sensor, "^GBFS-", "")))
            .when((src == "openaq") | sensor.startswith("OPENAQ-"),
                  F.concat(F.lit("OpenAQ Air Sensor "), F.regexp_replace(sensor, "^OPENAQ-", "")))
            .when(src == "simulator", F.concat(F.lit("City Sensor "), sensor))
            .otherwise(sensor))
