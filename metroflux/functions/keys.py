"""Record keys and paths: dedup key (V4) and archive partition path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_, partition_value
from .timefn import rfc3339_nano


def dedup_key(sensor_id="sensor_id", time="time", metric="metric") -> Column:
    """``sensor|RFC3339Nano(UTC)|metric``."""
    return F.concat_ws("|", col_(sensor_id), rfc3339_nano(col_(time)), col_(metric))


def partition_path(source="source", metric="metric", time="time") -> Column:
    """``source=<s>/metric=<m>/year=YYYY/month=MM/day=DD`` (UTC date)."""
    t = col_(time)
    return F.concat(F.lit("source="), partition_value(source), F.lit("/metric="), partition_value(metric),
                    F.lit("/year="), F.date_format(t, "yyyy"), F.lit("/month="), F.date_format(t, "MM"),
                    F.lit("/day="), F.date_format(t, "dd"))
