"""Time helpers: literals typed like the data, buckets, ages, labels."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ts_type(df: DataFrame, column: str) -> T.DataType:
    return df.schema[column].dataType


def ts_lit(value, like: T.DataType | None = None) -> Column:
    """A timestamp literal of the same flavour (LTZ/NTZ) as the column it is
    compared with, so the comparison needs no cast and reaches the scan."""
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    kind = "timestamp_ntz" if isinstance(like, T.TimestampNTZType) else "timestamp"
    return F.lit(str(value)).cast(kind)


def hours_before(as_of, hours: float, like: T.DataType | None = None) -> Column:
    """``as_of - hours`` as a literal of the column's timestamp flavour."""
    if isinstance(as_of, Column):
        return as_of - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(float(hours) * 3600))
    if not isinstance(as_of, _dt.datetime):
        as_of = _dt.datetime.fromisoformat(str(as_of))
    return ts_lit(as_of - _dt.timedelta(hours=hours), like)


def time_bucket(col: str | Column, every: str) -> Column:
    """Start of the tumbling bucket (epoch-aligned), keeps the input type.

    ``window(...)`` on a tumbling duration is a pure projection (no Expand)."""
    return F.window(col, every).start


def epoch_seconds(col: str | Column) -> Column:
    """Seconds since epoch as double (microsecond precision) for LTZ or NTZ."""
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_micros(c.cast("timestamp")) / F.lit(1_000_000.0)


def seconds_between(later: str | Column, earlier: str | Column) -> Column:
    return epoch_seconds(later) - epoch_seconds(earlier)


def freshness_label(latest: str | Column, as_of: Column) -> Column:
    """No data / Live / n min ago / n hr ago / n days ago; negative age -> 0."""
    latest_c = F.col(latest) if isinstance(latest, str) else latest
    age = F.greatest(F.lit(0.0), seconds_between(as_of, latest_c))
    return (F.when(latest_c.isNull(), F.lit("No data"))
            .when(age < 90, F.lit("Live"))
            .when(age < 3600, F.concat(F.floor(age / 60).cast("string"), F.lit(" min ago")))
            .when(age < 86400, F.concat(F.floor(age / 3600).cast("string"), F.lit(" hr ago")))
            .otherwise(F.concat(F.floor(age / 86400).cast("string"), F.lit(" days ago"))))


def rfc3339_nano(col: str | Column) -> Column:
    """Go ``RFC3339Nano`` text of a UTC timestamp: trailing zero fraction trimmed."""
    c = F.col(col) if isinstance(col, str) else col
    frac = F.regexp_replace(F.date_format(c, ".SSSSSS"), r"\.?0+$", "")
    return F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), frac, F.lit("Z"))
