"""Named queries over the driver's tables and their DuckDB oracles.

Each query is ``fn(spark, sf_dir) -> DataFrame`` and reads whole tables;
parameters (clock, window, thresholds) are the fixed values below so that
the Spark result and the oracle SQL describe the same question.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import schema as S
from ..sources import fixtures as FX
from . import sqlkit as Q

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AS_OF = FX.AS_OF
HOURS = FX.WINDOW_HOURS
STALE_HOURS = 24
ALL_METRICS = list(S.SUPPORTED_METRICS)


def register(name: str, sql: str | None = None):
    """Add ``fn`` to the catalogue under ``name`` (with its oracle SQL if given)."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def R(spark, sf):
    return FX.sensor_readings(spark, sf)


def IM(spark, sf):
    return FX.ingestion_metrics(spark, sf)


CUT = Q.cutoff(HOURS)
STALE_CUT = Q.cutoff(STALE_HOURS)
ASOF = Q.ts(AS_OF)

from . import q_reports  # noqa: E402,F401  (each module registers its queries)
from . import q_quality  # noqa: E402,F401
from . import q_normalize  # noqa: E402,F401
from . import q_safety  # noqa: E402,F401
from . import q_tables  # noqa: E402,F401
from . import q_messages  # noqa: E402,F401
from . import q_alerts  # noqa: E402,F401
from . import q_archive  # noqa: E402,F401
from . import q_stream  # noqa: E402,F401
from . import q_media_extra  # noqa: E402,F401
