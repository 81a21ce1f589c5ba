"""Small SQL text helpers for the DuckDB oracles.

Spark averages exact decimals exactly (``avg(decimal(p,s))`` is
``decimal(p+4,s+4)``, HALF_UP) while DuckDB averages them as doubles; the
oracle restates Spark's exact rule with integer arithmetic so both engines
produce the same double.
"""

from __future__ import annotations

import datetime as _dt  # noqa: F401  (re-exported for query modules)

from ..sources.fixtures import AS_OF


def ts(value: str | _dt.datetime) -> str:
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return f"TIMESTAMP '{value}'"


def cutoff(hours: float, as_of: str = AS_OF) -> str:
    t = _dt.datetime.fromisoformat(as_of) - _dt.timedelta(hours=hours)
    return ts(t)


def avg_exact(expr: str, scale: int, out_scale: int | None = None) -> str:
    """Exact average of a DECIMAL(…, scale) column as Spark computes it, then
    as DOUBLE. ``out_scale`` defaults to scale + 4 (Spark's avg result)."""
    out = scale + 4 if out_scale is None else out_scale
    s = f"CAST(SUM({expr}) * {10 ** scale} AS HUGEINT)"
    c = f"COUNT({expr})"
    mul = 10 ** (out - scale)
    if out >= scale:
        num_pos = f"(2 * {s} * {mul} + {c})"
        num_neg = f"(2 * (-{s}) * {mul} + {c})"
        den = f"(2 * {c})"
    else:
        div = 10 ** (scale - out)
        num_pos = f"(2 * {s} + {c} * {div})"
        num_neg = f"(2 * (-{s}) + {c} * {div})"
        den = f"(2 * {c} * {div})"
    q = f"CASE WHEN {s} >= 0 THEN {num_pos} // {den} ELSE -({num_neg} // {den}) END"
    return f"(CAST({q} AS DOUBLE) / {float(10 ** out)!r})"


def valid_pct(flag: str = "quality_flag") -> str:
    return (f"COALESCE(CAST(100.0 * SUM(CASE WHEN {flag} = 1 THEN 1 ELSE 0 END) AS DOUBLE)"
            f" / NULLIF(COUNT(*), 0), 0.0)")


def epoch_us(expr: str) -> str:
    return f"epoch_us({expr})"


def seconds_between(later: str, earlier: str) -> str:
    return f"(CAST({epoch_us(later)} AS DOUBLE) / 1000000.0 - CAST({epoch_us(earlier)} AS DOUBLE) / 1000000.0)"


def in_list(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"
