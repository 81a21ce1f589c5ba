"""Alert queries."""

from __future__ import annotations

import datetime as _dt

from ..operators import alerts as AL
from ..sources.fixtures import with_views
from . import sqlkit as Q
from .catalog import AS_OF, ASOF, IM, R, register

_END = _dt.datetime.fromisoformat(AS_OF)
_START, _EARLY = _END - _dt.timedelta(hours=24), _END - _dt.timedelta(hours=24, minutes=15)
START, EARLY, END = Q.ts(_START), Q.ts(_EARLY), Q.ts(_END)
LO15 = Q.ts(_END - _dt.timedelta(minutes=15))

register("alert_no_ingestion", with_views(f"""SELECT coalesce({Q.seconds_between(ASOF, 'max(ingested_at)')} / 60.0, 9999.0)
  AS value FROM sensor_readings WHERE ingested_at <= {ASOF}""", "sensor_readings"))(
    lambda spark, sf: AL.alert_no_ingestion(R(spark, sf), AS_OF))
register("alert_source_freshness", with_views(f"""SELECT coalesce(max(age), 9999.0) AS value FROM
  (SELECT {Q.seconds_between(ASOF, 'max(ingested_at)')} / 60.0 AS age FROM sensor_readings
   WHERE ingested_at <= {ASOF} GROUP BY source)""", "sensor_readings"))(
    lambda spark, sf: AL.alert_source_freshness(R(spark, sf), AS_OF))
register("alert_quality", with_views(f"""SELECT CAST(count(*) AS DOUBLE) AS value FROM sensor_readings
  WHERE ingested_at >= {LO15} AND ingested_at <= {ASOF} AND quality_flag <> 1""", "sensor_readings"))(
    lambda spark, sf: AL.alert_quality(R(spark, sf), AS_OF))
DROPPED_SQL = f"""SELECT CAST(coalesce(max(dropped_readings_total) - min(dropped_readings_total), 0) AS DOUBLE) AS value
  FROM ingestion_metrics WHERE recorded_at >= {{lo}} AND recorded_at <= {ASOF}"""
register("alert_dropped", with_views(DROPPED_SQL.format(lo=LO15), "ingestion_metrics"))(
    lambda spark, sf: AL.alert_dropped(IM(spark, sf), AS_OF))
# W7 over a one-day window: the counter's increase
register("dropped_increase", with_views(DROPPED_SQL.format(lo=Q.cutoff(24)).replace("AS value", "AS dropped_increase"),
                                         "ingestion_metrics"))(
    lambda spark, sf: AL.alert_dropped(IM(spark, sf), AS_OF, 24 * 60).withColumnRenamed("value", "dropped_increase"))

_AGE = lambda later, earlier: f"({Q.seconds_between(later, earlier)} / 60.0)"
_GREATEST = "CASE WHEN {a} IS NULL THEN {b} WHEN {b} IS NULL THEN {a} ELSE greatest({a}, {b}) END"
_TB = "time_bucket(INTERVAL '1 minute', {c}) + INTERVAL '1 minute'"
STATES_SQL = f"""
WITH grid AS (SELECT t FROM generate_series({START}, {END}, INTERVAL '1 minute') g(t)),
egrid AS (SELECT t FROM generate_series({EARLY}, {END}, INTERVAL '1 minute') g(t)),
recent AS (SELECT * FROM sensor_readings WHERE ingested_at >= {EARLY} AND ingested_at < {END}),
prior AS (SELECT max(ingested_at) AS p FROM sensor_readings WHERE ingested_at < {START}),
m1 AS (SELECT {_TB.format(c='ingested_at')} AS t, max(ingested_at) AS m FROM recent WHERE ingested_at >= {START} GROUP BY 1),
e1 AS (SELECT 'no_recent_ingestion' AS rule, t, coalesce({_AGE('t', 'last')}, 9999.0) AS value FROM
       (SELECT t, {_GREATEST.format(a='rm', b='p')} AS last FROM
          (SELECT grid.t, max(m) OVER (ORDER BY grid.t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rm
           FROM grid LEFT JOIN m1 USING (t)) CROSS JOIN prior)),
sources AS (SELECT DISTINCT source FROM sensor_readings WHERE ingested_at < {END}),
sprior AS (SELECT source, max(ingested_at) AS p FROM sensor_readings WHERE ingested_at < {START} GROUP BY source),
m2 AS (SELECT source, {_TB.format(c='ingested_at')} AS t, max(ingested_at) AS m FROM recent WHERE ingested_at >= {START} GROUP BY 1, 2),
s2 AS (SELECT s.source, g.t, max(m2.m) OVER (PARTITION BY s.source ORDER BY g.t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rm
       FROM sources s CROSS JOIN grid g LEFT JOIN m2 ON m2.source = s.source AND m2.t = g.t),
e2 AS (SELECT 'source_freshness' AS rule, t, coalesce(max({_AGE('t', _GREATEST.format(a='rm', b='p'))}), 9999.0) AS value
       FROM s2 LEFT JOIN sprior USING (source) GROUP BY t),
m3 AS (SELECT {_TB.format(c='ingested_at')} AS t, count(*) AS c FROM recent WHERE quality_flag <> 1 GROUP BY 1),
e3 AS (SELECT 'quality_exceptions' AS rule, t, value FROM
       (SELECT egrid.t, CAST(sum(coalesce(c, 0)) OVER (ORDER BY egrid.t ROWS BETWEEN 14 PRECEDING AND CURRENT ROW) AS DOUBLE) AS value
        FROM egrid LEFT JOIN m3 USING (t)) WHERE t >= {START}),
m4 AS (SELECT {_TB.format(c='recorded_at')} AS t, max(dropped_readings_total) AS hi, min(dropped_readings_total) AS lo
       FROM ingestion_metrics WHERE recorded_at >= {EARLY} AND recorded_at < {END} GROUP BY 1),
e4 AS (SELECT 'dropped_readings' AS rule, t, value FROM
       (SELECT egrid.t, CAST(coalesce(max(hi) OVER w - min(lo) OVER w, 0) AS DOUBLE) AS value
        FROM egrid LEFT JOIN m4 USING (t) WINDOW w AS (ORDER BY egrid.t ROWS BETWEEN 14 PRECEDING AND CURRENT ROW))
       WHERE t >= {START}),
rules AS (SELECT * FROM (VALUES {", ".join(f"('{r}', {th!r}, {h}, '{sev}')" for r, th, h, _, sev in AL.RULES)}) v(rule, threshold, hold, severity)),
v AS (SELECT * FROM (SELECT * FROM e1 UNION ALL SELECT * FROM e2 UNION ALL SELECT * FROM e3 UNION ALL SELECT * FROM e4)
      JOIN rules USING (rule)),
b AS (SELECT *, value > threshold AS breach,
             sum(CASE WHEN value > threshold THEN 0 ELSE 1 END) OVER (PARTITION BY rule ORDER BY t
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM v),
s AS (SELECT *, min(CASE WHEN breach THEN t END) OVER (PARTITION BY rule, island) AS breach_start FROM b)
SELECT rule, t AS eval_time, value,
  CASE WHEN NOT breach THEN 'normal' WHEN {_AGE('t', 'breach_start')} >= hold THEN 'firing' ELSE 'pending' END AS state,
  severity, value IS NULL AS no_data
FROM s"""
register("alert_states", with_views(STATES_SQL, "sensor_readings", "ingestion_metrics"))(
    lambda spark, sf: AL.alert_states(R(spark, sf), IM(spark, sf), AS_OF))
