"""metroflux: city sensor telemetry analytics on Spark DataFrames.

Sub-packages
------------
sources    readers/writers: fixture views, landed JSON payloads, archive, media listings
functions  column-level helpers (time buckets, text cleaning, keys, labels)
operators  DataFrame -> DataFrame operators: validation, normalisation, reports,
           keyed merges, alerts, media safety, sampling
plans      the query catalogue used by ``__spark_entry__`` and its DuckDB oracles
streaming  Structured Streaming jobs (ingest, hourly rollup, dedup, notifications)
"""

__all__ = ["session"]
