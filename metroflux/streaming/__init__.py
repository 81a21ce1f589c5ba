"""Structured Streaming jobs (T1-T10): continuous ingest with dead-lettering
and idempotent upserts, bounded consume, watermarked hourly rollup,
streaming dedup, media notifications, and progress-derived throughput."""
