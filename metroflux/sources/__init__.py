"""Readers and writers: fixture views over the driver tables, landed JSON
payloads, the partitioned Parquet archive and media listings."""
