"""Batch lakehouse analytics on Spark: ingest, clean, upsert, version, and build a star schema."""
