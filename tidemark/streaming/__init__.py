"""Structured Streaming jobs: incremental ingest, medallion stages, stream dedup, stream expectations."""
