"""Structured Streaming form of the raw -> bronze ingest (incremental L1)."""
