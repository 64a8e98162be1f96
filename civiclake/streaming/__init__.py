"""Incremental ingestion of landed files (Structured Streaming, availableNow)."""

from civiclake.streaming.bronze import ingest_landed, read_bronze  # noqa: F401
