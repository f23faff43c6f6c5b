"""Structured Streaming entry points (incremental filing ingest)."""
