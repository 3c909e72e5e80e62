"""Exactly-once incremental ingest on Structured Streaming."""
