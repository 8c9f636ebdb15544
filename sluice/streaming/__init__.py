"""Structured Streaming: incremental SQL-dump ingest."""
