"""Incremental file ingest on Structured Streaming."""
