"""Incremental file ingest and replay on Structured Streaming."""
