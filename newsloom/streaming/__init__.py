"""Structured Streaming jobs: incremental ingest and daily volumes."""
