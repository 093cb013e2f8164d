"""Structured Streaming ingest and windowed aggregates."""
