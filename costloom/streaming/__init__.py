"""Structured Streaming: ingest, append flows and change-data-capture flows."""
