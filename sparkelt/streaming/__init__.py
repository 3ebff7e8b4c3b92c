"""Structured Streaming: the ingest job, its sinks, and publishing."""
