"""Structured Streaming: ingestion queries, sinks, lifecycle, guarantees."""
