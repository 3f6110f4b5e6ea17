"""Structured Streaming ingestion and the incremental rebuild that follows it."""
