"""Incremental (Structured Streaming) ingestion of source-grain facts."""
