"""Incremental ingestion of landed feed pages with Structured Streaming."""
