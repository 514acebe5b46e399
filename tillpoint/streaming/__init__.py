"""Incremental ingest of CSV drops with Structured Streaming."""

from tillpoint.streaming.ingest import ingest_stream

__all__ = ["ingest_stream"]
