"""Incremental ingestion with Structured Streaming."""

from rolecall.streaming.ingest import ingest_landed

__all__ = ["ingest_landed"]
