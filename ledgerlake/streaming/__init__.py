"""Structured Streaming ingest."""

from .ingest import append_new_keys, await_any, ingest_stream, ingest_topics

__all__ = ["append_new_keys", "await_any", "ingest_stream", "ingest_topics"]
