"""Structured Streaming ingest of telemetry files."""

from yieldmill.streaming.ingest import (
    BY_BATCH,
    STREAM_BATCH,
    archive_options,
    stream_append,
    stream_json,
    stream_text,
)

__all__ = ["BY_BATCH", "STREAM_BATCH", "archive_options", "stream_append", "stream_json", "stream_text"]
