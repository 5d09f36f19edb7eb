"""Structured Streaming jobs."""

from cubelake.streaming.delta_stream import current_table, delta_stream, ingest_and_merge, ingest_deltas  # noqa: F401
