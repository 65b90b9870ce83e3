"""Incremental ingest of daily drops (Structured Streaming)."""

from .drops import drops_stream, ingest_drops

__all__ = ["drops_stream", "ingest_drops"]
