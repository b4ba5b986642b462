"""Incremental ingest: the ``stream`` dataset type."""

from layerline.streaming.ingest import read_stream, resolve_stream, write_stream

__all__ = ["read_stream", "resolve_stream", "write_stream"]
