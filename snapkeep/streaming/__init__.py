"""Structured Streaming paths."""

from .latest import write_stream_latest
from .sink import read_stream_files, write_stream

__all__ = ["read_stream_files", "write_stream", "write_stream_latest"]
