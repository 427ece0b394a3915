"""Structured Streaming operators."""

from .mirror_stream import delta_stream, stream_mirror
from .poll import announce, poll_mirror

__all__ = ["announce", "delta_stream", "poll_mirror", "stream_mirror"]
