"""Structured Streaming entry points for the loading strategies."""

from tableworks.streaming.loads import stream_load

__all__ = ["stream_load"]
