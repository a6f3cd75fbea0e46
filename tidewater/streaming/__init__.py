"""Streaming loads: the batch strategies applied per micro-batch."""

from tidewater.streaming.feed import stream_into

__all__ = ["stream_into"]
