"""Structured Streaming operators for live participation messages."""

from tallyframe.streaming import live
from tallyframe.streaming.runner import StreamRun, run_available, source_stream, start_live

__all__ = ["live", "run_available", "source_stream", "start_live", "StreamRun"]
