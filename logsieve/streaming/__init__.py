"""Structured Streaming forms of the window detectors, the missing-user filter
and the search for slow attacks."""

from logsieve.streaming.detectors import (
    late_rows,
    prepare_stream,
    read_log_stream,
    start_detectors,
    stream_tables,
)
from logsieve.streaming.sessions import stream_slow_attacks

__all__ = ["late_rows", "prepare_stream", "read_log_stream", "start_detectors", "stream_slow_attacks", "stream_tables"]
