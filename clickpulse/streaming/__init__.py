"""Structured Streaming: event sources, live session state, upsert sink."""

from clickpulse.streaming.live import (
    compact_live_table,
    event_stream_files,
    event_stream_kafka,
    live_session_stream,
    live_session_windows,
    read_live_table,
    replace_table_jdbc,
    run_live_sessions_once,
    start_live_sessions,
    upsert_by_epoch,
)

__all__ = [
    "compact_live_table",
    "event_stream_files",
    "event_stream_kafka",
    "live_session_stream",
    "live_session_windows",
    "read_live_table",
    "replace_table_jdbc",
    "run_live_sessions_once",
    "start_live_sessions",
    "upsert_by_epoch",
]
