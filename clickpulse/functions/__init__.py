"""Column expressions shared by the operators (all JVM-side built-ins)."""

from clickpulse.functions.exprs import (
    BATCH_TIME_FORMAT,
    EVENT_TYPES,
    STREAM_TIME_FORMAT,
    count_type,
    flag_type,
    label,
    lift,
    money,
    parse_event_time,
    revenue,
    root_category,
    safe_ratio,
)

__all__ = [
    "BATCH_TIME_FORMAT",
    "EVENT_TYPES",
    "STREAM_TIME_FORMAT",
    "count_type",
    "flag_type",
    "label",
    "lift",
    "money",
    "parse_event_time",
    "revenue",
    "root_category",
    "safe_ratio",
]
