"""Readers: raw event files, JSON payloads, grouped-count text, driver tables."""

from clickpulse.sources.events import (
    coerce_defaults,
    decode_event_json,
    read_events_csv,
    read_events_json,
)
from clickpulse.sources.tables import (
    baskets_from_lineitem,
    events_from_tables,
    load_table,
    shop_events,
)
from clickpulse.sources.text import read_pair_text

__all__ = [
    "baskets_from_lineitem",
    "coerce_defaults",
    "decode_event_json",
    "events_from_tables",
    "load_table",
    "read_events_csv",
    "read_events_json",
    "read_pair_text",
    "shop_events",
]
