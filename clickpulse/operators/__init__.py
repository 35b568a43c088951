"""DataFrame -> DataFrame operators."""

from clickpulse.operators.abandonment import cart_abandonment, session_flags
from clickpulse.operators.affinity import (
    affinity_scores,
    co_occurrence,
    distinct_sessions,
    product_affinity,
    product_session_counts,
    session_products,
    top_pairs,
)
from clickpulse.operators.enrich import enrich
from clickpulse.operators.live import live_sessions, session_state
from clickpulse.operators.metrics import (
    brand_price_rows,
    brand_revenue,
    brand_stats,
    category_event_rows,
    category_events,
    category_stats,
    daily_metrics,
    funnel_stats,
    product_stats,
)
from clickpulse.operators.sampling import row_sample, session_sample

__all__ = [
    "affinity_scores",
    "brand_price_rows",
    "brand_revenue",
    "brand_stats",
    "cart_abandonment",
    "category_event_rows",
    "category_events",
    "category_stats",
    "co_occurrence",
    "daily_metrics",
    "distinct_sessions",
    "enrich",
    "funnel_stats",
    "live_sessions",
    "product_affinity",
    "product_session_counts",
    "product_stats",
    "row_sample",
    "session_flags",
    "session_products",
    "session_sample",
    "session_state",
    "top_pairs",
]
