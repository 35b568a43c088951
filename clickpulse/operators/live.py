"""Per-session live state (ST1), one definition for batch and stream.

``first``/``last`` in arrival order are replaced by ``min_by``/``max_by`` on
(event time, tiebreak): the result no longer depends on file or partition
order (SURVEY T10).

Plan at scale: every aggregate buffer is fixed-width, so Spark picks a hash
aggregate with a map-side partial step (a text or struct buffer would force a
sort-based aggregate: two full sorts of all events). The (time, tiebreak)
ordering is packed into one ``decimal(38,0)``; text outputs (the category of
the last event) are aggregated as dictionary ids and decoded after grouping.
The dictionary is the distinct values (small), checkpointed and broadcast
behind a row-count check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from clickpulse.functions.exprs import flag_type
from clickpulse.plans.tuning import DEFAULT_BROADCAST_ROWS, small_side

ORDER_TYPE = DecimalType(38, 0)
# Packing: (micros + 1e17) * 1e20 + (tiebreak + 2^63) < 1e38 for any long
# tiebreak and any time between years -1200 and 5100.
_TS_SHIFT = "100000000000000000"
_SCALE = "100000000000000000000"
_TB_SHIFT = "9223372036854775808"
TIEBREAK_FALLBACK = ("product_id", "event_type", "category_code", "brand", "price", "user_id")


def _dec(text: str) -> Column:
    return F.lit(text).cast(ORDER_TYPE)


def event_order(df: DataFrame, tiebreak: str | None = None) -> Column:
    """One fixed-width sort key: event time, then a long tiebreak.

    The tiebreak is ``event_id`` when present, else a hash of the event's
    fields (equal only for identical events, where either choice gives the
    same answer). Rows without a time come before all others.
    """
    if tiebreak is not None:
        tb = F.col(tiebreak).cast("long")
    elif "event_id" in df.columns:
        tb = F.col("event_id").cast("long")
    else:
        tb = F.xxhash64(*[F.col(c) for c in TIEBREAK_FALLBACK if c in df.columns])
    micros = F.unix_micros(F.col("event_ts").cast("timestamp"))
    time = F.coalesce(micros.cast(ORDER_TYPE) + _dec(_TS_SHIFT), _dec("0"))
    return time * _dec(_SCALE) + (tb.cast(ORDER_TYPE) + _dec(_TB_SHIFT))


def dictionary(df: DataFrame, col: str, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Distinct non-null values of ``col`` with a unique long ``_code``.

    Ids come from ``monotonically_increasing_id`` and are fixed by a reliable
    checkpoint; the frame is broadcast only when counted under ``max_rows``.
    """
    values = df.select(col).where(F.col(col).isNotNull()).distinct()
    return small_side(values.withColumn("_code", F.monotonically_increasing_id()), max_rows)


def _measures(order: Column, last_category: Column) -> list[Column]:
    return [
        F.min_by("user_id", order).alias("user_id"),
        F.max("event_ts").alias("last_event_time"),
        F.count(F.lit(1)).alias("event_count"),
        flag_type("cart").alias("has_cart"),
        flag_type("purchase").alias("has_purchase"),
        F.max_by("product_id", order).alias("last_product_id"),
        F.max_by(last_category, order).alias("last_category"),
    ]


def session_state(enriched: DataFrame, tiebreak: str | None = None) -> DataFrame:
    """session_id, user_id (of the first event), last_event_time, event_count,
    has_cart, has_purchase, last_product_id, last_category (raw path).

    Batch: hash aggregate over fixed-width buffers (see module notes).
    Stream: the same measures on the category text directly; a micro-batch is
    small and the state store keeps one row per session either way.
    """
    order = event_order(enriched, tiebreak)
    key = F.col("user_session").alias("session_id")
    if enriched.isStreaming:
        return enriched.groupBy(key).agg(*_measures(order, F.col("category_code")))
    codes = dictionary(enriched, "category_code")
    coded = enriched.join(codes, "category_code", "left")
    state = coded.groupBy(key).agg(*_measures(order, F.col("_code")))
    names = codes.select(F.col("_code").alias("last_category"), F.col("category_code").alias("_text"))
    decoded = state.join(names, "last_category", "left")
    return decoded.select(
        "session_id",
        "user_id",
        "last_event_time",
        "event_count",
        "has_cart",
        "has_purchase",
        "last_product_id",
        F.col("_text").alias("last_category"),
    )


def session_window_state(
    enriched: DataFrame, gap: str = "30 minutes", tiebreak: str | None = None
) -> DataFrame:
    """Same measures per (session id, activity window): a window closes after
    ``gap`` without events. In a stream with a watermark the closed windows
    are final and their state is dropped (ST6); in batch it is a plain
    sessionization (session windows are merged over sorted input anyway)."""
    order = event_order(enriched, tiebreak)
    grouped = enriched.groupBy(
        F.col("user_session").alias("session_id"), F.session_window("event_ts", gap).alias("window")
    ).agg(*_measures(order, F.col("category_code")))
    return grouped.select(
        "session_id",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *[c for c in grouped.columns if c not in ("session_id", "window")],
    )


def live_sessions(enriched: DataFrame, tiebreak: str | None = None) -> DataFrame:
    """``session_state`` plus the processing-time stamp ``updated_at``."""
    return session_state(enriched, tiebreak).withColumn("updated_at", F.current_timestamp())
