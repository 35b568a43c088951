"""Column expressions: time parsing, category root, indicators, ratios.

All of these are built-in Catalyst expressions, so they stay inside
whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType

# Fixed values that must equal the reference's for the same results:
# the batch CSV time text, the stream JSON time text, and the three event
# types the KPIs recognise (any other type counts only in total_events).
BATCH_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss 'UTC'"
STREAM_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
EVENT_TYPES = ("view", "cart", "purchase")
UNKNOWN_CATEGORY = "unknown"

# Money is summed exactly, so that a sum does not depend on the order of its
# rows, unlike a double sum. Prices keep six decimals; only the
# serving tables round to cents.
MONEY_TYPE = DecimalType(28, 6)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_event_time(
    c: Column | str, formats: Iterable[str] = (BATCH_TIME_FORMAT,)
) -> Column:
    """Text -> timestamp; the first format that parses wins, junk gives null.

    ``try_to_timestamp`` keeps the PERMISSIVE behaviour under ANSI mode,
    where ``to_timestamp`` would fail the whole job on one bad row.
    """
    parsed = [F.try_to_timestamp(_col(c), F.lit(fmt)) for fmt in formats]
    return parsed[0] if len(parsed) == 1 else F.coalesce(*parsed)


def root_category(c: Column | str) -> Column:
    """First dot-separated segment of a category path; null -> ``unknown``.

    ``""`` and ``".x"`` give ``""`` (kept as-is, like the split-and-index form).
    """
    code = _col(c)
    return F.when(code.isNotNull(), F.substring_index(code, ".", 1)).otherwise(
        F.lit(UNKNOWN_CATEGORY)
    )


def is_type(event_type: Column | str, name: str) -> Column:
    """Boolean, never null: a null event type is simply not ``name``."""
    return F.coalesce(_col(event_type) == F.lit(name), F.lit(False))


def count_type(name: str, event_type: Column | str = "event_type") -> Column:
    """Number of rows of one event type (aggregate, bigint, 0 when none)."""
    return F.count_if(is_type(event_type, name))


def flag_type(name: str, event_type: Column | str = "event_type") -> Column:
    """Whether any row of the group has this event type (aggregate)."""
    return F.bool_or(is_type(event_type, name))


def money(c: Column | str) -> Column:
    """Price as an exact decimal. NaN, infinities and prices of 10**22 and more
    are no amounts: they become null and add nothing to a sum."""
    return _col(c).try_cast(MONEY_TYPE)


def revenue(
    price: Column | str = "price", event_type: Column | str = "event_type"
) -> Column:
    """Sum of purchase prices as a decimal (aggregate); 0 when no purchase."""
    return F.sum(
        F.when(is_type(event_type, "purchase"), money(price)).otherwise(
            F.lit(0).cast(MONEY_TYPE)
        )
    )


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den`` as a double when ``den > 0``, else 0.0 (never null)."""
    n, d = _col(num), _col(den)
    return F.when(d > 0, n.cast(DoubleType()) / d.cast(DoubleType())).otherwise(
        F.lit(0.0)
    )


def lift(
    co: Column | str, total: Column | str, count_a: Column | str, count_b: Column | str
) -> Column:
    """co * N / (count_a * count_b), in doubles so large counts cannot overflow."""
    return (_col(co).cast(DoubleType()) * _col(total).cast(DoubleType())) / (
        _col(count_a).cast(DoubleType()) * _col(count_b).cast(DoubleType())
    )


def label(c: Column | str) -> Column:
    """Null text shown as ``""`` (read side only)."""
    return F.coalesce(_col(c), F.lit(""))
