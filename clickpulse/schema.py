"""The raw event schema and the serving-table column types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Fixed field list of a raw shop event (CSV header order), all nullable.
EVENT_SCHEMA = StructType(
    [
        StructField("event_time", StringType(), True),
        StructField("event_type", StringType(), True),
        StructField("product_id", LongType(), True),
        StructField("category_id", LongType(), True),
        StructField("category_code", StringType(), True),
        StructField("brand", StringType(), True),
        StructField("price", DoubleType(), True),
        StructField("user_id", LongType(), True),
        StructField("user_session", StringType(), True),
    ]
)

EVENT_COLUMNS = [f.name for f in EVENT_SCHEMA.fields]


def _num(p: int, s: int) -> DecimalType:
    return DecimalType(p, s)


# Column types of the ten serving tables, as the result store declares them.
SERVING_TYPES: dict[str, dict[str, DataType]] = {
    "daily_metrics": {
        "date": DateType(),
        "total_events": LongType(),
        "unique_users": LongType(),
        "total_views": LongType(),
        "total_carts": LongType(),
        "total_purchases": LongType(),
        "total_revenue": _num(14, 2),
        "conversion_rate": _num(6, 4),
        "avg_order_value": _num(10, 2),
    },
    "funnel_stats": {
        "date": DateType(),
        "category": StringType(),
        "views": LongType(),
        "carts": LongType(),
        "purchases": LongType(),
        "view_to_cart_rate": _num(6, 4),
        "cart_to_purchase_rate": _num(6, 4),
    },
    "top_products": {
        "product_id": LongType(),
        "category": StringType(),
        "brand": StringType(),
        "price": _num(10, 2),
        "views": LongType(),
        "carts": LongType(),
        "purchases": LongType(),
        "revenue": _num(14, 2),
    },
    "top_categories": {
        "category": StringType(),
        "views": LongType(),
        "carts": LongType(),
        "purchases": LongType(),
        "revenue": _num(14, 2),
    },
    "top_brands": {
        "brand": StringType(),
        "views": LongType(),
        "carts": LongType(),
        "purchases": LongType(),
        "revenue": _num(14, 2),
    },
    "cart_abandonment": {
        "date": DateType(),
        "category": StringType(),
        "abandoned_carts": LongType(),
        "completed_purchases": LongType(),
        "abandonment_rate": _num(6, 4),
    },
    "product_affinity": {
        "product_a": LongType(),
        "product_b": LongType(),
        "co_occurrences": LongType(),
        "lift": _num(8, 4),
    },
    "category_events": {
        "category": StringType(),
        "event_type": StringType(),
        "event_count": LongType(),
    },
    "brand_revenue": {
        "brand": StringType(),
        "total_revenue": _num(14, 2),
        "purchase_count": LongType(),
    },
    "live_sessions": {
        "session_id": StringType(),
        "user_id": LongType(),
        "last_event_time": TimestampType(),
        "event_count": IntegerType(),
        "has_cart": BooleanType(),
        "has_purchase": BooleanType(),
        "last_product_id": LongType(),
        "last_category": StringType(),
        "updated_at": TimestampType(),
    },
}


# Wider types where a valid result can exceed the declared one, so that no cast fails:
# a rate counts events per user or per view and has no upper bound of 99; a pair seen
# once has a lift of as many as there are sessions; sums and single prices have no
# bound either; a bot's session can exceed 2**31 events.
WIDER_TYPES: dict[str, dict[str, DataType]] = {
    "daily_metrics": {"total_revenue": _num(38, 2), "conversion_rate": _num(24, 4), "avg_order_value": _num(28, 2)},
    "funnel_stats": {"view_to_cart_rate": _num(24, 4), "cart_to_purchase_rate": _num(24, 4)},
    "top_products": {"price": _num(28, 2), "revenue": _num(38, 2)},
    "top_categories": {"revenue": _num(38, 2)},
    "top_brands": {"revenue": _num(38, 2)},
    "product_affinity": {"lift": _num(24, 4)},
    "brand_revenue": {"total_revenue": _num(38, 2)},
    "live_sessions": {"event_count": LongType()},
}


def serving_types(table: str) -> dict[str, DataType]:
    """Types that ``conform`` casts to: as declared, or wider where a result can exceed that."""
    return SERVING_TYPES[table] | WIDER_TYPES.get(table, {})


def conform(df: DataFrame, table: str) -> DataFrame:
    """Cast a result to its serving types (rates to four decimals, money to cents).

    Columns the table does not declare are kept unchanged, in order. A price
    that is no amount (NaN, infinite) becomes null.
    """
    types = serving_types(table)
    return df.select(
        *[
            F.col(name).try_cast(types[name]).alias(name) if name in types else F.col(name)
            for name in df.columns
        ]
    )
