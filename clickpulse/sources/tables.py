"""Adapters from the driver's parquet tables to shop events and baskets.

``events(event_id, ts, user_id, event_type, value, props)`` carries no product,
brand or session, so a shop event is derived from it:

* product_id     = ``props.k`` (joined to ``part.p_partkey``)
* category_code  = ``lower(p_type) || '.' || p_name`` with spaces as ``_``
* brand          = ``p_brand``; price = ``value``
* event_type     = ``click`` read as ``cart``; other types unchanged
* user_session   = ``user_id || '-' || date``

``lineitem`` gives a second basket source: order = basket, part = product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, TimestampType

from clickpulse.plans.tuning import DEFAULT_BROADCAST_ROWS, dimension_side


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def product_dimension(part: DataFrame) -> DataFrame:
    """One row per product: id, category path, brand."""
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.concat(
            F.lower(F.col("p_type")), F.lit("."), F.regexp_replace(F.col("p_name"), " ", "_")
        ).alias("category_code"),
        F.col("p_brand").alias("brand"),
    )


def shop_events(
    events: DataFrame, part: DataFrame, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS
) -> DataFrame:
    """Driver events -> shop events (typed ``event_ts``, no text time).

    The product dimension is broadcast only when its row count is checked to
    be small; a large one is first cut to the products the events use (see
    :func:`clickpulse.plans.tuning.dimension_side`), so the events are not
    shuffled for the join.
    """
    ts = F.col("ts").cast(TimestampType())
    facts = events.select(
        F.col("event_id"),
        ts.alias("event_ts"),
        F.when(F.col("event_type") == "click", F.lit("cart"))
        .otherwise(F.col("event_type"))
        .alias("event_type"),
        F.get_json_object(F.col("props"), "$.k").cast(LongType()).alias("product_id"),
        F.col("value").alias("price"),
        F.col("user_id"),
        F.concat(
            F.col("user_id").cast("string"), F.lit("-"), F.to_date(ts).cast("string")
        ).alias("user_session"),
    )
    dim = dimension_side(product_dimension(part), facts, "product_id", max_broadcast_rows)
    joined = facts.join(dim, "product_id", "left")
    return joined.select(
        "event_id",
        "event_ts",
        "event_type",
        "product_id",
        F.lit(None).cast(LongType()).alias("category_id"),
        "category_code",
        "brand",
        "price",
        "user_id",
        "user_session",
    )


def events_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shop_events(load_table(spark, sf_dir, "events"), load_table(spark, sf_dir, "part"))


def baskets_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """(basket_id, product_id) rows; duplicates are kept (dedup is the operator's job)."""
    return lineitem.select(
        F.col("l_orderkey").alias("basket_id"), F.col("l_partkey").alias("product_id")
    )


def baskets_with_attributes(lineitem: DataFrame) -> DataFrame:
    """Baskets whose items are parts and, as items below zero, attributes of their lines.

    Attributes (return flag, line status, line number, quantity) stand in many
    baskets: frequent items beside rare ones, as categories or brands are beside
    products.
    """
    kinds = [
        F.col("l_partkey"),
        -1000 - F.ascii("l_returnflag"),
        -2000 - F.ascii("l_linestatus"),
        -3000 - F.col("l_linenumber"),
        -4000 - F.col("l_quantity"),
    ]
    items = F.explode(F.array(*[k.cast(LongType()) for k in kinds]))
    return lineitem.select(F.col("l_orderkey").alias("basket_id"), items.alias("product_id"))
