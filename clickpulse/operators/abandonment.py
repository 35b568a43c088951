"""Cart abandonment: session flags, then a second aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.functions.exprs import flag_type, safe_ratio
from clickpulse.operators.live import dictionary, event_order


def session_flags(enriched: DataFrame, grain: str = "day_category") -> DataFrame:
    """has_cart / has_purchase per session.

    ``grain="day_category"`` (default, as the reference): key is
    (user_session, date, root_category), so a cart in one category and a
    purchase in another, or across midnight, counts as abandoned.
    ``grain="session"``: key is the session alone; the row is attributed to
    the date and root category of the session's first cart event.
    """
    if grain == "day_category":
        return enriched.groupBy("user_session", "date", "root_category").agg(
            flag_type("cart").alias("has_cart"), flag_type("purchase").alias("has_purchase")
        )
    if grain == "session":
        # fixed-width buffers only (hash aggregate): the first cart's order
        # key picks its date and its root category's dictionary id
        first_cart = F.when(F.col("event_type") == "cart", event_order(enriched))
        codes = dictionary(enriched, "root_category")
        flags = (
            enriched.join(codes, "root_category", "left")
            .groupBy("user_session")
            .agg(
                flag_type("cart").alias("has_cart"),
                flag_type("purchase").alias("has_purchase"),
                F.min_by("date", first_cart).alias("date"),
                F.min_by("_code", first_cart).alias("_code"),
            )
        )
        return flags.join(codes, "_code", "left").select(
            "user_session", "date", "root_category", "has_cart", "has_purchase"
        )
    raise ValueError(f"unknown grain {grain!r}")


def cart_abandonment(flags: DataFrame) -> DataFrame:
    """Per (date, category): sessions with a cart that did / did not buy."""
    carts = flags.filter(F.col("has_cart"))
    out = (
        carts.groupBy("date", "root_category")
        .agg(
            F.count_if(~F.col("has_purchase")).alias("abandoned_carts"),
            F.count_if(F.col("has_purchase")).alias("completed_purchases"),
        )
        .withColumnRenamed("root_category", "category")
    )
    return out.withColumn(
        "abandonment_rate",
        safe_ratio("abandoned_carts", F.col("abandoned_carts") + F.col("completed_purchases")),
    )
