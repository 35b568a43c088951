"""Base cube: one aggregation pass shared by the additive roll-ups.

``base_cube`` groups the enriched events once by (date, product, category
path, root category, brand, price, event type) into an event count ``n`` and
an exact revenue ``amount``. Every additive output (A1 except distinct users,
A2-A5, A12, A13) is then a small roll-up of the cube instead of another scan
of the events. It pays off where a product's price is stable (the cube is
then about dates x products x types, far smaller than the events); where the
price changes per event the cube does not shrink, so the batch job uses it
only on request.

All rows of one cube cell share the price, so "price is not a finite
number" holds for the whole cell and the roll-ups keep the direct forms'
null handling exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.functions.exprs import MONEY_TYPE, money, safe_ratio

CUBE_KEYS = ["date", "product_id", "category_code", "root_category", "brand", "price", "event_type"]


def base_cube(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy(*CUBE_KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.sum(money("price")).alias("amount")
    )


COARSE_KEYS = ["date", "root_category", "brand", "event_type"]


def coarse_cube(enriched: DataFrame) -> DataFrame:
    """Counts and amounts without the product grain: small whatever prices do.

    One scan of the events; daily KPIs (save distinct users), categories,
    brands, funnel and both grouped counts are roll-ups of it.
    """
    return enriched.groupBy(*COARSE_KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.count(money("price")).alias("n_priced"), F.sum(money("price")).alias("amount")
    )


def _n_of(event_type: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col("event_type") == event_type, F.col("n"))), F.lit(0)).cast("bigint")


def _revenue() -> Column:
    return F.sum(
        F.when(F.col("event_type") == "purchase", F.col("amount")).otherwise(F.lit(0).cast(MONEY_TYPE))
    )


def _measures() -> list[Column]:
    return [
        _n_of("view").alias("views"),
        _n_of("cart").alias("carts"),
        _n_of("purchase").alias("purchases"),
        _revenue().alias("revenue"),
    ]


def daily_from_cube(cube: DataFrame, enriched: DataFrame) -> DataFrame:
    """Daily KPIs; distinct users come from the events (not additive)."""
    counts = cube.groupBy("date").agg(
        F.sum("n").cast("bigint").alias("total_events"),
        _n_of("view").alias("total_views"),
        _n_of("cart").alias("total_carts"),
        _n_of("purchase").alias("total_purchases"),
        _revenue().alias("total_revenue"),
    )
    users = enriched.groupBy("date").agg(F.count_distinct("user_id").alias("unique_users"))
    # one row per date on both sides; null dates must match too
    daily = counts.join(users, counts["date"].eqNullSafe(users["date"])).select(
        counts["date"],
        "total_events",
        "unique_users",
        "total_views",
        "total_carts",
        "total_purchases",
        "total_revenue",
    )
    return daily.withColumn(
        "conversion_rate", safe_ratio("total_purchases", "unique_users")
    ).withColumn("avg_order_value", safe_ratio("total_revenue", "total_purchases"))


def products_from_cube(cube: DataFrame) -> DataFrame:
    return (
        cube.groupBy("product_id", "category_code", "brand", "price")
        .agg(*_measures())
        .withColumnRenamed("category_code", "category")
    )


def categories_from_cube(cube: DataFrame) -> DataFrame:
    return cube.groupBy("root_category").agg(*_measures()).withColumnRenamed("root_category", "category")


def brands_from_cube(cube: DataFrame) -> DataFrame:
    return cube.filter(F.col("brand").isNotNull()).groupBy("brand").agg(*_measures())


def funnel_from_cube(cube: DataFrame) -> DataFrame:
    funnel = (
        cube.groupBy("date", "root_category")
        .agg(_n_of("view").alias("views"), _n_of("cart").alias("carts"), _n_of("purchase").alias("purchases"))
        .withColumnRenamed("root_category", "category")
    )
    return funnel.withColumn("view_to_cart_rate", safe_ratio("carts", "views")).withColumn(
        "cart_to_purchase_rate", safe_ratio("purchases", "carts")
    )


def category_events_from_cube(cube: DataFrame) -> DataFrame:
    cat, et = F.trim(F.col("root_category")), F.trim(F.col("event_type"))
    keyed = cube.select(cat.alias("category"), et.alias("event_type"), "n").filter(
        (F.col("category") != "") & F.col("event_type").isNotNull() & (F.col("event_type") != "")
    )
    return keyed.groupBy("category", "event_type").agg(F.sum("n").cast("bigint").alias("event_count"))


def brand_revenue_from_cube(cube: DataFrame) -> DataFrame:
    counted = F.col("n_priced") if "n_priced" in cube.columns else F.col("n")
    rows = cube.filter(
        (F.col("event_type") == "purchase") & F.col("brand").isNotNull() & F.col("amount").isNotNull()
    ).select(F.trim(F.col("brand")).alias("brand"), counted.alias("n"), "amount")
    return (
        rows.filter(F.col("brand") != "")
        .groupBy("brand")
        .agg(F.sum("amount").alias("total_revenue"), F.sum("n").cast("bigint").alias("purchase_count"))
    )
