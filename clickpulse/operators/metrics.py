"""Daily KPIs, product / category / brand roll-ups, funnel counts and the
grouped counts of the text jobs (A1-A5, A12, A13).

Every roll-up is one ``groupBy().agg()``: Spark runs a partial aggregate in
the scan stage (map-side combine), so a hot key ships one row per task, not
its events. ``count_distinct`` on one column is planned as two aggregation
levels keyed first by (group, user), so a hot day is spread too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.functions.exprs import count_type, money, revenue, safe_ratio


def _type_measures() -> list:
    return [
        count_type("view").alias("views"),
        count_type("cart").alias("carts"),
        count_type("purchase").alias("purchases"),
        revenue().alias("revenue"),
    ]


def daily_metrics(enriched: DataFrame) -> DataFrame:
    """One row per date (null date kept): counts, uniques, revenue, 2 ratios.

    conversion_rate = purchases / unique users; avg_order_value = revenue /
    purchase events (not orders); both 0 when the denominator is 0.
    """
    daily = enriched.groupBy("date").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_distinct("user_id").alias("unique_users"),
        count_type("view").alias("total_views"),
        count_type("cart").alias("total_carts"),
        count_type("purchase").alias("total_purchases"),
        revenue().alias("total_revenue"),
    )
    return daily.withColumn(
        "conversion_rate", safe_ratio("total_purchases", "unique_users")
    ).withColumn("avg_order_value", safe_ratio("total_revenue", "total_purchases"))


def in_dates(enriched: DataFrame, start=None, end=None) -> DataFrame:
    """Optional inclusive date range (pushed to the scan / partition filter)."""
    if start is not None:
        enriched = enriched.filter(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        enriched = enriched.filter(F.col("date") <= F.lit(end).cast("date"))
    return enriched


def product_stats(enriched: DataFrame, start=None, end=None) -> DataFrame:
    """Grain (product_id, category_code, brand, price): a product seen at two
    prices gives two rows, as in the serving table. ``start``/``end`` give the
    date-range form the dashboard asks for (SURVEY T13); default all dates."""
    return (
        in_dates(enriched, start, end).groupBy("product_id", "category_code", "brand", "price")
        .agg(*_type_measures())
        .withColumnRenamed("category_code", "category")
    )


def category_stats(enriched: DataFrame, start=None, end=None) -> DataFrame:
    return (
        in_dates(enriched, start, end).groupBy("root_category")
        .agg(*_type_measures())
        .withColumnRenamed("root_category", "category")
    )


def brand_stats(enriched: DataFrame, start=None, end=None) -> DataFrame:
    """Events without a brand are left out (the product roll-up keeps them)."""
    return in_dates(enriched, start, end).filter(F.col("brand").isNotNull()).groupBy("brand").agg(*_type_measures())


def funnel_stats(enriched: DataFrame) -> DataFrame:
    """(date, root category) view/cart/purchase counts and two step rates."""
    funnel = (
        enriched.groupBy("date", "root_category")
        .agg(
            count_type("view").alias("views"),
            count_type("cart").alias("carts"),
            count_type("purchase").alias("purchases"),
        )
        .withColumnRenamed("root_category", "category")
    )
    return funnel.withColumn("view_to_cart_rate", safe_ratio("carts", "views")).withColumn(
        "cart_to_purchase_rate", safe_ratio("purchases", "carts")
    )


# --- the two grouped-count jobs, expressed on columns -----------------------


def category_event_rows(enriched: DataFrame) -> DataFrame:
    """(category, event_type) projection exported for the count job."""
    return enriched.select(F.col("root_category").alias("category"), F.col("event_type"))


def brand_price_rows(events: DataFrame) -> DataFrame:
    """(brand, price) of purchases that have a brand."""
    return events.filter(
        (F.col("event_type") == "purchase") & F.col("brand").isNotNull()
    ).select("brand", "price")


def category_events(rows: DataFrame) -> DataFrame:
    """Count per (category, event_type); keys trimmed, blank keys dropped."""
    cat, et = F.trim(F.col("category")), F.trim(F.col("event_type"))
    keyed = rows.select(cat.alias("category"), et.alias("event_type")).filter(
        F.col("category").isNotNull()
        & (F.col("category") != "")
        & F.col("event_type").isNotNull()
        & (F.col("event_type") != "")
    )
    return keyed.groupBy("category", "event_type").agg(F.count(F.lit(1)).alias("event_count"))


def brand_revenue(rows: DataFrame) -> DataFrame:
    """Revenue and purchase count per trimmed brand.

    ``price`` may be text (from a file) or a number; text is parsed with
    ``try_cast`` and rows whose price is missing, unparsable or not finite
    are skipped. Revenue is an exact decimal sum.
    """
    price = F.col("price")
    if dict(rows.dtypes)["price"] == "string":
        price = F.trim(price).try_cast("double")
    amount = money(price)
    keyed = rows.select(F.trim(F.col("brand")).alias("brand"), amount.alias("amount")).filter(
        F.col("brand").isNotNull() & (F.col("brand") != "") & F.col("amount").isNotNull()
    )
    return keyed.groupBy("brand").agg(
        F.sum("amount").alias("total_revenue"), F.count(F.lit(1)).alias("purchase_count")
    )
