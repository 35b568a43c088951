"""Reads over the result tables (C8-C12): range roll-ups, funnel stages,
top-N lists, data range, live views. Dates and limits are arguments.

Global aggregates (no grouping key) return exactly one row even on an empty
range, with 0 in place of null sums. Money sums stay exact decimals.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.functions.exprs import MONEY_TYPE, label, safe_ratio

DateLike = dt.date | str


def _check_limit(n: int | None) -> None:
    """Top-N sizes must be positive (a limit of 0 is a caller error)."""
    if n is not None and (isinstance(n, bool) or not isinstance(n, int) or n < 1):
        raise ValueError(f"limit must be a positive integer, got {n!r}")


def _check_range(start: DateLike | None, end: DateLike | None) -> None:
    """Range reads need both dates, as the read layer does."""
    if start is None or end is None:
        raise ValueError("start and end dates are required")


def _in_range(start: DateLike | None, end: DateLike | None) -> Column:
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        cond = cond & (F.col("date") <= F.lit(end).cast("date"))
    return cond


def _zero_sum(c: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")


def _money_sum(c: str) -> Column:
    return F.coalesce(F.sum(F.col(c).cast("decimal(32,6)")), F.lit(0).cast(MONEY_TYPE))


def overview_kpis(daily: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """Range KPIs from daily rows.

    ``unique_users`` is the sum of daily uniques and conversion divides by it
    (SURVEY T3); :func:`range_distinct_users` gives true distinct users.
    """
    _check_range(start, end)
    rows = daily.filter(_in_range(start, end))
    agg = rows.agg(
        _zero_sum("total_events").alias("total_events"),
        _zero_sum("unique_users").alias("unique_users"),
        _zero_sum("total_views").alias("total_views"),
        _zero_sum("total_carts").alias("total_carts"),
        _zero_sum("total_purchases").alias("total_purchases"),
        _money_sum("total_revenue").alias("total_revenue"),
    )
    return agg.withColumn(
        "conversion_rate", safe_ratio("total_purchases", "unique_users")
    ).withColumn("avg_order_value", safe_ratio("total_revenue", "total_purchases"))


def range_distinct_users(enriched: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """Distinct users over a date range, from events (one row)."""
    _check_range(start, end)
    return enriched.filter(_in_range(start, end)).agg(
        F.count_distinct("user_id").alias("distinct_users")
    )


def overview_trend(daily: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """Daily series for the range, by date."""
    _check_range(start, end)
    return (
        daily.filter(_in_range(start, end))
        .select("date", "total_views", "total_carts", "total_purchases", "total_revenue")
        .orderBy("date")
    )


def funnel_range(
    funnel: DataFrame, start: DateLike, end: DateLike, category: str = "all"
) -> DataFrame:
    """Range funnel for all categories or one (A15, F7): counts + 3 rates."""
    _check_range(start, end)
    rows = funnel.filter(_in_range(start, end))
    if category != "all":
        rows = rows.filter(F.col("category") == F.lit(category))
    agg = rows.agg(
        _zero_sum("views").alias("views"),
        _zero_sum("carts").alias("carts"),
        _zero_sum("purchases").alias("purchases"),
    )
    return (
        agg.withColumn("view_to_cart_rate", safe_ratio("carts", "views"))
        .withColumn("cart_to_purchase_rate", safe_ratio("purchases", "carts"))
        .withColumn("overall_conversion", safe_ratio("purchases", "views"))
    )


def round_rates(df: DataFrame, digits: int = 4, cols: list[str] | None = None) -> DataFrame:
    """Optional display rounding of rate columns (P15). Spark rounds half-up
    on the decimal value, which can differ from binary round-half-even in the
    last digit (SURVEY T12), so results are served unrounded by default."""
    cols = cols or [c for c in df.columns if c.endswith("_rate") or c == "overall_conversion"]
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


def funnel_stages(range_row: DataFrame) -> DataFrame:
    """Three rows (stage, stage_order, count, rate vs views) from a range row."""
    return range_row.select(
        F.inline(
            F.array(
                F.struct(
                    F.lit("Views").alias("stage"),
                    F.lit(1).alias("stage_order"),
                    F.col("views").alias("count"),
                    F.lit(1.0).alias("rate"),
                ),
                F.struct(
                    F.lit("Cart Adds").alias("stage"),
                    F.lit(2).alias("stage_order"),
                    F.col("carts").alias("count"),
                    F.col("view_to_cart_rate").alias("rate"),
                ),
                F.struct(
                    F.lit("Purchases").alias("stage"),
                    F.lit(3).alias("stage_order"),
                    F.col("purchases").alias("count"),
                    F.col("overall_conversion").alias("rate"),
                ),
            )
        )
    )


def funnel_categories(funnel: DataFrame) -> DataFrame:
    """Distinct categories, sorted."""
    return funnel.select("category").distinct().orderBy("category")


def abandonment_top(
    abandonment: DataFrame, start: DateLike, end: DateLike, n: int = 10
) -> DataFrame:
    """Categories by mean daily abandonment rate (unweighted, SURVEY T14).

    Also returns the cart-weighted rate, which the daily mean is not.
    """
    _check_range(start, end)
    _check_limit(n)
    rows = abandonment.filter(_in_range(start, end))
    agg = rows.groupBy("category").agg(
        F.sum("abandoned_carts").cast("bigint").alias("abandoned_carts"),
        F.avg("abandonment_rate").alias("abandonment_rate"),
        F.sum(F.col("abandoned_carts") + F.col("completed_purchases")).cast("bigint").alias("_carts"),
    )
    agg = agg.withColumn("weighted_rate", safe_ratio("abandoned_carts", "_carts")).drop("_carts")
    return agg.orderBy(F.col("abandonment_rate").desc(), F.col("category")).limit(n)


def _by_revenue(df: DataFrame, keys: list[str], n: int | None) -> DataFrame:
    _check_limit(n)
    ordered = df.orderBy(F.col("revenue").desc(), *[F.col(k).asc_nulls_first() for k in keys])
    return ordered.limit(n) if n is not None else ordered


def products_by_revenue(products: DataFrame, n: int = 20) -> DataFrame:
    """Top-n product rows by revenue, labels null -> "" (L2, P13)."""
    top = _by_revenue(products, ["product_id", "category", "brand", "price"], n)
    return top.select(
        "product_id",
        label("category").alias("category"),
        label("brand").alias("brand"),
        "price",
        "views",
        "carts",
        "purchases",
        "revenue",
    )


def brands_by_revenue(brands: DataFrame, n: int = 20) -> DataFrame:
    top = _by_revenue(brands, ["brand"], n)
    return top.select(label("brand").alias("brand"), "views", "carts", "purchases", "revenue")


def categories_by_revenue(categories: DataFrame, n: int | None = None) -> DataFrame:
    """All categories by revenue (L4); ``n=10`` gives the chart slice."""
    top = _by_revenue(categories, ["category"], n)
    return top.select(label("category").alias("category"), "views", "carts", "purchases", "revenue")


def data_range(dated: DataFrame) -> DataFrame:
    """First and last date present (S9), from data instead of constants."""
    return dated.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def last_days(dated: DataFrame, days: int = 30) -> DataFrame:
    """Rows of the last ``days`` days anchored at the data's max date.

    The max date is a scalar subquery (one value, computed once).
    """
    anchor = dated.agg(F.max("date")).scalar()
    return dated.filter(F.col("date") >= F.date_sub(anchor, days - 1))


def live_top(live: DataFrame, n: int = 50) -> DataFrame:
    """Most recently updated live sessions (L7); ties by event time, then id."""
    _check_limit(n)
    keys = [F.col("last_event_time").desc_nulls_last(), F.col("session_id")]
    if "updated_at" in live.columns:
        keys.insert(0, F.col("updated_at").desc_nulls_last())
    cols = [c for c in live.columns if c != "last_category"]
    return live.orderBy(*keys).limit(n).select(*cols, label("last_category").alias("last_category"))


def live_counters(live: DataFrame, n: int | None = None) -> DataFrame:
    """Sessions, with a cart, with a purchase (A18): over the whole live table,
    or, with ``n``, over the ``n`` rows the live view shows (the reference's
    dashboard counts only those)."""
    if n is not None:
        live = live_top(live, n)
    return live.agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count_if(F.col("has_cart")).alias("with_cart"),
        F.count_if(F.col("has_purchase")).alias("purchased"),
    )
