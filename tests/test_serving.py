"""Read-side operators: empty ranges, one-category funnel, stages, top-N."""

from __future__ import annotations

import datetime as dt

from clickpulse.operators import enrich, metrics, serving


def test_overview_empty_range_is_one_zero_row(spark, make_events):
    ev = make_events([("2019-10-01 10:00:00 UTC", "view", 1, "a.b", "x", 1.0, 1, "s1")])
    daily = metrics.daily_metrics(enrich(ev))
    (row,) = serving.overview_kpis(daily, "2020-01-01", "2020-01-31").collect()
    assert row.total_events == 0 and row.unique_users == 0
    assert float(row.total_revenue) == 0.0
    assert row.conversion_rate == 0.0 and row.avg_order_value == 0.0
    assert serving.overview_trend(daily, "2020-01-01", "2020-01-31").count() == 0


def test_funnel_one_category_rates(spark):
    funnel = spark.createDataFrame(
        [(dt.date(2019, 10, 1), "electronics", 1000, 100, 10), (dt.date(2019, 10, 1), "toys", 5, 0, 0)],
        "date date, category string, views long, carts long, purchases long",
    )
    (row,) = serving.funnel_range(funnel, "2019-10-01", "2019-10-31", "electronics").collect()
    assert (row.views, row.carts, row.purchases) == (1000, 100, 10)
    assert row.view_to_cart_rate == 0.1 and row.cart_to_purchase_rate == 0.1
    stages = serving.funnel_stages(serving.funnel_range(funnel, "2019-10-01", "2019-10-31", "electronics")).collect()
    assert [s.stage for s in stages] == ["Views", "Cart Adds", "Purchases"]
    assert stages[1]["count"] == 100 and stages[0].rate == 1.0 and stages[2].rate == 0.01
    (empty,) = serving.funnel_range(funnel, "2020-01-01", "2020-01-02").collect()
    assert (empty.views, empty.view_to_cart_rate) == (0, 0.0)
    assert [r.category for r in serving.funnel_categories(funnel).collect()] == ["electronics", "toys"]


def test_top_lists_labels_and_limits(spark, make_events):
    t = "2019-10-01 10:00:00 UTC"
    ev = make_events(
        [
            (t, "purchase", 1, None, None, 5.0, 1, "s1"),
            (t, "purchase", 2, "a.b", "acme", 7.0, 1, "s1"),
            (t, "purchase", 3, "a.c", "zed", 7.0, 1, "s1"),
        ]
    )
    en = enrich(ev)
    prods = serving.products_by_revenue(metrics.product_stats(en), 2).collect()
    assert [r.product_id for r in prods] == [2, 3]  # tie on revenue broken by id
    allp = serving.products_by_revenue(metrics.product_stats(en), 10).collect()
    assert (allp[-1].category, allp[-1].brand) == ("", "")
    brands = serving.brands_by_revenue(metrics.brand_stats(en), 1).collect()
    assert [r.brand for r in brands] == ["acme"]
    cats = serving.categories_by_revenue(metrics.category_stats(en)).collect()
    assert [r.category for r in cats] == ["a", "unknown"]


def test_last_days_and_data_range(spark):
    daily = spark.createDataFrame(
        [(dt.date(2019, 10, d),) for d in range(1, 32)] + [(dt.date(2019, 11, d),) for d in range(1, 31)],
        "date date",
    )
    last = [r.date for r in serving.last_days(daily, 30).collect()]
    assert min(last) == dt.date(2019, 11, 1) and max(last) == dt.date(2019, 11, 30) and len(last) == 30
    (rng,) = serving.data_range(daily).collect()
    assert (rng.min_date, rng.max_date) == (dt.date(2019, 10, 1), dt.date(2019, 11, 30))


def test_abandonment_top_unweighted_mean(spark):
    ab = spark.createDataFrame(
        [
            (dt.date(2019, 10, 1), "a", 1, 0, 1.0),
            (dt.date(2019, 10, 2), "a", 1, 99, 0.01),
            (dt.date(2019, 10, 1), "b", 50, 50, 0.5),
        ],
        "date date, category string, abandoned_carts long, completed_purchases long, abandonment_rate double",
    )
    rows = serving.abandonment_top(ab, "2019-10-01", "2019-10-31", 10).collect()
    assert [r.category for r in rows] == ["a", "b"]
    assert rows[0].abandonment_rate == (1.0 + 0.01) / 2 and rows[0].abandoned_carts == 2
    assert rows[0].weighted_rate == 2 / 101


def test_live_top_and_counters(spark):
    live = spark.createDataFrame(
        [
            ("s1", 1, dt.datetime(2019, 10, 1, 10), 3, True, False, 5, None),
            ("s2", 2, dt.datetime(2019, 10, 1, 11), 1, True, True, 6, "a.b"),
            ("s3", 3, dt.datetime(2019, 10, 1, 11), 1, False, False, 7, "a.c"),
        ],
        "session_id string, user_id long, last_event_time timestamp, event_count long, has_cart boolean,"
        " has_purchase boolean, last_product_id long, last_category string",
    )
    top = serving.live_top(live, 2).collect()
    assert [r.session_id for r in top] == ["s2", "s3"]
    assert serving.live_top(live, 3).collect()[-1].last_category == ""
    (c,) = serving.live_counters(live).collect()
    assert (c.sessions, c.with_cart, c.purchased) == (3, 2, 1)


def test_round_rates_optional(spark):
    df = spark.createDataFrame([(1, 0.123456, 0.5, 7.0)], "views long, view_to_cart_rate double, overall_conversion double, x double")
    (row,) = serving.round_rates(df, 4).collect()
    assert (row.views, row.view_to_cart_rate, row.overall_conversion, row.x) == (1, 0.1235, 0.5, 7.0)


def test_live_counters_over_shown_rows(spark):
    live = spark.createDataFrame(
        [(f"s{i}", i, dt.datetime(2019, 10, 1, 0, i), 1, i % 2 == 0, i % 3 == 0, i, "a.b") for i in range(30)],
        "session_id string, user_id long, last_event_time timestamp, event_count long, has_cart boolean,"
        " has_purchase boolean, last_product_id long, last_category string",
    )
    (all_rows,) = serving.live_counters(live).collect()
    (shown,) = serving.live_counters(live, 20).collect()
    assert (all_rows.sessions, shown.sessions) == (30, 20)
    assert shown.with_cart == sum(1 for i in range(10, 30) if i % 2 == 0)


def test_bounds_are_rejected(spark):
    import pytest

    df = spark.createDataFrame(
        [(dt.date(2019, 10, 1), "a", 1, 1, 1, 1.0, "b")],
        "date date, category string, views long, carts long, purchases long, revenue double, brand string",
    )
    with pytest.raises(ValueError):
        serving.brands_by_revenue(df, 0)
    with pytest.raises(ValueError):
        serving.products_by_revenue(df, -1)
    with pytest.raises(ValueError):
        serving.funnel_range(df, None, "2019-10-31")
    with pytest.raises(ValueError):
        serving.overview_trend(df, "2019-10-01", None)
