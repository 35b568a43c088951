"""Enrichment, daily KPIs and roll-ups on hand-made rows (null_keys, bad_time,
zero_denominator, price_change fixtures)."""

from __future__ import annotations

import datetime as dt

from clickpulse.functions.exprs import BATCH_TIME_FORMAT, STREAM_TIME_FORMAT
from clickpulse.operators import enrich, metrics

T = "2019-10-01 10:00:00 UTC"


def test_root_category_rules(make_events):
    ev = make_events(
        [
            (T, "view", 1, None, "b", 1.0, 1, "s1"),
            (T, "view", 2, "", "b", 1.0, 1, "s1"),
            (T, "view", 3, ".x", "b", 1.0, 1, "s1"),
            (T, "view", 4, "a", "b", 1.0, 1, "s1"),
            (T, "view", 5, "electronics.phone.smart", "b", 1.0, 1, "s1"),
        ]
    )
    got = {r.product_id: r.root_category for r in enrich(ev).collect()}
    assert got == {1: "unknown", 2: "", 3: "", 4: "a", 5: "electronics"}


def test_bad_time_kept_with_null_date(make_events):
    ev = make_events(
        [
            ("junk", "view", 1, "a.b", "x", 1.0, 1, "s1"),
            (None, "view", 1, "a.b", "x", 1.0, 2, "s1"),
            ("2019-10-01 23:59:59 UTC", "purchase", 1, "a.b", "x", 2.5, 3, "s1"),
            ("2019-10-02T00:00:01Z", "view", 1, "a.b", "x", 1.0, 4, "s2"),
        ]
    )
    batch_only = enrich(ev).collect()
    assert [r.event_ts for r in batch_only][:2] == [None, None]
    assert batch_only[3].event_ts is None  # ISO text is not the batch format
    both = enrich(ev, (STREAM_TIME_FORMAT, BATCH_TIME_FORMAT)).collect()
    assert both[2].date == dt.date(2019, 10, 1)
    assert both[3].date == dt.date(2019, 10, 2)
    daily = {r.date: r for r in metrics.daily_metrics(enrich(ev)).collect()}
    assert daily[None].total_events == 3  # junk, null and ISO rows grouped under null
    assert daily[dt.date(2019, 10, 1)].total_purchases == 1


def test_daily_metrics_values_and_zero_denominators(make_events):
    d1, d2 = "2019-10-01 08:00:00 UTC", "2019-10-02 08:00:00 UTC"
    ev = make_events(
        [
            (d1, "view", 1, "a.x", "b1", 0.1, 1, "s1"),
            (d1, "cart", 1, "a.x", "b1", 0.1, 1, "s1"),
            (d1, "purchase", 1, "a.x", "b1", 0.1, 1, "s1"),
            (d1, "purchase", 2, "a.y", "b2", 0.2, 2, "s2"),
            (d1, "error", 2, "a.y", "b2", 0.2, 3, "s3"),
            (d2, "error", 2, "a.y", "b2", 0.2, 3, "s4"),
        ]
    )
    rows = {r.date: r for r in metrics.daily_metrics(enrich(ev)).collect()}
    r1 = rows[dt.date(2019, 10, 1)]
    assert (r1.total_events, r1.unique_users, r1.total_views, r1.total_carts, r1.total_purchases) == (
        5, 3, 1, 1, 2,
    )
    assert str(r1.total_revenue) == "0.300000"  # exact decimal, not 0.30000000000000004
    assert r1.conversion_rate == 2 / 3
    assert r1.avg_order_value == 0.3 / 2
    r2 = rows[dt.date(2019, 10, 2)]
    assert (r2.total_purchases, r2.conversion_rate, r2.avg_order_value) == (0, 0.0, 0.0)
    assert str(r2.total_revenue) == "0.000000"


def test_funnel_zero_views(make_events):
    ev = make_events([(T, "cart", 1, "c.x", "b", 1.0, 1, "s1")])
    (row,) = metrics.funnel_stats(enrich(ev)).collect()
    assert (row.views, row.carts, row.view_to_cart_rate, row.cart_to_purchase_rate) == (0, 1, 0.0, 0.0)


def test_price_change_and_null_brand(make_events):
    ev = make_events(
        [
            (T, "purchase", 7, "a.b", "acme", 10.0, 1, "s1"),
            (T, "purchase", 7, "a.b", "acme", 12.0, 1, "s1"),
            (T, "view", 8, "a.b", None, 5.0, 1, "s1"),
        ]
    )
    en = enrich(ev)
    products = metrics.product_stats(en).collect()
    assert sorted((r.product_id, r.price) for r in products) == [(7, 10.0), (7, 12.0), (8, 5.0)]
    brands = metrics.brand_stats(en).collect()
    assert [(r.brand, str(r.revenue)) for r in brands] == [("acme", "22.000000")]
    cats = metrics.category_stats(en).collect()
    assert [(r.category, r.views, r.purchases) for r in cats] == [("a", 1, 2)]


def test_other_event_types_count_only_in_total(make_events):
    ev = make_events([(T, "signup", 1, "a.b", "x", 1.0, 1, "s1"), (T, None, 1, "a.b", "x", 1.0, 1, "s1")])
    (row,) = metrics.daily_metrics(enrich(ev)).collect()
    assert (row.total_events, row.total_views, row.total_carts, row.total_purchases) == (2, 0, 0, 0)
