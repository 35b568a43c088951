"""Property tests: operators against a plain-Python model on generated events."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from clickpulse.operators import abandonment, enrich, metrics

TYPES = ["view", "cart", "purchase", "error"]
event = st.tuples(
    st.integers(1, 3),  # day
    st.integers(0, 23),  # hour
    st.sampled_from(TYPES),
    st.integers(0, 4),  # user
    st.integers(1, 999).map(lambda c: c / 100),  # price in cents
    st.sampled_from(["a.x", "b.y", None]),
)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def _rows(events):
    return [
        (f"2019-10-0{d} {h:02d}:00:00 UTC", t, 1, c, "br", p, u, f"u{u}-{d}")
        for d, h, t, u, p, c in events
    ]


@SETTINGS
@given(st.lists(event, min_size=1, max_size=40))
def test_daily_metrics_model(make_events, events):
    got = {r.date.day: r for r in metrics.daily_metrics(enrich(make_events(_rows(events)))).collect()}
    model = defaultdict(lambda: {"n": 0, "users": set(), "view": 0, "cart": 0, "purchase": 0, "rev": Decimal(0)})
    for d, _h, t, u, p, _c in events:
        m = model[d]
        m["n"] += 1
        m["users"].add(u)
        if t in ("view", "cart", "purchase"):
            m[t] += 1
        if t == "purchase":
            m["rev"] += Decimal(str(p))
    assert set(got) == set(model)
    for d, m in model.items():
        r = got[d]
        assert (r.total_events, r.unique_users, r.total_views, r.total_carts, r.total_purchases) == (
            m["n"], len(m["users"]), m["view"], m["cart"], m["purchase"],
        )
        assert r.total_revenue == m["rev"]
        assert r.conversion_rate == (m["purchase"] / len(m["users"]))
        assert r.avg_order_value == (float(m["rev"]) / m["purchase"] if m["purchase"] else 0.0)


@SETTINGS
@given(st.lists(event, min_size=1, max_size=40))
def test_cart_abandonment_model(make_events, events):
    got = {
        (r.date, r.category): (r.abandoned_carts, r.completed_purchases)
        for r in abandonment.cart_abandonment(abandonment.session_flags(enrich(make_events(_rows(events))))).collect()
    }
    flags = defaultdict(lambda: [False, False])
    for d, _h, t, u, _p, c in events:
        key = (f"u{u}-{d}", dt.date(2019, 10, d), c.split(".")[0] if c is not None else "unknown")
        flags[key][0] |= t == "cart"
        flags[key][1] |= t == "purchase"
    model = defaultdict(lambda: [0, 0])
    for (_s, day, cat), (cart, bought) in flags.items():
        if cart:
            model[(day, cat)][1 if bought else 0] += 1
    assert got == {k: tuple(v) for k, v in model.items()}
