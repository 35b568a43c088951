"""Abandonment (midnight, cross_category) and affinity (lift_known, lift_ties,
repeat_pair, null sessions, blocked self-join vs brute force)."""

from __future__ import annotations

import datetime as dt
import itertools
import random
from collections import Counter

from pyspark.sql import functions as F

from clickpulse.operators import abandonment, affinity, enrich, sampling


def test_midnight_faithful_and_session_grain(make_events):
    ev = make_events(
        [
            ("2019-10-01 23:59:00 UTC", "cart", 1, "tech.x", "b", 1.0, 1, "s1"),
            ("2019-10-02 00:01:00 UTC", "purchase", 1, "tech.x", "b", 1.0, 1, "s1"),
        ]
    )
    en = enrich(ev)
    faithful = abandonment.cart_abandonment(abandonment.session_flags(en)).collect()
    assert [(r.date, r.category, r.abandoned_carts, r.completed_purchases, r.abandonment_rate) for r in faithful] == [
        (dt.date(2019, 10, 1), "tech", 1, 0, 1.0)
    ]
    grain = abandonment.cart_abandonment(abandonment.session_flags(en, grain="session")).collect()
    assert [(r.date, r.abandoned_carts, r.completed_purchases) for r in grain] == [
        (dt.date(2019, 10, 1), 0, 1)
    ]


def test_cross_category_counts_as_abandoned(make_events):
    t = "2019-10-01 10:00:00 UTC"
    ev = make_events(
        [
            (t, "cart", 1, "electronics.a", "b", 1.0, 1, "s1"),
            (t, "purchase", 2, "appliances.b", "b", 1.0, 1, "s1"),
        ]
    )
    rows = abandonment.cart_abandonment(abandonment.session_flags(enrich(ev))).collect()
    assert [(r.category, r.abandoned_carts, r.completed_purchases) for r in rows] == [("electronics", 1, 0)]


def _basket_events(make_events, baskets, extra=()):
    t = "2019-10-01 10:00:00 UTC"
    rows = [(t, "view", p, "a.b", "x", 1.0, 1, s) for s, ps in baskets.items() for p in ps]
    rows += list(extra)
    return make_events(rows)


def test_lift_known_values(make_events):
    baskets = {"s1": [1, 2], "s2": [1, 2, 3], "s3": [2, 3], "s4": [1]}
    extra = [("2019-10-01 10:00:00 UTC", "purchase", 9, "a.b", "x", 1.0, 1, "s5")]
    ev = _basket_events(make_events, baskets, extra)
    got = {(r.product_a, r.product_b): (r.co_occurrences, r.lift) for r in affinity.product_affinity(ev).collect()}
    # counts: p1=3, p2=3, p3=2; N = 5 sessions (s5 is purchase-only but counted)
    assert got == {
        (1, 2): (2, 2 * 5 / (3 * 3)),
        (2, 3): (2, 2 * 5 / (3 * 2)),
        (1, 3): (1, 1 * 5 / (3 * 2)),
    }


def test_lift_ties_broken_by_ids(make_events):
    baskets = {"s1": [5, 6], "s2": [3, 4], "s3": [1, 2]}
    ev = _basket_events(make_events, baskets)
    rows = affinity.product_affinity(ev, n=2).collect()
    assert [(r.product_a, r.product_b) for r in rows] == [(1, 2), (3, 4)]


def test_repeat_pair_counted_once(make_events):
    baskets = {"s1": [1, 1, 2, 2, 2]}
    ev = _basket_events(make_events, baskets)
    rows = affinity.co_occurrence(affinity.session_products(enrich(ev))).collect()
    assert [(r.product_a, r.product_b, r.co_occurrences) for r in rows] == [(1, 2, 1)]


def test_null_session_counts_once_never_joins(make_events):
    t = "2019-10-01 10:00:00 UTC"
    ev = make_events(
        [
            (t, "view", 1, "a.b", "x", 1.0, 1, None),
            (t, "view", 2, "a.b", "x", 1.0, 1, None),
            (t, "view", 1, "a.b", "x", 1.0, 1, "s1"),
            (t, "view", 3, "a.b", "x", 1.0, 1, "s1"),
        ]
    )
    assert affinity.distinct_sessions(ev).collect()[0].total_sessions == 2
    sp = affinity.session_products(ev)
    counts = {r.product_id: r.session_count for r in affinity.product_session_counts(sp).collect()}
    assert counts == {1: 2, 2: 1, 3: 1}
    pairs = [(r.product_a, r.product_b) for r in affinity.co_occurrence(sp).collect()]
    assert pairs == [(1, 3)]


def _brute_force(baskets):
    c = Counter()
    for ps in baskets.values():
        for a, b in itertools.combinations(sorted(set(ps)), 2):
            c[(a, b)] += 1
    return dict(c)


def test_blocked_self_join_equals_brute_force(spark):
    rnd = random.Random(7)
    baskets = {f"s{i}": [rnd.randrange(60) for _ in range(rnd.randrange(1, 12))] for i in range(80)}
    # one hot session holding many products (and most rows)
    baskets["hot"] = [rnd.randrange(60) for _ in range(400)]
    rows = [(s, p) for s, ps in baskets.items() for p in ps]
    sp = spark.createDataFrame(rows, "session string, product_id long").dropDuplicates()
    want = _brute_force(baskets)
    for block in (1, 3, 16, 4096):
        got = {(r.product_a, r.product_b): r.co_occurrences for r in affinity.co_occurrence(sp, block_size=block).collect()}
        assert got == want, block


def test_hot_session_is_spread_over_keys(spark):
    rows = [("hot", p) for p in range(50)] + [("cold", 1), ("cold", 2)]
    sp = spark.createDataFrame(rows, "session string, product_id long")
    blocks = affinity._session_blocks(sp, block_size=10, max_broadcast_rows=1000)
    nb = {r.session: r._nb for r in blocks.select("session", "_nb").distinct().collect()}
    assert nb == {"hot": 5, "cold": 1}
    co = affinity.co_occurrence(sp, block_size=10)
    assert co.count() == 50 * 49 // 2 + 0  # (1, 2) is also in hot: still one row
    assert co.filter((F.col("product_a") == 1) & (F.col("product_b") == 2)).first().co_occurrences == 2


def test_tasks_of_the_pairs_grow_with_the_rows(spark, monkeypatch):
    from clickpulse.plans import tuning

    keys = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.files.maxPartitionBytes"]
    before = [spark.conf.get(k) for k in keys]
    baskets = spark.createDataFrame([(s, (s * k) % 50) for s in range(200) for k in (1, 3, 7)] + [(None, 4), (5, None)], "basket_id long, product_id long")
    want = [tuple(r) for r in affinity.product_affinity(baskets, session="basket_id", types=None, n=40).collect()]
    monkeypatch.setattr(tuning, "TASK_ROWS", 20)
    seen = []
    monkeypatch.setattr(affinity, "cut_lineage", lambda df: (seen.append([spark.conf.get(k) for k in keys[:2]]), tuning.cut_lineage(df))[1])
    for run in (affinity.product_affinity, affinity.pruned_affinity):
        seen.clear()
        assert [tuple(r) for r in run(baskets, session="basket_id", types=None, n=40).collect()] == want
        assert max(int(tasks) for tasks, merged in seen if merged == "false") >= 25  # about 590 rows
        assert [spark.conf.get(k) for k in keys] == before


def test_basket_affinity_without_event_type(spark):
    rows = [(1, 10), (1, 11), (2, 10), (2, 11), (3, 12)]
    baskets = spark.createDataFrame(rows, "basket_id long, product_id long")
    got = affinity.product_affinity(baskets, session="basket_id", types=None).collect()
    assert [(r.product_a, r.product_b, r.co_occurrences, r.lift) for r in got] == [(10, 11, 2, 2 * 3 / 4)]


def test_session_sample_keeps_whole_sessions(make_events):
    baskets = {f"s{i}": [1, 2, 3] for i in range(200)}
    ev = _basket_events(make_events, baskets)
    kept = sampling.session_sample(ev, 0.3)
    per_session = {r.user_session: r.n for r in kept.groupBy("user_session").agg(F.count("*").alias("n")).collect()}
    assert set(per_session.values()) == {3}
    assert 20 < len(per_session) < 100
    assert sampling.session_sample(ev, 1.0).count() == ev.count()
    assert sampling.session_sample(ev, 0.0).count() == 0
