"""Plan regression tests: the physical properties the scale design relies on."""

from __future__ import annotations

import contextlib
import io
import os

import pytest

from clickpulse.operators import affinity, enrich
from clickpulse.operators.live import session_state

SMALL = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver test data not present")


def executed_plan(df) -> str:
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue().split("== Initial Plan ==")[0]


@contextlib.contextmanager
def no_auto_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_session_state_is_a_hash_aggregate(spark, make_events):
    ev = make_events(
        [
            ("2019-10-01 10:00:00 UTC", "view", 1, "a.b", "x", 1.0, 1, "s1"),
            ("2019-10-01 10:01:00 UTC", "cart", 2, "c.d", "x", 1.0, 1, "s1"),
        ]
    )
    plan = executed_plan(session_state(enrich(ev)))
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    assert "partial_max_by" in plan


def test_blocked_self_join_shares_one_shuffle(spark):
    rows = [(f"s{i % 40}", i % 25) for i in range(400)]
    sp = spark.createDataFrame(rows, "session string, product_id long").dropDuplicates()
    with no_auto_broadcast(spark):
        plan = executed_plan(affinity.co_occurrence(sp, block_size=4))
    assert "SortMergeJoin" in plan
    assert "ReusedExchange" in plan  # both join sides read one exchange
    assert "hashpartitioning(session" in plan and "_lo" in plan and "_hi" in plan


@needs_data
def test_scans_are_pruned_and_filters_pushed(spark):
    import __spark_entry__ as entry

    plan = executed_plan(entry.queries()["range_distinct_users"](spark, SMALL))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


@needs_data
@pytest.mark.parametrize(
    "name", ["daily_metrics", "cart_abandonment", "product_affinity", "live_sessions", "brand_revenue"]
)
def test_no_python_in_plans(spark, name):
    import __spark_entry__ as entry

    plan = executed_plan(entry.queries()[name](spark, SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in plan
    assert "WholeStageCodegen" in plan or "*(" in plan


def test_large_dimension_is_cut_to_used_keys(spark):
    from pyspark.sql import functions as F

    from clickpulse.plans.tuning import dimension_side

    dim = spark.range(0, 5000).select(F.col("id").alias("product_id"), (F.col("id") * 2).alias("v"))
    facts = spark.createDataFrame([(i % 7,) for i in range(100)], "product_id long")
    side = dimension_side(dim, facts, "product_id", max_rows=100)
    assert sorted(r.product_id for r in side.collect()) == list(range(7))
    joined = facts.join(side, "product_id", "left")
    plan = executed_plan(joined)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert joined.count() == 100
