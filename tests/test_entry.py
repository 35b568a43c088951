"""Driver contract: entry() on sf0.001, registry/SQL keys, a few oracle checks."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tests.oracle_check import digest, duck

SMALL = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver test data not present")
def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:3] == ["date", "total_events", "unique_users"]


def test_sql_keys_are_registered():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    from clickpulse.plans.catalog import QUERIES

    assert set(QUERIES) - set(sql) == {"affinity_row_sample", "sample_export"}


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver test data not present")
@pytest.mark.parametrize(
    "name",
    ["daily_metrics", "cart_abandonment", "product_affinity", "basket_affinity", "live_sessions", "funnel_stages"],
)
def test_matches_sql_on_small_data(spark, name):
    df = entry.queries()[name](spark, SMALL)
    got = digest(df.columns, [tuple(r) for r in df.collect()])
    res = duck(SMALL).execute(entry.oracle_sql()[name])
    want = digest([d[0] for d in res.description], [tuple(r) for r in res.fetchall()])
    assert got == want
