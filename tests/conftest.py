from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from clickpulse.session import build_session

    ckpt = tempfile.mkdtemp(prefix="clickpulse-test-ckpt-")
    s = build_session(
        "clickpulse-tests",
        master="local[4]",
        shuffle_partitions=4,
        extra_conf={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"},
    )
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="clickpulse-test-")


def raw_events(spark, rows):
    """Rows of (event_time, event_type, product_id, category_code, brand, price,
    user_id, user_session) in the raw 9-field schema (category_id null)."""
    from clickpulse.schema import EVENT_SCHEMA

    full = [(r[0], r[1], r[2], None, r[3], r[4], r[5], r[6], r[7]) for r in rows]
    return spark.createDataFrame(full, EVENT_SCHEMA)


@pytest.fixture()
def make_events(spark):
    return lambda rows: raw_events(spark, rows)
