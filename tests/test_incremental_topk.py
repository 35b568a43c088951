"""Top-k trees, pruned affinity, incremental tables, stored user sets, samples and checked ingest."""

from __future__ import annotations

import datetime as dt
import glob
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickpulse.operators import affinity, enrich, metrics
from clickpulse.operators.abandonment import cart_abandonment, session_flags
from clickpulse.operators.sampling import bottom_k
from clickpulse.operators.topk import global_row_number, local_top, merge_levels, tree_top
from clickpulse.operators.users import daily_user_sets, number_users, range_users, users_of_ranges
from clickpulse.plans.incremental import advance_affinity, read_dated, refresh_dates, stored_affinity
from tests.test_plans import executed_plan

# --- trees of top-k, row numbers -------------------------------------------------


def numbers(spark, n=2000, partitions=40, seed=0):
    rng = random.Random(seed)
    return spark.createDataFrame([(i, rng.randrange(50)) for i in range(n)], "id long, v long").repartition(partitions)


@pytest.mark.parametrize(("partitions", "fan_in", "levels"), [(1, 64, []), (64, 64, []), (65, 64, [2]), (100_000, 64, [1563, 25]), (5, 2, [3, 2])])
def test_merge_levels(partitions, fan_in, levels):
    assert merge_levels(partitions, fan_in) == levels


@pytest.mark.parametrize(("n", "fan_in"), [(7, 2), (7, 8), (500, 4), (5000, 3)])
def test_tree_top_equals_order_and_limit(spark, n, fan_in):
    df = numbers(spark)
    order = [F.col("v").desc(), F.col("id")]
    want = [tuple(r) for r in df.orderBy(*order).limit(n).collect()]
    assert [tuple(r) for r in tree_top(df, order, n, fan_in, partitions=40).collect()] == want


def test_no_merging_task_reads_more_than_fan_in_times_n(spark):
    """Each level hands on n rows a task, so the next reads fan_in * n at most."""
    df, order, n = numbers(spark, 4000, 32), [F.col("v").desc(), F.col("id")], 5
    per_task = local_top(df, order, n).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(per_task) == 32 and {r["count"] for r in per_task} == {n}
    level = local_top(df, order, n).repartitionById(4, F.floor(F.spark_partition_id() / 8).cast("int"))
    assert [r["count"] for r in level.groupBy(F.spark_partition_id().alias("p")).count().collect()] == [8 * n] * 4


def test_global_row_number(spark):
    df = numbers(spark, 700, 9)
    got = global_row_number(df, [F.col("v"), F.col("id").desc()], partitions=5).collect()
    want = sorted(((r["id"], r["v"]) for r in got), key=lambda r: (r[1], -r[0]))
    assert [(r["id"], r["v"]) for r in sorted(got, key=lambda r: r["row_number"])] == want
    assert sorted(r["row_number"] for r in got) == list(range(1, 701))
    assert global_row_number(df.where("id < 0"), [F.col("id")]).collect() == []


# --- affinity without frequent products -------------------------------------------


def baskets(spark, seed, sessions=300, hot=3):
    """Rare products in small groups, and ``hot`` products that are in most baskets."""
    rng = random.Random(seed)
    rows = []
    for s in range(sessions):
        group = rng.randrange(60)
        rows += [(f"s{s}", "view", 100 + 4 * group + rng.randrange(4)) for _ in range(3)]
        rows += [(f"s{s}", rng.choice(["view", "cart"]), h) for h in range(hot) if rng.random() < 0.8]
    rows += [(None, "view", 100), (None, "cart", 101), ("s0", "purchase", 7), ("only", "purchase", 9), ("s1", "view", None)]
    return spark.createDataFrame(rows, "user_session string, event_type string, product_id long")


@pytest.mark.parametrize(("seed", "n"), [(1, 10), (2, 40), (3, 150), (4, 100_000)])
def test_pruned_affinity_equals_the_whole(spark, seed, n):
    events = baskets(spark, seed)
    want = [tuple(r) for r in affinity.product_affinity(events, n=n).collect()]
    assert [tuple(r) for r in affinity.pruned_affinity(events, n=n).collect()] == want and want


def test_pruned_affinity_keeps_frequent_products_out_of_the_join(spark, monkeypatch):
    joined = []
    whole = affinity.co_occurrence

    def spy(sp, *args, **more):
        joined.append({r["product_id"] for r in sp.select("product_id").distinct().collect()})
        return whole(sp, *args, **more)

    monkeypatch.setattr(affinity, "co_occurrence", spy)
    assert len(affinity.pruned_affinity(baskets(spark, 5), n=30).collect()) == 30
    assert joined and not any({0, 1, 2} & products for products in joined)


def test_pruned_affinity_ties_at_the_cut(spark):
    """All lifts are equal: ids decide, over the pairs of every product."""
    rows = [(f"s{i}", "view", p) for i in range(12) for p in (2 * i, 2 * i + 1)]
    events = spark.createDataFrame(rows, "user_session string, event_type string, product_id long")
    got = [(r["product_a"], r["product_b"]) for r in affinity.pruned_affinity(events, n=5).collect()]
    assert got == [(2 * i, 2 * i + 1) for i in range(5)]


def test_pruned_affinity_of_nothing(spark):
    events = spark.createDataFrame([], "user_session string, event_type string, product_id long")
    assert affinity.pruned_affinity(events, n=5).collect() == []


# --- batch by batch ------------------------------------------------------------------


@pytest.mark.parametrize("block_size", [1, 4096])
def test_affinity_day_by_day_equals_whole(spark, tmp_dir, block_size):
    rng = random.Random(9)
    days = [[(f"s{rng.randrange(25)}", rng.choice(["view", "cart", "purchase"]), rng.randrange(12)) for _ in range(60)] for _ in range(4)]
    days[1] += [(None, "view", 3), ("crosses", "view", 1), ("crosses", "cart", 2)]
    days[3] += [(None, "view", 4), ("crosses", "view", 11), ("crosses", "view", 1)]
    kind = "user_session string, event_type string, product_id long"
    for epoch, rows in enumerate(days):
        advance_affinity(spark.createDataFrame(rows, kind), tmp_dir, epoch, block_size=block_size)
    whole = affinity.product_affinity(spark.createDataFrame([r for d in days for r in d], kind), n=None)
    want = sorted(map(tuple, whole.collect()))
    assert sorted(map(tuple, stored_affinity(spark, tmp_dir, None).collect())) == want
    advance_affinity(spark.createDataFrame(days[3], kind), tmp_dir, 3)  # the last once more
    assert sorted(map(tuple, stored_affinity(spark, tmp_dir, None).collect())) == want


def test_old_pairs_are_not_listed_again(spark, tmp_dir):
    kind = "user_session string, event_type string, product_id long"
    advance_affinity(spark.createDataFrame([("s", "view", p) for p in range(6)], kind), tmp_dir, 0)
    advance_affinity(spark.createDataFrame([("s", "view", 6), ("s", "view", 2)], kind), tmp_dir, 1)
    added = spark.read.parquet(f"{tmp_dir}/pair_counts/epoch=1").collect()
    assert sorted((r["product_a"], r["product_b"], r["co_occurrences"]) for r in added) == [(p, 6, 1) for p in range(6)]


def test_state_without_epochs(spark, tmp_dir):
    assert stored_affinity(spark, tmp_dir).collect() == []


def files(folder):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{folder}/**/*.parquet", recursive=True)}


DAYS = [
    [("2019-10-01 10:00:00 UTC", "view", 1, "a.b", "x", 1.0, 1, "s1"), ("2019-10-01 11:00:00 UTC", "cart", 1, "a.b", "x", 1.0, 1, "s1"), ("2019-10-02 10:00:00 UTC", "cart", 2, "c.d", "y", 2.0, 2, "s2")],
    [("2019-10-03 10:00:00 UTC", "view", 3, "a.c", None, 3.0, 3, "s3"), ("never", "view", 3, None, None, 3.0, None, None)],
    [("2019-10-01 12:00:00 UTC", "purchase", 1, "a.b", "x", 1.0, 1, "s1"), ("2019-10-01 13:00:00 UTC", "cart", 2, "c.d", "x", 1.0, 7, "s9")],
]
WHOLE = {"daily_metrics": metrics.daily_metrics, "funnel_stats": metrics.funnel_stats, "cart_abandonment": lambda e: cart_abandonment(session_flags(e))}


def same_rows(a, b):
    cols = sorted(a.columns)
    key = lambda r: str(tuple(r))
    return sorted(a.columns) == sorted(b.columns) and sorted(map(tuple, a.select(cols).collect()), key=key) == sorted(map(tuple, b.select(cols).collect()), key=key)


def test_only_touched_dates_are_rewritten(spark, make_events, tmp_dir):
    for batch, rows in enumerate(DAYS[:2]):
        refresh_dates(make_events(rows), tmp_dir, batch)
    before = files(tmp_dir)
    dates = refresh_dates(make_events(DAYS[2]), tmp_dir, 2)  # late rows of the first day
    assert dates == [dt.date(2019, 10, 1)]
    after = files(tmp_dir)
    kept = {p for p in before if "date=2019-10-01" not in p}
    assert kept and all(after.get(p) == before[p] for p in kept)
    assert not any(p in after for p in before if "date=2019-10-01" in p and "events_enriched" not in p)
    everything = enrich(make_events([r for d in DAYS for r in d]))
    for name, whole in WHOLE.items():
        assert same_rows(read_dated(spark, tmp_dir, name), whole(everything)), name


def test_a_batch_run_again_replaces_itself(spark, make_events, tmp_dir):
    for batch, rows in enumerate(DAYS):
        refresh_dates(make_events(rows), tmp_dir, batch)
    refresh_dates(make_events(DAYS[1]), tmp_dir, 1)
    everything = enrich(make_events([r for d in DAYS for r in d]))
    for name, whole in WHOLE.items():
        assert same_rows(read_dated(spark, tmp_dir, name), whole(everything)), name
    refresh_dates(make_events(DAYS[1][:1]), tmp_dir, 1)  # now without its undated event
    left = enrich(make_events([*DAYS[0], DAYS[1][0], *DAYS[2]]))
    for name, whole in WHOLE.items():
        assert same_rows(read_dated(spark, tmp_dir, name), whole(left)), name


def test_empty_batch_touches_nothing(make_events, tmp_dir):
    refresh_dates(make_events(DAYS[0]), tmp_dir, 0)
    before = files(tmp_dir)
    assert refresh_dates(make_events([]), tmp_dir, 1) == [] and files(tmp_dir).items() >= before.items()


# --- stored user sets ------------------------------------------------------------------


def test_user_sets_of_any_range(spark, tmp_dir):
    rng = random.Random(3)
    ids = [0, 1, -1, -32768, -32769, 32767, 32768, 32769, 10**12, -(10**12), None] + [rng.randrange(-5, 100_000) for _ in range(300)]
    rows = [(dt.date(2024, 1, 1 + rng.randrange(9)), rng.choice(ids)) for _ in range(2000)] + [(None, 5)]
    events = spark.createDataFrame(rows, "date date, user_id long").repartition(5)
    daily_user_sets(events).write.parquet(f"{tmp_dir}/sets")
    sets = spark.read.parquet(f"{tmp_dir}/sets")
    ranges = [("2024-01-01", "2024-01-09"), ("2024-01-03", "2024-01-03"), ("2024-01-04", "2024-02-01"), ("2023-01-01", "2023-02-01")]
    want = {}
    for a, b in ranges:
        low, high = dt.date.fromisoformat(a), dt.date.fromisoformat(b)
        want[low, high] = len({u for d, u in rows if d is not None and low <= d <= high and u is not None})
        assert range_users(sets, a, b).first()["distinct_users"] == want[low, high]
    assert {(r["start_date"], r["end_date"]): r["distinct_users"] for r in users_of_ranges(sets, ranges).collect()} == want
    plan = executed_plan(range_users(sets, *ranges[0]))
    assert plan.count("Scan parquet") == 1 and f"{tmp_dir}/sets" in plan
    with pytest.raises(ValueError):
        range_users(sets, None, "2024-01-01")


def test_numbered_users_have_no_gaps(spark):
    events = spark.createDataFrame([(u,) for u in (9, 10**15, None, -4, 9, 3)], "user_id long")
    assert sorted((r["user"], r["user_number"]) for r in number_users(events).collect()) == [(-4, 1), (3, 2), (9, 3), (10**15, 4)]


# --- samples ------------------------------------------------------------------------------


def test_bottom_k_is_exact_and_merges(spark):
    df = spark.range(1000).withColumnRenamed("id", "event_id")
    ids = lambda x: {r["event_id"] for r in x.collect()}
    whole = ids(bottom_k(df.repartition(13), 50))
    assert len(whole) == 50 and ids(bottom_k(df.coalesce(1), 50)) == whole
    parts = bottom_k(df.where("event_id < 300"), 50).unionByName(bottom_k(df.where("event_id >= 300"), 50))
    assert ids(bottom_k(parts, 50)) == whole and ids(bottom_k(df, 50, seed=1)) != whole
    assert len(ids(bottom_k(df, 5000))) == 1000
    with pytest.raises(ValueError):
        bottom_k(df, 0)


# --- checked ingest ------------------------------------------------------------------------

HEADER = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session"


def test_ingest_counts_what_it_rejects(spark, tmp_dir):
    from clickpulse.sources.events import ingest_csv

    lines = [
        "2019-10-01 10:00:00 UTC,view,1,2,a.b,x,1.5,3,s1",
        "2019-10-01 10:00:00 UTC,view,one,2,a.b,x,1.5,3,s2",
        "2019-10-01 10:00:00 UTC,view",
        "junk,cart,1,2,a.b,x,1.5,3,s3",
        "2019-10-01 10:00:00 UTC,cart,1,2,a.b,x,1.5,3,s4,more",
        "2019-10-01 10:00:00 UTC,cart,,,,,,,",
    ]
    path = os.path.join(tmp_dir, "in.csv")
    with open(path, "w") as f:
        f.write("\n".join([HEADER, *lines]) + "\n")
    report = ingest_csv(spark, path, f"{tmp_dir}/out")
    assert (report.read, report.accepted, report.rejected, report.null_times) == (6, 3, 3, 1)
    stored = spark.read.parquet(f"{tmp_dir}/out")
    assert Counter(r["status"] for r in stored.collect()) == {"accepted": 3, "rejected": 3}
    assert {r["_corrupt_record"] for r in stored.where("status = 'rejected'").collect()} == {lines[1], lines[2], lines[4]}


def test_ingest_of_no_rows(spark, tmp_dir):
    from clickpulse.sources.events import ingest_csv

    path = os.path.join(tmp_dir, "in.csv")
    with open(path, "w") as f:
        f.write(HEADER + "\n")
    report = ingest_csv(spark, path, f"{tmp_dir}/out")
    assert (report.read, report.accepted, report.rejected, report.null_times) == (0, 0, 0, 0)
