"""Readers and writers: PERMISSIVE CSV, grouped-count text, TSV, JSON
encode/decode, serving types, batch job outputs."""

from __future__ import annotations

import decimal
import os

from pyspark.sql.types import DecimalType

from clickpulse.operators import enrich, metrics
from clickpulse.schema import conform
from clickpulse.sinks import files, kafka
from clickpulse.sources import events as ev_src
from clickpulse.sources.text import read_pair_text


def test_csv_permissive_bad_cell_and_short_row(spark, tmp_dir):
    path = f"{tmp_dir}/events.csv"
    with open(path, "w") as fh:
        fh.write("event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n")
        fh.write("2019-10-01 00:00:00 UTC,view,1,2,a.b,x,1.5,7,s1\n")
        fh.write("2019-10-01 00:00:01 UTC,view,notanumber,2,a.b,x,1.5,7,s1\n")
        fh.write("2019-10-01 00:00:02 UTC,cart\n")
    rows = ev_src.read_events_csv(spark, path).collect()
    assert len(rows) == 3
    assert rows[1].product_id is None and rows[1].event_type == "view"
    assert rows[2].event_type == "cart" and rows[2].user_session is None


def test_text_counts_skip_trim_reject(spark, tmp_dir):
    cat = f"{tmp_dir}/cat"
    os.makedirs(cat)
    with open(f"{cat}/part-0.csv", "w") as fh:
        fh.write("electronics,view\n\n  electronics , view \nonlyone\n,view\nappliances,cart\n")
    rows = read_pair_text(spark, cat, ("category", "event_type"))
    got = {(r.category, r.event_type): r.event_count for r in metrics.category_events(rows).collect()}
    assert got == {("electronics", "view"): 2, ("appliances", "cart"): 1}

    br = f"{tmp_dir}/br"
    os.makedirs(br)
    with open(f"{br}/part-0.csv", "w") as fh:
        fh.write("acme,10.10\n acme ,0.20\nacme,abc\nacme,nan\nacme,inf\nzed,\n,5\nzed,1\n")
    rows = read_pair_text(spark, br, ("brand", "price"))
    got = {r.brand: (str(r.total_revenue), r.purchase_count) for r in metrics.brand_revenue(rows).collect()}
    assert got == {"acme": ("10.300000", 2), "zed": ("1.000000", 1)}


def test_tsv_export_sorted_two_decimals(spark, tmp_dir):
    counts = spark.createDataFrame(
        [("zed", decimal.Decimal("1.5"), 1), ("acme", decimal.Decimal("10.3"), 2)],
        "brand string, total_revenue decimal(28,2), purchase_count long",
    )
    out = f"{tmp_dir}/tsv"
    files.write_counts_tsv(counts, ["brand"], out)
    lines = []
    for name in sorted(os.listdir(out)):
        if name.startswith("part-"):
            with open(f"{out}/{name}") as fh:
                lines += [ln.rstrip("\n") for ln in fh if ln.strip()]
    assert lines == ["acme\t10.30\t2", "zed\t1.50\t1"]


def test_json_encode_decode_roundtrip(spark, make_events):
    ev = make_events([("2019-10-01T10:00:00Z", "view", 1, None, "x", 1.25, 7, "s1")])
    enc = kafka.encode_events(ev)
    assert enc.columns == ["key", "value"]
    (rec,) = enc.collect()
    assert rec.key == "s1" and '"price":1.25' in rec.value and "category_code" not in rec.value
    back = ev_src.decode_event_json(enc).collect()
    assert tuple(back[0]) == tuple(ev.collect()[0])


def test_coerce_defaults(spark, make_events):
    ev = make_events([(None, None, None, None, None, None, None, None)])
    (row,) = ev_src.coerce_defaults(ev).collect()
    assert (row.event_time, row.product_id, row.price, row.user_session) == ("", 0, 0.0, "")


def test_conform_serving_types(spark, make_events):
    ev = make_events([("2019-10-01 10:00:00 UTC", "purchase", 1, "a.b", "x", 3.333, 1, "s1")])
    daily = conform(metrics.daily_metrics(enrich(ev)), "daily_metrics")
    types = {f.name: f.dataType for f in daily.schema.fields}
    assert types["conversion_rate"] == DecimalType(24, 4) and types["avg_order_value"] == DecimalType(28, 2)
    (row,) = daily.collect()
    assert row.total_revenue == decimal.Decimal("3.33") and row.conversion_rate == decimal.Decimal("1.0000")


def test_conform_holds_every_valid_result(spark):
    from clickpulse.schema import SERVING_TYPES

    assert SERVING_TYPES["category_events"]["event_count"].simpleString() == "bigint"
    assert SERVING_TYPES["product_affinity"]["lift"] == DecimalType(8, 4)
    (row,) = conform(spark.sql("SELECT 'a' category, 'view' event_type, 3000000000L event_count"), "category_events").collect()
    assert row.event_count == 3_000_000_000
    (row,) = conform(spark.sql("SELECT 1L product_a, 2L product_b, 1L co_occurrences, 2000000D lift"), "product_affinity").collect()
    assert row.lift == 2_000_000
    (row,) = conform(spark.sql("SELECT 150D conversion_rate, 123456789012345.678BD total_revenue"), "daily_metrics").collect()
    assert row.conversion_rate == 150 and row.total_revenue == decimal.Decimal("123456789012345.68")


def test_money_keeps_the_source_digits(spark, make_events):
    ev = make_events([(f"2019-10-01 10:00:0{i} UTC", "purchase", 1, "a.b", "x", p, 1, "s1") for i, p in enumerate((3.333, 3.333, 3.334, float("nan")))])
    (row,) = metrics.daily_metrics(enrich(ev)).collect()
    assert row.total_revenue == decimal.Decimal("10.000000") and row.total_purchases == 4


def test_batch_job_writes_all_outputs(spark, tmp_dir, make_events):
    from clickpulse.plans.batch_job import run_batch

    ev = make_events(
        [
            ("2019-10-01 10:00:00 UTC", "view", 1, "a.b", "x", 1.0, 1, "s1"),
            ("2019-10-01 10:01:00 UTC", "cart", 2, "a.c", "y", 2.0, 1, "s1"),
            ("2019-10-02 10:00:00 UTC", "purchase", 2, "a.c", "y", 2.0, 2, "s2"),
        ]
    )
    res = run_batch(spark, ev, f"{tmp_dir}/out")
    assert not res.skipped
    assert set(res.outputs) >= {"daily_metrics", "product_affinity", "cart_abandonment", "brand_revenue"}
    assert spark.read.parquet(res.outputs["daily_metrics"]).count() == 2
    enriched = spark.read.parquet(res.enriched_path)
    assert "date" in enriched.columns and enriched.count() == 3
    assert os.path.isdir(f"{tmp_dir}/out/events_enriched/date=2019-10-01")
    empty = run_batch(spark, ev.limit(0), f"{tmp_dir}/out2")
    assert empty.skipped and not os.path.exists(f"{tmp_dir}/out2")


def test_batch_cli_on_csv(spark, tmp_dir):
    from clickpulse import jobs

    src = f"{tmp_dir}/raw.csv"
    with open(src, "w") as fh:
        fh.write("event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n")
        fh.write("2019-10-01 00:00:00 UTC,view,1,2,a.b,x,1.5,7,s1\n")
        fh.write("2019-10-01 00:01:00 UTC,purchase,1,2,a.b,x,1.5,7,s1\n")
    assert jobs.run(["batch", "--events", src, "--out", f"{tmp_dir}/out"]) == 0
    (row,) = spark.read.parquet(f"{tmp_dir}/out/daily_metrics").collect()
    assert (row.total_events, row.total_purchases, str(row.total_revenue)) == (2, 1, "1.500000")


def test_batch_job_cube_equals_direct(spark, tmp_dir, make_events):
    from clickpulse.plans.batch_job import run_batch

    rows = []
    for i in range(60):
        et = ["view", "cart", "purchase", "signup"][i % 4]
        day = 1 + i % 3
        rows.append(
            (f"2019-10-0{day} 10:{i:02d}:00 UTC", et, i % 5, f"c{i % 3}.x" if i % 7 else None,
             f"b{i % 2}" if i % 6 else None, [1.5, 2.25, float("nan")][i % 3], i % 9, f"s{i % 11}")
        )
    ev = make_events(rows)
    direct = run_batch(spark, ev, f"{tmp_dir}/direct", export_text=False, use_cube=False)
    cubed = run_batch(spark, ev, f"{tmp_dir}/cube", export_text=False)
    assert "base_cube" in cubed.outputs
    for name in ("daily_metrics", "top_products", "top_categories", "top_brands", "funnel_stats",
                 "category_events", "brand_revenue"):
        a = spark.read.parquet(direct.outputs[name])
        b = spark.read.parquet(cubed.outputs[name]).select(*a.columns)
        as_text = lambda rows: sorted(tuple(str(v) for v in r) for r in rows)  # noqa: E731 (nan == nan)
        assert as_text(a.collect()) == as_text(b.collect()), name
