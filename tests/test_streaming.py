"""Live session stream: out-of-order files, restart on one checkpoint,
broken JSON, bounded (windowed) state; stream result equals batch result."""

from __future__ import annotations

import json
import os

from pyspark.sql import functions as F

from clickpulse.functions.exprs import BATCH_TIME_FORMAT, STREAM_TIME_FORMAT
from clickpulse.operators import enrich
from clickpulse.operators.live import session_state
from clickpulse.schema import EVENT_SCHEMA
from clickpulse.sources.events import decode_event_json
from clickpulse.streaming import live as stream_live


def _event(ts, et, pid, cat, session, user=1, price=1.0, brand="b"):
    return {
        "event_time": ts,
        "event_type": et,
        "product_id": pid,
        "category_code": cat,
        "brand": brand,
        "price": price,
        "user_id": user,
        "user_session": session,
    }


def _write_json(path, name, events):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as fh:
        for e in events:
            fh.write(json.dumps(e) + "\n")


def _run(spark, src, table, ckpt):
    events = stream_live.event_stream_files(spark, src, "json", max_files_per_trigger=1)
    q = stream_live.start_live_sessions(
        stream_live.live_session_stream(events), table, ckpt, trigger={"availableNow": True}
    )
    q.awaitTermination()
    return stream_live.read_live_table(spark, table)


def _batch(spark, src):
    ev = spark.read.schema(EVENT_SCHEMA).json(src)
    return session_state(enrich(ev, (STREAM_TIME_FORMAT, BATCH_TIME_FORMAT)))


def _rows(df):
    cols = [c for c in df.columns if c != "updated_at"]
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_late_and_out_of_order_follow_event_time(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    _write_json(src, "a.json", [_event("2019-10-01T10:05:00Z", "cart", 2, "b.y", "s1")])
    _write_json(src, "b.json", [_event("2019-10-01T10:00:00Z", "view", 1, "a.x", "s1", user=9)])
    live = _run(spark, src, f"{tmp_dir}/table", f"{tmp_dir}/ckpt").collect()
    (row,) = live
    assert (row.last_product_id, row.last_category, row.user_id, row.event_count) == (2, "b.y", 9, 2)
    assert row.has_cart and not row.has_purchase


def test_restart_on_same_checkpoint_equals_batch(spark, tmp_dir):
    src, table, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/table", f"{tmp_dir}/ckpt"
    _write_json(
        src,
        "1.json",
        [
            _event("2019-10-01T10:00:00Z", "view", 1, "a.x", "s1"),
            _event("2019-10-01 10:01:00 UTC", "cart", 1, "a.x", "s1"),  # batch text form also accepted
            _event("2019-10-01T10:02:00Z", "view", 3, "c.z", "s2", user=2),
        ],
    )
    first = _run(spark, src, table, ckpt)
    assert first.count() == 2
    _write_json(
        src,
        "2.json",
        [
            _event("2019-10-01T10:03:00Z", "purchase", 1, "a.x", "s1"),
            _event("2019-10-01T10:04:00Z", "view", 4, "d.w", "s3", user=3),
        ],
    )
    final = _run(spark, src, table, ckpt)
    assert _rows(final) == _rows(_batch(spark, src))
    s1 = final.filter(F.col("session_id") == "s1").first()
    assert (s1.event_count, s1.has_cart, s1.has_purchase) == (3, True, True)


def test_bad_json_gives_null_rows_and_continues(spark, tmp_dir):
    src = f"{tmp_dir}/raw"
    os.makedirs(src)
    with open(f"{src}/p.txt", "w") as fh:
        fh.write(json.dumps(_event("2019-10-01T10:00:00Z", "view", 1, "a.x", "s1")) + "\n")
        fh.write('{"event_type": "view", "product_id": \n')
        fh.write('{"event_type": "view", "product_id": "abc", "user_session": "s2"}\n')
        fh.write('{"event_type": null, "category_code": "", "user_session": "s3"}\n')
    stream = spark.readStream.format("text").load(src)
    decoded = decode_event_json(stream, "value")
    q = decoded.writeStream.format("memory").queryName("bad_json_out").trigger(availableNow=True).start()
    q.awaitTermination()
    rows = spark.sql("SELECT * FROM bad_json_out").collect()
    assert len(rows) == 4
    assert rows[0].product_id == 1 and rows[0].user_session == "s1"
    assert all(v is None for v in rows[1].asDict().values())
    assert rows[3].category_code is None  # "" is treated as missing


def test_windowed_state_is_bounded_and_correct(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    _write_json(
        src,
        "1.json",
        [
            _event("2019-10-01T10:00:00Z", "view", 1, "a.x", "s1"),
            _event("2019-10-01T10:10:00Z", "cart", 2, "a.y", "s1"),
        ],
    )
    _write_json(src, "2.json", [_event("2019-10-01T12:00:00Z", "view", 3, "b.x", "s2")])
    _write_json(src, "3.json", [_event("2019-10-01T14:00:00Z", "view", 4, "b.x", "s3")])
    events = stream_live.event_stream_files(spark, src, "json", max_files_per_trigger=1)
    windows = stream_live.live_session_windows(events, gap="30 minutes", watermark="30 minutes")
    q = (
        windows.writeStream.outputMode("append")
        .format("memory")
        .queryName("windows_out")
        .option("checkpointLocation", f"{tmp_dir}/ckpt")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    rows = {r.session_id: r for r in spark.sql("SELECT * FROM windows_out").collect()}
    assert "s1" in rows  # closed once the watermark passed its end
    assert (rows["s1"].event_count, rows["s1"].last_product_id, rows["s1"].has_cart) == (2, 2, True)
    assert "s3" not in rows  # still open: its state is live, not final



def test_compacted_table_reads_equal_full_reads(spark, tmp_dir):
    src, table, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/table", f"{tmp_dir}/ckpt"
    _write_json(src, "1.json", [_event("2019-10-01T10:00:00Z", "view", 1, "a.x", "s1")])
    _write_json(src, "2.json", [_event("2019-10-01T10:01:00Z", "cart", 2, "a.y", "s2", user=2)])
    _run(spark, src, table, ckpt)
    base = stream_live.compact_live_table(spark, table, f"{tmp_dir}/base1")
    _write_json(src, "3.json", [_event("2019-10-01T10:05:00Z", "purchase", 3, "b.z", "s1")])
    _run(spark, src, table, ckpt)
    merged = stream_live.read_live_table(spark, table, base=base)
    assert _rows(merged) == _rows(stream_live.read_live_table(spark, table)) == _rows(_batch(spark, src))
    s1 = merged.filter(F.col("session_id") == "s1").first()
    assert (s1.last_product_id, s1.last_category, s1.event_count) == (3, "b.z", 2)
    base2 = stream_live.compact_live_table(spark, table, f"{tmp_dir}/base2", base=base)
    assert _rows(stream_live.read_live_table(spark, table, base=base2)) == _rows(merged)


def test_window_table_keeps_every_window(spark, tmp_dir):
    src, table, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/table", f"{tmp_dir}/ckpt"
    _write_json(
        src,
        "1.json",
        [
            _event("2019-10-01T10:00:00Z", "view", 1, "a.x", "s1"),
            _event("2019-10-01T11:00:00Z", "cart", 2, "a.y", "s1"),  # new window: gap > 30 min
        ],
    )
    _write_json(src, "2.json", [_event("2019-10-01T14:00:00Z", "view", 3, "b.x", "s2")])
    events = stream_live.event_stream_files(spark, src, "json", max_files_per_trigger=1)
    windows = stream_live.live_session_windows(events, gap="30 minutes", watermark="30 minutes")
    q = stream_live.start_live_sessions(windows, table, ckpt, {"availableNow": True}, output_mode="append")
    q.awaitTermination()
    rows = stream_live.read_live_table(spark, table, key=stream_live.WINDOW_KEY).collect()
    s1 = sorted((r.window_start.hour, r.last_product_id) for r in rows if r.session_id == "s1")
    assert s1 == [(10, 1), (11, 2)]


def _pieces(spark, src, table, ckpt, **options):
    events = stream_live.event_stream_files(spark, src, "json", max_files_per_trigger=1)
    q = stream_live.live_session_expiring(events, table, ckpt, {"availableNow": True}, **options)
    q.awaitTermination()
    return q


def test_pieces_keep_paused_late_and_timeless_sessions(spark, tmp_dir):
    from clickpulse.streaming.pieces import read_live_pieces

    src, table, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/table", f"{tmp_dir}/ckpt"
    files = [
        [_event("2019-10-01T10:01:00Z", "cart", 2, "a.y", "s1"), _event("2019-10-01T10:00:00Z", "view", 1, "a.x", "s1", user=7)],
        [_event("2019-10-01T12:00:00Z", "view", 3, "b.x", "s2")],
        [_event("2019-10-01T12:40:00Z", "purchase", 4, "b.y", "s1", user=8)],  # resumes after a long pause
        [_event("2019-10-01T14:00:00Z", "view", 5, "b.x", "s3", user=9007199254740993), _event("2019-10-01T14:01:00Z", "view", None, None, "s3", user=None)],
        [_event("2019-10-01T09:00:00Z", "view", 6, "c.x", "late", user=9)],  # only a late event
        [_event("junk", "cart", 9007199254740993, "d.x", "timeless", user=3)],
    ]
    for i, events in enumerate(files):
        _write_json(src, f"{i}.json", events)
        query = _pieces(spark, src, table, ckpt, compact_every=2)
        assert [p["sink"]["description"] for p in query.recentProgress if p["numInputRows"]] and sum(p["numInputRows"] for p in query.recentProgress) == len(events)
    live = read_live_pieces(spark, table, "30 minutes")
    assert _rows(live.drop("expired")) == _rows(_batch(spark, src))
    rows = {r.session_id: r for r in live.collect()}
    assert (rows["s1"].event_count, rows["s1"].has_cart, rows["s1"].has_purchase, rows["s1"].user_id) == (3, True, True, 7)
    assert rows["timeless"].last_product_id == 9007199254740993 and rows["late"].expired and not rows["s3"].expired
    assert rows["s3"].user_id == 9007199254740993


def test_pieces_table_stays_small_and_archives(spark, tmp_dir):
    import glob

    from clickpulse.streaming.pieces import numbered_folders, read_live_pieces

    src, table, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/table", f"{tmp_dir}/ckpt"
    for i in range(9):
        _write_json(src, f"{i}.json", [_event(f"2019-10-{i + 1:02d}T10:00:00Z", "view", i, "a.x", f"s{i % 4}", user=i)])
        _pieces(spark, src, table, ckpt, compact_every=2, retain="3 days")
    assert len(numbered_folders(spark, f"{table}/_snapshots", "upto")) <= 2
    assert len(glob.glob(f"{table}/epoch=*")) <= 4
    whole = read_live_pieces(spark, table, archived=True)
    assert _rows(whole.drop("expired")) == _rows(_batch(spark, src))
    assert read_live_pieces(spark, table).count() <= whole.count()


def test_complete_mode_rewrites_the_table_each_epoch(spark, tmp_dir):
    src, table, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/table", f"{tmp_dir}/ckpt"
    for i in range(2):
        _write_json(src, f"{i}.json", [_event(f"2019-10-01T10:0{i}:00Z", "view", i, "a.x", f"s{i}", user=i)])
        events = stream_live.event_stream_files(spark, src, "json", max_files_per_trigger=1)
        sessions = stream_live.live_session_stream(events)
        stream_live.start_live_sessions(sessions, table, ckpt, {"availableNow": True}, "complete").awaitTermination()
    counts = {r["epoch"]: r["count"] for r in spark.read.parquet(table).groupBy("epoch").count().collect()}
    assert counts == {0: 1, 1: 2}
    assert _rows(stream_live.read_live_table(spark, table)) == _rows(_batch(spark, src))


def test_each_micro_batch_is_evaluated_once(spark, tmp_dir):
    src, table, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/table", f"{tmp_dir}/ckpt"
    _write_json(src, "1.json", [_event(f"2019-10-01T10:0{i}:00Z", "view", i, "a.x", f"s{i}") for i in range(5)])
    events = stream_live.event_stream_files(spark, src, "json", max_files_per_trigger=1)
    q = stream_live.start_live_sessions(stream_live.live_session_stream(events), table, ckpt, {"availableNow": True})
    q.awaitTermination()
    (state,) = [p["stateOperators"][0] for p in q.recentProgress if p["numInputRows"]]
    assert state["numRowsUpdated"] == 5 and state["numRowsTotal"] == 5


def test_stream_cli_expiring_from_files(spark, tmp_dir):
    import threading

    from clickpulse import jobs

    src = f"{tmp_dir}/src"
    _write_json(src, "1.json", [_event("2019-10-01T10:00:00Z", "view", 1, "a.x", "s1")])
    args = ["stream", "--source-dir", src, "--table", f"{tmp_dir}/t", "--checkpoint", f"{tmp_dir}/c",
            "--pieces", "--compact-every", "50", "--trigger", "1 second"]
    runner = threading.Thread(target=jobs.run, args=(args,), daemon=True)
    runner.start()
    import time

    deadline = time.time() + 120
    import glob

    while time.time() < deadline and not glob.glob(f"{tmp_dir}/t/epoch=*/_SUCCESS"):
        time.sleep(1)
    for q in spark.streams.active:
        q.stop()
    runner.join(timeout=60)
    (row,) = stream_live.read_live_pieces(spark, f"{tmp_dir}/t").collect()
    assert (row.session_id, row.event_count, row.expired) == ("s1", 1, False)


def test_large_dimension_is_not_sent_with_each_micro_batch(spark, monkeypatch, tmp_path):
    from clickpulse.plans import tuning

    dim = spark.range(30).select(F.col("id").alias("product_id"), F.format_string("a.%s", "id").alias("category_code"))
    spark.range(40).select(F.col("id").alias("product_id")).write.parquet(str(tmp_path / "facts"))
    facts = spark.readStream.schema("product_id long").parquet(str(tmp_path / "facts"))
    plan = lambda: facts.join(tuning.dimension_side(dim, facts, "product_id"), "product_id", "left")._jdf.queryExecution().logical().toString()
    assert "broadcast" in plan()
    monkeypatch.setattr(tuning, "STREAM_BROADCAST_ROWS", 20)
    assert "broadcast" not in plan() and "merge" in plan()
