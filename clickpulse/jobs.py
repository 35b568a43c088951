"""spark-submit entry points.

    spark-submit --py-files clickpulse.zip clickpulse/jobs.py batch \
        --events s3a://b/raw/events*.csv --out s3a://b/processed
    spark-submit --py-files clickpulse.zip clickpulse/jobs.py stream \
        --kafka host:9092 --topic clickstream-events \
        --table s3a://b/live_sessions --checkpoint s3a://b/chk/live

(or ``python -m clickpulse.jobs ...`` locally). Cluster settings come from the
submitter (``--conf``); nothing here hard-codes a master or credentials.
"""

from __future__ import annotations

import argparse
import sys

from clickpulse.session import build_session


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="clickpulse.jobs")
    sub = p.add_subparsers(dest="job", required=True)

    b = sub.add_parser("batch", help="all serving tables from raw events (CSV, JSON or Parquet)")
    b.add_argument("--events", required=True, help="raw events path or glob")
    b.add_argument("--format", default="csv", choices=["csv", "json", "parquet"])
    b.add_argument("--out", required=True, help="output folder for Parquet / text results")
    b.add_argument("--jdbc-url", default=None, help="also write the serving tables over JDBC")
    b.add_argument("--jdbc-user", default=None)
    b.add_argument("--jdbc-password", default=None)
    b.add_argument("--affinity-sample", type=float, default=None, help="session sample fraction")
    b.add_argument("--range-partitions", type=int, default=None, help="cluster unordered input by date")
    b.add_argument("--affinity-row-sample", type=float, default=None, help="row sample fraction instead (breaks baskets up)")
    b.add_argument("--only", nargs="*", default=None, help="outputs to write (the enriched table is kept if it is there)")
    b.add_argument("--jdbc-writers", type=int, default=8, help="tasks that write one table at once")

    s = sub.add_parser("stream", help="live per-session table from a stream")
    for q in (b, s):
        q.add_argument("--s3-endpoint", default=None, help="S3-compatible store; keys from --s3-access-key/--s3-secret-key")
        q.add_argument("--s3-access-key", default="")
        q.add_argument("--s3-secret-key", default="")
    s.add_argument("--kafka", default=None, help="bootstrap servers (else --source-dir)")
    s.add_argument("--topic", default="clickstream-events")
    s.add_argument("--starting-offsets", default="latest")
    s.add_argument("--source-dir", default=None, help="JSON-lines folder to stream instead of Kafka")
    s.add_argument("--table", required=True, help="live table folder (epoch=N updates)")
    s.add_argument("--checkpoint", required=True, help="stream checkpoint folder (shared storage)")
    s.add_argument("--trigger", default="5 seconds")
    s.add_argument("--state-partitions", type=int, default=200,
                   help="state store partitions; fixed at the first start of a checkpoint")
    s.add_argument("--watermark", default=None, help="e.g. '30 minutes' with --session-gap")
    s.add_argument("--session-gap", default=None, help="bounded state: one row per activity window")
    s.add_argument("--output-mode", default="update", choices=["update", "complete"])
    s.add_argument("--pieces", action="store_true", help="no streaming state: append pieces, roll up when read")
    s.add_argument("--compact-every", type=int, default=20, help="with --pieces: epochs between snapshots")
    s.add_argument("--retain", default=None, help="with --pieces: archive sessions idle for longer, e.g. '30 days'")
    return p


def _store_conf(args) -> dict[str, str]:
    from clickpulse.session import object_store_conf

    if not args.s3_endpoint:
        return {}
    return object_store_conf(args.s3_endpoint, args.s3_access_key, args.s3_secret_key)


def _read_events(spark, path: str, fmt: str):
    from clickpulse.schema import EVENT_SCHEMA
    from clickpulse.sources import read_events_csv, read_events_json

    if fmt == "csv":
        return read_events_csv(spark, path)
    if fmt == "json":
        return read_events_json(spark, path)
    return spark.read.schema(EVENT_SCHEMA).parquet(path)


def run(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    extra = _store_conf(args)
    if args.job == "stream":
        extra["spark.sql.shuffle.partitions"] = str(args.state_partitions)
    spark = build_session(f"clickpulse-{args.job}", extra_conf=extra)
    if args.job == "batch":
        from clickpulse.plans.batch_job import run_batch
        from clickpulse.session import apply_scale

        apply_scale(spark, args.events)

        props = {}
        if args.jdbc_user:
            props["user"] = args.jdbc_user
        if args.jdbc_password:
            props["password"] = args.jdbc_password
        result = run_batch(
            spark,
            _read_events(spark, args.events, args.format),
            args.out,
            jdbc_url=args.jdbc_url,
            jdbc_properties=props,
            affinity_sample=args.affinity_sample,
            affinity_row_sample=args.affinity_row_sample,
            range_partitions=args.range_partitions,
            outputs=args.only,
            jdbc_writers=args.jdbc_writers,
        )
        print("skipped: empty input" if result.skipped else f"wrote {sorted(result.outputs)}")
        return 0

    from clickpulse.streaming import live as stream_live

    if args.kafka:
        events = stream_live.event_stream_kafka(spark, args.kafka, args.topic, args.starting_offsets)
    elif args.source_dir:
        events = stream_live.event_stream_files(spark, args.source_dir, "json")
    else:
        raise SystemExit("give --kafka or --source-dir")
    trigger = {"processingTime": args.trigger}
    if args.pieces:
        query = stream_live.live_session_expiring(
            events, args.table, args.checkpoint, trigger, args.compact_every, args.retain
        )
        query.awaitTermination()
        return 0
    if args.session_gap:
        sessions = stream_live.live_session_windows(events, args.session_gap, args.watermark or args.session_gap)
        mode = "append"
    else:
        sessions = stream_live.live_session_stream(events)
        mode = args.output_mode
    query = stream_live.start_live_sessions(sessions, args.table, args.checkpoint, trigger, output_mode=mode)
    query.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(run())
