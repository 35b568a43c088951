"""Live per-session state as a Structured Streaming query (C7, ST1-ST7).

* Source: Kafka (JSON payload) in production, a file directory in tests;
  both give the same event columns.
* State: the same ``session_state`` aggregate as the batch form; output mode
  ``update`` emits only sessions changed in the micro-batch, stamped with the
  batch's processing time.
* Sink: ``foreachBatch`` appends the changed rows under ``epoch=<id>``,
  overwriting that folder on a replay, so a retried batch is idempotent.
  The live table is the latest epoch's row per session (an upsert by key).
* Restart: the checkpoint folder (in the shared ``spark.checkpoint.dir``)
  holds offsets and state, so a restarted query resumes where it stopped.
* Bounded state: :func:`live_session_expiring` keeps no state at all (each
  micro-batch appends pieces that a read rolls up, see ``pieces``);
  :func:`live_session_windows` keys state by a session window under a
  watermark, so finished sessions are evicted; the plain form keeps one row
  per session id forever, as the reference does.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType

from clickpulse.functions.exprs import BATCH_TIME_FORMAT, STREAM_TIME_FORMAT
from clickpulse.operators.enrich import enrich
from clickpulse.operators.live import dictionary, live_sessions, session_window_state
from clickpulse.schema import EVENT_SCHEMA
from clickpulse.session import scratch_path
from clickpulse.sources.events import decode_event_json
from clickpulse.sources.tables import load_table, shop_events
from clickpulse.streaming.pieces import append_pieces, read_live_pieces

STREAM_FORMATS = (STREAM_TIME_FORMAT, BATCH_TIME_FORMAT)
EPOCH_COL = "epoch"
WINDOW_KEY = ["session_id", "window_start"]


def event_stream_kafka(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    extra: dict[str, str] | None = None,
) -> DataFrame:
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    for k, v in (extra or {}).items():
        reader = reader.option(k, v)
    return decode_event_json(reader.load(), "value")


def event_stream_files(
    spark: SparkSession,
    path: str,
    fmt: str = "json",
    schema=EVENT_SCHEMA,
    max_files_per_trigger: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def live_session_stream(events: DataFrame) -> DataFrame:
    """Streaming session aggregate; both time formats accepted."""
    return live_sessions(enrich(events, STREAM_FORMATS))


def live_session_windows(events: DataFrame, gap: str = "30 minutes", watermark: str = "30 minutes") -> DataFrame:
    """Bounded-state variant: state per (session id, session window).

    Once the watermark passes a window's end the window is final and its
    state is dropped, so memory follows active sessions only.
    """
    enriched = enrich(events, STREAM_FORMATS).withWatermark("event_ts", watermark)
    return session_window_state(enriched, gap)


def live_session_expiring(
    events: DataFrame,
    table_path: str,
    checkpoint: str,
    trigger: dict | None = None,
    compact_every: int = 20,
    retain: str | None = None,
) -> StreamingQuery:
    """Start the bounded live table: no streaming state, every event kept.

    See :mod:`clickpulse.streaming.pieces`; read it with ``read_live_pieces``.
    """
    writer = (
        enrich(events, STREAM_FORMATS)
        .writeStream.foreachBatch(append_pieces(table_path, compact_every, retain))
        .option("checkpointLocation", checkpoint)
    )
    return writer.trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def upsert_by_epoch(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer: changed rows -> ``path/epoch=<id>`` (idempotent).

    The batch is evaluated once, by the write; an empty one makes an empty folder.
    """

    def write(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{EPOCH_COL}={epoch_id}")

    return write


def replace_table_jdbc(
    url: str, table: str, properties: dict[str, str] | None = None
) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer for ``complete`` mode: each micro-batch replaces the
    whole serving table (truncate + insert), for a database-backed live table.
    The batch is evaluated once, by the write."""
    from clickpulse.sinks.jdbc import write_table

    def write(batch: DataFrame, epoch_id: int) -> None:
        write_table(batch, url, table, properties)

    return write


Key = str | list[str]


def _keys(key: Key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def latest_by_key(updates: DataFrame, key: Key, version: str = EPOCH_COL) -> DataFrame:
    """Per key, the values of its highest ``version`` (ties cannot occur: one
    row per key per epoch).

    A hash aggregate with ``max_by(column, version)`` per fixed-width column;
    text columns go through a dictionary (distinct values, checkpointed,
    broadcast when small) so no buffer is variable-width. The partial
    aggregate keeps one row per key per task.
    """
    keys = _keys(key)
    fields = [f for f in updates.schema.fields if f.name not in (*keys, version)]
    text = [f.name for f in fields if isinstance(f.dataType, StringType)]
    coded = updates
    dicts = {}
    for name in text:
        dicts[name] = dictionary(updates, name).withColumnRenamed("_code", f"_code_{name}")
        coded = coded.join(dicts[name], name, "left")
    measures = [
        F.max_by(F.col(f"_code_{f.name}" if f.name in dicts else f.name), F.col(version)).alias(f.name)
        for f in fields
    ] + [F.max(version).alias(version)]
    latest = coded.groupBy(*keys).agg(*measures)
    for name, d in dicts.items():
        names = d.select(F.col(f"_code_{name}").alias(name), F.col(name).alias(f"_text_{name}"))
        latest = latest.join(names, name, "left").drop(name).withColumnRenamed(f"_text_{name}", name)
    return latest.select(*keys, *[f.name for f in fields], version)


def _updates_over(spark: SparkSession, path: str, base: str | None) -> DataFrame:
    """Epoch updates, or a snapshot plus the epochs after it. The snapshot's
    last epoch is one scalar; as a literal it prunes ``epoch=`` folders."""
    updates = spark.read.parquet(path)
    if base is None:
        return updates
    snapshot = spark.read.parquet(base)
    covered = snapshot.agg(F.max(EPOCH_COL)).first()[0]
    if covered is None:
        return updates
    return updates.where(F.col(EPOCH_COL) > F.lit(covered)).unionByName(snapshot)


def read_live_table(
    spark: SparkSession, path: str, key: Key = "session_id", base: str | None = None
) -> DataFrame:
    """Current live table: the latest epoch's row per key (``session_id``;
    ``["session_id", "window_start"]`` for the session-window table).

    With ``base`` (a snapshot written by :func:`compact_live_table`), only
    epochs newer than the snapshot are read (partition pruning on the
    ``epoch=`` folders) and merged over it.
    """
    return latest_by_key(_updates_over(spark, path, base), key).drop(EPOCH_COL)


def compact_live_table(
    spark: SparkSession, path: str, out: str, key: Key = "session_id", base: str | None = None
) -> str:
    """Write the current table (over ``base``, if given) as a new snapshot at
    ``out``, tagged with the last epoch it covers. Readers then pass
    ``base=out``; epoch folders up to that epoch are no longer read and can
    be removed by retention."""
    latest_by_key(_updates_over(spark, path, base), key).write.mode("overwrite").parquet(out)
    return out


def start_live_sessions(
    sessions: DataFrame,
    table_path: str,
    checkpoint: str,
    trigger: dict | None = None,
    output_mode: str = "update",
) -> StreamingQuery:
    """Start the sink. Default trigger: every 5 seconds."""
    writer = (
        sessions.writeStream.outputMode(output_mode)
        .foreachBatch(upsert_by_epoch(table_path))
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(**(trigger or {"processingTime": "5 seconds"}))
    return writer.start()


#: The driver's events are streamed in time order, in slices of six hours at first and then the rest,
#: and a last slice of events that come late: sessions pause, resume and get late events.
SLICE_HOURS, TIMED_SLICES, LATE_SHARE = 6, 6, 20


def run_live_sessions_once(spark: SparkSession, sf_dir: str, expiring: bool = False) -> DataFrame:
    """Stream the driver's events through the live query, slice by slice with a
    restart between them, then return the resulting live table. ``expiring``
    uses :func:`live_session_expiring` with a snapshot every second epoch."""
    stored = load_table(spark, sf_dir, "events")
    begin = stored.agg(F.min("ts")).scalar()
    hours = F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(begin.cast("timestamp"))) / F.lit(3_600_000_000 * SLICE_HOURS))
    late = F.pmod(F.xxhash64("event_id"), F.lit(LATE_SHARE)) == 0
    sliced = stored.withColumn("slice", F.when(late, TIMED_SLICES).otherwise(F.least(hours, F.lit(TIMED_SLICES - 1))))
    source, table, ckpt = (scratch_path(spark, f"live-{x}") for x in ("source", "table", "ckpt"))
    now = {"availableNow": True}
    for n in range(TIMED_SLICES + 1):
        sliced.where(F.col("slice") == n).drop("slice").write.mode("append").parquet(source)
        raw = event_stream_files(spark, source, "parquet", stored.schema)
        shop = shop_events(raw, load_table(spark, sf_dir, "part"))
        if expiring:
            query = live_session_expiring(shop, table, ckpt, now, compact_every=2)
        else:
            query = start_live_sessions(live_session_stream(shop), table, ckpt, now)
        query.awaitTermination()
    return read_live_pieces(spark, table) if expiring else read_live_table(spark, table)
