"""Live sessions without streaming state: pieces, rolled up when read.

Each micro-batch is aggregated by session on its own (a partial aggregate, as
a map-side combine would make it) and appended as one piece a session. A read
rolls a session's pieces up: counts add up, flags join, first and last follow
the event order that each piece carries. So no event is ever lost or
double-counted: a session may pause for days and resume, and a late event is
one more piece. No state store grows with the number of sessions.

The table's folders: ``epoch=<id>`` with that micro-batch's pieces (overwritten
on a replay), ``_snapshots/upto=<id>`` with all pieces up to an epoch rolled
up, ``_archive/upto=<id>`` with sessions that retention took out. The writer
makes a snapshot every ``compact_every`` epochs and then deletes what the
snapshot before it covered, so a read opens one snapshot and less than
``2 * compact_every`` epochs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.functions.exprs import flag_type
from clickpulse.operators.live import dictionary, event_order

PIECE_SCHEMA = (
    "session_id string, first_order decimal(38,0), user_id long, last_order decimal(38,0), "
    "last_event_time timestamp, event_count long, has_cart boolean, has_purchase boolean, "
    "last_product_id long, last_category string"
)
PIECE_COLUMNS = [c.split()[0] for c in PIECE_SCHEMA.split(", ")]


def session_pieces(enriched: DataFrame) -> DataFrame:
    """One piece for each session of these events (one micro-batch's)."""
    order = event_order(enriched)
    pieces = enriched.groupBy(F.col("user_session").alias("session_id")).agg(
        F.min(order).alias("first_order"),
        F.min_by("user_id", order).cast("long").alias("user_id"),
        F.max(order).alias("last_order"),
        F.max("event_ts").alias("last_event_time"),
        F.count(F.lit(1)).alias("event_count"),
        flag_type("cart").alias("has_cart"),
        flag_type("purchase").alias("has_purchase"),
        F.max_by("product_id", order).cast("long").alias("last_product_id"),
        F.max_by("category_code", order).alias("last_category"),
    )
    return pieces.select(*PIECE_COLUMNS)


def roll_up(pieces: DataFrame) -> DataFrame:
    """One row a session, in the same columns; text is aggregated as dictionary ids (fixed-width buffers)."""
    codes = dictionary(pieces, "last_category")
    coded = pieces.join(codes, "last_category", "left")
    rolled = coded.groupBy("session_id").agg(
        F.min("first_order").alias("first_order"),
        F.min_by("user_id", "first_order").alias("user_id"),
        F.max("last_order").alias("last_order"),
        F.max("last_event_time").alias("last_event_time"),
        F.sum("event_count").alias("event_count"),
        F.bool_or("has_cart").alias("has_cart"),
        F.bool_or("has_purchase").alias("has_purchase"),
        F.max_by("last_product_id", "last_order").alias("last_product_id"),
        F.max_by("_code", "last_order").alias("_code"),
    )
    return rolled.join(codes, "_code", "left").select(*PIECE_COLUMNS)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at, jvm.org.apache.hadoop.fs.Path


def numbered_folders(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers n of the finished folders ``path/name=n``."""
    fs, at, make = _fs(spark, path)
    if not fs.exists(at):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    found = [int(n.split("=")[1]) for n in names if n.startswith(f"{name}=")]
    return sorted(n for n in found if fs.exists(make(f"{path}/{name}={n}/_SUCCESS")))


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, at, _ = _fs(spark, path)
    fs.delete(at, True)


def _pieces(spark: SparkSession, table: str, upto: int | None = None, archived: bool = False) -> DataFrame:
    """All pieces: the last snapshot and the epochs after it (up to ``upto``), and the archive if asked for."""
    snapshots = [n for n in numbered_folders(spark, f"{table}/_snapshots", "upto") if upto is None or n < upto]
    covered = snapshots[-1] if snapshots else -1
    epochs = spark.read.schema(f"{PIECE_SCHEMA}, epoch long").parquet(table).where(F.col("epoch") > covered)
    if upto is not None:
        epochs = epochs.where(F.col("epoch") <= upto)
    found = epochs.select(*PIECE_COLUMNS)
    if snapshots:
        found = found.unionByName(spark.read.schema(PIECE_SCHEMA).parquet(f"{table}/_snapshots/upto={covered}"))
    if archived:
        for n in numbered_folders(spark, f"{table}/_archive", "upto"):
            found = found.unionByName(spark.read.schema(PIECE_SCHEMA).parquet(f"{table}/_archive/upto={n}"))
    return found


def compact_pieces(spark: SparkSession, table: str, upto: int, retain: str | None = None) -> None:
    """Roll all pieces up to an epoch into a snapshot; with ``retain`` (an interval), sessions idle for longer go to the archive."""
    before = [n for n in numbered_folders(spark, f"{table}/_snapshots", "upto") if n < upto]
    rolled = roll_up(_pieces(spark, table, upto))
    if retain:
        newest = rolled.agg(F.max("last_event_time").alias("t")).first()["t"]
        idle = F.coalesce(F.col("last_event_time") < F.lit(newest) - F.expr(f"INTERVAL {retain}"), F.lit(False))
        rolled.where(idle).write.mode("overwrite").parquet(f"{table}/_archive/upto={upto}")
        rolled = rolled.where(~idle)
    rolled.write.mode("overwrite").parquet(f"{table}/_snapshots/upto={upto}")
    if before:  # readers may still hold what the last snapshot covers, but nothing older
        for n in numbered_folders(spark, table, "epoch"):
            if n <= before[-1]:
                delete_folder(spark, f"{table}/epoch={n}")
        for n in before[:-1]:
            delete_folder(spark, f"{table}/_snapshots/upto={n}")


def append_pieces(table: str, compact_every: int = 20, retain: str | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer: aggregates the micro-batch's events once and writes its pieces."""
    table = table.rstrip("/")

    def write(batch: DataFrame, epoch_id: int) -> None:
        session_pieces(batch).write.mode("overwrite").parquet(f"{table}/epoch={epoch_id}")
        if compact_every and (epoch_id + 1) % compact_every == 0:
            compact_pieces(batch.sparkSession, table, epoch_id, retain)

    return write


def read_live_pieces(spark: SparkSession, table: str, gap: str = "30 minutes", archived: bool = False) -> DataFrame:
    """The live table: one row a session, and whether it has been idle for ``gap`` at the newest event's time."""
    rolled = roll_up(_pieces(spark, table.rstrip("/"), archived=archived))
    newest = rolled.agg(F.max("last_event_time").alias("t"))
    expired = F.coalesce(F.col("last_event_time") < newest.scalar() - F.expr(f"INTERVAL {gap}"), F.lit(False))
    return rolled.drop("first_order", "last_order").withColumn("expired", expired)
