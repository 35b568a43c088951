"""Physical-plan helpers: size-checked broadcast and lineage cuts."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only after we have counted that it holds at most this
# many rows; above it the join stays a shuffle join that AQE may still convert
# (measured shuffle sizes) or split (skew join) at run time.
DEFAULT_BROADCAST_ROWS = 2_000_000
# ... and takes at most this many bytes (rows x measured width). Below
# WIDTH_ROWS rows the width is not measured: only rows of over a kilobyte
# could then reach the bound.
DEFAULT_BROADCAST_BYTES = 256 * 1024**2
WIDTH_ROWS = 200_000
# A stream collects and sends a broadcast anew with each micro-batch: the driver
# gets it as often as there are batches, so a stream's side must be this small.
STREAM_BROADCAST_ROWS = 200_000


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared ``spark.checkpoint.dir``.

    Survives executor loss (unlike a local checkpoint): the data is on the
    shared file system, and the plan above it is dropped.
    """
    from clickpulse.session import shared_dir

    shared_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


#: rows that one task of a sized shuffle takes, about; and the bytes of one task of a scan before it
TASK_ROWS = 500_000
SCAN_BYTES = 32 * 1024**2
_SIZED = threading.RLock()


@contextmanager
def sized_shuffles(spark: SparkSession, rows: int | None = None) -> Iterator[None]:
    """What runs inside deals its shuffles to a task for each ``TASK_ROWS`` of ``rows``, and scans in small splits.

    By itself Spark merges shuffle partitions to about one a core while they are
    below the advisory size, so that a task's hash tables grow with the input.
    Plans take the settings when they run: only actions inside are sized.
    ``rows=None``: the splits alone.
    """
    chosen = {"spark.sql.files.maxPartitionBytes": str(SCAN_BYTES)}
    if rows is not None:
        tasks = max(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))
        chosen |= {"spark.sql.shuffle.partitions": str(tasks), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    with _SIZED:  # outputs may be built from several threads
        before = {k: spark.conf.get(k) for k in chosen}
        try:
            for key, value in chosen.items():
                spark.conf.set(key, value)
            yield
        finally:
            for key, value in before.items():
                spark.conf.set(key, value)


def fits(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows of bounded size in all.

    Call it on a plain table scan (Parquet answers ``count()`` from file
    footers, no data is read) or on a frame already materialized with
    :func:`cut_lineage`; see :func:`small_side`.
    """
    n = df.count()
    if n > max_rows:
        return False
    return n <= WIDTH_ROWS or row_bytes(df) <= DEFAULT_BROADCAST_BYTES


def row_bytes(df: DataFrame) -> int:
    """Bytes of all rows: eight for each number, the measured length of text and arrays."""
    fixed, sizes = 8, []
    for f in df.schema.fields:
        c, kind = F.col(f"`{f.name}`"), f.dataType.typeName()
        if kind in ("string", "binary"):
            sizes.append(F.octet_length(c))
        elif kind == "array":
            sizes.append(F.size(c) * 8)
        else:
            fixed += 8
    width = sum((F.coalesce(s, F.lit(0)) for s in sizes), F.lit(fixed + 8 * len(sizes)))
    return int(df.agg(F.sum(width)).first()[0] or 0)


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` if its row count is proven under ``max_rows``, else ``df``.

    For a scan-like frame (a projection of one table) the count is metadata
    only. For a computed frame use :func:`small_side`.
    """
    return F.broadcast(df) if fits(df, max_rows) else df


def small_side(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Materialize a computed join side once, then broadcast it only if small.

    The checkpoint is written to the shared folder, so the count is cheap,
    the main job reads it instead of recomputing it, and a lost executor
    does not re-run its lineage.
    """
    return broadcast_if_small(cut_lineage(df), max_rows)


def dimension_side(
    dim: DataFrame, facts: DataFrame, key: str, max_rows: int = DEFAULT_BROADCAST_ROWS
) -> DataFrame:
    """The dimension side of a fact-to-dimension join, as small as it can be.

    1. The whole dimension is broadcast if its row count (footer metadata
       for a table scan) is under ``max_rows``.
    2. Otherwise it is first cut to the keys the facts use (a semi join with
       the facts' distinct keys, a one-column aggregate), checkpointed, and
       broadcast if that is small, so the facts are never shuffled.
    3. Otherwise the reduced side is joined by a shuffle join (AQE splits
       hot keys; the dimension holds one row per key).
    A streaming fact side skips step 2 (its keys are not known up front). Its
    dimension is broadcast up to ``STREAM_BROADCAST_ROWS`` and merged beyond,
    whatever size Spark estimates.
    """
    if facts.isStreaming:
        return F.broadcast(dim) if fits(dim, min(max_rows, STREAM_BROADCAST_ROWS)) else dim.hint("merge")
    if fits(dim, max_rows):
        return F.broadcast(dim)
    used = facts.select(key).where(F.col(key).isNotNull()).distinct()
    return small_side(dim.join(used, key, "left_semi"), max_rows)
