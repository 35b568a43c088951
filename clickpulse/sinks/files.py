"""File sinks (K2, K3, K6, K9). All writes are distributed: each task writes
its own part file; nothing passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from clickpulse.functions.exprs import BATCH_TIME_FORMAT
from clickpulse.operators.sampling import DEFAULT_SEED, row_sample
from clickpulse.schema import EVENT_COLUMNS


def write_parquet(
    df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite"
) -> None:
    """Parquet write; with ``partition_by`` (e.g. ``["date"]``) readers prune
    whole directories on date-range filters."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def export_rows(enriched: DataFrame) -> DataFrame:
    """Back to the raw 9-field layout with ``event_time`` text in batch format."""
    cols = []
    for name in EVENT_COLUMNS:
        if name == "event_time":
            if "event_ts" in enriched.columns:
                cols.append(F.date_format("event_ts", BATCH_TIME_FORMAT).alias(name))
            else:
                cols.append(F.col(name))
        elif name in enriched.columns:
            cols.append(F.col(name))
        else:
            cols.append(F.lit(None).cast("bigint" if name.endswith("_id") else "string").alias(name))
    return enriched.select(*cols)


def write_events_csv(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV in the raw event layout (readable by ``read_events_csv``)."""
    rows.write.mode(mode).option("header", True).csv(path)


def sample_export(
    enriched: DataFrame, path: str, fraction: float = 0.01, seed: int = DEFAULT_SEED
) -> None:
    """Random ``fraction`` of rows as header CSV (K9). Sampling is the feature."""
    write_events_csv(export_rows(row_sample(enriched, fraction, seed)), path)


def write_pair_text(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header-less ``a,b`` lines for the grouped-count step (K3)."""
    rows.write.mode(mode).option("header", False).csv(path)


def format_counts(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Sorted rows with money as 2-decimal text, ready for TSV (K6)."""
    cols = []
    for f in counts.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, DecimalType) or f.dataType.typeName() == "double":
            c = c.cast("decimal(38,2)").cast("string")  # always two decimals
        cols.append(c.alias(f.name))
    return counts.orderBy(*keys).select(*cols)


def write_counts_tsv(counts: DataFrame, keys: list[str], path: str, mode: str = "overwrite") -> None:
    """Tab-separated, key-sorted text (a global sort: range-partitioned, no
    single-task collect)."""
    format_counts(counts, keys).write.mode(mode).option("sep", "\t").option("header", False).csv(path)
