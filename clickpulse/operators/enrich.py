"""Enrichment: typed event time, calendar date, root category."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from clickpulse.functions.exprs import BATCH_TIME_FORMAT, parse_event_time, root_category


def enrich(df: DataFrame, time_formats: Iterable[str] = (BATCH_TIME_FORMAT,)) -> DataFrame:
    """Add ``event_ts``, ``date`` and ``root_category`` to raw events.

    ``event_ts`` is parsed from ``event_time`` text (junk -> null, the row is
    kept and groups under a null date) unless the frame already carries a
    typed ``event_ts``. Projection only: no shuffle, fused into the scan stage.
    """
    if "event_ts" in df.columns:
        ts = F.col("event_ts").cast(TimestampType())
    else:
        ts = parse_event_time("event_time", time_formats)
    out = df.withColumn("event_ts", ts)
    return out.withColumn("date", F.to_date(F.col("event_ts"))).withColumn(
        "root_category", root_category("category_code")
    )
