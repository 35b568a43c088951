"""Event records for a Kafka topic (K5). The encode step is plain columns, so
it runs and is tested without a broker; the write needs the Kafka connector
on the classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.sources.events import coerce_defaults


def encode_events(rows: DataFrame, key_col: str | None = "user_session") -> DataFrame:
    """One JSON object per event in ``value`` (null fields omitted), keyed by
    session so one session's events stay in one topic partition, in order."""
    value = F.to_json(F.struct(*[F.col(c) for c in rows.columns])).alias("value")
    if key_col is None:
        return rows.select(value)
    return rows.select(F.col(key_col).cast("string").alias("key"), value)


def write_kafka(rows: DataFrame, servers: str, topic: str, extra: dict[str, str] | None = None) -> None:
    """Batch publish with ``acks=all``; nulls are sent as the producer's defaults."""
    writer = (
        encode_events(coerce_defaults(rows))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("kafka.acks", "all")
    )
    for k, v in (extra or {}).items():
        writer = writer.option(k, v)
    writer.save()
