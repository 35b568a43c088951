"""Writers: Parquet, CSV / TSV text, JDBC, Kafka records."""

from clickpulse.sinks.files import (
    export_rows,
    format_counts,
    sample_export,
    write_counts_tsv,
    write_events_csv,
    write_pair_text,
    write_parquet,
)
from clickpulse.sinks.jdbc import read_table, write_table
from clickpulse.sinks.kafka import encode_events, write_kafka

__all__ = [
    "encode_events",
    "export_rows",
    "format_counts",
    "read_table",
    "sample_export",
    "write_counts_tsv",
    "write_events_csv",
    "write_kafka",
    "write_pair_text",
    "write_parquet",
    "write_table",
]
