"""Raw event readers (CSV files, JSON lines, JSON payload columns)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from clickpulse.schema import EVENT_SCHEMA


def read_events_csv(spark: SparkSession, path: str, schema=EVENT_SCHEMA) -> DataFrame:
    """Header CSV with the fixed event schema; never infers types.

    PERMISSIVE: a bad cell becomes null and a short row is padded with nulls,
    so one broken line does not fail a job over a 100 TB input. The path may
    be a file, a directory or a glob on any Hadoop file system.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


CORRUPT = "_corrupt_record"


def read_events_csv_checked(spark: SparkSession, path: str, schema=EVENT_SCHEMA) -> DataFrame:
    """``read_events_csv`` with the text of each line that does not fit the schema in ``_corrupt_record``.

    A line is corrupt if a cell does not parse as its type, or if it has too few
    or too many cells.
    """
    with_corrupt = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    return (
        spark.read.schema(with_corrupt)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


@dataclass(frozen=True)
class IngestReport:
    """Counts of one ingest: ``read == accepted + rejected``."""

    read: int
    accepted: int
    rejected: int
    null_times: int
    path: str


def ingest_csv(spark: SparkSession, path: str, out: str, schema=EVENT_SCHEMA) -> IngestReport:
    """Enrich CSV events into ``out/status=accepted``, corrupt lines into ``out/status=rejected``.

    One write job reads the input once; the counts are observed as it runs.
    ``null_times``: accepted rows without a readable time. Without any row
    nothing is written.
    """
    from clickpulse.operators.enrich import enrich

    lines = enrich(read_events_csv_checked(spark, path, schema))
    bad = F.col(CORRUPT).isNotNull()
    seen = Observation()
    watched = lines.withColumn("status", F.when(bad, F.lit("rejected")).otherwise(F.lit("accepted"))).observe(
        seen,
        F.count(F.lit(1)).alias("read"),
        F.count_if(bad).alias("rejected"),
        F.count_if(~bad & F.col("event_ts").isNull()).alias("null_times"),
    )
    watched.write.mode("overwrite").partitionBy("status").parquet(out)
    got = seen.get
    return IngestReport(got["read"], got["read"] - got["rejected"], got["rejected"], got["null_times"], out)


def read_events_json(spark: SparkSession, path: str, schema=EVENT_SCHEMA) -> DataFrame:
    """JSON lines with the event fields (the stream payload written to files)."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def _blank_to_null(df: DataFrame) -> DataFrame:
    """Empty text means "no value" in the stream payload."""
    return df.select(
        *[
            F.nullif(F.col(f.name), F.lit("")).alias(f.name)
            if isinstance(f.dataType, StringType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def decode_event_json(
    df: DataFrame, value_col: str | Column = "value", schema=EVENT_SCHEMA
) -> DataFrame:
    """Bytes/text JSON column -> event columns.

    A malformed object or a field of the wrong type gives nulls, not a failed
    micro-batch. Works the same on a batch or a streaming frame.
    """
    value = F.col(value_col) if isinstance(value_col, str) else value_col
    parsed = df.select(
        F.from_json(value.cast(StringType()), schema, {"mode": "PERMISSIVE"}).alias("e")
    ).select("e.*")
    return _blank_to_null(parsed)


def coerce_defaults(df: DataFrame) -> DataFrame:
    """Replace nulls the way the event producer does before publishing:
    ids -> 0, price -> 0.0, text -> "" (S8)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, StringType):
            cols.append(F.coalesce(c, F.lit("")).alias(f.name))
        elif isinstance(f.dataType, LongType):
            cols.append(F.coalesce(c, F.lit(0).cast(LongType())).alias(f.name))
        elif f.name == "price":
            cols.append(F.coalesce(c, F.lit(0.0)).alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)
