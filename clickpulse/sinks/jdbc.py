"""Serving-table writes over JDBC (K1, K7) and reads back.

``overwrite`` with ``truncate=true`` keeps the table (keys, NUMERIC types)
and replaces its rows; without it Spark drops and re-creates the table
(SURVEY T6). Each task opens its own connection and inserts in batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickpulse.schema import SERVING_TYPES, conform


def _driver_for(url: str) -> str | None:
    if url.startswith("jdbc:postgresql:"):
        return "org.postgresql.Driver"
    return None


def write_table(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    mode: str = "overwrite",
    num_partitions: int | None = 8,
) -> None:
    """Write one serving table. At most ``num_partitions`` tasks write at
    once (Spark coalesces to it), so a large result cannot open one database
    connection per partition."""
    props = dict(properties or {})
    driver = _driver_for(url)
    if driver and "driver" not in props:
        props["driver"] = driver
    out = conform(df, table) if table in SERVING_TYPES else df
    writer = out.write.mode(mode).option("truncate", "true")
    if num_partitions:
        writer = writer.option("numPartitions", str(num_partitions))
    writer.jdbc(url, table, properties=props)


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    column: str | None = None,
    bounds: tuple[int, int] | None = None,
    num_partitions: int = 16,
) -> DataFrame:
    """A stored table. With ``column`` (a number) and its ``bounds``, ``num_partitions`` tasks read a range each."""
    props = dict(properties or {})
    driver = _driver_for(url)
    if driver and "driver" not in props:
        props["driver"] = driver
    if column is None or bounds is None:
        return spark.read.jdbc(url, table, properties=props)
    return spark.read.jdbc(url, table, column, bounds[0], bounds[1], num_partitions, properties=props)
