"""Grouped-count text inputs: header-less ``key,value`` lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_pair_text(
    spark: SparkSession, path: str, names: tuple[str, str] = ("key", "value")
) -> DataFrame:
    """Read ``a,b`` lines as two trimmed text columns.

    Lines with fewer than two fields, or with a blank field after trimming,
    are dropped (blank lines are skipped by the CSV reader itself). Extra
    fields are ignored, as the line mapper does.
    """
    schema = StructType([StructField(n, StringType(), True) for n in names])
    raw = (
        spark.read.schema(schema)
        .option("header", False)
        .option("mode", "PERMISSIVE")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    a, b = names
    trimmed = raw.select(F.trim(F.col(a)).alias(a), F.trim(F.col(b)).alias(b))
    return trimmed.filter(
        F.col(a).isNotNull() & (F.col(a) != "") & F.col(b).isNotNull() & (F.col(b) != "")
    )
