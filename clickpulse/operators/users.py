"""Distinct users of any range of days from stored exact sets.

A day's users are bitmaps of 32,768 ids, one for each bucket of ids that occur.
Bitmaps merge by OR, so distinct users of a range are a roll-up of the stored
days; the events are not opened again. The sets are exact for any ids; they are
small where ids are dense. Sparse ids are numbered first
(:func:`number_users`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.operators.serving import DateLike, _check_range, _in_range
from clickpulse.operators.topk import global_row_number


def daily_user_sets(enriched: DataFrame, user: str = "user_id") -> DataFrame:
    """Rows (date, bucket, users): one bitmap for each date and bucket of ids. Null users are in no set."""
    known = enriched.where(F.col(user).isNotNull())
    # ids first made distinct by (date, user): a hot user ships one row a task
    distinct = known.select("date", F.col(user).cast("bigint").alias("u")).distinct()
    keyed = distinct.select("date", F.bitmap_bucket_number("u").alias("bucket"), F.bitmap_bit_position("u").alias("bit"))
    return keyed.groupBy("date", "bucket").agg(F.bitmap_construct_agg("bit").alias("users"))


def range_users(sets: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """One row: distinct users from ``start`` to ``end``, from stored sets."""
    _check_range(start, end)
    merged = sets.where(_in_range(start, end)).groupBy("bucket").agg(F.bitmap_or_agg("users").alias("users"))
    return merged.agg(F.coalesce(F.sum(F.bitmap_count("users")), F.lit(0)).cast("bigint").alias("distinct_users"))


def users_of_ranges(sets: DataFrame, ranges: list[tuple[DateLike, DateLike]]) -> DataFrame:
    """Rows (start_date, end_date, distinct_users) for several ranges in one pass over the stored sets."""
    listed = sets.sparkSession.createDataFrame([(str(a), str(b)) for a, b in ranges], "a string, b string")
    listed = listed.select(F.to_date("a").alias("start_date"), F.to_date("b").alias("end_date"))
    held = sets.join(F.broadcast(listed), F.col("date").between(F.col("start_date"), F.col("end_date")))
    merged = held.groupBy("start_date", "end_date", "bucket").agg(F.bitmap_or_agg("users").alias("users"))
    counted = merged.groupBy("start_date", "end_date").agg(F.sum(F.bitmap_count("users")).alias("n"))
    return listed.join(F.broadcast(counted), ["start_date", "end_date"], "left").select("start_date", "end_date", F.coalesce("n", F.lit(0)).cast("bigint").alias("distinct_users"))


def number_users(enriched: DataFrame, user: str = "user_id") -> DataFrame:
    """Rows (user, user_number): distinct users numbered from 1 in their order, without gaps."""
    ids = enriched.where(F.col(user).isNotNull()).select(F.col(user).alias("user")).distinct()
    return global_row_number(ids, [F.col("user")], "user_number")
