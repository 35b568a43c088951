"""Top-k in a tree, and a global row number without a global task.

``tree_top``: every task keeps its best ``n`` rows; groups of ``fan_in`` tasks
merge theirs, and so on, so that no task, the last one included, reads more
than ``fan_in * n`` rows however many tasks there are. ``orderBy + limit``
alone merges ``n`` rows of every task in one.

``global_row_number``: rows are range-partitioned by their order, and a row's
number is its place within its partition plus the sizes of the partitions
before, which are one number each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAN_IN = 64
_PLACE = (1 << 33) - 1  # the bits of a monotonically increasing id that count rows within a task


def local_top(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The best ``n`` rows of each partition, in order; no shuffle."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE))
    return df.sortWithinPartitions(*order).withColumn("_place", place).where(F.col("_place") < n).drop("_place")


def merge_levels(partitions: int, fan_in: int = FAN_IN) -> list[int]:
    """Numbers of merging tasks, level by level, before the last merge."""
    if fan_in < 2:
        raise ValueError("fan_in must be 2 at least")
    levels = []
    while partitions > fan_in:
        partitions = -(-partitions // fan_in)
        levels.append(partitions)
    return levels


def tree_top(df: DataFrame, order: list[Column], n: int, fan_in: int = FAN_IN, partitions: int | None = None) -> DataFrame:
    """The first ``n`` rows of ``df`` by ``order`` (a total order, or ties are open).

    ``partitions``: how many tasks make ``df``; by default the session's number
    of shuffle partitions, as for a result of a grouping or join. More tasks
    than that only make the groups larger.
    """
    if partitions is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for groups in merge_levels(partitions, fan_in):
        group = F.pmod(F.floor(F.spark_partition_id() / F.lit(fan_in)), F.lit(groups)).cast("int")
        df = local_top(df, order, n).repartitionById(groups, group)
    return df.orderBy(*order).limit(n)


def global_row_number(df: DataFrame, order: list[Column], name: str = "row_number", partitions: int | None = None) -> DataFrame:
    """``df`` with the number (from 1) that each row has in the whole order.

    The ordered rows are written once to the shared folder, so that their
    places and the partitions' sizes come from the same rows. ``order`` must be
    total for a defined result.
    """
    from clickpulse.plans.tuning import cut_lineage

    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    key = F.monotonically_increasing_id()
    placed = cut_lineage(ranged.withColumns({"_part": F.shiftright(key, 33), "_place": key.bitwiseAND(F.lit(_PLACE))}))
    sizes = {r["_part"]: r["n"] for r in placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each partition
    starts, total = [], 0
    for part in sorted(sizes):
        starts.append((part, total))
        total += sizes[part]
    offsets = df.sparkSession.createDataFrame(starts, "_part long, _before long")
    numbered = placed.join(F.broadcast(offsets), "_part")
    return numbered.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_before") + F.col("_place") + 1).alias(name))
