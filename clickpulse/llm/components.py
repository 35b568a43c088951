"""Connected components of a graph given as rows of links.

Alternating large-star and small-star steps: every round replaces links by
links to the least neighbour, as joins and grouped minima; nothing is
collected. Rounds stop when the links no longer change; they are few (of the
order of the logarithm of the longest chain). ``SMALL`` links at most are handled in
one task, which spares their shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import staged

MAX_ROUNDS = 60
SMALL = 200_000


def _digest(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of ``links`` (a, b: long); root is the least node reachable.

    Links in either direction, to oneself, or repeated do no harm.
    """
    spark = links.sparkSession
    both = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = staged(both.distinct(), "links")
    last = _digest(now)
    if not last[0]:
        return spark.createDataFrame([], "node long, root long")
    for _ in range(MAX_ROUNDS):
        held = (lambda df: df.coalesce(1)) if last[0] <= SMALL else (lambda df: df)
        # large star: each node ties its larger neighbours to its least one
        both = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("x")
        ways = held(now).select(both).select("x.a", "x.b")
        least = ways.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = ways.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: each node ties itself and its smaller neighbours to the least of them
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        tied = large.join(small_least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = staged(held(tied.unionByName(small_least.select("a", F.col("m").alias("b")))).where(F.col("a") != F.col("b")).distinct(), "links")
        found = _digest(now)
        if found == last:
            break
        last = found
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
