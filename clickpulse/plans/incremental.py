"""New days without recomputing old ones.

Affinity: every run of new events is an epoch with a folder of its own under
each state table; a table is the sum of its epochs, and an epoch that is run
again replaces its own folders only.

* ``session_products``: the (session, product) pairs that no earlier epoch has;
* ``pair_counts``: pairs that the epoch adds, from a *delta self-join*: within the
  sessions the epoch touches, new with old and new with new products. Old pairs
  are never listed again;
* ``sessions``: session ids that no earlier epoch has.

Sums of counts over epochs are the counts of the whole, sessions that run on
over several epochs included.

Dates: an epoch's events are appended to the enriched table, the dates they
touch are found (late rows re-open an old date), and the per-date outputs of
those dates alone are computed again and replace their folders by dynamic
partition overwrite. Folders of other dates keep their files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.operators import abandonment, affinity, metrics, users
from clickpulse.operators.enrich import enrich

STATE = {"session_products": "session string, product_id long", "pair_counts": "product_a long, product_b long, co_occurrences long", "sessions": "session string"}


def _epochs(spark: SparkSession, path: str) -> list[int]:
    """The epochs whose last table has been written whole."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/sessions")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    found = [s.getPath() for s in fs.listStatus(folder) if s.isDirectory()]
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return sorted(int(p.getName().removeprefix("epoch=")) for p in found if fs.exists(mark(p, "_SUCCESS")))


def _table(spark: SparkSession, path: str, name: str, epochs: list[int]) -> DataFrame:
    if not epochs:
        return spark.createDataFrame([], STATE[name])
    return spark.read.schema(STATE[name]).parquet(*[f"{path}/{name}/epoch={e}" for e in epochs])


def advance_affinity(
    events: DataFrame,
    path: str,
    epoch: int,
    session: str = "user_session",
    product: str = "product_id",
    types: tuple[str, ...] | None = affinity.AFFINITY_TYPES,
    block_size: int = affinity.DEFAULT_BLOCK_SIZE,
) -> None:
    """Add an epoch's events to the affinity state under ``path``. Only earlier epochs are read."""
    spark = events.sparkSession
    path = path.rstrip("/")
    known = [e for e in _epochs(spark, path) if e < epoch]
    own = events.select(F.col(session).cast("string").alias("session"), F.col(product).cast("bigint").alias("product_id"), "event_type") if types else events.select(F.col(session).cast("string").alias("session"), F.col(product).cast("bigint").alias("product_id"))
    pairs = affinity.session_products(own, "session", "product_id", types)
    old = _table(spark, path, "session_products", known)
    same = lambda a, b, names: [a[n].eqNullSafe(b[n]) for n in names]
    new = pairs.join(old, same(pairs, old, ["session", "product_id"]), "left_anti")
    new.write.mode("overwrite").parquet(f"{path}/session_products/epoch={epoch}")
    new = _table(spark, path, "session_products", [epoch])
    touched = old.join(new.select("session").distinct(), "session", "left_semi")
    both = new.withColumn("fresh", F.lit(True)).unionByName(touched.withColumn("fresh", F.lit(False)))
    delta = affinity.co_occurrence(both, block_size, fresh="fresh")
    delta.write.mode("overwrite").parquet(f"{path}/pair_counts/epoch={epoch}")
    seen = own.select("session").distinct()
    before = _table(spark, path, "sessions", known)
    seen.join(before, same(seen, before, ["session"]), "left_anti").write.mode("overwrite").parquet(f"{path}/sessions/epoch={epoch}")


def stored_affinity(spark: SparkSession, path: str, n: int | None = affinity.DEFAULT_TOP_PAIRS) -> DataFrame:
    """Top pairs by lift from the state alone."""
    path = path.rstrip("/")
    epochs = _epochs(spark, path)
    pairs = _table(spark, path, "pair_counts", epochs).groupBy("product_a", "product_b").agg(F.sum("co_occurrences").alias("co_occurrences"))
    counts = affinity.product_session_counts(_table(spark, path, "session_products", epochs))
    total = _table(spark, path, "sessions", epochs).agg(F.count(F.lit(1)).alias("total_sessions"))  # ids of an epoch are new ones, null once
    return affinity.top_pairs(affinity.affinity_scores(pairs, counts, total), n)


# --- per-date outputs ----------------------------------------------------------

#: outputs whose rows of a date depend on that date's events alone
DATED = {
    "daily_metrics": metrics.daily_metrics,
    "funnel_stats": metrics.funnel_stats,
    "cart_abandonment": lambda enriched: abandonment.cart_abandonment(abandonment.session_flags(enriched)),
    "user_sets": users.daily_user_sets,
}


def of_dates(enriched: DataFrame, dates: list) -> DataFrame:
    """Events of the listed dates; a partition filter where the table is partitioned by date."""
    some = [d for d in dates if d is not None]
    keep = F.col("date").isin(some) if some else F.lit(False)
    return enriched.where(keep | F.col("date").isNull() if None in dates else keep)


def refresh_dates(events: DataFrame, out_dir: str, batch: int, outputs: list[str] | None = None) -> list:
    """Append a batch of events and recompute the outputs of the dates it touches.

    The batch's events go to a folder of its own, so running a batch again
    replaces it. Returns the dates.
    """
    spark, out = events.sparkSession, out_dir.rstrip("/")
    events = events if {"date", "root_category"} <= set(events.columns) else enrich(events)
    own = f"{out}/events_enriched/batch={batch}"
    before = _batch_dates(spark, own)
    events.sortWithinPartitions("date").write.mode("overwrite").partitionBy("date").parquet(own)
    # a day that an earlier run of this batch had, and this one has not, changes too
    dates = list(dict.fromkeys([*before, *_batch_dates(spark, own)]))
    if not dates:
        return []
    table = spark.read.option("basePath", f"{out}/events_enriched").parquet(f"{out}/events_enriched")
    rows = of_dates(table, dates)
    for name in outputs or DATED:
        result = DATED[name](rows)
        result.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(f"{out}/{name}")
        _drop_empty(spark, f"{out}/{name}", [d for d in dates if d in before], result)
    return dates


def _batch_dates(spark: SparkSession, path: str) -> list:
    """Dates of a written batch, from its folders' names alone."""
    import datetime as dt

    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
    values = [n.removeprefix("date=") for n in names if n.startswith("date=")]
    return sorted((None if v.startswith("__HIVE") else dt.date.fromisoformat(v) for v in values), key=lambda d: (d is None, d or dt.date.min))


def _drop_empty(spark: SparkSession, path: str, dates: list, result: DataFrame) -> None:
    """Remove the folders of dates that have no rows any more: an overwrite by partition leaves them."""
    if not dates:
        return
    left = {r["date"] for r in result.select("date").distinct().collect()}
    jvm = spark.sparkContext._jvm
    for date in dates:
        if date not in left:
            folder = jvm.org.apache.hadoop.fs.Path(f"{path}/date={date if date is not None else '__HIVE_DEFAULT_PARTITION__'}")
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def read_dated(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """A per-date output as it stands."""
    return spark.read.parquet(f"{out_dir.rstrip('/')}/{name}")
