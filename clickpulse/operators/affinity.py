"""Product affinity: co-occurrence within sessions and lift.

Plan at scale
-------------
* ``session_products`` is a distinct on (session, product): partial
  aggregation map-side, then one shuffle by both columns. The job
  checkpoints it once, since sizes, counts and pairs all read it.
* Pairs come from a self-join on the session. A plain join on the session
  key would put a hot session (say a third of all rows) into one task and
  make that task enumerate all of its pairs. Instead each session is split
  into ``nb = ceil(m / block_size)`` product blocks (``m`` = its distinct
  products) and the join key is (session, lo_block, hi_block). A normal
  session has ``nb = 1``: one key, no copies, the same work as the plain
  self-join. A hot session spreads over ``nb*(nb+1)/2`` keys, i.e. over
  many tasks, each doing at most ~``(2*block_size)^2`` comparisons. Every
  pair is still produced exactly once; nothing is dropped or capped.
* Both join sides are the same frame keyed the same way, so Spark reuses one
  shuffle for both sides.
* Pair counts are aggregated map-side right after the join, then shuffled by
  (product_a, product_b).
* Product counts are checkpointed, counted, and joined to the pairs by a
  broadcast only when small; otherwise by a shuffle join.
* The session total is a one-row aggregate used as a scalar subquery
  (computed once, no join), keeping one lazy plan instead of a driver-side
  count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.functions.exprs import lift
from clickpulse.operators.topk import tree_top
from clickpulse.plans.tuning import DEFAULT_BROADCAST_ROWS, broadcast_if_small, cut_lineage, sized_shuffles, small_side

DEFAULT_BLOCK_SIZE = 4096
AFFINITY_TYPES = ("view", "cart")
DEFAULT_TOP_PAIRS = 10_000


def session_products(
    events: DataFrame,
    session: str = "user_session",
    product: str = "product_id",
    types: tuple[str, ...] | None = AFFINITY_TYPES,
) -> DataFrame:
    """Distinct (session, product) among events of the given types.

    Null session / product values are kept here, as distinct values.
    """
    rows = events
    if types is not None:
        rows = rows.filter(F.col("event_type").isin(*types))
    return rows.select(
        F.col(session).alias("session"), F.col(product).alias("product_id")
    ).dropDuplicates()


def product_session_counts(sp: DataFrame, also: list[Column] | None = None) -> DataFrame:
    """Sessions per product (A8), from ``session_products``; ``also``: more sums of a product."""
    return sp.groupBy("product_id").agg(F.count(F.lit(1)).alias("session_count"), *(also or []))


def distinct_sessions(events: DataFrame, session: str = "user_session") -> DataFrame:
    """One row: number of distinct sessions over *all* events (A10).

    A null session counts as one value, like ``distinct().count()``.
    """
    s = F.col(session)
    return events.agg(
        (
            F.count_distinct(s) + F.coalesce(F.max(F.when(s.isNull(), 1).otherwise(0)), F.lit(0))
        ).alias("total_sessions")
    )


def hot_sessions(sp: DataFrame, block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """(session, _nb) of the sessions with more than ``block_size`` products, checkpointed: rows / block_size rows at most."""
    sizes = sp.groupBy("session").agg(F.count(F.lit(1)).alias("_m"))
    return cut_lineage(
        sizes.filter(F.col("_m") > block_size).select(
            "session", F.ceil(F.col("_m") / F.lit(block_size)).cast("int").alias("_nb")
        )
    )


def _session_blocks(
    sp: DataFrame,
    block_size: int,
    max_broadcast_rows: int,
    carried: list[str] | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """(session, product_id, blk, nb) with nb = number of blocks of the session.

    Only sessions with more than ``block_size`` products need nb > 1. That
    list (``hot``, or found here) is broadcast when counted to be small;
    otherwise it is a shuffle join (AQE splits the hot session's side, whose
    partner holds one row per session).
    """
    hot = hot_sessions(sp, block_size) if hot is None else hot
    tagged = sp.join(broadcast_if_small(hot, max_broadcast_rows), "session", "left")
    nb = F.coalesce(F.col("_nb"), F.lit(1))
    return tagged.select(
        "session",
        "product_id",
        *(carried or []),
        F.pmod(F.xxhash64("product_id"), nb).cast("int").alias("_blk"),
        nb.alias("_nb"),
    )


def co_occurrence(
    sp: DataFrame,
    block_size: int = DEFAULT_BLOCK_SIZE,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    fresh: str | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Sessions shared by each unordered product pair a < b.

    ``fresh``: a boolean column of ``sp``; pairs of two rows that are not fresh
    are then left out (the delta self-join of :mod:`clickpulse.plans.incremental`).
    ``hot``: the :func:`hot_sessions` of ``sp`` or of more rows, if known.
    """
    clean = sp.filter(F.col("session").isNotNull() & F.col("product_id").isNotNull())
    carried = [fresh] if fresh else []
    blocks = _session_blocks(clean, block_size, max_broadcast_rows, carried, hot)
    # each row goes to every block pair that contains its block: nb keys
    other = F.explode(F.sequence(F.lit(0), F.col("_nb") - 1))
    keyed = blocks.select("session", "product_id", *carried, "_blk", other.alias("_other")).select(
        "session",
        "product_id",
        *carried,
        "_blk",
        F.least("_blk", "_other").alias("_lo"),
        F.greatest("_blk", "_other").alias("_hi"),
    )
    a = keyed.alias("a")
    b = keyed.alias("b")
    cond = (
        (F.col("a.session") == F.col("b.session"))
        & (F.col("a._lo") == F.col("b._lo"))
        & (F.col("a._hi") == F.col("b._hi"))
        & (F.col("a.product_id") < F.col("b.product_id"))
        # the pair belongs to exactly this block pair; written over both
        # sides so no one-side filter is pushed down and the two sides stay
        # identical (one shuffle, reused)
        & (F.least("a._blk", "b._blk") == F.col("a._lo"))
        & (F.greatest("a._blk", "b._blk") == F.col("a._hi"))
    )
    if fresh:
        cond = cond & (F.col(f"a.{fresh}") | F.col(f"b.{fresh}"))
    pairs = a.join(b, cond, "inner").select(
        F.col("a.product_id").alias("product_a"), F.col("b.product_id").alias("product_b")
    )
    return pairs.groupBy("product_a", "product_b").agg(
        F.count(F.lit(1)).alias("co_occurrences")
    )


def affinity_scores(
    co: DataFrame,
    counts: DataFrame,
    total: DataFrame,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """Attach count_a, count_b and lift = co * N / (count_a * count_b)."""
    return _scored(co, small_side(counts, max_broadcast_rows), total)


def _scored(co: DataFrame, pc: DataFrame, total: DataFrame) -> DataFrame:
    pc_a = pc.select(F.col("product_id").alias("product_a"), F.col("session_count").alias("count_a"))
    pc_b = pc.select(F.col("product_id").alias("product_b"), F.col("session_count").alias("count_b"))
    # the one-row total enters as a scalar subquery: computed once, no join
    scored = co.join(pc_a, "product_a").join(pc_b, "product_b").withColumn(
        "total_sessions", total.select("total_sessions").scalar()
    )
    return scored.select(
        "product_a",
        "product_b",
        "co_occurrences",
        "count_a",
        "count_b",
        "total_sessions",
        lift("co_occurrences", "total_sessions", "count_a", "count_b").alias("lift"),
    )


def top_pairs(scored: DataFrame, n: int | None = DEFAULT_TOP_PAIRS) -> DataFrame:
    """Best ``n`` pairs by lift; ties broken by (product_a, product_b) (L1).

    Each task keeps its own top n, and tasks merge in a tree
    (:func:`clickpulse.operators.topk.tree_top`), so the last one reads a
    bounded number of rows.
    """
    order = [F.col("lift").desc(), F.col("product_a"), F.col("product_b")]
    pairs = scored.select("product_a", "product_b", "co_occurrences", "lift")
    return tree_top(pairs, order, n) if n is not None else pairs.orderBy(*order)


def product_affinity(
    events: DataFrame,
    session: str = "user_session",
    product: str = "product_id",
    types: tuple[str, ...] | None = AFFINITY_TYPES,
    n: int | None = DEFAULT_TOP_PAIRS,
    block_size: int = DEFAULT_BLOCK_SIZE,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """The whole affinity job on (already sampled, if wanted) events (C4).

    ``total_sessions`` counts sessions of *all* event types while product
    counts use only ``types`` (SURVEY T8). ``types=None`` takes every row,
    for basket tables without an event type.
    """
    # read three times (sizes, counts, pairs): dedup once, keep it on the shared folder
    spark = events.sparkSession
    with sized_shuffles(spark):
        sp = cut_lineage(session_products(events, session, product, types))
        counts = cut_lineage(product_session_counts(sp))
        total = cut_lineage(distinct_sessions(events, session))
    if n is None:
        return top_pairs(affinity_scores(co_occurrence(sp, block_size, max_broadcast_rows), counts, total, max_broadcast_rows), n)
    # run here, where its tasks can be sized: n rows leave
    with sized_shuffles(spark, _rows(counts)):
        co = co_occurrence(sp, block_size, max_broadcast_rows)
        best = cut_lineage(top_pairs(_scored(co, broadcast_if_small(counts, max_broadcast_rows), total), n))
    return best.orderBy(F.col("lift").desc(), "product_a", "product_b")


def _rows(counts: DataFrame) -> int:
    """How many session products the counts count."""
    return counts.agg(F.sum("session_count")).first()[0] or 0


def first_cutoff(counts: DataFrame, n: int) -> tuple[int, int]:
    """(least session count whose products, with all rarer ones, have ``4 * n`` rows; greatest session count).

    ``counts``: product_id, session_count. One row for each power of two of the
    count reaches the driver.
    """
    level = F.ceil(F.log2("session_count")).cast("int")
    rows = counts.groupBy(level.alias("level")).agg(F.sum("session_count").alias("rows"), F.max("session_count").alias("most")).orderBy("level").collect()
    held = 0
    for r in rows:
        held += r["rows"]
        if held >= 4 * n:
            return r["most"], rows[-1]["most"]
    return (rows[-1]["most"], rows[-1]["most"]) if rows else (0, 0)


def pruned_affinity(
    events: DataFrame,
    session: str = "user_session",
    product: str = "product_id",
    types: tuple[str, ...] | None = AFFINITY_TYPES,
    n: int = DEFAULT_TOP_PAIRS,
    block_size: int = DEFAULT_BLOCK_SIZE,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """``product_affinity`` without listing the pairs of products that are too frequent to matter.

    A pair shares at most the rarer product's sessions, so
    ``lift = co * N / (count_a * count_b) <= N / max(count_a, count_b)``. The
    pairs of rare products alone are scored first. If there are ``n``, the
    least of the best ``n`` lifts is a threshold ``T`` that the result can only
    exceed, and products with more than ``N / T`` sessions are in no pair of it
    (pairs that tie with ``T`` are kept, so ids break ties as ever). The
    self-join then runs without them: each session loses its most frequent
    products, which are in most pairs. While fewer than ``n`` pairs are found,
    the cutoff grows four times; at the greatest count it is the whole join.
    """
    spark = events.sparkSession
    with sized_shuffles(spark):
        sp = cut_lineage(session_products(events, session, product, types))
        # sessions without an id count for a product, as in the whole job, but are in no pair
        every = cut_lineage(product_session_counts(sp, also=[F.count("session").alias("_paired")]))
        total = cut_lineage(distinct_sessions(events, session))
        hot = hot_sessions(sp.where(F.col("session").isNotNull() & F.col("product_id").isNotNull()), block_size)
    counts = every.where("product_id is not null and _paired > 0").select("product_id", F.col("_paired").alias("session_count"))
    every = every.drop("_paired")
    scores = broadcast_if_small(every, max_broadcast_rows)
    sessions = total.first()["total_sessions"]
    cutoff, most = first_cutoff(counts, n)
    while True:
        kept, rows = sp, _rows(counts)
        if cutoff < most:
            rare, frequent = (counts.where(x).select("product_id") for x in (F.col("session_count") <= cutoff, F.col("session_count") > cutoff))
            if frequent.count() < rare.count():  # the smaller list tells the same
                kept = sp.join(small_side(frequent, max_broadcast_rows), "product_id", "left_anti")
            else:
                kept = sp.join(small_side(rare, max_broadcast_rows), "product_id", "left_semi")
            rows = _rows(counts.where(F.col("session_count") <= cutoff))
        with sized_shuffles(spark, rows):
            co = co_occurrence(kept, block_size, max_broadcast_rows, hot=hot)
            best = cut_lineage(top_pairs(_scored(co, scores, total), n))
        if cutoff >= most:
            break
        found = best.agg(F.count(F.lit(1)).alias("n"), F.min("lift").alias("least")).first()
        if found["n"] < n:
            cutoff = min(most, 4 * max(1, cutoff))
            continue
        bound = int(sessions / found["least"] * (1 + 1e-9)) + 1
        if bound <= cutoff:
            break
        cutoff = min(bound, most)
    return best.orderBy(F.col("lift").desc(), "product_a", "product_b")
