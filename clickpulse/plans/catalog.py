"""Registered queries over the driver tables: name -> (spark, sf_dir) -> DataFrame.

Each query reads whole tables. Results leave through :func:`edge`, which
casts exact decimals to double and session-zone timestamps to wall-clock
(``timestamp_ntz``) so they compare one-to-one with the SQL equivalents in
:mod:`clickpulse.plans.equivalent_sql`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, TimestampNTZType, TimestampType

from clickpulse.functions.exprs import BATCH_TIME_FORMAT, STREAM_TIME_FORMAT, parse_event_time
from clickpulse.operators import abandonment, affinity, cube, metrics, sampling, serving
from clickpulse.operators.enrich import enrich
from clickpulse.operators.live import session_state, session_window_state
from clickpulse.sources.tables import baskets_from_lineitem, baskets_with_attributes, events_from_tables, load_table

# Parameters of the range reads (the data covers 2024-01-01 .. 2024-01-30).
RANGE_START = "2024-01-05"
RANGE_END = "2024-01-24"
FUNNEL_CATEGORY = "economy"
SAMPLE_FRACTION = 0.5
TOP_PRODUCTS = 20
TOP_BRANDS = 20
TOP_ABANDONMENT = 10
LIVE_TOP = 50
LIVE_SHOWN = 20
SESSION_GAP = "30 minutes"
USER_RANGES = [("2024-01-01", "2024-01-01"), ("2024-01-05", "2024-01-24"), ("2024-01-10", "2024-02-10"), ("2023-01-01", "2023-12-31")]
SAMPLE_ROWS = 500
RATE_DIGITS = 9  # a mean of doubles is order-dependent in its last bits

Query = Callable[[SparkSession, str], DataFrame]


def edge(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            c = c.cast(DoubleType())
        elif isinstance(f.dataType, TimestampType):
            c = c.cast(TimestampNTZType())
        cols.append(c.alias(f.name))
    return df.select(*cols)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(events_from_tables(spark, sf_dir))


ENRICHED_COLUMNS = [
    "event_id",
    "event_ts",
    "date",
    "event_type",
    "product_id",
    "category_code",
    "brand",
    "price",
    "user_id",
    "user_session",
    "root_category",
]


def q_enriched_events(spark, sf):
    return edge(enriched(spark, sf).select(*ENRICHED_COLUMNS))


def q_event_time_parse(spark, sf):
    ev = load_table(spark, sf, "events")
    ts = F.col("ts").cast(TimestampType())
    batch_text = F.date_format(ts, BATCH_TIME_FORMAT)
    iso_text = F.date_format(ts, STREAM_TIME_FORMAT)
    both = (STREAM_TIME_FORMAT, BATCH_TIME_FORMAT)
    return edge(
        ev.select(
            "event_id",
            parse_event_time(batch_text).alias("batch_ts"),
            parse_event_time(iso_text, (STREAM_TIME_FORMAT,)).alias("iso_ts"),
            parse_event_time(batch_text, both).alias("either_from_batch"),
            parse_event_time(iso_text, both).alias("either_from_iso"),
            F.to_date(parse_event_time(batch_text)).alias("date"),
        )
    )


def q_daily_metrics(spark, sf):
    return edge(metrics.daily_metrics(enriched(spark, sf)))


def q_top_products(spark, sf):
    return edge(metrics.product_stats(enriched(spark, sf)))


def q_top_categories(spark, sf):
    return edge(metrics.category_stats(enriched(spark, sf)))


def q_top_brands(spark, sf):
    return edge(metrics.brand_stats(enriched(spark, sf)))


def q_funnel_stats(spark, sf):
    return edge(metrics.funnel_stats(enriched(spark, sf)))


def q_session_flags(spark, sf):
    return edge(abandonment.session_flags(enriched(spark, sf)))


def q_session_flags_session_grain(spark, sf):
    return edge(abandonment.session_flags(enriched(spark, sf), grain="session"))


def q_cart_abandonment(spark, sf):
    return edge(abandonment.cart_abandonment(abandonment.session_flags(enriched(spark, sf))))


def q_session_products(spark, sf):
    return edge(affinity.session_products(enriched(spark, sf)))


def q_product_session_counts(spark, sf):
    return edge(affinity.product_session_counts(affinity.session_products(enriched(spark, sf))))


def q_distinct_sessions(spark, sf):
    return edge(affinity.distinct_sessions(enriched(spark, sf)))


def q_co_occurrence(spark, sf):
    return edge(affinity.co_occurrence(affinity.session_products(enriched(spark, sf))))


def q_co_occurrence_blocked(spark, sf):
    """Same result with tiny blocks, so every session takes the hot-session path."""
    sp = affinity.session_products(enriched(spark, sf))
    return edge(affinity.co_occurrence(sp, block_size=1))


def q_product_affinity(spark, sf):
    return edge(affinity.product_affinity(enriched(spark, sf)))


def q_basket_affinity(spark, sf):
    baskets = baskets_from_lineitem(load_table(spark, sf, "lineitem"))
    return edge(affinity.product_affinity(baskets, session="basket_id", types=None))


def q_affinity_session_sample(spark, sf):
    sampled = sampling.session_sample(enriched(spark, sf), SAMPLE_FRACTION)
    return edge(affinity.product_affinity(sampled))


def q_affinity_row_sample(spark, sf):
    sampled = sampling.row_sample(enriched(spark, sf), SAMPLE_FRACTION)
    return edge(affinity.product_affinity(sampled))


def q_sample_export(spark, sf):
    from clickpulse.sinks.files import export_rows

    return edge(export_rows(sampling.row_sample(enriched(spark, sf), 0.01)))


def q_category_event_rows(spark, sf):
    return edge(metrics.category_event_rows(enriched(spark, sf)))


def q_brand_price_rows(spark, sf):
    return edge(metrics.brand_price_rows(enriched(spark, sf)))


def q_category_events(spark, sf):
    return edge(metrics.category_events(metrics.category_event_rows(enriched(spark, sf))))


def q_brand_revenue(spark, sf):
    return edge(metrics.brand_revenue(metrics.brand_price_rows(enriched(spark, sf))))


def q_category_events_text(spark, sf):
    from clickpulse.sinks.files import write_pair_text
    from clickpulse.session import scratch_path
    from clickpulse.sources.text import read_pair_text

    path = scratch_path(spark, "category-events-text")
    write_pair_text(metrics.category_event_rows(enriched(spark, sf)), path)
    rows = read_pair_text(spark, path, ("category", "event_type"))
    return edge(metrics.category_events(rows))


def q_brand_revenue_text(spark, sf):
    from clickpulse.sinks.files import write_pair_text
    from clickpulse.session import scratch_path
    from clickpulse.sources.text import read_pair_text

    path = scratch_path(spark, "brand-revenue-text")
    write_pair_text(metrics.brand_price_rows(enriched(spark, sf)), path)
    rows = read_pair_text(spark, path, ("brand", "price"))
    return edge(metrics.brand_revenue(rows))


def _cube(spark, sf):
    return cube.base_cube(enriched(spark, sf))


def q_base_cube(spark, sf):
    return edge(_cube(spark, sf))


def q_daily_metrics_cube(spark, sf):
    return edge(cube.daily_from_cube(_cube(spark, sf), enriched(spark, sf)))


def q_top_products_cube(spark, sf):
    return edge(cube.products_from_cube(_cube(spark, sf)))


def q_top_categories_cube(spark, sf):
    return edge(cube.categories_from_cube(_cube(spark, sf)))


def q_top_brands_cube(spark, sf):
    return edge(cube.brands_from_cube(_cube(spark, sf)))


def q_funnel_stats_cube(spark, sf):
    return edge(cube.funnel_from_cube(_cube(spark, sf)))


def q_category_events_cube(spark, sf):
    return edge(cube.category_events_from_cube(_cube(spark, sf)))


def q_brand_revenue_cube(spark, sf):
    return edge(cube.brand_revenue_from_cube(_cube(spark, sf)))


def _daily(spark, sf):
    return metrics.daily_metrics(enriched(spark, sf))


def _funnel(spark, sf):
    return metrics.funnel_stats(enriched(spark, sf))


def q_data_range(spark, sf):
    return edge(serving.data_range(enriched(spark, sf)))


def q_last_30_days(spark, sf):
    return edge(serving.last_days(_daily(spark, sf), 30))


def q_overview_kpis(spark, sf):
    return edge(serving.overview_kpis(_daily(spark, sf), RANGE_START, RANGE_END))


def q_range_distinct_users(spark, sf):
    return edge(serving.range_distinct_users(enriched(spark, sf), RANGE_START, RANGE_END))


def q_overview_trend(spark, sf):
    return edge(serving.overview_trend(_daily(spark, sf), RANGE_START, RANGE_END))


def q_funnel_range(spark, sf):
    return edge(serving.funnel_range(_funnel(spark, sf), RANGE_START, RANGE_END))


def q_funnel_range_category(spark, sf):
    return edge(serving.funnel_range(_funnel(spark, sf), RANGE_START, RANGE_END, FUNNEL_CATEGORY))


def q_funnel_stages(spark, sf):
    row = serving.funnel_range(_funnel(spark, sf), RANGE_START, RANGE_END)
    return edge(serving.funnel_stages(row))


def q_funnel_categories(spark, sf):
    return edge(serving.funnel_categories(_funnel(spark, sf)))


def q_abandonment_top(spark, sf):
    ab = abandonment.cart_abandonment(abandonment.session_flags(enriched(spark, sf)))
    top = serving.abandonment_top(ab, RANGE_START, RANGE_END, TOP_ABANDONMENT)
    return edge(
        top.withColumn("abandonment_rate", F.round("abandonment_rate", RATE_DIGITS))
    )


def q_products_by_revenue(spark, sf):
    return edge(serving.products_by_revenue(metrics.product_stats(enriched(spark, sf)), TOP_PRODUCTS))


def q_products_by_revenue_range(spark, sf):
    stats = metrics.product_stats(enriched(spark, sf), RANGE_START, RANGE_END)
    return edge(serving.products_by_revenue(stats, TOP_PRODUCTS))


def q_brands_by_revenue_range(spark, sf):
    stats = metrics.brand_stats(enriched(spark, sf), RANGE_START, RANGE_END)
    return edge(serving.brands_by_revenue(stats, TOP_BRANDS))


def q_brands_by_revenue(spark, sf):
    return edge(serving.brands_by_revenue(metrics.brand_stats(enriched(spark, sf)), TOP_BRANDS))


def q_categories_by_revenue(spark, sf):
    return edge(serving.categories_by_revenue(metrics.category_stats(enriched(spark, sf))))


def q_live_sessions(spark, sf):
    return edge(session_state(enriched(spark, sf)))


def q_live_session_windows(spark, sf):
    return edge(session_window_state(enriched(spark, sf), SESSION_GAP))


def q_live_top(spark, sf):
    return edge(serving.live_top(session_state(enriched(spark, sf)), LIVE_TOP))


def q_live_counters(spark, sf):
    return edge(serving.live_counters(session_state(enriched(spark, sf))))


def q_live_counters_shown(spark, sf):
    return edge(serving.live_counters(session_state(enriched(spark, sf)), LIVE_SHOWN))


def q_live_sessions_stream(spark, sf):
    from clickpulse.streaming.live import run_live_sessions_once

    return edge(run_live_sessions_once(spark, sf).drop("updated_at"))


def q_live_sessions_expiring(spark, sf):
    from clickpulse.streaming.live import run_live_sessions_once

    final = run_live_sessions_once(spark, sf, expiring=True)
    return edge(final.drop("updated_at", "expired"))


def q_event_json_roundtrip(spark, sf):
    from clickpulse.sinks.kafka import encode_events
    from clickpulse.sources.events import decode_event_json

    raw = enriched(spark, sf).select(
        F.date_format("event_ts", STREAM_TIME_FORMAT).alias("event_time"),
        "event_type",
        "product_id",
        "category_id",
        "category_code",
        "brand",
        "price",
        "user_id",
        "user_session",
    )
    decoded = decode_event_json(encode_events(raw))
    back = enrich(decoded, (STREAM_TIME_FORMAT, BATCH_TIME_FORMAT))
    return edge(back.drop("event_time", "category_id"))


def _written(spark, sf, name):
    """The batch job's own table, written and read back."""
    from clickpulse.plans.batch_job import run_batch
    from clickpulse.session import scratch_path

    done = run_batch(spark, events_from_tables(spark, sf), scratch_path(spark, "batch"), outputs=[name])
    return spark.read.parquet(done.outputs[name])


def q_batch_daily_metrics(spark, sf):
    return edge(_written(spark, sf, "daily_metrics"))


def q_batch_top_products(spark, sf):
    return edge(_written(spark, sf, "top_products"))


def q_batch_top_categories(spark, sf):
    return edge(_written(spark, sf, "top_categories"))


def q_batch_top_brands(spark, sf):
    return edge(_written(spark, sf, "top_brands"))


def q_batch_funnel_stats(spark, sf):
    return edge(_written(spark, sf, "funnel_stats"))


def q_batch_cart_abandonment(spark, sf):
    return edge(_written(spark, sf, "cart_abandonment"))


def q_batch_product_affinity(spark, sf):
    return edge(_written(spark, sf, "product_affinity"))


def q_batch_category_events(spark, sf):
    return edge(_written(spark, sf, "category_events"))


def q_batch_brand_revenue(spark, sf):
    return edge(_written(spark, sf, "brand_revenue"))


def q_batch_abandonment_top3(spark, sf):
    """The read over the written table, with a limit that bites."""
    top = serving.abandonment_top(_written(spark, sf, "cart_abandonment"), RANGE_START, RANGE_END, 3)
    return edge(top.withColumn("abandonment_rate", F.round("abandonment_rate", RATE_DIGITS)))


def q_event_defaults(spark, sf):
    """Events as the producer sends them: nulls as 0, 0.0 and empty text."""
    from clickpulse.sources.events import coerce_defaults

    columns = ["product_id", "category_code", "brand", "price", "user_id", "user_session"]
    return edge(coerce_defaults(enriched(spark, sf).select("event_id", *columns)))


def q_csv_roundtrip(spark, sf):
    from clickpulse.session import scratch_path
    from clickpulse.sinks.files import export_rows, write_events_csv
    from clickpulse.sources.events import read_events_csv

    path = scratch_path(spark, "events-csv")
    write_events_csv(export_rows(enriched(spark, sf)), path)
    back = enrich(read_events_csv(spark, path))
    return edge(back.drop("event_time", "category_id"))


def q_product_affinity_pruned(spark, sf):
    return edge(affinity.pruned_affinity(enriched(spark, sf)))


def q_basket_affinity_pruned(spark, sf):
    baskets = baskets_from_lineitem(load_table(spark, sf, "lineitem"))
    return edge(affinity.pruned_affinity(baskets, session="basket_id", types=None))


def q_attribute_affinity_pruned(spark, sf):
    """Parts and attributes of their lines as items: the frequent ones never reach the self-join."""
    baskets = baskets_with_attributes(load_table(spark, sf, "lineitem"))
    return edge(affinity.pruned_affinity(baskets, session="basket_id", types=None))


def _batches(spark, sf):
    """All events in three batches: most of the days up to a date; all later days; what came late for the first."""
    events = enriched(spark, sf)
    early, late = F.col("date") <= F.lit(RANGE_END).cast("date"), F.col("event_type") == "purchase"
    return [events.where(early & ~late), events.where(~F.coalesce(early, F.lit(False))), events.where(early & late)]


def q_affinity_incremental(spark, sf):
    """Products of a user over all days, added batch by batch: users come back in each."""
    from clickpulse.plans.incremental import advance_affinity, stored_affinity
    from clickpulse.session import scratch_path

    path = scratch_path(spark, "affinity-state")
    for epoch, events in enumerate(_batches(spark, sf)):
        advance_affinity(events, path, epoch, session="user_id")
    return edge(stored_affinity(spark, path))


def _refreshed(spark, sf, name):
    from clickpulse.plans.incremental import read_dated, refresh_dates
    from clickpulse.session import scratch_path

    out = scratch_path(spark, "dated")
    for batch, events in enumerate(_batches(spark, sf)):
        refresh_dates(events, out, batch, [name])
    return read_dated(spark, out, name)


def q_daily_metrics_incremental(spark, sf):
    return edge(_refreshed(spark, sf, "daily_metrics"))


def q_funnel_stats_incremental(spark, sf):
    return edge(_refreshed(spark, sf, "funnel_stats"))


def q_cart_abandonment_incremental(spark, sf):
    return edge(_refreshed(spark, sf, "cart_abandonment"))


def q_range_distinct_users_stored(spark, sf):
    from clickpulse.operators.users import range_users

    return edge(range_users(_refreshed(spark, sf, "user_sets"), RANGE_START, RANGE_END))


def q_distinct_users_ranges(spark, sf):
    from clickpulse.operators.users import daily_user_sets, users_of_ranges
    from clickpulse.plans.tuning import cut_lineage

    return edge(users_of_ranges(cut_lineage(daily_user_sets(enriched(spark, sf))), USER_RANGES))


def q_numbered_users(spark, sf):
    from clickpulse.operators.users import number_users

    return edge(number_users(enriched(spark, sf)))


def q_event_bottom_k(spark, sf):
    return edge(sampling.bottom_k(enriched(spark, sf).select(*ENRICHED_COLUMNS), SAMPLE_ROWS))


def q_category_events_ranked(spark, sf):
    """The order of the written text as a column."""
    from clickpulse.operators.topk import global_row_number

    counts = metrics.category_events(metrics.category_event_rows(enriched(spark, sf)))
    return edge(global_row_number(counts, [F.col("category"), F.col("event_type")], "rank"))


def q_csv_rejects(spark, sf):
    """Counts of an ingest of the events as CSV, some lines of which are cut short, misspelt or without a time."""
    from clickpulse.session import scratch_path
    from clickpulse.sources.events import ingest_csv

    rows = enriched(spark, sf)
    broken = lambda n: F.col("event_id") % n == 0
    time = F.when(broken(83), F.lit("some day")).otherwise(F.date_format("event_ts", BATCH_TIME_FORMAT))
    price = F.when(broken(97), F.lit("abc")).otherwise(F.col("price").cast("string"))
    rest = [F.lit(""), F.lit("a.b"), F.lit("x"), price, F.col("user_id").cast("string"), "user_session"]
    start = [time, "event_type", F.col("product_id").cast("string")]
    line = F.when(broken(89), F.concat_ws(",", *start)).otherwise(F.concat_ws(",", *start, *rest))
    path = scratch_path(spark, "broken-csv")
    rows.select(line.alias("event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session")).write.option("header", True).option("quote", "").option("escapeQuotes", False).option("sep", "\t").csv(path)
    got = ingest_csv(spark, path, scratch_path(spark, "ingested"))
    kept = spark.read.parquet(got.path).groupBy("status").count().collect()
    stored = {r["status"]: r["count"] for r in kept}
    return spark.createDataFrame([(got.read, got.accepted, got.rejected, got.null_times, stored.get("accepted", 0), stored.get("rejected", 0))], "rows_read long, accepted long, rejected long, null_times long, stored_accepted long, stored_rejected long")


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}

# Sampling operators whose rows depend on Spark's own random stream: no SQL form.
ROWS_ONLY = {"affinity_row_sample", "sample_export"}
