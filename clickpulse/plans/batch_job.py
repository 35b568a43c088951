"""The whole batch sequence (C13) over one enriched table.

The enriched events are written once as Parquet partitioned by ``date`` and
every output reads that table back. At 100 TB this beats one cache: each
roll-up reads only its columns (column pruning), date-range reads prune
partitions, and the written table cuts lineage so a lost executor re-reads
Parquet instead of re-parsing the raw input.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from clickpulse.operators import abandonment, affinity, cube, metrics, sampling
from clickpulse.operators.enrich import enrich
from clickpulse.session import shared_dir
from clickpulse.sinks.files import write_counts_tsv, write_pair_text, write_parquet
from clickpulse.sinks.jdbc import write_table


#: Tables that the coarse cube gives.
ROLL_UPS = {"daily_metrics", "top_categories", "top_brands", "funnel_stats", "category_events", "brand_revenue"}


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` has completed."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


@dataclass
class BatchResult:
    enriched_path: str
    outputs: dict[str, str] = field(default_factory=dict)
    skipped: bool = False


def output_builders(
    enriched: DataFrame,
    affinity_sample: float | None = None,
    base: DataFrame | None = None,
    affinity_row_sample: float | None = None,
) -> dict[str, Callable[[], DataFrame]]:
    """Builders of every serving table over one enriched frame.

    With ``base`` (a written :func:`clickpulse.operators.cube.coarse_cube`), the
    additive tables are roll-ups of it instead of scans of the events.
    Builders, not frames: affinity runs size checks while it is built, and
    each output is built inside its own task.
    """
    events_for_affinity = enriched
    if affinity_sample is not None:
        events_for_affinity = sampling.session_sample(enriched, affinity_sample)
    elif affinity_row_sample is not None:
        events_for_affinity = sampling.row_sample(enriched, affinity_row_sample)
    builders: dict[str, Callable[[], DataFrame]] = {
        "daily_metrics": lambda: metrics.daily_metrics(enriched),
        "top_products": lambda: metrics.product_stats(enriched),
        "top_categories": lambda: metrics.category_stats(enriched),
        "top_brands": lambda: metrics.brand_stats(enriched),
        "funnel_stats": lambda: metrics.funnel_stats(enriched),
        "cart_abandonment": lambda: abandonment.cart_abandonment(abandonment.session_flags(enriched)),
        "product_affinity": lambda: affinity.product_affinity(events_for_affinity),
        "category_events": lambda: metrics.category_events(metrics.category_event_rows(enriched)),
        "brand_revenue": lambda: metrics.brand_revenue(metrics.brand_price_rows(enriched)),
    }
    if base is not None:
        builders.update(
            {
                "daily_metrics": lambda: cube.daily_from_cube(base, enriched),
                "top_categories": lambda: cube.categories_from_cube(base),
                "top_brands": lambda: cube.brands_from_cube(base),
                "funnel_stats": lambda: cube.funnel_from_cube(base),
                "category_events": lambda: cube.category_events_from_cube(base),
                "brand_revenue": lambda: cube.brand_revenue_from_cube(base),
            }
        )
    return builders


def batch_outputs(
    enriched: DataFrame, affinity_sample: float | None = None, base: DataFrame | None = None
) -> dict[str, DataFrame]:
    """All serving tables as frames over one enriched frame."""
    return {name: build() for name, build in output_builders(enriched, affinity_sample, base).items()}


def _cluster_by_date(enriched: DataFrame, range_partitions: int | None) -> DataFrame:
    if range_partitions:
        enriched = enriched.repartitionByRange(range_partitions, "date", "user_session")
    return enriched.sortWithinPartitions("date")


def run_batch(
    spark: SparkSession,
    events: DataFrame,
    out_dir: str,
    jdbc_url: str | None = None,
    jdbc_properties: dict[str, str] | None = None,
    affinity_sample: float | None = None,
    export_text: bool = True,
    range_partitions: int | None = None,
    use_cube: bool = True,
    parallel: int = 4,
    outputs: list[str] | None = None,
    affinity_row_sample: float | None = None,
    jdbc_writers: int = 8,
) -> BatchResult:
    """Enrich once, write it, then compute and write every output.

    ``parallel``: how many outputs are written at once (independent jobs).

    ``use_cube``: write the coarse cube once and derive the additive tables
    from it (one scan of the events instead of six).

    ``outputs``: only these tables; an enriched table that an earlier run has
    finished is then read, not written again.

    ``affinity_sample``: fraction of sessions for affinity;
    ``affinity_row_sample``: fraction of rows instead (breaks baskets up).

    ``range_partitions``: leave unset for roughly time-ordered input (each
    task already holds few dates: a local sort keeps one open file per task,
    no shuffle). Set it for unordered input, to range-partition by (date,
    session) first: a hot date is then spread over many tasks and each task
    writes files for one or two dates only.

    An empty input writes nothing (S3). Outputs go to ``out_dir/<table>``
    as Parquet, and to JDBC (truncate + insert, serving types) if a URL is
    given. The two grouped-count results are also written as sorted TSV.
    """
    out = out_dir.rstrip("/")
    enriched_path = f"{out}/events_enriched"
    if outputs is None or not finished(spark, enriched_path):
        if events.isEmpty():
            return BatchResult(enriched_path, skipped=True)
        write_parquet(_cluster_by_date(enrich(events), range_partitions), enriched_path, partition_by=["date"])
    enriched = spark.read.parquet(enriched_path)
    result = BatchResult(enriched_path)
    shared_dir(spark)  # resolve the checkpoint folder once, before any thread needs it
    base = None
    if use_cube and (outputs is None or ROLL_UPS & set(outputs)):
        write_parquet(cube.coarse_cube(enriched), f"{out}/base_cube")
        base = spark.read.parquet(f"{out}/base_cube")
        result.outputs["base_cube"] = f"{out}/base_cube"
    def write_output(name: str, build: Callable[[], DataFrame]) -> None:
        path = f"{out}/{name}"
        write_parquet(build(), path)
        if jdbc_url:
            write_table(spark.read.parquet(path), jdbc_url, name, jdbc_properties, num_partitions=jdbc_writers)
        if export_text and name == "category_events":
            write_counts_tsv(spark.read.parquet(path), ["category", "event_type"], f"{out}/tsv/{name}")
        if export_text and name == "brand_revenue":
            write_counts_tsv(spark.read.parquet(path), ["brand"], f"{out}/tsv/{name}")
        result.outputs[name] = path

    jobs: list[tuple[Callable[..., None], tuple]] = [
        (write_output, (name, build))
        for name, build in output_builders(enriched, affinity_sample, base, affinity_row_sample).items()
        if outputs is None or name in outputs
    ]
    if export_text and outputs is None:
        jobs.append((write_pair_text, (metrics.category_event_rows(enriched), f"{out}/text/category_events")))
        jobs.append((write_pair_text, (metrics.brand_price_rows(enriched), f"{out}/text/brand_revenue")))
    # independent jobs over one written table, submitted together so the
    # scheduler overlaps them; any failure is raised here
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        for future in [pool.submit(fn, *args) for fn, args in jobs]:
            future.result()
    return result
