"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run to completion with the ``noop`` sink (full execution, no
driver collect), twice; the faster run is reported. Prints ONE JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

RUNS = 2
HEADLINE = [
    "daily_metrics",
    "top_products",
    "top_categories",
    "top_brands",
    "funnel_stats",
    "cart_abandonment",
    "category_events",
    "brand_revenue",
    "product_affinity",
    "basket_affinity",
    "live_sessions",
    "overview_kpis",
    "abandonment_top",
    "products_by_revenue",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from clickpulse.session import build_session

    scratch = tempfile.mkdtemp(prefix="clickpulse-bench-")
    spark = build_session(
        "clickpulse-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus) * 2,
        extra_conf={"spark.driver.memory": "16g", "spark.checkpoint.dir": f"{scratch}/ckpt"},
    )
    from clickpulse.plans.batch_job import run_batch
    from clickpulse.plans.catalog import QUERIES
    from clickpulse.sources.tables import events_from_tables

    # warm-up: JVM, parquet footers, codegen caches
    QUERIES["daily_metrics"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    # each query runs twice; the faster run is reported (steady state: the
    # first run of a plan shape also pays whole-stage code generation, a fixed
    # cost that large inputs amortize). First-run times are reported too.
    timings: dict[str, float] = {}
    first: dict[str, float] = {}
    for name in HEADLINE:
        runs = []
        for _ in range(RUNS):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        first[name] = round(runs[0], 3)
        timings[name] = round(min(runs), 3)

    t0 = time.perf_counter()
    run_batch(spark, events_from_tables(spark, sf_dir), f"{scratch}/batch", export_text=True)
    timings["batch_job_all_outputs"] = round(time.perf_counter() - t0, 3)

    from clickpulse.streaming.live import run_live_sessions_once

    t0 = time.perf_counter()  # seven restarts of the live stream, one micro-batch each
    run_live_sessions_once(spark, sf_dir, expiring=True).write.format("noop").mode("overwrite").save()
    stream = round(time.perf_counter() - t0, 3)

    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "first_run_total": round(sum(first.values()), 3),
                "first_run": first,
                "live_pieces_stream": stream,
                "runs_per_query": RUNS,
                "sf": float(m.group(1)) if m else sf_dir,
            }
        )
    )


if __name__ == "__main__":
    main()
