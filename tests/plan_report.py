"""Summarize the executed (final AQE) physical plan of every registered query.

Usage: python tests/plan_report.py [sf_dir] > PLANS.md
For each query: shuffles by kind, broadcasts, join kinds, reused exchanges,
whole-stage-codegen spans, and the columns each Parquet scan reads.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

COUNTERS = {
    "hash shuffles": r"Exchange hashpartitioning",
    "range shuffles": r"Exchange rangepartitioning",
    "single-partition": r"Exchange SinglePartition",
    "broadcasts": r"BroadcastExchange",
    "reused": r"ReusedExchange",
    "BHJ": r"BroadcastHashJoin",
    "SMJ": r"SortMergeJoin",
    "BNLJ": r"BroadcastNestedLoopJoin",
    "partial aggs": r"HashAggregate\(keys=\[[^\]]*\], functions=\[partial_",
    "sort aggs": r"SortAggregate|ObjectHashAggregate",
    "top-k": r"TakeOrderedAndProject",
    "codegen spans": r"WholeStageCodegen|\*\(\d+\)",
    "python": r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas",
}


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def summarize(text: str) -> dict[str, object]:
    final = text.split("== Initial Plan ==")[0]
    out: dict[str, object] = {}
    for name, pat in COUNTERS.items():
        if name == "codegen spans":
            out[name] = len(set(re.findall(r"\*\((\d+)\)", final)))
        else:
            out[name] = len(re.findall(pat, final))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\].*?Location: \w+\([^)]*\)\[[^\]]*?/([\w.]+)\]", final)
    out["scans"] = "; ".join(f"{tbl}({len(cols.split(','))} cols)" for cols, tbl in scans) or "-"
    pushed = re.findall(r"PushedFilters: \[([^\]]+)\]", final)
    out["pushed"] = "; ".join(sorted(set(pushed))) or "-"
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as entry
    from clickpulse.session import build_session

    spark = build_session("plan-report", master="local[8]", shuffle_partitions=8)
    rows = []
    for name, fn in entry.queries().items():
        df = fn(spark, sf_dir)
        df.collect()  # run it, so explain() shows the final adaptive plan
        rows.append((name, summarize(plan_text(df))))
    spark.stop()
    cols = [c for c in COUNTERS if c != "python"] + ["python", "scans", "pushed"]
    print(f"# Executed plans at {sf_dir} (local[8], AQE on)\n")
    print("Generated by `python tests/plan_report.py`. Counts are taken from the final")
    print("adaptive plan of each registered query after it ran; size-check and")
    print("checkpoint jobs that run while a query is built are not included.\n")
    print("| query | " + " | ".join(cols) + " |")
    print("|" + "---|" * (len(cols) + 1))
    for name, s in rows:
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |")


if __name__ == "__main__":
    main()
