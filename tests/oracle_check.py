"""Run every registered query next to its SQL equivalent and compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares row count, column names and an order-insensitive hash of values
(columns sorted by name), like the driver's correctness gate.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return "None"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> tuple[int, list[str], str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]
    return len(rows), sorted(columns), h


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    import __spark_entry__ as entry
    from clickpulse.session import build_session

    spark = build_session("oracle-check", master="local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            got = digest(df.columns, rows)
        except Exception as exc:  # report and continue
            print(f"FAIL {name}: spark error {type(exc).__name__}: {str(exc)[:400]}")
            bad += 1
            continue
        dt = time.time() - t0
        if name not in sqls:
            print(f"ROWS {name}: {got[0]} rows ({dt:.1f}s, no SQL form)")
            continue
        try:
            res = con.execute(sqls[name])
            cols = [d[0] for d in res.description]
            want = digest(cols, [tuple(r) for r in res.fetchall()])
        except Exception as exc:
            print(f"FAIL {name}: duckdb error {type(exc).__name__}: {str(exc)[:400]}")
            bad += 1
            continue
        if got == want:
            print(f"OK   {name}: {got[0]} rows ({dt:.1f}s)")
        else:
            bad += 1
            print(f"FAIL {name}: spark={got} duckdb={want}")
    spark.stop()
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
