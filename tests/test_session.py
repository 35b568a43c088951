"""The submitter's settings win over the library's defaults."""

from __future__ import annotations

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
from clickpulse.session import apply_scale, build_session, object_store_conf
s = build_session("t", master="local[1]", extra_conf=object_store_conf("http://store:9000", "a", "b"))
keys = ("spark.sql.adaptive.skewJoin.enabled", "spark.sql.session.timeZone", "spark.ui.enabled", "spark.hadoop.fs.s3a.endpoint")
chosen = apply_scale(s, "README.md")
print("FOUND", *[s.conf.get(k) for k in keys], s.conf.get("spark.sql.shuffle.partitions"), "spark.sql.shuffle.partitions" in chosen)
"""


def test_a_submitted_value_survives():
    args = "--conf spark.sql.adaptive.skewJoin.enabled=false --conf spark.sql.shuffle.partitions=7 pyspark-shell"
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": args, "PYTHONPATH": ROOT}
    said = subprocess.run([sys.executable, "-c", CODE], env=env, cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert "FOUND false UTC false http://store:9000 7 False" in said.stdout, said.stdout + said.stderr[-2000:]
