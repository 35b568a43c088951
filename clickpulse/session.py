"""Session construction and shared-folder helpers.

Operators never build a session; callers pass one in. ``build_session`` is the
one place that picks defaults for local runs (tests, bench). On a cluster the
submitter's configuration wins: a default is set only where the submitter set
nothing.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

_SHARED_DIR_LOCK = threading.Lock()

# Defaults that matter for correctness (UTC wall clock, see SURVEY T2) and for
# scale (AQE re-plans joins, coalesces small partitions and splits skewed ones).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # in a stream, events of a session window are merged within a task before the
    # shuffle, so a hot session ships a row for each window and task
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    # stream state off the JVM heap, checkpointed incrementally (millions of sessions)
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # checkpoint files of size checks and dictionaries go once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app_name: str = "clickpulse",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    wanted = dict(extra_conf or {})
    if shuffle_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    submitted = submitted_conf(wanted)
    for key, value in (DEFAULT_CONF | wanted).items():
        if key in wanted or not submitted.contains(key):
            builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    # the session zone is part of the semantics; enforce it even on a reused session
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def submitted_conf(launch: dict[str, str] | None = None) -> SparkConf:
    """What the submitter set (spark-submit, spark-defaults, environment).

    Starts the JVM if none runs yet, with ``launch`` (memory can only be set then).
    """
    first = SparkConf(loadDefaults=False)
    for key, value in (launch or {}).items():
        first.set(key, value)
    SparkContext._ensure_initialized(conf=first)
    found = SparkConf(loadDefaults=True)
    active = SparkSession.getActiveSession()
    if active is not None:  # a session of the caller's: its settings are the submitter's
        for key, value in active.sparkContext.getConf().getAll():
            found.set(key, value)
    return found


def apply_scale(spark: SparkSession, path: str) -> dict[str, str]:
    """Set ``scale_conf`` for the files of ``path`` (a glob), where the submitter set nothing."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(fs_path) or []
    size = sum(fs.getContentSummary(s.getPath()).getLength() for s in found)
    submitted = spark.sparkContext.getConf()
    chosen = {k: v for k, v in scale_conf(size).items() if not submitted.contains(k)}
    for key, value in chosen.items():
        spark.conf.set(key, value)
    return chosen


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 * 1024**2) -> dict[str, str]:
    """Shuffle sizing for a given input size (pass as ``extra_conf``).

    AQE can only coalesce shuffle partitions, never split them, so the
    initial count must be high enough for the largest shuffle: about one
    partition per ``target_partition_bytes`` of input (at least 200). AQE
    then merges small ones towards the advisory size and splits skewed
    partitions of joins.
    """
    partitions = max(200, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024**2),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024**2),
    }


def object_store_conf(
    endpoint: str,
    access_key: str,
    secret_key: str,
    path_style: bool = True,
    ssl: bool = True,
) -> dict[str, str]:
    """Session settings for an S3-compatible store (S2); pass as ``extra_conf``.

    Paths stay plain arguments, so ``s3a://``, ``hdfs://`` and ``file:`` all
    work with the same operators. Credentials come from the caller.
    """
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (the cluster names it). Only when it is
    unset, as in local tests, a fresh folder is made and registered.
    """
    with _SHARED_DIR_LOCK:  # outputs may be built from several threads
        return _shared_dir(spark)


def _shared_dir(spark: SparkSession) -> str:
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a shared folder (e.g. hdfs:// or s3a://); "
                "a machine-local folder does not survive executor loss"
            )
        configured = tempfile.mkdtemp(prefix="clickpulse-ckpt-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder (never reused between runs)."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for code that needs an OS path (tests only)."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
