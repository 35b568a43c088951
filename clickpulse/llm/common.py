"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import io
import os
import threading
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one task, one core

#: whole texts travel in Arrow batches; 10,000 rows of them, the default, can be many megabytes. Buffers beyond 4 MB
#: don't come from Arrow's pool in the executor, and what they leave behind stays with its process
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", str(1 << 20))

_SHIP_LOCK = threading.Lock()
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application.

    The archive lies in the shared folder; workers import it by name, so what
    they keep (tokenizers, tables of chunks) lasts from task to task.
    """
    from clickpulse.session import scratch_path

    sc = spark.sparkContext
    if not sc.getConf().contains(BATCH_BYTES[0]):  # the submitter's value wins
        spark.conf.set(*BATCH_BYTES)
    with _SHIP_LOCK:
        if sc.applicationId in _SHIPPED:
            return
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, names in os.walk(root):
                for name in sorted(names):
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        z.write(path, os.path.relpath(path, os.path.dirname(root)))
        target = f"{scratch_path(spark, 'package')}/clickpulse.zip"
        path = sc._jvm.org.apache.hadoop.fs.Path(target)
        out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path)
        out.write(packed.getvalue())
        out.close()
        sc.addPyFile(target)
        _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark deletes the shuffle files of an execution at its end: what is written needs them no longer
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_OPEN = threading.local()  # the scratch scopes that this thread is in


class scratch:  # noqa: N801
    """Scope whose staged folders are deleted at its end, but for those of the frames it keeps.

    What a frame that leaves the scope still reads has to be kept, or written
    before the end. Kept folders belong to the scope around this one, if any.
    """

    def __init__(self) -> None:
        self.folders: dict[str, DataFrame] = {}

    def __enter__(self) -> scratch:
        _OPEN.scopes = [*getattr(_OPEN, "scopes", []), self]
        self.kept: set[str] = set()
        return self

    def keep(self, *frames: DataFrame) -> None:
        self.kept.update(df.staged_path for df in frames)

    def __exit__(self, *_) -> None:
        _OPEN.scopes = _OPEN.scopes[:-1]
        for path in [x for x in self.folders if x not in self.kept]:
            release(self.folders.pop(path))
        if _OPEN.scopes:
            _OPEN.scopes[-1].folders.update(self.folders)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a frame into the shared folder and read it back.

    The folder outlives a lost executor, and what reads it does not recompute
    what stands above it. Inside a ``scratch`` scope it is deleted with the scope.
    """
    from clickpulse.session import scratch_path

    path, conf = scratch_path(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(CLEANUP)
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(CLEANUP, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_path = path
    if scopes := getattr(_OPEN, "scopes", []):
        scopes[-1].folders[path] = out
    return out


def release(*frames: DataFrame) -> None:
    """Delete the folders of staged frames, once all that reads them has been written."""
    for df in frames:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df.staged_path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """The batch's texts; null reads as the empty text."""
    return [x or "" for x in batch.column(column).to_pylist()]


def cut_rows(batches, max_bytes: int = 1 << 19):
    """Slices of Arrow batches holding about ``max_bytes`` at most (one row at least).

    Smaller batches are put together. When the batches end, the worker gives freed memory back: it stays for later tasks.
    """
    for batch in _together(batches, max_bytes):
        rows = max(1, batch.num_rows * max_bytes // max(1, batch.nbytes))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    give_back()


def _together(batches, max_bytes: int):
    """Batches, several small ones as one of about ``max_bytes`` at most."""
    held, size = [], 0
    for batch in batches:
        if held and size + batch.nbytes > max_bytes:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def give_back() -> None:
    """Return what Arrow and the C library hold unused to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


# --- words as 64-bit numbers -------------------------------------------------

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CODE = np.arange(1, 257, dtype=np.uint64)
_LOWER_CODE = _CODE[_LOWER]
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over all output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> np.ndarray:
    """Odd multipliers, one for each byte position of a word."""
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * _GOLD) | np.uint64(1)


_MULT = _powers(64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of a string column's texts one after the other, offsets of each text). Null counts as empty."""
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    rows = len(column)
    at = np.frombuffer(column.buffers()[1], dtype=np.int64, count=rows + 1 + column.offset)[column.offset :]
    if not rows or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(rows + 1, np.int64)
    return np.frombuffer(column.buffers()[2], dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def lowered(column: pa.Array) -> pa.Array:
    """A string column with A-Z in lower case. Null counts as empty."""
    data, at = text_bytes(column)
    return pa.LargeStringArray.from_buffers(len(column), pa.py_buffer(at), pa.py_buffer(_LOWER[data]))


def word_places(data: np.ndarray, at: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, offsets of each row's words, where each word begins, where it ends) of texts' bytes."""
    none = np.zeros(0, np.int64)
    inside = ~_SPACE[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    cuts = at[:-1][at[:-1] < len(data)]
    starts[cuts] = inside[cuts]  # a row begins a word of its own
    begin = np.flatnonzero(starts)
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64), none, none
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | starts[1:]
    end = np.flatnonzero(stops) + 1
    sizes = end - begin
    first = np.cumsum(sizes) - sizes  # of each word, among the characters of words
    place = np.arange(first[-1] + sizes[-1], dtype=np.int32) - np.repeat(first.astype(np.int32), sizes)
    longest = int(sizes.max())
    mult = _MULT if longest <= len(_MULT) else _powers(longest)
    part = (_LOWER_CODE if lower else _CODE)[data[inside]]
    part *= mult[place]
    return mix64(np.add.reduceat(part, first)), np.searchsorted(begin, at), begin, end


def word_hashes(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words ``[^\\x20\\x09-\\x0D]+`` of a string column.

    Returns (hash of each word in order, offsets of each row's words). Null
    counts as empty. Works on the column's bytes as a whole, without a Python
    object for each word. Two words get one hash with a chance near 2**-56.
    """
    return word_places(*text_bytes(column), lower)[:2]


def window_hashes(words: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's runs of ``size`` words, and the offsets of each row's runs.

    A row with fewer words gives its whole sequence as one run; a row without
    words gives none.
    """
    counts = np.diff(offsets)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out = np.zeros(len(runs) + 1, np.int64)
    np.cumsum(runs, out=out[1:])
    if not out[-1]:
        return np.zeros(0, np.uint64), out
    row = np.repeat(np.arange(len(runs)), runs)
    begin = offsets[:-1][row] + (np.arange(out[-1]) - out[:-1][row])
    have = np.minimum(counts[row], size)
    total = np.zeros(out[-1], np.uint64)
    for k in range(size):
        use = np.flatnonzero(have > k)
        total[use] += words[begin[use] + k] * _MULT[k]
    return mix64(total + have.astype(np.uint64) * _GOLD), out


def first_of_each(keys: np.ndarray) -> np.ndarray:
    """Marks where a sorted array begins a new value."""
    mark = np.ones(len(keys), dtype=bool)
    mark[1:] = keys[1:] != keys[:-1]
    return mark


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def spread(values: list[bytes], kind: str, index: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Arrays of numbers of dictionary-coded items, put one after the other as ``index`` says.

    ``values``: each distinct item's numbers, packed as ``kind``; ``at``: where
    each row's items begin in ``index``. Returns the numbers and the rows' offsets.
    """
    size = np.dtype(kind).itemsize
    lengths = np.array([len(v) // size for v in values], np.int64)
    flat = np.frombuffer(b"".join(values), kind)
    begin = np.cumsum(lengths) - lengths
    counts = lengths[index]
    ends = np.concatenate([[0], np.cumsum(counts)])
    return flat[np.repeat(begin[index] - ends[:-1], counts) + np.arange(ends[-1])], ends[at]
