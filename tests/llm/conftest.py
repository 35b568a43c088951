from __future__ import annotations

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

LONG = " ".join(f"w{i % 977} of the x{i % 31}." for i in range(6000))
EDGE_TEXTS = [
    None,
    "",
    " ",
    "\n \t\x0b\x0c\r\n",
    "one",
    "One two",
    "one TWO three",
    "the quick brown fox jumps over the lazy dog. " * 9,
    "the quick brown fox jumps over the lazy dog. " * 9,
    "The quick brown fox jumps over the lazy dog. " * 9 + "again",
    LONG,
    LONG + " tail",
    "x" * 30_000,
    "é ﬁ 你好 😀 ́a\x00b <|endoftext|> <s> ▁▁x  y",
    "ΣΑΣ it's 12 345 ### $$$ A|B\n\n\nline\nline\nline\n",
    "über straße der die das und nicht mit von ist im den\n" * 12,
]
EXTRA = ("id", "token", "class", "row", "span", "n", "bucket", "stratum", "levels", "cut", "query_id", "__doc", "shard")


def documents(texts, start: int = 0):
    n = len(texts)
    table = {
        "doc_id": pa.array([None if i == n - 1 else start + i for i in range(n)], pa.int64()),
        "text": pa.array(texts, pa.string()),
        "lang": pa.array([[None, "en", "de", "xx", "EN-us"][i % 5] for i in range(n)]),
        "source": pa.array([[None, "src0", "src1"][i % 3] for i in range(n)]),
        "n_chars": pa.array([None if t is None else len(t) for t in texts], pa.int64()),
    }
    return pa.table(table | {c: pa.array([c] * n) for c in EXTRA})


def write_tables(folder, docs: pa.Table, labels: pa.Table, embeddings: pa.Table) -> str:
    for name, table in (("documents", docs), ("labels", labels), ("embeddings", embeddings)):
        pq.write_table(table, os.path.join(folder, f"{name}.parquet"))
    return str(folder)


def embeddings_table(rows) -> pa.Table:
    return pa.table({"vec_id": pa.array([r[0] for r in rows], pa.int64()), "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float32())), "label": pa.array([0] * len(rows), pa.int32()), "v": pa.array(["v"] * len(rows))})


@pytest.fixture(scope="session")
def edge_dir(tmp_path_factory):
    """Nulls, empty and long texts, repeated rows, clashing columns."""
    docs = documents(EDGE_TEXTS + ["null id stands last"])
    again = docs.slice(7, 1)  # a whole row once more
    ids = [0, 1, 7, 7, 10, None, 999]
    labels = pa.table({"doc_id": pa.array(ids, pa.int64()), "quality": pa.array([1, 1, 0, 1, None, 1, 1], pa.int32()), "toxic": pa.array([0] * 7, pa.int32())})
    one = [1.0, 0.0, 0.5]
    rows = [(0, one), (100, one), (1, one), (1, one), (2, [0.0, 0.0, 0.0]), (3, None), (4, [1.0, None, 0.0]), (5, [float("nan"), 1.0, 0.0]), (6, [float("inf"), 1.0, 0.0]), (200, [0.9, 0.1, 0.4]), (7, [1.0, 2.0]), (None, one)]
    return write_tables(tmp_path_factory.mktemp("edge"), pa.concat_tables([docs, again]), labels, embeddings_table(rows))


@pytest.fixture(scope="session")
def empty_dir(tmp_path_factory):
    labels = pa.table({"doc_id": pa.array([], pa.int64()), "quality": pa.array([], pa.int32()), "toxic": pa.array([], pa.int32())})
    return write_tables(tmp_path_factory.mktemp("empty"), documents([None]).slice(0, 0), labels, embeddings_table([]))


def read(folder: str, name: str) -> list[dict]:
    return pq.read_table(os.path.join(folder, f"{name}.parquet")).to_pylist()
