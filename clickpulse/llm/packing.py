"""Packing of token sequences into windows by best-fit decreasing.

Method: a document longer than a window is first cut into full windows; its
rest and all short documents are placed longest first, each into the open
window with the least room that still holds it, found with a segment tree
indexed by remaining room.

Placing needs only lengths. Full windows need none. The rests are dealt out by
a hash of their row's number into shards of bounded size, so that no task or
group holds them all, whatever ids repeat; within a shard the order is longest
first, then by id and start. Shards of many thousand rests leave next to no
padding.

A document without ids gives no piece. Repeated rows are packed as often as
they stand; null and repeated ids are ids like others.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.byte_bpe import byte_tokenizer
from clickpulse.llm.common import cut_rows, ship, staged, texts

SHARD_PIECES = 50_000  # mean number of rests in a shard
LOCAL_BITS = 33  # windows of one shard are numbered in so many bits
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class RoomTree:
    """Stacks of open windows by room, with a segment tree over the rooms that have one."""

    def __init__(self, capacity: int):
        self.leaves = 1 << (capacity + 1).bit_length()
        self.any = bytearray(2 * self.leaves)
        self.stacks: list[list[int]] = [[] for _ in range(capacity + 1)]

    def push(self, room: int, window: int) -> None:
        self.stacks[room].append(window)
        node = self.leaves + room
        while node and not self.any[node]:
            self.any[node] = 1
            node >>= 1

    def pop(self, room: int) -> int:
        window = self.stacks[room].pop()
        if not self.stacks[room]:
            node = self.leaves + room
            self.any[node] = 0
            node >>= 1
            while node and not (self.any[2 * node] or self.any[2 * node + 1]):
                self.any[node] = 0
                node >>= 1
        return window

    def least(self, size: int) -> int:
        """The least room of at least ``size`` that an open window has; -1 if none has."""
        node = self.leaves + size
        if self.any[node]:
            return size
        while node > 1:
            if not node & 1 and self.any[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.any[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return -1


def best_fit_decreasing(lengths, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, offset) of each length; lengths must come longest first, each within 1..capacity."""
    tree = RoomTree(capacity)
    window = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    opened = 0
    for i, size in enumerate(lengths):
        room = tree.least(size)
        if room < 0:
            room, w = capacity, opened
            opened += 1
        else:
            w = tree.pop(room)
        window[i], offset[i] = w, capacity - room
        if room > size:
            tree.push(room - size, w)
    return window, offset


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int) -> DataFrame:
    """Pieces of each document's ids: full windows from its start, then the rest.

    Null text counts as empty: the end id alone.
    """
    ship(docs.sparkSession)

    def run(batches):
        tokenizer = byte_tokenizer(tokenizer_path)
        end, step = int(end_id).to_bytes(4, "little"), 4 * capacity
        for batch in cut_rows(batches):
            out: tuple[list, ...] = ([], [], [], [], [])
            for doc, own in zip(batch.column("doc_id").to_pylist(), tokenizer.encode(texts(batch, "text")), strict=True):
                ids = np.array(own, "<u4").tobytes() + end
                for at in range(0, len(ids), step):
                    piece = ids[at : at + step]
                    for column, value in zip(out, (doc, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


def pack(pieces: DataFrame, capacity: int, key: str = "doc_id", shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Adds (sequence_id, offset) to pieces of ``length`` 1..capacity.

    ``pieces`` must give the same rows each time it is read. Full pieces are
    windows by themselves: even sequence ids, from the task that holds them;
    windows of shards have odd ones. Other columns pass through; earlier places
    are replaced.
    """
    ship(pieces.sparkSession)
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    pieces = pieces.select(*[F.col(f"`{c}`") for c in names])
    shard = next(x for x in (f"shard{i}" for i in range(len(names) + 1)) if x not in names)
    full = pieces.where(F.col("length") == capacity)
    rests = pieces.where(F.col("length") < capacity)
    shards = max(1, -(-rests.count() // shard_pieces))

    def place(group: pa.Table) -> pa.Table:
        group = group.take(pc.sort_indices(group, sort_keys=[("length", "descending"), (key, "ascending"), ("start", "ascending")]))
        window, offset = best_fit_decreasing(group.column("length").to_pylist(), capacity)
        first = group.column(shard)[0].as_py() << LOCAL_BITS
        return group.select(names).append_column("sequence_id", pa.array(2 * (first + window) + 1)).append_column("offset", pa.array(offset))

    schema = rests.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).schema
    placed = rests.withColumn(shard, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards))).groupBy(shard).applyInArrow(place, schema)
    alone = full.select("*", (2 * F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return alone.unionByName(placed)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 1, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Every document's pieces with their places; the ids themselves follow from (doc_id, start, length)."""
    pieces = staged(token_pieces(docs, tokenizer_path, capacity, end_id), "pieces")
    return pack(pieces, capacity, shard_pieces=shard_pieces)
