"""Token ids in files coded by a static range asymmetric numeral system.

Method: the ids of a run of documents (a segment) share one table of
frequencies, made from all of them. The segment is cut into independent
blocks; in each, many coder states (lanes) take turns, token i belonging to
lane ``i mod lanes``. A block keeps all lanes' states at every ``CHECK_STEPS``
steps with the place in its words, so decoding can begin there, and a crc32 of
its ids. Blocks decode side by side; here all lanes of all blocks of a segment
step together in one vector.

Segment layout (little endian): header ``<4sBBHIIQ`` (magic, bits of the
frequency total, 0, lanes, tokens in a full block, number of symbols in the
table, number of tokens); table (its size u32, then deflated: steps between
symbols u32, frequencies u32); number of blocks u32; for each block ``<IIII`` (words, crc32 of its ids, checkpoints, 0);
then for each block its checkpoints (place u32 and the lanes' states u64 each)
and its words (u32). The first checkpoint holds the states at the start.

Files are Parquet rows (part, segment, doc_ids, lengths, body) in ascending
document order, so any store that Spark writes to can hold them.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickpulse.llm.byte_ids import chunked
from clickpulse.llm.common import cut_rows, ship

MAGIC = b"RANS"
HEAD = "<4sBBHIIQ"
LOW = 31  # states stay in [2**31, 2**63)
WORD, WORD_MASK = np.uint64(32), np.uint64(0xFFFFFFFF)
BLOCK_TOKENS = 1 << 18
CHECK_STEPS = 256
SEGMENT_TOKENS = 1 << 22
SLICE = 8 << 20  # bytes of texts that are cut and coded together
FILES = "part int, segment int, doc_ids array<long>, lengths array<long>, body binary"


def frequencies(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(symbols, frequencies summing to 2**bits, bits); every symbol that occurs has one at least."""
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    counts = counts[symbols].astype(np.float64)
    bits = max(12, min(24, int(len(symbols)).bit_length() + 4))
    total = 1 << bits
    freq = np.maximum(1, np.floor(counts * (total / counts.sum()))).astype(np.int64)
    over = int(freq.sum()) - total
    if over > 0:  # take from the largest what the least ones were given
        order = np.argsort(-freq, kind="stable")
        room = freq[order] - 1
        taken = np.minimum(room, np.maximum(0, over - (np.cumsum(room) - room)))
        freq[order] -= taken
    else:
        freq[np.argmax(freq)] -= over
    return symbols.astype(np.uint32), freq.astype(np.uint32), bits


def encode_segment(ids: np.ndarray) -> bytes:
    """One segment's bytes; ``ids`` are unsigned 32-bit numbers, at least one."""
    n = len(ids)
    lanes = min(256, max(1, n // 256))
    per_block = BLOCK_TOKENS // lanes * lanes if n > BLOCK_TOKENS else -(-n // lanes) * lanes
    blocks, steps = -(-n // per_block), per_block // lanes
    symbols, freq, bits = frequencies(ids)
    where = np.zeros(int(symbols[-1]) + 1, np.int64)
    where[symbols] = np.arange(len(symbols))
    place = where[ids]
    padded = np.full(blocks * per_block, int(np.argmax(freq)), np.int64)
    padded[:n] = place
    grid = padded.reshape(blocks, steps, lanes)
    starts = np.concatenate([[0], np.cumsum(freq[:-1])]).astype(np.uint64)
    both = ((freq.astype(np.uint64) << WORD) | starts)[grid.transpose(1, 0, 2).reshape(steps, -1)]
    top, shift = np.uint64(63 - bits), np.uint64(bits)
    x = np.full(blocks * lanes, 1 << LOW, np.uint64)
    words: list[np.ndarray] = []
    moved = np.zeros((steps, blocks), np.int64)
    checks: dict[int, np.ndarray] = {}
    for s in range(steps - 1, -1, -1):
        f = both[s] >> WORD
        out = x >= (f << top)
        which = np.flatnonzero(out)
        full = x[which]
        words.append(full.astype(np.uint32))
        x[which] = full >> WORD
        moved[s] = np.count_nonzero(out.reshape(blocks, lanes), axis=1)
        q = x // f
        f *= q
        x -= f
        q <<= shift
        x += q
        x += both[s] & WORD_MASK
        if s % CHECK_STEPS == 0:
            checks[s] = x.reshape(blocks, lanes).copy()
    stream = np.concatenate(words[::-1])
    owner = np.repeat(np.tile(np.arange(blocks, dtype=np.uint16), steps), moved.ravel())
    stream = stream[np.argsort(owner, kind="stable")]
    ends = np.concatenate([[0], np.cumsum(moved.sum(axis=0))])
    before = np.cumsum(moved, axis=0) - moved
    at = sorted(checks)
    tables = zlib.compress(np.diff(symbols, prepend=np.uint32(0)).astype("<u4").tobytes() + freq.astype("<u4").tobytes(), 6)
    parts = [struct.pack(HEAD, MAGIC, bits, 0, lanes, per_block, len(symbols), n), struct.pack("<I", len(tables)), tables, struct.pack("<I", blocks)]
    for b in range(blocks):
        own = ids[b * per_block : (b + 1) * per_block].astype("<u4")
        parts.append(struct.pack("<IIII", ends[b + 1] - ends[b], zlib.crc32(own.tobytes()), len(at), 0))
    for b in range(blocks):
        for s in at:
            parts += [struct.pack("<I", before[s, b]), checks[s][b].tobytes()]
        parts.append(stream[ends[b] : ends[b + 1]].tobytes())
    return b"".join(parts)


class Segment:
    """A segment's table, block index and blocks, read without decoding."""

    def __init__(self, body: bytes):
        magic, self.bits, _, self.lanes, self.per_block, count, self.n = struct.unpack_from(HEAD, body)
        if magic != MAGIC:
            raise ValueError("not a segment of this format")
        at = struct.calcsize(HEAD)
        (size,) = struct.unpack_from("<I", body, at)
        both = np.frombuffer(zlib.decompress(body[at + 4 : at + 4 + size]), "<u4")
        self.symbols = np.cumsum(both[:count], dtype=np.uint32)
        self.freq = both[count:]
        at += 4 + size
        (blocks,) = struct.unpack_from("<I", body, at)
        self.index = [struct.unpack_from("<IIII", body, at + 4 + 16 * b) for b in range(blocks)]
        at += 4 + 16 * blocks
        self.checks, self.words = [], []
        for n_words, _, n_checks, _ in self.index:
            rows = np.frombuffer(body, np.dtype([("place", "<u4"), ("states", "<u8", (self.lanes,))]), n_checks, at)
            at += rows.nbytes
            self.checks.append(rows)
            self.words.append(np.frombuffer(body, "<u4", n_words, at))
            at += 4 * n_words
        starts = np.concatenate([[0], np.cumsum(self.freq[:-1])])
        self.slots = np.repeat(self.symbols, self.freq)
        bias = np.arange(len(self.slots)) - np.repeat(starts, self.freq)
        self.both = (np.repeat(self.freq, self.freq).astype(np.uint64) << WORD) | bias.astype(np.uint64)

    def _steps(self, blocks: list[int], check: int, steps: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``steps`` steps from a checkpoint on, for some blocks together; the states then."""
        mask, shift, low = np.uint64((1 << self.bits) - 1), np.uint64(self.bits), np.uint64(1 << LOW)
        x = np.concatenate([self.checks[b]["states"][check] for b in blocks]).astype(np.uint64)
        sizes = [len(self.words[b]) for b in blocks]
        stream = np.concatenate([self.words[b] for b in blocks]).astype(np.uint64)
        pos = np.concatenate([[0], np.cumsum(sizes[:-1])]).astype(np.int64) + [int(self.checks[b]["place"][check]) for b in blocks]
        out = np.empty((steps, len(x)), np.int32)
        for s in range(steps):
            slot = x & mask
            out[s] = slot
            both = self.both[slot.view(np.int64)]
            x >>= shift
            x *= both >> WORD
            both &= WORD_MASK
            x += both
            short = x < low
            which = np.flatnonzero(short)
            count = np.count_nonzero(short.reshape(len(blocks), -1), axis=1)
            ends = np.cumsum(count)
            at = np.arange(len(which)) + np.repeat(pos - (ends - count), count)
            x[which] = (x[which] << WORD) | stream.take(at, mode="clip")
            pos += count
        order = out.reshape(steps, len(blocks), self.lanes).transpose(1, 0, 2)
        return self.slots[order], x

    def all(self) -> np.ndarray:
        """All ids, checked against the blocks' checksums."""
        found, states = self._steps(list(range(len(self.index))), 0, self.per_block // self.lanes)
        if (states != np.uint64(1 << LOW)).any():
            raise ValueError("a block's states do not end as they began")
        ids = found.reshape(-1)[: self.n]
        for b, (_, crc, _, _) in enumerate(self.index):
            if zlib.crc32(ids[b * self.per_block : (b + 1) * self.per_block].tobytes()) != crc:
                raise ValueError(f"checksum of block {b}")
        return ids

    def range(self, first: int, last: int) -> np.ndarray:
        """Ids first..last-1, decoding from the nearest checkpoint of each block only."""
        out = []
        while first < last:
            block, inside = divmod(first, self.per_block)
            end = min(last - block * self.per_block, self.per_block)
            check = inside // self.lanes // CHECK_STEPS
            begin = check * CHECK_STEPS * self.lanes
            found = self._steps([block], check, -(-(end - begin) // self.lanes))[0].reshape(-1)
            out.append(found[inside - begin : end - begin])
            first = block * self.per_block + end
        return np.concatenate(out) if out else np.zeros(0, np.uint32)


def write_token_files(docs: DataFrame, tokenizer_path: str, out: str, end_id: int = 1, partitions: int | None = None) -> None:
    """Encode each document's ids, with ``end_id`` after them, into files in ascending doc_id order.

    ``docs``: doc_id, text; null text counts as empty. Rows with equal ids
    stand next to each other, null ids first. Range partitioning by doc_id, then
    a hash of the text and the row's number, gives each task a run of documents,
    however many rows one id has; it holds one segment's ids at a time.
    """
    spark = docs.sparkSession
    ship(spark)

    def run(batches):
        tokenizer, end = chunked(tokenizer_path), int(end_id).to_bytes(4, "little")
        part, segment = TaskContext.get().partitionId(), 0
        docs_in, sizes, ids, total = [], [], [], 0

        def done():
            body = encode_segment(np.frombuffer(b"".join(ids), "<u4"))
            values = [part, segment, docs_in, sizes, body]
            kinds = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], ["part", "segment", "doc_ids", "lengths", "body"])

        for batch in cut_rows(batches, SLICE):
            found, at = tokenizer.column_ids(batch.column("text"))
            for doc, a, b in zip(batch.column("doc_id").to_pylist(), at.tolist(), at[1:].tolist(), strict=False):
                docs_in.append(doc)
                ids.append(found[a:b].tobytes() + end)
                sizes.append(b - a + 1)
                total += sizes[-1]
                if total >= SEGMENT_TOKENS:
                    yield done()
                    docs_in, sizes, ids, total = [], [], [], 0
                    segment += 1
        if docs_in:
            yield done()

    rows = docs.select("doc_id", "text")
    n = partitions or max(1, rows.rdd.getNumPartitions())
    keyed = rows.select("doc_id", "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row"))
    ordered = keyed.repartitionByRange(n, "doc_id", "h", "row").sortWithinPartitions("doc_id", "h", "row").select("doc_id", "text")
    ordered.mapInArrow(run, FILES).write.parquet(out)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32) decoded from the files, every block's checksum verified."""
    ship(spark)

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                get = lambda name, row=row, batch=batch: batch.column(name)[row]
                ids = Segment(get("body").as_py()).all()
                sizes = get("lengths").values.to_numpy()
                ends = np.cumsum(sizes)
                raw = ids.astype("<u4").tobytes()
                crc = [zlib.crc32(raw[4 * (e - s) : 4 * e]) for s, e in zip(sizes, ends, strict=True)]
                count = len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([get("part").as_py()] * count, pa.int32()), pa.array([get("segment").as_py()] * count, pa.int32()), get("doc_ids").values, pa.array(ends - sizes), pa.array(sizes), pa.array(crc, pa.int64())],
                    ["part", "segment", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    files = spark.read.schema(FILES).parquet(path)
    docs = files.mapInArrow(run, "part int, segment int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    # tokens before each segment: sums over the lengths alone, one row a segment, then one row a part
    each = files.select("part", "segment", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    own = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    parts = each.groupBy("part").agg(F.sum("n").alias("n"))
    before = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    base = each.select("part", "segment", F.coalesce(F.sum("n").over(own), F.lit(0)).alias("local")).join(before, "part")
    return docs.join(base, ["part", "segment"]).select("doc_id", (F.col("before") + F.col("local") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
