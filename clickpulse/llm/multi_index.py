"""Nearest neighbours by an inverted multi-index.

Method: the two halves of each vector are quantised by a codebook each; a cell
is a pair of centroids. A query walks the pairs by summed distance to its two
halves, with a heap (the multi-sequence walk), until the visited cells hold
``budget`` entries, and the entries are reranked by their true distance.

The codebooks are fitted by k-means on a sample of ``SAMPLE`` vectors (all, if
there are fewer), those with the least hash. The budget is set by measurement:
for ``CALIBRATE`` of the sampled vectors the true neighbours are found by brute
force over all rows, and the budget is the number of entries up to which
``recall`` of these neighbours lie in visited cells. Every row is indexed.

Equal vectors are one entry with its least ``k + 1`` ids; a larger id can't be
among ``k`` nearest, as ties go to the smaller one. Entries lie in blocks of
neighbouring cells of at most ``BLOCK`` entries (a cell that holds more spans
several), and queries come in packs of ``PACK``, so a task holds one block and
one pack at a time.

Vectors that are null, zero, of another length than most, or that hold null or
non-finite components take no part, neither as query nor as candidate; null ids
neither. Repeated rows count once.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.llm.common import ship, staged

SAMPLE = 20_000
CENTROIDS = 64
CALIBRATE = 200
RECALL = 0.97
BLOCK = 16_384
PACK = 4_096


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all rows of ``b``."""
    return np.maximum(0, (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T)


def k_means(points: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), min(k, len(points)), replace=False)].copy()
    for _ in range(rounds):
        nearest = _distances(points, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        counts = np.bincount(nearest, minlength=len(centres))
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


class MultiIndex:
    """Two codebooks and the number of entries in each cell."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.books, self.half = (first, second), first.shape[1]
        self.counts = np.zeros(len(first) * len(second), np.int64)

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        one, two = (_distances(v, b).argmin(1) for v, b in zip((vectors[:, : self.half], vectors[:, self.half :]), self.books, strict=True))
        return one * len(self.books[1]) + two

    def walk(self, vector: np.ndarray, budget: int) -> list[int]:
        """Cells by summed distance until they hold ``budget`` entries."""
        one, two = (_distances(v[None], b)[0] for v, b in zip((vector[: self.half], vector[self.half :]), self.books, strict=True))
        by_one, by_two = np.argsort(one, kind="stable"), np.argsort(two, kind="stable")
        one, two, width = one[by_one].tolist(), two[by_two].tolist(), len(two)
        names_one, names_two, counts = (by_one * width).tolist(), by_two.tolist(), self.counts
        heap, reached = [(one[0] + two[0], 0, 0)], [0] * len(one)  # reached: next column of each row
        out, held = [], 0
        while heap and held < budget:
            _, i, j = heapq.heappop(heap)
            cell = names_one[i] + names_two[j]
            if counts[cell]:
                out.append(cell)
                held += counts[cell]
            reached[i] = j + 1
            # a pair enters once both its neighbours nearer to the query have left
            if j + 1 < width and (i == 0 or reached[i - 1] > j + 1):
                heapq.heappush(heap, (one[i] + two[j + 1], i, j + 1))
            if i + 1 < len(one) and reached[i + 1] == j:
                heapq.heappush(heap, (one[i + 1] + two[j], i + 1, j))
        return out


def _matrix(column, dim: int) -> np.ndarray:
    flat = column.flatten() if len(column) else pa.array([], pa.float32())
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", good) & F.exists("v", lambda x: x != 0))
    most = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim = most["dim"] if most else 0
    return rows.where(F.size("v") == dim), dim


def nearest(vectors: DataFrame, every: int = 100, k: int = 10, recall: float = RECALL) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the ``k`` nearest found of each row whose id ``every`` divides.

    ``vectors``: vec_id, embedding. Score: Euclidean distance in double precision.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows, dim = _usable(vectors)
    result = "query_id long, rank int, vec_id long, score double"
    if not dim:
        return spark.createDataFrame([], result)
    # least k + 1 ids of equal vectors: first within salts, so that no task holds a common vector's rows
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(64))
    some = rows.dropDuplicates(["vec_id", "v"]).withColumn("salt", salt)
    some = some.withColumn("r", F.row_number().over(Window.partitionBy("v", "salt").orderBy("vec_id"))).where(F.col("r") <= k + 1)
    few = some.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("r") <= k + 1)
    entries = staged(few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "entries")
    total = entries.count()

    sample = entries.orderBy(F.xxhash64("v"), F.col("ids")[0]).limit(SAMPLE).select("v").toPandas()["v"]
    points = np.array(sample.tolist(), np.float64)
    size = max(1, min(CENTROIDS, int((total / 4) ** 0.5)))
    half = max(1, dim // 2)
    pair = (points[:, :half], points[:, half:]) if dim > 1 else (points, np.zeros((len(points), 1)))
    index = MultiIndex(k_means(pair[0], size), k_means(pair[1], size))
    one_dim = dim == 1

    def read(column):
        m = _matrix(column, dim)
        return np.hstack([m, np.zeros((len(m), 1))]) if one_dim else m

    def assign(batches):
        for batch in batches:
            yield batch.append_column("cell", pa.array(index.cells(read(batch.column("v"))), pa.int64()))

    indexed = staged(entries.mapInArrow(assign, "v array<double>, ids array<long>, cell long"), "index")
    for row in indexed.groupBy("cell").count().collect():  # size * size rows at most
        index.counts[row["cell"]] = row["count"]

    if one_dim:
        points = np.hstack([points, np.zeros((len(points), 1))])
    probes = points[:CALIBRATE]
    budget = _budget(indexed, index, probes, read, min(total, k), recall)

    # blocks of neighbouring cells; a cell of many entries is dealt over several
    first_block, blocks_of, block, held = {}, {}, 0, 0
    for cell in np.flatnonzero(index.counts).tolist():
        n = int(index.counts[cell])
        if held and held + n > BLOCK:
            block, held = block + 1, 0
        spans = -(-n // BLOCK)
        first_block[cell], blocks_of[cell] = block, spans
        if spans > 1:
            block, held = block + spans, 0
        else:
            held += n
    width = index.counts.size

    def place(batches):
        start, spans = np.zeros(width, np.int64), np.ones(width, np.int64)
        for c, b in first_block.items():
            start[c], spans[c] = b, blocks_of[c]
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            ids = np.array([x[0] for x in batch.column("ids").to_pylist()], np.int64)
            yield batch.append_column("block", pa.array(start[cell] + ids % spans[cell]))

    def ask(batches):
        for batch in batches:
            ids, vecs = batch.column("vec_id").to_pylist(), read(batch.column("v"))
            out: tuple[list, ...] = ([], [], [], [])
            for q, v, raw in zip(ids, vecs, batch.column("v").to_pylist(), strict=True):
                cells = index.walk(v, budget)
                mask = np.zeros(width, bool)
                mask[cells] = True
                seen = np.packbits(mask).tobytes()
                for b in sorted({first_block[c] + s for c in cells for s in range(blocks_of[c])}):
                    for column, value in zip(out, (q, raw, seen, b), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.list_(pa.float64())), pa.array(out[2], pa.binary()), pa.array(out[3], pa.int64())], ["query_id", "v", "seen", "block"])

    queries = rows.where(F.pmod("vec_id", F.lit(every)) == 0).dropDuplicates(["vec_id", "v"])
    packs = max(1, -(-queries.count() // PACK))
    pack = F.pmod(F.xxhash64("query_id"), F.lit(packs))
    asked = queries.mapInArrow(ask, "query_id long, v array<double>, seen binary, block long").withColumn("pack", pack)
    stored = indexed.mapInArrow(place, "v array<double>, ids array<long>, cell long, block long")
    stored = stored.withColumn("pack", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(packs - 1).cast("long"))))

    def rerank(key, entries: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        out: tuple[list, ...] = ([], [], [])
        if len(entries) and len(asks):
            x, cell, ids = np.array(entries["v"].tolist(), np.float64), entries["cell"].to_numpy(), entries["ids"].tolist()
            for at in range(0, len(asks), 64):
                part = asks.iloc[at : at + 64]
                q = np.array(part["v"].tolist(), np.float64)
                d = _distances(q, x)
                for i, (query, seen) in enumerate(zip(part["query_id"], part["seen"], strict=True)):
                    use = np.flatnonzero(np.unpackbits(np.frombuffer(seen, np.uint8), count=width)[cell])
                    near = d[i, use]
                    if len(use) > k + 1:
                        edge = np.partition(near, k)[k]  # k others and the query itself
                        use = use[near <= edge + 1e-9 * (1 + edge)]
                    true = np.sqrt(((x[use] - q[i]) ** 2).sum(1))
                    best = sorted((s, n) for s, u in zip(true.tolist(), use.tolist(), strict=True) for n in ids[u] if n != query)[:k]
                    for s, n in best:
                        out[0].append(query)
                        out[1].append(n)
                        out[2].append(s)
        return pd.DataFrame({"query_id": np.array(out[0], np.int64), "vec_id": np.array(out[1], np.int64), "score": np.array(out[2], np.float64)})

    found = stored.groupBy("block", "pack").cogroup(asked.groupBy("block", "pack")).applyInPandas(rerank, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score")).withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _budget(indexed: DataFrame, index: MultiIndex, probes: np.ndarray, read, k: int, recall: float) -> int:
    """Entries to visit so that ``recall`` of the probes' true neighbours lie in visited cells."""

    def best(batches):
        for batch in batches:
            x, cell = read(batch.column("v")), batch.column("cell").to_numpy()
            d = _distances(probes, x)
            take = np.argsort(d, axis=1)[:, : k + 1]
            n = take.shape[1]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(probes)), n)), pa.array(np.take_along_axis(d, take, 1).ravel()), pa.array(cell[take.ravel()])], ["probe", "d", "cell"])

    near = indexed.mapInArrow(best, "probe long, d double, cell long")
    top = near.withColumn("r", F.row_number().over(Window.partitionBy("probe").orderBy("d", "cell"))).where((F.col("r") > 1) & (F.col("r") <= k + 1)).collect()
    upto = {}
    for p, vector in enumerate(probes):
        cells = index.walk(vector, int(index.counts.sum()))
        upto[p] = dict(zip(cells, np.cumsum(index.counts[cells]).tolist(), strict=True))
    needed = sorted(upto[row["probe"]][row["cell"]] for row in top)
    least = 16 * (k + 1)
    return max(least, needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) if needed else least
