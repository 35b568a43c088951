"""K-means over a VA-file: few-bit cells first, whole vectors only where intervals overlap.

Method: every dimension is cut into ``2**bits`` cells, and a vector's cells are
stored beside it, one byte each. For a set of centroids, lookup tables hold for
each (dimension, cell, centroid) the least and the greatest contribution to the
distance that a component in the cell can make; their sums are an interval of
the distance to each centroid. Where one centroid's interval lies below all
others the vector is assigned from its cells alone; only where intervals
overlap the whole vector is fetched and measured exactly. What all centroids
share, the distance to their mean point, is left out of the tables, which makes
the intervals narrow.

A round needs no stored assignment. The sums of the clusters change only by the
vectors that changed cluster, and a vector whose cells decide for one and the
same centroid under the last round's and this round's centroids did not. The
pass over the cells finds the others; their vectors are fetched by a join (a
broadcast of row numbers, if they are counted to be few, else the table is
scanned and decides in place), measured under both sets of centroids, and what
left or entered a cluster is summed. The driver holds the centroids and their
sums, ``k * dims`` numbers.

All arithmetic is on integers, so results do not depend on order.

Vectors take part that have exactly ``dims`` components, none of them null or
non-finite; integers beyond +-2**27, whose squared distances a long can't
hold, take no part either. Repeated rows and ids are vectors of their own. A
null id takes part, but is a first centroid only after all others. Fewer vectors than
``k`` give as many centroids; none give no rows. Other columns take no part.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import ship, staged
from clickpulse.plans.tuning import fits

BITS = 8
SAMPLE = 10_000  # vectors whose quantiles bound the cells; any bounds give the same result
LARGEST = 1 << 27
FETCH_ROWS = 2_000_000  # row numbers that are broadcast at most


class Cells:
    """Cells of each dimension: ``low[d, q] <= component <= high[d, q]``."""

    def __init__(self, sample: np.ndarray, least: np.ndarray, greatest: np.ndarray, bits: int):
        if not 1 <= bits <= 8:
            raise ValueError("bits: 1 to 8")
        dims, count = len(least), 1 << bits
        self.edges = []
        self.low = np.empty((dims, count), np.int64)
        self.high = np.empty((dims, count), np.int64)
        at = np.arange(1, count) * len(sample) // count
        for d in range(dims):
            edges = np.unique(np.sort(sample[:, d])[at])
            edges = edges[edges > least[d]]
            self.edges.append(edges)
            self.low[d] = np.concatenate([[least[d]], edges, np.full(count - 1 - len(edges), greatest[d])])
            self.high[d] = np.concatenate([edges - 1, np.full(count - len(edges), greatest[d])])

    def of(self, vectors: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, vectors[:, d], side="right") for d, e in enumerate(self.edges)], axis=1).astype(np.uint8)


class Centroids:
    """Assignment of vectors to centroids by the cells' lookup tables and, where these leave several, exactly."""

    def __init__(self, points: np.ndarray, cells: Cells):
        self.points = points
        middle = points.sum(axis=0) // len(points)

        def shown(x: np.ndarray) -> np.ndarray:  # (dims, cells) -> (dims, cells, k)
            return (x[:, :, None] - points.T[:, None, :]) ** 2 - ((x - middle[:, None]) ** 2)[:, :, None]

        a, b = shown(cells.low), shown(cells.high)  # linear in the component, so the ends of a cell bound it
        self.least, self.most = np.minimum(a, b), np.maximum(a, b)

    def candidates(self, codes: np.ndarray) -> np.ndarray:
        """For each vector the centroids that may be nearest, from its cells."""
        low = np.zeros((len(codes), len(self.points)), np.int64)
        high = np.zeros_like(low)
        for d in range(codes.shape[1]):
            low += self.least[d][codes[:, d]]
            high += self.most[d][codes[:, d]]
        return low <= high.min(axis=1, keepdims=True)

    def exact(self, vectors: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(nearest centroid among the marked ones, its squared distance); ties go to the smaller number."""
        far = np.full(among.shape, np.iinfo(np.int64).max)
        for j, point in enumerate(self.points):
            rows = np.flatnonzero(among[:, j])
            gap = vectors[rows] - point
            far[rows, j] = np.einsum("ij,ij->i", gap, gap)
        nearest = far.argmin(axis=1)
        return nearest, far[np.arange(len(far)), nearest]

    def assign(self, codes: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Nearest centroids; ``vectors`` are looked at only where cells leave several."""
        maybe = self.candidates(codes)
        nearest = maybe.argmax(axis=1)
        open_ = np.flatnonzero(maybe.sum(axis=1) > 1)
        if len(open_):
            nearest[open_] = self.exact(vectors[open_], maybe[open_])[0]
        return nearest


def _slices(batches, rows: int = 16_384):
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _vectors(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _codes(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("cells").to_pylist()), np.uint8).reshape(-1, dims)


def usable(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """Rows (vec_id, v array<int>) of the vectors that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("x").isNotNull() & (F.size("x") == dims) & finite)
    rows = rows.where(F.forall("x", lambda x: F.abs(x * scale) <= F.lit(float(LARGEST))))
    return rows.select("vec_id", F.transform("x", lambda x: F.floor(x * scale).cast("int")).alias("v"))


def va_file(rows: DataFrame, dims: int, bits: int) -> tuple[DataFrame, Cells | None]:
    """The rows numbered, with their cells (one byte a dimension), written into the shared folder."""
    kept = staged(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "v"), "vectors")

    def ends(batches):
        low = np.full(dims, np.iinfo(np.int64).max)
        high = np.full(dims, np.iinfo(np.int64).min)
        seen = False
        for batch in _slices(batches):
            v = _vectors(batch, dims)
            low, high, seen = np.minimum(low, v.min(axis=0)), np.maximum(high, v.max(axis=0)), True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims, dtype=np.int32)), pa.array(low), pa.array(high)], ["d", "low", "high"])

    found = kept.select("v").mapInArrow(ends, "d int, low long, high long").groupBy("d").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("d").collect()
    if not found:
        return kept, None
    sample = kept.orderBy(F.xxhash64("vec_id", "v"), "v").limit(SAMPLE).select("v").toArrow()
    cells = Cells(_vectors(sample.combine_chunks().to_batches()[0], dims), np.array([r["low"] for r in found]), np.array([r["high"] for r in found]), bits)

    def coded(batches):
        for batch in _slices(batches):
            codes = cells.of(_vectors(batch, dims))
            yield batch.append_column("cells", pa.array([c.tobytes() for c in codes], pa.binary()))

    return staged(kept.mapInArrow(coded, "row long, vec_id long, v array<int>, cells binary"), "va-file"), cells


def _sums(changes: DataFrame, k: int, dims: int) -> tuple[list[list[int]], list[int]]:
    """Totals of rows (cluster, n, sums); k * dims numbers reach the driver."""
    total = [[0] * dims for _ in range(k)]
    count = [0] * k
    parts = changes.select("cluster", "n", F.posexplode("sums").alias("d", "x"))
    for r in parts.groupBy("cluster", "d").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"), F.sum("n").alias("n")).collect():
        total[r["cluster"]][r["d"]] = int(r["x"])
        count[r["cluster"]] = int(r["n"])
    return total, count


_CHANGES = "cluster int, n long, sums array<long>"


class _Change:
    """Vectors that left (sign -1) or entered (+1) each cluster, summed within a task."""

    def __init__(self, k: int, dims: int):
        self.n = np.zeros(k, np.int64)
        self.sums = np.zeros((k, dims), np.int64)

    def add(self, clusters: np.ndarray, vectors: np.ndarray, sign: int) -> None:
        for j in np.unique(clusters):
            rows = vectors[clusters == j]
            self.n[j] += sign * len(rows)
            self.sums[j] += sign * rows.sum(axis=0)

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(self.n), dtype=np.int32)), pa.array(self.n), pa.array(self.sums.tolist(), pa.list_(pa.int64()))], ["cluster", "n", "sums"]
        )


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: str = "3:", bits: int = BITS, fetch_rows: int = FETCH_ROWS) -> DataFrame:
    """Rows (vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that takes part.

    Centroids start as the ``k`` vectors with the least sha256 of ``seed`` and
    the id; each of ``rounds`` rounds assigns every vector to the nearest and
    replaces every non-empty centroid by the exact floored mean. An inertia
    beyond a long is null.
    """
    spark = vectors.sparkSession
    ship(spark)
    result = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    full, cells = va_file(usable(vectors, dims, scale), dims, bits)
    if cells is None:
        return spark.createDataFrame([], result)
    named = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    first = full.orderBy(named.asc_nulls_last(), "v").limit(k).select("v").collect()
    k = len(first)
    points = np.array([r["v"] for r in first], np.int64)

    def all_sums(points: np.ndarray) -> DataFrame:
        def run(batches):
            now, change = Centroids(points, cells), _Change(k, dims)
            for batch in _slices(batches):
                v = _vectors(batch, dims)
                change.add(now.assign(_codes(batch, dims), v), v, 1)
            yield change.batch()

        return full.select("v", "cells").mapInArrow(run, _CHANGES)

    def moved(before: np.ndarray, after: np.ndarray) -> DataFrame:
        """Changes between two rounds, from the vectors whose cells do not show that they stayed."""

        def undecided(old: Centroids, new: Centroids, codes: np.ndarray) -> np.ndarray:
            a, b = old.candidates(codes), new.candidates(codes)
            return (a != b).any(axis=1) | (a.sum(axis=1) > 1)

        def look(batches):
            old, new = Centroids(before, cells), Centroids(after, cells)
            for batch in _slices(batches):
                yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(np.flatnonzero(undecided(old, new, _codes(batch, dims)))))], ["row"])

        def run(batches):
            old, new, change = Centroids(before, cells), Centroids(after, cells), _Change(k, dims)
            for batch in _slices(batches):
                codes, v = _codes(batch, dims), _vectors(batch, dims)
                a, b = old.assign(codes, v), new.assign(codes, v)
                other = np.flatnonzero(a != b)
                change.add(a[other], v[other], -1)
                change.add(b[other], v[other], 1)
            yield change.batch()

        wanted = staged(full.select("row", "cells").mapInArrow(look, "row long"), "fetch")
        fetched = full.join(F.broadcast(wanted), "row", "left_semi") if fits(wanted, fetch_rows) else full
        return fetched.select("v", "cells").mapInArrow(run, _CHANGES)

    total = count = last = None
    for _ in range(rounds):
        if last is None:
            total, count = _sums(all_sums(points), k, dims)
        else:
            change, more = _sums(moved(last, points), k, dims)
            total = [[x + y for x, y in zip(a, b, strict=True)] for a, b in zip(total, change, strict=True)]
            count = [x + y for x, y in zip(count, more, strict=True)]
        last, points = points, np.array([[x // n for x in t] if n else p.tolist() for t, n, p in zip(total, count, points, strict=True)], np.int64)
        if (last == points).all():  # every later round would leave them
            break

    def final(batches):
        now = Centroids(points, cells)
        for batch in _slices(batches):
            v = _vectors(batch, dims)
            nearest = now.assign(_codes(batch, dims), v)
            gap = v - points[nearest]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(nearest.astype(np.int32)), pa.array(np.einsum("ij,ij->i", gap, gap))], ["vec_id", "cluster", "distance"])

    placed = staged(full.select("vec_id", "v", "cells").mapInArrow(final, "vec_id long, cluster int, distance long"), "placed")
    inertia = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("x")).collect()  # k rows
    whole = sum(r["x"] for r in inertia)
    as_long = lambda x: int(x) if x < 1 << 63 else None
    digest = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points.tolist()]
    facts = spark.createDataFrame([(r["cluster"], as_long(r["x"]), as_long(whole), digest[r["cluster"]]) for r in inertia], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(facts), "cluster").select(*[c.split()[0] for c in result.split(", ")])
