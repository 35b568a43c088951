"""Quality scores by a factorisation machine over hashed words, structure and metadata.

Method: a document is a sparse vector of features: its words hashed into
``WORDS`` buckets (the square roots of their counts, scaled to length 1), and one
feature for each statistic of its structure and metadata, the bin that the
statistic falls in. The machine adds a bias, a weight for each feature, and for
each pair of features the product of their ``RANK`` hidden numbers; by
``sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)``
all pairs cost no more than one pass over the features.

It is fitted by logistic loss (adaptive steps, small batches) on a bounded
sample of labelled documents: at most ``SAMPLE`` of each label, those with the
least hash of their id, and of these, in the same order, as many as hold
``MOST_FEATURES`` features; a row counts as much as its label's share says. Bins are
quantiles of that sample. One task fits; what is broadcast has a fixed size.
Every document is scored.

Only rows whose crc32 of the id as text, modulo 3, is not 1 are learnt from.
Inputs are the text and ``n_chars``, if the table has it; never id, language,
source or labels. A document labelled more than once is good if any label says
so; null labels say nothing. An id that several rows have gives one row to the
sample (that with the least hash of its text). Null text counts as empty; empty
texts have a score by their structure. Repeated rows are scored alike. Without
labels, or with one kind of label only, the score is that label's share
(smoothed; 0.5 without any). Other columns take no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import cut_rows, first_of_each, ship, staged, window_hashes, word_hashes

WORDS = 1 << 16
RANK = 8
BINS = 16
SAMPLE = 6_000  # labelled documents of each label
MOST_FEATURES = 6_000_000  # of the whole sample
EPOCHS = 8
BATCH = 128
STEP = 0.08
DECAY = 1e-5
#: statistics of a text's structure, then of its metadata
STATISTICS = ("words", "word_length", "symbols", "marks", "digits", "upper", "other_bytes", "lines", "repeated_lines", "repeated_words", "repeated_runs", "commonest_word", "declared_chars", "declared_share")
FEATURES = WORDS + len(STATISTICS) * (BINS + 1)

# classes of bytes
_SYMBOL, _MARK, _DIGIT, _UPPER, _LOWER, _HIGH, _TAIL, _BREAK = range(1, 9)
_KIND = np.zeros(256, np.int64)
_KIND[list(b"#*$%&|<>=+@^~_{}[]\\/")] = _SYMBOL
_KIND[list(b".,;:!?()'\"-`")] = _MARK
_KIND[48:58] = _DIGIT
_KIND[65:91] = _UPPER
_KIND[97:123] = _LOWER
_KIND[192:] = _HIGH
_KIND[128:192] = _TAIL
_KIND[10] = _BREAK


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets of each)."""
    at = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1 + column.offset)[column.offset :]
    if at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(at), np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]], at - at[0]


def _counts(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, their times) of sorted keys."""
    first = np.flatnonzero(first_of_each(sorted_keys)) if len(sorted_keys) else np.zeros(0, np.int64)
    return sorted_keys[first], np.diff(first, append=len(sorted_keys))


def raw_features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word buckets of all rows, their values, offsets of each row's, statistics of each row)."""
    text = batch.column("text").cast(pa.large_string()).fill_null("")
    rows = len(text)
    data, at = _bytes(text)
    kinds = np.bincount(np.repeat(np.arange(rows), np.diff(at)) * 9 + _KIND[data], minlength=rows * 9).reshape(rows, 9).astype(np.float64)
    words, words_at = word_hashes(text)
    n_words = np.diff(words_at)
    row = np.repeat(np.arange(rows, dtype=np.int64), n_words)
    key, times = _counts(np.sort(row << 17 | (words & np.uint64(WORDS - 1)).astype(np.int64)))
    owner = key >> 17
    value, norm = np.sqrt(times), np.sqrt(np.maximum(1, n_words))  # the squares of a row's values sum to its words
    offsets = np.searchsorted(owner, np.arange(rows + 1))
    commonest = np.zeros(rows)
    np.maximum.at(commonest, owner, times)
    runs, runs_at = window_hashes(words, words_at, 3)
    run_key, run_times = _counts(np.sort(np.repeat(np.arange(rows, dtype=np.int64), np.diff(runs_at)) << 40 | (runs >> np.uint64(24)).astype(np.int64)))
    lines = pc.split_pattern(text, "\n")
    line_row = np.repeat(np.arange(rows, dtype=np.int64), pc.list_value_length(lines).to_numpy(zero_copy_only=False))
    coded = lines.flatten().dictionary_encode()
    held = pc.not_equal(lines.flatten(), "").to_numpy(zero_copy_only=False)
    line_key = _counts(np.sort(line_row[held] << 32 | coded.indices.to_numpy()[held].astype(np.int64)))[0]
    n_lines = np.bincount(line_row[held], minlength=rows)
    letters = kinds[:, _UPPER] + kinds[:, _LOWER] + kinds[:, _HIGH]
    n_chars = np.maximum(1, np.diff(at) - kinds[:, _TAIL])
    share = lambda x, n: x / np.maximum(1, n)
    declared = np.full(rows, np.nan)
    if "n_chars" in batch.schema.names:
        declared = batch.column("n_chars").cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    statistics = [
        n_words,
        share(np.diff(at), n_words),
        share(kinds[:, _SYMBOL], n_chars),
        share(kinds[:, _MARK], n_chars),
        share(kinds[:, _DIGIT], n_chars),
        share(kinds[:, _UPPER], letters),
        share(kinds[:, _HIGH], n_chars),
        share(n_lines, n_words),
        1 - share(np.bincount(line_key >> 32, minlength=rows), n_lines),
        1 - share(np.diff(offsets), n_words),
        1 - share(np.bincount(run_key >> 40, minlength=rows), np.diff(runs_at)),
        share(commonest, n_words),
        declared,
        declared / n_chars,
    ]
    return key & (WORDS - 1), value / norm[owner], offsets, np.stack([np.asarray(s, np.float64) for s in statistics], axis=1)


def bins(statistics: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Feature numbers of each row's statistics; a missing statistic has a bin of its own."""
    out = np.empty(statistics.shape, np.int64)
    for s, e in enumerate(edges):
        place = np.searchsorted(e, statistics[:, s], side="right")
        out[:, s] = WORDS + s * (BINS + 1) + np.where(np.isnan(statistics[:, s]), BINS, place)
    return out


class Machine:
    """Bias, weights, hidden numbers, and the bins of the statistics."""

    def __init__(self, edges: list[np.ndarray], seed: int = 5):
        self.edges = edges
        self.bias = 0.0
        self.weight = np.zeros(FEATURES, np.float32)
        self.hidden = np.random.default_rng(seed).normal(0, 0.02, (FEATURES, RANK)).astype(np.float32)

    def rows(self, buckets, values, offsets, statistics) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(features, values, offsets) of rows: each row's words, then its bins."""
        n, s = len(offsets) - 1, len(STATISTICS)
        at = offsets + s * np.arange(n + 1)
        feature, value = np.empty(at[-1], np.int64), np.ones(at[-1], np.float32)
        place = np.arange(len(buckets)) + s * np.repeat(np.arange(n), np.diff(offsets))
        feature[place], value[place] = buckets, values
        feature[(at[1:] - s)[:, None] + np.arange(s)] = bins(statistics, self.edges)
        return feature, value, at

    def raw(self, feature: np.ndarray, value: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The sum before the logistic function, in one pass over the features."""
        if len(at) < 2:
            return np.zeros(0)
        vx = self.hidden[feature] * value[:, None]
        sums = np.add.reduceat(vx, at[:-1], axis=0, dtype=np.float64)
        squares = np.add.reduceat(np.einsum("ij,ij->i", vx, vx), at[:-1], dtype=np.float64)
        linear = np.add.reduceat(self.weight[feature] * value, at[:-1], dtype=np.float64)
        return self.bias + linear + 0.5 * ((sums**2).sum(axis=1) - squares)

    def score(self, batch: pa.RecordBatch) -> np.ndarray:
        return logistic(self.raw(*self.rows(*raw_features(batch))))

    def fit(self, feature: np.ndarray, value: np.ndarray, at: np.ndarray, good: np.ndarray, weight: np.ndarray, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(good))
        parts = []
        for lo in range(0, len(order), BATCH):
            rows = order[lo : lo + BATCH]
            sizes = at[rows + 1] - at[rows]
            place = np.repeat(at[rows] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
            own = feature[place]
            by = np.argsort(own, kind="stable")
            first = np.flatnonzero(first_of_each(own[by]))
            parts.append((rows, own, value[place], np.concatenate([[0], np.cumsum(sizes)]), by, first, own[by][first]))
        bias_sum, weight_sum, hidden_sum = 1e-6, np.full(FEATURES, 1e-6, np.float32), np.full((FEATURES, RANK), 1e-6, np.float32)
        for _ in range(EPOCHS):
            for p in rng.permutation(len(parts)):
                rows, own, x, cuts, by, first, names = parts[p]
                vx = self.hidden[own] * x[:, None]
                sums = np.add.reduceat(vx, cuts[:-1], axis=0)
                squares = np.add.reduceat(np.einsum("ij,ij->i", vx, vx), cuts[:-1])
                raw = self.bias + np.add.reduceat(self.weight[own] * x, cuts[:-1]) + 0.5 * ((sums**2).sum(axis=1) - squares)
                slope = ((logistic(raw) - good[rows]) * weight[rows] / len(rows)).astype(np.float32)
                of_row = np.repeat(np.arange(len(rows)), np.diff(cuts))
                scaled = slope[of_row] * x
                step_w = np.add.reduceat(scaled[by], first) + DECAY * self.weight[names]
                step_v = np.add.reduceat((scaled[:, None] * (sums[of_row] - vx))[by], first, axis=0) + DECAY * self.hidden[names]
                step_b = float(slope.sum())
                bias_sum += step_b**2
                weight_sum[names] += step_w**2
                hidden_sum[names] += step_v**2
                self.bias -= STEP * step_b / bias_sum**0.5
                self.weight[names] -= STEP * step_w / np.sqrt(weight_sum[names])
                self.hidden[names] -= STEP * step_v / np.sqrt(hidden_sum[names])

    def pack(self) -> bytes:
        edges = np.full((len(STATISTICS), BINS), np.nan)
        for s, e in enumerate(self.edges):
            edges[s, : len(e)] = e
        return np.float64(self.bias).tobytes() + edges.tobytes() + self.weight.tobytes() + self.hidden.tobytes()

    @classmethod
    def unpack(cls, raw: bytes) -> Machine:
        n = 8 * len(STATISTICS) * BINS
        edges = np.frombuffer(raw, np.float64, len(STATISTICS) * BINS, 8).reshape(-1, BINS)
        out = cls([e[~np.isnan(e)] for e in edges])
        out.bias = float(np.frombuffer(raw, np.float64, 1)[0])
        out.weight = np.frombuffer(raw, np.float32, FEATURES, 8 + n)
        out.hidden = np.frombuffer(raw, np.float32, FEATURES * RANK, 8 + n + 4 * FEATURES).reshape(FEATURES, RANK)
        return out


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _inputs(docs: DataFrame) -> DataFrame:
    chars = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), chars.alias("n_chars"))


def held_out() -> F.Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[DataFrame, float]:
    """(rows (doc_id, good, text, n_chars) of the sample, share of good labels among all that may be learnt from)."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out())
    known = staged(known.groupBy("doc_id").agg((F.max("quality") > 0).alias("good")), "labels")
    counts = {r["good"]: r["n"] for r in known.groupBy("good").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = (counts.get(True, 0) + 0.5) / (sum(counts.values()) + 1)
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    parts = [known.where(F.col("good") == F.lit(kind)).orderBy(*order).limit(sample) for kind in (True, False)]
    chosen = staged(parts[0].unionByName(parts[1]), "chosen")  # 2 * sample rows at most
    rows = docs.join(F.broadcast(chosen), "doc_id")
    one = F.min(F.struct(F.xxhash64("text").alias("h"), "text", "n_chars")).alias("row")
    return rows.groupBy("doc_id", "good").agg(one).select("doc_id", "good", "row.text", "row.n_chars"), share


def fitted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[Machine | None, float]:
    """(the machine, or None where labels are missing or all alike; share of good labels)."""
    rows, share = labelled_sample(docs, labels, sample)

    def features(batches):
        for batch in cut_rows(batches):
            buckets, values, at, statistics = raw_features(batch)
            offsets = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("good"),
                    pa.ListArray.from_arrays(offsets, pa.array(buckets.astype(np.int32))),
                    pa.ListArray.from_arrays(offsets, pa.array(values.astype(np.float32))),
                    pa.array(statistics.tolist(), pa.list_(pa.float64())),
                    pa.array(np.diff(at) + len(STATISTICS)),
                ],
                ["doc_id", "good", "buckets", "values", "statistics", "size"],
            )

    found = staged(rows.mapInArrow(features, "doc_id long, good boolean, buckets array<int>, values array<float>, statistics array<double>, size long"), "features")
    sizes = sorted(found.select(F.xxhash64("doc_id").alias("h"), "doc_id", "good", "size").collect())  # 2 * sample rows at most
    room = np.flatnonzero(np.cumsum([r["size"] for r in sizes]) <= MOST_FEATURES)
    taken = sizes[: len(room)]
    if {r["good"] for r in taken} != {True, False}:
        return None, share
    last = taken[-1]["h"]
    n_good = sum(r["good"] for r in taken)
    weights = {True: share * len(taken) / n_good, False: (1 - share) * len(taken) / (len(taken) - n_good)}

    def fit(group: pa.Table) -> pa.Table:
        group = group.sort_by([("h", "ascending"), ("doc_id", "ascending")]).combine_chunks()
        statistics = group.column("statistics").combine_chunks().flatten().to_numpy().reshape(group.num_rows, -1)
        cuts = np.arange(1, BINS) / BINS
        edges = [np.unique(np.quantile(x, cuts, method="lower")) if len(x) else np.zeros(0) for x in (s[~np.isnan(s)] for s in statistics.T)]
        machine = Machine(edges)
        flat = lambda name: group.column(name).combine_chunks().flatten().to_numpy()
        at = np.concatenate([[0], np.cumsum(group.column("size").to_numpy() - len(STATISTICS))])
        good = group.column("good").to_numpy().astype(bool)
        machine.fit(*machine.rows(flat("buckets"), flat("values"), at, statistics), good.astype(np.float64), np.where(good, weights[True], weights[False]))
        return pa.table({"model": pa.array([machine.pack()], pa.binary())})

    chosen = found.withColumns({"h": F.xxhash64("doc_id"), "all": F.lit(0)}).where(F.col("h") <= F.lit(last))
    packed = chosen.groupBy("all").applyInArrow(fit, "model binary").first()["model"]  # a fixed size
    return Machine.unpack(packed), share


def score_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted), one for each row of ``docs`` (doc_id, text, n_chars if there)."""
    spark = docs.sparkSession
    ship(spark)
    docs = _inputs(docs)
    machine, share = fitted(docs, labels, sample)
    if machine is None:
        return docs.select("doc_id", held_out().alias("held_out"), F.lit(share).alias("score"), F.lit(int(share >= 0.5)).cast("int").alias("predicted"))
    shared = spark.sparkContext.broadcast(machine.pack())

    def run(batches):
        model = Machine.unpack(shared.value)
        for batch in cut_rows(batches):
            score = model.score(batch)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.mapInArrow(run, "doc_id long, score double, predicted int").select("doc_id", held_out().alias("held_out"), "score", "predicted")
