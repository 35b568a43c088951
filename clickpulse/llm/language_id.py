"""Languages of texts by Bayesian fusion of evidence.

Method: the log posterior of each language is the sum of

* the text's log likelihood under the language's distribution of letter
  trigrams (hashed into ``BUCKETS``), at most as much as ``TEXT_WEIGHT``
  trigrams of it say, as neighbouring trigrams are not independent;
* the log probability of the declared language, given the language: how far
  declarations can be trusted is counted over the whole input;
* the log prior of the host, smoothed towards the prior of its address suffix,
  which is smoothed towards the prior of all rows.

All tables come from grouped sums over all rows: trigrams by declared language
first, then, with the language that the text alone suggests, declarations,
suffixes and hosts. ``und`` is a language too, under which all trigrams are
equally likely; it wins where no language explains the text.

Languages are the declared ones (primary subtag, lower-cased) whose rows have
``MIN_BYTES`` of text together, however few of all rows they are: as much as the
smoothing of their table weighs. In small inputs, those that ``MIN_SHARE`` of
all rows declare are languages too. Each has a table of ``BUCKETS`` numbers in
every task, so their number should stay in the hundreds.

A row is kept if its text has letters, its language is not ``und`` and the
posterior is ``MIN_POSTERIOR`` at least. Null text counts as empty: the other
evidence decides its language, and it isn't kept. A null or unknown declaration
is a category of its own; null hosts and suffixes share one each. Repeated rows
count and are judged each. Without any declared language all rows are ``und``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import cut_rows, ship, staged
from clickpulse.plans.tuning import broadcast_if_small

BUCKETS = 1 << 14
MIN_SHARE = 0.005
TEXT_WEIGHT = 300.0
SMOOTH = 0.5
MIN_BYTES = int(SMOOTH * BUCKETS)
HOST_WEIGHT = 20.0
MIN_POSTERIOR = 0.5
UND = "und"

_CLASS = np.full(256, 32, np.uint32)
_CLASS[97:123] = np.arange(97, 123)
_CLASS[65:91] = np.arange(97, 123)
_CLASS[128:] = np.arange(128, 256)


def _trigrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of each trigram of a string column that has a letter."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    rows = len(column)
    at = np.frombuffer(column.buffers()[1], np.int64, rows + 1 + column.offset)[column.offset :]
    if not rows or at[-1] - at[0] < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    b = _CLASS[np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]]]
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    row = np.repeat(np.arange(rows), np.diff(at))
    use = np.flatnonzero((code != 0x202020) & (row[:-2] == row[2:]))
    hashed = (code[use] * np.uint32(2654435761)) >> np.uint32(32 - 14)
    return hashed.astype(np.int64), row[use]


def _languages(rows: DataFrame) -> list[str]:
    each = rows.where("declared is not null and declared != 'und'").groupBy("declared").agg(F.count(F.lit(1)).alias("count"), F.sum(F.octet_length("text")).alias("bytes"))
    total = rows.count()
    found = each.where((F.col("bytes") >= MIN_BYTES) | (F.col("count") >= F.lit(MIN_SHARE) * F.lit(total))).select("declared").collect()  # a row for each language
    return sorted(r["declared"] for r in found)


def _trigram_counts(rows: DataFrame, languages: list[str]) -> np.ndarray:
    """Counts (language, bucket) over all rows that declare a language of the list."""
    number = {x: i for i, x in enumerate(languages)}

    def count(batches):
        total = np.zeros((len(languages), BUCKETS), np.int64)
        for batch in cut_rows(batches, 1 << 18):
            bucket, row = _trigrams(batch.column("text"))
            own = np.array([number.get(d, -1) for d in batch.column("declared").to_pylist()], np.int64)
            which = own[row] if len(row) else row
            good = which >= 0
            total += np.bincount(which[good] * BUCKETS + bucket[good], minlength=total.size).reshape(total.shape)
        some = [i for i in range(len(languages)) if total[i].any()]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([total[i].astype("<i8").tobytes() for i in some], pa.binary())], ["language", "counts"])

    def add(key, group):
        total = sum(np.frombuffer(x, "<i8") for x in group.column("counts").to_pylist())
        return pa.table({"language": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([total.astype("<i8").tobytes()])})

    summed = rows.select("text", "declared").mapInArrow(count, "language int, counts binary").groupBy("language").applyInArrow(add, "language int, counts binary")
    counts = np.zeros((len(languages), BUCKETS), np.int64)
    for r in summed.collect():  # a row of BUCKETS numbers for each language
        counts[r["language"]] = np.frombuffer(r["counts"], "<i8")
    return counts


def _log_likelihoods(rows: DataFrame, counts: np.ndarray) -> DataFrame:
    """Adds ``grams`` and ``text_scores`` (array<double>: languages, then und) to rows."""
    table = np.log((counts + SMOOTH) / (counts.sum(1, keepdims=True) + SMOOTH * BUCKETS))
    table = np.vstack([table, np.full((1, BUCKETS), -np.log(BUCKETS))])
    shared = rows.sparkSession.sparkContext.broadcast(table)
    n = len(table)

    def score(batches):
        table = shared.value
        for batch in cut_rows(batches, 1 << 18):
            bucket, row = _trigrams(batch.column("text"))
            grams = np.bincount(row, minlength=batch.num_rows)
            sums = np.stack([np.bincount(row, weights=t[bucket], minlength=batch.num_rows) for t in table], axis=1)
            sums *= (np.minimum(grams, TEXT_WEIGHT) / np.maximum(grams, 1))[:, None]
            out = pa.FixedSizeListArray.from_arrays(pa.array(sums.ravel()), n).cast(pa.list_(pa.float64()))
            arrays = [batch.column(c) for c in batch.schema.names if c != "text"]
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(grams, pa.int64()), out], [*names, "grams", "text_scores"])

    schema = rows.drop("text").withColumns({"grams": F.lit(0).cast("long"), "text_scores": F.array(F.lit(0.0))}).schema
    return rows.mapInArrow(score, schema)


def _argmax(scores: Column) -> Column:
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def identify(rows: DataFrame, carry: list[str]) -> DataFrame:
    """Rows ``carry``, language, posterior, text_language, grams and kept.

    ``rows``: the columns of ``carry``, and text, declared, host, suffix (strings).
    """
    ship(rows.sparkSession)
    declared = F.lower(F.regexp_extract(F.trim("declared"), "^([A-Za-z]+)", 1))
    plain = rows.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.when(declared != "", declared).alias("declared"),
        F.coalesce("host", F.lit("")).alias("host"),
        F.coalesce("suffix", F.lit("")).alias("suffix"),
    )
    languages = _languages(plain)
    names = [*languages, UND]
    counts = _trigram_counts(plain, languages) if languages else np.zeros((0, BUCKETS), np.int64)
    number = F.create_map(*[F.lit(x) for i, x in enumerate(languages) for x in (x, i)]) if languages else None
    n, other, none = len(names), len(languages), len(languages) + 1
    known = F.when(F.col("declared").isNull(), none).otherwise(F.coalesce(number[F.col("declared")], F.lit(other)) if languages else F.lit(other))
    scored = staged(_log_likelihoods(plain.withColumn("declaration", known.cast("int")).drop("declared"), counts), "language")
    scored = scored.withColumn("guess", _argmax(F.col("text_scores")))
    voting = scored.where("grams > 0")

    # P(declaration | language), and the prior of all rows: tables of fixed size
    pairs = {(r["guess"], r["declaration"]): r["count"] for r in voting.groupBy("guess", "declaration").count().collect()}
    said = np.array([[pairs.get((g, d), 0) for d in range(n + 1)] for g in range(n)], np.float64)
    overall = (said.sum(1) + 1) / (said.sum() + n)
    trust = np.log((said + 1) / (said.sum(1, keepdims=True) + n + 1))
    spark = rows.sparkSession
    trust_rows = spark.createDataFrame([(d, [float(x) for x in trust[:, d]]) for d in range(n + 1)], "declaration int, trust array<double>")

    votes = [F.sum(F.when(F.col("guess") == g, 1).otherwise(0)).alias(f"v{g}") for g in range(n)]
    vector = F.array(*[F.col(f"v{g}") for g in range(n)])

    def smoothed(parent: Column) -> Column:
        total = F.aggregate(vector, F.lit(0).cast("long"), lambda a, x: a + x)
        return F.zip_with(vector, parent, lambda v, p: (v + F.lit(HOST_WEIGHT) * p) / (total + F.lit(HOST_WEIGHT)))

    all_rows = F.array(*[F.lit(float(x)) for x in overall])
    suffixes = voting.groupBy("suffix").agg(*votes).select("suffix", smoothed(all_rows).alias("suffix_prior"))
    hosts = voting.groupBy("host").agg(F.max("suffix").alias("suffix"), *votes)
    hosts = hosts.join(suffixes, "suffix", "left").select("host", smoothed(F.coalesce("suffix_prior", all_rows)).alias("prior"))
    hosts = broadcast_if_small(staged(hosts, "hosts"))

    joined = scored.join(F.broadcast(trust_rows), "declaration").join(hosts, "host", "left")  # trust: a row for each language and two more
    logs = F.transform(F.coalesce("prior", all_rows), lambda p: F.log(p))
    fused = F.zip_with(F.zip_with("text_scores", "trust", lambda a, b: a + b), logs, lambda a, b: a + b)
    named = F.array(*[F.lit(x) for x in names])
    result = joined.withColumn("fused", fused).withColumn("best", _argmax(F.col("fused")))
    mass = F.aggregate("fused", F.lit(0.0), lambda a, x: a + F.exp(x - F.array_max("fused")))
    out = result.select("row.*", F.get(named, F.col("best")).alias("language"), (1 / mass).alias("posterior"), F.get(named, F.col("guess")).alias("text_language"), "grams")
    return out.withColumn("kept", (F.col("grams") > 0) & (F.col("language") != UND) & (F.col("posterior") >= MIN_POSTERIOR))


def document_rows(docs: DataFrame) -> DataFrame:
    """Evidence of ``documents``: lang is the declaration, source the host; there is no address."""
    return docs.withColumns({"declared": F.col("lang").cast("string"), "host": F.col("source").cast("string"), "suffix": F.lit(None).cast("string")})


def page_rows(pages: DataFrame) -> DataFrame:
    """Evidence of ``pages``: the text between tags, the markup's lang, the address's host and its last label."""
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    text = F.regexp_replace("html", r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>|&[a-z]+;", " ")
    lang = F.regexp_extract("html", r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", 1)
    return pages.select(
        "page_id", text.alias("text"), F.when(lang != "", lang).alias("declared"), F.when(host != "", host).alias("host"), F.when(host != "", F.regexp_extract(host, r"([^.]+)\.?$", 1)).alias("suffix")
    )


def language_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known, with all their columns."""
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    need = {c: F.col(f"c{docs.columns.index(c)}").alias(c) for c in ("text", "lang", "source")}
    found = identify(document_rows(numbered.select("*", *need.values())), numbered.columns)
    return found.where("kept").select(*numbered.columns).toDF(*docs.columns)
