"""Set-similarity links between documents by adaptive multi-match prefixes.

A document's set are its distinct runs of ``words`` words. Two documents link
when the Jaccard similarity of their sets is at least ``num / den``. Result:
each document's component under these links.

Method: all sets are read in one order of tokens, rare ones first. Two linked
sets share their first ``m`` common tokens within the first
``|x| - ceil(t |x|) + m`` tokens of either, for every ``m``. For each document
the number of matches ``m`` (1..MATCHES) is the one with the least estimated
cost: the documents listed under its longer prefix, plus the candidates that
could have ``m`` matches there. A pair is a candidate if it has the larger of
its two documents' ``m`` matches in prefixes of that length, and then is
verified on the whole sets.

The order comes from counts of all documents' tokens in a table of fixed size,
summed over all tasks; any order gives the same links. Before whole sets are
fetched, a pair's signatures (how often each of ``PARITY`` hash values occurs in
a set, modulo 2) must differ in no more bits than linked sets can differ in
tokens, which drops no link. Sets of more than ``PARITY`` tokens, which may
differ in more tokens than that signature has bits, have a wide one too, of
four bits and more for each token.

Skew: documents with equal sets form one class. For a few rounds, each large
list has a pivot of its own and each class is compared with the pivots of its
lists; whom that joins is one component, and only pairs across components are
then enumerated, in full. This leaves the components as they are, since a pair
inside one cannot change them. In large lists the signatures come along, so that
only pairs that may link leave the join, however many meet in a list.

Null text and text without words have the empty set and link with nothing.
Repeated rows share a class. Unlike texts of one id are documents of their own,
of which each row is linked by its own text. A null doc_id links nothing and
stays its own (null) component. Extra columns, whatever their names, take no part.
"""

from __future__ import annotations

import operator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import cut_rows, release, scratch, ship, signed, staged, window_hashes, word_hashes
from clickpulse.llm.components import components
from clickpulse.plans.tuning import DEFAULT_BROADCAST_ROWS, broadcast_if_small, fits

BUCKETS = 1 << 22  # counters of the token order: 16 MB
SLICES = 256
SOME = 8  # slices of a task's counters that leave it together
PARITY = 2048  # bits of a set's signature
WIDEST = 1 << 22  # bits of a wide one, at most
BLOCK = 64  # sets of a candidate component in one block
MATCHES = 4
VERIFY_COST = 16.0  # of one candidate, against one listed document
LARGE_LIST = 32
STAR_ROUNDS = 4
STAR_GAIN = 0.8  # a further round of pivots follows while one leaves less than this of the pairs across components


def _sets(batch: pa.RecordBatch, words: int):
    """(row, sorted distinct token hashes) of each row of a batch that has words."""
    tokens, at = window_hashes(*word_hashes(batch.column("text")), words)
    for row in range(batch.num_rows):
        own = np.sort(tokens[at[row] : at[row + 1]])
        if len(own):
            keep = np.empty(len(own), bool)
            keep[0] = True
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            yield row, own[keep]


def _class_of(own: np.ndarray) -> int:
    """A 64-bit name of a set: its mixed tokens summed."""
    total = (int(own.sum(dtype=np.uint64)) * 0x9E3779B97F4A7C15 + len(own)) & 0xFFFFFFFFFFFFFFFF
    total = ((total ^ total >> 31) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    return (total ^ total >> 29) - (1 << 63)


def _text_rows(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"))


def _signature(own: np.ndarray) -> list[int]:
    odd = np.bincount((own >> np.uint64(24)).astype(np.int64) & (PARITY - 1), minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def _wide(own: np.ndarray) -> bytes | None:
    """The wide signature of a long set: a power of two of bits."""
    if len(own) <= PARITY:
        return None
    bits = min(WIDEST, 1 << (4 * len(own) - 1).bit_length())
    odd = np.bincount((own >> np.uint64(24)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _wide_differ(x: np.ndarray, y: np.ndarray) -> int:
    """In how many bits two wide signatures differ, the longer one folded to the size of the other."""
    while len(x) != len(y):
        x, y = (x, y) if len(x) > len(y) else (y, x)
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _narrow(counts: np.ndarray) -> bytes:
    """Counters in as few bytes each as hold the largest."""
    return counts.astype(f"<u{next(w for w in (1, 2, 4) if counts.max() < 1 << 8 * w)}").tobytes()


def _wider(raw: pa.Buffer, n: int) -> np.ndarray:
    """The ``n`` counters of ``_narrow``."""
    return np.frombuffer(raw, f"<u{raw.size // n}")


FIRST = "doc_id long, h long, n long, class long, signature array<long>, wide binary, slice int, counts binary"


def _first_pass(docs: DataFrame, words: int) -> DataFrame:
    """Rows of documents (doc_id, h, n, class, signature, wide) and of counters (slice, counts)."""
    names = [x.split()[0] for x in FIRST.split(", ")]

    def run(batches):
        counts, seen = np.zeros(BUCKETS, np.int32), set()
        for batch in cut_rows(batches, 1 << 18):
            rows = batch.num_rows
            sizes, classes, signatures, wide = np.zeros(rows, np.int64), [None] * rows, [None] * rows, [None] * rows
            for row, own in _sets(batch, words):
                sizes[row], classes[row], signatures[row], wide[row] = len(own), _class_of(own), _signature(own), _wide(own)
                if classes[row] not in seen:
                    seen.add(classes[row])
                    np.add.at(counts, own & np.uint64(BUCKETS - 1), 1)
            none = [None] * rows
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("h"), pa.array(sizes), pa.array(classes, pa.int64()), pa.array(signatures, pa.list_(pa.int64())), pa.array(wide, pa.binary()), pa.array(none, pa.int32()), pa.array(none, pa.binary())], names)
        for at, some in enumerate(counts.reshape(-1, SOME, BUCKETS // SLICES) if counts.any() else []):  # a few at a time: all at once are 16 MB to this worker and again to the executor
            none = pa.array([None] * SOME, pa.int64())
            parts = pa.array([_narrow(p) for p in some], pa.binary())
            yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array([None] * SOME, pa.list_(pa.int64())), pa.array([None] * SOME, pa.binary()), pa.array(range(at * SOME, (at + 1) * SOME), pa.int32()), parts], names)

    return docs.mapInArrow(run, FIRST)


def _token_counts(parts: DataFrame) -> np.ndarray:
    """All tasks' counters summed: SLICES rows of fixed size reach the driver."""

    def add(key, group):
        total = np.zeros(BUCKETS // SLICES, np.int64)
        for x in group.column("counts"):
            total += _wider(x.as_buffer(), len(total))
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([np.minimum(total, 2**31 - 1).astype("<i4").tobytes()])})

    rows = parts.groupBy("slice").applyInArrow(add, "slice int, counts binary").collect()
    counts = np.zeros((SLICES, BUCKETS // SLICES), np.int32)
    for row in rows:
        counts[row["slice"]] = np.frombuffer(row["counts"], "<i4")
    return counts.ravel()


def _excess(counts: np.ndarray) -> np.ndarray:
    """Each counter's documents beyond what rare tokens alone would put there."""
    usual = float(np.median(counts))
    return np.maximum(0, counts - int(usual + 6 * np.sqrt(usual) + 1)).astype(np.int32)


def _prefix(own: np.ndarray, excess: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(tokens of the longest prefix, the number of matches from which each counts, the matches chosen)."""
    n = len(own)
    need = -(-num * n // den)  # tokens that a linked set has in common with this one, at least
    listed = excess[own & np.uint64(BUCKETS - 1)]
    order = np.argsort(listed, kind="stable")
    most = min(MATCHES, need)
    first = order[: n - need + most]
    level = np.maximum(1, np.arange(len(first)) - (n - need) + 1)
    cost, best = None, 1
    rows = np.cumsum(listed[first].astype(np.float64))
    for m in range(1, most + 1):
        read = rows[n - need + m - 1]
        now = read + VERIFY_COST * read / m + 0.5 * m
        if cost is None or now < cost:
            cost, best = now, m
    return own[first], level, best


def _postings(docs: DataFrame, excess: np.ndarray, words: int, num: int, den: int) -> DataFrame:
    """Rows (token, class, n, level, matches) of the prefixes, each class once a task."""
    shared = docs.sparkSession.sparkContext.broadcast(excess)  # BUCKETS numbers

    def run(batches):
        seen, excess = set(), shared.value
        for batch in cut_rows(batches, 1 << 18):
            columns: tuple[list, ...] = ([], [], [])
            for _, own in _sets(batch, words):
                name = _class_of(own)
                if name in seen:
                    continue
                seen.add(name)
                tokens, level, matches = _prefix(own, excess, num, den)
                columns[0].append(tokens)
                columns[1].append(np.full(len(tokens), name, np.int64))
                columns[2].append((np.int64(len(own)) << 8) | (level.astype(np.int64) << 4) | matches)
            if columns[0]:
                token, name, packed = (np.concatenate(c) for c in columns)
                yield pa.RecordBatch.from_arrays([pa.array(signed(token)), pa.array(name), pa.array(packed)], ["token", "class", "packed"])

    return docs.mapInArrow(run, "token long, class long, packed long")


def _listed(postings: DataFrame) -> DataFrame:
    """Postings of tokens that two classes have, each once, as columns."""
    shared = postings.groupBy("token").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo != hi").select("token")
    shared = staged(shared, "shared")  # so that the join has a shuffle on either side and a hot token's rows can be split
    own = postings.join(shared, "token").dropDuplicates(["token", "class"])
    field = lambda shift, mask: F.shiftright("packed", shift).bitwiseAND(F.lit(mask))
    return own.select("token", "class", F.shiftright("packed", 8).alias("n"), field(4, 15).alias("level"), field(0, 15).alias("matches"))


def _class_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """Rows (class, tokens as binary) of the wanted classes (class, doc_id of one member)."""
    if fits(wanted, DEFAULT_BROADCAST_ROWS):  # then other texts need not be read as words
        docs = docs.join(F.broadcast(wanted.select("doc_id").distinct()), "doc_id", "left_semi")

    def run(batches):
        for batch in cut_rows(batches, 1 << 18):
            rows, names, sets = [], [], []
            for row, own in _sets(batch, words):
                rows.append(row)
                names.append(_class_of(own))
                sets.append(own.tobytes())
            ids = batch.column("doc_id").take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), ids, pa.array(sets, pa.binary())], ["class", "doc_id", "tokens"])

    sets = docs.mapInArrow(run, "class long, doc_id long, tokens binary")
    return sets.join(broadcast_if_small(wanted), ["class", "doc_id"], "left_semi").select("class", "tokens")


def _may_link(num: int, den: int) -> Column:
    """Whether the signatures ``s`` and ``t`` of sets of ``n`` and ``m`` tokens leave a link possible."""
    differ = reduce(operator.add, [F.bit_count(F.get("s", F.lit(i)).bitwiseXOR(F.get("t", F.lit(i)))) for i in range(PARITY // 64)])
    return (den + num) * differ <= (den - num) * (F.col("n") + F.col("m"))


def _wide_near(pairs: DataFrame, wide: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of long sets, of ``n`` and ``m`` tokens, whose wide signatures (class, wide) leave a link possible."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    own = staged(wide.join(ends, "class", "left_semi").dropDuplicates(["class"]), "wide")
    of = lambda end, x: own.select(F.col("class").alias(end), F.col("wide").alias(x))

    def check(batches):
        for batch in cut_rows(batches):
            sides = zip(batch.column("x"), batch.column("y"), strict=True)
            differ = np.array([_wide_differ(*[np.frombuffer(x.as_buffer(), np.uint8) for x in side]) for side in sides], np.int64)
            sizes = batch.column("n").to_numpy() + batch.column("m").to_numpy()
            yield batch.select(["a", "b"]).filter(pa.array((den + num) * differ <= (den - num) * sizes))

    return pairs.join(of("a", "x"), "a").join(of("b", "y"), "b").mapInArrow(check, "a long, b long")


def _verify(pairs: DataFrame, docs: DataFrame, members: DataFrame, wide: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that link. ``members``: class, n, signature, and the doc_id of one of its documents; ``wide``: class and wide signature."""
    of = lambda end, n, sig: members.select(F.col("class").alias(end), F.col("n").alias(n), F.col("signature").alias(sig))
    both = pairs.join(of("a", "n", "s"), "a").join(of("b", "m", "t"), "b")
    near = staged(both.where(_may_link(num, den)).select("a", "b", "n", "m"), "pairs")
    long = F.least("n", "m") > PARITY
    if not near.where(long).isEmpty():
        near = staged(near.where(~long).select("a", "b").unionByName(_wide_near(near.where(long), wide, num, den)), "pairs")
    # classes of one candidate component meet in blocks of BLOCK: a set travels once for each block it has a pair with
    found = components(near).select(F.col("node").alias("class"), "root")
    sizes = found.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("long").alias("blocks"))
    placed = staged(found.join(sizes, "root").withColumn("sub", F.pmod(F.xxhash64("class"), F.col("blocks"))), "placed")
    wanted = placed.join(members.select("class", "doc_id"), "class").select("class", "doc_id")
    key = lambda x, y: [F.least(x, y).alias("lo"), F.greatest(x, y).alias("hi")]
    one = placed.select(F.col("class").alias("a"), "root", F.col("sub").alias("sub_a"))
    two = placed.select(F.col("class").alias("b"), F.col("sub").alias("sub_b"))
    asked = near.join(one, "a").join(two, "b").select(F.col("root").alias("comp"), *key("sub_a", "sub_b"), "a", "b")
    # a set goes to the pairs of blocks in which it is asked for, not to all of its component
    goes = staged(asked.select("comp", "lo", "hi", F.explode(F.array("a", "b")).alias("class")).distinct(), "goes")
    sets = _class_sets(docs, staged(wanted, "ends"), words).join(goes, "class").select("comp", "lo", "hi", "class", "tokens")

    def check(left: pa.Table, right: pa.Table) -> pa.Table:
        own = dict(zip(left.column("class").to_pylist(), left.column("tokens"), strict=True))
        keep = []
        for x, y in zip(right.column("a").to_pylist(), right.column("b").to_pylist(), strict=True):
            x, y = (np.frombuffer(own[c].as_buffer(), np.uint64) for c in (x, y))
            both = np.sort(np.concatenate([x, y]), kind="stable")
            common = int(np.count_nonzero(both[1:] == both[:-1]))
            keep.append(den * common >= num * (len(x) + len(y) - common))
        return right.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return sets.groupBy("comp", "lo", "hi").cogroup(asked.groupBy("comp", "lo", "hi")).applyInArrow(check, "a long, b long").distinct()


def _with_roots(listed: DataFrame, links: DataFrame | None) -> DataFrame:
    """Postings with each class's component so far."""
    if links is None:
        return listed.withColumn("root", F.col("class"))
    found = components(links).select(F.col("node").alias("class"), "root")
    return listed.join(broadcast_if_small(staged(found, "roots")), "class", "left").withColumn("root", F.coalesce("root", "class"))


def class_links(docs: DataFrame, words: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(document rows (doc_id, h, n, class), components (class, root) of the classes that link).

    Rows without doc_id have no part in links: their class counts only if another row has it.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = _text_rows(docs)
    first = staged(_first_pass(docs, words), "sets")
    with scratch() as own:
        roots = staged(_linked_classes(docs, first, words, num, den), "components")
        own.keep(roots)
    return first.where("slice is null").select("doc_id", "h", "n", "class"), roots


def _linked_classes(docs: DataFrame, first: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Components (class, root) of the classes that link; it reads folders staged here."""
    spark = docs.sparkSession
    members = first.where("class is not null and doc_id is not null").select("doc_id", "class", "n", "signature")
    least = members.groupBy("class").agg(F.min("doc_id").alias("doc_id"))
    members = staged(members.join(least, ["class", "doc_id"]).dropDuplicates(["class"]), "members")
    wide = first.where("wide is not null").select("class", "wide")
    excess = _excess(_token_counts(first.where("slice is not null").select("slice", "counts")))
    prefixes = staged(_postings(docs, excess, words, num, den), "prefixes")
    listed = staged(_listed(prefixes), "postings")
    release(prefixes)
    n_listed = listed.count()
    if not n_listed:
        return spark.createDataFrame([], "class long, root long")

    alike = den * F.least("n", "m") >= num * F.greatest("n", "m")
    links: DataFrame | None = None
    before: float | None = None
    for turn in range(STAR_ROUNDS + 1):
        now = staged(_with_roots(listed, links), "rooted")
        groups = now.groupBy("token", "root").agg(F.count(F.lit(1)).alias("c"))
        sizes = groups.groupBy("token").agg(F.sum("c").alias("c"), F.sum(F.col("c") * F.col("c")).alias("same"), F.count(F.lit(1)).alias("roots")).where("roots > 1")
        sizes = staged(sizes, "lists")
        across = sizes.where(F.col("c") >= LARGE_LIST).agg(F.sum((F.col("c") * F.col("c") - F.col("same")) / 2)).first()[0] or 0
        if turn == STAR_ROUNDS or not across or before is not None and across > STAR_GAIN * before:
            break
        before = across
        # a pivot for each large list, another one for each list and round; every member of another component meets it
        large = now.join(sizes.where(F.col("c") >= LARGE_LIST).select("token"), "token", "left_semi")
        rank = F.struct(F.xxhash64("class", "token", F.lit(turn)).alias("h"), F.col("class").alias("p"), F.col("n").alias("m"), F.col("root").alias("p_root"))
        pivots = large.groupBy("token").agg(F.min(rank).alias("pivot")).select("token", "pivot.p", "pivot.m", "pivot.p_root")
        star = large.join(pivots, "token").where(alike & (F.col("root") != F.col("p_root")))
        pairs = star.select(F.least("class", "p").alias("a"), F.greatest("class", "p").alias("b")).distinct()
        with scratch() as own:
            joined = staged(_verify(pairs, docs, members, wide, words, num, den), "joined")
            own.keep(joined)
        links = joined if links is None else staged(links.unionByName(joined), "links")
        release(now, sizes)
    # every pair across components that shares enough tokens
    open_lists = now.select("token", "class", "n", "level", "matches", "root")
    other = lambda df, *more: df.select("token", F.col("class").alias("b"), F.col("n").alias("m"), F.col("level").alias("level_b"), F.col("matches").alias("matches_b"), F.col("root").alias("root_b"), *more)
    need = F.greatest("matches", "matches_b")
    across = (F.col("class") < F.col("b")) & (F.col("root") != F.col("root_b")) & alike & (F.greatest("level", "level_b") <= need)
    hit = [F.col("class").alias("a"), "b", need.alias("need")]
    short = open_lists.join(sizes.where(F.col("c") < LARGE_LIST).select("token"), "token", "left_semi")
    met = short.join(other(short), "token").where(across).select(*hit)
    if not sizes.where(F.col("c") >= LARGE_LIST).isEmpty():
        signed_rows = open_lists.join(sizes.where(F.col("c") >= LARGE_LIST).select("token"), "token", "left_semi").join(members.select("class", F.col("signature").alias("s")), "class")
        signed_rows = staged(signed_rows, "signed")
        met = met.unionByName(signed_rows.join(other(signed_rows, F.col("s").alias("t")), "token").where(across & _may_link(num, den)).select(*hit))
    counted = met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("hits"), F.first("need").alias("need"))
    rest = staged(_verify(counted.where("hits >= need").select("a", "b"), docs, members, wide, words, num, den), "joined")
    links = rest if links is None else links.unionByName(rest)
    return components(links).select(F.col("node").alias("class"), "root")


def jaccard_components(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id), one for each row of ``docs`` (doc_id, text)."""
    rows, roots = class_links(docs, words, num, den)
    named = rows.where("class is not null and doc_id is not null")
    firsts = named.groupBy("class").agg(F.min("doc_id").alias("first"))
    joined = firsts.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    least = joined.groupBy("root").agg(F.min("first").alias("least"))
    of_class = joined.join(least, "root").select("class", "least")
    return rows.join(of_class, "class", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id"))


def near_duplicate_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component: that of the least doc_id (of its texts in the component, the one with the least hash).

    Rows are told apart by id and text, so unlike texts of one id go or stay by
    themselves. Of rows that agree in both, one stays (which, if other columns
    differ, is open). Rows without an id, and texts without words, all stay.
    """
    with scratch() as scope:
        rows, roots = class_links(docs, 5, 80, 100)
        named = rows.where("class is not null and doc_id is not null")
        own = F.struct("doc_id", "h")
        firsts = named.groupBy("class").agg(F.min(own).alias("first"), F.count(F.lit(1)).alias("n"))
        joined = firsts.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
        several = joined.groupBy("root").agg(F.min("first").alias("keep"), F.sum("n").alias("n")).where("n > 1")
        of_class = staged(joined.join(several, "root").select("class", "keep"), "classes")
        copies = staged(named.join(of_class, "class").select("doc_id", "h", (own == F.col("keep")).alias("kept")), "copies")
        drop = staged(copies.where(~F.col("kept")).select("doc_id", "h").distinct(), "drop")
        twice = staged(copies.where("kept").groupBy("doc_id", "h").count().where("count > 1").select("doc_id", "h"), "twice")
        scope.keep(drop, twice)
    at = {c: F.col(f"c{i}") for i, c in enumerate(docs.columns)}  # numbers for names, so that none clashes
    numbered = docs.toDF(*[f"c{i}" for i in range(len(at))])
    numbered = numbered.withColumns({"doc_id": at["doc_id"].cast("long"), "h": F.xxhash64(at["text"].cast("string"))})
    key = ["doc_id", "h"]
    kept = numbered.join(broadcast_if_small(drop), key, "left_anti")
    if not twice.isEmpty():
        again = broadcast_if_small(twice)
        kept = kept.join(again, key, "left_anti").unionByName(kept.join(again, key, "left_semi").dropDuplicates(key))
    return kept.select(*[x.alias(c) for c, x in at.items()])
