"""Alignment of the tokens of two tokenizers over the same bytes.

Method: each token list gets a dictionary from the byte offset where a token
ends to the token's place in the list. The offsets that both dictionaries have
(a set intersection), sorted, cut both lists into groups; within a group every
token of one list is linked to every token of the other whose bytes it
overlaps. Links of an id pair are counted over the whole corpus, and each text
is scored by the counts of its own links.

Tokenizer A is byte-level BPE and reads a space and the text; tokenizer B is a
SentencePiece model, which puts that space itself. A text is cut where no token
of either can reach across: before a space between two other characters. So a
cut is an end of both, equal chunks align alike, and a worker aligns a chunk
once (a bounded table of chunks; a chunk of any length is handled).

The counts of pairs meet their texts in two ways at once: pairs with a share of
at least ``1 / HEAD`` of all links (``HEAD`` pairs at most, whatever the
corpus; all pairs, if they are no more than that) are broadcast, and rarer
pairs are joined. So hot pairs are never shuffled to one place, and what is broadcast
does not grow.

Null and empty texts have no tokens, nor has a text whose tokens' bytes, of A
or of B, are not a space and the text (as with bytes that a normalization
changes): zeros and an empty digest. Repeated rows count as often as they
stand. A null id passes through. Other columns take no part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.byte_bpe import ByteTokenizer
from clickpulse.llm.common import cut_rows, first_of_each, ship, staged

HEAD = 1_000_000  # pairs whose counts are broadcast at most: 16 MB
LOT = 512  # chunks that are encoded together
SLICE = 2 << 20  # bytes of texts whose chunks are coded together
KEEP_BYTES = 96 << 20  # of chunks and their alignments in a worker's table before it is emptied
FLUSH = 400_000  # distinct pairs that a task sums before it passes them on
MARK = "\u2581"
_OTHER_SPACE = r"[\t\n\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_ODD = f"^ | $|  | {_OTHER_SPACE}|{_OTHER_SPACE} "
_GAP = re.compile(r"(?<=\S)(?= \S)")


class Aligner:
    """Both tokenizers, and a bounded table of aligned chunks.

    A chunk's slot holds the numbers of its tokens (A, B), groups and links,
    its groups as text (each followed by ``;``) and its links' id pairs, packed.
    """

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a = ByteTokenizer(a_path)
        self.a_bytes = self.a.token_bytes()
        self.b = sp = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.cuts = self.a.cuts and not any(MARK in p.lstrip(MARK) for p in pieces)
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in own], np.int64) for own in (self.a_bytes, self.b_bytes))
        self.width = len(self.b_bytes)
        self.code = "<u4" if len(self.a_bytes) * self.width < 1 << 32 else "<u8"
        # what follows an id in the text of groups: a comma, or the end of the group's ids of A or of B
        self.written = [b"%d%b" % (i, end) for end in (b",", b"|", b";") for i in range(max(len(self.a_bytes), self.width))]
        self.clear()

    def clear(self) -> None:
        self.table: dict[str, int] = {}
        self.sizes: list[np.ndarray] = []
        self.groups: list[bytes] = []
        self.pairs: list[bytes] = []
        self.bad: set[int] = set()
        self.held = 0

    def slots(self, chunks: list[str]) -> list[int]:
        """The slot of each chunk (a space, then what follows it), aligned if it is new."""
        get = self.table.get
        fresh = [c for c in chunks if get(c) is None]
        odd = [c for c in fresh if c[1:2].isspace() or c[-1].isspace()]
        if odd:
            fresh = [c for c in fresh if not (c[1:2].isspace() or c[-1].isspace())]
        for own, lot in ((fresh, LOT), (odd, 1)):
            for at in range(0, len(own), 8192):
                self._add(own[at : at + 8192], lot)
        return [self.table[c] for c in chunks]

    def _add(self, chunks: list[str], lot: int) -> None:
        """Aligns new chunks, encoded ``lot`` at a time: put together again they are cut where they were."""
        raw = [c.encode() for c in chunks]
        ends = np.cumsum([len(r) for r in raw])
        whole = b"".join(raw)
        joined = ["".join(chunks[at : at + lot]) for at in range(0, len(chunks), lot)]
        a = list(chain.from_iterable(self.a.encode(joined)))
        b = list(chain.from_iterable(self.b.encode([c[1:] for c in joined], num_threads=1)))
        at_a, at_b = (_cut_at(ids, own, sizes, ends, whole) for ids, own, sizes in ((a, self.a_bytes, self.a_sizes), (b, self.b_bytes, self.b_sizes)))
        wrong = np.zeros(len(chunks), bool)
        if at_a is None or at_b is None:  # a chunk whose tokens' bytes differ: one by one
            of_a, of_b = self.a.encode(chunks), self.b.encode([c[1:] for c in chunks], num_threads=1)
            for i, (x, y, r) in enumerate(zip(of_a, of_b, raw, strict=True)):
                if b"".join([self.a_bytes[k] for k in x]) != r or b"".join([self.b_bytes[k] for k in y]) != r:
                    wrong[i], of_a[i], of_b[i] = True, [], []
            a, b = list(chain.from_iterable(of_a)), list(chain.from_iterable(of_b))
            at_a, at_b = _offsets(of_a), _offsets(of_b)
        first = len(self.groups)
        self.table.update(zip(chunks, range(first, first + len(chunks)), strict=True))
        self.bad.update((first + np.flatnonzero(wrong)).tolist())
        self.held += 280 * len(chunks) + len(whole)
        self._align(np.array(a, np.int64), np.array(b, np.int64), at_a, at_b)

    def _align(self, a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> None:
        """Both tokenizers' ids of many chunks of equal bytes, chunk after chunk."""
        ends_a, ends_b = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        # byte offset of each token's end -> the token's place
        by_end_a, by_end_b = dict(zip(ends_a.tolist(), range(len(a)), strict=True)), dict(zip(ends_b.tolist(), range(len(b)), strict=True))
        common = sorted(by_end_a.keys() & by_end_b.keys())
        stop_a = np.fromiter(map(by_end_a.__getitem__, common), np.int64, len(common)) + 1
        stop_b = np.fromiter(map(by_end_b.__getitem__, common), np.int64, len(common)) + 1
        # links of a group: its tokens overlap wherever one of the two ends, once for each such end
        ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
        ends = ends[first_of_each(ends)]
        pair = a[np.searchsorted(ends_a, ends)] * self.width + b[np.searchsorted(ends_b, ends)]
        in_groups = np.searchsorted(stop_a, at_a, side="right")  # groups that end at or before a chunk's start
        in_links = np.searchsorted(ends, np.concatenate([[0], ends_a])[at_a], side="right")
        # a group's ids of A, then its ids of B
        group_a, group_b = np.searchsorted(stop_a, np.arange(len(a)), side="right"), np.searchsorted(stop_b, np.arange(len(b)), side="right")
        before_b = np.concatenate([[0], stop_b])
        many, last_a, last_b = len(self.written) // 3, np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[stop_a - 1], last_b[stop_b - 1] = 1, 2
        text = np.empty(len(a) + len(b), np.int64)
        text[np.arange(len(a)) + before_b[group_a]] = a + many * last_a
        text[np.arange(len(b)) + stop_a[group_b]] = b + many * last_b
        words, packed, step = [self.written[i] for i in text.tolist()], pair.astype(self.code).tobytes(), np.dtype(self.code).itemsize
        for s, e in zip((at_a + at_b)[:-1].tolist(), (at_a + at_b)[1:].tolist(), strict=True):
            self.groups.append(b"".join(words[s:e]))
        for s, e in zip((in_links * step)[:-1].tolist(), (in_links * step)[1:].tolist(), strict=True):
            self.pairs.append(packed[s:e])
        self.sizes.append(np.stack([np.diff(x) for x in (at_a, at_b, in_groups, in_links)], axis=1))
        self.held += len(packed) + 6 * len(text)

    def numbers(self) -> np.ndarray:
        """(tokens of A, tokens of B, groups, links) of all slots."""
        if len(self.sizes) > 1:
            self.sizes = [np.concatenate(self.sizes)]
        return self.sizes[0] if self.sizes else np.zeros((0, 4), np.int64)


def _segments(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    ends = np.concatenate([[0], np.cumsum(x)])
    return ends[at[1:]] - ends[at[:-1]]


def _cut_at(ids: list[int], own: list[bytes], sizes: np.ndarray, ends: np.ndarray, whole: bytes) -> np.ndarray | None:
    """Where chunks that end at these bytes cut the ids; None if the ids' bytes are not the whole, or a token crosses an end."""
    stops = np.cumsum(sizes[ids])
    at = np.searchsorted(stops, ends)
    if len(stops) and stops[-1] == len(whole) and (stops[at] == ends).all() and b"".join([own[i] for i in ids]) == whole:
        return np.concatenate([[0], at + 1])
    return None


def _offsets(lists: list[list[int]]) -> np.ndarray:
    out = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([len(x) for x in lists], out=out[1:])
    return out


def cut(texts: pa.Array, cuts: bool = True) -> tuple[pa.Array, np.ndarray]:
    """(chunks of a space and the text, all texts' in a row; offsets of each text's). Null and empty texts have none."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not cuts:
        chunks = [" " + t for t in texts.to_pylist() if t]
        return pa.array(chunks, pa.large_string()), np.concatenate([[0], np.cumsum(pc.not_equal(texts, "").to_numpy(zero_copy_only=False), dtype=np.int64)])
    counts = np.zeros(len(texts), np.int64)
    full = pc.not_equal(texts, "").to_numpy(zero_copy_only=False)
    odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
    if not (odd & full).any():
        parts = pc.split_pattern(texts.filter(pa.array(full)), " ")
        lead, space = (pa.scalar(x, pa.large_string()) for x in ("", " "))
        counts[full] = pc.list_value_length(parts).to_numpy(zero_copy_only=False)
        chunks = pc.binary_join_element_wise(lead, parts.flatten(), space)
    else:
        values = texts.to_pylist()
        cuts = [(_GAP.split(" " + t) if o else (" " + t.replace(" ", "\0 ")).split("\0") if "\0" not in t else _GAP.split(" " + t)) if t else [] for t, o in zip(values, odd, strict=True)]
        counts[:] = [len(c) for c in cuts]
        chunks = pa.array([x for c in cuts for x in c], pa.large_string())
    return chunks, np.concatenate([[0], np.cumsum(counts)])


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """The two tokenizers, loaded once in each Python worker."""
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
    return _ALIGNERS[a_path, b_path]


ROWS = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary, pair long, n long"
_NAMES = [x.split()[0] for x in ROWS.split(", ")]


def _document_rows(model: Aligner, batch: pa.RecordBatch, serial: int) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray]:
    """(rows of a batch's documents, distinct pairs of all of them, their times)."""
    if model.held > KEEP_BYTES:
        model.clear()
    chunks, at = cut(batch.column("text"), model.cuts)
    coded = chunks.dictionary_encode()
    slots = np.array(model.slots(coded.dictionary.to_pylist()), np.int64)[coded.indices.to_numpy()] if len(chunks) else np.zeros(0, np.int64)
    rows = batch.num_rows
    whole = np.diff(at) > 0
    if model.bad:
        wrong = np.isin(slots, list(model.bad))
        whole[np.repeat(np.arange(rows), np.diff(at))[wrong]] = False
    sums = np.stack([_segments(x, at) for x in model.numbers()[slots].T], axis=1) if len(slots) else np.zeros((rows, 4), np.int64)
    sums[~whole] = 0
    out_sha, out_pairs, out_times = [""] * rows, [b""] * rows, [b""] * rows
    all_pairs, all_times = [], []
    listed, groups, pairs = slots.tolist(), model.groups, model.pairs
    for r in np.flatnonzero(whole).tolist():
        own = listed[at[r] : at[r + 1]]
        out_sha[r] = hashlib.sha256(b"".join([groups[i] for i in own])[:-1]).hexdigest()
        found, times = np.unique(np.frombuffer(b"".join([pairs[i] for i in own]), model.code), return_counts=True)
        out_pairs[r], out_times[r] = found.tobytes(), times.astype("<u4").tobytes()
        all_pairs.append(found)
        all_times.append(times)
    none = pa.array([None] * rows, pa.int64())
    columns = [pa.array(serial + np.arange(rows)), batch.column("doc_id"), *(pa.array(np.ascontiguousarray(sums[:, i])) for i in range(4))]
    record = pa.RecordBatch.from_arrays([*columns, pa.array(out_sha), pa.array(out_pairs, pa.binary()), pa.array(out_times, pa.binary()), none, none], _NAMES)
    empty = np.zeros(0, np.int64)
    return record, *_summed([np.concatenate(all_pairs).astype(np.int64)] if all_pairs else [empty], [np.concatenate(all_times)] if all_times else [empty])


def _summed(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, n = np.concatenate(keys), np.concatenate(times)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(first_of_each(key)) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(n, first) if len(first) else n


def _count_rows(key: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64()] * 6 + [pa.string(), pa.binary(), pa.binary()]
    for at in range(0, len(key), 50_000):
        part = key[at : at + 50_000]
        yield pa.RecordBatch.from_arrays([*(pa.nulls(len(part), k) for k in kinds), pa.array(part), pa.array(n[at : at + 50_000].astype(np.int64))], _NAMES)


def align_rows(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Rows of documents (row, doc_id, counts, digest, distinct pairs and their times) and of pairs (pair, n) as each task has summed them."""
    ship(docs.sparkSession)

    def run(batches):
        model, serial = aligner(a_path, b_path), TaskContext.get().partitionId() << 33
        keys, times, size = [], [], 0
        for batch in cut_rows(batches, SLICE):
            record, key, n = _document_rows(model, batch, serial)
            serial += batch.num_rows
            yield record
            keys.append(key)
            times.append(n)
            size += len(key)
            if size > 2 * FLUSH:
                key, n = _summed(keys, times)
                if len(key) > FLUSH:
                    yield from _count_rows(key, n)
                    keys, times, size = [], [], 0
                else:
                    keys, times, size = [key], [n], len(key)
        if keys:
            yield from _count_rows(*_summed(keys, times))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, ROWS)


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """Rows (pair, n, best): an id pair's links over the corpus, and whether no pair of its B id has more."""
    counts = staged(aligned.where("pair is not null").groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    most = counts.groupBy(F.pmod("pair", F.lit(width)).alias("b")).agg(F.max("n").alias("most"))
    joined = counts.withColumn("b", F.pmod("pair", F.lit(width))).join(F.broadcast(most), "b")  # a row for each B id at most
    return staged(joined.select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")


def score_links(aligned: DataFrame, counts: DataFrame, code: str, head: int = HEAD) -> DataFrame:
    """Document rows with ``n_best`` and ``count_sum``."""
    spark = aligned.sparkSession
    rows = aligned.where("row is not null").drop("pair", "n")
    least = 1
    if counts.count() > head:
        least = -(-int(counts.agg(F.sum("n")).first()[0]) // head)
    top = counts.where(F.col("n") >= least).select("pair", "n", "best").toArrow()  # head rows at most
    key = top.column("pair").to_numpy()
    order = np.argsort(key)
    known = spark.sparkContext.broadcast((key[order], top.column("n").to_numpy()[order], top.column("best").to_numpy(zero_copy_only=False).astype(bool)[order]))
    fields = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum decimal(38,0), rare array<long>, rare_times array<long>"
    names = [x.split()[0] for x in fields.replace("decimal(38,0)", "decimal").split(", ")]

    def run(batches):
        key, n, best = known.value
        for batch in cut_rows(batches):
            parts = [np.frombuffer(x, code) for x in batch.column("pairs").to_pylist()]
            at = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
            pair = np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
            times = np.frombuffer(b"".join(batch.column("times").to_pylist()), "<u4").astype(np.int64)
            place = np.minimum(np.searchsorted(key, pair), max(0, len(key) - 1))
            here = key[place] == pair if len(key) else np.zeros(len(pair), bool)
            place = np.where(here, place, 0)
            good = np.where(here & best[place], times, 0) if len(key) else np.zeros_like(times)
            value = np.where(here, n[place], 0) * times if len(key) else np.zeros_like(times)
            rest = np.flatnonzero(~here)
            cuts = pa.array(np.searchsorted(rest, at), pa.int32())
            sums = [int(x) for x in _segments(value, at)]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in names[:7]),
                    pa.array(_segments(good, at)),
                    pa.array(sums, pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(cuts, pa.array(pair[rest])),
                    pa.ListArray.from_arrays(cuts, pa.array(times[rest])),
                ],
                names,
            )

    scored = rows.mapInArrow(run, fields)
    if least > 1:
        scored = staged(scored, "scored")
        asked = scored.select("row", F.explode(F.arrays_zip("rare", "rare_times")).alias("x")).select("row", F.col("x.rare").alias("pair"), F.col("x.rare_times").alias("times"))
        met = asked.join(counts.where(F.col("n") < least), "pair")
        more = met.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum((F.col("times") * F.col("n")).cast("decimal(38,0)")).alias("more_sum"))
        scored = scored.join(more, "row", "left")
        best = F.col("n_best") + F.coalesce("more_best", F.lit(0))
        total = F.col("count_sum") + F.coalesce("more_sum", F.lit(0))
    else:
        best, total = F.col("n_best"), F.col("count_sum")
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", best.cast("long").alias("n_best"), total.cast("long").alias("count_sum"), "groups_sha256")


def align_documents(docs: DataFrame, a_path: str, b_path: str, head: int = HEAD) -> DataFrame:
    """Rows (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one for each row of ``docs`` (doc_id, text)."""
    model = Aligner(a_path, b_path)  # for the sizes of its vocabularies
    aligned = staged(align_rows(docs, a_path, b_path), "aligned")
    return score_links(aligned, pair_counts(aligned, model.width), model.code, head)
