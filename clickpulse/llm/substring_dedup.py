"""Removal of passages that repeat, by sliding spans of sentences.

Method: a text is cut into sentences, and those of more than ``MOST_WORDS``
words further: before the word whose hash with the word before it is the least
of ``WINDOW`` neighbours (the last of equal ones). So cuts follow the words near
them, wherever the sentence begins and ends, a piece has ``MOST_WORDS`` words at
most, and any 50 words that two texts share hold a whole span. Pieces count as
sentences in what follows. Every shortest run of consecutive
sentences of at least ``MIN_WORDS`` words, read forward from each sentence and
backward from each, is a span and gets a hash: in prose, several whole
sentences; a sentence of ``MIN_WORDS`` words or more may hold one by itself, as
its pieces are the run. All spans are joined by hash
over all documents. The first occurrence of a span (least doc_id, then least
position) stays; the sentences of every other occurrence go. Runs read both
ways cover a repeated passage from its first whole sentence to its last.

The corpus is cut twice. The first time only hashes leave the tasks, and those
that occur twice are counted out; the second time a span leaves its task only
if a bitmap of fixed size (``SLOTS`` bits, set by the repeated hashes) holds its
hash; what the bitmap lets through by chance occurs once and loses nothing. So
what is shuffled is the hashes, and the places of repeated spans.

A sentence ends with a word that ends in ``.``, ``!`` or ``?``, or at a line
break; spans compare as words (A-Z lower-cased, white space aside). What
stands between sentences belongs to the one before.

Null text stays null; texts of fewer words have no span. A document is an id
with a text: rows that agree in both count as one and lose the same sentences;
unlike texts of one id are documents of their own (of equal ids, the one with
the lesser hash of its text comes first). Rows without doc_id keep their text
and count as no occurrence. Other columns pass through, save that ``n_chars``
(if it is there) follows a changed text, and a column ``dropped_sentences`` is
replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from clickpulse.llm.common import cut_rows, mix64, scratch, ship, signed, staged, text_bytes, word_places

MIN_WORDS = 20
MOST_WORDS = 15
WINDOW = 10
SLOTS = 1 << 26  # bits of the bitmap: 8 MB
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95  # of the running hash of words; odd, so that its powers have inverses
_SIZE = np.uint64(0x2545F4914F6CDD1D)


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as many as have been asked for."""

    def __init__(self):
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            both = [np.full(size, x, np.uint64) for x in (_BASE, pow(_BASE, -1, 1 << 64))]
            for factors in both:
                factors[0] = 1
            self.up, self.down = (np.cumprod(factors, dtype=np.uint64) for factors in both)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def _least_of_window(marks: np.ndarray) -> np.ndarray:
    """For each place, which of ``WINDOW`` marks from there on is the least (the last of equal ones)."""
    value, at, width = marks, np.arange(len(marks)), 1
    while width < WINDOW:
        step = min(width, WINDOW - width)
        right, right_at = value[step:], at[step:]
        take = right <= value[:-step]
        value, at = np.where(take, right, value[:-step]), np.where(take, right_at, at[:-step])
        width += step
    return at


class Cut:
    """The texts of a column, cut into sentences and pieces of long ones.

    ``first``: the number of the word with which each piece begins, over all
    texts; ``pieces``: offsets of each text's pieces; ``begin`` and ``end``:
    bytes of each piece, from its text's first on.
    """

    def __init__(self, column: pa.Array):
        data, self.at = text_bytes(column)
        self.words, self.offsets, begin, end = word_places(data, self.at)
        n = len(self.words)
        of_row = np.zeros(n, bool)
        of_row[self.offsets[:-1][np.diff(self.offsets) > 0]] = True
        breaks = of_row.copy()
        if n:
            lines = np.searchsorted(np.flatnonzero(data == 10), begin)
            breaks[1:] |= (lines[1:] != lines[:-1]) | np.isin(data[end[:-1] - 1], (33, 46, 63))
        starts = np.flatnonzero(breaks)
        sizes = np.diff(starts, append=n)
        if (sizes > MOST_WORDS).any():
            marks = mix64(self.words[:-1] * _PAIR + self.words[1:])  # between a word and the next
            least = _least_of_window(marks)
            ends = np.repeat(starts + sizes, sizes)[: len(least)]  # a window lies in one long sentence
            inside = (np.repeat(sizes > MOST_WORDS, sizes)[: len(least)]) & (np.arange(len(least)) + WINDOW < ends)
            breaks[least[inside] + 1] = True
        self.first = np.flatnonzero(breaks)
        self.pieces = np.searchsorted(self.first, self.offsets)
        row = np.repeat(np.arange(len(self.at) - 1), np.diff(self.pieces))
        lead = begin[self.first] - self.at[row] if n else np.zeros(0, np.int64)
        lead[of_row[self.first]] = 0
        self.begin = lead
        self.end = np.append(lead[1:], 0)[: len(lead)]
        last = self.pieces[1:][np.diff(self.pieces) > 0] - 1
        self.end[last] = np.diff(self.at)[np.diff(self.pieces) > 0]
        self.row = row

    def spans(self, min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash, text, first piece within the text, number of pieces) of all spans, text by text."""
        n, count = len(self.words), len(self.first)
        edge = np.append(self.first, n)  # words where pieces begin; the last piece's end
        low, high = self.pieces[self.row], self.pieces[self.row + 1]
        start = np.arange(count)
        stop = np.searchsorted(edge, self.first + min_words)  # forward: the first end with enough words
        good = stop <= high
        back = np.searchsorted(edge, edge[1:] - min_words, side="right") - 1  # backward from each piece's end
        other = (back >= low) & (edge[1:] - min_words >= 0)
        other[other] &= ~(good[back[other]] & (stop[back[other]] == start[other] + 1))  # found forward already
        s, e = np.concatenate([start[good], back[other]]), np.concatenate([stop[good], start[other] + 1])
        order = np.lexsort((e, s))
        s, e = s[order], e[order]
        up, down = _POWERS.of(n + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.words * up[:n], dtype=np.uint64)])
        a, b = edge[s], edge[e]
        hashes = mix64((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64) * _SIZE)
        row = self.row[s]
        return hashes, row, s - self.pieces[row], e - s


def sentences(text: str) -> list[str]:
    """The text cut into sentences, long ones into pieces, that join to it again."""
    cut, raw = Cut(pa.array([text], pa.large_string())), text.encode()
    return [raw[a:b].decode() for a, b in zip(cut.begin, cut.end, strict=True)] or [text] * bool(text)


def spans(text: str, min_words: int = MIN_WORDS) -> tuple[list[int], list[int], list[int]]:
    """(hash, first sentence, number of sentences) of each of the text's spans."""
    found, _, first, count = Cut(pa.array([text], pa.large_string())).spans(min_words)
    return signed(found).tolist(), first.tolist(), count.tolist()


def _documents(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.where("doc_id is not null")


def text_hash(text: Column) -> Column:
    """Tells texts of one id apart."""
    return F.xxhash64(text.cast("string"))


def _repeated(docs: DataFrame, min_words: int) -> DataFrame:
    """Rows (span) of the hashes that occur twice or more."""

    def run(batches):
        for batch in cut_rows(batches):
            found = Cut(batch.column("text")).spans(min_words)[0]
            yield pa.RecordBatch.from_arrays([pa.array(signed(found))], ["span"])

    hashes = _documents(docs).select("text").mapInArrow(run, "span long")
    return hashes.groupBy("span").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("span")


def _bitmap(repeated: DataFrame) -> np.ndarray:
    """Bits of ``SLOTS`` slots, those of the repeated hashes set: SLOTS / 64 rows at most reach the driver."""
    slot = F.col("span").bitwiseAND(F.lit(SLOTS - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))
    words = repeated.select(F.shiftright(slot, 6).cast("int").alias("place"), bit.alias("bit")).groupBy("place").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(SLOTS // 64, np.uint64)
    out[words.column("place").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


PLACES = "span long, doc_id long, h long, first int, count int, begin long, end long"


def _places(docs: DataFrame, bitmap: np.ndarray, min_words: int) -> DataFrame:
    """Rows ``PLACES`` of the spans that the bitmap holds: number of the first piece, of pieces, and their bytes."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        bits = shared.value
        for batch in cut_rows(batches):
            cut = Cut(batch.column("text"))
            found, row, first, count = cut.spans(min_words)
            slot = found & np.uint64(SLOTS - 1)
            keep = np.flatnonzero((bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1))
            found, row, first, count = found[keep], row[keep], first[keep], count[keep]
            at = cut.pieces[row] + first
            of_row = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(found)),
                    batch.column("doc_id").take(of_row),
                    batch.column("h").take(of_row),
                    pa.array(first.astype(np.int32)),
                    pa.array(count.astype(np.int32)),
                    pa.array(cut.begin[at]),
                    pa.array(cut.end[at + count - 1]),
                ],
                [x.split()[0] for x in PLACES.split(", ")],
            )

    rows = _documents(docs)
    return rows.select("doc_id", "text", text_hash(F.col("text")).alias("h")).mapInArrow(run, PLACES)


def repeated_places(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Rows (doc_id, h, places) for documents that lose sentences: every occurrence of a span but its first.

    ``places``: structs of the first piece, the number of pieces, their first
    byte and their end, each once.
    """
    ship(docs.sparkSession)
    with scratch() as own:
        lost = staged(_repeated_places(docs, min_words), "lost")
        own.keep(lost)
    return lost


def _repeated_places(docs: DataFrame, min_words: int) -> DataFrame:
    repeated = staged(_repeated(docs, min_words), "repeated")
    found = staged(_places(docs, _bitmap(repeated), min_words), "places")
    where = F.struct("doc_id", "h", "first")
    homes = found.groupBy("span").agg(F.min(where).alias("home"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # written, so that the join has a shuffle on either side and a hot span's rows can be split
    home = staged(homes.select("span", "home"), "homes")
    gone = found.join(home, "span").where(where != F.col("home"))
    place = F.struct("first", "count", "begin", "end")
    return gone.groupBy("doc_id", "h").agg(F.collect_set(place).alias("places"))


def _joined(ranges) -> list[list[int]]:
    """Ranges as few as they can be, in order."""
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return out


@pandas_udf(StructType([StructField("text", StringType()), StructField("n", IntegerType())]))
def _without(text: pd.Series, places: pd.Series) -> pd.DataFrame:
    out = []
    for t, own in zip(text, places, strict=True):
        if t is None or own is None:
            out.append((t, 0))
            continue
        raw, kept, at = t.encode(), [], 0
        for a, b in _joined((p["begin"], p["end"]) for p in own):
            kept.append(raw[at:a])
            at = b
        n = sum(b - a for a, b in _joined((p["first"], p["first"] + p["count"]) for p in own))
        out.append((b"".join([*kept, raw[at:]]).decode(), n))
    return pd.DataFrame(out, columns=["text", "n"])


def drop_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``, and ``dropped_sentences`` (int)."""
    ship(docs.sparkSession)
    at = {c: F.col(f"c{i}") for i, c in enumerate(docs.columns)}  # numbers for names, so that none clashes
    numbered = docs.toDF(*[f"c{i}" for i in range(len(at))])
    lost = repeated_places(docs, min_words).select(F.col("doc_id").alias("lost_doc"), F.col("h").alias("lost_h"), F.col("places").alias("lost"))
    joined = numbered.join(lost, (at["doc_id"] == F.col("lost_doc")) & (text_hash(at["text"]) == F.col("lost_h")), "left")
    some = F.col("lost").isNotNull()
    cleaned = joined.withColumn("cleaned", _without(F.when(some, at["text"].cast("string")), F.col("lost")))
    out = {c: x for c, x in at.items() if c != "dropped_sentences"}
    out["text"] = F.when(some, F.col("cleaned.text")).otherwise(at["text"])
    if "n_chars" in at:
        out["n_chars"] = F.when(some, F.length("cleaned.text").cast(docs.schema["n_chars"].dataType)).otherwise(at["n_chars"])
    return cleaned.select(*[x.alias(c) for c, x in out.items()], F.col("cleaned.n").alias("dropped_sentences"))


def substring_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated passages, with the columns they came with."""
    own = "dropped_sentences"
    if own not in docs.columns:
        return drop_repeats(docs).drop(own)
    aside = next(x for x in (f"{own}_{i}" for i in range(len(docs.columns) + 1)) if x not in docs.columns)
    names = [aside if c == own else c for c in docs.columns]
    return drop_repeats(docs.toDF(*names)).drop(own).toDF(*docs.columns)
