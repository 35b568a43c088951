"""Scores of texts by a probabilistic suffix tree of words.

Method: the tree's states are contexts of one word and more. A context becomes
a state if its next words diverge from those of its suffix, a state itself: its
count times the Kullback-Leibler divergence must exceed the cost of describing
its entries (half the logarithm of all tokens, for each). An entry is a next
word seen ``LEAST_COUNT`` times at least after the context. Contexts lengthen
for as long as this finds states. A state's distribution is its entries' counts
less a discount; what that leaves goes to the distribution of its suffix, down
to the single tokens' add-``ALPHA`` distribution. A token's probability is that
of the longest state that its preceding words end with.

As sums: a text's score is that of its single tokens, plus the logarithm of the
left mass of every state that a token stands after, plus a gain for every entry
met. So states and entries are one table of (key, value), with 64-bit hashes as
keys, and scoring is a join by key. It is built depth by depth with grouped
sums and joins; its size follows the input. States whose
counts rule out longer ones end there (``_fertile``, exact). Once the others
concern less than a ``FEW``-th of the tokens, those tokens are cut out with the
``WINDOW`` tokens before them, equal ones as one row. The states below each of
those states grow from these rows in one job, a bucket of states in a task;
while one state concerns more than ``LOCAL`` tokens, depth by depth.
Only what has a share of ``SHARED``
of the training tokens is broadcast (``1 / SHARED`` words, states of a length
and entries of a length at most); the rest is joined. Filters of a fixed size
that may say yes wrongly, never no, keep what can't be found from the shuffles.

Training: rows whose ``crc32(doc_id as text) mod FOLDS`` is not 0 (null reads
as the empty text). Counts cover all of these texts. Single tokens and runs are
counted in each task first and then summed by hash.

Tokens: words with A-Z lower-cased, then one end for each text. Null text
counts as empty: the end alone. Repeated rows count and are scored each. With
no training rows, all counts are 0.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import cut_rows, first_of_each, mix64, release, scratch, ship, signed, staged, word_hashes

ALPHA = 0.1
FOLDS = 10
SHARED = 1e-6
DISCOUNT = 0.75
LEAST_COUNT = 2
END = np.uint64(0x0E4D0F7E87C0DE01)
FLUSH = 1_500_000  # keys held by a counting task
FLUSH_RUNS = 1_000_000  # runs held by a counting task
PIECE = 1 << 20  # bytes of packed keys that leave a task together
MOST_BUCKETS = 1 << 17
FEW = 64  # training tokens for each token that deeper contexts can concern, from which on windows take the texts' place
WINDOW = 64  # depths for which one cutting of windows serves
LOCAL = 1 << 15  # most tokens that stand after a state whose longer ones grow in one task
FILTER_BITS = 28
_LONGER = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == 0


def _tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of a batch, an end after each text, and the texts' offsets."""
    words, at = word_hashes(batch.column("text"))
    out = np.insert(words, at[1:], END)
    return out, at + np.arange(len(at))


# --- counting ----------------------------------------------------------------


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(first_of_each(keys))
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts


def _planes(x: np.ndarray) -> bytes:
    """An array's bytes, all first bytes, then all second bytes, and so on: what is 0 throughout compresses away."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T.tobytes()


def _unplanes(raw, kind) -> np.ndarray:
    wide = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(wide, -1).T).view(kind).ravel()


def _bits(buckets: int) -> int:
    """How many first bits of a key name its bucket."""
    return (min(max(buckets, 1), MOST_BUCKETS) - 1).bit_length()


def _packed(buckets: int, keys: np.ndarray, **more: np.ndarray):
    """Rows (bucket, keys, more): a row for each range of sorted keys, in batches of about ``PIECE`` bytes."""
    bits = _bits(buckets)
    cuts = np.append(np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(1, np.uint64)), len(keys))
    rows, size = [], 0
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        own = slice(cuts[b], cuts[b + 1])
        rows.append((b, _planes(np.diff(keys[own], prepend=np.uint64(0))), *[_planes(x[own]) for x in more.values()]))
        size += sum(map(len, rows[-1][1:]))
        if size > PIECE or cuts[b + 1] == len(keys):
            bucket, *packed = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), *[pa.array(x, pa.binary()) for x in packed]], ["bucket", "keys", *more])
            rows, size = [], 0


def _unpacked(table: pa.Table, **kinds) -> list[np.ndarray]:
    """The keys of packed rows, and their further columns."""
    keys = np.concatenate([np.cumsum(_unplanes(x.as_buffer(), np.uint64), dtype=np.uint64) for x in table.column("keys")])
    return [keys, *[np.concatenate([_unplanes(x.as_buffer(), kind) for x in table.column(name)]) for name, kind in kinds.items()]]


class _Counter:
    """Distinct keys with counts; gives them as packed rows."""

    def __init__(self, buckets: int):
        self.buckets, self.new, self.size = buckets, [], 0
        self.held = (np.zeros(0, np.uint64), np.zeros(0, np.int64))

    def add(self, keys: np.ndarray):
        self.new.append(keys)
        self.size += len(keys)
        if self.size > FLUSH:
            self._count()
            if len(self.held[0]) > FLUSH // 2:
                yield from self._rows()

    def _count(self):
        keys = np.concatenate([np.zeros(0, np.uint64), *self.new])
        self.new, self.size = [], 0
        keys.sort()
        first = np.flatnonzero(first_of_each(keys)) if len(keys) else np.zeros(0, np.int64)
        own = keys[first], np.diff(first, append=len(keys))
        self.held = _summed(*[np.concatenate(x) for x in zip(self.held, own, strict=True)]) if len(self.held[0]) else own

    def _rows(self):
        keys, counts = self.held
        self.held = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        yield from _packed(self.buckets, keys, counts=counts.astype(np.uint32))

    def rows(self):
        self._count()
        yield from self._rows()


COUNTED = "bucket int, keys binary, counts binary"


def _merge(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = _unpacked(table, counts=np.uint32)
    return _summed(keys, counts.astype(np.int64))


def _training(batch: pa.RecordBatch) -> pa.RecordBatch:
    return batch.filter(pa.array([not held_out(d) for d in batch.column("doc_id").to_pylist()], pa.bool_()))


def word_counts(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows (word, n) of all training tokens, by hash."""

    def count(batches):
        counter = _Counter(buckets)
        for batch in cut_rows(batches):
            yield from counter.add(_tokens(_training(batch))[0])
        yield from counter.rows()

    def merge(key, table):
        words, n = _merge(table)
        return pa.table({"word": pa.array(signed(words)), "n": pa.array(n, pa.int64())})

    return docs.mapInArrow(count, COUNTED).groupBy("bucket").applyInArrow(merge, "word long, n long")


class Places:
    """Where spread 64-bit keys stand among sorted ones: by a table of first bits, then step by step."""

    def __init__(self, keys: np.ndarray):
        bits = len(keys).bit_length() + 1
        self.keys, self.shift = np.append(keys, np.uint64(2**64 - 1)), np.uint64(64 - bits)
        self.first = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, whether it is the key's own) of each key; a place among the keys, 0 at least."""
        at = self.first[keys >> self.shift]
        behind = np.flatnonzero(self.keys[at] < keys)
        while len(behind):
            at[behind] += 1
            behind = behind[self.keys[at[behind]] < keys[behind]]
        own = (self.keys[at] == keys) & (at < len(self.keys) - 1)
        at[~own] = 0
        return at, own


class Frequent:
    """Frequent words by hash, and their counts."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, total: int):
        order = np.argsort(words)
        self.words, self.counts, self.total = words[order], counts[order], total
        self.places = Places(self.words)

    def numbers(self, tokens: np.ndarray) -> np.ndarray:
        """Each token's place among the words; -1 if it is not frequent."""
        if not len(self.words):
            return np.full(len(tokens), -1, np.int64)
        at, own = self.places.find(tokens)
        return np.where(own, at, -1)


# --- the tree as a table ------------------------------------------------------


class Filter:
    """Bits of a set of spread 64-bit keys: ``has`` is true for all of them and for few others."""

    def __init__(self, bits: int, raw: np.ndarray):
        self.bits, self.raw, self.depths = bits, raw, 1  # how many depths it serves

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = keys >> np.uint64(64 - self.bits)
        return (self.raw[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _packed_keys(keys: DataFrame, buckets: int) -> DataFrame:
    """Packed rows of keys (column key)."""

    def pack(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch.column("key").to_numpy().view(np.uint64))
            size += len(held[-1])
            if size > FLUSH:
                yield from _packed(buckets, np.sort(np.concatenate(held)))
                held, size = [], 0
        if held:
            yield from _packed(buckets, np.sort(np.concatenate(held)))

    return keys.select("key").mapInArrow(pack, "bucket int, keys binary")


def _filter(packed: DataFrame, n: int, buckets: int) -> Filter:
    """The filter of ``n`` keys in packed rows: 2 ** FILTER_BITS bits at most, a part for each bucket."""
    bits = min(FILTER_BITS, max(20, int(16 * n).bit_length()))
    own = bits - _bits(buckets)

    def part(key, table):
        (keys,) = _unpacked(table)
        marks = np.zeros(1 << own, np.uint8)
        marks[(keys >> np.uint64(64 - bits)) & np.uint64((1 << own) - 1)] = 1
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "raw": pa.array([np.packbits(marks, bitorder="little").tobytes()], pa.binary())})

    raw, size = np.zeros(1 << (bits - 3), np.uint8), 1 << (own - 3)
    for r in packed.select("bucket", "keys").groupBy("bucket").applyInArrow(part, "part int, raw binary").collect():  # FILTER_BITS at most
        raw[r["part"] * size : (r["part"] + 1) * size] = np.frombuffer(r["raw"], np.uint8)
    return Filter(bits, raw)


def _entry(context, up):
    return context.bitwiseXOR(F.shiftleft(up, 17).bitwiseOR(F.shiftrightunsigned(up, 47)))


def _unmix64(x: np.ndarray) -> np.ndarray:
    """``mix64`` undone."""
    x = x ^ (x >> np.uint64(31)) ^ (x >> np.uint64(62))
    x *= np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))
    x = x ^ (x >> np.uint64(27)) ^ (x >> np.uint64(54))
    x *= np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    return x ^ (x >> np.uint64(30)) ^ (x >> np.uint64(60))


def _deeper(tokens: np.ndarray, at: np.ndarray, filters: list, where: np.ndarray | None = None):
    """(position, context, entry, entry of the context's suffix) of tokens, one array each, for every depth.

    ``where``: the positions asked for, all if not given. Each depth has the tokens whose contexts up to this depth pass the filters; one depth more than there are filters.
    """
    place = np.arange(len(tokens)) - np.repeat(at[:-1], np.diff(at))
    where = np.arange(len(tokens)) if where is None else where
    context, entry = np.zeros(len(where), np.uint64), tokens[where]
    for depth in range(1, len(filters) + 2):
        good = place[where] >= depth
        where, context, up = where[good], context[good], entry[good]
        context = mix64(context * _LONGER + tokens[where - depth])
        if depth <= len(filters):
            good = filters[depth - 1].has(context)
            where, context, up = where[good], context[good], up[good]
        entry = context ^ ((up << np.uint64(17)) | (up >> np.uint64(47)))  # as in _entry
        yield where, context, entry, up


def _summed_rows(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Rows of equal first column as one, with the sum of the last."""
    order = np.argsort(columns[0])
    first = np.flatnonzero(first_of_each(columns[0][order]))
    return [*[c[order[first]] for c in columns[:-1]], np.add.reduceat(columns[-1][order], first) if len(first) else columns[-1]]


def _source(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray | None, np.ndarray]:
    """(tokens, offsets of rows, positions that count or None for all, how often each position counts) of texts or windows."""
    if "window" in batch.schema.names:
        own = [x.as_buffer() for x in batch.column("window")]
        at = np.concatenate([[0], np.cumsum([x.size // 8 for x in own])]).astype(np.int64)
        tokens = np.frombuffer(b"".join(own), "<u8")
        return tokens, at, at[1:] - 1, np.repeat(batch.column("n").to_numpy(), np.diff(at))
    tokens, at = _tokens(_training(batch))
    return tokens, at, None, np.ones(len(tokens), np.int64)


def _run(context: np.ndarray, up: np.ndarray) -> np.ndarray:
    """As ``_entry``."""
    return context ^ ((up << np.uint64(17)) | (up >> np.uint64(47)))


def _paired(tokens: np.ndarray, where: np.ndarray, depth: int, pairs) -> np.ndarray:
    """Whether the contexts of this depth begin with one of the pairs of words."""
    return pairs.has(_run(mix64(tokens[where - depth]), tokens[where - depth + 1]))


def _candidates(batch: pa.RecordBatch, filters: list, entries, pairs) -> tuple:
    """(context, times) of all training tokens one deeper than the filters; (entry, context's place, suffix's entry, times) where that may be one.

    The contexts of a word and of two are left out: they stand as often as the word and the pair. Those of more words begin with a pair of ``pairs``.
    """
    tokens, at, where, times = _source(batch)
    *_, (where, context, entry, up) = _deeper(tokens, at, filters, where)
    if not filters:
        return (context[:0], times[:0]), (entry, up, times[where])
    good = _paired(tokens, where, len(filters) + 1, pairs)
    where, context, entry, up = where[good], context[good], entry[good], up[good]
    good = entries.has(up)
    counted = slice(0 if len(filters) == 1 else None)
    return (context[counted], times[where[counted]]), (entry[good], up[good], times[where[good]])


def windows(docs: DataFrame, found, left: int, buckets: int) -> DataFrame:
    """Rows (bucket, window, n): each training token that stands after a state of the last filter's depth, with ``left`` tokens before it.

    Equal windows are one row; ``n`` says how many there are. Their last tokens are all that deeper contexts can concern;
    those whose next context begins with a pair that stands once are left out. ``bucket`` is the state's.
    """

    def cut(batches):
        filters, _, pairs = found.value
        for batch in cut_rows(batches):
            tokens, at = _tokens(_training(batch))
            *_, (where, state, _, _), (deep, _, _, _) = _deeper(tokens, at, filters)  # with one token more before them at least
            deep = deep[_paired(tokens, deep, len(filters) + 1, pairs)]
            first = np.maximum(np.repeat(at[:-1], np.diff(at))[deep], deep - left)
            bucket = signed(state[np.searchsorted(where, deep)]) % buckets
            raw = Counter((b, tokens[i : j + 1].astype("<u8").tobytes()) for b, i, j in zip(bucket.tolist(), first.tolist(), deep.tolist(), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in raw], pa.int32()), pa.array([w for _, w in raw], pa.binary()), pa.array(list(raw.values()), pa.int64())], ["bucket", "window", "n"])

    return docs.mapInArrow(cut, "bucket int, window binary, n long").groupBy("bucket", "window").agg(F.sum("n").alias("n"))


def deeper_runs(docs: DataFrame, found, buckets: int) -> DataFrame:
    """Rows (context, up, n): runs one deeper than the filters, and with up = 0 the contexts themselves if longer than two words.

    What stands ``LEAST_COUNT`` times at least in all training texts; ``up`` is the key of the run without its first word;
    ``_entry`` makes the run's own key. They are summed by that key, so that a frequent context's runs go to many buckets.
    """

    def count(batches):
        held, size = [], 0

        def summed():
            return _summed_rows([np.concatenate(x) for x in zip(*held, strict=True)])

        def rows(columns):
            yield from _packed(buckets, columns[0], up=columns[1], n=columns[2].astype(np.uint32))

        for batch in cut_rows(batches):
            (contexts, times), (entry, up, entry_times) = _candidates(batch, *found.value)
            held.append([np.concatenate([contexts, entry]), np.concatenate([np.zeros(len(contexts), np.uint64), up]), np.concatenate([times, entry_times])])
            size += len(held[-1][0])
            if size > FLUSH_RUNS:
                held = [summed()]
                size = len(held[0][0])
                if size > FLUSH_RUNS // 2:
                    yield from rows(held[0])
                    held, size = [], 0
        if held:
            yield from rows(summed())

    def merge(key, table):
        keys, up, n = _unpacked(table, up=np.uint64, n=np.uint32)
        keys, up, n = _summed_rows([keys, up, n.astype(np.int64)])
        good = n >= LEAST_COUNT
        keys, up, n = keys[good], up[good], n[good]
        context = keys ^ ((up << np.uint64(17)) | (up >> np.uint64(47)))  # _entry undone
        return pa.table({"context": pa.array(signed(context)), "up": pa.array(signed(up)), "n": pa.array(n, pa.int64())})

    return docs.mapInArrow(count, "bucket int, keys binary, up binary, n binary").groupBy("bucket").applyInArrow(merge, "context long, up long, n long")


def word_contexts(counts: DataFrame) -> DataFrame:
    """Rows (context, total) of the contexts of a single word: a token stands after each word but the end."""

    def keyed(batches):
        for batch in batches:
            words = batch.column("word").to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(signed(mix64(words))), batch.column("n")], ["context", "total"])

    return counts.where(F.col("n") >= LEAST_COUNT).mapInArrow(keyed, "context long, total long")


def pair_contexts(runs: DataFrame, states) -> DataFrame:
    """Rows (context, total) of the contexts of two words, of the runs after a single one: for those that end with a state of the filter."""

    def keyed(batches):
        for batch in batches:
            first, last = _unmix64(batch.column("context").to_numpy().view(np.uint64)), mix64(batch.column("up").to_numpy().view(np.uint64))
            good = states.value.has(last)
            yield pa.RecordBatch.from_arrays([pa.array(signed(mix64(last[good] * _LONGER + first[good]))), batch.column("n").filter(pa.array(good))], ["context", "total"])

    return runs.select("context", "up", "n").mapInArrow(keyed, "context long, total long")


def _fertile(cost: float):
    """Whether a longer context of a state can be a state itself: no if the most that its divergence can gain stays within the cost of an entry.

    Each of its entries is one of the state's, met no more often, and the state gives it ``(n - DISCOUNT) / total`` at least.
    So N tokens gain ``N log(total / N)`` (at most total / e) at most, and ``each`` more by an entry; nor can an entry gain more
    than ``n`` times the logarithm of its probability here (``most``). What is left are words that it has met once:
    ``others`` of them at most, and the state leaves them ``mass`` at least.
    """
    each = LEAST_COUNT * float(np.log(LEAST_COUNT / (LEAST_COUNT - DISCOUNT)))
    if cost <= each:
        return F.lit(True)
    total = F.col("total")
    mass, others = F.col("rest") * (1 - F.col("below")), total - F.col("n") + F.col("size") - 1
    most = F.col("n") * F.log(total) - F.col("logs")
    return (mass < 1e-9) | (F.least(total / float(np.e) + each, most) - others * F.log(mass) > cost - 1e-6)


def _may_grow(total, n, size, rest, left_below, logs, cost: float) -> np.ndarray:
    """As ``_fertile``."""
    each = LEAST_COUNT * float(np.log(LEAST_COUNT / (LEAST_COUNT - DISCOUNT)))
    if cost <= each:
        return np.ones(len(total), bool)
    mass, others = rest * left_below, total - n + size - 1
    gain = np.minimum(total / np.e + each, n * np.log(total) - logs) - others * np.log(np.maximum(mass, 1e-9))
    return (mass < 1e-9) | (gain > cost - 1e-6)


DEEP = "depth int, bucket int, state boolean, key long, value double, n long, fertile boolean, p double"


def subtrees(few: DataFrame, entries: DataFrame, depth: int, reach: int, buckets: int, cost: float) -> DataFrame:
    """Rows (depth, the state's bucket, state or entry, key, value, n, fertile, p) of all states and entries below those of a depth, down to ``reach``.

    ``few``: windows; ``entries``: (bucket, key, p) of that depth. What is below a state concerns its own windows and
    entries alone, so each bucket of states grows by itself, with the rules of ``grow``.
    """

    def build(key, windows, known):
        tokens, at, where, times = _source(windows)
        context, entry = np.zeros(len(where), np.uint64), tokens[where]
        place, n = np.diff(at) - 1, times[where]
        met, chance = known.column("key").to_numpy().view(np.uint64), known.column("p").to_numpy()
        out = []
        for k in range(1, reach + 1):
            good = place >= k
            where, place, n, context, up = where[good], place[good], n[good], context[good], entry[good]
            context = mix64(context * _LONGER + tokens[where - k])
            entry = _run(context, up)
            if k <= depth:
                continue
            order = np.argsort(met)
            met, chance = met[order], chance[order]
            spot = np.minimum(np.searchsorted(met, up), max(len(met) - 1, 0))
            known_up = met[spot] == up if len(met) else np.zeros(len(up), bool)
            contexts, totals = _summed(context, n)
            runs, of, below, m = _summed_rows([entry[known_up], context[known_up], chance[spot[known_up]], n[known_up]])
            often = m >= LEAST_COUNT
            runs, of, below, m = runs[often], of[often], below[often], m[often]
            order = np.argsort(of)
            runs, of, below, m = runs[order], of[order], below[order], m[order]
            first = np.flatnonzero(first_of_each(of))
            if not len(first):
                break
            add = lambda x: np.add.reduceat(x, first)  # noqa: B023, E731
            total = totals[np.searchsorted(contexts, of[first])]
            size, seen, mass = np.diff(first, append=len(of)), add(m), 1 - add(below)
            left = total - seen
            rest = 1 - (seen - DISCOUNT * size) / total
            gain = add(m * np.log(m / below)) - seen * np.log(total)
            some = (left > 0) & (mass > 0)
            gain[some] += left[some] * np.log(left[some] / total[some] / mass[some])
            is_state = gain > size * cost
            fertile = is_state & _may_grow(total, seen, size, rest, mass, add(m * np.log(m - DISCOUNT)), cost)
            row = np.repeat(np.arange(len(first)), size)
            here = is_state[row]
            passed = rest[row] * below
            p = (m - DISCOUNT) / total[row] + passed
            keys = np.concatenate([of[first][is_state], runs[here]])
            values = np.concatenate([np.log10(rest[is_state]), np.log10(p[here] / passed[here])])
            out.append((np.full(len(keys), k, np.int32), (signed(np.concatenate([of[first][is_state], of[here]])) % buckets).astype(np.int32), np.arange(len(keys)) < is_state.sum(), keys, values, np.concatenate([total[is_state], m[here]]), np.concatenate([fertile[is_state], fertile[row][here]]), np.concatenate([np.zeros(is_state.sum()), p[here]])))
            met, chance = runs[fertile[row]], p[fertile[row]]
            good = np.isin(context, of[first][fertile])
            where, place, n, context, entry = where[good], place[good], n[good], context[good], entry[good]
        kinds = (np.int32, np.int32, bool, np.uint64, float, np.int64, bool, float)
        columns = [np.concatenate([np.zeros(0, kind), *x]) for kind, x in zip(kinds, zip(*out, strict=True) if out else [()] * len(kinds), strict=True)]
        columns[3] = signed(columns[3])
        return pa.Table.from_arrays([pa.array(x) for x in columns], ["depth", "bucket", "state", "key", "value", "n", "fertile", "p"])

    return few.groupBy("bucket").cogroup(entries.groupBy("bucket")).applyInArrow(build, DEEP)


def grow(docs: DataFrame, counts: DataFrame, total: int, vocabulary: int, buckets: int) -> tuple[list[DataFrame], list[Filter]]:
    """The tree: for each depth rows (key, value, n) of its states and entries, and the filter of its states.

    ``value`` is what a token's logarithm gains after the state, or by the entry.
    """
    sc = docs.sparkSession.sparkContext
    below = counts.select(F.col("word").alias("up"), ((F.col("n") + F.lit(ALPHA)) / F.lit(total + ALPHA * (vocabulary + 1))).alias("below"))
    cost = 0.5 * float(np.log(max(2, total)))
    tables, filters = [], []
    fertile, met, pairs = [], None, None  # filters of the states that may have longer ones, of their entries, of pairs of words
    few, reach = None, 0  # once there are few tokens to look at: windows of the texts, and up to which depth they tell all
    while True:
        depth = len(fertile)
        known = sc.broadcast((list(fertile), met, pairs))
        if few is not None and (depth >= reach or largest <= LOCAL):
            release(few)
            few = None
        if few is None and depth and concerned * FEW < total:
            reach = depth + WINDOW
            few = staged(windows(docs, known, reach, buckets), "windows")
        if few is not None and largest <= LOCAL:
            release(*([pair_totals] if depth == 1 else []))
            deep = staged(subtrees(few, entries.select("bucket", "key", "p"), depth, reach, buckets, cost), "subtrees")
            release(few)
            few, states = None, deep.where("state")
            beyond = states.where(F.col("fertile") & (F.col("depth") == reach))
            size, deepest = states.agg(F.count(F.lit(1)), F.max("depth")).first()
            if size:
                tables.append(deep.select("key", "value", "n"))
                filters.append(_filter(_packed_keys(states, buckets), size, buckets))
                filters[-1].depths = deepest - depth
            concerned, largest = beyond.agg(F.coalesce(F.sum("n"), F.lit(0)), F.max("n")).first()
            if concerned:
                fertile += [_filter(_packed_keys(states.where("fertile"), buckets), size, buckets)] * WINDOW
            entries = deep.where(~F.col("state") & F.col("fertile") & (F.col("depth") == reach))
        else:
            found = staged(deeper_runs(docs if few is None else few, known, buckets), "runs")
            runs = staged(found.where("up <> 0").join(below, "up"), "below")
            n, total_n, left, left_below = F.col("n"), F.col("total"), F.col("total") - F.col("n"), 1 - F.col("below")
            sums = runs.groupBy("context").agg(
                F.count(F.lit(1)).alias("size"), F.sum(F.col("n") * F.log(F.col("n") / F.col("below"))).alias("gain"), F.sum(F.col("n") * F.log(F.col("n") - DISCOUNT)).alias("logs"), F.sum("n").alias("n"), F.sum("below").alias("below")
            )
            totals = word_contexts(counts) if not depth else pair_totals if depth == 1 else found.where("up = 0").select("context", F.col("n").alias("total"))
            sums = sums.join(totals, "context")
            gain = F.col("gain") - n * F.log(total_n) + F.when((left > 0) & (left_below > 0), left * F.log(left / total_n / left_below)).otherwise(0.0)
            rest = 1 - (n - F.lit(DISCOUNT) * F.col("size")) / total_n
            states = sums.where(gain > F.col("size") * F.lit(cost)).withColumn("rest", rest)
            states = staged(states.select("context", "total", "rest", _fertile(cost).alias("fertile")), "states")
            own = F.when(F.col("fertile"), F.col("total"))
            size, some, concerned, largest = states.agg(F.count(F.lit(1)), F.count(own), F.coalesce(F.sum(own), F.lit(0)), F.max(own)).first()
            if size:
                passed = F.col("rest") * F.col("below")
                p = (F.col("n") - F.lit(DISCOUNT)) / F.col("total") + passed
                bucket = F.when(F.col("fertile"), F.pmod(F.col("context"), F.lit(buckets)).cast("int"))  # null: no deeper states
                entries = staged(runs.join(states, "context").select(_entry(F.col("context"), F.col("up")).alias("key"), "n", p.alias("p"), F.log10(p / passed).alias("value"), bucket.alias("bucket")), "entries")
                tables.append(states.select(F.col("context").alias("key"), F.log10("rest").alias("value"), F.col("total").alias("n")).unionByName(entries.select("key", "value", "n")))
                filters.append(_filter(_packed_keys(states.select(F.col("context").alias("key")), buckets), size, buckets))
                entries = entries.where("bucket is not null")
            if concerned and pairs is None:
                pairs = _filter(_packed_keys(runs.select(_entry(F.col("context"), F.col("up")).alias("key")), buckets), runs.count(), buckets)
            if concerned:
                fertile.append(_filter(_packed_keys(states.where("fertile").select(F.col("context").alias("key")), buckets), some, buckets))
            if concerned and not depth:
                ends = sc.broadcast(fertile[0])
                pair_totals = staged(pair_contexts(runs, ends), "pairs")
                ends.destroy()
            release(found, runs, *([] if size else [states]), *([pair_totals] if depth == 1 else []))
        known.destroy()
        known = None  # a destroyed broadcast still holds its value here
        if not concerned:
            release(*([] if few is None else [few]))
            return tables, filters
        met = _filter(_packed_keys(entries, buckets), entries.count(), buckets)
        below = entries.select(F.col("key").alias("up"), F.col("p").alias("below"))


# --- scoring -----------------------------------------------------------------

LOT_BITS = 2  # first bits of a key that name its lot: what is joined is dealt lot by lot, as all of it would fill the disk
SCORED = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double" + "".join(f", rare{lot} array<long>, times{lot} array<int>" for lot in range(1 << LOT_BITS))


class Model:
    """The frequent part of words and tree, and filters of the states and of what is not here."""

    def __init__(self, frequent: Frequent, norm: float, keys: np.ndarray, values: np.ndarray, filters: list[Filter], others: Filter):
        order = np.argsort(keys)
        self.frequent, self.keys, self.values, self.filters, self.others = frequent, keys[order], values[order], filters, others
        self.places = Places(self.keys)
        self.logs, self.unseen = np.log10((frequent.counts + ALPHA) / norm), np.log10(ALPHA / norm)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of keys, 0 for others, and which keys the joined part may have."""
        if not len(self.keys):
            return np.zeros(len(keys)), self.others.has(keys)
        at, here = self.places.find(keys)
        return np.where(here, self.values[at], 0.0), ~here & self.others.has(keys)


def _scored(docs: DataFrame, model) -> DataFrame:
    """Rows with the part of the scores that the broadcast makes, and the keys that are to be joined with their times."""

    def run(batches):
        known, serial = model.value, TaskContext.get().partitionId() << 33
        for batch in cut_rows(batches):
            tokens, at = _tokens(batch)
            numbers = known.frequent.numbers(tokens)
            seen = numbers >= 0
            # other words count as unseen; the join adds what their counts change
            root = np.where(seen, known.logs[np.where(seen, numbers, 0)], known.unseen) if len(known.logs) else np.full(len(tokens), known.unseen)
            p, row = root.copy(), np.repeat(np.arange(batch.num_rows), np.diff(at))
            keys, rows = [tokens[~seen]], [row[~seen]]
            filters = [f for f in known.filters for _ in range(f.depths)]
            for _, (where, context, entry, _) in zip(filters, _deeper(tokens, at, filters), strict=False):
                if not len(where):
                    break
                for key in (context, entry):
                    value, open_ = known.find(key)
                    p[where] += value
                    keys.append(key[open_])
                    rows.append(row[where[open_]])
            key, of = np.concatenate(keys), np.concatenate(rows)
            order = np.argsort(key)
            order = order[np.argsort(of[order].astype(np.uint16 if batch.num_rows < 1 << 16 else np.int64), kind="stable")]
            key, of = key[order], of[order]
            first = np.flatnonzero(first_of_each(key) | first_of_each(of))
            times, key, of = np.diff(first, append=len(key)), key[first], of[first]
            lists = {}
            for lot in range(1 << LOT_BITS):
                own = key >> np.uint64(64 - LOT_BITS) == lot
                offsets = pa.array(np.searchsorted(of[own], np.arange(batch.num_rows + 1)), pa.int32())
                lists[f"rare{lot}"] = pa.ListArray.from_arrays(offsets, pa.array(signed(key[own]), pa.int64()))
                lists[f"times{lot}"] = pa.ListArray.from_arrays(offsets, pa.array(times[own], pa.int32()))
            docs_in, n_rows = batch.column("doc_id").to_pylist(), batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(serial + np.arange(n_rows)),
                    pa.array(docs_in, pa.int64()),
                    pa.array([held_out(d) for d in docs_in], pa.bool_()),
                    pa.array(np.diff(at)),
                    pa.array(np.add.reduceat(seen, at[:-1], dtype=np.int64) if n_rows else np.zeros(0, np.int64)),
                    pa.array(_row_sums(root, at)),
                    pa.array(_row_sums(p, at)),
                    *lists.values(),
                ],
                ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", *lists],
            )
            serial += n_rows

    return docs.mapInArrow(run, SCORED)


def _row_sums(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x, at[:-1]) if len(at) > 1 else np.zeros(0)


def score_texts(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one for each row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    buckets = max(16, 4 * docs.rdd.getNumPartitions())
    counts = staged(word_counts(docs, buckets), "word-counts")
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, vocabulary = int(totals["n"]), int(totals["v"])
    norm = total + ALPHA * (vocabulary + 1)
    tables, filters = grow(docs, counts, total, vocabulary, buckets)

    least = F.lit(SHARED * total)
    top = counts.where(F.col("n") >= least).toArrow()  # 1 / SHARED rows at most
    frequent = Frequent(top.column("word").to_numpy().view(np.uint64), top.column("n").to_numpy().astype(np.int64), total)
    shared = [t.where(F.col("n") >= least).select("key", "value").toArrow() for t in tables]  # 1 / SHARED states and as many entries of a depth at most
    keys = np.concatenate([np.zeros(0, np.uint64), *[t.column("key").to_numpy().view(np.uint64) for t in shared]])
    values = np.concatenate([np.zeros(0), *[t.column("value").to_numpy() for t in shared]])
    others = counts.where(F.col("n") < least).select(F.col("word").alias("key"), F.log10((F.col("n") + F.lit(ALPHA)) / F.lit(ALPHA)).alias("value"), F.lit(1).alias("word"))
    rest = counts.select(F.col("word").alias("key"), F.lit(0.0).alias("value")).limit(0)
    for t in tables:
        rest = rest.unionByName(t.where(F.col("n") < least).select("key", "value"))
    model = Model(frequent, norm, keys, values, filters, _filter(_packed_keys(rest, buckets), rest.count(), buckets))
    shared_model = spark.sparkContext.broadcast(model)
    rows = staged(_scored(docs, shared_model), "scored")
    shared_model.destroy()

    held = others.unionByName(rest.withColumn("word", F.lit(0)))
    extra = None
    for lot in range(1 << LOT_BITS):
        asked = rows.select("row", F.explode(F.arrays_zip(F.col(f"rare{lot}").alias("rare"), F.col(f"times{lot}").alias("times"))).alias("x")).select("row", F.col("x.rare").alias("key"), F.col("x.times").alias("m"))
        met = asked.join(held.where(F.shiftrightunsigned("key", 64 - LOT_BITS) == lot), "key")
        own = met.groupBy("row").agg(F.sum(F.col("m") * F.col("value")).alias("more"), F.sum(F.col("m") * F.col("value") * F.col("word")).alias("base_more"), F.sum(F.col("m") * F.col("word")).alias("also"))
        own = staged(own, "lot")
        extra = own if extra is None else extra.unionByName(own)
    extra = extra.groupBy("row").agg(*[F.sum(c).alias(c) for c in ("more", "base_more", "also")])
    return rows.select("row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score").join(extra, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("also", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base_more", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"),
    )
