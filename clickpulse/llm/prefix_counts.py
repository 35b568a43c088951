"""Exact token counts of every prefix of a text, for truncation and budgets.

Method: dynamic programming over prefixes. For each prefix the last token is
the one piece that fits the last token of what precedes it, so the prefix's
count is that one's plus one. The store keeps, for each character, by how much
the count changes; a question about a cut or a budget is a running sum over it,
without encoding again.

Null text counts as empty: no tokens. Repeated rows stay repeated. Columns
other than the two named take no part.
"""

from __future__ import annotations

import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import cut_rows, ship, spread, texts
from clickpulse.llm.piece_bpe import piece_model

SLICE = 8 << 20  # bytes of texts that are cut and counted together
KEEP_UNITS = 600_000  # in a worker's table before it is emptied
STORE = "n_bytes long, n_tokens long, n_chars long, deltas binary"


def pack_deltas(deltas: bytes) -> bytes:
    return zlib.compress(deltas, 1)


def prefix_tokens(deltas: bytes) -> np.ndarray:
    """Counts of the prefixes of 0, 1, 2, ... characters of the normalized text."""
    steps = np.frombuffer(zlib.decompress(deltas), dtype="<i2")
    return np.concatenate([[0], np.cumsum(steps, dtype=np.int64)])


def tokens_of_prefix(deltas: bytes, n_chars: int) -> int:
    """Tokens of the first ``n_chars`` characters (of the whole text, if it is shorter)."""
    counts = prefix_tokens(deltas)
    return int(counts[min(n_chars, len(counts) - 1)])


def longest_within(deltas: bytes, budget: int) -> int:
    """Characters of the longest prefix of at most ``budget`` tokens."""
    return int(np.flatnonzero(prefix_tokens(deltas) <= budget)[-1])


def prefix_store(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_bytes, n_tokens, n_chars, deltas) of every row of ``docs``.

    ``n_chars``: characters of the normalized text. ``deltas`` holds the change
    of the count for each of them (16-bit numbers, deflated; a change that does
    not fit raises an error); the functions above read it.
    """
    ship(docs.sparkSession)

    def run(batches):
        model = piece_model(model_path)

        table: dict[str, bytes] = {}
        held = 0
        for batch in cut_rows(batches, SLICE):
            own = texts(batch, "text")
            units, at = model.fine_units([model.normalize(t) for t in own])
            coded = units.dictionary_encode()
            distinct = coded.dictionary.to_pylist()
            fresh = sorted(u for u in distinct if u not in table)
            for lo in range(0, len(fresh), 4096):
                part = fresh[lo : lo + 4096]
                table.update((u, array("h", s).tobytes()) for u, s in zip(part, model.prefix_steps(part), strict=True))
                held += sum(map(len, part))
            steps, cuts = spread([table[u] for u in distinct], "<i2", coded.indices.to_numpy(), at)
            sums = np.concatenate([[0], np.cumsum(steps, dtype=np.int64)])
            sizes = [len(t.encode()) for t in own]
            tokens, chars = sums[cuts[1:]] - sums[cuts[:-1]], np.diff(cuts)
            deltas = [pack_deltas(steps[a:b].tobytes()) for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False)]
            if len(table) > KEEP_UNITS or held > 16 * KEEP_UNITS:
                table.clear()
                held = 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array(chars, pa.int64()), pa.array(deltas, pa.binary())],
                ["id", "n_bytes", "n_tokens", "n_chars", "deltas"],
            )

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, {STORE}").withColumnRenamed("id", id_col)


def budget_answers(store: DataFrame, limit: int, id_col: str = "doc_id") -> DataFrame:
    """Rows (id, n_bytes, n_tokens, over_limit, fit_chars) from a store.

    ``fit_chars``: characters of the longest prefix (of the normalized text)
    of at most ``limit`` tokens.
    """
    ship(store.sparkSession)

    def run(batches):
        for batch in cut_rows(batches):
            tokens, fit = batch.column("n_tokens").to_numpy(), batch.column("n_chars").to_numpy().copy()
            # a count can fall with a further character, but a text of at most the limit fits as a whole
            for row in np.flatnonzero(tokens > limit):
                fit[row] = longest_within(batch.column("deltas")[int(row)].as_py(), limit)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_bytes"), batch.column("n_tokens"), pa.array(tokens > limit), pa.array(fit, pa.int64())],
                ["id", "n_bytes", "n_tokens", "over_limit", "fit_chars"],
            )

    rows = store.select(F.col(f"`{id_col}`").alias("id"), "n_bytes", "n_tokens", "n_chars", "deltas")
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean, fit_chars long").withColumnRenamed("id", id_col)
