"""Encoding and decoding with a SentencePiece model of merge type, as digests or as ids.

Method: Aho-Corasick longest matches, compatibility of adjacent tokens checked
by merging them again, and a bitfield of failed positions (``piece_bpe``).

Null text counts as empty; an empty text has the end id alone. Repeated rows
stay repeated. Columns other than the two named take no part.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import cut_rows, ship, texts
from clickpulse.llm.piece_bpe import MARK, piece_model


def encode_pieces(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, ids array<int> with the end id) of every row of ``docs``."""
    ship(docs.sparkSession)

    def run(batches):
        model = piece_model(model_path)
        look = model.kept(model.encode_ids)
        for batch in cut_rows(batches):
            ids = [[i for found in look(model.units(model.normalize(t))) for i in found] + [model.end] for t in texts(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(ids, pa.list_(pa.int32()))], ["id", "ids"])

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>").withColumnRenamed("id", id_col)


def decode_pieces(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Rows (id, text) of encoded rows; null ids give the empty text."""
    ship(encoded.sparkSession)

    def run(batches):
        model = piece_model(model_path)
        for batch in cut_rows(batches):
            text = [model.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(text, pa.string())], ["id", "text"])

    rows = encoded.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{ids_col}`").alias("ids"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, text string").withColumnRenamed("id", id_col)


def encode_digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_tokens, ids_sha256, decoded_sha256) of every row of ``docs``.

    What ``encode_pieces`` and ``decode_pieces`` give, digested where it is
    made: the ids as decimal numbers joined by one space, and the decoded text.
    """
    ship(docs.sparkSession)

    def run(batches):
        model = piece_model(model_path)

        def digest(unit: str) -> tuple[int, bytes, bytes]:
            if len(parts := model.parts(unit)) > 1:
                made = look(parts)
                return sum([m[0] for m in made]), b"".join([m[1] for m in made]), b"".join([m[2] for m in made])
            ids = model.encode_ids(unit)
            # a unit's byte pieces are whole characters, so units decode one by one
            text = model.decode(ids)
            if unit.startswith(MARK):
                text = " " + text
            return len(ids), b"".join([numbers[i] for i in ids]), text.encode()

        numbers = [f"{i} ".encode() for i in range(model.size)]
        look, end = model.kept(digest), str(model.end).encode()
        for batch in cut_rows(batches):
            out: tuple[list, list, list] = ([], [], [])
            for text in texts(batch, "text"):
                found = look(model.units(model.normalize(text)))
                decoded = b"".join([f[2] for f in found])
                out[0].append(sum([f[0] for f in found]) + 1)
                out[1].append(hashlib.sha256(b"".join([f[1] for f in found]) + end).hexdigest())
                out[2].append(hashlib.sha256(decoded[1:] if decoded[:1] == b" " else decoded).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(out[0], pa.int64()), pa.array(out[1]), pa.array(out[2])],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
