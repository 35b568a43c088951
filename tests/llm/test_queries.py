"""Each registered query against its plain version: driver tables, edge cases, empty tables."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pytest

from tests.llm import brute
from tests.llm.conftest import read

SF = "/root/testdata/sf0.001"
KEYED = ("op1", "op2", "op3", "op4", "op5", "op6", "op7", "op8", "op9", "op10", "op11", "op12", "op13")


def query(name):
    from clickpulse.llm.queries import QUERIES

    return next(f for q, f in QUERIES.items() if q.startswith(name + "_"))


def collected(spark, name, folder, *order):
    rows = [r.asDict() for r in query(name)(spark, folder).collect()]
    return sorted(rows, key=lambda r: [(r[c] is None, r[c]) for c in order])


def by_id(rows):
    return sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"] or ""))


@pytest.fixture(params=["sf", "edge"])
def folder(request, edge_dir):
    return SF if request.param == "sf" else edge_dir


@pytest.mark.parametrize("name", KEYED)
def test_empty_tables(spark, empty_dir, name):
    assert query(name)(spark, empty_dir).collect() == []


def library(name):
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


def sentencepiece_model():
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def test_op1_language(spark, folder):
    docs, rows = by_id(read(folder, "documents")), collected(spark, "op1", folder, "doc_id")
    assert [r["doc_id"] for r in rows] == [d["doc_id"] for d in docs]
    for d, r in zip(docs, rows, strict=True):
        assert 0 < r["posterior"] <= 1 + 1e-9
        if not any(c.isalpha() for c in d["text"] or ""):
            assert not r["kept"]
    if folder == SF:
        right = [r["language"] == d["lang"] for d, r in zip(docs, rows, strict=True)]
        assert sum(right) >= 0.97 * len(right) and sum(r["kept"] for r in rows) >= 0.97 * len(rows)


def test_op2_packing(spark, folder):
    tokenizer = library("byte_bpe_50k.json")
    rows = collected(spark, "op2", folder, "sequence_id", "offset")
    docs = read(folder, "documents")
    want = sorted(([d["doc_id"] if d["doc_id"] is not None else -1, tokenizer.encode(d["text"] or "", add_special_tokens=False).ids + [1]] for d in docs))
    pieces: dict = {}
    for r in rows:
        pieces.setdefault(r["doc_id"] if r["doc_id"] is not None else -1, []).append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    for doc, ids in want:
        expected = [(a, len(ids[a : a + 2048]), zlib.crc32(brute.ids_bytes(ids[a : a + 2048])), len(ids)) for a in range(0, len(ids), 2048)]
        for e in expected:
            pieces[doc].remove(e)
    assert not any(pieces.values())
    sequences: dict = {}
    for r in rows:
        assert r["offset"] == sequences.get(r["sequence_id"], 0)
        sequences[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(sequences.values()) <= 2048
    if folder == SF:
        total = sum(sequences.values())
        assert len(sequences) <= math.ceil(total / 2048 * 1.02) + 1


def test_op3_components(spark, folder):
    docs = by_id(read(folder, "documents"))
    want = sorted((d["doc_id"] is None, d["doc_id"] or 0, *w) for d, w in zip(docs, brute.jaccard_components(docs, 3, 90, 100), strict=True) if d["doc_id"] is not None)
    rows = collected(spark, "op3", folder, "doc_id")
    assert sorted((False, r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] is not None) == want
    assert len(rows) == len(docs) and all(r["component_id"] is None for r in rows if r["doc_id"] is None)


def test_op4_spans(spark, folder):
    docs, rows = by_id(read(folder, "documents")), collected(spark, "op4", folder, "doc_id")
    want = brute.without_repeats([(d["doc_id"], d["text"]) for d in docs], 20)
    key = lambda x: (x[0] is None, x[0] or 0, x[1] or "", x[2])
    assert sorted(((r["doc_id"], r["text"], r["dropped_sentences"]) for r in rows), key=key) == sorted(((d["doc_id"], *w) for d, w in zip(docs, want, strict=True)), key=key)
    assert any(n for _, n in want)


def test_op5_scores(spark, folder):
    docs = by_id(read(folder, "documents"))
    rows = collected(spark, "op5", folder, "doc_id", "n_tokens")
    want = sorted((d["doc_id"] is None, d["doc_id"] or 0, *w) for d, w in zip(docs, brute.unigram_scores(docs), strict=True))
    for r, (no_id, doc, held, n, known, total, base) in zip(rows, want, strict=True):
        assert (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (None if no_id else doc, held, n, known, total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9, abs_tol=1e-9) and math.isfinite(r["score"])
    if folder == SF:
        out = [r for r in rows if r["held_out"]]
        assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def usable(folder):
    rows = [r for r in read(folder, "embeddings") if r["vec_id"] is not None and r["embedding"] and all(x is not None and math.isfinite(x) for x in r["embedding"]) and any(r["embedding"])]
    most = max((len(r["embedding"]) for r in rows), default=0)
    return [(r["vec_id"], np.array(r["embedding"], np.float64)) for r in rows if len(r["embedding"]) == most]


def test_op6_neighbours(spark, folder):
    vectors, rows = usable(folder), collected(spark, "op6", folder, "query_id", "rank")
    found, hits, asked = {}, 0, 0
    for r in rows:
        found.setdefault(r["query_id"], []).append(r)
    for q, v in {i: x for i, x in vectors if i % 100 == 0}.items():
        near = sorted({(math.sqrt(((x - v) ** 2).sum()), i) for i, x in vectors if i != q})[:10]
        got = found.get(q, [])
        assert [r["rank"] for r in got] == list(range(1, len(near) + 1))
        assert [(r["score"], r["vec_id"]) for r in got] == sorted((r["score"], r["vec_id"]) for r in got)
        for r in got:
            x = next(x for i, x in vectors if i == r["vec_id"])
            assert math.isclose(r["score"], math.sqrt(((x - v) ** 2).sum()), rel_tol=1e-12, abs_tol=1e-12)
        hits, asked = hits + len({i for _, i in near} & {r["vec_id"] for r in got}), asked + len(near)
    assert set(found) <= {i for i, _ in vectors if i % 100 == 0} and hits >= 0.9 * asked


def test_op7_counts(spark, folder):
    docs = by_id(read(folder, "documents"))
    rows = collected(spark, "op7", folder, "doc_id", "n_words")
    want = sorted((d["doc_id"] is None, d["doc_id"] or 0, *brute.quality_counts(d["text"])) for d in docs)
    for r, (no_id, doc, n, chars, symbols, lines, repeat) in zip(rows, want, strict=True):
        assert (r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (None if no_id else doc, n, chars, symbols, lines, repeat)
        assert r["base_failed"] == (n < 50 or 100 * repeat > 50 * n) and not (r["base_failed"] and r["kept"])


def test_op8_files(spark, folder):
    tokenizer = library("word_bpe_49k.json")
    docs = sorted(read(folder, "documents"), key=lambda d: (d["doc_id"] is not None, d["doc_id"] or 0))
    rows = collected(spark, "op8", folder, "start")
    start = 0
    for d, r in zip(docs, rows, strict=True):
        ids = tokenizer.encode(d["text"] or "", add_special_tokens=False).ids + [1]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (d["doc_id"], start, len(ids), zlib.crc32(brute.ids_bytes(ids)))
        start += len(ids)


def test_op9_counts(spark, folder):
    model = sentencepiece_model()
    docs, rows = by_id(read(folder, "documents")), collected(spark, "op9", folder, "doc_id")
    for d, r in zip(docs, rows, strict=True):
        n = len(model.encode(d["text"] or ""))
        assert (r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) == (d["doc_id"], len((d["text"] or "").encode()), n, n > 4096)


def test_op10_codec(spark, folder):
    model = sentencepiece_model()
    docs, rows = by_id(read(folder, "documents")), collected(spark, "op10", folder, "doc_id")
    for d, r in zip(docs, rows, strict=True):
        ids = [*model.encode(d["text"] or ""), 2]
        assert (r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (d["doc_id"], len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(model.decode(ids)))
