"""Operators 11 to 13: plain versions, exactness, held-out accuracy, edge cases."""

from __future__ import annotations

import hashlib
import json
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tests.llm.conftest import EDGE_TEXTS, read
from tests.llm.test_queries import SF, by_id, collected, folder, library, query, sentencepiece_model  # noqa: F401

# --- 11: factorisation machine -----------------------------------------------


def held(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 3 == 1


def test_op11_scores_every_row(spark, folder):  # noqa: F811
    docs, rows = by_id(read(folder, "documents")), collected(spark, "op11", folder, "doc_id")
    assert [r["doc_id"] for r in rows] == [d["doc_id"] for d in docs]
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) and r["held_out"] == held(r["doc_id"])


def test_op11_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in read(sf, "labels")}
    rows = [r for r in collected(spark, "op11", sf, "doc_id") if r["held_out"] and r["doc_id"] in labels]
    good = [r["score"] for r in rows if labels[r["doc_id"]]]
    bad = [r["score"] for r in rows if not labels[r["doc_id"]]]
    above = sum(g > b for g in good for b in bad) / (len(good) * len(bad))
    assert above >= 0.97
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in rows) >= 0.95 * len(rows)


def machine(seed=3):
    from clickpulse.llm.quality_fm import FEATURES, STATISTICS, Machine

    rng = np.random.default_rng(seed)
    out = Machine([np.unique(rng.normal(0, 3, 15)) for _ in STATISTICS])
    out.bias, out.weight = 0.3, rng.normal(0, 0.5, FEATURES).astype(np.float32)
    out.hidden = rng.normal(0, 0.5, out.hidden.shape).astype(np.float32)
    return out


def test_machine_equals_all_pairs():
    from clickpulse.llm.quality_fm import raw_features

    m = machine()
    batch = pa.RecordBatch.from_pydict({"text": pa.array([t and t[:400] for t in EDGE_TEXTS]), "n_chars": pa.array([float(i) if i % 3 else None for i in range(len(EDGE_TEXTS))])})
    feature, value, at = m.rows(*raw_features(batch))
    for r, raw in enumerate(m.raw(feature, value, at)):
        f, x = feature[at[r] : at[r + 1]], value[at[r] : at[r + 1]].astype(float)
        pairs = sum(float(m.hidden[f[i]].astype(float) @ m.hidden[f[j]].astype(float)) * x[i] * x[j] for i in range(len(f)) for j in range(i))
        assert np.isclose(raw, m.bias + float((m.weight[f] * x).sum()) + pairs, rtol=1e-4, atol=1e-4)


def test_machine_survives_packing():
    from clickpulse.llm.quality_fm import Machine, raw_features

    m = machine()
    again = Machine.unpack(m.pack())
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["a b | c", "", None])})
    assert np.array_equal(m.raw(*m.rows(*raw_features(batch))), again.raw(*again.rows(*raw_features(batch))))


def test_statistics_of_structure():
    from clickpulse.llm.quality_fm import STATISTICS, raw_features

    text = "Ab ab x\nAb ab x\n\nq#9 é."
    batch = pa.RecordBatch.from_pydict({"text": pa.array([text, ""]), "n_chars": pa.array([46.0, None])})
    buckets, values, at, statistics = raw_features(batch)
    s = dict(zip(STATISTICS, statistics[0], strict=True))
    assert s["words"] == 8 and s["declared_chars"] == 46 and s["declared_share"] == 46 / len(text)
    assert np.isclose(s["word_length"], len(text.encode()) / 8) and np.isclose(s["symbols"], 1 / len(text)) and np.isclose(s["digits"], 1 / len(text))
    assert np.isclose(s["lines"], 3 / 8) and np.isclose(s["repeated_lines"], 1 / 3)
    assert np.isclose(s["repeated_words"], 1 - 4 / 8) and np.isclose(s["commonest_word"], 4 / 8)  # ab x q#9 é.
    assert np.isclose((values**2).sum(), 1) and at.tolist() == [0, 4, 4]
    assert statistics[1][0] == 0 and np.isnan(statistics[1][-1])


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_op11_without_usable_labels(spark):
    from clickpulse.llm.quality_fm import score_quality

    docs = spark.createDataFrame([(0, "a"), (2, None), (None, "c")], "doc_id long, text string")
    one_kind = score_quality(docs, labels_of(spark, [(0, 1, 0), (2, 1, 0), (2, None, 0), (None, 0, 0)])).collect()
    assert len(one_kind) == 3 and {r["predicted"] for r in one_kind} == {1}
    none = score_quality(docs, labels_of(spark, [])).collect()
    assert {r["score"] for r in none} == {0.5}


def test_op11_learns_nothing_from_held_out_rows(spark):
    from clickpulse.llm.quality_fm import score_quality

    docs = spark.createDataFrame([(i, ("good words here " if i % 2 else "### $$$ ||| ") * (3 + i % 7)) for i in range(120)], "doc_id long, text string")
    true = [(i, i % 2, 0) for i in range(120)]
    turned = [(i, 1 - q if held(i) else q, 0) for i, q, _ in true]
    a, b = (sorted((r["doc_id"], r["score"]) for r in score_quality(docs, labels_of(spark, x)).collect()) for x in (true, turned))
    assert a == b and all((s >= 0.5) == bool(i % 2) for i, s in a)


def test_op11_sample_is_bounded_and_one_row_an_id(spark):
    from clickpulse.llm.quality_fm import _inputs, labelled_sample

    docs = spark.createDataFrame([(i % 50, f"text {i}") for i in range(400)], "doc_id long, text string")
    rows, share = labelled_sample(_inputs(docs), labels_of(spark, [(i, int(i % 5 > 0), 0) for i in range(50)] * 3), sample=4)
    found = rows.collect()
    assert Counter(r["good"] for r in found) == {True: 4, False: 4} and len({r["doc_id"] for r in found}) == 8 and 0.6 < share < 0.95


# --- 12: cross-tokenizer alignment -------------------------------------------


def token_lists(text):
    """Ids and bytes of both tokenizers' tokens, by the libraries on the whole text; nothing where bytes differ."""
    if not text:
        return None
    a_lib, sp = library("byte_bpe_50k.json"), sentencepiece_model()
    a_lib.encode_special_tokens = True
    names = {i: t for t, i in a_lib.get_vocab().items()}
    from clickpulse.llm.byte_bpe import byte_alphabet

    alphabet = byte_alphabet()
    a, b = a_lib.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
    raw_a = [bytes(alphabet[c] for c in names[i]) for i in a]
    raw_b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
    whole = (" " + text).encode()
    return (a, b, raw_a, raw_b) if b"".join(raw_a) == whole == b"".join(raw_b) else None


def plain_alignment(texts):
    out, counts, links_of = [], Counter(), []
    known = {}
    for text in texts:
        if text not in known:
            known[text] = token_lists(text)
        found = known[text]
        if found is None:
            out.append([0, 0, 0, 0, 0, 0, ""])
            links_of.append([])
            continue
        a, b, raw_a, raw_b = found
        ends_a, ends_b = np.cumsum([len(x) for x in raw_a]).tolist(), np.cumsum([len(x) for x in raw_b]).tolist()
        links, j = [], 0
        for i, end in enumerate(ends_a):
            start = end - len(raw_a[i])
            while j and ends_b[j - 1] > start:
                j -= 1
            while j < len(b) and ends_b[j] - len(raw_b[j]) < end:
                if ends_b[j] > start:
                    links.append((a[i], b[j]))
                j += 1
        groups, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            p, q = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
            i, j = p, q
        counts.update(links)
        links_of.append(links)
        out.append([len(a), len(b), len(groups), len(links), 0, 0, hashlib.sha256(";".join(groups).encode()).hexdigest()])
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    for row, links in zip(out, links_of, strict=True):
        row[4] = sum(counts[x] == most[x[1]] for x in links)
        row[5] = sum(counts[x] for x in links)
    return [tuple(r) for r in out]


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_op12_alignment(spark, folder):  # noqa: F811
    docs, rows = by_id(read(folder, "documents")), collected(spark, "op12", folder, "doc_id", "n_a")
    want = sorted((d["doc_id"] is None, d["doc_id"] or 0, w) for d, w in zip(docs, plain_alignment([d["text"] for d in docs]), strict=True))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, tuple(r[c] for c in COLUMNS)) for r in rows) == want


ODD_TEXTS = [" lead", "trail ", "a  b", "a \n b\t c", "x▁y", "café déjà", "你好 世界", "\U0001f600 ok", "\x00 nul", "<|endoftext|> <s> </s> <unk>", "a b 　 c", "é ﬁ", "a\x1c b \x1d", " ", "\n", "tab\t\tx", "it's we'll 12345", "İstanbul ǅ ͸ \U0001fae8", *EDGE_TEXTS]


def test_op12_odd_texts_and_rare_pairs_joined(spark):
    from clickpulse.llm.queries import vocabulary
    from clickpulse.llm.token_alignment import align_documents

    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD_TEXTS)], "doc_id long, text string, pair string")
    want = [(i, *w) for i, w in enumerate(plain_alignment(ODD_TEXTS))]
    for head in (3, 40, 1_000_000):  # nearly all pairs joined; some; none
        rows = align_documents(docs.repartition(3), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"), head=head).collect()
        assert sorted((r["doc_id"], *(r[c] for c in COLUMNS)) for r in rows) == want


def test_byte_bpe_equals_the_library():
    from clickpulse.llm.byte_bpe import ByteTokenizer
    from clickpulse.llm.queries import vocabulary

    texts = [t for t in pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist() if t] + [t for t in ODD_TEXTS if t]
    for plain in (True, False):
        own, lib = ByteTokenizer(vocabulary("byte_bpe_50k.json"), plain_special=plain), library("byte_bpe_50k.json")
        lib.encode_special_tokens = plain
        assert own.fast is not None and sum(map(own.sure, texts)) > 0.9 * len(texts) - len(ODD_TEXTS)
        assert own.encode(texts) == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    assert ByteTokenizer(vocabulary("word_bpe_49k.json")).fast is None


def test_latin_texts_leave_the_second_tokenizer_unread():
    from clickpulse.llm.byte_bpe import ByteTokenizer
    from clickpulse.llm.queries import vocabulary

    own, lib = ByteTokenizer(vocabulary("byte_bpe_50k.json"), plain_special=False), library("byte_bpe_50k.json")
    assert own.vocabulary == lib.get_vocab()
    ids = lambda t: lib.encode(t, add_special_tokens=False).ids
    assert own.encode(["Plain words, 12\n", ""]) == [ids("Plain words, 12\n"), []]
    assert "slow" not in vars(own)  # memory that a worker of the pipeline does not have to spare
    assert own.encode(["Ωmega", "plain"]) == [ids("Ωmega"), ids("plain")]
    assert "slow" in vars(own)


def test_table_of_chunks_is_bounded(monkeypatch):
    from clickpulse.llm import token_alignment as ta
    from clickpulse.llm.queries import vocabulary

    monkeypatch.setattr(ta, "KEEP_BYTES", 50_000)
    own = ta.Aligner(vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
    seen = []
    for i in range(40):
        batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([i], pa.int64()), "text": pa.array([" ".join(f"word{i}x{j}" for j in range(60))])})
        ta._document_rows(own, batch, 0)
        seen.append(own.held)
    assert max(seen) < 3 * 50_000 and len(own.table) < 40 * 60


# --- 13: clustering over a VA-file -------------------------------------------


def plain_k_means(rows, k=8, rounds=10, dims=64):
    kept = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) and abs(x) * 1024 <= 1 << 27 for x in v)]
    name = lambda i: (i is None, hashlib.sha256(f"3:{i}".encode()).hexdigest())
    centroids = [v for _, v in sorted(kept, key=lambda r: (*name(r[0]), r[1]))[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for j, vs in groups.items():
            centroids[j] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    placed = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = Counter()
    for _, j, s in placed:
        inertia[j] += s
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i is None, i or 0, j, s, inertia[j], sum(inertia.values()), sha[j]) for i, j, s in placed))


def clustered(spark, rows, **options):
    from clickpulse.llm.va_clustering import cluster

    table = spark.createDataFrame([(i, v, 1, "c") for i, v in rows], "vec_id long, embedding array<float>, cluster int, row string")
    found = cluster(table.repartition(3), **options).collect()
    return sorted((r["vec_id"] is None, r["vec_id"] or 0, r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in found)


def vectors(n=300, seed=1, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (8, 64))
    return [(i, (centres[i % 8] + rng.normal(0, spread, 64)).astype(np.float32).tolist()) for i in range(n)]


def test_op13_driver_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in read(SF, "embeddings")]
    got = collected(spark, "op13", SF, "vec_id")
    assert [(False, r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in got] == plain_k_means(rows)


@pytest.mark.parametrize(("bits", "fetch_rows"), [(1, 2_000_000), (4, 0), (8, 2_000_000)])
def test_op13_any_cells_and_either_fetch(spark, bits, fetch_rows):
    rows = vectors()
    assert clustered(spark, rows, bits=bits, fetch_rows=fetch_rows) == plain_k_means(rows)


def test_op13_edges(spark):
    one = [0.25] * 64
    rows = [(0, one), (0, one), (5, one), (5, [0.5] * 64), (None, [1.0] * 64), (7, None), (8, [1.0] * 63), (9, [float("nan")] * 64), (10, [None] + one[1:]), (11, [float("inf")] * 64), (12, [3e38] * 64), (13, [0.0] * 64), (14, [131072.0] * 64), (15, [-0.0004] * 64)]
    assert clustered(spark, rows) == plain_k_means(rows)
    few = [(1, one), (2, [0.0] * 64)]
    assert clustered(spark, few) == plain_k_means(few)


def test_cells_decide_most_vectors_alone():
    from clickpulse.llm.va_clustering import Cells, Centroids

    v = np.floor(1024 * np.array([x for _, x in vectors(400)], np.float64)).astype(np.int64)
    cells = Cells(v[::2], v.min(axis=0), v.max(axis=0), 6)
    now = Centroids(v[:8].copy(), cells)
    maybe = now.candidates(cells.of(v))
    nearest = ((v[:, None] - v[None, :8]) ** 2).sum(axis=2).argmin(axis=1)
    assert maybe[np.arange(len(v)), nearest].all() and (maybe.sum(axis=1) == 1).mean() > 0.5
    assert np.array_equal(now.assign(cells.of(v), v), nearest)


def test_op13_reads_cells_alone_before_it_fetches(spark):
    """The pass that looks for vectors to fetch reads the cells and not the vectors."""
    from clickpulse.llm.va_clustering import usable, va_file

    table = spark.createDataFrame(vectors(50), "vec_id long, embedding array<float>")
    full, cells = va_file(usable(table, 64, 1024), 64, 8)
    plan = full.select("row", "cells")._jdf.queryExecution().executedPlan().toString()
    assert cells is not None and "ReadSchema: struct<row:bigint,cells:binary>" in plan


def test_op13_sql_equals_query(spark):
    import duckdb

    from clickpulse.llm.sql import SQL

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    found = con.execute(SQL["op13_va_file_clustering"])
    names = [c[0] for c in found.description]
    want = sorted((tuple(r[names.index(c)] for c in ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")) for r in found.fetchall()))
    got = [tuple(r[c] for c in ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")) for r in collected(spark, "op13", SF, "vec_id")]
    assert got == want


def test_json_roundtrip_of_results(spark, tmp_path):
    """Results keep their declared types through a write."""
    kinds = {"op11": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}, "op12": {c: "bigint" for c in ("doc_id", *COLUMNS[:-1])} | {"groups_sha256": "string"}, "op13": {"vec_id": "bigint", "cluster": "int", "distance": "bigint", "cluster_inertia": "bigint", "inertia": "bigint", "centroid_sha256": "string"}}
    for name, want in kinds.items():
        assert json.loads(json.dumps(dict(query(name)(spark, SF).dtypes))) == want
