"""The operators' own interfaces: invariants, round trips, brute force on random input."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import brute

SF = "/root/testdata/sf0.001"


def vocabulary(name):
    from clickpulse.llm.queries import vocabulary as found

    return found(name)


# --- words and windows ---------------------------------------------------------


@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbé \t\n", max_size=30)), max_size=8), st.integers(0, 3))
@settings(max_examples=80, deadline=None)
def test_word_and_window_hashes(texts, skip):
    from clickpulse.llm.common import window_hashes, word_hashes

    column = pa.array(texts, pa.string()).slice(skip)
    words, at = word_hashes(column)
    plain = [brute.WORD.findall((t or "").translate(brute.LOWER)) for t in texts[skip:]]
    assert np.diff(at).tolist() == [len(p) for p in plain]
    names: dict = {}
    for word, h in zip([w for p in plain for w in p], words.tolist(), strict=True):
        assert names.setdefault(word, h) == h
    assert len(set(names.values())) == len(names)
    runs, cuts = window_hashes(words, at, 3)
    for i, p in enumerate(plain):
        own = [tuple(p[j : j + 3]) for j in range(len(p) - 2)] or ([tuple(p)] if p else [])
        assert cuts[i + 1] - cuts[i] == len(own)
        for key, h in zip(own, runs[cuts[i] : cuts[i + 1]].tolist(), strict=True):
            assert names.setdefault(key, h) == h


# --- packing ---------------------------------------------------------------------


@given(st.lists(st.integers(1, 50), max_size=60))
@settings(max_examples=100, deadline=None)
def test_best_fit_decreasing(lengths):
    from clickpulse.llm.packing import best_fit_decreasing

    lengths = sorted(lengths, reverse=True)
    window, offset = best_fit_decreasing(lengths, 50)
    rooms: list[int] = []
    for size, w, o in zip(lengths, window.tolist(), offset.tolist(), strict=True):
        fits = [r for r in rooms if r >= size]
        room = rooms[w] if w < len(rooms) else 50
        assert room == (min(fits) if fits else 50) and (w < len(rooms)) == bool(fits)
        assert o == 50 - room
        rooms[w : w + 1] = [room - size]


def test_packing_shards_are_whole(spark):
    from clickpulse.llm.packing import pack

    rows = [(i, 0, 1 + (i * 7919) % 99, i) for i in range(500)] + [(i, 0, 100, i) for i in range(500, 520)]
    pieces = spark.createDataFrame(rows, "doc_id long, start long, length long, shard0 long").repartition(3)
    placed = pack(pieces, 100, shard_pieces=60).collect()
    assert sorted(r["doc_id"] for r in placed) == list(range(520))
    used: dict = {}
    for r in sorted(placed, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == used.get(r["sequence_id"], 0)
        used[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(used.values()) <= 100


# --- token files -----------------------------------------------------------------


def test_null_ids_are_dealt_to_many_shards(spark):
    """Rests of one id do not meet in one group; nothing is lost."""
    from pyspark.sql import functions as F

    from clickpulse.llm.packing import pack

    rests = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("start"), F.lit(3).cast("long").alias("length"))
    placed = pack(rests, 10, shard_pieces=1000).collect()
    shards = {}
    for r in placed:
        shards[r["sequence_id"] >> 34] = shards.get(r["sequence_id"] >> 34, 0) + 1
    assert len(placed) == 4000 and len(shards) == 4 and max(shards.values()) < 1300


@given(st.integers(1, 5000), st.integers(1, 300), st.randoms(use_true_random=False))
@settings(max_examples=40, deadline=None)
def test_rans_round_trip_and_ranges(n, symbols, rng):
    from clickpulse.llm.rans import Segment, encode_segment

    ids = np.array([min(rng.randrange(symbols), rng.randrange(symbols)) * 151 for _ in range(n)], np.uint32)
    segment = Segment(encode_segment(ids))
    assert (segment.all() == ids).all()
    for _ in range(4):
        a, b = sorted((rng.randrange(n + 1), rng.randrange(n + 1)))
        assert (segment.range(a, b) == ids[a:b]).all()


def test_rans_many_blocks_checkpoints_and_damage():
    from clickpulse.llm.rans import Segment, encode_segment

    rng = np.random.default_rng(3)
    ids = np.minimum(rng.zipf(1.2, 700_001), 49_000).astype(np.uint32)
    body = encode_segment(ids)
    segment = Segment(body)
    assert len(segment.index) == 3 and (segment.all() == ids).all()
    assert (segment.range(262_100, 530_000) == ids[262_100:530_000]).all()
    shares = np.bincount(ids)[np.unique(ids)] / len(ids)
    assert 8 * len(body) / len(ids) < 1.15 * -(shares * np.log2(shares)).sum()
    for at in (len(body) - 50, len(body) // 2):
        harmed = bytearray(body)
        harmed[at] ^= 4
        with pytest.raises(ValueError):
            Segment(bytes(harmed)).all()


# --- SentencePiece ---------------------------------------------------------------


@given(st.text(alphabet="  abthe.\nié你😀́▁<s>0x", max_size=40))
@settings(max_examples=150, deadline=None)
def test_pieces_equal_the_library(text):
    from clickpulse.llm.piece_bpe import piece_model

    model = piece_model(vocabulary("piece_bpe_32k.model"))
    units = model.units(model.normalize(text))
    ids = [i for u in units for i in model.piece_ids(model.encode(u))]
    assert ids == model.sp.encode(text) and model.decode(ids) == model.sp.decode(ids)
    counts = [0]
    for u in units:
        counts += [counts[-1] + c for c in model.prefix_counts(u)[1:]]
    normal = "".join(units)
    for n in range(1, len(text) + 1):
        assert normal[: n + 1] == model.normalize(text[:n]) and counts[n + 1] == len(model.sp.encode(text[:n]))


def test_prefix_store_answers(spark):
    from clickpulse.llm.prefix_counts import budget_answers, longest_within, prefix_store, tokens_of_prefix

    import sentencepiece

    path = vocabulary("piece_bpe_32k.model")
    texts = ["the quick brown fox jumps over the lazy dog", None, "", "a" * 500]
    store = prefix_store(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for r in store.collect():
        text = texts[r["doc_id"]] or ""
        for n in range(1, len(text) + 1, 7):  # one more: the space put in front
            assert tokens_of_prefix(r["deltas"], n + 1) == len(model.encode(text[:n]))
        assert tokens_of_prefix(r["deltas"], 10**9) == r["n_tokens"]
        fit = longest_within(r["deltas"], 5)
        assert len(model.encode(text[: max(0, fit - 1)])) <= 5
    answers = {r["doc_id"]: r for r in budget_answers(store, 5).collect()}
    assert answers[0]["over_limit"] and not answers[1]["over_limit"] and answers[1]["fit_chars"] == 0


def test_pieces_round_trip(spark):
    from clickpulse.llm.piece_encode import decode_pieces, encode_pieces

    path = vocabulary("piece_bpe_32k.model")
    docs = spark.createDataFrame([(1, "over the  hill\n你"), (2, None), (3, "")], "doc_id long, text string")
    back = {r["doc_id"]: r["text"] for r in decode_pieces(encode_pieces(docs, path), path).collect()}
    assert back == {1: "over the  hill\n你", 2: "", 3: ""}


# --- links -----------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_links(spark, seed):
    from clickpulse.llm.components import components

    rng = random.Random(seed)
    links = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(200, 240)] + [(300, 300 + i) for i in range(1, 40)]
    rng.shuffle(links)
    parent = {x: x for l in links for x in l}

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    touched = {x for a, b in links if a != b for x in (a, b)}
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in touched}


def near_copies(seed: int) -> list[dict]:
    """Groups of copies with a few words changed, one large, with passages that all share."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    common = [word() for _ in range(30)]
    rows = []
    for size in (60, 12, 12, 5, 1, 1, 1, 1, 2, 2):
        base = [word() for _ in range(rng.randrange(20, 160))]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randrange(0, 4)):
                text[rng.randrange(len(text))] = word()
            rows.append(" ".join(text + common * (rng.random() < 0.4)))
    rows += ["", None, "a b", "a b", "A  b"]
    rng.shuffle(rows)
    return [{"doc_id": 3 * i, "text": t} for i, t in enumerate(rows)]


@pytest.mark.parametrize(("seed", "words", "num"), [(0, 3, 90), (1, 5, 80), (2, 3, 75)])
def test_jaccard_components_of_near_copies(spark, seed, words, num):
    from clickpulse.llm.jaccard_join import jaccard_components

    rows = near_copies(seed)
    frame = spark.createDataFrame([(r["doc_id"], r["text"]) for r in rows], "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(frame, words, num, 100).collect()}
    want = brute.jaccard_components(rows, words, num, 100)
    assert got == {r["doc_id"]: w for r, w in zip(rows, want, strict=True)}
    assert len({c for _, c in got.values()}) < len(rows)


def test_near_duplicate_stage_keeps_unlike_texts_of_one_id(spark):
    from clickpulse.llm.jaccard_join import near_duplicate_stage

    rng = random.Random(8)
    a, b, c, d = (" ".join(f"w{rng.randrange(99999)}" for _ in range(60)) for _ in range(4))
    rows = [(1, a), (5, a), (5, b), (7, c), (7, d), (7, c), (9, d + " tail"), (None, a), (None, a), (3, ""), (3, ""), (4, None)]
    frame = spark.createDataFrame([(*r, i, "h") for i, r in enumerate(rows)], "doc_id long, text string, `a.b` int, h string").repartition(3)
    got = near_duplicate_stage(spark, frame, "")
    assert got.columns == ["doc_id", "text", "a.b", "h"]
    found = sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str)
    assert found == sorted([(1, a), (5, b), (7, c), (7, d), (None, a), (None, a), (3, ""), (3, ""), (4, None)], key=str)


@pytest.mark.parametrize("large", [2, 8])
def test_large_lists_sift_by_signature(spark, monkeypatch, large):
    from clickpulse.llm import jaccard_join as jj

    monkeypatch.setattr(jj, "LARGE_LIST", large)
    monkeypatch.setattr(jj, "STAR_ROUNDS", 0)  # all pairs are left to the lists
    rows = near_copies(11)
    frame = spark.createDataFrame([(r["doc_id"], r["text"]) for r in rows], "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jj.jaccard_components(frame, 3, 90, 100).collect()}
    assert got == {r["doc_id"]: w for r, w in zip(rows, brute.jaccard_components(rows, 3, 90, 100), strict=True)}


def test_prefixes_share_enough_tokens():
    """Two linked sets have the larger number of matches in common, whatever the order says."""
    from clickpulse.llm.jaccard_join import BUCKETS, _prefix

    rng = np.random.default_rng(5)
    for _ in range(300):
        excess = np.where(rng.random(BUCKETS) < 0.3, rng.integers(0, 500, BUCKETS), 0) if _ % 50 == 0 else excess
        base = rng.integers(0, 1 << 62, rng.integers(1, 80)).astype(np.uint64)
        other = np.concatenate([base[rng.random(len(base)) < 0.95], rng.integers(0, 1 << 62, rng.integers(0, 4)).astype(np.uint64)])
        x, y = np.unique(base), np.unique(other)
        common = len(np.intersect1d(x, y))
        if not len(y) or 100 * common < 90 * (len(x) + len(y) - common):
            continue
        (a, la, ma), (b, lb, mb) = _prefix(x, excess, 90, 100), _prefix(y, excess, 90, 100)
        need = max(ma, mb)
        mine, theirs = dict(zip(a.tolist(), la.tolist(), strict=True)), dict(zip(b.tolist(), lb.tolist(), strict=True))
        assert sum(max(mine[t], theirs[t]) <= need for t in mine.keys() & theirs.keys()) >= need


@given(st.lists(st.text(alphabet="abcdefghijklmnopqrstuvwxyzT' \n.9\u00e9", max_size=25), max_size=12))
@settings(max_examples=150, deadline=None)
def test_word_ids_equal_the_library(texts):
    from clickpulse.llm.byte_ids import chunked
    from clickpulse.llm.queries import vocabulary

    own = chunked(vocabulary("word_bpe_49k.json"))
    want = [e.ids for e in own.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert own.letters is not None and [np.frombuffer(x, "<u4").tolist() for x in own.ids(texts)] == want


def test_ids_of_all_words_of_a_table():
    import pyarrow.parquet as pq

    from clickpulse.llm.byte_ids import chunked
    from clickpulse.llm.queries import vocabulary

    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()
    own = chunked(vocabulary("word_bpe_49k.json"))
    want = [e.ids for e in own.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.ids([t or "" for t in texts])] == want


def test_latin_words_are_merged_by_rank(monkeypatch):
    from clickpulse.llm.byte_ids import ChunkedTokenizer
    from clickpulse.llm.queries import vocabulary

    own, sent = ChunkedTokenizer(vocabulary("word_bpe_49k.json")), []
    encoded = own._encoded
    monkeypatch.setattr(own, "_encoded", lambda parts: sent.extend(parts) or encoded(parts))
    texts = ["Straße, élève.  ÉCOLE'S año", "Straße ½ <|ENDOFTEXT|> a<|endoftext|>É", ""]
    want = [e.ids for e in own.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.ids(texts[:1] + texts[2:])] == want[:1] + want[2:]
    assert set(sent) == {",", ".", "'s"}  # the library sees signs alone
    assert [np.frombuffer(x, "<u4").tolist() for x in own.ids(texts)] == want


@given(st.lists(st.text(alphabet="abé.²!,(1 \n\u4e2d\u2581", max_size=20), max_size=6))
@settings(max_examples=100, deadline=None)
def test_pieces_of_a_units_parts_are_the_units(texts):
    from clickpulse.llm.piece_bpe import piece_model
    from clickpulse.llm.queries import vocabulary

    model = piece_model(vocabulary("piece_bpe_32k.model"))
    assert model.parts("\u2581(word.\n") == ["\u2581(", "word", ".\n"]
    for text in texts:
        units = model.units(model.normalize(text))
        assert [i for u in units for p in model.parts(u) for i in model.encode_ids(p)] == model.sp.encode(text)
        assert all("".join(model.parts(u)) == u for u in units)


def test_wide_signatures_tell_long_sets_apart(spark, tmp_path):
    from clickpulse.llm import jaccard_join

    rng = np.random.default_rng(5)
    sets = [np.sort(rng.integers(0, 1 << 63, size=n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)) for n in (6000, 6000, 4000)]
    near = np.sort(np.concatenate([sets[0][:5400], sets[1][:300]]))
    wide = [jaccard_join._wide(x) for x in (*sets, near)]
    differ = lambda i, j: jaccard_join._wide_differ(*[np.frombuffer(wide[k], np.uint8) for k in (i, j)])
    assert jaccard_join._wide(sets[0][: jaccard_join.PARITY]) is None and len(wide[2]) != len(wide[0])
    assert differ(0, 3) <= 900 and differ(0, 0) == 0 and differ(2, 0) == differ(0, 2)
    pairs = spark.createDataFrame([(0, 1, 6000, 6000), (0, 3, 6000, 5700), (0, 2, 6000, 4000)], "a long, b long, n long, m long")
    rows = spark.createDataFrame([(i, bytearray(w)) for i, w in enumerate(wide)], "class long, wide binary")
    assert [(r["a"], r["b"]) for r in jaccard_join._wide_near(pairs, rows, 80, 100).collect()] == [(0, 3)]


# --- spans -----------------------------------------------------------------------


@given(st.text(alphabet="ab.!? \n\t", max_size=60))
@settings(max_examples=150, deadline=None)
def test_sentences_join_to_the_text(text):
    from clickpulse.llm.substring_dedup import sentences, spans

    parts = sentences(text)
    assert "".join(parts) == text and all(parts)
    sizes = [len(brute.WORD.findall(p)) for p in parts]
    for _, first, count in zip(*spans(text, 3), strict=True):
        own = sizes[first : first + count]
        assert sum(own) >= 3 and min(sum(own[1:]), sum(own[:-1])) < 3


def test_repeated_passage_goes_and_the_rest_stays(spark):
    from clickpulse.llm.substring_dedup import drop_repeats

    rng = random.Random(1)
    sentence = lambda: " ".join(f"w{rng.randrange(9999)}" for _ in range(rng.randrange(5, 15))) + "."
    passage = " ".join(sentence() for _ in range(7))
    own = [[" ".join(sentence() for _ in range(4)) for _ in range(2)] for _ in range(6)]
    rows = [(i, f"{a}\n{passage}\n{b}" if i < 5 else f"{a}\n{b}", "x") for i, (a, b) in enumerate(own)]
    got = {r["doc_id"]: r for r in drop_repeats(spark.createDataFrame(rows, "doc_id long, text string, lost string")).collect()}
    assert got[0]["text"] == rows[0][1] and got[5]["text"] == rows[5][1]
    for i in range(1, 5):
        assert got[i]["text"] == f"{own[i][0]}\n{own[i][1]}" and got[i]["lost"] == "x"


@pytest.mark.parametrize("seed", range(40))
def test_fifty_shared_words_hold_a_span(seed):
    from clickpulse.llm.substring_dedup import MIN_WORDS, MOST_WORDS, sentences, spans

    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(500)}" + "." * (rng.random() < (0, 0.03, 0.1)[seed % 3])
    some = lambda n: [word() for _ in range(n)]
    passage = some(50)
    one, two = (" ".join(some(rng.randrange(60)) + passage + some(rng.randrange(60))) for _ in range(2))
    assert max(len(p.split()) for p in sentences(one)) <= MOST_WORDS
    assert set(spans(one, MIN_WORDS)[0]) & set(spans(two, MIN_WORDS)[0])


def test_unlike_texts_of_one_id_and_odd_columns(spark):
    """A text is not cut by another text's places, and columns of any name pass through."""
    from clickpulse.llm.substring_dedup import drop_repeats, substring_stage

    rng = random.Random(4)
    text = lambda n: " ".join(f"w{rng.randrange(99999)}" for _ in range(n))
    shared, own, alone = text(60), text(200), text(300)
    rows = [(1, shared), (5, own + " " + shared), (5, alone), (5, alone)]
    frame = spark.createDataFrame([(*r, 7, "p") for r in rows], "doc_id long, text string, dropped_sentences long, `a.b` string")
    got = sorted((r["doc_id"], r["text"], r["dropped_sentences"], r["a.b"]) for r in substring_stage(spark, frame, "").collect())
    kept = next(t for d, t, _, _ in got if d == 5 and t != alone)
    assert [g[:2] for g in got if g[1] == alone] == [(5, alone)] * 2 and (1, shared, 7, "p") in got and {g[2:] for g in got} == {(7, "p")}
    assert kept.split()[:190] == own.split()[:190] and len(kept.split()) < 215
    counted = {(r["doc_id"], r["text"]): r["dropped_sentences"] for r in drop_repeats(frame).collect()}
    assert counted[5, alone] == 0 and counted[1, shared] == 0 and counted[5, kept] > 2


@pytest.mark.parametrize("slots", [64, 1 << 20])
def test_bitmap_only_sifts(spark, monkeypatch, slots):
    """A full bitmap and a sparse one give the same result."""
    from clickpulse.llm import substring_dedup as sd

    monkeypatch.setattr(sd, "SLOTS", slots)
    rows = [(r["doc_id"], (r["text"] or "") * 2) for r in near_copies(3)][:60]
    got = sorted((r["doc_id"], r["text"], r["dropped_sentences"]) for r in sd.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(d, *w) for (d, _), w in sorted(zip(rows, brute.without_repeats(rows, 20), strict=True))] and any(n for _, _, n in got)


def test_passage_within_long_sentences_goes(spark):
    from clickpulse.llm.substring_dedup import drop_repeats

    rng = random.Random(2)
    some = lambda n: [f"w{rng.randrange(9999)}" for _ in range(n)]
    passage = some(60)
    own = [(some(31 + 7 * i), some(40)) for i in range(4)]
    rows = [(i, " ".join(a + passage + b)) for i, (a, b) in enumerate(own)]
    got = {r["doc_id"]: r["text"].split() for r in drop_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == rows[0][1].split()
    for i, (a, b) in enumerate(own[1:], 1):
        kept = got[i][len(a) : -len(b)]
        assert got[i][: len(a)] == a and got[i][-len(b) :] == b and len(kept) <= 20 and set(kept) <= set(passage)


def test_counters_leave_a_task_narrow_and_whole(spark):
    from clickpulse.llm import jaccard_join as jj
    from clickpulse.llm.common import ship

    ship(spark)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 4 << 20
    rng = random.Random(9)
    rows = [(i, " ".join(["one", "same", "start"] + [f"w{rng.randrange(10**6)}" for _ in range(40)])) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    first = jj._first_pass(jj._text_rows(docs), 3).where("slice is not null").select("slice", "counts")
    sizes = [len(r["counts"]) for r in first.collect()]
    assert len(sizes) == jj.SLICES and sorted(sizes)[0] == jj.BUCKETS // jj.SLICES < sorted(sizes)[-1]  # one run stands 300 times
    want = np.zeros(jj.BUCKETS, np.int64)
    for _, own in jj._sets(pa.RecordBatch.from_pydict({"text": [t for _, t in rows]}), 3):
        np.add.at(want, own & np.uint64(jj.BUCKETS - 1), 1)
    assert want.max() >= 300 and (jj._token_counts(first) == want).all()


def test_small_batches_are_put_together():
    from clickpulse.llm.common import cut_rows

    batches = [pa.RecordBatch.from_pydict({"x": list(range(10 * i, 10 * i + 10))}) for i in range(9)]  # 80 bytes each
    got = list(cut_rows(iter(batches), 240))
    assert [b.num_rows for b in got] == [30, 30, 30] and [x for b in got for x in b.column("x").to_pylist()] == list(range(90))
    assert [b.num_rows for b in cut_rows(iter(batches[:2]), 40)] == [5, 5, 5, 5] and not list(cut_rows(iter([]), 40))


# --- suffix tree -----------------------------------------------------------------


def test_tree_distributions_sum_to_one(spark):
    from clickpulse.llm import suffix_tree_lm as lm

    rows = [(i, " ".join(random.Random(i % 7).choices(["a", "b", "c", "d", "e"], [5, 4, 3, 2, 1], k=60)) + " a b a b x") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts = lm.word_counts(docs, 8)
    words, n = (np.array(x) for x in zip(*counts.collect(), strict=True))
    words, total, vocabulary = words.astype(np.int64).view(np.uint64), int(n.sum()), len(n)
    norm = total + lm.ALPHA * (vocabulary + 1)
    base, unseen = (n + lm.ALPHA) / norm, lm.ALPHA / norm
    tables, filters = lm.grow(docs, counts, total, vocabulary, 8)
    assert len(tables) == len(filters) > 1
    value = {r["key"] & (2**64 - 1): r["value"] for t in tables for r in t.collect()}
    states = 0
    for one in words:
        for two in words:  # P(word | two, one) by the longest state
            text = np.stack([np.full(len(words), two), np.full(len(words), one), words], 1).ravel()
            p, rest = base.copy(), unseen
            for (where, context, entry, _), _ in zip(lm._deeper(text, np.arange(0, len(text) + 1, 3), filters[:2], np.arange(2, len(text), 3)), range(2), strict=False):
                state = value.get(int(context[0])) if len(context) else None
                if state is None:
                    break
                states += 1
                p *= 10.0 ** (state + np.array([value.get(int(e), 0.0) for e in entry]))
                rest *= 10.0**state
            assert math.isclose(p.sum() + rest, 1, rel_tol=1e-9)
    assert states > len(words)


def plain_tree_scores(rows) -> dict:
    """Scores by a suffix tree of any depth, kept in dictionaries."""
    from clickpulse.llm import suffix_tree_lm as lm

    texts = {d: [*t.split(), None] for d, t in rows}
    training = [t for d, t in texts.items() if not lm.held_out(d)]
    ones = Counter(w for t in training for w in t)
    total = sum(ones.values())
    base = lambda w: (ones[w] + lm.ALPHA) / (total + lm.ALPHA * (len(ones) + 1))
    states = {}

    def p(word, context):
        if not context:
            return base(word)
        shorter = p(word, context[1:])
        rest, own = states[context] if context in states else (1.0, {})
        return own.get(word, 0.0) + rest * shorter

    depth, grown = 0, True
    while grown:
        depth, grown, after = depth + 1, False, {}
        for t in training:
            for i in range(depth, len(t)):
                context = tuple(t[i - depth : i])
                if depth == 1 or context[1:] in states:
                    after.setdefault(context, Counter())[t[i]] += 1
        for context, words in after.items():
            n, some = sum(words.values()), {w: c for w, c in words.items() if c >= lm.LEAST_COUNT}
            below = {w: p(w, context[1:]) for w in some}
            gain = sum(c * math.log(c / n / below[w]) for w, c in some.items())
            left, left_below = n - sum(some.values()), 1 - sum(below.values())
            gain += left * math.log(left / n / left_below) if left > 0 and left_below > 0 else 0
            if some and gain > len(some) * 0.5 * math.log(total):
                own = {w: (c - lm.DISCOUNT) / n for w, c in some.items()}
                states[context], grown = (1 - sum(own.values()), own), True
    longest = lambda t, i: next((tuple(t[i - k : i]) for k in range(min(i, depth), 0, -1) if tuple(t[i - k : i]) in states), ())
    return {d: sum(math.log10(p(w, longest(t, i))) for i, w in enumerate(t)) for d, t in texts.items()} | {"depth": max(map(len, states), default=0), "states": states}


@pytest.mark.parametrize("share", [1e-6, 2.0])
def test_tree_keeps_rare_and_long_contexts(spark, monkeypatch, share):
    from clickpulse.llm import suffix_tree_lm as lm

    rng = random.Random(5)
    rows = [(i, " ".join(f"w{rng.randrange(3000)}" for _ in range(400))) for i in range(150)]
    weights: dict = {}
    for i in range(60):  # each word depends on the three before it
        words = ["a", "b", "c"]
        while len(words) < 120:
            words += rng.choices("abc", weights.setdefault(tuple(words[-3:]), [rng.random() ** 4 for _ in "abc"]))
        rows.append((1000 + i, " ".join(words)))
    rows += [(2000 + i, "rare pair") for i in range(3)]  # a share below 5e-5
    want = plain_tree_scores(rows)
    assert want["depth"] >= 3 and ("rare",) in want["states"]
    monkeypatch.setattr(lm, "SHARED", share)  # 2: all by joins
    got = {r["doc_id"]: r["score"] for r in lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(math.isclose(got[d], want[d], rel_tol=1e-9) for d, _ in rows)
    # the tree from windows alone, cut again at every second depth
    monkeypatch.setattr(lm, "FEW", 0)
    monkeypatch.setattr(lm, "WINDOW", 2)
    again = {r["doc_id"]: r["score"] for r in lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(math.isclose(again[d], want[d], rel_tol=1e-9) for d, _ in rows)


@pytest.mark.parametrize("local", [1 << 15, 0])
def test_long_repeats_take_few_passes(spark, monkeypatch, local):
    """Deep states grow in one job, not in two passes for each length."""
    from clickpulse.llm import suffix_tree_lm as lm

    rng = random.Random(8)
    rows, weights = [], {}
    for i in range(100):  # each word depends on the five before it
        words = rng.choices("ab", k=5)
        while len(words) < 150:
            words += rng.choices("ab", weights.setdefault(tuple(words[-5:]), [rng.random() ** 3 for _ in "ab"]))
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, f"a b c{i % 9} d a") for i in range(40)] + [(2000, None), (2001, "")]
    want = plain_tree_scores([(d, t or "") for d, t in rows])
    names, write = [], lm.staged
    monkeypatch.setattr(lm, "LOCAL", local)
    monkeypatch.setattr(lm, "staged", lambda df, name: names.append(name) or write(df, name))
    monkeypatch.setattr(lm, "FEW", 0)
    got = {r["doc_id"]: r["score"] for r in lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert want["depth"] >= 5 and all(math.isclose(got[d], want[d], rel_tol=1e-9) for d, _ in rows)
    assert "repeated" not in names  # each depth reads the texts once
    assert names.count("runs") == (1 if local else want["depth"] + 1) and ("subtrees" in names) == bool(local)


def test_look_up_by_first_bits():
    from clickpulse.llm import suffix_tree_lm as lm

    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 1000):
        keys = np.unique(np.append(rng.integers(0, 2**64, n, np.uint64), np.array([0, 2**64 - 1], np.uint64)[: n // 2]))
        asked = np.concatenate([keys, rng.integers(0, 2**64, 500, np.uint64), np.array([0, 5, 2**64 - 1], np.uint64)])
        at, own = lm.Places(keys).find(asked)
        assert (own == np.isin(asked, keys)).all() and (keys[at[own]] == asked[own]).all()
    assert (lm._unmix64(lm.mix64(keys)) == keys).all()


def test_counting_task_holds_and_sends_little_at_a_time():
    from clickpulse.llm import suffix_tree_lm as lm

    rng = np.random.default_rng(4)
    keys = rng.integers(0, 2**64, 2_000_000, np.uint64)
    counter, sent = lm._Counter(100), []
    for part in np.split(np.concatenate([keys, keys[:500_000]]), 50):
        sent += counter.add(part)
        assert counter.size + len(counter.held[0]) <= lm.FLUSH * 3 // 2
    assert sent  # before the end
    sent += counter.rows()
    assert len(sent) > 10 and max(b.nbytes for b in sent) < 2 * lm.PIECE
    table = pa.Table.from_batches(sent)
    found, n = lm._merge(table)
    want, m = np.unique(np.concatenate([keys, keys[:500_000]]), return_counts=True)
    assert (found == want).all() and (n == m).all()
    for bucket in range(128):  # each bucket is a range of keys
        own = table.filter(pa.array([b == bucket for b in table.column("bucket").to_pylist()]))
        assert (lm._unpacked(own)[0] >> np.uint64(57) == bucket).all()


# --- neighbours ------------------------------------------------------------------


def test_walk_visits_cells_by_summed_distance():
    from clickpulse.llm.multi_index import MultiIndex, _distances

    rng = np.random.default_rng(2)
    index = MultiIndex(rng.normal(size=(6, 3)), rng.normal(size=(5, 3)))
    index.counts = rng.integers(0, 3, 30)
    for _ in range(20):
        v = rng.normal(size=6)
        one, two = (_distances(x[None], b)[0] for x, b in zip((v[:3], v[3:]), index.books, strict=True))
        both = (one[:, None] + two[None]).ravel()
        order = [c for c in np.argsort(both, kind="stable").tolist() if index.counts[c]]
        assert index.walk(v, 10**9) == order
        part = index.walk(v, 7)
        assert part == order[: len(part)] and index.counts[part].sum() >= 7 > index.counts[part[:-1]].sum()


def test_common_vector_keeps_the_least_ids(spark):
    from clickpulse.llm.multi_index import nearest

    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(300)] + [(1000 + i, [float(i), 1.0, 0.0, 2.0]) for i in range(30)]
    got: dict = {}
    for r in nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), 100, 5).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got[0]) == [(k, k, 0.0) for k in range(1, 6)]
    assert sorted(got[200]) == [(k, k - 1, 0.0) for k in range(1, 6)] and len(got[1000]) == 5


# --- quality ---------------------------------------------------------------------


def test_binomial_tail(spark):
    from pyspark.sql import functions as F

    from clickpulse.llm.quality import binomial_tail

    cases = [(k, n) for n in (1, 10, 400, 5000) for k in (0, 1, 3, 17) if k <= n]
    rows = spark.createDataFrame(cases, "k long, n long").withColumn("p", binomial_tail(F.col("k"), F.col("n"), 0.004)).collect()
    for r in rows:
        want = sum(math.comb(r["n"], i) * 0.004**i * 0.996 ** (r["n"] - i) for i in range(r["k"] + 1)) if r["k"] <= r["n"] * 0.004 else 1.0
        assert math.isclose(r["p"], want, rel_tol=1e-9)


def test_cutoffs_hold_their_promise(spark):
    from clickpulse.llm import quality

    rng = random.Random(4)
    rows = []
    for _ in range(6000):  # the second rule would reject a tenth of good documents at its strict end
        levels = [quality.LEVELS] * len(quality.RULES)
        if rng.random() < 0.1:
            levels[1] = quality.LEVELS - 1
        rows.append(("en", levels))
    rows += [("de", [quality.LEVELS] * len(quality.RULES))] * 20  # too few to show anything
    cut = {r["stratum"]: r["cut"] for r in quality.cutoffs(spark.createDataFrame(rows, "stratum string, levels array<int>")).collect()}
    assert cut["en"] == [19, 18, 19, 19, 19] and cut["de"] == [-1] * 5 and cut["other"] == [-1] * 5
    assert set(cut) == {"en", "de", "other"}


def test_each_language_is_a_stratum(spark):
    from pyspark.sql import functions as F

    from clickpulse.llm import quality

    # the second rule's strict end rejects 3% of good Italian documents, and none of the many Portuguese ones
    good = F.array_repeat(F.lit(quality.LEVELS), len(quality.RULES))
    bad = F.array(*[F.lit(quality.LEVELS - (i == 1)) for i in range(len(quality.RULES))])
    rows = spark.range(30000).select(F.when(F.col("id") % 2 == 0, "pt-BR").otherwise(" PT").alias("lang"), good.alias("levels"))
    rows = rows.union(spark.range(2000).select(F.lit("it"), F.when(F.col("id") < 60, bad).otherwise(good)))
    rows = rows.union(spark.range(3000).select(F.lit("EN-us"), good)).union(spark.range(3).select(F.lit(None).cast("string"), good))
    cut = {r["stratum"]: r["cut"] for r in quality.cutoffs(rows.select(quality.stratum(F.col("lang")).alias("stratum"), "levels")).collect()}
    assert set(cut) == {"en", "other", "pt", "it"}
    assert cut["pt"] == cut["en"] == [19] * 5 and cut["it"] == [19, 18, 19, 19, 19] and cut["other"] == [-1] * 5


def test_quality_plan_has_no_python(spark):
    from clickpulse.llm.queries import QUERIES

    plan = QUERIES["op7_risk_controlled_quality"](spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- languages -------------------------------------------------------------------


def test_other_evidence_decides_where_text_says_little(spark):
    from clickpulse.llm.language_id import identify

    english = "the house of the brother and the water of that with this which are not from there "
    german = "der hund und die katze mit dem haus nicht ein zu auch werden sich aus ist "
    rows = [(i, english * 3, "en", "h1", "com") for i in range(40)] + [(100 + i, german * 3, "de", "h2", "com") for i in range(40)]
    rows += [(500, "", None, "h1", "com"), (501, None, None, "h2", "com"), (502, german, "en", "h2", "com"), (503, "", "de", None, None), (504, "你好世界，这是一个测试。" * 9, None, "h1", "com")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, declared string, host string, suffix string")
    got = {r["doc_id"]: r for r in identify(frame, ["doc_id"]).collect()}
    assert all(got[i]["language"] == "en" and got[100 + i]["language"] == "de" and got[i]["kept"] for i in range(40))
    assert (got[500]["language"], got[501]["language"], got[502]["language"], got[503]["language"]) == ("en", "de", "de", "de")
    assert not got[500]["kept"] and not got[504]["kept"] and got[504]["language"] == "und"


def test_language_of_few_rows_is_one(spark):
    from clickpulse.llm.language_id import identify

    english, german = "the house of the brother and the water of that with this ", "der hund und die katze mit dem haus nicht ein zu auch "
    greek = "το σπίτι του αδελφού και το νερό της θάλασσας δεν είναι εδώ με αυτό που από εκεί "
    rows = [(i, (english, german)[i % 2], ("en", "de")[i % 2], f"h{i % 2}", None) for i in range(3000)]
    rows += [(5000 + i, greek * 8, "el", "h2", None) for i in range(12)]  # a share of 0.4%
    got = {r["doc_id"]: r for r in identify(spark.createDataFrame(rows, "doc_id long, text string, declared string, host string, suffix string"), ["doc_id"]).collect()}
    assert all(got[5000 + i]["language"] == "el" and got[5000 + i]["kept"] for i in range(12))
    assert all(got[i]["language"] == ("en", "de")[i % 2] for i in range(3000))


def test_page_evidence(spark):
    from clickpulse.llm.language_id import page_rows

    html = "<!DOCTYPE html><HTML class='x' lang='de-AT'><script>var t='<p>';</script><p>Guten&nbsp;Tag</p>"
    rows = [(1, "https://u@www.Example.co.at:80/de?x=1", html), (2, None, None), (3, "nonsense", "<p>x")]
    got = {r["page_id"]: r for r in page_rows(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert (got[1]["declared"], got[1]["host"], got[1]["suffix"], got[1]["text"].split()) == ("de-AT", "www.example.co.at", "at", ["Guten", "Tag"])
    assert got[2]["declared"] is None and got[2]["host"] is None and got[3]["suffix"] is None


# --- the pipeline ----------------------------------------------------------------


def test_pipeline_stages(spark):
    import corpus_pipeline
    from clickpulse.llm.common import staged

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_duplicates", "substrings", "packing"]
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, SF), name)
        assert docs.columns == columns
        now = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert now.keys() <= rows.keys()
        if name != "substrings":
            assert all(rows[d] == t for d, t in now.items())
        seen[name], rows = set(now), now
        if name == "quality":
            assert all(not brute.quality_counts(t)[0] < 50 for t in now.values())
        if name == "near_duplicates":
            own = [{"doc_id": d, "text": t} for d, t in now.items()]
            assert all(c == r["doc_id"] for r, (_, c) in zip(own, brute.jaccard_components(own, 5, 80, 100), strict=True))
    assert len(seen["near_duplicates"]) < len(seen["language"]) == len(seen["quality"])
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in pieces} == set(rows)
    whole = corpus_pipeline.run(spark, SF).collect()
    key = lambda r: (r["doc_id"], r["start"], r["length"], r["ids_crc32"])
    assert sorted(map(key, whole)) == sorted(map(key, pieces))


def test_pipeline_edge_and_empty(spark, edge_dir, empty_dir):
    import corpus_pipeline

    assert corpus_pipeline.run(spark, empty_dir).collect() == []
    assert corpus_pipeline.run(spark, edge_dir).count() >= 0  # runs through, whatever its rules keep


def test_working_tables_go_with_their_scope(spark):
    import os

    from clickpulse.llm.common import scratch, staged
    from clickpulse.session import local_path

    here = lambda df: os.path.exists(local_path(df.staged_path))
    with scratch() as outer:
        with scratch() as inner:
            a, b, c = (staged(spark.range(n), "scope") for n in (1, 2, 3))
            inner.keep(b, c)
        assert not here(a) and here(b) and here(c)
        outer.keep(c)
    assert not here(b) and c.count() == 3
    with pytest.raises(ValueError), scratch():
        d = staged(spark.range(4), "scope")
        raise ValueError
    assert not here(d) and here(staged(spark.range(5), "scope"))


def test_stages_free_what_the_stage_before_left(spark):
    import os

    import corpus_pipeline
    from clickpulse.llm.common import staged
    from clickpulse.session import local_path

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    (_, quality), (_, language) = corpus_pipeline.STAGES[:2]
    folders = lambda: {f for f in os.listdir(local_path(spark.sparkContext.getCheckpointDir())) if f.startswith("quality-")}
    before = folders()
    open_rows = quality(spark, docs, SF)
    (own,) = folders() - before
    language(spark, docs, SF).count()  # side by side on the same documents: the first one's rows can still be read
    n = open_rows.count()
    straight = language(spark, open_rows, SF)  # not written before: it reads them itself
    assert own in folders() and 0 < straight.count() <= n
    rows = quality(spark, docs, SF)
    (again,) = folders() - before - {own}
    written = staged(rows, "written")
    language(spark, written, SF).count()
    assert again not in folders()
