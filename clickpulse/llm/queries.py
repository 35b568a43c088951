"""Registered queries: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickpulse.llm.common import table
from clickpulse.llm.sql import SQL

__all__ = ["QUERIES", "SQL"]

END_ID = 1
WINDOW = 2048
TOKEN_LIMIT = 4096

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clickpulse.llm.language_id import document_rows, identify

    return identify(document_rows(table(spark, sf_dir, "documents")), ["doc_id"])


def page_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clickpulse.llm.language_id import identify, page_rows

    return identify(page_rows(table(spark, sf_dir, "pages")), ["page_id"])


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clickpulse.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), WINDOW, END_ID)


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clickpulse.llm.jaccard_join import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"), words=3, num=90, den=100)


def op4_sentence_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clickpulse.llm.substring_dedup import drop_repeats

    return drop_repeats(table(spark, sf_dir, "documents")).select("doc_id", "text", "dropped_sentences")


def op5_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clickpulse.llm.suffix_tree_lm import score_texts

    return score_texts(table(spark, sf_dir, "documents"))


def op6_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clickpulse.llm.multi_index import nearest

    return nearest(table(spark, sf_dir, "embeddings"), every=100, k=10)


def op7_risk_controlled_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clickpulse.llm.quality import judge

    judged = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *[f"quality.{c}" for c in counts], "base_failed", "kept")


def op8_rans_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clickpulse.llm.rans import read_token_files, write_token_files
    from clickpulse.session import scratch_path

    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), path, END_ID)
    return read_token_files(spark, path)


def op9_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clickpulse.llm.prefix_counts import budget_answers, prefix_store

    store = prefix_store(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))
    return budget_answers(store, TOKEN_LIMIT)


def op10_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clickpulse.llm.piece_encode import encode_digests

    return encode_digests(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op11_factorisation_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clickpulse.llm.quality_fm import score_quality

    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clickpulse.llm.token_alignment import align_documents

    return align_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


def op13_va_file_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clickpulse.llm.va_clustering import cluster

    return cluster(table(spark, sf_dir, "embeddings"), k=8, rounds=10, dims=64, scale=1024, seed="3:")


QUERIES: dict[str, Query] = {
    "op1_language_id": op1_language_id,
    "page_language_id": page_language_id,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_sentence_span_dedup": op4_sentence_span_dedup,
    "op5_suffix_tree_scores": op5_suffix_tree_scores,
    "op6_inverted_multi_index": op6_inverted_multi_index,
    "op7_risk_controlled_quality": op7_risk_controlled_quality,
    "op8_rans_token_files": op8_rans_token_files,
    "op9_prefix_token_counts": op9_prefix_token_counts,
    "op10_sentencepiece_codec": op10_sentencepiece_codec,
    "op11_factorisation_quality": op11_factorisation_quality,
    "op12_token_alignment": op12_token_alignment,
    "op13_va_file_clustering": op13_va_file_clustering,
}
