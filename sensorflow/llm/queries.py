"""The registered queries of the subpackage, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from sensorflow.llm import (alignment, bpe, exact_dedup, line_dedup, multi_index, near_dedup, packing, phrase_dedup, prefix_trie,
                            quality, repetition, secret_scan, toxicity)
from sensorflow.llm.common import read_documents, read_labels


def op1_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.with_digests(bpe.bpe_round_trip(read_documents(spark, sf_dir), path))


def op2_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    return quality.score(docs, quality.train(docs, read_labels(spark, sf_dir)))


def op3_suffix_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.with_verdict(repetition.repetition(read_documents(spark, sf_dir))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "longest_repeat", "covered_chars")


def op4_progressive_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_decisions(read_documents(spark, sf_dir))


def op5_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.train(docs, read_labels(spark, sf_dir)))


def op6_randomness_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.with_digests(secret_scan.find_secrets(read_documents(spark, sf_dir)))


def op7_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.with_crc32(packing.pack_documents(read_documents(spark, sf_dir), path))


def op8_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_dedup.drop_repeated(read_documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op9_bottom_k_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_documents(spark, sf_dir), shingle_words=4, percent=80).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op10_site_spread_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_boilerplate(read_documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op11_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return multi_index.neighbours(vectors, F.col("vec_id") % 100 == 0, 10)


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.link_counts(read_documents(spark, sf_dir), a, b)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def llm_registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (op1_bpe_transducer, op2_ordinal_quality, op3_suffix_repetition, op4_progressive_dedup,
           op5_counterfactual_toxicity, op6_randomness_secrets, op7_cost_packing, op8_phrase_automata,
           op9_bottom_k_near_dedup, op10_site_spread_lines, op11_inverted_multi_index, op12_tokenizer_alignment, op13_prefix_trie)
    return {f.__name__: f for f in ops} | {"pipeline": corpus_pipeline.run}


def llm_oracles() -> dict[str, str]:
    return {"op3_suffix_repetition": repetition.ORACLE, "op4_progressive_dedup": exact_dedup.ORACLE,
            "op8_phrase_automata": phrase_dedup.ORACLE, "op9_bottom_k_near_dedup": near_dedup.ORACLE,
            "op10_site_spread_lines": line_dedup.ORACLE, "op13_prefix_trie": prefix_trie.ORACLE}
