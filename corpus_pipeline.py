"""Corpus pipeline: quality classifier, exact dedup, near dedup, secret scan, packing.

Each stage takes ``(spark, docs, sf_dir)`` with the columns of ``documents`` and works on all
its predecessor kept.  All stages but the last return these columns; the last returns the
pieces of the packed sequences.  :func:`run` writes each stage's result to the shared folder
and reads it back, which cuts the lineage, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.llm import exact_dedup, near_dedup, packing, quality, secret_scan
from sensorflow.llm.common import read_documents, read_labels
from sensorflow.session import staged


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier doesn't reject; learned from labelled input rows."""
    return quality.keep_good(docs, quality.train(docs, read_labels(spark, sf_dir)))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies (five-word shingles, Jaccard 0.8 or more)."""
    return near_dedup.drop_near_copies(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; ``n_chars`` follows the text."""
    clean = secret_scan.redact(docs)
    kind = docs.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.coalesce(F.length("text"), F.col("n_chars")).cast(kind))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens, without padding."""
    return packing.with_crc32(packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

#: the classifier and the tokenizer have no SQL form; tests compare the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
