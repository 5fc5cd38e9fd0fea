"""Texts beyond one slice in every operator; the whole pipeline on odd, empty and clashing tables; forced shuffles."""

from collections import Counter

import brute
import public_tokenizers
import pytest
from corpus_rows import ODD, SF, prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from sensorflow.llm import (alignment, bpe, exact_dedup, line_dedup, near_dedup, packing, phrase_dedup, quality, repetition,
                            secret_scan, toxicity)
from sensorflow.llm.common import SLICE_BYTES

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def long_rows():
    """A text of more than a slice, an exact and a near copy, and short texts that share its last words."""
    text = prose(40, 400_000) + "\nthe last line\n"
    assert len(text) > SLICE_BYTES
    tail = " ".join(text.split()[-60:])
    near = prose(41, 300) + " " + " ".join(text.split()[300:]) + " password = hunter22"
    return [(1, text, "a"), (2, text.replace("\n", "  \n"), "b"), (3, near, "c"), (4, f"own words here {tail}", "d"), (5, "", "e"),
            (6, prose(42, 50), "f")]


@pytest.fixture(scope="module")
def long_docs(make_docs, long_rows):
    return make_docs(long_rows)


def test_long_texts_in_the_deduplicating_operators(long_docs, long_rows):
    rows = [(i, t) for i, t, _ in long_rows]
    got = exact_dedup.dedup_decisions(long_docs).collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got} == brute.exact_dedup(rows)
    assert sorted(r.doc_id for r in exact_dedup.drop_copies(long_docs).select("doc_id").collect()) == [1, 3, 4, 5, 6]
    rows, long_docs = [x for x in rows if x[0] != 2], long_docs.where("doc_id != 2")
    got = near_dedup.near_duplicates(long_docs, shingle_words=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute.near_dedup(rows)
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 3: 1, 4: 4, 5: 5, 6: 6}
    got = phrase_dedup.drop_repeated(long_docs).select("doc_id", "n_words", "n_removed", F.sha2("text", 256)).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == brute.repeated_windows(rows)


def test_long_texts_in_the_measuring_operators(long_docs, long_rows):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = repetition.with_verdict(repetition.repetition(long_docs)).collect()
    assert {r.doc_id: tuple(r[n] for n in names) for r in got} == {i: brute.repetition_base(t) for i, t, _ in long_rows}
    spans = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in secret_scan.find_secrets(long_docs).collect()}
    assert spans == {i: brute.secret_spans(t) for i, t, _ in long_rows} and len(spans[3]) == 1
    lines = {r.doc_id: (r.n_lines, r.n_removed) for r in line_dedup.drop_boilerplate(long_docs, min_sites=2).collect()}
    assert lines[1] == (2, 2) and lines[3] == (1, 0) and lines[5] == (0, 0)


def test_long_texts_in_the_encoders(long_docs, long_rows):
    long_rows, long_docs = [x for x in long_rows if x[0] not in (2, 3)], long_docs.where("doc_id not in (2, 3)")
    t = Tokenizer.from_file(BYTE)
    want = {i: (n.ids, x) for i, x, _ in long_rows for n in [t.encode(x, add_special_tokens=False)]}
    got = bpe.with_digests(bpe.bpe_round_trip(long_docs, BYTE)).collect()
    assert {r.doc_id: (r.n_tokens, r.decoded_sha256) for r in got} == {
        i: (len(ids), brute.sha(t.decode(ids, skip_special_tokens=False))) for i, (ids, _) in want.items()}
    w = Tokenizer.from_file(WORD)
    pieces = packing.pack_documents(long_docs, WORD).select("doc_id", "length").collect()
    total = Counter()
    for r in pieces:
        total[r.doc_id] += r.length
    assert total == {i: len(w.encode(x, add_special_tokens=False).ids) + 1 for i, x, _ in long_rows}
    links = {r.doc_id: r for r in alignment.link_counts(long_docs, BYTE, PIECE).collect()}
    assert {i: r.n_a for i, r in links.items()} == {
        i: len(t.encode(" " + x, add_special_tokens=False).ids) if x else 0 for i, x, _ in long_rows}


def test_long_texts_in_the_classifiers(long_docs, long_rows, spark):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 7)], "doc_id long, quality int, toxic int")
    graded = quality.score(long_docs, quality.train(long_docs, labels)).collect()
    scored = toxicity.score(long_docs, toxicity.train(long_docs, labels)).collect()
    assert len(graded) == len(scored) == len(long_rows)
    assert all(0 <= r.score <= 1 for r in scored) and all(0 <= r.expected_grade <= quality.GRADES - 1 for r in graded)


def test_full_sets_by_a_shuffle_equal_those_by_a_broadcast(odd, spark):
    ids = spark.createDataFrame([(i,) for i in (3, 5, 6, 7, 8, 100, 120, 999)], "node long")
    sets = [{(r.node, tuple(sorted(r.shingles))) for r in near_dedup.full_sets(odd, ids, 4, limit).collect()}
            for limit in (near_dedup.BROADCAST_IDS, 0)]
    assert sets[0] == sets[1] and {i for i, _ in sets[0]} == {3, 5, 6, 7, 8, 100, 120}


def write_tables(spark, path, docs, labels):
    docs.write.parquet(f"{path}/documents.parquet")
    labels.write.parquet(f"{path}/labels.parquet")
    return str(path)


def check_sequences(rows):
    filled = {}
    for r in rows:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 2048


def test_the_whole_pipeline_on_odd_rows(spark, odd, odd_rows, tmp_path):
    """Odd rows with clashing columns beside the small table: each keeps or loses its rows as the stages' rules say."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    moved = odd.withColumn("doc_id", F.col("doc_id") + 10**6)
    sf = write_tables(spark, tmp_path, docs.unionByName(moved, allowMissingColumns=True),
                      spark.read.parquet(f"{SF}/labels.parquet"))
    rows = corpus_pipeline.run(spark, sf).collect()
    check_sequences(rows)
    every = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    good = {r.doc_id for r in quality.score(spark.read.parquet(f"{sf}/documents.parquet"), quality.train(
        spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))).where("kept").collect()}
    left = {i: t for i, t in every if i in good and i is not None}
    left = {i: left[i] for i, x in brute.exact_dedup(left.items()).items() if x[2]}
    left = {i for i, x in brute.near_dedup(left.items(), 5).items() if x[2]}
    assert {r.doc_id for r in rows if r.doc_id is not None} == left and len(left) > 50


def test_the_whole_pipeline_on_empty_tables(spark, tmp_path):
    sf = write_tables(spark, tmp_path, spark.createDataFrame([], ODD), spark.read.parquet(f"{SF}/labels.parquet"))
    assert corpus_pipeline.run(spark, sf).collect() == []
