"""Each operator against brute force on generated documents and on odd rows; empty tables."""

import zlib
from collections import Counter

import brute
import duckdb
import numpy as np
import public_tokenizers
import pytest
from corpus_rows import SF
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sensorflow.llm import (bpe, exact_dedup, line_dedup, near_dedup, packing, phrase_dedup, quality, repetition, secret_scan,
                            toxicity)

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def small_rows(small):
    return [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]


def test_bpe_odd_rows(odd, odd_rows):
    t = Tokenizer.from_file(BYTE)
    want = Counter()
    for i, text, _ in odd_rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        want[i, len(ids), brute.sha(np.array(ids, "<u4").tobytes()), brute.sha(t.decode(ids, skip_special_tokens=False))] += 1
    for lexicon_words in (0, 5, 50_000):
        got = bpe.with_digests(bpe.bpe_round_trip(odd, BYTE, lexicon_words)).collect()
        assert Counter(map(tuple, got)) == want


def test_exact_dedup_odd_rows(odd, odd_rows):
    by_text = {}
    for i, t, _ in odd_rows:
        by_text.setdefault(brute.SPACE.sub(" ", t or ""), []).append(i)
    want = Counter()
    for norm, ids in by_text.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        for i in ids:
            want[i, keep, len(ids), i == keep, brute.sha(norm)] += 1
    for broadcast_keys in (exact_dedup.BROADCAST_KEYS, 0):
        assert Counter(map(tuple, exact_dedup.dedup_decisions(odd, broadcast_keys).collect())) == want
    left = exact_dedup.drop_copies(odd)
    assert left.columns == odd.columns
    kept = [(r.doc_id, brute.SPACE.sub(" ", r.text or "")) for r in left.collect()]
    assert sorted(map(str, kept)) == sorted(str((min([i for i in ids if i is not None], default=None), norm))
                                            for norm, ids in by_text.items())


def test_drop_copies_hashes_only_surviving_groups(odd, odd_rows):
    """A row alone with its length and prefix gets no full hash, whether the keys are broadcast or shuffled."""
    level = lambda t: (len(t), t[:exact_dedup.PREFIX_CHARS])
    norms = [brute.SPACE.sub(" ", t or "") for _, t, _ in odd_rows]
    again = {k for k, n in Counter(map(level, norms)).items() if n > 1}
    want = Counter(brute.sha(n) if level(n) in again else None for n in norms)
    assert want[None] > 20 and len(want) > 1
    shared, plain = exact_dedup.surviving_keys(odd), Counter(map(str, exact_dedup.drop_copies(odd).select("doc_id", "text").collect()))
    for broadcast_keys in (exact_dedup.BROADCAST_KEYS, 0):
        got = [r._hash for r in exact_dedup.refined(odd, shared, broadcast_keys).select("_hash").collect()]
        assert Counter(h if len(h) == 64 else None for h in got) == want
        assert len({h for h in got if len(h) < 64}) == want[None]
        assert Counter(map(str, exact_dedup.drop_copies(odd, broadcast_keys).select("doc_id", "text").collect())) == plain


def test_near_dedup_matches_brute_force(odd, odd_rows, small, small_rows):
    for docs, rows in ((odd.where("doc_id is not null"), [(i, t) for i, t, _ in odd_rows if i is not None]), (small, small_rows)):
        want = brute.near_dedup(rows)
        got = near_dedup.near_duplicates(docs, shingle_words=4).collect()
        assert len(got) == len(rows)
        assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == want
        left = near_dedup.drop_near_copies(docs, shingle_words=4)
        assert left.columns == docs.columns
        assert {r.doc_id for r in left.collect()} == {i for i, x in want.items() if x[2]}


def test_near_dedup_long_lists_in_rounds(make_docs, monkeypatch):
    """Chains and clusters that one pivot does not connect; lists longer than the short limit."""
    import random
    monkeypatch.setattr(near_dedup, "SHORT_LIST", 2)
    rnd, rows = random.Random(2), []
    for c in range(3):
        text = [f"c{c}w{k}" for k in range(80)]
        for k in range(25):
            rows.append((1000 * c + k, " ".join(text), "s"))
            for _ in range(rnd.randrange(1, 3)):
                text[rnd.randrange(80)] = f"n{rnd.randrange(10**6)}"
    got = near_dedup.near_duplicates(make_docs(rows), shingle_words=2).collect()
    want = brute.near_dedup([(i, t) for i, t, _ in rows], n=2)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == want


def test_near_dedup_at_lower_percent(make_docs):
    """Subsets at exactly 0.6 and 0.5, which hold far less than half of the sketch in common."""
    import random
    rnd = random.Random(6)
    for percent in (60, 50):
        rows = []
        for c in range(120):
            words = [f"p{c}w{k}" for k in range(300)]
            rnd.shuffle(words)
            rows += [(2 * c, " ".join(words), "s"), (2 * c + 1, " ".join(words[:3 * percent]), "s")]
        got = near_dedup.near_duplicates(make_docs(rows), shingle_words=1, percent=percent).collect()
        want = brute.near_dedup([(i, t) for i, t, _ in rows], n=1, percent=percent)
        assert sum(x[2] for x in want.values()) == 120
        assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == want
    for percent in (20, 0, 101):
        with pytest.raises(ValueError):
            near_dedup.near_duplicates(make_docs(rows[:2]), percent=percent)


def test_near_dedup_rows_without_id(odd):
    got = near_dedup.near_duplicates(odd, shingle_words=4).where("doc_id is null").collect()
    assert Counter((r.component_id, r.kept) for r in got) == Counter({(None, True): 2, (5, False): 1})


def test_phrase_dedup_matches_brute_force(odd, odd_rows, small, small_rows):
    count = brute.repeated_windows([(k, t) for k, (_, t, _) in enumerate(odd_rows)])
    want = Counter((odd_rows[k][0], *x) for k, x in count.items())
    got = phrase_dedup.drop_repeated(odd).select("doc_id", "n_words", "n_removed", F.sha2("text", 256)).collect()
    assert Counter(map(tuple, got)) == want and sum(x[1] for x in count.values()) > 200
    got = phrase_dedup.drop_repeated(small, lg_bits=15).select("doc_id", "n_words", "n_removed", F.sha2("text", 256)).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == brute.repeated_windows(small_rows)


def test_repetition_matches_brute_force(odd, odd_rows):
    got = repetition.with_verdict(repetition.repetition(odd)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter((r.doc_id, *(r[n] for n in names)) for r in got) == Counter(
        (i, *brute.repetition_base(t)) for i, t, _ in odd_rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[10].longest_repeat == 399 and not by_id[10].kept
    assert [(s.start, s.end) for s in by_id[10].repeats] == [(0, 400)] and by_id[10].covered_chars == 400
    assert not by_id[3].kept and by_id[3].repeats == [] and by_id[100].kept


def test_secrets_match_patterns(odd, odd_rows):
    got = secret_scan.with_digests(secret_scan.find_secrets(odd)).collect()
    want = Counter()
    for i, t, _ in odd_rows:
        spans = brute.secret_spans(t)
        want[(i, *(sum(k == kind for k, _, _ in spans) for kind in ("assign", "access", "hex")),
              brute.sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans)))] += 1
    assert Counter(tuple(r)[:5] for r in got) == want
    clean = secret_scan.redact(odd)
    assert clean.columns == odd.columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[13] == "<SECRET>\" and <SECRET> pwd" and texts[0] is None
    assert texts[14] == "<SECRET>' secret=short token=xy <SECRET>"


def test_packing_matches_tokenizer(odd, odd_rows):
    t = Tokenizer.from_file(WORD)
    rows = packing.with_crc32(packing.pack_documents(odd, WORD, shard_chars=9000)).collect()
    check_packing(rows, Counter((i, *t.encode(x or "", add_special_tokens=False).ids, 1) for i, x, _ in odd_rows))


def test_repeated_rows_meet_in_no_single_group(make_docs):
    """Many rows of one id and text: spread over the shards, and one list of windows for all of them."""
    from corpus_rows import prose
    text = prose(21, 120)
    docs = make_docs([(7, text, "s")] * 200 + [(k, prose(k, 120), "s") for k in range(100, 140)]).repartition(3)
    rows = packing.with_crc32(packing.pack_documents(docs, WORD, shard_chars=len(text) * 10)).collect()
    t = Tokenizer.from_file(WORD)
    check_packing(rows, Counter((i, *t.encode(x, add_special_tokens=False).ids, 1) for i, x in docs.select("doc_id", "text").collect()))
    per_shard = Counter(r.sequence_id >> 32 for r in rows if r.doc_id == 7 and r.start == 0)
    assert sum(per_shard.values()) == 200 and max(per_shard.values()) < 50
    with_content = docs.select("doc_id", "text", F.xxhash64("text").alias("content"))
    spans = phrase_dedup.repeated_spans(with_content, phrase_dedup.WINDOW, phrase_dedup.PHRASE, 15).collect()
    assert len(spans) == 1 and 0 < len(spans[0].starts) == len({s.start for s in spans[0].starts})
    assert {(r.doc_id, r.n_removed) for r in phrase_dedup.drop_repeated(docs, lg_bits=15).collect()} == (
        {(7, 120)} | {(k, 0) for k in range(100, 140)})


def check_packing(rows, documents):
    seqs, firsts = {}, {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
        firsts.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for pieces in seqs.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at == packing.CAPACITY or at & (at - 1) == 0 and at < packing.CAPACITY
    assert sum(r.length for r in rows) == sum((len(d) - 1) * k for d, k in documents.items())
    for (i, *ids), k in documents.items():
        for p in firsts[i, len(ids)]:
            # pieces of equal length documents under one id are told apart by their ids
            crc = {zlib.crc32(np.array(d[1:][p.start:p.start + p.length], "<u4").tobytes()) for d in documents
                   if d[0] == i and len(d) - 1 == len(ids)}
            assert p.ids_crc32 in crc


def test_line_dedup_matches_sql(spark, odd_rows, odd):
    con = duckdb.connect()
    rows = odd_rows
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [r for r in rows if r[0] not in (None, 7)])
    want = Counter(map(tuple, con.sql("SELECT doc_id, n_lines, n_removed, kept_sha256 FROM (" + line_dedup.ORACLE + ")").fetchall()))
    docs = odd.where("doc_id is not null and doc_id != 7")
    got = line_dedup.drop_boilerplate(docs).select("doc_id", "n_lines", "n_removed", F.sha2("text", 256)).collect()
    assert Counter(map(tuple, got)) == want and sum(r[2] for r in got) >= 26
    assert line_dedup.drop_boilerplate(odd).count() == len(rows)


def test_line_dedup_counts_near_lines_exactly(make_docs):
    """All lines of 8 to 12 sites around a threshold of 10, each many times over."""
    rows = [(1000 * n + k, f"line at {n} sites\nown {n} {k}", f"s{k % n}") for n in range(6, 15) for k in range(60)]
    got = line_dedup.drop_boilerplate(make_docs(rows)).collect()
    assert all(r.n_removed == (r.doc_id // 1000 >= 10) for r in got)


def test_line_dedup_plan_is_native(odd):
    plan = line_dedup.drop_boilerplate(odd)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_empty_tables(none, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    frames = [bpe.bpe_round_trip(none, BYTE), exact_dedup.dedup_decisions(none), exact_dedup.drop_copies(none),
              near_dedup.near_duplicates(none), near_dedup.drop_near_copies(none), phrase_dedup.drop_repeated(none),
              repetition.repetition(none), secret_scan.find_secrets(none), secret_scan.redact(none),
              packing.pack_documents(none, WORD), line_dedup.drop_boilerplate(none),
              quality.score(none, quality.train(none, labels)), quality.keep_good(none, quality.train(none, labels)),
              toxicity.score(none, toxicity.train(none, labels))]
    assert [f.count() for f in frames] == [0] * len(frames)


def test_classifiers_on_odd_rows(odd, odd_rows, spark):
    labels = spark.createDataFrame([(i, k % 2, None if k % 5 == 0 else k % 3 % 2) for k, (i, _, _) in enumerate(odd_rows)]
                                   + [(10**9, 1, 1), (None, 0, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    for rows in (quality.score(odd, quality.train(odd, labels)).collect(), toxicity.score(odd, toxicity.train(odd, labels)).collect()):
        assert Counter(r.doc_id for r in rows) == Counter(i for i, _, _ in odd_rows)
        assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    kept = quality.keep_good(odd, quality.train(odd, labels))
    assert kept.columns == odd.columns


@pytest.mark.parametrize("name", ["op3_suffix_repetition", "op8_phrase_automata", "op9_bottom_k_near_dedup"])
def test_queries_match_sql(spark, odd_rows, name, tmp_path):
    """The query and its DuckDB twin on the small table, with odd rows of unique ids beside them."""
    from sensorflow.llm.queries import llm_oracles, llm_registry
    rows = [(10**6 + k, t) for k, (_, t, _) in enumerate(odd_rows)]
    (spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
     .unionAll(spark.createDataFrame(rows, "doc_id long, text string")).write.parquet(f"{tmp_path}/documents.parquet"))
    got = llm_registry()[name](spark, str(tmp_path))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.sql(llm_oracles()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert Counter(map(tuple, got.select(*want.columns).collect())) == Counter(want.fetchall())
