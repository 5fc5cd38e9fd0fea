"""Local parts of the operators: automata, suffix ranks, packing, tests of randomness, models."""

import random
import re
import tempfile
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from corpus_rows import SF, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sensorflow.llm import bpe, common, hashed_text, packing, phrase_dedup, quality, ragged, repetition, secret_scan, toxicity
from sensorflow.llm.components import components

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
LIBRARY = {path: Tokenizer.from_file(path) for path in (BYTE, WORD)}
TEXT = st.text(max_size=60) | st.lists(st.sampled_from(
    ["a", "the", " ", "  ", "\n", "'s", "'", "é", "<|endoftext|>", "<|", "12", "\x85", "\x1c", "　", "中", "😀", "!!",
     "anthered" * 12, "x" * 90]), max_size=30).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=4))
def test_encoders_equal_the_library(texts):
    for path, encode in ((BYTE, bpe.Encoder(BYTE, None).encode), (WORD, packing.word_encoder(WORD).encode)):
        want = [np.array(e.ids, "<u4").tobytes()
                for e in LIBRARY[path].encode_batch(texts, add_special_tokens=False)] if texts else []
        assert encode(texts) == want
    for t in texts:
        ids = np.frombuffer(bpe.Encoder(BYTE, None).encode([t])[0], "<u4").tolist()
        assert bpe.decode(BYTE, ids) == t


def test_encoders_equal_the_library_on_every_character():
    texts = [f"a{c}1 {c}b  {c}{c} \n{c}\t" for c in map(chr, [*range(0xD800), *range(0xE000, 0x11000), *range(0x1F000, 0x20000)])]
    for path, encode in ((BYTE, bpe.Encoder(BYTE, None).encode), (WORD, packing.word_encoder(WORD).encode)):
        want = LIBRARY[path].encode_batch(texts, add_special_tokens=False)
        assert encode(texts) == [np.array(e.ids, "<u4").tobytes() for e in want]


def test_encoders_equal_the_library_on_long_texts():
    rnd = random.Random(5)
    words = ["".join(rnd.choices("abdeghilnorstu'é1.", k=rnd.randint(1, 14))) for _ in range(40_000)]
    texts = ["x" * 20_000, " ".join(words), "", " " * 5000, "don't  it's\n\n 's ''ll", "中文" * 500 + "\u3000x", "a\xa0b"]
    for path, encode in ((BYTE, bpe.Encoder(BYTE, None).encode), (WORD, packing.word_encoder(WORD).encode)):
        want = LIBRARY[path].encode_batch(texts, add_special_tokens=False)
        assert encode(texts) == [np.array(e.ids, "<u4").tobytes() for e in want]


def test_encoders_take_nulls_and_slices_of_columns():
    column = pa.array(["before", "ab cd", None, "", "don't", "after"]).slice(1, 4)
    texts = ["ab cd", "", "", "don't"]
    assert packing.word_encoder(WORD).encode_column(column).to_pylist() == packing.word_encoder(WORD).encode(texts)
    coded = bpe.Encoder(BYTE, None).encode_column(column)
    assert bpe.decode_column(BYTE, *coded).to_pylist() == texts
    # a token that ends within a character
    half = np.array([bpe.vocabulary(BYTE).byte_ids[0xC3]], np.uint32)
    assert bpe.decode_column(BYTE, half, np.array([0, 1])).to_pylist() == ["\ufffd"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=80), max_size=30))
def test_merges_take_the_lowest_rank_leftmost(words):
    # "a", "b", "c" are 0 to 2; equal neighbours and overlapping pairs
    pairs, merged = [(0, 0), (0, 1), (3, 3), (4, 2), (1, 1), (2, 5)], [3, 4, 5, 6, 7, 8]
    data, offsets = ragged.flat(pa.array(words, pa.string()))
    ids, ends = ragged.Merges(pairs, merged)(data.astype(np.int64) - ord("a"), offsets)
    for word, a, b in zip(words, ends, ends[1:]):
        want = [ord(c) - ord("a") for c in word]
        while ranks := [(pairs.index(p), i) for i, p in enumerate(zip(want, want[1:])) if p in pairs]:
            rank, i = min(ranks)
            want[i:i + 2] = [merged[rank]]
        assert ids[a:b].tolist() == want


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.binary(min_size=1, max_size=6), st.lists(st.integers(0, 9), min_size=1, max_size=3), max_size=40),
       st.lists(st.binary(max_size=6), max_size=10))
def test_lexicon_holds_exactly_its_words(entries, others):
    with tempfile.NamedTemporaryFile() as f:
        f.write(bpe.compile_lexicon(entries))
        f.flush()
        lexicon = bpe.Lexicon(f.name)
        words = [*entries, *others]
        for w, p in zip(words, lexicon.places(words).tolist()):
            assert (p < 0) == (w not in entries)
            assert p < 0 or np.frombuffer(lexicon.ids_of(p), "<u4").tolist() == entries[w]


def test_lexicon_shares_suffixes():
    words = [a + b for a in (b"walk", b"talk", b"jump", b"help") for b in (b"", b"s", b"ed", b"ing", b"er")]
    with tempfile.NamedTemporaryFile() as f:
        f.write(bpe.compile_lexicon({w: [1] for w in words}))
        f.flush()
        # w/t share "alk", all four share one set of endings
        assert len(bpe.Lexicon(f.name).final) < 20


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=25), max_size=5))
def test_longest_repeats(texts):
    words = np.array([w for t in texts for w in t], np.int64)
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts]).astype(np.int64)
    want = []
    for t in texts:
        for i in range(len(t)):
            best = 0
            for j in range(len(t)):
                k = 0
                while j != i and max(i, j) + k < len(t) and t[i + k] == t[j + k]:
                    k += 1
                best = max(best, k)
            want.append(best)
    got = repetition.longest_repeats(words, doc)
    assert got.tolist() == want
    covered = np.zeros(len(words), bool)
    for i, n in enumerate(want):
        covered[i:i + n] |= n >= 3
    united = np.zeros(len(words), bool)
    for a, b in zip(*repetition.united_spans(got, doc, 3)):
        assert doc[a] == doc[b - 1] and not united[a:b].any()
        united[a:b] = True
    assert (united == covered).all()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 90), max_size=60), st.sampled_from([8, 16, 32]))
def test_pack_fills_every_sequence(lengths, capacity):
    pieces = packing.pack(np.array(lengths, np.int64), capacity)
    assert sum(p[2] for p in pieces) == sum(lengths)
    for d, n in enumerate(lengths):
        at = 0
        for _, start, length, _, _ in sorted(p for p in pieces if p[0] == d):
            assert start == at and length > 0
            at += length
        assert at == n
    fill = {}
    for _, _, length, s, offset in sorted(pieces, key=lambda p: (p[3], p[4])):
        assert offset == fill.get(s, 0)
        fill[s] = offset + length
    assert all(n == capacity or n & (n - 1) == 0 for n in fill.values()) and sorted(fill) == list(range(len(fill)))


def test_pack_balances_cost():
    rnd = random.Random(4)
    pieces = packing.pack(np.array([int(rnd.lognormvariate(5, 1)) + 1 for _ in range(4000)], np.int64))
    cost, size = {}, {}
    for _, _, n, s, _ in pieces:
        cost[s] = cost.get(s, 0) + packing.LINEAR * n + packing.QUADRATIC * n * n
        size[s] = size.get(s, 0) + n
    full = np.array([cost[s] for s in cost if size[s] == packing.CAPACITY])
    assert full.std() < 0.05 * full.mean()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=60), st.integers(1, 20))
def test_sliding_argmin(values, width):
    got = phrase_dedup.sliding_argmin(np.array(values), width) if len(values) >= width else []
    assert list(got) == [i + int(np.argmin(values[i:i + width])) for i in range(len(values) - width + 1)]


def test_components_of_random_graphs(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 440)] + [(5, 5)]
    label = {i: i for e in edges for i in e}
    for _ in range(500):
        for u, v in edges:
            label[u] = label[v] = min(label[u], label[v])
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: m for i, m in label.items() if i != m}


def test_randomness_battery():
    rnd = random.Random(8)
    noise = ["".join(rnd.choice("0123456789abcdef") for _ in range(n)) for n in (24, 32, 40, 64) for _ in range(50)]
    noise += ["".join(rnd.choice(secret_scan.ALNUM_SYMBOLS) for _ in range(40)) for _ in range(100)]
    assert np.mean([secret_scan.p_value(s) > 0.05 for s in noise]) > 0.93
    plain = ["abcabcabcabc123123123123", "aaaaaaaaaaaa1111111111111111", "0123456789abcdef0123456789abcdef",
             "abababababab1212121212121212", "1" * 20 + "a" * 20]
    assert all(secret_scan.p_value(s) < 0.05 for s in plain)
    assert secret_scan.upper_gamma(2.5, 2.5) == pytest.approx(0.41588, abs=1e-4)
    assert secret_scan.upper_gamma(5, 20) == pytest.approx(1.6945e-5, rel=1e-3)


def test_random_strings_are_found_and_regular_ones_not(make_docs):
    rnd = random.Random(9)
    key = lambda n: "".join(rnd.choice(secret_scan.ALNUM_SYMBOLS) for _ in range(n))
    rows = [(k, f"the key {key(40)} here", "s") for k in range(30)]
    rows += [(100 + k, f"serial {'xy12' * (6 + k % 5)} and words", "s") for k in range(60)]
    got = {r.doc_id: r.spans for r in secret_scan.find_secrets(make_docs(rows)).collect()}
    found = [bool(got[k]) for k in range(30)]
    assert sum(found) >= 27 and not any(got[100 + k] for k in range(60))
    assert all((s.kind, s.start, s.end) == ("random", 8, 48) for k in range(30) for s in got[k])


def test_random_strings_of_all_encodings_and_lengths_are_found(make_docs):
    """Keys without digits, or with few, and keys that separators join to other words."""
    rnd = random.Random(12)
    base64, letters = secret_scan.BASE64_SYMBOLS + "+/", secret_scan.BASE64_SYMBOLS[:52]
    kinds = {"base64": base64, "url": secret_scan.BASE64_SYMBOLS + "-_", "base32": secret_scan.BASE32_SYMBOLS,
             "alnum": secret_scan.ALNUM_SYMBOLS, "letters": letters, "small": letters[26:], "digits": "0123456789"}
    key = lambda kind, n: "".join(rnd.choice(kinds[kind]) for _ in range(n))
    planted = [(kind, f"the key {key(kind, n)}{'=' * (n == 43)} here") for kind in kinds for n in (20, 24, 32, 43, 64) for _ in range(20)]
    path = "/how/to/keep/things/and/where/to/find/them/again/some/day/"
    planted += [("joined", f"the key {path}{key('alnum', 40)}/edit-the-other-page-of-this-long-list here") for _ in range(40)]
    regular = ["serial " + "xy12" * (6 + k % 5) for k in range(200)] + ["-" * 40, "_" * 30, path, "state-of-the-art-of-words",
                                                                       "under_the_old_oak_tree_by_day"]
    regular += ["Aa1/Bb2-Cc3_Dd4+Ee5/Ff6-Gg7"]  # signs of two encodings
    rows = [(k, t, "s") for k, (_, t) in enumerate(planted)] + [(10_000 + k, t, "s") for k, t in enumerate(regular)]
    got = {r.doc_id: [s for s in r.spans if s.kind == "random"] for r in secret_scan.find_secrets(make_docs(rows)).collect()}
    clean = {r.doc_id: r.text for r in secret_scan.redact(make_docs(rows)).collect()}
    found = {}
    for k, (kind, t) in enumerate(planted):
        word = t.split()[2]
        want = (8, 8 + len(word)) if kind != "joined" else (8 + len(path), 8 + len(path) + 40)
        base = secret_scan.base_spans(t)
        found.setdefault(kind, []).append(bool(base) or any((s.start, s.end) == want for s in got[k]))
        assert bool(base) or (clean[k] != t) == bool(got[k])
        assert all(not (a.start <= b.start and b.end <= a.end) for a in got[k] for b in got[k] if a is not b)
    assert all(np.mean(f) >= 0.9 for f in found.values()), {k: np.mean(f) for k, f in found.items()}
    assert not any(got[10_000 + k] for k in range(len(regular)))


def test_toxicity_ignores_who_is_named():
    """A group named mostly in toxic sentences: the penalty takes its weight away."""
    rnd = random.Random(3)
    texts, labels = [], []
    for k in range(600):
        toxic = k % 3 == 0
        named = rnd.random() < (0.7 if toxic else 0.1)
        texts.append(f"{prose(k, 30, 300)} {'idiot scum' if toxic and rnd.random() < 0.8 else ''} {'muslims' if named else ''}")
        labels.append(int(toxic))
    found = [toxicity.features(t) for t in texts]
    data = (np.repeat(np.arange(600), [len(f) for f in found]), np.array([c for f in found for c in f]),
            np.array([v for f in found for v in f.values()]), np.array(labels), 600)
    free, bound = toxicity.fit(*data, counterfactual=0.0), toxicity.fit(*data, counterfactual=20.0)
    logit = lambda m, t: m.intercept + sum(m.weights[c] for c in toxicity.features(t))
    neutral = "we met muslims and people today"
    gap = lambda m: abs(logit(m, neutral) - logit(m, neutral.replace("muslims", "persons")))
    assert gap(free) > 0.5 and gap(bound) < 0.25 * gap(free)
    assert hashed_text.sigmoid(logit(bound, "you idiot scum")) > 0.7 > hashed_text.sigmoid(logit(bound, neutral))


def test_copies_change_all_features_of_a_term():
    """The swap's entries are the difference of the two texts' features, stems and shared stems included."""
    for text in ("the muslims went home", "muslims in a museum met christians", "immigrants, men and immigration", "persons"):
        got = {}
        for c, v in toxicity.with_copies(text).items():
            got.setdefault(c >> toxicity.LG_FEATURES, {})[c & (1 << toxicity.LG_FEATURES) - 1] = v
        assert got.pop(0) == toxicity.features(text)
        words, expected = toxicity.words_of(text), []
        for term in toxicity.IDENTITY_TERMS:
            for other in toxicity.IDENTITY_TERMS:
                if term in words and other != term:
                    a, b = toxicity.features(text), toxicity.features(" ".join(words - {term} | {other}))
                    expected.append({c: 1.0 for c in a.keys() - b.keys()} | {c: -1.0 for c in b.keys() - a.keys()})
        assert got and all(c in expected for c in got.values())


@pytest.mark.parametrize("term", ["muslims", "immigrants", "jews", "gay"])
def test_penalty_as_used_holds_for_terms_with_stems(make_docs, spark, term):
    rnd = random.Random(4)
    rows, labels = [], []
    for k in range(900):
        toxic = k % 3 == 0
        named = rnd.random() < (0.7 if toxic else 0.1)
        rows.append((k, f"{prose(k, 30, 300)} {'idiot scum' if toxic and rnd.random() < 0.8 else ''} {term if named else ''}", "s"))
        labels.append((k, 1, int(toxic)))
    docs, labels = make_docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    logit = lambda m, t: m.intercept + sum(m.weights[c] for c in toxicity.features(t))
    gap = lambda m: abs(logit(m, f"we met {term} today") - logit(m, "we met persons today"))
    free, bound = toxicity.train(docs, labels, counterfactual=0.0), toxicity.train(docs, labels)
    assert gap(free) > 0.5 and gap(bound) < 0.25 * gap(free)


def test_ordinal_regression_orders_thresholds():
    rnd = np.random.default_rng(2)
    n = 1500
    latent = rnd.normal(size=n) * 2
    grades = np.digitize(latent + rnd.logistic(size=n) * 0.3, [-1.0, 0.5, 2.0])
    model = quality.fit(np.arange(n), np.zeros(n, int), latent, grades, n, n_grades=4, l2=0.0)
    assert (np.diff(model.thresholds) > 0).all()
    expected = model.tails(model.weights[0] * latent).sum(axis=1)
    assert np.corrcoef(expected, grades)[0, 1] > 0.9


def test_classifiers_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    known = {r.doc_id: r for r in labels.collect()}
    held = [r for r in quality.score(docs, quality.train(docs, labels)).collect() if r.held_out and r.doc_id in known]
    assert len(held) > 80 and np.mean([r.kept == (known[r.doc_id].quality == 1) for r in held]) > 0.95
    held = [r for r in toxicity.score(docs, toxicity.train(docs, labels)).collect() if r.held_out and r.doc_id in known]
    hit = np.array([r.score for r in held if known[r.doc_id].toxic == 1])
    rest = np.array([r.score for r in held if known[r.doc_id].toxic == 0])
    assert (hit[:, None] > rest[None, :]).mean() > 0.85


def test_pipeline_against_brute_force(spark):
    import brute

    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    now, kept = docs, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        now = spark.createDataFrame(stage(spark, now, SF).collect(), docs.schema)
        kept = {r.doc_id: r.text for r in now.collect()}
        assert now.columns == docs.columns and set(kept) <= set(before)
        if name == "exact_dedup":
            assert set(kept) == {i for i, x in brute.exact_dedup(before.items()).items() if x[2]}
        if name == "near_dedup":
            assert set(kept) == {i for i, x in brute.near_dedup(before.items(), 5).items() if x[2]}
        if name == "secrets":
            assert set(kept) == set(before) and not any(brute.secret_spans(t) for t in kept.values())
            assert all(r.n_chars == len(r.text) for r in now.collect())
    t = LIBRARY[WORD]
    pieces = corpus_pipeline.STAGES[-1][1](spark, now, SF).collect()
    tokens = {}
    for r in pieces:
        tokens[r.doc_id] = tokens.get(r.doc_id, 0) + r.length
    assert tokens == {i: len(t.encode(x, add_special_tokens=False).ids) + 1 for i, x in kept.items()}


def test_words_in_letters_only_are_no_secrets(spark):
    """Of the given documents no ordinary word is reported; random letters put among them are, of 20 letters already."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rnd = random.Random(7)
    keys = ["".join(rnd.choice(secret_scan.LETTER_SYMBOLS[26:]) for _ in range(n)) for n in (20, 24, 32, 40) for _ in range(50)]
    planted = spark.createDataFrame([(10**6 + i, f"the word {k} of it") for i, k in enumerate(keys)], "doc_id long, text string")
    found = secret_scan.find_secrets(docs.select("doc_id", "text").unionAll(planted))
    hits = [r.doc_id for r in found.where("exists(spans, s -> s.kind = 'random')").collect()]
    assert sum(i >= 10**6 for i in hits) >= 0.9 * len(keys)
    spans = (found.where("doc_id < 1000000").join(docs.select("doc_id", "text"), "doc_id")
             .selectExpr("inline(transform(filter(spans, s -> s.kind = 'random'), s -> named_struct('x', substring(text, int(s.start + 1), "
                         "int(s.end - s.start)))))").collect())
    assert [r.x for r in spans if r.x.isalpha()] == []


def test_spans_are_merged_in_one_sweep():
    last = dict.fromkeys(range(len(secret_scan.LENGTH_CLASSES)), -1)
    found = [(0, 60, 0.5), (0, 30, 0.5), (35, 60, 0.5), (40, 70, 0.5), (100, 130, 0.0), (200, 230, 0.9), (201, 230, 0.9)]
    assert secret_scan.merged([(195, "hex", 229), (0, "assign", 25)], found, last) == [
        (0, "assign", 25), (0, "random", 60), (40, "random", 70), (195, "hex", 229), (200, "random", 230)]
    many = [(30 * i, 30 * i + 25, 0.5) for i in range(200_000)]
    assert len(secret_scan.merged([], many, last)) == 200_000


def test_a_slice_of_the_packing_encoder_takes_little_memory():
    rnd = random.Random(5)
    words = ["".join(rnd.choices("abcdefghij", k=rnd.randint(2, 9))) for _ in range(5000)]
    texts = [" ".join(rnd.choices(words, k=400)) for _ in range(3000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    encoder = packing.word_encoder(WORD)
    wanted = encoder.encode(texts[:3])
    tracemalloc.start()
    try:
        got = [encoder.encode_column(piece.column("text")).slice(0, 3).to_pylist()
               for piece in common.slices(iter([batch]), max_bytes=packing.WORD_BYTES)]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert got[0] == wanted and len(got) > 1
    assert peak < 50e6


@given(st.lists(st.lists(st.booleans(), max_size=6), max_size=12))
def test_any_in_tells_members_with_a_marked_place(members):
    mask = np.array([x for m in members for x in m], bool)
    offsets = np.concatenate([[0], np.cumsum([len(m) for m in members])]).astype(np.int64)
    assert ragged.any_in(mask, offsets).tolist() == [any(m) for m in members]


def test_letter_pairs_are_counted_in_blocks_that_cut_no_word():

    rng = random.Random(3)
    words = ["".join(rng.choices("abcxyz-7\n", k=rng.randint(1, 30))) for _ in range(70_000)]
    text = " ".join(words)
    raw = text.encode() + b" "
    assert len(raw) > 4 * secret_scan.PAIR_BYTES
    tracemalloc.start()
    got = sum(secret_scan.pair_counts(b) for b in secret_scan.blocks(raw))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 * secret_scan.PAIR_BYTES < 15 * len(raw)
    runs = [w for w in re.findall("[a-z]+", text) if len(w) < secret_scan.MIN_CHARS]
    want = Counter((ord(a) - 97) * 26 + ord(b) - 97 for w in runs for a, b in zip(w, w[1:]))
    assert {int(k): int(got[k]) for k in got.nonzero()[0]} == dict(want)
    # a part ends at the first space at or after its size
    assert [bytes(b) for b in secret_scan.blocks(b"ab cd efgh i ", 4)] == [b"ab cd ", b"efgh ", b"i "]
