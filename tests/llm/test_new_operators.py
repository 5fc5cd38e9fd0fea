"""Multi-index, tokenizer alignment and prefix trie against brute force; odd rows, empty tables."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from corpus_rows import SF
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorflow.llm import alignment, multi_index, prefix_trie

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# --- nearest neighbours

def exact_neighbours(rows, k, is_query):
    """rows: (vec_id, vector); all rows with one id are one item."""
    def ok(i, v):
        return i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    rows = [(i, np.array(v, float)) for i, v in rows if ok(i, v)]
    dims = max(Counter(len(v) for _, v in rows).items(), key=lambda x: (x[1], x[0]))[0] if rows else 0
    rows = [(i, v) for i, v in rows if len(v) == dims]
    out = {}
    for q in {i for i, _ in rows if is_query(i)}:
        best: dict[int, float] = {}
        for _, x in (r for r in rows if r[0] == q):
            for i, v in rows:
                if i != q:
                    best[i] = min(best.get(i, math.inf), float(np.sqrt(((v - x) ** 2).sum())))
        out[q] = sorted((d, i) for i, d in best.items())[:k]
    return {q: r for q, r in out.items() if r}


def found(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        assert r["rank"] == len(out[r.query_id]) + 1
        out[r.query_id].append((r.score, r.vec_id))
    return dict(out)


def test_neighbours_of_whole_table_are_exact_if_all_cells_are_visited(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).round(1).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]  # copies of one vector, a query among them
    rows += [(5, rows[5][1]), (6, rows[8][1]), (None, rows[1][1]), (2000, None), (2100, []), (2200, [0.0] * 6), (2300, [1.0] * 5 + [None]),
             (2400, [math.nan] * 6), (2500, [math.inf] * 6), (2600, [1.0, 2.0]), (-10, [1e200] * 6), (2700, [-1e200] * 6), (2710, [-0.0] * 5 + [1.0])]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<double>, label int, vector string").repartition(3)
    for part_rows in (1 << 16, 20):
        monkeypatch.setattr(multi_index, "PART_ROWS", part_rows)
        got = found(multi_index.neighbours(df, F.col("vec_id") % 10 == 0, 10, target=1, centroids=7))
        want = exact_neighbours(rows, 10, lambda i: i % 10 == 0)
        assert got.keys() == want.keys()
        for q in want:
            assert [i for _, i in got[q]] == [i for _, i in want[q]]
            assert np.allclose([d for d, _ in got[q]], [d for d, _ in want[q]], rtol=1e-12)


def test_few_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    query = F.col("vec_id") % 100 == 0
    assert multi_index.neighbours(spark.createDataFrame([], schema), query).collect() == []
    assert multi_index.neighbours(spark.createDataFrame([(0, [1.0, 2.0])], schema), query).collect() == []
    some = spark.createDataFrame([(0, [1.0]), (100, [4.0]), (7, [1.0])], schema)
    assert found(multi_index.neighbours(some, query)) == {0: [(0.0, 7), (3.0, 100)], 100: [(3.0, 0), (3.0, 7)]}


def test_recall_on_the_given_vectors(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = found(multi_index.neighbours(df, F.col("vec_id") % 100 == 0, 10))
    want = exact_neighbours([(r.vec_id, r.embedding) for r in df.collect()], 10, lambda i: i % 100 == 0)
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values())) and all(len(got[q]) == 10 for q in want)
    assert all(abs(d - dict((i, d) for d, i in want[q]).get(i, d)) < 1e-12 for q in want for d, i in got[q])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 20), min_size=1, max_size=6), st.lists(st.integers(0, 20), min_size=1, max_size=6), st.integers(1, 40))
def test_walk_takes_pairs_in_order(left, right, target):
    left, right = np.array(left, float), np.array(right, float)
    counts = np.arange(len(left) * len(right)) % 3
    cells = multi_index.walk(left, right, counts, target)
    sums = [left[c // len(right)] + right[c % len(right)] for c in cells]
    assert len(set(cells)) == len(cells) and sums == sorted(sums)
    everything = np.sort((left[:, None] + right[None, :]).ravel())
    assert sums == everything[:len(cells)].tolist()
    assert counts[cells].sum() >= target or len(cells) == len(counts)
    assert counts[cells[:-1]].sum() < target


# --- alignment

def aligned_by_force(tool, text):
    """``A ids, B ids, groups, pairs`` from whole-text encodings and decoded bytes."""
    whole = " " + (text or "")
    a, b = tool.a.encode(whole, add_special_tokens=False).ids, tool.b.encode(text or "")
    pa_, pb = [tool.a_bytes[i] for i in a], [tool.b_bytes[i] for i in b]
    if not text or b"".join(pa_) != whole.encode() or b"".join(pb) != whole.encode():
        return None
    ends_a, ends_b = np.cumsum([len(x) for x in pa_]).tolist(), np.cumsum([len(x) for x in pb]).tolist()
    groups, pairs, i, j, x, y = [], [], 0, 0, 0, 0
    while i < len(a):
        pairs.append((a[i], b[j]))
        step_a, step_b = ends_a[i] <= ends_b[j], ends_b[j] <= ends_a[i]
        i, j = i + step_a, j + step_b
        if step_a and step_b:
            groups.append(",".join(map(str, a[x:i])) + "|" + ",".join(map(str, b[y:j])))
            x, y = i, j
    return a, b, groups, pairs


def links_by_force(rows):
    tool = alignment.aligner(A, B)
    found = [(i, aligned_by_force(tool, t)) for i, t in rows]
    n = Counter(p for _, f in found if f for p in set(f[3]))
    best = defaultdict(int)
    for (a, _), k in n.items():
        best[a] = max(best[a], k)
    out = Counter()
    for i, f in found:
        if f is None:
            out[i, 0, 0, 0, 0, 0, 0, ""] += 1
        else:
            out[i, len(f[0]), len(f[1]), len(f[2]), len(f[3]), sum(n[p] == best[p[0]] for p in f[3]), sum(n[p] for p in f[3]),
                hashlib.sha256(";".join(f[2]).encode()).hexdigest()] += 1
    return out


def test_links_of_odd_rows(odd, odd_rows, none):
    rows = [(i, t) for i, t, _ in odd_rows]
    want = links_by_force(rows)
    for table_pairs in (0, 40, 1 << 18):
        assert Counter(map(tuple, alignment.link_counts(odd, A, B, table_pairs).collect())) == want
    assert alignment.link_counts(none, A, B).collect() == []


def test_links_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = links_by_force([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert Counter(map(tuple, alignment.link_counts(docs, A, B, 500).collect())) == want


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a", "the", " ", "  ", "\n", "\n\n", "'s", "é", "<|endoftext|>", "12", "\x85", "\x1c", "　", "中", "😀", ",", ".",
                                 "². ", "▁", "\t", "\r", ";\r", "<0x0A>", "Ünï", "日本語", "\x00", "word,", "end.", "x" * 70]), max_size=10).map("".join))
def test_pieces_align_like_the_whole_text(text):
    tool = alignment.aligner(A, B)
    pieces = tool.pieces(text)
    assert "".join(pieces) == (" " + text if text else "")
    entries = [tool.aligned(pieces)[p] for p in pieces]
    want = aligned_by_force(tool, text)
    if want is None:
        assert not pieces or None in entries
    else:
        assert ";".join(e[3] for e in entries) == ";".join(want[2])
        assert [divmod(v, alignment.B_IDS) for e in entries for v in np.frombuffer(e[4], np.int64).tolist()] == want[3]
        assert [sum(e[k] for e in entries) for k in range(3)] == [len(want[0]), len(want[1]), len(want[2])]


def test_vocabularies_across_cuts_get_whole_texts():
    tool = alignment.Aligner(A, B)
    assert tool.cuts and alignment.ACROSS.search("a▁b") and alignment.ACROSS.search("a,") and not alignment.ACROSS.search("▁▁a")
    cut = [tool.aligned([p])[p] for p in tool.pieces("two words, here")]
    tool.cuts = False
    assert tool.pieces("two words, here") == [" two words, here"]
    whole = tool.aligned([" two words, here"])[" two words, here"]
    assert whole[3] == ";".join(e[3] for e in cut) and whole[4] == b"".join(e[4] for e in cut)


# --- prefix trie

def trie_by_force(rows):
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, x) for *_, r, x in sorted(v, key=lambda x: x[:2])] for c, v in by.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:]
    members, below = defaultdict(list), defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        if node:
            below[node[:-1]].append(node)
        leaves[node] = sum(leaves[x] for x in below[node]) or 1
        saved[node] = (len(members[node]) - 1) * len(node[-1][1].encode() if node else b"") + sum(saved[x] for x in below[node])
    return Counter((m[0], len(n), members[n[:-1]][0] if n else None, len(m), len(below[n]), leaves[n], saved[n], hashlib.sha256(
        ",".join(str(c) for c in m if len(built[c]) == len(n)).encode()).hexdigest()) for n, m in members.items())


TURNS = "conv_id long, turn long, role string, text string, depth string, k1 string"


@pytest.mark.parametrize("band, block, bits", [(16, 1024, 10), (2, 4, 1), (3, 7, 0)])
def test_trie_of_odd_conversations(spark, monkeypatch, band, block, bits):
    for name, value in (("BAND", band), ("BLOCK", block), ("ID_BITS", bits)):
        monkeypatch.setattr(prefix_trie, name, value)
    rows = [(None, 1, "user", "x"), (0, None, "user", "first"), (0, 2, None, "b"), (0, 3, "user", None), (1, 1, "user", "first"),
            (2, 1, "", ""), (3, 5, "user", "é"), (-3, 5, "user", "long " * 2000), (-5, 1, "a", "b"), (-6, 1, "a", "b"), (12, 1, "u", "v")]
    rows += [(20, t, "user", f"t{t}") for t in range(60)]  # a long one, and others that leave it late
    rows += [(25, t, "user", f"t{t}" if t < 50 else f"u{t}") for t in range(70)] + [(30, t, "user", f"t{t}") for t in range(33)]
    rows += [(100 + 5 * k, t, "user", "hello" if t < 3 else f"own {k}") for k in range(40) for t in range(4 if k % 2 else 3)]
    rows += [(901, 1, "u", "a"), (901, 1, "u", "a"), (901, 2, "u", "b")]
    df = spark.createDataFrame([(*r, "d", "k") for r in rows], TURNS).repartition(5)
    assert Counter(map(tuple, prefix_trie.rebuilt_trie(df).collect())) == trie_by_force(rows)


def test_trie_of_conversations(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert Counter(map(tuple, prefix_trie.rebuilt_trie(df).collect())) == trie_by_force(rows)
    assert prefix_trie.rebuilt_trie(df.limit(0)).collect() == []
    assert prefix_trie.rebuilt_trie(df.withColumn("conv_id", F.lit(None).cast("long"))).collect() == []


def test_trie_nodes_add_to_a_bounded_number_of_ancestors(spark):
    """A chain of 300 turns: three bands' worth of rounds, and no node in more than BAND rows of one."""
    one = spark.createDataFrame([(5, t, "u", "x") for t in range(300)], "conv_id long, turn long, role string, text string")
    rows = {r.depth: r for r in prefix_trie.rebuilt_trie(one).collect()}
    assert len(rows) == 301 and all(r.n_leaves == 1 and r.saved_tokens == 0 for r in rows.values())
    walked = prefix_trie.steps(prefix_trie.placed_turns(one).withColumnRenamed("place", "depth"))
    nodes = prefix_trie.nodes_of(walked, spark.createDataFrame([(5, 300)], "conv_id long, n long"))
    for unit in (1, 16):
        sizes = prefix_trie.ancestors(walked, nodes, unit).select(F.size("above").alias("n"), "depth").collect()
        assert len(sizes) == 300 // unit and max(r.n for r in sizes) <= 2 * prefix_trie.BAND - 1
        assert all(r.n == min(r.depth // unit - 1, 2 * prefix_trie.BAND - 1) for r in sizes)
