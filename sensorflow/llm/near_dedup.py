"""Near-duplicates: bottom-k sketches from one hash function, inverted lists, exact Jaccard.

1. One pass hashes the shingles of each whole text; the k smallest distinct values are its
   sketch, two commutative sums its fingerprint.  Texts with the same shingle set become
   one node (their smallest id).
2. Inverted lists of retained values.  Two sets with Jaccard 0.8 or more share far more
   than half of the retained values (:func:`least_shared`; for the worst case, a subset at
   exactly 0.8, all but 1e-7 of pairs), so they meet in the lists of their rarest ``k - shared + 1`` values
   alone; common lines and passages drop out there, whatever their number of documents.
3. Short lists give all their pairs.  A long list gives only its members against a pivot:
   the most central member, whose retained values are the most common ones, so the lists of
   a cluster agree on it.  The sketch of the union, from the two sketches, estimates the
   overlap and drops pairs far below; the rest are confirmed on the full sets.
4. Lists whose members are not all in one component after that stay open.  Their members'
   full sets are joined exactly: in one global order of the elements (those in one set
   only first), two similar sets share an element so early in both that the rest can still
   reach the overlap; which partner sizes that allows is known for each element, and the
   smaller set must allow its own.  Edits of one text that are too far from it thereby
   meet nobody, however many there are.  No list is cut off.
5. Links give components, all by Spark joins; nothing but counts and a bitmap of fixed size
   reaches the driver.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import (BROADCAST_IDS, as_bytes, bitmap_of, content, dealt_anew, gram_hashes, id_and_text, in_bitmap,
                                   joined_rows, long_array, mix64, slices, word_hashes)
from sensorflow.llm.components import components
from sensorflow.session import staged

SHINGLE_WORDS = 5
PERCENT = 80
SKETCH = 64
#: share of pairs, at most, of a subset at exactly the threshold that have less in common than ``least_shared``
LOST = 1e-7
#: lists up to this length give all their pairs at once
SHORT_LIST = 3
#: bits of the bitmap of elements that several sets hold (16 MB)
LG_BITS = 27
#: classes of the elements whose parities are compared before full sets are
PARITY_BITS = 512
#: nodes without any id are numbered from here
NO_ID = 1 << 62


def least_shared(percent: float) -> float:
    """Share of the smaller sketch that two sets with that Jaccard hold in common at least, but for ``LOST`` of pairs.

    The common values of the union's sketch are binomial at the least.  An error where
    ``LOST`` of pairs or more have none at all.
    """
    p, total = percent / 100, 0.0
    if not 0 < p <= 1:
        raise ValueError(f"percent must be above 0 and at most 100, not {percent}")
    for shared in range(SKETCH + 1):
        total += math.comb(SKETCH, shared) * p ** shared * (1 - p) ** (SKETCH - shared)
        if total > LOST:
            break
    if not shared:
        raise ValueError(f"sketches of {SKETCH} values can't tell sets with {percent} % in common from others")
    return shared / SKETCH


def shingle_sets(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending within each text, and their number per text.

    A text with fewer than ``n`` words has its whole sequence as one shingle, one without
    words has none.
    """
    words, counts = word_hashes([t.lower().split() for t in texts])
    doc = np.repeat(np.arange(len(texts)), counts)
    grams = gram_hashes(words, n)
    ok = doc[:len(grams)] == doc[n - 1:] if len(grams) else np.zeros(0, bool)
    h, d = grams[ok], doc[:len(grams)][ok]
    first = np.cumsum(counts) - counts
    few = np.flatnonzero((counts > 0) & (counts < n))
    if len(few):
        whole = [gram_hashes(words[first[i]:first[i] + counts[i]], int(counts[i]), int(counts[i]))[0] for i in few]
        h, d = np.concatenate([h, np.array(whole, np.uint64)]), np.concatenate([d, few])
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return h[new], np.bincount(d[new], minlength=len(texts))


def per_text_sums(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sum modulo 2**64 of each text's run of values."""
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    ends = np.cumsum(size)
    return upto[ends] - upto[ends - size]


def sketches(docs: DataFrame, n: int) -> DataFrame:
    """``doc_id, content, n_shingles, f1, f2, sketch`` of every row; ``content`` hashes the raw text."""

    def make(batches):
        for piece in slices(batches):
            h, size = shingle_sets(as_bytes(piece.column("text")), n)
            ends = np.cumsum(size)
            kept = np.minimum(size, SKETCH)
            at = np.repeat(ends - size - (np.cumsum(kept) - kept), kept) + np.arange(kept.sum())
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("content"), pa.array(size.astype(np.int64)), long_array(per_text_sums(mix64(h), size)),
                 long_array(per_text_sums(mix64(h ^ np.uint64(0x9E3779B97F4A7C15)), size)),
                 pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(kept)]), pa.int32()),
                                          long_array(h[at]))],
                ["doc_id", "content", "n_shingles", "f1", "f2", "sketch"])

    return id_and_text(docs).withColumn("content", content(F.col("text"))).mapInArrow(
        make, "doc_id long, content long, n_shingles long, f1 long, f2 long, sketch array<long>")


def node_without_id(f1: Column) -> Column:
    return F.lit(NO_ID) + f1.bitwiseAND(F.lit((1 << 61) - 1))


def full_sets(docs: DataFrame, nodes: DataFrame, n: int, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """``node, shingles array<long>`` (distinct 64-bit values) of the rows whose id is in ``nodes``, and of those without one."""
    wanted = nodes.select(F.col("node").alias("doc_id"))
    n_nodes = nodes.count()
    if n_nodes <= broadcast_ids:
        wanted = F.broadcast(wanted)
    rows = id_and_text(docs)

    def make(batches):
        for piece in slices(batches):
            h, size = shingle_sets(as_bytes(piece.column("text")), n)
            sets = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), long_array(h))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), long_array(per_text_sums(mix64(h), size)), sets], ["doc_id", "f1", "shingles"])

    schema = "doc_id long, f1 long, shingles array<long>"
    named = rows.join(wanted, "doc_id", "left_semi").mapInArrow(make, schema).select(F.col("doc_id").alias("node"), "shingles")
    nameless = (rows.where("doc_id is null").mapInArrow(make, schema).select(node_without_id(F.col("f1")).alias("node"), "shingles")
                .join(nodes, "node", "left_semi").dropDuplicates(["node"]))
    sets = staged(named.unionAll(nameless), "sets")
    return sets if sets.count() == n_nodes else staged(sets.dropDuplicates(["node", "shingles"]), "sets")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs ``u, v``, those with ``100 * |intersection| >= percent * |union|`` on the full sets."""
    a = sets.select(F.col("node").alias("u"), F.col("shingles").alias("a"))
    b = sets.select(F.col("node").alias("v"), F.col("shingles").alias("b"))
    both = F.size(F.array_intersect("a", "b")).cast("long")
    similar = 100 * both >= percent * (F.size("a") + F.size("b") - both)
    return pairs.join(a, "u").join(b, "v").where(similar).select("u", "v")


def maybe_similar(pairs: DataFrame, reps: DataFrame, share: float) -> DataFrame:
    """Pairs whose union sketch (the k smallest of both sketches) holds enough values of both."""
    a = reps.select(F.col("node").alias("u"), F.col("sketch").alias("a"))
    b = reps.select(F.col("node").alias("v"), F.col("sketch").alias("b"))
    union = F.slice(F.sort_array(F.array_union("a", "b")), 1, SKETCH)
    both = F.size(F.array_intersect(union, F.array_intersect("a", "b")))
    return pairs.join(a, "u").join(b, "v").where(both >= F.size(union) * share).select("u", "v")


def as_unsigned(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False).view(np.uint64)


def _pairs(joined: DataFrame) -> DataFrame:
    return joined.where("p != node").select(F.least("p", "node").alias("u"), F.greatest("p", "node").alias("v")).distinct()


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, content`` for every row of ``docs``.

    Words are runs of characters other than ``\\x20`` and ``\\x09-\\x0D``, A-Z lower-cased.
    Texts without words (null, empty, blank) have no shingles and are linked with nothing:
    their component is their own id.  ``component_id`` is the smallest id reachable, null if
    no document there has one; ``kept`` is true for that document, and for all rows of a
    component without ids.  Rows that share an id but not the text are judged one by one;
    ``content`` (a hash of the raw text) tells them apart.  An empty table gives no rows.
    ``percent`` is 23 or more; below, two sketches may share nothing, which is an error.
    """
    least_shared(percent)
    rows = staged(sketches(docs, shingle_words), "sketches")
    worded = rows.where("n_shingles > 0")
    groups = staged(worded.groupBy("f1", "f2").agg(F.min("doc_id").alias("id"))
                    .select("f1", "f2", F.coalesce("id", node_without_id(F.col("f1"))).alias("node")), "groups")
    keys = ["f1", "f2", "node"]
    reps = staged(worded.withColumn("node", F.coalesce("doc_id", node_without_id(F.col("f1"))))
                  .join(groups, keys).select("node", "sketch"), "representatives")
    if reps.count() != groups.count():  # repeated rows
        reps = staged(reps.dropDuplicates(["node", "sketch"]), "representatives")
    labels = components(links(docs, reps, shingle_words, percent))
    named = staged(groups.join(labels, "node", "left")
                   .select("f1", "f2", F.coalesce("label", "node").alias("_label")), "components")
    wordless = F.col("n_shingles") == 0
    known = F.when(wordless, F.col("doc_id")).when(F.col("_label") < NO_ID, F.col("_label"))
    return rows.join(named, ["f1", "f2"], "left").select(
        "doc_id", "n_shingles", known.alias("component_id"),
        (wordless | known.isNull() | F.col("doc_id").eqNullSafe(known)).alias("kept"), "content")


def links(docs: DataFrame, reps: DataFrame, shingle_words: int, percent: int) -> DataFrame:
    """Confirmed edges ``u, v`` that connect every component of similar nodes."""
    share = least_shared(percent)
    values = reps.select("node", F.size("sketch").alias("k"), F.explode("sketch").alias("value"))
    common = staged(values.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "values")
    # the rarest k - shared + 1 values of each node; a value of one node alone takes a place but no list
    prefix = (F.col("k") - F.ceil(F.col("k") * share) + 1).cast("int")
    lists = staged(
        values.join(common, "value").groupBy("node", "k")
        .agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("vs"), F.avg(F.log2("df")).alias("common"))
        # how common all values of the node are, as a whole number to sort by
        .withColumn("rank", -F.round(F.col("common") * F.size("vs") / F.col("k") * 1000).cast("long"))
        .select("node", "rank", F.explode(F.slice("vs", 1, F.greatest(F.lit(0), prefix - (F.col("k") - F.size("vs"))))).alias("x"))
        .select(F.col("x.value").alias("value"), F.col("x.df").alias("df"), "rank", "node"), "lists")
    short = (lists.where(F.col("df") <= SHORT_LIST).groupBy("value").agg(F.collect_list("node").alias("nodes"))
             .where(F.size("nodes") > 1)
             .select("nodes", F.explode("nodes").alias("p")).select("p", F.explode("nodes").alias("node")).where("p < node"))
    long_ = staged(lists.where(F.col("df") > SHORT_LIST).select("value", "rank", "node"), "long")
    pivots = staged(long_.groupBy("value").agg(F.min(F.struct("rank", "node")).alias("p"))
                    .select("value", F.col("p.node").alias("p")), "pivots")
    pairs = _pairs(short.unionAll(long_.join(pivots, "value").select("p", "node")))
    likely = staged(maybe_similar(pairs, reps, share), "likely")
    nodes = likely.select(F.col("u").alias("node")).unionAll(likely.select(F.col("v").alias("node"))).distinct()
    sets = full_sets(docs, staged(nodes, "nodes"), shingle_words)
    edges = staged(confirmed(likely, sets, percent), "links")
    # lists that are not one component yet
    open_ = staged(long_.join(components(edges), "node", "left")
                   .select("value", "node", F.coalesce("label", "node").alias("label")), "open")
    mixed = (open_.groupBy("value").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a != b")
             .select(dealt_anew("value")))
    labels = staged(open_.join(mixed, "value", "left_semi").select("node", "label").distinct(), "members")
    sets = full_sets(docs, labels.select("node"), shingle_words)
    return edges.unionAll(staged(confirmed(similar_sizes(sets, labels, percent), sets, percent), "links"))


def similar_sizes(sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs ``u, v`` of sets with different labels that may reach ``percent``: an exact prefix join.

    The overlap must be ``percent / (100 + percent)`` of both sizes together.  If the first
    common element stands at place i of a set, the overlap is at most the elements from there
    on, so ``cap = (size - i) * (100 + percent) / percent - size`` bounds the partner's size.
    Each entry carries the parities of its set's elements in ``PARITY_BITS`` classes: two sets
    differ in one element at least for each parity that differs, which drops most other pairs.
    """
    parities = [f"s{k}" for k in range(PARITY_BITS // 64)]

    def elements(batches):
        for piece in slices(batches, "shingles"):
            h, n = np.unique(as_unsigned(piece.column("shingles").flatten()), return_counts=True)
            yield pa.RecordBatch.from_arrays([long_array(h), pa.array(n, pa.int64())], ["element", "n"])

    counted = sets.select("shingles").mapInArrow(elements, "element long, n long").groupBy("element").agg(F.sum("n").alias("n"))
    common = sets.sparkSession.sparkContext.broadcast(bitmap_of(counted.where("n > 1").select("element"), LG_BITS))

    def prefixes(batches):
        for piece in slices(batches, "shingles"):
            out = []
            sets = piece.column("shingles")
            sizes = np.cumsum(sets.value_lengths().to_numpy(zero_copy_only=False))
            for h in np.split(as_unsigned(sets.flatten()), sizes[:-1]):
                known = in_bitmap(common.value, h, LG_BITS)
                size, rare = len(h), int((~known).sum())
                place = np.arange(rare, size)
                cap = (size - place) * (100 + percent) // percent - size
                # no partner is smaller than percent of the size
                ok = 100 * cap >= percent * size
                odd = np.bincount((h >> np.uint64(40)).astype(np.int64) % PARITY_BITS, minlength=PARITY_BITS) & 1
                out.append((h[known][ok], cap[ok], size, np.packbits(odd.astype(np.uint8)).view(np.int64)))
            n = [len(x[0]) for x in out]
            signs = np.repeat(np.stack([x[3] for x in out]), n, axis=0)
            at = pa.array(np.repeat(np.arange(len(out)), n))
            yield pa.RecordBatch.from_arrays(
                [long_array(np.concatenate([x[0] for x in out])), piece.column("node").take(at), piece.column("label").take(at),
                 pa.array(np.repeat([x[2] for x in out], n), pa.int64()),
                 pa.array(np.concatenate([x[1] for x in out]), pa.int64()), *(pa.array(c) for c in signs.T.copy())],
                ["element", "node", "label", "size", "cap", *parities])

    entries = staged(sets.join(labels, "node").mapInArrow(
        prefixes, "element long, node long, label long, size long, cap long, " + ", ".join(f"{c} long" for c in parities)),
        "entries")
    # in each list, pairs within the most frequent component need no look
    top = staged(entries.groupBy("element", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("element")
                 .agg(F.max_by("label", F.struct("n", "label")).alias("top"), F.count(F.lit(1)).alias("k")).where("k > 1")
                 .select("element", "top"), "top")
    entries = staged(entries.join(top, "element").withColumn("major", F.col("label") == F.col("top")).drop("top"), "entries")
    small = entries.where("cap >= size")
    large = entries.select("element", *(F.col(c).alias("_" + c) for c in ("node", "label", "size", "cap", "major", *parities)))
    differ = reduce(lambda x, y: x + y, [F.bit_count(F.col(c).bitwiseXOR(F.col("_" + c))) for c in parities])
    both = F.col("size") + F.col("_size")
    fits = ((F.col("label") != F.col("_label")) & (F.col("size") <= F.col("_size")) & (F.col("_size") <= F.col("cap"))
            & (F.col("size") <= F.col("_cap")) & ((100 + percent) * (both - differ) >= 2 * percent * both))
    pairs = (small.join(large.where("not _major"), "element").where(fits)
             .unionAll(small.where("not major").join(large.where("_major"), "element").where(fits)))
    return pairs.select(F.least("node", "_node").alias("u"), F.greatest("node", "_node").alias("v")).distinct()


def drop_near_copies(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id; all columns as they were.

    Texts without words (null, empty, blank) all stay.  Rows with a null id go if their component has a
    document with one, else all of them stay.  Rows that repeat id and text share one decision.
    An empty table gives an empty one.
    """
    gone = staged(near_duplicates(docs, shingle_words, percent).where("not kept")
                  .select(F.col("doc_id").alias("id"), F.col("content").alias("raw")).distinct(), "gone")
    return joined_rows(docs, gone, "left_anti")


#: the query's contract: four-word shingles, 80 percent
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
i AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM w WHERE len(ws) > 0),
g AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS s FROM i),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM g x JOIN g y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
link AS MATERIALIZED (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
edge AS MATERIALIZED (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents
          UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN n USING (doc_id)
"""
