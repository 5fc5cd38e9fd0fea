"""Passages of many words that occur more than once, found with Aho-Corasick automata.

A window is ``WINDOW`` consecutive words.  Each window's anchor is the phrase of
``PHRASE`` words within it whose hash is smallest, so equal windows have equal anchors at
the same place, and neighbouring windows mostly share one.

1. Anchors are counted over all documents; those that occur twice or more are the
   recurring phrases.  They go to all tasks as a bitmap of fixed size: a wrong bit only adds
   work, never drops anything.
2. Documents stream past in bounded slices.  The recurring phrases of a slice are compiled
   into an Aho-Corasick automaton over word numbers (one shard per slice), which locates
   all their occurrences.  Windows with a located anchor form segments.
3. Equal segments are counted first (map-side per slice, then by hash); only where one
   phrase stands in different surroundings are single windows counted.  A window that occurs
   twice or more, anywhere, is confirmed.
4. Each document's confirmed windows come back by segment and remove the words they cover.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import (as_bytes, bitmap_of, dealt_anew, gram_hashes, id_and_text, in_bitmap, long_array, mix64,
                                   slices, word_hashes)
from sensorflow.session import staged

WINDOW, PHRASE = 35, 16
#: bits of the bitmap of recurring phrases (16 MB)
LG_BITS = 27


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost minimum of each run of ``width`` values."""
    at, h = np.arange(len(values)), 1
    while 2 * h <= width:
        a, b = at[:-h], at[h:]
        at = np.where(values[a] <= values[b], a, b)
        h *= 2
    if h < width:
        a, b = at[:len(at) - (width - h)], at[width - h:]
        at = np.where(values[a] <= values[b], a, b)
    return at


def windows(split: list[list[bytes]], window: int, phrase: int):
    """Words of all texts in one row: first word, phrase hashes, and of each window in a text start, anchor, hash.

    The last word of a window is in the same text as the first.
    """
    words, counts = word_hashes(split)
    first = np.cumsum(counts) - counts
    grams = gram_hashes(words, phrase)
    if len(words) < window:
        none = np.empty(0, np.int64)
        return first, grams, none, none, np.empty(0, np.uint64)
    doc = np.repeat(np.arange(len(split)), counts)
    start = np.flatnonzero(doc[:len(doc) - window + 1] == doc[window - 1:])
    anchor = sliding_argmin(grams, window - phrase + 1)[start]
    # overlapping phrases cover the window
    h = np.full(len(start), np.uint64(window))
    for k in [*range(0, window - phrase, phrase), window - phrase]:
        h = mix64(h * np.uint64(0x100000001B3) + grams[start + k])
    return first, grams, start, anchor, h


def recurring_phrases(docs: DataFrame, window: int, phrase: int, lg_bits: int) -> np.ndarray:
    """Bitmap (bytes) of the anchors that occur twice or more in the corpus, by their low bits."""

    def count(batches):
        for piece in slices(batches):
            _, grams, _, anchor, _ = windows([t.split() for t in as_bytes(piece.column("text"))], window, phrase)
            h, n = np.unique(grams[np.unique(anchor)], return_counts=True)
            yield pa.RecordBatch.from_arrays([long_array(h), pa.array(n, pa.int64())], ["anchor", "n"])

    rows = docs.select("text").mapInArrow(count, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    return bitmap_of(rows.where("n > 1").select("anchor"), lg_bits)


def locate(split: list[list[bytes]], phrase: int, places: np.ndarray) -> np.ndarray:
    """Starts, in the row of all words, of every occurrence of the phrases that stand at ``places``.

    Each word is two symbols of disjoint alphabets, as a state's children are searched one by
    one: the start state would have a child for each first word otherwise.
    """
    if not len(places):
        return np.empty(0, np.int64)
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for ws in split for w in ws], np.int64)
    base = int(len(number) ** 0.5) + 1
    stream = tuple(np.stack([ids // base + 1, ids % base + base + 2], axis=1).ravel().tolist())
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for p in places.tolist():
        automaton.add_word(stream[2 * p:2 * (p + phrase)], 1)
    automaton.make_automaton()
    return (np.fromiter((end for end, _ in automaton.iter(stream)), np.int64) + 1) // 2 - phrase


SEGMENTS = ("doc_id long, content long, start long, width long, anchor long, segment long, n long, "
            "hashes array<long>")


def segments(docs: DataFrame, bitmap, window: int, phrase: int, lg_bits: int) -> DataFrame:
    """Runs of windows that share a recurring anchor: one row per occurrence.

    The first of equal segments of a slice has their number ``n`` and the windows' hashes.
    """

    def find(batches):
        bits = bitmap.value
        for piece in slices(batches):
            split = [t.split() for t in as_bytes(piece.column("text"))]
            first, grams, start, anchor, h = windows(split, window, phrase)
            places = np.unique(anchor)
            places = places[in_bitmap(bits, grams[places], lg_bits)]
            _, one = np.unique(grams[places], return_index=True)
            located = np.zeros(len(grams) + 1, bool)
            located[locate(split, phrase, places[one])] = True
            ok = np.flatnonzero(located[anchor])
            if not len(ok):
                continue
            begins = np.ones(len(ok), bool)
            begins[1:] = (np.diff(ok) != 1) | (anchor[ok[1:]] != anchor[ok[:-1]]) | (np.diff(start[ok]) != 1)
            b = np.flatnonzero(begins)
            width = np.diff(np.concatenate([b, [len(ok)]]))
            a, z = ok[b], ok[b + width - 1]
            key = mix64(mix64(h[a] + width.astype(np.uint64)) + h[z])
            _, once, n = np.unique(key, return_index=True, return_counts=True)
            total = np.zeros(len(b), np.int64)
            total[once] = n
            doc = np.searchsorted(first, start[a], "right") - 1
            lead = total > 0
            kept = np.where(lead, width, 0)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id").take(pa.array(doc)), piece.column("content").take(pa.array(doc)),
                 pa.array(start[a] - first[doc]), pa.array(width), long_array(grams[anchor[a]]), long_array(key),
                 pa.array(total), pa.ListArray.from_arrays(
                     pa.array(np.concatenate([[0], np.cumsum(kept)]), pa.int32()),
                     long_array(h[ok[np.repeat(lead, width)]]))],
                ["doc_id", "content", "start", "width", "anchor", "segment", "n", "hashes"])

    return docs.mapInArrow(find, SEGMENTS)


def confirmed_windows(found: DataFrame) -> DataFrame:
    """``anchor, segment, mask``: which windows of a segment occur twice or more; segments with none are left out."""
    key = ["anchor", "segment"]
    counted = staged(found.where("n > 0").groupBy(*key).agg(F.sum("n").alias("n"), F.max("width").alias("width")), "counted")
    whole = counted.where("n > 1").select(*key, (F.expr("shiftleft(1L, cast(width as int))") - 1).alias("mask"))
    # one phrase in different surroundings: count its windows one by one
    mixed = counted.groupBy("anchor").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select(dealt_anew("anchor"))
    single = staged(found.where("n > 0").join(staged(mixed, "mixed"), "anchor", "left_semi")
                    .select(*key, "n", F.posexplode("hashes").alias("i", "w")), "windows")
    again = staged(single.groupBy("anchor", "w").agg(F.sum("n").alias("n")).where("n > 1").select("anchor", "w"), "again")
    alone = single.join(counted.where("n = 1").select(*key), key, "left_semi")
    part = (alone.join(again, ["anchor", "w"], "left_semi").groupBy(*key)
            .agg(F.bit_or(F.expr("shiftleft(1L, i)")).alias("mask")))
    return whole.unionAll(part)


def repeated_spans(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE, lg_bits: int = LG_BITS) -> DataFrame:
    """``doc_id, content, starts array<struct<start,mask>>``: confirmed windows per text, in words.

    Bit ``i`` of ``mask`` says that the window from word ``start + i`` is confirmed.  Rows that
    repeat id and text have the same ones, which are kept once.
    """
    bitmap = docs.sparkSession.sparkContext.broadcast(recurring_phrases(docs, window, phrase, lg_bits))
    found = staged(segments(docs, bitmap, window, phrase, lg_bits), "segments")
    masks = staged(confirmed_windows(found), "masks")
    spans = found.join(masks, ["anchor", "segment"]).select("doc_id", "content", "start", "mask")
    if not docs.groupBy("doc_id", "content").count().where("count > 1").isEmpty():
        spans = spans.distinct()
    return spans.groupBy("doc_id", "content").agg(F.collect_list(F.struct("start", "mask")).alias("starts"))


def drop_repeated(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE, lg_bits: int = LG_BITS) -> DataFrame:
    """``doc_id, n_words, n_removed, text``: every whole text without the words of recurring windows.

    Words are runs of characters other than ``\\x20`` and ``\\x09-\\x0D``; ``text`` has the kept
    ones joined by one space.  A window recurs if its word sequence starts anywhere else, in
    another row or in the same one; a row that repeats id and text counts as another.  A null
    text has no words; texts shorter than a window stay as they are.  Null ids are allowed.
    An empty table gives no rows.
    """
    rows = id_and_text(docs).withColumn("content", F.xxhash64("text"))
    spans = staged(repeated_spans(rows, window, phrase, lg_bits), "spans").withColumnsRenamed(
        {"doc_id": "_id", "content": "_content"})

    def cut(batches):
        for piece in slices(batches):
            n_words, n_removed, kept = [], [], []
            for text, starts in zip(as_bytes(piece.column("text")), piece.column("starts").to_pylist()):
                words = text.split()
                edge = np.zeros(len(words) + 1, np.int64)
                for s in starts or ():
                    for i in range(s["mask"].bit_length()):
                        if s["mask"] >> i & 1:
                            edge[s["start"] + i] += 1
                            edge[s["start"] + i + window] -= 1
                stay = np.flatnonzero(edge.cumsum()[:-1] == 0).tolist() if starts else range(len(words))
                n_words.append(len(words))
                n_removed.append(len(words) - len(stay))
                kept.append(b" ".join([words[i] for i in stay]))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "text"])

    return (rows.join(spans, rows.doc_id.eqNullSafe(spans._id) & (rows.content == spans._content), "left")
            .select("doc_id", "text", "starts").mapInArrow(cut, "doc_id long, n_words long, n_removed long, text string"))


ORACLE = rf"""
WITH w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(ws) - {WINDOW - 2})) AS i, ws FROM w WHERE len(ws) >= {WINDOW}),
k AS MATERIALIZED (SELECT doc_id, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS win FROM win),
again AS (SELECT win FROM k GROUP BY win HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM k JOIN again USING (win)),
x AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
j AS (SELECT x.doc_id, count(gone.p) AS n_gone, string_agg(word, ' ' ORDER BY x.p) FILTER (WHERE gone.p IS NULL) AS rest
      FROM x LEFT JOIN gone ON gone.doc_id = x.doc_id AND gone.p = x.p GROUP BY x.doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n_gone, 0) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM w LEFT JOIN j USING (doc_id)
"""
