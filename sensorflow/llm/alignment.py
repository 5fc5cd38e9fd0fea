"""Two tokenizers aligned by spans: a byte-level BPE (A) and a sentencepiece model with byte fallback (B).

Texts are cut where neither vocabulary has a token across: before a space or line feed that follows
other characters, and between a word and a comma or full stop.  Words repeat, so a piece of text is
aligned once per worker as long as it is remembered:

1. Its tokens come from the two libraries, with the ends of their spans: character offsets from
   tokenizers, spans of sentencepiece's proto result.  Ends that both sides share are the coarse cuts.
2. A span is refined where it isn't as long as its token's decoded bytes: several A tokens within one
   character, or B's byte tokens.  There, decoded bytes say where the token ends.
3. Ends on both sides cut the tokens into groups; each stretch between two neighbouring ends is
   one link.  Two partitions of the same bytes overlap in as many pairs as they have ends together.

How many documents hold an id pair is one aggregation over the corpus.  Pairs above a count, of which
there are at most ``TABLE_PAIRS``, are looked up in a sorted table on each worker, the rest by a join;
a pair of the rest has fewer documents than that count, so no key of the join is hot.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sensorflow.llm.bpe import byte_alphabet
from sensorflow.llm.common import as_texts, id_and_text, slices
from sensorflow.session import staged

#: pairs that a worker looks up in memory (12 bytes each)
TABLE_PAIRS = 1 << 18
#: pieces of text that a worker remembers, twice (the newer and the older ones)
REMEMBERED = 250_000
#: longer pieces aren't remembered
REMEMBERED_CHARS = 64
#: an id pair is ``a * B_IDS + b``
B_IDS = 1 << 16

LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: cuts in front of ' ' and '\n' after other than white space, and between letters and ',' or '.'
PIECE = re.compile(rf"(?:[ \n]\s*)?[{LETTERS}]+(?=[,. \n]|\Z)|(?:[ \n]\s*)?\S+(?:[^\S \n]\s*\S+)*(?:[^\S \n]\s*\Z)?|\s+")
#: pieces that may follow each other in one text
PLAIN = re.compile(r" \S(?:.*\S)?", re.S)
#: a B piece that such a cut would split
ACROSS = re.compile(rf"[^▁]▁|.\n|[{LETTERS}][,.]", re.S)

FIELDS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"


class Aligner:
    """Aligns pieces of text; see the module's description."""

    def __init__(self, a_path: str, b_path: str):
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        alphabet = byte_alphabet()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        # a vocabulary with pieces across the cuts gets whole texts
        self.cuts = not any(ACROSS.search(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()) if not self.b.is_byte(i))
        self.a_size, self.b_size = (np.array([len(x) for x in t]) for t in (self.a_bytes, self.b_bytes))
        self.new: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}

    def pieces(self, text: str) -> list[str]:
        """The pieces of space + text, none for an empty one."""
        if not text:
            return []
        return PIECE.findall(" " + text) if self.cuts else [" " + text]

    def spans_a(self, texts: list[str], size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and ends (in bytes of all texts joined) of A's tokens."""
        ids, ends, first = [], [], 0
        for e, text in zip(self.a.encode_batch(texts, add_special_tokens=False), texts):
            ids += e.ids
            ends += [first + y for _, y in e.offsets]
            first += len(text)
        # characters to bytes; a token within a character ends inside it, where its decoded bytes end
        at = np.concatenate([[0], np.cumsum(size)])
        return self.refined(np.array(ids, np.int64), at[np.array(ends, np.int64)], self.a_size)

    def spans_b(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and ends (in bytes of all texts joined) of B's tokens."""
        ids, ends, first = [], [], 0
        for text in texts:
            # its own space stands in front of a text; one that begins otherwise comes after a letter, which goes again
            spaced = text[0] == " " and len(text) > 1
            shift, skip = (first + 1, 0) if spaced else (first - 1, 1)
            found = [(p.id, p.end) for p in self.b.encode(text[1:] if spaced else "x" + text, return_type="proto").pieces]
            if not spaced:
                found = [x for x in found if x[1] > skip]
            ids += [i for i, _ in found]
            ends += [shift + e for _, e in found]
            first += len(text.encode())
        return self.refined(np.array(ids, np.int64), np.array(ends, np.int64), self.b_size)

    @staticmethod
    def refined(ids: np.ndarray, ends: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ends of spans, by decoded bytes where a span isn't as long as its token."""
        span = np.diff(ends, prepend=0)
        return ids, np.where(span == size[ids], ends, np.cumsum(size[ids]))

    def align(self, texts: list[str], at_once: bool = False) -> list[tuple | None]:
        """Per text ``(n_a, n_b, n_groups, groups as text, id pairs as bytes)``; None if the decoded bytes aren't the text's.

        ``at_once``: the texts follow each other where no token crosses, and can be encoded as one.
        """
        joined = "".join(texts)
        raw = joined.encode()
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        size = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
        a, a_end = self.spans_a([joined] if at_once else texts, size)
        b, b_end = self.spans_b([joined] if at_once else texts)
        if (b"".join(map(self.a_bytes.__getitem__, a.tolist())) != raw or b"".join(map(self.b_bytes.__getitem__, b.tolist())) != raw):
            return [None] if len(texts) == 1 else [x for t in texts for x in self.align([t])]
        stop = np.concatenate([[0], np.cumsum(size)])[np.cumsum([len(t) for t in texts])]
        # every stretch between neighbouring ends lies in one A and one B token
        both = np.sort(np.concatenate([a_end, b_end]), kind="stable")
        again = both[1:] == both[:-1]
        ends, cut = both[np.concatenate([[True], ~again])] if len(both) else both, both[1:][again]
        pairs = (a[np.searchsorted(a_end, ends)] * B_IDS + b[np.searchsorted(b_end, ends)]).tobytes()
        n_a, n_b, n_groups, n_links = (np.diff(np.searchsorted(x, stop, "right"), prepend=0).tolist() for x in (a_end, b_end, cut, ends))
        names_a, names_b = [str(i) for i in a.tolist()], [str(i) for i in b.tolist()]
        groups, i, j = [], 0, 0
        for x, y in zip(np.searchsorted(a_end, cut, "right").tolist(), np.searchsorted(b_end, cut, "right").tolist()):
            if x - i == 1 == y - j:
                groups.append(names_a[i] + "|" + names_b[j])
            else:
                groups.append(",".join(names_a[i:x]) + "|" + ",".join(names_b[j:y]))
            i, j = x, y
        out, g, k = [], 0, 0
        for x, y, z, n in zip(n_a, n_b, n_groups, n_links):
            out.append((x, y, z, ";".join(groups[g:g + z]), pairs[k:k + 8 * n]))
            g, k = g + z, k + 8 * n
        return out

    def aligned(self, pieces: list[str]) -> dict[str, tuple | None]:
        """Alignments of distinct pieces, remembered ones first."""
        out, plain, other = {}, [], []
        for p in pieces:
            found = self.new.get(p, 0)
            if found == 0:
                found = self.old.get(p, 0)
                if found == 0:
                    (plain if self.cuts and PLAIN.fullmatch(p) else other).append(p)
                    continue
                self.new[p] = found
            out[p] = found
        for missing, at_once in ((plain, True), (other, False)):
            for start in range(0, len(missing), 4096):
                some = missing[start:start + 4096]
                for p, found in zip(some, self.align(some, at_once)):
                    out[p] = found
                    if len(p) <= REMEMBERED_CHARS:
                        self.new[p] = found
        if len(self.new) > REMEMBERED:
            self.old, self.new = self.new, {}
        return out


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


def align_documents(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per row ``doc_id``, numbers of tokens, groups and links, the groups' digest, and its distinct id pairs with how often.

    Null and empty texts, and texts that a tokenizer doesn't give back byte by byte, have no tokens.
    Rows with null or repeated ids are rows like others.  An empty table gives no rows.
    """

    def align(batches):
        tool = aligner(a_path, b_path)
        for batch in slices(batches):
            cut = [tool.pieces(t) for t in as_texts(batch.column("text"))]
            flat = [p for ps in cut for p in ps]
            distinct = dict.fromkeys(flat)
            found = tool.aligned(list(distinct))
            for k, p in enumerate(distinct):
                distinct[p] = k
            entries = [found[p] for p in distinct]
            whole = np.array([e is not None for e in entries], bool)
            nothing = (0, 0, 0, "", b"")
            entries = [e or nothing for e in entries]
            at = np.fromiter(map(distinct.__getitem__, flat), np.int64, len(flat))
            length = np.fromiter(map(len, cut), np.int64, len(cut))
            doc = np.repeat(np.arange(len(cut)), length)
            ok = np.bincount(doc[~whole[at]], minlength=len(cut)) == 0
            counts = [np.bincount(doc, np.array([e[c] for e in entries], np.float64)[at] if entries else None, len(cut)).astype(np.int64) * ok
                      for c in range(3)]
            texts, digests, start, places = [e[3] for e in entries], [], 0, at.tolist()
            for n, good in zip(length.tolist(), ok.tolist()):
                digests.append(hashlib.sha256(";".join(map(texts.__getitem__, places[start:start + n])).encode()).hexdigest()
                               if n and good else "")
                start += n
            keep = ok[doc]
            at, doc = at[keep], doc[keep]
            size = np.array([len(e[4]) >> 3 for e in entries], np.int64)
            first = np.cumsum(size) - size
            n = size[at]
            pairs = np.frombuffer(b"".join(e[4] for e in entries), np.int64)
            pairs = pairs[np.repeat(first[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            key, times = np.unique(np.repeat(doc, n) << 33 | pairs, return_counts=True)
            per_doc = np.bincount(key >> 33, minlength=len(cut))
            offsets = pa.array(np.concatenate([[0], np.cumsum(per_doc)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, counts), pa.array(np.bincount(doc, n, len(cut)).astype(np.int64)),
                 pa.array(digests, pa.string()), pa.ListArray.from_arrays(offsets, pa.array(key & ((1 << 33) - 1))),
                 pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int64)))],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    return id_and_text(docs).mapInArrow(align, FIELDS)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, n_docs``: documents that hold each id pair linked, counted by slices first."""

    def count(batches):
        for batch in slices(batches, "pairs", 16 << 20):
            pairs, n = np.unique(batch.column("pairs").flatten().to_numpy(zero_copy_only=False), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n.astype(np.int64))], ["pair", "n"])

    return aligned.select("pairs").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n_docs"))


def frequent_pairs(counts: DataFrame, table_pairs: int = TABLE_PAIRS) -> tuple[pa.Table, int]:
    """The pairs in ``2**k`` documents or more, for the least k with at most ``table_pairs`` of them, and that count."""
    classes = counts.groupBy(F.floor(F.log2("n_docs")).cast("int").alias("k")).count().collect()
    least, total = 63, 0
    for k, n in sorted(((r["k"], r["count"]) for r in classes), reverse=True):
        if total + n > table_pairs:
            break
        least, total = k, total + n
    return counts.where(F.col("n_docs") >= (1 << min(least, 62))).toArrow().sort_by("pair"), 1 << min(least, 62)


def link_counts(docs: DataFrame, a_path: str, b_path: str, table_pairs: int = TABLE_PAIRS) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``count_sum`` sums over links how many documents hold that id pair; ``n_best`` are the links
    whose pair no other pair of the same A id exceeds.  See :func:`align_documents` for odd rows.
    """
    rows = staged(align_documents(docs, a_path, b_path).withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = staged(pair_counts(rows), "pairs")
    best = staged(counts.groupBy(F.floor(F.col("pair") / B_IDS).cast("long").alias("a")).agg(F.max("n_docs").alias("best")), "best")
    # one row per A id: bounded by the vocabulary
    most = best.toArrow()
    table, least = frequent_pairs(counts, table_pairs)
    shared = docs.sparkSession.sparkContext.broadcast(
        tuple(t.column(c).to_numpy() for t, c in ((table, "pair"), (table, "n_docs"), (most, "a"), (most, "best"))))

    def look_up(batches):
        known, n_docs, ids, highest = shared.value
        top = np.zeros(int(ids.max(initial=0)) + 1, np.int64)
        top[ids] = highest
        for batch in slices(batches, "pairs", 16 << 20):
            pairs, times = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("pairs", "times"))
            size = pc.list_value_length(batch.column("pairs")).to_numpy(zero_copy_only=False)
            doc = np.repeat(np.arange(len(size)), size)
            place = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
            found = known[place] == pairs if len(known) else np.zeros(len(pairs), bool)
            n = np.where(found, n_docs[place] if len(known) else 0, 0)
            is_best = found & (n == top[pairs // B_IDS])
            sums = [np.zeros(len(size), np.int64) for _ in range(2)]
            np.add.at(sums[0], doc[is_best], times[is_best])
            np.add.at(sums[1], doc, n * times)
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc[~found], minlength=len(size)))]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(sums[0]), pa.array(sums[1]),
                 *(pa.ListArray.from_arrays(offsets, pa.array(x[~found])) for x in (pairs, times))],
                ["row", "n_best", "count_sum", "rare", "rare_times"])

    near = staged(rows.select("row", "pairs", "times").mapInArrow(
        look_up, "row long, n_best long, count_sum long, rare array<long>, rare_times array<long>"), "near")
    rare = (near.select("row", F.explode(F.arrays_zip("rare", "rare_times")).alias("x"))
            .select("row", F.col("x.rare").alias("pair"), F.col("x.rare_times").alias("times"))
            .join(counts.where(F.col("n_docs") < least), "pair")
            .withColumn("a", F.floor(F.col("pair") / B_IDS).cast("long")).join(F.broadcast(best), "a")
            .select("row", F.when(F.col("n_docs") == F.col("best"), F.col("times")).otherwise(0).alias("n_best"),
                    (F.col("n_docs") * F.col("times")).alias("count_sum")))
    sums = (near.select("row", "n_best", "count_sum").unionAll(rare).groupBy("row")
            .agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    return rows.drop("pairs", "times").join(sums, "row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
