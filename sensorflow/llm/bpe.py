"""Byte-level BPE with a minimal acyclic transducer for frequent words.

1. Every whole text is cut into pre-tokens; their counts over all documents are a
   Spark aggregation, of which at most ``lexicon_words`` frequent ones are kept.
2. The driver compiles these (a bounded number) with their token ids into a minimal
   acyclic automaton: equal suffixes share states, each arc adds a number, and the sum
   along a word is the word's place in a table of id sequences.  The flat arrays go to
   one file, which Spark ships to every executor and the workers memory-map.
3. Workers look up all distinct words of a slice at once in the automaton and merge the
   others exactly, pair by pair in rank order, all of them side by side.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import id_and_text, slices
from sensorflow.llm.ragged import WHITE_BYTES, Merges, column, distinct, flat, take, word_offsets
from sensorflow.session import staged

# fixed values: the pre-token pattern of the public byte-level vocabularies
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Unicode white space, as \s above has it (Python's re adds four control characters)
WIDE_WHITE = "\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WHITE = rf"\t-\r {WIDE_WHITE}"
#: the same cut at white space only: each chunk holds whole pre-tokens and can be cut by itself
CHUNK_PATTERN = f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"

LEXICON_WORDS = 1 << 17
#: longer words are never in the lexicon
LEXICON_BYTES = 48
#: text bytes that a task cuts into words at once
WORD_BYTES = 4 << 20


def byte_alphabet() -> dict[str, int]:
    """Character that stands for each byte in the vocabulary file: itself if printable, else from 256 up."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Ids, merges and added tokens of a tokenizer file (JSON)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte = byte_alphabet()
        ids = spec["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        token_bytes = [b""] * (max([*ids.values(), *self.added.values()]) + 1)
        for token, i in ids.items():
            token_bytes[i] = bytes(byte[c] for c in token)
        for token, i in self.added.items():
            token_bytes[i] = token.encode()
        self.token_data, self.token_at = flat(pa.array(token_bytes, pa.binary()))
        self.byte_ids = np.zeros(256, np.int32)
        for c, b in byte.items():
            self.byte_ids[b] = ids[c]
        pairs = [p.split(" ") if isinstance(p, str) else p for p in spec["model"]["merges"]]
        self.merges = Merges([(ids[a], ids[b]) for a, b in pairs], [ids[a + b] for a, b in pairs])
        self.split_added = regex.compile("|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)))
        self.words = regex.compile(WORD_PATTERN).findall
        self.chunks = re.compile(CHUNK_PATTERN).findall

    def pieces(self, text: str) -> Iterator[str | int]:
        """Text between added tokens, and the ids of these."""
        at = 0
        for m in self.split_added.finditer(text) if self.added else ():
            if m.start() > at:
                yield text[at:m.start()]
            yield self.added[m[0]]
            at = m.end()
        if at < len(text):
            yield text[at:]

    def merged(self, words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact BPE of pre-tokens (bytes and offsets): the pair of lowest rank first, leftmost among equals."""
        return self.merges(self.byte_ids[words], offsets)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """Minimal acyclic transducer of ``word -> ids`` as one block of flat arrays.

    Words are added in sorted order; a state is shared as soon as its right language is
    complete, so the automaton is minimal at any time.  States are numbered after that.
    """
    words = sorted(entries)
    edges: list[dict[int, int]] = [{}]
    final, known = [False], {}
    path = [0]  # states along the last word

    def close(depth: int, word: bytes) -> None:
        while len(path) > depth + 1:
            state = path.pop()
            key = (final[state], tuple(edges[state].items()))
            edges[path[-1]][word[len(path) - 1]] = known.setdefault(key, state)

    last = b""
    for w in words:
        common = os.path.commonprefix([last, w])
        close(len(common), last)
        for b in w[len(common):]:
            edges.append({})
            final.append(False)
            edges[path[-1]][b] = len(edges) - 1
            path.append(len(edges) - 1)
        final[path[-1]] = True
        last = w
    close(0, last)

    number, order, stack = {0: 0}, [], [(0, False)]
    while stack:  # states in use, targets before sources
        state, done = stack.pop()
        if done:
            order.append(state)
            continue
        stack.append((state, True))
        for t in edges[state].values():
            if t not in number:
                number[t] = len(number)
                stack.append((t, False))
    reach: dict[int, int] = {}

    def count(state: int) -> int:
        if state not in reach:
            reach[state] = final[state] + sum(count(t) for t in edges[state].values())
        return reach[state]

    for state in order:
        count(state)
    arcs = []
    for state, i in number.items():
        skip = int(final[state])
        for b, t in sorted(edges[state].items()):
            arcs.append((i << 8 | b, number[t], skip))
            skip += reach[t]
    arcs.sort()
    ids = [entries[w] for w in words]
    parts = [np.array([a[0] for a in arcs], "<i8"), np.array([a[1] for a in arcs], "<i4"),
             np.array([a[2] for a in arcs], "<i4"),
             np.array([final[s] for s in sorted(number, key=number.get)], "<u1"),
             np.cumsum([0, *map(len, ids)]).astype("<i8"), np.array([x for y in ids for x in y], "<u4")]
    head = np.array([len(p) for p in parts], "<i8").tobytes()
    return head + b"".join(p.tobytes() + b"\0" * (-p.nbytes % 8) for p in parts)


class Lexicon:
    """Memory-mapped lookup of many words at once."""

    TYPES = ("<i8", "<i4", "<i4", "<u1", "<i8", "<u4")

    def __init__(self, path: str):
        block = np.memmap(path, np.uint8, "r")
        sizes, at, parts = block[:48].view("<i8"), 48, []
        for n, kind in zip(sizes.tolist(), self.TYPES):
            nbytes = n * np.dtype(kind).itemsize
            parts.append(block[at:at + nbytes].view(kind))
            at += nbytes + -nbytes % 8
        self.keys, self.targets, self.skips, self.final, self.offsets, self.ids = parts

    def places(self, words: list[bytes]) -> np.ndarray:
        """Number of each word in the lexicon, -1 if absent."""
        return self.find(*flat(pa.array(words, pa.binary())))

    def find(self, text: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The same for words given by their bytes and offsets."""
        start, size = offsets[:-1], np.diff(offsets)
        state, place = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        live = np.flatnonzero((size > 0) & (size <= LEXICON_BYTES)) if len(self.keys) else np.empty(0, np.int64)
        found = np.full(len(size), -1, np.int64)
        depth = 0
        while len(live):
            key = state[live] << 8 | text[start[live] + depth]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[arc] == key
            live, arc = live[hit], arc[hit]
            state[live] = self.targets[arc]
            place[live] += self.skips[arc]
            depth += 1
            ends = size[live] == depth
            over = live[ends]
            ok = over[self.final[state[over]] == 1]
            found[ok] = place[ok]
            live = live[~ends]
        return found

    def ids_of(self, place: int) -> bytes:
        return self.ids[self.offsets[place]:self.offsets[place + 1]].tobytes()


def chunks(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cut texts without wide white space by ``CHUNK_PATTERN``: bytes, offsets of the chunks, first chunk of each text."""
    data, offsets = flat(texts)
    white = np.append(WHITE_BYTES[data], False)
    ends_text = np.zeros(len(data) + 1, bool)
    ends_text[offsets[1:][offsets[1:] > 0] - 1] = True
    starts = np.zeros(len(data) + 1, bool)
    # a run of white space, its last character before a word, and a word after anything but a blank
    starts[1:] = white[1:] & ~white[:-1] | ~white[1:] & white[:-1] & (data != 0x20)
    starts[:-1] |= white[:-1] & ~white[1:] & ~ends_text[:-1]
    starts[offsets] = True
    starts[-1] = False
    at = np.append(np.flatnonzero(starts), len(data)) if len(data) else np.zeros(1, np.int64)
    return data, at, np.searchsorted(at, offsets)


class Words:
    """Distinct words of chunks, and how the chunks consist of them."""

    def __init__(self, vocab: Vocabulary, data: np.ndarray, offsets: np.ndarray):
        self.chunk, chunk_data, chunk_at = distinct(data, offsets)
        word_at, self.first = word_offsets(chunk_data, chunk_at, vocab.words, single_numbers=False)
        self.word, self.data, self.offsets = distinct(chunk_data, word_at)

    def counts(self) -> np.ndarray:
        """How often each distinct word occurs."""
        per_chunk = np.bincount(self.chunk, minlength=len(self.first) - 1)
        return np.bincount(self.word, np.repeat(per_chunk, np.diff(self.first)), len(self.offsets) - 1).astype(np.int64)

    def spread(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks in order from those of the distinct words, with offsets."""
        at, ends = take(offsets, self.word)
        ids, offsets = ids[at], ends[self.first]
        at, ends = take(offsets, self.chunk)
        return ids[at], ends


class Encoder:
    """Encodes texts a slice at a time; each distinct word is looked up or merged once in it."""

    def __init__(self, path: str, lexicon: Lexicon | None):
        self.vocab, self.lexicon = vocabulary(path), lexicon

    def word_ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words: from the lexicon, or merged."""
        if self.lexicon is None:
            return self.vocab.merged(data, offsets)
        place = self.lexicon.find(data, offsets)
        seen, unseen = np.flatnonzero(place >= 0), np.flatnonzero(place < 0)
        known_at, known_ends = take(self.lexicon.offsets, place[seen])
        at, ends = take(offsets, unseen)
        merged, merged_ends = self.vocab.merged(data[at], ends)
        size = np.empty(len(place), np.int64)
        size[seen], size[unseen] = np.diff(known_ends), np.diff(merged_ends)
        out_at = np.concatenate([[0], np.cumsum(size)])
        ids = np.empty(out_at[-1], np.uint32)
        ids[take(out_at, seen)[0]] = self.lexicon.ids[known_at]
        ids[take(out_at, unseen)[0]] = merged
        return ids, out_at

    def regular(self, texts: pa.Array) -> np.ndarray:
        """Texts without added tokens and without white space of several bytes."""
        odd = pc.match_substring_regex(texts, f"[{WIDE_WHITE}]")
        for marker in self.vocab.added:
            odd = pc.or_(odd, pc.match_substring(texts, marker))
        return ~odd.to_numpy(zero_copy_only=False)

    def regular_ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, at, first = chunks(texts)
        words = Words(self.vocab, data, at)
        ids, ends = words.spread(*self.word_ids(words.data, words.offsets))
        return ids, ends[first]

    def odd_ids(self, text: str) -> np.ndarray:
        """Ids of one text of any kind."""
        parts = [np.empty(0, np.uint32)]
        for p in self.vocab.pieces(text):
            if isinstance(p, int):
                parts.append(np.array([p], np.uint32))
            else:
                words = Words(self.vocab, *flat(pa.array(self.vocab.chunks(p), pa.string())))
                parts.append(words.spread(*self.word_ids(words.data, words.offsets))[0])
        return np.concatenate(parts)

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and their offsets; null as empty."""
        texts = pc.fill_null(texts, "")
        regular = self.regular(texts)
        if regular.all():
            return self.regular_ids(texts)
        mask = pa.array(regular)
        ids, offsets = self.regular_ids(texts.filter(mask))
        ours = iter(np.split(ids, offsets[1:-1]))
        rest = map(self.odd_ids, texts.filter(pc.invert(mask)).to_pylist())
        parts = [next(ours) if r else next(rest) for r in regular.tolist()]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return column(*self.encode_column(pa.array(texts, pa.string()))).to_pylist()

    def word_counts(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Distinct words of at most ``LEXICON_BYTES`` bytes and how often they occur, per kind of text."""
        texts = pc.fill_null(texts, "")
        regular = pa.array(self.regular(texts))
        data, at, _ = chunks(texts.filter(regular))
        odd = [c for t in texts.filter(pc.invert(regular)).to_pylist() for p in self.vocab.pieces(t)
               if not isinstance(p, int) for c in self.vocab.chunks(p)]
        more, more_at = flat(pa.array(odd, pa.string()))
        words = Words(self.vocab, np.concatenate([data, more]), np.concatenate([at, at[-1] + more_at[1:]]))
        short = np.diff(words.offsets) <= LEXICON_BYTES
        return column(words.data, words.offsets).filter(pa.array(short)), words.counts()[short]


def decode_column(path: str, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Texts of token ids: their bytes joined, malformed UTF-8 replaced."""
    vocab = vocabulary(path)
    at, ends = take(vocab.token_at, ids.astype(np.int64))
    joined = column(vocab.token_data[at], ends[offsets])
    try:
        return joined.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([b.decode("utf-8", "replace") for b in joined.to_pylist()], pa.string())


def decode(path: str, ids: list[int]) -> str:
    """Text of one list of token ids."""
    return decode_column(path, np.array(ids, np.uint32), np.array([0, len(ids)]))[0].as_py()


def frequent_words(docs: DataFrame, path: str, lexicon_words: int = LEXICON_WORDS) -> list[bytes]:
    """The most frequent pre-tokens of all documents: all above a frequency that ``lexicon_words`` or fewer reach."""

    def count(batches):
        encoder = Encoder(path, None)
        for piece in slices(batches, max_bytes=WORD_BYTES):
            words, n = encoder.word_counts(piece.column("text"))
            yield pa.RecordBatch.from_arrays([words, pa.array(n)], ["word", "n"])

    counted = staged(docs.select("text").mapInArrow(count, "word binary, n long").groupBy("word")
                     .agg(F.sum("n").alias("n")).where("n > 1"), "words")
    # words per level of frequency (32 levels for each doubling): a bounded number of rows
    level = F.floor(F.log2("n") * 32).cast("int")
    sizes = {r.level: r.n for r in counted.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total, least = 0, None
    for at in sorted(sizes, reverse=True):
        total += sizes[at]
        if total > lexicon_words:
            break
        least = at
    if least is None:
        return []
    return [bytes(r.word) for r in counted.where(level >= least).select("word").collect()]


def ship_lexicon(docs: DataFrame, path: str, lexicon_words: int = LEXICON_WORDS) -> str:
    """Build the lexicon of ``docs`` and send its file to every executor; returns the file's name there."""
    vocab = vocabulary(path)
    words = frequent_words(docs, path, lexicon_words)
    ids, offsets = vocab.merged(*flat(pa.array(words, pa.binary())))
    block = compile_lexicon({w: x.tolist() for w, x in zip(words, np.split(ids, offsets[1:-1]))})
    name = f"lexicon-{hashlib.sha256(block).hexdigest()[:32]}.bin"
    context = docs.sparkSession.sparkContext
    if any(f.endswith(name) for f in context.listFiles):
        return name
    here = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="lexicon-")), name)
    with open(here, "wb") as f:
        f.write(block)
    context.addFile(here)
    return name


def bpe_round_trip(docs: DataFrame, path: str, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """``doc_id, ids binary, decoded string`` of every whole text of ``docs``.

    ``ids`` holds little-endian unsigned 32-bit integers.  They equal those of the
    tokenizers library for the file at ``path`` without special tokens added around the
    text; an added token's string inside a text is that token.  A null text is empty: no
    ids, empty decoded text.  Null and repeated ids give one row per input row; an empty
    table gives no rows.  Only ``doc_id`` and ``text`` are read.
    """
    docs = id_and_text(docs)
    name = ship_lexicon(docs, path, lexicon_words)

    def encode(batches):
        encoder = Encoder(path, Lexicon(SparkFiles.get(name)))
        for piece in slices(batches, max_bytes=WORD_BYTES):
            ids, offsets = encoder.encode_column(piece.column("text"))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), column(ids, offsets), decode_column(path, ids, offsets)],
                ["doc_id", "ids", "decoded"])

    return docs.mapInArrow(encode, "doc_id long, ids binary, decoded string")


def with_digests(coded: DataFrame) -> DataFrame:
    """Token count and SHA-256 digests of :func:`bpe_round_trip` rows."""
    return coded.select("doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
