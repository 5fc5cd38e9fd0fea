"""Cost-balanced packing of token sequences.

Documents are dealt to shards of about ``shard_chars`` characters by a hash of their row
number; a shard is packed by one task:

* a document of a full sequence or more gives whole sequences and a rest;
* rests and short documents, in descending length, go to the sequence of lowest estimated
  cost (linear plus quadratic in each piece, attention stays within a piece) that has room;
* what fits nowhere whole is cut into the room left, fullest sequence first, so the shard's
  tokens fill all its sequences exactly; the last tokens (fewer than one sequence) go to
  sequences whose lengths are falling powers of two, which need no padding.
"""

from __future__ import annotations

import json
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sensorflow.llm.bpe import byte_alphabet
from sensorflow.llm.common import give_back_memory, id_and_text, slices
from sensorflow.llm.ragged import WHITE_BYTES, Merges, any_in, column, distinct, flat, take, word_offsets

CAPACITY = 2048
END_ID = 1
#: cost of a piece of n tokens: LINEAR * n + QUADRATIC * n * n (per layer, model width 1024)
LINEAR, QUADRATIC = 12 * 1024.0, 1.0
SHARD_CHARS = 8_000_000
#: text bytes that a task cuts into words at once
WORD_BYTES = 2 << 20


class WordEncoder:
    r"""Ids of whole texts as the tokenizers library gives them, merged once for each distinct word of a slice.

    The word vocabulary drops white space and cuts words by the pattern below before any
    merge, so a word's ids don't depend on its neighbours.  Texts within Latin-1 without the
    separators \x1c-\x1f (white space to Python alone) and without a marker of added tokens
    are cut and merged here; others go to the library whole.
    """

    # fixed values: the pre-token pattern of the public word vocabulary
    WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
    END = "</w>"

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        ids, pairs = model["vocab"], [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        self.merges = Merges([(ids[a], ids[b]) for a, b in pairs], [ids[a + b] for a, b in pairs])
        self.inner, self.last = np.zeros(256, np.uint32), np.zeros(256, np.uint32)
        for c, b in byte_alphabet().items():
            self.inner[b], self.last[b] = ids[c], ids[c + self.END]

    def library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def plain(self, column: pa.Array) -> np.ndarray:
        data, offsets = flat(column)
        odd = any_in((data >= 0xC4) | (data >= 0x1C) & (data <= 0x1F), offsets)
        for marker in self.added:
            odd |= pc.match_substring(column, marker).to_numpy(zero_copy_only=False)
        return ~odd

    def plain_ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and offsets of plain texts."""
        data, offsets = flat(pc.utf8_lower(column))
        white = WHITE_BYTES[data]
        wide = np.flatnonzero(data[:-1] == 0xC2)  # the two white characters of two bytes
        wide = wide[(data[wide + 1] == 0x85) | (data[wide + 1] == 0xA0)]
        white[wide] = white[wide + 1] = True
        solid = np.append(~white, False)
        first, last = solid.copy(), solid.copy()
        first[1:] &= ~solid[:-1]
        first[offsets] = solid[offsets]
        last[:-1] &= ~solid[1:]
        inner = offsets[(offsets > 0)] - 1
        last[inner] = solid[inner]
        starts = np.flatnonzero(first)
        sizes = np.flatnonzero(last) + 1 - starts
        chunk, chunk_data, chunk_at = distinct(data[solid[:-1]], np.concatenate([[0], np.cumsum(sizes)]))
        word_at, chunk_words = word_offsets(chunk_data, chunk_at, self.WORDS, single_numbers=True)
        word, word_data, word_at = distinct(chunk_data, word_at)
        symbols = self.inner[word_data]
        symbols[word_at[1:] - 1] = self.last[word_data[word_at[1:] - 1]]
        ids, id_at = self.merges(symbols, word_at)
        at, ends = take(id_at, word)  # ids of each word of the chunks, in order
        ids, id_at = ids[at], ends[chunk_words]
        at, ends = take(id_at, chunk)
        return ids[at], ends[np.searchsorted(starts, offsets)]

    def encode_column(self, texts: pa.Array) -> pa.Array:
        """Little-endian unsigned 32-bit ids of each text; null as empty."""
        texts = pc.fill_null(texts, "")
        plain = self.plain(texts)
        if plain.all():
            return column(*self.plain_ids(texts))
        mask = pa.array(plain)
        ours = iter(column(*self.plain_ids(texts.filter(mask))).to_pylist())
        rest = iter(self.library(texts.filter(pc.invert(mask)).to_pylist()))
        return pa.array([next(ours) if p else next(rest) for p in plain.tolist()], pa.binary())

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.encode_column(pa.array(texts, pa.string())).to_pylist()


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def tokens(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids binary``: little-endian unsigned 32-bit ids of every whole text, then ``END_ID``."""
    end = np.array([END_ID], "<u4").tobytes()

    def encode(batches):
        encoder = word_encoder(path)
        for piece in slices(batches, max_bytes=WORD_BYTES):
            ids = encoder.encode_column(piece.column("text"))
            ids = pc.binary_join_element_wise(ids, pa.scalar(end, ids.type), pa.scalar(b"", ids.type))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), ids.cast(pa.binary())], ["doc_id", "ids"])

    return id_and_text(docs).mapInArrow(encode, "doc_id long, ids binary")


def pack(lengths: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """``(document, start, length, sequence, offset)`` of the pieces of one shard; no padding at all."""
    total = int(lengths.sum())
    n_full = total // capacity
    pieces: list[tuple[int, int, int, int, int]] = []
    rests: list[tuple[int, int, int]] = []  # length, document, start
    used = 0
    for d, n in enumerate(lengths.tolist()):
        whole = n // capacity
        pieces += [(d, k * capacity, capacity, used + k, 0) for k in range(whole)]
        used += whole
        if n % capacity:
            rests.append((n % capacity, d, whole * capacity))
    rests.sort(key=lambda r: (-r[0], r[1]))
    room = np.full(n_full - used, capacity, np.int64)
    cost = np.zeros(n_full - used)
    over: list[tuple[int, int, int]] = []

    def put(d: int, start: int, n: int, s: int) -> None:
        pieces.append((d, start, n, used + s, capacity - int(room[s])))
        room[s] -= n
        cost[s] += LINEAR * n + QUADRATIC * n * n

    for n, d, start in rests:
        fits = np.where(room >= n, cost, np.inf)
        s = int(fits.argmin()) if len(fits) else 0
        if len(fits) and fits[s] < np.inf:
            put(d, start, n, s)
        else:
            over.append((n, d, start))
    open_ = [s for s in np.argsort(room, kind="stable").tolist() if room[s]]
    last: list[tuple[int, int, int]] = []
    for n, d, start in over:
        while n and open_:
            take = min(n, int(room[open_[0]]))
            put(d, start, take, open_[0])
            n, start = n - take, start + take
            if not room[open_[0]]:
                open_.pop(0)
        if n:
            last.append((n, d, start))
    s, left, at = n_full - 1, 0, 0
    for n, d, start in last:
        while n:
            if not left:
                rest = total - n_full * capacity - at
                s, left = s + 1, 1 << rest.bit_length() - 1
                size = left
            take = min(n, left)
            pieces.append((d, start, take, s, size - left))
            n, start, left, at = n - take, start + take, left - take, at + take
    return pieces


PIECES = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def pack_documents(docs: DataFrame, path: str, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """Pieces of all documents, packed: ``doc_id, start, length, doc_tokens, sequence_id, offset, ids``.

    Each row is one piece with its ids (little-endian unsigned 32-bit); each id of a
    document lies in exactly one piece.  Sequences hold ``CAPACITY`` tokens or a power of
    two, gapless, so none needs padding.  A null or empty text is the end id alone.  Rows
    with null or repeated ids are packed as documents of their own under that id.  An
    empty table gives no rows.
    """
    chars = id_and_text(docs).agg(F.sum(F.length("text") + 1)).first()[0]
    shards = max(1, -(-int(chars or 0) // shard_chars))

    def pack_shard(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        doc_id, ids = table.column("doc_id").to_pylist(), table.column("ids").to_pylist()
        shard = table.column("shard")[0].as_py()
        order = sorted(range(len(ids)), key=lambda i: (doc_id[i] is None, doc_id[i] or 0, zlib.crc32(ids[i]), len(ids[i])))
        lengths = np.array([len(ids[i]) // 4 for i in order], np.int64)
        out = [(doc_id[order[d]], start, n, int(lengths[d]), shard << 32 | s, offset,
                ids[order[d]][4 * start:4 * (start + n)]) for d, start, n, s, offset in pack(lengths)]
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset"]
        columns = list(zip(*out))
        packed = pa.Table.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:6]), pa.array(columns[6], pa.binary())],
                                      [*names, "ids"])
        del table, doc_id, ids, out, columns
        give_back_memory()
        return packed

    # by a number per row: rows that repeat id and text must not all meet in one shard
    shard = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).alias("shard")
    return tokens(docs, path).select("doc_id", "ids", shard).groupBy("shard").applyInArrow(pack_shard, PIECES)


def with_crc32(pieces: DataFrame) -> DataFrame:
    """The pieces with a CRC-32 of their ids in place of these."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")
