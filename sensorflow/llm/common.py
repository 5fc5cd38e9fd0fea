"""Shared helpers: input columns, Arrow slices of bounded size, word splitting."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: one run of the white space that separates words (Java and Python regex)
SPACE_RUN = r"[\x20\x09-\x0D]+"

#: text bytes that a Python task turns into objects at once
SLICE_BYTES = 2 << 20


#: a broadcast of ids or keys has at most this many (about 16 bytes each); more are joined by a shuffle
BROADCAST_IDS = 500_000


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def read_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` long and ``text`` only: other columns, whatever their names, stay out of the work."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def content(text: Column) -> Column:
    """Hash of the raw text; equal hashes of one id count as equal texts.  Null has a hash of its own."""
    return F.xxhash64(text.cast("string"))


def joined_rows(docs: DataFrame, keys: DataFrame, how: str, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """Rows of ``docs`` whose id and raw text are (``left_semi``) or aren't (``left_anti``) in ``keys`` (``id, raw``).

    A null id equals a null id.  Whatever the columns of ``docs`` are called, none clashes.
    """
    a, b = f"_{uuid.uuid4().hex}", f"_{uuid.uuid4().hex}"
    wanted = keys.select(F.col("id").alias(a), F.col("raw").alias(b)).distinct()
    if wanted.count() <= broadcast_ids:
        wanted = F.broadcast(wanted)
    return docs.join(wanted, docs["doc_id"].cast("long").eqNullSafe(wanted[a]) & (content(docs["text"]) == wanted[b]), how)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` (text, bytes or longs) holds about ``max_bytes`` per piece, one row at least.

    Once all is read, memory that the task no longer uses goes back to the system: workers are
    reused, and what one stage needed at most would count against the next.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        values = batch.column(column)
        size = pc.multiply(pc.list_value_length(values), 8) if pa.types.is_list(values.type) else pc.binary_length(values)
        size = pc.fill_null(size, 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + max_bytes, "right")))
            yield batch.slice(start, stop - start)
            start = stop
    give_back_memory()


def give_back_memory() -> None:
    """Return what this process no longer uses to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return pc.fill_null(column, "").cast(pa.binary()).to_pylist()


def as_texts(column: pa.Array) -> list[str]:
    """A string column, null as empty."""
    return pc.fill_null(column, "").to_pylist()


# bytes.split() separates words at exactly \x20 and \x09-\x0D, bytes.lower() changes A-Z only


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that all their bits depend on each other."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def gram_hashes(words: np.ndarray, n: int, seed: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """64-bit hash of each run of ``n`` consecutive word hashes."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    m = len(words) - n + 1
    h = np.full(m, seed & 0xFFFFFFFFFFFFFFFF, np.uint64)
    for i in range(n):
        h = mix64(h * np.uint64(0x100000001B3) + words[i:i + m])
    return h


def word_hashes(split: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts in order, and the number of words per text."""
    flat = [w for ws in split for w in ws]
    hashed = {w: xxhash.xxh3_64_intdigest(w) for w in set(flat)}
    return (np.fromiter(map(hashed.__getitem__, flat), np.uint64, len(flat)),
            np.fromiter(map(len, split), np.int64, len(split)))


def long_array(h: np.ndarray) -> pa.Array:
    """Unsigned 64-bit values as Spark longs of the same bits."""
    return pa.array(np.ascontiguousarray(h, np.uint64).view(np.int64))


def dealt_anew(column: str) -> Column:
    """The same long as a new expression: a join on it deals an aggregated side out again, so
    both sides are plain exchanges and AQE can split a hot key."""
    return F.col(column).bitwiseXOR(F.lit(0).cast("long")).alias(column)


def bitmap_of(values: DataFrame, lg_bits: int) -> np.ndarray:
    """Bytes of a bitmap of ``2**lg_bits`` bits with those set that the one long column of ``values`` names
    by its low bits: a digest of fixed size, whatever the input's, that may say yes too often but never no."""
    low = F.col(values.columns[0]).bitwiseAND(F.lit((1 << lg_bits) - 1))
    rows = (values.select(F.shiftright(low, 15).alias("bucket"), low.bitwiseAND(F.lit(32767)).alias("bit"))
            .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect())
    bitmap = np.zeros(max(1 << lg_bits, 1 << 15) >> 3, np.uint8)
    for r in rows:
        bitmap[r.bucket << 12:(r.bucket + 1) << 12] = np.frombuffer(r.bits, np.uint8)
    return bitmap


def in_bitmap(bitmap: np.ndarray, values: np.ndarray, lg_bits: int) -> np.ndarray:
    low = (values & np.uint64((1 << lg_bits) - 1)).astype(np.int64)
    return (bitmap[low >> 3] >> (low & 7)) & 1 == 1
