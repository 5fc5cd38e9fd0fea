"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Two texts are equal when they are identical after each run of ``[\\x20\\x09-\\x0D]`` became
one space.  Each level groups only what the level before left in a group of two or more:

1. one narrow pass: rows per (length, hash of the first characters), counted map-side;
2. only rows of surviving (length, prefix) groups hash their full content (SHA-256);
   the surviving keys are broadcast, or joined by a shuffle if more than ``broadcast_keys``;
3. rows per full hash, counted map-side by (hash, id) and then by hash.

A hot group never meets in one task: its rows are summed before each shuffle, and the
rows find their group's summary by a join whose sides Spark may split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import BROADCAST_IDS as BROADCAST_KEYS
from sensorflow.llm.common import SPACE_RUN, content, joined_rows
from sensorflow.session import staged

PREFIX_CHARS = 64

KEY = ["_length", "_prefix"]


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACE_RUN, " ")


def with_keys(docs: DataFrame, *columns: Column) -> DataFrame:
    """``columns`` of ``docs`` and the normalised text's length and prefix hash."""
    norm = normalised(F.col("text"))
    return docs.select(*columns, F.length(norm).cast("long").alias("_length"),
                       F.xxhash64(F.substring(norm, 1, PREFIX_CHARS)).alias("_prefix"))


def surviving_keys(docs: DataFrame) -> DataFrame:
    """``_length, _prefix`` that two rows or more share."""
    return staged(with_keys(docs).groupBy(*KEY).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*KEY), "lengths")


def looked_up(keyed: DataFrame, shared: DataFrame, how: str, broadcast_keys: int) -> DataFrame:
    """Rows joined with the surviving keys."""
    return keyed.join(F.broadcast(shared) if shared.count() <= broadcast_keys else shared, KEY, how)


def copy_groups(docs: DataFrame, shared: DataFrame, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """``_hash, keep_id, group_size, n_keep`` of every text that occurs in two rows or more.

    ``shared`` are the :func:`surviving_keys`.  ``keep_id`` is the smallest id among equal
    texts (null ids rank last), ``n_keep`` the rows that carry it.
    """
    keyed = looked_up(with_keys(docs, F.col("doc_id").cast("long").alias("_id"), F.col("text")), shared, "left_semi",
                      broadcast_keys)
    return (keyed.select("_id", F.sha2(normalised(F.col("text")), 256).alias("_hash"))
            .groupBy("_hash", "_id").agg(F.count(F.lit(1)).alias("_n"))
            .groupBy("_hash").agg(F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_n")).alias("_first"),
                                  F.sum("_n").alias("group_size"))
            .where("group_size > 1")
            .select("_hash", F.col("_first._id").alias("keep_id"), "group_size", F.col("_first._n").alias("n_keep")))


def dedup_decisions(docs: DataFrame, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """Per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Null texts count as empty; empty texts are equal to each other.  Rows with a null id
    form groups like others, and a null id stays only where no equal text has an id.
    Repeated rows (same id, same text) each count in ``group_size`` and share one
    decision; :func:`drop_copies` leaves one of them.  Same id with different texts:
    judged separately.  An empty table gives no rows.
    """
    groups = staged(copy_groups(docs, surviving_keys(docs), broadcast_keys), "copies")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.sha2(normalised(F.col("text")), 256).alias("_hash"))
    alone = F.col("group_size").isNull()
    return rows.join(groups, "_hash", "left").select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"), F.col("_hash").alias("text_sha256"))


def refined(docs: DataFrame, shared: DataFrame, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """``_id, _raw, _again, _hash`` of all rows: id, hash of the raw text, whether the row shares its length and
    prefix, and then the full hash; a row alone with these has them in place of a full hash."""
    keyed = with_keys(docs, F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("_text"))
    return looked_up(keyed, shared.withColumn("_again", F.lit(True)), "left", broadcast_keys).select(
        "_id", content(F.col("_text")).alias("_raw"), F.coalesce("_again", F.lit(False)).alias("_again"),
        F.when(F.col("_again"), F.sha2(normalised(F.col("_text")), 256)).otherwise(F.concat_ws(":", *KEY)).alias("_hash"))


def copies(docs: DataFrame, shared: DataFrame, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """``id, raw, n, kept`` of every id and raw text (by its hash) that occurs in two rows or more once normalised.

    One is kept per text: the smallest id (null ids last), then the smallest hash; ``n`` rows have both.
    """
    rows = staged(refined(docs, shared, broadcast_keys).where("_again").groupBy("_hash", "_id", "_raw").agg(F.count(F.lit(1)).alias("n"))
                  .select("_hash", F.col("_id").alias("id"), F.col("_raw").alias("raw"), "n"), "again")
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "raw")
    first = staged(rows.groupBy("_hash").agg(F.min(rank).alias("_first"), F.sum("n").alias("_all")).where("_all > 1")
                   .select("_hash", "_first"), "first")
    return rows.join(first, "_hash").select("id", "raw", "n", (rank == F.col("_first")).alias("kept"))


def drop_copies(docs: DataFrame, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were.

    The row with the smallest id stays; of rows that repeat id and text, any one.  Null texts
    count as empty, and empty texts are equal to each other; a null id stays only where no equal
    text has an id.  An empty table gives an empty one.  Decisions are made on ids and hashes; texts
    stay where they are unless more than ``broadcast_keys`` rows go.
    """
    judged = staged(copies(docs, surviving_keys(docs), broadcast_keys), "judged")
    left = joined_rows(docs, judged.where("not kept"), "left_anti", broadcast_keys)
    repeated = staged(judged.where("kept and n > 1"), "repeated")
    if repeated.isEmpty():
        return left
    again = joined_rows(left, repeated, "left_semi", broadcast_keys).select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"),
        content(F.col("text")).alias("raw"))
    return joined_rows(left, repeated, "left_anti", broadcast_keys).unionAll(again.dropDuplicates(["id", "raw"]).select("row.*"))


ORACLE = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM n JOIN g USING (norm)
"""
