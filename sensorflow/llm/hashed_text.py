"""Hashed features, bounded training samples and sparse linear algebra of the two classifiers."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import as_texts, id_and_text, slices

#: labelled rows whose crc32(doc_id as text) mod HOLD_OUT_OF is HOLD_OUT are never learned from
HOLD_OUT_OF, HOLD_OUT = 3, 1


def bucket(token: str, lg_size: int) -> int:
    return xxhash.xxh3_64_intdigest(token) >> (64 - lg_size)


def held_out(doc_id: Column) -> Column:
    """True for the rows kept for evaluation (false for a null id)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % HOLD_OUT_OF == HOLD_OUT, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: Column, max_rows: int) -> DataFrame:
    """``doc_id, text, label`` of at most ``max_rows`` labelled rows that aren't held out.

    Rows in the order of a hash of their id, so the sample doesn't depend on the input's
    layout.  Rows without id or label are left out; of repeated labels the largest counts.
    """
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), label.cast("int").alias("label"))
             .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("label").alias("label"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    return id_and_text(docs).join(F.broadcast(known), "doc_id")


def collect_features(sample: DataFrame, features: Callable[[str], dict[int, float]], max_rows: int):
    """``(rows, columns, values, labels, texts' number)`` of a bounded sample, gathered on the driver.

    Values are None where all are one."""

    def extract(batches):
        for piece in slices(batches):
            found = [features(t) for t in as_texts(piece.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("label"), pa.array([list(f) for f in found], pa.list_(pa.int32())),
                 pa.array([list(f.values()) for f in found], pa.list_(pa.float32()))],
                ["doc_id", "label", "columns", "values"])

    table = (sample.select("doc_id", "text", "label")
             .mapInArrow(extract, "doc_id long, label int, columns array<int>, values array<float>")
             .limit(max_rows).toArrow().combine_chunks())
    # a fixed order, whatever the order of arrival
    table = table.sort_by([("doc_id", "ascending"), ("label", "ascending")]).combine_chunks()
    if not table.num_rows:
        return np.zeros(0, np.int32), np.zeros(0, np.int32), None, np.zeros(0, np.int64), 0
    columns, labels = table.column("columns").combine_chunks(), table.column("label").to_numpy().astype(np.int64)
    size = pc.list_value_length(columns).to_numpy(zero_copy_only=False)
    values = table.column("values").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return (np.repeat(np.arange(len(size), dtype=np.int32), size), columns.flatten().to_numpy(zero_copy_only=False),
            None if (values == 1).all() else values, labels, len(size))


def frequent_columns(columns: np.ndarray, least: int, size: int) -> np.ndarray:
    """Which columns occur in ``least`` rows or more."""
    return np.bincount(columns, minlength=size) >= least


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


class Sparse:
    """Rows of (column, value) pairs, values None for ones; products with a vector from either side."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray | None, n_rows: int, n_columns: int):
        self.rows, self.columns, self.values = rows, columns, values
        self.shape = n_rows, n_columns

    def weighted(self, x: np.ndarray) -> np.ndarray:
        return x if self.values is None else x * self.values

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, self.weighted(w[self.columns]), minlength=self.shape[0])

    def t_dot(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, self.weighted(g[self.rows]), minlength=self.shape[1])
