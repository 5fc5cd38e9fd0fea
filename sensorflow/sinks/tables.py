"""Sink-side operators.

Writes are appends of DataFrames to Parquet (or any DataFrameWriter format), a
folder per ``batch_id``; a replay of a batch replaces its folder.  The ledger is
written last, and :func:`committed` shows only batches that are in it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorflow import rules, schemas


LEDGER = "processed_ledger"
MANIFEST = "batch_manifest"


def nan_to_null(df: DataFrame) -> DataFrame:
    """K9: NaN -> NULL in every floating-point column."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.when(~F.isnan(F.col(f.name)), F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def with_optional_columns(df: DataFrame, names: Sequence[str] = ("zone", "location", "unit")) -> DataFrame:
    """Add missing optional text columns as NULL."""
    for n in names:
        if n not in df.columns:
            df = df.withColumn(n, F.lit(None).cast("string"))
    return df


def guard_not_null(df: DataFrame, required: Sequence[tuple[str, str]]) -> DataFrame:
    """Add ``reject_reason``: the first NOT NULL constraint a row breaks."""
    reason = None
    for col, msg in required:
        cond = F.col(col).isNull()
        reason = F.when(cond, F.lit(msg)) if reason is None else reason.when(cond, F.lit(msg))
    return df.withColumn("reject_reason", reason if reason is not None else F.lit(None).cast("string"))


READING_REQUIRED = (("sensor_id", rules.REASON_NULL_SENSOR_ID),
                    ("sensor_type", rules.REASON_NULL_SENSOR_TYPE),
                    ("value", rules.REASON_NULL_VALUE),
                    ("event_ts", rules.REASON_NULL_TIMESTAMP))


def reading_rows(enriched: DataFrame) -> DataFrame:
    """K4 + K9 + K10 + K11: enriched rows -> ``READING`` rows + ``reject_reason``."""
    df = nan_to_null(with_optional_columns(enriched))
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.READING.fields]
    return guard_not_null(df.select(*cols), READING_REQUIRED)


def anomaly_rows(anomalies: DataFrame) -> DataFrame:
    """K5 + K9 + K11: anomaly rows with NaN -> NULL and the NOT NULL guard."""
    df = nan_to_null(anomalies.select([F.col(f.name) for f in schemas.ANOMALY.fields]))
    return guard_not_null(df, (("sensor_id", rules.REASON_NULL_SENSOR_ID),
                               ("sensor_type", rules.REASON_NULL_SENSOR_TYPE),
                               ("event_ts", rules.REASON_NULL_TIMESTAMP)))


def dead_letter_sink_rows(dead: DataFrame, rejected: DataFrame | None = None) -> DataFrame:
    """K3: dead letters with the payload text wrapped as ``{"raw": "<text>"}``.

    ``rejected`` adds rows refused by a sink guard (``raw_event_id``, ``payload``
    text, ``reject_reason``).
    """
    d = dead.select("raw_event_id", "payload", "reason")
    if rejected is not None:
        d = d.unionByName(rejected.select("raw_event_id", F.col("payload").cast("string"),
                                          F.col("reject_reason").alias("reason")))
    return d.select("raw_event_id", F.to_json(F.struct(F.col("payload").alias("raw"))).alias("payload"),
                    "reason")


def mark_processed(ledger_path: str, ids: DataFrame, batch_id: int | str) -> None:
    """K7: record processed landing ids in an append-only ledger (idempotent per batch).

    Readers exclude ledger ids with a left anti join
    (:func:`sensorflow.sources.landing.unprocessed_batch`).  An empty id set takes
    the batch out of the ledger.
    """
    write_batch(ids.select(F.col(ids.columns[0]).cast("long").alias("id")), ledger_path, batch_id)


def insert_if_absent(existing: DataFrame, new: DataFrame, key: str | Sequence[str] = "sensor_id") -> DataFrame:
    """K8: ``existing`` plus the rows of ``new`` whose key is not present (existing rows win).

    Of several new rows with one key, the smallest by the remaining columns is inserted.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = existing.columns
    first = F.min(F.struct(*[F.col(c) for c in cols])).alias("_first")
    add = new.join(existing.select(*keys), keys, "left_anti").groupBy(*keys).agg(first).select("_first.*")
    return existing.unionByName(add)


def primary_key_violations(df: DataFrame, key: str | Sequence[str] = "sensor_id") -> DataFrame:
    """Keys that occur more than once (a dimension must be unique on its key)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def write_batch(df: DataFrame, path: str, batch_id: int | str, fmt: str = "parquet",
                partition_by: Sequence[str] = ()) -> None:
    """K1/K4-K6: write one batch into its own folder ``batch_id=...`` of the table.

    A replay replaces the whole folder: partitions and rows that the first attempt left
    and the replay no longer has are gone, also when the replay has no rows at all.
    Partitioned tables are rebalanced first, so a batch has few files per partition and
    a large partition is still written by several tasks.
    """
    writer = (df.hint("rebalance", *partition_by) if partition_by else df).write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "static").partitionBy(*partition_by)
    writer.save(f"{path}/batch_id={batch_id}")


def landing_append(landing: DataFrame, path: str, batch_id: int | str) -> None:
    """K1: append landing rows, one folder per intake batch."""
    write_batch(landing.select(*schemas.LANDING.fieldNames()), path, batch_id)


def read_batch(spark: SparkSession, path: str, batch_id: int | str, schema: T.StructType) -> DataFrame | None:
    """The rows of one batch's folder, or None if there is no such folder."""
    try:
        return spark.read.schema(schema).parquet(f"{path}/batch_id={batch_id}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def committed(spark: SparkSession, out_root: str, table: str) -> DataFrame:
    """Rows of ``table`` that belong to batches in the ledger: a batch under way or half written isn't seen.

    The ledger's batch ids are partition values, so no ledger file's rows are shuffled for it.
    """
    done = spark.read.parquet(f"{out_root}/{LEDGER}").select("batch_id").distinct()
    return spark.read.parquet(f"{out_root}/{table}").join(done, "batch_id", "left_semi")
