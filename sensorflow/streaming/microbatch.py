"""Structured Streaming front end.

The landing feed is read as a stream; each micro-batch runs the same batch
plan inside ``foreachBatch``.  Non-time windows (dedup ranking, the z-score
sweep) are not allowed on a streaming DataFrame but are allowed on the static
micro-batch frame, so all operators run unchanged.  Every sink write is keyed
by the micro-batch id, so a replay after a failure overwrites instead of
duplicating (at-least-once source + idempotent sink = effectively once).
Window state does not cross batches: each batch is scored on its own rows,
as the scheduled runs are.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from sensorflow import schemas, session
from sensorflow.plans.batch import manifest, process, staging_folder, write_outputs
from sensorflow.sinks.tables import landing_append
from sensorflow.sources.intake import drop_redelivered, messages_to_landing, subscribe
from sensorflow.store import CommitLog, Landing
from sensorflow.store.runs import BeforeCommit, stream_writer


def landing_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Landing rows as a stream from a folder of files."""
    r = spark.readStream.format(fmt).schema(schemas.LANDING)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def message_stream_to_landing(messages: DataFrame, prefix: str = "sensors", id_col: str | None = None) -> DataFrame:
    """T1 from a broker-shaped stream (e.g. Kafka ``topic``/``value``/``timestamp``)."""
    if "received_at" not in messages.columns and "timestamp" in messages.columns:
        messages = messages.withColumnRenamed("timestamp", "received_at")
    return messages_to_landing(subscribe(messages, prefix), id_col=id_col)


def batch_writer(metadata: DataFrame, out_root: str, method: str = "sweep",
                 on_metrics: Callable[[int, dict], None] | None = None):
    """``foreachBatch`` function: one micro-batch -> all sinks, keyed by batch id.

    ``on_metrics`` gets the batch id and its run counters (T4) once the writes are done.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        session.ensure_utc(batch.sparkSession)
        ids = manifest(batch, out_root, batch_id, renew=True)
        result = process(batch, metadata, method=method, ids=ids, staging=staging_folder(out_root, batch_id),
                         observe=f"batch_{batch_id}" if on_metrics else None)
        write_outputs(result, out_root, batch_id)
        if on_metrics:
            on_metrics(batch_id, {name: o.get for name, o in result.metrics.items()})
    return write


def start_intake(messages: DataFrame, landing_path: str, checkpoint: str, *, prefix: str = "sensors",
                 id_col: str | None = None, trigger: dict | None = None):
    """T1 + K1: messages -> landing rows, appended a folder per micro-batch (a replay replaces it)."""
    rows = message_stream_to_landing(messages, prefix, id_col)
    return (rows.writeStream.foreachBatch(lambda batch, batch_id: landing_append(batch, landing_path, batch_id))
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "1 minute"})).start())


def start_deduplicated_intake(messages: DataFrame, landing: Landing, checkpoint: str, *, source: str = "stream",
                              prefix: str = "sensors", id_col: str | None = None, window: str = "1 hour",
                              trigger: dict | None = None, partitions: int | None = None):
    """T1 + K1, at-least-once source: messages -> landing rows, each id once per ``window``, an intake per micro-batch.

    ``partitions`` of the remembered ids, which the checkpoint's first start fixes: each writes its files in every
    micro-batch, however few rows there are.  By default as many as the cluster runs at once, at most the session's
    shuffle partitions; all ids are held in memory in any case.
    """
    rows = drop_redelivered(message_stream_to_landing(messages, prefix, id_col), window)
    writer = (rows.writeStream.foreachBatch(lambda batch, batch_id: landing.append(batch, batch_id, source))
              .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "1 minute"})))
    # a stream keeps the settings that its session has at the start
    spark, name = messages.sparkSession, "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(partitions or min(int(before), spark.sparkContext.defaultParallelism)))
    try:
        return writer.start()
    finally:
        spark.conf.set(name, before)


def start_committed(stream: DataFrame, log: CommitLog, checkpoint: str, *, trigger: dict | None = None,
                    method: str = "sweep", before_commit: BeforeCommit | None = None):
    """Micro-batches of landing rows through all tables of ``log``, one commit each."""
    return (stream.writeStream.foreachBatch(stream_writer(log, method, before_commit))
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "5 minutes"})).start())


def start(stream: DataFrame, metadata: DataFrame, out_root: str, checkpoint: str, *,
          trigger: dict | None = None, method: str = "sweep",
          on_metrics: Callable[[int, dict], None] | None = None):
    """Start the micro-batch query (default trigger: every 5 minutes)."""
    trig = trigger or {"processingTime": "5 minutes"}
    return (stream.writeStream.foreachBatch(batch_writer(metadata, out_root, method, on_metrics))
            .option("checkpointLocation", checkpoint).trigger(**trig).start())


def run_available_now(spark: SparkSession, source: str, out_root: str, metadata: DataFrame, *,
                      max_files_per_trigger: int | None = None, method: str = "sweep") -> str:
    """Process everything currently in ``source`` and stop; returns ``out_root``."""
    q = start(landing_stream(spark, source, max_files_per_trigger=max_files_per_trigger), metadata,
              out_root, os.path.join(out_root, "_checkpoint"), trigger={"availableNow": True}, method=method)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return out_root
