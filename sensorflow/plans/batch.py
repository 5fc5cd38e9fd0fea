"""The batch plan: landing rows -> flatten -> clean -> enrich -> detect -> sinks.

One lazy plan per stage; the classified frame (after dedup and validation) is
the only fan-out point (clean rows, dead letters), so it is written once to a
staging folder of its own under the output root before the sinks read it.  The ids
of a batch are written before anything else (its manifest): a replay takes the same
rows, whatever has arrived since, and marks exactly these.  Shuffles: dedup
by (sensor, raw timestamp), z-score by (sensor, time block), motion counts by
(sensor, minute); the dimension join is the planner's choice.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sensorflow import rules, schemas, session
from sensorflow.operators.clean import classify, clean_rows, dead_letter_rows
from sensorflow.operators.detect import detect_anomalies
from sensorflow.operators.enrich import enrich_events
from sensorflow.sinks.tables import (
    LEDGER,
    MANIFEST,
    anomaly_rows,
    dead_letter_sink_rows,
    mark_processed,
    read_batch,
    reading_rows,
    write_batch,
)
from sensorflow.sources.landing import clean_by_ids, flatten_payload, unprocessed_batch


@dataclass
class BatchResult:
    clean: DataFrame
    dead_letters: DataFrame
    enriched: DataFrame
    anomalies: DataFrame
    readings: DataFrame
    landing_ids: DataFrame
    classified: DataFrame
    curated: str | None = None
    metrics: dict[str, Observation] = field(default_factory=dict)


def process(landing: DataFrame, metadata: DataFrame, *, method: str = "sweep",
            staging: str | None = None, observe: str | None = None, curated: str | None = None,
            ids: DataFrame | None = None, known: DataFrame | None = None, block_seconds: int = 4 * 3600,
            by: tuple[str, ...] = ()) -> BatchResult:
    """Plan of one batch (no sink writes).

    ``staging`` names a folder in shared storage: the classified frame (the
    only fan-out point: clean rows, dead letters, detectors) is written there
    once and read back, which cuts the lineage and keeps the dedup shuffle
    from being recomputed by each sink.  ``curated`` names a folder to write the
    clean rows to first; enrichment then reads them from there by id.  ``ids`` is
    the batch's manifest (default: the ids of ``landing``).  Clean rows whose ``id`` is in
    ``known`` (keys committed before) become dead letters.  ``observe`` names the
    run counters (``Observation`` metrics, no extra job).  ``by`` (e.g.
    ``("batch_id",)``) keeps dedup, windows and minute counts inside each batch (D13).
    """
    session.ensure_utc(landing.sparkSession)
    classified = classify(flatten_payload(landing, keep=by), by=by)
    if known is not None:
        repeated = F.when(F.col("_known"), F.lit(rules.REASON_REPEATED_KEY))
        classified = (classified.join(known.select("id", F.lit(True).alias("_known")), "id", "left")
                      .withColumn("reason", F.coalesce("reason", repeated)).drop("_known"))
    metrics: dict[str, Observation] = {}
    if observe:
        # T4 run counters, collected by the job that computes the frame (no extra job)
        metrics["clean"] = Observation(f"{observe}_clean")
        classified = classified.observe(
            metrics["clean"], F.count(F.lit(1)).alias("deduped_rows"),
            F.count_if(F.col("reason").isNull()).alias("clean_rows"),
            F.count_if(F.col("reason").isNotNull()).alias("dead_letter_rows"))
    if staging:
        classified.write.mode("overwrite").parquet(staging)
        classified = landing.sparkSession.read.parquet(staging)
    clean = clean_rows(classified, keep=by)
    dead = dead_letter_rows(classified)
    ids = landing.select("id") if ids is None else ids
    if curated:
        clean.write.mode("overwrite").parquet(curated)
        clean = clean_by_ids(landing.sparkSession.read.schema(clean.schema).parquet(curated), ids)
    enriched = enrich_events(clean, metadata)
    anomalies = detect_anomalies(enriched, method=method, block_seconds=block_seconds, by=by)
    readings = reading_rows(enriched)
    if observe:
        metrics["readings"] = Observation(f"{observe}_readings")
        readings = readings.observe(metrics["readings"], F.count(F.lit(1)).alias("rows"),
                                    F.count_if(F.col("zone").isNull()).alias("rows_without_zone"),
                                    F.count_if(F.col("reject_reason").isNotNull()).alias("rejected_rows"))
    return BatchResult(clean=clean, dead_letters=dead, enriched=enriched, anomalies=anomalies,
                       readings=readings, landing_ids=ids, classified=classified, curated=curated, metrics=metrics)


def write_outputs(result: BatchResult, out_root: str, batch_id: int | str, parallel: bool = True) -> None:
    """K6: all sinks of one batch, each idempotent on ``batch_id``.

    The batch leaves the ledger first, so readers of committed batches don't see a replay
    half done.  The data sinks are independent Spark jobs and are submitted together (one
    driver thread each); the ledger is written after all of them succeeded, so a failure
    anywhere leaves the batch uncommitted and its replay replaces what was written.
    """
    readings = result.readings
    ok = readings.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    payload = result.classified.select(F.col("id").cast("long").alias("raw_event_id"), "payload")
    rejected = (readings.filter(F.col("reject_reason").isNotNull()).select("raw_event_id", "reject_reason")
                .join(payload, "raw_event_id", "left").select("raw_event_id", "payload", "reject_reason"))
    anomalies = anomaly_rows(result.anomalies).filter(F.col("reject_reason").isNull()).drop("reject_reason")
    jobs = [
        lambda: write_batch(ok.withColumn("event_date", F.to_date("event_ts")), f"{out_root}/sensor_readings",
                            batch_id, partition_by=("event_date",)),
        lambda: write_batch(anomalies, f"{out_root}/anomalies", batch_id),
        lambda: write_batch(dead_letter_sink_rows(result.dead_letters, rejected),
                            f"{out_root}/dead_letter_events", batch_id),
    ]
    if not result.curated:
        jobs.append(lambda: write_batch(result.clean, f"{out_root}/clean_events", batch_id))
    mark_processed(f"{out_root}/{LEDGER}", result.landing_ids.limit(0), batch_id)
    if parallel:
        with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
            for f in [pool.submit(j) for j in jobs]:
                f.result()
    else:
        for j in jobs:
            j()
    mark_processed(f"{out_root}/{LEDGER}", result.landing_ids, batch_id)


def manifest(batch: DataFrame, out_root: str, batch_id: int | str, renew: bool = False) -> DataFrame:
    """Ids of the batch, written once: a replay gets those of the first attempt (``renew``: of ``batch``)."""
    spark, path = batch.sparkSession, f"{out_root}/{MANIFEST}"
    schema = schemas.LANDING["id"]
    ids = None if renew else read_batch(spark, path, batch_id, type(schemas.LANDING)([schema]))
    if ids is None:
        write_batch(batch.select("id"), path, batch_id)
        ids = read_batch(spark, path, batch_id, type(schemas.LANDING)([schema]))
    return ids


def staging_folder(out_root: str, batch_id: int | str) -> str:
    """A folder of this attempt's own: runs on one root don't overwrite each other's frames."""
    return f"{out_root}/_staging/{batch_id}-{uuid.uuid4().hex}"


def run_once(landing: DataFrame, metadata: DataFrame, out_root: str, batch_id: int | str, *,
             limit: int | None = None, ledger: DataFrame | None = None,
             method: str = "sweep", observe: str | None = "run", curated: bool = False) -> BatchResult:
    """One scheduled run: all pending rows, or the ``limit`` oldest, processed and written.

    ``curated`` takes the route over the clean table: it is written first and read again by ids.
    ``result.metrics`` holds the run counters once the writes are done."""
    ids = manifest(unprocessed_batch(landing, limit, ledger), out_root, batch_id)
    result = process(landing.join(ids, "id", "left_semi"), metadata, method=method, ids=ids,
                     staging=staging_folder(out_root, batch_id), observe=observe,
                     curated=f"{out_root}/clean_events/batch_id={batch_id}" if curated else None)
    write_outputs(result, out_root, batch_id)
    return result
