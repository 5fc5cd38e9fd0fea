"""Whole flows over the derived feed: messages -> landing -> runs -> all tables, with faults planted.

Each flow runs once per session and input folder; the registered queries read its tables.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow import session
from sensorflow.sources import derived
from sensorflow.sources.intake import messages_to_landing
from sensorflow.sources.landing import seed_metadata
from sensorflow.store import CommitLog, Landing, compact, replay, run_pending, seed_dimension
from sensorflow.streaming.microbatch import landing_stream, start_committed, start_deduplicated_intake

#: runs take a sixth of the messages each, and five are made
SHARE, RUNS = 6, 5


class Stopped(RuntimeError):
    """The planted fault."""


def stop_once(batch: int) -> Callable[[int], None]:
    """A hook that stops the first attempt of ``batch`` between its tables and its commit."""
    seen: list[int] = []

    def hook(now: int) -> None:
        if now == batch and not seen:
            seen.append(now)
            raise Stopped(f"batch {now}")
    return hook


def new_root(spark: SparkSession, name: str) -> str:
    return os.path.join(session.checkpoint_dir(spark), "flows", f"{name}-{uuid.uuid4().hex}")


def scheduled_flow(spark: SparkSession, events: DataFrame) -> tuple[CommitLog, Landing]:
    """Four parts of messages through a stream that drops redeliveries, and five capped runs.

    Two runs after the second part, so that the third part's late messages are below the mark;
    then a second consumer lands old messages again.  The fourth run is stopped before its commit
    and made again, the second one is replayed after the tables were compacted.
    """
    root = new_root(spark, "scheduled")
    log, landing = CommitLog(spark, f"{root}/out"), Landing(spark, f"{root}/landing")
    deliveries = session.staged(derived.derive_deliveries(events), "deliveries")
    limit = -(-max(1, events.count()) // SHARE)
    seed_dimension(log, seed_metadata(spark))
    for part in range(derived.PARTS):
        deliveries.where(F.col("part") == part).drop("part").hint("rebalance").write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(deliveries.drop("part").schema).parquet(f"{root}/in")
        start_deduplicated_intake(stream, landing, f"{root}/intake", id_col="id", trigger={"availableNow": True}).awaitTermination()
        if part == 1:
            run_pending(log, landing, limit=limit)
            run_pending(log, landing, limit=limit)
    again = deliveries.where(F.col("part") == derived.PARTS)
    landing.append(messages_to_landing(again, id_col="id"), 0, source="second")
    run_pending(log, landing, limit=limit)
    compact(log)
    try:
        run_pending(log, landing, limit=limit, before_commit=stop_once(3))
    except Stopped:
        run_pending(log, landing, limit=limit)
    run_pending(log, landing, limit=limit)
    replay(log, landing, 1)
    return log, landing


def restarted_stream(spark: SparkSession, landing_rows: DataFrame, files: int = 4) -> CommitLog:
    """Landing files, four per micro-batch, through a stream that is stopped before its second commit and started again."""
    root = new_root(spark, "restarted")
    log = CommitLog(spark, f"{root}/out")
    seed_dimension(log, seed_metadata(spark))
    rows = session.staged(landing_rows.withColumn("e", F.expr("id div 2")), "landing")
    total = (rows.agg(F.max("e")).first()[0] or 0) + 1
    part = F.least(F.lit(derived.PARTS - 1), F.expr(f"{derived.PARTS} * e div {total}"))
    for k in range(derived.PARTS):
        rows.where(part == k).drop("e").repartition(files).write.mode("append").parquet(f"{root}/landing")
    hook = stop_once(1)
    while True:
        query = start_committed(landing_stream(spark, f"{root}/landing", max_files_per_trigger=files), log, f"{root}/checkpoint",
                                trigger={"availableNow": True}, before_commit=hook)
        try:
            query.awaitTermination()
            return log
        except Exception as e:
            if "Stopped" not in str(e):
                raise
