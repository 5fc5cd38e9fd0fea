"""Runs: pending landing rows -> the batch plan -> all tables -> one commit.

A run's batch is planned first: a range of the landing order over the intakes that are there.  An
attempt that dies anywhere before its commit leaves folders that nothing names; the next run takes
the same plan again, whatever has arrived since.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow import rules, schemas, session
from sensorflow.plans.batch import BatchResult, process
from sensorflow.sinks.tables import anomaly_rows, dead_letter_sink_rows
from sensorflow.sources.landing import rows_frame
from sensorflow.store.landing import ORDER, Landing, above, advanced, mark_of, still_open
from sensorflow.store.log import CommitLog, State
from sensorflow.store.tables import commit_batch, committed_ids, read_dimension, write_attempt, write_dimension

#: called between the tables and the commit, with the batch's number
BeforeCommit = Callable[[int], None]


def observed_sensors(clean: DataFrame) -> DataFrame:
    """Dimension rows of the sensors of clean rows: the type of the first row in input order, nothing else known."""
    first = (clean.where("sensor_id is not null").groupBy("sensor_id")
             .agg(F.min_by("sensor_type", F.struct("received_at", "raw_event_id")).alias("sensor_type")))
    return first.select(*[F.col(f.name) if f.name in first.columns else F.lit(None).cast(f.dataType).alias(f.name)
                          for f in schemas.METADATA.fields])


def outputs(result: BatchResult) -> dict[str, DataFrame]:
    """Rows of each table but the counters."""
    readings = result.readings
    payload = result.classified.select(F.col("id").cast("long").alias("raw_event_id"), "payload")
    rejected = (readings.where("reject_reason is not null").select("raw_event_id", "reject_reason")
                .join(payload, "raw_event_id", "left").select("raw_event_id", "payload", "reject_reason"))
    return {"sensor_readings": readings.where("reject_reason is null").drop("reject_reason"),
            "anomalies": anomaly_rows(result.anomalies).where("reject_reason is null").drop("reject_reason"),
            "dead_letter_events": dead_letter_sink_rows(result.dead_letters, rejected),
            "clean_events": result.clean}


def counters(spark: SparkSession, result: BatchResult) -> DataFrame:
    """The counters that the jobs of the other tables observed, as one row."""
    got = {k: v for name in result.metrics.values() for k, v in name.get.items()}
    return rows_frame(spark, [tuple(got[f.name] for f in schemas.RUN_METRICS.fields)], schemas.RUN_METRICS)


def write_batch(log: CommitLog, rows: DataFrame, n_rows: int, batch: int, method: str, state: State) -> tuple[State, str, list[str]]:
    """Write all tables of one batch to an attempt's folders; the state to commit, the attempt, the tables."""
    spark, attempt = log.spark, uuid.uuid4().hex
    session.ensure_utc(spark)
    repeated = committed_ids(log, rows.select("id"), n_rows, state) if state.n_batches else None
    result = process(rows, read_dimension(log, state), method=method, known=repeated, observe=f"attempt_{attempt}",
                     staging=f"{log.root}/_staging/{attempt}")
    tables = outputs(result)
    with ThreadPoolExecutor(max_workers=len(tables) + 1) as pool:
        writes = [pool.submit(write_attempt, log, df, name, batch, attempt) for name, df in tables.items()]
        dimension = pool.submit(write_dimension, log, state, observed_sensors(result.clean))
        for f in writes:
            f.result()
        write_attempt(log, counters(spark, result), "run_metrics", batch, attempt)
        return dimension.result(), attempt, [*tables, "run_metrics"]


def plan_batch(log: CommitLog, landing: Landing, state: State, limit: int | None) -> dict | None:
    """Which rows the next batch takes: as planned before, else the oldest pending ones; None if there are none.

    A plan is a range of the landing order, so taking it again gives the same rows.
    """
    plan = log.plan(state.n_batches)
    if plan is not None:
        return plan
    folders, last = landing.candidates(state)
    keys = landing.rows_between(folders, state.marks, None, state.tail).select(*ORDER)
    key = F.struct(F.unix_micros("received_at").alias("at"), "id")
    n, top = (keys if limit is None else keys.orderBy(*ORDER).limit(limit)).agg(F.count(F.lit(1)), F.max(key)).first()
    if not n:
        return None
    mark = None if limit is None or n < limit else [top["at"], top["id"]]
    return log.plan(state.n_batches, {"folders": folders, "marks": state.marks, "tail": state.tail, "last": last, "mark": mark,
                                      "rows": n})


def planned_rows(landing: Landing, plan: dict) -> DataFrame:
    return landing.rows_between(plan["folders"], plan["marks"], plan["mark"], plan["tail"]).select(*schemas.LANDING.fieldNames())


def run_pending(log: CommitLog, landing: Landing, *, limit: int | None = rules.BATCH_LIMIT, method: str = "sweep",
                before_commit: BeforeCommit | None = None) -> State | None:
    """One scheduled run: the ``limit`` oldest pending rows through all tables, with one commit.

    Rows that share the last one's time and id come along.  None if nothing is pending.
    """
    state = log.latest()
    batch, plan = state.n_batches, plan_batch(log, landing, state, limit)
    if plan is None:
        return None
    state, attempt, tables = write_batch(log, planned_rows(landing, plan), plan["rows"], batch, method, state)
    state.marks = advanced(state.marks, plan["last"], plan["mark"])
    state.open = still_open(plan["folders"], state.marks)
    state.tail = tail_above(log, state, plan["folders"])
    if before_commit:
        before_commit(batch)
    return commit_batch(log, state, batch, attempt, tables)


def replay(log: CommitLog, landing: Landing, batch: int, *, method: str = "sweep",
           before_commit: BeforeCommit | None = None) -> State:
    """Compute a committed batch again from its plan; readers have the earlier attempt until the commit."""
    state, plan = log.latest(), log.plan(batch)
    if plan is None or batch >= state.n_batches:
        raise ValueError(f"batch {batch} isn't committed")
    # keys of the batch itself are no repeats of it
    others, attempt, tables = write_batch(log, planned_rows(landing, plan), plan["rows"], batch, method, _without(state, batch))
    state.dimension = others.dimension
    if before_commit:
        before_commit(batch)
    return commit_batch(log, state, batch, attempt, tables)


def _without(state: State, batch: int) -> State:
    """The state as if the batch had no rows."""
    out = State(**{**vars(state), "attempts": [x for x in state.attempts if x[0] != batch], "redone": dict(state.redone)})
    if len(out.attempts) == len(state.attempts):
        out.redone[str(batch)] = ""
    return out


def mark_done(log: CommitLog, landing: Landing, ids: DataFrame) -> State:
    """K7: mark rows by id (a column ``id``) in any order; an empty set changes nothing."""
    state = log.latest()
    found = landing.pending(state).select("intake", *ORDER).join(ids.select("id"), "id", "left_semi")
    if found.isEmpty():
        return state
    if state.tail:
        found = found.unionByName(log.spark.read.parquet(state.tail))
    folder = f"{log.root}/_tails/{uuid.uuid4().hex}"
    found.write.parquet(folder)
    state.tail = folder
    return log.commit(state)


def tail_above(log: CommitLog, state: State, folders: list) -> str | None:
    """The list of ids done out of order, without those of ``folders`` that the marks have passed."""
    if not state.tail:
        return None
    passed = F.lit(False)
    for number, name in {(f[0], f[1]) for f in folders}:
        passed = passed | ((F.col("intake") == name) & ~above(mark_of(state.marks, number)))
    folder = f"{log.root}/_tails/{uuid.uuid4().hex}"
    log.spark.read.parquet(state.tail).where(~passed).write.parquet(folder)
    return None if log.spark.read.parquet(folder).isEmpty() else folder


def seed_dimension(log: CommitLog, seed: DataFrame) -> State:
    """K8: the seed sensors, where the dimension lacks them."""
    return log.commit(write_dimension(log, log.latest(), seed))


def stream_writer(log: CommitLog, method: str = "sweep", before_commit: BeforeCommit | None = None):
    """``foreachBatch`` function of a stream of landing rows: one micro-batch, one commit.

    A micro-batch that comes again after its commit has the same rows and is left alone; one that
    failed before it is written anew.  A stream has an output root of its own.
    """
    def write(rows: DataFrame, batch: int) -> None:
        state = log.latest()
        if batch < state.n_batches:
            return
        state, attempt, tables = write_batch(log, rows.select(*schemas.LANDING.fieldNames()), rows.count(), batch, method, state)
        if before_commit:
            before_commit(batch)
        commit_batch(log, state, batch, attempt, tables)
    return write
