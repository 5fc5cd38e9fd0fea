"""Tables of an output root: folders per attempt until compaction, then files by date.

``<table>/folder=a-<batch>-<attempt>/<date column>=...`` holds what one attempt wrote,
``<table>/folder=c-<id>/<date column>=...`` what a compaction did.  Every row carries its batch and
attempt.  A compaction writes the rows of all committed attempts once, clustered by date, and
then merges each date's folders of one level when there are ``fan_in`` of them: a row is written
again once per level, and a date has fewer than ``fan_in`` folders per level, however many
batches there were.  Folders that no record names are left where they are.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorflow import schemas
from sensorflow.sinks.tables import insert_if_absent, primary_key_violations
from sensorflow.sources.landing import rows_frame
from sensorflow.store.log import CommitLog, State


def _with(schema: T.StructType, *fields: tuple[str, str]) -> T.StructType:
    out = T.StructType(list(schema.fields))
    for name, kind in (*fields, ("batch_id", "long"), ("attempt", "string")):
        out = out.add(name, kind)
    return out


#: table -> its columns, and the date that its files are clustered by (None: none)
TABLES: dict[str, tuple[T.StructType, str | None]] = {
    "sensor_readings": (_with(schemas.READING, ("ingested_at", "timestamp"), ("event_date", "date")), "event_date"),
    "anomalies": (_with(schemas.ANOMALY, ("detected_at", "timestamp"), ("event_date", "date")), "event_date"),
    "clean_events": (_with(schemas.CLEAN, ("ingested_at", "timestamp"), ("event_date", "date")), "event_date"),
    "dead_letter_events": (_with(schemas.DEAD_LETTER, ("failed_at", "timestamp")), None),
    "run_metrics": (_with(schemas.RUN_METRICS), None),
}
FAN_IN = 8
#: a date whose value is null
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def attempt_folder(table: str, batch: int, attempt: str) -> str:
    return f"{table}/folder=a-{batch}-{attempt}"


def _write(df: DataFrame, path: str, date: str | None) -> None:
    if date:
        df.hint("rebalance", date).write.partitionBy(date).parquet(path)
    else:
        df.hint("rebalance").write.parquet(path)


def write_attempt(log: CommitLog, df: DataFrame, table: str, batch: int, attempt: str) -> None:
    """Write a table's rows of one attempt; nobody sees them before the attempt is committed."""
    schema, date = TABLES[table]
    stamps = {"ingested_at": F.current_timestamp(), "detected_at": F.current_timestamp(), "failed_at": F.current_timestamp(),
              "event_date": F.to_date("event_ts") if "event_ts" in df.columns else None,
              "batch_id": F.lit(batch).cast("long"), "attempt": F.lit(attempt)}
    rows = df.select(*[(F.col(f.name) if f.name in df.columns else stamps[f.name]).cast(f.dataType).alias(f.name)
                       for f in schema.fields])
    _write(rows, f"{log.root}/{attempt_folder(table, batch, attempt)}", date)


def _scan(log: CommitLog, table: str, paths: list[str], values: list[str] | None) -> DataFrame:
    """Rows of some folders, of the date values given only, if any are."""
    schema, date = TABLES[table]
    if date and values is not None:
        paths = [f"{p}/{n}" for p in paths for n in log.folder.names(p) if n.startswith(f"{date}=") and n.partition("=")[2] in values]
    if not paths:
        return rows_frame(log.spark, [], schema)
    return (log.spark.read.schema(T.StructType([*schema.fields, T.StructField("folder", T.StringType())]))
            .option("basePath", f"{log.root}/{table}").parquet(*[f"{log.root}/{p}" for p in paths]).select(*schema.fieldNames()))


def read_table(log: CommitLog, table: str, state: State | None = None, dates: list[str] | None = None) -> DataFrame:
    """Committed rows of ``table``; of ``dates`` (ISO) only, if given: no other date's folder is looked at."""
    state = state or log.latest()
    pieces = log.layout(state).get(table, {})
    chosen = [folder for value, held in pieces.items() if dates is None or value in dates or not TABLES[table][1]
              for _, folder in held]
    compacted = _scan(log, table, chosen, None)
    for batch, attempt in state.redone.items():
        compacted = compacted.where((F.col("batch_id") != int(batch)) | (F.col("attempt") == attempt))
    fresh = [attempt_folder(table, b, a) for b, a, tables in state.attempts if table in tables]
    if not fresh:
        return compacted
    rest = _scan(log, table, fresh, dates)
    return compacted.unionAll(rest) if chosen else rest


def commit_batch(log: CommitLog, state: State, batch: int, attempt: str, tables: list[str]) -> State:
    """Make an attempt the one that counts for its batch; an earlier one isn't seen any more."""
    if batch > state.n_batches:
        raise ValueError(f"batch {batch} would leave a gap after {state.n_batches}")
    if batch < state.n_batches and all(b != batch for b, _, _ in state.attempts):
        state.redone[str(batch)] = attempt
    state.attempts = sorted([*(x for x in state.attempts if x[0] != batch), [batch, attempt, tables]])
    state.n_batches = max(state.n_batches, batch + 1)
    return log.commit(state)


def _merged(log: CommitLog, table: str, rows: DataFrame) -> dict[str, str]:
    """Write rows clustered by date; date value -> folder."""
    name = f"{table}/folder=c-{uuid.uuid4().hex}"
    date = TABLES[table][1]
    _write(rows, f"{log.root}/{name}", date)
    if not date:
        return {"": name}
    return {n.partition("=")[2]: f"{name}/{n}" for n in log.folder.names(name) if n.startswith(f"{date}=")}


def compact(log: CommitLog, fan_in: int = FAN_IN, least: int = 1) -> State:
    """Cluster the attempts committed so far by date, if there are ``least`` or more."""
    state = log.latest()
    if len(state.attempts) < max(1, least):
        return state
    layout = log.layout(state)
    for table in TABLES:
        fresh = [attempt_folder(table, b, a) for b, a, tables in state.attempts if table in tables]
        if not fresh:
            continue
        pieces = layout.setdefault(table, {})
        for value, folder in _merged(log, table, _scan(log, table, fresh, None)).items():
            pieces.setdefault(value, []).append([0, folder])
        while full := _full_levels(pieces, fan_in):
            level = min(k for _, k in full)
            due = {value: [f for k, f in pieces[value] if k == level] for value, k in full if k == level}
            rows = _scan(log, table, [f for held in due.values() for f in held], None)
            for batch, attempt in state.redone.items():
                rows = rows.where((F.col("batch_id") != int(batch)) | (F.col("attempt") == attempt))
            found = _merged(log, table, rows)
            for value, held in due.items():
                pieces[value] = [p for p in pieces[value] if p[1] not in held]
                if value in found:
                    pieces[value].append([level + 1, found[value]])
    state.layout = f"_layouts/{state.version + 1:011d}-{uuid.uuid4().hex}.json"
    log.folder.create(state.layout, json.dumps(layout))
    state.attempts = []
    return log.commit(state)


def _full_levels(pieces: dict, fan_in: int) -> list[tuple[str, int]]:
    found = []
    for value, held in pieces.items():
        count: dict[int, int] = defaultdict(int)
        for level, _ in held:
            count[level] += 1
        found += [(value, level) for level, n in count.items() if n >= fan_in]
    return found


def read_dimension(log: CommitLog, state: State | None = None) -> DataFrame:
    """The stored sensor dimension (no rows before it is first written)."""
    state = state or log.latest()
    if state.dimension is None:
        return rows_frame(log.spark, [], schemas.METADATA)
    return log.spark.read.schema(schemas.METADATA).parquet(f"{log.root}/{state.dimension}")


def write_dimension(log: CommitLog, state: State, new: DataFrame) -> State:
    """K8: a new version of the dimension with the sensors of ``new`` that it lacks, in ``state`` (not committed).

    A version is written whole and swapped in by the commit, so a replay adds nothing twice; if
    nothing is missing the version stays.  Keys that occur twice are an error.
    """
    known = read_dimension(log, state)
    new = new.select(*schemas.METADATA.fieldNames()).where("sensor_id is not null")
    if state.dimension and new.join(known, "sensor_id", "left_anti").isEmpty():
        return state
    rows = insert_if_absent(known, new)
    folder = f"dimension/{uuid.uuid4().hex}"
    rows.write.parquet(f"{log.root}/{folder}")
    stored = log.spark.read.schema(schemas.METADATA).parquet(f"{log.root}/{folder}")
    if not primary_key_violations(stored).isEmpty():
        raise ValueError("a sensor occurs twice in the dimension")
    state.dimension = folder
    return state


#: bits of the filter per id of the batch
BITS_PER_ID = 16


def committed_ids(log: CommitLog, ids: DataFrame, n_ids: int, state: State | None = None, table: str = "clean_events",
                  key: str = "raw_event_id") -> DataFrame:
    """Which of ``ids`` (a column ``id``) are keys of committed rows of ``table``.

    A Bloom filter of the batch's ids, as 64-bit words, drops nearly all committed rows where they
    are read, before anything is shuffled; those that pass meet the ids themselves.  The filter has
    a quarter of a row per id at most.
    """
    words = 1 << max(0, (max(n_ids, 1) * BITS_PER_ID // 64 - 1).bit_length())

    def place(c):
        h = F.xxhash64(c)
        return [F.pmod(F.shiftright(h, 6), F.lit(words)).alias("word"), h.bitwiseAND(F.lit(63)).cast("int").alias("bit")]

    bloom = (ids.select(*place(F.col("id"))).groupBy("word")
             .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")))
    found = read_table(log, table, state).select(F.col(key).cast("long").alias("id"))
    likely = (found.select("id", *place(F.col("id"))).join(bloom, "word")
              .where(F.expr("shiftright(bits, bit) & 1L") == 1).select("id").distinct())
    return ids.select("id").distinct().join(likely, "id", "left_semi")
