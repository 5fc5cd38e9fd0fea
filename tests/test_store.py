"""The store: ledger marks, commits, replays, compaction, keys, dimension, redeliveries."""

import json
import os
import tempfile
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorflow import schemas
from sensorflow.operators.joins import hot_key_join
from sensorflow.sources.landing import seed_metadata
from sensorflow.store import (CommitConflict, CommitLog, Landing, compact, mark_done, read_dimension, read_table, replay, run_pending,
                              seed_dimension)
from sensorflow.store.landing import FOLDERS, NOTHING_DONE, advanced, mark_of, still_open
from sensorflow.store.log import State
from sensorflow.store.tables import commit_batch, committed_ids, write_attempt, write_dimension
from sensorflow.streaming.microbatch import start_deduplicated_intake

START = datetime(2024, 6, 3)


def at(minutes):
    return START + timedelta(minutes=minutes)


def landing_rows(spark, rows):
    """rows: (id, minute of arrival); a valid temperature reading each."""
    body = '{{"sensor_id":"temp-01","sensor_type":"temperature","value":"{}","timestamp":"{}"}}'
    return spark.createDataFrame([(i, "temp-01", "temperature", body.format(20 + i % 3, at(m).isoformat() + "Z"), at(m), False)
                                  for i, m in rows], schemas.LANDING)


@pytest.fixture
def place(spark):
    root = tempfile.mkdtemp(prefix="sf-store-")
    return CommitLog(spark, f"{root}/out"), Landing(spark, f"{root}/landing")


def ids_of(df, column="id"):
    return sorted(r[0] for r in df.select(column).collect())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 30), max_size=6), st.integers(1, 5)), max_size=8))
def test_marks_say_exactly_what_is_done(steps):
    """Each step lands an intake of rows (their times) and takes the oldest few pending ones."""
    marks, landed, done, serial = [], [], set(), 0
    for number, (times, cap) in enumerate(steps):
        for t in times:
            landed.append((t, serial, number))
            serial += 1

        def pending():
            out = []
            for t, i, n in landed:
                m = mark_of(marks, n)
                if m == NOTHING_DONE or (m is not None and [t, i] > m):
                    out.append((t, i, n))
            return sorted(out)

        before = pending()
        assert {i for _, i, _ in before} == {i for _, i, _ in landed} - done
        taken = before[:cap]
        if taken:
            marks = advanced(marks, number, None if len(before) < cap else [taken[-1][0], taken[-1][1]])
            done |= {i for _, i, _ in taken}
    assert len(marks) <= len(steps)


def test_folders_close_when_their_hour_is_below_the_mark():
    mark = [int((datetime(2024, 6, 3, 5, 30) - datetime(1970, 1, 1)).total_seconds()) * 1_000_000, 7]
    folders = [[0, "a", "2024-06-03-04"], [0, "a", "2024-06-03-05"], [0, "a", "2024-06-03-06"], [1, "b", "2024-06-01-00"], [2, "c", "x"]]
    assert still_open(folders, [[0, mark], [1, None]]) == [folders[1], folders[2], folders[4]]


def test_runs_read_only_open_folders_and_find_late_rows(spark, place):
    log, landing = place
    for k in range(5):
        landing.append(landing_rows(spark, [(100 * k + j, 60 * k + j) for j in range(10)]), k)
    assert not landing.append(landing_rows(spark, [(1, 0)]), 4)
    run_pending(log, landing, limit=35)
    state = log.latest()
    assert ids_of(landing.pending(state)) == [*range(305, 310), *range(400, 410)]
    # two hours are open, three aren't looked at
    files = landing.pending(state).inputFiles()
    assert files and all("hour=2024-06-03-03" in f or "hour=2024-06-03-04" in f for f in files)
    plan = landing.pending(state)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(received_at" in plan
    # rows from before the mark, landed after it: of another source as well
    landing.append(landing_rows(spark, [(7000, 2)]), 5)
    landing.append(landing_rows(spark, [(7001, 1)]), 0, source="other")
    state = run_pending(log, landing, limit=1)
    assert ids_of(landing.pending(state)) == [*range(305, 310), *range(400, 410), 7000]
    state = run_pending(log, landing, limit=None)
    assert landing.pending(state).isEmpty() and state.open == [] and len(state.marks) == 1
    assert run_pending(log, landing, limit=None) is None
    assert ids_of(read_table(log, "clean_events"), "raw_event_id") == sorted([*(100 * k + j for k in range(5) for j in range(10)), 7000, 7001])


def test_an_intake_of_many_hours_has_few_folders_and_files(spark, place):
    log, landing = place
    rows = [(k, 20 * k) for k in range(300)] + [(1000 + j, 5) for j in range(200)]  # 100 hours, the first one full
    feed = os.path.join(landing.root, "feed")
    messages = landing_rows(spark, rows).selectExpr("id", "'sensors/temperature/temp-01' AS topic", "encode(payload, 'UTF-8') AS value",
                                                    "received_at")
    messages.write.parquet(feed)
    stream = spark.readStream.schema(messages.schema).parquet(feed)
    start_deduplicated_intake(stream, landing, os.path.join(landing.root, "checkpoint"), id_col="id",
                              trigger={"availableNow": True}).awaitTermination()
    assert ids_of(landing.all_rows()) == sorted(i for i, _ in rows)
    record = landing.intakes()[0]
    assert 16 <= len(record["hours"]) <= FOLDERS and len(landing.all_rows().inputFiles()) <= 2 * FOLDERS
    assert landing.folder.names("_staging") == []
    # no folder's name is before the hour of one of its rows, so none is closed too early
    assert landing.all_rows().where(F.date_format("received_at", "yyyy-MM-dd-HH") > F.col("hour")).isEmpty()
    done = []
    while (state := run_pending(log, landing, limit=120)) is not None:
        left = ids_of(landing.pending(state))
        done.append(len(rows) - len(left))
        assert len(state.open) <= FOLDERS * len(left) / len(rows) + 3
    assert done == [120, 240, 360, 480, 500]
    assert ids_of(read_table(log, "run_metrics"), "batch_id") == [0, 1, 2, 3, 4]


def test_a_run_reads_as_much_after_many_batches_as_after_few(spark, place):
    log, landing = place
    counts, read = [], landing.folder.read

    def state_after(n):
        state = log.latest()
        while state.n_batches < n:
            k = state.n_batches
            landing.folder.create(f"_intakes/{k // 100:09d}/{k:011d}.json", json.dumps(
                {"number": k, "name": f"stream-{k}", "hours": ["2024-06-03-00"], "sources": {"stream": k}}))
            state.n_batches, state.marks = k + 1, [[k, None]]
            state = log.commit(state)
        return log.latest()

    for n in (10, 150):
        state, seen = state_after(n), []
        landing.folder.read = lambda name, seen=seen: seen.append(name) or read(name)
        assert landing.candidates(state) == ([], n - 1)
        counts.append(len(seen))
        landing.folder.read = read
        assert len(json.dumps(vars(state))) < 400
    assert counts == [0, 0]


def test_marks_out_of_order(spark, place):
    log, landing = place
    landing.append(landing_rows(spark, [(j, j) for j in range(10)]), 0)
    ids = spark.createDataFrame([(3,), (8,), (99,)], "id long")
    assert mark_done(log, landing, ids.limit(0)).version == 0
    state = mark_done(log, landing, ids)
    assert ids_of(landing.pending(state)) == [0, 1, 2, 4, 5, 6, 7, 9]
    state = run_pending(log, landing, limit=4)
    assert ids_of(spark.read.parquet(state.tail)) == [8] and ids_of(landing.pending(state)) == [5, 6, 7, 9]
    assert run_pending(log, landing, limit=None).tail is None


def test_failed_attempts_change_nothing_and_replays_take_their_place(spark, place):
    log, landing = place
    seed_dimension(log, seed_metadata(spark))
    landing.append(landing_rows(spark, [(j, j) for j in range(6)]), 0)

    def fail(batch):
        assert read_table(log, "sensor_readings").count() == committed
        raise RuntimeError("stopped")

    committed = 0
    with pytest.raises(RuntimeError, match="stopped"):
        run_pending(log, landing, limit=4, before_commit=fail)
    assert ids_of(landing.pending(log.latest())) == [0, 1, 2, 3, 4, 5]
    # older rows arrive: the batch is the one that was planned
    landing.append(landing_rows(spark, [(50, -1)]), 1)
    run_pending(log, landing, limit=4)
    assert ids_of(read_table(log, "sensor_readings"), "raw_event_id") == [0, 1, 2, 3]
    first = read_table(log, "sensor_readings").first().attempt
    committed = 4
    for compacted in (False, True):
        if compacted:
            compact(log)
        with pytest.raises(RuntimeError, match="stopped"):
            replay(log, landing, 0, before_commit=fail)
        assert {r.attempt for r in read_table(log, "sensor_readings").collect()} == {first}
    replay(log, landing, 0)
    for _ in range(2):
        rows = read_table(log, "sensor_readings").collect()
        assert sorted(r.raw_event_id for r in rows) == [0, 1, 2, 3] and len({r.attempt for r in rows} - {first}) == 1
        assert read_table(log, "run_metrics").count() == 1
        compact(log)
    assert ids_of(landing.pending(log.latest())) == [4, 5, 50]


def test_two_writers_cannot_commit_from_one_state(spark, place):
    log, _ = place
    a, b = log.latest(), log.latest()
    log.commit(a)
    with pytest.raises(CommitConflict):
        log.commit(b)
    with pytest.raises(ValueError, match="gap"):
        commit_batch(log, log.latest(), 1, "x", [])


def readings(spark, batch, days, n=2):
    rows = [(1000 * batch + 10 * d + j, "temp-01", "temperature", 1.0, None, START + timedelta(days=d, hours=j), j, 0, None, None, True)
            for d in days for j in range(n)]
    return spark.createDataFrame(rows, schemas.READING).coalesce(1)


def test_files_of_a_date_stay_few_and_a_date_reads_its_own(spark, place):
    log, _ = place
    for batch in range(36):
        write_attempt(log, readings(spark, batch, (0, batch % 3)), "sensor_readings", batch, f"x{batch}")
        commit_batch(log, log.latest(), batch, f"x{batch}", ["sensor_readings"])
        if batch % 4 == 3:
            compact(log, fan_in=3)
    assert read_table(log, "sensor_readings").count() == 144
    pieces = log.layout(log.latest())["sensor_readings"]
    files = read_table(log, "sensor_readings").inputFiles()
    for day in ("2024-06-03", "2024-06-04", "2024-06-05"):
        # 9 compactions: fewer than three folders on each of three levels
        assert len(pieces[day]) <= 6 and sum(f"event_date={day}" in f for f in files) <= 6
    some = read_table(log, "sensor_readings", dates=["2024-06-04"])
    assert some.count() == 24 and all("event_date=2024-06-04" in f for f in some.inputFiles())
    # a filter alone prunes as well
    kept = read_table(log, "sensor_readings").where("event_date = date'2024-06-04'")
    assert kept.count() == 24 and "PartitionFilters: [isnotnull(event_date" in kept._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    # attempts that aren't committed, and those not compacted yet
    write_attempt(log, readings(spark, 36, (1,)), "sensor_readings", 36, "y")
    assert read_table(log, "sensor_readings", dates=["2024-06-04"]).count() == 24
    commit_batch(log, log.latest(), 36, "y", ["sensor_readings"])
    assert read_table(log, "sensor_readings", dates=["2024-06-04"]).count() == 26


def test_committed_ids_are_found_exactly(spark, place):
    log, _ = place
    clean = readings(spark, 0, range(40), 5).withColumn("received_at", F.col("event_ts"))
    write_attempt(log, clean, "clean_events", 0, "x")
    state = commit_batch(log, log.latest(), 0, "x", ["clean_events"])
    known = set(ids_of(clean, "raw_event_id"))
    for n in (1, 30, 3000):
        ids = spark.range(n).toDF("id")
        found = committed_ids(log, ids.unionAll(ids), n, state)
        assert ids_of(found) == sorted(known & set(range(n)))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "xxhash64" in plan


def test_later_copies_of_a_committed_key_are_dead_letters(spark, place):
    log, landing = place
    landing.append(landing_rows(spark, [(j, j) for j in range(4)]), 0)
    run_pending(log, landing, limit=None)
    landing.append(landing_rows(spark, [(2, 2), (9, 9)]), 1)
    run_pending(log, landing, limit=None)
    assert ids_of(read_table(log, "sensor_readings"), "raw_event_id") == [0, 1, 2, 3, 9]
    dead = read_table(log, "dead_letter_events").collect()
    assert [(r.raw_event_id, r.reason, r.batch_id) for r in dead] == [(2, "raw_event_id already committed", 1)]
    sums = read_table(log, "run_metrics").agg(F.sum("clean_rows"), F.sum("dead_letter_rows")).first()
    assert tuple(sums) == (5, 1)


def test_dimension_versions(spark, place):
    log, _ = place
    seed_dimension(log, seed_metadata(spark))
    new = spark.createDataFrame([("n-1", "door", None, None, None, None, None), (None, "door", None, None, None, None, None),
                                 ("temp-01", "x", None, None, None, None, None)], schemas.METADATA)
    unseen = write_dimension(log, log.latest(), new)
    assert read_dimension(log).count() == 6
    log.commit(unseen)
    assert read_dimension(log).count() == 7
    again = write_dimension(log, log.latest(), new)
    assert again.dimension == log.latest().dimension
    assert read_dimension(log).where("sensor_id = 'temp-01'").first().sensor_type == "temperature"
    assert read_dimension(CommitLog(spark, tempfile.mkdtemp())).count() == 0


def test_redelivered_messages_land_once_over_restarts(spark, place):
    from sensorflow.streaming.microbatch import start_deduplicated_intake
    _, landing = place
    root = tempfile.mkdtemp(prefix="sf-redelivery-")
    schema = "id long, topic string, value binary, received_at timestamp"
    for k, ids in enumerate(([1, 2, 2], [2, 3, 1], [4, 3], [])):
        rows = [(i, "sensors/door/d", b"{}", at(k)) for i in ids]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(schema).parquet(f"{root}/in")
        start_deduplicated_intake(stream, landing, f"{root}/checkpoint", id_col="id", trigger={"availableNow": True}).awaitTermination()
    rows = landing.all_rows()
    assert [(r.id, r.received_at) for r in rows.orderBy("id").collect()] == [(1, at(0)), (2, at(0)), (3, at(1)), (4, at(2))]


def test_hot_keys_stay_where_they_are(spark):
    """A third of the rows on one sensor and another third without any, nothing broadcast by the planner."""
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in off}
    root = tempfile.mkdtemp(prefix="sf-hot-")
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None).otherwise(F.concat(F.lit("s"), F.col("id") % 5000))
    spark.range(0, 60_000, 1, 8).select("id", key.alias("sensor_id")).write.parquet(f"{root}/fact")
    fact = spark.read.parquet(f"{root}/fact")
    dim = spark.range(5000).select(F.concat(F.lit("s"), "id").alias("sensor_id"), F.col("id").alias("x")).unionByName(
        spark.createDataFrame([("hot", -1)], "sensor_id string, x long"))
    try:
        for k, v in off.items():
            spark.conf.set(k, v)
        out = hot_key_join(fact, dim, "sensor_id")
        most = max(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
        # the scan has four splits of 10,000 such rows
        assert most <= 15_000
        plain = fact.join(dim, "sensor_id", "left").select("id", "sensor_id", "x")
        assert out.select("id", "sensor_id", "x").exceptAll(plain).isEmpty() and out.count() == 60_000
        assert out.where("sensor_id = 'hot' and x = -1").count() == 20_000
        assert hot_key_join(fact.limit(0), dim, "sensor_id").isEmpty()
        assert hot_key_join(fact, dim.limit(0), "sensor_id").where("x is null").count() == 60_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_stream_never_shows_half_a_batch(spark):
    from sensorflow.plans.flows import restarted_stream
    from sensorflow.plans.queries import landing
    from sensorflow.store import runs
    seen, commit = [], runs.commit_batch

    def watched(log, state, batch, attempt, tables):
        counts = [read_table(log, t).select("batch_id").distinct().count() for t in ("sensor_readings", "dead_letter_events", "run_metrics")]
        seen.append((batch, counts))
        return commit(log, state, batch, attempt, tables)

    runs.commit_batch = watched
    try:
        log = restarted_stream(spark, landing(spark, "/root/testdata/sf0.001"))
    finally:
        runs.commit_batch = commit
    assert seen == [(k, [k] * 3) for k in range(4)]
    assert log.latest().n_batches == 4


def test_state_is_read_from_the_newest_record_of_many(spark):
    log = CommitLog(spark, tempfile.mkdtemp())
    assert log.latest() == State()
    state = State()
    for _ in range(205):
        state = log.commit(state)
    assert log.latest().version == 205 and sorted(os.listdir(f"{log.root}/_log")) == ["000000000", "000000001", "000000002"]


def test_remembered_ids_have_as_many_partitions_as_run_at_once(spark, place):
    _, landing = place
    messages = landing_rows(spark, [(k, k) for k in range(20)]).selectExpr(
        "id", "'sensors/temperature/temp-01' AS topic", "encode(payload, 'UTF-8') AS value", "received_at")
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    for key, partitions in (("default", None), ("three", 3)):
        feed, checkpoint = os.path.join(landing.root, f"feed-{key}"), os.path.join(landing.root, f"checkpoint-{key}")
        messages.write.parquet(feed)
        spark.conf.set(name, "200")
        try:
            query = start_deduplicated_intake(spark.readStream.schema(messages.schema).parquet(feed), landing, checkpoint, source=key,
                                              id_col="id", trigger={"availableNow": True}, partitions=partitions)
            assert spark.conf.get(name) == "200"
        finally:
            spark.conf.set(name, before)
        query.awaitTermination()
        kept = [d for d in os.listdir(f"{checkpoint}/state/0") if d.isdigit()]
        assert len(kept) == (partitions or min(200, spark.sparkContext.defaultParallelism))
    # the second source lands its own copies; an empty read needs no task
    assert landing.all_rows().count() == 40
    plan = landing.read([])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("LocalRelation <empty>")
