import os
import tempfile

from sensorflow.plans import batch as batch_plan
from sensorflow.plans.queries import landing
from sensorflow.sources.landing import seed_metadata
from sensorflow.streaming.microbatch import run_available_now

SMOKE = "/root/testdata/sf0.001"


def test_stream_equals_batch_per_microbatch(spark):
    root = tempfile.mkdtemp(prefix="sf-stream-")
    src = os.path.join(root, "landing")
    lnd = landing(spark, SMOKE)
    # three files -> three micro-batches with maxFilesPerTrigger=1
    lnd.repartition(3, "id").write.parquet(src)
    out = run_available_now(spark, src, os.path.join(root, "out"), seed_metadata(spark),
                            max_files_per_trigger=1)
    got = spark.read.parquet(os.path.join(out, "sensor_readings"))
    assert got.select("batch_id").distinct().count() == 3
    # batch-local semantics: each file processed on its own gives the same rows
    files = sorted(f for f in os.listdir(src) if f.endswith(".parquet"))
    expected = 0
    for f in files:
        part = spark.read.parquet(os.path.join(src, f))
        expected += batch_plan.process(part, seed_metadata(spark)).readings.filter(
            "reject_reason is null").count()
    assert got.count() == expected
    # replaying the query (same checkpoint) adds nothing
    run_available_now(spark, src, os.path.join(root, "out"), seed_metadata(spark), max_files_per_trigger=1)
    assert spark.read.parquet(os.path.join(out, "sensor_readings")).count() == expected


def test_batch_run_once_writes_all_sinks(spark):
    root = tempfile.mkdtemp(prefix="sf-batch-")
    lnd = landing(spark, SMOKE)
    res = batch_plan.run_once(lnd, seed_metadata(spark), root, 0, limit=300)
    ledger = spark.read.parquet(os.path.join(root, "processed_ledger"))
    assert ledger.count() == 300
    counters = res.metrics["clean"].get
    assert counters["clean_rows"] + counters["dead_letter_rows"] == counters["deduped_rows"] <= 300
    assert res.metrics["readings"].get["rows"] == counters["clean_rows"]
    for t in ("sensor_readings", "anomalies", "dead_letter_events", "clean_events"):
        assert os.path.isdir(os.path.join(root, t))
    # next run skips what the ledger holds
    batch_plan.run_once(lnd, seed_metadata(spark), root, 1, limit=300,
                        ledger=spark.read.parquet(os.path.join(root, "processed_ledger")))
    ids = spark.read.parquet(os.path.join(root, "processed_ledger"))
    assert ids.count() == 600 and ids.select("id").distinct().count() == 600


def test_replay_takes_the_manifest_and_commits_once(spark):
    from sensorflow.sinks.tables import committed
    root = tempfile.mkdtemp(prefix="sf-batch-")
    lnd = landing(spark, SMOKE)
    early, seed = lnd.where("id % 3 != 0"), seed_metadata(spark)
    batch_plan.run_once(early, seed, root, 0)
    first = {t: committed(spark, root, t).count() for t in ("sensor_readings", "dead_letter_events", "clean_events")}
    # more rows have arrived: the replay still has the batch of its manifest, and marks no other row
    batch_plan.run_once(lnd, seed, root, 0, curated=True)
    assert {t: committed(spark, root, t).count() for t in first} == first
    marked = spark.read.parquet(os.path.join(root, "processed_ledger"))
    assert marked.count() == early.where("not processed").count()
    # a batch that isn't in the ledger isn't shown
    batch_plan.write_batch(spark.createDataFrame([(1,)], "raw_event_id long"), os.path.join(root, "clean_events"), 7)
    assert committed(spark, root, "clean_events").count() == first["clean_events"]
    # rows that the sink's constraints refuse keep their payload
    dead = committed(spark, root, "dead_letter_events").where("reason in ('null sensor_id', 'null value')").collect()
    refused = [r for r in dead if r.reason == "null sensor_id"]
    assert refused and all('sensor_type' in r.payload for r in refused)


def test_stream_counters(spark):
    from sensorflow.streaming.microbatch import landing_stream, start
    root = tempfile.mkdtemp(prefix="sf-stream-")
    landing(spark, SMOKE).repartition(1).write.parquet(os.path.join(root, "landing"))
    seen = {}
    q = start(landing_stream(spark, os.path.join(root, "landing")), seed_metadata(spark), os.path.join(root, "out"),
              os.path.join(root, "ckpt"), trigger={"availableNow": True}, on_metrics=lambda i, m: seen.update({i: m}))
    q.awaitTermination()
    assert list(seen) == [0]
    clean = seen[0]["clean"]
    assert clean["clean_rows"] + clean["dead_letter_rows"] == clean["deduped_rows"] > 0
    assert seen[0]["readings"]["rows"] == clean["clean_rows"] and seen[0]["readings"]["rejected_rows"] > 0


def test_intake_stream_lands_rows_with_ids(spark):
    from sensorflow.plans.queries import _events
    from sensorflow.sources.derived import derive_messages
    from sensorflow.streaming.microbatch import start_intake
    root = tempfile.mkdtemp(prefix="sf-intake-")
    msgs = derive_messages(_events(spark, SMOKE)).drop("id")
    msgs.repartition(2).write.parquet(os.path.join(root, "in"))
    stream = spark.readStream.schema(msgs.schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(root, "in"))
    start_intake(stream, os.path.join(root, "landing"), os.path.join(root, "ckpt"), trigger={"availableNow": True}).awaitTermination()
    rows = spark.read.parquet(os.path.join(root, "landing"))
    assert rows.count() == msgs.count() == rows.select("id").where("id is not null").distinct().count()
    # landing rows go on through the batch plan
    batch_plan.run_once(rows.drop("batch_id"), seed_metadata(spark), os.path.join(root, "out"), 0)
    assert spark.read.parquet(os.path.join(root, "out", "processed_ledger")).count() == rows.count()


def test_message_stream_intake_equals_batch(spark):
    from pyspark.sql import functions as F

    from sensorflow.plans.queries import _events
    from sensorflow.sources.derived import derive_messages
    from sensorflow.sources.intake import messages_to_landing
    from sensorflow.streaming.microbatch import message_stream_to_landing

    root = tempfile.mkdtemp(prefix="sf-msg-")
    msgs = derive_messages(_events(spark, SMOKE))
    msgs.repartition(2).write.parquet(os.path.join(root, "in"))
    schema = spark.read.parquet(os.path.join(root, "in")).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(root, "in"))
    landed = message_stream_to_landing(stream, "sensors", id_col="id")
    q = (landed.writeStream.format("parquet").option("path", os.path.join(root, "out"))
         .option("checkpointLocation", os.path.join(root, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(os.path.join(root, "out"))
    want = messages_to_landing(msgs, id_col="id")
    cols = ["id", "sensor_id", "sensor_type", "payload", "processed"]
    assert got.count() == want.count() == msgs.count()
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0
    assert got.filter(F.col("payload").startswith('{"raw":')).count() > 0
