import os
import tempfile
from datetime import datetime

from sensorflow import schemas
from sensorflow.sinks.tables import (
    dead_letter_sink_rows,
    insert_if_absent,
    nan_to_null,
    primary_key_violations,
    reading_rows,
    write_batch,
)
from sensorflow.sources.landing import clean_by_ids, seed_metadata


def test_insert_if_absent(spark):
    seed = seed_metadata(spark)
    new = spark.createDataFrame([("temp-01", "x", None, None, None, None, None),
                                 ("new-1", "door", None, None, None, None, None)], schemas.METADATA)
    out = {r["sensor_id"]: r for r in insert_if_absent(seed, new).collect()}
    assert len(out) == 7 and out["temp-01"]["sensor_type"] == "temperature" and "new-1" in out
    again = insert_if_absent(insert_if_absent(seed, new), new)
    assert again.count() == 7


def test_primary_key_violations(spark):
    seed = seed_metadata(spark)
    assert primary_key_violations(seed).count() == 0
    assert primary_key_violations(seed.unionByName(seed.limit(1))).count() == 1


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"), 1.0, "a")], "x double, y double, s string")
    r = nan_to_null(df).first()
    assert r["x"] is None and r["y"] == 1.0 and r["s"] == "a"


def test_reading_guard(spark):
    rows = [(1, None, "temperature", 1.0, None, datetime(2024, 6, 3), None, 10, 0, True, None, None, None, None,
             None),
            (2, "a", "temperature", float("nan"), None, datetime(2024, 6, 3), None, 10, 0, True, None, None, None,
             None, None),
            (3, "a", "temperature", 1.0, None, datetime(2024, 6, 3), None, 10, 0, True, None, None, None, None,
             None)]
    df = spark.createDataFrame(rows, schemas.ENRICHED)
    out = {r["raw_event_id"]: r for r in reading_rows(df).collect()}
    assert out[1]["reject_reason"] == "null sensor_id"
    assert out[2]["reject_reason"] == "null value" and out[2]["value"] is None
    assert out[3]["reject_reason"] is None


def test_dead_letter_wrapping(spark):
    d = spark.createDataFrame([(1, '{"a": 1}', "null value")], schemas.DEAD_LETTER)
    r = dead_letter_sink_rows(d).first()
    assert r["payload"] == '{"raw":"{\\"a\\": 1}"}'


def test_write_batch_replay_is_idempotent(spark):
    root = tempfile.mkdtemp(prefix="sf-sink-")
    df = spark.createDataFrame([(1,), (2,)], "id long")
    write_batch(df, os.path.join(root, "t"), 0)
    write_batch(df, os.path.join(root, "t"), 1)
    write_batch(df, os.path.join(root, "t"), 1)
    assert spark.read.parquet(os.path.join(root, "t")).count() == 4


def test_replay_removes_what_it_no_longer_has(spark):
    root = os.path.join(tempfile.mkdtemp(prefix="sf-sink-"), "t")
    df = spark.createDataFrame([(1, "2024-06-03"), (2, "2024-06-04")], "id long, d string")
    write_batch(df, root, 0, partition_by=("d",))
    write_batch(df, root, 1, partition_by=("d",))
    write_batch(df.where("id = 1"), root, 1, partition_by=("d",))
    assert sorted((r.batch_id, r.id) for r in spark.read.parquet(root).collect()) == [(0, 1), (0, 2), (1, 1)]
    write_batch(df.limit(0), root, 1, partition_by=("d",))
    assert sorted((r.batch_id, r.id) for r in spark.read.parquet(root).collect()) == [(0, 1), (0, 2)]


def test_insert_if_absent_takes_one_of_equal_keys(spark):
    seed = seed_metadata(spark)
    new = spark.createDataFrame([("n", "b", None, None, None, None, None), ("n", "a", None, None, None, None, None),
                                 ("temp-01", "x", None, None, None, None, None)], schemas.METADATA)
    out = insert_if_absent(seed, new).collect()
    assert len(out) == 7 and [r.sensor_type for r in out if r.sensor_id == "n"] == ["a"]


def test_clean_by_ids_semi_join(spark):
    c = spark.createDataFrame([(1, "a", "t", 1.0, None, datetime(2024, 6, 3, 2), None),
                               (2, "a", "t", 1.0, None, datetime(2024, 6, 3, 1), None),
                               (3, "a", "t", 1.0, None, datetime(2024, 6, 3, 3), None)], schemas.CLEAN)
    ids = spark.createDataFrame([(2,), (1,), (1,)], "id long")
    assert [r["raw_event_id"] for r in clean_by_ids(c, ids).collect()] == [2, 1]


def test_optional_columns_added(spark):
    from sensorflow.sinks.tables import with_optional_columns
    df = spark.createDataFrame([(1, "a")], "raw_event_id long, sensor_id string")
    out = with_optional_columns(df)
    assert {"zone", "location", "unit"} <= set(out.columns) and out.first()["zone"] is None


def test_from_records(spark):
    from sensorflow.sources.landing import from_records
    df = from_records(spark, [{"id": 1, "sensor_id": "s", "value": "1.5", "timestamp": "2024-06-03T10:00:00Z"},
                              {"id": 2}])
    assert df.columns == schemas.FLAT.fieldNames() and df.count() == 2
    assert df.filter("id = 1").first()["value"] == "1.5"


def test_dimension_scan_with_declared_schema(spark):
    from sensorflow.sources.landing import read_table
    root = tempfile.mkdtemp(prefix="sf-dim-")
    seed_metadata(spark).write.parquet(os.path.join(root, "meta"))
    df = read_table(spark, os.path.join(root, "meta"), schemas.METADATA)
    assert df.schema == schemas.METADATA and df.count() == 6


def test_anomaly_guard(spark):
    from sensorflow.sinks.tables import anomaly_rows
    rows = [(None, "door", datetime(2024, 6, 3), 1.0, "door_outside_hours", 1.0, "r"),
            ("d", "door", datetime(2024, 6, 3), float("nan"), "door_outside_hours", float("nan"), "r")]
    out = anomaly_rows(spark.createDataFrame(rows, schemas.ANOMALY)).orderBy("sensor_id").collect()
    assert out[0]["reject_reason"] == "null sensor_id"
    assert out[1]["reject_reason"] is None and out[1]["value"] is None and out[1]["score"] is None
