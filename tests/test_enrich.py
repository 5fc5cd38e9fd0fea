from datetime import timedelta

from sensor_rows import BASE, ts
from pyspark.sql import Observation

from sensorflow import schemas
from sensorflow.operators.enrich import enrich_events, enrich_quality, time_features
from sensorflow.sources.landing import seed_metadata


def clean_df(spark, rows):
    out = []
    for i, r in enumerate(rows):
        e = dict(raw_event_id=i + 1, sensor_id="temp-01", sensor_type="temperature", value=22.0, unit="celsius",
                 event_ts=BASE + timedelta(minutes=i), received_at=BASE + timedelta(minutes=i))
        e.update(r)
        out.append(tuple(e[f] for f in schemas.CLEAN.fieldNames()))
    return spark.createDataFrame(out, schemas.CLEAN)


def feats(spark, t):
    return time_features(clean_df(spark, [{"event_ts": t}])).first()


def test_hours(spark):
    assert feats(spark, ts(2024, 6, 3, 14, 30))["hour_of_day"] == 14
    assert feats(spark, ts(2024, 6, 3, 0, 0))["hour_of_day"] == 0
    assert feats(spark, ts(2024, 6, 3, 23, 59))["hour_of_day"] == 23


def test_hour_from_offset_text(spark):
    df = spark.createDataFrame([(1, "temp-01", "temperature", 22.0, "c", "2024-06-03T12:00:00+02:00")],
                               "raw_event_id long, sensor_id string, sensor_type string, value double, unit string, event_ts string")
    assert time_features(df).first()["hour_of_day"] == 10


def test_weekdays(spark):
    assert feats(spark, ts(2024, 6, 3, 10))["day_of_week"] == 0
    assert feats(spark, ts(2024, 6, 5, 10))["day_of_week"] == 2
    assert feats(spark, ts(2024, 6, 8, 10))["day_of_week"] == 5
    assert feats(spark, ts(2024, 6, 9, 10))["day_of_week"] == 6


def test_business_hours(spark):
    yes = [ts(2024, 6, 3, 9), ts(2024, 6, 3, 8), ts(2024, 6, 7, 17, 59)]
    no = [ts(2024, 6, 3, 18), ts(2024, 6, 3, 7), ts(2024, 6, 8, 10), ts(2024, 6, 9, 12)]
    assert all(feats(spark, t)["is_business_hours"] for t in yes)
    assert not any(feats(spark, t)["is_business_hours"] for t in no)


def test_join_metadata(spark):
    df = enrich_events(clean_df(spark, [{}, {"sensor_id": "nope"}, {"sensor_id": "door-02", "sensor_type": "door"}]),
                       seed_metadata(spark))
    rows = {r["sensor_id"]: r for r in df.collect()}
    assert rows["temp-01"]["zone"] == "zone-a" and rows["temp-01"]["location"] == "Server Room A"
    assert rows["temp-01"]["baseline_events_per_min"] == 0.5
    assert rows["nope"]["zone"] is None
    assert rows["door-02"]["zone"] == "zone-b"
    assert rows["door-02"]["sensor_type"] == "door"


def test_empty_input_full_schema(spark):
    df = enrich_events(clean_df(spark, []), seed_metadata(spark))
    assert df.count() == 0
    for c in ("hour_of_day", "day_of_week", "is_business_hours", "zone", "location",
              "min_expected", "max_expected", "baseline_events_per_min"):
        assert c in df.columns


def test_empty_metadata(spark):
    df = enrich_events(clean_df(spark, [{}]), seed_metadata(spark).limit(0))
    r = df.first()
    assert r["zone"] is None and r["baseline_events_per_min"] is None and r["hour_of_day"] == 10


def test_quality_metrics(spark):
    seen = Observation("q1")
    df = enrich_quality(enrich_events(clean_df(spark, [{}, {"sensor_id": "nope"}, {"sensor_id": None}]),
                                      seed_metadata(spark)), seen)
    assert df.count() == 3
    assert seen.get == {"rows": 3, "rows_without_zone": 2}


def test_dimension_is_broadcast(spark):
    df = enrich_events(clean_df(spark, [{}]), seed_metadata(spark))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_broadcast_respects_session_threshold(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        df = enrich_events(clean_df(spark, [{}]), seed_metadata(spark))
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
