"""Whole-table runs vs batch-local runs (``by=("batch_id",)``)."""

from datetime import timedelta

from sensor_rows import BASE, enriched_rows, flat_rows
from pyspark.sql import functions as F

from sensorflow.operators.clean import classify
from sensorflow.operators.detect import motion_anomalies, temperature_anomalies


def test_dedup_across_batches(spark):
    t = BASE.isoformat()
    df = flat_rows(spark, [{"timestamp": t}, {"timestamp": t}]).withColumn(
        "batch_id", F.when(F.col("id") == 1, 0).otherwise(1))
    assert classify(df).count() == 1
    assert classify(df, by=("batch_id",)).count() == 2


def test_zscore_window_stays_in_batch(spark):
    rows = [dict(value=22.0, event_ts=BASE + timedelta(minutes=i)) for i in range(10)]
    rows.append(dict(value=75.0, event_ts=BASE + timedelta(minutes=10)))
    df = enriched_rows(spark, rows).withColumn("batch_id", F.when(F.col("value") == 75.0, 1).otherwise(0))
    assert temperature_anomalies(df).count() == 1
    assert temperature_anomalies(df, by=("batch_id",)).count() == 0
    assert temperature_anomalies(df, by=("batch_id",), method="frame").count() == 0
    # sensor ids come back unchanged
    assert temperature_anomalies(df).first()["sensor_id"] == "temp-01"


def test_motion_minute_stays_in_batch(spark):
    rows = [dict(sensor_id="motion-01", sensor_type="motion", value=1.0, baseline_events_per_min=2.0,
                 event_ts=BASE + timedelta(seconds=5 * i)) for i in range(10)]
    df = enriched_rows(spark, rows).withColumn("batch_id", F.col("raw_event_id") % 2)
    assert motion_anomalies(df).count() == 1
    assert motion_anomalies(df, by=("batch_id",)).count() == 0


def test_batch_plan_by_batch_id(spark):
    from sensorflow.plans import batch as batch_plan
    from sensorflow.plans.queries import landing
    from sensorflow.sources.landing import seed_metadata
    lnd = landing(spark, "/root/testdata/sf0.001")
    whole = batch_plan.process(lnd, seed_metadata(spark))
    split = batch_plan.process(lnd.withColumn("batch_id", F.col("id") % 3), seed_metadata(spark), by=("batch_id",))
    assert "batch_id" in split.enriched.columns
    # repeats of one reading in different batches are each kept
    assert split.clean.count() >= whole.clean.count()
    assert split.anomalies.count() >= 0
