"""Anomaly detectors (A1-A5) over enriched rows -> ``ANOMALY`` rows.

Detectors match ``sensor_type`` case-sensitively (unlike the clean step's
range rules, which lower-case it).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow import rules, schemas
from sensorflow.functions.columns import first_in_order, order_key, packed_order_key
from sensorflow.operators.enrich import with_baseline
from sensorflow.operators.rolling import rolling_zscore

ANOMALY_COLUMNS = [f.name for f in schemas.ANOMALY.fields]


def _event_ts(df: DataFrame) -> DataFrame:
    if dict(df.dtypes).get("event_ts") == "string":
        from sensorflow.functions.columns import parse_event_time
        df = df.withColumn("event_ts", parse_event_time(F.col("event_ts"), ()))
    return df


def temperature_anomalies(enriched: DataFrame, *, method: str = "sweep",
                          threshold: float = rules.ZSCORE_THRESHOLD,
                          window_seconds: int = rules.ZSCORE_WINDOW_SECONDS,
                          block_seconds: int = 4 * 3600, by: Sequence[str] = ()) -> DataFrame:
    """A1: rolling z-score of temperature readings (see ``operators.rolling``).

    ``by`` adds partition keys (e.g. ``("batch_id",)``): windows never cross
    them, which reproduces batch-local scoring over a whole table.
    """
    df = _event_ts(enriched).filter(F.col("sensor_type") == "temperature")
    keep = [c for c in ("sensor_id", "sensor_type", "event_ts", "value", "raw_event_id") if c in df.columns]
    if by:
        # the window key becomes (sensor, *by); the sensor id is restored after
        df = df.withColumn("_sensor", F.col("sensor_id")).withColumn(
            "sensor_id", F.to_json(F.struct(F.col("sensor_id"), *[F.col(c) for c in by])))
        keep = keep + ["_sensor"]
    flagged = rolling_zscore(df.select(*keep), window_seconds=window_seconds, threshold=threshold,
                             block_seconds=block_seconds, method=method)
    if by:
        flagged = flagged.withColumn("sensor_id", F.col("_sensor")).drop("_sensor")
    reason = F.format_string(
        f"Z-score %.2f exceeds threshold +-{threshold} (window mean=%.2f, std=%.2f)",
        F.col("_z"), F.col("_mean"), F.col("_std"))
    return flagged.select(
        "sensor_id", "sensor_type", "event_ts", F.col("value").cast("double").alias("value"),
        F.lit(rules.ANOMALY_TEMPERATURE).alias("anomaly_type"),
        F.round(F.abs(F.col("_z")), 4).alias("score"),
        reason.alias("reason"))


def motion_minute_counts(enriched: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A2a-b: per (sensor, type, minute): count of all rows, first baseline,
    first event time (input order), mean value.  Partial aggregation map-side."""
    df = _event_ts(enriched).filter((F.col("sensor_type") == "motion")
                                    & F.col("baseline_events_per_min").isNotNull())
    key = packed_order_key(df)
    if key is None:
        key = order_key(df, ("received_at", "raw_event_id", "id", "event_ts"))
    return (df.withColumn("minute_bucket", F.date_trunc("minute", F.col("event_ts")))
              .groupBy("sensor_id", "sensor_type", "minute_bucket", *by)
              .agg(F.count(F.lit(1)).alias("event_count"),
                   first_in_order("baseline_events_per_min", key).alias("baseline_events_per_min"),
                   first_in_order("event_ts", key).alias("event_ts"),
                   F.avg(F.col("value").cast("double")).alias("value")))


def motion_anomalies(enriched: DataFrame, metadata: DataFrame | None = None,
                     multiplier: float = rules.MOTION_BASELINE_MULTIPLIER,
                     with_count: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """A2: minutes whose count exceeds ``multiplier`` x the sensor baseline.

    ``with_count`` keeps the minute's ``event_count`` as an extra column."""
    if metadata is not None:
        enriched = with_baseline(enriched, metadata)
    counts = motion_minute_counts(enriched, by)
    base = F.col("baseline_events_per_min")
    limit = base * F.lit(multiplier)
    score = F.when(base == 0, F.lit(float("inf"))).otherwise(
        F.round(F.try_divide(F.col("event_count"), base), 4))
    reason = F.concat(F.lit("Events per minute ("), F.col("event_count").cast("string"),
                      F.lit(") exceeds "), F.round(limit, 1).cast("string"), F.lit("x baseline"))
    extra = ["event_count"] if with_count else []
    return counts.filter(F.col("event_count") > limit).select(
        "sensor_id", "sensor_type", "event_ts", F.col("value").cast("double").alias("value"),
        F.lit(rules.ANOMALY_MOTION).alias("anomaly_type"), score.alias("score"), reason.alias("reason"), *extra)


def door_anomalies(enriched: DataFrame) -> DataFrame:
    """A3: door opened (value = 1.0) outside business hours; NULL hours flag nothing."""
    df = _event_ts(enriched)
    return df.filter((F.col("sensor_type") == "door") & (F.col("value") == 1.0)
                     & (F.col("is_business_hours") == F.lit(False))).select(
        "sensor_id", "sensor_type", "event_ts", F.col("value").cast("double").alias("value"),
        F.lit(rules.ANOMALY_DOOR).alias("anomaly_type"), F.lit(1.0).alias("score"),
        F.lit(rules.DOOR_REASON).alias("reason"))


def detect_anomalies(enriched: DataFrame, *, method: str = "sweep", block_seconds: int = 4 * 3600,
                     by: Sequence[str] = ()) -> DataFrame:
    """A4-A5: union of the three detectors; always the ``ANOMALY`` schema.

    ``by`` keeps windows and minute counts inside each value of those columns.
    """
    parts = [temperature_anomalies(enriched, method=method, block_seconds=block_seconds, by=by),
             motion_anomalies(enriched, by=by),
             door_anomalies(enriched)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.ANOMALY.fields])
