"""Operators: clean, enrich, detectors, rolling windows, join helpers."""

from sensorflow.operators.clean import (
    classify,
    clean_events,
    clean_rows,
    dead_letter_rows,
    dedup_keep_first,
)
from sensorflow.operators.detect import (
    detect_anomalies,
    door_anomalies,
    motion_anomalies,
    motion_minute_counts,
    temperature_anomalies,
)
from sensorflow.operators.enrich import enrich_events, enrich_quality, time_features, with_baseline
from sensorflow.operators.joins import dimension_join
from sensorflow.operators.rolling import rolling_zscore

__all__ = [
    "classify", "clean_events", "clean_rows", "dead_letter_rows", "dedup_keep_first",
    "detect_anomalies", "dimension_join", "door_anomalies", "enrich_events", "enrich_quality",
    "motion_anomalies", "motion_minute_counts", "rolling_zscore",
    "temperature_anomalies", "time_features", "with_baseline",
]
