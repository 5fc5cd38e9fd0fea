"""Sinks: constraint guard, idempotent appends, processed ledger, dimension seeding."""

from sensorflow.sinks.tables import (
    anomaly_rows,
    dead_letter_sink_rows,
    guard_not_null,
    insert_if_absent,
    mark_processed,
    nan_to_null,
    primary_key_violations,
    reading_rows,
    write_batch,
)

__all__ = [
    "anomaly_rows", "dead_letter_sink_rows", "guard_not_null", "insert_if_absent",
    "mark_processed", "nan_to_null", "primary_key_violations", "reading_rows", "write_batch",
]
