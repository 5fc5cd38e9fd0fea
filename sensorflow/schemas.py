"""Declared schemas of every stage (one schema per stage, empty or not)."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, B, I, TS = (T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(),
                     T.IntegerType(), T.TimestampType())


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Broker message as delivered by a Kafka- or file-shaped source.
MESSAGE = _struct(("topic", S), ("value", T.BinaryType()), ("received_at", TS))

# Landing table (append-only).
LANDING = _struct(("id", L), ("sensor_id", S), ("sensor_type", S), ("payload", S),
                  ("received_at", TS), ("processed", B))

# Flattened landing row: input of the clean step.
FLAT = _struct(("id", L), ("sensor_id", S), ("sensor_type", S), ("value", S), ("unit", S),
               ("timestamp", S), ("received_at", TS), ("payload", S))

# Curated rows: output of the clean step (received_at kept as the order key).
CLEAN = _struct(("raw_event_id", L), ("sensor_id", S), ("sensor_type", S), ("value", D),
                ("unit", S), ("event_ts", TS), ("received_at", TS))

DEAD_LETTER = _struct(("raw_event_id", L), ("payload", S), ("reason", S))

METADATA = _struct(("sensor_id", S), ("sensor_type", S), ("location", S), ("zone", S),
                   ("min_expected", D), ("max_expected", D), ("baseline_events_per_min", D))

METADATA_JOINED = ("location", "zone", "min_expected", "max_expected", "baseline_events_per_min")

ENRICHED = _struct(*[(f.name, f.dataType) for f in CLEAN.fields],
                   ("hour_of_day", I), ("day_of_week", I), ("is_business_hours", B),
                   ("location", S), ("zone", S), ("min_expected", D), ("max_expected", D),
                   ("baseline_events_per_min", D))

ANOMALY = _struct(("sensor_id", S), ("sensor_type", S), ("event_ts", TS), ("value", D),
                  ("anomaly_type", S), ("score", D), ("reason", S))

# Sink rows (constraint-checked; NOT NULL columns guarded before the write).
READING = _struct(("raw_event_id", L), ("sensor_id", S), ("sensor_type", S), ("value", D),
                  ("unit", S), ("event_ts", TS), ("hour_of_day", I), ("day_of_week", I),
                  ("zone", S), ("location", S), ("is_business_hours", B))

# Counters of one run, stored with its tables.
RUN_METRICS = _struct(("deduped_rows", L), ("clean_rows", L), ("dead_letter_rows", L), ("rows", L),
                      ("rows_without_zone", L), ("rejected_rows", L))
