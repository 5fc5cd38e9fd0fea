"""Fixed values the results depend on.

These constants define the semantics of the pipeline and must stay exactly as
listed: valid value ranges per sensor type, detector thresholds, the business
calendar, the seed sensor dimension and the record caps.
"""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------
# Inclusive valid value range per sensor type (type compared lower-cased).
VALID_RANGES: dict[str, tuple[float, float]] = {
    "temperature": (-50.0, 100.0),
    "motion": (0.0, 1.0),
    "door": (0.0, 1.0),
}

# Rolling z-score: flag when |z| > ZSCORE_THRESHOLD over a trailing window.
ZSCORE_THRESHOLD = 3.0
ZSCORE_WINDOW_SECONDS = 3600

# Motion bursts: flag a sensor-minute when its count > MULTIPLIER x baseline.
MOTION_BASELINE_MULTIPLIER = 3.0

# Business hours (UTC): Monday..Friday (day_of_week 0..4), 08:00 <= t < 18:00.
BUSINESS_HOUR_START = 8
BUSINESS_HOUR_END = 18
LAST_BUSINESS_WEEKDAY = 4

# Oldest-first batch cap of one scheduled run.
BATCH_LIMIT = 5000

# Seed sensor dimension:
# (sensor_id, sensor_type, location, zone, min_expected, max_expected, baseline_events_per_min)
SEED_SENSORS: list[tuple[str, str, str, str, float, float, float]] = [
    ("temp-01", "temperature", "Server Room A", "zone-a", -50.0, 100.0, 0.5),
    ("temp-02", "temperature", "Office Floor 2", "zone-b", -50.0, 100.0, 0.5),
    ("motion-01", "motion", "Main Entrance", "zone-a", 0.0, 1.0, 2.0),
    ("motion-02", "motion", "Parking Lot", "zone-c", 0.0, 1.0, 1.0),
    ("door-01", "door", "Front Door", "zone-a", 0.0, 1.0, 0.3),
    ("door-02", "door", "Back Exit", "zone-b", 0.0, 1.0, 0.2),
]

# Output labels and messages.
REASON_NULL_VALUE = "null value"
REASON_NULL_TIMESTAMP = "null timestamp"
REASON_BAD_TIMESTAMP = "unparseable timestamp"
REASON_NON_NUMERIC = "non-numeric value"
REASON_OUT_OF_RANGE = "value out of valid range for sensor_type"
REASON_NULL_SENSOR_ID = "null sensor_id"
REASON_NULL_SENSOR_TYPE = "null sensor_type"
REASON_REPEATED_KEY = "raw_event_id already committed"

ANOMALY_TEMPERATURE = "temperature_zscore"
ANOMALY_MOTION = "motion_burst"
ANOMALY_DOOR = "door_outside_hours"
DOOR_REASON = "Door opened outside business hours (Mon-Fri 08:00-18:00)"

# Extra timestamp layouts tried, in order, after the ISO-8601 family that the
# cast rules already accept (Spark datetime patterns).
EXTRA_TIMESTAMP_FORMATS: tuple[str, ...] = (
    "yyyy/MM/dd HH:mm:ss",
    "yyyy/MM/dd HH:mm",
    "yyyy/MM/dd",
    "MM/dd/yyyy HH:mm:ss",
    "MM/dd/yyyy",
    "dd MMM yyyy HH:mm:ss",
    "MMM d yyyy HH:mm:ss",
    "MMMM d yyyy HH:mm:ss",
    "MMMM d yyyy",
)
