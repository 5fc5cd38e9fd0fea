"""Clean step vs a plain-Python model of its rules, on generated batches."""

from datetime import datetime, timedelta, timezone

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sensorflow import rules, schemas
from sensorflow.operators.clean import clean_events

T0 = datetime(2024, 6, 3, 10, tzinfo=timezone.utc)
VALUES = [None, "22.5", "-51", "100", "1", "0", "2", "n/a", "NaN", "true", "1e3"]
STAMPS = [None, "2024-06-03T10:00:00Z", "2024-06-03T12:00:00+02:00", "2024-06-03T10:00:00",
          "not-a-date", "2024-06-03T10:00:01+00:00"]
TYPES = ["temperature", "Temperature", "motion", "door", "humidity", None]
SENSORS = ["a", "b", None]

row = st.tuples(st.sampled_from(SENSORS), st.sampled_from(TYPES), st.sampled_from(VALUES),
                st.sampled_from(STAMPS), st.integers(0, 5))


def model(rows):
    """rows: (id, sensor, type, value, ts, arrival) -> (clean ids, {dead id: reason})."""
    first = {}
    for r in sorted(rows, key=lambda r: (r[5], r[0])):
        first.setdefault((r[1], r[4]), r)
    clean, dead = set(), {}
    for rid, _sid, typ, val, ts, _ in first.values():
        num = None
        if val is not None:
            low = val.strip().lower()
            num = 1.0 if low == "true" else 0.0 if low == "false" else None
            if num is None:
                try:
                    num = float(val)
                except ValueError:
                    num = None
        parsed = ts is not None and ts != "not-a-date"
        if val is None:
            dead[rid] = rules.REASON_NULL_VALUE
        elif ts is None:
            dead[rid] = rules.REASON_NULL_TIMESTAMP
        elif not parsed:
            dead[rid] = rules.REASON_BAD_TIMESTAMP
        elif num is None:
            dead[rid] = rules.REASON_NON_NUMERIC
        elif typ is not None and typ.lower() in rules.VALID_RANGES and not (
                rules.VALID_RANGES[typ.lower()][0] <= num <= rules.VALID_RANGES[typ.lower()][1]):
            dead[rid] = rules.REASON_OUT_OF_RANGE
        else:
            clean.add(rid)
    return clean, dead


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=25))
def test_clean_matches_model(spark, gen):
    rows = [(i + 1, s, t, v, ts, a) for i, (s, t, v, ts, a) in enumerate(gen)]
    data = [(rid, s, t, v, "u", ts, T0 + timedelta(seconds=a), "{}") for rid, s, t, v, ts, a in rows]
    c, d = clean_events(spark.createDataFrame(data, schemas.FLAT))
    want_clean, want_dead = model(rows)
    assert {r["raw_event_id"] for r in c.collect()} == want_clean
    assert {r["raw_event_id"]: r["reason"] for r in d.collect()} == want_dead
