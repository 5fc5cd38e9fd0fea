"""Rows for the tests of the sensor part."""

from datetime import datetime, timedelta, timezone

from sensorflow import schemas

UTC = timezone.utc


def ts(y, mo, d, h=0, mi=0, s=0, us=0):
    return datetime(y, mo, d, h, mi, s, us, tzinfo=UTC)


BASE = ts(2024, 6, 3, 10)          # Monday 10:00 UTC
SATURDAY = ts(2024, 6, 8, 10)
NIGHT = ts(2024, 6, 3, 2)


def flat_rows(spark, rows):
    """rows: dicts with FLAT fields; defaults fill the rest (distinct times by default)."""
    out = []
    for i, r in enumerate(rows):
        base = {
            "id": i + 1,
            "sensor_id": "temp-01",
            "sensor_type": "temperature",
            "value": "22.5",
            "unit": "celsius",
            "timestamp": (BASE + timedelta(minutes=i)).isoformat(),
            "received_at": BASE + timedelta(minutes=i, seconds=1),
            "payload": '{"sensor_id": "temp-01"}',
        }
        base.update(r)
        out.append(tuple(base[f] for f in schemas.FLAT.fieldNames()))
    return spark.createDataFrame(out, schemas.FLAT)


def enriched_rows(spark, rows):
    """rows: dicts with ENRICHED fields; hour/day features derived from event_ts when absent."""
    out = []
    for i, r in enumerate(rows):
        e = dict(raw_event_id=i + 1, sensor_id="temp-01", sensor_type="temperature", value=22.0,
                 unit="celsius", event_ts=BASE + timedelta(minutes=i), received_at=None,
                 location=None, zone=None, min_expected=None, max_expected=None,
                 baseline_events_per_min=None)
        e.update(r)
        if e["received_at"] is None:
            e["received_at"] = e["event_ts"]
        t = e["event_ts"]
        e.setdefault("hour_of_day", t.hour if t else None)
        e.setdefault("day_of_week", t.weekday() if t else None)
        if "is_business_hours" not in e:
            e["is_business_hours"] = (8 <= t.hour < 18 and t.weekday() <= 4) if t else None
        out.append(tuple(e[f] for f in schemas.ENRICHED.fieldNames()))
    return spark.createDataFrame(out, schemas.ENRICHED)
