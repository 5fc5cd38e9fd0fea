import math
import random
from datetime import timedelta, timezone

import pytest
from sensor_rows import BASE, NIGHT, SATURDAY, enriched_rows, ts

from sensorflow import schemas
from sensorflow.operators.detect import detect_anomalies, door_anomalies, motion_anomalies
from sensorflow.operators.detect import temperature_anomalies as _temperature_anomalies
from sensorflow.operators.rolling import rolling_zscore as _rolling_zscore

METHODS = ["sweep", "frame", "offsets"]


def temperature_anomalies(df, method="sweep", **kw):  # noqa: F811 - layouts under test
    if method == "offsets":
        return _temperature_anomalies(df, method="sweep", block_seconds=900, **kw)
    return _temperature_anomalies(df, method=method, **kw)


def rolling_zscore(df, method="sweep", **kw):  # noqa: F811
    if method == "offsets":
        return _rolling_zscore(df, method="sweep", block_seconds=900, **kw)
    return _rolling_zscore(df, method=method, **kw)


def temps(values, step=timedelta(minutes=1), start=BASE, sensor="temp-01"):
    return [dict(sensor_id=sensor, value=v, event_ts=start + i * step) for i, v in enumerate(values)]


@pytest.mark.parametrize("method", METHODS)
def test_stable_temperature(spark, method):
    df = enriched_rows(spark, temps([22.0 + 0.1 * i for i in range(10)]))
    assert temperature_anomalies(df, method=method).count() == 0


@pytest.mark.parametrize("method", METHODS)
def test_spike_n10_is_exactly_three_not_flagged(spark, method):
    df = enriched_rows(spark, temps([22.0] * 9 + [75.0]))
    assert temperature_anomalies(df, method=method).count() == 0


@pytest.mark.parametrize("method", METHODS)
def test_spike_n11_flagged(spark, method):
    df = enriched_rows(spark, temps([22.0] * 10 + [75.0]))
    r = temperature_anomalies(df, method=method).collect()
    assert len(r) == 1
    assert r[0]["score"] == pytest.approx(3.1623, abs=1e-4)
    assert r[0]["anomaly_type"] == "temperature_zscore"
    assert r[0]["reason"].startswith("Z-score 3.16 exceeds threshold +-3.0 (window mean=26.82, std=15.24)")


@pytest.mark.parametrize("method", METHODS)
def test_spike_after_earlier_variance(spark, method):
    # variance earlier in the block must not leak into a later constant window
    vals = [float(x) for x in range(10, 60)] + [22.0] * 10 + [75.0]
    rows = temps(vals[:50], step=timedelta(minutes=1)) + \
        temps(vals[50:], step=timedelta(minutes=1), start=BASE + timedelta(hours=2))
    df = enriched_rows(spark, rows)
    r = temperature_anomalies(df, method=method).collect()
    assert len(r) == 1 and r[0]["value"] == 75.0


@pytest.mark.parametrize("method", METHODS)
def test_two_readings(spark, method):
    df = enriched_rows(spark, temps([22.0, 23.0]))
    assert temperature_anomalies(df, method=method).count() == 0


@pytest.mark.parametrize("method", METHODS)
def test_window_edge(spark, method):
    # a spike exactly 3600 s after the first row still sees it; 1 us later it does not
    base = temps([22.0] * 10 + [22.5] * 10, step=timedelta(seconds=30))
    last = base[-1]["event_ts"]
    first = base[0]["event_ts"]
    inside = dict(sensor_id="temp-01", value=80.0, event_ts=first + timedelta(seconds=3600))
    df = enriched_rows(spark, base + [inside])
    r = [x for x in rolling_zscore(df, method=method).collect() if x["value"] == 80.0]
    assert len(r) == 1 and r[0]["_wn"] == 21
    outside = dict(sensor_id="temp-01", value=80.0, event_ts=first + timedelta(seconds=3600, microseconds=1))
    df = enriched_rows(spark, base + [outside])
    r = [x for x in rolling_zscore(df, method=method).collect() if x["value"] == 80.0]
    assert len(r) == 1 and r[0]["_wn"] == 20
    assert last < outside["event_ts"]


@pytest.mark.parametrize("method", METHODS)
def test_ties_later_id_sees_earlier(spark, method):
    rows = temps([22.0] * 10)
    t = rows[-1]["event_ts"] + timedelta(minutes=1)
    rows += [dict(raw_event_id=100, sensor_id="temp-01", value=75.0, event_ts=t),
             dict(raw_event_id=101, sensor_id="temp-01", value=22.0, event_ts=t)]
    df = enriched_rows(spark, rows)
    # id 100 (spike) sees 10 x 22 + itself -> z = sqrt(10) > 3; id 101 sees the spike too
    r = {x["raw_event_id"]: x for x in rolling_zscore(df, method=method, threshold=0.0).collect()}
    assert r[100]["_wn"] == 11 and r[101]["_wn"] == 12


@pytest.mark.parametrize("method", METHODS)
def test_nan_in_window_not_flagged(spark, method):
    df = enriched_rows(spark, temps([22.0] * 10 + [float("nan"), 75.0]))
    assert temperature_anomalies(df, method=method).count() == 0


def test_type_match_is_case_sensitive(spark):
    rows = temps([22.0] * 10 + [75.0])
    for r in rows:
        r["sensor_type"] = "Temperature"
    assert temperature_anomalies(enriched_rows(spark, rows)).count() == 0


def test_sweep_equals_frame_random(spark):
    rnd = random.Random(7)
    rows = []
    for s in ("temp-01", "temp-02", "temp-03"):
        t = BASE
        for i in range(600):
            t += timedelta(seconds=rnd.choice([0, 0, 1, 5, 30, 90, 400]))
            v = rnd.choice([22.0, 22.0, 21.5, 23.25]) if rnd.random() < 0.9 else rnd.uniform(-40, 90)
            rows.append(dict(raw_event_id=len(rows) + 1, sensor_id=s, value=round(v, 2), event_ts=t))
    df = enriched_rows(spark, rows)
    brute = _brute_force_flags(rows, threshold=1.5)
    for block in (900, 1200, 3600, 7200):
        a = rolling_zscore(df, method="sweep", threshold=1.5, block_seconds=block)
        b = rolling_zscore(df, method="frame", threshold=1.5, block_seconds=block)
        ra = {r["raw_event_id"]: (r["_wn"], round(r["_z"], 7)) for r in a.collect()}
        rb = {r["raw_event_id"]: (r["_wn"], round(r["_z"], 7)) for r in b.collect()}
        assert ra == rb and len(ra) > 10
        sure = {i for i, (n, z) in brute.items() if abs(abs(z) - 1.5) > 1e-9}
        assert {i for i in ra if i in sure or i not in brute} == {i for i in sure}
        for i in sure:
            assert ra[i][0] == brute[i][0] and abs(ra[i][1] - brute[i][1]) < 1e-6


def _brute_force_flags(rows, threshold, window_s=3600):
    """Direct model of the window rule: per sensor, sort by (time, id); the window
    of row i is rows j <= i (by position) with 0 <= t_i - t_j <= window."""
    import numpy as np
    out = {}
    by_sensor = {}
    for r in rows:
        by_sensor.setdefault(r["sensor_id"], []).append(r)
    for rs in by_sensor.values():
        rs.sort(key=lambda r: (r["event_ts"], r["raw_event_id"]))
        for i, r in enumerate(rs):
            win = [x["value"] for x in rs[:i + 1]
                   if (r["event_ts"] - x["event_ts"]).total_seconds() <= window_s]
            if len(win) < 2:
                continue
            a = np.array(win, dtype=float)
            sd = a.std()
            if sd == 0:
                continue
            z = (r["value"] - a.mean()) / sd
            if abs(z) > threshold:
                out[r["raw_event_id"]] = (len(win), z)
    return out


def motion(n, baseline, start=BASE, sensor="motion-01", value=1.0):
    return [dict(sensor_id=sensor, sensor_type="motion", value=value, baseline_events_per_min=baseline,
                 event_ts=start + timedelta(seconds=i * (50 / max(n, 1)))) for i in range(n)]


def test_motion_normal(spark):
    assert motion_anomalies(enriched_rows(spark, motion(3, 2.0))).count() == 0


def test_motion_burst(spark):
    r = motion_anomalies(enriched_rows(spark, motion(10, 2.0))).collect()
    assert len(r) == 1 and r[0]["score"] == 5.0
    assert r[0]["reason"] == "Events per minute (10) exceeds 6.0x baseline"
    assert r[0]["event_ts"] == BASE.replace(tzinfo=None)


def test_motion_high_ratio(spark):
    r = motion_anomalies(enriched_rows(spark, motion(20, 1.0))).collect()
    assert r[0]["score"] == 20.0


def test_motion_edge_equal_not_flagged(spark):
    assert motion_anomalies(enriched_rows(spark, motion(6, 2.0))).count() == 0


def test_motion_null_baseline(spark):
    assert motion_anomalies(enriched_rows(spark, motion(10, None))).count() == 0


def test_motion_zero_values_count(spark):
    r = motion_anomalies(enriched_rows(spark, motion(10, 2.0, value=0.0))).collect()
    assert len(r) == 1 and r[0]["value"] == 0.0


def test_motion_baseline_from_metadata(spark):
    from sensorflow.sources.landing import seed_metadata
    df = enriched_rows(spark, motion(10, 2.0)).drop("baseline_events_per_min")
    assert motion_anomalies(df, seed_metadata(spark)).count() == 1


def door(t, value=1.0):
    return dict(sensor_id="door-01", sensor_type="door", value=value, event_ts=t)


def test_door_open_at_night(spark):
    r = door_anomalies(enriched_rows(spark, [door(NIGHT)])).collect()
    assert len(r) == 1 and r[0]["score"] == 1.0 and r[0]["anomaly_type"] == "door_outside_hours"


def test_door_weekend(spark):
    assert door_anomalies(enriched_rows(spark, [door(SATURDAY)])).count() == 1


def test_door_three_opens(spark):
    rows = [door(NIGHT + timedelta(minutes=i)) for i in range(3)]
    assert door_anomalies(enriched_rows(spark, rows)).count() == 3


def test_door_not_flagged(spark):
    assert door_anomalies(enriched_rows(spark, [door(BASE), door(NIGHT, 0.0)])).count() == 0


def test_door_null_business_flag(spark):
    assert door_anomalies(enriched_rows(spark, [dict(door(NIGHT), is_business_hours=None)])).count() == 0


def test_all_anomalies_schema_and_mix(spark):
    rows = temps([22.0 + 0.1 * i for i in range(5)]) + motion(3, 2.0) + [door(BASE)]
    df = detect_anomalies(enriched_rows(spark, rows))
    assert df.count() == 0
    assert [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in schemas.ANOMALY.fields]


def test_all_anomalies_union(spark):
    rows = temps([22.0] * 10 + [75.0]) + motion(10, 2.0) + [door(NIGHT)]
    df = detect_anomalies(enriched_rows(spark, rows))
    assert sorted(r["anomaly_type"] for r in df.collect()) == ["door_outside_hours", "motion_burst",
                                                               "temperature_zscore"]


def test_empty_input(spark):
    df = detect_anomalies(enriched_rows(spark, []))
    assert df.count() == 0 and df.columns == [f.name for f in schemas.ANOMALY.fields]


def _brute(rows, window=3600.0, threshold=3.0):
    """rows: (seconds, id, value) of one sensor -> ids flagged, exactly as the definition says."""
    rows = sorted(rows)
    out = set()
    for k, (t, i, v) in enumerate(rows):
        vals = [x for s, _, x in rows[:k + 1] if t - s <= window]
        mean = math.fsum(vals) / len(vals)
        std = math.sqrt(math.fsum((x - mean) ** 2 for x in vals) / len(vals))
        if len(vals) >= 2 and len(set(vals)) > 1 and abs(v - mean) / std > threshold + 1e-9:
            out.add(i)
    return out


def test_zscore_before_and_after_1970_matches_brute_force(spark):
    """Blocks are rounded down: windows that cross the epoch, ties, constant stretches, high readings, a cold start."""
    rnd = random.Random(7)
    epoch = ts(1970, 1, 1)
    rows = []
    for i in range(700):
        sec = (i - 350) * 60 - (60 if i % 50 == 7 else 0)  # some share their time with the row before
        v = 22.0 if 200 <= i < 300 else round(22 + rnd.uniform(-.005, .005), 4)
        v = 95.0 if i in (90, 91, 400) else 60.0 if i % 97 == 5 else v
        rows.append((float(sec), i + 1, v))
    df = enriched_rows(spark, [dict(raw_event_id=i, value=v, event_ts=epoch + timedelta(seconds=s)) for s, i, v in rows])
    want = _brute(rows)
    assert len(want) > 5
    for kwargs in ({}, {"block_seconds": 3600}, {"block_seconds": 900}, {"method": "frame"}):
        got = temperature_anomalies(df, **kwargs)
        times = {(r.event_ts.replace(tzinfo=timezone.utc) - epoch).total_seconds() for r in got.collect()}
        assert times == {s for s, i, _ in rows if i in want}, kwargs
