"""Motion bursts vs a plain-Python model on generated readings."""

from datetime import timedelta

from sensor_rows import BASE, enriched_rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sensorflow.operators.detect import motion_anomalies

reading = st.tuples(st.sampled_from(["m1", "m2"]), st.integers(0, 179), st.integers(0, 30),
                    st.sampled_from([0.0, 1.0]), st.sampled_from([0.5, 1.0, 2.0, None]))


def model(rows):
    groups = {}
    for rid, (sid, sec, arrival, val, base) in rows:
        if base is None:
            continue
        t = BASE + timedelta(seconds=sec)
        key = (sid, t.replace(second=0))
        groups.setdefault(key, []).append((arrival, rid, t, val, base))
    out = {}
    for (sid, _m), rs in groups.items():
        rs.sort()
        first = rs[0]
        n = len(rs)
        if n > first[4] * 3.0:
            out[(sid, first[2].replace(tzinfo=None))] = (round(n / first[4], 4), sum(r[3] for r in rs) / n)
    return out


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(reading, min_size=1, max_size=40))
def test_motion_matches_model(spark, gen):
    rows = list(enumerate(gen, start=1))
    data = [dict(raw_event_id=rid, sensor_id=sid, sensor_type="motion", value=val, baseline_events_per_min=base,
                 event_ts=BASE + timedelta(seconds=sec), received_at=BASE + timedelta(seconds=arrival))
            for rid, (sid, sec, arrival, val, base) in rows]
    got = {(r["sensor_id"], r["event_ts"]): (r["score"], r["value"])
           for r in motion_anomalies(enriched_rows(spark, data)).collect()}
    want = model(rows)
    assert got.keys() == want.keys()
    for k in got:
        assert got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-12
