from datetime import timedelta

from sensor_rows import BASE, flat_rows

from sensorflow import rules
from sensorflow.operators.clean import clean_events, dedup_keep_first


def run(spark, rows):
    c, d = clean_events(flat_rows(spark, rows))
    return c.orderBy("raw_event_id").collect(), d.orderBy("raw_event_id").collect()


def test_valid_row(spark):
    c, d = run(spark, [{}])
    assert len(c) == 1 and len(d) == 0
    assert c[0]["value"] == 22.5 and c[0]["raw_event_id"] == 1


def test_five_valid_rows_with_distinct_times(spark):
    c, d = run(spark, [{} for _ in range(5)])
    assert (len(c), len(d)) == (5, 0)


def test_same_key_rows_collapse_to_one(spark):
    # the original helper gives every row the same sensor and timestamp
    same = BASE.isoformat()
    c, d = run(spark, [{"timestamp": same} for _ in range(5)])
    assert (len(c), len(d)) == (1, 0)


def test_empty(spark):
    c, d = clean_events(flat_rows(spark, []))
    assert c.count() == 0 and d.count() == 0
    assert [f.name for f in c.schema.fields][:6] == ["raw_event_id", "sensor_id", "sensor_type", "value",
                                                     "unit", "event_ts"]
    assert d.columns == ["raw_event_id", "payload", "reason"]


def test_null_value(spark):
    c, d = run(spark, [{}, {"value": None}, {}])
    assert len(c) == 2 and len(d) == 1
    assert d[0]["reason"] == rules.REASON_NULL_VALUE and d[0]["raw_event_id"] == 2


def test_all_null_values(spark):
    c, d = run(spark, [{"value": None} for _ in range(3)])
    assert len(c) == 0 and [r["reason"] for r in d] == [rules.REASON_NULL_VALUE] * 3


def test_duplicate_keeps_first(spark):
    t = BASE.isoformat()
    c, d = run(spark, [{"timestamp": t, "value": "1.0"}, {"timestamp": t, "value": "2.0"}])
    assert len(c) == 1 and len(d) == 0 and c[0]["value"] == 1.0 and c[0]["raw_event_id"] == 1


def test_first_is_by_arrival_not_id(spark):
    t = BASE.isoformat()
    c, _ = run(spark, [{"timestamp": t, "value": "1.0", "received_at": BASE + timedelta(seconds=9)},
                       {"timestamp": t, "value": "2.0", "received_at": BASE}])
    assert c[0]["raw_event_id"] == 2


def test_other_time_or_sensor_kept(spark):
    t = BASE.isoformat()
    c, _ = run(spark, [{"timestamp": t}, {"timestamp": (BASE + timedelta(seconds=1)).isoformat()},
                       {"timestamp": t, "sensor_id": "temp-02"}])
    assert len(c) == 3


def test_null_and_bad_timestamp(spark):
    c, d = run(spark, [{"timestamp": None}, {"timestamp": "not-a-real-date"}])
    assert len(c) == 0
    assert [r["reason"] for r in d] == [rules.REASON_NULL_TIMESTAMP, rules.REASON_BAD_TIMESTAMP]


def test_offset_and_naive_timestamp_are_utc(spark):
    c, _ = run(spark, [{"timestamp": "2024-06-03T12:00:00+02:00", "sensor_id": "a"},
                       {"timestamp": "2024-06-03T10:00:00", "sensor_id": "b"},
                       {"timestamp": "2024-06-03T10:00:00Z", "sensor_id": "c"}])
    assert {r["event_ts"] for r in c} == {BASE.replace(tzinfo=None)}


def test_same_instant_different_text_both_kept(spark):
    c, _ = run(spark, [{"timestamp": "2024-06-03T10:00:00Z"}, {"timestamp": "2024-06-03T10:00:00+00:00"}])
    assert len(c) == 2


def test_range_edges(spark):
    rows = [{"value": "-51"}, {"value": "101"}, {"value": "-50"}, {"value": "100"},
            {"sensor_type": "motion", "value": "2"}, {"sensor_type": "door", "value": "-1"}]
    c, d = run(spark, rows)
    assert [r["raw_event_id"] for r in c] == [3, 4]
    assert [r["raw_event_id"] for r in d] == [1, 2, 5, 6]
    assert {r["reason"] for r in d} == {rules.REASON_OUT_OF_RANGE}


def test_motion_binary_values_clean(spark):
    c, d = run(spark, [{"sensor_type": "motion", "value": v} for v in ("0", "1", "0.0", "1.0")])
    assert len(c) == 4 and len(d) == 0


def test_unknown_type_passes(spark):
    c, _ = run(spark, [{"sensor_type": "humidity", "value": "9999.0"}])
    assert c[0]["value"] == 9999.0


def test_type_lowercased_for_range(spark):
    c, d = run(spark, [{"sensor_type": "Temperature", "value": "150"}])
    assert len(c) == 0 and d[0]["reason"] == rules.REASON_OUT_OF_RANGE


def test_nan_fails_ruled_type(spark):
    c, d = run(spark, [{"value": "NaN"}, {"sensor_type": "humidity", "value": "NaN"}])
    assert [r["raw_event_id"] for r in d] == [1] and [r["raw_event_id"] for r in c] == [2]


def test_non_numeric_and_boolean(spark):
    c, d = run(spark, [{"value": "n/a"}, {"sensor_type": "door", "value": "true"}])
    assert d[0]["reason"] == rules.REASON_NON_NUMERIC
    assert c[0]["value"] == 1.0


def test_null_value_first_hides_good_duplicate(spark):
    t = BASE.isoformat()
    c, d = run(spark, [{"timestamp": t, "value": None}, {"timestamp": t, "value": "22.0"}])
    assert len(c) == 0 and len(d) == 1 and d[0]["reason"] == rules.REASON_NULL_VALUE


def test_first_failing_rule_wins(spark):
    c, d = run(spark, [{"value": None, "timestamp": None}])
    assert d[0]["reason"] == rules.REASON_NULL_VALUE


def test_null_payload_text(spark):
    _, d = run(spark, [{"value": None, "payload": None}])
    assert d[0]["payload"] == "None"


def test_output_types(spark):
    c, d = clean_events(flat_rows(spark, [{}]))
    assert dict(c.dtypes)["value"] == "double"
    assert dict(c.dtypes)["event_ts"] == "timestamp"
    assert "reason" in d.columns


def test_null_timestamps_collapse_per_sensor(spark):
    df = flat_rows(spark, [{"timestamp": None}, {"timestamp": None}, {"timestamp": None, "sensor_id": "x"}])
    assert dedup_keep_first(df).count() == 2
