from datetime import datetime, timedelta

from pyspark.sql import functions as F

from sensorflow.functions.columns import iso_utc_text, packed_order_key, parse_event_time


def test_packed_order_key_matches_struct_order(spark):
    t0 = datetime(2024, 6, 3, 10)
    rows = [(t0, 5), (t0, -3), (t0, 9223372036854775807), (t0, -9223372036854775808),
            (t0 + timedelta(microseconds=1), -9223372036854775808), (datetime(1960, 1, 1), 0),
            (datetime(9999, 12, 31, 23, 59, 59), 0), (t0 - timedelta(microseconds=1), 9223372036854775807)]
    df = spark.createDataFrame(rows, "received_at timestamp, raw_event_id long")
    key = packed_order_key(df)
    by_packed = [tuple(r) for r in df.orderBy(key).collect()]
    by_struct = [tuple(r) for r in df.orderBy("received_at", "raw_event_id").collect()]
    assert by_packed == by_struct


def test_parse_event_time_layouts(spark):
    df = spark.createDataFrame([("2024-06-03T10:00:00Z",), ("2024-06-03 12:00:00+02:00",), ("2024-06-03",),
                                ("2024/06/03 10:00:00",), (" 2024-06-03T10:00:00.5 ",), ("garbage",), (None,)],
                               "t string")
    out = [r[0] for r in df.select(parse_event_time("t")).collect()]
    assert out[0] == out[1] == out[3] == datetime(2024, 6, 3, 10)
    assert out[2] == datetime(2024, 6, 3)
    assert out[4] == datetime(2024, 6, 3, 10, 0, 0, 500000)
    assert out[5] is None and out[6] is None


def test_iso_text(spark):
    df = spark.createDataFrame([(datetime(2024, 6, 3, 10),), (datetime(2024, 6, 3, 10, 0, 0, 123),)], "t timestamp")
    assert [r[0] for r in df.select(iso_utc_text(F.col("t"))).collect()] == [
        "2024-06-03T10:00:00+00:00", "2024-06-03T10:00:00.000123+00:00"]
