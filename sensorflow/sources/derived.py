"""Landing rows derived from a generic event table.

The test and benchmark tables carry no sensor feed, so the feed is derived
from the ``events`` table (``event_id, ts, user_id, event_type, value, props``)
with fixed formulas.  Every formula here has a twin in the DuckDB oracle SQL
(``sensorflow.plans.oracle``); both must stay in step.  All columns are
functions of one input row except the repeats, which are a second copy of
selected rows -- so the derivation is a narrow, shuffle-free projection.

Let ``e = event_id``, ``u = user_id``, ``v = value`` and
``t = 1717372800 + 5 e`` (epoch seconds; 2024-06-03 00:00 UTC is a Monday).  Ids are
``2 e`` for a row and ``2 e + 1`` for its repeat, so they never collide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# --- fixed values -----------------------------------------------------------
EPOCH_START = 1717372800
SECONDS_PER_EVENT = 5
UNKNOWN_USER = 149
UNKNOWN_SENSOR = "unknown-99"
SENSOR_IDS = ["temp-01", "temp-02", "motion-01", "motion-02", "door-01", "door-02"]
SENSOR_TYPES = ["temperature", "temperature", "motion", "motion", "door", "door"]
REPEAT_DELAY_SECONDS = 30


def _sql_list(values: list[str]) -> str:
    return "array(" + ", ".join(f"'{x}'" for x in values) + ")"


def _json_str_sql(c: str) -> str:
    return f"""CASE WHEN {c} IS NULL THEN 'null' ELSE concat('"', {c}, '"') END"""


_FMT = "yyyy-MM-dd'T'HH:mm:ss"

#: a row of the feed, and for one in 25 a repeat: the repeats of every third of these carry the same
#: instant in another layout, so they are no repeats to the dedup but readings at a tied time
_COPIES = f"""explode(if(e % 25 = 4, array(struct(2 * e AS id, 0 AS late, stamp AS stamp),
                                      struct(2 * e + 1 AS id, {REPEAT_DELAY_SECONDS} AS late,
                                             if(e % 3 = 0 AND stamp IS NOT NULL, slashed, stamp) AS stamp)),
                          array(struct(2 * e AS id, 0 AS late, stamp AS stamp)))) AS c"""


def derive_rows(events: DataFrame) -> DataFrame:
    """One row per event: raw (text) fields, topic id, times; ``k = e mod 500`` picks the odd cases."""
    step1 = events.selectExpr(
        "event_id AS e", "event_id % 500 AS k", "value AS v", f"{EPOCH_START} + {SECONDS_PER_EVENT} * event_id AS t",
        f"CASE WHEN user_id = {UNKNOWN_USER} THEN '{UNKNOWN_SENSOR}' "
        f"ELSE element_at({_sql_list(SENSOR_IDS)}, CAST(user_id % 6 + 1 AS INT)) END AS device",
        f"element_at({_sql_list(SENSOR_TYPES)}, CAST(user_id % 6 + 1 AS INT)) AS kind")
    return step1.selectExpr(
        "e", "k", "t", "device", "CASE WHEN k = 47 THEN CAST(NULL AS STRING) ELSE device END AS sensor_id",
        "CASE WHEN k IN (37, 41) THEN 'Temperature' WHEN k = 33 THEN 'humidity' ELSE kind END AS sensor_type",
        """CASE WHEN k IN (31, 33) THEN 'NaN'
                WHEN k = 37 THEN '150'
                WHEN k = 41 THEN '60.0'
                WHEN k = 53 THEN 'true'
                WHEN k = 67 THEN '22d'
                WHEN k = 71 THEN '0x1p3'
                WHEN e % 20 = 0 THEN CAST(NULL AS STRING)
                WHEN e % 101 = 6 THEN 'n/a'
                WHEN kind = 'temperature' AND e % 211 = 9 THEN '150.0'
                WHEN kind = 'temperature' AND e % 83 = 7 THEN '60.0'
                WHEN kind = 'temperature' THEN CAST(round(18.0 + v - 8.0 * floor(v / 8.0), 2) AS STRING)
                WHEN e % 97 = 5 THEN '2'
                ELSE CAST(e % 2 AS STRING) END AS value""",
        """CASE WHEN e % 100 = 3 THEN CAST(NULL AS STRING)
                WHEN kind = 'temperature' THEN 'celsius' ELSE 'boolean' END AS unit""",
        f"""CASE WHEN e % 50 = 1 THEN CAST(NULL AS STRING)
                 WHEN e % 100 = 2 THEN 'not-a-timestamp'
                 WHEN k = 73 THEN date_format(timestamp_seconds(t), 'HH:mm:ss')
                 WHEN e % 7 = 3 THEN concat(date_format(timestamp_seconds(t + 7200), "{_FMT}"), '+02:00')
                 WHEN e % 7 = 4 THEN date_format(timestamp_seconds(t), "{_FMT}")
                 ELSE concat(date_format(timestamp_seconds(t), "{_FMT}"), '+00:00') END AS stamp""",
        "date_format(timestamp_seconds(t), 'yyyy/MM/dd HH:mm:ss') AS slashed",
        "e % 10 = 9 AS processed")


def _payload_sql(stamp: str) -> str:
    value = f"CASE WHEN k = 53 THEN 'true' ELSE {_json_str_sql('value')} END"
    body = ("concat('{\"sensor_id\":', " + _json_str_sql("sensor_id")
            + ", ',\"sensor_type\":', " + _json_str_sql("sensor_type")
            + ", ',\"value\":', " + value
            + ", ',\"timestamp\":', " + _json_str_sql(stamp)
            + ", CASE WHEN unit IS NULL THEN '' ELSE concat(',\"unit\":', " + _json_str_sql("unit") + ") END, '}')")
    # k = 61, 63: a key that comes again later, the second with odd white space
    return f"""CASE WHEN k = 59 THEN '[1, 2]'
                    WHEN k = 61 THEN concat('{{"value":"7",', substring({body}, 2))
                    WHEN k = 63 THEN concat('{{ \n\t"unit" : "first" , ', substring({body}, 2)) ELSE {body} END"""


def derive_feed(events: DataFrame) -> DataFrame:
    """events -> feed rows with the raw (text) fields and the landing columns; one scan, no shuffle."""
    rows = derive_rows(events).selectExpr("*", _COPIES)
    return rows.selectExpr(
        "c.id AS id", "CASE WHEN k = 43 THEN '' ELSE sensor_id END AS sensor_id", "sensor_type", "value", "unit",
        "c.stamp AS timestamp", "timestamp_seconds(t + 1 + c.late) AS received_at",
        _payload_sql("c.stamp") + " AS payload", "processed")


def derive_landing(events: DataFrame) -> DataFrame:
    """events -> ``LANDING`` rows (id, sensor_id, sensor_type, payload, received_at, processed)."""
    return derive_feed(events).select("id", "sensor_id", "sensor_type", "payload", "received_at", "processed")


def derive_messages(events: DataFrame) -> DataFrame:
    """events -> broker messages ``(id, topic, value BINARY, received_at)``, one per event.

    ``e mod 200 = 11`` carries broken JSON, ``e mod 200 = 13`` a payload without ids (identity
    then comes from the topic).  ``k = 83``: an invalid UTF-8 byte; 87: an object after white
    space, from another topic; 89, 91: a number and ``null``; 93: an object with a key ``raw``.
    """
    f = derive_rows(events)
    text = f"""CASE WHEN e % 200 = 11 THEN concat('{{"sensor_id": "', device, '", broken')
                    WHEN e % 200 = 13 THEN concat('{{"value":', {_json_str_sql("value")}, ',"timestamp":', {_json_str_sql("stamp")}, '}}')
                    WHEN k = 87 THEN concat('\n\t', {_payload_sql("stamp")})
                    WHEN k = 89 THEN '42'
                    WHEN k = 91 THEN 'null'
                    WHEN k = 93 THEN '{{"raw":"x","sensor_id":"r-1","sensor_type":"door","value":"1"}}'
                    ELSE {_payload_sql("stamp")} END"""
    return f.selectExpr(
        "2 * e AS id", "CASE WHEN k = 87 THEN 'sensors/door/other' ELSE concat('sensors/', sensor_type, '/', device) END AS topic",
        f"""CASE WHEN k = 83 THEN concat(encode('{{"sensor_id":"bad-', 'UTF-8'), X'FF', encode('","value":"1"}}', 'UTF-8'))
                 ELSE encode({text}, 'UTF-8') END AS value""",
        "timestamp_seconds(t + 1) AS received_at")


#: parts in which the messages arrive, one after the other
PARTS = 4


def derive_deliveries(events: DataFrame) -> DataFrame:
    """events -> messages as an at-least-once source delivers them: ``(part, id, topic, value, received_at)``.

    Message ``e`` of N belongs to part ``4 e div N``.  ``e mod 50 = 21`` comes a part late; ``e mod 40 = 7`` comes
    again a part later, with a later time of arrival unless it is the last part's.  Part 4 holds messages of the
    first part (``e mod 80 = 19``) that come again when nobody remembers them.
    """
    total = (events.agg({"event_id": "max"}).first()[0] or 0) + 1
    return derive_messages(events).selectExpr(
        "*", "id div 2 AS e").selectExpr(
        "*", f"least({PARTS - 1}, {PARTS} * e div {total}) AS quarter").selectExpr(
        "*", f"least({PARTS - 1}, quarter + if(e % 50 = 21, 1, 0)) AS first").selectExpr(
        "*", f"""explode(concat(
            array(struct(first AS part, received_at AS at)),
            if(e % 40 = 7, array(struct(least({PARTS - 1}, first + 1) AS part,
                                        received_at + make_interval(0, 0, 0, 0, 0, 0, if(first < {PARTS - 1}, 60, 0)) AS at)),
               array()),
            if(e % 80 = 19 AND quarter = 0, array(struct({PARTS} AS part, received_at AS at)), array()))) AS d""").selectExpr(
        "CAST(d.part AS INT) AS part", "id", "topic", "value", "d.at AS received_at")
