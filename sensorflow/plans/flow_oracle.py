"""DuckDB twins of the flow queries: which batch takes each row, then the stages within each batch."""

from __future__ import annotations

from sensorflow.plans.oracle import FEED_CTE, MOTION_CTE, SEED, ZSCORE_CTE, DOOR_CTE, canonical, with_ctes

# --- fixed values, written out here as in ``oracle``

#: messages in the stored form, one per event
MESSAGE_CTE = f"""
message AS (
  SELECT e, 2 * e AS id, make_timestamp((t + 1) * 1000000) AS received_at,
    CASE WHEN k = 87 THEN 'sensors/door/other' ELSE 'sensors/' || sensor_type || '/' || device END AS topic,
    CASE WHEN k = 83 THEN '{{"sensor_id":"bad-' || chr(65533) || '","value":"1"}}'
         WHEN e % 200 = 11 THEN CAST(json_object('raw', '{{"sensor_id": "' || device || '", broken') AS VARCHAR)
         WHEN e % 200 = 13 THEN '{{"timestamp":' || CASE WHEN stamp IS NULL THEN 'null' ELSE '"' || stamp || '"' END
                                || ',"value":' || CASE WHEN value IS NULL THEN 'null' ELSE '"' || value || '"' END || '}}'
         WHEN k = 89 THEN '42'
         WHEN k = 91 THEN 'null'
         WHEN k = 93 THEN '{{"raw":"x","sensor_id":"r-1","sensor_type":"door","value":"1"}}'
         ELSE {canonical("stamp")} END AS canon
  FROM f1
), landed AS (
  SELECT e, id, received_at, canon,
    coalesce(CASE WHEN json_type(canon) = 'OBJECT' THEN json_extract_string(canon, '$.sensor_id') END,
             string_split(topic, '/')[3]) AS sensor_id,
    coalesce(CASE WHEN json_type(canon) = 'OBJECT' THEN json_extract_string(canon, '$.sensor_type') END,
             string_split(topic, '/')[2]) AS sensor_type
  FROM message WHERE topic = 'sensors' OR starts_with(topic, 'sensors/')
)"""

#: the part in which each message comes first, and the messages that nobody remembers
ARRIVAL_CTE = """
n AS (SELECT max(e) + 1 AS total, CAST(ceil(count(*) / 6.0) AS BIGINT) AS cap FROM ev),
quarters AS (SELECT l.*, least(3, 4 * e // n.total) AS quarter, n.cap FROM landed l, n),
arrivals AS (
  SELECT *, least(3, quarter + CASE WHEN e % 50 = 21 THEN 1 ELSE 0 END) AS part FROM quarters
  UNION ALL SELECT *, 4 FROM quarters WHERE e % 80 = 19 AND quarter = 0
), early AS (
  SELECT *, row_number() OVER (ORDER BY received_at, id) - 1 AS nth FROM arrivals WHERE part <= 1
), later AS (
  SELECT *, row_number() OVER (ORDER BY received_at, id) - 1 AS nth FROM (
    SELECT * FROM arrivals WHERE part > 1 UNION ALL SELECT * EXCLUDE (nth) FROM early WHERE nth >= 2 * cap)
), taken AS (
  SELECT *, nth // cap AS batch FROM early WHERE nth < 2 * cap
  UNION ALL SELECT *, 2 + nth // cap FROM later WHERE nth < 3 * cap
)"""

#: landing files in quarters of the ids, a micro-batch each
FILES_CTE = """
taken AS (
  SELECT l.*, least(3, 4 * (id // 2) // (SELECT max(id // 2) + 1 FROM landing)) AS batch FROM landing l
)"""

STAGES_CTE = """
flat AS (
  SELECT batch, id,
    coalesce(nullif(sensor_id, ''), json_extract_string(canon, '$.sensor_id')) AS sensor_id,
    coalesce(nullif(sensor_type, ''), json_extract_string(canon, '$.sensor_type')) AS sensor_type,
    json_extract_string(canon, '$.value') AS value, json_extract_string(canon, '$.unit') AS unit,
    json_extract_string(canon, '$.timestamp') AS "timestamp", received_at,
    CASE WHEN json_type(canon) = 'OBJECT' THEN canon ELSE '{}' END AS payload
  FROM taken
), dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY batch, sensor_id, "timestamp" ORDER BY received_at, id) AS rn FROM flat)
  WHERE rn = 1
), parsed AS (
  SELECT *,
    CASE lower(trim(value)) WHEN 'true' THEN 1.0 WHEN 'false' THEN 0.0 ELSE TRY_CAST(trim(value) AS DOUBLE) END AS dval,
    coalesce(make_timestamp(epoch_us(TRY_CAST(
      CASE WHEN regexp_matches(trim("timestamp"), '(Z|[+-][0-9][0-9]:?[0-9][0-9])$') THEN trim("timestamp")
           ELSE trim("timestamp") || '+00:00' END AS TIMESTAMPTZ))),
      try_strptime(trim("timestamp"), '%Y/%m/%d %H:%M:%S')) AS event_ts
  FROM dedup
), judged AS (
  SELECT *,
    CASE WHEN value IS NULL THEN 'null value'
         WHEN "timestamp" IS NULL THEN 'null timestamp'
         WHEN event_ts IS NULL THEN 'unparseable timestamp'
         WHEN dval IS NULL THEN 'non-numeric value'
         WHEN (lower(sensor_type) = 'temperature' AND NOT (dval BETWEEN -50 AND 100))
           OR (lower(sensor_type) IN ('motion', 'door') AND NOT (dval BETWEEN 0 AND 1))
           THEN 'value out of valid range for sensor_type' END AS reason
  FROM parsed
), first_clean AS (
  SELECT id, min(batch) AS first_batch FROM judged WHERE reason IS NULL GROUP BY id
), classified AS (
  SELECT j.* REPLACE (coalesce(j.reason, CASE WHEN j.batch > c.first_batch THEN 'raw_event_id already committed' END) AS reason)
  FROM judged j LEFT JOIN first_clean c USING (id)
), clean AS (
  SELECT batch, id AS raw_event_id, sensor_id, sensor_type, dval AS value, unit, event_ts, received_at
  FROM classified WHERE reason IS NULL
), enriched AS (
  SELECT c.*, CAST(hour(c.event_ts) AS INTEGER) AS hour_of_day, CAST(isodow(c.event_ts) - 1 AS INTEGER) AS day_of_week,
    (hour(c.event_ts) >= 8 AND hour(c.event_ts) < 18 AND isodow(c.event_ts) <= 5) AS is_business_hours,
    m.location, m.zone, CAST(m.baseline_events_per_min AS DOUBLE) AS baseline_events_per_min
  FROM clean c LEFT JOIN """ + SEED + """ ON c.sensor_id = m.sensor_id
), readings AS (
  SELECT batch AS batch_id, raw_event_id, sensor_id, sensor_type, CASE WHEN isnan(value) THEN NULL ELSE value END AS value, unit,
    event_ts, hour_of_day, day_of_week, zone, location, is_business_hours,
    CASE WHEN sensor_id IS NULL THEN 'null sensor_id' WHEN sensor_type IS NULL THEN 'null sensor_type'
         WHEN value IS NULL OR isnan(value) THEN 'null value' END AS reject_reason
  FROM enriched
)"""

READING_COLUMNS = ("batch_id, raw_event_id, sensor_id, sensor_type, value, unit, event_ts, hour_of_day, day_of_week, zone, location, "
                   "is_business_hours")
_BATCH_ZSCORE = (ZSCORE_CTE.replace("PARTITION BY sensor_id", "PARTITION BY batch, sensor_id")
                 .replace("SELECT sensor_id, sensor_type", "SELECT batch, sensor_id, sensor_type"))
_BATCH_MOTION = MOTION_CTE.replace("SELECT sensor_id, sensor_type", "SELECT batch, sensor_id, sensor_type")
_BATCH_DOOR = DOOR_CTE.replace("SELECT sensor_id, sensor_type", "SELECT batch, sensor_id, sensor_type")


def flow_queries() -> dict[str, str]:
    arrivals = [FEED_CTE, MESSAGE_CTE, ARRIVAL_CTE]
    stages = [*arrivals, STAGES_CTE]
    anomaly = "batch AS batch_id, sensor_id, sensor_type, event_ts, round(value, 6) AS value, anomaly_type, score, reason"
    readings = f"SELECT {READING_COLUMNS} FROM readings WHERE reject_reason IS NULL"
    return {
        "store_landing": with_ctes(*arrivals) + "SELECT id, sensor_id, sensor_type, canon AS payload, received_at FROM arrivals",
        "store_pending": with_ctes(*arrivals) + "SELECT id, received_at FROM later WHERE nth >= 3 * cap",
        "store_readings": with_ctes(*stages) + readings,
        "store_readings_of_day": with_ctes(*stages) + readings + " AND CAST(event_ts AS DATE) = DATE '2024-06-03'",
        "store_clean_events": with_ctes(*stages) + """
SELECT batch AS batch_id, raw_event_id, sensor_id, sensor_type, CASE WHEN isnan(value) THEN NULL ELSE value END AS value,
  isnan(value) AS value_is_nan, unit, event_ts FROM clean""",
        "store_dead_letters": with_ctes(*stages) + """
SELECT batch AS batch_id, id AS raw_event_id, CAST(json_object('raw', payload) AS VARCHAR) AS payload, reason
FROM classified WHERE reason IS NOT NULL
UNION ALL
SELECT r.batch_id, r.raw_event_id, CAST(json_object('raw', c.payload) AS VARCHAR), r.reject_reason
FROM readings r JOIN classified c ON c.batch = r.batch_id AND c.id = r.raw_event_id WHERE r.reject_reason IS NOT NULL""",
        "store_anomalies": with_ctes(*stages, _BATCH_ZSCORE, _BATCH_MOTION, _BATCH_DOOR) + f"""
SELECT {anomaly} FROM zscores UNION ALL SELECT {anomaly} FROM bursts UNION ALL SELECT {anomaly} FROM doors""",
        "store_run_metrics": with_ctes(*stages) + """
, r AS (SELECT batch_id, count(*) AS "rows", count(*) FILTER (WHERE zone IS NULL) AS rows_without_zone,
          count(reject_reason) AS rejected_rows FROM readings GROUP BY batch_id)
SELECT c.batch AS batch_id, count(*) AS deduped_rows, count(*) FILTER (WHERE c.reason IS NULL) AS clean_rows,
  count(c.reason) AS dead_letter_rows, any_value(r."rows") AS "rows", any_value(r.rows_without_zone) AS rows_without_zone,
  any_value(r.rejected_rows) AS rejected_rows
FROM classified c LEFT JOIN r ON r.batch_id = c.batch GROUP BY c.batch""",
        "store_dimension": with_ctes(*stages) + f"""
SELECT sensor_id, sensor_type, location, zone, CAST(min_expected AS DOUBLE) AS min_expected,
  CAST(max_expected AS DOUBLE) AS max_expected, CAST(baseline_events_per_min AS DOUBLE) AS baseline_events_per_min FROM {SEED}
UNION ALL
SELECT sensor_id, arg_min(sensor_type, (batch, received_at, raw_event_id)), NULL, NULL, NULL, NULL, NULL FROM clean
WHERE sensor_id IS NOT NULL AND sensor_id NOT IN (SELECT sensor_id FROM {SEED}) GROUP BY sensor_id""",
        "stream_restart_readings": with_ctes(FEED_CTE, FILES_CTE, STAGES_CTE) + readings,
    }
