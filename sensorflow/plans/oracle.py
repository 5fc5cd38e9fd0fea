"""DuckDB SQL twins of the registered queries (the correctness oracle).

``LANDING_CTE`` re-derives the landing feed from ``events`` with the same
formulas as ``sensorflow.sources.derived``; the stage CTEs mirror the Spark
operators step by step.  Times are returned as zone-less UTC timestamps.
"""

from __future__ import annotations


def _json_str(c: str) -> str:
    return f"""CASE WHEN {c} IS NULL THEN 'null' ELSE '"' || {c} || '"' END"""


def _body(stamp: str) -> str:
    return f"""'{{"sensor_id":' || {_json_str('sensor_id')} || ',"sensor_type":' || {_json_str('sensor_type')}
      || ',"value":' || CASE WHEN k = 53 THEN 'true' ELSE {_json_str('value')} END
      || ',"timestamp":' || {_json_str(stamp)}
      || CASE WHEN unit IS NULL THEN '' ELSE ',"unit":' || {_json_str('unit')} END || '}}'"""


def _payload(stamp: str) -> str:
    """The payload as it is sent: of 61 and 63 with a key that comes again."""
    return f"""CASE WHEN k = 59 THEN '[1, 2]'
      WHEN k = 61 THEN '{{"value":"7",' || substr({_body(stamp)}, 2)
      WHEN k = 63 THEN '{{ ' || chr(10) || chr(9) || '"unit" : "first" , ' || substr({_body(stamp)}, 2)
      ELSE {_body(stamp)} END"""


def canonical(stamp: str) -> str:
    """The payload in the one form it is stored in: keys in order, the last one of equal keys."""
    return f"""CASE WHEN k = 59 THEN '[1,2]' ELSE
      '{{"sensor_id":' || {_json_str('sensor_id')} || ',"sensor_type":' || {_json_str('sensor_type')}
      || ',"timestamp":' || {_json_str(stamp)}
      || CASE WHEN unit IS NULL THEN '' ELSE ',"unit":' || {_json_str('unit')} END
      || ',"value":' || CASE WHEN k = 53 THEN 'true' ELSE {_json_str('value')} END || '}}' END"""


_TS_FMT = "'%Y-%m-%dT%H:%M:%S'"

# --- fixed values, written out here and not imported: a wrong constant must not pass on both sides
FEED_CTE = f"""
ev AS (
  SELECT event_id AS e, event_id % 500 AS k, user_id AS u, value AS v, 1717372800 + 5 * event_id AS t
  FROM events
), f0 AS (
  SELECT e, k, v, t,
    CASE WHEN u = 149 THEN 'unknown-99'
         ELSE (['temp-01', 'temp-02', 'motion-01', 'motion-02', 'door-01', 'door-02'])[(u % 6) + 1] END AS device,
    (['temperature', 'temperature', 'motion', 'motion', 'door', 'door'])[(u % 6) + 1] AS kind
  FROM ev
), f1 AS (
  SELECT e, k, t, device, CASE WHEN k = 47 THEN NULL ELSE device END AS sensor_id,
    CASE WHEN k IN (37, 41) THEN 'Temperature' WHEN k = 33 THEN 'humidity' ELSE kind END AS sensor_type,
    CASE WHEN k IN (31, 33) THEN 'NaN'
         WHEN k = 37 THEN '150'
         WHEN k = 41 THEN '60.0'
         WHEN k = 53 THEN 'true'
         WHEN k = 67 THEN '22d'
         WHEN k = 71 THEN '0x1p3'
         WHEN e % 20 = 0 THEN NULL
         WHEN e % 101 = 6 THEN 'n/a'
         WHEN kind = 'temperature' AND e % 211 = 9 THEN '150.0'
         WHEN kind = 'temperature' AND e % 83 = 7 THEN '60.0'
         WHEN kind = 'temperature' THEN CAST(round(18.0 + v - 8.0 * floor(v / 8.0), 2) AS VARCHAR)
         WHEN e % 97 = 5 THEN '2'
         ELSE CAST(e % 2 AS VARCHAR) END AS value,
    CASE WHEN e % 50 = 1 THEN NULL
         WHEN e % 100 = 2 THEN 'not-a-timestamp'
         WHEN k = 73 THEN strftime(make_timestamp(t * 1000000), '%H:%M:%S')
         WHEN e % 7 = 3 THEN strftime(make_timestamp((t + 7200) * 1000000), {_TS_FMT}) || '+02:00'
         WHEN e % 7 = 4 THEN strftime(make_timestamp(t * 1000000), {_TS_FMT})
         ELSE strftime(make_timestamp(t * 1000000), {_TS_FMT}) || '+00:00' END AS stamp,
    CASE WHEN e % 100 = 3 THEN NULL WHEN kind = 'temperature' THEN 'celsius' ELSE 'boolean' END AS unit,
    e % 10 = 9 AS processed
  FROM f0
), f2 AS (
  SELECT *, 2 * e AS id, 0 AS late, stamp AS "timestamp" FROM f1
  UNION ALL
  SELECT *, 2 * e + 1, 30,
    CASE WHEN e % 3 = 0 AND stamp IS NOT NULL THEN strftime(make_timestamp(t * 1000000), '%Y/%m/%d %H:%M:%S') ELSE stamp END
  FROM f1 WHERE e % 25 = 4
), feed AS (
  SELECT id, CASE WHEN k = 43 THEN '' ELSE sensor_id END AS sensor_id, sensor_type, value, unit, "timestamp",
    make_timestamp((t + 1 + late) * 1000000) AS received_at, {_payload('"timestamp"')} AS payload,
    {canonical('"timestamp"')} AS canon, processed
  FROM f2
), landing AS (
  SELECT id, sensor_id, sensor_type, payload, canon, received_at, processed FROM feed
)"""

FLAT_CTE = """
flat AS (
  SELECT id,
    coalesce(nullif(sensor_id, ''), json_extract_string(canon, '$.sensor_id')) AS sensor_id,
    coalesce(nullif(sensor_type, ''), json_extract_string(canon, '$.sensor_type')) AS sensor_type,
    json_extract_string(canon, '$.value') AS value,
    json_extract_string(canon, '$.unit') AS unit,
    json_extract_string(canon, '$.timestamp') AS "timestamp",
    received_at, CASE WHEN json_type(canon) = 'OBJECT' THEN canon ELSE '{}' END AS payload
  FROM landing
)"""


CLEAN_CTE = f"""
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY sensor_id, "timestamp" ORDER BY received_at, id) AS rn FROM flat)
  WHERE rn = 1
), parsed AS (
  SELECT *,
    CASE lower(trim(value)) WHEN 'true' THEN 1.0 WHEN 'false' THEN 0.0
         ELSE TRY_CAST(trim(value) AS DOUBLE) END AS dval,
    coalesce(make_timestamp(epoch_us(TRY_CAST(
      CASE WHEN regexp_matches(trim("timestamp"), '(Z|[+-][0-9][0-9]:?[0-9][0-9])$') THEN trim("timestamp")
           ELSE trim("timestamp") || '+00:00' END AS TIMESTAMPTZ))),
      try_strptime(trim("timestamp"), '%Y/%m/%d %H:%M:%S')) AS event_ts
  FROM dedup
), classified AS (
  SELECT *,
    CASE WHEN value IS NULL THEN 'null value'
         WHEN "timestamp" IS NULL THEN 'null timestamp'
         WHEN event_ts IS NULL THEN 'unparseable timestamp'
         WHEN dval IS NULL THEN 'non-numeric value'
         WHEN (lower(sensor_type) = 'temperature' AND NOT (dval BETWEEN -50 AND 100))
           OR (lower(sensor_type) IN ('motion', 'door') AND NOT (dval BETWEEN 0 AND 1))
           THEN 'value out of valid range for sensor_type'
    END AS reason
  FROM parsed
), clean AS (
  SELECT id AS raw_event_id, sensor_id, sensor_type, dval AS value, unit, event_ts, received_at
  FROM classified WHERE reason IS NULL
), dead AS (
  SELECT id AS raw_event_id, coalesce(payload, 'None') AS payload, reason FROM classified WHERE reason IS NOT NULL
)"""


SEED = """(VALUES
  ('temp-01', 'temperature', 'Server Room A', 'zone-a', -50.0, 100.0, 0.5),
  ('temp-02', 'temperature', 'Office Floor 2', 'zone-b', -50.0, 100.0, 0.5),
  ('motion-01', 'motion', 'Main Entrance', 'zone-a', 0.0, 1.0, 2.0),
  ('motion-02', 'motion', 'Parking Lot', 'zone-c', 0.0, 1.0, 1.0),
  ('door-01', 'door', 'Front Door', 'zone-a', 0.0, 1.0, 0.3),
  ('door-02', 'door', 'Back Exit', 'zone-b', 0.0, 1.0, 0.2))
  AS m(sensor_id, sensor_type, location, zone, min_expected, max_expected, baseline_events_per_min)"""
ZERO_BASELINE = f"(SELECT * REPLACE (0.0 AS baseline_events_per_min) FROM {SEED} WHERE sensor_id <> 'motion-01') AS m"


def _enriched_cte(meta: str) -> str:
    return f"""
enriched AS (
  SELECT c.raw_event_id, c.sensor_id, c.sensor_type, c.value, c.unit, c.event_ts, c.received_at,
    CAST(hour(c.event_ts) AS INTEGER) AS hour_of_day,
    CAST(isodow(c.event_ts) - 1 AS INTEGER) AS day_of_week,
    (hour(c.event_ts) >= 8 AND hour(c.event_ts) < 18 AND isodow(c.event_ts) <= 5) AS is_business_hours,
    m.location, m.zone, CAST(m.min_expected AS DOUBLE) AS min_expected,
    CAST(m.max_expected AS DOUBLE) AS max_expected,
    CAST(m.baseline_events_per_min AS DOUBLE) AS baseline_events_per_min
  FROM clean c LEFT JOIN {meta} ON c.sensor_id = m.sensor_id
)"""


ENRICHED_CTE = _enriched_cte(SEED)
EMPTY_META = ("(SELECT * FROM " + SEED + " WHERE false) AS m")
ENRICHED_EMPTY_DIM_CTE = _enriched_cte(EMPTY_META)

ZSCORE_CTE = f"""
temp AS (
  SELECT *, epoch_us(event_ts) AS micros,
    row_number() OVER (PARTITION BY sensor_id, event_ts ORDER BY raw_event_id) - 1 AS tie_rank
  FROM enriched WHERE sensor_type = 'temperature' AND event_ts IS NOT NULL
), temp_w AS (
  SELECT *,
    count(*) OVER w AS wn, avg(value) OVER w AS wmean, stddev_pop(value) OVER w AS wstd
  FROM (SELECT *, micros * 2048 + tie_rank AS o FROM temp)
  WINDOW w AS (PARTITION BY sensor_id ORDER BY o RANGE BETWEEN 7372800001023 PRECEDING AND CURRENT ROW)
), zscores AS (
  SELECT sensor_id, sensor_type, event_ts, value, 'temperature_zscore' AS anomaly_type,
    round(abs((value - wmean) / wstd), 4) AS score,
    printf('Z-score %.2f exceeds threshold +-3.0 (window mean=%.2f, std=%.2f)', (value - wmean) / wstd, wmean, wstd) AS reason
  FROM temp_w
  WHERE wn >= 2 AND wstd <> 0 AND abs((value - wmean) / wstd) > 3.0
)"""

MOTION_CTE = f"""
motion AS (
  SELECT sensor_id, sensor_type, date_trunc('minute', event_ts) AS minute_bucket,
    count(*) AS event_count,
    arg_min(baseline_events_per_min, (received_at, raw_event_id)) AS baseline_events_per_min,
    arg_min(event_ts, (received_at, raw_event_id)) AS event_ts,
    avg(value) AS value
  FROM enriched WHERE sensor_type = 'motion' AND baseline_events_per_min IS NOT NULL
  GROUP BY ALL
), bursts AS (
  SELECT sensor_id, sensor_type, event_ts, value, 'motion_burst' AS anomaly_type,
    CASE WHEN baseline_events_per_min = 0 THEN 'inf'::DOUBLE
         ELSE round(event_count / baseline_events_per_min, 4) END AS score,
    'Events per minute (' || CAST(event_count AS VARCHAR) || ') exceeds '
      || CAST(round(baseline_events_per_min * 3.0, 1) AS VARCHAR) || 'x baseline' AS reason,
    event_count
  FROM motion WHERE event_count > baseline_events_per_min * 3.0
)"""

DOOR_CTE = f"""
doors AS (
  SELECT sensor_id, sensor_type, event_ts, value, 'door_outside_hours' AS anomaly_type,
    1.0::DOUBLE AS score, 'Door opened outside business hours (Mon-Fri 08:00-18:00)' AS reason
  FROM enriched WHERE sensor_type = 'door' AND value = 1.0 AND is_business_hours = false
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def oracle_queries() -> dict[str, str]:
    from sensorflow.plans.flow_oracle import flow_queries
    base = [FEED_CTE, FLAT_CTE]
    cl = base + [CLEAN_CTE]
    en = cl + [ENRICHED_CTE]
    q: dict[str, str] = {}
    q["unprocessed_batch"] = with_ctes(FEED_CTE) + f"""
SELECT id, sensor_id, sensor_type, payload, received_at FROM landing
WHERE NOT processed ORDER BY received_at, id LIMIT 5000"""
    q["flatten_payload"] = with_ctes(*base) + "SELECT * FROM flat"
    q["intake_identity"] = with_ctes(FEED_CTE) + """
, msg AS (
  SELECT 2 * e AS id, k, e, value, make_timestamp((t + 1) * 1000000) AS received_at,
    CASE WHEN k = 87 THEN 'sensors/door/other' ELSE 'sensors/' || sensor_type || '/' || device END AS topic,
    CASE WHEN k = 83 THEN '{"sensor_id":"bad-' || chr(65533) || '","value":"1"}'
         WHEN e % 200 = 11 THEN '{"sensor_id": "' || device || '", broken'
         WHEN e % 200 = 13 THEN '{"value":' || CASE WHEN value IS NULL THEN 'null' ELSE '"' || value || '"' END
                                || ',"timestamp":' || CASE WHEN stamp IS NULL THEN 'null' ELSE '"' || stamp || '"' END || '}'
         WHEN k = 87 THEN chr(10) || chr(9) || """ + _payload("stamp") + """
         WHEN k = 89 THEN '42'
         WHEN k = 91 THEN 'null'
         WHEN k = 93 THEN '{"raw":"x","sensor_id":"r-1","sensor_type":"door","value":"1"}'
         ELSE """ + _payload("stamp") + """ END AS body
  FROM f1
), parsed AS (
  SELECT *, json_valid(body) AS ok,
    CASE WHEN json_valid(body) THEN json_type(CASE WHEN json_valid(body) THEN body END) = 'OBJECT' ELSE false END AS obj,
    string_split(topic, '/') AS parts
  FROM msg WHERE topic = 'sensors' OR starts_with(topic, 'sensors/')
)
SELECT id, topic,
  coalesce(CASE WHEN obj THEN json_extract_string(CASE WHEN obj THEN body END, '$.sensor_id') END,
           CASE WHEN len(parts) >= 3 THEN parts[3] END) AS sensor_id,
  coalesce(CASE WHEN obj THEN json_extract_string(CASE WHEN obj THEN body END, '$.sensor_type') END,
           CASE WHEN len(parts) >= 3 THEN parts[2] END) AS sensor_type,
  CASE WHEN ok THEN NULL ELSE body END AS raw_text,
  CASE WHEN k = 61 AND e % 200 NOT IN (11, 13) THEN value
       WHEN obj THEN json_extract_string(CASE WHEN obj THEN body END, '$.value') END AS payload_value,
  received_at
FROM parsed"""
    q["dedup_keep_first"] = with_ctes(*base) + """
SELECT id, sensor_id, sensor_type, "timestamp", received_at FROM (
  SELECT *, row_number() OVER (PARTITION BY sensor_id, "timestamp" ORDER BY received_at, id) AS rn FROM flat)
WHERE rn = 1"""
    q["dead_letters"] = with_ctes(*cl) + "SELECT raw_event_id, payload, reason FROM dead"
    q["dead_letter_summary"] = with_ctes(*cl) + \
        "SELECT reason, count(*) AS n_rows, count(DISTINCT sensor_id) AS n_sensors FROM classified WHERE reason IS NOT NULL GROUP BY reason"
    q["clean_events"] = with_ctes(*cl) + \
        """SELECT raw_event_id, sensor_id, sensor_type, CASE WHEN isnan(value) THEN NULL ELSE value END AS value,
  isnan(value) AS value_is_nan, unit, event_ts FROM clean"""
    q["time_features"] = with_ctes(*en) + \
        "SELECT raw_event_id, event_ts, hour_of_day, day_of_week, is_business_hours FROM enriched"
    enriched_cols = ("raw_event_id, sensor_id, sensor_type, CASE WHEN isnan(value) THEN NULL ELSE value END AS value, "
                     "isnan(value) AS value_is_nan, unit, event_ts, hour_of_day, day_of_week, "
                     "is_business_hours, location, zone, min_expected, max_expected, baseline_events_per_min")
    q["enrich_readings"] = with_ctes(*en) + f"SELECT {enriched_cols} FROM enriched"
    q["enrich_unmatched"] = with_ctes(*en) + """
SELECT sensor_id, count(*) AS n_rows, count(*) FILTER (WHERE zone IS NULL) AS rows_without_zone
FROM enriched GROUP BY sensor_id"""
    q["enrich_empty_dimension"] = with_ctes(*(cl + [ENRICHED_EMPTY_DIM_CTE])) + f"SELECT {enriched_cols} FROM enriched"
    q["motion_bursts"] = with_ctes(*(en + [MOTION_CTE])) + """
SELECT sensor_id, sensor_type, event_ts, round(value, 6) AS value, anomaly_type, score, reason, event_count FROM bursts"""
    q["motion_zero_baseline"] = with_ctes(*(cl + [_enriched_cte(ZERO_BASELINE), MOTION_CTE])) + """
SELECT sensor_id, event_ts, event_count, isinf(score) AS endless, reason FROM bursts"""
    q["enrich_from_curated"] = with_ctes(*en) + f"SELECT {enriched_cols} FROM enriched"
    q["door_after_hours"] = with_ctes(*(en + [DOOR_CTE])) + "SELECT * FROM doors"
    z = with_ctes(*(en + [ZSCORE_CTE])) + "SELECT * FROM zscores"
    q["temperature_zscore"] = z
    q["temperature_zscore_sweep"] = z
    q["temperature_zscore_offsets"] = z
    q["all_anomalies"] = with_ctes(*(en + [ZSCORE_CTE, MOTION_CTE, DOOR_CTE])) + """
SELECT sensor_id, sensor_type, event_ts, round(value, 6) AS value, anomaly_type, score, reason FROM zscores
UNION ALL SELECT sensor_id, sensor_type, event_ts, round(value, 6), anomaly_type, score, reason FROM bursts
UNION ALL SELECT sensor_id, sensor_type, event_ts, round(value, 6), anomaly_type, score, reason FROM doors"""
    q["readings_sink_rows"] = with_ctes(*en) + """
SELECT raw_event_id, sensor_id, sensor_type, CASE WHEN isnan(value) THEN NULL ELSE value END AS value, unit,
  event_ts, hour_of_day, day_of_week, zone, location, is_business_hours,
  CASE WHEN sensor_id IS NULL THEN 'null sensor_id' WHEN sensor_type IS NULL THEN 'null sensor_type'
       WHEN value IS NULL OR isnan(value) THEN 'null value' WHEN event_ts IS NULL THEN 'null timestamp' END AS reject_reason
FROM enriched"""
    q["mark_processed_remaining"] = with_ctes(FEED_CTE) + f"""
, batch AS (SELECT id FROM landing WHERE NOT processed ORDER BY received_at, id LIMIT 5000)
SELECT l.id, l.received_at FROM landing l
WHERE NOT l.processed AND NOT EXISTS (SELECT 1 FROM batch b WHERE b.id = l.id)"""
    q["seed_if_absent"] = with_ctes(FEED_CTE) + f"""
, seed AS (SELECT * FROM {SEED})
, observed AS (
  SELECT sensor_id, arg_min(sensor_type, (received_at, id)) AS sensor_type
  FROM landing WHERE sensor_id IS NOT NULL GROUP BY sensor_id)
SELECT sensor_id, sensor_type, location, zone, CAST(min_expected AS DOUBLE) AS min_expected,
  CAST(max_expected AS DOUBLE) AS max_expected, CAST(baseline_events_per_min AS DOUBLE) AS baseline_events_per_min
FROM seed
UNION ALL
SELECT o.sensor_id, o.sensor_type, NULL, NULL, NULL, NULL, NULL FROM observed o
WHERE NOT EXISTS (SELECT 1 FROM seed s WHERE s.sensor_id = o.sensor_id)"""
    q["clean_by_ids"] = with_ctes(*cl) + """
SELECT raw_event_id, sensor_id, sensor_type, CASE WHEN isnan(value) THEN NULL ELSE value END AS value,
  isnan(value) AS value_is_nan, unit, event_ts FROM clean
WHERE raw_event_id IN (SELECT id FROM landing WHERE NOT processed)"""
    q["dead_letter_sink"] = with_ctes(*cl) + \
        "SELECT raw_event_id, CAST(json_object('raw', payload) AS VARCHAR) AS payload, reason FROM dead"
    q["motion_minute_counts"] = with_ctes(*(en + [MOTION_CTE])) + """
SELECT sensor_id, sensor_type, minute_bucket, event_count, baseline_events_per_min, event_ts,
  round(value, 6) AS value FROM motion"""
    q["dimension_after_registration"] = with_ctes(FEED_CTE) + f"""
, seed AS (SELECT * FROM {SEED})
, observed AS (SELECT DISTINCT sensor_id FROM landing WHERE sensor_id IS NOT NULL)
, dim AS (
  SELECT sensor_id FROM seed
  UNION ALL SELECT o.sensor_id FROM observed o WHERE NOT EXISTS (SELECT 1 FROM seed s WHERE s.sensor_id = o.sensor_id))
SELECT sensor_id, count(*) AS n_rows, count(*) > 1 AS duplicate_key FROM dim GROUP BY sensor_id"""
    q["streaming_readings"] = with_ctes(*en) + """
SELECT raw_event_id, sensor_id, sensor_type, value, unit, event_ts, hour_of_day, day_of_week, zone, location,
  is_business_hours, CAST(0 AS BIGINT) AS batch_id
FROM enriched
WHERE sensor_id IS NOT NULL AND sensor_type IS NOT NULL AND value IS NOT NULL AND NOT isnan(value)
  AND event_ts IS NOT NULL"""
    q["enrich_hot_sensors"] = q["enrich_readings"]
    return q | flow_queries()
