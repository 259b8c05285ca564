"""The named queries as plain SQL over the same tables, for checking."""

from __future__ import annotations

ISO = """strftime(event_time, '%Y-%m-%dT%H:%M:%S')
         || CASE WHEN microsecond(event_time) % 1000000 = 0 THEN '' ELSE strftime(event_time, '.%f') END"""

BASE = f"""
WITH src AS (
  SELECT event_id AS off, event_id % 100 AS f, ts AS event_time,
         CAST(user_id % 24 AS INTEGER) AS part,
         printf('00000000-0000-4000-8000-%012d', event_id) AS uid,
         printf('cust_%05d', user_id) AS base_customer,
         CAST(40 + floor(value * 7 / 10) AS INTEGER) AS rate
  FROM events
),
msg AS (
  SELECT *, {ISO} AS iso,
    CASE WHEN f = 1 THEN '' WHEN f = 5 THEN base_customer || repeat('x', 64) ELSE base_customer END AS customer,
    CASE WHEN f = 0 THEN 'json' ELSE nullif(concat_ws(',',
      CASE WHEN f = 6 THEN 'event_id' END,
      CASE WHEN f = 1 THEN 'customer_id_blank' END,
      CASE WHEN f = 7 THEN 'timestamp' END,
      CASE WHEN f = 8 THEN 'heart_rate_missing' WHEN f IN (2, 9) THEN 'heart_rate_type'
           WHEN rate NOT BETWEEN 0 AND 250 THEN 'heart_rate_hard_bounds' END), '') END AS schema_reasons
  FROM src
),
raw AS (
  SELECT *,
    '{{"event_id": "' || CASE WHEN f = 6 THEN 'not-a-uuid' ELSE uid END
    || '", "customer_id": "'
    || CASE WHEN f = 1 THEN '   ' WHEN f = 4 THEN ' ' || base_customer || '\\t '
            WHEN f = 5 THEN base_customer || repeat('x', 64) ELSE base_customer END
    || '", "timestamp": "' || CASE WHEN f = 7 THEN 'yesterday' ELSE iso || 'Z' END || '"'
    || CASE WHEN f = 8 THEN '' ELSE ', "heart_rate": '
       || CASE WHEN f = 2 THEN 'null' WHEN f = 3 THEN '"' || rate || '"' WHEN f = 9 THEN rate || '.5'
               ELSE CAST(rate AS VARCHAR) END END
    || CASE WHEN f = 0 THEN '' ELSE '}}' END AS raw
  FROM msg
),
routed AS (
  SELECT *,
    CASE WHEN schema_reasons IS NOT NULL OR rate NOT BETWEEN 45 AND 185 THEN 'VALIDATION'
         WHEN f = 5 THEN 'PROCESSING' ELSE 'VALID' END AS route,
    CASE WHEN schema_reasons IS NOT NULL THEN schema_reasons
         WHEN rate NOT BETWEEN 45 AND 185 THEN 'heart_rate_soft_bounds'
         WHEN f = 5 THEN 'customer_id_length' END AS reasons
  FROM raw
),
valid AS (SELECT * FROM routed WHERE route = 'VALID'),
ok AS (SELECT * FROM routed WHERE schema_reasons IS NULL),
chained AS (
  SELECT *, lag(rate) OVER (PARTITION BY customer ORDER BY part, off) AS previous FROM ok
),
found AS (
  SELECT *,
    CASE WHEN rate <= 50 THEN 'LOW_HEART_RATE' WHEN rate >= 140 THEN 'HIGH_HEART_RATE'
         WHEN abs(rate - previous) >= 30 THEN 'SPIKE' END AS anomaly_type
  FROM chained WHERE f <> 5
),
anomaly AS (
  SELECT *, CASE WHEN anomaly_type = 'SPIKE' THEN 'medium' ELSE 'high' END AS severity,
    CASE WHEN anomaly_type = 'SPIKE' THEN abs(rate - previous) END AS delta,
    CASE anomaly_type WHEN 'LOW_HEART_RATE' THEN 50 WHEN 'HIGH_HEART_RATE' THEN 140 ELSE 30 END AS threshold,
    CASE WHEN anomaly_type = 'SPIKE' THEN previous END AS shown_previous
  FROM found WHERE anomaly_type IS NOT NULL
)
"""

AS_OF = "(SELECT max(ts) FROM events)"
EVENT_JSON = (
    """'{"event_id":"' || uid || '","customer_id":"' || customer || '","timestamp":"' || iso || '%s","heart_rate":'"""
    """ || rate || '}'"""
)
EVENT_COLUMNS = f"""uid AS event_id, customer AS customer_id, event_time, rate AS heart_rate,
  'valid' AS quality_flag, 'events.raw.v1' AS source_topic, part AS source_partition, off AS source_offset,
  {EVENT_JSON % '+00:00'} AS payload, CAST(event_time AS DATE) AS event_date"""
ANOMALY_COLUMNS = "uid AS event_id, customer AS customer_id, event_time, rate AS heart_rate, anomaly_type, severity"
ERROR = """CASE
  WHEN schema_reasons = 'json' THEN 'message is not one JSON document'
  WHEN schema_reasons IS NOT NULL THEN concat_ws('; ',
    CASE WHEN f = 6 THEN 'event_id is not a valid UUID' END,
    CASE WHEN f = 1 THEN 'customer_id cannot be empty or whitespace' END,
    CASE WHEN f = 7 THEN 'timestamp is not a valid date and time' END,
    CASE WHEN f = 8 THEN 'heart_rate is missing' WHEN f IN (2, 9) THEN 'heart_rate is not a whole number'
         WHEN rate NOT BETWEEN 0 AND 250
         THEN 'heart_rate ' || rate || ' is outside hard physiological bounds [0, 250]' END)
  WHEN rate NOT BETWEEN 45 AND 185
  THEN 'heart_rate ' || rate || ' is outside the configured domain bounds [45, 185]'
  ELSE 'value too long for type character varying(64)' END"""
MARKS = """SELECT 'cg.db-writer.v1' AS consumer_group, 'events.raw.v1' AS topic, part AS "partition",
  max(off) AS last_offset FROM valid"""
EARLIER = "event_time < TIMESTAMP '2024-01-16'"
MEAN = "CAST(round(CAST(sum(rate) AS DECIMAL(18,0)) / nullif(count(*), 0), 1) AS DOUBLE)"
# percentile_cont as the dashboards' database computes it, low + share * (high - low).
# DuckDB's own quantile_cont interpolates with other arithmetic and can differ in the last bit.
_SORTED = "list_sort(list(CAST(rate AS DOUBLE)))"
_POSITION = "(CAST(0.95 AS DOUBLE) * (count(*) - 1))"
_LOW = f"{_SORTED}[CAST(floor({_POSITION}) AS BIGINT) + 1]"
_HIGH = f"{_SORTED}[CAST(ceil({_POSITION}) AS BIGINT) + 1]"
P95 = f"({_LOW} + ({_POSITION} - floor({_POSITION})) * ({_HIGH} - {_LOW}))"
MINUTE = "date_trunc('minute', event_time)"
INTERVAL5 = "time_bucket(INTERVAL 5 SECOND, event_time)"


def _trailing(select: str, source: str, width: str, tail: str = "") -> str:
    return f"{BASE} SELECT {select} FROM {source} WHERE event_time > {AS_OF} - INTERVAL {width} {tail}"


def _band(value: str, base: str, bands: tuple[tuple[int, str], ...]) -> str:
    cases = " ".join(f"WHEN {value} >= {limit} THEN '{name}'" for limit, name in sorted(bands, reverse=True))
    return f"CASE {cases} ELSE '{base}' END"


def _breakdown(width: str) -> str:
    return _trailing('anomaly_type, count(*) AS "count"', "anomaly", width, "GROUP BY anomaly_type")


def _per_minute(source: str, condition: str = "TRUE") -> str:
    return (
        f"{BASE} SELECT {MINUTE} AS time, CAST(count(*) AS DOUBLE) AS value FROM {source}"
        f" WHERE {condition} GROUP BY 1"
    )


def _throughput(condition: str = "TRUE") -> str:
    return (
        f"{BASE} SELECT {INTERVAL5} AS interval_start, count(*) AS readings,"
        " round(count(*) / 5.0, 1)::DOUBLE AS per_second, count(*) / 5.0 < 500 AS below_minimum"
        f" FROM valid WHERE {condition} GROUP BY 1"
    )


# Forms of messages by off % 24; those not named here are plain.
FORMS = f"""{BASE}, formed AS (
    SELECT *, off % 24 AS form, sha256('events.raw.v1|' || part || '|' || off) AS digest FROM src
), told AS (
    SELECT *, CASE form WHEN 14 THEN 1 ELSE rate END AS read_rate, CASE form
        WHEN 16 THEN 'encoding' WHEN 17 THEN 'encoding' WHEN 19 THEN 'json' WHEN 20 THEN 'not_object' WHEN 6 THEN 'event_id'
        WHEN 22 THEN 'timestamp,heart_rate_missing' END AS wrong FROM formed
), judged AS (
    SELECT *, CASE WHEN wrong = 'event_id' AND read_rate NOT BETWEEN 0 AND 250 THEN 'event_id,heart_rate_hard_bounds'
        WHEN wrong IS NULL AND read_rate NOT BETWEEN 0 AND 250 THEN 'heart_rate_hard_bounds' ELSE wrong END AS reasons FROM told
)
SELECT off AS "offset", reasons, CASE WHEN reasons IS NULL THEN CASE form
        WHEN 1 THEN 'abcdef00' || substr(uid, 9)
        WHEN 5 THEN substr(digest, 1, 8) || '-' || substr(digest, 9, 4) || '-4' || substr(digest, 14, 3) || '-8' || substr(digest, 18, 3) || '-' || substr(digest, 21, 12)
        ELSE uid END END AS event_id,
    CASE WHEN reasons IS NULL THEN (length(base_customer) + CASE form WHEN 18 THEN 1 ELSE 0 END)::INT END AS customer_chars,
    CASE WHEN reasons IS NULL THEN CASE form WHEN 9 THEN date_trunc('second', event_time) WHEN 10 THEN date_trunc('millisecond', event_time)
        WHEN 11 THEN date_trunc('minute', event_time) WHEN 12 THEN date_trunc('day', event_time) ELSE event_time END::TIMESTAMP END AS event_time,
    CASE WHEN reasons IS NULL THEN read_rate END AS heart_rate
FROM judged"""

VALID_EVENTS = f"{BASE} SELECT {EVENT_COLUMNS} FROM valid"
ANOMALIES = f"{BASE} SELECT {ANOMALY_COLUMNS} FROM anomaly"

ORACLE: dict[str, str] = {
    "route_counts": f"""{BASE} SELECT count(*) AS consumed, count(*) FILTER (route = 'VALID') AS inserted,
        count(*) FILTER (route = 'VALIDATION') AS invalid, count(*) FILTER (route = 'PROCESSING') AS dlq FROM routed""",
    "valid_events": VALID_EVENTS,
    "quarantine_reasons": f"""{BASE} SELECT route AS error_type, reasons, count(*) AS messages
        FROM routed WHERE route <> 'VALID' GROUP BY ALL""",
    "quarantine_envelopes": f"""{BASE} SELECT {ERROR} AS error, raw, route AS error_type
        FROM routed WHERE route = 'VALIDATION'""",
    "dead_letter_envelopes": f"""{BASE} SELECT {ERROR} AS error, raw, route AS error_type
        FROM routed WHERE route = 'PROCESSING'""",
    "dedup_first_wins": f"""{BASE}, delivered AS (
        SELECT customer AS customer_id, uid AS event_id, part AS source_partition, off AS source_offset,
               rate AS heart_rate FROM valid
        UNION ALL SELECT customer, uid, part, off + 1000000000, 99 FROM valid)
        SELECT * FROM delivered
        QUALIFY row_number() OVER (PARTITION BY customer_id, event_id ORDER BY source_partition, source_offset) = 1""",
    "insert_if_absent": f"""{BASE} SELECT customer AS customer_id, uid AS event_id, off AS source_offset FROM valid a
        WHERE NOT EXISTS (SELECT 1 FROM valid b WHERE b.{EARLIER} AND b.customer = a.customer AND b.uid = a.uid)""",
    "checkpoint_offsets": f"{BASE} {MARKS} GROUP BY part",
    "checkpoint_upsert": f"""{BASE}, early AS ({MARKS} WHERE {EARLIER} GROUP BY part),
        late AS ({MARKS} WHERE NOT ({EARLIER}) GROUP BY part)
        SELECT * FROM early UNION ALL
        SELECT * FROM late WHERE "partition" NOT IN (SELECT "partition" FROM early)""",
    "replay_after_checkpoint": f"""{BASE}, early AS ({MARKS} WHERE {EARLIER} GROUP BY part)
        SELECT 'events.raw.v1' AS topic, part AS "partition", off AS "offset", raw AS value
        FROM routed LEFT JOIN early ON early."partition" = part WHERE off > coalesce(last_offset, -1)""",
    "previous_rate": f"""{BASE} SELECT uid AS event_id, customer AS customer_id, rate AS heart_rate,
        previous AS previous_rate FROM chained""",
    "rolling_history": f"""{BASE} SELECT uid AS event_id, customer AS customer_id, rate AS heart_rate,
        coalesce(array_to_string(list(rate) OVER (PARTITION BY customer ORDER BY part, off
          ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING), ','), '') AS recent_rates FROM ok""",
    "rolling_history_chunk_7": f"""{BASE} SELECT uid AS event_id, customer AS customer_id, rate AS heart_rate,
        coalesce(array_to_string(list(rate) OVER (PARTITION BY customer ORDER BY part, off
          ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING), ','), '') AS recent_rates FROM ok""",
    "previous_rate_chunk_7": f"""{BASE} SELECT uid AS event_id, customer AS customer_id, rate AS heart_rate,
        previous AS previous_rate FROM chained""",
    "anomalies": ANOMALIES,
    "anomalies_redelivered": ANOMALIES.replace("FROM ok\n", "FROM (SELECT * FROM ok UNION ALL SELECT * REPLACE (off + 1000000000 AS off) FROM ok)\n"),
    "decode_forms": FORMS,
    "anomaly_details": f"""{BASE} SELECT uid AS event_id, delta, threshold, shown_previous AS previous,
        rate AS measured FROM anomaly""",
    "anomaly_type_breakdown": _breakdown("1 HOUR"),
    "anomaly_type_breakdown_30d": _breakdown("30 DAY"),
    "anomaly_type_severity": f'{BASE} SELECT anomaly_type, severity, count(*) AS "count" FROM anomaly GROUP BY ALL',
    "events_per_minute": _per_minute("valid"),
    "events_per_minute_default_range": _per_minute(
        "valid", f"event_time BETWEEN {AS_OF} - INTERVAL 1 HOUR AND {AS_OF}"
    ),
    "anomalies_per_minute": _per_minute("anomaly"),
    "avg_rate": _trailing(f"{MEAN} AS value", "valid", "5 MINUTE"),
    "avg_rate_1d": _trailing(f"{MEAN} AS value", "valid", "1 DAY"),
    "avg_rate_30d": _trailing(f"{MEAN} AS value", "valid", "30 DAY"),
    "p95_rate": _trailing(f"{P95} AS value", "valid", "5 MINUTE"),
    "p95_rate_1d": _trailing(f"{P95} AS value", "valid", "1 DAY"),
    "p95_rate_30d": _trailing(f"{P95} AS value", "valid", "30 DAY"),
    "active_customers": _trailing("CAST(count(DISTINCT customer) AS DOUBLE) AS value", "valid", "10 MINUTE"),
    "active_customers_1d": _trailing("CAST(count(DISTINCT customer) AS DOUBLE) AS value", "valid", "1 DAY"),
    "active_customers_30d": _trailing("CAST(count(DISTINCT customer) AS DOUBLE) AS value", "valid", "30 DAY"),
    "stat_bands": f"""{BASE}, stats AS (
        SELECT customer AS customer_id, {MEAN} AS average, {P95} AS p95 FROM valid GROUP BY customer)
        SELECT customer_id, average,
          {_band('average', 'blue', ((60, 'green'), (120, 'orange'), (140, 'red')))} AS average_band,
          p95, {_band('p95', 'green', ((130, 'yellow'), (160, 'red')))} AS p95_band FROM stats""",
    "recent_anomalies": f"""{BASE} SELECT event_time, customer AS customer_id, rate AS heart_rate, anomaly_type, severity
        FROM anomaly ORDER BY event_time DESC, uid LIMIT 20""",
    "last_n_readings": f"""{BASE} SELECT customer AS customer_id,
        CAST(row_number() OVER (PARTITION BY customer ORDER BY event_time DESC, uid) AS INTEGER) AS position,
        uid AS event_id, event_time FROM valid QUALIFY position <= 5""",
    "customer_last_readings": f"""{BASE} SELECT customer AS customer_id, uid AS event_id, event_time FROM valid
        WHERE customer = 'cust_00001' ORDER BY event_time DESC, uid LIMIT 10""",
    "customer_anomalies": f"{BASE} SELECT {ANOMALY_COLUMNS} FROM anomaly WHERE customer = 'cust_00001'",
    "recent_events": _trailing("uid AS event_id, customer AS customer_id, event_time", "valid", "1 HOUR"),
    "recent_events_30d": _trailing("uid AS event_id, customer AS customer_id, event_time", "valid", "30 DAY"),
    "quality_audit": f"{BASE} SELECT uid AS event_id, event_time, 'repaired' AS quality_flag FROM valid WHERE f = 3",
    "trace_to_source": f"""{BASE} SELECT uid AS event_id, 'events.raw.v1' AS source_topic, part AS source_partition,
        off AS source_offset, raw FROM valid""",
    "ingest_latency": f"""{BASE}, delays AS (SELECT 1000000 + off * 48271 % 8999993 AS micros FROM valid)
        SELECT count(*) AS events, round(CAST(sum(micros) AS DECIMAL(18,0)) / count(*), 0)::DOUBLE / 1000000 AS avg_seconds,
        quantile_disc(micros, 0.95) / 1000000::DOUBLE AS p95_seconds, max(micros) / 1000000::DOUBLE AS max_seconds FROM delays""",
    "throughput_intervals": _throughput(),
    "publish_events": f"{BASE} SELECT customer AS key, {EVENT_JSON % 'Z'} AS value FROM valid",
    "publish_anomalies": f"""{BASE} SELECT customer AS key,
        '{{"event_id":"' || uid || '","customer_id":"' || customer || '","timestamp":"' || iso || 'Z","heart_rate":' || rate
        || ',"anomaly_type":"' || anomaly_type || '","severity":"' || severity || '","details":{{'
        || CASE WHEN anomaly_type = 'SPIKE'
           THEN '"delta":' || delta || ',"threshold":' || threshold || ',"previous":' || previous
           ELSE '"threshold":' || threshold END || ',"measured":' || rate || '}}}}' AS value FROM anomaly""",
    "publish_then_replay": f"{BASE} SELECT customer AS key, {EVENT_JSON % 'Z'} AS value FROM valid WHERE NOT ({EARLIER})",
    "preview_json": f"{BASE} SELECT {EVENT_JSON % 'Z'} AS value FROM valid ORDER BY event_time, uid LIMIT 100",
    "stream_anomalies": ANOMALIES,
    "stream_valid_events": VALID_EVENTS,
    "stream_valid_events_stateful": VALID_EVENTS,
    "ingest_twice": VALID_EVENTS,
    "backfill_then_stream": VALID_EVENTS,
    "detector_new_progress": ANOMALIES,
    "stream_valid_events_redelivered": VALID_EVENTS,
    "consumers_share_feed": f"""{BASE} SELECT 'event' AS kind, uid AS event_id, rate AS heart_rate FROM valid
        UNION ALL SELECT anomaly_type, uid, rate FROM anomaly""",
    "stream_events_per_minute": _per_minute("valid"),
    "stream_events_per_minute_late": _per_minute("valid"),
    "stream_active_customers": f"""{BASE} SELECT date_trunc('minute', event_time) + (i + 1) * INTERVAL 1 MINUTE AS time,
        CAST(count(DISTINCT customer) AS DOUBLE) AS value FROM valid, range(10) AS t(i) GROUP BY 1""",
    "stream_anomalies_per_minute": _per_minute("anomaly"),
    "stream_throughput_intervals": _throughput(),
}
