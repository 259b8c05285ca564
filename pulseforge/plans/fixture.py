"""Sensor messages projected from the generic ``events`` table.

The test data has no sensor readings, so each ``events`` row is turned into
one: user -> customer, value -> rate, row number -> offset. ``raw_messages``
also writes ten kinds of faulty message, chosen by ``event_id``, so that every
validation branch is met on every run over the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseforge.config import TOPIC_RAW
from pulseforge.functions import text

PARTITIONS = 24
EVENTS_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def spread(events: DataFrame) -> DataFrame:
    """Deal the rows of a small table to all cores. One small file is a single
    scan task; a table with at least one task per core is left as it is."""
    cores = events.sparkSession.sparkContext.defaultParallelism
    return events.repartition(cores) if events.rdd.getNumPartitions() < cores else events


def readings(events: DataFrame, later: str = "0") -> DataFrame:
    """Clean readings with their source position, which ``later`` moves on."""
    return events.selectExpr(
        "'00000000-0000-4000-8000-' || lpad(CAST(event_id AS STRING), 12, '0') AS event_id",
        "'cust_' || lpad(CAST(user_id AS STRING), greatest(5, length(CAST(user_id AS STRING))), '0') AS customer_id",
        "CAST(ts AS TIMESTAMP) AS event_time",
        "CAST(40 + floor(value * 7 / 10) AS INT) AS heart_rate",
        f"'{TOPIC_RAW}' AS topic",
        f"CAST(user_id % {PARTITIONS} AS INT) AS partition",
        f"event_id + {later} AS `offset`",
    )


def raw_messages(events: DataFrame, later: str = "0") -> DataFrame:
    """JSON messages with faults, in the raw source layout."""
    faulty = readings(events, later).select("*", text.iso_zulu(F.col("event_time")).alias("iso")).selectExpr(
        "*", "`offset` % 100 AS fault", "CAST(heart_rate AS STRING) AS rate"
    )
    value = r"""concat(
        '{"event_id": "', CASE WHEN fault = 6 THEN 'not-a-uuid' ELSE event_id END,
        '", "customer_id": "',
        CASE fault WHEN 1 THEN '   ' WHEN 4 THEN ' ' || customer_id || r'\t '
                   WHEN 5 THEN customer_id || repeat('x', 64) ELSE customer_id END,
        '", "timestamp": "', CASE WHEN fault = 7 THEN 'yesterday' ELSE iso END, '"',
        CASE WHEN fault = 8 THEN '' ELSE ', "heart_rate": ' ||
            CASE fault WHEN 2 THEN 'null' WHEN 3 THEN '"' || rate || '"' WHEN 9 THEN rate || '.5' ELSE rate END END,
        CASE WHEN fault = 0 THEN '' ELSE '}' END) AS value"""
    return faulty.selectExpr("customer_id AS key", value, "topic", "partition", "`offset`", "event_time AS timestamp")


# Forms that a message's members may have, by ``event_id % 24``; {id}, {iso} and the
# like stand for the row's values. A member that is None is left out.
_ISO = "date_format(event_time, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"
_IDS = {
    1: """upper('"abcdef00' || substring(event_id, 9) || '"')""", 2: """'"{' || event_id || '}"'""", 3: """'"urn:uuid:' || event_id || '"'""",
    4: """'"' || replace(event_id, '-', '') || '"'""", 5: None, 6: "'null'",
}
_CUSTOMERS = {18: r"""'"' || customer_id || r'\u0000"'""", 21: r"""'"\u00a0 ' || customer_id || r' \u3000"'"""}
_TIMES = {
    7: None, 8: """'"' || date_format(event_time + INTERVAL 2 HOURS, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") || '+02:00"'""", 9: "CAST(unix_seconds(event_time) AS STRING)",
    10: "CAST(unix_millis(event_time) AS STRING)", 11: """'"' || date_format(event_time, 'yyyy-MM-dd HH:mm') || '"'""",
    12: """'"' || date_format(event_time, 'yyyy-MM-dd') || '"'""", 22: """'"yesterday"'""",
}
_RATES = {13: """'" ' || heart_rate || '.0 "'""", 14: "'true'", 15: "heart_rate || '.0'", 22: None}


def _member(name: str, usual: str, forms: dict[int, str | None]) -> str:
    cases = " ".join(f"WHEN {n} THEN " + (f"""'"{name}": ' || {value}""" if value else "NULL") for n, value in forms.items())
    return f"""CASE form {cases} ELSE '"{name}": ' || {usual} END"""


def message_forms(events: DataFrame) -> DataFrame:
    """Binary messages in all forms that members may have, in the raw layout."""
    rows = readings(events).selectExpr("*", "`offset` % 24 AS form")
    members = (
        _member("event_id", """'"' || event_id || '"'""", _IDS), _member("customer_id", """'"' || customer_id || '"'""", _CUSTOMERS),
        _member("timestamp", f"""'"' || {_ISO} || 'Z"'""", _TIMES), _member("heart_rate", "heart_rate", _RATES),
    )
    document = f"""'{{' || CASE WHEN form = 23 THEN '"heart_rate": 1, ' ELSE '' END || concat_ws(', ', {', '.join(members)}) || '}}'"""
    value = f"""CASE form WHEN 16 THEN concat(CAST({document} AS BINARY), X'FF') WHEN 17 THEN NULL WHEN 19 THEN CAST({document} || ' x' AS BINARY)
        WHEN 20 THEN CAST('[' || {document} || ']' AS BINARY) ELSE CAST({document} AS BINARY) END AS value"""
    return rows.selectExpr("customer_id AS key", value, "topic", "partition", "`offset`", "event_time AS timestamp")
