"""Column layout of every dataset that crosses an operator boundary."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw messages as a broker source delivers them.
RAW_MESSAGE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

EVENT = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("heart_rate", T.IntegerType()),
])

STORED_EVENT = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("ingest_time", T.TimestampType()),
    T.StructField("heart_rate", T.ShortType()),
    T.StructField("quality_flag", T.StringType()),
    T.StructField("source_topic", T.StringType()),
    T.StructField("source_partition", T.IntegerType()),
    T.StructField("source_offset", T.LongType()),
    T.StructField("payload", T.StringType()),
    T.StructField("event_date", T.DateType()),
    T.StructField("run", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])

ANOMALY = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("heart_rate", T.ShortType()),
    T.StructField("anomaly_type", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("details", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("event_date", T.DateType()),
    T.StructField("run", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])

DETAILS = T.StructType([
    T.StructField("delta", T.IntegerType()),
    T.StructField("threshold", T.IntegerType()),
    T.StructField("previous", T.IntegerType()),
    T.StructField("measured", T.IntegerType()),
])

ENVELOPE = T.StructType([
    T.StructField("error", T.StringType(), False),
    T.StructField("raw", T.StringType(), False),
    T.StructField("error_type", T.StringType(), False),
])

CHECKPOINT = T.StructType([
    T.StructField("consumer_group", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("last_offset", T.LongType()),
    T.StructField("updated_at", T.TimestampType()),
])

# Last reading seen per customer, carried between micro-batches.
LAST_READING = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("heart_rate", T.IntegerType()),
])

ARRIVAL = ("topic", "partition", "offset")
EVENT_KEY = ("customer_id", "event_id")
