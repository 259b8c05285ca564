"""Writes: idempotent events, anomalies, checkpoints, topics, previews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseforge.config import DEFAULTS, Settings
from pulseforge.functions import text
from pulseforge.operators import anomalies as anomaly_ops
from pulseforge.operators import dedup, metrics, route
from pulseforge.schema import CHECKPOINT
from pulseforge.sources import keyed, topics
from pulseforge.sources.batch import Batch
from pulseforge.sources.tables import Tables, write_batch


def insert_events(
    spark: SparkSession, valid: DataFrame, tables: Tables, batch: Batch, **options: bool
) -> None:
    """First-wins insert of stored-layout events. Rows of the same batch do not
    count as existing: they are what this write replaces."""
    tables.history.keep_up(spark)
    fresh = dedup.first_arrivals(valid)
    for existing in tables.history.read(spark, without=batch):
        fresh = dedup.absent_from(fresh, existing, **options)
    write_events(fresh, tables, batch)


def write_events(fresh: DataFrame, tables: Tables, batch: Batch) -> None:
    write_batch(fresh.withColumn("ingest_time", F.current_timestamp()), tables.events, batch)


def append_anomalies(found: DataFrame, tables: Tables, batch: Batch) -> None:
    """Plain append: a reading delivered twice gives two rows."""
    write_batch(found.withColumn("created_at", F.current_timestamp()), tables.anomalies, batch)


def upsert_checkpoint(spark: SparkSession, marks: DataFrame, tables: Tables, batch: Batch | None = None) -> None:
    """Insert or overwrite ``last_offset``. Unconditional: replaying older
    messages moves the mark back."""
    keyed.upsert(
        spark,
        tables.checkpoint,
        CHECKPOINT,
        marks.withColumn("updated_at", F.current_timestamp()),
        ("consumer_group", "topic", "partition"),
        batch or Batch.new(),
    )


def publish_files(messages: DataFrame, tables: Tables, topic: str, batch: Batch, settings: Settings = DEFAULTS) -> None:
    """One batch of a topic, with the partitions and offsets that a broker gives."""
    topics.publish(messages, tables.topic(topic), topic, batch, settings.topic_partitions)


def kafka_sink_options(topic: str, settings: Settings = DEFAULTS) -> dict[str, str]:
    """Writer options for a topic; the broker client hashes ``key`` to pick the
    partition, which keeps each customer's messages in order."""
    return {"kafka.bootstrap.servers": settings.bootstrap_servers, "topic": topic, "kafka.acks": "all"}


def publish_kafka(messages: DataFrame, topic: str, settings: Settings = DEFAULTS) -> None:
    messages.write.format("kafka").options(**kafka_sink_options(topic, settings)).save()


def publish_rejects(routed: DataFrame, error_type: str, tables: Tables, batch: Batch, settings: Settings = DEFAULTS) -> None:
    topic = {route.VALIDATION: settings.topic_invalid, route.PROCESSING: settings.topic_dlq}[error_type]
    publish_files(route.as_envelope_json(route.quarantine(routed, error_type)), tables, topic, batch, settings)


def publish_quarantine(routed: DataFrame, tables: Tables, batch: Batch, settings: Settings = DEFAULTS) -> None:
    for error_type in (route.VALIDATION, route.PROCESSING):
        publish_rejects(routed, error_type, tables, batch, settings)


def publish_anomalies(found: DataFrame, tables: Tables, batch: Batch, settings: Settings = DEFAULTS) -> None:
    publish_files(anomaly_ops.as_messages(found), tables, settings.topic_anomaly, batch, settings)


def event_messages(events: DataFrame) -> DataFrame:
    """Events as keyed JSON messages for the raw topic."""
    return events.select(
        F.col("customer_id").alias("key"),
        text.event_json(
            F.col("event_id"), F.col("customer_id"), text.iso_zulu(F.col("event_time")), F.col("heart_rate")
        ).alias("value"),
    )


def preview_json(events: DataFrame, n: int = 100, order: tuple[str, ...] = ("event_time", "event_id")) -> DataFrame:
    """The first ``n`` events as JSON lines: a top-k, not a full sort."""
    return event_messages(events.orderBy(*order).limit(n)).select("value")


def high_water_marks(routed: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return metrics.high_water_marks(routed.where(F.col("route") == route.VALID), settings.group_writer)
