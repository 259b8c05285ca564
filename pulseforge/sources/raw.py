"""Raw message sources: a broker topic, or files with the same columns.

The broker binding needs Spark's Kafka connector on the class path. It only
builds options and column casts, so everything behind it is the same for both.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseforge.config import DEFAULTS, Settings
from pulseforge.schema import RAW_MESSAGE

COLUMNS = tuple(RAW_MESSAGE.names)
#: Fixed value: the broker's number for a partition's first message.
EARLIEST = -2


def kafka_options(
    settings: Settings = DEFAULTS,
    group: str | None = None,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Reader options: one topic, earliest start. Offsets are committed to the
    query checkpoint after each batch, never by the client."""
    options = {
        "kafka.bootstrap.servers": settings.bootstrap_servers,
        "subscribe": settings.topic_raw,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "true",
    }
    if group:
        options["groupIdPrefix"] = group
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def from_kafka(rows: DataFrame) -> DataFrame:
    """Broker columns in the raw layout. ``value`` stays binary so that the
    decoder can tell invalid UTF-8."""
    return rows.select(F.col("key").cast("string").alias("key"), "value", "topic", "partition", "offset", "timestamp")


def stream_kafka(spark: SparkSession, settings: Settings = DEFAULTS, **options) -> DataFrame:
    return from_kafka(spark.readStream.format("kafka").options(**kafka_options(settings, **options)).load())


def read_kafka(spark: SparkSession, settings: Settings = DEFAULTS, **options) -> DataFrame:
    return from_kafka(spark.read.format("kafka").options(**kafka_options(settings, **options)).load())


def stream_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(RAW_MESSAGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_MESSAGE).parquet(path)


def starting_offsets(checkpoint: DataFrame, group: str, partitions: Mapping[str, Iterable[int]] | None = None) -> str:
    """``startingOffsets`` text that resumes after a group's stored offsets. The
    broker wants every partition named: those of ``partitions`` (by topic) without a
    mark start at their earliest message. The marks, one short row for each source
    partition, go to the driver; ``earliest`` if there are none and no partitions."""
    marks = checkpoint.where(F.col("consumer_group") == group).select("topic", "partition", "last_offset").collect()
    offsets: dict[str, dict[int, int]] = {topic: dict.fromkeys(sorted(some), EARLIEST) for topic, some in (partitions or {}).items()}
    for topic, partition, last in marks:
        offsets.setdefault(topic, {})[partition] = last + 1
    if not offsets:
        return "earliest"
    return json.dumps({t: {str(p): o for p, o in sorted(by.items())} for t, by in sorted(offsets.items())}, separators=(",", ":"))
