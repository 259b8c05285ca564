"""Assign each message to VALID, VALIDATION or PROCESSING."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseforge.config import CUSTOMER_ID_MAX, DEFAULTS, Settings
from pulseforge.functions import text
from pulseforge.functions.times import utc_date

VALID = "VALID"
VALIDATION = "VALIDATION"
PROCESSING = "PROCESSING"


def route_messages(decoded: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Add ``route`` and complete ``reasons`` / ``error``. The first failing
    stage decides: decode and schema, then domain bounds, then what the
    destination table can hold."""
    rate = F.col("heart_rate")
    outside = ~rate.between(settings.heart_rate_min, settings.heart_rate_max)
    schema_error = F.col("reasons").isNotNull()
    too_long = F.char_length("customer_id") > CUSTOMER_ID_MAX
    has_nul = F.contains("customer_id", F.lit("\0"))

    def pick(on_schema: Column | str, on_bounds: Column, on_nul: Column, on_length: Column) -> Column:
        return (
            F.when(schema_error, on_schema).when(outside, on_bounds).when(has_nul, on_nul).when(too_long, on_length)
        )

    return decoded.select(
        "topic", "partition", "offset", "raw", "event_id", "customer_id", "event_time", "heart_rate",
        F.coalesce(
            pick(F.lit(VALIDATION), F.lit(VALIDATION), F.lit(PROCESSING), F.lit(PROCESSING)), F.lit(VALID)
        ).alias("route"),
        pick(
            F.col("reasons"), F.lit("heart_rate_soft_bounds"), F.lit("customer_id_nul"), F.lit("customer_id_length")
        ).alias("reasons"),
        pick(
            F.col("error"),
            text.rate_error(text.SOFT_BOUNDS, rate, settings.heart_rate_min, settings.heart_rate_max),
            F.lit(text.NUL_CHARACTER),
            F.lit(text.TOO_LONG % CUSTOMER_ID_MAX),
        ).alias("error"),
    )


def storable(customer_id: Column) -> Column:
    """True where the id fits the destination's customer column."""
    return (F.char_length(customer_id) <= CUSTOMER_ID_MAX) & ~F.contains(customer_id, F.lit("\0"))


def valid_events(routed: DataFrame) -> DataFrame:
    """VALID rows in the stored layout, without the write-time columns."""
    return routed.where(F.col("route") == VALID).select(
        "event_id",
        "customer_id",
        "event_time",
        F.col("heart_rate").cast("smallint").alias("heart_rate"),
        F.lit("valid").alias("quality_flag"),
        F.col("topic").alias("source_topic"),
        F.col("partition").alias("source_partition"),
        F.col("offset").alias("source_offset"),
        text.event_json(
            F.col("event_id"), F.col("customer_id"), text.iso_offset(F.col("event_time")), F.col("heart_rate")
        ).alias("payload"),
        utc_date(F.col("event_time")).alias("event_date"),
    )


def quarantine(routed: DataFrame, error_type: str) -> DataFrame:
    """Envelope of every message on one of the two error routes."""
    return routed.where(F.col("route") == error_type).select(
        "error", "raw", F.col("route").alias("error_type")
    )


def as_envelope_json(envelopes: DataFrame) -> DataFrame:
    """Keyless JSON messages, ready for a topic sink."""
    return envelopes.select(F.to_json(F.struct("error", "raw", "error_type")).alias("value"))


def route_counters(routed: DataFrame) -> DataFrame:
    """One row: consumed, inserted, invalid and dead-lettered messages.
    ``inserted`` counts repeated deliveries too, as they are accepted writes."""
    return routed.agg(*counter_columns())


def counter_columns() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("consumed"),
        F.count_if(F.col("route") == VALID).alias("inserted"),
        F.count_if(F.col("route") == VALIDATION).alias("invalid"),
        F.count_if(F.col("route") == PROCESSING).alias("dlq"),
    ]
