"""Rolling history and anomaly detection over schema-valid readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseforge.config import DEFAULTS, Settings
from pulseforge.functions import rules, text
from pulseforge.functions.times import utc_date
from pulseforge.operators.lookback import with_recent
from pulseforge.operators.route import storable


def with_previous_rate(readings: DataFrame, settings: Settings = DEFAULTS, known: DataFrame | None = None) -> DataFrame:
    """Add ``previous_rate``: the customer's preceding reading in arrival order, for
    the first one that of ``known`` (customers' last readings before), if any."""
    rows = with_recent(readings, "_recent", 1, settings.lookback_chunk, known)
    return rows.withColumn("previous_rate", F.get("_recent", 0)).drop("_recent")


def with_history(readings: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Add ``recent_rates``: up to ``history_depth`` preceding readings, most
    recent last, empty on the first."""
    return with_recent(readings, "recent_rates", settings.history_depth, settings.lookback_chunk)


def flag_anomalies(with_previous: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Readings on which a rule fires, in the stored anomaly layout. A customer
    id that the destination cannot hold yields no anomaly, though its readings
    still count as history."""
    return (
        with_previous.where(storable(F.col("customer_id")))
        .withColumn("_hit", rules.anomaly(F.col("heart_rate"), F.col("previous_rate"), settings))
        .where(F.col("_hit").isNotNull())
        .select(
            "event_id",
            "customer_id",
            "event_time",
            F.col("heart_rate").cast("smallint").alias("heart_rate"),
            F.col("_hit.anomaly_type").alias("anomaly_type"),
            F.col("_hit.severity").alias("severity"),
            rules.details_json(F.col("_hit.details")).alias("details"),
            utc_date(F.col("event_time")).alias("event_date"),
        )
    )


def detect(readings: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Batch detector: schema-valid readings -> anomalies. Soft bounds are not
    applied, so a reading the writer rejects can still be an anomaly and is
    still the next reading's predecessor."""
    return flag_anomalies(with_previous_rate(readings, settings), settings)


def as_messages(anomalies: DataFrame) -> DataFrame:
    """Keyed JSON messages for the anomaly topic."""
    document = F.to_json(
        F.struct(
            "event_id",
            "customer_id",
            text.iso_zulu(F.col("event_time")).alias("timestamp"),
            F.col("heart_rate").cast("int").alias("heart_rate"),
            "anomaly_type",
            "severity",
            F.from_json("details", "delta INT, threshold INT, previous INT, measured INT").alias("details"),
        )
    )
    return anomalies.select(F.col("customer_id").alias("key"), document.alias("value"))
