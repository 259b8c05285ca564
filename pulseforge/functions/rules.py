"""Anomaly rules as one pure column builder, shared by batch and streaming."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulseforge.config import DEFAULTS, Settings

LOW = "LOW_HEART_RATE"
HIGH = "HIGH_HEART_RATE"
SPIKE = "SPIKE"


def anomaly(rate: Column, previous: Column, settings: Settings = DEFAULTS) -> Column:
    """``STRUCT<anomaly_type, severity, details>`` of the first rule that fires
    (low, then high, then spike), NULL when none does. ``previous`` is NULL on
    a customer's first reading, which can therefore never be a spike."""
    delta = F.abs(rate - previous)
    nothing = F.lit(None).cast("int")
    return (
        F.when(
            rate <= settings.anomaly_low_threshold,
            _outcome(LOW, "high", nothing, settings.anomaly_low_threshold, nothing, rate),
        )
        .when(
            rate >= settings.anomaly_high_threshold,
            _outcome(HIGH, "high", nothing, settings.anomaly_high_threshold, nothing, rate),
        )
        .when(
            delta >= settings.anomaly_spike_delta,
            _outcome(SPIKE, "medium", delta, settings.anomaly_spike_delta, previous, rate),
        )
    )


def _outcome(kind: str, severity: str, delta: Column, threshold: int, previous: Column, rate: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("anomaly_type"),
        F.lit(severity).alias("severity"),
        F.struct(
            delta.cast("int").alias("delta"),
            F.lit(threshold).alias("threshold"),
            previous.cast("int").alias("previous"),
            rate.cast("int").alias("measured"),
        ).alias("details"),
    )


def details_json(details: Column) -> Column:
    """Context as JSON; members that do not apply to the rule are left out."""
    return F.to_json(details)
