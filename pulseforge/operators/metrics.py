"""Dashboard panels, counters and time filters.

Every aggregate is partial on the map side. Counts per minute, per type and per
partition reduce to a handful of rows per task; mean and exact percentile work
on counts per distinct rate (at most 251).
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseforge.config import DEFAULTS, Settings
from pulseforge.functions.times import Instant, instant, utc_date

# Default widths of the trailing panels.
BREAKDOWN_WIDTH = timedelta(hours=1)
RATE_WIDTH = timedelta(minutes=5)
ACTIVE_WIDTH = timedelta(minutes=10)
DEFAULT_RANGE = timedelta(hours=1)
RECENT_LIMIT = 20

# Colour bands of the two rate panels, each from its lower limit.
AVERAGE_BANDS = ((60, "green"), (120, "orange"), (140, "red"))
AVERAGE_BASE = "blue"
P95_BANDS = ((130, "yellow"), (160, "red"))
P95_BASE = "green"


def time_range(rows: DataFrame, start: Instant, end: Instant) -> DataFrame:
    """``start <= event_time <= end``; partitions outside the dates are pruned."""
    low, high = instant(start), instant(end)
    kept = rows.where(F.col("event_time").between(low, high))
    if "event_date" in rows.columns:
        kept = kept.where(F.col("event_date").between(utc_date(low), utc_date(high)))
    return kept


def trailing(rows: DataFrame, width: timedelta, as_of: Instant | None = None) -> DataFrame:
    """``event_time > as_of - width``, with no upper limit. The derived
    ``event_date`` filter prunes partitions, which the optimizer cannot infer."""
    now = F.current_timestamp() if as_of is None else instant(as_of)
    limit = now - F.lit(width)
    kept = rows.where(F.col("event_time") > limit)
    if "event_date" in rows.columns:
        kept = kept.where(F.col("event_date") >= utc_date(limit))
    return kept


def per_minute(rows: DataFrame) -> DataFrame:
    """Rows per minute, ascending; a minute without rows is absent."""
    return (
        rows.groupBy(F.date_trunc("minute", "event_time").alias("time"))
        .agg(F.count(F.lit(1)).cast("double").alias("value"))
        .orderBy("time")
    )


def type_breakdown(anomalies: DataFrame) -> DataFrame:
    return (
        anomalies.groupBy("anomaly_type")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "anomaly_type")
    )


def rate_stats(events: DataFrame, *keys: str, fraction: float = 0.95) -> DataFrame:
    """``average`` (one decimal, half away from zero) and exact ``p95`` rate per
    key; NULL when there is no reading.

    Readings are first counted per distinct rate, which leaves at most 251 rows
    per key whatever the number of readings; the rest works on those. The mean
    divides integer sums as decimals, so one that lies exactly on a half is not
    moved by binary rounding. The percentile interpolates as the database does,
    ``low + share * (high - low)``: a weighted sum can differ in the last bit,
    which is enough to change a colour band.
    """
    counts = (
        events.where(F.col("heart_rate").isNotNull())
        .groupBy(*keys, F.col("heart_rate").cast("int").alias("_rate"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    per_key = Window.partitionBy(*keys)
    position = F.lit(fraction) * (F.sum("_n").over(per_key) - 1)
    placed = counts.withColumns({
        "_upto": F.sum("_n").over(per_key.orderBy("_rate").rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "_position": position,
    })
    reached = lambda rank: F.min(F.when(F.col("_upto") > rank, F.col("_rate")))
    whole = "decimal(20,0)"
    mean = F.try_divide(F.sum(F.col("_rate") * F.col("_n")).cast(whole), F.sum("_n").cast(whole))
    stats = placed.groupBy(*keys).agg(
        F.round(mean, 1).cast("double").alias("average"),
        reached(F.floor("_position")).cast("double").alias("_low"),
        reached(F.ceil("_position")).cast("double").alias("_high"),
        F.max("_position").alias("_position"),
    )
    share = F.col("_position") - F.floor("_position")
    return stats.select(
        *keys, "average", (F.col("_low") + share * (F.col("_high") - F.col("_low"))).alias("p95")
    )


def average_rate(events: DataFrame) -> DataFrame:
    return rate_stats(events).select(F.col("average").alias("value"))


def p95_rate(events: DataFrame) -> DataFrame:
    return rate_stats(events).select(F.col("p95").alias("value"))


def active_customers(events: DataFrame) -> DataFrame:
    return events.agg(F.count_distinct("customer_id").cast("double").alias("value"))


def recent_anomalies(anomalies: DataFrame, limit: int = RECENT_LIMIT) -> DataFrame:
    """Newest anomalies; equal times are ordered by event id to be repeatable."""
    return (
        anomalies.orderBy(F.desc("event_time"), "event_id")
        .limit(limit)
        .select("event_time", "customer_id", "heart_rate", "anomaly_type", "severity")
    )


def average_band(value: Column) -> Column:
    return _band(value, AVERAGE_BASE, AVERAGE_BANDS)


def p95_band(value: Column) -> Column:
    return _band(value, P95_BASE, P95_BANDS)


def _band(value: Column, base: str, bands: tuple[tuple[int, str], ...]) -> Column:
    colour = F.when(value.isNull(), F.lit(None).cast("string"))
    for limit, name in sorted(bands, reverse=True):
        colour = colour.when(value >= limit, name)
    return colour.otherwise(base)


def type_severity_counts(anomalies: DataFrame) -> DataFrame:
    return anomalies.groupBy("anomaly_type", "severity").agg(F.count(F.lit(1)).alias("count"))


def throughput(rows: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Readings per second in each tumbling interval that has any, and whether
    that is below the accepted minimum."""
    seconds = settings.throughput_seconds
    interval = F.window("event_time", f"{seconds} seconds")
    rate = F.col("readings") / F.lit(seconds)
    return (
        rows.groupBy(interval.alias("_window"))
        .agg(F.count(F.lit(1)).alias("readings"))
        .select(
            F.col("_window.start").alias("interval_start"),
            "readings",
            F.round(rate, 1).alias("per_second"),
            (rate < settings.throughput_min_eps).alias("below_minimum"),
        )
    )


def high_water_marks(valid: DataFrame, group: str) -> DataFrame:
    """Last valid offset per source partition: rows for the checkpoint table.
    Accepts routed VALID rows or stored events."""
    names = ("topic", "partition", "offset")
    if "source_offset" in valid.columns:
        names = ("source_topic", "source_partition", "source_offset")
    topic, partition, offset = names
    return (
        valid.groupBy(F.col(topic).alias("topic"), F.col(partition).alias("partition"))
        .agg(F.max(offset).alias("last_offset"))
        .select(F.lit(group).alias("consumer_group"), "topic", "partition", "last_offset")
    )
