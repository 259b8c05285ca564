"""Look-ups over stored data and the source position joins."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulseforge.functions.times import Instant
from pulseforge.operators.metrics import trailing
from pulseforge.operators.selection import quantile

# Spark pushes a top-k-per-group limit below the shuffle up to this size
# (default of spark.sql.optimizer.windowGroupLimitThreshold).
GROUP_LIMIT = 1000


def last_readings(events: DataFrame, n: int) -> DataFrame:
    """The ``n`` newest readings of every customer, with their ``position``
    (1 = newest). Up to ``GROUP_LIMIT`` each task forwards at most ``n`` rows
    per customer; above it a first pass per customer and day does the same
    job, so that no task ranks more than a day of a customer, or ``n`` rows of each."""
    newest = [F.desc("event_time"), F.asc("event_id")]
    rows = events
    if n > GROUP_LIMIT:
        day = F.floor(F.unix_micros("event_time") / 86_400_000_000)
        first = Window.partitionBy("customer_id", "_day").orderBy(*newest)
        rows = rows.withColumn("_day", day).withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= n).drop("_day", "_rank")
    window = Window.partitionBy("customer_id").orderBy(*newest)
    return rows.withColumn("position", F.row_number().over(window)).where(F.col("position") <= n)


def customer_last_readings(events: DataFrame, customer_id: str, n: int) -> DataFrame:
    """The ``n`` newest readings of one customer: a pushed-down filter and a top-k."""
    return (
        events.where(F.col("customer_id") == customer_id).orderBy(F.desc("event_time"), F.asc("event_id")).limit(n)
    )


def recent_events(events: DataFrame, width: timedelta = timedelta(hours=1), as_of: Instant | None = None) -> DataFrame:
    return trailing(events, width, as_of)


def quality_audit(events: DataFrame) -> DataFrame:
    """Rows not flagged valid, newest first."""
    return events.where(F.col("quality_flag") != "valid").orderBy(F.desc("event_time"), F.asc("event_id"))


def customer_anomalies(anomalies: DataFrame, customer_id: str) -> DataFrame:
    return anomalies.where(F.col("customer_id") == customer_id).orderBy(F.desc("event_time"), F.asc("event_id"))


def ingest_latency(events: DataFrame) -> DataFrame:
    """One row: how long readings took from capture to storage, in seconds. The p95
    is exact: the least delay that 95 % of the readings do not exceed."""
    micros = F.unix_micros("ingest_time") - F.unix_micros("event_time")
    rows = events.select(micros.alias("_micros"))
    whole = "decimal(30,0)"
    mean = F.try_divide(F.sum(F.col("_micros").cast(whole)), F.count("_micros").cast(whole))
    average = (F.round(mean, 0) / 1_000_000).cast("double")
    count, seconds, low, high = rows.agg(F.count("_micros"), average, F.min("_micros"), F.max("_micros")).first()
    p95 = quantile(rows, F.col("_micros"), 0.95, (low, high, count))
    found = events.sparkSession.createDataFrame([(count, seconds, p95, high)], "events BIGINT, avg_seconds DOUBLE, _p95 BIGINT, _high BIGINT")
    return found.select("events", "avg_seconds", (F.col("_p95") / 1_000_000).alias("p95_seconds"), (F.col("_high") / 1_000_000).alias("max_seconds"))


def trace_to_source(stored: DataFrame, messages: DataFrame) -> DataFrame:
    """Stored events next to the raw message each one came from."""
    source = messages.select(
        F.col("topic").alias("source_topic"),
        F.col("partition").alias("source_partition"),
        F.col("offset").alias("source_offset"),
        F.col("value").alias("raw"),
    )
    return stored.join(source, ["source_topic", "source_partition", "source_offset"])


def replay_after(messages: DataFrame, checkpoint: DataFrame, group: str) -> DataFrame:
    """Messages past the group's stored offset; all of a partition without one.

    The checkpoint is keyed by (group, topic, partition): one narrow row per
    source partition, however much data there is. That bound is what makes the
    broadcast safe; without it every message would be shuffled to one of a few
    (topic, partition) groups."""
    marks = checkpoint.where(F.col("consumer_group") == group).select("topic", "partition", "last_offset")
    return (
        messages.join(F.broadcast(marks), ["topic", "partition"], "left")
        .where(F.col("offset") > F.coalesce("last_offset", F.lit(-1)))
        .drop("last_offset")
        .select(*messages.columns)
    )
