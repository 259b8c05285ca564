"""Named queries over the test tables. Each runs over the whole table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseforge.config import DEFAULTS, Settings
from pulseforge.operators import anomalies, decode, dedup, lookup, metrics, route
from pulseforge.plans import fixture, pipeline
from pulseforge.schema import CHECKPOINT, DETAILS
from pulseforge.session import configure, work_dir
from pulseforge.sources import keyed, log, sinks, topics
from pulseforge.sources.archive import Archive
from pulseforge.sources.batch import Batch
from pulseforge.sources.tables import Tables
from pulseforge.streaming import active
from pulseforge.streaming import queries as streams

Query = Callable[[SparkSession, str], DataFrame]

HOUR = timedelta(hours=1)
DAY = timedelta(days=1)
MONTH = timedelta(days=30)
HALF_WAY = datetime(2024, 1, 16, tzinfo=timezone.utc)
REDELIVERY = 1_000_000_000
CUSTOMER = "cust_00001"


def _source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.read_events(configure(spark), sf_dir)


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.raw_messages(fixture.spread(_source(spark, sf_dir)))


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route.route_messages(decode.decode_messages(_messages(spark, sf_dir)))


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route.valid_events(_routed(spark, sf_dir))


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.schema_valid(decode.decode_messages(_messages(spark, sf_dir)))


def _anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomalies.detect(_readings(spark, sf_dir))


_built: dict[tuple, Tables] = {}


def _tables(spark: SparkSession, sf_dir: str, consumer: Callable) -> Tables:
    """The tables that a consumer makes of all messages, written once per session
    and state of the input to the shared folder. The panels read these."""
    spark = configure(spark)
    key = (spark.sparkContext.applicationId, sf_dir, log.stamp(spark, f"{sf_dir}/events.parquet"), consumer.__name__)
    if key not in _built:
        tables = Tables(work_dir(spark, consumer.__name__))
        consumer(spark, _messages(spark, sf_dir), tables)
        _built[key] = tables
    return _built[key]


def keep_raw(spark: SparkSession, messages: DataFrame, tables: Tables) -> None:
    tables.archive.keep(messages, Batch.new())


def _archive(spark: SparkSession, sf_dir: str) -> Archive:
    return _tables(spark, sf_dir, keep_raw).archive


def _stored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tables(spark, sf_dir, pipeline.ingest).read_events(spark)


def _stored_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tables(spark, sf_dir, pipeline.detect).read_anomalies(spark)


def _as_of(spark: SparkSession, sf_dir: str) -> Column:
    """Time of the last reading: the panels' "now"."""
    return _source(spark, sf_dir).agg(F.max("ts").cast("timestamp")).scalar()


def _start(spark: SparkSession, sf_dir: str) -> Column:
    return _source(spark, sf_dir).agg(F.min("ts").cast("timestamp")).scalar()


def plain_times(rows: DataFrame) -> DataFrame:
    """UTC instants as zone-less timestamps, for comparison outside Spark."""
    instants = [f.name for f in rows.schema if f.dataType.typeName() == "timestamp"]
    return rows.withColumns({name: F.col(name).cast("timestamp_ntz") for name in instants}) if instants else rows


def _anomaly_columns(rows: DataFrame) -> DataFrame:
    return plain_times(
        rows.select(
            "event_id", "customer_id", "event_time", F.col("heart_rate").cast("int").alias("heart_rate"),
            "anomaly_type", "severity",
        )
    )


def _event_columns(rows: DataFrame) -> DataFrame:
    return plain_times(
        rows.select(
            "event_id", "customer_id", "event_time", F.col("heart_rate").cast("int").alias("heart_rate"),
            "quality_flag", "source_topic", "source_partition", "source_offset", "payload", "event_date",
        )
    )


def route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route.route_counters(_routed(spark, sf_dir))


def valid_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_columns(_valid(spark, sf_dir))


def quarantine_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = _routed(spark, sf_dir).where(F.col("route") != route.VALID)
    return failed.groupBy(F.col("route").alias("error_type"), "reasons").agg(F.count(F.lit(1)).alias("messages"))


def quarantine_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route.quarantine(_routed(spark, sf_dir), route.VALIDATION)


def dead_letter_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route.quarantine(_routed(spark, sf_dir), route.PROCESSING)


def dedup_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every valid event delivered again later with another rate."""
    once = _valid(spark, sf_dir).select(
        "customer_id", "event_id", "source_topic", "source_partition", "source_offset",
        F.col("heart_rate").cast("int").alias("heart_rate"),
    )
    again = once.withColumns({"source_offset": F.col("source_offset") + REDELIVERY, "heart_rate": F.lit(99)})
    return dedup.first_arrivals(once.unionByName(again)).drop("source_topic")


def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All valid events offered to a table that holds the earlier half."""
    offered = _valid(spark, sf_dir)
    existing = offered.where(F.col("event_time") < F.lit(HALF_WAY))
    return dedup.insert_if_absent(offered, existing).select("customer_id", "event_id", "source_offset")


def checkpoint_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.high_water_marks(_routed(spark, sf_dir))


def _marks(spark: SparkSession, sf_dir: str, earlier: bool) -> DataFrame:
    routed = _routed(spark, sf_dir)
    before = F.col("event_time") < F.lit(HALF_WAY)
    return sinks.high_water_marks(routed.where(before if earlier else ~before))


def checkpoint_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later half is recorded first, then the earlier: marks move back."""
    tables = Tables(work_dir(configure(spark), "checkpoint"))
    sinks.upsert_checkpoint(spark, _marks(spark, sf_dir, earlier=False), tables)
    sinks.upsert_checkpoint(spark, _marks(spark, sf_dir, earlier=True), tables)
    return keyed.read(spark, tables.checkpoint, CHECKPOINT).drop("updated_at")


def replay_after_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = _marks(spark, sf_dir, earlier=True)
    found = _archive(spark, sf_dir).replay(spark, marks, DEFAULTS.group_writer)
    return found.select("topic", "partition", "offset", "value")


def anomaly_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _anomaly_columns(_anomalies(spark, sf_dir))


def anomaly_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _anomalies(spark, sf_dir).select("event_id", F.from_json("details", DETAILS).alias("d"))
    return found.select("event_id", *[F.col(f"d.{name}").alias(name) for name in DETAILS.names])


def _breakdown(width: timedelta) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return metrics.type_breakdown(metrics.trailing(_stored_anomalies(spark, sf_dir), width, _as_of(spark, sf_dir)))

    return query


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anomalies by type of the last 30 days, straight from the messages."""
    return metrics.type_breakdown(metrics.trailing(_anomalies(spark, sf_dir), MONTH, _as_of(spark, sf_dir)))


def anomaly_type_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.type_severity_counts(_stored_anomalies(spark, sf_dir))


SMALL_CHUNK = Settings(lookback_chunk=7)


def rolling_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir, DEFAULTS)


def rolling_history_chunk_7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven offsets a chunk: nearly every reading looks across chunks."""
    return _history(spark, sf_dir, SMALL_CHUNK)


def _history(spark: SparkSession, sf_dir: str, settings: Settings) -> DataFrame:
    rows = anomalies.with_history(_readings(spark, sf_dir), settings)
    recent = F.array_join(F.col("recent_rates").cast("array<string>"), ",")
    return rows.select("event_id", "customer_id", "heart_rate", recent.alias("recent_rates"))


def previous_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _previous(_readings(spark, sf_dir), DEFAULTS)


def previous_rate_chunk_7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _previous(_readings(spark, sf_dir), SMALL_CHUNK)


def _previous(readings: DataFrame, settings: Settings) -> DataFrame:
    rows = anomalies.with_previous_rate(readings, settings)
    return rows.select("event_id", "customer_id", "heart_rate", "previous_rate")


def events_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    in_range = metrics.time_range(_stored_events(spark, sf_dir), _start(spark, sf_dir), _as_of(spark, sf_dir))
    return plain_times(metrics.per_minute(in_range))


def anomalies_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    in_range = metrics.time_range(_stored_anomalies(spark, sf_dir), _start(spark, sf_dir), _as_of(spark, sf_dir))
    return plain_times(metrics.per_minute(in_range))


def events_per_minute_default_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = _as_of(spark, sf_dir)
    in_range = metrics.time_range(_stored_events(spark, sf_dir), now - F.lit(metrics.DEFAULT_RANGE), now)
    return plain_times(metrics.per_minute(in_range))


def _panel(panel: Callable[[DataFrame], DataFrame], width: timedelta) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return panel(metrics.trailing(_stored_events(spark, sf_dir), width, _as_of(spark, sf_dir)))

    return query


def stat_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both rate panels and their colours, per customer."""
    return metrics.rate_stats(_stored_events(spark, sf_dir), "customer_id").select(
        "customer_id",
        "average",
        metrics.average_band(F.col("average")).alias("average_band"),
        "p95",
        metrics.p95_band(F.col("p95")).alias("p95_band"),
    )


def recent_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = plain_times(metrics.recent_anomalies(_stored_anomalies(spark, sf_dir)))
    return rows.withColumn("heart_rate", F.col("heart_rate").cast("int"))


def last_n_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lookup.last_readings(_stored_events(spark, sf_dir), 5)
    return plain_times(rows.select("customer_id", "position", "event_id", "event_time"))


def customer_last_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lookup.customer_last_readings(_stored_events(spark, sf_dir), CUSTOMER, 10)
    return plain_times(rows.select("customer_id", "event_id", "event_time"))


def customer_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _anomaly_columns(lookup.customer_anomalies(_stored_anomalies(spark, sf_dir), CUSTOMER))


def _recent_events(width: timedelta) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = lookup.recent_events(_stored_events(spark, sf_dir), width, _as_of(spark, sf_dir))
        return plain_times(rows.select("event_id", "customer_id", "event_time"))

    return query


def quality_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored readings that another writer has flagged: the writers here flag every
    row valid. A reading whose rate came as text counts as repaired."""
    came_as_text = F.col("source_offset") % 100 == 3
    flagged = _valid(spark, sf_dir).withColumn("quality_flag", F.when(came_as_text, "repaired").otherwise("valid"))
    tables = Tables(work_dir(spark, "flagged"))
    sinks.write_events(flagged, tables, Batch.new())
    return plain_times(lookup.quality_audit(tables.read_events(spark)).select("event_id", "event_time", "quality_flag"))


def trace_to_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _archive(spark, sf_dir).trace(_stored_events(spark, sf_dir))
    return rows.select("event_id", "source_topic", "source_partition", "source_offset", "raw")


def ingest_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delays of microseconds, hardly any two of them the same."""
    delay = F.make_dt_interval(secs=(1_000_000 + F.col("source_offset") * 48_271 % 8_999_993).cast("decimal(18,6)") / 1_000_000)
    return lookup.ingest_latency(_valid(spark, sf_dir).withColumn("ingest_time", F.col("event_time") + delay))


def throughput_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(metrics.throughput(_stored_events(spark, sf_dir)))


def publish_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.event_messages(_valid(spark, sf_dir))


def publish_then_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two halves published to a topic one after the other; the second half is what
    is left after the offsets that the first half's writer has stored."""
    tables, name = Tables(work_dir(configure(spark), "published")), "events.again.v1"
    events = _valid(spark, sf_dir)
    early = F.col("event_time") < F.lit(HALF_WAY)
    topics.publish(sinks.event_messages(events.where(early)), tables.topic(name), name, Batch.new(), DEFAULTS.topic_partitions)
    pipeline.ingest(spark, tables.read_topic(spark, name), tables)
    topics.publish(sinks.event_messages(events.where(~early)), tables.topic(name), name, Batch.new(), DEFAULTS.topic_partitions)
    return lookup.replay_after(tables.read_topic(spark, name), tables.read_checkpoint(spark), DEFAULTS.group_writer).select("key", "value")


def decode_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All forms that identifiers, times and rates may have, members left out, bytes
    that are no text, and messages without a value."""
    rows = decode.decode_messages(fixture.message_forms(_source(spark, sf_dir)))
    return plain_times(rows.select("offset", "event_id", F.char_length("customer_id").alias("customer_chars"), "event_time", "heart_rate", "reasons"))


def _redelivered(messages: DataFrame) -> DataFrame:
    """All messages, and all of them again at later offsets."""
    return messages.unionByName(messages.withColumn("offset", F.col("offset") + REDELIVERY))


def anomalies_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reading delivered twice is judged twice, the second time after the rest."""
    messages = _redelivered(_messages(spark, sf_dir))
    return _anomaly_columns(anomalies.detect(decode.schema_valid(decode.decode_messages(messages))))


def publish_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomalies.as_messages(_anomalies(spark, sf_dir))


def preview_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.preview_json(_valid(spark, sf_dir))


CUTS = 4
#: Rows that a file of the feed has at least, where a stretch has several.
FEED_ROWS = 10_000


def _message_stream(spark: SparkSession, sf_dir: str, late: bool = False, again: bool = False) -> DataFrame:
    """All messages as a stream that arrives in ``CUTS`` micro-batches: stretches of
    the table are written one after another, each in as many files, and read stretch
    by stretch. The files are dealt to all cores, so the number of batches does not
    grow with the files that a large table is written to or scanned in. ``late`` cuts
    across, so that every batch has rows of all times. ``again`` sends each stretch a
    second time, in a batch of its own. A stretch without rows is left out."""
    events, feed = _source(spark, sf_dir), work_dir(spark, "feed")
    low, high = events.agg(F.min("event_id"), F.max("event_id")).first()
    width = (high - low) // CUTS + 1
    starts = [low + cut * width for cut in range(CUTS)]
    parts = [F.col("event_id") % CUTS == cut if late else F.col("event_id").between(starts[cut], starts[cut] + width - 1) for cut in range(CUTS)]
    counts = events.agg(*[F.count_if(part) for part in parts]).first()
    files = max(1, min(spark.sparkContext.defaultParallelism, min(n for n in counts if n) // FEED_ROWS))
    for part in (part for part, n in zip(parts, counts) if n):
        for more in (0, REDELIVERY)[:2 if again else 1]:
            events.where(part).withColumn("_more", F.lit(more)).repartition(files).write.mode("append").parquet(feed)
    stream = spark.readStream.schema(f"{fixture.EVENTS_SCHEMA}, _more BIGINT").option("maxFilesPerTrigger", files).parquet(feed)
    return fixture.raw_messages(stream, "_more")


def stream_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(configure(spark), "detector")
    tables = Tables(f"{root}/tables")
    messages = _message_stream(spark, sf_dir)
    streams.start_detector(messages, tables, f"{root}/progress", available_now=True).awaitTermination()
    return _anomaly_columns(tables.read_anomalies(spark))


def stream_valid_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(configure(spark), "writer")
    tables = Tables(f"{root}/tables")
    messages = _message_stream(spark, sf_dir)
    streams.start_writer(messages, tables, f"{root}/progress", available_now=True).awaitTermination()
    return _event_columns(tables.read_events(spark))


def stream_valid_events_stateful(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(configure(spark), "stateful-writer")
    tables = Tables(f"{root}/tables")
    messages = _message_stream(spark, sf_dir)
    streams.start_stateful_writer(messages, tables, f"{root}/progress", available_now=True).awaitTermination()
    return _event_columns(tables.read_events(spark))


def stream_valid_events_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with every message delivered again, in another batch: the first
    arrival stays, and marks go on to the second's offset."""
    root = work_dir(configure(spark), "redelivered")
    tables = Tables(f"{root}/tables")
    messages = _message_stream(spark, sf_dir, again=True)
    streams.start_stateful_writer(messages, tables, f"{root}/progress", available_now=True).awaitTermination()
    return _event_columns(tables.read_events(spark))


def consumers_share_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writer and detector on one feed, each with its own progress."""
    root = work_dir(configure(spark), "consumers")
    tables = Tables(f"{root}/tables")
    messages = _message_stream(spark, sf_dir)
    both = [
        streams.start_writer(messages, tables, f"{root}/progress-writer", available_now=True),
        streams.start_detector(messages, tables, f"{root}/progress-detector", available_now=True),
    ]
    for query in both:
        query.awaitTermination()
    stored = tables.read_events(spark).select(F.lit("event").alias("kind"), "event_id", F.col("heart_rate").cast("int").alias("heart_rate"))
    return stored.unionByName(tables.read_anomalies(spark).select(F.col("anomaly_type").alias("kind"), "event_id", F.col("heart_rate").cast("int").alias("heart_rate")))


def ingest_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batch jobs over halves of the messages, then all of them again, against
    keys in the index and, for the second half, keys that it has not come to yet."""
    tables = Tables(work_dir(configure(spark), "twice"))
    messages = _messages(spark, sf_dir)
    early = F.col("timestamp") < F.lit(HALF_WAY)
    pipeline.ingest(spark, messages.where(early), tables)
    tables.history.catch_up(spark)
    for part in (messages.where(~early), messages):
        pipeline.ingest(spark, part, tables)
    return _event_columns(tables.read_events(spark))


def backfill_then_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backfill of the earlier half, then the stream of all messages."""
    root = work_dir(configure(spark), "backfill")
    tables = Tables(f"{root}/tables")
    early = _messages(spark, sf_dir).where(F.col("timestamp") < F.lit(HALF_WAY))
    pipeline.ingest(spark, early, tables)
    messages = _message_stream(spark, sf_dir)
    streams.start_writer(messages, tables, f"{root}/progress", available_now=True).awaitTermination()
    return _event_columns(tables.read_events(spark))


def detector_new_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earlier half by a stream, the later half by another with a progress
    folder of its own: history goes on where it stood."""
    root = work_dir(configure(spark), "detectors")
    tables = Tables(f"{root}/tables")
    messages = _messages(spark, sf_dir)
    early = F.col("timestamp") < F.lit(HALF_WAY)
    for name, part in (("first", messages.where(early)), ("second", messages.where(~early))):
        part.write.parquet(f"{root}/{name}")
        stream = spark.readStream.schema(part.schema).parquet(f"{root}/{name}")
        streams.start_detector(stream, tables, f"{root}/progress-{name}", available_now=True).awaitTermination()
    return _anomaly_columns(tables.read_anomalies(spark))


def _stream_panel(spark: SparkSession, counts: DataFrame, key: str, root: str) -> DataFrame:
    streams.start_panel(counts, f"{root}/panel", [key], f"{root}/progress-panel", available_now=True).awaitTermination()
    return plain_times(keyed.read(spark, f"{root}/panel", counts.schema))


def _valid_stream(spark: SparkSession, sf_dir: str, late: bool = False) -> DataFrame:
    return route.valid_events(route.route_messages(decode.decode_messages(_message_stream(spark, sf_dir, late))))


def stream_events_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(configure(spark), "minutes")
    return _stream_panel(spark, streams.minute_counts(_valid_stream(spark, sf_dir)), "time", root)


def stream_events_per_minute_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(configure(spark), "late-minutes")
    return _stream_panel(spark, streams.minute_counts(_valid_stream(spark, sf_dir, late=True)), "time", root)


def stream_active_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct customers of every ten minutes, rows of all times in every batch."""
    root = work_dir(configure(spark), "active")
    rows = _valid_stream(spark, sf_dir, late=True)
    active.start_active_customers(rows, f"{root}/panel", f"{root}/progress", available_now=True).awaitTermination()
    return plain_times(active.read_active(spark, f"{root}/panel"))


def stream_anomalies_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detector's table, followed by its commits."""
    root = work_dir(configure(spark), "anomaly-minutes")
    tables = Tables(f"{root}/tables")
    messages = _message_stream(spark, sf_dir)
    streams.start_detector(messages, tables, f"{root}/progress", available_now=True).awaitTermination()
    counts, panel = streams.minute_counts, f"{root}/panel"
    streams.start_table_panel(spark, tables.anomalies, counts, panel, ["time"], f"{root}/progress-panel", available_now=True).awaitTermination()
    return plain_times(streams.read_panel(spark, panel, counts(tables.read_anomalies(spark)).schema))


def stream_throughput_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(configure(spark), "throughput")
    return _stream_panel(spark, metrics.throughput(_valid_stream(spark, sf_dir)), "interval_start", root)


QUERIES: dict[str, Query] = {
    "route_counts": route_counts,
    "valid_events": valid_events,
    "quarantine_reasons": quarantine_reasons,
    "quarantine_envelopes": quarantine_envelopes,
    "dead_letter_envelopes": dead_letter_envelopes,
    "dedup_first_wins": dedup_first_wins,
    "insert_if_absent": insert_if_absent,
    "checkpoint_offsets": checkpoint_offsets,
    "checkpoint_upsert": checkpoint_upsert,
    "replay_after_checkpoint": replay_after_checkpoint,
    "previous_rate": previous_rate,
    "rolling_history": rolling_history,
    "rolling_history_chunk_7": rolling_history_chunk_7,
    "previous_rate_chunk_7": previous_rate_chunk_7,
    "anomalies": anomaly_rows,
    "anomalies_redelivered": anomalies_redelivered,
    "anomaly_details": anomaly_details,
    "anomaly_type_breakdown": _breakdown(metrics.BREAKDOWN_WIDTH),
    "anomaly_type_breakdown_30d": _breakdown(MONTH),
    "anomaly_type_severity": anomaly_type_severity,
    "events_per_minute": events_per_minute,
    "events_per_minute_default_range": events_per_minute_default_range,
    "anomalies_per_minute": anomalies_per_minute,
    "avg_rate": _panel(metrics.average_rate, metrics.RATE_WIDTH),
    "avg_rate_1d": _panel(metrics.average_rate, DAY),
    "avg_rate_30d": _panel(metrics.average_rate, MONTH),
    "p95_rate": _panel(metrics.p95_rate, metrics.RATE_WIDTH),
    "p95_rate_1d": _panel(metrics.p95_rate, DAY),
    "p95_rate_30d": _panel(metrics.p95_rate, MONTH),
    "active_customers": _panel(metrics.active_customers, metrics.ACTIVE_WIDTH),
    "active_customers_1d": _panel(metrics.active_customers, DAY),
    "active_customers_30d": _panel(metrics.active_customers, MONTH),
    "stat_bands": stat_bands,
    "recent_anomalies": recent_anomalies,
    "last_n_readings": last_n_readings,
    "customer_last_readings": customer_last_readings,
    "customer_anomalies": customer_anomalies,
    "recent_events": _recent_events(HOUR),
    "recent_events_30d": _recent_events(MONTH),
    "quality_audit": quality_audit,
    "trace_to_source": trace_to_source,
    "ingest_latency": ingest_latency,
    "throughput_intervals": throughput_intervals,
    "publish_events": publish_events,
    "publish_anomalies": publish_anomalies,
    "publish_then_replay": publish_then_replay,
    "decode_forms": decode_forms,
    "preview_json": preview_json,
    "stream_anomalies": stream_anomalies,
    "stream_valid_events": stream_valid_events,
    "stream_valid_events_stateful": stream_valid_events_stateful,
    "stream_valid_events_redelivered": stream_valid_events_redelivered,
    "consumers_share_feed": consumers_share_feed,
    "ingest_twice": ingest_twice,
    "backfill_then_stream": backfill_then_stream,
    "detector_new_progress": detector_new_progress,
    "stream_events_per_minute": stream_events_per_minute,
    "stream_events_per_minute_late": stream_events_per_minute_late,
    "stream_active_customers": stream_active_customers,
    "stream_anomalies_per_minute": stream_anomalies_per_minute,
    "stream_throughput_intervals": stream_throughput_intervals,
}
