"""Continuous versions of the two consumers and of the per-interval panels."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from pulseforge.config import DEFAULTS, Settings
from pulseforge.operators import decode, metrics, route
from pulseforge.plans import pipeline
from pulseforge.session import adaptive, at_once, rocksdb_state
from pulseforge.sources import keyed, sinks
from pulseforge.sources.batch import Batch, run_of
from pulseforge.sources.committed import Committed
from pulseforge.sources.tables import Tables


def _start(writer: DataStreamWriter, checkpoint: str, available_now: bool, interval: str) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def _query_name(group: str) -> str:
    return group.replace(".", "_").replace("-", "_")


def start_writer(
    messages: DataFrame,
    tables: Tables,
    checkpoint: str,
    settings: Settings = DEFAULTS,
    available_now: bool = False,
    interval: str = "10 seconds",
    on_counters: Callable[[int, dict[str, int]], None] | None = None,
    **options: bool,
) -> StreamingQuery:
    """Stream raw messages into the events table, quarantine and checkpoint.
    A message that cannot be stored is dead-lettered once and passed over."""

    run = run_of(messages.sparkSession, checkpoint)

    def batch(rows: DataFrame, batch_id: int) -> None:
        with adaptive(rows.sparkSession, messages.sparkSession):
            counters = pipeline.ingest(
                rows.sparkSession, rows, tables, Batch(run, batch_id), settings, reduce_history=True, **options
            )
        if on_counters:
            on_counters(batch_id, counters)

    writer = messages.writeStream.queryName(_query_name(settings.group_writer))
    return _start(writer.foreachBatch(batch), checkpoint, available_now, interval)


def _first_arrivals(routed: DataFrame) -> DataFrame:
    """Stateful first-wins: one row per key met in the batch, new or not.

    A valid event's key is (customer, event); a rejected message's is its source
    position, so that both go through one state and messages are decoded once. A
    streaming aggregation combines copies before the shuffle, so a key with very many
    copies costs one row per task. ``first`` is the row that won when the key was
    first met; ``last`` is its newest delivery. Both start with the batch's own time,
    so they share it exactly when the key is new.
    """
    arrival = ("batch_time", "topic", "partition", "offset")
    valid = F.col("route") == route.VALID
    rejected = lambda name: F.when(~valid, F.col(name)).alias(name)
    return (
        routed.withColumn("batch_time", F.current_timestamp())
        .withColumn("position", F.when(~valid, F.struct("topic", "partition", "offset")))
        .groupBy("route", F.when(valid, F.col("customer_id")).alias("customer_id"), F.when(valid, F.col("event_id")).alias("event_id"), "position")
        .agg(
            F.min(F.struct(*arrival, "event_time", "heart_rate", rejected("raw"), rejected("error"))).alias("first"),
            F.max(F.struct(*arrival)).alias("last"),
        )
    )


def start_stateful_writer(
    messages: DataFrame,
    tables: Tables,
    checkpoint: str,
    settings: Settings = DEFAULTS,
    available_now: bool = False,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """The writer with its keys in the state store rather than in the table.

    ``start_writer`` compares every batch with the keys of the whole events table,
    which grows for ever. Here the work per batch depends on the batch alone: known
    keys live in the (RocksDB) state store, spread over the executors by key. Use it
    for long-running streams into a table that only it writes. Rejected messages pass
    the same state under their source position, and stay there as valid keys do.
    Counters are reported as the query's observed metrics ``accepted`` and
    ``rejected``.

    Progress marks come from the keys met in each batch, so they are exact as
    long as one event is not delivered on two source partitions within one
    batch, which keyed publishing rules out; otherwise they may lag, never lead.
    """
    routed = route.route_messages(decode.decode_messages(messages), settings)
    counted = routed.observe("accepted", F.count_if(F.col("route") == route.VALID).alias("inserted")).observe(
        "rejected",
        F.count_if(F.col("route") == route.VALIDATION).alias("invalid"),
        F.count_if(F.col("route") == route.PROCESSING).alias("dlq"),
    )
    run = run_of(messages.sparkSession, checkpoint)

    def batch(rows: DataFrame, batch_id: int) -> None:
        # Held as plain columns, so that each sink reads those it needs, and without
        # what keys known before need not carry.
        new = F.col("first.batch_time") == F.col("last.batch_time")
        names = ("topic", "partition", "offset", "event_time", "heart_rate", "raw", "error")
        marks = [F.col(f"last.{n}").alias(f"last_{n}") for n in ("topic", "partition", "offset")]
        kept = [F.when(new, c).alias(n) for n, c in [(n, F.col(n)) for n in ("event_id", "customer_id")] + [(n, F.col(f"first.{n}")) for n in names]]
        rows = rows.select("route", new.alias("new"), *kept, *marks).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            with adaptive(rows.sparkSession, messages.sparkSession):
                store(rows, Batch(run, batch_id))
        finally:
            rows.unpersist()

    def store(rows: DataFrame, this: Batch) -> None:
        spark = rows.sparkSession
        # Runs the state, once, in a task for each of its partitions. The sinks have
        # little to do for each; they read several in a task and share the cores.
        found = {r for r, in rows.where("new").select("route").distinct().collect()}  # three routes at most
        rows = rows.coalesce(2 * spark.sparkContext.defaultParallelism)
        fresh = rows.where("new").drop("new", "last_topic", "last_partition", "last_offset")
        jobs = [lambda e=e: sinks.publish_rejects(fresh, e, tables, this, settings) for e in (route.VALIDATION, route.PROCESSING) if e in found]
        if route.VALID in found:
            jobs.append(lambda: sinks.write_events(route.valid_events(fresh), tables, this))
        at_once(spark, jobs)
        met = rows.where(F.col("route") == route.VALID).select(*[F.col(f"last_{n}").alias(n) for n in ("topic", "partition", "offset")])
        sinks.upsert_checkpoint(spark, metrics.high_water_marks(met, settings.group_writer), tables, this)

    writer = _first_arrivals(counted).writeStream.outputMode("update").queryName(_query_name(settings.group_writer))
    with rocksdb_state(messages.sparkSession):
        return _start(writer.foreachBatch(batch), checkpoint, available_now, interval)


def start_detector(
    messages: DataFrame,
    tables: Tables,
    checkpoint: str,
    settings: Settings = DEFAULTS,
    available_now: bool = False,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Stream raw messages into the anomalies table and topic. Independent of
    the writer: it has its own checkpoint and reads the topic itself."""

    run = run_of(messages.sparkSession, checkpoint)

    def batch(rows: DataFrame, batch_id: int) -> None:
        with adaptive(rows.sparkSession, messages.sparkSession):
            pipeline.detect(rows.sparkSession, rows, tables, Batch(run, batch_id), settings)

    writer = messages.writeStream.queryName(_query_name(settings.group_detector))
    return _start(writer.foreachBatch(batch), checkpoint, available_now, interval)


def minute_counts(rows: DataFrame) -> DataFrame:
    """Rows per minute over a stream, for ``start_panel``."""
    return (
        rows.groupBy(F.window("event_time", "1 minute").alias("_window"))
        .agg(F.count(F.lit(1)).cast("double").alias("value"))
        .select(F.col("_window.start").alias("time"), "value")
    )


def start_panel(
    counts: DataFrame,
    path: str,
    key: Sequence[str],
    checkpoint: str,
    available_now: bool = False,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Keep a panel of a streaming aggregation (``minute_counts``,
    ``operators.metrics.throughput``) as a keyed table at ``path``.

    Every batch puts the intervals it changed in place of the old ones. There is
    no watermark: a late row amends its interval, the newest interval is there as
    soon as it has a row, and the table equals the batch panel over all rows read
    so far, however they were cut into batches. State and table hold one row per
    interval. Read the table with ``keyed.read``.
    """
    run = run_of(counts.sparkSession, checkpoint)

    def batch(rows: DataFrame, batch_id: int) -> None:
        with adaptive(rows.sparkSession, counts.sparkSession):
            keyed.upsert(rows.sparkSession, path, counts.schema, rows.hint("rebalance"), key, Batch(run, batch_id))

    return _start(counts.writeStream.outputMode("update").foreachBatch(batch), checkpoint, available_now, interval)


def start_table_panel(
    spark: SparkSession,
    table: Committed,
    counts: Callable[[DataFrame], DataFrame],
    path: str,
    key: Sequence[str],
    checkpoint: str,
    available_now: bool = False,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Keep a panel of a stored table by following its commits. ``counts`` makes
    rows of ``key`` and ``value`` of any part of the table, which are added up.

    The rows of new files are added, and those of files that a repeated batch has
    replaced are taken off again; compactions change nothing. A batch reads the new
    files and the panel rows they touch. Read the panel with ``read_panel``."""
    schema = counts(table.load(spark, [])).schema
    run = run_of(spark, checkpoint)

    def batch(commits: DataFrame, batch_id: int) -> None:
        spark, this = commits.sparkSession, Batch(run, batch_id)
        files = commits.where("writer IS NOT NULL").select("added.file", "removed").collect()
        new = counts(table.load(spark, [f for added, _ in files for f in added]))
        old = counts(table.load(spark, [f for _, removed in files for f in removed]))
        changes = new.unionByName(old.withColumn("value", -F.col("value"))).groupBy(*key).agg(F.sum("value").alias("_change")).persist()
        try:
            known = keyed.read(spark, path, schema, this, changes)
            updates = changes.join(known, list(key), "left").withColumn("value", F.coalesce("value", F.lit(0.0)) + F.col("_change"))
            keyed.upsert(spark, path, schema, updates, key, this)
        finally:
            changes.unpersist()

    return _start(table.changes(spark).writeStream.foreachBatch(batch), checkpoint, available_now, interval)


def read_panel(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A panel's rows; what has become nothing again is left out."""
    return keyed.read(spark, path, schema).where(F.col("value") != 0)
