"""The two consumers of the raw topic, for one batch of messages.

Both are called with a whole bounded input (a backfill) or with one micro-batch
(see ``pulseforge.streaming``). Data is written first and the table that
records progress last; every write is known by the writer's run and the batch, so
repeating a batch after a failure gives the same tables as running it once, and no
other run or batch is touched. A call without ``batch`` is a run of its own.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseforge.config import DEFAULTS, Settings
from pulseforge.operators import anomalies, decode, route
from pulseforge.schema import LAST_READING
from pulseforge.sources import keyed, sinks
from pulseforge.sources.batch import Batch
from pulseforge.sources.tables import Tables


def ingest(
    spark: SparkSession,
    messages: DataFrame,
    tables: Tables,
    batch: Batch | None = None,
    settings: Settings = DEFAULTS,
    staging: str | None = None,
    **options: bool,
) -> dict[str, int]:
    """Writer: validate, quarantine, insert, advance the checkpoint. Returns
    the batch's counters.

    The routed messages feed four sinks and are decoded once. They are held in
    executor memory and disk or, given a ``staging`` folder on shared storage
    (for inputs too large to hold), written there by route and read back.
    """
    batch = batch or Batch.new()
    routed = route.route_messages(decode.decode_messages(messages), settings)
    if staging:
        routed.write.mode("overwrite").partitionBy("route").parquet(staging)
        routed = spark.read.schema(routed.schema).parquet(staging)
    else:
        routed = routed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counters = route.route_counters(routed).first().asDict()
        sinks.publish_quarantine(routed, tables, batch, settings)
        sinks.insert_events(spark, route.valid_events(routed), tables, batch, **options)
        sinks.upsert_checkpoint(spark, sinks.high_water_marks(routed, settings), tables, batch)
    finally:
        if not staging:
            routed.unpersist()
    return counters


def detect(
    spark: SparkSession,
    messages: DataFrame,
    tables: Tables,
    batch: Batch | None = None,
    settings: Settings = DEFAULTS,
    staging: str | None = None,
) -> None:
    """Detector: flag anomalies, store and publish them, keep last readings.

    Readings and anomalies are used more than once. They are held in executor memory
    and disk or, given a ``staging`` folder on shared storage (for inputs too large to
    hold), written there and read back.

    A customer's first reading in the batch takes its predecessor from the last
    readings stored by earlier batches, of which only those of the batch's customers
    are read.
    """
    batch = batch or Batch.new()
    arrival = F.struct("topic", "partition", "offset")
    held: list[DataFrame] = []

    def hold(rows: DataFrame, name: str) -> DataFrame:
        if staging:
            rows.write.mode("overwrite").parquet(f"{staging}/{name}")
            return spark.read.schema(rows.schema).parquet(f"{staging}/{name}")
        held.append(rows.persist(StorageLevel.MEMORY_AND_DISK))
        return held[-1]

    try:
        readings = hold(decode.schema_valid(decode.decode_messages(messages)), "readings")
        # Only the buckets in which the batch's customers lie are read.
        known = tables.read_last_readings(spark, before=batch, keys=readings)
        linked = anomalies.with_previous_rate(readings, settings, known)
        found = hold(anomalies.flag_anomalies(linked, settings), "anomalies")
        sinks.append_anomalies(found, tables, batch)
        sinks.publish_anomalies(found, tables, batch, settings)
        latest = readings.groupBy("customer_id").agg(F.max_by("heart_rate", arrival).alias("heart_rate"))
        keyed.upsert(spark, tables.last_readings, LAST_READING, latest, ("customer_id",), batch)
    finally:
        for rows in held:
            rows.unpersist()
