"""Stored tables: where they are, how they are read and written.

Events, anomalies and topics are files that commits name (``committed``), events and
anomalies by date: ``event_date=D`` is the outermost folder, so readers prune by date.
Rows are clustered by customer inside each file, so the row-group statistics serve
look-ups of one customer. Checkpoints and last readings are keyed (``keyed``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseforge.config import ANOMALIES_TABLE, CHECKPOINT_TABLE, EVENTS_TABLE
from pulseforge.schema import ANOMALY, CHECKPOINT, LAST_READING, RAW_MESSAGE, STORED_EVENT
from pulseforge.sources import keyed
from pulseforge.sources.archive import Archive
from pulseforge.sources.batch import Batch
from pulseforge.sources.committed import Committed
from pulseforge.sources.history import History

CLUSTER = ("customer_id", "event_time")


@dataclass(frozen=True)
class Tables:
    """The tables under one root folder of shared storage."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def events(self) -> Committed:
        return Committed(self.path(EVENTS_TABLE), STORED_EVENT, "event_date")

    @property
    def history(self) -> History:
        """The keys of all stored events."""
        return History(self.path("event_keys"), self.events)

    @property
    def anomalies(self) -> Committed:
        return Committed(self.path(ANOMALIES_TABLE), ANOMALY, "event_date")

    @property
    def checkpoint(self) -> str:
        return self.path(CHECKPOINT_TABLE)

    @property
    def last_readings(self) -> str:
        return self.path("last_readings")

    @property
    def archive(self) -> Archive:
        """Raw messages by source partition and offset."""
        return Archive(self.path("raw_archive"))

    def topic(self, name: str) -> Committed:
        return Committed(self.path(f"topics/{name}"), RAW_MESSAGE)

    def read_events(self, spark: SparkSession) -> DataFrame:
        return self.events.read(spark)

    def read_anomalies(self, spark: SparkSession) -> DataFrame:
        return self.anomalies.read(spark)

    def read_topic(self, spark: SparkSession, name: str) -> DataFrame:
        return self.topic(name).read(spark)

    def read_checkpoint(self, spark: SparkSession) -> DataFrame:
        return keyed.read(spark, self.checkpoint, CHECKPOINT)

    def read_last_readings(self, spark: SparkSession, before: Batch | None = None, keys: DataFrame | None = None) -> DataFrame:
        return keyed.read(spark, self.last_readings, LAST_READING, before, keys)

    def register_views(self, spark: SparkSession) -> None:
        """Make the tables available to ``spark.sql`` under their own names."""
        self.read_events(spark).createOrReplaceTempView(EVENTS_TABLE)
        self.read_anomalies(spark).createOrReplaceTempView(ANOMALIES_TABLE)
        self.read_checkpoint(spark).createOrReplaceTempView(CHECKPOINT_TABLE)


def write_batch(rows: DataFrame, table: Committed, batch: Batch) -> None:
    """Write one batch of a dated table, in place of an earlier attempt.

    ``rebalance`` lets adaptive execution merge small output partitions and
    split a date, or a hot share of one, over several tasks: files come out of
    even size, with few dates per task."""
    named = rows.withColumns({"run": F.lit(batch.run), "batch_id": F.lit(batch.number).cast("long")})
    table.write(named.hint("rebalance", F.col("event_date")).sortWithinPartitions("event_date", *CLUSTER), batch)
