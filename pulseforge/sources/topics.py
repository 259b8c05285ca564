"""Topics as files: messages with a partition and gapless offsets, as a broker gives
them, so that a published topic can be read like any raw source.

A message's partition comes from its key's hash. Its offset is the partition's next
offset so far, plus the messages of the batch before it: those of earlier tasks, by
sums over one count per task and partition, and those of its own task. No task ever
sorts a whole partition. The next offsets stand in the topic's commits; if another
batch commits first, the offsets are dealt again from where that one ended.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulseforge.schema import RAW_MESSAGE
from pulseforge.sources import log
from pulseforge.sources.batch import Batch
from pulseforge.sources.committed import Committed, entry


def _placed(messages: DataFrame, partitions: int) -> DataFrame:
    """Messages with their partition, task and place in the task."""
    if "key" not in messages.columns:
        messages = messages.withColumn("key", F.lit(None).cast("string"))
    partition = F.pmod(F.xxhash64(F.coalesce("key", "value")), F.lit(partitions)).cast("int")
    return messages.select("key", "value", partition.alias("_partition"), F.spark_partition_id().alias("_task"), F.monotonically_increasing_id().alias("_place"))


def _dealt(placed: DataFrame, topic: str, first: dict[str, int]) -> DataFrame:
    """The messages in the raw layout."""
    earlier = Window.partitionBy("_partition").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("_partition", "_task").agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.select("_partition", "_task", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    base = F.from_json(F.lit(json.dumps(first)), "MAP<STRING, BIGINT>")[F.col("_partition").cast("string")]
    own = F.row_number().over(Window.partitionBy("_partition", "_task").orderBy("_place")) - 1
    offset = F.coalesce(base, F.lit(0)) + F.col("_before") + F.col("_own")
    return (
        placed.withColumn("_own", own)
        .join(starts, ["_partition", "_task"])
        .select("key", "value", F.lit(topic).alias("topic"), F.col("_partition").alias("partition"), offset.alias("offset"), F.current_timestamp().alias("timestamp"))
        .sortWithinPartitions("partition", "offset")
        .select(*RAW_MESSAGE.names)
    )


def publish(messages: DataFrame, table: Committed, topic: str, batch: Batch, partitions: int) -> None:
    """Append the messages to the topic, once for each batch: a batch that has been
    published before adds nothing, as its messages have their offsets already."""
    spark = messages.sparkSession
    if table.state(spark).of(batch):
        return
    # Written first, so that tasks and places stay as they are.
    aside = f"{table.path}/aside/{uuid.uuid4().hex}"
    placed = _placed(messages, partitions)
    placed.write.parquet(aside)
    placed = spark.read.schema(placed.schema).parquet(aside)
    many = {str(p): n for p, n in placed.groupBy("_partition").count().collect()}  # a row for each partition
    while many:
        first = table.state(spark).next
        added = table.put(_dealt(placed, topic, first))
        after = first | {p: first.get(p, 0) + n for p, n in many.items()}
        if table.commit(spark, lambda now: entry(batch, added, [], next=after) if now.next == first else None):
            break
    log.remove(spark, aside)
