"""A customer's preceding readings in one sorted pass, safe for hot customers.

A plain ``Window.partitionBy(customer)`` sends every reading of a customer to one
task. Here a customer's readings are cut into chunks of consecutive source offsets
and the window runs per (customer, chunk), so no task ever sorts more than ``chunk``
readings of one customer. What a chunk's first readings have to see of earlier chunks
is carried over: the last readings of every chunk are aggregated (one short row per
customer and chunk), put in order per customer, and joined to the chunk they precede.
The join keeps the window's partitioning and order, so that each reading is shuffled
and sorted once.

The rows are read twice, once to be aggregated: hand over stored or persisted ones.
The result equals the plain window's exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _tails(rows: DataFrame, place: list[str], value: str, depth: int) -> DataFrame:
    """The last ``depth`` values of each chunk, oldest first."""
    if depth == 1:  # a plain hash aggregate
        return rows.groupBy(*place).agg(F.array(F.max_by(value, "offset")).alias("_tail"))
    newest = Window.partitionBy(*place).orderBy(F.desc("offset"))
    last = rows.select(*place, "offset", value).withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= depth)
    ordered = F.sort_array(F.collect_list(F.struct("offset", value)))
    return last.groupBy(*place).agg(F.transform(ordered, lambda x: x[value]).alias("_tail"))


def with_recent(
    rows: DataFrame, output: str, depth: int, chunk: int, known: DataFrame | None = None, value: str = "heart_rate", key: str = "customer_id"
) -> DataFrame:
    """Add ``output``: up to ``depth`` values that precede a row among its key's rows
    by arrival (topic, partition, offset), oldest first. ``known`` has the last value
    of keys before all rows, if any; it meets one row for each key and chunk."""
    place = [key, "topic", "partition", "_cell"]
    rows = rows.withColumn("_cell", F.floor(F.col("offset") / F.lit(chunk)))
    earlier = Window.partitionBy(key).orderBy(*place[1:]).rowsBetween(-depth, -1)
    before = _last(F.flatten(F.collect_list("_tail").over(earlier)), depth)
    tails = _tails(rows, place, value, depth)
    if known is not None:  # nulls come first
        tails = tails.unionByName(known.select(key, F.array(value).alias("_tail")), allowMissingColumns=True)
    seeds = tails.withColumn("_before", before).drop("_tail").where(F.size("_before") > 0)
    inside = Window.partitionBy(*place).orderBy("offset").rowsBetween(-depth, -1)
    seen = rows.withColumn("_inside", F.collect_list(value).over(inside)).join(seeds, place, "left")
    recent = F.when(F.col("_before").isNull() | (F.size("_inside") == depth), F.col("_inside"))
    recent = recent.otherwise(_last(F.concat("_before", "_inside"), depth))
    return seen.select(*[c for c in rows.columns if c != "_cell"], recent.alias(output))


def _last(values, depth: int):
    return F.slice(values, F.greatest(F.size(values) - depth, F.lit(0)) + 1, depth)
