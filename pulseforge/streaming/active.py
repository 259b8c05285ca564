"""Exact distinct customers in sliding windows, from changes instead of copies.

A window is as wide as ``k`` slides. A reading in slide ``c`` makes its customer active
in the windows that end after slides ``c`` to ``c + k - 1``, up to the customer's next
reading, which goes on from there. So each reading adds one at its slide, and takes one
off again ``k`` slides later or at the customer's next slide, whichever comes first. The
running sum of these changes is the number of distinct customers in every window; no
reading is copied into the windows it lies in.

A late reading only changes where the reading before it ends and where it ends itself.
A batch therefore needs the customers' slides within ``k`` of its own: they are stored
by day and read for those days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pulseforge.session import adaptive
from pulseforge.sources import keyed
from pulseforge.sources.batch import Batch, run_of
from pulseforge.sources.committed import Committed, entry

#: (customer, slide) pairs seen, by the day of the slide.
SEEN = T.StructType([T.StructField("customer_id", T.StringType()), T.StructField("slide", T.LongType()), T.StructField("day", T.DateType())])
#: By how much the number of active customers changes after a slide.
CHANGES = T.StructType([T.StructField("slide", T.LongType()), T.StructField("change", T.LongType())])
#: Slides that one task sums up.
SPAN = 1_440


def changes(known: DataFrame, new: DataFrame, k: int) -> DataFrame:
    """``slide``, ``change``: what the pairs of ``new`` (``customer_id``, ``slide``; none
    of them in ``known``) add to the changes of those in ``known``."""
    both = known.select("customer_id", "slide", F.lit(True).alias("_known"))
    both = both.unionByName(new.select("customer_id", "slide", F.lit(False).alias("_known")))
    order = Window.partitionBy("customer_id").orderBy("slide")
    after = order.rowsBetween(1, Window.unboundedFollowing)
    end = lambda following: F.least(F.col("slide") + k, F.coalesce(following, F.col("slide") + k))
    both = both.withColumn("_end", end(F.lead("slide").over(order)))
    both = both.withColumn("_was", F.when(F.col("_known"), end(F.min(F.when(F.col("_known"), F.col("slide"))).over(after))))
    change = lambda at, by: F.struct(at.alias("slide"), F.lit(by).cast("bigint").alias("change"))
    begun = F.array(change(F.col("slide"), 1), change(F.col("_end"), -1))
    moved = F.array(change(F.col("_was"), 1), change(F.col("_end"), -1))
    rows = both.where(~F.col("_known") | (F.col("_was") != F.col("_end")))
    rows = rows.select(F.explode(F.when(F.col("_known"), moved).otherwise(begun)).alias("c")).select("c.*")
    return rows.groupBy("slide").agg(F.sum("change").alias("change"))


def counts(changes: DataFrame, seconds: int) -> DataFrame:
    """``time`` (a window's end), ``value``: active customers in each window with any.

    Changes are summed in spans of ``SPAN`` slides; the spans' totals, one row each, are
    summed on their own and added. A count stands until the next change."""
    rows = changes.where("change != 0").withColumn("_span", F.floor(F.col("slide") / SPAN))
    spans = rows.groupBy("_span").agg(F.sum("change").alias("_sum"), F.min("slide").alias("_first"))
    order = Window.orderBy("_span")
    spans = spans.select(
        "_span", F.coalesce(F.sum("_sum").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.lead("_first").over(order).alias("_next"),
    )
    inside = Window.partitionBy("_span").orderBy("slide")
    rows = rows.join(spans, "_span")
    rows = rows.withColumn("_count", F.sum("change").over(inside) + F.col("_before"))
    rows = rows.withColumn("_until", F.coalesce(F.lead("slide").over(inside), "_next")).where("_count > 0")
    rows = rows.withColumn("slide", F.explode(F.sequence("slide", F.col("_until") - 1)))
    return rows.select(F.timestamp_seconds((F.col("slide") + 1) * seconds).alias("time"), F.col("_count").cast("double").alias("value"))


def _seconds(interval: str) -> int:
    return int(SparkSession.active().sql(f"SELECT unix_seconds(timestamp_seconds(0) + INTERVAL '{interval}')").first()[0])


def seen_pairs(rows: DataFrame, seconds: int) -> DataFrame:
    return rows.select("customer_id", F.floor(F.unix_micros("event_time") / (seconds * 1_000_000)).alias("slide"))


def start_active_customers(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    width: str = "10 minutes",
    slide: str = "1 minute",
    available_now: bool = False,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Keep the distinct customers of every sliding window under ``path``; late rows
    amend their windows. The state store holds each (customer, slide) once. Read the
    panel with ``read_active``."""
    from pulseforge.streaming.queries import _start

    seconds = _seconds(slide)
    if seconds < 1 or _seconds(width) % seconds:
        raise ValueError("the width must be a whole number of slides")
    k = _seconds(width) // seconds
    run = run_of(rows.sparkSession, checkpoint)
    table = Committed(f"{path}/seen", SEEN, "day")

    def batch(new: DataFrame, batch_id: int) -> None:
        with adaptive(new.sparkSession, rows.sparkSession):
            keep(new, Batch(run, batch_id))

    def keep(new: DataFrame, this: Batch) -> None:
        spark = new.sparkSession
        day = lambda slide: F.timestamp_seconds(slide * seconds).cast("date")
        # The pairs are used more than once. They are read back from their files, which
        # count from the commit at the end on: a plan that has the stream's own frame
        # twice would run its state again, persisted or not.
        added = table.put(new.withColumn("day", day(F.col("slide"))).hint("rebalance", F.col("day")).sortWithinPartitions("day", "customer_id"))
        if not added:
            return
        new = table.load(spark, [a["file"] for a in added])
        low, high = new.agg(day(F.min("slide") - k).cast("string"), day(F.max("slide") + k).cast("string")).first()
        known = table.read(spark, this, low, high).join(new.select("customer_id").distinct(), "customer_id", "left_semi")
        changed = changes(known, new, k).persist()
        try:
            old = keyed.read(spark, f"{path}/changes", CHANGES, this, changed).withColumnRenamed("change", "_old")
            updates = changed.join(old, "slide", "left").select("slide", (F.col("change") + F.coalesce("_old", F.lit(0))).alias("change"))
            keyed.upsert(spark, f"{path}/changes", CHANGES, updates, ("slide",), this)
        finally:
            changed.unpersist()
        table.commit(spark, lambda state: entry(this, added, state.of(this)))

    pairs = seen_pairs(rows, seconds).dropDuplicates(["customer_id", "slide"])
    return _start(pairs.writeStream.foreachBatch(batch), checkpoint, available_now, interval)


def read_active(spark: SparkSession, path: str, slide: str = "1 minute") -> DataFrame:
    """The panel: ``time`` (a window's end) and ``value``, for windows with customers."""
    return counts(keyed.read(spark, f"{path}/changes", CHANGES), _seconds(slide))
