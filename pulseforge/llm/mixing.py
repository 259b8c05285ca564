"""Mix sources to target weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseforge.llm.common import WORD, pick, unit_hash, written

WEIGHTS = (3.0, 1.0, 2.0)
BUDGET = 1.5
REPEATS = 2.0

#: Documents above this share of their source are drawn together, so that one
#: of them does not decide how near the source comes to its target.
LARGE_SHARE = 0.001
#: Sources (one short row each) that are sent to every executor.
BROADCAST_SOURCES = 100_000


def targets(totals: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, repeats: float = REPEATS) -> DataFrame:
    """``source``, ``source_size`` -> also ``target``.

    Sources in code point order, null last, take the weights in turn. ``budget``
    times all sizes is shared by weight; a source gets at most ``repeats`` times
    its size, and what is over is shared again until none is above. That ends
    where every source has the lesser of its limit and one common level times
    its weight, so sources are put in order of limit per weight; the first whose
    limit reaches the level of those left has the level (the levels fall after it). Works on one row per source.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.row_number().over(in_order) - 1, F.lit(len(weights))).cast("int") + 1)
    limit = F.col("source_size") * F.lit(float(repeats))
    rows = totals.withColumn("_weight", weight).withColumn("_limit", limit).withColumn("_ratio", F.col("_limit") / F.col("_weight"))
    whole = Window.partitionBy()
    before = Window.orderBy("_ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    shared = F.sum("source_size").over(whole) * F.lit(float(budget))
    limited = F.coalesce(F.sum("_limit").over(before), F.lit(0.0))
    left = F.sum("_weight").over(whole) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    rows = rows.withColumn("_level", (shared - limited) / left)
    level = F.max(F.when(F.col("_ratio") >= F.col("_level"), F.col("_level"))).over(whole)
    # No level: every source stands at its limit.
    return rows.select("source", "source_size", F.coalesce(F.least("_limit", level * F.col("_weight")), F.col("_limit")).alias("target"))


def _key(*names: str) -> Column:
    """A hash that tells null from empty."""
    return F.xxhash64(*[c for n in names for c in (F.col(n).isNull(), F.col(n))])


def _counted(rows: DataFrame, mark: list[Column]) -> DataFrame:
    """``rows`` of ids that several rows of a source share, with ``_more``: of rows
    equal in id and text floor or ceil of the fraction, from one hashed start.

    Equal rows are numbered within the partition they are read in, and those
    counts are summed, so that no task has to hold them all."""
    rows = rows.withColumn("_equal", _key("source", "doc_id", "text")).withColumn("_at", F.spark_partition_id())
    rows = written(rows, "rows-of-repeated-ids")
    # Written, as partitions may be others when computed again.
    before = Window.partitionBy("_equal").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("_equal", "_at").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    within = Window.partitionBy("_equal", "_at").orderBy("doc_id")
    rows = rows.join(counts, ["_equal", "_at"]).withColumn("_place", F.row_number().over(within) + F.col("_before"))
    text = F.md5(F.col("text").cast("binary"))
    step = F.col("_place") * F.col("_part") + unit_hash(*mark, F.col("doc_id").cast("string"), text)
    rows = rows.withColumn("_more", F.floor(step) > F.floor(step - F.col("_part")))
    return rows.drop("_equal", "_at", "_before", "_place")


def _drawn(rows: DataFrame, weights: Sequence[float], budget: float, repeats: float, seed: int) -> DataFrame:
    """``rows`` (``doc_id``, ``text``, ``source`` and what else is to be carried)
    with ``size``, ``source_size``, ``target``, ``copies``."""
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))
    rows = rows.withColumn("size", size)
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = written(targets(totals, weights, budget, repeats), "targets").withColumnRenamed("source", "_source")
    # Texts are shuffled by source only if there are too many sources to send out.
    goals = F.broadcast(goals) if goals.count() <= BROADCAST_SOURCES else goals
    rows = rows.join(goals, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = rows.withColumn("_whole", F.floor(rate)).withColumn("_part", rate - F.floor(rate))
    mark = [F.lit(str(seed)), F.col("source")]
    large = F.col("size") > F.col("source_size") * F.lit(LARGE_SHARE)
    alone = rows.where(~large)
    again = written(rows.groupBy("source", "doc_id").agg(F.count("*").alias("_rows")).where("_rows > 1").select(_key("source", "doc_id").alias("_again")), "repeated-ids")
    many = again.count()
    if many:
        again = F.broadcast(again.distinct()) if many <= BROADCAST_SOURCES else again.distinct()
        alone = alone.join(again, _key("source", "doc_id") == F.col("_again"), "left")
        shared = _counted(alone.where("_again IS NOT NULL").drop("_again"), mark)
        alone = alone.where("_again IS NULL").drop("_again")
    alone = alone.withColumn("_more", unit_hash(*mark, F.col("doc_id").cast("string")) < F.col("_part"))
    alone = alone.unionByName(shared) if many else alone
    by_size = Window.partitionBy("source").orderBy(F.col("size").desc(), "doc_id", F.md5(F.col("text").cast("binary")))
    step = F.row_number().over(by_size) * F.col("_part") + unit_hash(*mark)
    together = rows.where(large).withColumn("_more", F.floor(step) > F.floor(step - F.col("_part")))
    return alone.unionByName(together).withColumn("copies", F.col("_whole") + F.col("_more").cast("long"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, repeats: float = REPEATS, seed: int = 7) -> DataFrame:
    """What every row gives to the mixture: ``doc_id``, ``source``, ``size``,
    ``source_size``, ``target``, ``copies``.

    The size is the number of words (null text: 0). A source's rate is its target
    over its size; a document is taken floor(rate) times, and once more with the
    probability of the fraction. That draw is a hash of the seed, the source and
    the doc_id, so reruns agree. Where several rows of a source share an id (or have
    none), the text's hash is drawn with, and of n rows equal in id and text floor or
    ceil of n times the fraction are taken. Documents above ``LARGE_SHARE`` of their source
    (at most 1 / LARGE_SHARE of them) are drawn one after another by size from one
    hashed start, each with the same probability, which keeps the source near its
    target although few documents may hold most of its words. Null sources are one
    source, null ids one id; repeated rows count each; extra columns are left out.
    A source without words takes nothing; an empty table gives no rows.
    """
    rows = _drawn(pick(docs, "doc_id", "text", "source"), weights, budget, repeats, seed)
    return rows.select("doc_id", "source", "size", "source_size", "target", "copies")


def emit(docs: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, repeats: float = REPEATS, seed: int = 7) -> DataFrame:
    """The mixture itself: the rows of ``docs``, all columns, as often as they are
    taken (see ``mix``)."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text", "source")
    rows = _drawn(rows, weights, budget, repeats, seed).where("copies > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def op4_mix_sources(spark, sf_dir: str) -> DataFrame:
    """What each document gives to the mixture of all sources."""
    rows = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
