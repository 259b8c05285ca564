"""Exact order statistics without sorting."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits that one pass settles: at most 2^BITS groups in an aggregation.
BITS = 16


def quantile(rows: DataFrame, value: Column, fraction: float, known: tuple | None = None) -> int | None:
    """The least whole value that at least ``fraction`` of all values do not exceed.

    Each pass counts the values still in question by their next ``BITS`` leading bits
    (combined before the shuffle, at most 2^BITS groups, whatever the number of rows)
    and keeps the group that holds the wanted rank: three passes for a range of 2^48.
    NULLs do not count; NULL where there are no values. The values' range must be
    below 2^62. ``known``: their least, greatest and count, if at hand.
    """
    rows = rows.select(value.cast("bigint").alias("_value")).where("_value IS NOT NULL")
    low, high, count = known or rows.agg(F.min("_value"), F.max("_value"), F.count("_value")).first()
    if not count:
        return None
    rank = max(1, ceil(fraction * count))
    passes = max(1, ceil((high - low).bit_length() / BITS))
    for shift in range(BITS * (passes - 1), -1, -BITS):
        above = F.col("_value") - F.lit(low)
        rows = rows.where((above >= 0) & (above < F.lit(1 << (shift + BITS))))
        groups = rows.groupBy(F.shiftright(above, shift).alias("_group")).agg(F.count(F.lit(1)).alias("_n"))
        upto = F.sum("_n").over(Window.orderBy("_group"))
        group, before = groups.withColumn("_upto", upto).where(F.col("_upto") >= rank).orderBy("_group").select("_group", F.col("_upto") - F.col("_n")).first()
        low, rank = low + (group << shift), rank - before
    return low
