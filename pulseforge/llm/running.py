"""Running sums over an ordered integer key without one task for all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def suffix_sums(df: DataFrame, key: str, sums: dict[str, str], width: int = 4096) -> DataFrame:
    """Add, for each ``{column: name}``, the sum of ``column`` over all rows whose
    ``key`` is at least the row's. ``key`` is a distinct non-negative integer.
    Sums run inside cells of ``width`` keys; the cells' totals (one row per
    ``width`` keys) are summed on their own and added."""
    cell = F.floor(F.col(key) / width)
    within = Window.partitionBy("_cell").orderBy(F.col(key).desc())
    after = Window.orderBy(F.col("_cell").desc()).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("_cell", cell)
    cells = rows.groupBy("_cell").agg(*[F.sum(c).alias(c) for c in sums])
    cells = cells.select("_cell", *[F.coalesce(F.sum(c).over(after), F.lit(0)).alias(f"_after_{c}") for c in sums])
    rows = rows.join(cells, "_cell")
    return rows.select(*df.columns, *[(F.sum(c).over(within) + F.col(f"_after_{c}")).alias(name) for c, name in sums.items()])
