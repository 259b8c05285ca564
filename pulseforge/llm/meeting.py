"""Numbered integer vectors, and blocks of rows that stream past a resident block."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseforge.llm.common import written

#: The id of a row that has none, in comparisons: after all others.
NO_ID = (1 << 63) - 1


def finite(vector: Column) -> Column:
    """Not null, and without a component that is null or not finite."""
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~wrong, F.lit(False))


def integers(vectors: DataFrame, factor: int, vector: str, vec_id: str, *more: Column) -> DataFrame:
    """Every row with a finite vector, written: ``row`` (a number of its own,
    negative for rows without id), ``id`` (``NO_ID`` for none), ``dim``, ``vector``
    (floor of ``factor`` times each component, as double) and ``more``.

    Components beyond sqrt(2^63 / dim) are held at about that, so that no inner
    product leaves 64 bits.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("_id"), F.col(vector).cast("array<double>").alias("_vector"), *more)
    rows = rows.where(finite(F.col("_vector"))).withColumn("dim", F.size("_vector"))
    most = F.floor(F.sqrt(F.lit(float(1 << 63)) / F.greatest("dim", F.lit(1)))) - 1
    whole = F.transform("_vector", lambda x: F.floor(F.least(F.greatest(x * F.lit(float(factor)), -most.cast("double")), most.cast("double"))))
    number = F.monotonically_increasing_id()
    names = [c for c in rows.columns if c not in ("_id", "_vector", "dim")]
    rows = rows.select(
        F.when(F.col("_id").isNull(), -number - 1).otherwise(number).alias("row"), F.coalesce("_id", F.lit(NO_ID)).alias("id"),
        "dim", whole.cast("array<long>").alias("vector"), *names,
    )
    return written(rows, "integer-vectors")


def matrix(table: pa.RecordBatch | pa.Table, name: str) -> np.ndarray:
    """A column of arrays of one length as a matrix."""
    column = table.column(name)
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)


def column(table: pa.RecordBatch | pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy() if isinstance(table, pa.Table) else table.column(name).to_numpy(zero_copy_only=False)


class Work:
    """What a task does with one block: ``start`` gets all resident rows, ``add``
    the streamed rows, batch by batch, ``end`` is called after the last."""

    def start(self, resident: pa.Table) -> None:
        raise NotImplementedError

    def add(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        raise NotImplementedError

    def end(self) -> Iterator[pa.RecordBatch]:
        return iter(())


def meet(resident: DataFrame, streamed: DataFrame, work: Callable[[], Work], schema: str, tasks: int) -> DataFrame:
    """Let the rows of ``streamed`` pass the rows of ``resident`` that have the same
    ``task``. Only a task's resident rows are held in memory, and the caller bounds
    them. Both have the same columns. A task without resident rows gives nothing,
    and neither does one without streamed rows."""
    names = resident.columns
    rows = resident.select(F.lit(0).alias("_side"), *names).unionByName(streamed.select(F.lit(1).alias("_side"), *names))
    rows = rows.repartition(tasks, "task").sortWithinPartitions("task", "_side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held, current = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            side, tasks_ = batch.column(0).to_numpy(), batch.column("task").to_numpy()
            edges = np.flatnonzero(np.append(True, (side[1:] != side[:-1]) | (tasks_[1:] != tasks_[:-1])))
            for a, b in zip(edges.tolist(), [*edges[1:].tolist(), batch.num_rows]):
                if tasks_[a] != task:
                    if current is not None:
                        yield from current.end()
                    task, held, current = tasks_[a], [], None
                part = batch.slice(a, b - a)
                if side[a] == 0:
                    held.append(part)
                    continue
                if held:
                    current = work()
                    current.start(pa.Table.from_batches(held))
                    held = []
                if current is not None:
                    yield from current.add(part)
        if current is not None:
            yield from current.end()

    return rows.mapInArrow(run, schema)
