"""Best-fit packing planned over a histogram of lengths."""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulseforge.llm import tokens
from pulseforge.llm.common import blocks, written

SIZE = 1024
_SALTS = 1 << 20

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, _salt int"
_PLAN = "plan_length long, from_rank long, to_rank long, per_sequence long, first_sequence long, offset long"


def pieces(docs: DataFrame, size: int = SIZE, with_ids: bool = False) -> DataFrame:
    """Each document's ids and end token, cut into pieces of ``size`` ids; the
    first piece of a longer document holds what is left over. ``_salt`` spreads
    equal pieces evenly."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder()
        end = np.array([tokens.END_ID], dtype="<u4")
        salts = itertools.cycle(range(_SALTS))
        for batch, column in blocks(batches, "text"):
            keys, rows = batch.column(0).to_pylist(), []
            for key, text in zip(keys, column.to_pylist()):
                ids = np.concatenate([encoder.ids(text), end])
                edges = [0, *range(len(ids) % size or size, len(ids) + 1, size)] if len(ids) > size else [0, len(ids)]
                for i, (a, b) in enumerate(zip(edges, edges[1:])):
                    raw = ids[a:b].tobytes()
                    rows.append((key, i, a, b - a, zlib.crc32(raw), raw if with_ids else None, next(salts)))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32())
            names = ("doc_id", "piece", "start", "length", "ids_crc32", "ids", "_salt")
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, _PIECES)
    return out if with_ids else out.drop("ids")


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit over counts, longest pieces first.

    A run of equal sequences is (first number, how many, room left). Pieces of
    one length go to the runs with the least room that still fits, as many per
    sequence as fit, then to new sequences. Each row of the result says that
    pieces of ``length`` with ranks ``from_rank`` to ``to_rank`` stand
    ``per_sequence`` to a sequence from ``first_sequence`` on, the first at
    ``offset``. Work and result depend on ``size``, not on the number of pieces.
    """
    runs: dict[int, list[tuple[int, int]]] = {}
    rows: list[tuple[int, int, int, int, int, int]] = []
    sequences = 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        for room in [r for r in sorted(runs) if r >= length]:
            if not left:
                break
            waiting, runs[room] = runs.pop(room), []
            for first, many in waiting:
                first, many, left, rank = _fill(rows, runs, length, size - room, room, first, many, left, rank)
                if many:
                    runs.setdefault(room, []).append((first, many))
            if not runs[room]:
                del runs[room]
        if left:
            many = -(-left // (size // length))
            _fill(rows, runs, length, 0, size, sequences, many, left, rank)
            sequences += many
    return rows


def _fill(rows, runs, length, offset, room, first, many, left, rank):
    """Put up to ``left`` pieces into a run; returns what remains of the run, the
    pieces left and the next rank."""
    per = room // length
    full = min(many, left // per)
    used = [(full, per)] if full else []
    if full < many and left - full * per:
        used.append((1, left - full * per))
    for n, each in used:
        rows.append((length, rank, rank + n * each, each, first, offset))
        rest = room - each * length
        if rest:
            runs.setdefault(rest, []).append((first, n))
        first, many, left, rank = first + n, many - n, left - n * each, rank + n * each
    return first, many, left, rank


def assign(placed: DataFrame, size: int = SIZE) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to the rows of ``pieces``, which must be a stored
    table.

    The driver gets one count per length. A row's rank within its length is its
    rank in one of many hashed cells of the length plus the counts of earlier
    cells, so that no length, however common, is sorted in one task.
    """
    spark = placed.sparkSession
    counts = {int(r[0]): int(r[1]) for r in placed.groupBy("length").count().collect()}
    planned = spark.createDataFrame(plan(counts, size), _PLAN)
    cells = max(int(spark.conf.get("spark.sql.shuffle.partitions")), sum(counts.values()) // 500_000)
    rows = placed.withColumn("_cell", F.col("_salt") % cells)
    earlier = Window.partitionBy("length").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("length", "_cell").agg(F.count("*").alias("_n"))
    before = before.select("length", "_cell", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    local = Window.partitionBy("_cell", "length").orderBy("_salt", "doc_id", "piece", "ids_crc32")
    ranked = rows.withColumn("_rank", F.row_number().over(local) - 1).join(before, ["length", "_cell"])
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_before"))
    # The plan has a few rows per length up to ``size``, whatever the input.
    in_row = (F.col("length") == F.col("plan_length")) & (F.col("_rank") >= F.col("from_rank")) & (F.col("_rank") < F.col("to_rank"))
    joined = ranked.join(F.broadcast(planned), in_row)
    step = F.col("_rank") - F.col("from_rank")
    within = F.pmod(step, F.col("per_sequence"))
    return joined.select(
        *[c for c in placed.columns if c != "_salt"],
        (F.col("first_sequence") + ((step - within) / F.col("per_sequence")).cast("long")).alias("sequence_id"),
        (F.col("offset") + within * F.col("length")).alias("offset"),
    )


def pack(docs: DataFrame, size: int = SIZE, with_ids: bool = False) -> DataFrame:
    """Pack all documents into as few sequences of at most ``size`` ids as best
    fit finds, one row per piece.

    A null or empty text has its end token alone. Rows with the same or a null
    ``doc_id`` are packed each on its own. An empty table gives no rows.
    ``with_ids`` adds the ids themselves (little-endian 32-bit).
    """
    return assign(written(pieces(docs, size, with_ids), "pieces"), size)


def op3_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 tokens."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
