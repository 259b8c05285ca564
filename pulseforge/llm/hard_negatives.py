"""Hard negatives: rows of another label that score nearly as high as a positive.

Anchors lie in blocks; all candidates stream past each block in tiles. The integer
scores of a tile are one matrix product by Strassen's recursion, in 64-bit integers
with zero padding. Every block keeps heaps that merge: of each anchor the positives
of highest score, and of each anchor and positive the negatives of highest score
inside the window that the positive's score sets. The heaps of a block's tasks are
merged at the end.

Positives come first, from candidates of the anchor's label alone; their scores set
the windows of a second pass over all candidates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseforge.llm.common import written
from pulseforge.llm.heaps import Heaps
from pulseforge.llm.meeting import Work, column, integers, matrix, meet

POSITIVES = 5
NEGATIVES = 3
FACTOR = 256
#: Anchors, and bytes of them, in a block; candidates that pass a block in one task.
BLOCK_ANCHORS = 16_384
BLOCK_BYTES = 16 << 20
RUN = 8_192
#: Rows of a tile on both sides; the side below which products are plain.
TILE = 1_024
PLAIN = 32
MOST_TASKS = 20_000


def strassen(a: np.ndarray, b: np.ndarray, plain: int = PLAIN) -> np.ndarray:
    """``a @ b.T`` for 64-bit integers by seven products of halves. Odd sides get a
    row or column of zeros. Sums may wrap around on the way; the result is exact
    wherever it fits 64 bits, as wrapping keeps sums and products modulo 2^64."""
    (m, d), n = a.shape, len(b)
    if min(m, n, d) < 2 * plain:
        return a @ b.T
    a, b = (np.pad(x, ((0, len(x) % 2), (0, d % 2))) for x in (a, b))
    i, j, k = len(a) // 2, len(b) // 2, a.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :k], a[:i, k:], a[i:, :k], a[i:, k:]
    # Of the transposed b: the rows of b are its columns.
    b11, b12, b21, b22 = b[:j, :k], b[j:, :k], b[:j, k:], b[j:, k:]
    p1 = strassen(a11 + a22, b11 + b22, plain)
    p2 = strassen(a21 + a22, b11, plain)
    p3 = strassen(a11, b12 - b22, plain)
    p4 = strassen(a22, b21 - b11, plain)
    p5 = strassen(a11 + a12, b22, plain)
    p6 = strassen(a21 - a11, b11 + b12, plain)
    p7 = strassen(a12 - a22, b21 + b22, plain)
    out = np.empty((2 * i, 2 * j), dtype=np.int64)
    out[:i, :j] = p1 + p4 - p5 + p7
    out[:i, j:] = p3 + p5
    out[i:, :j] = p2 + p4
    out[i:, j:] = p1 - p2 + p3 + p6
    return out[:m, :n]


class _Tiles(Work):
    """Products of a block's anchors with the candidates, tile by tile."""

    def start(self, resident: pa.Table) -> None:
        self.anchors, self.own = matrix(resident, "vector"), column(resident, "row")
        self.label = column(resident, "label")
        self.resident = resident

    def add(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at in range(0, rows.num_rows, TILE):
            part = rows.slice(at, TILE)
            vectors, ids, row, label = matrix(part, "vector"), column(part, "id"), column(part, "row"), column(part, "label")
            for low in range(0, len(self.own), TILE):
                some = slice(low, min(low + TILE, len(self.own)))
                self.tile(some, strassen(self.anchors[some], vectors), ids, row, label)
        return iter(())

    def tile(self, some: slice, score: np.ndarray, ids: np.ndarray, row: np.ndarray, label: np.ndarray) -> None:
        raise NotImplementedError


class _Positives(_Tiles):
    def __init__(self, top: int):
        self.top = top

    def start(self, resident: pa.Table) -> None:
        super().start(resident)
        self.heaps = Heaps(len(self.own), self.top)

    def tile(self, some, score, ids, row, label) -> None:
        owners = np.arange(some.start, some.stop)
        i, j = np.nonzero(self.heaps.improve(owners, score, ids) & (row != self.own[some][:, None]))
        self.heaps.merge(i + some.start, score[i, j], ids[j], row[j])

    def end(self) -> Iterator[pa.RecordBatch]:
        h = self.heaps
        yield pa.record_batch({"anchor": pa.array(self.own[h.owner]), "row": pa.array(h.row), "id": pa.array(h.ids), "score": pa.array(h.score)})


class _Negatives(_Tiles):
    def __init__(self, top: int):
        self.top = top

    def start(self, resident: pa.Table) -> None:
        super().start(resident)
        lists = resident.column("windows").combine_chunks()
        self.count = lists.value_lengths().to_numpy(zero_copy_only=False)
        flat = lists.flatten()
        self.owner = np.repeat(np.arange(len(self.own)), self.count)
        self.first = np.cumsum(self.count) - self.count
        self.place, self.low, self.high = (flat.field(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("rank", "low", "high"))
        self.heaps = Heaps(len(self.owner), self.top)

    def tile(self, some, score, ids, row, label) -> None:
        other = label != self.label[some][:, None]
        for k in range(int(self.count[some].max(initial=0))):
            has = np.flatnonzero(self.count[some] > k)
            window = self.first[some][has] + k
            s = score[has]
            inside = (s >= self.low[window][:, None]) & (s <= self.high[window][:, None])
            i, j = np.nonzero(other[has] & inside & self.heaps.improve(window, s, ids))
            self.heaps.merge(window[i], s[i, j], ids[j], row[j])

    def end(self) -> Iterator[pa.RecordBatch]:
        h = self.heaps
        yield pa.record_batch({
            "anchor": pa.array(self.own[self.owner[h.owner]]), "place": pa.array(self.place[h.owner].astype(np.int32)),
            "row": pa.array(h.row), "id": pa.array(h.ids), "score": pa.array(h.score),
        })


def _dealt(anchors: DataFrame, rows: DataFrame, per: list[str], work, schema: str, windows: bool) -> DataFrame:
    """All anchors meet all rows that agree with them in ``per``."""
    per_block = F.greatest(F.lit(1), F.least(F.lit(BLOCK_ANCHORS), F.floor(F.lit(BLOCK_BYTES) / (8 * F.greatest("dim", F.lit(1)))))).alias("_per")
    blocks = anchors.groupBy(*per).agg(F.count("*").alias("_n"), F.first(per_block).alias("_per"))
    blocks = blocks.select(*per, F.ceil(F.col("_n") / F.col("_per")).cast("int").alias("blocks"))
    sizes = rows.groupBy(*per).agg(F.ceil(F.count("*") / RUN).cast("int").alias("runs")).join(blocks, per)
    sizes = written(sizes, "blocks")
    task = F.xxhash64(*per, "block", "run").alias("task")
    names = ["row", "id", "label", "vector"] + (["windows"] if windows else [])
    deal = lambda seed, parts: F.pmod(F.xxhash64("row", F.lit(seed)), F.col(parts)).cast("int")
    count = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    held = anchors.join(sizes, per).withColumn("block", deal(1, "blocks")).withColumn("run", count("runs"))
    passing = rows.join(sizes, per).withColumn("run", deal(2, "runs")).withColumn("block", count("blocks"))
    if windows:
        passing = passing.withColumn("windows", F.lit(None).cast(anchors.schema["windows"].dataType))
    in_all = sizes.agg(F.coalesce(F.sum(F.col("runs") * F.col("blocks")), F.lit(0))).first()[0]
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(MOST_TASKS, in_all))
    return meet(held.select(task, *names), passing.select(task, *names), work, schema, tasks)


def _ranked(hits: DataFrame, top: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "id", "row")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def mine(
    vectors: DataFrame, is_anchor: Column, label: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
    low: int = 50, high: int = 95, factor: int = FACTOR, vector: str = "embedding", vec_id: str = "vec_id",
) -> DataFrame:
    """``negatives`` hard negatives for each anchor and each of its ``positives``:
    ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    A component x counts as floor(``factor`` * x); a row's score is its inner product
    with the anchor. Positives are the other rows of the anchor's label of highest
    score; negatives are those rows of any other label of highest score for which
    low * positive_score <= 100 * negative_score <= high * positive_score. Ties go to
    the smaller id; all rows if there are fewer; no row where there is none. Only
    rows with vectors of the anchor's length count. Rows that share an id count each.
    Rows without id are no anchors, and come after all others (their ids are null).
    Rows with a null label, a null vector, or a null or non-finite component take no
    part. Components beyond sqrt(2^63 / dimension) are held at that. An empty table
    gives no rows.
    """
    rows = vectors.withColumn("_label", label.cast("long")).where("_label is not null")
    rows = integers(rows, factor, vector, vec_id, F.coalesce(is_anchor, F.lit(False)).alias("asked"), F.col("_label").alias("label"))
    anchors = rows.where(F.col("asked") & (F.col("row") >= 0))
    found = _dealt(anchors, rows, ["dim", "label"], lambda: _Positives(positives), "anchor long, row long, id long, score long", False)
    found = written(_ranked(found, positives, "anchor"), "positives")

    # Bounds in whole numbers; parts of a hundred first, so that nothing overflows.
    part = lambda percent, rounded: (F.expr(f"{percent} * (score div 100)") + rounded(F.expr(f"{percent} * (score % 100)") / 100)).cast("long")
    windows = found.select("anchor", "rank", part(low, F.ceil).alias("low"), part(high, F.floor).alias("high"))
    windows = windows.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "low", "high"))).alias("windows"))
    asked = anchors.join(windows.withColumnRenamed("anchor", "row"), "row")
    hits = _dealt(asked, rows, ["dim"], lambda: _Negatives(negatives), "anchor long, place int, row long, id long, score long", True)
    hits = _ranked(hits, negatives, "anchor", "place")
    hits = hits.select("anchor", "place", "rank", _named("id", "row", "negative_id"), F.col("score").alias("negative_score"))
    found = found.select("anchor", F.col("rank").alias("place"), _named("id", "row", "positive_id"), F.col("score").alias("positive_score"))
    out = hits.join(found, ["anchor", "place"]).join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _named(ids: str, row: str, name: str) -> Column:
    return F.when(F.col(row) >= 0, F.col(ids)).alias(name)


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector; where the id is divisible by 7, the
    label counts as the next one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0, label)
