"""Exact top-k search by largest integer inner product: ball trees and bounds.

Vectors are dealt to shards of bounded size. In a task, a shard becomes a ball tree.
No inner product of a query with the vectors of a ball exceeds the one with its
centre by more than the query's length times the radius. Each query follows the
nodes in the order of this bound, and stops where the bound no longer reaches its
current k-th hit.

Queries see their shards in rounds of one, then seven, then 56 shards and so on.
After each round the k best hits so far are written, and the next round's searches
begin at the k-th score of those, so that later shards are mostly cut off early.
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

TOP = 10
FACTOR = 1024
#: Vectors, and bytes, of a shard; vectors of a leaf; queries that a shard serves in one task, and at once.
SHARD_VECTORS = 8_192
SHARD_BYTES = 16 << 20
LEAF = 256
TASK_QUERIES = 65_536
AT_ONCE = 1_024
#: Rounds see 1, GROWTH - 1, GROWTH^2 - GROWTH ... shards.
GROWTH = 8
#: Tasks at most that shards are dealt to; a task then serves several.
MOST_TASKS = 20_000

_LEAST = -(1 << 63)
_HITS = "query long, query_id long, row long, id long, score long"


class BallTree:
    """Nodes of balanced halves: ``low`` and ``high`` (rows), ``centre``, ``radius``,
    ``first`` (the least id below), ``child`` (the left child, 0 for a leaf; the
    right one follows it)."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, leaf: int):
        x = vectors.astype(np.float64)
        self.order = np.argsort(ids, kind="stable")
        low, high, child = [0], [len(x)], [0]
        at = 0
        while at < len(low):
            a, b = low[at], high[at]
            if b - a > leaf:
                rows = self.order[a:b]
                y = x[rows]
                one = y[((y - y.mean(axis=0)) ** 2).sum(axis=1).argmax()]
                other = y[((y - one) ** 2).sum(axis=1).argmax()]
                self.order[a:b] = rows[np.argsort(y @ (other - one), kind="stable")]
                middle = (a + b) // 2
                child[at] = len(low)
                low += [a, middle]
                high += [middle, b]
                child += [0, 0]
            at += 1
        self.low, self.high, self.child = np.array(low), np.array(high), np.array(child)
        x = x[self.order]
        self.centre = np.array([x[a:b].mean(axis=0) for a, b in zip(low, high)]).reshape(len(low), -1)
        self.radius = np.array([np.sqrt(((x[a:b] - c) ** 2).sum(axis=1).max()) for a, b, c in zip(low, high, self.centre)])
        self.first = np.array([ids[self.order[a:b]].min() for a, b in zip(low, high)])

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """No inner product of a query (row) with a node's vectors is larger. All
        products are whole numbers, so the bound, with room for rounding, is too."""
        q = queries.astype(np.float64)
        length = np.sqrt((q**2).sum(axis=1))[:, None]
        reach = np.sqrt((self.centre**2).sum(axis=1)) + self.radius
        return np.floor(q @ self.centre.T + length * self.radius + 1e-9 * length * reach)


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where all sums stay below 2^53, else in
    64-bit integers."""
    if not queries.size or not vectors.size:
        return np.zeros((len(queries), len(vectors)), dtype=np.int64)
    if float(np.abs(queries).max()) * float(np.abs(vectors).max()) * queries.shape[1] < 2.0**53:
        return (queries.astype(np.float64) @ vectors.astype(np.float64).T).astype(np.int64)
    return queries @ vectors.T


class _Search(Work):
    def __init__(self, top: int, leaf: int):
        self.top, self.leaf = top, leaf

    def start(self, resident: pa.Table) -> None:
        vectors, ids = matrix(resident, "vector"), column(resident, "id")
        self.tree = BallTree(vectors, ids, self.leaf)
        order = self.tree.order
        self.vectors, self.ids, self.rows = vectors[order], ids[order], column(resident, "row")[order]

    def add(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at in range(0, rows.num_rows, AT_ONCE):
            yield self._some(rows.slice(at, AT_ONCE))

    def _some(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        tree, queries, own = self.tree, matrix(batch, "vector"), column(batch, "row")
        # The k-th hit so far: only what is better counts.
        kth, kth_id = column(batch, "kth"), column(batch, "kth_id")
        bound = tree.bounds(queries)
        waiting = np.full(bound.shape, -np.inf)
        waiting[:, 0] = bound[:, 0]
        heaps = Heaps(len(queries), self.top)
        alive = np.arange(len(queries))
        while True:
            node = waiting[alive].argmax(axis=1)
            most = waiting[alive, node]
            on = most >= kth[alive]
            alive, node, most = alive[on], node[on], most[on]
            if not len(alive):
                break
            waiting[alive, node] = -np.inf
            # Where the bound only equals the k-th score, smaller ids count.
            visit = (most > kth[alive]) | (tree.first[node] < kth_id[alive])
            query, node = alive[visit], node[visit]
            child = tree.child[node]
            inner = child > 0
            for side in (0, 1):
                waiting[query[inner], child[inner] + side] = bound[query[inner], child[inner] + side]
            query, node = query[~inner], node[~inner]
            new = [self._leaf(queries, query[node == k], k, kth, kth_id, own) for k in np.unique(node)]
            if not new:
                continue
            query, place, score = (np.concatenate([n[i] for n in new]) for i in range(3))
            heaps.merge(query, score, self.ids[place], self.rows[place])
            kth, kth_id = (np.where(kth > heaps.least, old, now) for old, now in ((kth, heaps.least), (kth_id, heaps.least_id)))
        return pa.record_batch({
            "query": pa.array(own[heaps.owner]), "query_id": pa.array(column(batch, "id")[heaps.owner]), "row": pa.array(heaps.row),
            "id": pa.array(heaps.ids), "score": pa.array(heaps.score),
        })

    def _leaf(self, queries, some, node, kth, kth_id, own) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b = self.tree.low[node], self.tree.high[node]
        score = products(queries[some], self.vectors[a:b])
        limit = kth[some][:, None]
        good = (score > limit) | ((score == limit) & (self.ids[a:b] < kth_id[some][:, None]))
        good &= self.rows[a:b] != own[some][:, None]
        i, j = np.nonzero(good)
        return some[i], j + a, score[i, j]


def _best(hits: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "id", "row")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(vectors: DataFrame, is_query: Column, top: int = TOP, factor: int = FACTOR, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """The ``top`` highest integer inner products of each query: ``query_id``,
    ``rank``, ``vec_id``, ``score``.

    A component x counts as floor(``factor`` * x). Candidates are all rows but the
    query's own whose vector is finite and has the query's length (empty ones and
    zeros score 0). Highest first, ties to the smaller id; all candidates if there
    are fewer than ``top``. Rows that share an id are queries and candidates each;
    rows without id are candidates only (``vec_id`` null, after all others). Rows
    with a null vector, or a null or non-finite component, take no part. Components
    beyond sqrt(2^63 / dimension) are held at that. An empty table gives no rows.
    """
    rows = integers(vectors, factor, vector, vec_id, F.coalesce(is_query, F.lit(False)).alias("asked"))
    per_shard = F.greatest(F.lit(LEAF), F.least(F.lit(SHARD_VECTORS), F.lit(SHARD_BYTES) / (8 * F.greatest("dim", F.lit(1)))))
    sizes = rows.groupBy("dim").agg(F.count("*").alias("_all"), F.count_if("asked").alias("_asked"))
    sizes = written(sizes.select("dim", "_asked", F.ceil(F.col("_all") / per_shard).cast("int").alias("shards")), "shards")
    most, asked_in_all, in_all = sizes.agg(F.max("shards"), F.sum("_asked"), F.sum("shards")).first()
    if not asked_in_all:
        return rows.where("false").select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.col("id").alias("score"))
    spark = rows.sparkSession
    placed = rows.join(sizes, "dim").withColumn("shard", F.pmod(F.xxhash64("row"), F.col("shards")).cast("int"))
    best: DataFrame | None = None
    first, after = 0, 1
    while first < most:
        seen = F.least(F.lit(after), F.col("shards")) - first
        # A shard serves about as many queries as there are shards in a round.
        parts = F.greatest(F.ceil(F.col("_asked") * seen / F.col("shards") / TASK_QUERIES), F.lit(1)).cast("int")
        asked = placed.where(F.col("asked") & (F.col("shards") > first)).withColumn("part", F.pmod(F.xxhash64("row", F.lit(1)), parts).cast("int"))
        offsets = F.sequence(F.lit(first), F.least(F.lit(after), F.col("shards")) - 1)
        asked = asked.withColumn("_offset", F.explode(offsets)).withColumn("shard", F.pmod(F.col("shard") + F.col("_offset"), F.col("shards")))
        if best is None:
            asked = asked.withColumns({"kth": F.lit(_LEAST), "kth_id": F.lit(0).cast("long")})
        else:
            kth = best.where(F.col("rank") == top).select(F.col("query").alias("row"), F.col("score").alias("kth"), F.col("id").alias("kth_id"))
            asked = asked.join(kth, "row", "left").withColumns({"kth": F.coalesce("kth", F.lit(_LEAST)), "kth_id": F.coalesce("kth_id", F.lit(0).cast("long"))})
        held = placed.where(F.col("shards") > first).withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
        held = held.withColumns({"kth": F.lit(None).cast("long"), "kth_id": F.lit(None).cast("long")})
        task = F.xxhash64("dim", "shard", "part").alias("task")
        names = ("row", "id", "vector", "kth", "kth_id")
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(MOST_TASKS, in_all))
        found = meet(held.select(task, *names), asked.select(task, *names), lambda: _Search(top, LEAF), _HITS, tasks)
        if best is not None:
            found = found.unionByName(best.drop("rank"))
        best = written(_best(found, top), "hits")
        first, after = after, after * GROWTH
    return best.select("query_id", "rank", F.when(F.col("row") >= 0, F.col("id")).alias("vec_id"), "score")


def op13_ball_tree_search(spark, sf_dir: str) -> DataFrame:
    """The 10 highest of every hundredth vector."""
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)
