"""Approximate nearest neighbours by largest inner product.

Vectors are dealt to shards of bounded size. Each shard gets a directed graph: a
greedy search from the shard's centre proposes neighbours for every vector, and
relaxed distance pruning keeps those that no kept neighbour stands in for. A task
holds one shard, the queries stream past it, and a beam search follows the graph for
each. The best of all shards are merged.

One more coordinate makes all vectors of a shard equally long, so that nearness in
the graph is the inner product's order. Shards are dealt within bands of length, so
that a very long vector does not press the others of its shard together. Equal
vectors are indexed once. Scores are computed in double precision from the vectors
as they stand, and where that leaves the range of doubles from scaled ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseforge.llm.common import written
from pulseforge.llm.meeting import Work, meet

TOP = 20
DEGREE = 32
BUILD_BEAM = 96
BEAM = 128
RELAX = 1.2
#: Vectors, and bytes, of a shard; queries of a block.
SHARD_VECTORS = 8_192
SHARD_BYTES = 16 << 20
#: Queries that pass a shard in one task, and that are searched at once.
TASK_QUERIES = 65_536
AT_ONCE = 1_024
#: Powers of two that lengths within a band, counted from the longest vector, span.
BAND = 8
#: Tasks that shards are dealt to at most; a task then builds several.
MOST_TASKS = 20_000
_AT_ONCE = 4


def usable(vector: Column) -> Column:
    """Neither null, empty or zero, nor with a component that is null or not finite."""
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~wrong & F.exists(vector, lambda x: x != 0), F.lit(False))


def distances(x: np.ndarray, at: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances of each row of ``points`` to the vectors in its row of ``at``."""
    y = x[at]
    return np.einsum("qkd,qkd->qk", y, y) - 2 * np.einsum("qkd,qd->qk", y, points) + np.einsum("qd,qd->q", points, points)[:, None]


def beam_search(x: np.ndarray, graph: np.ndarray, start: int, points: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and squared distances of the nearest vectors met from ``start`` on,
    ascending, ``len(x)`` standing for none."""
    q, none = len(points), len(x)
    seen = np.zeros((q, none + 1), dtype=bool)
    seen[:, none] = True
    seen[:, start] = True
    found = np.full((q, width), none, dtype=np.int64)
    far = np.full((q, width), np.inf, dtype=np.float32)
    done = np.ones((q, width), dtype=bool)
    found[:, 0] = start
    far[:, 0] = distances(x, np.full((q, 1), start), points)[:, 0]
    done[:, 0] = False
    live, many = np.arange(q), min(_AT_ONCE, width)
    while len(live):
        # Follow the nearest vectors whose neighbours have not been seen.
        waiting = ~done[live]
        order = np.argsort(~waiting, axis=1, kind="stable")[:, :many]
        picked = np.take_along_axis(waiting, order, axis=1)
        rows = np.repeat(live, many).reshape(-1, many)
        done[rows[picked], order[picked]] = True
        from_ = np.where(picked, found[rows, order], none)
        to = np.where(from_[:, :, None] < none, graph[np.minimum(from_, none - 1)], none).reshape(len(live), -1)
        to.sort(axis=1)
        fresh = ~seen[live[:, None], to]
        fresh[:, 1:] &= to[:, 1:] != to[:, :-1]
        seen[live[:, None], to] = True
        i, j = np.nonzero(fresh)
        new = np.full(to.shape, np.inf, dtype=np.float32)
        y = x[to[i, j]] - points[live[i]]
        new[i, j] = np.einsum("nd,nd->n", y, y)
        ids = np.concatenate([found[live], np.where(fresh, to, none)], axis=1)
        dist = np.concatenate([far[live], new], axis=1)
        old = np.concatenate([done[live], ~fresh], axis=1)
        best = np.argpartition(dist, width - 1, axis=1)[:, :width]
        best = np.take_along_axis(best, np.argsort(np.take_along_axis(dist, best, axis=1), axis=1, kind="stable"), axis=1)
        found[live], far[live], done[live] = (np.take_along_axis(a, best, axis=1) for a in (ids, dist, old))
        live = live[(~done[live]).any(axis=1)]
    return found, far


def prune(x: np.ndarray, node: np.ndarray, candidate: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """For each node the nearest candidates such that none is much nearer to one
    kept before than to the node; ``len(x)`` stands for none."""
    none = len(x)
    candidate = np.sort(np.where(candidate == node[:, None], none, candidate), axis=1)
    candidate[:, 1:][candidate[:, 1:] == candidate[:, :-1]] = none
    # Seen from the node, so that vectors that lie close together stay apart.
    y = x[np.minimum(candidate, none - 1)] - x[node][:, None, :]
    far = np.einsum("nkd,nkd->nk", y, y)
    far[candidate == none] = np.inf
    order = np.argsort(far, axis=1, kind="stable")
    candidate, far = np.take_along_axis(candidate, order, axis=1), np.take_along_axis(far, order, axis=1)
    y = np.take_along_axis(y, order[:, :, None], axis=1)
    square = np.where(np.isfinite(far), far, 0)
    between = square[:, :, None] + square[:, None, :] - 2 * (y @ y.transpose(0, 2, 1))
    alive = np.isfinite(far)
    kept = np.full((len(node), degree), none, dtype=np.int64)
    every = np.arange(len(node))
    for k in range(degree):
        pick = alive.argmax(axis=1)
        some = alive[every, pick]
        if not some.any():
            break
        kept[:, k] = np.where(some, candidate[every, pick], none)
        stands_in = relax * relax * between[every, pick] <= far
        alive &= ~(stands_in & some[:, None])
        alive[every, pick] = False
    return kept


def build(x: np.ndarray, degree: int = DEGREE, width: int = BUILD_BEAM, relax: float = RELAX, seed: int = 3) -> tuple[np.ndarray, int]:
    """The graph over ``x`` (rows of neighbours, ``len(x)`` for none) and its start."""
    n = len(x)
    rng = np.random.default_rng(seed)
    start = int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())
    graph = np.full((n, degree + degree // 2), n, dtype=np.int64)
    if n == 1:
        return graph, start
    graph[:, :8] = rng.integers(0, n, (n, 8))
    order = rng.permutation(n)
    for at in range(0, n, 512):
        node = order[at:at + 512]
        near, _ = beam_search(x, graph, start, x[node], width)
        graph[node, :degree] = prune(x, node, np.concatenate([near, graph[node]], axis=1), degree, relax)
        graph[node, degree:] = n
        _link_back(x, graph, node, degree, relax)
    return graph, start


def _link_back(x: np.ndarray, graph: np.ndarray, node: np.ndarray, degree: int, relax: float) -> None:
    """Let the nodes' neighbours point back; a list that overflows is pruned."""
    n, room = len(x), graph.shape[1]
    to, source = graph[node, :degree].ravel(), np.repeat(node, degree)
    to, source = to[to < n], source[to < n]
    order = np.argsort(to, kind="stable")
    to, source = to[order], source[order]
    target, first, count = np.unique(to, return_index=True, return_counts=True)
    graph[target] = np.sort(graph[target], axis=1)
    used = (graph[target] < n).sum(axis=1)
    fits = used + count <= room
    place = np.arange(len(to)) - np.repeat(first, count) + np.repeat(used, count)
    simple = np.repeat(fits, count)
    graph[to[simple], place[simple]] = source[simple]
    # Targets with about as many new links are pruned together.
    for low, high in ((1, 8), (9, 64), (65, n)):
        some = np.flatnonzero(~fits & (count >= low) & (count <= high))
        for at in range(0, len(some), 256):
            part = some[at:at + 256]
            new = np.full((len(part), count[part].max()), n, dtype=np.int64)
            for row, k in enumerate(part):
                new[row, :count[k]] = source[first[k]:first[k] + count[k]]
            graph[target[part], :degree] = prune(x, target[part], np.concatenate([graph[target[part]], new], axis=1), degree, relax)
            graph[target[part], degree:] = n


def _build_shard(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    dim, shard = (k.as_py() for k in key)
    vectors = table["vector"].combine_chunks().flatten().to_numpy()
    graph, start = build(_longer(vectors.reshape(-1, dim)))
    packed = (table["row"].to_numpy(), table["vec_id"].to_numpy(), vectors, graph.astype(np.int32))
    blobs = [pa.array([x.tobytes()], pa.binary()) for x in packed]
    return pa.table([pa.array([dim], pa.int32()), pa.array([shard], pa.int32()), *blobs, pa.array([start], pa.int32())], names=["dim", "shard", "rows", "ids", "vectors", "graph", "start"])


def scaled(vectors: np.ndarray, by_row: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The vectors over a power of two, and its exponent, by which the largest
    component (of each row, or of all) is at least one half and less than one."""
    largest = np.abs(vectors).max(axis=1 if by_row else None, keepdims=True)
    power = np.frexp(largest)[1].astype(np.int32)
    return np.ldexp(vectors, -power), power


def _longer(vectors: np.ndarray) -> np.ndarray:
    vectors = scaled(vectors)[0]
    square = (vectors**2).sum(axis=1)
    return (np.column_stack([vectors, np.sqrt(square.max() - square)]) / np.sqrt(square.max())).astype(np.float32)


def products(vectors: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inner products of rows as mantissas (0, or from one half to below one, with
    their sign) and exponents of two; no product overflows."""
    with np.errstate(over="ignore", invalid="ignore"):
        plain = np.einsum("nd,nd->n", vectors, queries)
    mantissa, power = np.frexp(plain)
    beyond = np.flatnonzero(~np.isfinite(plain) | (np.abs(plain) < 1e-280))
    if len(beyond):
        (v, a), (q, b) = scaled(vectors[beyond], True), scaled(queries[beyond], True)
        mantissa[beyond], more = np.frexp(np.einsum("nd,nd->n", v, q))
        power[beyond] = np.where(mantissa[beyond] == 0, 0, more + a[:, 0] + b[:, 0])
    return mantissa, power


def level(mantissa: np.ndarray, power: np.ndarray) -> np.ndarray:
    """A number that orders products of different sign or exponent as they are."""
    return (np.sign(mantissa) * (power + 10_000)).astype(np.int32)


class _Search(Work):
    """Beam search of queries in one shard."""

    def __init__(self, top: int, beam: int):
        self.top, self.beam = top, beam

    def start(self, resident: pa.Table) -> None:
        row = resident.to_pylist()[0]
        self.rows, self.ids = (np.frombuffer(row[n], dtype=np.int64) for n in ("rows", "ids"))
        self.vectors = np.frombuffer(row["vectors"]).reshape(len(self.rows), -1)
        self.graph = np.frombuffer(row["graph"], dtype=np.int32).reshape(len(self.rows), -1)
        self.points, self.first = _longer(self.vectors), row["start"]

    def add(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at in range(0, rows.num_rows, AT_ONCE):
            part = rows.slice(at, AT_ONCE)
            queries = part.column("vector").flatten().to_numpy().reshape(part.num_rows, -1)
            yield self._some(part.column("row").to_numpy(), queries)

    def _some(self, own: np.ndarray, queries: np.ndarray) -> pa.RecordBatch:
        n = len(self.rows)
        points = scaled(queries, True)[0]
        points = np.column_stack([points, np.zeros(len(points))]) / np.sqrt((points**2).sum(axis=1, keepdims=True))
        found = wide_search(self.points, self.graph, self.first, points.astype(np.float32), min(self.beam, n), self.top)
        i, j = np.nonzero(found < n)
        mantissa, power = np.zeros(found.shape), np.zeros(found.shape, dtype=np.int32)
        mantissa[i, j], power[i, j] = products(self.vectors[found[i, j]], queries[i])
        levels = np.where(found < n, level(mantissa, power), np.int32(-(1 << 30)))
        ids = self.ids[np.minimum(found, n - 1)]
        best = np.lexsort((ids, -mantissa, -levels), axis=1)[:, :self.top]
        mantissa, power, levels, found = (np.take_along_axis(a, best, axis=1) for a in (mantissa, power, levels, found))
        i, j = np.nonzero(found < n)
        with np.errstate(over="ignore"):
            scores = np.ldexp(mantissa[i, j], power[i, j])
        return pa.record_batch({
            "query": pa.array(own[i]), "rep": pa.array(self.rows[found[i, j]]), "score": pa.array(scores),
            "level": pa.array(levels[i, j]), "mantissa": pa.array(mantissa[i, j]),
        })


def wide_search(x: np.ndarray, graph: np.ndarray, start: int, points: np.ndarray, width: int, top: int) -> np.ndarray:
    """Beam search that widens its beam for queries whose last hits tie with the
    ``top``-th, until all ties are in it: ids decide among ties, not the beam."""
    found, far = beam_search(x, graph, start, points, width)
    while width < len(x):
        edge = far[:, min(top, width) - 1]
        tied = np.flatnonzero(np.isfinite(far[:, -1]) & (far[:, -1] <= edge + 1e-5 * np.maximum(edge, 1)))
        if not len(tied):
            break
        width = min(4 * width, len(x))
        wide, distance = np.full((len(points), width), len(x), dtype=found.dtype), np.full((len(points), width), np.inf, dtype=far.dtype)
        wide[:, :found.shape[1]], distance[:, :found.shape[1]] = found, far
        for at in range(0, len(tied), 64):
            some = tied[at:at + 64]
            wide[some], distance[some] = beam_search(x, graph, start, points[some], width)
        found, far = wide, distance
    return found


def dealt_to(sizes: DataFrame) -> int:
    """The number of shards of all dimensions."""
    return sizes.agg(F.coalesce(F.sum("shards"), F.lit(0))).first()[0]


def search(vectors: DataFrame, is_query: Column, top: int = TOP, beam: int = BEAM, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """The ``top`` nearest found for each query: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Candidates are all usable vectors (see ``usable``) but the query itself; only
    vectors of the query's dimension. A score beyond the range of doubles is
    infinite, but ranked by its size. Rows without id take no part; rows that share
    an id are queries and candidates each. Nearest first, ties to the smaller id;
    all candidates if there are fewer than ``top``. Of equal vectors the ``top``
    + 1 smallest ids are enough for any query; those are kept, so that any number
    of copies is searched exactly as one. An empty table gives no rows.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    rows = written(rows.withColumn("dim", F.size("vector")).withColumn("row", F.monotonically_increasing_id()), "vectors")
    in_class = Window.partitionBy("vector").orderBy("vec_id", "row")
    members = rows.withColumn("_n", F.row_number().over(in_class)).where(F.col("_n") <= top + 1)
    members = written(members.withColumn("rep", F.first("row").over(in_class)), "classes")

    distinct = members.where("_n = 1")
    # The logarithm of the length, by the largest component, as squares may overflow.
    largest = F.array_max(F.transform("vector", F.abs))
    length = F.log2("_largest") + F.log2(F.aggregate("vector", F.lit(0.0), lambda a, x: a + (x / F.col("_largest")) * (x / F.col("_largest")))) / 2
    distinct = distinct.withColumn("_largest", largest).withColumn("_length", length)
    longest = distinct.groupBy("dim").agg(F.max("_length").alias("_longest"))
    distinct = distinct.join(F.broadcast(longest), "dim").withColumn("band", F.floor((F.col("_longest") - F.col("_length")) / BAND).cast("int"))
    per_shard = F.greatest(F.lit(256), F.least(F.lit(SHARD_VECTORS), F.lit(SHARD_BYTES) / (8 * F.col("dim"))))
    # One short row per dimension and band; the shards of a dimension are numbered through.
    bands = distinct.groupBy("dim", "band").agg(F.count("*").alias("_all")).withColumn("_shards", F.ceil(F.col("_all") / per_shard).cast("int"))
    before = Window.partitionBy("dim").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    bands = written(bands.select("dim", "band", "_shards", F.coalesce(F.sum("_shards").over(before), F.lit(0)).cast("int").alias("_first")), "bands")
    sizes = bands.groupBy("dim").agg(F.sum("_shards").cast("int").alias("shards")).withColumn("_size", per_shard.cast("int"))
    shard = (F.col("_first") + F.pmod(F.xxhash64("row"), F.col("_shards"))).cast("int").alias("shard")
    dealt = distinct.join(F.broadcast(bands), ["dim", "band"]).select("dim", shard, "row", "vec_id", "vector")
    # A small table is one partition to Spark, but each shard is a long piece of work.
    spark = rows.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(MOST_TASKS, dealt_to(sizes)))
    dealt = dealt.repartition(tasks, "dim", "shard")
    graphs = dealt.groupBy("dim", "shard").applyInArrow(_build_shard, "dim int, shard int, rows binary, ids binary, vectors binary, graph binary, start int")
    graphs = written(graphs, "graphs")

    # Every query goes to every shard of its dimension; a shard is loaded once for
    # each ``TASK_QUERIES`` of them.
    asked = rows.where(is_query)
    parts = asked.groupBy("dim").agg(F.ceil(F.count("*") / TASK_QUERIES).cast("int").alias("parts")).join(sizes, "dim").select("dim", "shards", "parts")
    parts = written(parts, "parts")
    task = F.xxhash64("dim", "shard", "part").alias("task")
    blob = ("rows", "ids", "vectors", "graph", "start")
    held = graphs.join(parts, "dim").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    held = held.select(task, F.lit(None).cast("long").alias("row"), F.lit(None).cast("array<double>").alias("vector"), *blob)
    asking = asked.join(parts, "dim").withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"))
    asking = asking.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    asking = asking.select(task, "row", "vector", *[F.lit(None).cast(held.schema[n].dataType).alias(n) for n in blob])
    schema = "query long, rep long, score double, level int, mantissa double"
    found = meet(held, asking, lambda: _Search(top + 1, beam), schema, tasks)

    hits = found.join(members.select("rep", "row", "vec_id"), "rep").where("query != row")
    nearest = Window.partitionBy("query").orderBy(F.col("level").desc(), F.col("mantissa").desc(), "vec_id", "row")
    hits = hits.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= top)
    named = rows.where(is_query).select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"))
    return hits.join(named, "query").select("query_id", "rank", "vec_id", "score")


def op10_graph_neighbours(spark, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector."""
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)
