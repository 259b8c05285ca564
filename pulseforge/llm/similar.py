"""Similarity join of documents by the Jaccard similarity of their word n-grams.

MinHash LSH forest with exact verification. Documents with equal n-gram sets are
one node. A signature of ``TREES * LENGTH`` minima is cut into ``TREES`` strings;
sorted, the strings of one tree are a prefix trie. Matched prefixes begin at full
length and are shortened until documents at the threshold share one in some tree
with the target probability. Nodes with a common prefix and similar sketches are
tied into clusters; within a cluster all similarities are computed exactly.

No list of pairs is made. Inside a cluster, tasks take blocks of nodes against
blocks of nodes and return, for each node, its number of links and one tie to the
least node it is connected with. Common prefixes and clusters of any size are cut
into blocks, so that a group that holds a third of the corpus is spread over
tasks, and blocks hold a bounded number of nodes and n-grams.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseforge.llm.common import Words, binary_rows, blocks, mix, written
from pulseforge.llm.components import components

NGRAM = 5
THRESHOLD = 0.8
RECALL = 0.9999
TREES = 20
LENGTH = 5
#: Standard deviations below the threshold at which a sketch still ties.
MARGIN = 4.0

#: Nodes, and n-grams, of a block. Two blocks meet in a task.
BLOCK_NODES = 512
BLOCK_GRAMS = 2_000_000
BUCKET_NODES = 2_048
#: Id that stands for null.
NO_ID = (1 << 63) - 1

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def row_key(doc_id: Column, text: Column) -> list[Column]:
    """What a document row is known by: its id (null last) and its text's hash."""
    return [F.coalesce(doc_id.cast("long"), F.lit(NO_ID)).alias("_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("_th")]


def prefix_length(threshold: float, recall: float, trees: int = TREES, length: int = LENGTH) -> int:
    """The longest prefix that finds pairs at the threshold with this probability:
    prefixes are shortened from full length until they do. ValueError if even the
    shortest does not."""
    for n in range(length, 0, -1):
        if 1 - (1 - threshold**n) ** trees >= recall:
            return n
    raise ValueError(f"{trees} trees do not find pairs at {threshold} with probability {recall}")


def gram_sets(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each text's word n-grams in ascending order, and where
    each text's begin. A shorter text has one n-gram, of all its words."""
    count = words.count
    whole = words.whole(n)
    values, owner = words.grams(n)[whole], words.text_of()[:len(whole)][whole]
    for few in range(1, n):
        at = np.flatnonzero(count == few)
        if len(at):
            h = np.full(len(at), few, dtype=np.uint64)
            for i in range(few):
                h = mix(h * _GOLDEN + words.hash[words.doc[at] + i])
            values, owner = np.append(values, h), np.append(owner, at)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.append(True, (values[1:] != values[:-1]) | (owner[1:] != owner[:-1]))[:len(values)]
    values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(len(count) + 1))


def signatures(values: np.ndarray, start: np.ndarray, size: int, seed: int = 11) -> np.ndarray:
    """``size`` minima of each set; of an empty set all bits."""
    out = np.full((len(start) - 1, size), np.iinfo(np.uint64).max, dtype=np.uint64)
    full = np.flatnonzero(np.diff(start))
    if len(full):
        rng = np.random.default_rng(seed)
        for k, (a, b) in enumerate(rng.integers(1, 1 << 63, (size, 2), dtype=np.uint64)):
            out[full, k] = np.minimum.reduceat((values ^ b) * (a | np.uint64(1)), start[full])
    return out


def _sign(docs: DataFrame, ngram: int, depth: int) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, column in blocks(batches, "text"):
            values, start = gram_sets(Words(column), ngram)
            minima = signatures(values, start, TREES * LENGTH)
            size = np.diff(start)
            raw = values.tobytes()
            names = [hashlib.md5(raw[8 * a:8 * b]).digest() for a, b in zip(start[:-1].tolist(), start[1:].tolist())]
            keys = np.zeros((len(column), TREES), dtype=np.uint64)
            for tree in range(TREES):
                h = np.full(len(column), tree, dtype=np.uint64)
                for i in range(depth):
                    h = mix(h * _GOLDEN + minima[:, tree * LENGTH + i])
                keys[:, tree] = h
            ends = pa.array(np.arange(0, keys.size + 1, TREES, dtype=np.int32))
            yield pa.record_batch({
                "_id": batch.column(0), "_th": batch.column(1), "node": pa.array(names, pa.binary()), "grams": pa.array(size.astype(np.int64)),
                "sketch": binary_rows((minima >> np.uint64(40)).astype(np.uint8), TREES * LENGTH),
                "keys": pa.ListArray.from_arrays(ends, pa.array(keys.view(np.int64).ravel())),
            })

    return docs.mapInArrow(sign, "_id long, _th long, node binary, grams long, sketch binary, keys array<long>")


def _against(rows: DataFrame, parts: Column) -> DataFrame:
    """Deal rows to pairs of blocks (``lo``, ``hi``) of their group."""
    rows = rows.withColumn("_parts", parts.cast("int")).withColumn("block", F.pmod(F.xxhash64("node"), F.col("_parts")).cast("int"))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    return rows.withColumn("lo", F.least("block", "_other")).withColumn("hi", F.greatest("block", "_other")).drop("_other")


def _tables(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], limit: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Batches sorted by ``keys`` -> tables of whole groups, of about ``limit``
    rows if their groups are smaller, with each row's group number."""
    waiting: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        waiting = table if waiting is None else pa.concat_tables([waiting, table])
        if waiting.num_rows >= limit:
            group = _group_numbers(waiting, keys)
            to = int(np.searchsorted(group, group[-1]))
            if to:
                yield waiting.slice(0, to), group[:to]
                waiting = waiting.slice(to)
    if waiting is not None and waiting.num_rows:
        yield waiting, _group_numbers(waiting, keys)


def _group_numbers(table: pa.Table, keys: tuple[str, ...]) -> np.ndarray:
    new = np.zeros(table.num_rows, dtype=bool)
    for key in keys:
        values = table[key].combine_chunks().dictionary_encode()
        index = (values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values).indices.to_numpy()
        new[1:] |= index[1:] != index[:-1]
    return np.cumsum(new)


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least number each of ``n`` numbers is connected with by pairs."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    while not np.array_equal(root, root[root]):
        root = root[root]
    return root


def _tie(rows: DataFrame, least: float) -> DataFrame:
    """Nodes in one bucket with similar sketches -> ties to the bucket's roots."""
    size = TREES * LENGTH

    def tie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in _tables(batches, ("key", "lo", "hi"), 4_000):
            sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), dtype=np.uint8).reshape(-1, size)
            block = table["block"].to_numpy()
            apart = table["lo"].to_numpy() != table["hi"].to_numpy()
            firsts, seconds = [], []
            for step in range(1, int(np.bincount(group).max())):
                at = np.flatnonzero(group[step:] == group[:-step])
                at = at[~apart[at] | (block[at] != block[at + step])]
                if len(at):
                    at = at[(sketch[at] == sketch[at + step]).sum(axis=1) >= least]
                    firsts.append(at)
                    seconds.append(at + step)
            if firsts:
                root = roots(len(group), np.concatenate(firsts), np.concatenate(seconds))
                tied = np.flatnonzero(root != np.arange(len(root)))
                node = table["node"].combine_chunks()
                yield pa.record_batch({"u": node.take(pa.array(tied)), "v": node.take(pa.array(root[tied]))})

    ordered = rows.select("key", "lo", "hi", "block", "node", "sketch").repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    return ordered.mapInArrow(tie, "u binary, v binary")


def overlaps(values: np.ndarray, start: np.ndarray, width: int = 4_096) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets."""
    n = len(start) - 1
    if n == 2:
        shared = len(np.intersect1d(values[:start[1]], values[start[1]:], assume_unique=True))
        return np.array([[start[1], shared], [shared, start[2] - start[1]]])
    owner = np.repeat(np.arange(n), np.diff(start))
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    column = np.cumsum(np.append(False, values[1:] != values[:-1]))
    out = np.zeros((n, n))
    edges = np.searchsorted(column, np.arange(0, column[-1] + 1 + width, width)) if len(column) else [0]
    for k, (a, b) in enumerate(zip(edges, edges[1:])):
        seen = np.zeros((n, width), dtype=np.float32)
        seen[owner[a:b], column[a:b] - k * width] = 1
        out += seen @ seen.T
    return out.astype(np.int64)


def _verify(rows: DataFrame, threshold: float) -> DataFrame:
    """Exact similarities in each pair of blocks -> each node's links there, and
    its root among the nodes it is linked with."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in _tables(batches, ("cluster", "lo", "hi"), 256):
            edges = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(group))
            nodes, parts = table["node"].to_pylist(), table["parts"].to_pylist()
            copies, block = table["copies"].to_numpy(), table["block"].to_numpy()
            apart = table["lo"].to_numpy() != table["hi"].to_numpy()
            sets = table["values"]
            rows = []
            for a, b in zip(edges, edges[1:]):
                at = [i for i in range(a, b) if i == a or nodes[i] != nodes[i - 1]]  # repeated rows stand side by side
                arrays = [np.frombuffer(sets[i].as_py(), dtype=np.uint64) for i in at]
                size = np.array([len(x) for x in arrays])
                start = np.append(0, np.cumsum(size))
                both = overlaps(np.concatenate(arrays), start)
                linked = both >= threshold * (size[:, None] + size[None, :] - both) - 1e-9
                np.fill_diagonal(linked, False)
                if apart[a]:
                    linked &= block[at][:, None] != block[at][None, :]
                links = linked @ copies[at]
                i, j = np.nonzero(np.triu(linked))
                root = roots(len(at), i, j)
                rows += [(nodes[x], nodes[at[r]], int(k), parts[x]) for x, r, k in zip(at, root, links)]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), (pa.binary(), pa.binary(), pa.int64(), pa.int32()))], names=["u", "v", "links", "parts"])

    ordered = rows.repartition("cluster", "lo", "hi").sortWithinPartitions("cluster", "lo", "hi", "node")
    return ordered.mapInArrow(verify, "u binary, v binary, links long, parts int")


def _with_sets(members: DataFrame, ngram: int) -> DataFrame:
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, column in blocks(batches, "text"):
            values, start = gram_sets(Words(column), ngram)
            raw = values.tobytes()
            found = [raw[8 * a:8 * b] for a, b in zip(start[:-1].tolist(), start[1:].tolist())]
            keep = [n for n in batch.schema.names if n != "text"]
            yield pa.record_batch([*[batch.column(batch.schema.get_field_index(n)) for n in keep], pa.array(found, pa.binary())], names=[*keep, "values"])

    return members.select("cluster", "parts", "node", "copies", "text").mapInArrow(sets, "cluster binary, parts int, node binary, copies long, values binary")


def similar(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, ngram: int = NGRAM) -> DataFrame:
    """One row per document row: ``doc_id``, ``class_id``, ``copy_id``, ``n_links``.

    Words are runs of anything but blank, tab, line feed, vertical tab, form feed
    and carriage return, unchanged; a document with fewer than ``ngram`` words has
    one n-gram, of all of them. Two documents are linked if the Jaccard similarity
    of their n-gram sets is at least ``threshold``. ``n_links`` counts the other
    documents a document is linked with, ``class_id`` is the least doc_id it is
    connected with by links, ``copy_id`` the least doc_id with an equal n-gram set.
    Null and empty texts have no n-grams and are equal to one another. A null
    doc_id is greater than all others and null as a result; repeated rows count as
    documents. An empty table gives no rows. ``recall`` is the probability with
    which two different documents at the threshold itself become candidates; it
    is higher above the threshold, and similarities of candidates are exact.
    ValueError where ``TREES`` trees cannot give that (a threshold below 0.37).

    Columns ``_id`` and ``_th`` (see ``row_key``) and ``_class_id``, ``_class_th``
    (the row that stands for the class) lead back to the rows.
    """
    depth = prefix_length(threshold, recall)
    keyed = docs.select(*row_key(F.col("doc_id"), F.col("text")), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    signed = written(_sign(keyed, ngram, depth), "signatures")
    first = lambda c: F.first(c).alias(c)  # noqa: E731  equal for equal sets
    nodes = written(
        signed.groupBy("node").agg(F.min(F.struct("_id", "_th")).alias("doc"), F.count("*").alias("copies"), first("grams"), first("sketch"), first("keys")), "nodes"
    )

    # Candidates: nodes with a common prefix, then those with similar sketches.
    prefixes = nodes.where("grams > 0").select(F.explode("keys").alias("key"), "node")
    shared = prefixes.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    buckets = prefixes.join(shared, "key").join(nodes.select("node", "sketch"), "node")
    size = TREES * LENGTH
    likely = threshold - MARGIN * (threshold * (1 - threshold) / size) ** 0.5
    ties = _tie(_against(buckets, F.ceil(F.col("n") / BUCKET_NODES)), likely * size)
    clusters = components(ties).select("node", F.col("root").alias("cluster"))

    # Exact similarities within clusters.
    members = written(clusters.join(nodes.select("node", "doc", "copies", "grams"), "node"), "clusters")
    sizes = members.groupBy("cluster").agg(F.count("*").alias("n"), F.sum("grams").alias("g"))
    parts = F.ceil(F.greatest(F.col("n") / BLOCK_NODES, F.col("g") / BLOCK_GRAMS)).cast("int").alias("parts")
    wanted = members.join(sizes.select("cluster", parts), "cluster").select("cluster", "parts", "node", "copies", F.col("doc._id").alias("_id"), F.col("doc._th").alias("_th"))
    # The wanted rows grow with the corpus: join by sorting at every size.
    sets = _with_sets(keyed.hint("merge").join(wanted, ["_id", "_th"]), ngram)
    checked = written(_verify(_against(sets, F.col("parts")), threshold), "links")

    # Classes: the roots found are final where one task saw the whole cluster.
    links = checked.groupBy("u").agg(F.sum("links").alias("links")).select(F.col("u").alias("node"), "links")
    across = components(checked.where("parts > 1").select("u", "v"))
    root = checked.where("parts = 1").select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(across)
    classes = nodes.select("node", "doc", "copies").join(root, "node", "left").join(links, "node", "left")
    classes = classes.select("node", "doc", "copies", F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    least = classes.groupBy("root").agg(F.min("doc").alias("least"))
    classes = classes.join(least, "root").select("node", "doc", "least", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    named = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return signed.select("_id", "_th", "node").join(classes, "node").select(
        named("_id").alias("doc_id"), named("least._id").alias("class_id"), named("doc._id").alias("copy_id"), "n_links",
        "_id", "_th", F.col("least._id").alias("_class_id"), F.col("least._th").alias("_class_th"),
    )


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One row of ``docs`` for each class: the one with the least doc_id; of rows
    equal in id and text, any."""
    found = similar(docs, **options)
    kept = found.select(F.col("_class_id").alias("_id"), F.col("_class_th").alias("_th")).distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, *row_key(F.col("doc_id"), F.col("text"))).join(kept, ["_id", "_th"], "left_semi")
    one = Window.partitionBy("_id", "_th").orderBy(F.lit(1))
    return rows.withColumn("_n", F.row_number().over(one)).where("_n = 1").select("row.*")


def op7_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Classes and links of all documents at 0.8 over five words."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return similar(docs).select("doc_id", "class_id", "copy_id", "n_links")
