"""Ranked lexical search for many items at once: shared term sets are scored once.

An item's score is a sum over its terms, so items that share terms share parts of
the sum. Items with similar terms are brought into groups. Of each group's term
lists the pairs that stand in several items are made nodes, again and again, so that
a node is a set of terms that items share. Nodes are sums of two nodes, and so form
a graph that ends in the items. In each block of documents the terms' scores are
filled in, every node's partial scores are computed once, and items add up the few
nodes they are left with.

Documents are read once for each block of items: their terms are counted against
the block's vocabulary and written. Document frequencies, weights and scores come
from these counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulseforge.llm.common import Words, blocks, pick, written
from pulseforge.llm.heaps import Heaps
from pulseforge.llm.meeting import NO_ID

TOP = 10
#: Term slots of items in a group, and in a block of groups, which is broadcast.
GROUP_SLOTS = 1 << 14
BLOCK_SLOTS = 1 << 18
#: Bytes of partial scores that are worked on at once.
SCORE_BYTES = 32 << 20

_OUTSIDE = np.ones(256, dtype=bool)
for _first, _last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _OUTSIDE[_first:_last + 1] = False
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20


def terms(column: pa.Array) -> Words:
    """Runs of digits, ASCII letters and all characters beyond ASCII; A-Z as a-z."""
    return Words(column, _OUTSIDE, _FOLD)


def _item_terms(items: DataFrame) -> DataFrame:
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, column in blocks(batches, "text"):
            words = terms(column)
            data = words.data.tobytes()
            all_terms, all_times, sign = [], [], []
            for i in range(len(column)):
                a, b = words.doc[i], words.doc[i + 1]
                _, first, times = np.unique(words.hash[a:b], return_index=True, return_counts=True)
                all_terms.append([data[words.start[a + k]:words.end[a + k]] for k in first.tolist()])
                all_times.append(times.astype(np.int32))
                sign.append(int(words.hash[a:b].min().view(np.int64)) if b > a else 0)
            yield pa.record_batch({
                "item": batch.column("item"), "item_id": batch.column("item_id"), "terms": pa.array(all_terms, pa.list_(pa.binary())),
                "times": pa.array(all_times, pa.list_(pa.int32())), "sign": pa.array(sign, pa.int64()),
            })

    return items.mapInArrow(split, "item long, item_id long, terms array<binary>, times array<int>, sign long").where("size(terms) > 0")


def share(lists: list[np.ndarray], leaves: int) -> tuple[np.ndarray, np.ndarray, list[int], np.ndarray, np.ndarray]:
    """Nodes for what the lists (of leaves, each at most once) share.

    Gives the two parts of each node, where each round's nodes end, and the lists'
    remaining nodes one after another with their ends. Leaves count from 0, nodes
    from ``leaves`` on. The sum over a list's remaining nodes is the sum over its
    leaves."""
    value = np.concatenate(lists).astype(np.int64) if lists else np.zeros(0, dtype=np.int64)
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    # Frequent leaves first, so that what many lists share stands side by side.
    often = np.bincount(value, minlength=leaves)
    order = np.lexsort((value, -often[value], owner))
    value, owner = value[order], owner[order]
    left, right, ends = [], [], []
    nodes = leaves
    while len(value) > 1:
        pair = value[:-1] * nodes + value[1:]
        pair[owner[1:] != owner[:-1]] = -1
        kinds, kind, count = np.unique(pair, return_inverse=True, return_counts=True)
        count[kinds < 0] = 0
        worth = np.where(count[kind] > 1, count[kind], 0)
        # Of pairs that overlap the more frequent one is taken, or the first.
        before, after = np.append(0, worth[:-1]), np.append(worth[1:], 0)
        taken = np.flatnonzero((worth > before) & (worth >= after) & (worth > 0))
        kept, new, again = np.unique(kind[taken], return_inverse=True, return_counts=True)
        use = again > 1
        taken, new = taken[use[new]], (np.cumsum(use) - 1)[new][use[new]]
        if not len(taken):
            break
        key = kinds[kept[use]]
        left.append(key // nodes)
        right.append(key % nodes)
        value[taken] = nodes + new
        stay = np.ones(len(value), dtype=bool)
        stay[taken + 1] = False
        value, owner = value[stay], owner[stay]
        nodes += len(key)
        ends.append(nodes)
    none = [np.zeros(0, dtype=np.int64)]
    return np.concatenate(left or none), np.concatenate(right or none), ends, value, np.cumsum(np.bincount(owner, minlength=len(lists)))


_GROUP = (
    "group long, slots long, terms array<binary>, leaf_term array<int>, leaf_times array<int>, left array<int>, right array<int>, "
    "ends array<int>, items array<long>, item_ids array<long>, nodes array<int>, node_ends array<int>"
)


def _group(rows: list[dict], number: int) -> dict:
    """The graph of one group of items."""
    numbers: dict[bytes, int] = {}
    leaf_of: dict[tuple[int, int], int] = {}
    lists = []
    for row in rows:
        numbered = [numbers.setdefault(t, len(numbers)) for t in row["terms"]]
        lists.append(np.array([leaf_of.setdefault(x, len(leaf_of)) for x in zip(numbered, row["times"])], dtype=np.int64))
    left, right, ends, nodes, node_ends = share(lists, len(leaf_of))
    return {
        "group": number, "slots": sum(len(x) for x in lists), "terms": list(numbers), "leaf_term": [t for t, _ in leaf_of], "leaf_times": [n for _, n in leaf_of],
        "left": left.tolist(), "right": right.tolist(), "ends": ends, "items": [r["item"] for r in rows],
        "item_ids": [r["item_id"] for r in rows], "nodes": nodes.tolist(), "node_ends": node_ends.tolist(),
    }


def plans(items: DataFrame) -> DataFrame:
    """Groups of items with their graphs, written, and dealt to blocks one after
    another. Items whose least term hash is the same, so probably items with like
    terms, are neighbours."""
    listed = written(_item_terms(items), "item-terms")
    slots = listed.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    many = -(-slots // BLOCK_SLOTS)
    dealt = listed.repartitionByRange(max(1, many), "sign", F.xxhash64("item")).sortWithinPartitions("sign", "item")
    dealt = dealt.withColumn("part", F.spark_partition_id().cast("long"))
    group_slots = GROUP_SLOTS

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held, made = [], 0, 0
        schema = pa.schema([(n, _ARROW[n]) for n in _ARROW])

        def group() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([_group(rows, (rows[0]["part"] << 32) + made)], schema)

        for batch in batches:
            for row in batch.to_pylist():
                if rows and held + len(row["terms"]) > group_slots:
                    yield group()
                    rows, held, made = [], 0, made + 1
                rows.append(row)
                held += len(row["terms"])
        if rows:
            yield group()

    groups = written(dealt.mapInArrow(mine, _GROUP), "item-groups")
    # One short row for each group.
    before = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    block = F.floor(F.coalesce(F.sum("slots").over(before), F.lit(0)) / BLOCK_SLOTS)
    return groups.join(groups.select("group", block.alias("block")), "group")


_ARROW = {"group": pa.int64(), "slots": pa.int64(), "terms": pa.list_(pa.binary())} | {n: pa.list_(pa.int32()) for n in ("leaf_term", "leaf_times", "left", "right", "ends")}
_ARROW |= {"items": pa.list_(pa.int64()), "item_ids": pa.list_(pa.int64()), "nodes": pa.list_(pa.int32()), "node_ends": pa.list_(pa.int32())}


class Vocabulary:
    """Distinct terms by hash; ``find`` compares the bytes too."""

    def __init__(self, distinct: list[bytes]):
        words = Words(pa.array(distinct, pa.large_binary()).cast(pa.large_string()), np.zeros(256, dtype=bool))
        order = np.argsort(words.hash)
        self.hash = words.hash[order]
        if len(np.unique(self.hash)) < len(self.hash):
            raise RuntimeError("two terms have one 64-bit hash")
        self.terms = [distinct[k] for k in order.tolist()]
        self.number = {t: i for i, t in enumerate(self.terms)}
        self.length = np.array([len(t) for t in self.terms])
        self.data = np.frombuffer(b"".join(self.terms), dtype=np.uint8)
        self.start = np.cumsum(self.length) - self.length

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """The words that are terms, and the number of each term."""
        at = np.minimum(np.searchsorted(self.hash, words.hash), len(self.hash) - 1)
        length = words.end - words.start
        word = np.flatnonzero((self.hash[at] == words.hash) & (self.length[at] == length))
        same = np.ones(len(word), dtype=bool)
        for n in np.unique(length[word]):
            some = np.flatnonzero(length[word] == n)
            for low in range(0, len(some), max(1, (1 << 20) // n)):
                part = some[low:low + max(1, (1 << 20) // n)]
                place = np.arange(n)
                a = words.data[words.start[word[part]][:, None] + place]
                same[part] = (a == self.data[self.start[at[word[part]]][:, None] + place]).all(axis=1)
        return word[same], at[word[same]]


def _count(docs: DataFrame, vocabulary) -> DataFrame:
    """Documents with any terms: how many (``n``), and which of the vocabulary's
    terms how often."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch, column in blocks(batches, "text"):
            words = terms(column)
            word, term = known.find(words)
            doc = words.text_of()[word]
            key, times = np.unique(doc * len(known.terms) + term, return_counts=True)
            doc, term = np.divmod(key, len(known.terms))
            ends = np.append(0, np.cumsum(np.bincount(doc, minlength=len(column)))).astype(np.int32)
            lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (term, times)]
            rows = pa.record_batch({"doc_id": batch.column("doc_id"), "n": pa.array(words.count.astype(np.int64)), "terms": lists[0], "times": lists[1]})
            yield rows.filter(pa.array(words.count > 0))

    return docs.mapInArrow(count, "doc_id long, n long, terms array<int>, times array<int>")


def _frequencies(counted: DataFrame, many: int) -> DataFrame:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(many, dtype=np.int64)
        for batch in batches:
            df += np.bincount(batch.column("terms").flatten().to_numpy(zero_copy_only=False), minlength=many)
        some = np.flatnonzero(df)
        yield pa.record_batch({"term": pa.array(some.astype(np.int32)), "df": pa.array(df[some])})

    return counted.select("terms").mapInArrow(add, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))


class Group:
    """One group of items, ready to be scored."""

    def __init__(self, row, number: dict[bytes, int], many: int, top: int):
        term = np.array([number[t] for t in row["terms"]])[np.array(row["leaf_term"])]
        order = np.argsort(term, kind="stable")
        # Leaves by term: a term with several multiplicities has several.
        self.leaf, self.times = order, np.array(row["leaf_times"])[order]
        self.first = np.searchsorted(term[order], np.arange(many + 1))
        self.leaves = len(term)
        self.left, self.right = np.array(row["left"], dtype=np.int64), np.array(row["right"], dtype=np.int64)
        self.ends = [self.leaves, *row["ends"]]
        self.items, self.item_ids = np.array(row["items"], dtype=np.int64), row["item_ids"]
        self.nodes, ends = np.array(row["nodes"], dtype=np.int64), np.array(row["node_ends"], dtype=np.int64)
        self.starts, self.sizes = np.append(0, ends[:-1]), np.diff(np.append(0, ends))
        self.heaps = Heaps(len(self.items), top)

    @property
    def size(self) -> int:
        return self.ends[-1] + len(self.items)

    def scores(self, doc: np.ndarray, term: np.ndarray, value: np.ndarray, docs: int) -> np.ndarray:
        """Scores of all items (rows) and documents from the terms' scores."""
        partial = np.zeros((self.ends[-1], docs), dtype=np.int64)
        many = self.first[term + 1] - self.first[term]
        at = np.arange(many.sum()) + np.repeat(self.first[term] - (np.cumsum(many) - many), many)
        partial[self.leaf[at], np.repeat(doc, many)] = np.repeat(value, many) * self.times[at]
        for low, high in zip(self.ends, self.ends[1:]):
            some = slice(low - self.leaves, high - self.leaves)
            np.add(partial[self.left[some]], partial[self.right[some]], out=partial[low:high])
        out = np.zeros((len(self.items), docs), dtype=np.int64)
        for k in range(int(self.sizes.max(initial=0))):
            has = np.flatnonzero(self.sizes > k)
            out[has] += partial[self.nodes[self.starts[has] + k]]
        return out


def _rank(counted: DataFrame, groups, weights, top: int) -> DataFrame:
    """The best documents of each task for each item."""

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, number = groups.value
        weight = weights.value
        mine = [Group(r, number, len(weight), top) for r in rows]
        step = max(1, SCORE_BYTES // (8 * max(g.size for g in mine)))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                ids = part.column("doc_id")
                named = np.where(ids.is_null().to_numpy(zero_copy_only=False), -1, 0)
                ids = ids.fill_null(NO_ID).to_numpy()
                doc = np.repeat(np.arange(part.num_rows), part.column("terms").value_lengths().to_numpy())
                term = part.column("terms").flatten().to_numpy(zero_copy_only=False)
                tf = part.column("times").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                value = weight[term] * ((1_000_000_000 * tf) // (1_000 * tf + 8 * part.column("m").to_numpy()[doc]))
                for g in mine:
                    score = g.scores(doc, term, value, part.num_rows)
                    i, j = np.nonzero((score > 0) & g.heaps.improve(np.arange(len(score)), score, ids))
                    g.heaps.merge(i, score[i, j], ids[j], named[j])
        for g in mine:
            h = g.heaps
            yield pa.record_batch({
                "item": pa.array(g.items[h.owner]), "item_id": pa.array([g.item_ids[k] for k in h.owner.tolist()], pa.int64()),
                "doc_id": pa.array(h.ids, mask=h.row < 0), "score": pa.array(h.score),
            })

    return counted.select("doc_id", "m", "terms", "times").mapInArrow(rank, "item long, item_id long, doc_id long, score long")


def search(items: DataFrame, docs: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` highest-scoring documents of each item: ``item_id``, ``rank``, ``doc_id``, ``score``.

    Terms are maximal runs of ASCII letters and digits and of any characters beyond
    ASCII, A-Z as a-z, of the whole text; a null text has none. With N documents
    that have terms, L terms in them, n of one document, df documents with a term
    and tf occurrences in the document, a term counts
    floor(1000 ln((2N + 2) / (2 df + 1))) times (10^9 tf) div (1000 tf + 8 m), m being
    25 + (75 n N) div L, as often as it stands in the item. Only scores above 0 rank;
    equal ones by the smaller id, null ids last. Repeated documents rank each;
    items equal in id and text count once, items that share only the id have a list
    each. No items, or no documents, give no rows. Extra columns are ignored.
    """
    spark = docs.sparkSession
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text")).where("text is not null").distinct()
    items = written(items.withColumn("item", F.monotonically_increasing_id()), "items")
    groups = plans(items)
    docs = pick(docs, "doc_id", "text").where("text is not null").withColumn("doc_id", F.col("doc_id").cast("long"))
    found = None
    # One row for each block of items.
    for (block,) in sorted(groups.select("block").distinct().collect()):
        rows = [r.asDict() for r in groups.where(F.col("block") == block).collect()]
        vocabulary = Vocabulary(sorted({bytes(t) for r in rows for t in r["terms"]}))
        counted = written(_count(docs, spark.sparkContext.broadcast(vocabulary)), "counted")
        many, total = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not many:
            continue
        weigh = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * many + 2) / (F.lit(2.0) * F.col("df") + 1))).cast("long")
        weights = np.zeros(len(vocabulary.terms), dtype=np.int64)
        for term, weight in _frequencies(counted, len(weights)).select("term", weigh.alias("weight")).collect():
            weights[term] = weight
        counted = counted.withColumn("m", F.expr(f"25 + (75 * n * {many}L) div {total}L"))
        for r in rows:
            r["terms"] = [bytes(t) for t in r["terms"]]
        hits = _rank(counted, spark.sparkContext.broadcast((rows, vocabulary.number)), spark.sparkContext.broadcast(weights), top)
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return items.where("false").select("item_id", F.lit(1).alias("rank"), F.col("item_id").alias("doc_id"), F.col("item_id").alias("score"))
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def op11_ranked_search(spark, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    return search(spark.read.parquet(f"{sf_dir}/benchmark.parquet"), spark.read.parquet(f"{sf_dir}/documents.parquet"))
