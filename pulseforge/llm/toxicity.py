"""Toxicity scores from the nearest labelled examples.

Examples and documents are TF-IDF vectors over words, and beginnings of words, that
tell the labels apart.
The most similar examples (exact cosine) are found through an inverted index in
blocks: for each word a block's largest weight is kept, so that the words of a
document bound every block's best similarity, and blocks that cannot reach the
nearest examples found so far are left out. Neighbours vote by distance; a monotone
curve fitted on the examples, each scored without itself, turns votes into
probabilities.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseforge.llm.common import blocks, crc_fold, pick, written

#: Labelled rows of each class the model is fitted on, at most about.
FIT_DOCUMENTS = 3_000
#: Terms the model knows at most; the least chi-squared and documents of a term.
WORDS = 2_048
LEAST_CHI2 = 40.0
LEAST_DOCUMENTS = 3
#: Lengths of the beginnings of words that are terms beside the words.
BEGINNINGS = (3, 4, 5, 6, 7)

NEIGHBOURS = 15
BLOCK = 64
#: Added to a neighbour's distance before it is inverted.
NEAREST = 0.05

_WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    """Lower-case runs of letters."""
    return _WORD.findall(text.lower())


def terms(word: str) -> list[str]:
    """The word, and its beginnings: forms of one word share them."""
    return [word, *[word[:n] + "*" for n in BEGINNINGS if len(word) >= n]]


@dataclass(frozen=True)
class Examples:
    """``weight[block]``: words by examples; ``bound``: words by blocks."""

    vocabulary: dict[str, int]
    idf: np.ndarray
    weight: np.ndarray
    bound: np.ndarray
    ids: np.ndarray
    toxic: np.ndarray
    share: np.ndarray  # labelled rows each example stands for
    base: float = 0.0  # toxic share of labelled rows without any known word
    votes: np.ndarray = field(default_factory=lambda: np.zeros(0))
    probability: np.ndarray = field(default_factory=lambda: np.zeros(0))


@dataclass(frozen=True)
class Vectors:
    """Known words of some texts: word numbers and weights, text by text."""

    word: np.ndarray
    value: np.ndarray
    start: np.ndarray


def vectors(counts: list[dict[int, int]], idf: np.ndarray) -> Vectors:
    """Unit vectors of (1 + log tf) * idf."""
    sizes = np.array([len(c) for c in counts], dtype=np.int64)
    start = np.append(0, np.cumsum(sizes))
    word = np.fromiter((w for c in counts for w in c), dtype=np.int64, count=start[-1])
    tf = np.fromiter((n for c in counts for n in c.values()), dtype=np.float64, count=start[-1])
    value = (1 + np.log(tf)) * idf[word] if len(word) else tf
    if len(word):
        full = np.flatnonzero(sizes)
        norm = np.sqrt(np.add.reduceat(value * value, start[full]))
        value = value / np.repeat(norm, sizes[full])
    return Vectors(word, value, start)


def nearest(index: Examples, some: Vectors, k: int, leave_out: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and cosines of each text's ``k`` most similar examples, best first,
    ties to the smaller number; -1 where fewer have a word in common. ``leave_out``
    names one example per text that takes no part."""
    n = len(some.start) - 1
    found, best = np.full((n, k), -1, dtype=np.int64), np.zeros((n, k))
    sizes = np.diff(some.start)
    full = np.flatnonzero(sizes)
    if not len(full) or not len(index.weight):
        return found, best
    bound = np.zeros((n, len(index.weight)))
    bound[full] = np.add.reduceat(index.bound[some.word] * some.value[:, None], some.start[full], axis=0)
    for b in np.argsort(-bound.sum(axis=0), kind="stable"):
        some_left = np.flatnonzero((bound[:, b] > 0) & (bound[:, b] * (1 + 1e-9) >= best[:, -1]))
        if not len(some_left):
            continue
        many = sizes[some_left]
        at = np.repeat(some.start[some_left] - np.append(0, np.cumsum(many)[:-1]), many) + np.arange(many.sum())
        scores = np.add.reduceat(index.weight[b][some.word[at]] * some.value[at, None], np.append(0, np.cumsum(many)[:-1]), axis=0)
        ids = b * BLOCK + np.arange(scores.shape[1])
        if leave_out is not None:
            scores[leave_out[some_left][:, None] == ids[None, :]] = 0
        cosine = np.concatenate([best[some_left], scores], axis=1)
        number = np.concatenate([found[some_left], np.broadcast_to(ids, scores.shape)], axis=1)
        number = np.where(cosine > 0, number, -1)
        order = np.lexsort((number, -cosine), axis=1)[:, :k]
        best[some_left], found[some_left] = np.take_along_axis(cosine, order, axis=1), np.take_along_axis(number, order, axis=1)
    return found, best


def vote(index: Examples, found: np.ndarray, cosine: np.ndarray) -> np.ndarray:
    """Toxic share of the neighbours, each by what it stands for over its distance;
    -1 without neighbours."""
    there = found >= 0
    weight = np.where(there, index.share[found] / (1 - np.minimum(cosine, 1) + NEAREST), 0)
    total = weight.sum(axis=1)
    return np.where(total > 0, (weight * index.toxic[found]).sum(axis=1) / np.where(total > 0, total, 1), -1.0)


def rising(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression: points of the monotone curve nearest to ``y``."""
    pools: list[list[float]] = []  # sum of weights, of weight * x, of weight * y
    for i in np.argsort(x, kind="stable"):
        pools.append([weight[i], weight[i] * x[i], weight[i] * y[i]])
        while len(pools) > 1 and pools[-2][2] / pools[-2][0] >= pools[-1][2] / pools[-1][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return np.array([p[1] / p[0] for p in pools]), np.array([p[2] / p[0] for p in pools])


def probabilities(index: Examples, votes: np.ndarray) -> np.ndarray:
    curve = np.interp(votes, index.votes, index.probability) if len(index.votes) else np.full(len(votes), index.base)
    return np.clip(np.where(votes < 0, index.base, curve), 0.0, 1.0)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, column in blocks(batches, "text"):
        counts = [Counter(x for w in words(t) for x in terms(w)) for t in column.to_pylist()]
        kind = pa.map_(pa.string(), pa.int32())
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.record_batch([*[batch.column(batch.schema.get_field_index(n)) for n in names], pa.array([list(c.items()) for c in counts], kind)], names=[*names, "words"])


def fit(docs: DataFrame, labels: DataFrame, learn: Column, bound: int = FIT_DOCUMENTS) -> Examples:
    """Fit on labelled rows where ``learn`` holds.

    ``labels`` has ``doc_id`` and ``toxic`` (0 or 1; null is no label; of several
    labels of a document the largest counts). From each class a hash of the doc_id
    picks about ``bound`` rows (all, if fewer), and each stands for as many as were
    left. Terms are those of at least ``LEAST_DOCUMENTS`` examples whose
    chi-squared against the label is ``LEAST_CHI2`` or more, the ``WORDS`` best.
    All that reaches the driver is bounded by these parameters.
    """
    known = labels.where(learn & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    rate = {t: min(1.0, bound / n) for t, n in sizes.items()}
    share = F.when(F.col("toxic") == 1, F.lit(rate.get(1, 1.0))).otherwise(F.lit(rate.get(0, 1.0)))
    picked = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30))
    # At most about twice ``bound`` rows.
    rows = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(picked), "doc_id")
    rows = written(rows.mapInArrow(_counted, "doc_id long, toxic int, words map<string, int>"), "examples")

    seen = rows.select("toxic", F.explode(F.map_keys("words")).alias("word")).groupBy("word")
    n, p = rows.count(), rows.where("toxic = 1").count()
    a, df = F.col("n_toxic").cast("double"), F.col("df").cast("double")
    # Of the two-by-two table of word and label.
    cross = a * (n - p - df + a) - (df - a) * (p - a)
    chi2 = float(n) * cross * cross / (df * (n - df) * float(p) * float(n - p))
    best = seen.agg(F.count("*").alias("df"), F.sum("toxic").alias("n_toxic")).where((F.col("df") >= LEAST_DOCUMENTS) & (F.col("df") < n))
    best = best.withColumn("chi2", chi2) if 0 < p < n else best.where("false").withColumn("chi2", F.lit(0.0))
    chosen = best.where(F.col("chi2") >= LEAST_CHI2).orderBy(F.col("chi2").desc(), "word").limit(WORDS).collect()
    vocabulary = {r["word"]: i for i, r in enumerate(chosen)}
    idf = np.log((n + 1) / (np.array([r["df"] for r in chosen]) + 1)) + 1 if chosen else np.zeros(0)
    return _index(rows, vocabulary, idf, rate)


def _index(rows: DataFrame, vocabulary: dict[str, int], idf: np.ndarray, rate: dict[int, float]) -> Examples:
    chosen = F.map_filter("words", lambda w, _: w.isin(list(vocabulary))) if vocabulary else F.create_map().cast("map<string,int>")
    found = rows.select("doc_id", "toxic", chosen.alias("words")).orderBy("doc_id").collect()
    counts = [{vocabulary[w]: n for w, n in sorted(r["words"].items())} for r in found]
    # Like examples next to each other: by their rarest known word.
    order = sorted(range(len(found)), key=lambda i: (min(counts[i], key=lambda w: (-idf[w], w)) if counts[i] else len(vocabulary), i))
    found, counts = [found[i] for i in order], [counts[i] for i in order]
    some = vectors(counts, idf)
    n = len(found)
    weight = np.zeros((-(-n // BLOCK), max(1, len(vocabulary)), BLOCK), dtype=np.float32)
    owner = np.repeat(np.arange(n), np.diff(some.start))
    weight[owner // BLOCK, some.word, owner % BLOCK] = some.value
    toxic = np.array([r["toxic"] for r in found], dtype=float)
    share = np.array([1 / rate[r["toxic"]] for r in found])
    index = Examples(vocabulary, idf, weight, weight.max(axis=2).T, np.array([r["doc_id"] for r in found], dtype=np.int64), toxic, share)
    if not n:
        return index
    near, cosine = nearest(index, some, NEIGHBOURS, np.arange(n))
    votes = vote(index, near, cosine)
    alone = votes < 0
    base = float((toxic * share)[alone].sum() / share[alone].sum()) if alone.any() else float((toxic * share).sum() / share.sum())
    x, y = rising(votes[~alone], toxic[~alone], share[~alone]) if not alone.all() else (np.zeros(0), np.zeros(0))
    return Examples(vocabulary, idf, weight, index.bound, index.ids, toxic, share, base, x, y)


def score(docs: DataFrame, index: Examples) -> DataFrame:
    """``doc_id``, ``score``, ``predicted`` and ``evidence`` of every row.

    The score depends on the text alone. A text without known words (null and
    empty ones too) has the share of toxic examples without known words. Evidence
    lists the nearest examples: doc_id, label, cosine. Repeated rows score alike;
    an empty table gives no rows. Without any example the score is 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        of_word: dict[str, tuple[int, ...]] = {}  # remembered, not a limit
        for batch, column in blocks(batches, "text"):
            counts = []
            for text in column.to_pylist():
                found: Counter[int] = Counter()
                for word, n in Counter(words(text)).items():
                    if word not in of_word:
                        of_word[word] = tuple(m.vocabulary[x] for x in terms(word) if x in m.vocabulary)
                    for x in of_word[word]:
                        found[x] += n
                counts.append(dict(sorted(found.items())))
                if len(of_word) > 300_000:
                    of_word.clear()
            near, cosine = nearest(m, vectors(counts, m.idf), NEIGHBOURS)
            scores = probabilities(m, vote(m, near, cosine)) if len(m.ids) else np.zeros(len(counts))
            evidence = [[{"doc_id": int(m.ids[j]), "toxic": int(m.toxic[j]), "cosine": float(c)} for j, c in zip(a, b) if j >= 0] for a, b in zip(near, cosine)]
            kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("toxic", pa.int32()), ("cosine", pa.float64())]))
            yield pa.record_batch({
                "doc_id": batch.column(0), "score": pa.array(scores, pa.float64()), "predicted": pa.array((scores >= 0.5).astype(np.int32)),
                "evidence": pa.array(evidence, kind),
            })

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(find, "doc_id long, score double, predicted int, evidence array<struct<doc_id:long,toxic:int,cosine:double>>")


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt outside the held-out fifth."""
    docs = pick(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    index = fit(docs, labels, crc_fold(F.col("doc_id")) != 0)
    held_out = F.coalesce(crc_fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out")
    return score(docs, index).select("doc_id", held_out, "score", "predicted", "evidence")
