"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseforge.llm.common import blocks, crc_fold, mix, pick

UNDETERMINED = "und"
ORDERS = (1, 2, 3)
#: N-gram buckets, fewer (a power of two) where there are so many languages that the
#: model would exceed MODEL_BYTES, but LEAST_BUCKETS at least.
BUCKETS = 1 << 15
LEAST_BUCKETS = 1 << 8
MODEL_BYTES = 16 << 20
#: Labelled documents of each language the model is fitted on, at most about (all, if fewer).
FIT_DOCUMENTS = 40_000
#: Below this score a document's language counts as not recognised.
LEAST_SCORE = 0.5

_BLANK = np.uint32(0x20)
#: Code points of one text that are worked on at once.
_SLICE = 1 << 20
#: Log-probabilities that are added up at once.
_TERMS = 1 << 22
_letter: list[np.ndarray] = []


@dataclass(frozen=True)
class Model:
    """``weight``: log-probability by bucket and language; ``prior`` by language."""

    languages: tuple[str, ...]
    weight: np.ndarray
    prior: np.ndarray


def _letters() -> np.ndarray:
    if not _letter:
        _letter.append(np.array([chr(i).isalpha() for i in range(0x110000)], dtype=bool))
    return _letter[0]


def symbols(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters of all texts as code points, each run of anything else
    as one blank, and the text each belongs to."""
    data = column.to_pylist()
    points = np.frombuffer("\n".join(data).lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.array([len(t.lower()) for t in data], dtype=np.int64)
    text = np.repeat(np.arange(len(data)), sizes + 1)[:len(points)]
    letter = _letters()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[:1] = True
    keep[1:] |= text[1:] != text[:-1]
    return np.where(letter, points, _BLANK)[keep], text[keep]


def buckets_for(languages: int) -> int:
    """The number of buckets of a model of so many languages."""
    buckets = BUCKETS
    while buckets > LEAST_BUCKETS and 4 * buckets * languages > MODEL_BYTES:
        buckets //= 2
    if 4 * buckets * languages > MODEL_BYTES:
        raise ValueError(f"{languages} languages: a model of {LEAST_BUCKETS} buckets each exceeds {MODEL_BYTES} bytes")
    return buckets


def features(column: pa.Array, buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, text numbers) of the n-grams of some texts, order by order.
    N-grams begin and end with letters or are cut at one blank."""
    point, text = symbols(column)
    letter = point != _BLANK
    for n in ORDERS:
        size = len(point) - n + 1
        if size <= 0:
            continue
        h = np.full(size, n, dtype=np.uint64)
        for i in range(n):
            h = h * np.uint64(0x100000001B3) + point[i:size + i]
        one_text = text[:size] == text[n - 1:]
        some = letter[:size].copy()
        for i in range(1, n):
            some |= letter[i:size + i]
        # Unigrams: letters. Longer ones hold a letter and lie in one text.
        keep = one_text & some
        yield (mix(h[keep]) % np.uint64(buckets)).astype(np.int64), text[:size][keep]


def slices(column: pa.Array) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """Texts in groups of bounded size; a longer text comes in overlapping parts
    (with the numbers of the texts they belong to)."""
    waiting, numbers, size = [], [], 0
    overlap = max(ORDERS) - 1
    for i, text in enumerate(column.to_pylist()):
        for at in range(0, max(1, len(text)), _SLICE):
            part = text[max(0, at - overlap):at + _SLICE]
            waiting.append(part)
            numbers.append(i)
            size += len(part)
            if size >= _SLICE:
                yield np.array(numbers), pa.array(waiting, pa.large_string())
                waiting, numbers, size = [], [], 0
    if waiting:
        yield np.array(numbers), pa.array(waiting, pa.large_string())


def fit(docs: DataFrame, learn: Column, bound: int = FIT_DOCUMENTS) -> Model:
    """Fit on rows where ``learn`` holds and ``lang`` and ``text`` are not null.

    Of a language with more than ``bound`` such rows, a hash of the row (its id,
    if it has one, and text) picks about that many; other languages are learnt
    whole. Priors come from all rows. Counts by language and bucket are summed on
    the executors; the driver gets one number for each at most, and the model never
    exceeds ``MODEL_BYTES`` (ValueError above 16,384 languages). Counts are smoothed
    by one half.
    """
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    documents = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    drawn = F.pmod(F.xxhash64(*[F.col(c) for c in ("doc_id", "text") if c in docs.columns]), F.lit(1 << 30))
    shares = [(x, int((1 << 30) * bound / n)) for x, n in documents.items() if n > bound]
    if shares:
        share = F.broadcast(docs.sparkSession.createDataFrame(shares, "lang string, _share long"))
        rows = rows.select("lang", "text", drawn.alias("_drawn")).join(share, "lang", "left").where(F.col("_share").isNull() | (F.col("_drawn") < F.col("_share")))
    rows = rows.select("lang", "text")
    buckets = buckets_for(len(documents))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch, column in blocks(batches, "text"):
            languages = np.array(batch.column(0).to_pylist(), dtype=object)
            for numbers, part in slices(column):
                names, code = np.unique(languages[numbers], return_inverse=True)
                for bucket, text in features(part, buckets):
                    found = np.bincount(code[text] * buckets + bucket, minlength=len(names) * buckets).reshape(-1, buckets)
                    for name, own in zip(names, found):
                        totals[name] = totals.get(name, 0) + own
        for name, found in totals.items():
            at = np.flatnonzero(found)
            yield pa.record_batch({"lang": pa.array([name] * len(at), pa.string()), "bucket": pa.array(at, pa.int32()), "n": pa.array(found[at], pa.int64())})

    counts = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    languages = tuple(sorted(documents))
    number = {x: i for i, x in enumerate(languages)}
    found = np.full((buckets, len(languages)), 0.5)
    if counts.num_rows:
        at = np.array([number[x] for x in counts["lang"].to_pylist()])
        found[counts["bucket"].to_numpy(), at] += counts["n"].to_numpy()
    weight = np.log(found / found.sum(axis=0)).astype(np.float32)
    prior = np.log(np.array([documents[x] for x in languages], dtype=float) / max(1, sum(documents.values())))
    return Model(languages, weight, prior)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` with ``lang_pred`` and ``score``.

    The prediction is the language of the largest posterior. The score is that
    posterior with the evidence divided by the number of n-gram orders, as the
    n-grams of different orders at one place are not independent. A null text,
    one without letters, and any text under a model of no languages gives
    ``und`` and 0. Ties go to the language first in code point order. Texts of
    any length are scored whole, in parts of bounded size.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch, column in blocks(batches, "text"):
            sums, grams = np.zeros((len(column), len(m.languages))), np.zeros(len(column), dtype=np.int64)
            for numbers, part in slices(column):
                for bucket, text in features(part, len(m.weight)):
                    grams += np.bincount(numbers[text], minlength=len(column))
                    # The n-grams of a text stand together: rows of the matrix, summed by text.
                    step = max(1, _TERMS // max(1, len(m.languages)))
                    for at in range(0, len(bucket), step):
                        own = text[at:at + step]
                        first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
                        added = np.add.reduceat(m.weight[bucket[at:at + step]], first, axis=0, dtype=np.float64)
                        np.add.at(sums, numbers[own[first]], added)
            known = (grams > 0) & bool(len(m.languages))
            names, scores = [UNDETERMINED] * len(column), np.zeros(len(column))
            if m.languages:
                level = sums / len(ORDERS) + m.prior
                best = level.argmax(axis=1)
                share = 1 / np.exp(level - level.max(axis=1, keepdims=True)).sum(axis=1)
                names = [m.languages[b] if k else UNDETERMINED for b, k in zip(best, known)]
                scores = np.where(known, share, 0.0)
            out = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.record_batch([*out, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names, "lang_pred", "score"])

    kept = docs.drop("lang_pred", "score")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(score, f"{kinds}, lang_pred string, score double")


def recognised(docs: DataFrame, model: Model, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` whose language is recognised: not ``und``, and with a
    score of ``least`` or more."""
    # Columns travel under other names, so that none can clash.
    names = {c: c if c == "text" else f"_{i}" for i, c in enumerate(docs.columns)}
    rows = predict(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), model)
    rows = rows.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least))
    return rows.select(*[F.col(n).alias(c) for c, n in names.items()])


def learnt(docs: DataFrame) -> Column:
    """Rows that may be learnt from: those outside the held-out fifth."""
    return F.coalesce(crc_fold(F.col("doc_id")) != 0, F.lit(True))


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    """The language of every document, learnt outside the held-out fifth."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(pick(docs, "doc_id", "lang", "text"), learnt(docs))
    rows = predict(pick(docs, "doc_id", "text"), model)
    return rows.select("doc_id", F.coalesce(crc_fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")
