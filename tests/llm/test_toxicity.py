import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulseforge.llm import toxicity


def index_of(counts, size):
    n = len(counts)
    idf = np.linspace(1, 2, size)
    some = toxicity.vectors(counts, idf)
    weight = np.zeros((-(-n // toxicity.BLOCK), size, toxicity.BLOCK), dtype=np.float32)
    owner = np.repeat(np.arange(n), np.diff(some.start))
    weight[owner // toxicity.BLOCK, some.word, owner % toxicity.BLOCK] = some.value
    return toxicity.Examples({}, idf, weight, weight.max(axis=2).T, np.arange(n), np.zeros(n), np.ones(n)), some


@settings(max_examples=60, deadline=None)
@given(st.lists(st.dictionaries(st.integers(0, 9), st.integers(1, 3), max_size=5), min_size=1, max_size=200), st.integers(1, 20))
def test_blocks_left_out_change_nothing(counts, k):
    index, some = index_of(counts, 10)
    dense = np.zeros((len(counts), 10))
    for i, c in enumerate(counts):
        dense[i, some.word[some.start[i]:some.start[i + 1]]] = some.value[some.start[i]:some.start[i + 1]]
    found, cosine = toxicity.nearest(index, some, k)
    every = dense @ dense.T
    for i in range(len(counts)):
        best = np.sort(every[i][every[i] > 0])[::-1][:k]
        assert cosine[i][:len(best)] == pytest.approx(best, abs=1e-6) and (cosine[i][len(best):] == 0).all()
        assert (found[i][:len(best)] >= 0).all() and len(set(found[i][:len(best)])) == len(best)


@given(st.lists(st.tuples(st.floats(0, 1), st.booleans()), min_size=1, max_size=40))
def test_rising_curve(points):
    x, y = (np.array(v, dtype=float) for v in zip(*points))
    at, level = toxicity.rising(x, y, np.ones(len(x)))
    assert (np.diff(level) >= 0).all() and (np.diff(at) >= 0).all() and 0 <= level.min() and level.max() <= 1


def test_held_out_documents(spark):
    rows = toxicity.op5_toxicity(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    rows = rows.join(labels, "doc_id").drop("evidence").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    y, p = np.array([r.toxic for r in held]), np.array([r.predicted for r in held])
    assert (y == p).mean() >= 0.97 and p[y == 1].mean() >= 0.85 and p[y == 0].mean() <= 0.02


def test_messy_rows(spark, messy, nothing):
    docs = messy.select("doc_id", F.concat_ws(" ", "text", F.when(F.col("doc_id") % 2 == 0, F.lit("vile"))).alias("text"), "node")
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(1, 14)] + [(3, 0), (99, 1), (None, 1), (5, None)], "doc_id long, toxic int")
    index = toxicity.fit(docs, labels, F.lit(True))
    rows = toxicity.score(messy, index).collect()
    assert len(rows) == messy.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in rows if r.doc_id in (2, 3)} == {index.base}
    assert toxicity.score(nothing, index).count() == 0
    none = toxicity.fit(nothing, labels, F.lit(True))
    assert {(r.score, r.predicted) for r in toxicity.score(messy, none).collect()} == {(0.0, 0)}
