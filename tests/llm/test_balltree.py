import numpy as np
import pytest
from pyspark.sql import functions as F

from pulseforge.llm import balltree

SCHEMA = "vec_id long, embedding array<double>, row string, task int, kth string, id string, shard binary"
REST = ("x", 1, "y", "z", None)


def table(spark, rows):
    return spark.createDataFrame([(i, v if v is None else [None if x is None else float(x) for x in v], *REST) for i, v in rows], SCHEMA)


def found(rows):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in rows)


def brute(vectors, queries, top, factor=1024):
    """``vectors``: (id, components) of usable rows."""
    whole = [(i, [int(np.floor(factor * x)) for x in v]) for i, v in vectors]
    out = []
    for k, (q, a) in enumerate(whole):
        if q is not None and queries(q):
            scores = [(-sum(x * y for x, y in zip(a, b)), i is None, i or 0) for n, (i, b) in enumerate(whole) if n != k and len(a) == len(b)]
            out += [(q, n + 1, None if no else i, -s) for n, (s, no, i) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=lambda x: (x[0], x[1]))


@pytest.fixture
def small_parts(monkeypatch):
    """Many shards, rounds, leaves and parts of queries from few rows."""
    monkeypatch.setattr(balltree, "SHARD_VECTORS", 24)
    monkeypatch.setattr(balltree, "LEAF", 5)
    monkeypatch.setattr(balltree, "TASK_QUERIES", 3)
    monkeypatch.setattr(balltree, "AT_ONCE", 2)
    monkeypatch.setattr(balltree, "GROWTH", 3)


def test_rounds_over_shards(spark, small_parts):
    x = np.random.default_rng(1).normal(size=(400, 6)) * np.random.default_rng(2).uniform(0.1, 5, size=(400, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = found(balltree.search(table(spark, rows), F.col("vec_id") % 20 == 0, top=7).collect())
    assert got == brute(rows, lambda i: i % 20 == 0, 7)


def test_ties_and_copies(spark, small_parts):
    """A third of all rows are copies, and 120 different vectors tie."""
    rows = [(i, [1.0, 2.0, 0.0]) for i in range(150, 0, -1)] + [(1000 + i, [1.0, 0.0, i]) for i in range(120, 0, -1)] + [(2000 + i, [0, i, 1]) for i in range(90)]
    rows.append((2100, [1, 0, 0]))
    got = found(balltree.search(table(spark, rows), F.col("vec_id") % 50 == 0, top=9).collect())
    assert got == brute(rows, lambda i: i % 50 == 0, 9)
    assert [g[2] for g in got if g[0] == 2100] == list(range(1, 10))


def test_what_takes_no_part(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [1.0, 2.0]), (100, [2.0, 1.0]), (7, [-1.0, -1.0]), (None, [5.0, 5.0]), (None, [-9.0, 0]), (8, [0.0, 0.0]), (0, [1.0, 2.0]), (200, []), (9, []), (300, [4.0]), (1, [1, 2, 3.0])]
    wrong = [(400, None), (500, [nan, 1.0]), (600, [1.0, None]), (10, [inf, 1.0]), (11, [-inf, 1.0])]
    got = balltree.search(table(spark, good + wrong), F.col("vec_id") % 100 == 0).collect()
    key = lambda x: (x[0], x[1], x[2] or 0)
    assert sorted([(r.query_id, r["rank"], r.vec_id, r.score) for r in got], key=key) == sorted(brute(good, lambda i: i % 100 == 0, 10), key=key)
    assert balltree.search(table(spark, [(1, [1.0])]), F.col("vec_id") % 100 == 0).count() == 0
    empty = balltree.search(table(spark, good).where("false"), F.col("vec_id") % 100 == 0)
    assert empty.count() == 0 and empty.columns == ["query_id", "rank", "vec_id", "score"]


def test_large_components(spark):
    """Products beyond 2^53 stay exact, components too large for 64 bits are held."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-(1 << 20), 1 << 20, 4).astype(float).tolist()) for i in range(60)] + [(60, [float(1 << 20) - 1] * 4), (61, [float(1 << 20) - 2] * 4)]
    got = found(balltree.search(table(spark, rows), F.col("vec_id") % 20 == 0, top=10).collect())
    assert got == brute(rows, lambda i: i % 20 == 0, 10)
    rows = [(0, [1e300, 1.0]), (1, [1e200, 5.0]), (2, [1.0, 1.0]), (3, [-1e300, 0.0])]
    got = found(balltree.search(table(spark, rows), F.col("vec_id") == 0).collect())
    assert [g[2] for g in got] == [1, 2, 3] and got[0][3] > 1 << 61 and got[2][3] < -(1 << 61)


def test_bounds_hold(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(-3000, 3000, (300, 5))
    tree = balltree.BallTree(x, np.arange(300), 8)
    q = rng.integers(-3000, 3000, (40, 5))
    bound, y = tree.bounds(q), x[tree.order]
    for k, (a, b) in enumerate(zip(tree.low, tree.high)):
        assert ((q @ y[a:b].T).max(axis=1) <= bound[:, k]).all()
        assert tree.first[k] == tree.order[a:b].min() and (tree.child[k] > 0) == (b - a > 8)
