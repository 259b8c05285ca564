import numpy as np
import pytest
from pyspark.sql import functions as F

from pulseforge.llm import neighbours


def brute(vectors, query, top):
    """Exact nearest by numpy in double precision."""
    scores = []
    for i, v in vectors.items():
        if i != query and len(v) == len(vectors[query]):
            scores.append((-float(np.dot(v, vectors[query])), i))
    return [i for _, i in sorted(scores)[:top]]


def recall(rows, vectors, top):
    found = {}
    for r in rows:
        assert r.score == pytest.approx(float(np.dot(vectors[r.query_id], vectors[r.vec_id])), rel=1e-12, abs=1e-12)
        assert r.vec_id != r.query_id
        found.setdefault(r.query_id, []).append((r["rank"], -r.score, r.vec_id))
    hits = []
    for q, got in found.items():
        got.sort()
        assert [g[0] for g in got] == list(range(1, len(got) + 1)) and [g[1:] for g in got] == sorted(g[1:] for g in got)
        want = brute(vectors, q, top)
        assert len(got) == len(want)
        hits.append(len({g[2] for g in got} & set(want)) / len(want))
    return np.mean(hits), set(found)


def test_recall_over_shards(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_VECTORS", 300)
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").where("vec_id < 1200")
    vectors = {r.vec_id: np.array(r.embedding, dtype=float) for r in table.collect()}
    got, queries = recall(neighbours.search(table, F.col("vec_id") % 20 == 0).collect(), vectors, 20)
    assert got >= 0.95 and queries == {i for i in vectors if i % 20 == 0}


def test_clusters_lengths_and_copies(spark):
    rng = np.random.default_rng(5)
    near = rng.normal(size=12) + rng.normal(size=(300, 12)) * 1e-4  # one very common vector, a little changed
    spread = rng.normal(size=(300, 12)) * rng.uniform(0.1, 9, size=(300, 1))
    same = np.repeat(rng.normal(size=(1, 12)), 90, axis=0)
    x = np.concatenate([near, spread, same])
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    vectors = dict(enumerate(x))
    rows = neighbours.search(table, F.col("vec_id") % 15 == 0, top=10).collect()
    assert recall(rows, vectors, 10)[0] >= 0.9
    first = [r.vec_id for r in sorted(rows, key=lambda r: r["rank"]) if r.query_id == 600 and r.vec_id >= 600]
    assert first == sorted(first)


@pytest.mark.parametrize("huge", [1e8, 1e30, 1e160])
def test_one_huge_vector(spark, huge):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(800, 12))
    x /= np.sqrt((x**2).sum(axis=1, keepdims=True))
    x[7] *= huge
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows = neighbours.search(table, F.col("vec_id") % 40 == 0, top=10).collect()
    assert recall(rows, dict(enumerate(x)), 10)[0] >= 0.95


def test_products_beyond_doubles(spark):
    rows = [(0, [1e200, -1e200]), (1, [1e200, 1e200]), (2, [2e200, 0.0]), (3, [3e200, 0.0]), (4, [1e-300, 0.0]), (5, [2e-300, 0.0]), (6, [0.0, 9e307])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted((r["rank"], r.vec_id, r.score) for r in neighbours.search(table, F.col("vec_id") == 0).collect())
    inf = float("inf")
    assert [f[:2] for f in found] == [(1, 3), (2, 2), (3, 5), (4, 4), (5, 1), (6, 6)]
    assert [f[2] for f in found] == [inf, inf, pytest.approx(2e-100), pytest.approx(1e-100), 0.0, -inf]


def test_unusable_rows_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (20, [2.0, 1.0]), (40, None), (60, [0.0, 0.0]), (80, [1.0, None]), (100, [nan, 1.0]), (120, [inf, 1.0]), (None, [1.0, 1.0]),
            (0, [1.0, 2.0]), (7, [1.0, 2.0, 3.0]), (140, [3.0, 0.0, 0.0]), (160, []), (180, [5.0]), (3, [-1.0, -1.0])]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, shard string")
    found = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in neighbours.search(table, F.col("vec_id") % 20 == 0).collect())
    # Rows that share an id are queries and candidates each.
    assert found == [*[(0, 1, 0, 5.0)] * 2, *[(0, 2, 20, 4.0)] * 2, *[(0, 3, 3, -3.0)] * 2, (20, 1, 0, 4.0), (20, 2, 0, 4.0), (20, 3, 3, -3.0), (140, 1, 7, 3.0)]
    assert neighbours.search(table.where("false"), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("many", [119, 1000])
def test_ties_of_different_vectors_go_to_smaller_ids(spark, many):
    """All products with the query are equal, no two vectors are."""
    rng = np.random.default_rng(8)
    rows = [(0, [1.0, 0.0, 0.0, 0.0])] + [(i, [1.0, *(rng.integers(-512, 512, 3) / 256).tolist()]) for i in range(1, many + 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = neighbours.search(table, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in found] == [(i, 1.0) for i in range(1, 21)]


def test_pruning_keeps_no_neighbour_behind_another():
    x = np.array([[0, 0], [1, 0], [2, 0], [0, 3], [9, 9]], dtype=np.float32)
    kept = neighbours.prune(x, np.array([0]), np.array([[1, 2, 3, 1, 5, 0]]), 4, 1.2)
    assert kept.tolist() == [[1, 3, 5, 5]]
