import collections
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pulseforge.llm import similar
from pulseforge.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BIG = similar.NO_ID


def grams(text, n=5):
    w = WORD.findall(text or "")
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute(rows, threshold=0.8):
    sets = [grams(r.text) for r in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            union = len(sets[i] | sets[j])
            if both >= threshold * union - 1e-9:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        at = find(i)
        least[at] = min(least.get(at, BIG), BIG if r.doc_id is None else r.doc_id)
    none = lambda x: None if x == BIG else x
    return sorted((str(r.doc_id), str(none(least[find(i)])), links[i]) for i, r in enumerate(rows))


def result(docs, **options):
    return sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in similar.similar(docs, **options).collect())


def variants(n, length, seed):
    """Copies of one text with some words changed."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(length)]
    out = []
    for i in range(n):
        words = base[:]
        for _ in range(rng.randrange(0, 6)):
            words[rng.randrange(length)] = f"x{rng.randrange(40)}"
        out.append(" ".join(words))
    return out


def test_against_all_pairs(documents, messy):
    for docs in (documents, messy):
        assert result(docs) == brute(docs.select("doc_id", "text").collect())


def test_large_groups_are_cut_into_blocks(spark, monkeypatch):
    texts = variants(90, 130, 1) + variants(40, 60, 2) + ["same text for all of these rows"] * 70
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    wanted = brute(docs.collect())
    assert result(docs) == wanted
    monkeypatch.setattr(similar, "BLOCK_NODES", 16)
    monkeypatch.setattr(similar, "BUCKET_NODES", 16)
    assert result(docs) == wanted


def test_one_row_of_each_class_stays(messy, nothing):
    kept = similar.keep_one(messy)
    classes = {r.class_id for r in similar.similar(messy).collect()}
    assert kept.columns == messy.columns and kept.count() == len({str(c) for c in classes})
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(c for c in classes if c is not None)
    assert similar.similar(nothing).count() == 0 and similar.keep_one(nothing).count() == 0


def test_prefixes_are_shortened_to_the_recall():
    assert [similar.prefix_length(t, r) for t, r in ((0.8, 0.9999), (0.8, 0.99), (0.5, 0.9999), (0.95, 0.9999))] == [4, 5, 1, 5]
    assert similar.prefix_length(0.3, 0.999) == 1
    with pytest.raises(ValueError):
        similar.prefix_length(0.3, 0.9999)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.sets(st.integers(0, 40), min_size=1, max_size=30), min_size=1, max_size=9), st.sampled_from([3, 4096]))
def test_overlaps(sets, width):
    values = np.concatenate([np.array(sorted(s), dtype=np.uint64) for s in sets])
    start = np.append(0, np.cumsum([len(s) for s in sets]))
    assert similar.overlaps(values, start, width).tolist() == [[len(a & b) for b in sets] for a in sets]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 19), st.integers(0, 19)), max_size=25))
def test_roots(pairs):
    parent = list(range(20))
    for _ in range(20):
        for a, b in pairs:
            parent[a] = parent[b] = min(parent[a], parent[b])
    a, b = (np.array(x, dtype=np.int64) for x in (zip(*pairs) if pairs else ([], [])))
    assert similar.roots(20, a, b).tolist() == parent


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)] + [(50, 51), (52, 51)]])
def test_components(spark, edges):
    rows = components(spark.createDataFrame(edges, "u long, v long")).collect()
    root = {n: n for e in edges for n in e if e[0] != e[1]}
    for _ in range(len(edges)):
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert collections.Counter((r.node, r.root) for r in rows) == collections.Counter(root.items())
