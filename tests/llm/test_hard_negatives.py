import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulseforge.llm import hard_negatives
from pulseforge.llm.hard_negatives import strassen

SCHEMA = "vec_id long, embedding array<double>, label int, row string, asked string, windows int, id string"


def table(spark, rows):
    return spark.createDataFrame([(i, v if v is None else [None if x is None else float(x) for x in v], k, "r", "a", 3, "i") for i, v, k in rows], SCHEMA)


def brute(rows, anchor, positives=5, negatives=3, factor=256):
    whole = [(i, [int(np.floor(factor * x)) for x in v], k) for i, v, k in rows]
    out = []
    for n, (a, x, label) in enumerate(whole):
        if a is None or not anchor(a):
            continue
        others = [(-sum(p * q for p, q in zip(x, y)), i is None, i or 0, k) for m, (i, y, k) in enumerate(whole) if m != n and len(x) == len(y)]
        others.sort()
        for s, no, i, _ in [o for o in others if o[3] == label][:positives]:
            fits = [o for o in others if o[3] != label and 50 * -s <= 100 * -o[0] <= 95 * -s]
            out += [(a, None if no else i, r + 1, None if o[1] else o[2], -s, -o[0]) for r, o in enumerate(fits[:negatives])]
    return sorted(out, key=_key)


def _key(row):
    return tuple(-1 if x is None else x for x in row)


def mined(frame, **more):
    return sorted([tuple(r) for r in hard_negatives.mine(frame, F.col("vec_id") % 10 == 0, F.col("label"), **more).collect()], key=_key)


@given(st.integers(1, 40), st.integers(1, 40), st.integers(0, 40), st.integers(1, 9), st.booleans())
@settings(max_examples=60, deadline=None)
def test_strassen_is_exact(m, n, d, plain, large):
    rng = np.random.default_rng(m * 1681 + n * 41 + d)
    most = (1 << 62) if large else 1000  # large: sums wrap around, as the plain product's do
    a, b = rng.integers(-most, most, (m, d)), rng.integers(-most, most, (n, d))
    assert (strassen(a, b, plain) == a @ b.T).all()


@pytest.mark.parametrize("sizes", [None, {"BLOCK_ANCHORS": 3, "RUN": 20, "TILE": 2, "PLAIN": 1}, {"TILE": 7}])
def test_all_pairs_are_seen(spark, monkeypatch, sizes):
    for name, value in (sizes or {}).items():
        monkeypatch.setattr(hard_negatives, name, value)
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=5) + 1).tolist(), int(rng.integers(0, 3) ** 2 // 2)) for i in range(180)]
    want = brute(rows, lambda i: i % 10 == 0)
    assert len(want) > 100 and mined(table(spark, rows)) == want


def test_ties_copies_and_a_hot_label(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "RUN", 30)
    rows = [(i, [1.0, 1.0], 1) for i in range(60, 0, -1)] + [(100 + i, [1.0, 0.5], 2) for i in range(40, 0, -1)] + [(200 + i, [0.75, 0.75 - i / 100], 3) for i in range(30)]
    assert mined(table(spark, rows)) == brute(rows, lambda i: i % 10 == 0)


def test_what_takes_no_part(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [1.0, 1.0], 1), (1, [1.0, 0.9], 1), (2, [0.8, 0.7], 2), (3, [0.0, 0.0], 1), (None, [0.9, 0.9], 1), (None, [0.7, 0.8], 2), (0, [1.0, 1.0], 1),
            (10, [-1.0, -1.0], 2), (20, [1.0, 2.0, 3.0], 1), (30, [], 5), (31, [], 5), (32, [], 6), (40, [3.0], 9), (4, [0.6, 0.9], 2)]
    wrong = [(50, None, 1), (60, [1.0, nan], 1), (70, [1.0, None], 2), (5, [inf, 1.0], 2), (80, [1.0, 1.0], None), (6, [0.8, 0.8], None)]
    want = brute(good, lambda i: i % 10 == 0)
    assert any(w[3] is None for w in want) and any(w[1] is None for w in want)
    assert mined(table(spark, good + wrong)) == want
    assert mined(table(spark, good).where("false")) == [] and mined(table(spark, good[1:3])) == []


def test_products_beyond_doubles(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=4) * (1 << 20)).tolist(), i % 3) for i in range(60)]
    rows = [(i, [float(np.floor(x)) for x in v], k) for i, v, k in rows]
    assert mined(table(spark, rows)) == brute(rows, lambda i: i % 10 == 0)
