import collections
import math
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pulseforge.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def brute(items, docs, top=10):
    split = lambda t: TERM.findall((t or "").translate(_LOWER))
    counted = [(i, collections.Counter(split(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = collections.Counter(t for _, c in counted for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for i, c in counted:
            m = 25 + (75 * sum(c.values()) * n) // total
            w = lambda t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
            s = sum(w(t) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in split(text) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if no else i, -s) for r, (s, no, i) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=_key)


def _key(row):
    return tuple(-1 if x is None else x for x in row)


def searched(spark, items, docs, top=10):
    items = spark.createDataFrame([(*r, "a", 1) for r in items], "item_id long, text string, terms string, sign int")
    docs = spark.createDataFrame([(*r, "n", 2, "b") for r in docs], "doc_id long, text string, n string, m int, block string").repartition(3)
    return sorted([tuple(r) for r in ranked.search(items, docs, top).collect()], key=_key)


ITEMS = [(1, "Alpha beta GAMMA, alpha!"), (2, "beta gamma delta"), (3, "beta gamma delta epsilon"), (4, None), (5, ""), (6, " .,- "), (7, "nowhere"), (8, "été Été ETÉ"),
         (1, "Alpha beta GAMMA, alpha!"), (1, "zeta"), (None, "gamma"), (9, "the the the alpha"), (10, "long " * 3000 + "beta")]
DOCS = [(1, "alpha beta"), (2, "alpha beta"), (2, "alpha beta"), (3, None), (4, ""), (5, "## !!"), (6, "Gamma-delta_epsilon\x00zeta9 zeta"), (None, "gamma"), (None, None),
        (7, "the alpha " * 9000), (8, "été ä \U00010400 ETÉ"), (9, "beta " * 5 + "gamma"), (10, "delta\x7fepsilon"), (11, "gamma gamma"), (-3, "alpha beta")]


@pytest.mark.parametrize("sizes", [None, {"GROUP_SLOTS": 3, "BLOCK_SLOTS": 6, "SCORE_BYTES": 64}, {"GROUP_SLOTS": 5}])
def test_against_brute_force(spark, monkeypatch, sizes):
    for name, value in (sizes or {}).items():
        monkeypatch.setattr(ranked, name, value)
    assert searched(spark, ITEMS, DOCS) == brute(ITEMS, DOCS)
    assert searched(spark, ITEMS, DOCS, top=2) == brute(ITEMS, DOCS, top=2)


def test_ties_go_to_the_smaller_id(spark):
    docs = [(i, "same words here") for i in range(400, 0, -1)] + [(i + 500, "other text") for i in range(500)]
    assert [r[2] for r in searched(spark, [(1, "words")], docs)] == list(range(1, 11))


def test_empty_tables(spark):
    assert searched(spark, ITEMS, []) == [] and searched(spark, [], DOCS) == [] and searched(spark, [(1, "!")], DOCS) == []
    assert searched(spark, ITEMS, [(1, None), (2, "")]) == []


@given(st.lists(st.sets(st.integers(0, 12)), max_size=14))
@settings(max_examples=200, deadline=None)
def test_shared_nodes_keep_sums(sets):
    lists = [np.array(sorted(s), dtype=np.int64) for s in sets]
    left, right, ends, nodes, node_ends = ranked.share(lists, 13)
    value = [1 << (5 * i) for i in range(13)]
    for a, b in zip(left.tolist(), right.tolist()):
        assert max(a, b) < len(value)  # nodes come after their parts
        value.append(value[a] + value[b])
    starts = [0, *node_ends.tolist()[:-1]]
    for s, a, b in zip(sets, starts, node_ends.tolist()):
        assert sum(value[k] for k in nodes[a:b]) == sum(value[i] for i in s)


def test_items_that_share_terms_share_nodes():
    lists = [np.arange(8), np.arange(8), np.arange(6), np.array([6, 7])]
    left, _, _, nodes, ends = ranked.share(lists, 8)
    assert ends.tolist()[1] == 2 * ends.tolist()[0] and nodes[0] == nodes[ends[0]]
    assert len(left) + len(nodes) - len(lists) < sum(len(x) - 1 for x in lists)
