import collections
import re

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pulseforge.llm import repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts, n):
    words = [WORD.findall(t or "") for t in texts]
    seen = collections.Counter(tuple(w[i:i + n]) for w in words for i in range(len(w) - n + 1))
    out = []
    for w in words:
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - n + 1):
            if seen[tuple(w[i:i + n])] > 1:
                gone[i:i + n] = True
        out.append((len(w), int(gone.sum()), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def result(docs, n):
    rows = repeats.remove_repeats(docs, n).collect()
    return sorted((str(r.doc_id), r.text or "", r.n_words, r.n_removed, r.kept_text) for r in rows)


def expected(docs, n):
    rows = docs.collect()
    return sorted((str(r.doc_id), r.text or "", *b) for r, b in zip(rows, brute([r.text for r in rows], n)))


@pytest.mark.parametrize("n", [35, 8, 3])
def test_against_all_windows(documents, messy, n):
    assert result(documents, n) == expected(documents, n)
    assert result(messy, n) == expected(messy, n)


def test_frequent_anchors_are_dealt_over_shares(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SHARE", 3)
    passage = " ".join(f"p{i}" for i in range(14))
    texts = [f"a{i} b{i % 7} {passage} c{i % 5} d{i}" for i in range(60)] + ["x " * 40, "y x y x y x y x y x y x " * 3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    for n in (12, 16, 17):
        assert result(docs, n) == expected(docs, n)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.lists(st.sampled_from("abc"), max_size=40), max_size=8), n=st.integers(1, 12))
def test_few_words(spark, texts, n):
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    assert result(docs, n) == expected(docs, n)


def test_columns_stay(messy, nothing):
    rows = repeats.remove_repeats(messy)
    assert set(messy.columns) - {"n_words"} <= set(rows.columns)
    assert {(r._id, r.node) for r in rows.collect()} == {("i", "n")}
    assert [r.text for r in rows.where("doc_id = 2").collect()] == [None]
    assert repeats.remove_repeats(nothing).count() == 0


def test_very_many_equal_rows(spark):
    """Equal in id and text, or in text alone; their number is no square anywhere."""
    text = " ".join(f"w{i}" for i in range(120))
    other = " ".join(f"v{i}" for i in range(60))
    rows = spark.range(100_000).selectExpr("cast(null as long) as doc_id", f"'{text}' as text")
    rows = rows.unionByName(spark.range(20_000).selectExpr("id % 3 as doc_id", f"'{other}' as text"))
    rows = rows.unionByName(spark.createDataFrame([(9, "start " + text + " end"), (10, "nothing else")], "doc_id long, text string"))
    found = repeats.remove_repeats(rows.repartition(8)).groupBy("doc_id", "n_words", "n_removed", "kept_text").count().collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text, r["count"]) for r in found) == [
        ("0", 60, 60, "", 6667), ("1", 60, 60, "", 6667), ("10", 2, 0, "nothing else", 1), ("2", 60, 60, "", 6666), ("9", 122, 120, "start end", 1), ("None", 120, 120, "", 100_000)]
