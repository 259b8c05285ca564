import collections

import pytest

import corpus_pipeline
from pulseforge.llm import tokens
from tests_brute import near_classes, without_repeats


def test_every_stage_against_brute_force(spark, documents):
    docs, names = documents, documents.columns
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5

    kept = stages["language identification"](spark, docs, "").collect()
    before = docs.collect()
    assert set(kept) <= set(before)
    assert {r.doc_id for r in before} - {r.doc_id for r in kept} == {r.doc_id for r in before if not any(c.isalpha() for c in r.text)}

    docs = spark.createDataFrame(kept, docs.schema)
    found = stages["n-gram Jaccard join"](spark, docs, "").collect()
    assert sorted(r.doc_id for r in found) == sorted(near_classes(kept))

    docs = spark.createDataFrame(found, docs.schema)
    rows = {r.doc_id: r for r in stages["substring dedup"](spark, docs, "").collect()}
    texts = without_repeats([r.text for r in found], 35)
    assert [rows[r.doc_id].text for r in found] == texts and [rows[r.doc_id].n_chars for r in found] == [len(t) if t != r.text else r.n_chars for t, r in zip(texts, found)]

    docs = spark.createDataFrame(list(rows.values()), docs.schema)
    mixed = stages["mixing sources"](spark, docs, "")
    assert mixed.columns == names
    many = collections.Counter(r.doc_id for r in mixed.collect())
    assert set(many) <= set(rows) and max(many.values()) == 2
    words = lambda rs: sum(len(r.text.split()) for r in rs)
    assert words(mixed.collect()) == pytest.approx(1.5 * words(rows.values()), rel=0.06)

    packed = stages["best-fit packing"](spark, mixed, "").collect()
    size = {i: len(tokens.encoder().ids(r.text)) + 1 for i, r in rows.items()}
    assert sum(r.length for r in packed) == sum(size[i] * n for i, n in many.items())


def test_stages_take_messy_and_empty_tables(spark, messy, nothing):
    for docs in (messy, nothing):
        for name, stage in corpus_pipeline.STAGES:
            rows = stage(spark, docs, "")
            if name != "best-fit packing":
                assert rows.columns == docs.columns or name == "substring dedup"
                docs = spark.createDataFrame(rows.collect(), rows.schema)
        assert rows.count() >= (1 if docs.count() else 0)
