import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pulseforge.llm import langid


def plain(texts, langs, queries):
    """The same model by dictionaries of n-gram strings."""
    def grams(text):
        letters = "".join(c if c.isalpha() else " " for c in text.lower())
        out, last = [], ""
        for c in letters:
            if c != " " or last != " ":
                out.append(c)
            last = c
        s = "".join(out)
        return [s[i:i + n] for n in langid.ORDERS for i in range(len(s) - n + 1) if s[i:i + n].strip()]

    names = sorted(set(langs))
    counts = {x: {} for x in names}
    for t, x in zip(texts, langs):
        for g in grams(t):
            counts[x][g] = counts[x].get(g, 0) + 1
    total = {x: sum(counts[x].values()) + langid.BUCKETS / 2 for x in names}
    out = []
    for q in queries:
        level = [sum(np.log((counts[x].get(g, 0) + 0.5) / total[x]) for g in grams(q)) / len(langid.ORDERS) + np.log(langs.count(x) / len(langs)) for x in names]
        out.append(names[int(np.argmax(level))])
    return out


def test_against_dictionaries(spark):
    texts = ["the cat and the dog", "le chat et le chien", "der hund und die katze", "the end, of it", "la fin de tout", "das ende von allem"]
    langs = ["en", "fr", "de"] * 2
    queries = ["The DOG, 12!", "chien###chat", "katze", "the", "et le", "und die x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").join(spark.createDataFrame(list(enumerate(langs)), "doc_id long, lang string"), "doc_id")
    model = langid.fit(docs, F.lit(True))
    asked = spark.createDataFrame(list(enumerate(queries)), "doc_id long, text string")
    rows = sorted(langid.predict(asked, model).collect())
    assert [r.lang_pred for r in rows] == plain(texts, langs, queries)
    assert all(1 / 3 <= r.score <= 1 for r in rows)


def test_held_out_accuracy(spark):
    rows = langid.op2_language_id(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = rows.join(truth, "doc_id").collect()
    assert len(rows) == truth.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out and r.lang]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) >= 0.97


def test_messy_rows(messy, nothing, monkeypatch):
    model = langid.fit(messy, langid.learnt(messy))
    assert model.languages == ("de", "en", "fr")
    rows = langid.predict(messy, model).collect()
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and (r.score > 0) == letters
    whole = {(r.doc_id, r.text): r.score for r in rows}
    monkeypatch.setattr(langid, "_SLICE", 1000)
    cut = langid.predict(messy.where("doc_id = 6"), model).collect()
    assert cut[0].score == pytest.approx(whole[6, cut[0].text])
    kept = langid.recognised(messy, model)
    assert kept.columns == messy.columns and {(r.score, r.lang_pred) for r in kept.collect()} == {("s", 5)}
    assert langid.predict(nothing, model).count() == 0
    empty = langid.fit(nothing, F.lit(True))
    assert {(r.lang_pred, r.score) for r in langid.predict(messy, empty).collect()} == {("und", 0.0)}


def test_bounded_sample_still_learns(documents):
    model = langid.fit(documents, F.lit(True), bound=60)
    rows = langid.predict(documents, model).where("lang is not null").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.9


def test_every_language_is_learnt_under_the_bound(spark):
    # A third of the large language are exact copies, the small one has few rows.
    rows = [(i, "en", "the same words again" if i % 3 == 0 else f"{'abcde'[i % 5] * 3} and {'fghij'[i % 7 % 5]} the") for i in range(3000)]
    rows += [(3000 + i, "xx", f"zzq qzz zqz {'uvw'[i % 3]}") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = langid.fit(docs, F.lit(True), bound=300)
    assert model.languages == ("en", "xx")
    assert np.exp(model.prior) == pytest.approx([3000 / 3006, 6 / 3006])
    # Only the copies have an 'm', each one; a bucket never seen counts one half.
    bucket = next(part[0] for part, _ in langid.features(pa.array(["m"], pa.large_string())) if len(part))
    copies = (np.exp(model.weight[bucket, 0] - model.weight[:, 0].min()) - 1) / 2
    assert 60 <= copies <= 150
    assert {r.lang_pred for r in langid.predict(docs.where("lang = 'xx'"), model).collect()} == {"xx"}


def test_very_many_languages(spark, monkeypatch):
    """The model stays within its bound; above it there is an error, no silent choice."""
    assert [langid.buckets_for(n) for n in (0, 4, 128, 129, 10_000, 16_384)] == [1 << 15, 1 << 15, 1 << 15, 1 << 14, 1 << 8, 1 << 8]
    with pytest.raises(ValueError):
        langid.buckets_for(16_385)
    monkeypatch.setattr(langid, "MODEL_BYTES", 1 << 18)
    rows = [(i, f"l{i % 200:03d}", " ".join(f"{'abcdefghijklmnopqrst'[(i % 200 + k * (1 + i % 200 // 20)) % 20]}{'uvwxyz'[i % 200 // 34]}" for k in range(30))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = langid.fit(docs, F.lit(True))
    assert model.weight.shape == (256, 200) and model.weight.nbytes <= 1 << 18
    found = langid.predict(docs, model).collect()
    assert sum(r.lang == r.lang_pred for r in found) / len(found) > 0.9


def test_sums_of_long_texts_are_cut_evenly(spark, monkeypatch):
    text = "the quick brown fox and der schnelle braune Fuchs " * 400
    docs = spark.createDataFrame([(1, "en", "the quick brown fox and"), (2, "de", "der schnelle braune Fuchs"), (3, None, text), (4, None, "")], "doc_id long, lang string, text string")
    model = langid.fit(docs, F.lit(True))
    whole = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs, model).collect()}
    monkeypatch.setattr(langid, "_TERMS", 7)
    assert {r.doc_id: (r.lang_pred, pytest.approx(r.score)) for r in langid.predict(docs, model).collect()} == whole
