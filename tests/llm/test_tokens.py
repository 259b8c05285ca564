import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pulseforge.llm import packing, token_counts, tokens

SAMPLES = ["", " ", "a  b", "x\n y", "it's 'll", "éß 日本", "<|endoftext|> hi", "a<|endoftext|>", "\U0001f600　y", "x" * 5000, "\t\r\n" * 9]


@pytest.mark.parametrize("text", SAMPLES)
def test_ids_are_those_of_the_full_tokenizer(text):
    encoder = tokens.encoder()
    assert encoder.ids(text).tolist() == encoder.full.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=("Cs",)), max_size=60))
def test_ids_of_any_text(text):
    encoder = tokens.encoder()
    assert encoder.ids(text).tolist() == encoder.full.encode(text, add_special_tokens=False).ids


def ids_of(text):
    return [*tokens.encoder().full.encode(text or "", add_special_tokens=False).ids, tokens.END_ID]


def test_histogram_against_lists(documents, messy):
    for docs in (documents, messy):
        lengths = np.array([len(ids_of(r.text)) for r in docs.select("text").collect()])
        rows = {r.n_tokens: r for r in token_counts.histogram(docs).collect()}
        assert set(rows) == set(lengths.tolist())
        for n, r in rows.items():
            longer = lengths >= n
            assert (r.n_docs, r.docs_from, r.tokens_from) == ((lengths == n).sum(), longer.sum(), lengths[longer].sum())
            assert r.truncated_tokens == np.minimum(lengths, n).sum() and r.total_tokens == lengths.sum()
            assert r["quantile"] == pytest.approx((lengths <= n).mean())
        table = token_counts.histogram(docs)
        for r in token_counts.at_limits(table, [1, 7, 512, 10**9]).collect():
            assert r.tokens_kept == np.minimum(lengths, r.context_limit).sum()
            assert r.docs_cut == (lengths > r.context_limit).sum() and r.tokens_lost == lengths.sum() - r.tokens_kept
        for r in token_counts.quantiles(table, [0.1, 0.5, 1.0]).collect():
            assert (lengths <= r.n_tokens).mean() >= r.share > (lengths < r.n_tokens).mean()


def test_histogram_of_nothing(nothing):
    assert token_counts.histogram(nothing).count() == 0
    (r,) = token_counts.at_limits(token_counts.histogram(nothing), [5]).collect()
    assert (r.docs_cut, r.tokens_kept, r.tokens_lost) == (0, 0, 0)


def best_fit(lengths, size):
    """Best fit decreasing, piece by piece."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= length]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= length
        else:
            rooms.append(size - length)
    return len(rooms)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=80))
def test_plan_is_best_fit_and_places_each_piece_once(lengths):
    counts = {n: lengths.count(n) for n in set(lengths)}
    used, ranks = {}, {n: [] for n in counts}
    for length, low, high, per, first, offset in packing.plan(counts, 32):
        for rank in range(low, high):
            step = rank - low
            ranks[length].append(rank)
            used.setdefault(first + step // per, []).append((offset + step % per * length, length))
    assert all(sorted(r) == list(range(counts[n])) for n, r in ranks.items())
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 32
    assert len(used) == best_fit(lengths, 32)


def check_packing(docs, size):
    rows = packing.pack(docs, size, with_ids=True).collect()
    pieces = sorted(bytes(r.ids) for r in rows)
    expected = []
    for r in docs.select("text").collect():
        ids = np.array(ids_of(r.text), dtype="<u4")
        head = len(ids) % size if len(ids) > size else len(ids)
        edges = sorted({0, *range(head, len(ids) + 1, size), len(ids)})
        expected += [ids[a:b].tobytes() for a, b in zip(edges, edges[1:])]
    assert pieces == sorted(expected)
    sequences = {}
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(r.ids) and r.length == len(r.ids) // 4
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    assert len(sequences) <= 1.02 * -(-sum(r.length for r in rows) // size) + 1
    return rows


def test_packing_keeps_every_id(documents, messy):
    rows = check_packing(documents, 1024)
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for r in documents.collect():
        parts = sorted(by_doc[r.doc_id], key=lambda p: p.piece)
        assert [p.piece for p in parts] == list(range(len(parts)))
        assert [p.start for p in parts] == np.cumsum([0, *[p.length for p in parts][:-1]]).tolist()
        assert np.frombuffer(b"".join(bytes(p.ids) for p in parts), "<u4").tolist() == ids_of(r.text)
    check_packing(messy, 1024)
    check_packing(messy, 64)


def test_packing_of_nothing(nothing):
    assert packing.pack(nothing).count() == 0
