import collections
import re

import pytest

from pulseforge.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shares(sizes, weights=(3.0, 1.0, 2.0), budget=1.5, repeats=2.0):
    """Share by weight, cut at the limit, share what is over again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    rest, open_ = budget * sum(sizes.values()), set(names)
    while open_ and rest > 1e-9:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += rest * weight[s] / total
        rest = 0.0
        for s in list(open_):
            over = target[s] - repeats * sizes[s]
            if over >= 0:
                target[s], rest = repeats * sizes[s], rest + over
                open_.remove(s)
    return target


def sizes_of(docs):
    sizes = collections.Counter()
    for r in docs.select("text", "source").collect():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    return sizes


def test_targets_and_draws(documents, messy):
    for docs in (documents, messy):
        sizes, rows = sizes_of(docs), mixing.mix(docs).collect()
        goal = shares(sizes)
        assert len(rows) == docs.count()
        for r in rows:
            assert r.source_size == sizes[r.source] and r.target == pytest.approx(goal[r.source], abs=1e-6)
            rate = r.target / r.source_size if r.source_size else 0
            assert int(rate) <= r.copies <= min(2, int(rate) + 1) and r.copies >= 0
        assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs.repartition(5)).collect()))


def test_sources_come_near_their_targets(spark):
    rows = [(i, " ".join("w" * (1 + i * 37 % 90)).strip(), ("hot", "a", "b")[0 if i % 3 else i % 2 + 1]) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken, goal = collections.Counter(), {}
    for r in mixing.mix(docs).collect():
        taken[r.source] += r.copies * r["size"]
        goal[r.source] = r.target
    assert all(taken[s] == pytest.approx(goal[s], rel=0.03) for s in goal)


@pytest.mark.parametrize("hot", [lambda i: (None, f"w w w{i}"), lambda i: (None, "w w w"), lambda i: (5, "w w w")])
def test_repeated_ids_do_not_decide_alone(spark, hot):
    rows = [(*(hot(i) if i % 2 else (i, "w w w")), ("hot", "a", "b")[0 if i % 3 else i % 2 + 1]) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    taken, goal = collections.Counter(), {}
    for r in mixing.mix(docs).collect():
        taken[r.source] += r.copies * r["size"]
        goal[r.source] = r.target
    assert all(taken[s] == pytest.approx(goal[s], rel=0.03) for s in goal)
    assert sum(len(r.text.split()) for r in mixing.emit(docs).collect()) == sum(taken.values())
    assert sorted(map(str, mixing.mix(docs).collect())) == sorted(map(str, mixing.mix(docs.repartition(3)).collect()))


def test_emitted_rows_are_the_copies(messy, nothing):
    wanted = collections.Counter()
    for r in mixing.mix(messy).collect():
        wanted[r.doc_id, r.source] += r.copies
    rows = mixing.emit(messy)
    assert rows.columns == messy.columns
    assert collections.Counter((r.doc_id, r.source) for r in rows.collect()) == +wanted
    assert {(r["size"], r.copies) for r in rows.collect()} == {("z", "c")}
    assert mixing.mix(nothing).count() == 0 and mixing.emit(nothing).count() == 0
