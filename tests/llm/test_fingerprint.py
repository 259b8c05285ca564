import hashlib
import re

import pytest
from pyspark.sql import functions as F

from pulseforge.llm import fingerprint


def expected(rows):
    """(doc_id, n_chars, sha of the edited text) by lists."""
    least = {}
    for i, t in rows:
        if i is not None:
            least[i] = min(least.get(i, t or ""), t or "", key=lambda x: x.encode())
    order = sorted(least)
    after = dict(zip(order, order[1:] + order[:1]))
    out = []
    for i, t in rows:
        t = t or ""
        other = least[after[i]] if i is not None else least[order[0]] if order else ""
        half = len(t) // 2
        out.append((str(i), len(t), hashlib.sha256((t[:len(t) - half] + other[:half]).encode()).hexdigest()))
    return sorted(out)


def test_edited_texts(documents, messy):
    for docs in (documents, messy):
        rows = fingerprint.compare_with_next(docs).collect()
        assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in rows) == expected([(r.doc_id, r.text) for r in docs.collect()])
        assert all(0 <= x <= 1 for r in rows for x in (r.near_edited, r.near_next))
        assert len({r.fingerprint for r in rows}) == len({r.text or "" for r in docs.collect()})


def test_half_kept_is_half_alike(documents):
    rows = [r for r in fingerprint.compare_with_next(documents).collect() if r.n_chars > 400]
    assert sum(r.near_edited for r in rows) / len(rows) == pytest.approx(0.5, abs=0.1)
    assert sum(r.near_next for r in rows) / len(rows) < 0.15


def trees(spark, texts):
    """name -> (leaves, paragraphs, sections, root, nodes) of named texts."""
    docs = spark.createDataFrame(list(texts.items()), "name string, text string")
    docs = docs.withColumn("l", fingerprint.leaves(F.col("text"))).withColumn("p", fingerprint.paragraphs(F.col("l"))).withColumn("s", fingerprint.sections(F.col("p")))
    return docs.withColumn("r", fingerprint.root(F.col("s"))).withColumn("n", fingerprint.nodes(F.col("l"), F.col("p"), F.col("s")))


def compared(spark, texts, first="a"):
    """name -> (likeness, same root, sections and paragraphs that differ) against the first."""
    nodes = trees(spark, texts).drop("l", "text")
    one = nodes.where(F.col("name") == first).select(*[F.col(c).alias(f"{c}0") for c in "psrn"])
    both = nodes.join(one).withColumn("ds", fingerprint.differences(F.col("s0"), F.col("s")))
    both = both.select("name", fingerprint.likeness(F.col("n0"), F.col("n")).alias("near"), (F.col("r") == F.col("r0")).alias("same"), "ds", fingerprint.differences_below(F.col("ds"), F.col("p0"), F.col("p")).alias("dp"))
    return {r.name: (r.near, r.same, r.ds, r.dp) for r in both.collect()}


def test_tree_tells_all_that_differs(spark):
    lines = [f"line number {i}" for i in range(40)]
    changed = lambda *at: "\n".join("other" if i in at else x for i, x in enumerate(lines))
    found = compared(spark, {"a": "\n".join(lines), "b": "\n".join(lines), "c": changed(20), "d": "\n".join(lines + ["more"]), "e": "", "f": changed(0, 3, 39)})
    assert {n: v[1:] for n, v in found.items()} == {
        "a": (True, [], []), "b": (True, [], []), "c": (False, [1], [20]), "d": (False, [2], [40]), "e": (False, [0, 1, 2], list(range(40))), "f": (False, [0, 2], [0, 3, 39])}
    assert found["a"][0] == found["b"][0] == 1 and 0.9 < found["c"][0] < 1 and found["e"][0] == 0


def test_a_small_change_leaves_most_alike(spark):
    words = [f"word{i * 7919 % 1009}" for i in range(300)]
    text = " ".join(words)
    found = compared(spark, {
        "a": text, "front": "x" + text, "word": "new " + text, "middle": " ".join(words[:150] + ["new", "ones"] + words[150:]), "gone": " ".join(words[:40] + words[45:]),
        "none": " ".join(f"else{i}" for i in range(300))})
    assert all(0.85 <= found[n][0] < 1 for n in ("front", "word", "middle", "gone")) and found["front"][0] >= 0.9 and found["none"][0] < 0.05


def test_only_equal_trees_are_alike_throughout(spark):
    """Order, repeats and lengths count."""
    texts = {"a": "x" * 160, "b": "x" * 16, "c": "x" * 159, "d": "one two\nthree four", "e": "three four\none two", "f": "one two\none two\nthree four", "g": "", "h": "\n", "i": " ", "j": "one two three four"}
    for name in texts:
        found = compared(spark, texts, name)
        assert {n for n, v in found.items() if v[0] == 1} == {n for n, v in found.items() if v[1]} == {name}
        assert all(0 <= v[0] <= 1 for v in found.values())


def test_nodes_are_hashes_of_what_is_below(spark):
    text = "x\n\nSome words that make a line, some of which end a leaf  and more"
    (r,) = trees(spark, {"t": text}).collect()
    sha = lambda parts: hashlib.sha256("".join(parts).encode()).hexdigest()
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    want = []
    for line in text.split("\n"):
        tokens = re.findall("[^ ]{0,63}[^ ] ?| ", line)
        assert "".join(tokens) == line
        want.append([md5(x) for x in "".join(t + ("\n" if md5(t) < "3" else "") for t in tokens).rstrip("\n").split("\n")])
    assert r.l == want and len(want[2]) > 1
    assert r.p == [sha(x) for x in want] and r.s == [sha(r.p)] and r.r == sha(r.s)
    assert len(r.n) == sum(map(len, want)) + 3 + 1 + 1


def test_nothing(nothing):
    assert fingerprint.compare_with_next(nothing).count() == 0


def test_no_python_on_the_way(documents):
    plan = fingerprint.compare_with_next(documents)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
