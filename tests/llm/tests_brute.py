"""Plain versions that the pipeline's stages are held against."""

import collections
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def near_classes(rows, threshold=0.8, n=5):
    """The least doc_id of each class of near-duplicates."""
    sets = {}
    for r in rows:
        w = WORD.findall(r.text)
        sets[r.doc_id] = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in sets:
            if j < i and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {find(i) for i in sets}


def without_repeats(texts, n):
    words = [WORD.findall(t) for t in texts]
    seen = collections.Counter(tuple(w[i:i + n]) for w in words for i in range(len(w) - n + 1))
    out = []
    for t, w in zip(texts, words):
        gone = {k for i in range(len(w) - n + 1) if seen[tuple(w[i:i + n])] > 1 for k in range(i, i + n)}
        out.append(" ".join(x for i, x in enumerate(w) if i not in gone) if gone else t)
    return out
