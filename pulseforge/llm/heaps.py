"""Best entries of many groups at once, in numpy."""

from __future__ import annotations

import numpy as np


def best_rows(group: np.ndarray, score: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """Of each group the ``top`` entries of highest score, ties by id; in order."""
    order = np.lexsort((ids, -score, group))
    g = group[order]
    new = np.flatnonzero(np.append(True, g[1:] != g[:-1])) if len(g) else np.zeros(0, dtype=np.int64)
    place = np.arange(len(g)) - np.repeat(new, np.diff(np.append(new, len(g))))
    return order[place < top]


class Heaps:
    """The ``top`` best (score, id, row) of each of many owners; merges with more."""

    def __init__(self, owners: int, top: int):
        self.top = top
        self.owner, self.score, self.ids, self.row = (np.zeros(0, dtype=np.int64) for _ in range(4))
        #: The score, and with it the id, that an entry must reach to get in.
        self.least = np.full(owners, -(1 << 63), dtype=np.int64)
        self.least_id = np.zeros(owners, dtype=np.int64)

    def improve(self, owners: np.ndarray, score: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Which scores (owners by entries) would get in."""
        least = self.least[owners][:, None]
        return (score > least) | ((score == least) & (ids < self.least_id[owners][:, None]))

    def merge(self, owner: np.ndarray, score: np.ndarray, ids: np.ndarray, row: np.ndarray) -> None:
        if not len(owner):
            return
        both = [np.concatenate(x) for x in ((self.owner, owner), (self.score, score), (self.ids, ids), (self.row, row))]
        kept = best_rows(both[0], both[1], both[2], self.top)
        self.owner, self.score, self.ids, self.row = (x[kept] for x in both)
        last = np.flatnonzero(np.append(self.owner[1:] != self.owner[:-1], True))
        full = last[np.diff(np.append(-1, last)) == self.top]
        self.least[self.owner[full]], self.least_id[self.owner[full]] = self.score[full], self.ids[full]
