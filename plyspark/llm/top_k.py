"""The highest scores of many queries, kept exactly while scores stream by."""

from __future__ import annotations

import numpy as np

HIGHEST = np.iinfo(np.int64).max


class Best:
    """The ``k`` highest scores of each query so far: score, then smallest
    identifier (null last). A new one has to reach ``least``, or to tie with
    it under an identifier of ``least_id`` at most."""

    def __init__(self, least: np.ndarray, k: int, least_id: np.ndarray | None = None):
        self.k, self.least = k, least.astype(np.int64)
        self.least_id = np.full(len(least), HIGHEST) if least_id is None else least_id.astype(np.int64)
        self.query, self.score, self.id, self.null = (np.zeros(0, t) for t in (np.int64, np.int64, np.int64, bool))

    def add(self, query: np.ndarray, scores: np.ndarray, ids: np.ndarray, null: np.ndarray, without: np.ndarray | None = None) -> None:
        """``scores``: rows of documents by ``query``; ``without`` masks some."""
        enough = scores >= self.least[query]
        if without is not None:
            enough &= ~without
        doc, column = np.nonzero(enough)
        new, value = query[column], scores[doc, column]
        wins = (value > self.least[new]) | (np.where(null[doc], HIGHEST, ids[doc]) <= self.least_id[new])
        doc, new, value = doc[wins], new[wins], value[wins]
        if not len(doc):
            return
        pairs = zip((self.query, self.score, self.id, self.null), (new, value, ids[doc], null[doc]))
        query, score, ids, null = (np.concatenate(p) for p in pairs)
        order = np.lexsort((ids, null, -score, query))
        query = query[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        kept, self.query, rank = order[rank < self.k], query[rank < self.k], rank[rank < self.k]
        self.score, self.id, self.null = score[kept], ids[kept], null[kept]
        last = rank == self.k - 1
        self.least[self.query[last]] = self.score[last]
        self.least_id[self.query[last]] = np.where(self.null[last], HIGHEST, self.id[last])
