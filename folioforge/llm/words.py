"""Numbering of words for vectorised scoring: each distinct word gets a row of numbers, made once per worker."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from folioforge.llm.shared import given_back

#: Bytes (as estimated) that a worker's memo may take; beyond it the memo starts anew. Bytes of an entry besides its key.
MEMO, ENTRY = 48 << 20, 200
#: Words whose rows are made at once: a batch of rare words would take some 100 MB for a moment.
MADE = 8192
_HOLDER: list = []


def hold(memo) -> None:
    """Makes memo the one that this worker keeps; another operator's, left by an earlier task, is emptied."""
    if not _HOLDER or _HOLDER[0] is not memo:
        others, _HOLDER[:] = _HOLDER[:], [memo]
        for other in others:
            other.empty()
        if others:
            given_back()


class WordRows:
    """rows(texts) -> (row of each word, words in each text); table[row] holds what make(words) gave for it.

    Texts are split at white space; given as bytes, at space, tab, line feed, vertical tab, form feed and carriage
    return alone.
    """

    def __init__(self, make: Callable[[list], np.ndarray], width: int, dtype=np.float32):
        self.make, self.width, self.dtype = make, width, dtype
        self.empty()

    def empty(self) -> None:
        self.seen: dict = {}
        self.bytes = 0
        self.table = np.zeros((1024, self.width), self.dtype)

    def rows(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        hold(self)
        if self.bytes > MEMO:
            self.empty()
        seen, known = self.seen, len(self.seen)
        split = [t.split() for t in texts]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        get = seen.setdefault
        flat = np.fromiter((get(w, len(seen)) for words in split for w in words), np.int64, int(counts.sum()))
        if len(seen) > known:
            fresh = list(seen)[known:] if known == 0 else [w for w, _ in zip(reversed(seen), range(len(seen) - known))][::-1]
            if len(seen) > len(self.table):
                more = np.zeros((2 * len(seen), self.width), self.dtype)
                more[:known] = self.table[:known]
                self.table = more
            for at in range(0, len(fresh), MADE):
                some = fresh[at : at + MADE]
                self.table[known + at : known + at + len(some)] = self.make(some)
            self.bytes += sum(map(len, fresh)) + len(fresh) * (ENTRY + self.table.itemsize * self.width)
        return flat, counts

    def sums(self, flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """For each text, the sum of its words' rows, in double precision."""
        out = np.zeros((len(counts), self.width))
        some = counts > 0
        if len(flat):
            starts = (np.cumsum(counts) - counts)[some]
            out[some] = np.add.reduceat(self.table[flat], starts, axis=0, dtype=np.float64)
        return out
