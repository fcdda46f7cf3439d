"""What a task has found out about words, kept by hash for the texts that follow."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from catalog_star.llm.texts import Texts


class WordCache:
    """A number per word hash. Holds ``limit`` words at most: then it starts anew, which costs time only."""

    def __init__(self, limit: int):
        self._limit = limit
        self.clear()

    def clear(self) -> None:
        self._levels = [(np.zeros(0, np.uint64), np.zeros(0, np.int64)) for _ in range(2)]

    def __len__(self) -> int:
        return sum(len(keys) for keys, _ in self._levels)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 where there is none. ``hashes`` rise."""
        found = np.full(len(hashes), -1, np.int64)
        for keys, values in self._levels:
            if len(keys):
                at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                hit = keys[at] == hashes
                found[hit] = values[at[hit]]
        return found

    def add(self, hashes: np.ndarray, values: np.ndarray) -> None:
        """Take in new words. Few new ones go to a small level, so that the large one is seldom merged."""
        old, new = self._levels
        new = self._merged(new, (hashes, values))
        if 4 * len(new[0]) > len(old[0]):
            old, new = self._merged(old, new), (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        self._levels = [old, new]

    @staticmethod
    def _merged(a, b):
        keys = np.concatenate([a[0], b[0]])
        order = np.argsort(keys, kind="stable")
        return keys[order], np.concatenate([a[1], b[1]])[order]

    @property
    def full(self) -> bool:
        return len(self) > self._limit


def number_words(texts: Texts, cache: WordCache, make: Callable[[list[bytes]], np.ndarray]) -> np.ndarray:
    """The number of every word of some texts. ``make`` gives the numbers of words the cache lacks, each asked once."""
    starts, ends, _ = texts.words()
    distinct, where, which = np.unique(texts.word_hashes(), return_index=True, return_inverse=True)
    found = cache.find(distinct)
    lacking = np.flatnonzero(found < 0)
    if len(lacking):
        data = texts.data.tobytes()
        words = [data[a:b] for a, b in zip(starts[where[lacking]].tolist(), ends[where[lacking]].tolist())]
        found[lacking] = make(words)
        cache.add(distinct[lacking], found[lacking])
    return found[which]
